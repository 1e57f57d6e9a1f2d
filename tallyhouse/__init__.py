"""tallyhouse: retail lakehouse analytics written as plain Spark jobs.

Layers: ``sources`` (scans, sinks, test feed), ``functions`` (column helpers), ``operators``
(reusable row-set operations), ``plans`` (silver, gold and analytic tables) and ``streaming``.
"""

from tallyhouse.plans.lake import Lake

__all__ = ["Lake"]
