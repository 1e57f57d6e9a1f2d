"""Spines and grids: complete key ranges to which facts are attached, gaps filled with 0."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.operators.ranking import ranked

#: Site lists up to this length are sent to every executor.
MANY_SITES = 100_000


def calendar_spine(df: DataFrame, day: str, measures: Mapping[str, Column]) -> DataFrame:
    """One row per calendar day between the first and last ``day``; days without rows get 0."""
    days = df.agg(F.min(day).alias("lo"), F.max(day).alias("hi")).select(
        F.explode(F.sequence("lo", "hi", F.expr("interval 1 day"))).alias(day)
    )
    daily = df.groupBy(day).agg(*[m.alias(n) for n, m in measures.items()])
    return days.join(daily, day, "left").na.fill(0, list(measures))


def product_site_day_grid(
    products: DataFrame, sites: DataFrame, facts: DataFrame, measures: Sequence[str],
    product: str = "product_id", site: str = "warehouse_id", day: str = "snapshot_date",
) -> DataFrame:
    """Every product at every site on every day of the facts' date range, measures 0 where no fact exists.

    The grid grows out of the product rows (one explode per axis) and meets the sites on a dense number,
    so no cross join is planned. A plan's size check does not see what an explode multiplies and would send the exploded products, or a
    fact table that grew out of an explode, to every executor: here it is the counted sites that are sent, and facts meet the grid by sorting both.
    """
    numbered = ranked(sites.select(site), "_site_no", site, site, ascending=True)
    first, last, n_sites = (
        *facts.agg(F.min(day), F.max(day)).first(),
        sites.count(),
    )
    if first is None or n_sites == 0:
        return facts.limit(0).select(product, site, day, *measures)
    grid = (
        products.select(product)
        .withColumn("_site_no", F.explode(F.sequence(F.lit(1), F.lit(n_sites))))
        .join(numbered.hint("broadcast" if n_sites <= MANY_SITES else "merge"), "_site_no")
        .withColumn(day, F.explode(F.sequence(F.lit(first), F.lit(last), F.expr("interval 1 day"))))
        .select(product, site, day)
    )
    return grid.join(facts.select(product, site, day, *measures).hint("merge"), [product, site, day], "left").na.fill(0, list(measures))


def expand_rows(df: DataFrame, times: str, seq: str = "item_seq") -> DataFrame:
    """Repeat each row ``times`` times, numbered from 1; rows with 0, a negative or NULL count vanish."""
    return df.where(F.col(times) > 0).withColumn(seq, F.explode(F.sequence(F.lit(1), F.col(times))))
