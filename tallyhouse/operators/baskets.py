"""Which items occur together: exact pair support, with large baskets split over many tasks."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


#: Rows or pairs that one task holds, about.
TASK_ROWS = 2_000_000


def pair_support(baskets: DataFrame, min_support: int, items_per_block: int = 256) -> DataFrame:
    """Pairs ``(item_a, item_b, support)`` with ``item_a < item_b`` found in ``min_support`` baskets or more.

    ``baskets`` holds distinct ``(basket, item)`` rows, best without items that occur in fewer than ``min_support``
    baskets: those cannot be in a result pair.

    Every basket is cut into blocks of about ``items_per_block`` items by a hash of the item; an ordinary basket has one. A row
    goes once to each pair of blocks that holds its own, and pairs are formed inside a pair of blocks only, so no task
    meets more than two blocks of a basket at once. Each pair of items of a basket is met exactly once: support is a count of such
    meetings, and counting them is the work this operator has to do, in proportion to the pairs that the baskets hold.

    The number of tasks follows the rows and pairs, which are counted first, so what a task sorts or counts does not grow with the input. Pairs
    are dealt out as they are met: few of them meet twice in one task, and a table of partial counts would hold them all.
    """
    sizes = baskets.groupBy("basket").agg(F.count(F.lit(1)).alias("n")).withColumn("blocks", F.ceil(F.col("n") / items_per_block).cast("int"))
    n_rows, n_pairs = sizes.agg(F.sum(F.col("n").cast("double") * F.col("blocks")), F.sum(F.col("n").cast("double") * (F.col("n") - 1) / 2)).first()
    least = int(baskets.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tasks = [max(least, math.ceil((n or 0) / TASK_ROWS)) for n in (n_rows, n_pairs)]
    sizes = sizes.drop("n")
    block = F.pmod(F.xxhash64("item"), F.col("blocks")).cast("int")
    rows = baskets.join(sizes, "basket").withColumn("block", block)
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.select("basket", "item", "block", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"))
    rows = rows.repartition(tasks[0], "basket", "lo", "hi")
    met = rows.alias("a").join(rows.alias("b"), ["basket", "lo", "hi"]).where(F.col("a.item") < F.col("b.item"))
    met = met.where((F.col("lo") == F.col("hi")) | (F.col("a.block") != F.col("b.block")))
    met = met.select(F.col("a.item").alias("item_a"), F.col("b.item").alias("item_b")).repartition(tasks[1], "item_a", "item_b")
    pairs = met.groupBy("item_a", "item_b")
    return pairs.agg(F.count(F.lit(1)).alias("support")).where(F.col("support") >= min_support)
