"""Changes to stored tables: only partitions that a change touches are written again, and a version counts once it is marked.

A table lies in ``<path>/data/v=<version>/<partition folders>``. Each version has a list (``<path>/list/<version>``) that names, for every
partition, the version whose folder holds it, its number of rows and a digest that does not depend on the order of rows. A change
finds the partitions it touches, writes those under the next version, then the list, then the empty file
``<path>/committed/<version>``. Readers take versions from there only, so a job that dies before the mark leaves nothing to see, and
folders of untouched partitions are shared between versions. One writer at a time; partitions, not rows, pass the driver.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.operators.changes import change_feed, first_per_key
from tallyhouse.sources.tables import mark, marks, remove


class StoredTable:
    """A table under ``path``, partitioned by ``partition_by`` (dates, whole numbers, or text that stands in a folder name as it is)."""

    def __init__(self, spark: SparkSession, path: str, partition_by: Sequence[str]):
        self.spark, self.path, self.partition_by = spark, path.rstrip("/"), list(partition_by)

    # --- versions ---------------------------------------------------------------------------------

    def versions(self) -> list[int]:
        """Committed versions, ascending."""
        return marks(self.spark, f"{self.path}/committed")

    def _list(self, version: int) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/list/{version}")

    def _latest(self, version: int | None = None) -> int:
        known = [v for v in self.versions() if version is None or v <= version]
        if not known:
            raise ValueError(f"{self.path} has no committed version" + ("" if version is None else f" up to {version}"))
        return known[-1]

    def read(self, version: int | None = None) -> DataFrame:
        """The newest version, or the newest up to ``version``."""
        at = self._latest(version)
        return self._folders(self._list(at), at)

    def _folders(self, listed: DataFrame, version: int) -> DataFrame:
        """Partitions of a list; without any, an empty frame with the columns of the version."""
        schema = self.spark.read.parquet(f"{self.path}/schema/{version}").schema
        folders = [f"{self.path}/data/v={r['v']}" + "".join(f"/{c}={r['_' + c]}" for c in self.partition_by) for r in listed.collect()]
        if not folders:
            return self.spark.read.schema(schema).parquet(f"{self.path}/schema/{version}")
        wide = T.StructType([*schema.fields, T.StructField("v", T.LongType())])
        return self.spark.read.option("basePath", f"{self.path}/data").schema(wide).parquet(*folders).select(*schema.names)

    def _commit(self, changed: DataFrame | None, kept: DataFrame | None, schema: DataFrame) -> int:
        """Write ``changed`` as partitions of the next version beside the list entries ``kept``."""
        known = self.versions()
        version = known[-1] + 1 if known else 0
        for part in ("data/v=", "list/", "schema/"):  # of a job that died before its mark
            remove(self.spark, f"{self.path}/{part}{version}")
        entries = kept
        if changed is not None:
            folder = f"{self.path}/data/v={version}"
            changed.hint("rebalance", *self.partition_by).write.partitionBy(*self.partition_by).parquet(folder)
            plain = [c for c in schema.columns if c not in self.partition_by]
            written = self.spark.read.schema(schema.schema).parquet(folder)
            raw = F.regexp_extract_all(F.col("_metadata.file_path"), F.lit("/([^/=]+)=([^/]*)"), F.lit(2))
            name = [F.element_at(raw, -(len(self.partition_by) - i)).alias(f"_{c}") for i, c in enumerate(self.partition_by)]
            made = written.select(*name, F.xxhash64(*plain).cast("decimal(38,0)").alias("h")).groupBy(*[f"_{c}" for c in self.partition_by]).agg(
                F.count(F.lit(1)).alias("n_rows"), F.sum("h").alias("digest")
            ).withColumn("v", F.lit(version).cast("bigint"))
            entries = made if kept is None else kept.unionByName(made)
        entries.coalesce(1).write.parquet(f"{self.path}/list/{version}")
        schema.limit(0).write.parquet(f"{self.path}/schema/{version}")
        mark(self.spark, f"{self.path}/committed/{version}")
        return version

    # --- changes ----------------------------------------------------------------------------------

    def overwrite(self, df: DataFrame) -> int:
        """Replace the whole table, or create it."""
        return self._commit(df, None, df.limit(0))

    def _touched(self, rows: DataFrame) -> DataFrame:
        """Folder names of the partitions that hold ``rows`` of this table's scan."""
        raw = F.regexp_extract_all(F.col("_metadata.file_path"), F.lit("/([^/=]+)=([^/]*)"), F.lit(2))
        return rows.select(*[F.element_at(raw, -(len(self.partition_by) - i)).alias(f"_{c}") for i, c in enumerate(self.partition_by)]).distinct()

    def _rewrite(self, touched: DataFrame, change) -> int:
        """Put ``change(rows of touched partitions)`` in the place of these partitions; nothing touched gives no version."""
        at = self._latest()
        names = [f"_{c}" for c in self.partition_by]
        values = touched.collect()
        if not values:
            return at
        hit = reduce(lambda a, b: a | b, [reduce(lambda a, b: a & b, [F.col(n) == F.lit(r[n]) for n in names]) for r in values])
        listed = self._list(at)
        old = self._folders(listed.where(hit), at)
        return self._commit(change(old), listed.where(~hit), self.read(at).limit(0))

    def delete(self, listed: DataFrame, key: str) -> int:
        """Remove rows whose ``key`` is listed; rows with a NULL key stay."""
        keys = listed.select(key).where(F.col(key).isNotNull()).distinct()
        found = self._touched(self.read().select("*", "_metadata").join(keys, key, "left_semi"))
        return self._rewrite(found, lambda rows: rows.join(keys, key, "left_anti").select(rows.columns))

    def upsert(self, updates: DataFrame, keys: Sequence[str]) -> int:
        """Replace rows by those with the same key (NULL equals NULL), add new keys; a row may move to another partition.

        A key that occurs twice in ``updates`` is refused.
        """
        once = updates.select(*[F.col(k).alias(f"_u_{k}") for k in keys])
        if not once.groupBy(*once.columns).count().where("count > 1").isEmpty():
            raise ValueError(f"more than one row for a key of {list(keys)}")
        same = [F.col(k).eqNullSafe(F.col(f"_u_{k}")) for k in keys]
        table = self.read()
        at = self._latest()
        leaving = self._touched(table.select("*", "_metadata").join(once, same, "left_semi"))
        arriving = updates.select(*[F.col(c).cast("string").alias(f"_{c}") for c in self.partition_by]).distinct()
        here = self._list(at).join(arriving, [f"_{c}" for c in self.partition_by], "left_semi").select(leaving.columns)
        touched = leaving.unionByName(here).distinct()
        if touched.isEmpty():  # only new partitions
            return self._commit(updates.select(table.columns), self._list(at), table.limit(0))
        return self._rewrite(touched, lambda rows: rows.join(once, same, "left_anti").select(rows.columns).unionByName(updates.select(rows.columns)))

    def retain(self, ts: str, as_of: dt.datetime, hours: int) -> int:
        """Remove rows older than ``hours`` at ``as_of``; rows without a time stay."""
        old = F.col(ts) < F.lit(as_of - dt.timedelta(hours=hours))
        found = self._touched(self.read().select("*", "_metadata").where(old))
        return self._rewrite(found, lambda rows: rows.where(~F.coalesce(old, F.lit(False))))

    def vacuum(self, keep: int = 2) -> int:
        """Forget all but the newest ``keep`` versions and delete the partition folders that none of these uses; returns their number."""
        known = self.versions()
        gone, stay = known[:-keep], known[-keep:]
        if not gone:
            return 0
        names = [*[f"_{c}" for c in self.partition_by], "v"]
        used = {tuple(r) for v in stay for r in self._list(v).select(names).collect()}
        dead = {tuple(r) for v in gone for r in self._list(v).select(names).collect()} - used
        for v in gone:
            for part in ("committed", "list", "schema"):
                remove(self.spark, f"{self.path}/{part}/{v}")
        for *folders, v in dead:
            remove(self.spark, f"{self.path}/data/v={v}" + "".join(f"/{c}={x}" for c, x in zip(self.partition_by, folders)))
        return len(dead)

    # --- comparison -------------------------------------------------------------------------------

    def changes(self, old: int, new: int, keys: Sequence[str]) -> DataFrame:
        """Changes from version ``old`` to ``new`` as :func:`change_feed` gives them. Partitions with equal digests are not read."""
        names = [f"_{c}" for c in self.partition_by]
        a, b = self._list(self._latest(old)), self._list(self._latest(new))
        differ = a.join(b.select(*names, F.col("n_rows").alias("n"), F.col("digest").alias("d")), names, "full_outer").where(
            ~(F.col("n_rows").eqNullSafe(F.col("n")) & F.col("digest").eqNullSafe(F.col("d")))
        ).select(names)
        return change_feed(
            self._folders(a.join(differ, names, "left_semi"), self._latest(old)), self._folders(b.join(differ, names, "left_semi"), self._latest(new)), keys
        )


def write_snapshot(log: DataFrame, path: str, keys: Sequence[str], version: str, at: int) -> None:
    """Keep the latest entry per key up to version ``at``, deletes included, as ``<path>/data/snapshot=<at>``."""
    first_per_key(log.where(F.col(version) <= F.lit(at)), keys, [F.col(version).desc()]).write.mode("overwrite").parquet(f"{path}/data/snapshot={at}")
    mark(log.sparkSession, f"{path}/committed/{at}")


def state_from_snapshot(log: DataFrame, path: str, keys: Sequence[str], version: str, upto: int, is_delete: Column) -> DataFrame:
    """Table state after all log entries up to ``upto``, from the nearest snapshot before and the entries after it.

    Equal to :func:`state_as_of` over the whole log. A log stored by ``version`` reads only the folders after the snapshot.
    """
    usable = [s for s in marks(log.sparkSession, f"{path}/committed") if s <= upto]
    seen = log.where(F.col(version) <= F.lit(upto))
    if usable:
        snapshot = log.sparkSession.read.schema(log.schema).parquet(f"{path}/data/snapshot={usable[-1]}")
        seen = seen.where(F.col(version) > F.lit(usable[-1])).unionByName(snapshot)
    return first_per_key(seen, keys, [F.col(version).desc()]).where(~is_delete)
