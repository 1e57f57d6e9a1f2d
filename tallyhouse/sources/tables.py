"""Batch scans and sinks over Parquet folders named ``<root>/<layer>/<table>``."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: folder inside a bucketed table that says how many buckets it has; scans of the table skip it
BUCKETING = "_bucketing"


def load(spark: SparkSession, root: str, layer: str, table: str, merge_schema: bool = False) -> DataFrame:
    """Scan one table. ``merge_schema`` unites the columns of files written over time."""
    reader = spark.read.option("mergeSchema", "true") if merge_schema else spark.read
    return reader.parquet(f"{root}/{layer}/{table}")


def register_views(tables: Mapping[str, DataFrame]) -> None:
    """Expose frames to ``spark.sql`` as temp views named ``layer_table``."""
    for name, frame in tables.items():
        frame.createOrReplaceTempView(name.replace(".", "_"))


def overwrite(df: DataFrame, path: str, partition_by: Sequence[str] = (), sort_by: Sequence[str] = ()) -> None:
    """Replace a table, schema included.

    A partitioned write first rebalances on its partition columns: rows of one folder meet in few
    tasks, and an oversized folder is split by AQE, so a month that holds a third of all rows
    is written by many tasks.
    """
    _writer(df, partition_by, sort_by).mode("overwrite").parquet(path)


def append(df: DataFrame, path: str, partition_by: Sequence[str] = (), sort_by: Sequence[str] = ()) -> None:
    """Add rows to a table; the partition columns must be those of the table."""
    _writer(df, partition_by, sort_by).mode("append").parquet(path)


def _place(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), where


def mark(spark: SparkSession, path: str) -> None:
    """Create an empty file; it is there or not, never half."""
    system, where = _place(spark, path)
    system.create(where, True).close()


def marks(spark: SparkSession, folder: str) -> list[int]:
    """Numbers that :func:`mark` has left as file names in a folder, ascending; none if there is no such folder."""
    system, where = _place(spark, folder)
    return sorted(int(f.getPath().getName()) for f in system.listStatus(where)) if system.exists(where) else []


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file or folder of the library's own, if it is there."""
    system, where = _place(spark, path)
    system.delete(where, True)


def bucketed_name(path: str) -> str:
    """Name under which the session's catalog knows the bucketed table of a folder."""
    return f"bucketed_{path.rstrip('/').rsplit('/', 1)[-1]}_{hashlib.sha256(path.rstrip('/').encode()).hexdigest()[:16]}"


def overwrite_bucketed(df: DataFrame, path: str, key: str, partition_by: Sequence[str] = (), buckets: int | None = None) -> DataFrame:
    """Replace a table whose rows lie in ``buckets`` by ``key`` and return a scan that knows it.

    The default is a quarter of the shuffle partitions, since a bucket is a file in every partition folder.

    Two tables with the same number of buckets are joined by the key, and each is grouped by it, without an exchange. Rows are
    dealt out by the key before they are written, so a bucket is one file per partition folder; the key should be
    spread evenly, as one that is unique or nearly so is. The partition columns should have far fewer values than there are rows in a
    file.
    """
    buckets = buckets or max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) // 4)
    name = bucketed_name(path)
    df.sparkSession.sql(f"DROP TABLE IF EXISTS {name}")
    writer = df.repartition(buckets, key).write.mode("overwrite").bucketBy(buckets, key).sortBy(key).option("path", path)
    (writer.partitionBy(*partition_by) if partition_by else writer).saveAsTable(name)
    df.sparkSession.range(1).select(F.lit(buckets).alias("buckets")).write.parquet(f"{path}/{BUCKETING}")
    return df.sparkSession.table(name)


def load_bucketed(spark: SparkSession, path: str, key: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Scan a table written by :func:`overwrite_bucketed`; a session whose catalog does not know it registers it again."""
    name = bucketed_name(path)
    if not spark.catalog.tableExists(name):
        plain = spark.read.parquet(path)
        buckets = spark.read.parquet(f"{path}/{BUCKETING}").first()[0]
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in plain.schema.fields)
        folders = f"PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
        spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet {folders} CLUSTERED BY ({key}) SORTED BY ({key}) INTO {buckets} BUCKETS LOCATION '{path}'")
        if partition_by:
            spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
    return spark.table(name)


def _writer(df: DataFrame, partition_by: Sequence[str], sort_by: Sequence[str]):
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    if sort_by:
        df = df.sortWithinPartitions(*partition_by, *sort_by)
    return df.write.partitionBy(*partition_by) if partition_by else df.write


def union_by_name(frames: Iterable[DataFrame]) -> DataFrame:
    """UNION ALL that merges schemas: a column absent from a frame is NULL there."""
    first, *rest = list(frames)
    for frame in rest:
        first = first.unionByName(frame, allowMissingColumns=True)
    return first


def split_by_schema(lines: DataFrame, text: str, schema: str, options: Mapping[str, str] | None = None) -> DataFrame:
    """Parse JSON text against a declared schema and mark each row.

    Adds ``parsed`` (struct) and ``is_valid``; a row is invalid when the text does not fit the schema.
    Split the result on ``is_valid`` to get the good rows and the rejects.
    """
    marker = "_corrupt_record"
    parsed = F.from_json(
        F.col(text),
        f"{schema}, {marker} string",
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": marker, **(options or {})},
    )
    return lines.withColumn("parsed", parsed).withColumn("is_valid", F.col(f"parsed.{marker}").isNull())
