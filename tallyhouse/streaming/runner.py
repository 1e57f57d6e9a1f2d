"""Start streams, wait for the backlog to be consumed, read the result back."""

from __future__ import annotations

from collections.abc import Sequence
from contextlib import contextmanager
from threading import Lock

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tallyhouse.session import workspace
from tallyhouse.sources.tables import mark, marks, remove

EVENT_SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
ORDER_SCHEMA = T.StructType([
    T.StructField("order_id", T.StringType(), False),
    T.StructField("customer_id", T.LongType(), False),
    T.StructField("order_date", T.StringType(), False),
    T.StructField("items", T.ArrayType(T.StructType([
        T.StructField("product_id", T.LongType()),
        T.StructField("quantity", T.IntegerType()),
        T.StructField("price", T.DoubleType()),
    ]))),
    T.StructField("total_amount", T.DoubleType()),
    T.StructField("status", T.StringType()),
    T.StructField("shipping_address", T.StructType([
        T.StructField(name, T.StringType()) for name in ("street", "city", "state", "zip")
    ])),
])
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def read_events(spark: SparkSession, root: str, name: str = "events.parquet", max_files: int | None = None) -> DataFrame:
    """Raw events as a stream over ``<root>/<name>``, a Parquet file or a folder of them.

    The path is written as a pattern: unlike a plain path it may name a single file.
    """
    reader = spark.readStream.schema(EVENT_SCHEMA)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(f"{root}/{{{name}}}")


def read_table(spark: SparkSession, path: str, schema: T.StructType, max_files: int | None = None) -> DataFrame:
    """A Parquet table as a stream."""
    reader = spark.readStream.schema(schema)
    return (reader.option("maxFilesPerTrigger", max_files) if max_files else reader).parquet(path)


def read_orders_json(spark: SparkSession, path: str, max_files: int = 1000) -> DataFrame:
    """Order documents (one JSON object per line) as a stream, declared schema, limited files per batch."""
    return spark.readStream.schema(ORDER_SCHEMA).option("maxFilesPerTrigger", max_files).json(path)


_starting = Lock()


@contextmanager
def _stream_settings(spark: SparkSession, state_partitions: int | None):
    """Settings a query keeps for life are read when it starts: state partitions and a store that can spill.

    A stream belongs to the session of its frame, so the settings are made there for the moment of the start. Starts take turns;
    batch queries that other threads plan in the same session at that moment should use a session of their own.
    """
    wanted = {
        "spark.sql.shuffle.partitions": str(state_partitions or spark.sparkContext.defaultParallelism),
        "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
    }
    with _starting:
        before = {k: spark.conf.get(k, None) for k in wanted}
        for k, v in wanted.items():
            spark.conf.set(k, v)
        try:
            yield
        finally:
            for k, v in before.items():
                spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def start_append(
    df: DataFrame, path: str, checkpoint: str, partition_by: Sequence[str] = (), state_partitions: int | None = None
) -> StreamingQuery:
    """Append finished rows to Parquet. The file sink's log and the checkpoint make it exactly-once."""
    writer = df.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    with _stream_settings(df.sparkSession, state_partitions):
        return writer.trigger(availableNow=True).start(path)


def start_complete(df: DataFrame, path: str, checkpoint: str, state_partitions: int | None = None) -> StreamingQuery:
    """Publish the full aggregate after every micro-batch as a new version of the table.

    Each batch writes its own ``version=<batch id>`` folder, so a batch replayed after a failure
    overwrites just what it wrote before, and readers of the previous version are not disturbed. A finished
    version has an empty file with its number in the folder ``committed``; readers take versions from there only. The version before
    the previous one is deleted then.
    """

    def publish(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/data/version={batch_id}")
        mark(batch.sparkSession, f"{path}/committed/{batch_id}")
        for old in [v for v in marks(batch.sparkSession, f"{path}/committed") if v < batch_id - 1]:
            remove(batch.sparkSession, f"{path}/committed/{old}")
            remove(batch.sparkSession, f"{path}/data/version={old}")

    writer = df.writeStream.foreachBatch(publish).outputMode("complete").option("checkpointLocation", checkpoint)
    with _stream_settings(df.sparkSession, state_partitions):
        return writer.trigger(availableNow=True).start()


def latest_version(spark: SparkSession, path: str) -> DataFrame:
    """The newest committed version written by :func:`start_complete`; a half-written one is not seen."""
    return spark.read.parquet(f"{path}/data/version={max(marks(spark, f'{path}/committed'))}")


def drain_append(df: DataFrame, partition_by: Sequence[str] = (), label: str = "stream") -> DataFrame:
    """Run an append stream over everything available into a fresh folder and return the table."""
    spark = df.sparkSession
    root = workspace(spark, label)
    query = start_append(df, f"{root}/data", f"{root}/checkpoint", partition_by)
    query.awaitTermination()
    return spark.read.schema(df.schema).parquet(f"{root}/data")


def drain_complete(df: DataFrame, label: str = "stream") -> DataFrame:
    """Run a complete-mode stream over everything available into a fresh folder and return its last version."""
    spark = df.sparkSession
    root = workspace(spark, label)
    start_complete(df, f"{root}/data", f"{root}/checkpoint").awaitTermination()
    return latest_version(spark, f"{root}/data")
