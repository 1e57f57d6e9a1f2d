"""What the operators share: table access, staging in the shared folder, batch sizes, hashes of words."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.session import configure, workspace

#: Rows of an Arrow batch. Long texts make large batches, so it is kept small.
BATCH_ROWS = 500
BATCH_BYTES = 16 << 20
TIDY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings of this package: those of the library and small Arrow batches."""
    configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the input tables."""
    return prepare(spark).read.parquet(f"{folder}/{name}.parquet")


@contextmanager
def tidy(spark: SparkSession) -> Iterator[None]:
    """Jobs in this block delete their shuffle files when they are done: their results are written and never computed again."""
    before = spark.conf.get(TIDY, None)
    spark.conf.set(TIDY, "true")
    try:
        yield
    finally:
        spark.conf.unset(TIDY) if before is None else spark.conf.set(TIDY, before)


def stage(df: DataFrame, label: str, codec: str | None = None) -> DataFrame:
    """Write a frame to the shared folder and read it back: later steps do not recompute it."""
    path = workspace(df.sparkSession, label)
    with tidy(df.sparkSession):
        df.write.parquet(path, compression=codec)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete the folder of a staged frame that nothing reads any more."""
    spark = df.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()[:1]}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def remainder(key: str, of: int) -> Column:
    """crc32 of a key written as text, modulo ``of``; a NULL key counts as empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit(""))) % of


def hash_sample(df: DataFrame, columns: list[str], rows: int, seed: int) -> DataFrame:
    """About ``rows`` rows, those with the smallest hash of ``columns`` in the whole table, never more.

    Only hashes are sorted; the rows themselves are read again and filtered, so no task receives more than the sample.
    """
    mark = F.xxhash64(F.lit(seed), *columns)
    last = df.select(mark.alias("h")).orderBy("h").limit(rows).agg(F.max("h")).first()[0]
    return df.where(mark <= (-(1 << 63) if last is None else last)).limit(rows)


def batches(
    convert: Callable[[pa.RecordBatch], pa.RecordBatch | None],
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A ``mapInArrow`` function that converts one batch after the other."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            made = convert(batch)
            if made is not None:
                yield made

    return run


_HELD: dict[str, Callable[[], None]] = {}


def hold(owner: str, release: Callable[[], None]) -> None:
    """Say that an operator keeps values in this worker process; what other operators keep is released first.

    Worker processes outlive stages: without this the caches of all operators that ever ran in one would add up.
    """
    if len(_HELD) == 1 and owner in _HELD:
        return
    for other in [o for o in _HELD if o != owner]:
        _HELD.pop(other)()
    _HELD[owner] = release


class WordHashes(dict):
    """64-bit hash of each word (bytes), kept up to ``limit`` words and then begun anew."""

    def __init__(self, limit: int = 250_000, seed: int = 0):
        super().__init__()
        self.limit, self.seed = limit, seed

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word, self.seed)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=len(words))


_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5], dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble the bits of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def windows(words: np.ndarray, size: int = 5) -> np.ndarray:
    """Hash of each window of ``size`` words; of all words together where there are fewer, none for no words."""
    n = len(words)
    if n == 0:
        return words
    take = min(n, size)
    total = words[: n - take + 1] * _ODD[0]
    for i in range(1, take):
        total += words[i : n - take + 1 + i] * _ODD[i % 5]
    return mix(total + np.uint64(take))
