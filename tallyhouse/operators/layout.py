"""Physical layout: files clustered by several columns at once."""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows of the sample that text bounds come from, characters of a text that count, and the accuracy of numeric bounds.
SAMPLE, TEXT, ACCURACY = 10_000, 200, 100_000


def ordinal(df: DataFrame, name: str) -> Column:
    """Whole number that orders like the column: whole numbers and dates directly, decimals in their smallest unit, other
    fractions in millionths, text by the six bytes after what all its values have in common at their start."""
    kind = df.schema[name].dataType
    c = F.col(name)
    if isinstance(kind, T.StringType):
        low, high = df.agg(F.min(c), F.max(c)).first()
        low, high = (low or "").encode(), (high or "").encode()
        common = len(os.path.commonprefix([low, high]))  # of the extremes, so of all values between them
        tail = F.substring(c.cast("binary"), common + 1, 6)
        return F.conv(F.rpad(F.hex(tail), 12, "0"), 16, 10).cast("bigint")
    if isinstance(kind, T.DateType):
        return F.unix_date(c).cast("bigint")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(c.cast("timestamp"))
    if isinstance(kind, T.DecimalType):
        return F.floor(c * 10**kind.scale).cast("decimal(38,0)")
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return F.floor(c.cast("double") * 1e6).cast("decimal(38,0)")
    return c.cast("bigint")


def zorder_key(df: DataFrame, columns: Sequence[str], bits: int = 8, name: str = "z_key") -> DataFrame:
    """Add a Z-order key: the range bucket of each column (``2**bits`` of equal width), bits interleaved.

    Bit ``i`` of column ``j`` goes to position ``i * len(columns) + j``; a NULL counts as bucket 0.
    """
    if bits * len(columns) > 62:
        raise ValueError("bits * columns must fit a long")
    ranges = df.agg(*[f(ordinal(df, c)).alias(f"{p}{i}") for i, c in enumerate(columns) for p, f in (("lo", F.min), ("hi", F.max))]).first()
    key = F.lit(0).cast("bigint")
    for j, c in enumerate(columns):
        low, high = ranges[f"lo{j}"], ranges[f"hi{j}"]
        if low is None:
            continue
        scaled = (ordinal(df, c) - F.lit(low)).cast("decimal(28,0)") * F.lit(1 << bits)
        width = F.lit(high - low + 1).cast("decimal(28,0)")
        bucket = F.coalesce(F.call_function("div", scaled, width), F.lit(0).cast("bigint"))
        for i in range(bits):
            bit = F.shiftright(bucket, i).bitwiseAND(F.lit(1).cast("bigint"))
            key = key.bitwiseOR(F.shiftleft(bit, i * len(columns) + j))
    return df.withColumn(name, key)


def _texts(df: DataFrame, name: str, cuts: int) -> list[str]:
    """``cuts`` texts that divide a hashed sample of ``SAMPLE`` values evenly, each cut to ``TEXT`` characters; the sample is bounded."""
    value = F.substring(name, 1, TEXT).alias("v")
    sample = df.where(F.col(name).isNotNull()).select(value, F.xxhash64(*df.columns).alias("h")).orderBy("h", "v").limit(SAMPLE)
    values = sorted((r["v"] for r in sample.collect()), key=lambda v: v.encode())
    return [values[(i + 1) * len(values) // (cuts + 1)] for i in range(cuts)] if values else []


def quantile_bounds(df: DataFrame, columns: Sequence[str], bits: int = 8) -> dict[str, list]:
    """For each column up to ``2**bits - 1`` ascending values that divide its rows into parts of similar size.

    Numbers, dates and times come from one ``approx_percentile`` pass over all rows (exact up to some 50,000 rows), text from the
    whole values of a bounded sample. Equal bounds are kept once: a value that fills several parts has one bucket.
    """
    cuts = (1 << bits) - 1
    text = [c for c in columns if isinstance(df.schema[c].dataType, T.StringType)]
    rest = [c for c in columns if c not in text]
    shares = [(i + 1) / (cuts + 1) for i in range(cuts)]
    found = df.agg(*[F.percentile_approx(ordinal(df, c), shares, ACCURACY).alias(c) for c in rest]).first() if rest else {}
    return {c: sorted(set(_texts(df, c, cuts) if c in text else found[c] or []), key=lambda v: v.encode() if c in text else v) for c in columns}


def bucket_by(value: Column, bounds: Sequence, kind: str) -> Column:
    """How many of the ascending ``bounds`` are at most ``value``, by binary search in a literal array; NULL counts as 0."""
    if not bounds:
        return F.lit(0)
    array = F.array(*[F.lit(b).cast(kind) for b in bounds])
    steps = F.array(*[F.lit(1 << i) for i in range(len(bounds).bit_length() - 1, -1, -1)])

    def step(at: Column, size: Column) -> Column:
        reaches = (at + size <= len(bounds)) & (F.get(array, at + size - 1) <= value)
        return at + F.when(reaches, size).otherwise(0)

    return F.aggregate(steps, F.lit(0), step)


def quantile_key(df: DataFrame, columns: Sequence[str], bits: int = 8, name: str = "z_key") -> DataFrame:
    """Add a Z-order key whose buckets hold similar numbers of rows, however values are spread: one value far off moves no other bound.

    Bit ``i`` of column ``j`` goes to position ``i * len(columns) + j`` as in :func:`zorder_key`; a NULL counts as bucket 0.
    """
    if bits * len(columns) > 62:
        raise ValueError("bits * columns must fit a long")
    key = F.lit(0).cast("bigint")
    for j, (c, bounds) in enumerate(quantile_bounds(df, columns, bits).items()):
        text = isinstance(df.schema[c].dataType, T.StringType)
        value = F.substring(c, 1, TEXT) if text else ordinal(df, c)
        bucket = bucket_by(value, bounds, "string" if text else df.select(value.alias("v")).schema["v"].dataType.simpleString()).cast("bigint")
        for i in range(bits):
            key = key.bitwiseOR(F.shiftleft(F.shiftright(bucket, i).bitwiseAND(F.lit(1).cast("bigint")), i * len(columns) + j))
    return df.withColumn(name, key)


def files_to_read(scan: DataFrame, column: str, low, high) -> tuple[int, int]:
    """Files whose range of ``column`` meets ``low`` to ``high``, by their own extremes, and all files with a value in it."""
    ranges = scan.where(F.col(column).isNotNull()).groupBy(F.col("_metadata.file_path").alias("f")).agg(F.min(column).alias("a"), F.max(column).alias("b"))
    row = ranges.agg(F.count_if((F.col("a") <= F.lit(high)) & (F.col("b") >= F.lit(low))).alias("hit"), F.count(F.lit(1)).alias("n")).first()
    return row["hit"], row["n"]


def cluster_write(df: DataFrame, path: str, columns: Sequence[str], files: int, bits: int = 8) -> None:
    """Rewrite a table into ``files`` files of similar size, clustered by Z-order over quantile buckets.

    Rows are range-partitioned on the key plus a row hash, so equal keys, however many, are
    divided too. Parquet min/max statistics then skip files for filters on any of the columns.
    """
    keyed = quantile_key(df, columns, bits, "_z")
    spread = F.xxhash64(*df.columns)
    (
        keyed.withColumn("_h", spread)
        .repartitionByRange(files, "_z", "_h")
        .sortWithinPartitions("_z")
        .drop("_z", "_h")
        .write.mode("overwrite").parquet(path)
    )
