"""Exact distinct counts that merge: one bit per key in bitmaps of 32,768 keys.

A distinct count cannot be added up over days or stores, a bitmap can be united. Keys are whole numbers; the denser they
are, the less a bitmap wastes: it has 4 kB for every 32,768 numbers of which at least one occurs. Where groups hold few keys
of a block, as days do, words of 64 keys take less.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Keys in one bitmap.
KEYS = 32_768


def key_bitmaps(df: DataFrame, groups: Sequence[str], key: str, sums: Sequence[Column] = ()) -> DataFrame:
    """One row per group and block of keys: ``groups``, ``bucket``, ``bitmap`` and the ``sums``. Rows with a NULL key are in the
    bucket NULL, whose bitmap is empty; a hot group is spread over as many rows as it has blocks of keys."""
    c = F.col(key).cast("bigint")
    return df.groupBy(*groups, F.bitmap_bucket_number(c).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(c)).alias("bitmap"), *sums)


def key_words(df: DataFrame, groups: Sequence[str], key: str, sums: Sequence[Column] = ()) -> DataFrame:
    """As :func:`key_bitmaps` in bitmaps of 64 keys that are one long each: for groups that hold few of the keys of a block.

    A group never takes more words than it has keys, and rows stay narrow in shuffles, sorts and hash tables, where a bitmap has 4 kB however few its keys are.
    """
    c = F.col(key).cast("bigint")
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), c.bitwiseAND(63).cast("int"))
    word = F.coalesce(F.bit_or(bit), F.lit(0).cast("bigint"))
    return df.groupBy(*groups, F.shiftright(c, 6).alias("bucket")).agg(word.alias("bitmap"), *sums)


def _is_word(bitmaps: DataFrame) -> bool:
    return dict(bitmaps.dtypes)["bitmap"] == "bigint"


def unite(bitmaps: DataFrame, groups: Sequence[str], sums: Sequence[Column] = ()) -> DataFrame:
    """Bitmaps of coarser groups, say weeks from days, without reading a key again."""
    both = F.bit_or("bitmap") if _is_word(bitmaps) else F.bitmap_or_agg("bitmap")
    return bitmaps.groupBy(*groups, "bucket").agg(both.alias("bitmap"), *sums)


def keys_in(bitmaps: DataFrame) -> Column:
    """Number of keys in a row's bitmap."""
    return (F.bit_count("bitmap") if _is_word(bitmaps) else F.bitmap_count("bitmap")).cast("bigint")


def count_keys(bitmaps: DataFrame, groups: Sequence[str], name: str = "distinct_keys") -> DataFrame:
    """Distinct keys per group, from bitmaps that have one row per group and bucket."""
    return bitmaps.groupBy(*groups).agg(F.sum(keys_in(bitmaps)).alias(name))
