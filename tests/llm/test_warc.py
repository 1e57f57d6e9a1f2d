import base64
import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tallyhouse.llm import warc
from tallyhouse.llm.base import prepare

PAGES = T.StructType([T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()), T.StructField("html", T.StringType()), T.StructField("sha", T.StringType()), T.StructField("page", T.StringType())])


def expected(rows, least=0):
    by = defaultdict(list)
    for p, _, h in rows:
        by[(h or "").encode()].append(p)
    out = []
    for p, _, h in rows:
        raw = (h or "").encode()
        newest = max((x for x in by[raw] if x is not None), default=None)
        revisit = len(raw) >= least and newest is not None and p != newest
        out.append((p, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "revisit" if revisit else "response", newest if revisit else None))
    return sorted(out, key=str)


ROWS = [(1, "http://a/%\r\nX: y", "<p>é漢</p>"), (2, None, None), (3, "", ""), (4, "u", "big" * 300_000), (9, "v", "big" * 300_000), (5, "u", "\r\n\r\nWARC/1.1\r\n\r\n"),
        (6, "w", "<p>é漢</p>"), (6, "w", "<p>é漢</p>"), (None, "n", "only null"), (None, "n", "<p>é漢</p>"), (7, "x", "a" * warc.CHUNK_BYTES), (8, "x", "a" * (2 * warc.CHUNK_BYTES))]


def test_round_trip(spark):
    prepare(spark)
    table = spark.createDataFrame([(*r, "s", "p") for r in ROWS], PAGES)
    for least in (0, 5):
        path = warc.write(table, least=least)
        assert sorted(map(tuple, warc.read(spark, path).collect()), key=str) == expected(ROWS, least)
    chunks = spark.read.parquet(path)
    assert chunks.agg(F.max(F.octet_length("content"))).first()[0] < warc.CHUNK_BYTES + 2000
    # the contents in order are the record
    big = chunks.groupBy("record_id").agg(F.sort_array(F.collect_list(F.struct("chunk_no", "content"))).alias("c")).where("size(c) = 4").first()
    whole = b"".join(bytes(x["content"]) for x in big["c"])
    fields, http, at = warc.parse_header(whole)
    assert whole[at:] == b"big" * 300_000 + warc.END and int(fields["Content-Length"]) == len(whole) - whole.index(warc.END) - 8


def test_damage_is_found(spark):
    table = spark.createDataFrame([(*r, "s", "p") for r in ROWS], PAGES)
    chunks = spark.read.parquet(warc.write(table))
    for broken in (chunks.where("chunk_no <> 1"), chunks.withColumn("content", F.when(F.col("chunk_no") == 2, F.concat("content", F.lit(b"x"))).otherwise(F.col("content")))):
        path = warc.workspace(spark, "broken")
        broken.write.parquet(path)
        with pytest.raises(Exception, match="lacks chunk|damaged|does not end"):
            warc.read(spark, path).collect()


def test_whole_test_table_and_empty(spark, folder):
    table = spark.read.parquet(f"{folder}/pages.parquet")
    got = sorted(map(tuple, warc.read(spark, warc.write(table)).collect()), key=str)
    assert got == expected([(r.page_id, r.url, r.html) for r in table.collect()])
    assert warc.read(spark, warc.write(spark.createDataFrame([], PAGES))).collect() == []


def test_ten_thousand_equal_pages(spark):
    rows = [(i, "u", "same page") for i in range(10_000)] + [(20_000, "v", "another"), (None, "w", "same page")]
    table = spark.createDataFrame([(*r, "s", "p") for r in rows], PAGES)
    path = warc.write(table)
    got = {r.page_id: (r.record_type, r.refers_to) for r in warc.read(spark, path).collect()}
    assert len(got) == 10_002 and got[9_999] == got[20_000] == ("response", None)
    assert {v for k, v in got.items() if k not in (9_999, 20_000)} == {("revisit", 9_999)}
    assert spark.read.parquet(path).where(F.col("content").contains(b"same page")).count() == 1
