import hashlib
import random
from collections import defaultdict

import duckdb
from pyspark.sql import types as T
from tallyhouse.llm import chat, queries

SHAPE = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()),
                      T.StructField("text", T.StringType()), T.StructField("conv_key", T.StringType()), T.StructField("formatted", T.StringType())])
PARTS = ["\\", "#", "<", ":", "###", "</turn>", " </turn>\n", "\n", "\\b", "\\l", "é", "漢", "### assistant: ", "", "ok", "😀"]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def expected(rows):
    by = defaultdict(list)
    for c, n, r, x in rows:
        by[c].append((n is not None, n or 0, r or "", x or ""))
    out = {}
    for c, turns in by.items():
        turns.sort()
        loss = "".join(x for _, _, r, x in turns if r == "assistant")
        out[c] = (len(turns), sha("".join(f"{r}\n{x}\n" for _, _, r, x in turns)), len(loss), sha(loss))
    return out


def test_hostile_texts_come_back(spark):
    pick = random.Random(3)
    rows = [(pick.choice([1, 2, 3, None, -7]), pick.choice([None, 0, 1, 2, 3]), pick.choice(["user", "assistant", None, "a: b#<\\", ""]),
             pick.choice([None, "".join(pick.choices(PARTS, k=pick.randint(0, 9)))])) for _ in range(200)]
    rows += [(8, 0, "user", "alone"), (9, 1, "assistant", "x" * 300_000), (9, 1, "assistant", "x" * 300_000)]
    files = chat.write(spark.createDataFrame([(*r, "k", "f") for r in rows], SHAPE))
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in chat.digest(spark, files).collect()}
    assert got == expected(rows)
    full = chat.materialise(spark, files).collect()
    assert len(full) == sum(r[2] == "assistant" for r in rows)
    whole = {r.conv_key: r.formatted for r in chat.conversations(spark, files).collect()}
    for r in full:
        assert whole[r.conv_key].startswith(r.example)
        assert r.example.count(chat.CLOSE) == r.context_turns + 1
        assert r.example[r.loss_end :] == chat.CLOSE and "<" not in r.example[r.loss_start : r.loss_end]


def test_empty_table(spark):
    files = chat.write(spark.createDataFrame([], SHAPE))
    assert chat.digest(spark, files).collect() == [] and chat.materialise(spark, files).collect() == []


def test_query_equals_sql(spark, folder):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{folder}/conversations.parquet')")
    got = queries.op6_chat_examples(spark, folder)
    want = con.sql(queries.SQL["op6_chat_examples"])
    assert sorted(map(tuple, got.select(*want.columns).collect())) == sorted(want.fetchall())


def test_digest_reads_text_under_the_mask(spark):
    rows = [(1, 0, "user", "é#: hi"), (1, 1, "assistant", "漢<b\\"), (1, 2, "user", "more 😀"), (1, 3, "assistant", "last"), (None, 0, "assistant", ""), (2, 0, "user", "alone")]
    files = chat.write(spark.createDataFrame([(*r, "k", "f") for r in rows], SHAPE))
    kept = spark.read.parquet(files.examples)
    assert set(kept.columns) == {"conv_key", "context_turns", "loss_start", "loss_end"}
    whole = {r.conv_key: r.formatted.encode() for r in chat.conversations(spark, files).collect()}
    cut = {(r.conv_key, r.context_turns): whole[r.conv_key][r.loss_start : r.loss_end].decode() for r in kept.collect()}
    assert cut == {(1, 1): "漢\\lb\\b", (1, 3): "last", (None, 0): ""}
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in chat.digest(spark, files).collect()}
    assert got == expected(rows)
    # a mask that is one byte short must show in the digest
    moved = chat.ChatFiles(files.conversations, files.examples + "-moved")
    kept.selectExpr("conv_key", "context_turns", "loss_start", "greatest(loss_start, loss_end - 1) AS loss_end").write.parquet(moved.examples)
    assert {r.conv_id: r.loss_chars for r in chat.digest(spark, moved).collect()} != {k: v[2] for k, v in got.items()}
