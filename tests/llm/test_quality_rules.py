from llm.reference import measures
from tallyhouse.llm import quality_rules as Q

TEXTS = [None, "", " \n\t ", "one", "a b c d e a b c d e", "a a a a a a a a a a a a", "x\nx\n \n \ny\nx", "w1 w2 w3 w4 w5 w6 w7 w8 w9 w10 w11",
         "# * $ % & | < > é é é é é é é é é é é é é é é é", "über  straße\x0bfoo\x0cbar\rbaz\x1c ", " lead trail ", "1 2 3 4 5 6 1 2 3 4 5 9 8 7 1 2 3 4 5 6 " * 9,
         "漢字 😀 " * 4000, "q" * 50_000]


def test_measures_match_a_plain_count(spark, docs):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(3, "one"), (None, "one")]
    got = Q.features(docs(rows)).collect()
    assert len(got) == len(rows)
    for r in got:
        want = measures("one" if r.doc_id is None else TEXTS[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want, r


def test_whole_test_table(spark, folder):
    table = spark.read.parquet(f"{folder}/documents.parquet")
    texts = {r.doc_id: r.text for r in table.collect()}
    for r in Q.judge(table).collect():
        want = measures(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 10 or 100 * want[4] > 20 * want[0])
        assert not (r.base_failed and r.kept)


def test_kept_rows_are_those_judged_so_in_any_order(spark, docs):
    rows = docs([(i, t) for i, t in enumerate(TEXTS)])
    judged = {r.doc_id for r in Q.judge(rows).collect() if r.kept}
    kept = Q.keep(rows)
    assert kept.columns == rows.columns
    assert {r.doc_id for r in kept.collect()} == judged == {7}


def test_empty_table(spark, docs):
    assert Q.judge(docs([])).collect() == []
    assert Q.keep(docs([])).collect() == []


def test_cheap_rejecting_rule_comes_first(spark, docs):
    from pyspark.sql import functions as F

    rows = docs([(i, "word " * 200) for i in range(500)]).select("doc_id", F.col("text").alias("t"))
    slow = F.aggregate(F.transform(F.sequence(F.lit(1), F.lit(3000)), lambda x: F.xxhash64(x, "t")), F.lit(0).cast("long"), lambda a, x: a.bitwiseXOR(x)) == 5
    rules = [Q.Rule("slow", slow), Q.Rule("never", F.col("t") == "zzz"), Q.Rule("fast", F.col("doc_id") >= 0)]
    assert Q.order_rules(rows, rules, "doc_id")[0].name == "fast"
