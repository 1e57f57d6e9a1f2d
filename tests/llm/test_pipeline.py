from collections import Counter, defaultdict

import corpus_pipeline as C
from llm.reference import components, measures, shingles, words
from tallyhouse.llm import toxicity
from tallyhouse.llm.base import remainder, stage, table
from llm.test_decontamination import brute


def quality(text):
    n, chars, symbols, repeated_lines, repeated = measures(text)
    lines = sum(bool(words(x)) for x in (text or "").split("\n"))
    return not (n < 10 or 100 * repeated > 20 * n or 2 * symbols > n or 10 * repeated_lines > 3 * max(1, lines) or chars < 2 * n or chars > 20 * n)


def test_stages_against_brute_force(spark, folder):
    docs = table(spark, folder, "documents")
    columns, before = docs.columns, {r.doc_id: r.text for r in docs.collect()}
    items = {r.item_id: r.text for r in table(spark, folder, "benchmark").collect()}
    for name, function in C.STAGES[:-1]:
        docs = stage(function(spark, docs, folder), "t")
        assert docs.columns == columns
        after = {r.doc_id: r.text for r in docs.collect()}
        assert after.items() <= before.items()
        if name == "toxicity":
            model = toxicity.fit(table(spark, folder, "documents"), table(spark, folder, "labels"), remainder("doc_id", 5) != 0)
            scorer = toxicity.Scorer(model)
            want = {i for i, t in before.items() if scorer.score(t) < 0.5}
        elif name == "quality_rules":
            want = {i for i, t in before.items() if quality(t)}
        elif name == "jaccard":
            want = {i for i, (_, c) in components(list(before.items())).items() if i == c}
        else:
            known = set().union(*(shingles(t) for t in items.values()))
            hit = {i for i, t in before.items() if shingles(t) & known}
            want = {i for i, t in before.items() if i not in hit or all(brute(t, x) < 0.75 for x in items.values())}
        assert set(after) == want, name
        before = after
    pieces = C.STAGES[-1][1](spark, docs, folder).collect()
    assert {r.doc_id for r in pieces} == set(before)
    totals = {r.doc_id: r.doc_tokens for r in pieces}
    placed, filled = Counter(), defaultdict(int)
    for r in pieces:
        placed[r.doc_id] += r.length
        filled[r.sequence_id] += r.length
    assert placed == totals and max(filled.values()) <= 4096


def test_run_gives_the_last_stage(spark, folder):
    assert {"doc_id", "start", "length", "sequence_id", "offset"} <= set(C.run(spark, folder).columns)


def test_empty_and_hostile_rows(spark, docs):
    columns = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(1, None), (2, ""), (3, "ok " * 40_000), (4, "one two three four five six seven eight nine ten"), (4, "one two three four five six seven eight nine ten"), (None, "no key here but many words to pass the rule of ten words")]
    for some in ([], rows):
        now = spark.createDataFrame([(i, t, None, None, None) for i, t in some], columns)
        for _, function in C.STAGES:
            now = stage(function(spark, now, "/root/testdata/sf0.001"), "t")
        assert sorted({str(r.doc_id) for r in now.collect()}) == (["4", "None"] if some else [])


def test_a_worker_keeps_the_caches_of_one_operator_only():
    from tallyhouse.llm import decontamination, jaccard, token_counts, tokens, toxicity

    path = tokens.vocabulary_file("word_bpe_49k.json")
    tokens.encoder(path)(["some words"])
    scorer = toxicity._scorer(toxicity.Model({"badword": False}))
    scorer.score("a text of words")
    assert toxicity._scorer(scorer.model) is scorer and scorer.seen and not tokens._ENCODERS
    jaccard.shingle_set(b"one two three four five six")
    assert jaccard._words and not toxicity._SCORERS
    decontamination.word_hashes(b"one two three")
    assert decontamination._words and not jaccard._words
    token_counts.counter(path)(["some words"])
    assert token_counts._COUNTERS and not decontamination._words
    assert len(tokens.encoder(path)(["some words"])) == 1 and not token_counts._COUNTERS
