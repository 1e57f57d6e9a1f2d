import math
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F
from llm.reference import lower, words
from tallyhouse.llm import eliasfano as ef
from tallyhouse.llm import language_model as L
from tallyhouse.llm import queries


def test_sequences_find_successors(tmp_path):
    rng = np.random.default_rng(0)
    for n, universe in [(1, 1), (1, 1 << 40), (5, 5), (1000, 1000), (1000, 1 << 20), (3000, 1 << 64), (70, 1 << 63), (0, 100), (500, 700)]:
        values = np.sort(rng.choice(universe, n, replace=False)).astype(np.uint64) if universe < 1 << 30 else np.unique(rng.integers(0, universe - 1, n, dtype=np.uint64, endpoint=True))
        arrays, bits = ef.encode(values, universe)
        ef.save(str(tmp_path / "x"), arrays, {"bits": bits})
        arrays, notes = ef.load(str(tmp_path / "x"))
        s = ef.Sequence(arrays, notes["bits"], len(values))
        assert (s.values(0, len(values)) == values).all()
        asked = np.concatenate([values, values[values > 0] - np.uint64(1), values[values < universe - 1] + np.uint64(1), np.array([0, universe - 1], dtype=np.uint64)])
        index, equal = s.successor(asked)
        assert (index == np.searchsorted(values, asked)).all()
        assert (equal == np.isin(asked, values)).all()


def brute(rows, train):
    """Exact interpolated bigram scores and the contract's base scores."""
    chains = [words(lower(t)) + [None] for _, t in rows]
    seen = [c for c, use in zip(chains, train) if use]
    one, two, after, N = Counter(), Counter(), Counter(), 0
    kinds = {}
    for c in seen:
        N += len(c)
        one.update(c)
        for a, b in zip(["<s>", *c], c):
            two[a, b] += 1
            after[a] += 1
            kinds.setdefault(a, set()).add(b)
    V = len(one)
    out = []
    for c in chains:
        base = made = 0.0
        for a, b in zip(["<s>", *c], c):
            base += math.log10((one[b] + 1) / (N + V + 1))
            alone = (one[b] or max(V, 1)) / max(N + V, 1)
            t = len(kinds.get(a, ()))
            made += math.log10((two[a, b] + t * alone) / (after[a] + t)) if t else math.log10(alone)
        out.append((len(c), sum(one[b] > 0 for b in c), N, base, made))
    return out


def compare(table, rows, train, learn_from):
    got = L.train_and_score(table, learn_from).collect()
    want = sorted(zip([i for i, _ in rows], brute(rows, train)), key=str)
    assert len(got) == len(rows)
    key = lambda r: (r.doc_id, r.n_tokens, round(r.base_score, 6))
    for r, (i, (n, known, N, base, made)) in zip(sorted(got, key=lambda r: str(key(r))), sorted(want, key=lambda x: str((x[0], x[1][0], round(x[1][3], 6))))):
        assert (r.doc_id, r.n_tokens, r.n_known, r.train_tokens) == (i, n, known, N)
        assert abs(r.base_score - base) < 1e-6 * max(1, abs(base))
        assert abs(r.score - made) < 0.04 * math.sqrt(n), (r, made)
    return got


def test_whole_test_table(spark, folder):
    table = spark.read.parquet(f"{folder}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in table.collect()]
    train = [zlib.crc32(str(i).encode()) % 7 != 2 for i, _ in rows]
    got = compare(table, rows, train, queries.remainder("doc_id", 7) != 2)
    held = [r for r, use in zip(sorted(got, key=lambda r: r.doc_id), [t for _, t in sorted(zip([i for i, _ in rows], train))]) if not use]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
    shown = queries.op7_language_model(spark, folder)
    assert set(shown.columns) == {"doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"}


def test_edge_rows(spark, docs):
    rows = [(1, None), (2, ""), (3, "the cat sat " * 20_000), (4, "The  CAT"), (4, "The  CAT"), (None, "new words é"), (6, "a a a"), (7, "É é")]
    compare(docs(rows), rows, [i not in (2, 7) for i, _ in rows], F.coalesce(~F.col("doc_id").isin(2, 7), F.lit(True)))
    assert L.train_and_score(docs([]), F.lit(True)).collect() == []
    compare(docs(rows), rows, [False] * len(rows), F.lit(False))


def test_probabilities_of_a_context_sum_to_one(spark, docs):
    text = "a b a c a b d a b c a"
    model = L.train(docs([(1, text)]))
    levels = L.Levels(model)
    ids = levels.numbers([b"a b c d x"])[0]
    alone = np.log10(levels.unigram(levels.counts(ids)))
    for context in ids[:-1]:  # nothing follows the end
        n = len(ids)
        total = 10 ** levels.follow(2, np.full(n, context if context < model.unknown else -1), ids, alone)[0]
        assert abs(total.sum() - 1) < 0.02


def test_quantised_values():
    few, many = np.log10(np.arange(1, 200) / 200), np.random.default_rng(0).normal(size=5000)
    bins, book = L.quantised(np.tile(few, 3))
    assert (book[bins] == np.tile(few, 3)).all()
    bins, book = L.quantised(many)
    assert len(book) == L.BINS and np.abs(book[bins] - many).max() <= np.ptp(many) / L.BINS


def test_words_are_told_apart():
    texts = [None, b"", b" \t\x0b\x0c\r\n", b"a", b" a  b\x00c ", "É é \x85x\u3000y".encode(), b"A b aB" + b"z" * 300 + b" " + b"z" * 301, b"x" * 100_000]
    texts += [b"a" * n for n in range(1, 40)] + [b"a" * n + b"\x00" for n in range(1, 40)] + [b"abcdefgh" * n + b"A" for n in range(1, 40)]
    hashes, sizes = L.word_hashes(texts)
    plain = [(t or b"").lower().split() for t in texts]
    assert sizes.tolist() == [len(w) for w in plain]
    flat = [w for ws in plain for w in ws]
    assert len(hashes) == len(flat)
    assert len(set(zip(flat, hashes.tolist()))) == len(set(flat)) == len(set(hashes.tolist()))
    alone = [h for t in texts for h in L.word_hashes([t])[0].tolist()]
    assert hashes.tolist() == alone
    assert [len(x) for x in L.word_hashes([])] == [0, 0]


def test_ids_over_many_chunks(spark, docs, monkeypatch):
    rows = [(i, f"the cat {i % 7} sat on the mat {i % 3}" if i % 5 else None) for i in range(300)]
    want = sorted((r.doc_id, r.n_tokens, round(r.score, 9)) for r in L.train_and_score(docs(rows), F.lit(True), order=3).collect())
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    monkeypatch.setattr(L, "CHUNK", 20)  # tasks get the module by reference in this process, a smaller batch in any case
    got = sorted((r.doc_id, r.n_tokens, round(r.score, 9)) for r in L.train_and_score(docs(rows), F.lit(True), order=3).collect())
    assert got == want


def brute_order(rows, train, order):
    """Exact interpolated scores with contexts of up to ``order - 1`` words."""
    chains = [["<s>", *words(lower(t)), None] for _, t in rows]
    seen, after, kinds = Counter(), Counter(), {}
    for c, use in zip(chains, train):
        for i in range(1, len(c) if use else 0):
            for n in range(min(order, i + 1)):
                context = tuple(c[i - n : i])
                seen[context, c[i]] += 1
                after[context] += 1
                kinds.setdefault(context, set()).add(c[i])
    N, V = after[()], len(kinds.get((), ()))
    out = []
    for c in chains:
        made = 0.0
        for i in range(1, len(c)):
            p = (seen[(), c[i]] or max(V, 1)) / max(N + V, 1)
            for n in range(1, min(order, i + 1)):
                context = tuple(c[i - n : i])
                t = len(kinds.get(context, ()))
                p = (seen[context, c[i]] + t * p) / (after[context] + t) if t else p
            made += math.log10(p)
        out.append((len(c) - 1, made))
    return out


def test_longer_contexts(spark, docs):
    rows = [(1, None), (2, ""), (3, "the cat sat on the mat " * 3_000), (4, "the dog sat under the tree"), (4, "the dog sat under the tree"), (None, "the cat sat under new é"),
            (6, "a a a a b"), (7, "the dog sat on the tree a a b"), (8, "dog sat"), (9, "b a a b the cat")]
    train = [i not in (2, 7, 9) for i, _ in rows]
    learn_from = F.coalesce(~F.col("doc_id").isin(2, 7, 9), F.lit(True))
    for order in (2, 3, 4):
        for use, where in ((train, learn_from), ([False] * len(rows), F.lit(False))):
            got = sorted((str(r.doc_id), r.n_tokens, r.score) for r in L.train_and_score(docs(rows), where, order=order).collect())
            want = sorted((str(i), n, made) for (i, _), (n, made) in zip(rows, brute_order(rows, use, order)))
            for (i, n, score), (j, m, made) in zip(got, want, strict=True):
                assert (i, n) == (j, m) and abs(score - made) < 0.04 * math.sqrt(n), (order, i, score, made)


def test_query_uses_two_preceding_words(spark, folder):
    table = spark.read.parquet(f"{folder}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in table.collect()]
    train = [zlib.crc32(str(i).encode()) % 7 != 2 for i, _ in rows]
    got = queries.op7_language_model(spark, folder).collect()
    want = sorted((i, n, made) for (i, _), (n, made) in zip(rows, brute_order(rows, train, 3)))
    for r, (i, n, made) in zip(sorted(got, key=lambda r: (r.doc_id, r.n_tokens, r.score)), want, strict=True):
        assert (r.doc_id, r.n_tokens) == (i, n) and abs(r.score - made) < 0.04 * math.sqrt(n), (r, made)
    two = L.train_and_score(table, queries.remainder("doc_id", 7) != 2).collect()
    held = {r.doc_id for r in got if r.held_out}
    assert held and sum(r.score for r in got if r.held_out) > sum(r.score for r in two if r.doc_id in held)
