import zlib
from collections import defaultdict

import numpy as np
from tallyhouse.llm import packing as P
from tallyhouse.llm import tokens


def test_patterns_place_every_piece_once():
    rng = np.random.default_rng(5)
    for lengths, demand in [([64, 128, 1984, 7, 4096], [1000, 300, 77, 500, 9]), (range(1, 64), rng.integers(1, 2000, 63)), ([4000], [3]), ([], [])]:
        lengths, demand = np.array(lengths, dtype=np.int64), np.array(demand, dtype=np.int64)
        made = P.patterns(lengths, demand)
        if not len(lengths):
            assert made == []
            continue
        assert all(n > 0 and (c @ lengths) <= P.SIZE for n, c in made)
        assert (sum(n * c for n, c in made) == demand).all()


def test_knapsack_against_enumeration():
    sizes, values = np.array([3, 5, 7]), np.array([0.31, 0.5, 0.8])
    best = max(a * 0.31 + b * 0.5 + c * 0.8 for a in range(8) for b in range(5) for c in range(4) if 3 * a + 5 * b + 7 * c <= 23)
    value, counts = P.knapsack(sizes, values, 23)
    assert abs(value - best) < 1e-9 and counts @ sizes <= 23


def check(rows, docs_table, most_padding):
    tool = tokens._library(tokens.vocabulary_file("word_bpe_49k.json"))
    want = defaultdict(list)
    for i, t in rows:
        want[i].append(tool.encode(t or "", add_special_tokens=False).ids + [2])
    got = P.pack(docs_table, "word_bpe_49k.json", end_id=2, with_ids=True).collect()
    ids = {}
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in got:
        assert r.ids_crc32 == zlib.crc32(r.ids) and len(r.ids) == 4 * r.length
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    for i, lists in want.items():
        pieces = sorted(by_doc.pop(i), key=lambda r: r.start)
        assert sum(r.length for r in pieces) == sum(map(len, lists))
        if len(lists) == 1:
            assert np.concatenate([np.frombuffer(r.ids, "<u4") for r in pieces]).tolist() == lists[0]
            assert [r.start for r in pieces] == np.cumsum([0, *[r.length for r in pieces]])[:-1].tolist()
            assert {r.doc_tokens for r in pieces} == {len(lists[0])}
    assert not by_doc
    padding = total = 0
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= P.SIZE
        total += at
        padding += 0 if at & (at - 1) == 0 else P.SIZE - at
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    assert padding <= most_padding * total + P.SIZE
    return ids


def test_whole_test_table(spark, folder):
    table = spark.read.parquet(f"{folder}/documents.parquet")
    check([(r.doc_id, r.text) for r in table.collect()], table, 0.01)


def test_edge_rows(spark, docs):
    rows = [(1, None), (2, ""), (3, "word " * 40_000), (4, "a b"), (4, "a b"), (None, "c")]
    check(rows, docs(rows), 1)
    packed = P.pack(docs(rows), "word_bpe_49k.json", end_id=2, with_ids=True)
    assert all(len(r.ids) == 4 * r.n_tokens for r in P.sequences(packed).collect())
    assert P.pack(docs([]), "word_bpe_49k.json", end_id=2).collect() == []
