import random
from collections import Counter

from pyspark.sql import types as T
from llm.reference import lower, words
from tallyhouse.llm import decontamination as D

ITEMS = T.StructType([T.StructField("item_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("k", T.StringType())])


def grams(w, n=5):
    return Counter(tuple(w[i : i + n]) for i in range(len(w) - n + 1))


def brute(text, item):
    """Similarity of the best item-sized window, every start tried."""
    w, v = words(lower(text)), words(lower(item))
    n = min(5, len(v))
    if len(w) < n or not n:
        return 0.0
    want, best = grams(v, n), 0.0
    for start in range(max(1, len(w) - len(v) + 1)):
        got = grams(w[start : start + len(v)], n)
        best = max(best, sum((got & want).values()) / sum((got | want).values()))
    return best


def test_against_all_windows(spark, docs):
    pick = random.Random(6)
    vocabulary = [f"v{i}" for i in range(300)]
    items = [(i, " ".join(pick.choices(vocabulary, k=pick.choice([5, 6, 12, 40, 70])))) for i in range(30)] + [(90, None), (91, "too short"), (92, "")]
    items.append((93, items[3][1]))
    rows = [(1000, None), (1001, ""), (1002, items[2][1]), (1003, items[3][1].upper()), (1004, "x " * 30_000 + items[4][1]), (1004, "x"), (None, items[5][1])]
    for n in range(150):
        passage = pick.choice(items[:30])[1].split()
        for _ in range(pick.randint(0, 1 + len(passage) // 12)):
            at = pick.randrange(len(passage))
            pick.choice([lambda: passage.pop(at) if len(passage) > 1 else None, lambda: passage.insert(at, "new"), lambda: passage.__setitem__(at, "other")])()
        rows.append((n, " ".join(pick.choices(vocabulary, k=pick.randint(0, 60)) + passage + pick.choices(vocabulary, k=pick.randint(0, 60)))))
    benchmark = spark.createDataFrame([(i, t, "k") for i, t in items], ITEMS)
    got = D.overlaps(docs(rows), benchmark).collect()
    assert len(got) == len(rows)
    texts = {i: t for i, t in rows if i != 1004}
    for r in got:
        if r.doc_id == 1004:
            assert r.item_ids in ([], [4])
            continue
        want = sorted(i for i, t in items if brute(texts[r.doc_id], t) >= 0.75)
        assert r.item_ids == want and r.contaminated == bool(want), (r, want)
        for i, s in zip(r.item_ids, r.similarities):
            assert abs(s - brute(texts[r.doc_id], dict(items)[i])) < 1e-12
    assert sum(r.contaminated for r in got) > 60
    kept = D.clean(docs(rows), benchmark)
    assert kept.columns == docs(rows).columns
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect()) == sorted((r.doc_id is None, r.doc_id or 0) for r in got if not r.contaminated)


def index_of(pick, count, vocabulary=2000, sizes=(20, 40, 80)):
    names = [f"v{i}" for i in range(vocabulary)]
    texts = [" ".join(pick.choices(names, k=pick.choice(sizes))) for _ in range(count)]
    return texts, D.Index([(i, D.word_hashes(t.encode())) for i, t in enumerate(texts)])


def test_index_finds_every_fingerprint_within_the_radius():
    pick = random.Random(1)
    _, index = index_of(pick, 200)
    for p in index.prints[:40]:
        mark = p.copy()
        for bit in pick.sample(range(192), pick.randint(0, 70)):
            mark[bit // 32] ^= D.np.uint32(1 << (bit % 32))
        want = [n for n, q in enumerate(index.prints) if int(D.np.bitwise_count(q ^ mark).sum()) <= index.radius]
        assert index.candidates(mark).tolist() == want


def test_index_touches_few_items_and_loses_no_window_at_the_threshold():
    pick = random.Random(9)
    texts, index = index_of(pick, 1500)
    touched = [len(index.touched(p)) / len(index.prints) for p in index.prints[:200]]
    assert sum(touched) / len(touched) < 0.05
    near = lost = 0
    for n, text in enumerate(texts[:400]):
        w = text.split()
        for _ in range(6):
            v = list(w)
            for _ in range(pick.randint(1, 3)):
                v[pick.randrange(len(v))] = "other"
            hashes = D.windows(D.word_hashes(" ".join(v).encode()), 5)
            if 0.75 <= D.weighted_similarity(hashes, index.shingles[n]) < 0.85:
                near += 1
                lost += n not in index.candidates(D.simhash(D._bits(hashes).sum(axis=0)[None, :])[0])
    assert near > 100 and lost <= near // 100


def test_halves_and_sentences_that_trade_places(spark, docs):
    pick = random.Random(12)
    names = [f"v{i}" for i in range(5000)]
    items, rows = [], []
    for i in range(90):
        w = pick.choices(names, k=(40, 80, 120)[i % 3])
        cut = len(w) // (2 if i % 2 else 3)
        items.append((i, " ".join(w), "k"))
        rows.append((i, " ".join(pick.choices(names, k=pick.randint(0, 30)) + w[cut:] + w[:cut] + pick.choices(names, k=pick.randint(0, 30)))))
    got = D.overlaps(docs(rows), spark.createDataFrame(items, ITEMS)).collect()
    for r in got:
        best = brute(dict(rows)[r.doc_id], dict((i, t) for i, t, _ in items)[r.doc_id])
        assert r.item_ids == ([r.doc_id] if best >= 0.75 else []), (r, best)
    assert sum(r.contaminated for r in got) > 80


def test_short_items_are_one_shingle(spark, docs):
    benchmark = spark.createDataFrame([(1, "forty two", "k"), (2, "yes", "k"), (3, " ", "k"), (4, None, "k"), (5, "a b c d", "k")], ITEMS)
    rows = [(1, "the answer is Forty  Two indeed"), (2, "YES"), (3, "a b c"), (4, "x a b c d"), (5, "forty and two"), (6, None)]
    got = D.overlaps(docs(rows), benchmark).orderBy("doc_id").collect()
    assert [(r.item_ids, r.first_words, r.n_words) for r in got] == [([1], [3], [2]), ([2], [0], [1]), ([], [], []), ([5], [1], [4]), ([], [], []), ([], [], [])]


def test_blocks_of_items_and_empty_tables(spark, docs, monkeypatch):
    benchmark = spark.createDataFrame([(i, f"one two three four five six item{i}", "k") for i in range(40)], ITEMS)
    rows = [(1, "one two three four five six item7"), (2, "nothing here at all to see now")]
    want = [r.item_ids for r in D.overlaps(docs(rows), benchmark).orderBy("doc_id").collect()]
    monkeypatch.setattr(D, "BLOCK_BYTES", 300)
    assert [r.item_ids for r in D.overlaps(docs(rows), benchmark).orderBy("doc_id").collect()] == want == [[7], []]
    assert [r.doc_id for r in D.clean(docs(rows), benchmark).collect()] == [2]
    assert D.overlaps(docs([]), benchmark).collect() == []
    assert [r.contaminated for r in D.overlaps(docs(rows), benchmark.limit(0)).collect()] == [False, False]
    assert D.clean(docs(rows), benchmark.limit(0)).count() == 2
