import random

import numpy as np
from llm.reference import components, shingles
from tallyhouse.llm import jaccard as J
from tallyhouse.llm.components import components as connected


def test_similar_sets_share_a_signature():
    """All pairs of random sets at and above the threshold, with many common elements called frequent."""
    rng = np.random.default_rng(2)
    for trial in range(400):
        size = int(rng.choice([1, 2, 3, 4, 5, 7, 12, 30, 90, 300]))
        base = rng.integers(0, 1 << 63, size, dtype=np.uint64) * np.uint64(2)
        drop, add = rng.integers(0, size // 7 + 2), rng.integers(0, size // 7 + 2)
        other = np.r_[base[drop:], rng.integers(0, 1 << 63, add, dtype=np.uint64)]
        frequent = np.sort(base[: int(rng.integers(0, size + 1))]) if trial % 2 else base[:0]
        a, b = np.unique(base), np.unique(other)
        both = len(np.intersect1d(a, b))
        if len(b) and 4 * both >= 3 * (len(a) + len(b) - both):
            (p, c), (q, d) = J.signatures(a, frequent, 0.75), J.signatures(b, frequent, 0.75)
            assert len(np.intersect1d(p, q))
            # in some band and scheme both sets meet what either that stops there promises
            slots = [(s, np.isin(q[d & 255 == s], p[c & 255 == s]).sum(), max(c[c & 255 == s] >> 8), max(d[d & 255 == s] >> 8)) for s in np.intersect1d(c & 255, d & 255)]
            assert any(shared >= max(x, y) for _, shared, x, y in slots)


def test_components_of_edges(spark):
    pick = random.Random(4)
    edges = [(i, i + 1) for i in range(60)] + [(pick.randint(100, 300), pick.randint(100, 300)) for _ in range(150)] + [(500, i) for i in range(501, 560)] + [(7, 7)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    got = {r.node: r.root for r in connected(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: root(x) for x in parent}


def made_rows():
    pick = random.Random(9)
    words = [f"w{i}" for i in range(400)]
    rows, n = [], 0
    passage = pick.choices(words, k=60)
    for group in range(40):
        text = pick.choices(words, k=pick.choice([1, 3, 5, 6, 8, 12, 40, 150]))
        if group % 3 == 0:
            text = passage + text
        for _ in range(pick.choice([1, 1, 2, 5, 12])):
            copy = list(text)
            for _ in range(pick.randint(0, 1 + len(copy) // 35)):
                copy[pick.randrange(len(copy))] = pick.choice(words)
            rows.append((1000 - n, " ".join(copy).upper() if n % 2 else "\n".join(copy)))
            n += 1
    # a chain whose ends are far apart
    chain = pick.choices(words, k=80)
    for i in range(8):
        chain[i * 8] = f"new{i}"
        rows.append((2000 + i, " ".join(chain)))
    return rows


def test_against_all_pairs(spark, docs):
    rows = made_rows() + [(1, None), (2, ""), (3, " \n"), (4, "a b c"), (5, "A  b\tc"), (6, "long text " * 20_000), (7, "long text " * 20_001), (8, "é é"), (9, "É é")]
    want = components(rows)
    assert len({c for _, c in want.values()}) < len(rows) - 30
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in J.similar_components(docs(rows)).collect()}
    assert got == want
    kept = J.one_of_each(docs(rows))
    assert kept.columns == docs(rows).columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, (_, c) in want.items() if i == c)


def test_repeated_rows_keys_and_empty_tables(spark, docs):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (1, "other words here"), (2, "other words here"), (None, "a b c d e f"), (None, "solo")]
    got = sorted((r.doc_id or 0, r.n_shingles, r.component_id or 0) for r in J.similar_components(docs(rows)).collect())
    assert got == [(0, 1, 0), (0, 2, 1), (1, 1, 1), (1, 2, 1), (1, 2, 1), (2, 1, 1)]
    assert J.similar_components(docs([])).collect() == []
    assert J.similar_components(docs([(1, None)])).collect() == [(1, 0, 1)]


def test_whole_test_table(spark, folder):
    table = spark.read.parquet(f"{folder}/documents.parquet")
    want = components([(r.doc_id, r.text) for r in table.collect()])
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in J.similar_components(table).collect()} == want
    assert shingles(None) == frozenset()


def test_copies_are_dealt_out(spark, docs):
    made = J._signed(docs([(i, "one text that all the rows have") for i in range(-150, 150)] + [(None, "other words")]), "doc_id", "text", 0.75).where("digest is not null")
    assert made.count() == 301
    files = [r["count"] for r in made.selectExpr("input_file_name() AS f").groupBy("f").count().collect()]
    assert len(files) > 1 and max(files) < 250


def test_subsets_and_parities():
    """Every two of three parts make a signature, and sets differ in at least as many elements as parity bits."""
    assert J._subsets(1, 3).T.tolist() == [[1, 1, 0], [1, 0, 1], [0, 1, 1]]
    rng = np.random.default_rng(5)
    for size in (0, 1, 40, 400):
        a = np.unique(rng.integers(0, 1 << 63, size, dtype=np.uint64))
        b = np.unique(np.r_[a[size // 5 :], rng.integers(0, 1 << 63, size // 4, dtype=np.uint64)])
        bits = int.from_bytes(J._parities(a), "big") ^ int.from_bytes(J._parities(b), "big")
        assert bits.bit_count() <= len(np.setxor1d(a, b))
    whole = np.sort(rng.integers(0, 1 << 63, 200, dtype=np.uint64))
    other = np.delete(whole, [3, 50, 120])
    (p, c), (q, _) = J.signatures(whole, whole[:0], 0.75), J.signatures(other, whole[:0], 0.75)
    assert len(p) > 100 and len(np.intersect1d(p, q)) >= max(c >> 8)


def test_groups_differ_in_their_members(spark, docs):
    """Two sets that share many signatures, and only with each other, meet in one group of a band and scheme."""
    pick = random.Random(5)
    text = [f"w{pick.randrange(5000)}" for _ in range(300)]
    rows = [(1, " ".join(text)), (2, " ".join(text[2:])), (3, " ".join(text[:-2])), (4, "some other words that stand alone here")]
    shared = J._signed(docs(rows), "doc_id", "text", 0.75).where("sig is not null")
    groups = {}
    for r in J._worth_a_look(shared).collect():
        groups.setdefault(r.sig, []).append(r.id)
    assert all(len(ids) == len(set(ids)) > 1 for ids in groups.values())
    assert len({i for ids in groups.values() for i in ids}) == 3
    # four lists of two or three sets, in two bands of at most four schemes
    assert len(groups) <= 4 * 2 * 4 < shared.select("id", "sig", "size").count() / 3


def test_frequent_is_a_number_of_documents(spark):
    """600 of 90,000 documents share a passage: a share below 1/250, but more than a group should hold."""
    passage = " ".join(f"p{i}" for i in range(20))
    rows = spark.range(90_000).selectExpr(f"cast(if(id % 150 = 0, concat('{passage} n', id), concat('one t', id, ' u', id, ' v', id, ' x', id)) as binary) AS t")
    found = set(J._frequent(rows).tolist())
    assert set(J.shingle_set(passage.encode()).tolist()) == found


def test_pairs_of_groups(spark):
    """Pairs of one group, different components and near enough sizes and parities, over more rows than are paired at a time."""
    pick = random.Random(8)
    sets = [(i.to_bytes(16, "big"), pick.randrange(40), pick.choice([40, 44, 90]), [pick.getrandbits(6) for _ in range(4)]) for i in range(300)]
    rows, want = [], set()
    for sig in range(30_000):
        group = pick.sample(sets, 3 if sig else 200)
        rows += [(sig % 7, sig, d, r, n, *bits) for d, r, n, bits in group]
        for d, r, n, bits in group:
            for e, q, m, other in group:
                least = max(sum((x ^ y).bit_count() for x, y in zip(bits, other)), abs(n - m))
                if d > e and r != q and 7 * least <= n + m:
                    want.add((d, e))
    assert len(rows) > J.PAIRED
    made = J._paired(spark.createDataFrame(rows, "lo long, sig long, digest binary, r long, n long, p0 long, p1 long, p2 long, p3 long"), 0.75)
    got = [(bytes(r.a), bytes(r.b)) for r in made.collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_sketches_bound_differences():
    rng = np.random.default_rng(6)
    for size in (1, 60, 128, 129, 700, 50_000):
        a = np.unique(rng.integers(0, 1 << 63, size, dtype=np.uint64))
        b = np.unique(np.r_[a[size // 3 :], rng.integers(0, 1 << 63, size // 2, dtype=np.uint64)])
        x, y = J._sketch(a), J._sketch(b)
        assert J._differ(x, y) == J._differ(y, x) <= len(np.setxor1d(a, b))
        assert J._differ(x, x) == 0
    # a family at a similarity of 0.6 is told apart, which 256 bits do not
    a = rng.integers(0, 1 << 63, 400, dtype=np.uint64)
    b = np.r_[a[100:], rng.integers(0, 1 << 63, 100, dtype=np.uint64)]
    assert 7 * J._differ(J._sketch(a), J._sketch(b)) > 800


def test_pairs_of_a_family_grow_with_its_sets(spark, docs, monkeypatch):
    """40 texts at a similarity of some 0.6 to each other, and near copies of each: pairs are made of what sketches leave, and of it
    the nearest first. Made of what 256 bits of parities leave, they were 7,133."""
    pick = random.Random(12)
    base, rows, made = [f"w{pick.randrange(50_000)}" for _ in range(700)], [], []
    for i in range(40):
        text = list(base)
        at = pick.randrange(500)
        text[at : at + 170] = [f"v{i}_{j}" for j in range(170)]
        for j in range(3):
            text[pick.randrange(700)] = f"x{i}_{j}"
            rows.append((100 * i + j, " ".join(text)))
    keep = J.stage

    def counted(df, label, codec=None):
        out = keep(df, label, codec)
        if label in ("tried-pairs", "more-pairs"):
            made.append(out.count())
        return out

    monkeypatch.setattr(J, "stage", counted)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in J.similar_components(docs(rows)).collect()}
    assert got == components(rows) and len({c for _, c in got.values()}) == 40
    assert sum(made) < 2 * len(rows)


def test_blocks_of_a_family(spark, monkeypatch):
    """Sets of many blocks: each two meet once, in whichever blocks they are; the nearest are one pair a component at most."""
    monkeypatch.setattr(J, "BLOCK", 16)
    pick = random.Random(3)
    sets = [(i.to_bytes(16, "big"), pick.randrange(30), 40, [pick.getrandbits(4) for _ in range(4)]) for i in range(150)]
    rows = spark.createDataFrame([(5, 9, d, r, n, *bits) for d, r, n, bits in sets], "lo long, sig long, digest binary, r long, n long, p0 long, p1 long, p2 long, p3 long")
    want = {}
    for d, r, n, bits in sets:
        for e, q, m, other in sets:
            least = sum((x ^ y).bit_count() for x, y in zip(bits, other))
            if d > e and r != q and 7 * least <= n + m:
                want[d, e] = (least, r, q)
    got = [(bytes(x.a), bytes(x.b)) for x in J._paired(rows, 0.75).collect()]
    assert len(got) == len(set(got)) and set(got) == set(want)
    near = {(bytes(x.a), bytes(x.b)) for x in J._paired(rows, 0.75, nearest=True).collect()}
    assert near <= set(want) and len(near) <= 30
    for c in range(30):
        own = [x for x, (_, r, q) in want.items() if c in (r, q)]
        assert any(want[x][0] == min(want[y][0] for y in own) for x in near & set(own)) or not own
