import hashlib
import random
import zlib

import numpy as np
from tallyhouse.llm import runs
from tests.llm.reference import words


def brute(w, least=6, exponent=4):
    """Every run by trying every period at every place."""
    out = []
    for q in range(1, len(w) // exponent + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            n = j + q - i
            if j > i and n >= max(least, exponent * q) and not any(all(w[x] == w[x + p] for x in range(i, i + n - p)) for p in range(1, q)):
                out.append((i, n, q))
            i = max(j, i) + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def plant(key, w):
    h = zlib.crc32(str("" if key is None else key).encode())
    n, g = len(w), h // 10
    if h % 10 or not n:
        return w
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]


def expected(key, text):
    w = plant(key, words(text))
    found = brute(w)
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    best = min(found, key=lambda r: (-r[1] / r[2], r[0], r[2])) if found else (None,) * 3
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (key, len(found), *best, 1000 * best[1] // best[2] if found else None, sha("".join(f"{s},{n},{q}\n" for s, n, q in found)), sha(" ".join(x for i, x in enumerate(w) if i not in gone)))


def test_runs_equal_brute_force(monkeypatch):
    rng = random.Random(5)
    for _ in range(150):
        texts = []
        for _ in range(rng.randint(1, 10)):
            n, names = rng.randint(0, 90), rng.choice([1, 2, 2, 3, 20])
            w = [b"%d" % rng.randrange(names) for _ in range(n)]
            if n and rng.random() < 0.6:
                s = rng.randrange(n)
                w = w[:s] + (w[s : s + 1 + (n - s) // rng.randint(3, 10)] * n)[: n - s]
            texts.append(w)
        monkeypatch.setattr(runs, "CHUNK", rng.choice([1, 7, 50, 1 << 16]))
        assert runs.runs_of(texts) == [brute(w) for w in texts]


def test_words_appended_one_by_one_complete_the_same_squares():
    rng = np.random.default_rng(1)
    words = rng.integers(0, 2, 200).astype(np.uint64)
    whole, single = runs.Catchers(200, 200), runs.Catchers(200, 200)
    assert whole.append(words) == sum(single.append(words[i : i + 1]) for i in range(200)) > 0
    assert whole.runs().tolist() == single.runs().tolist()


def test_long_periodic_texts_take_little_time():
    thue_morse = [b"%d" % (bin(i).count("1") % 2) for i in range(60_000)]
    assert runs.runs_of([[b"a"] * 300_000, thue_morse, [b"%d" % (i % 1000) for i in range(9_000)]]) == [[(0, 300_000, 1)], [], [(0, 9_000, 1000)]]


def test_rows_of_odd_documents(spark, docs):
    rng = random.Random(7)
    rows = [(None, "a a a a a a a"), (None, None), (1, None), (2, ""), (3, " \n\t"), (4, "x y " * 9 + "z"), (4, "x y " * 9 + "z"), (5, "é è b " * 6)]
    rows += [(i, " ".join(rng.choice("abcdefgh") * rng.randint(1, 2) for _ in range(rng.randint(0, 120)))) for i in range(10, 250)]
    found = runs.find_runs(docs(rows), plant=True)
    assert found.columns == ["doc_id", "runs", "collapsed"]
    got = runs.digest(found)
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    order = lambda r: tuple((v is not None, v) for v in r)
    assert sorted(map(tuple, got.collect()), key=order) == sorted((expected(k, t) for k, t in rows), key=order)
    assert runs.find_runs(docs([])).count() == 0
    assert sum(r.n_runs for r in got.collect()) > 10
