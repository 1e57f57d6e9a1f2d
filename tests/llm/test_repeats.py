import random

import numpy as np
import pytest
from tallyhouse.llm import induced, repeats


def brute(rows, length=50):
    """(key, kept, spans) by a table of every string of ``length`` bytes."""
    least, key = {}, lambda k: (k is None, k or 0)
    for k, t in rows:
        b = (t or "").encode()
        for i in range(len(b) - length + 1):
            w = b[i : i + length]
            least[w] = min(least.get(w, key(k)), key(k))
    out = []
    for k, t in rows:
        b = (t or "").encode()
        gone = np.zeros(len(b) + 1, dtype=bool)
        for i in range(len(b) - length + 1):
            if least[b[i : i + length]] < key(k):
                gone[i : i + length] = True
        edge = np.flatnonzero(np.diff(gone.astype(int), prepend=0))
        out.append((k, len(b), tuple((int(s), int(e - s)) for s, e in zip(edge[::2], edge[1::2])), bytes(x for x, g in zip(b, gone) if not g)))
    return out


def check(frame, rows, **options):
    got = repeats.remove_repeats(frame, **options)
    assert got.columns == ["doc_id", "n_bytes", "spans", "kept"]
    order = lambda r: tuple((v is not None, v) for v in r)
    made = [(r[0], r[1], tuple(map(tuple, r[2])), bytes(r[3])) for r in got.collect()]
    want = brute(rows)
    assert sorted(made, key=order) == sorted(want, key=order)
    return sum(len(r[2]) for r in want)


def corpus(rng, n, letters="abcdefgh \n"):
    passages = ["".join(rng.choice(letters) for _ in range(rng.choice([30, 49, 50, 51, 75, 120, 400]))) for _ in range(12)]
    rows = []
    for i in rng.sample(range(-n, 3 * n), n):
        parts = [rng.choice(passages) if rng.random() < 0.4 else "".join(rng.choice(letters) for _ in range(rng.randint(0, 150))) for _ in range(rng.randint(0, 6))]
        rows.append((i, "".join(parts)))
    for i in range(n // 5):  # near copies
        k, t = rng.choice(rows)
        at = rng.randint(0, len(t))
        rows.append((5 * n + i, t[:at] + "X" + t[at + 1 :]))
    return rows


def test_kept_bytes_equal_brute_force(spark, docs):
    rng = random.Random(2)
    rows = corpus(rng, 150) + [(None, None), (None, ""), (9_001, None), (9_002, ""), (9_003, "é" * 40), (9_004, "xé" + "é" * 40), (None, "é" * 40), (9_003, "é" * 40)]
    rows += [(9_100 + i, "a" * (45 + i)) for i in range(10)] + [(9_200, "\0" * 60 + "b" * 60), (9_201, "b" * 60 + "\0" * 60), (9_202, "ab" * 100), (9_203, "ba" * 70)]
    assert check(docs(rows), rows) > 100


def test_small_blocks_shards_and_spilled_queues(spark, docs, monkeypatch):
    monkeypatch.setattr(repeats, "BLOCK_BYTES", 1500)
    monkeypatch.setattr(repeats, "SHARD_BYTES", 4000)
    rng = random.Random(4)
    rows = corpus(rng, 120)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    assert check(docs(rows).repartition(5), rows, memory=64) > 80


def test_hot_line_is_split_and_whole(spark, docs, monkeypatch):
    monkeypatch.setattr(repeats, "SHARD_BYTES", 3000)
    monkeypatch.setattr(repeats, "HOT", 20)
    rng = random.Random(6)
    line = "this very common line stands nearly everywhere in it"
    rows = [(i, f"{rng.random()} {line} {rng.random()}") for i in range(200)] + [(i, "one text with a third of all rows " * 4) for i in range(200, 300)]
    assert check(docs(rows).repartition(3), rows) >= 298


@pytest.mark.parametrize("rows", [[], [(1, None)], [(2, "x" * 49), (1, "x" * 49)]])
def test_nothing_to_remove(spark, docs, rows):
    assert check(docs(rows), rows) == 0


def test_windows_have_one_sample_each(monkeypatch):
    rng = random.Random(8)
    for _ in range(40):
        monkeypatch.setattr(repeats, "CHUNK_BYTES", rng.choice([37, 100, 1000, 1 << 20]))
        sizes = [rng.choice([0, 3, 49, 50, 51, 60, 200, 500]) for _ in range(rng.randint(1, 8))]
        text, ends = np.array([rng.choice(b"abcd\0") for _ in range(sum(sizes))], dtype=np.uint8), np.cumsum(sizes)
        at, low, high, _ = repeats.samples(text, ends)
        assert sorted(a - d for a, x, y in zip(at, low, high) for d in range(x, y + 1)) == [s for e, n in zip(ends, sizes) for s in range(e - n, e - 49)]


def test_queue_keeps_order_when_it_spills(tmp_path):
    rng = random.Random(3)
    for _ in range(60):
        queue, pushed = induced.Queue(str(tmp_path), memory=rng.choice([5, 50, 10_000])), []
        for _ in range(rng.randint(0, 12)):
            rows = np.zeros(rng.randint(0, 30), dtype=induced.SUFFIX)
            rows["key"] = [rng.choice([1, 2, 3, 1 << 60]) for _ in rows]
            rows["rank"] = np.arange(len(pushed), len(pushed) + len(rows))
            pushed += [(int(r["key"]), int(r["rank"])) for r in rows]
            queue.push(rows)
        assert [(int(r["key"]), int(r["rank"])) for block in queue.drain() for r in block] == sorted(pushed)
    with pytest.raises(ValueError, match="larger than memory"):
        queue = induced.Queue(None, memory=1)
        queue.push(np.zeros(2, dtype=induced.SUFFIX))
