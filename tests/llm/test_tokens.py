import random
import time
import zlib

import numpy as np
import pytest
from tallyhouse.llm import id_files, token_counts, tokens

PARTS = [" ", "  ", "\n", "\x1c", "\x85", " ", "'s", "'", "<|endoftext|>", "<|", "a", "aa", "aaaa", "Foo", "bar,", "é", "İ", "œuvre", "漢字", "12", "½", "_", "é", "😀", "Σ", "the", "..", "|", "don't", "\t", "　", "x\ny"]
MIXED = ["".join(random.Random(i).choices(PARTS, k=i % 15)) for i in range(3000)]


@pytest.mark.parametrize("file", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_ids_and_counts_equal_the_library(file):
    path = tokens.vocabulary_file(file)
    want = [x.ids for x in tokens._library(path).encode_batch(MIXED, add_special_tokens=False)]
    for _ in range(2):  # the second time from kept pieces
        assert [np.frombuffer(x, "<u2").tolist() for x in tokens.encoder(path)(MIXED)] == want
        assert token_counts.counter(path)(MIXED) == [len(x) for x in want]


def test_long_words_take_seconds_and_equal_the_library():
    path = tokens.vocabulary_file("word_bpe_49k.json")
    tool, count = tokens._library(path), token_counts.Merger(path)
    rng = random.Random(3)
    plain = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=n)) for n in (1, 2, 511, 512, 513, 700, 20_000)]
    plain += ["a" * n for n in (511, 512, 513, 4001)] + ["the" * 500, "aab" * 700 + "a", "".join(rng.choices(["ing", "the", "er", "aa"], k=3000))]
    want = [len(tool.encode(w, add_special_tokens=False).ids) for w in plain]
    assert count.counts([w.encode() for w in plain]).tolist() == want
    assert count._long([w.encode() for w in plain]).tolist() == want  # at any length
    huge = "".join(rng.choices("etaoinshrdlu", k=1_000_000))
    start = time.perf_counter()
    assert token_counts.counter(path)([huge]) == [len(tool.encode(huge, add_special_tokens=False).ids)]
    assert time.perf_counter() - start < 60


def test_kept_pieces_stay_bounded():
    made = tokens.Pieces(lambda c: [len(x) for x in c], sum, len, False, limit=100)
    texts = [f"{i}a {i}b {i}" for i in range(1000)]
    for i in range(0, 1000, 10):
        assert made(texts[i : i + 10]) == [len(t.replace(" ", "")) for t in texts[i : i + 10]]
    assert len(made.rest) <= 140


ROWS = [(5, "b b"), (2, None), (2, None), (9, "long " * 30_000), (None, "no key"), (1, ""), (7, "a<|endoftext|>b")]


def test_counts_table(spark, docs):
    tool = tokens._library(tokens.vocabulary_file("word_bpe_49k.json"))
    got = {(r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in token_counts.count_tokens(docs(ROWS), "word_bpe_49k.json").collect()}
    want = set()
    for i, t in ROWS:
        n = len(tool.encode(t or "", add_special_tokens=False).ids)
        want.add((i, len((t or "").encode()), n, n > 2048))
    assert got == want
    assert token_counts.count_tokens(docs([]), "word_bpe_49k.json").collect() == []


def _check_files(spark, table, rows):
    tool = tokens._library(tokens.vocabulary_file("byte_bpe_50k.json"))
    files = id_files.write(table, "byte_bpe_50k.json", end_id=2)
    got = sorted(id_files.read(spark, files, with_ids=True).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == sorted((i for i, _ in rows), key=lambda i: (i is not None, i or 0))
    at = 0
    left = {}
    for i, t in rows:
        left.setdefault(i, []).append(tool.encode(t or "", add_special_tokens=False).ids + [2])
    for r in got:
        assert r.start == at
        assert list(r.ids) in left[r.doc_id]
        assert r.n_tokens == len(r.ids)
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        at += r.n_tokens
    return files


def test_id_files_round_trip(spark, docs):
    _check_files(spark, docs(ROWS), ROWS)


def test_id_files_with_dictionary(spark, folder):
    table = spark.read.parquet(f"{folder}/documents.parquet")
    files = _check_files(spark, table, [(r.doc_id, r.text) for r in table.collect()])
    assert files.dictionary
    again = id_files.open_set(spark, files.path)
    assert again == files
    box = spark.read.parquet(f"{files.path}/containers").first()["content"]
    with pytest.raises(ValueError, match="another dictionary"):
        id_files.Container(bytes(box), b"other")


def test_id_files_of_an_empty_table(spark, docs):
    files = id_files.write(docs([]), "byte_bpe_50k.json", end_id=2)
    assert id_files.read(spark, files).collect() == []
