"""Token ids in container files: one zstandard frame per document, one shared dictionary, an offset index.

A container holds the documents of a contiguous range of keys::

    magic "IDZ1", id width (1 byte), dictionary hash (16 bytes), documents n (uint32)
    key present (n bytes), keys (n int64), tokens (n uint64), frame offsets (n + 1 uint64), frames

All numbers are little-endian. A frame is read by its two offsets alone, so a short document costs one small read and one
decompression. Containers are kept as the ``content`` column of a Parquet table: Spark's writer brings them to any file
system the cluster has and commits whole tasks, so a lost executor leaves no half-written file. The dictionary is
a one-row table beside them.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.llm import tokens
from tallyhouse.llm.base import hash_sample
from tallyhouse.session import workspace

MAGIC = b"IDZ1"
_HEAD = struct.Struct("<4sB16sI")
#: Documents whose ids the dictionary is trained on, at most; chosen by a hash of the key over the whole table.
SAMPLE_DOCS = 1000
#: A sampled text is left out above this many bytes, so that the sample stays bounded.
SAMPLE_TEXT_BYTES = 65_536
DICTIONARY_BYTES = 65_536
#: Frames in a container, at most, unless one document alone has more.
CONTAINER_BYTES = 4 << 20


def dictionary_hash(dictionary: bytes) -> bytes:
    return hashlib.blake2b(dictionary, digest_size=16).digest()


def train_dictionary(docs: DataFrame, vocabulary: str, key: str, text: str) -> bytes:
    """A zstandard dictionary from the serialised ids of a bounded sample; empty where the sample is too small for one."""
    small = docs.where(F.octet_length(text) <= SAMPLE_TEXT_BYTES)
    picked = sorted(hash_sample(small.select(key, text), [key, text], SAMPLE_DOCS, seed=7).select(text).collect())
    encode = tokens.encoder(tokens.vocabulary_file(vocabulary))
    samples = [s for s in encode([row[0] for row in picked]) if s]
    if len(samples) < 8:
        return b""
    size = min(DICTIONARY_BYTES, max(256, sum(map(len, samples)) // 10))
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:  # too little or too uniform data
        return b""


def _codec(dictionary: bytes):
    shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    if shared:
        shared.precompute_compress(level=3)
    make = {"dict_data": shared} if shared else {}
    return zstandard.ZstdCompressor(level=3, **make), zstandard.ZstdDecompressor(**make)


def pack_container(keys: list[int | None], counts: list[int], frames: list[bytes], digest: bytes, width: int) -> bytes:
    offsets = np.concatenate([[0], np.cumsum([len(f) for f in frames])]).astype("<u8")
    return b"".join((
        _HEAD.pack(MAGIC, width, digest, len(keys)),
        bytes(k is not None for k in keys),
        np.array([k or 0 for k in keys], dtype="<i8").tobytes(),
        np.array(counts, dtype="<u8").tobytes(),
        offsets.tobytes(),
        *frames,
    ))


class Container:
    """Reads a container; ``ids(i)`` touches only the frame of document ``i``."""

    def __init__(self, content: bytes, dictionary: bytes, decompressor=None):
        magic, self.width, digest, n = _HEAD.unpack_from(content)
        if magic != MAGIC:
            raise ValueError("not a container of token ids")
        if digest != dictionary_hash(dictionary):
            raise ValueError("the container was written with another dictionary")
        at = _HEAD.size
        there = content[at : at + n]
        keys = np.frombuffer(content, "<i8", n, at + n)
        self.counts = np.frombuffer(content, "<u8", n, at + 9 * n)
        self.offsets = np.frombuffer(content, "<u8", n + 1, at + 17 * n)
        self.keys = [int(k) if p else None for k, p in zip(keys, there)]
        self.body = memoryview(content)[at + 25 * n + 8 :]
        self.open = decompressor or _codec(dictionary)[1]

    def ids(self, i: int) -> np.ndarray:
        raw = self.open.decompress(self.body[int(self.offsets[i]) : int(self.offsets[i + 1])])
        return np.frombuffer(raw, "<u2" if self.width == 2 else "<u4")


@dataclass(frozen=True)
class IdFiles:
    """A written set: the container table, the dictionary, and the first position of each range of keys."""

    path: str
    dictionary: bytes
    bases: dict[int, int]


def write(docs: DataFrame, vocabulary: str, end_id: int, key: str = "doc_id", text: str = "text") -> IdFiles:
    """Encode every text, append ``end_id`` and write containers in ascending order of ``key`` (NULLs first).

    NULL text counts as empty and gives just the end id. Rows with equal keys follow one another by a hash of their text;
    exact repeats are interchangeable. The rows are dealt in ranges of the key, encoded and compressed in the task that writes
    them. The driver sees one number per range (the shuffle partitions), never ids.
    """
    spark = docs.sparkSession
    path = workspace(spark, "ids")
    rows = docs.select(F.col(key).cast("long").alias("k"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    rows = rows.withColumn("h", F.xxhash64("t"))
    dictionary = train_dictionary(rows, vocabulary, "k", "t")
    digest = dictionary_hash(dictionary)

    def contain(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        squeeze = _codec(dictionary)[0].compress
        encode = tokens.encoder(tokens.vocabulary_file(vocabulary))
        end = np.array([end_id], dtype="<u2").tobytes()
        keys, counts, frames, held, before = [], [], [], 0, 0

        def flush():
            content = pack_container(keys, counts, frames, digest, 2)
            made = [[part], [before], [sum(counts)], [content]]
            return pa.RecordBatch.from_arrays(
                [pa.array(v, t) for v, t in zip(made, (pa.int32(), pa.int64(), pa.int64(), pa.binary()))],
                ["part", "before", "n_tokens", "content"],
            )

        for batch in rows:
            for k, ids in zip(batch.column(0).to_pylist(), encode(batch.column(1).to_pylist())):
                frame = squeeze(ids + end)
                if frames and held + len(frame) > CONTAINER_BYTES:
                    yield flush()
                    before += sum(counts)
                    keys, counts, frames, held = [], [], [], 0
                keys.append(k)
                counts.append(len(ids) // 2 + 1)
                frames.append(frame)
                held += len(frame)
        if frames:
            yield flush()

    order = [F.col("k").asc_nulls_first(), F.col("h")]
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("k", "t")
    made = dealt.mapInArrow(contain, "part int, before long, n_tokens long, content binary")
    made.write.option("compression", "none").parquet(f"{path}/containers")
    spark.createDataFrame([(bytearray(dictionary), bytearray(digest))], "dictionary binary, hash binary").coalesce(1).write.parquet(f"{path}/dictionary")
    return open_set(spark, path)


def open_set(spark: SparkSession, path: str) -> IdFiles:
    """Open a written set by its path."""
    row = spark.read.parquet(f"{path}/dictionary").first()
    dictionary = bytes(row["dictionary"])
    if dictionary_hash(dictionary) != bytes(row["hash"]):
        raise ValueError("the dictionary does not match its hash")
    sizes = spark.read.parquet(f"{path}/containers").groupBy("part").agg(F.sum("n_tokens").alias("n")).collect()
    bases, at = {}, 0
    for part, n in sorted((r["part"], r["n"]) for r in sizes):
        bases[part] = at
        at += n
    return IdFiles(path, dictionary, bases)


def read(spark: SparkSession, files: IdFiles, key: str = "doc_id", with_ids: bool = False) -> DataFrame:
    """Per document, read back from the containers: key, ``start``, ``n_tokens``, ``ids_crc32``, with ``ids`` if asked for."""
    dictionary, bases = files.dictionary, files.bases

    def parse(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opener = _codec(dictionary)[1]
        for batch in rows:
            for part, before, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                start = bases[part] + before
                box = Container(content.as_py(), dictionary, opener)
                sums, arrays = [], []
                for i in range(len(box.keys)):
                    ids = box.ids(i).astype("<u4")
                    sums.append(zlib.crc32(ids.tobytes()))
                    if with_ids:
                        arrays.append(ids.astype(np.int64))
                counts = box.counts.astype(np.int64)
                starts = start + np.concatenate([[0], np.cumsum(counts)[:-1]]).astype(np.int64)
                columns = [pa.array(box.keys, pa.int64()), pa.array(starts), pa.array(counts), pa.array(sums, pa.int64())]
                if with_ids:
                    columns.append(pa.array([a.tolist() for a in arrays], pa.list_(pa.int64())))
                yield pa.RecordBatch.from_arrays(columns, ["k", "start", "n_tokens", "ids_crc32", "ids"][: len(columns)])

    shape = "k long, start long, n_tokens long, ids_crc32 long" + ", ids array<long>" * with_ids
    table = spark.read.parquet(f"{files.path}/containers").select("part", "before", "content")
    return table.mapInArrow(parse, shape).withColumnRenamed("k", key)
