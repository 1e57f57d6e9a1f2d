"""Documents whose sets of word shingles are similar: PartEnum signatures, exact verification, components.

Sets are banded by size. In a band, two sets whose Jaccard similarity reaches the threshold differ in at most ``k`` elements.
The feature domain (64-bit shingle hashes) is cut into ``k // (inner + 1) + 1 + m`` partitions, so at least ``m + 1`` of them hold at
most ``inner`` of the differences. Each is cut again into ``parts``, of which at most ``inner`` differ there, and every subset of
``parts - inner`` parts gives one signature: two similar sets share one in each of ``m + 1`` partitions. Small sets do without
the second level (one part, no difference).

An equal subset that is empty says nothing, and one on a passage that many documents share says little. So
the domain first leaves out shingles that are frequent in a sample of documents (any sub-domain keeps the bound ``k``,
so the sample decides cost, never results). Frequent means a number of documents, not a share of them: a share would let the groups
of the rest grow with the table, and their pairs with its square. Counting parts that can differ, two similar sets share at least ``n * (inner + 1) - k`` subsets, of which a set loses at most
``inner + 1 - filled`` in a partition of which it fills so few parts. A set that still has one left shares a non-empty signature
with every similar set. Only the others go on to the next scheme, with more partitions or the whole domain, and sets that fail every
scheme meet in one signature for their band. A pair is missed by a scheme only if both of its sets go on,
so no pair is missed.

The same count tells how many non-empty signatures two similar sets share at least; each set leaves out as many of its
most common signatures, less one, as it must share.

Signatures that the same sets share say the same, so a group is named by its members and each set joins it once.

Sets that share a signature are not paired with each other. Each set is verified against one other, of the smallest sets of
its groups the one it shares most groups with, and verified links are joined to components. Groups with one smallest component are
a family. In it each component is verified against the set of another that is nearest to one of its own, and links are joined again;
only then are the pairs verified that share a signature and are still in different components. The components are those of all links.

Before texts are compared, sizes and parities rule pairs out exactly: each set has 256 bits, the parities of its elements' counts in
256 classes of hashes, and two sets differ in at least as many elements as bits. The sets of a family have the same bound with about
four classes an element, their sketches, which also tell who is nearest. A family's sets are dealt out in blocks and each two blocks
meet in one task, so a pair is looked at once in a family, and only a pair that this bound leaves is made.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction
from functools import lru_cache
from itertools import combinations
from math import ceil

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.llm.base import WordHashes, discard, hold, mix, stage, windows
from tallyhouse.llm.components import components

#: One document of so many (by a hash of its text) tells frequent shingles, a shingle being frequent that more than so many of them
#: have, and frequent shingles that are listed: the most common ones, where there are more.
SAMPLE, FREQUENT, LISTED = 16, 8, 1 << 20
#: Pairs that are handed on at a time, and sets in a block of a family.
PAIRED, BLOCK = 1 << 16, 512
#: Entries of a signature bucket to aim for.
BUCKET = 1 << 19


@dataclass(frozen=True)
class Scheme:
    rare_only: bool
    slack: float
    seed: int


#: Differences allowed inside a partition and parts of it, from this ``k`` on; below, a partition is one part.
INNER, PARTS, TWO_LEVELS = 1, 3, 8
#: Steps in which the number of shared signatures is promised, rounded down.
NEEDS = np.array([1, 2, 3, 4, 6, 8, 12, 16, 24, 32, 48, 64, 96, 128, 192, 255])
#: Scheme number of the one signature that all remaining sets of a band share.
REST = 7

SCHEMES = (Scheme(True, 0.25, 0), Scheme(True, 1.0, 0), Scheme(False, 0.25, 1), Scheme(False, 1.0, 2))

_words = WordHashes()


def shingle_set(text: bytes | None, size: int = 5) -> np.ndarray:
    """Sorted distinct hashes of the text's word shingles."""
    hold("jaccard", _words.clear)
    found = (text or b"").lower().split()
    return np.unique(windows(_words.of(found), size)) if found else np.zeros(0, np.uint64)


@lru_cache
def bands(threshold: float) -> np.ndarray:
    """Upper sizes of the bands: each as wide as the threshold lets two sets differ in size."""
    share, ends = Fraction(str(threshold)), [1]
    while ends[-1] < 1 << 40:
        ends.append(max(ends[-1] + 1, int(ends[-1] / share)))
    return np.array(ends, dtype=np.int64)


def most_different(largest: int, threshold: float) -> int:
    """Elements in which two sets of at most ``largest`` elements may differ and still be similar enough."""
    share = Fraction(str(threshold))
    return int((1 - share) / (1 + share) * 2 * largest)


def _first_of_run(values: np.ndarray) -> np.ndarray:
    """Positions where a new value begins in a sorted array."""
    return np.concatenate(([0], np.flatnonzero(values[1:] != values[:-1]) + 1)) if len(values) else np.zeros(0, dtype=np.int64)


@lru_cache(maxsize=1 << 16)
def _levels(size: int, threshold: float) -> list[tuple[int, int]]:
    """Bands a set of this size joins, its own and the next larger ones that hold sets up to ``1 / threshold`` its size, and their ``k``."""
    ends = bands(threshold)
    low, high = (int(np.searchsorted(ends, n)) for n in (size, int(size / Fraction(str(threshold)))))
    return [(band, most_different(int(ends[band]), threshold)) for band in range(low, high + 1)]


@lru_cache
def _subsets(inner: int, parts: int) -> np.ndarray:
    """One column per subset of ``parts - inner`` parts, 1 where the part belongs to it."""
    picked = list(combinations(range(parts), parts - inner))
    return np.array([[part in some for some in picked] for part in range(parts)], dtype=np.uint64)


def signatures(elements: np.ndarray, frequent: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Signatures of one set (sorted distinct 64-bit elements), of every band it joins, and a code for each.

    The code's low byte tells the band (odd or even) and the scheme, its high byte ``need``: a similar set shares at least so many
    signatures of that band and scheme, provided that this set stops there (else it is 1, which promises nothing).
    """
    if not len(elements):
        return elements, np.zeros(0, np.uint16)
    codes = []
    domains = {0: elements, True: elements}
    if len(frequent):
        at = np.searchsorted(frequent, elements)
        at[at == len(frequent)] = 0
        domains[True] = elements[frequent[at] != elements]
    made = []
    for band, k in _levels(len(elements), threshold):
        inner, parts = (INNER, PARTS) if k >= TWO_LEVELS else (0, 1)
        subsets = _subsets(inner, parts)
        bad = k // (inner + 1)  # partitions that may hold more than ``inner`` differences
        for number, scheme in enumerate(SCHEMES):
            m = max(1, ceil(scheme.slack * (bad + 1))) if k else 0
            n = bad + 1 + m
            which = True if scheme.rare_only else scheme.seed
            if which not in domains:
                domains[which] = np.sort(mix(elements ^ np.uint64(scheme.seed * 0x9E3779B97F4A7C15 & (1 << 64) - 1)))
            domain = domains[which]
            # parts are ranges of hashes, so a sorted set is already grouped by them
            part = ((domain >> np.uint64(32)) * np.uint64(n * parts)) >> np.uint64(32)
            first = _first_of_run(part)
            total, filled = np.zeros(n * parts, np.uint64), np.zeros(n * parts, np.uint64)
            if len(first):
                total[part[first]] = np.add.reduceat(domain, first)
                filled[part[first]] = 1
            filled = filled.reshape(n, parts)
            names = (np.arange(n * subsets.shape[1], dtype=np.uint64) + np.uint64((band << 40) + (number << 36) + (1 << 35))) * np.uint64(0x9E3779B97F4A7C15)
            some = ((filled @ subsets) > 0).ravel()
            made.append(mix((total.reshape(n, parts) @ subsets).ravel() + names)[some])
            # a partition with j differing parts shares at least inner + 1 - j subsets, less those that are empty in this set
            need = n * (inner + 1) - k - int(np.maximum(inner + 1 - filled.sum(axis=1).astype(np.int64), 0).sum())
            promise = int(NEEDS[np.searchsorted(NEEDS, max(need, 1), "right") - 1])
            codes.append(np.full(len(made[-1]), promise << 8 | (band & 1) << 3 | number, dtype=np.uint16))
            if need >= 1:
                break
        else:
            made.append(mix(np.array([band << 40 | 0xF << 32], dtype=np.uint64)))
            codes.append(np.array([1 << 8 | (band & 1) << 3 | REST], dtype=np.uint16))
    return np.concatenate(made), np.concatenate(codes)


def _frequent(rows: DataFrame) -> np.ndarray:
    """Shingles in more than ``FREQUENT`` documents of the sample, at most ``LISTED``."""
    picked = rows.select("t").where("t is not null").where(F.pmod(F.xxhash64(F.lit(3), "t"), F.lit(SAMPLE)) == 0)

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            sets = [shingle_set(x) for x in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(sets).view(np.int64))], ["h"])

    counted = picked.mapInArrow(run, "h long").groupBy("h").agg(F.count(F.lit(1)).alias("c")).where(F.col("c") > FREQUENT)
    counted = stage(counted, "frequent-shingles")
    least, held = 0, 0
    for c, n in counted.groupBy(F.least("c", F.lit(1 << 16)).alias("c")).count().orderBy(F.desc("c")).collect():
        held += n
        if held > LISTED:
            least = c
            break
    found = counted.where(F.col("c") > least).select("h").toArrow().column(0).to_numpy()
    discard(counted)
    return np.sort(found.astype(np.int64).view(np.uint64))


def _identity(elements: np.ndarray) -> tuple[int, bytes]:
    """40-bit id and 128-bit digest of a set."""
    digest = xxhash.xxh3_128_digest(elements.tobytes())
    return _id(digest), digest


def _parities(elements: np.ndarray) -> bytes:
    """256 bits: whether an odd number of elements is in each class."""
    return np.packbits(np.bincount((elements & np.uint64(255)).astype(np.int64), minlength=256) & 1).tobytes()


def _id(digest: bytes) -> int:
    return int.from_bytes(digest[:5], "little")


def _narrow(values: np.ndarray, width: int) -> bytes:
    """The low ``width`` bytes of 64-bit values."""
    return values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def _widen(blob: bytes, n: int, width: int, at: int) -> np.ndarray:
    wide = np.zeros((n, 8), dtype=np.uint8)
    wide[:, :width] = np.frombuffer(blob, np.uint8, width * n, at).reshape(n, width)
    return wide.view("<u8").ravel()


_PLACED = "k long, n long, digest binary, id long, sig long, size long, code int, p0 long, p1 long, p2 long, p3 long"
_NAMES = [x.split(" ")[0] for x in _PLACED.split(", ")]
_KINDS = [pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), *[pa.int64()] * 4]


def _placed(**columns) -> pa.RecordBatch:
    size = len(next(iter(columns.values())))
    return pa.RecordBatch.from_arrays([pa.array(columns[n], t) if n in columns else pa.nulls(size, t) for n, t in zip(_NAMES, _KINDS)], _NAMES)


def _signed(docs: DataFrame, key: str, text: str, threshold: float) -> DataFrame:
    """One pass over the texts. Rows with a digest tell each document's key, set size and identity; rows with a signature tell
    the name of the group that shares it, the id of a set of the group, how many it has, and the set's code for it."""
    rows = docs.select(F.col(key).cast("long").alias("k"), F.col(text).cast("binary").alias("t"))
    frequent = _frequent(rows)
    entries = (rows.agg(F.coalesce(F.sum(F.octet_length("t")), F.lit(0))).first()[0]) // 8  # about one per word
    buckets = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), ceil(entries / BUCKET))

    def sign(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()  # of this task: copies are signed once
        found, owners, marks, held, told = [], [], [], 0, []

        def flush():
            # 10 bytes an entry: a bucket holds few enough for 32 bits of the signature to tell it, chance equality adds candidates only
            sig, owner = np.concatenate([np.zeros(0, np.uint64), *found]), np.concatenate([np.zeros(0, np.uint64), *owners])
            mark = np.concatenate([np.zeros(0, np.uint16), *marks])
            mark = (np.searchsorted(NEEDS, mark >> 8) << 4 | mark & 15).astype(np.uint8)
            bucket = ((sig >> np.uint64(40)) * np.uint64(buckets)) >> np.uint64(24)
            order = np.argsort(bucket.astype(np.uint16) if buckets <= 1 << 16 else bucket, kind="stable")
            sig, owner, mark, bucket = sig[order], owner[order], mark[order], bucket[order]
            starts = _first_of_run(bucket)
            stops = np.append(starts[1:], len(bucket))
            blobs = [_narrow(sig[a:b], 4) + _narrow(owner[a:b], 5) + mark[a:b].tobytes() for a, b in zip(starts, stops)]
            blank = [None] * len(blobs)
            names = bucket[starts].astype(np.int64).tolist()
            for k, _, digest, _ in told:  # documents need not meet here: copies are dealt out by their keys too
                names.append(xxhash.xxh3_64_intdigest(digest + (k or 0).to_bytes(8, "little", signed=True)) % buckets)
            return pa.RecordBatch.from_arrays(
                [pa.array(names, pa.int64()), pa.array(blobs + [None] * len(told), pa.binary()), pa.array(blank + [x[0] for x in told], pa.int64()),
                 pa.array(blank + [x[1] for x in told], pa.int64()), pa.array(blank + [x[2] for x in told], pa.binary()),
                 pa.array(blank + [x[3] for x in told], pa.binary())],
                ["bucket", "blob", "k", "n", "digest", "bits"],
            )

        for batch in rows:
            for k, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                s = shingle_set(t)
                name, digest = _identity(s)
                told.append((k, len(s), digest, _parities(s)))
                if not len(s) or digest in seen:
                    continue
                seen.add(digest)
                sig, code = signatures(s, frequent, threshold)
                found.append(sig)
                marks.append(code)
                owners.append(np.full(len(sig), name, dtype=np.uint64))
                held += len(sig)
            if held > 1_000_000:
                yield flush()
                found, owners, marks, held, told = [], [], [], 0, []
        if told:
            yield flush()

    def work(blobs: list[bytes]) -> Iterator[pa.RecordBatch]:
        sigs, owners, marks = [], [], []
        for blob in blobs:
            n = len(blob) // 10
            sigs.append(_widen(blob, n, 4, 0))
            owners.append(_widen(blob, n, 5, 4 * n))
            marks.append(np.frombuffer(blob, np.uint8, n, 9 * n))
        sig, owner, mark = np.concatenate(sigs), np.concatenate(owners), np.concatenate(marks)
        order = np.lexsort((owner, sig))
        sig, owner, mark = sig[order], owner[order], mark[order]
        fresh = np.append(True, (sig[1:] != sig[:-1]) | (owner[1:] != owner[:-1]))
        sig, owner, mark = sig[fresh], owner[fresh], mark[fresh]
        starts = _first_of_run(sig)
        count = np.diff(np.append(starts, len(sig)))
        shared = np.repeat(count > 1, count)
        if shared.any():
            # named by its members, band and scheme: signatures of the same sets have one name, in whatever buckets they are
            members = np.repeat(np.bitwise_xor.reduceat(mix(owner), starts), count)[shared]
            named = mix(members + ((mark[shared] & 15).astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))
            named = (named >> np.uint64(24)).view(np.int64)  # one name for two groups adds candidates only
            code = NEEDS[mark[shared] >> 4] << 8 | (mark[shared] & 15)
            yield _placed(id=owner[shared].astype(np.int64), sig=named, size=np.repeat(count, count)[shared], code=code.astype(np.int32))

    def meet(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, blobs = None, []  # rows come sorted by bucket, so one bucket is held at a time
        for batch in rows:
            own = batch.filter(batch.column(4).is_valid())
            if own.num_rows:
                digests = own.column(4).to_pylist()
                bits = np.frombuffer(b"".join(own.column(5).to_pylist()), "<i8").reshape(-1, 4)
                yield _placed(
                    k=own.column(2).to_pylist(), n=own.column(3).to_pylist(), digest=digests, id=[_id(d) for d in digests],
                    **{f"p{i}": bits[:, i] for i in range(4)},
                )
            for bucket, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if blob is None:
                    continue
                if bucket != current and blobs:
                    yield from work(blobs)
                    blobs = []
                current = bucket
                blobs.append(blob)
        if blobs:
            yield from work(blobs)

    dealt = rows.mapInArrow(sign, "bucket long, blob binary, k long, n long, digest binary, bits binary").repartition(buckets, "bucket").sortWithinPartitions("bucket")
    return stage(dealt.mapInArrow(meet, _PLACED), "signatures")


def _sketch(elements: np.ndarray) -> bytes:
    """Parities in about four classes an element, 256 at least."""
    classes = min(max(256, 1 << (4 * len(elements) - 1).bit_length()), 1 << 17) if len(elements) else 256
    return np.packbits(np.bincount((elements & np.uint64(classes - 1)).astype(np.int64), minlength=classes) & 1).tobytes()


def _differ(x: bytes, y: bytes) -> int:
    """Bits in which two sketches differ. The longer one is folded: a class is the sum of two of twice as many."""
    size = min(len(x), len(y)) // 8
    return int(np.bitwise_count(_folded(x, size) ^ _folded(y, size)).sum())


def _folded(bits: bytes, size: int) -> np.ndarray:
    p = np.frombuffer(bits, np.uint64)
    while len(p) > size:
        p = p[: len(p) // 2] ^ p[len(p) // 2 :]
    return p


def _texts(docs: DataFrame, wanted: DataFrame, key: str, text: str) -> DataFrame:
    """Digest, text, size and sketch of the wanted documents (their keys)."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            sets = [shingle_set(t) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([_identity(s)[1] for s in sets], pa.binary()), batch.column(0), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([_sketch(s) for s in sets], pa.binary())],
                ["digest", "t", "n", "bits"],
            )

    rows = docs.select(F.col(key).cast("long").alias("k"), F.col(text).cast("binary").alias("t")).where("t is not null")
    return rows.join(wanted, rows["k"].eqNullSafe(wanted["k"]), "left_semi").select("t").mapInArrow(run, "digest binary, t binary, n long, bits binary")


_BITS = ("p0", "p1", "p2", "p3")


def _sided(sets: DataFrame, side: str) -> DataFrame:
    """The sets with their digest named ``side`` and their size and parities marked by it."""
    return sets.withColumnsRenamed({"digest": side, **{c: f"{c}_{side}" for c in ("n", *_BITS)}}).drop("k")


def _may_link(threshold: float) -> Column:
    """Whether the pair ``a``, ``b`` may be linked: similar sets differ in few elements, and different bits or sizes are differences."""
    share = Fraction(str(threshold))
    bits = sum((F.bit_count(F.col(f"{c}_a").bitwiseXOR(F.col(f"{c}_b"))) for c in _BITS), F.lit(0))
    least = F.greatest(bits.cast("long"), F.abs(F.col("n_a") - F.col("n_b")))
    return least * (share.denominator + share.numerator) <= (F.col("n_a") + F.col("n_b")) * (share.denominator - share.numerator)


def _close(pairs: DataFrame, sketches: DataFrame, threshold: float) -> DataFrame:
    """Those pairs of digests (``a``, ``b``) that their sketches do not rule out."""
    share = Fraction(str(threshold))

    def near(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            a, b, n, m, x, y = (c.to_pylist() for c in batch.columns)
            most = [(i + j) * (share.denominator - share.numerator) for i, j in zip(n, m)]
            keep = pa.array([_differ(i, j) * (share.denominator + share.numerator) <= d for i, j, d in zip(x, y, most)], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], ["a", "b"])

    first = sketches.withColumnsRenamed({"digest": "a", "bits": "x"})
    second = sketches.withColumnsRenamed({"digest": "b", "n": "m", "bits": "y"})
    return pairs.join(first, "a").join(second, "b").select("a", "b", "n", "m", "x", "y").mapInArrow(near, "a binary, b binary")


def _verified(close: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """Those pairs of digests (``a``, ``b``) whose sets are similar enough. Texts travel, being smaller than their sets."""
    share = Fraction(str(threshold))

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, q = None, None
        for batch in rows:
            linked = []
            for b, x, y in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), batch.column(3)):
                if b != last:
                    last, q = b, shingle_set(y.as_py())
                p, q2 = shingle_set(x), q
                if len(p) > len(q2):
                    p, q2 = q2, p
                at = np.searchsorted(q2, p)
                at[at == len(q2)] = 0
                both = int(np.count_nonzero(q2[at] == p))
                linked.append(share.denominator * both >= share.numerator * (len(p) + len(q2) - both))
            keep = pa.array(linked, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], ["a", "b"])

    used = close.select(F.col("a").alias("digest")).unionByName(close.select(F.col("b").alias("digest"))).distinct()
    texts = texts.join(used, "digest", "left_semi")
    left = texts.select(F.col("digest").alias("a"), F.col("t").alias("x"))
    right = texts.select(F.col("digest").alias("b"), F.col("t").alias("y"))
    found = close.join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInArrow(run, "a binary, b binary")
    return stage(found, "links")


def _worth_a_look(shared: DataFrame) -> DataFrame:
    """Groups in which sets must meet: ``sig``, ``id``.

    Similar sets share ``need`` signatures, so each may leave out its ``need - 1`` most common ones, in one order for all sets, and
    the rarest shared one is left (prefix filter). Sets that only share a passage share fewer and drop out here. Of signatures with
    one name the last stands for all: two sets that share one of them share the last too.
    """
    mine = Window.partitionBy("id", F.col("code").bitwiseAND(F.lit(255))).orderBy(F.desc("size"), "sig")
    ranked = shared.withColumns({"place": F.row_number().over(mine), "next": F.lead(F.struct("size", "sig")).over(mine)})
    last = ~F.col("next").eqNullSafe(F.struct("size", "sig"))
    left = stage(ranked.where(last & (F.col("place") >= F.shiftright("code", 8))).select("sig", "id"), "rare-signatures")
    several = left.groupBy("sig").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("sig")
    groups = stage(left.join(several, "sig"), "signature-groups")
    discard(left)
    return groups


def _gathered(rest: DataFrame) -> DataFrame:
    """One row per set of a family (``lo``) with its signatures there, ``sigs``, in 32 bits: chance equality adds candidates only.

    Other columns belong to the set.
    """
    own = [c for c in rest.columns if c not in ("lo", "digest", "sig")]
    return rest.groupBy("lo", "digest").agg(F.collect_list(F.hash("sig")).alias("sigs"), *[F.first(c).alias(c) for c in own])


def _paired(rest: DataFrame, threshold: float, nearest: bool = False) -> DataFrame:
    """Pairs (``a``, ``b``) of sets of one group and different components (``r``) that sizes and sketches (``bits``) do not rule out.

    ``rest`` has a row per set of a family, as ``_gathered`` makes them, or per set and signature; without ``bits`` parities tell.
    ``nearest``: of each family's components only the pair that differs least.
    """
    share = Fraction(str(threshold))
    up, down = share.denominator + share.numerator, share.denominator - share.numerator
    sets = rest if "sigs" in rest.columns else _gathered(rest)
    if "bits" not in sets.columns:
        sets = sets.withColumn("bits", F.unhex(F.concat(*[F.lpad(F.hex(c), 16, "0") for c in _BITS])))
    made = "lo long, r long, far double, a binary, b binary"
    names = [x.split(" ")[0] for x in made.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.float64(), pa.binary(), pa.binary()]

    def work(key: tuple[int, int, int], held: list[tuple]) -> Iterator[pa.RecordBatch]:
        held.sort(key=lambda x: x[0])  # the lower block first
        sigs, bits, digests = ([x[c] for x in held] for c in (5, 4, 1))
        root, n = (np.array([x[c] for x in held], dtype=np.int64) for c in (2, 3))
        small = np.array([_folded(x, 4) for x in bits])
        lower = int(np.searchsorted([x[0] for x in held], key[1], "right"))  # two blocks: only pairs between them
        found, best = [], {}

        def told(rows) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)

        for i in range(lower):
            at = i + 1 if key[1] == key[2] else lower
            j = at + np.flatnonzero(root[at:] != root[i])
            j = j[np.abs(n[i] - n[j]) * up <= (n[i] + n[j]) * down]
            j = j[np.bitwise_count(small[i] ^ small[j]).sum(axis=1, dtype=np.int64) * up <= (n[i] + n[j]) * down]
            mine = None
            for k in j.tolist():
                both = int(n[i] + n[k])
                least = max(_differ(bits[i], bits[k]), abs(int(n[i] - n[k])))
                if least * up > both * down:
                    continue
                far = least / both
                if nearest and all(r in best and best[r][2] <= far for r in (root[i], root[k])):
                    continue
                mine = set(sigs[i]) if mine is None else mine
                if mine.isdisjoint(sigs[k]):
                    continue
                if not nearest:
                    found.append((key[0], root[i], far, digests[i], digests[k]))
                    continue
                for r in (root[i], root[k]):
                    if r not in best or far < best[r][2]:
                        best[r] = (key[0], r, far, digests[i], digests[k])
            if len(found) >= PAIRED:
                yield told(found)
                found = []
        found += best.values()
        if found:
            yield told(found)

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held = None, []  # rows come sorted, so the sets of two blocks are held at a time
        for batch in rows:
            columns = [c.to_pylist() for c in batch.columns[:-1]]
            sigs = batch.columns[-1]
            for at, row in enumerate(zip(*columns)):
                if row[:3] != current:
                    if held:
                        yield from work(current, held)
                    current, held = row[:3], []
                held.append((*row[3:], sigs[at].values.to_numpy().tolist()))
        if held:
            yield from work(current, held)

    # only families of several blocks are listed, at most one for so many sets, and a family's sets need not meet to learn it
    listed = sets.groupBy("lo").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("blocks")).where("blocks > 1")
    blocks = F.coalesce("blocks", F.lit(1).cast("long"))
    mine = sets.join(F.broadcast(listed), "lo", "left").withColumn("blocks", blocks).withColumn("own", F.pmod(F.xxhash64("digest"), "blocks"))
    dealt = mine.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    dealt = dealt.select("lo", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "digest", "r", "n", "bits", "sigs")
    pairs = dealt.repartition("lo", "i", "j").sortWithinPartitions("lo", "i", "j").mapInArrow(run, made)
    if nearest:
        pairs = pairs.groupBy("lo", "r").agg(F.min(F.struct("far", "a", "b")).alias("p")).select("p.a", "p.b")
    return pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def similar_components(docs: DataFrame, threshold: float = 0.75, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``key``, ``n_shingles`` and ``component_id``, the smallest key that similar documents reach from it.

    A document's set holds its distinct five-word shingles, or all its words as one shingle where they are fewer. Two documents
    are linked when the Jaccard similarity of their sets is at least ``threshold``. NULL, empty and blank texts have an empty
    set and are linked with nothing. Rows repeat as given; rows with equal keys are separate documents. A row with a NULL key takes part
    and its component has the smallest key that is there, if any. Extra columns are not read, an empty table gives no rows.
    """
    signed = _signed(docs, key, text, threshold)
    identified = stage(signed.where("digest is not null").select("k", "n", "digest", "id", *_BITS), "identities")
    groups = _worth_a_look(signed.where("sig is not null"))
    discard(signed)
    facts = [F.min("k").alias("k"), *[F.first(c).alias(c) for c in ("n", *_BITS)]]
    classes = stage(identified.where("n > 0").groupBy("digest", "id").agg(*facts), "classes")

    # ids are 40 bits of the digest: should two sets have one id, both stand for it, and they are a candidate pair
    bundled = classes.groupBy("id").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("id")
    taking_part = stage(classes.join(groups.select("id").unionByName(bundled).distinct(), "id"), "candidates")
    named = taking_part.select("id", "digest")
    sets = taking_part.drop("id")
    twins = named.join(bundled, "id")
    twins = twins.withColumnRenamed("digest", "a").join(twins.withColumnRenamed("digest", "b"), "id").where("a > b").select("a", "b")
    placed = stage(groups.join(named, "id").select("sig", "digest"), "members")
    discard(groups)
    # each set is first held against the center it shares most groups with
    centers = placed.groupBy("sig").agg(F.min("digest").alias("b"))
    most = placed.withColumnRenamed("digest", "a").join(centers, "sig").where("a <> b").groupBy("a", "b").agg(F.count(F.lit(1)).alias("c"))
    starred = most.groupBy("a").agg(F.max_by("b", F.struct("c", "b")).alias("b"))
    tried = starred.unionByName(twins).distinct().join(_sided(sets, "a"), "a").join(_sided(sets, "b"), "b").where(_may_link(threshold))
    tried = stage(tried.select("a", "b"), "tried-pairs")
    texts = stage(_texts(docs, taking_part.select("k").distinct(), key, text), "candidate-texts")
    sketches = stage(texts.select("digest", "n", "bits").dropDuplicates(["digest"]), "sketches")
    links = _verified(stage(_close(tried, sketches, threshold), "close-pairs"), texts, threshold)
    joined = components(links)

    # what shares a signature and is still apart
    root = F.coalesce("root", "digest")
    parted = stage(placed.join(joined.withColumnRenamed("node", "digest"), "digest", "left").select("sig", "digest", root.alias("root")), "placed")
    discard(placed)
    apart = parted.groupBy("sig").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi").select("sig", F.xxhash64("lo").alias("lo"))
    families = stage(_gathered(parted.select("sig", "digest").join(apart, "sig")), "families")
    discard(parted)
    # first the nearest, and when those are joined all that is left
    for nearest in (True, False):
        told = sketches.join(joined.withColumnRenamed("node", "digest"), "digest", "left").select("digest", "n", "bits", F.xxhash64(root).alias("r"))
        more = stage(_paired(families.join(told, "digest"), threshold, nearest).join(tried, ["a", "b"], "left_anti"), "more-pairs")
        tried = tried.unionByName(more)
        found = _verified(more, texts, threshold)
        if not found.isEmpty():
            links = links.unionByName(found)
            joined = components(links)
    discard(families)
    discard(texts)

    roots = classes.join(joined.withColumnRenamed("node", "digest"), "digest", "left").select("digest", "k", F.coalesce("root", "digest").alias("root"))
    smallest = roots.groupBy("root").agg(F.min("k").alias("component_id"))
    answer = roots.join(smallest, "root").select("digest", "component_id")
    full = identified.join(answer, "digest", "left")
    return full.select(
        F.col("k").alias(key), F.col("n").alias("n_shingles"),
        F.when(F.col("n") == 0, F.col("k")).otherwise(F.col("component_id")).alias("component_id"),
    )


def one_of_each(docs: DataFrame, threshold: float = 0.75, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose key is the smallest of its component; of rows with equal keys and texts one stays.

    Rows without a word or without a key stay. A component whose smallest key has several texts keeps each of them.
    """
    found = similar_components(docs, threshold, key, text)
    stay = found.where(F.col(key) == F.col("component_id")).select(F.col(key).alias("_stay")).distinct()
    kept = docs.join(stay, F.col(key) == F.col("_stay"), "left").where(F.col("_stay").isNotNull() | F.col(key).isNull()).drop("_stay")
    return kept.dropDuplicates([key, text])
