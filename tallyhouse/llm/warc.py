r"""WARC archives as a chunked record table.

A record is the rows of one ``record_id``: the contents in order of ``chunk_no`` are its bytes, header to closing blank lines,
and all records one after the other are a WARC/1.1 file. Payloads are cut into chunks before Python sees them, so neither
writing nor reading ever holds a whole oversized record: each chunk row carries the digest and the length of the payload up to its
end, the writer checks the last against the digest in the header, and the reader checks every one as it streams. A record
of one chunk is a single row. Spark's writer brings the table to any file system and commits whole tasks.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.llm.base import discard, stage
from tallyhouse.session import workspace

#: Payload bytes of a chunk.
CHUNK_BYTES = 256 << 10
END = b"\r\n\r\n"
_TABLE = "record_id string, chunk_no int, last boolean, content binary, payload_so_far long, sha1_so_far binary"
_NAMES = [x.split(" ")[0] for x in _TABLE.split(", ")]
_KINDS = [pa.string(), pa.int32(), pa.bool_(), pa.binary(), pa.int64(), pa.binary()]


def _one_line(value: object) -> str:
    """A header value on one line; other line ends and percent signs are percent-encoded."""
    return "".join(c if c.isprintable() and c != "%" else "".join(f"%{b:02X}" for b in c.encode()) for c in str(value))


def header(record_id: str, page: int | None, url: str | None, digest: bytes, length: int, refers_to: int | None, revisit: bool, date: str) -> bytes:
    """WARC header and HTTP header of a record; a revisit has no payload after it."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {length}\r\n\r\n".encode()
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:uuid:{record_id}>",
        f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha1:{base64.b32encode(digest).decode()}",
        "Content-Type: application/http;msgtype=response",
        f"Content-Length: {len(http) + (0 if revisit else length)}",
    ]
    if url is not None:
        lines.append(f"WARC-Target-URI: {_one_line(url)}")
    if page is not None:
        lines.append(f"X-Page-ID: {page}")
    if revisit:
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        lines.append(f"X-Refers-To-Page-ID: {refers_to}")
    return ("\r\n".join(lines) + "\r\n\r\n").encode() + http


def write(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", least: int = 0, date: str = "2024-01-01T00:00:00Z") -> str:
    """Write one record per page and return the folder of the chunk table.

    Of pages with equal payloads of at least ``least`` bytes the one with the largest key is a response, the others are
    revisits of it. NULL html is an empty payload. Repeated rows each have a record; if a largest key repeats, each of its rows is a
    response. A NULL key is smaller than any other; if a payload has no other key, all its records are responses. Other
    columns are not read, an empty table gives an empty archive. Hot payloads: the largest key of a repeated payload is aggregated before
    the shuffle, and revisits are decided and written without bodies. Bodies of responses are told by key and digest together, which
    spreads the copies of a payload; only distinct keys of revisits are held in memory, a partition at a time, and no body is sorted.
    """
    path = workspace(pages.sparkSession, "warc")
    raw = pages.select(F.col(key).cast("long").alias("page"), F.col(url).alias("url"), F.coalesce(F.col(html).cast("binary"), F.lit(b"")).alias("body"))
    raw = raw.withColumn("sha", F.unhex(F.sha1("body"))).withColumn("size", F.octet_length("body").cast("long"))
    groups = raw.where(F.col("size") >= least).groupBy("sha").agg(F.max("page").alias("newest"), F.count(F.lit(1)).alias("c"))
    newest = stage(groups.where("c > 1 AND newest IS NOT NULL").select("sha", "newest"), "payloads")
    revisits = raw.drop("body").join(newest, "sha").where(~F.col("page").eqNullSafe(F.col("newest")))
    revisits = stage(revisits.select("page", "url", "sha", "size", "newest"), "revisits")
    told = revisits.select(F.col("page").alias("p"), F.col("sha").alias("s")).distinct().hint("shuffle_hash")
    responses = raw.join(told, F.col("page").eqNullSafe(F.col("p")) & (F.col("sha") == F.col("s")), "left_anti")
    empty = revisits.select("*", F.lit(0).alias("chunk"), F.lit(b"").alias("part"))
    chunks = F.explode(F.sequence(F.lit(0), F.greatest(F.ceil(F.col("size") / CHUNK_BYTES).cast("int") - 1, F.lit(0))))
    cut = responses.select("page", "url", "sha", "size", F.lit(None).cast("long").alias("newest"), "body", chunks.alias("chunk"))
    cut = cut.select("page", "url", "sha", "size", "newest", "chunk", F.substring("body", F.col("chunk") * CHUNK_BYTES + 1, F.lit(CHUNK_BYTES)).alias("part"))

    def records(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        record, running, length = "", hashlib.sha1(), 0
        for batch in rows:
            made: list[list] = [[] for _ in _NAMES]
            columns = [batch.column(i).to_pylist() for i in range(6)]
            for page, link, sha, size, newest, number, part in zip(*columns, batch.column(6)):
                revisit = newest is not None
                content = part.as_py()
                if number == 0:
                    record, running, length = str(uuid.uuid4()), hashlib.sha1(), 0
                running.update(content)
                length += len(content)
                last = length == size
                if last and not revisit and running.digest() != sha:
                    raise ValueError(f"payload of page {page} changed while it was written")
                if number == 0:
                    content = header(record, page, link, sha, size, newest, revisit, date) + (b"" if revisit else content)
                whole = last or revisit
                row = (record, number, whole, content + END * whole, 0 if revisit else length, hashlib.sha1().digest() if revisit else running.digest())
                for column, value in zip(made, row):
                    column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(made, _KINDS)], _NAMES)

    cut.unionByName(empty).mapInArrow(records, _TABLE).write.parquet(path)
    discard(revisits)
    return path


def parse_header(content: bytes) -> tuple[dict[str, str], dict[str, str], int]:
    """WARC fields, HTTP fields and where the payload begins."""
    stop = content.index(END)
    lines = content[:stop].decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError("not a WARC record")
    end = content.index(END, stop + 4)
    http = content[stop + 4 : end].decode().split("\r\n")
    fields = [dict(x.split(": ", 1) for x in some[1:]) for some in (lines, http)]
    return fields[0], fields[1], end + 4


def read(spark: SparkSession, path: str, key: str = "page_id") -> DataFrame:
    """One row per record, parsed from the archive: ``key``, ``payload_bytes``, ``payload_digest``, ``record_type``, ``refers_to``.

    Records of several chunks are sorted by chunk and streamed, with one chunk in memory.
    """
    names = ["k", "payload_bytes", "payload_digest", "record_type", "refers_to"]

    def parse(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fields, http, record, number, left, running = {}, {}, "", 0, 0, hashlib.sha1()
        for batch in rows:
            made: list[list] = [[] for _ in names]
            columns = [batch.column(i).to_pylist() for i in (0, 1, 2, 5)]
            for name, chunk, last, so_far, cell in zip(*columns, batch.column(3)):
                content = memoryview(cell.as_buffer())
                if chunk == 0:
                    fields, http, at = parse_header(bytes(content))
                    record, number, running = name, 0, hashlib.sha1()
                    left = int(http["Content-Length"]) if fields["WARC-Type"] == "response" else 0
                    content = content[at:]
                elif name != record or chunk != number + 1:
                    raise ValueError(f"record {name} lacks chunk {number + 1}")
                if last:
                    if content[-4:] != END:
                        raise ValueError(f"record {name} does not end")
                    content = content[:-4]
                number = chunk
                running.update(content)
                left -= len(content)
                if running.digest() != so_far or last and left:
                    raise ValueError(f"record {name} is damaged at chunk {chunk}")
                if last:
                    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                    if fields["WARC-Type"] == "response" and base64.b32encode(running.digest()).decode() != digest:
                        raise ValueError(f"record {name} has another payload than its header says")
                    page, older = fields.get("X-Page-ID"), fields.get("X-Refers-To-Page-ID")
                    row = (page and int(page), int(http["Content-Length"]), digest, fields["WARC-Type"], older and int(older))
                    for column, value in zip(made, row):
                        column.append(value)
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(made, kinds)], names)

    table = spark.read.schema(_TABLE).parquet(path)
    single = table.where("chunk_no = 0 and last")
    several = table.where("not (chunk_no = 0 and last)").repartition("record_id").sortWithinPartitions("record_id", "chunk_no")
    shape = "k long, payload_bytes long, payload_digest string, record_type string, refers_to long"
    return single.mapInArrow(parse, shape).unionByName(several.mapInArrow(parse, shape)).withColumnRenamed("k", key)
