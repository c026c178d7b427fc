"""WARC archives: writer, and a sequential reader.

Writing: ``revisit_of`` finds the records whose payload another record
already holds (one digest per record, map-side combining, hot digests by a
broadcast of fewer than 1000 entries), then each task frames its rows as WARC
records, one gzip member per record, and closes an archive after about
``ARCHIVE_BYTES``. Archive names follow from the partition and a counter, and
a file appears by renaming, so a task that runs again after a lost executor
replaces its own files. In a folder that all machines mount (``file:``) the
archives are plain ``.warc.gz`` files; in any other store Spark writes the
same bytes as rows (name, content), since only Spark's writers reach it.

Reading: ``read_records`` goes through an archive in order. A member is
inflated in steps of ``CHUNK`` bytes; the header ends at the blank line, the
block is exactly Content-Length bytes and is followed by two line ends and
the member's end; the block digest, and a response's payload digest, are
computed on the way and compared with the header.

Defined cases: a null payload counts as empty; a null url is left out of the
header and reads back as null; a null id reads back as null and counts as the
smallest id. Of equal payloads of at least ``min_bytes`` bytes the record
with the smallest id is the response and the others are revisits; rows that
repeat an id and payload are the same record and have the same type. A block
that breaks its framing or digest gives a row with ``verified`` false and the
reason in ``error``; reading of that archive ends at a broken frame. Empty
tables give no archive and no row. Extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import os
import uuid
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import NULL_ID, cut, restore_id, small_batches

ARCHIVE_BYTES = 8 << 20
CHUNK = 64 << 10
HOT_SHARE = 1000
END = b"\r\n"
DATE = "2000-01-01T00:00:00Z"     # archives of the same rows are the same bytes
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


# ---------------------------------------------------------------- writing

def frame(kind: str, record_id: str, block: bytes, fields: dict[str, str]) -> bytes:
    """One record as one gzip member."""
    head = {"WARC-Type": kind, "WARC-Record-ID": f"<{record_id}>", "WARC-Date": DATE, **fields,
            "WARC-Block-Digest": "sha1:" + base32_sha1(block), "Content-Length": str(len(block))}
    lines = [b"WARC/1.1"] + [f"{k}: {v}".encode() for k, v in head.items()]
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(END.join(lines) + END + END + block + END + END) + z.flush()


def page_record(page: int, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """A response with its payload, or a revisit: the HTTP header alone, whose
    Content-Length still tells the payload's size."""
    http = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "
            + str(len(payload)).encode() + END + END)
    fields = {"WARC-Payload-Digest": "sha1:" + base32_sha1(payload),
              "Content-Type": "application/http; msgtype=response"}
    if url is not None:
        fields["WARC-Target-URI"] = "".join(url.split())
    if refers_to is None:
        return frame("response", f"urn:page:{page}", http + payload, fields)
    return frame("revisit", f"urn:page:{page}", http,
                 fields | {"WARC-Profile": PROFILE, "WARC-Refers-To": f"<urn:page:{refers_to}>"})


def revisit_of(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """(page_id, digest, refers_to) of the records that revisit another."""
    digests = cut(pages.where(F.octet_length("payload") >= min_bytes).select("page_id", "digest"), "warc-digests")
    total = digests.count()
    groups = digests.groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.count("*").alias("n")).where("n > 1")
    groups = cut(groups, "warc-groups")
    hot = groups.where(F.col("n") * HOT_SHARE > total)          # fewer than HOT_SHARE rows
    cold = groups.where(F.col("n") * HOT_SHARE <= total)
    both = (digests.join(F.broadcast(hot), "digest").unionByName(digests.join(cold.hint("merge"), "digest")))
    return cut(both.where("page_id != refers_to").select("page_id", "digest", "refers_to").distinct(), "warc-revisits")


def local_folder(folder: str) -> str | None:
    """The mounted folder that a path names, or None for any other store."""
    if folder.startswith("file:"):
        return "/" + folder[5:].lstrip("/")
    return folder if "://" not in folder and not folder.startswith("hdfs:") else None


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url",
                   payload_col: str = "html", min_bytes: int = 0, archive_bytes: int = ARCHIVE_BYTES) -> None:
    """Write every row of ``pages`` as a record of the archives in ``folder``."""
    small_batches(pages.sparkSession)
    rows = pages.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID)).alias("page_id"),
                        F.col(url_col).cast("string").alias("url"),
                        F.coalesce(F.col(payload_col).cast("string"), F.lit("")).alias("payload"))
    rows = rows.withColumn("digest", F.unhex(F.sha1("payload")))
    refs = revisit_of(rows, min_bytes)
    rows = rows.join(refs, ["page_id", "digest"], "left").drop("digest")
    mount = local_folder(folder)

    def archives(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, count, buf, size = TaskContext.get().partitionId(), 0, [], 0

        def close():
            nonlocal count, buf, size
            name, content = f"part-{part:06d}-{count:06d}.warc.gz", b"".join(buf)
            count, buf, size = count + 1, [], 0
            if mount:
                os.makedirs(mount, exist_ok=True)
                own = f"{mount}/.{name}.{uuid.uuid4().hex}"
                with open(own, "wb") as f:
                    f.write(content)
                os.replace(own, f"{mount}/{name}")
            return pa.RecordBatch.from_pydict(
                {"name": pa.array([name]), "size": pa.array([len(content)], pa.int64()),
                 "content": pa.array([None if mount else content], pa.binary())})

        for batch in batches:
            for page, url, payload, ref in zip(*(batch.column(c) for c in ("page_id", "url", "payload", "refers_to"))):
                if not buf:
                    buf.append(frame("warcinfo", f"urn:archive:{part}-{count}", b"software: quarry\r\n",
                                     {"Content-Type": "application/warc-fields"}))
                buf.append(page_record(page.as_py(), url.as_py(), payload.as_buffer().to_pybytes(), ref.as_py()))
                size += len(buf[-1])
                if size >= archive_bytes:
                    yield close()
        if buf:
            yield close()

    written = rows.select("page_id", "url", "payload", "refers_to").mapInArrow(
        archives, "name string, size long, content binary")
    written.write.parquet(f"{folder}/_index" if mount else f"{folder}/rows")


# ---------------------------------------------------------------- reading

class BrokenRecord(ValueError):
    """The archive does not go on as the format says."""


def chunks_of(content) -> Iterator[memoryview]:
    view = memoryview(content)
    for i in range(0, len(view), CHUNK):
        yield view[i:i + CHUNK]


def members(chunks: Iterable) -> Iterator[tuple[int, Iterator[bytes]]]:
    """(offset, inflated steps) of each gzip member. A member must be read to
    its end before the next one is asked for."""
    source, rest, at = iter(chunks), b"", 0

    def steps():
        nonlocal rest, at
        z = zlib.decompressobj(31)
        while not z.eof:
            if z.unconsumed_tail:
                data = z.unconsumed_tail
            else:
                if not len(rest):
                    rest = next(source, b"")
                    at += len(rest)
                data, rest = rest, b""
                if not len(data):
                    raise BrokenRecord("the archive ends inside a member")
            try:
                yield z.decompress(data, CHUNK)
            except zlib.error as e:
                raise BrokenRecord(f"not a gzip member: {e}") from e
        rest = z.unused_data

    while True:
        if not rest:
            rest = bytes(next(source, b""))
            at += len(rest)
            if not rest:
                return
        yield at - len(rest), steps()


def record(steps: Iterator[bytes]) -> tuple[dict[str, str], bytes]:
    """Header fields (names in lower case) and block of one member."""
    buf = bytearray()
    for s in steps:
        buf += s
        if (cut_at := buf.find(b"\r\n\r\n")) >= 0:
            break
    else:
        raise BrokenRecord("no end of the header")
    lines = bytes(buf[:cut_at]).decode("utf-8", "replace").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise BrokenRecord("no WARC version line")
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    if not fields.get("content-length", "").isdigit():
        raise BrokenRecord("no content length")
    size = int(fields["content-length"])
    del buf[:cut_at + 4]
    for s in steps:
        buf += s
        if len(buf) > size + 4:
            raise BrokenRecord("the block is longer than its content length")
    if len(buf) != size + 4 or buf[size:] != b"\r\n\r\n":
        raise BrokenRecord("the block does not end at its content length")
    return fields, bytes(buf[:size])


def http_parts(block: bytes) -> tuple[int | None, bytes]:
    """Content length that the HTTP header tells, and the body."""
    head, _, body = block.partition(b"\r\n\r\n")
    for line in head.split(b"\r\n")[1:]:
        k, _, v = line.partition(b":")
        if k.strip().lower() == b"content-length" and v.strip().isdigit():
            return int(v), body
    return None, body


def checked(fields: dict[str, str], block: bytes) -> dict:
    """Row of one record; its digests are computed anew."""
    kind, error = fields.get("warc-type", ""), None
    told = fields.get("warc-payload-digest", "").removeprefix("sha1:") or None
    if (d := fields.get("warc-block-digest")) and d.removeprefix("sha1:") != base32_sha1(block):
        error = "block digest differs"
    size, payload = http_parts(block) if kind in ("response", "revisit") else (len(block), block)
    if kind == "response":
        if told and told != base32_sha1(payload):
            error = error or "payload digest differs"
        if size is not None and size != len(payload):
            error = error or "payload size differs"
    return {"record_type": kind, "record_id": fields.get("warc-record-id", "").strip("<>"),
            "target_uri": fields.get("warc-target-uri"), "refers_to": (fields.get("warc-refers-to") or "").strip("<>") or None,
            "payload_digest": told, "payload_bytes": size, "payload": payload if kind == "response" else None,
            "verified": error is None, "error": error}


RECORD = ("archive string, member_offset long, record_type string, record_id string, target_uri string, "
          "refers_to string, payload_digest string, payload_bytes long, payload binary, verified boolean, error string")
NAMES = [x.split()[0] for x in RECORD.split(", ")]
TYPES = {"member_offset": pa.int64(), "payload_bytes": pa.int64(), "payload": pa.binary(), "verified": pa.bool_()}


def archive_rows(name: str, chunks: Iterable) -> Iterator[dict]:
    begin = 0
    try:
        for begin, steps in members(chunks):
            yield {"archive": name, "member_offset": begin, **checked(*record(steps))}
    except BrokenRecord as e:
        yield dict.fromkeys(NAMES) | {"archive": name, "member_offset": begin, "verified": False, "error": str(e)}


def read_records(spark: SparkSession, folder: str) -> DataFrame:
    """Every record of the archives in ``folder``, checked."""
    if local_folder(folder):
        files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz").load(folder)
                 .select(F.element_at(F.split("path", "/"), -1).alias("name"), "content"))
    else:
        files = spark.read.schema("name string, size long, content binary").parquet(f"{folder}/rows").select("name", "content")

    def read(batches):
        for batch in batches:
            for name, content in zip(batch.column(0), batch.column(1)):
                out, size = [], 0
                for row in archive_rows(name.as_py(), chunks_of(content.as_buffer())):
                    out.append(row)
                    size += len(row["payload"] or b"")
                    if size > 4 << 20:
                        yield as_batch(out)
                        out, size = [], 0
                if out:
                    yield as_batch(out)

    return files.mapInArrow(read, RECORD)


def as_batch(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([r[c] for r in rows], TYPES.get(c, pa.string())) for c in NAMES], names=NAMES)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, f"warc-{uuid.uuid4().hex}")
    write_archives(spark.read.parquet(f"{sf_dir}/pages.parquet"), folder)
    page = lambda c: F.element_at(F.split(c, ":"), -1).cast("long")
    rec = read_records(spark, folder).where("error IS NOT NULL OR record_type IN ('response', 'revisit')")
    ok = F.when(F.col("verified"), F.col("payload_digest")).otherwise(
        F.raise_error(F.concat_ws(" ", "archive", "member_offset", "error")))
    return (rec.select(page("record_id").alias("page_id"), "payload_bytes", ok.alias("payload_digest"),
                       "record_type", page("refers_to").alias("refers_to"))
            .withColumns({"page_id": restore_id("page_id"), "refers_to": restore_id("refers_to")}))


SQL = """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages),
m AS (SELECT h, min(page_id) AS first_id FROM p GROUP BY h)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           1 + ((CAST('0x' || substr(h, 1 + 5 * (i // 4), 5) AS INTEGER) >> CAST(15 - 5 * (i % 4) AS INTEGER)) & 31), 1)),
           '') AS payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM p JOIN m USING (h)
"""
