import base64
import hashlib
import os

import pytest
from pyspark.sql import functions as F

from quarry.llm import op05_warc as op

ROWS = [(1, "http://a", "<p>x</p>"), (2, "http://b", "<p>x</p>"), (3, None, None), (4, "u", ""), (5, "u", "é" * 400_000),
        (6, "http://c d", "WARC/1.1\r\n\r\nContent-Length: 3\r\n\r\n"), (None, "n", "null id"), (8, "z", "null id"),
        (9, "r", "again"), (9, "r", "again")]
SCHEMA = "page_id long, url string, html string"


def brute(rows):
    low = lambda i: -2 ** 63 if i is None else i
    out = []
    for i, _, h in rows:
        b = (h or "").encode()
        first = min((j for j, _, g in rows if (g or "") == (h or "")), key=low)
        out.append((i, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(),
                    "response" if i == first else "revisit", None if i == first else first))
    return sorted(out, key=str)


def got(df):
    return sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in df.collect()), key=str)


def test_query_against_brute_force(spark, tmp_path):
    rows = ROWS + [(100 + i, "u", f"page {i % 7}") for i in range(60)]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(1) for c in ("digest", "refers_to", "payload")})
    df.repartition(3).write.parquet(f"{tmp_path}/pages.parquet")
    assert got(op.query(spark, str(tmp_path))) == brute(rows)


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/pages.parquet")
    assert op.query(spark, str(tmp_path)).count() == 0


def test_small_archives_round_trip_and_min_bytes(spark, tmp_path):
    df = spark.createDataFrame(ROWS[:6] * 1, SCHEMA).coalesce(1)
    op.write_archives(df, str(tmp_path / "w"), archive_bytes=1, min_bytes=1)
    assert len([x for x in os.listdir(tmp_path / "w") if x.endswith(".warc.gz")]) == 6
    rec = {r.record_id: r for r in op.read_records(spark, str(tmp_path / "w")).collect()}
    assert bytes(rec["urn:page:5"].payload).decode() == "é" * 400_000
    assert rec["urn:page:2"].record_type == "revisit" and rec["urn:page:2"].payload_bytes == 8
    assert rec["urn:page:4"].record_type == "response" and rec["urn:page:3"].target_uri is None
    assert all(r.verified for r in rec.values())


def test_store_without_mount_holds_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(op, "local_folder", lambda f: None)
    df = spark.createDataFrame(ROWS[:6], SCHEMA)
    op.write_archives(df, str(tmp_path / "w"))
    assert op.read_records(spark, str(tmp_path / "w")).where("record_type <> 'warcinfo'").count() == 6


def member(n=1):
    return op.page_record(n, "u", b"payload", None)


@pytest.mark.parametrize("bad, reason", [
    (member()[:-9], "ends inside"), (b"junk" + member(), "not a gzip"),
    (op.frame("response", "r", b"HTTP/1.1 200 OK\r\n\r\nx", {"WARC-Payload-Digest": "sha1:AAAA"}), "payload digest"),
])
def test_faults_are_reported(bad, reason):
    rows = list(op.archive_rows("a", op.chunks_of(member(0) + bad)))
    assert rows[0]["verified"] and not rows[1]["verified"] and reason in rows[1]["error"]


def test_members_across_tiny_chunks():
    data = b"".join(member(i) for i in range(5))
    rows = list(op.archive_rows("a", (data[i:i + 3] for i in range(0, len(data), 3))))
    assert [r["record_id"] for r in rows] == [f"urn:page:{i}" for i in range(5)] and all(r["verified"] for r in rows)
    assert rows[1]["member_offset"] == len(member(0))
