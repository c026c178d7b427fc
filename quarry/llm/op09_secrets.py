"""Secret scan with structural confirmation.

Three pattern kinds report by their pattern alone: ``assign`` (a named value),
``access`` (access key ids) and ``hex`` (long hex runs). Two more kinds are
reported only after their candidate has been decoded and its structure holds:

* ``jwt``: three dot-separated base64url parts, whatever they begin with, whose
  first decodes to a JSON object with an ``alg`` and whose second decodes to a
  JSON object;
* ``key``: a PEM block (line ends may be escaped, as in JSON), or a bare base64,
  base64url or hex run, that decodes to a private key: DER whose nested lengths
  fill their parents exactly and whose fields are those of an RSA, EC, DSA or
  wrapped private key, or the length-prefixed strings of an OpenSSH private
  key; or a PEM block with encryption headers whose body is whole cipher blocks
  of the length of its initial vector.

Every text is scanned whole in its task; nothing is shuffled. Spans are code
points, end exclusive.

Defined cases: a null or empty text has no span; repeated rows are scanned
each for itself; a null id stays null. An empty table gives an empty result.
Extra columns are ignored.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import key_text, restore_id

KINDS = ["assign", "access", "hex", "jwt", "key"]
BASE = KINDS[:3]
RANK = {k: i for i, k in enumerate(KINDS)}

# The base patterns and their least lengths.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")      # whole runs of 24 and more
LEAST = {"assign": 6, "access": 20}

# looks ahead, so that any part of a dotted name may begin a token
JWT = re.compile(r"(?<![A-Za-z0-9_-])(?=([A-Za-z0-9_-]{8,})\.([A-Za-z0-9_-]+)\.([A-Za-z0-9_-]*))")
PEM = re.compile(r"-----BEGIN (?:[A-Z0-9]+ )*PRIVATE KEY-----((?:[^-]|-(?!----))*)-----END (?:[A-Z0-9]+ )*PRIVATE KEY-----")
DEK = re.compile(r"\s*Proc-Type:\s*4,ENCRYPTED\s+DEK-Info:\s*[A-Z0-9-]+,([0-9A-Fa-f]+)\s+(.*)", re.DOTALL)
RUN = re.compile(r"(?<![A-Za-z0-9+/])[A-Za-z0-9+/]{40,}={0,2}")
URL_RUN = re.compile(r"(?<![A-Za-z0-9_-])[A-Za-z0-9_-]{40,}={0,2}")
OPENSSH_HEAD = "b3BlbnNzaC1rZXktdjE"


def base_spans(text: str) -> list[tuple[int, str, int]]:
    """(start, kind, end) of the pattern kinds, leftmost and non-overlapping."""
    out = []
    if ":" in text or "=" in text:
        out += [(m.start(), "assign", m.end()) for m in ASSIGN.finditer(text)
                if m.end(2) - m.start(2) >= LEAST["assign"]]
    if "AKIA" in text:
        out += [(m.start(), "access", m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST["access"]]
    out += [(m.start(), "hex", m.end()) for m in HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[0], RANK[s[1]]))


# ------------------------------------------------------- structures

def unbase64(s: str, urlsafe: bool = False) -> bytes | None:
    s = s.rstrip("=")
    try:
        return base64.b64decode(s + "=" * (-len(s) % 4), altchars=b"-_" if urlsafe else None, validate=True)
    except (binascii.Error, ValueError):
        return None


def tlv(data: bytes, at: int, end: int) -> tuple[int, int, int] | None:
    """(tag, start, end) of the DER value at ``at``, if it fits."""
    if at + 2 > end:
        return None
    tag, n, at = data[at], data[at + 1], at + 2
    if n & 0x80:
        k = n & 0x7F
        if not 1 <= k <= 4 or at + k > end:
            return None
        n, at = int.from_bytes(data[at:at + k], "big"), at + k
        if n < 0x80:
            return None
    return (tag, at, at + n) if at + n <= end else None


def fields(data: bytes, start: int, end: int) -> list[tuple[int, int, int]] | None:
    """The values that fill [start, end) exactly."""
    out = []
    while start < end:
        if not (v := tlv(data, start, end)):
            return None
        out.append(v)
        start = v[2]
    return out


def private_der(data: bytes) -> bool:
    """An RSA, DSA, EC or wrapped (plain or encrypted) private key in DER."""
    outer = tlv(data, 0, len(data))
    if not outer or outer[0] != 0x30 or outer[2] != len(data):
        return False
    inner = fields(data, outer[1], outer[2])
    if not inner or len(inner) < 2:
        return False
    tags = [t for t, _, _ in inner]
    if tags[0] == 0x30 and tags == [0x30, 0x04]:                       # encrypted: algorithm, octets
        algorithm = fields(data, inner[0][1], inner[0][2])
        return bool(algorithm) and algorithm[0][0] == 0x06
    if tags[0] != 0x02:
        return False
    version = int.from_bytes(data[inner[0][1]:inner[0][2]], "big")
    if len(tags) >= 9 and set(tags[:9]) == {0x02} and version in (0, 1):   # RSA
        return True
    if len(tags) == 6 and set(tags) == {0x02} and version == 0:           # DSA
        return True
    if version == 1 and tags[1] == 0x04 and all(t in (0xA0, 0xA1) for t in tags[2:]):   # EC
        return True
    if version in (0, 1) and tags[1:3] == [0x30, 0x04]:                    # algorithm, then the key in octets
        algorithm = fields(data, inner[1][1], inner[1][2])
        return bool(algorithm) and algorithm[0][0] == 0x06
    return False


def openssh(data: bytes) -> bool:
    """openssh-key-v1: cipher, kdf, options, key count, public and private parts."""
    magic = b"openssh-key-v1\0"
    if not data.startswith(magic):
        return False
    at = len(magic)

    def string():
        nonlocal at
        n = int.from_bytes(data[at:at + 4], "big")
        if at + 4 + n > len(data):
            return False
        at += 4 + n
        return True

    if not (string() and string() and string()) or at + 4 > len(data):
        return False
    count = int.from_bytes(data[at:at + 4], "big")
    at += 4
    return 1 <= count <= 16 and all(string() for _ in range(count + 1)) and at == len(data)


def private_key(data: bytes | None) -> bool:
    return bool(data) and (private_der(data) or openssh(data))


def signed_token(head: str, body: str) -> bool:
    try:
        h, b = (json.loads(unbase64(x, True) or b"") for x in (head, body))
    except (ValueError, RecursionError):
        return False
    return isinstance(h, dict) and isinstance(h.get("alg"), str) and isinstance(b, dict)


def pem_body(body: str) -> bool:
    """Does the inside of a PEM block decode to a private key?"""
    body = body.replace("\\r", "").replace("\\n", "\n")
    if m := DEK.fullmatch(body):
        block, data = len(m[1]) // 2, unbase64("".join(m[2].split()))
        return block in (8, 16) and bool(data) and len(data) % block == 0
    return private_key(unbase64("".join(body.split())))


def confirmed_spans(text: str) -> list[tuple[int, str, int]]:
    """(start, kind, end) of what decodes to a signed token or private key."""
    out = []
    if "." in text:
        # the first characters of a header are white space or the opening brace
        out += [(m.start(1), "jwt", m.end(3)) for m in JWT.finditer(text)
                if (unbase64(m[1][:4], True) or b"x").lstrip()[:1] in (b"{", b"") and signed_token(m[1], m[2])]
    pem = [(m.start(), "key", m.end()) for m in (PEM.finditer(text) if "PRIVATE KEY-----" in text else ()) if pem_body(m[1])]
    out += pem
    seen = {a: b for a, _, b in pem}
    # DER starts with a sequence (0x30 as base64 "M", hex "30"); OpenSSH with its magic
    for m in RUN.finditer(text):
        run = m[0]
        if run[0] == "M" or run.startswith(OPENSSH_HEAD):
            if private_key(unbase64(run)):
                seen.setdefault(m.start(), m.end())
        elif run[:2] == "30" and len(run) % 2 == 0 and re.fullmatch(r"[0-9a-fA-F]+", run):
            if private_key(bytes.fromhex(run)):
                seen.setdefault(m.start(), m.end())
    for m in URL_RUN.finditer(text):
        run = m[0]
        if ("-" in run or "_" in run) and (run[0] == "M" or run.startswith(OPENSSH_HEAD)) and private_key(unbase64(run, True)):
            seen.setdefault(m.start(), m.end())
    # bare runs inside a block are the block's
    last = 0
    blocks = {a for a, _, _ in pem}
    for a, b in sorted(seen.items()):
        if a in blocks:
            last = b
        elif a >= last:
            out.append((a, "key", b))
    return out


def spans(text: str) -> list[tuple[int, str, int]]:
    """All spans of a text by start, then kind as listed in KINDS."""
    return sorted(base_spans(text) + confirmed_spans(text), key=lambda s: (s[0], RANK[s[1]]))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, spans array<struct<start, kind, end>>) of every row."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.string()), ("end", pa.int64())]))
        for b in batches:
            found = [[{"start": s, "kind": k, "end": e} for s, k, e in spans(x.as_py())] for x in b.column("text")]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(found, t)], names=["doc_id", "spans"])

    out = key_text(docs, id_col, text_col).mapInArrow(
        task, "doc_id long, spans array<struct<start: long, kind: string, end: long>>")
    return out.select(restore_id(), "spans")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    joined = lambda a: F.array_join(F.transform(
        a, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    return found.select(
        "doc_id", *[count(k) for k in BASE],
        F.sha2(joined(F.filter("spans", lambda s: s["kind"].isin(BASE))), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"), *[count(k) for k in KINDS[3:]])


SQL = None
