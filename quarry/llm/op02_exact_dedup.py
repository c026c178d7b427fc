"""Exact dedup against a persistent digest index.

``DigestIndex`` is a table of the digests seen so far, bucketed and sorted by
digest. ``ingest`` normalises and hashes the new rows, reduces them to one
row per digest with map-side combining (a text repeated a billion times sends
one row per task), drops the digests that the index already holds by a
sort-merge anti-join in which the index side needs neither shuffle nor sort,
and appends the rest to the index.

The decisions join every row with its digest's entry. An entry that covers
more than 1/1000 of the rows is hot; there are fewer than 1000 such entries,
whatever the input, and they are broadcast. The other entries go through a
sort-merge join in which no key holds more than 1/1000 of the rows.

Defined cases: a null text counts as empty; texts are equal when identical
after lower-casing A-Z; the row with the largest id stays (``keep="max"``;
a null id is smaller than any other). Rows repeated with the same id are one
document: each of them carries the same decision. An empty table gives an
empty result. Extra columns are ignored, whatever their names.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import NULL_ID, ascii_lower, cut, key_text, n_buckets, restore_id

HOT_SHARE = 1000


class DigestIndex:
    """Digests seen so far: (digest binary, keep_id long, group_size long),
    bucketed and sorted by digest in a folder that outlives the session."""

    SCHEMA = "digest BINARY, keep_id BIGINT, group_size BIGINT"

    def __init__(self, spark: SparkSession, path: str | None = None, buckets: int | None = None):
        self.spark = spark
        self.path = path or scratch_path(spark, f"digest-index-{uuid.uuid4().hex}")
        self.buckets = buckets or n_buckets(spark, 0, 1)
        self.table = f"digest_index_{uuid.uuid4().hex}"
        # An existing folder is taken over as it is; otherwise it is empty.
        spark.sql(f"CREATE TABLE {self.table} ({self.SCHEMA}) USING parquet CLUSTERED BY (digest) "
                  f"SORTED BY (digest) INTO {self.buckets} BUCKETS LOCATION '{self.path}'")

    def rows(self) -> DataFrame:
        return self.spark.table(self.table)

    def ingest(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """Append the texts not seen before; return one row per row of
        ``docs``: (doc_id, keep_id, group_size, kept, text_sha256). A text
        that the index held before keeps its former row."""
        hashed = cut(
            key_text(docs, id_col, text_col)
            .select("doc_id", F.unhex(F.sha2(ascii_lower("text"), 256)).alias("digest")), "digests")
        groups = hashed.groupBy("digest").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
        fresh = groups.repartition(self.buckets, "digest").join(
            self.rows().select("digest").hint("merge"), "digest", "left_anti")
        (fresh.select("digest", "keep_id", "group_size").sortWithinPartitions("digest")
         .write.format("parquet").mode("append").insertInto(self.table))
        self.spark.catalog.refreshTable(self.table)
        return decide(hashed, self.rows())

    def drop(self) -> None:
        """Forget the table's name; the files stay."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")


def decide(hashed: DataFrame, entries: DataFrame) -> DataFrame:
    """Join every row with its entry: hot entries by broadcast (fewer than
    HOT_SHARE of them by construction), the others by sort-merge."""
    total = hashed.count()
    hot = entries.where(F.col("group_size") * HOT_SHARE > total)
    cold = entries.where(F.col("group_size") * HOT_SHARE <= total)
    marked = hashed.join(F.broadcast(hot), "digest", "left")
    out = marked.where(F.col("keep_id").isNotNull()).unionByName(
        marked.where(F.col("keep_id").isNull()).select("doc_id", "digest").join(cold.hint("merge"), "digest"))
    return out.select(
        restore_id(), restore_id("keep_id"), "group_size",
        (F.col("doc_id") == F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"))


def exact_dedup(docs: DataFrame, index: DigestIndex | None = None, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """Decisions for every row against a fresh index, or a given one."""
    return (index or DigestIndex(docs.sparkSession)).ingest(docs, id_col, text_col)


def keep_rows(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, all columns as they are. Repeated rows
    with one id and text are one document and stay once."""
    kept = exact_dedup(docs).where("kept").select(
        F.coalesce("doc_id", F.lit(NULL_ID)).alias("_id"), "text_sha256").distinct()
    text = F.coalesce(F.col("text"), F.lit(""))
    keyed = docs.withColumns({"_id": F.coalesce(F.col("doc_id"), F.lit(NULL_ID)),
                              "_sha": F.sha2(ascii_lower(text), 256)})
    return (keyed.join(kept, (keyed["_id"] == kept["_id"]) & (keyed["_sha"] == kept["text_sha256"]), "left_semi")
            .dropDuplicates(["_id", "_sha"]).select(*docs.columns))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"))


SQL = """
WITH d AS (SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256 FROM documents),
g AS (SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY 1)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, d.text_sha256
FROM d JOIN g USING (text_sha256)
"""
