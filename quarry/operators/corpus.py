"""Per-class corpora built from the fixture tables, their union, filters
and data checks.

news = ``documents``; email = ``conversations`` (subject = role, message =
text); contract = ``pages`` with tags removed; invoice = rendered invoices
(synthetic). All are per-row projections; the union is ``unionByName`` with
missing columns null-filled (no shuffle).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions import text as tx
from ..sources.tables import table


def news_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", "text", F.col("lang").alias("label"), F.lit("news").alias("doc_type"))


def email_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations")
    return c.select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("doc_id"),
        F.col("role").alias("subject"), F.col("text").alias("message"),
        tx.concat_fields("role", "text").alias("text"),
        F.lit("email").alias("doc_type"),
    )


def contract_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "pages")
    body = F.regexp_replace("html", "<[^>]*>", " ")
    text = tx.py_strip(tx.collapse_horizontal(tx.html_space_clean(body)))
    return p.select(F.col("page_id").alias("doc_id"), text.alias("text"), F.lit("contract").alias("doc_type"))


def merged_corpus(spark: SparkSession, sf_dir: str, with_invoices: bool = False) -> DataFrame:
    parts = [
        news_corpus(spark, sf_dir).select("doc_type", "doc_id", "text"),
        email_corpus(spark, sf_dir).select("doc_type", "doc_id", "text"),
        contract_corpus(spark, sf_dir).select("doc_type", "doc_id", "text"),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    out = out.withColumn("is_synthetic", F.lit(None).cast("boolean"))
    if with_invoices:
        from ..sources.invoices import invoices
        inv = invoices(spark, sf_dir).select(
            F.lit("invoice").alias("doc_type"), "doc_id", "text", F.lit(True).alias("is_synthetic"))
        out = out.unionByName(inv, allowMissingColumns=True)
    return out


def filter_max_words(df: DataFrame, limits=None) -> DataFrame:
    limits = limits or fixed.MAX_WORDS_BY_CLASS
    nw = tx.n_words("text")
    cond = F.lit(True)
    for cls, lim in limits.items():
        cond = cond & ((F.col("doc_type") != cls) | (nw <= lim))
    return df.where(cond)


def quarantine(df: DataFrame, text: str = "text") -> DataFrame:
    """Reason per row: unreadable (null), empty, needs_ocr (< 40 chars);
    null reason = good row."""
    s = tx.py_strip(F.col(text))
    reason = (F.when(F.col(text).isNull(), "unreadable").when(s == "", "empty")
              .when(~tx.enough_text(text), "needs_ocr"))
    return df.withColumn("reason", reason)


def dataset_checks(sets: dict[str, DataFrame]) -> DataFrame:
    """Per dataset: rows, columns, blank texts, duplicate texts, labels."""
    from .profile import text_key
    out = None
    for name, df in sets.items():
        blank = tx.py_strip(F.coalesce(F.col("text"), F.lit(""))) == ""
        row = df.agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.count_if(blank).alias("n_blank"),
            (F.count(F.lit(1)) - F.count_distinct(text_key("text"))).alias("n_duplicates"),
            F.count_distinct("label").alias("n_labels"),
        ).select(F.lit(name).alias("dataset"), "n_rows", F.lit(len(df.columns)).alias("n_columns"),
                 "n_blank", "n_duplicates", "n_labels")
        out = row if out is None else out.unionByName(row)
    return out
