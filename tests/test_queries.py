"""Registered queries against their DuckDB oracles on sf0.001, the entry
smoke test, scale-safe operators, and the scoring override."""

import math

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from quarry.sources.tables import TABLES

from helpers import SF001

FAST = ["field_recall", "extract_from_text", "find_date", "largest_monetary", "value_counts", "describe",
        "null_profile", "duplicate_rate", "top_words_by_label", "dedup_keep_first", "show_all_duplicates",
        "sequence_id", "stratified_split", "vocabulary", "tfidf", "classification_report", "confusion_matrix",
        "clean_for_classifier", "gold_json_flat", "length_histogram", "extract_from_words", "right_of_join",
        "read_csv", "stream_extract"]


def norm(v):
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    return v


def rows(cols, data):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(norm(r[i]) for i in order) for r in data), key=lambda t: tuple(map(str, t)))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return c


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", FAST)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF001)
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    res = con.execute(E.oracle_sql()[name])
    want = rows([d[0] for d in res.description], res.fetchall())
    assert got == want


def test_entry(spark):
    df = E.entry(spark)
    out = {r["field"]: r for r in df.collect()}
    assert set(out) == {"invoice_number", "invoice_date", "due_date", "issuer", "recipient", "total"}
    # the text rules miss the total of layout 1 and the due date of layout 2 only
    from quarry.sources.invoices import invoices
    n = {r["layout"]: r["count"] for r in invoices(spark, SF001).groupBy("layout").count().collect()}
    assert out["total"]["hits"] == sum(n.values()) - n[1] and out["due_date"]["hits"] == sum(n.values()) - n[2]


def test_dedup_keeps_lowest_id_under_heavy_duplication(spark):
    df = spark.range(3000).select(F.col("id").alias("doc_id"),
                                  F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("text"))
    from quarry.operators.dedup import dedup_keep_first
    out = dedup_keep_first(df, "text", "doc_id")
    hot = out.where("text = 'hot'").collect()[0]
    assert hot["doc_id"] == 0 and hot["n_copies"] == 1000 and out.count() == 2001


def test_stratified_split_is_exact(spark):
    from quarry.operators.features import stratified_split
    df = spark.range(1000).select(F.col("id").alias("doc_id"), (F.col("id") % 4).cast("string").alias("label"))
    s = stratified_split(df, "label", "doc_id")
    counts = {(r["label"], r["split"]): r["count"] for r in s.groupBy("label", "split").count().collect()}
    assert all(counts[(str(k), "train")] == 175 for k in range(4))
    assert sum(counts.values()) == 1000


def test_invoice_override(spark):
    from quarry.operators.train import invoice_override
    df = spark.createDataFrame([(1, "news", 0.9, {"news": 0.9, "invoice": 0.05}, 4),
                                (2, "news", 0.9, {"news": 0.9, "invoice": 0.05}, 3)],
                               "doc_id long, label string, confidence double, proba map<string,double>, n_signals int")
    out = {r["doc_id"]: r for r in invoice_override(df).collect()}
    assert out[1]["label"] == "invoice" and math.isclose(out[1]["confidence"], 0.05)
    assert out[2]["label"] == "news"


def test_model_quality_floor(spark):
    df = E.queries()["logistic_regression"](spark, "/root/testdata/sf0.01")
    val = [r for r in df.collect() if r["split"] == "val"][0]
    assert val["macro_f1"] >= 0.9
