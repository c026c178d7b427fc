"""Edge rows of readers, sinks and metrics."""

import re

import pytest
from pyspark.sql import functions as F

from helpers import SF001
from quarry.operators import dedup, metrics, profile
from quarry.sources import files


def test_csv_keeps_blanks_empty_strings_and_nulls(spark, tmp_path):
    rows = [(1, "  lead and trail  "), (2, ""), (3, None), (4, 'quote " and , comma'), (5, "two\nlines"), (6, "\ttab")]
    df = spark.createDataFrame(rows, "id long, text string")
    files.write_results(df, str(tmp_path / "out"))
    back = files.read_csv(spark, str(tmp_path / "out"), "id long, text string", files.NULL_MARK)
    assert sorted((r.id, r.text) for r in back.collect()) == rows


def test_fallback_reads_csv_and_refuses_two_missing_paths(spark, tmp_path):
    (tmp_path / "t.csv").write_text("a,b\n1,x\n2,\n")
    got = files.read_table_with_fallback(spark, str(tmp_path / "none.parquet"), str(tmp_path / "t.csv"), ["a", "b"])
    assert [(r.a, r.b) for r in got.collect()] == [("1", "x"), ("2", None)]
    typed = files.read_table_with_fallback(spark, str(tmp_path / "t.csv"), "unused", ["a"], "a long, b string")
    assert [r.a for r in typed.collect()] == [1, 2]
    with pytest.raises(FileNotFoundError):
        files.read_table_with_fallback(spark, str(tmp_path / "x"), str(tmp_path / "y"), ["a"])


def test_confusion_matrix_has_every_class(spark):
    df = spark.createDataFrame([("a", "b"), ("a", "a"), ("b", "b")], "label string, prediction string")
    got = {r["label"]: (r["a"], r["b"], r["c"]) for r in metrics.confusion_matrix(df, ["a", "b", "c"]).collect()}
    assert got == {"a": (1, 1, 0), "b": (0, 1, 0), "c": (0, 0, 0)}


def test_report_rows(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "b"), ("b", "b"), ("b", "b")], "label string, prediction string")
    got = {r["class"]: (r.precision, r.recall, r.f1, r.support) for r in metrics.classification_report(df).collect()}
    assert got["a"] == (1.0, 0.5, 0.6667, 2) and got["b"] == (0.6667, 1.0, 0.8, 2)
    assert got["macro avg"] == (0.8333, 0.75, 0.7333, 4) and got["weighted avg"] == (0.8333, 0.75, 0.7333, 4)


def test_null_text_is_no_distinct_value(spark):
    df = spark.createDataFrame([(1, None), (2, None), (3, "x")], "id long, text string")
    assert df.agg(F.count_distinct(profile.text_key("text"))).first()[0] == 1
    assert sorted(r.id for r in dedup.show_all_duplicates(df, "text").collect()) == [1, 2]
    assert sorted(r.id for r in dedup.dedup_keep_first(df, "text", "id").collect()) == [1, 3]


def test_schema_check_is_strict():
    from tools.check_oracles import schema_faults
    assert not schema_faults([("a", "bigint")], [("a", "BIGINT")])
    assert schema_faults([("a", "bigint")], [("a", "HUGEINT")])
    assert schema_faults([("a", "bigint"), ("b", "int")], [("b", "INTEGER"), ("a", "BIGINT")])


def test_text_tree_on_a_mounted_folder_is_sparks_own(spark, tmp_path):
    """folders, bytes and counts are those of Spark's text writer, without its process per file."""
    rows = [("en", "a\nb"), ("en", None), (None, "x"), ("", "empty"), ("a/b:c%", "caf\u00e9"), ("de", ""), ("en", "a\nb")]
    df = spark.createDataFrame(rows, "label string, text string").repartition(3)
    tree = lambda path: sorted((p.parent.name, p.read_bytes()) for p in path.rglob("*.txt"))
    files.write_text_tree(df, f"file://{tmp_path / 'own'}")
    used = len(list((tmp_path / "own").rglob(".*")))
    (tmp_path / "spark").mkdir()                       # a folder that is there is overwritten by Spark
    files.write_text_tree(df, str(tmp_path / "spark"))
    assert used == 0 and tree(tmp_path / "own") == tree(tmp_path / "spark") and len(tree(tmp_path / "own")) == len(rows)
    back = files.read_text_tree(spark, str(tmp_path / "own"))
    assert back.count() == len(rows)


def test_terms_are_not_grouped_by_document(spark):
    """What is grouped has one row per document or per term, never one per both."""
    from quarry.plans import feature_plans as fp
    plan = fp.q_vocabulary(spark, SF001)._jdf.queryExecution().optimizedPlan().toString()
    keys = re.findall(r"Aggregate \[([^\]]*)\]", plan)
    assert keys and not any("doc_id" in k and "term" in k for k in keys)


def test_term_weights_of_repeated_keys(spark):
    """Rows of one key are one document, also without a key; each split has its own counts, the norm is common."""
    from quarry.operators import features as fe
    rows = [(1, "a", "alpha beta alpha"), (1, "a", "beta gamma"), (1, "b", "alpha"), (2, "a", "alpha zeta"), (None, "a", "alpha"), (None, "a", "gamma"),
            (3, "b", None), (4, "b", "unseen"), (5, "a", "")]
    docs = fe.doc_unigrams(spark.createDataFrame(rows, "doc_id long, split string, text string"), by="split", values=("a", "b"))
    assert docs.count() == 6
    vocab = fe.vocabulary(fe.doc_terms(docs), min_df=2)
    got = [(r.term, r.df, r.cf, r["index"]) for r in vocab.collect()]
    assert got == [("alpha", 3, 4, 0), ("gamma", 2, 2, 1)]
    idf = vocab.withColumn("idf", F.col("index") + 1.0)
    found = sorted(((r.doc_id or 0, r.term, round(r.weight, 6)) for r in fe.tfidf(fe.doc_terms(docs, ["u0", "u1"]), idf).collect()))
    one, none = (4 + 4 + 1) ** 0.5, 5 ** 0.5
    assert found == sorted([(1, "alpha", round(2 / one, 6)), (1, "gamma", round(2 / one, 6)), (1, "alpha", round(1 / one, 6)), (2, "alpha", 1.0),
                            (0, "alpha", round(1 / none, 6)), (0, "gamma", round(2 / none, 6))])
    assert fe.tfidf(fe.doc_terms(docs), idf.limit(0)).count() == 0
