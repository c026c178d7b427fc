"""Resumable streaming: a second run with the same checkpoint processes only
new files; extraction is independent of partitioning."""

import os
import tempfile

from pyspark.sql import functions as F

from quarry.operators.extract_text import extract_from_text
from quarry.sources.invoices import invoices
from quarry.operators.extract_layout import extract_from_words, merge_layout_text
from quarry.sources.invoices import word_boxes
from quarry.streaming import jobs
from quarry.streaming.jobs import stream_extract

from helpers import SF001


def test_stream_extract_resumes(spark):
    base = tempfile.mkdtemp(prefix="quarry-stream-test-")
    src, out, ckpt = (os.path.join(base, x) for x in ("in", "out", "ckpt"))
    inv = invoices(spark, SF001).select("doc_id", "text")
    inv.where(F.col("doc_id") % 2 == 0).write.parquet(os.path.join(src, "a"))
    first = stream_extract(spark, os.path.join(src, "*"), "doc_id long, text string", out, ckpt).count()
    inv.where(F.col("doc_id") % 2 == 1).write.parquet(os.path.join(src, "b"))
    both = stream_extract(spark, os.path.join(src, "*"), "doc_id long, text string", out, ckpt)
    assert 0 < first < both.count() == inv.count()
    assert both.select("doc_id").distinct().count() == inv.count()


def test_extraction_independent_of_partitioning(spark):
    inv = invoices(spark, SF001).select("doc_id", "text")
    a = sorted(map(tuple, extract_from_text(inv.repartition(1)).collect()))
    b = sorted(map(tuple, extract_from_text(inv.repartition(7, "text")).collect()))
    assert a == b


def test_pages_are_assembled_over_batches_and_restarts(spark, tmp_path):
    """Texts and boxes come in parts, some twice, one document's last box
    never: fields equal the batch path's as soon as a document is complete."""
    inv = invoices(spark, SF001).where("doc_id < 400").select("doc_id", "text").cache()
    boxes = word_boxes(inv).drop("conf").cache()
    want = {tuple(r) for r in merge_layout_text(extract_from_text(inv), extract_from_words(boxes)).collect()}
    dirs = [str(tmp_path / x) for x in ("texts", "words", "out", "waiting", "ckpt")]
    counts = boxes.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_words"))
    texts = inv.join(counts, "doc_id")
    late = inv.agg(F.max("doc_id")).first()[0]
    run = lambda **kw: {tuple(r) for r in jobs.stream_extract_boxes(spark, *dirs, **kw).collect()}
    texts.where("doc_id % 3 > 0").write.parquet(dirs[0])
    boxes.where(F.col("idx") % 2 == 0).write.parquet(dirs[1])
    first = run()
    assert not first
    boxes.where((F.col("idx") % 2 == 1) & ((F.col("doc_id") != late) | (F.col("idx") > 1))).repartition(3).write.mode("append").parquet(dirs[1])
    second = run(files_per_batch=1)
    assert second == {r for r in want if r[0] % 3 > 0 and r[0] != late}
    texts.where("doc_id % 3 = 0").write.mode("append").parquet(dirs[0])
    boxes.where("doc_id % 5 = 0").write.mode("append").parquet(dirs[1])
    third = run()
    assert {r for r in want if r[0] != late} - third == set() and len(third) == len({r[0] for r in third})


def test_a_batch_that_runs_again_gives_the_same(spark, tmp_path):
    """The job stops after its results are written and before the batch is committed."""
    inv = invoices(spark, SF001).where("doc_id < 60").select("doc_id", "text")
    boxes = word_boxes(inv).drop("conf")
    dirs = [str(tmp_path / x) for x in ("texts", "words", "out", "waiting", "ckpt")]
    inv.join(boxes.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_words")), "doc_id").write.parquet(dirs[0])
    boxes.write.parquet(dirs[1])
    first = sorted(map(tuple, jobs.stream_extract_boxes(spark, *dirs).collect()))
    for name in ("0", ".0.crc"):
        os.remove(os.path.join(dirs[4], "commits", name))
    again = sorted(map(tuple, jobs.stream_extract_boxes(spark, *dirs).collect()))
    assert first == again and len(first) > 0


def test_dedup_over_batches_and_a_restart(spark, tmp_path):
    src, out, ckpt = (str(tmp_path / x) for x in ("in", "out", "ckpt"))
    before = spark.conf.get(jobs.STATE_STORE, None)
    seen = []
    for n in range(4):
        rows = [(100 * n + i, f"text {i % 7 + n}") for i in range(30)]
        spark.createDataFrame(rows, "doc_id long, text string").write.mode("append").parquet(src)
        kept = jobs.stream_dedup(spark, src, "doc_id long, text string", out, ckpt)
        seen = [r.content_key for r in kept.collect()]
        assert len(seen) == len(set(seen)) == 7 + n
    assert spark.conf.get(jobs.STATE_STORE, None) == before
    assert any(f.endswith((".zip", ".changelog")) for _, _, files in os.walk(os.path.join(ckpt, "state")) for f in files)   # kept on disk


def test_dedup_gives_up_old_keys(spark, tmp_path):
    src, out, ckpt = (str(tmp_path / x) for x in ("in", "out", "ckpt"))
    run = lambda: jobs.stream_dedup(spark, src, "doc_id long, text string, at timestamp", out, ckpt, "at", "1 day").count()
    put = lambda rows: spark.createDataFrame(rows, "doc_id long, text string, at string").withColumn(
        "at", F.to_timestamp("at")).write.mode("append").parquet(src)
    put([(1, "a", "2024-01-01 00:00:00"), (2, "a", "2024-01-01 01:00:00"), (3, "b", "2024-01-05 00:00:00")])
    assert run() == 2
    put([(4, "b", "2024-01-05 02:00:00"), (5, "a", "2024-01-05 03:00:00")])
    assert run() == 3


def test_boxes_are_marked_in_one_shuffle(spark):
    """copies count once, documents without an id go, and rows are dealt once."""
    rows = [(1, None, 2), (1, 0, None), (1, 1, None), (1, 1, None), (2, None, 1), (3, 0, None), (4, None, 0), (None, None, 0)]
    df = spark.createDataFrame(rows, "doc_id long, idx long, n_words long").withColumn("page", F.lit(1))
    got = jobs.mark_complete(df)
    assert sorted((r.doc_id, r.idx is None, r.complete) for r in got.collect()) == [
        (1, False, True), (1, False, True), (1, True, True), (2, True, False), (3, False, False), (4, True, True)]
    assert got._jdf.queryExecution().sparkPlan().toString().count("Exchange") <= 1
    assert got._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") <= 2  # once per listing of the plan
