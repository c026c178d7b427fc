"""Resumable Structured Streaming jobs: score new documents, extract fields
from new invoices, drop repeated content.

Each job reads new parquet files from a folder, applies the same column
expressions as the batch path (the array form of the line rules works on a
stream: no windows), and writes to a file sink with a checkpoint, so a
restarted job resumes after the last committed batch. ``availableNow``
processes what is there and stops; a long-running trigger works the same.

Word boxes come in parts, so a document waits until all of its boxes are there
(``stream_extract_boxes``); what waits is a table per batch, never more than
the incomplete documents.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as tx
from ..operators.extract_layout import extract_from_words, merge_layout_text
from ..operators.extract_text import extract_fields, extract_from_text

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ON_DISK = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
TEXT_SCHEMA = "doc_id long, text string, n_words long"
WORD_SCHEMA = "doc_id long, page int, idx long, text string, x0 double, x1 double, top double, bottom double"


def _run(stream: DataFrame, out: str, checkpoint: str) -> None:
    q = (stream.writeStream.format("parquet").option("path", out)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()


@contextmanager
def _setting(spark: SparkSession, key: str, value: str):
    """A session setting for the time in which a query starts; the caller's comes back."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def stream_extract(spark: SparkSession, src: str, schema, out: str, checkpoint: str) -> DataFrame:
    """New invoices -> six fields per document."""
    s = spark.readStream.schema(schema).parquet(src)
    fields = s.select("doc_id", extract_fields(F.col("text")).alias("f")).select("doc_id", "f.*")
    _run(fields, out, checkpoint)
    return spark.read.parquet(out)


def mark_complete(df: DataFrame) -> DataFrame:
    """Texts and boxes, each once however often it was sent, with ``complete``:
    has the document as many boxes as its text says (``n_words``, set on texts
    only)? Rows are dealt by document once; copies and counts are then found in
    the document's own partition, so the boxes are not shuffled again."""
    once = df.where("doc_id IS NOT NULL").repartition("doc_id").dropDuplicates(["doc_id", "page", "idx"])
    doc = Window.partitionBy("doc_id")
    return once.withColumn("complete", F.coalesce(F.count("idx").over(doc) >= F.max("n_words").over(doc), F.lit(False)))


def stream_extract_boxes(spark: SparkSession, texts: str, words: str, out: str, waiting: str, checkpoint: str,
                         files_per_batch: int | None = None) -> DataFrame:
    """New invoices with word boxes -> six fields per document, the layout
    rules' value where there is one, else the text rules'.

    ``texts`` holds a row per document with the number of its boxes over all
    pages (``TEXT_SCHEMA``; null or 0: it has none), ``words`` the boxes
    (``WORD_SCHEMA``), in any order and in parts. A document is complete when
    its text and that many different boxes have come. Batch n joins its rows to
    those that waited after batch n - 1, writes the complete documents to
    ``out/batch=n`` and the others to ``waiting/batch=n``; both are overwritten
    when batch n runs again, so a restart at any point gives the same result.
    Boxes that come for a document already written wait for a text of their own."""
    def read(schema: str, path: str) -> DataFrame:
        r = spark.readStream.schema(schema)
        return (r.option("maxFilesPerTrigger", files_per_batch) if files_per_batch else r).parquet(path)

    none = lambda t: F.lit(None).cast(t)
    boxes = read(WORD_SCHEMA, words).withColumn("n_words", none("long"))
    rows = read(TEXT_SCHEMA, texts).select("doc_id", none("int").alias("page"), none("long").alias("idx"), "text", *[
        none("double").alias(c) for c in ("x0", "x1", "top", "bottom")], F.coalesce("n_words", F.lit(0)).alias("n_words")).unionByName(boxes)

    def batch(df: DataFrame, number: int) -> None:
        session = df.sparkSession
        if number > 0:
            df = df.unionByName(session.read.schema(df.schema).parquet(f"{waiting}/batch={number - 1}"))
        marked = mark_complete(df).cache()
        ready = marked.where("complete")
        docs = ready.where("idx IS NULL").select("doc_id", "text")
        fields = merge_layout_text(extract_from_text(docs), extract_from_words(ready.where("idx IS NOT NULL")))
        fields.write.mode("overwrite").parquet(f"{out}/batch={number}")
        marked.where("NOT complete").drop("complete").write.mode("overwrite").parquet(f"{waiting}/batch={number}")
        marked.unpersist()

    q = rows.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.parquet(out).drop("batch")


def stream_dedup(spark: SparkSession, src: str, schema, out: str, checkpoint: str, event_time: str | None = None,
                 retention: str | None = None) -> DataFrame:
    """Identical content (SHA-256 of the text) is passed on once. The state is
    one 64-byte key per distinct text, spread over the shuffle partitions and
    kept on disk with its changes in the checkpoint, so memory does not follow
    it. Without ``retention`` a copy is dropped however late it comes and no
    key is ever given up; with it, a key is given up ``retention`` (such as
    "30 days") of ``event_time`` after its text came, and a later copy is new."""
    s = spark.readStream.schema(schema).parquet(src)
    keyed = s.withColumn("content_key", F.sha2(F.col("text"), 256))
    once = (keyed.withWatermark(event_time, retention).dropDuplicatesWithinWatermark(["content_key"]) if retention
            else keyed.dropDuplicates(["content_key"]))
    with _setting(spark, STATE_STORE, ON_DISK):
        _run(once.drop("text"), out, checkpoint)
    return spark.read.parquet(out)


def stream_score(spark: SparkSession, src: str, schema, model, labels: list[str], out: str,
                 checkpoint: str) -> DataFrame:
    """New documents -> label, confidence, signal count and the invoice
    override (a fitted PipelineModel, margins through a softmax where it has no
    probabilities, applied per micro-batch; one output row per input row, no
    join)."""
    from ..operators.train import invoice_override, probabilities
    s = spark.readStream.schema(schema).parquet(src)
    prepared = s.withColumn("raw", F.col("text")).withColumn("text", tx.clean_for_classifier("raw"))
    p = probabilities(model, prepared, labels, carry=("raw",)).withColumn("n_signals", tx.signal_count("raw"))
    _run(invoice_override(p).drop("proba", "raw"), out, checkpoint)
    return spark.read.parquet(out)

