"""File sources and sinks: text trees, byte decoding, CSV, fallbacks,
per-class outputs.

All readers are ``spark.read`` scans (``binaryFile``, ``csv``, ``parquet``);
decoding, labels from folder names and extension filters are column
expressions, so listing and reading are distributed like any file scan.
"""

from __future__ import annotations

import os
import re
import uuid
from collections.abc import Iterator
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def _binary(spark: SparkSession, path: str) -> DataFrame:
    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path))


def read_text_tree(spark: SparkSession, path: str, encoding: str = "ISO-8859-1") -> DataFrame:
    """One file = one row; the parent folder name is the label."""
    b = _binary(spark, path).where(~F.regexp_extract("path", r"([^/]+)$", 1).rlike(r"^[._]"))
    return b.select(
        F.regexp_extract("path", r"/([^/]+)/[^/]+$", 1).alias("label"),
        F.decode("content", encoding).alias("text"),
        F.regexp_extract("path", r"([^/]+)$", 1).alias("filename"),
    )


def read_text_utf8_or_latin1(spark: SparkSession, path: str) -> DataFrame:
    """UTF-8 when the bytes are valid UTF-8, else Latin-1; stem as name."""
    b = _binary(spark, path).where(~F.regexp_extract("path", r"([^/]+)$", 1).rlike(r"^[._]"))
    as_str = F.col("content").cast("string")
    text = F.when(F.is_valid_utf8(as_str), F.decode("content", "UTF-8")).otherwise(F.decode("content", "ISO-8859-1"))
    name = F.regexp_extract("path", r"([^/]+)$", 1)
    return b.select(name.alias("filename"), F.regexp_replace(name, r"\.[^.]*$", "").alias("name"), text.alias("text"))


def read_binary_filtered(spark: SparkSession, path: str, exts: list[str]) -> DataFrame:
    """Recursive listing with a case-insensitive extension allowlist."""
    ext = F.lower(F.regexp_extract("path", r"(\.[^./]+)$", 1))
    return _binary(spark, path).where(ext.isin([e.lower() for e in exts])).select("path", "length", "content")


NULL_MARK = "\\N"            # how ``write_results`` spells null in CSV; the empty string stays itself


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None, null_mark: str = "") -> DataFrame:
    """Header CSV with quoted multi-line fields. Without a schema all columns
    are strings named by the header. ``null_mark`` is read as null: the empty
    field of ordinary files, NULL_MARK for files of ``write_results``. Blanks
    at the ends of fields stay."""
    reader = (spark.read.option("header", "true").option("multiLine", "true").option("quote", '"').option("escape", '"')
              .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false")
              .option("nullValue", null_mark).option("emptyValue", ""))
    return (reader.schema(schema) if schema is not None else reader).csv(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Does the path exist in the store that it names (any Hadoop file system)?"""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def read_table_with_fallback(spark: SparkSession, primary: str, secondary: str, columns: list[str],
                             schema: StructType | str | None = None) -> DataFrame:
    """First existing path of two (CSV by extension, with ``schema``; else
    parquet), else raise."""
    for p in (primary, secondary):
        if path_exists(spark, p):
            return (read_csv(spark, p, schema) if p.endswith(".csv") else spark.read.parquet(p)).select(*columns)
    raise FileNotFoundError(f"neither {primary} nor {secondary} exists")


def mounted_folder(path: str) -> str | None:
    """The folder that all machines mount, or None for any other store."""
    if path.startswith("file:"):
        return unquote(re.sub(r"^file:/*", "/", path))
    return path if path.startswith("/") else None


def write_text_tree(df: DataFrame, path: str, label: str = "label", text: str = "text") -> None:
    """One text file per row under label=<label> folders (test and fixture helper).

    Where ``path`` is on a mounted folder, tasks write their files themselves:
    Spark's local writer starts a process per file to set its mode. The names
    follow task and row, so a task that runs again replaces its own files; each
    is written aside (a dot file, which no reader lists) and moved. Other stores
    get the files from Spark's text writer."""
    spark = df.sparkSession
    store = spark._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    folder = mounted_folder(path) if store.getUri().getScheme() == "file" else None
    if folder is None or path_exists(spark, path):
        (df.select(label, text).write.mode("overwrite").option("maxRecordsPerFile", 1)
         .partitionBy(label).text(path))
        return
    run = uuid.uuid4().hex

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        task, n = TaskContext.get(), 0
        for b in batches:
            for lab, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                own = os.path.join(folder, f"{label}={partition_name(lab)}")
                if n == 0 or not os.path.isdir(own):
                    os.makedirs(own, exist_ok=True)
                name = f"part-{task.partitionId():05d}-{run}-c{n:06d}.txt"
                aside = os.path.join(own, f".{name}.{task.taskAttemptId()}")
                with open(aside, "wb") as f:
                    f.write((data or b"") + b"\n")
                os.replace(aside, os.path.join(own, name))
                n += 1
        yield pa.RecordBatch.from_pydict({"n": pa.array([n], pa.int64())})

    os.makedirs(folder, exist_ok=True)
    rows = df.select(F.col(label).cast("string"), F.col(text).cast("binary"))
    rows.mapInArrow(write, "n long").agg(F.sum("n")).collect()


def partition_name(value: str | None) -> str:
    """The value as Spark spells it in a folder name."""
    if not value:
        return "__HIVE_DEFAULT_PARTITION__"
    return "".join(f"%{ord(c):02X}" if ord(c) < 32 or c in "\x7f\"#%'*/:=?\\{[]^" else c for c in value)


def write_results(df: DataFrame, path: str, fmt: str = "csv") -> None:
    """Result rows as CSV (header) or parquet; the task commit protocol makes
    finished tasks durable and a rerun overwrites. Null is spelled NULL_MARK,
    the empty string is quoted, and blanks at the ends of fields stay."""
    w = df.write.mode("overwrite")
    if fmt == "csv":
        (w.option("header", "true").option("escape", '"').option("nullValue", NULL_MARK).option("emptyValue", '""')
         .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false").csv(path))
    else:
        w.parquet(path)


def write_per_class(df: DataFrame, path: str, cls: str = "doc_type") -> None:
    """One folder per class plus the merged view (the folder itself)."""
    df.write.mode("overwrite").partitionBy(cls).parquet(path)
