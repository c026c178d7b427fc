"""Tokens, n-grams, vocabulary, TF-IDF, exact stratified split, class weights.

Relational TF-IDF: a document's terms stay in its row; term statistics are one
partial aggregate by term, the vocabulary (at most ``max_features`` rows, a
proven bound) is broadcast back, and counts, weights and the L2 norm are taken
inside the row. The same vocabulary/IDF feeds Spark ML vectors.

The split is exact per class and has no per-class window: rows are ranked by
a global range-partitioned sort on (label, hash) with per-partition offsets,
and per-class start/size come from a tiny grouped table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions import fixed
from .profile import english_stop_words, tokens

DOCS_AT_ONCE = 1000              # whose terms a task looks up together


def unigrams(text) -> Column:
    stop = list(english_stop_words())
    return F.filter(tokens(text), lambda t: ~t.isin(stop))


def tokens_ngrams(text, ngram_max: int = 2) -> Column:
    """1-grams and (when ngram_max = 2) 2-grams of the non-stop tokens."""
    u = unigrams(text)
    return u if ngram_max < 2 else with_bigrams(u)


def with_bigrams(u: Column) -> Column:
    """An array of tokens, then its neighbouring pairs."""
    n = F.size(u)
    bi = F.when(n > 1, F.zip_with(F.slice(u, 1, n - 1), F.slice(u, 2, n - 1),
                                 lambda a, b: F.concat_ws(" ", a, b))).otherwise(F.array().cast("array<string>"))
    return F.concat(u, bi)


def doc_unigrams(df: DataFrame, text: str = "text", key: str = "doc_id", by: str | None = None, values=(None,)) -> DataFrame:
    """(key, u0, u1, ...): one row per document, with the non-stop tokens of each
    of its texts; rows that share a key are one document. One column per value of
    ``by``, or a single one."""
    u = df.select(key, *([by] if by else []), unigrams(F.col(text)).alias("u"))
    own = [F.when(F.col(by) == v, F.col("u")) if by else F.col("u") for v in values]
    return u.groupBy(key).agg(*[F.collect_list(c).alias(f"u{i}") for i, c in enumerate(own)])


def doc_terms(docs: DataFrame, columns=("u0",), key: str = "doc_id", ngram_max: int = 2) -> DataFrame:
    """(key, parts): the terms of each of the columns of ``doc_unigrams``, still
    in the document's row. Nothing is grouped by document and term."""
    ngrams = (lambda x: x) if ngram_max < 2 else with_bigrams
    return docs.select(key, F.array(*[F.flatten(F.transform(c, ngrams)) for c in columns]).alias("parts"))


def vocabulary(docs: DataFrame, min_df: int = fixed.MIN_DF, max_features: int = fixed.MAX_FEATURES) -> DataFrame:
    """Terms in at least min_df documents, top max_features by corpus count
    (ties by term), with df and a 0-based index in that order. ``docs``: rows of
    ``doc_terms``. A document's terms are sorted inside its row, where the first
    of equal ones counts for df; what is aggregated has one row per term."""
    s = docs.select(F.sort_array(F.flatten("parts")).alias("s"))
    first = s.select(F.explode(F.transform("s", lambda t, i: F.struct(
        t.alias("term"), ((i == 0) | (t != F.try_element_at(F.col("s"), i))).cast("long").alias("first")))).alias("x"))
    stats = first.groupBy("x.term").agg(F.sum("x.first").alias("df"), F.count(F.lit(1)).alias("cf"))
    top = stats.where(F.col("df") >= min_df).orderBy(F.desc("cf"), "term").limit(max_features)
    # at most max_features rows: one ordered window is bounded by that
    w = Window.orderBy(F.desc("cf"), "term")
    return top.withColumn("index", (F.row_number().over(w) - 1).cast("long"))


def idf_table(vocab: DataFrame, docs: DataFrame) -> DataFrame:
    """term -> smooth idf ln((1+n)/(1+df)) + 1, n = number of fit documents
    (a scalar subquery)."""
    n = docs.agg(F.count(F.lit(1))).scalar()
    return vocab.select("term", "index", "df", (F.log((1 + n) / (1 + F.col("df"))) + 1).alias("idf"))


def tfidf(docs: DataFrame, idf: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, term, index, weight): tf * idf per part of a document, L2-normalised
    per document. The vocabulary (at most max_features rows) is known to every
    task, which looks up the terms of many documents at once."""
    rows = idf.select("term", "index", "idf").collect()
    shared = docs.sparkSession.sparkContext.broadcast(
        (pa.array([r.term for r in rows], pa.string()), np.array([r["index"] for r in rows], np.int64), np.array([r.idf for r in rows], np.float64)))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, index, weight = shared.value
        for batch in batches:
            for lo in range(0, batch.num_rows, DOCS_AT_ONCE):
                b = batch.slice(lo, DOCS_AT_ONCE)
                parts = b.column("parts").flatten()
                per_doc = b.column("parts").value_lengths().to_numpy()
                at = pc.index_in(parts.flatten(), value_set=terms)
                part = np.repeat(np.arange(len(parts)), parts.value_lengths().to_numpy())
                known = at.is_valid().to_numpy(zero_copy_only=False)
                cell, tf = np.unique(part[known] * max(1, len(terms)) + at.drop_null().to_numpy(), return_counts=True)
                place = cell % max(1, len(terms))
                row = np.repeat(np.arange(b.num_rows), per_doc)[cell // max(1, len(terms))]
                w = tf * weight[place]
                norm = np.sqrt(np.bincount(row, w * w, b.num_rows))
                yield pa.RecordBatch.from_arrays([b.column(key).take(pa.array(row)), terms.take(pa.array(place)), pa.array(index[place]),
                                                  pa.array(w / norm[row])], names=[key, "term", "index", "weight"])

    out = StructType([docs.schema[key], *StructType.fromDDL("term string, index long, weight double").fields])
    return docs.mapInArrow(task, out)


def hash_key(key: str, seed: int = fixed.SEED) -> Column:
    """Seeded ordering key reproducible in SQL engines (hex MD5)."""
    return F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{seed}")))


def stratified_ranks(df: DataFrame, label: str, key: str, seed: int = fixed.SEED,
                     prefix_chars: int = 3) -> DataFrame:
    """Adds rank (0-based position inside the class by seeded hash) and
    class_n (class size).

    The MD5 hex prefix splits every class into 16^prefix_chars buckets of
    near-equal size (uniform hash), so the ranking window runs per bucket,
    never per class: a class holding a third of all rows is spread over
    thousands of tasks. Bucket offsets are a running sum over the small
    (classes x buckets) count table, broadcast back.
    """
    d = df.withColumn("_h", hash_key(key, seed)).withColumn("_b", F.substring("_h", 1, prefix_chars))
    w = Window.partitionBy(label, "_b").orderBy("_h")
    local = d.withColumn("_r", F.row_number().over(w) - 1)
    counts = d.groupBy(label, "_b").agg(F.count(F.lit(1)).alias("_n"))
    cw = Window.partitionBy(label).orderBy("_b")
    offs = counts.select(
        label, "_b",
        F.coalesce(F.sum("_n").over(cw.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"),
        F.sum("_n").over(Window.partitionBy(label)).alias("class_n"))
    return (local.join(F.broadcast(offs), [label, "_b"])  # classes x 16^prefix rows
            .withColumn("rank", F.col("_off") + F.col("_r")).drop("_h", "_b", "_r", "_off"))


def stratified_split(df: DataFrame, label: str, key: str, fractions=fixed.SPLIT_FRACTIONS,
                     seed: int = fixed.SEED) -> DataFrame:
    """Exact per-class train/val/test assignment by seeded hash rank."""
    r = stratified_ranks(df, label, key, seed)
    frac = F.col("rank") / F.col("class_n")
    a, b = fractions[0], fractions[0] + fractions[1]
    split = F.when(frac < a, "train").when(frac < b, "val").otherwise("test")
    return r.withColumn("split", split).drop("rank", "class_n")


def fold_ids(df: DataFrame, label: str, key: str, k: int = fixed.CV_FOLDS, seed: int = fixed.SEED) -> DataFrame:
    r = stratified_ranks(df, label, key, seed)
    return r.withColumn("fold", (F.col("rank") % k).cast("int")).drop("rank", "class_n")


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """label -> n / (k * n_c) (balanced weights)."""
    c = df.groupBy(label).agg(F.count(F.lit(1)).alias("n_c"))
    tot = c.agg(F.struct(F.sum("n_c").alias("n"), F.count(F.lit(1)).alias("k"))).scalar()
    return c.select(label, (tot["n"] / (tot["k"] * F.col("n_c"))).alias("weight"))


def label_index(df: DataFrame, label: str) -> DataFrame:
    """label -> 0-based alphabetical index."""
    d = df.select(label).where(F.col(label).isNotNull()).distinct()
    # one row per class: the ordered window is bounded by the class count
    return d.withColumn("label_idx", (F.row_number().over(Window.orderBy(label)) - 1).cast("long"))
