"""Document classifiers with Spark ML: features, models, CV, grid search,
learning curve, coefficients, scoring.

Features stay in the JVM: a SQL stage builds the 1-2 gram term array with
built-in expressions, a ``CountVectorizerModel`` keeps the vocabulary (min document
frequency, top terms by corpus count, counted in one pass together with the
document frequencies), an ``ElementwiseProduct`` weighs by the smooth idf, then
an L2 ``Normalizer``. The fitted stages form a ``PipelineModel``
that can be saved and loaded. Fitting is distributed; fitted features are
cached once and reused by all models of a run.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml import PipelineModel
from pyspark.ml.classification import NaiveBayes
from pyspark.ml.feature import (
    CountVectorizerModel, ElementwiseProduct, Normalizer, SQLTransformer, StringIndexer,
)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fixed
from . import linear, trees
from . import metrics as mt
from .profile import WORD_TOKEN, english_stop_words


def terms_sql(text: str = "text", ngram_max: int = 2) -> str:
    """SQL statement adding ``terms`` (non-stop 1-grams, then 2-grams)."""
    stop = ", ".join("'" + w.replace("'", "\\'") + "'" for w in english_stop_words())
    uni = (f"filter(regexp_extract_all(lower({text}), '{WORD_TOKEN.replace(chr(92), chr(92) * 2)}', 0), "
           f"t -> t NOT IN ({stop}))")
    if ngram_max < 2:
        return f"SELECT *, {uni} AS terms FROM __THIS__"
    bi = ("CASE WHEN size(u) > 1 THEN zip_with(slice(u, 1, size(u) - 1), slice(u, 2, size(u) - 1), "
          "(a, b) -> concat(a, ' ', b)) ELSE array() END")
    return (f"SELECT * EXCEPT (u), concat(u, {bi}) AS terms FROM "
            f"(SELECT *, {uni} AS u FROM __THIS__)")


def term_counts(rows: DataFrame) -> DataFrame:
    """(term, n, d): how often and in how many of the rows a term stands. Counted per
    batch of rows first, so that a term is sent once per batch."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            terms = b.column("terms")
            code = terms.flatten().dictionary_encode()
            row = np.repeat(np.arange(b.num_rows), pc.fill_null(terms.value_lengths(), 0).to_numpy())
            at, many = code.indices.to_numpy(zero_copy_only=False), max(1, len(code.dictionary))
            once = np.unique(row * many + at) % many
            yield pa.RecordBatch.from_arrays([code.dictionary, pa.array(np.bincount(at, minlength=len(code.dictionary))),
                                              pa.array(np.bincount(once, minlength=len(code.dictionary)))], names=["term", "n", "d"])

    return (rows.select("terms").where("terms is not null").mapInArrow(task, "term string, n long, d long").groupBy("term")
            .agg(F.sum("n").alias("n"), F.sum("d").alias("d")))


def fit_features(train: DataFrame, min_df: int = fixed.MIN_DF, vocab_size: int = fixed.MAX_FEATURES,
                 ngram_max: int = 2, text: str = "text") -> PipelineModel:
    """One pass over the texts: the ``vocab_size`` most frequent terms (ties by term)
    in ``min_df`` rows at least, and their idf, ln((1+n)/(1+df)) + 1. The result is
    one saveable PipelineModel of JVM stages."""
    split = SQLTransformer(statement=terms_sql(text, ngram_max))
    top = term_counts(split.transform(train)).where(F.col("d") >= min_df).orderBy(F.desc("n"), "term").limit(vocab_size).collect()
    n = train.count()
    scale = DenseVector(np.log((1.0 + n) / (1.0 + np.array([r.d for r in top], np.float64))) + 1.0)
    return PipelineModel(stages=[
        split,
        CountVectorizerModel.from_vocabulary([r.term for r in top], inputCol="terms", outputCol="tf"),
        ElementwiseProduct(scalingVec=scale, inputCol="tf", outputCol="_tfidf"),
        Normalizer(p=2.0, inputCol="_tfidf", outputCol="features"),
        SQLTransformer(statement="SELECT * EXCEPT (_tfidf) FROM __THIS__"),
    ])


def term_rows(df: DataFrame, ngram_max: int = 2) -> DataFrame:
    """``df`` with its terms, as the first stage of ``fit_features`` gives them."""
    return SQLTransformer(statement=terms_sql("text", ngram_max)).transform(df)


def index_labels(df: DataFrame, label: str = "label"):
    idx = StringIndexer(inputCol=label, outputCol="y", stringOrderType="alphabetAsc",
                        handleInvalid="error").fit(df)
    return idx


def with_balanced_weights(df: DataFrame, label: str = "label") -> DataFrame:
    """weight = n / (k * n_c), from a per-class table broadcast back."""
    c = df.groupBy(label).agg(F.count(F.lit(1)).alias("_nc"))
    tot = c.agg(F.struct(F.sum("_nc").alias("n"), F.count(F.lit(1)).alias("k"))).scalar()
    w = c.select(label, (tot["n"] / (tot["k"] * F.col("_nc"))).alias("weight"))
    return df.join(F.broadcast(w), label)  # one row per class


def predictions(model, data: DataFrame) -> DataFrame:
    """Scored rows with ``rawPrediction`` and ``prediction``; the columns of
    a boosted model's members are dropped."""
    out = model.transform(data)
    out = out.drop(*[c for c in out.columns if re.fullmatch(r"_raw\d+", c)])
    if "prediction" not in out.columns:
        margins = vector_to_array("rawPrediction")
        out = out.withColumn("prediction", (F.array_position(margins, F.array_max(margins)) - 1).cast("double"))
    return out


# Settings of the fits, the reference's.
TREES = 200
TREE_DEPTH = 5
BOOST_ROUNDS = 300


def make_model(kind: str, C: float = 1.0):
    """The model families. ``C`` is the inverse strength of the penalty
    against the summed loss."""
    if kind == "naive_bayes":
        return NaiveBayes(modelType="multinomial", featuresCol="features", labelCol="y")
    if kind == "linear_svm":
        return linear.Linear(linear.HINGE, C)
    if kind == "logistic_regression":
        return linear.Linear(linear.SOFTMAX, C)
    if kind == "random_forest":
        return trees.Forest(TREES, TREE_DEPTH, fixed.SEED)
    if kind == "boosted_trees":
        return trees.Boosted(BOOST_ROUNDS, depth=6, step=0.1, row_share=0.8, feature_share=0.8, seed=fixed.SEED)
    raise ValueError(f"unknown model {kind}")


FIT_ROWS_PER_TASK = 2000


def fit_ready(df: DataFrame) -> tuple[DataFrame, int]:
    """Fit columns, cached, in few enough partitions that an iteration is
    not all scheduling; and the number of rows. The caller unpersists."""
    df = df.select("doc_id", "label", "features", "y", "weight").cache()
    n = df.count()
    few = max(1, -(-n // FIT_ROWS_PER_TASK))
    if df.rdd.getNumPartitions() <= few:
        return df, n
    small = df.coalesce(few).cache()
    small.count()
    df.unpersist()
    return small, n


MODELS = ["naive_bayes", "linear_svm", "logistic_regression", "random_forest", "boosted_trees"]


def prepare(train: DataFrame, label: str = "label", **feat_kw):
    """Fit features and the label index on train; returns (features, indexer)."""
    feats = fit_features(train, **feat_kw)
    idx = index_labels(train, label)
    return feats, idx


def featurize(df: DataFrame, feats: PipelineModel, idx, label: str = "label") -> DataFrame:
    return idx.transform(feats.transform(df))


def evaluate(model, data: DataFrame, labels: list[str]) -> DataFrame:
    """(label, prediction) as strings for metrics."""
    p = predictions(model, data)
    lab = F.element_at(F.array(*[F.lit(x) for x in labels]), (F.col("prediction") + 1).cast("int"))
    return p.select("doc_id", F.col("label"), lab.alias("prediction"))


def macro_f1(preds: DataFrame) -> DataFrame:
    return mt.summary(preds).select("macro_f1")


def probabilities(model, data: DataFrame, labels: list[str], carry=()) -> DataFrame:
    """doc_id, ``carry`` columns, label, confidence, class -> probability map (4 decimals). Models
    without probabilities (one-vs-rest SVM) get a softmax of the margins."""
    p = predictions(model, data)
    if "probability" in p.columns:
        probs = vector_to_array("probability")
    else:
        m = vector_to_array("rawPrediction")
        mx = F.array_max(m)
        ex = F.transform(m, lambda x: F.exp(x - mx))
        tot = F.aggregate(ex, F.lit(0.0), lambda a, x: a + x)
        probs = F.transform(ex, lambda x: x / tot)
    labs = F.array(*[F.lit(x) for x in labels])
    pred = F.element_at(labs, (F.col("prediction") + 1).cast("int"))
    return p.select(
        "doc_id", *carry, pred.alias("label"),
        F.round(F.array_max(probs), 4).alias("confidence"),
        F.map_from_arrays(labs, F.transform(probs, lambda x: F.round(x, 4))).alias("proba"),
    )


def invoice_override(scored: DataFrame, signals_col: str = "n_signals",
                     threshold: int = fixed.INVOICE_OVERRIDE_MIN_SIGNALS) -> DataFrame:
    """At least ``threshold`` invoice signals and another label -> invoice,
    with the invoice class's own probability as confidence."""
    hit = (F.col(signals_col) >= threshold) & (F.col("label") != "invoice")
    inv_p = F.coalesce(F.try_element_at(F.col("proba"), F.lit("invoice")), F.lit(0.0))
    return scored.select(
        "*", hit.alias("overridden"),
    ).withColumn("label", F.when(F.col("overridden"), F.lit("invoice")).otherwise(F.col("label"))) \
     .withColumn("confidence", F.when(F.col("overridden"), inv_p).otherwise(F.col("confidence")))


def top_coefficients(lr_model, vocab: list[str], labels: list[str], n: int = 15) -> DataFrame:
    """n highest and n lowest term weights per class of a linear model (ties
    by term). The coefficient matrix (classes x vocabulary, bounded by
    max_features) lives in the driver-side model and is ranked there; only
    2 n rows per class become a table."""
    mat, terms = lr_model.coefficientMatrix.toArray(), np.array(vocab)
    rows = []
    for c, label in enumerate(labels):
        for side, weight in (("top", -mat[c]), ("bottom", mat[c])):
            for rank, j in enumerate(np.lexsort((terms, weight))[:n].tolist(), 1):
                rows.append((label, vocab[j], round(float(mat[c, j]), 6), side, rank))
    return SparkSession.active().createDataFrame(rows, "label string, term string, weight double, side string, rank int")


def dense_vectors(df: DataFrame, col: str = "embedding") -> DataFrame:
    return df.withColumn("features", array_to_vector(F.col(col)))
