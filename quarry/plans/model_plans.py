"""Registered model queries (rows-only checks; quality bounds in pytest).

Vocabulary, grids, folds and sizes are the reference's; iteration settings
stand in ``operators/train.py``.
"""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions import text as tx
from ..operators import features as fe
from ..operators import linear
from ..operators import metrics as mt
from ..operators import train as tr
from ..session import scratch_path
from ..sources.invoices import invoices, word_boxes
from ..sources.tables import table
from .feature_plans import cleaned, split_docs

QUERIES: dict = {}
ORACLES: dict = {}


def register(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


class Fit:
    """Split documents, fitted features and cached fit rows of one run.
    ``stored``: the documents are read from a cache of the caller's."""

    def __init__(self, docs: DataFrame, vocab_size: int = fixed.MAX_FEATURES, stored: bool = False):
        self.split = docs if stored else docs.cache()
        self.stored = stored
        train = docs.where(F.col("split") == "train")
        self.feats, self.idx = tr.prepare(train, vocab_size=vocab_size)
        self.labels = self.idx.labels
        self.rows, self.n = tr.fit_ready(tr.with_balanced_weights(tr.featurize(train, self.feats, self.idx)))

    def part(self, name: str) -> DataFrame:
        return tr.featurize(self.split.where(F.col("split") == name), self.feats, self.idx)

    def model(self, kind: str, **kw):
        return tr.make_model(kind, **kw).fit(self.rows)

    def metrics(self, name: str, model) -> DataFrame:
        """accuracy and F1s of validation and test, as a small local table."""
        out = [(name, part, *mt.summary(tr.evaluate(model, self.part(part), self.labels)).first()) for part in ("val", "test")]
        return self.rows.sparkSession.createDataFrame(out, "model string, split string, accuracy double, macro_f1 double, weighted_f1 double")

    def done(self) -> None:
        """Free the cached rows; what is scored later is read anew."""
        self.rows.unpersist()
        if not self.stored:
            self.split.unpersist()


def train_and_score(spark, sf_dir, kind: str) -> DataFrame:
    fit = Fit(split_docs(spark, sf_dir))
    out = fit.metrics(kind, fit.model(kind))
    fit.done()
    return out


for _k in tr.MODELS:
    register(_k)(lambda spark, sf_dir, _k=_k: train_and_score(spark, sf_dir, _k))


def side_by_side(jobs, workers: int = 4) -> list:
    """Results of independent fits, a few of them at a time."""
    with ThreadPoolExecutor(workers) as pool:
        return list(pool.map(lambda f: f(), [inheritable_thread_target(j) for j in jobs]))


@register("dense_vector_lr")
def q_dense_vector_lr(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("doc_id"), F.col("label").cast("string").alias("label"), "embedding")
    sp = fe.stratified_split(e, "label", "doc_id")
    idx = tr.index_labels(sp, "label")
    data = idx.transform(tr.dense_vectors(sp))
    train, n = tr.fit_ready(tr.with_balanced_weights(data.where(F.col("split") == "train")))
    model = tr.make_model("logistic_regression").fit(train)
    train.unpersist()
    out = None
    for split in ("val", "test"):
        s = mt.summary(tr.evaluate(model, data.where(F.col("split") == split), idx.labels)).select(
            F.lit("dense_vector_lr").alias("model"), F.lit(split).alias("split"), "accuracy", "macro_f1",
            "weighted_f1")
        out = s if out is None else out.unionByName(s)
    return out


CV_MODELS = ("naive_bayes", "linear_svm", "logistic_regression", "random_forest")


def cv_scores(spark, sf_dir, kinds=CV_MODELS, k: int = fixed.CV_FOLDS, vocab_size: int = fixed.MAX_FEATURES) -> DataFrame:
    """Stratified k folds; features re-fit on each training fold."""
    # texts are cleaned once for all folds, and a fold's held-out features are taken once for all kinds
    d = fe.fold_ids(cleaned(spark, sf_dir), "label", "doc_id", k=k).cache()

    def one(fold: int):
        marked = d.withColumn("split", F.when(F.col("fold") == fold, "val").otherwise("train"))
        fit = Fit(marked, vocab_size, stored=True)
        held = fit.part("val").select("doc_id", "label", "y", "features").cache()
        out = []
        for kind in kinds:
            s = mt.summary(tr.evaluate(fit.model(kind), held, fit.labels)).first()
            out.append((kind, fold, float(s["accuracy"]), float(s["macro_f1"]), float(s["weighted_f1"])))
        held.unpersist()
        fit.done()
        return out

    rows = [r for part in side_by_side([lambda f=f: one(f) for f in range(k)]) for r in part]
    d.unpersist()
    return spark.createDataFrame(rows, "model string, fold int, accuracy double, macro_f1 double, weighted_f1 double")


@register("stratified_cv")
def q_stratified_cv(spark, sf_dir):
    """Mean and spread of three metrics over five folds, four models."""
    scores = cv_scores(spark, sf_dir)
    out = None
    for m in ("accuracy", "macro_f1", "weighted_f1"):
        part = mt.fold_mean_std(scores, m).withColumn("metric", F.lit(m))
        out = part if out is None else out.unionByName(part)
    return out


GRID_VOCABS, GRID_NGRAMS = (10000, 20000), (1, 2)
GRID_C = {"logistic_regression": (0.1, 1.0, 10.0), "linear_svm": (0.01, 0.1, 1.0)}


def grid_search(spark, sf_dir, kind: str, vocab_sizes=GRID_VOCABS, ngrams=GRID_NGRAMS, Cs=None,
                k: int = fixed.CV_FOLDS) -> DataFrame:
    """Vocabulary size x n-gram range x C by k-fold macro-F1; the features
    are fitted once per fold and feature setting, inside the fold. The best
    setting (ties: smaller vocabulary, n-gram range, C) is fitted on all
    training and validation rows and scored on the test rows. ``Cs``: by
    default those of the kind."""
    Cs = tuple(Cs or GRID_C[kind])
    sp = split_docs(spark, sf_dir)
    dev = fe.fold_ids(sp.where(F.col("split") != "test").drop("split"), "label", "doc_id", k=k).drop("rank", "class_n").cache()
    idx = tr.index_labels(dev)
    sizes = sorted(vocab_sizes)
    loss = {"linear_svm": linear.HINGE, "logistic_regression": linear.SOFTMAX}[kind]

    def folds_of(ngram: int) -> dict[tuple, list[float]]:
        """Scores of every (vocabulary size, n-gram range, C) and fold: terms
        once, features of all folds and sizes in one pass, and all fits of all
        folds, sizes and penalties step by step in the same passes."""
        terms = tr.term_rows(idx.transform(dev), ngram).select("fold", "y", "terms").cache()
        counts = linear.class_counts(terms, len(idx.labels), "fold")
        vocab = linear.fold_terms(terms, k, sizes[-1], fixed.MIN_DF)
        blocks = linear.fold_cells(terms, vocab, sizes).cache()
        total, base = sum(counts.values()), lambda fold: fold * len(sizes)
        problems = {base(f) + i: linear.Problem(total - counts.get((f,), 0), min(s, len(v.terms)), Cs, loss)
                    for f, v in enumerate(vocab) for i, s in enumerate(sizes)}
        found = linear.confusion(blocks.where(held=True), linear.fit(blocks.where(held=False), problems))
        blocks.unpersist()
        terms.unpersist()
        return {(s, ngram, c): [linear.macro_f1(found[base(f) + i][j]) for f in range(k)]
                for i, s in enumerate(sizes) for j, c in enumerate(Cs)}

    scores = {key: v for part in side_by_side([lambda g=g: folds_of(g) for g in ngrams]) for key, v in part.items()}
    best = min(scores, key=lambda s: (-sum(scores[s]), s))
    feats, idx = tr.prepare(dev, vocab_size=best[0], ngram_max=best[1])
    rows, _ = tr.fit_ready(tr.with_balanced_weights(tr.featurize(dev, feats, idx)))
    model = tr.make_model(kind, C=best[2]).fit(rows)
    rows.unpersist()
    dev.unpersist()
    test = mt.summary(tr.evaluate(model, tr.featurize(sp.where(F.col("split") == "test"), feats, idx), idx.labels)).first()
    table_ = [(kind, *s, float(sum(x) / len(x)), s == best, float(test["macro_f1"]) if s == best else None)
              for s, x in sorted(scores.items())]
    return spark.createDataFrame(table_, "model string, vocab_size int, ngram_max int, C double, cv_macro_f1 double, best boolean, test_macro_f1 double")


@register("grid_search")
def q_grid_search(spark, sf_dir):
    return grid_search(spark, sf_dir, "logistic_regression")


CURVE_SIZES = (0.1, 0.229, 0.357, 0.486, 0.614, 0.743, 0.871, 1.0)


def learning_curve(spark, sf_dir, sizes=CURVE_SIZES, k: int = fixed.CV_FOLDS, vocab_size: int = fixed.MAX_FEATURES) -> DataFrame:
    """Train / validation macro-F1 of LR on nested, class-balanced subsets
    of the training folds. A row's cell is its fold and the smallest subset that
    holds it: terms are taken once, and all fits go step by step in the same passes."""
    sizes = sorted(set(sizes))
    d = fe.stratified_ranks(cleaned(spark, sf_dir), "label", "doc_id").withColumn("fold", (F.col("rank") % k).cast("int"))
    step = F.lit(len(sizes))
    for s in range(len(sizes) - 1, -1, -1):
        step = F.when(F.col("rank") < F.col("class_n") * sizes[s], s).otherwise(step)
    d = d.withColumn("cell", F.col("fold") * (len(sizes) + 1) + step).select("doc_id", "label", "text", "cell").cache()
    idx = tr.index_labels(d)
    rows = tr.term_rows(idx.transform(d)).select("cell", "y", "terms").cache()
    cells = lambda folds, steps: [f * (len(sizes) + 1) + s for f in folds for s in steps]
    settings = [(f, s) for f in range(k) for s in range(len(sizes))]
    trained = [cells(others, range(s + 1)) for others in linear.other_folds(k) for s in range(len(sizes))]
    held = [cells([f], range(len(sizes) + 1)) for f, _ in settings]
    counts = linear.class_counts(rows, len(idx.labels), "cell")
    n = [sum((counts[c,] for c in part if (c,) in counts), np.zeros(len(idx.labels), np.int64)) for part in trained]
    vocab = linear.cell_terms(rows, trained, vocab_size, fixed.MIN_DF)
    blocks = linear.Cells(rows, vocab, trained, held, [vocab_size]).cache()
    weights = linear.fit(blocks.where(held=False), {p: linear.Problem(n[p], len(vocab[p].terms), (1.0,), linear.SOFTMAX) for p in range(len(settings))})
    f1 = [{p: linear.macro_f1(c[0]) for p, c in linear.confusion(blocks.where(held=part), weights).items()} for part in (False, True)]
    for used in (blocks, rows, d):
        used.unpersist()
    out = [(float(sizes[s]), f, int(n[p].sum()), *(round(scores[p], mt.R) for scores in f1)) for p, (f, s) in enumerate(settings)]
    df = spark.createDataFrame(out, "size double, fold int, n_train long, train_f1 double, val_f1 double")
    return df.groupBy("size").agg(F.round(F.avg("n_train"), 1).alias("n_train"),
                                  F.round(F.avg("train_f1"), 4).alias("train_macro_f1"),
                                  F.round(F.avg("val_f1"), 4).alias("val_macro_f1"))


@register("learning_curve")
def q_learning_curve(spark, sf_dir):
    return learning_curve(spark, sf_dir)


@register("top_coefficients")
def q_top_coefficients(spark, sf_dir, n: int = 15):
    fit = Fit(split_docs(spark, sf_dir))
    vocab = [s for s in fit.feats.stages if hasattr(s, "vocabulary")][0].vocabulary
    out = tr.top_coefficients(fit.model("logistic_regression"), vocab, fit.labels, n)
    fit.done()
    return out


@register("predict_proba")
def q_predict_proba(spark, sf_dir):
    fit = Fit(split_docs(spark, sf_dir))
    lr = fit.model("logistic_regression")
    fit.done()
    return tr.probabilities(lr, fit.part("test"), fit.labels)


def leaderboard(spark, sf_dir, kinds=tuple(tr.MODELS)) -> DataFrame:
    fit = Fit(split_docs(spark, sf_dir))
    out = None
    for kind in kinds:
        rows = fit.metrics(kind, fit.model(kind))
        out = rows if out is None else out.unionByName(rows)
    fit.done()
    return out


@register("leaderboard")
def q_leaderboard(spark, sf_dir):
    lb = leaderboard(spark, sf_dir).unionByName(q_dense_vector_lr(spark, sf_dir))
    return lb.where(F.col("split") == "val").orderBy(F.desc("macro_f1"), "model")


# -- scoring: model store, classify job --------------------------------------------------

INVOICE_IDS = 10_000_000_000     # added to an invoice's id in the scoring corpus


def _scoring_corpus(spark, sf_dir) -> DataFrame:
    """documents (label = lang) plus rendered invoices (label = invoice)."""
    d = table(spark, sf_dir, "documents").select(
        "doc_id", F.col("lang").alias("label"), F.col("text").alias("raw"))
    inv = invoices(spark, sf_dir).select(
        (F.col("doc_id") + INVOICE_IDS).alias("doc_id"), F.lit("invoice").alias("label"),
        F.col("text").alias("raw"))
    both = d.unionByName(inv)
    return both.withColumn("text", tx.clean_for_classifier("raw"))


def save_model(spark, sf_dir, key: str = "logistic_regression") -> str:
    """Fit features + indexer + model on the scoring corpus and save one
    PipelineModel in a folder of its own under the shared checkpoint folder."""
    # the fit needs neither the raw texts nor the other splits
    docs = fe.stratified_split(_scoring_corpus(spark, sf_dir).drop("raw"), "label", "doc_id")
    fit = Fit(docs.where(F.col("split") == "train"))
    model = fit.model(key)
    fit.done()
    members = list(model.stages) if isinstance(model, PipelineModel) else [model]
    path = scratch_path(spark, f"model-{key}-{uuid.uuid4().hex}")
    PipelineModel(stages=[*fit.feats.stages, fit.idx, *members]).write().save(path)
    return path


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def labels_of(pm: PipelineModel) -> list[str]:
    return [s for s in pm.stages if hasattr(s, "labels")][0].labels


@register("model_store")
def q_model_store(spark, sf_dir):
    """An SVM, saved and loaded: predictions per class over the scoring corpus."""
    pm = load_model(save_model(spark, sf_dir, "linear_svm"))
    scored = tr.predictions(pm, _scoring_corpus(spark, sf_dir))
    lab = F.element_at(F.array(*[F.lit(x) for x in labels_of(pm)]), (F.col("prediction") + 1).cast("int"))
    return scored.groupBy(lab.alias("prediction")).agg(F.count(F.lit(1)).alias("n"))


def classify(spark, path: str, docs: DataFrame, key: str, words: DataFrame | None = None) -> DataFrame:
    """clean -> features -> predict -> probabilities -> signal override ->
    extraction for invoices only. Text rules are per row; with ``words`` the
    invoices' boxes are read by the layout rules, whose values come first."""
    from ..operators.extract_layout import extract_from_words
    from ..operators.extract_text import extract_fields
    pm = load_model(path)
    prepared = docs.withColumns({"text": tx.clean_for_classifier("raw"), "n_signals": tx.signal_count("raw")})
    s = tr.invoice_override(tr.probabilities(pm, prepared, labels_of(pm), carry=("raw", "n_signals")))
    s = s.select("doc_id", "label", "confidence", "proba", F.lit(key).alias("model_used"), "n_signals", "overridden",
                 F.when(F.col("label") == "invoice", extract_fields(F.col("raw"))).alias("invoice_fields"))
    if words is None:
        return s
    layout = extract_from_words(words).select("doc_id", F.struct(*fixed.FIELDS).alias("_layout"))
    merged = F.struct(*[F.coalesce(F.col(f"_layout.{f}"), F.col(f"invoice_fields.{f}")).alias(f) for f in fixed.FIELDS])
    return s.join(layout, "doc_id", "left").withColumn(
        "invoice_fields", F.when(F.col("label") == "invoice", merged)).drop("_layout")


@register("classify_job")
def q_classify_job(spark, sf_dir):
    path = save_model(spark, sf_dir, "logistic_regression")
    words = word_boxes(invoices(spark, sf_dir).withColumn("doc_id", F.col("doc_id") + INVOICE_IDS))
    out = classify(spark, path, _scoring_corpus(spark, sf_dir).select("doc_id", "raw"), "logistic_regression", words)
    return out.select("doc_id", "label", "confidence", "model_used", "n_signals", "overridden",
                      "invoice_fields.*")


# the longest ones come last
@register("grid_search_svm")
def q_grid_search_svm(spark, sf_dir):
    return grid_search(spark, sf_dir, "linear_svm")


TUNED = ("logistic_regression", "linear_svm")


@register("select_best")
def q_select_best(spark, sf_dir):
    """Best test macro-F1 of the eight candidates: the five families, the
    dense vectors and the best of both grids. Ties go to the first of them."""
    tested = leaderboard(spark, sf_dir).unionByName(q_dense_vector_lr(spark, sf_dir)).where(F.col("split") == "test")
    found = {r.model: r.macro_f1 for r in tested.collect()}
    for kind in TUNED:
        found[f"tuned_{kind}"] = grid_search(spark, sf_dir, kind).where("best").first()["test_macro_f1"]
    order = [*tr.MODELS, "dense_vector_lr", *(f"tuned_{kind}" for kind in TUNED)]
    best = max(order, key=lambda m: found[m])
    return spark.createDataFrame([(best, float(found[best]))], "best_model string, best_test_macro_f1 double")
