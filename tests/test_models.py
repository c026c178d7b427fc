"""Floors of the classifiers, and saving of every kind that scoring uses."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from helpers import SF001
from quarry.operators import linear, metrics, train
from quarry.plans import model_plans as mp


@pytest.fixture(scope="module")
def fit(spark):
    out = mp.Fit(mp.split_docs(spark, SF001))
    yield out
    out.done()


@pytest.mark.parametrize("kind, floor", [("naive_bayes", 0.85), ("logistic_regression", 0.9), ("linear_svm", 0.95), ("random_forest", 0.8)])
def test_macro_f1_floor(fit, kind, floor):
    preds = train.evaluate(fit.model(kind), fit.part("val").unionByName(fit.part("test")), fit.labels)
    assert metrics.summary(preds).first()["macro_f1"] >= floor


def test_svm_is_saved_and_loaded(spark, fit, tmp_path):
    from pyspark.ml import PipelineModel
    model = fit.model("linear_svm")
    path = str(tmp_path / "svm")
    PipelineModel(stages=[*fit.feats.stages, fit.idx, model]).write().save(path)
    test = fit.split.where(F.col("split") == "test").select("doc_id", "label", "text")
    again = mp.load_model(path)
    assert mp.labels_of(again) == fit.labels
    a = {r.doc_id: r.prediction for r in train.predictions(again, test).collect()}
    b = {r.doc_id: r.prediction for r in train.predictions(model, fit.part("test")).collect()}
    assert a == b and len(a) > 0
    p = train.probabilities(again, test, fit.labels, carry=("text",)).first()
    assert 0 < p.confidence <= 1 and set(p.proba) == set(fit.labels)


def test_grid_refits_the_best(spark):
    rows = mp.grid_search(spark, SF001, "logistic_regression", vocab_sizes=(500,), ngrams=(1,), Cs=(0.1, 10.0), k=2).collect()
    assert len(rows) == 2 and sum(r.best for r in rows) == 1
    best = [r for r in rows if r.best][0]
    assert best.cv_macro_f1 == max(r.cv_macro_f1 for r in rows) and best.test_macro_f1 > 0.5


@pytest.mark.parametrize("kind, want", [("linear_svm", [0.01, 0.1, 1.0]), ("logistic_regression", [0.1, 1.0, 10.0])])
def test_each_grid_has_its_own_penalties(spark, kind, want):
    rows = mp.grid_search(spark, SF001, kind, vocab_sizes=(200, 300), ngrams=(1,), k=2).collect()
    assert sorted(r.C for r in rows if r.vocab_size == 200) == want and len(rows) == 6 and sum(r.best for r in rows) == 1
    assert all(0.3 < r.cv_macro_f1 <= 1 for r in rows)


def toy(spark, n=240, d=12, k=3, seed=1):
    r = np.random.default_rng(seed)
    centre, y = r.normal(0, 1.2, (k, d)), r.integers(0, k, n)
    y[: n // 3] = 0
    x = np.where(r.random((n, d)) < 0.5, 0.0, centre[y] + r.normal(0, 1, (n, d)))
    rows = [(int(i % 2), float(c), Vectors.dense(v) if i % 5 else Vectors.sparse(d, {j: v[j] for j in np.flatnonzero(v)}))
            for i, (c, v) in enumerate(zip(y, x))]
    return x, y, spark.createDataFrame(rows, ["pid", "y", "features"])


@pytest.mark.parametrize("loss", [linear.HINGE, linear.SOFTMAX])
def test_weights_are_at_the_minimum(spark, monkeypatch, loss):
    """Two problems with two penalties in the same passes: the gradient of the
    objective, written out anew, vanishes at every model's weights."""
    monkeypatch.setattr(linear, "TOLERANCE", 1e-6)
    x, y, rows = toy(spark)
    k, Cs = 3, (0.05, 1.0)
    counts = linear.class_counts(rows, k, "pid")
    found = linear.fit(linear.packed(rows.repartition(3)), {p: linear.Problem(counts[p,], x.shape[1], Cs, loss) for p in (0, 1)})
    for p in (0, 1):
        xp, yp = np.c_[x, np.ones(len(x))][p::2], y[p::2]
        bal = len(yp) / (k * np.bincount(yp, minlength=k))
        for j, C in enumerate(Cs):
            w = found[p][j]
            z = xp @ w.T
            if loss == linear.HINGE:
                s = np.where(yp[:, None] == np.arange(k), 1.0, -1.0)
                weight = np.where(s > 0, bal, 1.0)
                g = w + (-2 * C * weight * s * np.maximum(0, 1 - s * z)).T @ xp
            else:
                e = np.exp(z - z.max(1, keepdims=True))
                g = w + C * ((e / e.sum(1, keepdims=True) - (yp[:, None] == np.arange(k))) * bal[yp][:, None]).T @ xp
                g[:, -1] -= w[:, -1]
            assert np.abs(g).max() < 1e-3 * max(1.0, C * len(yp))
        cells = linear.confusion(linear.packed(rows.where(F.col("pid") == p)), {p: found[p]})[p]
        assert cells.sum() == 2 * len(yp)
        assert cells[1].tolist() == [[int(((yp == a) & ((xp @ found[p][1].T).argmax(1) == b)).sum()) for b in range(k)] for a in range(k)]


def test_many_tasks_are_summed_in_groups(spark, monkeypatch):
    x, y, rows = toy(spark)
    counts = linear.class_counts(rows, 3, "pid")
    problems = {p: linear.Problem(counts[p,], x.shape[1], (0.3,), linear.HINGE) for p in (0, 1)}
    few = linear.fit(linear.packed(rows.coalesce(1)), problems)
    monkeypatch.setattr(linear, "DIRECT", 2)
    many = linear.fit(linear.packed(rows.repartition(7)), problems)
    assert all(np.abs(few[p] - many[p]).max() < 1e-2 for p in problems)


def test_large_gradients_reach_the_driver_once_per_model(spark, monkeypatch):
    parts = spark.range(0, 12, 1, 6).selectExpr("id % 2 AS pid", "0L AS unit", "int(id / 2) AS part", "1.0D AS loss").withColumn(
        "g", F.lit(np.ones(4).tobytes())).withColumn("part", F.col("part").cast("long"))
    assert len(linear.summed(parts, 6, 64)) == 12
    monkeypatch.setattr(linear, "DIRECT_BYTES", 100)
    found = linear.summed(parts, 6, 64)
    assert sorted((r.pid, r.loss, np.frombuffer(r.g).tolist()) for r in found) == [(p, 6.0, [6.0] * 4) for p in (0, 1)]


def test_fold_features_equal_the_pipeline(spark):
    """Terms, idf and rows of every fold as the fitted stages give them, cut to each vocabulary size."""
    r = np.random.default_rng(3)
    words = [f"t{i:02d}" for i in range(40)]
    docs = [(i, int(i % 3), float(i % 2), " ".join(r.choice(words, r.integers(1, 30), p=0.75 ** np.arange(40) / (0.75 ** np.arange(40)).sum()))) for i in range(60)]
    rows = train.term_rows(spark.createDataFrame(docs, ["doc_id", "fold", "y", "text"]), 1)
    vocab = linear.fold_terms(rows, 3, 60, 3)
    found = {}
    for b in linear.packed_folds(rows.repartition(4), vocab, [4, 60]).collect():
        for _, ptr, idx, val, y in linear.unpacked(pa.RecordBatch.from_pylist([{c: b[c] for c in ("pid", "ptr", "idx", "val", "y")}])):
            for lo, hi in zip(ptr, ptr[1:]):
                found.setdefault((b.pid, b.held), []).append(sorted(zip(idx[lo:hi].tolist(), np.round(val[lo:hi], 9).tolist())))
    for f in range(3):
        for i, size in enumerate((4, 60)):
            feats = train.fit_features(rows.where(F.col("fold") != f).drop("terms"), vocab_size=size, ngram_max=1)
            names = [s for s in feats.stages if hasattr(s, "vocabulary")][0].vocabulary
            assert set(names) == set(vocab[f].terms[:size])
            place = {t: k for k, t in enumerate(vocab[f].terms)}
            for held in (False, True):
                part = feats.transform(rows.drop("terms").where((F.col("fold") == f) == F.lit(held))).select("features").collect()
                want = [sorted((place[names[j]], round(float(v), 9)) for j, v in zip(x.features.indices, x.features.values)) for x in part]
                assert sorted(found[2 * f + i, held]) == sorted(want)


@pytest.mark.parametrize("svm, best", [(0.95, "tuned_linear_svm"), (0.91, "random_forest"), (0.92, "random_forest")])
def test_select_best_ranks_the_tuned_models(spark, monkeypatch, svm, best):
    f1 = {"naive_bayes": 0.8, "linear_svm": 0.9, "logistic_regression": 0.9, "random_forest": 0.92, "boosted_trees": 0.7}
    cols = "model string, split string, accuracy double, macro_f1 double, weighted_f1 double"
    small = lambda found: spark.createDataFrame([(m, s, x, x, x) for m, v in found.items() for s, x in (("val", 1.0), ("test", v))], cols)
    monkeypatch.setattr(mp, "leaderboard", lambda *a, **kw: small(f1))
    monkeypatch.setattr(mp, "q_dense_vector_lr", lambda *a: small({"dense_vector_lr": 0.6}))
    monkeypatch.setattr(mp, "grid_search", lambda spark, sf, kind, **kw: spark.createDataFrame(
        [(kind, False, None), (kind, True, svm if kind == "linear_svm" else 0.9)], "model string, best boolean, test_macro_f1 double"))
    row = mp.q_select_best(spark, SF001).first()
    assert (row.best_model, row.best_test_macro_f1) == (best, max(svm, 0.92))


def test_top_coefficients_are_the_extremes(fit):
    lr = fit.model("logistic_regression")
    vocab = [s for s in fit.feats.stages if hasattr(s, "vocabulary")][0].vocabulary
    rows = train.top_coefficients(lr, vocab, fit.labels, 5).collect()
    m = lr.coefficientMatrix.toArray()
    for c, label in enumerate(fit.labels):
        top = [r.weight for r in sorted((r for r in rows if r.label == label and r.side == "top"), key=lambda r: r.rank)]
        assert top == [round(float(x), 6) for x in sorted(m[c], reverse=True)[:5]]


def test_a_step_has_a_task_per_core(spark):
    """What a step sends does not grow with the number of stored partitions."""
    rows = spark.range(0, 1000, 1, 100)
    assert linear.per_core(rows).rdd.getNumPartitions() == min(100, spark.sparkContext.defaultParallelism)
    assert linear.per_core(rows.coalesce(1)).rdd.getNumPartitions() == 1


def test_curve_has_every_subset(spark, monkeypatch):
    """All fits of the curve go in one set of passes, over the subsets that are asked for."""
    calls, fit_all = [], linear.fit
    monkeypatch.setattr(linear, "fit", lambda blocks, problems: calls.append(problems) or fit_all(blocks, problems))
    got = {r["size"]: r for r in mp.learning_curve(spark, SF001, sizes=(0.4, 1.0), k=2, vocab_size=500).collect()}
    assert len(calls) == 1 and len(calls[0]) == 4
    d = mp.fe.stratified_ranks(mp.cleaned(spark, SF001), "label", "doc_id").withColumn("fold", F.col("rank") % 2).cache()
    for s in (0.4, 1.0):
        n, scores = [], []
        for f in (0, 1):
            marked = d.where((F.col("fold") == f) | (F.col("rank") < F.col("class_n") * s)).withColumn("split", F.when(F.col("fold") == f, "val").otherwise("train"))
            one = mp.Fit(marked, 500)
            m = one.model("logistic_regression")
            n.append(one.n)
            scores.append([metrics.summary(train.evaluate(m, x, one.labels)).first()["macro_f1"] for x in (one.rows, one.part("val"))])
            one.done()
        assert got[s].n_train == sum(n) / 2
        # ties at the end of a vocabulary may fall otherwise
        assert abs(got[s].train_macro_f1 - sum(x for x, _ in scores) / 2) < 0.03 and abs(got[s].val_macro_f1 - sum(x for _, x in scores) / 2) < 0.05
    d.unpersist()


def test_what_a_curve_stores_does_not_grow_with_its_fits(spark):
    """A row is stored once, however many training sets it is part of."""
    docs = [(i % 3, float(i % 2), [f"t{j}" for j in range(i % 7, i % 7 + 9)]) for i in range(120)]
    rows = spark.createDataFrame(docs, ["cell", "y", "terms"]).coalesce(2)
    size = {}
    for sets in (1, 20):
        trained = [[0, 1]] * sets
        cells = linear.Cells(rows, linear.cell_terms(rows, trained, 10, 1), trained, [[2]] * sets, [5, 10])
        size[sets] = [sum(len(r[c]) for r in cells.blocks.collect()) for c in ("idx", "val", "y")]
        read = cells.where(held=False).reader()
        assert {x[0] for b in cells.blocks.toArrow().to_batches() for x in read(b, range(2 * sets))} == set(range(2 * sets))
    assert size[1] == size[20]


def test_features_are_fitted_in_one_pass(spark):
    """Counts of terms and of their rows, as written out; the texts are read once for both."""
    docs = [(i, "alpha beta alpha" if i % 2 else None if i == 4 else "beta gamma") for i in range(9)]
    rows = train.term_rows(spark.createDataFrame(docs, "doc_id int, text string").repartition(3), 1)
    assert sorted(map(tuple, train.term_counts(rows).collect())) == [("alpha", 8, 4), ("beta", 8, 8), ("gamma", 4, 4)]
    feats = train.fit_features(rows.drop("terms").where("text is not null"), min_df=4, vocab_size=2, ngram_max=1)
    assert [s for s in feats.stages if hasattr(s, "vocabulary")][0].vocabulary == ["alpha", "beta"]
    assert [s for s in feats.stages if hasattr(s, "getScalingVec")][0].getScalingVec().toArray().tolist() == pytest.approx([np.log(9 / 5) + 1, 1.0])


def test_each_signal_is_looked_for_once(spark):
    from quarry.functions import fixed
    from quarry.functions import text as tx
    out = spark.createDataFrame([("x",)], "raw string").select(tx.clean_for_classifier("raw").alias("text"))
    assert out._jdf.queryExecution().analyzed().toString().count("RLIKE") == len(fixed.INVOICE_SIGNALS)


def test_finished_steps_leave_no_shuffle_files(spark, monkeypatch):
    """Gradients that are summed on the way are dropped every so many bytes, not kept until the fit ends."""
    x, y, rows = toy(spark)
    counts, calls = linear.class_counts(rows, 3, "pid"), []
    problems = {0: linear.Problem(counts[0,], x.shape[1], (0.3,), linear.SOFTMAX)}
    want = linear.fit(linear.packed(rows.repartition(3)), problems)
    monkeypatch.setattr(linear, "drop_shuffles", calls.append)
    linear.fit(linear.packed(rows.repartition(3)), problems)
    assert not calls
    monkeypatch.setattr(linear, "DIRECT_BYTES", 1)
    monkeypatch.setattr(linear, "LEFT_BYTES", 1000)
    found = linear.fit(linear.packed(rows.repartition(3)), problems)
    assert len(calls) > 1 and np.abs(found[0] - want[0]).max() < 1e-2
