"""Linear classifiers: all classes, penalties and folds in one data pass per step.

A *problem* is one training set (a fold with its own features). Its models are
one weight row per class for every penalty value ``C``: squared hinge, one
class against the rest (the penalty includes the intercept; a class's own rows
weigh n / (k n_c), the others 1), or multinomial logistic loss (rows weigh
n / (k n_c), the intercept is free). Both minimise |w|^2 / 2 + C * loss.

Rows are packed once into blocks of sparse rows and cached. One step is one
Spark job with a task per core, whatever the number of rows: every task multiplies its blocks with the trial weights of all
models of all problems and returns one loss and one gradient per model, summed
inside the task; with many tasks or large models they are summed again by groups
of tasks, so that large gradients reach the driver once per model. The driver
keeps weights and a short history in single precision per model (limited-memory
quasi-Newton with step halving), bounded by classes x features x penalties,
whatever the number of rows. Every model moves at its own pace: a step serves
those that try a new direction and those that halve their step alike, and
models that have converged drop out. A larger penalty value starts from the
same zero weights, as all are fitted in the same passes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import SparkContext
from pyspark.ml import Estimator
from pyspark.ml.classification import LogisticRegressionModel
from pyspark.ml.common import _py2java
from pyspark.ml.linalg import DenseMatrix, DenseVector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HINGE, SOFTMAX = "squared_hinge", "softmax"
MAX_STEPS = 1000
TOLERANCE = 1e-3                 # of the first gradient's length
HISTORY = 10
BLOCK_ROWS = 1000
DIRECT = 32                      # so many tasks report to the driver at once
DIRECT_BYTES = 16 << 20          # and no more than this together, above one gradient per model
LEFT_BYTES = 1 << 30             # of gradients that finished steps may leave in shuffle files
PACKED = "pid long, ptr binary, idx binary, val binary, y binary"


# ------------------------------------------------------------ blocks

def blocks_of(pid: int, ptr, idx, val, y) -> Iterator[tuple]:
    for lo in range(0, len(ptr) - 1, BLOCK_ROWS):
        hi = min(len(ptr) - 1, lo + BLOCK_ROWS)
        a, b = ptr[lo], ptr[hi]
        yield pid, (ptr[lo:hi + 1] - a).tobytes(), idx[a:b].tobytes(), val[a:b].tobytes(), y[lo:hi].tobytes()


def as_batch(blocks: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*blocks)) or [()] * 5
    return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), *(pa.array(c, pa.binary()) for c in cols[1:])],
                                      names=[c.split()[0] for c in PACKED.split(", ")])


def sparse_rows(x: pa.StructArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts of the rows, feature, value) of a column of vectors; a dense vector has no indices."""
    idx, val = x.field("indices"), x.field("values")
    n = val.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    ptr = np.r_[0, np.cumsum(n)]
    value = val.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    if idx.null_count == 0:
        return ptr, idx.flatten().to_numpy(zero_copy_only=False).astype(np.int32, copy=False), value
    dense = np.repeat(~idx.is_valid().to_numpy(zero_copy_only=False), n)
    feature = (np.arange(len(value)) - np.repeat(ptr[:-1], n)).astype(np.int32)
    feature[~dense] = idx.flatten().to_numpy(zero_copy_only=False)
    return ptr, feature, value


def packed(rows: DataFrame) -> DataFrame:
    """Blocks of rows (pid, y, features)."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            pids, y = b.column("pid").to_numpy(), b.column("y").to_numpy().astype(np.int32)
            ptr, idx, val = sparse_rows(b.column("features"))
            for pid in np.unique(pids).tolist():
                mine = pids == pid
                own = np.repeat(mine, np.diff(ptr))
                out += blocks_of(pid, np.r_[0, np.cumsum(np.diff(ptr)[mine])], idx[own], val[own], y[mine])
            yield as_batch(out)

    return rows.select("pid", "y", "features").mapInArrow(task, PACKED)


# ------------------------------------------------------------ tf-idf of all folds at once

@dataclass
class FoldTerms:
    """Terms of the rows outside a fold, most frequent first, and their idf."""
    terms: list[str]
    idf: np.ndarray


def cell_terms(rows: DataFrame, members: list[list[int]], most: int, min_df: int) -> list[FoldTerms]:
    """Per training set (the cells it is made of) the ``most`` frequent terms
    (ties by term) of its rows (cell, terms) that stand in ``min_df`` of them.
    Counts per term and cell are taken once; a set's are their sums."""
    one = lambda t, n, d: F.struct(t.alias("term"), F.lit(n).alias("n"), F.lit(d).alias("d"))
    each = rows.select("cell", F.explode(F.concat(F.transform("terms", lambda t: one(t, 1, 0)),
                                                  F.transform(F.array_distinct("terms"), lambda t: one(t, 0, 1)))).alias("x"))
    own = lambda c, cells: F.sum(F.when(F.col("cell").isin(cells), F.col(c)).otherwise(0))
    counts = (each.groupBy("cell", "x.term").agg(F.sum("x.n").alias("n"), F.sum("x.d").alias("d")).groupBy("term")
              .agg(F.sum("d").alias("d"), *[own(c, cells).alias(f"{c}{f}") for f, cells in enumerate(members) for c in ("n", "d")])
              .where(F.col("d") >= min_df)).cache()
    size = {r.cell: r["count"] for r in rows.groupBy("cell").count().collect()}
    out = []
    for f, cells in enumerate(members):
        top = counts.where(F.col(f"d{f}") >= min_df).orderBy(F.desc(f"n{f}"), "term").limit(most).select("term", f"d{f}").collect()
        n = sum(size.get(c, 0) for c in cells)
        out.append(FoldTerms([r[0] for r in top], np.log((1 + n) / (1 + np.array([r[1] for r in top], np.float64))) + 1))
    counts.unpersist()
    return out


def other_folds(folds: int) -> list[list[int]]:
    return [[c for c in range(folds) if c != f] for f in range(folds)]


def fold_terms(rows: DataFrame, folds: int, most: int, min_df: int) -> list[FoldTerms]:
    """Per fold the terms of the other folds' rows (fold, terms)."""
    return cell_terms(rows.withColumnRenamed("fold", "cell"), other_folds(folds), most, min_df)


class Cells:
    """The tf-idf rows of (cell, y, terms) for every training set and vocabulary
    size; problem = set x sizes + place of the size. A row is stored once, as the
    counts of the terms that any set knows; a task makes the rows of a set from them
    whenever it reads a block, so what is stored does not grow with the number of sets."""

    def __init__(self, rows: DataFrame, sets: list[FoldTerms], trained: list[list[int]], held: list[list[int]], sizes: list[int]):
        every = sorted({t for v in sets for t in v.terms})
        at = {t: i for i, t in enumerate(every)}

        def places(v: FoldTerms) -> np.ndarray:
            out = np.full(len(every), -1, np.int32)
            out[[at[t] for t in v.terms]] = np.arange(len(v.terms))
            return out

        sc = rows.sparkSession.sparkContext
        known = sc.broadcast(pa.array(every, pa.string()))
        self.sets = sc.broadcast([(places(v), v.idf, t, h) for v, t, h in zip(sets, trained, held)])
        self.sizes = sizes

        def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                for lo in range(0, whole.num_rows, BLOCK_ROWS):
                    b = whole.slice(lo, BLOCK_ROWS)
                    found = pc.index_in(b.column("terms").flatten(), value_set=known.value)
                    row = np.repeat(np.arange(b.num_rows), pc.fill_null(b.column("terms").value_lengths(), 0).to_numpy())
                    many = max(1, len(known.value))
                    pair, times = np.unique(row[found.is_valid().to_numpy(zero_copy_only=False)] * many + found.drop_null().to_numpy(), return_counts=True)
                    yield as_batch([(0, np.searchsorted(pair // many, np.arange(b.num_rows + 1)).tobytes(), (pair % many).astype(np.int32).tobytes(),
                                     times.astype(np.int32).tobytes(), b.column("y").to_numpy().astype(np.int32).tobytes())]).append_column(
                                         "cells", pa.array([b.column("cell").to_numpy().astype(np.int32).tobytes()], pa.binary()))

        self.blocks = rows.select("cell", "y", "terms").mapInArrow(task, PACKED + ", cells binary")

    def cache(self) -> "Cells":
        self.blocks = self.blocks.cache()
        return self

    def unpersist(self) -> None:
        self.blocks.unpersist()

    def where(self, held: bool) -> "Part":
        """The rows held out, else those trained on."""
        return Part(self.blocks, self.sets, self.sizes, held)


@dataclass
class Part:
    """Blocks of ``Cells`` as ``fit`` and ``confusion`` read them."""
    blocks: DataFrame
    sets: object
    sizes: list[int]
    held: bool

    def reader(self):
        sets, sizes, held = self.sets, self.sizes, self.held

        def read(b: pa.RecordBatch, wanted) -> Iterator[tuple]:
            for ptr, term, times, y, cells in zip(*(b.column(c).to_pylist() for c in ("ptr", "idx", "val", "y", "cells"))):
                ptr, y, cells = np.frombuffer(ptr, np.int64), np.frombuffer(y, np.int32), np.frombuffer(cells, np.int32)
                term, times = np.frombuffer(term, np.int32), np.frombuffer(times, np.int32)
                row = np.repeat(np.arange(len(y)), np.diff(ptr))
                for f, (place, idf, *parts) in enumerate(sets.value):
                    pids = [f * len(sizes) + k for k in range(len(sizes))]
                    mine = np.isin(cells, parts[held])
                    if not mine.any() or not any(p in wanted for p in pids):
                        continue
                    some = mine[row]
                    idx = place[term[some]]
                    own = idx >= 0
                    idx, at_row = idx[own], row[some][own]
                    val = times[some][own] * idf[idx]
                    for pid, size in zip(pids, sizes):
                        if pid in wanted:
                            keep = idx < size
                            norm = np.sqrt(np.bincount(at_row[keep], val[keep] ** 2, len(y)))
                            n = np.bincount(at_row[keep], minlength=len(y))[mine]
                            yield pid, np.r_[0, np.cumsum(n)], idx[keep], val[keep] / norm[at_row[keep]], y[mine]

        return read


def fold_cells(rows: DataFrame, folds: list[FoldTerms], sizes: list[int]) -> Cells:
    """The rows (fold, y, terms) for every fold and vocabulary size; a fold's own rows are held out."""
    return Cells(rows.withColumnRenamed("fold", "cell"), folds, other_folds(len(folds)), [[f] for f in range(len(folds))], sizes)


def packed_folds(rows: DataFrame, folds: list[FoldTerms], sizes: list[int]) -> DataFrame:
    """Blocks of the rows (fold, y, terms) for every fold and vocabulary size;
    ``held``: the fold's own rows, else the others."""
    cells = fold_cells(rows, folds, sizes)
    readers, every = [(h, cells.where(h).reader()) for h in (False, True)], set(range(len(folds) * len(sizes)))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for is_held, read in readers:
                out = [block for x in read(b, every) for block in blocks_of(*x)]
                yield as_batch(out).append_column("held", pa.array(np.full(len(out), is_held)))

    return cells.blocks.mapInArrow(task, PACKED + ", held boolean")


def unpacked(b: pa.RecordBatch) -> Iterator[tuple]:
    for pid, ptr, idx, val, y in zip(*(b.column(c).to_pylist() for c in ("pid", "ptr", "idx", "val", "y"))):
        yield pid, np.frombuffer(ptr, np.int64), np.frombuffer(idx, np.int32), np.frombuffer(val), np.frombuffer(y, np.int32)


def reader_of(blocks):
    """(data frame, what reads the wanted problems' rows in a batch of it)."""
    if isinstance(blocks, Part):
        return blocks.blocks, blocks.reader()
    return blocks, lambda b, wanted: (x for x in unpacked(b) if x[0] in wanted)


def margins(ptr, idx, val, w: np.ndarray) -> np.ndarray:
    """(rows of w) x (rows of the block); the last column of w is the intercept."""
    out = np.repeat(w[:, -1:], len(ptr) - 1, 1)
    some = np.flatnonzero(np.diff(ptr))
    if len(some):
        for r in range(len(w)):
            out[r, some] += np.add.reduceat(w[r, idx] * val, ptr[some])
    return out


def gradients(ptr, idx, val, dz: np.ndarray, size: int) -> np.ndarray:
    """Sum over the rows of dz times the row, per row of dz."""
    n = np.diff(ptr)
    out = np.empty((len(dz), size))
    for r in range(len(dz)):
        out[r, :-1] = np.bincount(idx, np.repeat(dz[r], n) * val, size - 1)
    out[:, -1] = dz.sum(1)
    return out


# ------------------------------------------------------------ losses

@dataclass
class Problem:
    """``n`` rows per class, number of features, penalties."""
    n: np.ndarray
    size: int
    Cs: tuple[float, ...]
    loss: str

    @property
    def balanced(self) -> np.ndarray:
        """n / (k n_c); a class without rows weighs nothing."""
        return np.where(self.n > 0, self.n.sum() / (len(self.n) * np.maximum(self.n, 1)), 0.0)

    def units(self) -> list[tuple[int, ...]]:
        """Shapes of the models that move on their own: hinge models by
        penalty and class, softmax models by penalty."""
        k, d = len(self.n), self.size + 1
        return [(1, d)] * (k * len(self.Cs)) if self.loss == HINGE else [(k, d)] * len(self.Cs)

    def data_loss(self, unit: int, z: np.ndarray, y: np.ndarray) -> tuple[float, np.ndarray]:
        """C * loss of a block and its derivative by the margins."""
        k = len(self.n)
        if self.loss == HINGE:
            C, c = self.Cs[unit // k], unit % k
            sign = np.where(y == c, 1.0, -1.0)
            weight = C * np.where(y == c, self.balanced[c], 1.0)
            short = np.maximum(0.0, 1.0 - sign * z[0])
            return float((weight * short * short).sum()), (-2.0 * weight * sign * short)[None, :]
        weight = self.Cs[unit] * self.balanced[y]
        z = z - z.max(0)
        e = np.exp(z)
        p = e / e.sum(0)
        at = (y, np.arange(len(y)))
        loss = float((weight * (np.log(e.sum(0)) - z[at])).sum())
        p[at] -= 1.0
        return loss, p * weight

    def penalty(self, w: np.ndarray) -> tuple[float, np.ndarray]:
        g = w.copy()
        if self.loss == SOFTMAX:
            g[:, -1] = 0.0
        return 0.5 * float((g * g).sum()), g


@dataclass
class Descent:
    """One model's weights and its limited-memory quasi-Newton state."""
    w: np.ndarray
    loss: float = np.inf
    g: np.ndarray | None = None
    direction: np.ndarray | None = None
    step: float = 1.0
    first: float = 0.0
    done: bool = False
    steps: int = 0
    moves: list = field(default_factory=list)

    def trial(self) -> np.ndarray:
        return self.w if self.g is None else self.w + self.step * self.direction

    def take(self, loss: float, g: np.ndarray) -> None:
        """What the trial gave: accept it and turn, or halve the step."""
        if self.g is None:
            self.loss, self.g, self.first = loss, g, float(np.linalg.norm(g))
        else:
            slope = float((self.g * self.direction).sum())
            if loss > self.loss + 1e-4 * self.step * slope:
                self.step /= 2
                self.done = self.step < 1e-10
                return
            s, y = self.step * self.direction, g - self.g
            if (s * y).sum() > 1e-12:
                self.moves = [*self.moves[1 - HISTORY:], (s.astype(np.float32), y.astype(np.float32), 1.0 / float((s * y).sum()))]
            self.w, self.loss, self.g = self.w + s, loss, g
        self.steps += 1
        self.done = float(np.linalg.norm(self.g)) <= TOLERANCE * self.first or self.steps >= MAX_STEPS
        q, back = -self.g, []
        for s, y, r in reversed(self.moves):
            a = r * float((s * q).sum())
            back.append(a)
            q = q - a * y
        if self.moves:
            s, y, _ = self.moves[-1]
            q = q * (float((s * y).sum()) / float((y * y).sum()))
        for (s, y, r), a in zip(self.moves, reversed(back)):
            q = q + (a - r * float((y * q).sum())) * s
        self.direction = q
        self.step = 1.0 if self.moves else min(1.0, 1.0 / max(self.first, 1e-12))


def summed(parts: DataFrame, tasks: int, size: int) -> list:
    """Per (pid, unit) the sum of the tasks' losses and gradients, ``size`` bytes
    a task. Up to ``DIRECT`` tasks and ``DIRECT_BYTES`` report to the driver; more
    are summed in groups first."""
    def add(t: pa.Table) -> pa.Table:
        g = np.sum([np.frombuffer(x) for x in t.column("g").to_pylist()], axis=0)
        return pa.Table.from_pydict({"pid": t.column("pid")[:1], "unit": t.column("unit")[:1], "part": t.column("part")[:1],
                                     "loss": pa.array([sum(t.column("loss").to_pylist())]), "g": pa.array([g.tobytes()], pa.binary())})
    while tasks > DIRECT or tasks > 1 and tasks * size > DIRECT_BYTES:
        tasks = -(-tasks // DIRECT)
        parts = (parts.withColumn("part", F.col("part") % tasks).groupBy("pid", "unit", "part")
                 .applyInArrow(add, "pid long, unit long, part long, loss double, g binary"))
    return parts.collect()


def drop_shuffles(sc) -> None:
    """Spark deletes the shuffle files of finished steps once its driver has collected their garbage."""
    sc._jvm.System.gc()


def per_core(stored: DataFrame, each: int = 1) -> DataFrame:
    """Stored rows for one step: ``each`` tasks per core, which read several stored
    partitions, so that what a step sends does not grow with the rows."""
    return stored.coalesce(max(1, min(stored.rdd.getNumPartitions(), each * stored.sparkSession.sparkContext.defaultParallelism)))


def fit(blocks: DataFrame | Part, problems: dict[int, Problem]) -> dict[int, np.ndarray]:
    """Weights (penalty, class, feature and intercept) of every problem."""
    blocks, read = reader_of(blocks)
    sc, blocks = blocks.sparkSession.sparkContext, per_core(blocks)
    tasks = blocks.rdd.getNumPartitions()
    state = {(pid, u): Descent(np.zeros(shape)) for pid, p in problems.items() for u, shape in enumerate(p.units())}
    left = 0
    while any(not s.done for s in state.values()):
        trials = {key: s.trial() for key, s in state.items() if not s.done}
        shared = sc.broadcast((problems, trials))

        def task(batches):
            from pyspark import TaskContext
            known, w = shared.value
            total: dict[tuple[int, int], list] = {}
            units: dict[int, list[int]] = {}
            for pid, u in w:
                units.setdefault(pid, []).append(u)
            for b in batches:
                for pid, ptr, idx, val, y in read(b, units):
                    mine = units[pid]
                    stack = np.concatenate([w[pid, u] for u in mine])
                    z = margins(ptr, idx, val, stack)
                    at = np.cumsum([0, *(len(w[pid, u]) for u in mine)])
                    found = [known[pid].data_loss(u, z[a:c], y) for u, a, c in zip(mine, at, at[1:])]
                    g = gradients(ptr, idx, val, np.concatenate([dz for _, dz in found]), stack.shape[1])
                    for u, (loss, _), a, c in zip(mine, found, at, at[1:]):
                        entry = total.setdefault((pid, u), [0.0, 0.0])
                        entry[0] += loss
                        entry[1] = entry[1] + g[a:c]
            part = TaskContext.get().partitionId()
            for (pid, u), (loss, g) in total.items():
                yield pa.RecordBatch.from_pydict({"pid": [pid], "unit": [u], "part": [part], "loss": [loss], "g": pa.array([g.tobytes()], pa.binary())})

        got: dict[tuple[int, int], list] = {}
        size = sum(w.nbytes for w in trials.values())
        for r in summed(blocks.mapInArrow(task, "pid long, unit long, part long, loss double, g binary"), tasks, size):
            entry = got.setdefault((r.pid, r.unit), [0.0, 0.0])
            entry[0] += r.loss
            entry[1] = entry[1] + np.frombuffer(r.g)
        shared.destroy()
        left += tasks * size if tasks > DIRECT or tasks * size > DIRECT_BYTES else 0
        if left > LEFT_BYTES:
            drop_shuffles(sc)
            left = 0
        for key, w in trials.items():
            loss, g = got.get(key, (0.0, np.zeros(w.size)))                    # no rows: only the penalty
            more, own = problems[key[0]].penalty(w)
            state[key].take(loss + more, np.reshape(g, w.shape) + own)
    out = {}
    for pid, p in problems.items():
        rows = np.concatenate([state[pid, u].w for u in range(len(p.units()))])
        out[pid] = rows.reshape(len(p.Cs), len(p.n), p.size + 1)
    return out


def confusion(blocks: DataFrame | Part, weights: dict[int, np.ndarray]) -> dict[int, np.ndarray]:
    """Per problem: counts (penalty, class, predicted class)."""
    blocks, read = reader_of(blocks)
    shared = blocks.sparkSession.sparkContext.broadcast(weights)

    def task(batches):
        total = {}
        for b in batches:
            for pid, ptr, idx, val, y in read(b, shared.value):
                w = shared.value[pid]
                c, k, d = w.shape
                best = margins(ptr, idx, val, w.reshape(c * k, d)).reshape(c, k, -1).argmax(1)
                cell = (np.arange(c)[:, None] * k + y[None, :]) * k + best
                total[pid] = total.get(pid, 0) + np.bincount(cell.ravel(), minlength=c * k * k)
        for pid, n in total.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_pydict({"pid": np.full(len(at), pid), "cell": at, "n": n[at]})

    out = {pid: np.zeros(w.shape[0] * w.shape[1] ** 2, np.int64) for pid, w in weights.items()}
    for r in blocks.mapInArrow(task, "pid long, cell long, n long").groupBy("pid", "cell").agg(F.sum("n").alias("n")).collect():
        out[r.pid][r.cell] = r.n
    return {pid: n.reshape(weights[pid].shape[0], weights[pid].shape[1], -1) for pid, n in out.items()}


def macro_f1(counts: np.ndarray) -> float:
    """Of one confusion matrix, over the classes that occur or are predicted."""
    hit, truth, told = np.diag(counts), counts.sum(1), counts.sum(0)
    seen = (truth + told) > 0
    return float((2.0 * hit[seen] / (truth + told)[seen]).mean()) if seen.any() else 0.0


def class_counts(rows: DataFrame, k: int, *by: str) -> dict[tuple, np.ndarray]:
    out: dict[tuple, np.ndarray] = {}
    for r in rows.groupBy(*by, "y").count().collect():
        out.setdefault(tuple(r[c] for c in by), np.zeros(k, np.int64))[int(r.y)] = r["count"]
    return out


# ------------------------------------------------------------ as a Spark model

def linear_model(w: np.ndarray) -> LogisticRegressionModel:
    """A model of the JVM with these margins (class, feature and intercept):
    raw predictions are the margins, probabilities their softmax."""
    sc = SparkContext._active_spark_context
    k, d = w.shape
    matrix = DenseMatrix(k, d - 1, w[:, :-1].ravel(order="F").tolist())
    jvm = sc._jvm.org.apache.spark.ml.classification.LogisticRegressionModel(
        "linear_" + format(abs(hash(w.tobytes())), "x"), _py2java(sc, matrix), _py2java(sc, DenseVector(w[:, -1])), k, True)
    return LogisticRegressionModel(jvm)


class Linear(Estimator):
    """One problem and one penalty; fits (y, features)."""

    def __init__(self, loss: str, C: float = 1.0):
        super().__init__()
        self.loss, self.C = loss, C

    def _fit(self, df: DataFrame) -> LogisticRegressionModel:
        rows = df.select(F.lit(0).cast("long").alias("pid"), "y", "features")
        k = int(df.agg(F.max("y")).first()[0]) + 1
        size = len(df.select("features").first()[0])
        blocks = packed(rows).cache()
        n = class_counts(rows, k)[()]
        w = fit(blocks, {0: Problem(n, size, (self.C,), self.loss)})[0][0]
        blocks.unpersist()
        return linear_model(w)
