"""Many linear models in one pass: every candidate, fold and class has weights of its own, one aggregate an iteration serves all.

A model is a column of one matrix. A task multiplies its rows with the whole matrix and adds up losses and gradients,
leaving out of each column the rows of that column's own test fold. The driver keeps the columns (parameters of models,
not rows) and moves each by its own limited-memory quasi-Newton step; several step lengths are tried in the same pass.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmine.functions.vectors import matrix
from sparkmine.lineage import scoped, small_table
from sparkmine.operators.metrics import summary

MEMORY = 10
STEPS = (1.0, 0.5, 0.25, 0.1, 0.02, 2.0)  # in the order in which equally good ones are taken
DECREASE = 1e-4
NO_FOLD = -1
ROWS = 4096  # rows a task multiplies at a time


@dataclass
class Stack:
    """Linear models: ``weights`` has a column for every (task, class); the last row is the intercept."""

    weights: np.ndarray
    classes: list[int]
    folds: list[int]  # the fold that a task leaves out, or NO_FOLD
    iterations: int

    def predictions(self, df: DataFrame, *, id_col: str, x_col: str, label_col: str, fold_col: str | None = None) -> DataFrame:
        """``(id, task, label, prediction)``: each row under the tasks whose test fold it is in, or under all tasks without folds.

        The class with the highest margin wins, the smallest of equals.
        """
        w, classes, folds = self.weights, np.array(self.classes, dtype=np.int32), np.array(self.folds)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for at in range(0, batch.num_rows, ROWS):
                    part = batch.slice(at, ROWS)
                    margin = (matrix(part.column("x")) @ w[:-1] + w[-1]).reshape(part.num_rows, len(folds), len(classes))
                    row, task = np.nonzero((part.column("fold").to_numpy()[:, None] == folds[None]) | (folds == NO_FOLD)[None])
                    best = margin[row, task].argmax(axis=1) if len(row) else row
                    yield pa.RecordBatch.from_arrays(
                        [part.column("id").take(pa.array(row)), pa.array(task.astype(np.int32)), part.column("label").take(pa.array(row)), pa.array(classes[best])],
                        names=["id", "task", "label", "prediction"])

        rows = _rows(df, x_col, label_col, fold_col).withColumn("id", F.col(id_col)).select("id", "x", "label", "fold")
        kind = df.schema[id_col].dataType.simpleString()
        return rows.mapInArrow(run, f"id {kind}, task int, label int, prediction int")


def _rows(df: DataFrame, x_col: str, label_col: str, fold_col: str | None) -> DataFrame:
    fold = F.col(fold_col).cast("int") if fold_col else F.lit(NO_FOLD)
    return df.withColumn("x", F.col(x_col).cast("array<double>")).withColumn("label", F.col(label_col).cast("int")).withColumn("fold", F.coalesce(fold, F.lit(NO_FOLD)))


def _hinge(margin: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Loss and slope of support vectors."""
    gap = 1.0 - y * margin
    return np.maximum(gap, 0.0), np.where(gap > 0, -y, 0.0)


def _logistic(margin: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    z = y * margin
    loss = np.logaddexp(0.0, -z)
    return loss, -y / (1.0 + np.exp(np.clip(z, -500, 500)))


LOSSES = {"hinge": _hinge, "logistic": _logistic}


def _sums(rows: DataFrame, weights: np.ndarray, folds: np.ndarray, classes: np.ndarray, loss: str) -> tuple[np.ndarray, np.ndarray]:
    """Loss and gradient sums of every column of ``weights (trial, width, model)``, test rows left out."""
    trials, width, models = weights.shape
    flat = np.concatenate(list(weights), axis=1)
    of_loss = LOSSES[loss]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, slope = np.zeros(trials * models), np.zeros((width, trials * models))
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                x = matrix(part.column("x"))
                y = np.where(part.column("label").to_numpy()[:, None] == classes[None], 1.0, -1.0)
                kept = part.column("fold").to_numpy()[:, None] != folds[None]
                if (folds == NO_FOLD).any():
                    kept = kept | (folds == NO_FOLD)[None]
                y, kept = np.tile(y, (1, trials)), np.tile(kept, (1, trials))
                value, d = of_loss(x @ flat[:-1] + flat[-1], y)
                d = d * kept
                total += (value * kept).sum(axis=0)
                slope[:-1] += x.T @ d
                slope[-1] += d.sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary()), pa.array([slope.tobytes()], pa.binary())], names=["loss", "slope"])

    found = rows.mapInArrow(run, "loss binary, slope binary").toArrow()  # one row a task
    total = sum(np.frombuffer(b) for b in found.column("loss").to_pylist())
    slope = sum(np.frombuffer(b).reshape(width, -1) for b in found.column("slope").to_pylist())
    split = lambda a: np.stack(np.split(a, trials, axis=-1))
    return split(np.asarray(total)), split(np.asarray(slope))


def _direction(g: np.ndarray, moves: list[np.ndarray], turns: list[np.ndarray]) -> np.ndarray:
    """Quasi-Newton direction of one model from its last moves and the turns of its gradient."""
    q, alphas = g.copy(), []
    for s, y in zip(reversed(moves), reversed(turns)):
        a = (s @ q) / (s @ y)
        alphas.append(a)
        q -= a * y
    if moves:
        q *= (moves[-1] @ turns[-1]) / (turns[-1] @ turns[-1])
    for s, y, a in zip(moves, turns, reversed(alphas)):
        q += s * (a - (y @ q) / (s @ y))
    return -q


@scoped
def fit_stack(df: DataFrame, *, x_col: str, label_col: str, penalties: Sequence[float], fold_col: str | None = None, n_folds: int = 1,
              loss: str = "hinge", max_iter: int = 100, tol: float = 1e-6) -> Stack:
    """One-against-rest models for every penalty ``C`` and fold, penalised by ``1 / (C * n)`` as single fits are; intercepts are free.

    With ``fold_col`` task ``i * n_folds + f`` has the i-th penalty and leaves fold f out. Rows without a label take
    no part. A class that a training side lacks keeps a model that never wins against a present one.
    """
    rows = _rows(df, x_col, label_col, fold_col).filter("label IS NOT NULL AND x IS NOT NULL").select("x", "label", "fold").persist()
    try:
        sizes = rows.groupBy("fold", "label").agg(F.count(F.lit(1)).alias("n"), F.max(F.size("x")).alias("width")).collect()  # folds x classes
        classes = sorted({r["label"] for r in sizes})
        folds = list(range(n_folds)) if fold_col else [NO_FOLD]
        tasks = [(c, f) for c in penalties for f in folds]
        if not classes:
            raise ValueError("no row has a label")
        count = {f: max(1, sum(r["n"] for r in sizes if f == NO_FOLD or r["fold"] != f)) for f in folds}
        width, k = max(r["width"] for r in sizes) + 1, len(classes)
        n = np.repeat([count[f] for _, f in tasks], k).astype(float)
        ridge = np.repeat([1.0 / (c * count[f]) for c, f in tasks], k)
        of_fold, of_class = np.repeat([f for _, f in tasks], k), np.tile(classes, len(tasks))
        free = np.ones(width)
        free[-1] = 0.0  # the intercept is not penalised

        def value(w: np.ndarray, on: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            total, slope = _sums(rows, w, of_fold[on], of_class[on], loss)
            own = free[None, :, None] * w
            return total / n[on] + 0.5 * ridge[on] * (own * w).sum(axis=1), slope / n[on] + ridge[on] * own

        w = np.zeros((width, len(n)))
        every = np.arange(len(n))
        at, grad = (v[0] for v in value(w[None], every))
        moves: list[list[np.ndarray]] = [[] for _ in every]
        turns: list[list[np.ndarray]] = [[] for _ in every]
        on, done, steps = every, 0, np.array(STEPS)
        for done in range(1, max_iter + 1):
            way = np.stack([_direction(grad[:, m], moves[m], turns[m]) for m in on], axis=1)
            down = (way * grad[:, on]).sum(axis=0)
            way[:, down >= 0] = -grad[:, on[down >= 0]]
            down = np.minimum(down, (way * grad[:, on]).sum(axis=0))
            first = np.array([1.0 if moves[m] else min(1.0, 1.0 / max(np.abs(grad[:, m]).sum(), 1e-12)) for m in on])
            tried = w[None][:, :, on] + steps[:, None, None] * (first * way)[None]
            values, slopes = value(tried, on)
            fine = values <= at[on] + DECREASE * steps[:, None] * first * down
            best = np.where(fine.any(axis=0), np.where(fine, values, np.inf).argmin(axis=0), -1)
            still = []
            for j, m in enumerate(on):
                if best[j] < 0:
                    if moves[m]:  # a fresh start from the steepest way down
                        moves[m], turns[m] = [], []
                        still.append(m)
                    continue
                new, g, v = tried[best[j], :, j], slopes[best[j], :, j], values[best[j], j]
                s, y = new - w[:, m], g - grad[:, m]
                if s @ y > 1e-12 * (y @ y):
                    moves[m], turns[m] = [*moves[m], s][-MEMORY:], [*turns[m], y][-MEMORY:]
                if at[m] - v > tol * max(abs(at[m]), abs(v), 1e-12):
                    still.append(m)
                w[:, m], grad[:, m], at[m] = new, g, v
            on = np.array(still, dtype=int)
            if not len(on):
                break
    finally:
        rows.unpersist()
    return Stack(w, classes, [f for _, f in tasks], done)


def search_linear(df: DataFrame, params: Sequence[Mapping[str, float]], *, id_col: str, x_col: str, label_col: str, fold_col: str, n_folds: int,
                  loss: str = "hinge", scoring: str = "accuracy", max_iter: int = 100) -> DataFrame:
    """``(candidate, params, mean_score, std_score)`` per map with a ``C``, all candidates and folds fitted in the same passes."""
    stack = fit_stack(df, x_col=x_col, label_col=label_col, penalties=[p["C"] for p in params], fold_col=fold_col, n_folds=n_folds, loss=loss, max_iter=max_iter)
    told = stack.predictions(df.filter(F.col(label_col).isNotNull()), id_col=id_col, x_col=x_col, label_col=label_col, fold_col=fold_col)
    per_task = summary(told, label_col="label", prediction_col="prediction", by=["task"])
    per_fold = per_task.select(F.floor(F.col("task") / n_folds).cast("int").alias("candidate"), F.coalesce(scoring, F.lit(0.0)).alias("score"))
    text = small_table(df.sparkSession, [(i, ", ".join(f"{k}={v}" for k, v in sorted(p.items()))) for i, p in enumerate(params)], "candidate int, params string")
    scored = per_fold.groupBy("candidate").agg((F.sum("score") / n_folds).alias("mean_score"), F.stddev_pop("score").alias("std_score"))
    return scored.join(F.broadcast(text), "candidate").select("candidate", "params", "mean_score", "std_score")
