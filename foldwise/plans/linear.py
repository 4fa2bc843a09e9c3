"""Linear models of all folds at once (M1-M3).

One scan of the rows gives every fit fold what its solver needs: merged by a tree reduce on the
executors, one small matrix a fold reaches the driver.

* Squared loss: moments (count, means, centred scatter matrix) are enough for ridge and for
  any number of elastic-net penalties; coordinate descent runs on the fold's Gram matrix.
* Logistic loss: each scan adds up loss, gradient and Hessian of all folds at their
  current weights; a Newton step is solved a fold, with coordinate descent where there is an L1 part.

Rows carry ``fit_fold``, ``label`` and the vector ``features``. Weights become literals of
one projection that scores the rows of all folds.
"""

from __future__ import annotations

import pickle
from collections.abc import Sequence
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foldwise.operators.base import FIT_FOLD
from foldwise.session import ship_package


def merge_moments(a: tuple, b: tuple) -> tuple:
    """Row counts, means and scatter matrices of two parts as those of both (no uncentred sums)."""
    if not a[0] or not b[0]:
        return b if not a[0] else a
    n, shift = a[0] + b[0], b[1] - a[1]
    return n, a[1] + shift * (b[0] / n), a[2] + b[2] + np.outer(shift, shift) * (a[0] * b[0] / n)


def _merge_folds(a: dict, b: dict) -> dict:
    none = (0, None, None)
    return {f: merge_moments(a.get(f, none), b.get(f, none)) for f in {*a, *b}}


def _per_fold(batch: pa.RecordBatch):
    """(fold, features, labels) of a batch."""
    x = batch.column("_x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
    y, folds = batch.column("label").to_numpy(zero_copy_only=False), batch.column(FIT_FOLD).to_numpy()
    for f in np.unique(folds):
        mine = folds == f
        yield int(f), x[mine], y[mine]


def _fold_moments(batches):
    """Moments of [x, y] per fit fold of a partition, as one row."""
    held: dict[int, tuple] = {}
    for batch in batches:
        if not batch.num_rows:
            continue
        for f, x, y in _per_fold(batch):
            rows = np.column_stack([x, y])
            mean = rows.mean(axis=0)
            held = _merge_folds(held, {f: (len(rows), mean, (rows - mean).T @ (rows - mean))})
    if held:
        yield pa.RecordBatch.from_pydict({"m": [pickle.dumps(held)]})


def _arrays(train: DataFrame) -> DataFrame:
    ship_package(train.sparkSession)
    return train.select(FIT_FOLD, vector_to_array("features").alias("_x"), F.col("label").cast("double").alias("label"))


def fold_moments(train: DataFrame) -> dict[int, tuple]:
    """{fit fold: (n, means of [x, y], scatter of [x, y])} from one scan."""
    parts = _arrays(train).mapInArrow(_fold_moments, "m binary")
    return parts.rdd.map(lambda r: pickle.loads(r["m"])).treeReduce(_merge_folds)


def score(rows: DataFrame, weights: dict[int, np.ndarray]) -> Column:
    """x . w + intercept by the weights of the row's fit fold; weights have the intercept last."""
    table = [c for f in sorted(weights) for c in (F.lit(f), F.array(*[F.lit(float(v)) for v in weights[f]]))]
    with_one = F.concat(vector_to_array("features"), F.array(F.lit(1.0)))
    return F.aggregate(F.zip_with(with_one, F.element_at(F.create_map(*table), F.col(FIT_FOLD)), lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v)


def ridge_weights(moments: dict[int, tuple], alpha: float) -> dict[int, np.ndarray]:
    """Minimises ||y - Xw||^2 + alpha ||w||^2 a fold, by the normal equations of the centred data: exact also where a feature is constant or collinear."""
    out = {}
    for f, (_, mean, scatter) in moments.items():
        d = len(mean) - 1
        w = np.linalg.solve(scatter[:d, :d] + alpha * np.eye(d), scatter[:d, d])
        out[f] = np.append(w, mean[d] - mean[:d] @ w)
    return out


def descend(gram: np.ndarray, target: np.ndarray, l1: np.ndarray | float, l2: np.ndarray | float, start: np.ndarray, max_iter: int, tol: float) -> np.ndarray:
    """Minimises w'Gw/2 - t'w + sum l1 |w| + sum l2 w^2/2 by cyclic coordinate descent; G w is kept up to date.

    Ends when no coordinate moved by more than ``tol`` times the largest weight. A coordinate without curvature stays 0."""
    w, d = start.astype(float).copy(), len(target)
    l1, l2 = np.broadcast_to(l1, d), np.broadcast_to(l2, d)
    product = gram @ w
    for _ in range(max_iter):
        moved = 0.0
        for j in range(d):
            curve = gram[j, j] + l2[j]
            if curve <= 1e-12:
                continue
            pull = target[j] - product[j] + gram[j, j] * w[j]
            new = np.sign(pull) * max(abs(pull) - l1[j], 0.0) / curve
            if new != w[j]:
                product += gram[:, j] * (new - w[j])
                moved = max(moved, abs(new - w[j]))
                w[j] = new
        if moved <= tol * max(1.0, np.abs(w).max(initial=0.0)):
            break
    return w


def elasticnet_path(moments: dict[int, tuple], penalties: Sequence[tuple[float, float]], max_iter: int = 1000, tol: float = 1e-12) -> list[dict[int, np.ndarray]]:
    """Weights of every (alpha, l1_ratio), a fold each: minimises
    ||y - Xw||^2 / 2n + alpha l1_ratio |w| + alpha (1 - l1_ratio) ||w||^2 / 2, each from the solution before."""
    out: list[dict[int, np.ndarray]] = [{} for _ in penalties]
    for f, (n, mean, scatter) in moments.items():
        d = len(mean) - 1
        gram, target, w = scatter[:d, :d] / n, scatter[:d, d] / n, np.zeros(d)
        for at, (alpha, ratio) in enumerate(penalties):
            w = descend(gram, target, alpha * ratio, alpha * (1 - ratio), w, max_iter, tol)
            out[at][f] = np.append(w, mean[d] - mean[:d] @ w)
    return out


def _logistic_parts(batches, weights, class_weights):
    """(weighted loss, gradient, Hessian) per fold at its weights, of a partition."""
    held: dict[int, tuple] = {}
    for batch in batches:
        if not batch.num_rows:
            continue
        for f, x, y in _per_fold(batch):
            z = np.column_stack([x, np.ones(len(x))])
            t = z @ weights.value[f]
            p = np.where(t >= 0, 1 / (1 + np.exp(-np.abs(t))), np.exp(-np.abs(t)) / (1 + np.exp(-np.abs(t))))
            v = np.where(y == 1, class_weights[f][1], class_weights[f][0])
            part = ((v * (np.logaddexp(0, t) - y * t)).sum(), z.T @ (v * (p - y)), (z * (v * p * (1 - p))[:, None]).T @ z)
            held[f] = tuple(a + b for a, b in zip(held[f], part, strict=True)) if f in held else part
    if held:
        yield pa.RecordBatch.from_pydict({"m": [pickle.dumps(held)]})


def _add_parts(a: dict, b: dict) -> dict:
    return {f: tuple(x + y for x, y in zip(a[f], b[f], strict=True)) if f in a and f in b else a.get(f, b.get(f)) for f in {*a, *b}}


def logistic_weights(train: DataFrame, C: float = 1.0, l1_ratio: float = 0.0, class_weight: str | None = None, max_iter: int = 100, tol: float = 1e-10) -> dict[int, np.ndarray]:
    """Minimises C sum v log-loss + l1_ratio |w| + (1 - l1_ratio) ||w||^2 / 2 a fold (intercept free) by Newton steps.

    Every iteration is one scan for all folds that still move. A step that raises the objective is halved; ``balanced``
    weighs class c by n / (2 n_c). A fold with one class only raises ValueError. ``max_iter`` bounds the scans."""
    if class_weight not in (None, "balanced"):
        raise ValueError("class_weight is None or 'balanced'")
    rows = _arrays(train)
    sc = train.sparkSession.sparkContext
    counts: dict[int, dict] = {}
    for r in rows.groupBy(FIT_FOLD, "label").agg(F.count(F.lit(1)).alias("n")).collect():  # folds x classes
        counts.setdefault(r[FIT_FOLD], {})[r["label"]] = r["n"]
    if any(set(c) != {0.0, 1.0} for c in counts.values()):
        raise ValueError("logistic regression needs labels 0 and 1 in every fold")
    v = {f: {int(c): (sum(n.values()) / (2 * n[c]) if class_weight else 1.0) for c in n} for f, n in counts.items()}
    d = len(rows.first()["_x"])
    free = np.append(np.ones(d), 0.0)
    at = {f: np.zeros(d + 1) for f in counts}       # where the next scan looks
    best = dict(at)                                  # the last accepted weights
    value = {f: np.inf for f in counts}
    step: dict[int, np.ndarray] = {}
    moving = set(counts)
    for _ in range(max_iter):
        held = sc.broadcast(at)
        some = rows.where(F.col(FIT_FOLD).isin(*moving)) if len(moving) < len(counts) else rows
        parts = some.mapInArrow(partial(_logistic_parts, weights=held, class_weights=v), "m binary").rdd.map(lambda r: pickle.loads(r["m"])).treeReduce(_add_parts)
        held.unpersist()
        for f in sorted(moving):
            loss, gradient, hessian = parts[f]
            w = at[f]
            now = C * loss + (free * (l1_ratio * np.abs(w) + (1 - l1_ratio) / 2 * w * w)).sum()
            if now > value[f] + 1e-12 * abs(value[f]):
                step[f] = step[f] / 2
                at[f] = best[f] + step[f]
                if np.abs(step[f]).max() <= tol:
                    moving.discard(f)
                continue
            best[f], value[f] = w, now
            if l1_ratio:
                # the quadratic model of the loss at w, in the weights themselves
                step[f] = descend(C * hessian, C * (hessian @ w - gradient), l1_ratio * free, (1 - l1_ratio) * free, w, 10_000, 1e-14) - w
            else:
                step[f] = -np.linalg.lstsq(C * hessian + np.diag(free), C * gradient + free * w, rcond=None)[0]
            at[f] = w + step[f]
            if np.abs(step[f]).max() <= tol * max(1.0, np.abs(w).max()):
                best[f] = at[f]
                moving.discard(f)
        if not moving:
            break
    return best
