import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from foldwise.operators import knn as kn
from foldwise.plans import evaluate as ev
from foldwise.plans import linear as ln
from foldwise.plans import models as md


def _feat(spark, X, y, folds, split=None):
    rows = []
    for i in range(len(y)):
        rows.append((i, int(folds[i]), float(y[i]), *[float(v) for v in X[i]]))
    cols = ", ".join(f"x{j} double" for j in range(X.shape[1]))
    df = spark.createDataFrame(rows, f"id long, fold int, y double, {cols}")
    df = df.withColumn("split", F.lit("train"))
    from foldwise.operators.base import expand_fits
    return expand_fits(df, int(max(folds)))


def test_ridge_mapping_matches_normal_equations(spark):
    rng = np.random.default_rng(0)
    n, d = 200, 3
    X = rng.normal(size=(n, d))
    y = X @ np.array([1.5, -2.0, 0.5]) + 3 + rng.normal(size=n)
    folds = np.arange(n) % 2 + 1
    feat = _feat(spark, X, y, folds)
    preds = ev.cross_validate(feat, ["x0", "x1", "x2"], "y", md.resolve("ridge", "regression"), 2, {"alpha": 10.0})
    got = {r["id"]: r["y_pred"] for r in ev.oof(preds).collect()}
    for f in (1, 2):
        tr = folds != f
        Xc = X[tr] - X[tr].mean(0)
        yc = y[tr] - y[tr].mean()
        w = np.linalg.solve(Xc.T @ Xc + 10.0 * np.eye(d), Xc.T @ yc)
        b = y[tr].mean() - X[tr].mean(0) @ w
        for i in np.where(~tr)[0]:
            assert math.isclose(got[i], X[i] @ w + b, rel_tol=1e-6, abs_tol=1e-6)


def test_logistic_mapping_is_optimal(spark):
    rng = np.random.default_rng(1)
    n, d = 300, 2
    X = rng.normal(size=(n, d))
    y = (X @ np.array([1.0, -1.0]) + rng.normal(size=n) > 0).astype(float)
    feat = _feat(spark, X, y, np.where(np.arange(n) < 250, 1, 2))   # fit 2 trains on the first 250 rows
    data = ev.assemble(feat.withColumn("label", F.col("y")), ["x0", "x1"])
    tr = data.where((F.col("fit_fold") == 2) & (F.col("role") == "train"))
    *w, b = ln.logistic_weights(tr, C=1.0)[2]
    Xt, yt = X[:250], y[:250]
    p = 1 / (1 + np.exp(-(Xt @ w + b)))
    grad_w = 1.0 * Xt.T @ (p - yt) + w            # C * sum loss gradient + penalty gradient
    grad_b = np.sum(p - yt)
    assert np.max(np.abs(grad_w)) < 1e-3 and abs(grad_b) < 1e-3


def test_gaussian_nb_matches_closed_form(spark):
    rng = np.random.default_rng(2)
    n = 120
    X = rng.normal(size=(n, 2)) + np.repeat([[0, 0], [1, 1]], n // 2, axis=0)
    y = np.repeat([0.0, 1.0], n // 2)
    folds = np.arange(n) % 2 + 1
    feat = _feat(spark, X, y, folds)
    got = {(r["id"], r["fit_fold"]): r["y_pred"] for r in ev.gaussian_nb(feat, ["x0", "x1"], "y").collect()}
    for f in (1, 2):
        tr = folds != f
        eps = 1e-9 * X[tr].var(0).max()
        stats = {c: (X[tr][y[tr] == c].mean(0), X[tr][y[tr] == c].var(0) + eps, np.mean(y[tr] == c)) for c in (0, 1)}
        for i in np.where(~tr)[0]:
            jll = [math.log(pr) - 0.5 * np.sum(np.log(2 * np.pi * v)) - 0.5 * np.sum((X[i] - m) ** 2 / v)
                   for m, v, pr in (stats[0], stats[1])]
            p1 = math.exp(jll[1] - np.logaddexp(jll[0], jll[1]))
            assert math.isclose(got[(i, f)], p1, rel_tol=1e-9, abs_tol=1e-12)


@pytest.mark.parametrize("method", ["blocked", "pivot"])
def test_knn_exact(spark, method):
    rng = np.random.default_rng(3)
    X = np.concatenate([rng.normal(size=(60, 3)), rng.normal(size=(60, 3)) + 5])
    df = spark.createDataFrame([(i, [float(v) for v in X[i]]) for i in range(len(X))], "id long, v array<double>")
    got = {}
    for r in kn.knn_join(df, "id", "v", k=4, method=method, block_rows=37).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["neighbor_id"]))
    D = np.sqrt(((X[:, None] - X[None]) ** 2).sum(-1))
    np.fill_diagonal(D, np.inf)
    for i in range(len(X)):
        want = list(np.lexsort((np.arange(len(X)), np.round(D[i], 9)))[:4])
        assert [nb for _, nb in sorted(got[i])] == want
