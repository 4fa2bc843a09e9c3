"""Boosting and linear models of all folds against plain loops and optimality conditions."""

import heapq

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from foldwise.plans import boosting as bo
from foldwise.plans import evaluate as ev
from foldwise.plans import linear as ln
from foldwise.plans import models as md


def vectors(spark, X, y, folds, k):
    """(id, fit_fold, role, label, features) of every fit fold; NaN stays in the vectors."""
    names = [f"x{j}" for j in range(X.shape[1])]
    rows = [(i, int(f), float(t), *map(float, x)) for i, (f, t, x) in enumerate(zip(folds, y, X, strict=True))]
    df = spark.createDataFrame(rows, "id long, fold int, label double, " + ", ".join(f"{n} double" for n in names))
    df = df.withColumn("fit_fold", F.explode(F.sequence(F.lit(1), F.lit(k)))).withColumn("role", F.when(F.col("fold") == F.col("fit_fold"), "valid").otherwise("train"))
    return VectorAssembler(inputCols=names, outputCol="features", handleInvalid="keep").transform(df).select("id", "fit_fold", "role", "label", "features")


def problem(n=400, seed=0, binary=False):
    rng = np.random.default_rng(seed)
    X = rng.normal(size=(n, 4))
    X[:, 1] = rng.integers(0, 6, n)
    X[rng.random(n) < 0.2, 0] = np.nan
    y = np.where(np.isnan(X[:, 0]), 1.5, np.sign(X[:, 0])) + 0.7 * X[:, 1] * (X[:, 2] > 0) + 0.1 * rng.normal(size=n)
    return X, (y > y.mean()).astype(float) if binary else y, rng.integers(1, 4, n)


# ------------------------------------------------------------------ boosting, by plain loops
def grow(codes, g, h, s):
    """{path: (feature, set of left codes) or None} of one tree, strictly by the rule of its growth."""
    def best(rows):
        found = None
        G, H = g[rows].sum(), h[rows].sum()
        for j in range(codes.shape[1]):
            for c in range(1, s.bins + 1):
                for missing_left in (True, False):
                    left = rows[(codes[rows, j] <= c) & ((codes[rows, j] > 0) | missing_left)]
                    right = np.setdiff1d(rows, left)
                    if min(len(left), len(right)) < max(s.min_samples, 1) or min(h[left].sum(), h[right].sum()) < s.min_hessian:
                        continue
                    gain = g[left].sum() ** 2 / (h[left].sum() + s.l2) + g[right].sum() ** 2 / (h[right].sum() + s.l2) - G * G / (H + s.l2)
                    if gain > 1e-9 and (found is None or gain > found[0] * (1 + 1e-8)):
                        found = gain, j, left, right
        return found

    out, members = {}, {1: np.arange(len(g))}
    if s.growth == "leaf":
        first = best(members[1])
        heap = [(-first[0], 1, first)] if first else []
        while heap and len(out) < s.max_leaves - 1:
            _, n, (_, j, left, right) = heapq.heappop(heap)
            out[n] = j
            for c, rows in ((2 * n, left), (2 * n + 1, right)):
                members[c] = rows
                found = best(rows) if s.max_depth is None or c.bit_length() - 1 < s.max_depth else None
                if found:
                    heapq.heappush(heap, (-found[0], c, found))
            del members[n]
    else:
        for depth in range(s.max_depth):
            for n in [n for n in members if n.bit_length() - 1 == depth]:
                found = best(members[n])
                if found:
                    out[n] = found[1]
                    members[2 * n], members[2 * n + 1] = found[2], found[3]
                    del members[n]
    return out, members


@pytest.mark.parametrize("settings,binary", [
    (bo.Settings("leaf", 2, 0.3, None, 6, 5, 0.0, 0.0, 0.0, 12), True), (bo.Settings("leaf", 1, 0.5, 3, 12, 1, 0.0, 1.0, 0.0, 9), False), (bo.Settings("depth", 2, 0.3, 2, 31, 3, 0.0, 1.0, 0.0, 12), False)])
def test_trees_as_by_plain_loops(spark, settings, binary):
    X, y, folds = problem(220, 1, binary)
    table = vectors(spark, X, y, folds, 3)
    model = bo.fit_boosting(table.where("role = 'train'"), settings, "binary" if binary else "regression")
    for f in (1, 2, 3):
        rows = folds != f
        edges = [np.unique([np.sort(v)[max(0, int(np.ceil(i / settings.bins * len(v))) - 1)] for i in range(1, settings.bins)]) for v in (X[rows][~np.isnan(X[rows, j]), j] for j in range(4))]
        assert all(np.array_equal(a, b) for a, b in zip(edges, model.edges[f], strict=True))
        codes = bo.codes_of(X[rows], edges, {}, settings.bins).astype(int)
        raw = np.full(rows.sum(), model.base[f])
        for tree in model.trees[f]:
            g, h = bo._gradients(y[rows], raw, "binary" if binary else "regression")
            out, members = grow(codes, g, h, settings)
            assert (tree.feature >= 0).sum() == len(out)
            for leaf in members.values():
                if len(leaf):
                    raw[leaf] -= settings.learning_rate * g[leaf].sum() / (h[leaf].sum() + settings.l2)
        want = raw if not binary else 1 / (1 + np.exp(-raw))
        assert np.allclose(model.predict(f, X[rows]), want, atol=1e-9)


def test_looking_ahead_saves_scans_not_splits(spark):
    X, y, folds = problem(300, 2)
    s = bo.Settings("leaf", 1, 0.1, None, 16, 2, 0.0, 0.0, 0.0, 16)
    model = bo.fit_boosting(vectors(spark, X, y, folds, 3).where("role = 'train'"), s, "regression")
    assert all((t.feature >= 0).sum() == 15 for trees in model.trees.values() for t in trees)
    assert model.scans < 15


def test_features_in_portions_and_raw_scores_written_down(spark, monkeypatch):
    X, y, folds = problem(250, 3)
    table = vectors(spark, X, y, folds, 2).where("role = 'train' and fit_fold <= 2")
    for growth in ("leaf", "oblivious"):
        s = bo.Settings(growth, 3, 0.2, 2, 4, 2, 0.0, 1.0, 0.0, 8)
        plain = bo.fit_boosting(table, s, "regression")
        monkeypatch.setattr(bo, "SCAN_CELLS", 20)
        monkeypatch.setattr(bo, "KEPT_TREES", 2)
        monkeypatch.setattr(bo, "BLOCK_ROWS", 37)
        other = bo.fit_boosting(table.repartition(5), s, "regression")
        monkeypatch.undo()
        assert other.scans > plain.scans
        assert np.allclose(plain.predict(1, X), other.predict(1, X))


def test_oblivious_trees_split_a_level_at_once(spark):
    X, y, folds = problem(300, 4)
    model = bo.fit_boosting(vectors(spark, X, y, folds, 3).where("role = 'train'"), bo.Settings("oblivious", 2, 0.3, 3, 31, 1, 0.0, 3.0, 0.0, 16), "regression")
    for tree in model.trees[1]:
        level = [0]
        while tree.feature[level[0]] >= 0:
            assert len({(int(tree.feature[n]), tree.table[n].tobytes()) for n in level}) == 1
            level = [c for n in level for c in (tree.left[n], tree.right[n])]
        assert len(level) == 8


def test_nominal_features_split_into_sets(spark):
    rng = np.random.default_rng(5)
    c = rng.integers(0, 6, 300)
    y = np.isin(c, (0, 3, 5)) * 10.0 + rng.normal(size=300) * 0.01
    table = vectors(spark, c[:, None].astype(float), y, rng.integers(1, 3, 300), 2)
    model = bo.fit_boosting(table.where("role = 'train'"), bo.Settings("depth", 1, 1.0, 1, bins=16), "regression", nominal={0: 6})
    got = model.predict(1, np.arange(7.0)[:, None])
    assert np.allclose(got[:6], [10, 0, 0, 10, 0, 10], atol=0.1)  # one split; an unknown category goes right
    assert bo.codes_of(np.array([[7.0], [np.nan], [2.0]]), [np.zeros(0)], {0: 6}, 16).ravel().tolist() == [0, 0, 3]


def test_degenerate_tables(spark):
    X, y, folds = np.full((30, 2), np.nan), np.arange(30.0), np.arange(30) % 2 + 1
    model = bo.fit_boosting(vectors(spark, X, y, folds, 2).where("role = 'train'"), bo.Settings("leaf", 2, bins=4), "regression")
    assert np.allclose(model.predict(1, X[:1]), y[folds == 2].mean())
    empty = vectors(spark, X, y, folds, 2).where("role = 'none'")
    assert bo.fit_boosting(empty, bo.Settings("leaf", 2), "regression").trees == {}
    with pytest.raises(ValueError, match="max_depth"):
        bo.Settings("depth")
    with pytest.raises(ValueError, match="growth"):
        bo.Settings("sideways")


@pytest.mark.parametrize("name", sorted(md.BOOSTING))
def test_boosting_families_differ_and_learn(spark, name):
    X, y, folds = problem(300, 6)
    table = vectors(spark, X, y, folds, 3)
    own = {"catboost": "iterations", "hist_gradient_boosting": "max_iter"}.get(name, "n_estimators")
    out = ev.cross_validate(table, ["x"], "label", md.resolve(name, "regression"), 3, {own: 3, "learning_rate": 0.8, "max_depth": 4}, score_only=True).toPandas()
    assert len(out) == 300 and ((out.y_pred - out.y_true) ** 2).mean() < 0.35 * y.var()


# ------------------------------------------------------------------ linear models
def test_elastic_net_meets_its_conditions(spark):
    rng = np.random.default_rng(7)
    X = rng.normal(size=(300, 5))
    X[:, 4] = 2 * X[:, 3]
    X[:, 2] = 1.0
    y, folds = X @ np.array([3.0, 0.0, 1.0, -2.0, 0.5]) + rng.normal(size=300), rng.integers(1, 4, 300)
    path = ln.elasticnet_path(ln.fold_moments(vectors(spark, X, y, folds, 3).where("role = 'train'")), penalties := [(1.0, 0.5), (0.1, 1.0), (0.01, 0.2)])
    for (alpha, ratio), weights in zip(penalties, path, strict=True):
        for f in (1, 2, 3):
            A, b, w = X[folds != f], y[folds != f], weights[f]
            r = b - A @ w[:-1] - w[-1]
            assert abs(r.mean()) < 1e-9
            pull = (A - A.mean(0)).T @ r / len(b) - alpha * (1 - ratio) * w[:-1]
            on = w[:-1] != 0
            assert np.allclose(pull[on], alpha * ratio * np.sign(w[:-1][on]), atol=1e-8) and (np.abs(pull[~on]) <= alpha * ratio + 1e-8).all()


@pytest.mark.parametrize("ratio", [0.0, 0.5, 1.0])
@pytest.mark.parametrize("balance", [None, "balanced"])
def test_logistic_regression_meets_its_conditions(spark, ratio, balance):
    rng = np.random.default_rng(8)
    X = rng.normal(size=(300, 4)) * [1, 5, 1, 1]
    y, folds = (X @ np.array([2.0, -0.3, 0.0, 0.0]) + rng.normal(size=300) > 1).astype(float), rng.integers(1, 4, 300)
    C = 0.5
    found = ln.logistic_weights(vectors(spark, X, y, folds, 3).where("role = 'train'"), C, ratio, balance)
    for f, w in found.items():
        A, b = X[folds != f], y[folds != f]
        v = np.where(b == 1, len(b) / 2 / b.sum(), len(b) / 2 / (1 - b).sum()) if balance else np.ones(len(b))
        e = C * v * (b - 1 / (1 + np.exp(-(A @ w[:-1] + w[-1]))))
        assert abs(e.sum()) < 1e-6
        pull, on = A.T @ e - (1 - ratio) * w[:-1], w[:-1] != 0
        assert np.allclose(pull[on], ratio * np.sign(w[:-1][on]), atol=1e-6) and (np.abs(pull[~on]) <= ratio + 1e-6).all()


def test_separable_classes_and_one_class(spark):
    X = np.array([[-2.0], [-1.0], [1.0], [2.0]] * 10)
    y, folds = (X[:, 0] > 0).astype(float), np.arange(40) % 2 + 1
    w = ln.logistic_weights(vectors(spark, X, y, folds, 2).where("role = 'train'"), C=1e6)
    assert all(np.isfinite(v).all() and v[0] > 3 for v in w.values())
    with pytest.raises(ValueError, match="labels 0 and 1"):
        ln.logistic_weights(vectors(spark, X, np.ones(40), folds, 2).where("role = 'train'"))


@pytest.mark.parametrize("name,task,params", [("ridge", "regression", {"alpha": 2.0}), ("elasticnet", "regression", {"alpha": 0.05, "tol": 1e-12}), ("logistic_regression", "binary", {"C": 0.3})])
def test_wide_designs_get_the_same_answer(spark, monkeypatch, name, task, params):
    rng = np.random.default_rng(9)
    X, folds = rng.normal(size=(200, 6)), rng.integers(1, 3, 200)
    y = X @ rng.normal(size=6) + rng.normal(size=200)
    y = (y > 0).astype(float) if task == "binary" else y
    table, family = vectors(spark, X, y, folds, 2), md.resolve(name, task)
    run = lambda: ev.cross_validate(table, ["x"] * 6, "label", family, 2, params, score_only=True).orderBy("id").toPandas().y_pred.to_numpy()
    direct = run()
    monkeypatch.setattr(md, "DIRECT_FEATURES", 3)
    monkeypatch.setattr(ev, "DIRECT_FEATURES", 3)
    assert np.allclose(direct, run(), atol=2e-4 * max(1.0, np.abs(direct).max()))
