"""The approximate kNN join against all distances."""

import numpy as np
import pytest

from foldwise.operators import knn_lsh as lsh


def frame(spark, X, ids=None):
    ids = range(len(X)) if ids is None else ids
    return spark.createDataFrame([(None if i is None else int(i), None if x is None else list(map(float, x))) for i, x in zip(ids, X, strict=True)], "id long, v array<double>")


def exact(X, ids, Q, q_ids, k, exclude=True):
    out = {}
    for i, q in zip(q_ids, Q, strict=True):
        d = np.floor(np.sqrt(((X - q) ** 2).sum(1)) * 1e9 + 0.5)
        order = [j for j in np.lexsort((ids, d)) if not exclude or ids[j] != i][:k]
        out[int(i)] = [int(ids[j]) for j in order]
    return out


def lists(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: r["rank"]):
        out.setdefault(r["query_id"], []).append(r["neighbor_id"])
    return out


def clustered(n, d=8, seed=0, spread=0.05):
    rng = np.random.default_rng(seed)
    return rng.normal(size=(n // 10, d))[rng.integers(0, n // 10, n)] + spread * rng.normal(size=(n, d))


def test_collisions_as_drawn():
    rng = np.random.default_rng(1)
    for c in (0.5, 1.0, 3.0):
        a, b = rng.normal(size=(100_000, 1)), rng.random((100_000, 1))
        hits = (np.floor(a * c / 2.0 + b) == np.floor(b)).mean()
        assert lsh.collision(np.array([c]), 2.0)[0] == pytest.approx(hits, abs=0.01)


def test_planned_tables_reach_the_recall(spark, monkeypatch):
    X, plans = clustered(1500), []
    planned = lsh.plan_tables
    monkeypatch.setattr(lsh, "plan_tables", lambda *a: plans.append(planned(*a)) or plans[-1])
    monkeypatch.setattr(lsh, "BUCKET_ROWS", 20)  # most buckets are dealt as blocks
    got, want = lists(lsh.knn_lsh_join(frame(spark, X), "id", "v", 5)), exact(X, np.arange(1500), X, np.arange(1500), 5)
    assert plans[0][1] > 2  # more than a few projections: far pairs aren't compared
    assert np.mean([len(set(got.get(i, [])) & set(want[i])) / 5 for i in want]) >= 0.9


def test_one_wide_bucket_is_exact_with_ties_and_equal_vectors(spark, monkeypatch):
    rng = np.random.default_rng(2)
    X = np.concatenate([rng.integers(0, 3, (90, 3)).astype(float), np.tile([1.0, 1.0, 1.0], (60, 1)), rng.normal(size=(30, 3))])
    ids = rng.permutation(len(X)) * 3
    monkeypatch.setattr(lsh, "BUCKET_ROWS", 16)
    plan = (1, 1, 1e9)
    assert lists(lsh.knn_lsh_join(frame(spark, X, ids), "id", "v", 4, plan=plan)) == exact(X, ids, X, ids, 4)
    Q, q_ids = np.concatenate([X[:5], rng.normal(size=(4, 3))]), np.arange(9) * 1000 + 1
    got = lists(lsh.knn_lsh_join(frame(spark, X, ids), "id", "v", 4, queries=frame(spark, Q, q_ids), exclude_self=False, plan=plan))
    assert got == exact(X, ids, Q, q_ids, 4, exclude=False)


def test_nulls_and_empty_tables(spark):
    rows = frame(spark, [[0.0], None, [1.0], [1.5]], [1, 2, None, 4])
    assert lists(lsh.knn_lsh_join(rows, "id", "v", 3, plan=(1, 1, 1e9))) == {1: [4], 4: [1]}
    assert lsh.knn_lsh_join(rows.where("id > 100"), "id", "v", 3).collect() == []
