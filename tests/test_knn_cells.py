"""Exact kNN by cells of space: few cells are visited, and the result is that of all pairs."""

import numpy as np

from foldwise.operators import knn as kn


def brute(q_ids, q, r_ids, r, k):
    d = np.floor(np.sqrt(((q[:, None] - r[None]) ** 2).sum(-1)) * 1e9 + 0.5)
    d[q_ids[:, None] == r_ids[None]] = np.inf
    return {int(q_ids[i]): [int(r_ids[j]) for j in np.lexsort((r_ids, d[i]))[:k] if d[i, j] < np.inf] for i in range(len(q))}


def lists(rows):
    out = {}
    for q, r in rows:
        out.setdefault(int(q), []).append(int(r))
    return out


def test_few_pairs_of_a_block_are_measured(monkeypatch):
    rng = np.random.default_rng(5)
    r, ids, measured = rng.normal(size=(20_000, 3)), rng.permutation(20_000), []
    rough = kn._rough
    monkeypatch.setattr(kn, "_rough", lambda q, r, top=None: measured.append(len(q) * len(r)) or rough(q, r, top))
    got = kn.nearest(ids[:2000], r[:2000], ids, r, 4, 1e9, True)
    assert lists(zip(got[0], got[1])) == brute(ids[:2000], r[:2000], ids, r, 4)
    assert sum(measured) < 0.4 * 2000 * 20_000


def test_queries_visit_few_cells_and_full_cells_are_dealt(spark):
    """A third of the rows are one vector, which no plane can part."""
    rng = np.random.default_rng(6)
    X = np.concatenate([np.tile([0.5, 0.5], (400, 1)), rng.random((800, 2))])
    ids = rng.permutation(len(X))
    cells = kn.Cells(ids[:400], X[rng.permutation(len(X))[:400]], 16)
    assert sum(len(row) for row, _ in cells.visits(X, cells.reach(ids, X, 3, 1e-9, False))) < 0.6 * len(X) * len(cells.lo)
    df = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, X)], "id long, v array<double>")
    rows = sorted(kn.knn_join(df, "id", "v", k=3, block_rows=100).collect(), key=lambda r: (r["query_id"], r["rank"]))
    assert lists((r["query_id"], r["neighbor_id"]) for r in rows) == brute(ids, X, ids, X, 3)
