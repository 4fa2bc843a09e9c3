import itertools
import math

import numpy as np
import pytest

from foldwise.plans import blend as bl
from foldwise.plans import metrics as mt
from foldwise.plans import profile as pf


def _pred(spark, y, p, fold=1, cand="c"):
    rows = [(cand, fold, float(a), float(b)) for a, b in zip(y, p)]
    return spark.createDataFrame(rows, "candidate_id string, fold int, y_true double, y_pred double")


def _auc_bruteforce(y, p):
    pos = [s for s, t in zip(p, y) if t == 1]
    neg = [s for s, t in zip(p, y) if t == 0]
    return sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg))


def test_tied_scores_auc_half(spark):
    r = mt.fold_metrics(_pred(spark, [0, 1], [0.5, 0.5]), "roc_auc").collect()[0]
    assert r["metric_value"] == 0.5


def test_auc_matches_pairwise_count(spark):
    rng = np.random.default_rng(5)
    y = rng.integers(0, 2, 300)
    p = np.round(rng.random(300), 1)
    r = mt.fold_metrics(_pred(spark, y, p), "roc_auc").collect()[0]
    assert math.isclose(r["metric_value"], _auc_bruteforce(y, p), rel_tol=1e-12)


def test_rmsle_clips_negative_predictions(spark):
    r = mt.fold_metrics(_pred(spark, [0.0], [-3.0]), "rmsle").collect()[0]
    assert r["metric_value"] == 0.0


def test_accuracy_threshold_inclusive(spark):
    r = mt.fold_metrics(_pred(spark, [1], [0.5]), "accuracy").collect()[0]
    assert r["metric_value"] == 1.0


def test_metric_names():
    assert mt.normalize_metric("root_mean_squared_error", "regression") == "rmse"
    with pytest.raises(ValueError):
        mt.normalize_metric("roc_auc", "regression")


def test_label_pair_checks(spark):
    df = spark.createDataFrame([(0,), (1,), (None,)], "y int")
    with pytest.raises(ValueError, match="exactly two"):
        pf.binary_label_pair(df, "y")
    with pytest.raises(ValueError):
        pf.positive_label([0.0, 1.0], None)
    assert pf.positive_label([0, 1], None) == 1
    assert pf.positive_label(["Yes", "No"], None) == "Yes"


def _greedy_reference(P, y, rounds):
    """Direct re-statement of forward selection with replacement on an n x m matrix."""
    m = P.shape[1]
    def rmse(v):
        return math.sqrt(np.mean((v - y) ** 2))
    singles = [rmse(P[:, i]) for i in range(m)]
    counts = np.zeros(m, int)
    counts[int(np.argmin(singles))] = 1
    cur = min(singles)
    for _ in range(rounds):
        best_gain, best_i = -np.inf, None
        for i in range(m):
            trial = (P @ counts + P[:, i]) / (counts.sum() + 1)
            g = cur - rmse(trial)
            if g > best_gain:
                best_gain, best_i = g, i
        counts[best_i] += 1
        cur = rmse(P @ counts / counts.sum())
        if best_gain <= 0:
            break
    return counts / counts.sum(), cur


def test_greedy_selection_matches_direct_computation(spark):
    rng = np.random.default_rng(11)
    n, m = 400, 5
    y = rng.normal(size=n) * 10
    P = np.stack([y + rng.normal(size=n) * s for s in (3, 4, 5, 6, 2.5)], 1)
    rows = [(f"c{j}", i, 1, float(y[i]), float(P[i, j])) for i in range(n) for j in range(m)]
    df = spark.createDataFrame(rows, "candidate_id string, row_idx long, fold int, y_true double, y_pred double")
    cands = [f"c{j}" for j in range(m)]
    w, score = bl.greedy_select(bl.gram(df, cands, ["row_idx"]), cands, 30, "rmse")
    w_ref, s_ref = _greedy_reference(P, y, 30)
    assert np.allclose([w[c] for c in cands], w_ref, atol=1e-12)
    assert math.isclose(score, s_ref, rel_tol=1e-9)


def test_blend_weights_validation():
    with pytest.raises(ValueError):
        bl.normalize_weights(["a"])
    with pytest.raises(ValueError):
        bl.normalize_weights(["a", "b"], [1.0, -1.0])
    assert bl.normalize_weights(["a", "b"], [3.0, 1.0]) == {"a": 0.75, "b": 0.25}


def test_correlated_filter():
    ids = ["a", "b", "c"]
    corr = {(x, y): (1.0 if x == y else 0.0) for x, y in itertools.product(ids, ids)}
    corr[("a", "b")] = corr[("b", "a")] = 0.999
    corr[("a", "c")] = corr[("c", "a")] = 0.5
    kept, dropped = bl.filter_correlated(corr, ids, 0.99)
    assert dropped == ["a"] and kept == ["b", "c"]
