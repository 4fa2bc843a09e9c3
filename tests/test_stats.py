import numpy as np
import pytest
from pyspark.sql import functions as F

from foldwise.operators import stats as st


def _long(spark, values, folds):
    rows = [(int(f), "x", float(v)) for v, f in zip(values, folds)]
    return spark.createDataFrame(rows, "fold int, key string, x double")


@pytest.mark.parametrize("seed", [0, 1])
def test_select_ranks_matches_sort(spark, seed):
    rng = np.random.default_rng(seed)
    vals = np.concatenate([rng.normal(size=300), np.zeros(100), rng.integers(0, 5, 50).astype(float)])
    fl = rng.integers(1, 4, len(vals))
    lg = _long(spark, vals, fl)
    targets = []
    for f in (0, 1, 2, 3):
        n = int(np.sum(fl != f))
        targets += [("x", f, r) for r in (0, 1, n // 3, n // 2, n - 2, n - 1)]
    got = st.select_ranks(lg, targets, buckets=16)
    for key, f, r in targets:
        assert got[(key, f, r)] == np.sort(vals[fl != f])[r]


@pytest.mark.parametrize("n", [1, 2, 4, 5, 10, 97, 100])
def test_quantiles_match_numpy(spark, n):
    rng = np.random.default_rng(n)
    vals = np.round(rng.normal(size=n) * 10, 1)
    lg = _long(spark, vals, [1] * n)
    probs = [0.0, 0.2, 0.25, 0.4, 0.5, 0.6, 0.75, 0.8, 1.0]
    lin = st.complement_quantiles(lg, ["x"], [0], probs, "linear")[("x", 0)]
    avg = st.complement_quantiles(lg, ["x"], [0], probs, "averaged_cdf")[("x", 0)]
    assert np.allclose(lin, np.percentile(vals, [p * 100 for p in probs], method="linear"), rtol=0, atol=1e-12)
    assert np.allclose(avg, np.percentile(vals, [p * 100 for p in probs], method="averaged_inverted_cdf"),
                       rtol=0, atol=1e-12)


def test_even_quantile_hand_table(spark):
    lg = _long(spark, [3, 1, 2, 2], [1] * 4)
    q = st.complement_quantiles(lg, ["x"], [0], [0.25, 0.5, 0.75], "averaged_cdf")[("x", 0)]
    assert q == [1.5, 2.0, 2.5]


def test_imputed_quantiles_match_numpy(spark):
    rng = np.random.default_rng(7)
    vals = rng.normal(size=60)
    fl = rng.integers(1, 4, 60)
    nulls = {1: 5, 2: 0, 3: 7}
    lg = _long(spark, vals, fl)
    summ = st.fold_summary(lg)
    imp = {}
    for f in (1, 2, 3):
        comp = vals[fl != f]
        m = float(np.median(comp))
        z = sum(v for g, v in nulls.items() if g != f)
        imp[("x", f)] = (m, z)
    got = st.complement_quantiles(lg, ["x"], [1, 2, 3], [0.1, 0.25, 0.5, 0.75, 0.9], "linear", summ, imp)
    for f in (1, 2, 3):
        m, z = imp[("x", f)]
        full = np.concatenate([vals[fl != f], np.full(z, m)])
        assert np.allclose(got[("x", f)], np.percentile(full, [10, 25, 50, 75, 90]), atol=1e-12)


def test_conditional_ranks(spark):
    rows = [("a", "x", True), ("a", "y", False), ("a", "z", True), ("b", "m", True), ("b", "n", True)]
    df = spark.createDataFrame(rows, "key string, v string, p boolean")
    got = {(r["key"], r["v"]): r["rank_p"] for r in st.conditional_ranks(df, "key", "v", ["p"], 3).collect()}
    assert got == {("a", "x"): 0, ("a", "y"): 1, ("a", "z"): 1, ("b", "m"): 0, ("b", "n"): 1}
