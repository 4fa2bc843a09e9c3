"""Hand-table edge cases for the feature operators (FIXTURES.md part C)."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import table
from foldwise.operators import categorical as cat
from foldwise.operators import interactions as ix
from foldwise.operators import numeric as num
from foldwise.operators.base import FIT_FOLD

K = 2


def _rows(fitted, df, k=K, keep=("id", FIT_FOLD, "role")):
    out = fitted.transform(df, k, list(keep))
    return {(r["id"], r[FIT_FOLD]): r for r in out.collect()}


def test_constant_numeric_is_zero_and_unscaled(spark):
    df = table(spark, [(1, 5.0, 1), (2, 5.0, 1), (3, 5.0, 2), (4, 5.0, 2)], "id long, x double, fold int")
    ns = num.NumericStats(df, ["x"], [1, 2])
    assert ns.moments[("x", 1)][1] == 0.0
    res = _rows(num.fit_standardize(ns), df)
    assert all(r["standardize_numeric__x"] == 0.0 for r in res.values())
    rob = _rows(num.fit_robust_scale(ns), df)
    assert all(r["robust_scale_numeric__x"] == 0.0 for r in rob.values())


def test_all_null_numeric_raises_naming_column(spark):
    df = table(spark, [(1, None, 1), (2, None, 2)], "id long, bad double, fold int")
    ns = num.NumericStats(df, ["bad"], [1, 2])
    with pytest.raises(ValueError, match="bad"):
        _ = ns.medians


def test_repeated_edges_merge_bins(spark):
    vals = [0, 0, 0, 0, 1]
    df = table(spark, [(i, float(v), 1) for i, v in enumerate(vals)] + [(99, 0.5, 2)], "id long, x double, fold int")
    ns = num.NumericStats(df, ["x"], [2])
    edges = num.bin_edges(ns, 5)[("x", 2)]
    assert edges == [0.0, 0.5, 1.0]   # four edges at 0 collapse into one: 2 bins instead of 5
    assert num.bin_counts(ns, 5)[("x", 2)] == 2
    assert edges == list(np.unique(np.percentile(vals, [0, 20, 40, 60, 80, 100], method="averaged_inverted_cdf")))
    res = _rows(num.fit_quantile_bin(ns, 5), df, k=2)
    used = {r["quantile_bin_numeric__x"] for (i, f), r in res.items() if f == 2 and i != 99}
    assert used == {0, 1}             # no empty bin


def test_standardize_matches_numpy_with_imputation(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=40)
    x[::7] = np.nan
    folds = np.arange(40) % 2 + 1
    rows = [(i, None if np.isnan(v) else float(v), int(f)) for i, (v, f) in enumerate(zip(x, folds))]
    df = table(spark, rows, "id long, x double, fold int")
    ns = num.NumericStats(df, ["x"], [1, 2])
    res = _rows(num.fit_standardize(ns), df)
    for f in (1, 2):
        fit = x[folds != f]
        med = np.nanmedian(fit)
        imp = np.where(np.isnan(fit), med, fit)
        for i in range(40):
            v = med if np.isnan(x[i]) else x[i]
            assert math.isclose(res[(i, f)]["standardize_numeric__x"], (v - imp.mean()) / imp.std(), abs_tol=1e-9)


def test_null_category_token_and_share(spark):
    df = table(spark, [(1, "a", 1), (2, "a", 1), (3, None, 1), (4, "a", 2)], "id long, c string, fold int")
    cs = cat.CategoryStats(df, ["c"], K)
    res = _rows(cat.fit_frequency(cs), df)
    assert math.isclose(res[(4, 2)]["frequency_encode_categoricals__c"], 2 / 3)   # fit 2 = fold 1 rows
    assert math.isclose(res[(3, 2)]["frequency_encode_categoricals__c"], 1 / 3)


def test_unseen_category(spark):
    df = table(spark, [(1, "a", 1.0, 1), (2, "b", 3.0, 1), (3, "z", 10.0, 2)], "id long, c string, y double, fold int")
    cs = cat.CategoryStats(df, ["c"], K, y_col="y")
    fr = _rows(cat.fit_frequency(cs), df)
    te = _rows(cat.fit_target(cs, 1.0), df)
    od = _rows(cat.fit_ordinal(cs), df)
    oh = _rows(cat.fit_onehot(cs, cs.nunique_all(), 16), df)
    assert fr[(3, 2)]["frequency_encode_categoricals__c"] == 0.0
    assert te[(3, 2)]["target_encode_categoricals__c"] == 2.0           # fit-fold mean of 1 and 3
    assert od[(3, 2)]["ordinal_encode_categoricals__c"] == -1.0
    assert oh[(3, 2)]["onehot_encode_low_cardinality_categoricals__c"] is None
    assert od[(2, 2)]["ordinal_encode_categoricals__c"] == 1.0           # sorted: a=0, b=1


def test_tied_mode_imputes_smallest(spark):
    df = table(spark, [(1, "b", 1), (2, "a", 1), (3, None, 2)], "id long, c string, fold int")
    cs = cat.CategoryStats(df, ["c"], K)
    assert cs.modes()[("c", 2)] == "a"
    od = _rows(cat.fit_ordinal(cs), df)
    assert od[(3, 2)]["ordinal_encode_categoricals__c"] == 0.0


def test_single_row_group_deviation_is_zero(spark):
    rows = [(1, "a", 1.0, 1), (2, "a", 2.0, 1), (3, "a", 4.0, 1), (4, "b", 7.0, 1), (5, "b", 3.0, 2)]
    df = table(spark, rows, "id long, g string, x double, fold int")
    ns = num.NumericStats(df, ["x"], [1, 2])
    cs = cat.CategoryStats(df, ["g"], K)
    res = _rows(ix.fit_group_deviation(ns, cs, 20), df)
    assert res[(4, 2)]["groupwise_deviation_features__x_dev_by_g"] == 0.0
    a = np.array([1.0, 2.0, 4.0])
    want = (2.0 - a.mean()) / (a.std(ddof=1) + 1e-8)
    assert math.isclose(res[(2, 2)]["groupwise_deviation_features__x_dev_by_g"], want, rel_tol=1e-12)


def test_target_encoding_has_no_leakage(spark):
    rng = np.random.default_rng(1)
    rows = [(i, "abc"[i % 3], float(rng.normal()), i % 3 + 1) for i in range(60)]
    df = table(spark, rows, "id long, c string, y double, fold int")
    changed = df.withColumn("y", F.when(F.col("fold") == 2, F.col("y") + 100.0).otherwise(F.col("y")))
    te1 = _rows(cat.fit_target(cat.CategoryStats(df, ["c"], 3, y_col="y"), 1.0), df, k=3)
    te2 = _rows(cat.fit_target(cat.CategoryStats(changed, ["c"], 3, y_col="y"), 1.0), changed, k=3)
    for (i, f), r in te1.items():
        if f == 2:
            assert r["target_encode_categoricals__c"] == te2[(i, f)]["target_encode_categoricals__c"]


def test_feature_plans_stay_in_the_jvm(spark):
    df = table(spark, [(i, float(i), "ab"[i % 2], float(i % 3), i % 2 + 1) for i in range(20)],
               "id long, x double, c string, y double, fold int")
    ns = num.NumericStats(df, ["x"], [1, 2])
    cs = cat.CategoryStats(df, ["c"], 2, y_col="y")
    for fitted in (num.fit_standardize(ns), cat.fit_target(cs), cat.fit_frequency(cs)):
        plan = fitted.transform(df, 2, ["id"])._jdf.queryExecution().executedPlan().toString()
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
