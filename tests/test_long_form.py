"""Long tables of dense features: a row a feature from one short loop."""

import math
import re

import pytest
from conftest import SF_SMALL, table
from pyspark.sql import functions as F

from foldwise.operators import categorical as cat
from foldwise.operators import interactions as ix
from foldwise.operators import numeric as num

KEEP = ["id", "fit_fold", "role"]


def _wide(fitted, df, k):
    out = {}
    for r in fitted.transform(df, k, KEEP).collect():
        out.update({(r["id"], r["fit_fold"], r["role"], n): r[n] for n in fitted.names() if r[n] is not None})
    return out


def _long(fitted, df):
    rows = fitted.transform_long(df, KEEP).collect()
    out = {(r["id"], r["fit_fold"], r["role"], r["feature"]): r["value"] for r in rows}
    assert len(out) == len(rows)
    return out


def test_group_deviation_long_equals_wide(spark):
    # g: "z" is in the test rows only, "c" in fold 3 only; h has three categories, but two outside fold 3
    rows = [(i, "ab"[i % 2], "xy"[i % 2], float(i * i), None if i % 4 == 0 else i / 3, i % 3 + 1, "train") for i in range(20)]
    rows += [(20, "c", "w", 5.0, float("nan"), 3, "train"), (21, None, "x", None, 1.0, 3, "train"), (22, "z", "x", 3.0, None, None, "test")]
    df = table(spark, rows, "id long, g string, h string, x double, y double, fold int, split string")
    train = df.where("split = 'train'")
    ns, cs = num.NumericStats(train, ["x", "y"], [1, 2, 3]), cat.CategoryStats(train, ["g", "h"], 3)
    fitted = ix.fit_group_deviation(ns, cs, 2)
    long, wide = _long(fitted, df), _wide(fitted, df, 3)
    assert long.keys() == wide.keys() and all(long[k] == wide[k] or math.isnan(long[k]) and math.isnan(wide[k]) for k in wide)
    assert {k[1] for k in long} == {3}      # the fits with "c" and "w" have three categories of g and of h
    assert len(long) == len(rows) * 4
    # an unseen category takes the fit's own mean and std
    fit = [r[3] for r in rows if r[5] not in (3, None) and r[3] is not None]
    mean = sum(fit) / len(fit)
    std = math.sqrt(sum((v - mean) ** 2 for v in fit) / (len(fit) - 1))
    assert long[(22, 3, "test", "groupwise_deviation_features__x_dev_by_g")] == pytest.approx((3.0 - mean) / (std + 1e-8))


def test_cross_frequencies_long_equals_wide(spark):
    rows = [(i, "ab"[i % 2], "xyz"[i % 3], i % 2 == 0, i % 3 + 1, "train") for i in range(18)] + [(18, "q", None, None, None, "test")]
    df = table(spark, rows, "id long, g string, h string, b boolean, fold int, split string")
    plan = ix.CrossPlan(cat.CategoryStats(df.where("split = 'train'"), ["g", "h", "b"], 3), 10)
    fitted = ix.fit_frequency_crosses(plan)
    rows = plan.prepare(df)
    assert _long(fitted, rows) == _wide(fitted, rows, 3)


def test_nothing_eligible_gives_no_rows(spark):
    df = table(spark, [(i, "abc"[i % 3], float(i), i % 2 + 1) for i in range(12)], "id long, g string, x double, fold int")
    ns, cs = num.NumericStats(df, ["x"], [1, 2]), cat.CategoryStats(df, ["g"], 2)
    out = ix.fit_group_deviation(ns, cs, 1).transform_long(df, KEEP)
    assert out.columns == [*KEEP, "feature", "value"] and out.count() == 0
    assert ix.fit_frequency_crosses(ix.CrossPlan(cs, 1)).transform_long(df, KEEP).count() == 0


@pytest.mark.parametrize("name", ["group_deviation_cv", "frequency_cross_cv"])
def test_long_tables_are_compiled(spark, name):
    """The JVM compiles no method above 8000 bytes: a table written by such a one costs ten times as much."""
    from foldwise import catalog
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")      # show the plan as it will run
    try:
        df = catalog.QUERIES[name](spark, SF_SMALL).where(F.length("feature") > 0)
        mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("codegen")
        shown = df._jdf.queryExecution().explainString(mode)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    stages = [s for s in re.split(r"== Subtree \d+", shown) if re.search(r"\*\(\d+\) Generate ", s.split("Generated code")[0])]
    sizes = [int(n) for s in stages for n in re.findall(r"maxMethodCodeSize:(\d+)", s)]
    assert sizes and max(sizes) < 8000, sizes


def test_crosses_with_bins_long_equal_wide_and_are_compiled(spark):
    """nulls, merged edges, an unseen category, a column that only some fits take, more bins than a word marks."""
    rows = [(i, float(i % 7) if i % 5 else None, float(i * i), "abc"[i % 3], f"v{i}" if i % 3 == 0 else "w", i % 3 + 1, "train") for i in range(30)]
    df = table(spark, [*rows, (30, 2.0, float("nan"), "z", None, None, "test")], "id long, x double, y double, g string, h string, fold int, split string")
    train = df.where("split = 'train'")
    for bins, xs in ((3, ["x", "y"]), (70, ["y"])):
        ns, cs = num.NumericStats(train, xs, [1, 2, 3]), cat.CategoryStats(train, ["g", "h"], 3)
        fitted = ix.fit_cross_binned(ns, cs, bins, 8)
        wide = fitted.transform(df, 3, KEEP)
        want = sorted((*[r[c] for c in KEEP], r["feature"]) for r in cat.sparse_long(wide, fitted.names(), KEEP).collect())
        long = fitted.transform_long(df, KEEP)
        assert sorted((*[r[c] for c in KEEP], r["feature"]) for r in long.collect()) == want
        # a crossed value counts where the fit's own rows have it
        seen = {(f, r["feature"]) for f in (1, 2, 3) for r in long.where(f"role = 'train' and fit_fold = {f}").collect()}
        assert seen and all((f, name) in seen for _, f, _, name in want)
    assert ix.fit_cross_binned(ns, cat.CategoryStats(train, ["g"], 3), 3, 1).transform_long(df, KEEP).count() == 0


def test_cross_bin_long_is_compiled(spark):
    test_long_tables_are_compiled(spark, "cross_bin_long")
