"""Correlations of the pruner: one scan of matrices, pairwise where values are missing."""

import numpy as np
import pytest

from foldwise.operators import prune as pr


def test_correlations_pairwise_constant_nan_and_large_means(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(400, 7)) + [0, 0, 1e6, 0, 0, 0, 0]
    x[:, 1] += x[:, 0]
    x[:, 3] = 0.1                                   # constant
    rows = [(i % 3 + 1, *[float(v) for v in r]) for i, r in enumerate(x)]
    # column 4 is missing at times, column 5 constant where column 4 is present, column 6 has a NaN in group 2
    rows = [(g, a, b, c, d, None if i % 4 else e, f if i % 4 else 0.3, float("nan") if i == 1 else h) for i, (g, a, b, c, d, e, f, h) in enumerate(rows)]
    names = [f"c{i}" for i in range(7)]
    got = pr.correlations(spark.createDataFrame(rows, "fit_fold int, " + ", ".join(f"{n} double" for n in names)).repartition(5), names)
    for g in (1, 2, 3):
        mine = np.array([[np.nan if v is None else v for v in r[1:]] for r in rows if r[0] == g])
        for i in range(7):
            for j in range(i + 1, 7):
                c = got[(g, i, j)]
                if j == 6 and g == 2:
                    assert c is None or c != c or i == 4    # the NaN is not in a row that has column 4
                elif 3 in (i, j) or (i, j) == (4, 5):
                    assert c is None
                else:
                    both = ~np.isnan(mine[:, i]) & ~np.isnan(mine[:, j])
                    assert c == pytest.approx(np.corrcoef(mine[both, i], mine[both, j])[0, 1], abs=1e-8)


def test_wide_blocks_take_one_scan(spark):
    """an aggregate a pair made methods that the JVM leaves uncompiled, and a scan per 400 pairs."""
    names = [f"c{i}" for i in range(60)]
    df = spark.range(200).selectExpr("cast(id % 2 as int) + 1 as fit_fold", *[f"cast(hash(id, {i}) as double) as {n}" for i, n in enumerate(names)])
    sc = spark.sparkContext
    sc.setJobGroup("prune-scans", "")
    got = pr.correlations(df, names)
    jobs = len(sc.statusTracker().getJobIdsForGroup("prune-scans"))
    sc.setLocalProperty("spark.jobGroup.id", None)
    assert len(got) == 2 * 60 * 59 // 2 and jobs == 1
