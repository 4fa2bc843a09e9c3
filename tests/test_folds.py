import hashlib

import numpy as np
from pyspark.sql import functions as F

from foldwise.plans import folds


def _md5_order(ids, seed=42):
    return sorted(ids, key=lambda i: (hashlib.md5(f"{seed}:{i}".encode()).hexdigest(), i))


def test_kfold_sizes_and_members(spark):
    ids = list(range(1, 11))
    df = spark.createDataFrame([(i,) for i in ids], "id long")
    out = {r["id"]: r["fold"] for r in folds.kfold(df, "id", 3).collect()}
    order = _md5_order(ids)
    expect = {}
    sizes = [4, 3, 3]  # the first n % k folds take one extra row
    pos = 0
    for f, s in enumerate(sizes, start=1):
        for i in order[pos:pos + s]:
            expect[i] = f
        pos += s
    assert out == expect


def test_kfold_each_row_once(spark):
    df = spark.range(0, 997).select(F.col("id"))
    fd = folds.kfold(df, "id", 5)
    v = {r["check"]: r["violations"] for r in folds.validate_folds(fd, "id", 5).collect()}
    assert all(x == 0 for x in v.values())
    sizes = sorted(r["count"] for r in fd.groupBy("fold").count().collect())
    assert sizes == [199, 199, 199, 200, 200]


def test_unshuffled_kfold_is_contiguous(spark):
    df = spark.range(0, 103).select((F.col("id") * 7).alias("id"))
    out = sorted((r["id"], r["fold"]) for r in folds.kfold(df, "id", 4, shuffle=False).collect())
    got = [f for _, f in out]
    assert got == sorted(got)
    assert [got.count(f) for f in range(1, 5)] == [26, 26, 26, 25]


def test_stratified_allocation_matches_round_robin(spark):
    rng = np.random.default_rng(3)
    y = (rng.random(257) < 0.3).astype(int)
    df = spark.createDataFrame([(i, int(v)) for i, v in enumerate(y)], "id long, y int")
    out = folds.stratified_kfold(df, "id", "y", 5).collect()
    k = 5
    y_sorted = np.sort(y)
    for c in (0, 1):
        want = [int(np.sum(y_sorted[f::k] == c)) for f in range(k)]
        got = [sum(1 for r in out if r["y"] == c and r["fold"] == f + 1) for f in range(k)]
        assert got == want
