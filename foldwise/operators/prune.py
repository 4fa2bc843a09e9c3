"""High-correlation pruner.

Pairwise Pearson correlations of the dense training block of each fit come from one scan:
tasks keep, per fit fold, the centred moments of every pair of columns over the rows where both
are present, as matrices, which a tree reduce merges. A constant column has no correlation
(its centred moments are exactly 0) and never causes a drop. Column j is dropped when any
earlier column i has |corr| above the threshold -- also when i is itself
dropped. Only the d x d matrices per fold reach the driver.
"""

from __future__ import annotations

import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldwise.session import ship_package


def _pair_moments(x: np.ndarray, present: np.ndarray) -> tuple:
    """(rows, means, square sums, products) of a block, d x d each: of column i over the rows where i and j are present; centred at
    that mean. Values are taken from the first one, so that those of a constant column are exactly 0."""
    d = x.shape[1]
    n, mean, square, product = np.zeros((d, d)), np.zeros((d, d)), np.zeros((d, d)), np.zeros((d, d))
    whole = np.flatnonzero(present.all(axis=0))
    if len(whole):
        at = np.ix_(whole, whole)
        first = x[0, whole]
        off = x[:, whole] - first
        m = off.mean(axis=0)
        cross = (off - m).T @ (off - m)
        n[at], mean[at], square[at], product[at] = len(x), (first + m)[:, None], np.diag(cross)[:, None], cross
    for j in np.flatnonzero(~present.all(axis=0)):
        for i in range(d):
            both = present[:, i] & present[:, j]
            if not both.any():
                continue
            for a, b in ((i, j), (j, i)):
                u, v = x[both, a], x[both, b]
                du, dv = u - u[0], v - v[0]
                n[a, b], mean[a, b] = both.sum(), u[0] + du.mean()
                du, dv = du - du.mean(), dv - dv.mean()
                square[a, b], product[a, b] = du @ du, du @ dv
    return n, mean, square, product


def _merged(a: tuple, b: tuple) -> tuple:
    n = a[0] + b[0]
    share = a[0] * b[0] / np.where(n > 0, n, 1)
    off = np.where((a[0] > 0) & (b[0] > 0), b[1] - a[1], 0.0)
    mean = np.where(a[0] > 0, a[1] + off * (b[0] / np.where(n > 0, n, 1)), b[1])
    return n, mean, a[2] + b[2] + off * off * share, a[3] + b[3] + off * off.T * share


def _merge_groups(a: dict, b: dict) -> dict:
    return {g: _merged(a[g], b[g]) if g in a and g in b else a.get(g, b.get(g)) for g in {*a, *b}}


def _group_moments(batches):
    """Moments per group of a partition, as one row; a null is absent, a NaN is a value that spoils its pairs."""
    held: dict = {}
    for batch in batches:
        if not batch.num_rows:
            continue
        flat = batch.column("x").flatten()
        present = flat.is_valid().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
        x = flat.fill_null(0.0).to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
        groups = batch.column("g").to_pylist() if batch.column("g").null_count else batch.column("g").to_numpy(zero_copy_only=False)
        groups = np.asarray(groups, dtype=object if batch.column("g").null_count else None)
        for g in dict.fromkeys(groups.tolist()):
            mine = np.array([v is None for v in groups]) if g is None else groups == g
            with np.errstate(invalid="ignore", over="ignore"):
                held = _merge_groups(held, {g: _pair_moments(x[mine], present[mine])})
    if held:
        yield pa.RecordBatch.from_pydict({"m": [pickle.dumps(held)]})


def correlations(df: DataFrame, features: list[str], group_col: str = "fit_fold") -> dict:
    """{(group, i, j): corr or None} for i < j."""
    d = len(features)
    if d < 2:
        return {}
    ship_package(df.sparkSession)
    rows = df.select(F.col(group_col).alias("g"), F.array(*[F.col(c).cast("double") for c in features]).alias("x"))
    parts = rows.mapInArrow(_group_moments, "m binary").rdd.map(lambda r: pickle.loads(r["m"]))
    found = parts.treeAggregate({}, _merge_groups, _merge_groups)
    out = {}
    for g, (_, _, square, product) in found.items():
        for i in range(d):
            for j in range(i + 1, d):
                size = float(np.sqrt(square[i, j]) * np.sqrt(square[j, i]))
                out[(g, i, j)] = None if size == 0 else float(product[i, j]) / size
    return out


def dropped_features(corr: dict, features: list[str], groups: list, threshold: float = 0.98) -> dict:
    """{group: set of dropped feature names}."""
    if not 0 < threshold <= 1:
        raise ValueError("threshold must be in (0, 1]")
    out = {}
    for g in groups:
        drop = set()
        if len(features) >= 2:
            for j in range(1, len(features)):
                for i in range(j):
                    v = corr.get((g, i, j))
                    if v is not None and v == v and abs(v) > threshold:
                        drop.add(features[j])
                        break
        out[g] = drop
    return out
