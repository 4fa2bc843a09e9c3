"""Fold-complement statistics.

Every fitted operator needs statistics over "all training rows except fold f"
for each f. Instead of k scans:

* algebraic statistics (counts, sums, shifted sums of squares, per-category
  counts and target sums) are aggregated once by (key, fold) and the complement
  is ``total - fold``;
* order statistics (medians, quartiles, bin edges) come from
  :func:`select_ranks`, an exact distributed selection: the summary's quantile
  sketches give each target a narrow bracket, and each pass is one
  aggregate of a histogram of the brackets, grouped by (key, fold, bucket), so
  the complement for every fit fold falls out of the same small table. Few values
  are counted one by one; else a bracket that spans several powers of two is cut by
  sign and exponent, one inside a power of two linearly by BUCKETS: at most
  PASSES passes resolve all 64 bits, whatever the distribution. No task ever holds a whole column or group, and the
  driver only sees a handful of rows per target and pass.

Keys are strings (normally the column name); folds are 1..k; ``fit_fold = 0``
means "no fold excluded" (statistics over all rows).
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foldwise.functions.scalar import observed

BUCKETS = 1024
#: One pass by sign and exponent, then the 52 bits of the fraction at log2(BUCKETS) = 10 a pass, and one to spare.
PASSES = 8
#: Quantiles that a fold's sketch gives, and its accuracy (rank errors of n / SKETCH).
GRID = 200
SKETCH = 10_000
#: Values in all open segments up to which a pass counts them one by one.
VALUES = 1_000_000


def long_numeric(df: DataFrame, cols: list[str], fold_col: str = "fold") -> DataFrame:
    """(key, fold, x) for every value of ``cols`` that is neither NULL nor NaN (one scan, stack)."""
    arr = F.array(*[F.struct(F.lit(c).alias("key"), observed(c).alias("x")) for c in cols])
    return (df.select(F.col(fold_col).cast("int").alias("fold"), F.inline(arr))
            .where(F.col("x").isNotNull()))


class Summary(dict):
    """{(key, fold): (count, min, max)}, and in ``grid`` the sketched quantiles of each."""

    def __init__(self, *args):
        super().__init__(*args)
        self.grid: dict = {}


def fold_summary(long_df: DataFrame) -> Summary:
    """Counts, bounds and a quantile sketch of every (key, fold) -- one aggregate, #keys x k rows."""
    points = [i / GRID for i in range(GRID + 1)]
    rows = (long_df.groupBy("key", "fold")
            .agg(F.count(F.lit(1)).alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi"), F.percentile_approx("x", points, SKETCH).alias("q"))
            .collect())
    out = Summary({(r["key"], r["fold"]): (r["n"], r["lo"], r["hi"]) for r in rows})
    out.grid = {(r["key"], r["fold"]): r["q"] for r in rows}
    return out


def complement(summary: dict, key: str, fit_fold: int):
    """(count, min, max) over folds other than ``fit_fold`` (0 = all folds)."""
    n, lo, hi = 0, None, None
    for (k_, f), (c, a, b) in summary.items():
        if k_ != key or f == fit_fold:
            continue
        n += c
        lo = a if lo is None else min(lo, a)
        hi = b if hi is None else max(hi, b)
    return n, lo, hi


class Ranks(dict):
    """{target: value}, and the number of scans it took after the summary."""

    passes = 0


def _rank_bounds(summary: Summary, key: str, fit_fold: int):
    """(values, at least so many are <= each, at most so many are < each) of a complement, by the folds' sketches."""
    parts = [(np.array(q), summary[(k_, f)][0]) for (k_, f), q in summary.grid.items() if k_ == key and f != fit_fold]
    values = np.unique(np.concatenate([q for q, _ in parts]))
    least, most = np.zeros(len(values)), np.zeros(len(values))
    for q, n in parts:
        slack = math.ceil(n / SKETCH) + 1
        least += np.clip((np.searchsorted(q, values, side="right") - 1) * n / GRID - slack, 0, n)
        most += np.clip(np.searchsorted(q, values, side="left") * n / GRID + slack, 0, n)
    return values, least, most


def _first_brackets(summary: dict, targets: list) -> tuple[dict, float]:
    """Where each target's value should lie, and about how many values lie in all brackets. Sketches may be wrong;
    what falls outside is found by the counts."""
    out, weight = {}, {}
    bounds: dict = {}
    for t in targets:
        key, f, r = t
        n, lo, hi = complement(summary, key, f)
        if not getattr(summary, "grid", None):
            out[t], weight[(key, lo, hi)] = (lo, hi), n
            continue
        if (key, f) not in bounds:
            bounds[(key, f)] = _rank_bounds(summary, key, f)
        values, least, most = bounds[(key, f)]
        i, j = np.searchsorted(most, r, side="right") - 1, np.searchsorted(least, r + 1, side="left")
        a, b = float(values[i]) if i >= 0 else lo, float(values[j]) if j < len(values) else hi
        out[t] = (max(a, lo), min(b, hi))
        weight[(key, *out[t])] = (least[j] if j < len(values) else n) - (most[i] if i >= 0 else 0)
    return out, sum(max(0.0, w) for w in weight.values())


def _segments(brackets) -> dict:
    """{key: disjoint (lo, hi) in ascending order} that cover the brackets."""
    out: dict = {}
    for key, lo, hi in sorted(set(brackets)):
        have = out.setdefault(key, [])
        if have and lo <= have[-1][1]:
            have[-1] = (have[-1][0], max(have[-1][1], hi))
        else:
            have.append((lo, hi))
    return out


def select_ranks(long_df: DataFrame, targets, summary: dict | None = None,
                 buckets: int = BUCKETS) -> Ranks:
    """Exact order statistics of fold complements.

    ``targets``: iterable of (key, fit_fold, rank) with 0-based ``rank`` in the
    ascending multiset {x : key, fold != fit_fold}. Returns {target: value}.

    The summary's sketches say where the values should lie. A pass counts what lies in those
    segments, by bucket, or by value where few are left, and between them, per fold; running sums of the
    complements give every target its bucket, exactly. What is not decided then goes on
    within its bucket, so two passes do unless millions of values are that close.
    """
    spark = long_df.sparkSession
    targets = sorted(set(targets))
    result = Ranks()
    if not targets:
        return result
    summary = summary if summary is not None else fold_summary(long_df)
    open_targets = []
    for t in targets:
        key, f, r = t
        n, lo, hi = complement(summary, key, f)
        if not 0 <= r < n:
            raise ValueError(f"rank {r} outside 0..{n - 1} for {key} (fit fold {f})")
        if lo == hi or r == 0:
            result[t] = lo
        elif r == n - 1:
            result[t] = hi
        else:
            open_targets.append(t)
    brackets, left = _first_brackets(summary, open_targets)
    for _ in range(PASSES):
        if not brackets:
            return result
        result.passes += 1
        segments = _segments((t[0], *b) for t, b in brackets.items())
        by_value = left <= VALUES
        # both tables hold a few numbers per target: broadcast is bounded
        table = spark.createDataFrame([(k, [a for a, _ in v], [b for _, b in v]) for k, v in segments.items()], "skey string, los array<double>, his array<double>")
        wanted: dict = {}
        for key, f, r in brackets:
            wanted.setdefault((key, f), []).append(r)
        ranks = spark.createDataFrame([(k, f, r) for (k, f), r in wanted.items()], "skey string, fit_fold int, ranks array<long>")
        x = F.col("x")
        # the last segment that begins at or below x, and whether it reaches x
        cell = long_df.join(F.broadcast(table), F.col("key") == F.col("skey")).withColumn("seg", F.size(F.filter("los", lambda v: v <= x)))
        inside = (F.col("seg") > 0) & (x <= F.get("his", F.col("seg") - 1))
        lo, hi = F.get("los", F.col("seg") - 1), F.get("his", F.col("seg") - 1)
        span = hi * 0.5 - lo * 0.5
        linear = F.when(span > 0, F.least(F.floor((x * 0.5 - lo * 0.5) / span * buckets), F.lit(buckets - 1))).otherwise(F.lit(0))
        bucket = x if by_value else F.when(_binade(lo) == _binade(hi), linear).otherwise(_binade(x)).cast("double")
        hist = (cell.select("key", "fold", "seg", F.coalesce(~inside, F.lit(True)).alias("gap"), F.when(inside, bucket).otherwise(F.lit(0.0)).alias("bucket"), "x")
                .groupBy("key", "fold", "seg", "gap", "bucket")
                .agg(F.count(F.lit(1)).alias("c"), F.min("x").alias("mn"), F.max("x").alias("mx")))
        comp = (hist.join(F.broadcast(ranks), F.col("key") == F.col("skey")).where(F.col("fold") != F.col("fit_fold"))
                .groupBy("key", "fit_fold", "seg", "gap", "bucket")
                .agg(F.sum("c").alias("c"), F.min("mn").alias("mn"), F.max("mx").alias("mx"), F.first("ranks").alias("ranks")))
        w = Window.partitionBy("key", "fit_fold").orderBy("seg", "gap", "bucket").rowsBetween(Window.unboundedPreceding, 0)
        cum = comp.withColumn("cum", F.sum("c").over(w))
        hit = F.filter("ranks", lambda r: (r >= F.col("cum") - F.col("c")) & (r < F.col("cum")))
        picked = cum.select("key", "fit_fold", F.explode(hit).alias("r"), (F.col("cum") - F.col("c")).alias("before"), "c", "mn", "mx").collect()
        brackets, weight = {}, {}
        for row in picked:
            t = (row["key"], row["fit_fold"], row["r"])
            within = row["r"] - row["before"]
            if row["mn"] == row["mx"] or within == 0:
                result[t] = row["mn"]
            elif within == row["c"] - 1:
                result[t] = row["mx"]
            else:
                brackets[t] = (row["mn"], row["mx"])
                weight[(t[0], row["mn"], row["mx"])] = 2 * row["c"]
        left = sum(weight.values())
    if brackets:
        raise RuntimeError(f"rank selection did not converge for {list(brackets)[:3]}")
    return result


def _binade(x):
    """Sign and exponent of a double as one ascending number; infinities beyond all, zero between."""
    size = F.least(F.greatest(F.floor(F.log2(F.abs(x))), F.lit(-1075)), F.lit(1025)) + 1100
    return F.when(x == 0, F.lit(0)).otherwise(F.signum(x).cast("long") * size)


def linear_positions(n: int, p: float):
    """NumPy 'linear' quantile: (lower rank, upper rank, fraction)."""
    h = (n - 1) * p
    lo = int(math.floor(h))
    hi = min(lo + 1, n - 1)
    return lo, hi, h - lo


def averaged_cdf_positions(n: int, p: float):
    """NumPy 'averaged_inverted_cdf': (rank a, rank b), value = mean of both."""
    g = n * p
    j = int(math.floor(g))
    if g > j:
        r = min(j, n - 1)
        return r, r
    return max(min(j - 1, n - 1), 0), min(j, n - 1)


def _interp(a: float, b: float, frac: float) -> float:
    """NumPy's lerp: from the upper end when frac >= 0.5, else from the lower."""
    d = b - a
    return b - d * (1.0 - frac) if frac >= 0.5 else a + d * frac


def complement_quantiles(long_df: DataFrame, keys: list[str], fit_folds: list[int], probs: list[float],
                         method: str = "linear", summary: dict | None = None,
                         impute: dict | None = None, buckets: int = BUCKETS) -> dict:
    """Quantiles of the fold complement for every (key, fit fold).

    ``impute``: optional {(key, fit_fold): (median, null_count)} -- quantiles are
    then taken over the values with the nulls replaced by that median, without
    materialising the imputed column (rank arithmetic around the median).
    Returns {(key, fit_fold): [q(p) for p in probs]}.
    """
    summary = summary if summary is not None else fold_summary(long_df)
    below_eq = {}
    if impute:
        below_eq = _count_around(long_df, {kf: m for kf, (m, _) in impute.items()})
    plan = {}
    targets = set()
    for key in keys:
        for f in fit_folds:
            n, _, _ = complement(summary, key, f)
            z = impute[(key, f)][1] if impute else 0
            total = n + z
            if total == 0:
                raise ValueError(f"column '{key}' has no values to fit on (fold {f})")
            entries = []
            for p in probs:
                if method == "linear":
                    a, b, frac = linear_positions(total, p)
                else:
                    a, b = averaged_cdf_positions(total, p)
                    frac = 0.5 if a != b else 0.0
                ra, rb = (_map_imputed(a, below_eq.get((key, f)), z), _map_imputed(b, below_eq.get((key, f)), z))
                for r in (ra, rb):
                    if r[0] == "rank":
                        targets.add((key, f, r[1]))
                entries.append((ra, rb, frac))
            plan[(key, f)] = entries
    values = select_ranks(long_df, targets, summary, buckets)
    out = {}
    for (key, f), entries in plan.items():
        m = impute[(key, f)][0] if impute else None
        res = []
        for ra, rb, frac in entries:
            va = values[(key, f, ra[1])] if ra[0] == "rank" else m
            vb = values[(key, f, rb[1])] if rb[0] == "rank" else m
            res.append(_interp(va, vb, frac) if frac else va)
        out[(key, f)] = res
    return out


def _map_imputed(r: int, around, z: int):
    """Rank in the imputed multiset -> rank among observed values or the median."""
    if not z:
        return ("rank", r)
    lt, le = around
    if r < lt:
        return ("rank", r)
    if r < le + z:
        return ("median", None)
    return ("rank", r - z)


def _count_around(long_df: DataFrame, points: dict) -> dict:
    """{(key, fit_fold): (#x < m, #x <= m)} over the complement, one aggregate."""
    spark = long_df.sparkSession
    schema = T.StructType([T.StructField("pkey", T.StringType()), T.StructField("fit_fold", T.IntegerType()),
                           T.StructField("m", T.DoubleType())])
    pts = spark.createDataFrame([(k, f, float(m)) for (k, f), m in points.items()], schema)
    rows = (long_df.join(F.broadcast(pts), F.col("key") == F.col("pkey"))
            .where(F.col("fold") != F.col("fit_fold"))
            .groupBy("pkey", "fit_fold")
            .agg(F.count_if(F.col("x") < F.col("m")).alias("lt"), F.count_if(F.col("x") <= F.col("m")).alias("le"))
            .collect())
    out = {(r["pkey"], r["fit_fold"]): (r["lt"], r["le"]) for r in rows}
    for kf in points:
        out.setdefault(kf, (0, 0))
    return out


def null_counts(df: DataFrame, cols: list[str], fold_col: str = "fold") -> dict:
    """{(col, fold): (rows, nulls)} -- one grouped aggregate."""
    aggs = [F.count(F.lit(1)).alias("__rows")] + [F.count_if(observed(c).isNull()).alias(c) for c in cols]
    rows = df.groupBy(F.col(fold_col).cast("int").alias("fold")).agg(*aggs).collect()
    out = {}
    for r in rows:
        for c in cols:
            out[(c, r["fold"])] = (r["__rows"], r[c])
    return out


def complement_nulls(nc: dict, col: str, fit_fold: int):
    rows = nulls = 0
    for (c, f), (r, z) in nc.items():
        if c == col and f != fit_fold:
            rows += r
            nulls += z
    return rows, nulls


def complement_medians(df: DataFrame, cols: list[str], fit_folds: list[int], fold_col: str = "fold",
                       long_df: DataFrame | None = None, summary: dict | None = None):
    """Median imputation statistics: {(col, f): (median, nulls, rows)}.

    Raises ``ValueError`` naming a column with no observed value in a fit.
    """
    long_df = long_df if long_df is not None else long_numeric(df, cols, fold_col)
    summary = summary if summary is not None else fold_summary(long_df)
    for c in cols:
        for f in fit_folds:
            if complement(summary, c, f)[0] == 0:
                raise ValueError(f"numeric column '{c}' has only missing values in the fitted rows")
    med = complement_quantiles(long_df, cols, fit_folds, [0.5], "linear", summary)
    nc = null_counts(df, cols, fold_col)
    out = {}
    for c in cols:
        for f in fit_folds:
            rows, nulls = complement_nulls(nc, c, f)
            out[(c, f)] = (med[(c, f)][0], nulls, rows)
    return out


def imputed_moments(df: DataFrame, cols: list[str], medians: dict, fit_folds: list[int],
                    fold_col: str = "fold", shifts: dict | None = None) -> dict:
    """Mean and population / sample variance of the median-imputed columns per fit fold.

    One grouped aggregate of shifted sums by fold; the nulls contribute
    ``nulls * (median - shift)`` algebraically. Returns
    {(col, f): (mean, var_pop, var_samp, n)}.
    """
    shifts = shifts or {}
    aggs = []
    for c in cols:
        s = float(shifts.get(c, 0.0))
        d = observed(c) - F.lit(s)
        aggs += [F.sum(d).alias(f"{c}__s1"), F.sum(d * d).alias(f"{c}__s2")]
    rows = df.groupBy(F.col(fold_col).cast("int").alias("fold")).agg(*aggs).collect()
    out = {}
    for c in cols:
        s = float(shifts.get(c, 0.0))
        for f in fit_folds:
            s1 = sum((r[f"{c}__s1"] or 0.0) for r in rows if r["fold"] != f)
            s2 = sum((r[f"{c}__s2"] or 0.0) for r in rows if r["fold"] != f)
            m, nulls, n = medians[(c, f)]
            dm = m - s
            s1 += nulls * dm
            s2 += nulls * dm * dm
            mean_d = s1 / n
            var_pop = max(s2 / n - mean_d * mean_d, 0.0)
            var_samp = var_pop * n / (n - 1) if n > 1 else float("nan")
            out[(c, f)] = (s + mean_d, var_pop, var_samp, n)
    return out


def fit_folds_of(k: int) -> list[int]:
    return list(range(1, k + 1))


def fits_table(spark, k: int) -> DataFrame:
    """k rows (fit_fold 1..k); broadcast everywhere, its size is the fold count."""
    return spark.range(1, k + 1).select(F.col("id").cast("int").alias("fit_fold"))


def complement_groups(df: DataFrame, group_cols: list[str], k: int, partial: dict,
                      combine: dict, fold_col: str = "fold") -> DataFrame:
    """Statistics of every group over the rows outside each fit fold.

    ``partial``: name -> aggregate Column, computed once per (group, fold) with
    map-side combining; ``combine``: name -> 'sum' | 'min' | 'max' used to merge
    the partials of the other k-1 folds (summing the k-1 partials keeps a
    single-row complement exact, unlike total minus fold). Output: one row per
    (group, fit_fold) in which the group occurs, k rows per group at most.
    """
    from foldwise.operators.base import outside_fold
    parts = df.groupBy(*group_cols, F.col(fold_col).cast("int").alias("_fold")).agg(
        *[c.alias(n) for n, c in partial.items()])
    fns = {"sum": F.sum, "min": F.min, "max": F.max}
    return (parts.withColumn("fit_fold", outside_fold("_fold", k))
            .groupBy(*group_cols, "fit_fold")
            .agg(*[fns[combine[n]](n).alias(n) for n in partial]))


def fold_totals(df: DataFrame, k: int, fold_col: str = "fold", y_col: str | None = None) -> dict:
    """{fit_fold: (rows, sum_y)} over the complement, from one k-row aggregate."""
    aggs = [F.count(F.lit(1)).alias("n")]
    if y_col:
        aggs.append(F.sum(F.col(y_col).cast("double")).alias("s"))
    rows = df.groupBy(F.col(fold_col).cast("int").alias("f")).agg(*aggs).collect()
    out = {}
    for f in range(1, k + 1):
        n = sum(r["n"] for r in rows if r["f"] != f)
        s = sum((r["s"] or 0.0) for r in rows if r["f"] != f) if y_col else None
        out[f] = (n, s)
    return out


def conditional_ranks(df: DataFrame, key_col: str, order_col: str, flags: list[str],
                      partitions: int | None = None) -> DataFrame:
    """For each row: ``rank_<flag>`` = number of rows with the same key, a smaller
    ``order_col`` and ``flag`` true. Rows are range-partitioned on (key, order),
    ranked inside their partition and shifted by the flag counts of earlier
    partitions -- no window holds a whole key."""
    spark = df.sparkSession
    parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    # The range cut is sampled with a seed tied to the RDD id; checkpoint it once so
    # both branches below (per-partition counts, in-partition ranks) agree.
    from foldwise.session import cut_lineage
    r = cut_lineage(df.repartitionByRange(parts, key_col, order_col).withColumn("_b", F.spark_partition_id()))
    counts = r.groupBy(key_col, "_b").agg(*[F.sum(F.col(f).cast("long")).alias(f) for f in flags])
    wb = Window.partitionBy(key_col).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(key_col, "_b", *[F.coalesce(F.sum(f).over(wb), F.lit(0)).alias(f"_off_{f}")
                                            for f in flags])
    wl = Window.partitionBy(key_col, "_b").orderBy(order_col).rowsBetween(Window.unboundedPreceding, -1)
    local = r.select("*", *[F.coalesce(F.sum(F.col(f).cast("long")).over(wl), F.lit(0)).alias(f"_loc_{f}")
                            for f in flags])
    # offsets: one row per (key, partition) -- bounded by #keys x #partitions.
    out = local.join(F.broadcast(offsets), [key_col, "_b"])
    for f in flags:
        out = out.withColumn(f"rank_{f}", F.col(f"_off_{f}") + F.col(f"_loc_{f}"))
    return out.drop("_b", *[f"_off_{f}" for f in flags], *[f"_loc_{f}" for f in flags])
