"""Blending and ensemble selection.

Candidate predictions live in one long table ``(candidate_id, row key, ...,
y_pred)``. Blends group by the row key instead of n-way joins; correlations
and the greedy selection pivot the (small, configured) candidate list into
columns so a single aggregate yields the whole Gram / moment matrix. For squared
errors, selection is then arithmetic on an m x m matrix on the driver; other
metrics score all trial blends of a round in one pass.
"""

from __future__ import annotations

import hashlib
import json
import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldwise.functions.scalar import ACCURACY_THRESHOLD, close
from foldwise.plans import metrics as mt


def normalize_weights(candidate_ids: list[str], weights: list[float] | None = None) -> dict:
    """Equal weights, or positive finite weights scaled to sum 1."""
    if len(candidate_ids) < 2:
        raise ValueError("a blend needs at least two components")
    if len(set(candidate_ids)) != len(candidate_ids):
        raise ValueError("blend components must be distinct")
    if weights is None:
        weights = [1.0] * len(candidate_ids)
    if len(weights) != len(candidate_ids):
        raise ValueError("one weight per component is required")
    if any((not math.isfinite(w)) or w <= 0 for w in weights):
        raise ValueError("blend weights must be positive and finite")
    total = float(sum(weights))
    return {c: w / total for c, w in zip(candidate_ids, weights)}


def short_hash(payload: dict) -> str:
    """First 8 hex digits of the SHA-256 of the payload as JSON with sorted keys."""
    return hashlib.sha256(json.dumps(payload, sort_keys=True).encode("utf-8")).hexdigest()[:8]


def blend_id(weights: dict, competition: dict) -> str:
    """``blend__<hash8>`` of the competition's identity and the components, ordered by id."""
    components = [{"candidate_id": c, "weight": weights[c]} for c in sorted(weights)]
    return "blend__" + short_hash({"competition": competition, "components": components})


def model_candidate_id(family: str, representation_id: str, payload: dict) -> str:
    """``<family>-<representation>-<hash8>`` of what else makes the candidate."""
    return f"{family}-{representation_id}-{short_hash(payload)}"


def _weights_df(spark, weights: dict) -> DataFrame:
    # one row per configured component: bounded by the blend definition
    return F.broadcast(spark.createDataFrame(list(weights.items()), "candidate_id string, w double"))


def blend(pred: DataFrame, weights: dict, key: list[str], carry: list[str] | None = None) -> DataFrame:
    """B2 (J3/J4): weighted average per row key. A row that lacks a component, or has one
    twice, is an error: re-weighting over what is there would be another blend."""
    carry = carry or []
    w = _weights_df(pred.sparkSession, weights)
    j = pred.join(w, "candidate_id")
    out = j.groupBy(*key).agg(
        *[F.first(c).alias(c) for c in carry],
        (F.sum(F.col("w") * F.col("y_pred")) / F.sum("w")).alias("y_pred"),
        F.count(F.lit(1)).alias("n_components"), F.count_distinct("candidate_id", "y_pred").alias("_m"))
    whole = (F.col("n_components") == len(weights)) & (F.col("_m") == len(weights))
    broken = F.raise_error(F.concat(F.lit("blend components do not align at row "), *[F.col(k).cast("string") for k in key])).cast("double")
    return out.withColumn("y_pred", F.when(whole, F.col("y_pred")).otherwise(broken)).drop("_m")


def finalize(blended: DataFrame, metric: str, positive=1, negative=0) -> DataFrame:
    """Rmsle clips at 0; accuracy turns scores into labels plus a probability sidecar."""
    if metric == "rmsle":
        return blended.withColumn("y_pred", F.greatest(F.col("y_pred"), F.lit(0.0)))
    if metric == "accuracy":
        return (blended.withColumn("probability", F.col("y_pred"))
                .withColumn("label", F.when(F.col("y_pred") >= F.lit(ACCURACY_THRESHOLD), F.lit(positive))
                            .otherwise(F.lit(negative))))
    return blended


def alignment_violations(pred: DataFrame, key: list[str], candidates: list[str], truth_cols=("y_true", "fold")):
    """Rows that lack a component or repeat one, and rows whose truth / fold differ between
    components (allclose for floating columns; NULL differs from a value)."""
    # the configured candidates are counted by a flag each: a distinct count would keep every (row, candidate) pair
    present = [F.max(F.when(F.col("candidate_id") == c, 1)) for c in candidates]
    g = pred.where(F.col("candidate_id").isin(*candidates)).groupBy(*key).agg(
        F.size(F.array_compact(F.array(*present))).alias("m"), F.count(F.lit(1)).alias("rows"),
        *[F.count(c).alias(f"n_{c}") for c in truth_cols],
        *[F.max_by(c, F.col("candidate_id") == candidates[0]).alias(f"ref_{c}") for c in truth_cols],
        *[F.min(c).alias(f"lo_{c}") for c in truth_cols], *[F.max(c).alias(f"hi_{c}") for c in truth_cols])

    def differs(c):
        return ((F.col(f"n_{c}") != F.col("rows")) & (F.col(f"n_{c}") != 0)) | ~close(f"lo_{c}", f"ref_{c}") | ~close(f"hi_{c}", f"ref_{c}")
    return g.agg(F.count_if((F.col("m") != len(candidates)) | (F.col("rows") != len(candidates))).alias("misaligned_rows"),
                 *[F.count_if(differs(c)).alias(f"inconsistent_{c}") for c in truth_cols])


def wide(pred: DataFrame, candidates: list[str], key: list[str], carry: list[str] | None = None) -> DataFrame:
    """Pivot the configured candidates into columns (values listed: no discovery pass)."""
    carry = carry or []
    return pred.groupBy(*key, *carry).pivot("candidate_id", candidates).agg(F.first("y_pred"))


def correlation_matrix(pred: DataFrame, candidates: list[str], key: list[str]) -> dict:
    """{(a, b): Pearson correlation of OOF predictions}, NULL-safe."""
    w = wide(pred, candidates, key)
    aggs = []
    for i, a in enumerate(candidates):
        for b in candidates[i + 1:]:
            aggs.append(F.try_divide(F.covar_pop(a, b), F.stddev_pop(a) * F.stddev_pop(b)).alias(f"{a}|{b}"))
    row = w.agg(*aggs).collect()[0] if aggs else {}
    out = {}
    for i, a in enumerate(candidates):
        out[(a, a)] = 1.0
        for b in candidates[i + 1:]:
            v = row[f"{a}|{b}"]
            out[(a, b)] = out[(b, a)] = v
    return out


# The columns of a blend summary, in order.
BLEND_SUMMARY_COLUMNS = (
    "blend_candidate_id", "blend_registry_key", "blend_metric_name", "blend_metric_mean", "blend_metric_std",
    "component_rank", "component_candidate_id", "component_candidate_type", "component_mlflow_run_id",
    "component_model_registry_key", "component_estimator_name", "component_representation_id",
    "component_config_fingerprint", "component_weight", "component_cv_metric_mean", "component_cv_metric_std",
    "avg_oof_correlation_to_others", "min_oof_correlation_to_others", "max_oof_correlation_to_others",
)
BLEND_REGISTRY_KEY = "blend_weighted_average"


def blend_summary(pred: DataFrame, weights: dict, metric: str, candidate_id: str, components: dict[str, dict], key: list[str]) -> DataFrame:
    """One row per component, in configured order: its metadata (``components``, by candidate id), weight,
    CV metric and OOF correlations, beside the blend's own CV metric. pred is long: key, fold, y_true,
    y_pred, candidate_id. Only one number per pair and per candidate reaches the driver."""
    names = list(weights)
    corr = correlation_matrix(pred, names, key)
    own = blend(pred, weights, [*key, "fold"], carry=["y_true"]).drop("n_components").withColumn("candidate_id", F.lit(candidate_id))
    rows = pred.where(F.col("candidate_id").isin(*names)).select(*key, "fold", "y_true", "y_pred", "candidate_id").unionByName(own)
    cv = {r["candidate_id"]: r for r in mt.cv_summary(mt.fold_metrics(rows, metric)).collect()}
    out = []
    for rank, c in enumerate(names, start=1):
        others = [corr[(c, b)] for b in names if b != c and corr[(c, b)] is not None]
        about = components.get(c, {})
        out.append((candidate_id, BLEND_REGISTRY_KEY, metric, cv[candidate_id]["cv_mean"], cv[candidate_id]["cv_std"], rank, c,
                    *(about.get(k) for k in ("candidate_type", "run_id", "model_registry_key", "estimator_name", "representation_id", "config_fingerprint")),
                    weights[c], cv[c]["cv_mean"], cv[c]["cv_std"],
                    sum(others) / len(others) if others else None, min(others, default=None), max(others, default=None)))
    kinds = ["string"] * 3 + ["double"] * 2 + ["int"] + ["string"] * 7 + ["double"] * 6
    return pred.sparkSession.createDataFrame(out, ", ".join(f"{n} {k}" for n, k in zip(BLEND_SUMMARY_COLUMNS, kinds, strict=True)))


# ---------------------------------------------------------------- greedy selection
QUADRATIC = ("mse", "rmse")


def _aligned(pred: DataFrame, candidates: list[str], key: list[str]) -> DataFrame:
    """The candidates' columns beside ``y_true``; a missing prediction is an error."""
    wd = wide(pred, candidates, key, carry=["y_true"])
    gap = F.raise_error(F.lit("candidate predictions do not cover the same rows")).cast("double")
    return wd.select(*key, "y_true", *[F.coalesce(F.col(c), gap).alias(c) for c in candidates])


def residual_grams(pred: DataFrame, candidates: list[str], key: list[str], row_weights: list | None = None) -> list[dict]:
    """Per row weight (default one: every row once): sum of w r_i r_j over the residuals
    r_i = p_i - y, and sum of w. All weights and pairs are columns of one aggregate.

    Weights of a blend sum to 1, so a blend's residual is the blend of residuals;
    residuals are small, which keeps close candidates apart in floating point."""
    wd = _aligned(pred, candidates, key)
    m = len(candidates)
    res = [F.col(c).cast("double") - F.col("y_true").cast("double") for c in candidates]
    aggs = []
    for w, wt in enumerate(row_weights or [F.lit(1.0)]):
        aggs.append(F.sum(wt).alias(f"n|{w}"))
        aggs += [F.sum(wt * res[i] * res[j]).alias(f"g|{w}|{i}|{j}") for i in range(m) for j in range(i, m)]
    r = wd.agg(*aggs).collect()[0]
    return [{"G": [[r[f"g|{w}|{min(i, j)}|{max(i, j)}"] for j in range(m)] for i in range(m)], "n": r[f"n|{w}"]}
            for w in range(len(row_weights or [1]))]


def gram(pred: DataFrame, candidates: list[str], key: list[str], row_weight=None) -> dict:
    return residual_grams(pred, candidates, key, None if row_weight is None else [row_weight])[0]


def _mse(stats: dict, weights: list[float]) -> float:
    s, m, G = float(sum(weights)), len(weights), stats["G"]
    return max(sum(weights[i] * weights[j] * G[i][j] for i in range(m) for j in range(m)) / (s * s) / stats["n"], 0.0)


def _gram_losses(stats: dict, metric: str):
    def losses(trials):
        return [math.sqrt(_mse(stats, t)) if metric == "rmse" else _mse(stats, t) for t in trials]
    return losses


def _scan_losses(wd: DataFrame, candidates: list[str], metric: str):
    """Losses of trial blends by one pass over the aligned predictions, all trials at once."""
    def losses(trials):
        blends = [sum((F.col(c) * F.lit(w / float(sum(t))) for c, w in zip(candidates, t) if w), F.lit(0.0)) for t in trials]
        rows = wd.select("y_true", F.inline(F.array(*[F.struct(F.lit(i).alias("trial"), b.alias("y_pred")) for i, b in enumerate(blends)])))
        found = {r["trial"]: r["metric_value"] for r in mt.fold_metrics(rows, metric, group_cols=("trial",)).collect()}
        sign = -1.0 if mt.greater_is_better(metric) else 1.0
        return [sign * found[i] for i in range(len(trials))]
    return losses


def _forward(losses, m: int, n_rounds: int, drop_non_improving: bool) -> tuple[list[int], float]:
    unit = [[int(i == j) for j in range(m)] for i in range(m)]
    singles = losses(unit)
    best = min(range(m), key=lambda i: (singles[i], i))
    counts, current = unit[best], singles[best]
    for _ in range(n_rounds):
        trials = [[c + u for c, u in zip(counts, unit[i])] for i in range(m)]
        after = losses(trials)
        i = min(range(m), key=lambda i: (after[i], i))
        improves = after[i] < current
        if not improves and drop_non_improving:
            break
        counts, current = trials[i], after[i]
        if not improves:
            break
    return counts, current


def greedy_select(stats: dict, candidates: list[str], n_rounds: int = 50, metric: str = "rmse",
                  drop_non_improving: bool = False) -> tuple[dict, float]:
    """B5 for mse / rmse, from residual Gram sums: forward selection with replacement from the
    best single candidate, without another scan. Other metrics: :func:`select_ensemble`.

    Stops after the first round without a gain; that round's pick is kept unless
    ``drop_non_improving``."""
    if metric not in QUADRATIC:
        raise ValueError(f"'{metric}' cannot be computed from Gram sums; use select_ensemble")
    counts, current = _forward(_gram_losses(stats, metric), len(candidates), n_rounds, drop_non_improving)
    total = float(sum(counts))
    return {c: counts[i] / total for i, c in enumerate(candidates)}, current


def select_ensemble(pred: DataFrame, candidates: list[str], key: list[str], metric: str, n_rounds: int = 50,
                    drop_non_improving: bool = False) -> tuple[dict, float]:
    """B5 for every metric: mse and rmse from one Gram pass; mae, rmsle, log loss, accuracy and
    AUC by one pass a round that scores all trial blends at once. The score is the metric's value."""
    _known(metric)
    if metric in QUADRATIC:
        return greedy_select(gram(pred, candidates, key), candidates, n_rounds, metric, drop_non_improving)
    wd = _aligned(pred, candidates, key).persist()  # read once a round; released below
    try:
        counts, current = _forward(_scan_losses(wd, candidates, metric), len(candidates), n_rounds, drop_non_improving)
    finally:
        wd.unpersist()
    total = float(sum(counts))
    return {c: counts[i] / total for i, c in enumerate(candidates)}, -current if mt.greater_is_better(metric) else current


def _known(metric: str) -> None:
    if metric not in mt.REGRESSION_METRICS + mt.BINARY_METRICS:
        raise ValueError(f"unknown metric '{metric}'")


def filter_correlated(corr: dict, candidates: list[str], threshold: float) -> tuple[list, list]:
    """While the largest signed pairwise correlation exceeds ``threshold``,
    drop the candidate with the highest mean absolute correlation (diagonal as 0); means that
    agree to nine digits are ties, which the first candidate takes."""
    ids = list(candidates)
    dropped = []
    while len(ids) > 1:
        pairs = [(corr[(a, b)] or 0.0) for a in ids for b in ids if a != b]
        if max(pairs) <= threshold:
            break
        means = [math.floor(sum(abs(corr[(a, b)] or 0.0) for b in ids if b != a) / len(ids) * 1e9 + 0.5) for a in ids]
        k = max(range(len(ids)), key=lambda i: (means[i], -i))
        dropped.append(ids.pop(k))
    return ids, dropped


def poisson_weight(key_col: str, seed: int, bag: int):
    """Poisson(1) row multiplicity from a seeded hash (bootstrap in law, no sampling pass)."""
    u = (F.conv(F.substring(F.sha2(F.concat_ws(":", F.lit(seed), F.lit(bag), F.col(key_col).cast("string")), 256),
                            1, 13), 16, 10).cast("double") / float(16 ** 13))
    expr, cdf, p = None, 0.0, math.exp(-1.0)
    k = 0
    while cdf < 1.0 - 1e-17 and k < 40:
        cdf += p
        cond = u < F.lit(cdf)
        expr = F.when(cond, F.lit(float(k))) if expr is None else expr.when(cond, F.lit(float(k)))
        k += 1
        p = p / k
    return expr.otherwise(F.lit(float(k)))


def bagged_select(pred: DataFrame, candidates: list[str], key: list[str], n_bags: int = 5, n_rounds: int = 50,
                  metric: str = "rmse", seed: int = 42) -> tuple[dict, float]:
    """Average of greedy weights over Poisson-bootstrap bags, scored on all rows.

    For mse / rmse the Gram sums of all bags and of all rows are one aggregate over
    one pivot; other metrics repeat each row of a bag by its weight."""
    _known(metric)
    weights = [poisson_weight(key[0], seed, bag) for bag in range(n_bags)]
    if metric in QUADRATIC:
        *bags, full = residual_grams(pred, candidates, key, [*weights, F.lit(1.0)])
        picked = [greedy_select(st, candidates, n_rounds, metric)[0] for st in bags]
        avg = {c: sum(w[c] for w in picked) / n_bags for c in candidates}
        return avg, _gram_losses(full, metric)([[avg[c] for c in candidates]])[0]
    wd = _aligned(pred, candidates, key).persist()
    try:
        picked = []
        for wt in weights:
            bag = wd.where(wt > 0).withColumn("_copy", F.explode(F.array_repeat(F.lit(0), wt.cast("int"))))
            counts, _ = _forward(_scan_losses(bag, candidates, metric), len(candidates), n_rounds, False)
            picked.append([c / float(sum(counts)) for c in counts])
        mean = [sum(w[i] for w in picked) / n_bags for i in range(len(candidates))]
        loss = _scan_losses(wd, candidates, metric)([mean])[0]
    finally:
        wd.unpersist()
    return dict(zip(candidates, mean)), -loss if mt.greater_is_better(metric) else loss
