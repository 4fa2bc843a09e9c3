"""Cross-validation metrics (A11-A18), computed per (candidate, fold) in one pass.

The input is a long prediction table ``(candidate_id, fold, y_true, y_pred)``.
Regression metrics and log loss / accuracy are plain grouped aggregates. ROC
AUC is the tie-aware rank statistic sum_s pos(s) * (neg_below(s) + neg(s)/2) /
(P * N): predictions are first collapsed to (group, score) counts, then the
negatives below each score come from range-partitioned conditional ranks, so
no window ever holds a whole fold.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foldwise.functions.scalar import ACCURACY_THRESHOLD, PROBABILITY_EPSILON
from foldwise.operators.stats import conditional_ranks

# Long metric names as given by users -> metric id (ids are names too), and direction.
METRIC_NAMES = {
    "root mean squared error": "rmse",
    "mean squared error": "mse",
    "root mean squared logarithmic error": "rmsle",
    "mean absolute error": "mae",
    "area under the roc curve": "roc_auc",
    "roc auc score": "roc_auc",
    "log loss": "log_loss",
    "accuracy": "accuracy",
}
REGRESSION_METRICS = ("rmse", "mse", "mae", "rmsle")
BINARY_METRICS = ("roc_auc", "log_loss", "accuracy")
HIGHER_IS_BETTER = {"roc_auc", "accuracy"}


def normalize_metric(name: str, task: str) -> str:
    """Canonical metric id valid for the task."""
    given = name.strip().lower()
    given = given if given in REGRESSION_METRICS + BINARY_METRICS else given.replace("_", " ")
    m = given if given in REGRESSION_METRICS + BINARY_METRICS else METRIC_NAMES.get(given)
    if m is None:
        raise ValueError(f"unknown metric '{name}'")
    allowed = REGRESSION_METRICS if task == "regression" else BINARY_METRICS
    if m not in allowed:
        raise ValueError(f"metric '{m}' is not valid for task '{task}'")
    return m


def greater_is_better(metric: str) -> bool:
    return metric in HIGHER_IS_BETTER


def _expr(metric: str, y: Column, p: Column) -> Column:
    if metric == "mse":
        return F.avg((y - p) * (y - p))
    if metric == "rmse":
        return F.sqrt(F.avg((y - p) * (y - p)))
    if metric == "mae":
        return F.avg(F.abs(y - p))
    if metric == "rmsle":
        d = F.log1p(y) - F.log1p(F.greatest(p, F.lit(0.0)))
        return F.sqrt(F.avg(d * d))
    if metric == "log_loss":
        q = F.least(F.greatest(p, F.lit(PROBABILITY_EPSILON)), F.lit(1.0 - PROBABILITY_EPSILON))
        return -F.avg(y * F.log(q) + (F.lit(1.0) - y) * F.log(F.lit(1.0) - q))
    if metric == "accuracy":
        return F.avg(((p >= F.lit(ACCURACY_THRESHOLD)) == (y == F.lit(1.0))).cast("double"))
    raise ValueError(metric)


def fold_metrics(pred: DataFrame, metric: str, group_cols=("candidate_id", "fold"),
                 y_col: str = "y_true", p_col: str = "y_pred", decimals: int | None = None) -> DataFrame:
    """(group..., metric_name, metric_value, valid_rows).

    ``decimals``: labels and predictions have that many decimals; mae then adds up exact numbers, and the order
    in which tasks finish can't move its last digit."""
    group_cols = list(group_cols)
    y, p = F.col(y_col).cast("double"), F.col(p_col).cast("double")
    if metric == "roc_auc":
        return roc_auc(pred, group_cols, y_col, p_col)
    value = _expr(metric, y, p)
    if metric == "mae" and decimals is not None:
        value = F.sum(F.abs(y - p).cast(f"decimal(28,{decimals})")).cast("double") / F.count(F.abs(y - p))
    return pred.groupBy(*group_cols).agg(
        F.lit(metric).alias("metric_name"), value.alias("metric_value"),
        F.count(F.lit(1)).alias("valid_rows"))


def roc_auc(pred: DataFrame, group_cols: list, y_col: str = "y_true", p_col: str = "y_pred") -> DataFrame:
    """Exact tie-aware ROC AUC per group; NULL when a group lacks a class."""
    y = F.col(y_col).cast("double")
    by_score = pred.groupBy(*group_cols, F.col(p_col).cast("double").alias("score")).agg(
        F.sum(y).alias("pos"), F.sum(F.lit(1.0) - y).alias("neg"))
    keyed = by_score.withColumn("_g", F.to_json(F.struct(*group_cols)))
    ranked = conditional_ranks(keyed, "_g", "score", ["neg"])
    return ranked.groupBy(*group_cols).agg(
        F.lit("roc_auc").alias("metric_name"),
        F.try_divide(F.sum(F.col("pos") * (F.col("rank_neg") + F.col("neg") / 2.0)),
                     F.sum("pos") * F.sum("neg")).alias("metric_value"),
        F.sum(F.col("pos") + F.col("neg")).cast("bigint").alias("valid_rows"))


def with_train_rows(fm: DataFrame, group_cols=("candidate_id",), fold_col: str = "fold") -> DataFrame:
    """train_rows of a fold = rows of the other folds of the same candidate."""
    from pyspark.sql import Window
    w = Window.partitionBy(*group_cols)
    return fm.withColumn("train_rows", (F.sum("valid_rows").over(w) - F.col("valid_rows")).cast("bigint"))


def cv_summary(fm: DataFrame, group_cols=("candidate_id", "metric_name")) -> DataFrame:
    """Unweighted mean and population std of the fold metrics."""
    return fm.groupBy(*group_cols).agg(F.avg("metric_value").alias("cv_mean"),
                                       F.stddev_pop("metric_value").alias("cv_std"),
                                       F.count(F.lit(1)).cast("bigint").alias("n_folds"))
