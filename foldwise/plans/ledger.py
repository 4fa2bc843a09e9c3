"""Run ledger.

Runs are rows of a ``runs`` table (tags and params as columns, metrics as a
value column) plus a ``run_artifacts`` table of logged paths. Lookups are
filters that Catalyst pushes into the parquet scan; the canonical-run rule is
an anti join against the required-paths table, then one grouped count.
"""

from __future__ import annotations

import itertools
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Run kinds, active statuses and the artifact paths a complete
# candidate bundle must hold.
RUN_KINDS = ("screening", "canonical", "submission", "optimization_trial")
ACTIVE_STATUSES = ("RUNNING", "SCHEDULED")
REQUIRED_ARTIFACT_PATHS = (
    "logs/runtime.log",
    "config/runtime_config.json",
    "context/competition.json",
    "context/folds.csv",
    "candidate/candidate.json",
    "candidate/fold_metrics.csv",
    "candidate/oof_predictions.csv",
    "candidate/test_predictions.csv",
)


def search_runs(runs: DataFrame, **equals) -> DataFrame:
    """Equality filters on tags (pushed down to the scan)."""
    out = runs
    for k, v in equals.items():
        out = out.where(F.col(k) == F.lit(v))
    return out


def incomplete_runs(runs: DataFrame, artifacts: DataFrame) -> DataFrame:
    """Runs missing at least one required artifact path. The listing is dealt by run before it is counted: a few large
    files would else be counted by as many tasks, each with all of its runs in one hash table."""
    flag = F.lit(0)
    for at, path in enumerate(REQUIRED_ARTIFACT_PATHS):
        flag = F.when(F.col("path") == path, F.lit(1 << at)).otherwise(flag)
    present = (artifacts.where(F.col("path").isin(*REQUIRED_ARTIFACT_PATHS)).select("run_id", flag.alias("flag")).repartition("run_id")
               .groupBy("run_id").agg(F.bit_count(F.bit_or("flag")).alias("n_present")))
    return (runs.select("run_id").join(present, "run_id", "left")
            .where(F.coalesce(F.col("n_present"), F.lit(0)) < len(REQUIRED_ARTIFACT_PATHS))
            .select("run_id"))


def read_manifests(manifests: DataFrame) -> DataFrame:
    """Manifests (run_id, text) as VARIANT: ``manifest`` is null where the text is no JSON object; candidate_id and n_splits are its typed fields, null where absent or of another kind."""
    v = F.try_parse_json("text")
    parsed = manifests.select("run_id", F.when(F.schema_of_variant(v).startswith("OBJECT"), v).alias("manifest"))
    return parsed.select("run_id", "manifest", F.try_variant_get("manifest", "$.candidate_id", "string").alias("candidate_id"), F.try_variant_get("manifest", "$.cv.n_splits", "int").alias("n_splits"))


def canonical_runs(runs: DataFrame, artifacts: DataFrame, manifests: DataFrame | None = None) -> DataFrame:
    """Canonical-kind, FINISHED runs with every required artifact; with ``manifests`` (run_id, text) also
    with one readable manifest that names the run's candidate, and its ``n_splits``."""
    bad = incomplete_runs(runs.where(F.col("run_kind") == "canonical"), artifacts)
    good = (runs.where((F.col("run_kind") == "canonical") & (F.col("status") == "FINISHED"))
            .join(bad, "run_id", "left_anti"))
    if manifests is None:
        return good
    read = read_manifests(manifests).where("manifest is not null").select("run_id", "candidate_id", "n_splits").repartition("run_id")
    once = read.groupBy("run_id").agg(F.count(F.lit(1)).alias("_n"), F.min("candidate_id").alias("candidate_id"), F.min("n_splits").alias("n_splits")).where("_n = 1").drop("_n")
    return good.join(once, ["run_id", "candidate_id"])


def canonical_lookup(runs: DataFrame, artifacts: DataFrame) -> DataFrame:
    """Per candidate, 0 -> missing, 1 -> ok (with its run id), >1 -> ambiguous;
    ``active`` counts RUNNING / SCHEDULED canonical runs (a new one would be refused)."""
    can = canonical_runs(runs, artifacts)
    per = can.groupBy("candidate_id").agg(F.count(F.lit(1)).alias("n_canonical"), F.min("run_id").alias("run_id"))
    active = (runs.where((F.col("run_kind") == "canonical") & F.col("status").isin(*ACTIVE_STATUSES))
              .groupBy("candidate_id").agg(F.count(F.lit(1)).alias("n_active")))
    cands = runs.select("candidate_id").distinct()
    out = cands.join(per, "candidate_id", "left").join(active, "candidate_id", "left")
    n = F.coalesce(F.col("n_canonical"), F.lit(0))
    return out.select(
        "candidate_id", n.cast("bigint").alias("n_canonical"),
        F.coalesce(F.col("n_active"), F.lit(0)).cast("bigint").alias("n_active"),
        F.when(n == 0, "missing").when(n == 1, "ok").otherwise("ambiguous").alias("lookup_status"),
        F.when(n == 1, F.col("run_id")).alias("run_id"))


def cv_config_filter(runs: DataFrame, n_splits: int, shuffle: bool, seed: int) -> DataFrame:
    """Runs whose CV params equal the given ones (compared as text)."""
    return runs.where((F.col("cv_n_splits") == str(n_splits)) & (F.col("cv_shuffle") == str(shuffle).lower())
                      & (F.col("cv_random_state") == str(seed)))


def status_counts(runs: DataFrame) -> DataFrame:
    """Runs by status."""
    return runs.groupBy("status").agg(F.count(F.lit(1)).alias("n_runs"))


def audit(runs: DataFrame, a: str, b: str) -> DataFrame:
    """Counts by two tags, with finished / failed splits."""
    return runs.groupBy(a, b).agg(
        F.count(F.lit(1)).alias("n_runs"),
        F.count_if(F.col("status") == "FINISHED").alias("n_finished"),
        F.count_if(F.col("status") == "FAILED").alias("n_failed"))


def variant_compare(runs: DataFrame, keys: list[str], variant_col: str, a: str, b: str,
                    metric_col: str = "metric_value", higher_is_better: bool = False) -> DataFrame:
    """Per key, best finished metric (by the metric's direction) of variant a and of b, and
    the delta (conditional aggregation instead of a self join)."""
    fin = runs.where(F.col("status") == "FINISHED")
    best = F.max if higher_is_better else F.min
    out = fin.groupBy(*keys).agg(
        best(F.when(F.col(variant_col) == a, F.col(metric_col))).alias(f"best_{a}"),
        best(F.when(F.col(variant_col) == b, F.col(metric_col))).alias(f"best_{b}"),
        F.count_if(F.col(variant_col) == a).alias(f"n_{a}"),
        F.count_if(F.col(variant_col) == b).alias(f"n_{b}"))
    return out.withColumn("delta", F.col(f"best_{b}") - F.col(f"best_{a}"))


def trial_parents(runs: DataFrame) -> DataFrame:
    """Optimization trials with their parent run."""
    trials = runs.where(F.col("run_kind") == "optimization_trial").select(
        F.col("run_id").alias("trial_run_id"), "parent_run_id", F.col("metric_value").alias("trial_metric"))
    parents = runs.select(F.col("run_id").alias("parent_run_id"), F.col("candidate_id").alias("parent_candidate_id"),
                          F.col("run_kind").alias("parent_kind"))
    return trials.join(parents, "parent_run_id", "inner")


def optimization_summary(trials: DataFrame, higher_is_better: bool) -> DataFrame:
    """Per parent: completed trials and the best one (ties -> smaller trial id)."""
    done = trials.where(F.col("status") == "FINISHED")
    key = F.struct((F.col("metric_value") if higher_is_better else -F.col("metric_value")).alias("m"),
                   (-F.col("trial_number")).alias("t"))
    return done.groupBy("parent_run_id").agg(
        F.count(F.lit(1)).alias("completed_trials"),
        F.max_by("trial_number", key).alias("best_trial_number"),
        F.max_by("metric_value", key).alias("best_metric_value"))


LEDGER_TABLES = ("runs", "run_params", "run_metrics", "run_artifacts")


def write_runs(root: str, runs: DataFrame, params: list[str], metrics: list[str], artifacts: DataFrame) -> None:
    """Append finished or failed runs to the ledger's four tables under root: ``runs`` (id and tags),
    ``run_params`` (run_id, key, JSON value), ``run_metrics`` (run_id, key, value) and ``run_artifacts``
    (run_id, path). params and metrics name columns of runs; NULLs are not logged. The run rows are
    written last, so a reader never meets a run whose tables are incomplete."""
    def pairs(names, value, kind):
        entries = F.array(*[F.struct(F.lit(c).alias("key"), value(F.col(c)).cast(kind).alias("value")) for c in names])
        return runs.select("run_id", F.inline(entries)).where(F.col("value").isNotNull())
    pairs(params, lambda c: F.when(c.isNotNull(), F.regexp_extract(F.to_json(F.struct(c.alias("v"))), r"^\{\"v\":(.*)\}$", 1)), "string").write.mode("append").parquet(f"{root}/run_params")
    pairs(metrics, lambda c: c, "double").write.mode("append").parquet(f"{root}/run_metrics")
    artifacts.select("run_id", "path").write.mode("append").parquet(f"{root}/run_artifacts")
    runs.drop(*params, *metrics).write.mode("append").parquet(f"{root}/runs")


def read_ledger(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    return {t: spark.read.parquet(f"{root}/{t}") for t in LEDGER_TABLES}


def submission_message(candidate_id: str, event_id: str, metric: str, value: float, prefix: str | None = None) -> str:
    """The tagged description that a refresh parses back."""
    parts = [prefix.strip()] if prefix else []
    return " | ".join([*parts, f"candidate={candidate_id}", f"submit={event_id}", f"{metric}={value:.6f}"])


def sweep_grid(recipes: list[str], families: list[str], options: list[dict]) -> list[tuple]:
    """Planned candidates -- a plan-time product of configuration lists."""
    return [(r, f, json.dumps(o, sort_keys=True)) for r, f, o in itertools.product(recipes, families, options)]
