"""Artifact sinks and readers with column contracts.

Candidate outputs are tables, written once and read by blends and selection:

* context: the fold table ``(id, row_idx, fold)`` plus a JSON manifest;
* per candidate, under ``candidate_id=<id>`` partitions: fold metrics, OOF
  predictions ``(row_idx, y_true, y_pred, fold)``, test predictions
  ``(<id>, <label>)`` and, for accuracy, the probability sidecar;
* trials, blend summaries and EDA reports.

Readers check the exact column contract and fail with the offending columns,
so a blend never silently aligns the wrong tables. Readers of many candidates
use one partitioned scan with partition pruning on ``candidate_id``.
"""

from __future__ import annotations

import json
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foldwise.functions.scalar import close

# The column contracts of the stored tables.
OOF_COLUMNS = ["row_idx", "y_true", "y_pred", "fold"]
FOLD_COLUMNS = ["row_idx", "fold"]
FOLD_METRIC_COLUMNS = ["fold", "metric_name", "metric_value", "train_rows", "valid_rows"]


def _check_columns(df: DataFrame, expected: list[str], what: str) -> DataFrame:
    if df.columns != expected:
        raise ValueError(f"{what}: expected columns {expected}, found {df.columns}")
    return df


def write_context(folds: DataFrame, manifest: dict, root: str) -> None:
    """Fold table (row_idx, fold) and the context manifest."""
    _check_columns(folds.select(*FOLD_COLUMNS), FOLD_COLUMNS, "folds")
    folds.select(*FOLD_COLUMNS).write.mode("overwrite").parquet(os.path.join(root, "context", "folds"))
    spark = folds.sparkSession
    spark.createDataFrame([(json.dumps(manifest, sort_keys=True),)], "manifest string") \
        .write.mode("overwrite").json(os.path.join(root, "context", "manifest"))


def write_candidate(root: str, candidate_id: str, oof: DataFrame, test: DataFrame,
                    fold_metrics: DataFrame | None = None, probabilities: DataFrame | None = None) -> None:
    """Candidate tables, partitioned by candidate id (overwrite of that partition only)."""
    def put(df, name):
        (df.withColumn("candidate_id", F.lit(candidate_id)).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("candidate_id")
         .parquet(os.path.join(root, name)))
    put(_check_columns(oof.select(*OOF_COLUMNS), OOF_COLUMNS, "oof"), "oof")
    if len(test.columns) != 2:
        raise ValueError(f"test predictions must have exactly [id, label], found {test.columns}")
    put(test, "test_predictions")
    if fold_metrics is not None:
        put(_check_columns(fold_metrics.select(*FOLD_METRIC_COLUMNS), FOLD_METRIC_COLUMNS, "fold metrics"),
            "fold_metrics")
    if probabilities is not None:
        put(probabilities, "test_probabilities")


def read_oof(spark: SparkSession, root: str, candidates: list[str]) -> DataFrame:
    """OOF tables of several candidates in one scan (partition pruning)."""
    df = spark.read.parquet(os.path.join(root, "oof")).where(F.col("candidate_id").isin(*candidates))
    _check_columns(df.select(*[c for c in df.columns if c != "candidate_id"]), OOF_COLUMNS, "oof")
    return df


def read_test_predictions(spark: SparkSession, root: str, candidates: list[str], id_col: str,
                          label_col: str) -> DataFrame:
    """Test predictions with the [id, label] contract."""
    df = spark.read.parquet(os.path.join(root, "test_predictions")).where(F.col("candidate_id").isin(*candidates))
    _check_columns(df.select(*[c for c in df.columns if c != "candidate_id"]), [id_col, label_col], "test predictions")
    return df


def read_probabilities(spark: SparkSession, root: str, candidates: list[str], id_col: str, label_col: str, contracts: DataFrame) -> DataFrame:
    """The probabilities of an accuracy blend's candidates, [id, label] columns; every candidate must have a table and an ok contract
    (``contracts``: candidate_id, contract)."""
    said = {r["candidate_id"]: r["contract"] for r in contracts.where(F.col("candidate_id").isin(*candidates)).collect()}  # the configured candidates
    bad = {c: said.get(c, "missing_contract") for c in candidates if said.get(c) != "ok"}
    if bad:
        raise ValueError(f"probability blends need candidates with a fitting label contract: {bad}")
    df = spark.read.parquet(os.path.join(root, "test_probabilities")).where(F.col("candidate_id").isin(*candidates))
    _check_columns(df.select(*[c for c in df.columns if c != "candidate_id"]), [id_col, label_col], "test probabilities")
    there = {r["candidate_id"] for r in df.select("candidate_id").distinct().collect()}
    if missing := sorted(set(candidates) - there):
        raise ValueError(f"no test probabilities of {missing}")
    return df


def truth_mismatches(oof: DataFrame, reference: DataFrame, candidates: list[str], key: str = "row_idx") -> DataFrame:
    """Per candidate, rows whose y_true or fold differ from the reference, rows
    that the reference lacks, and reference rows that the candidate lacks.

    The configured candidates (a short list) meet every reference row once; one
    full outer join on (candidate, row) then shows what is absent on either side."""
    ref = reference.select(key, F.col("y_true").alias("ref_y"), F.col("fold").alias("ref_fold"), F.lit(True).alias("_ref"),
                           F.explode(F.array(*[F.lit(c) for c in candidates])).alias("candidate_id"))
    own = oof.where(F.col("candidate_id").isin(*candidates)).withColumn("_own", F.lit(True))
    both = F.col("_ref") & F.col("_own")
    return own.join(ref, [key, "candidate_id"], "full_outer").groupBy("candidate_id").agg(
        F.count_if(both & ~close("y_true", "ref_y")).alias("y_true_mismatches"),
        F.count_if(both & ~F.col("fold").eqNullSafe(F.col("ref_fold"))).alias("fold_mismatches"),
        F.count_if(F.col("_ref").isNull()).alias("unknown_rows"),
        F.count_if(F.col("_own").isNull()).alias("missing_rows"))


def write_history(events: DataFrame, observations: DataFrame, path: str, key: str = "candidate_id") -> None:
    """One JSON document {events: [...], observations: [...]} per candidate
    (a candidate's submission history is small: submissions are rate-limited)."""
    ev = events.groupBy(key).agg(F.collect_list(F.struct(*[c for c in events.columns if c != key])).alias("events"))
    ob = observations.groupBy(key).agg(
        F.collect_list(F.struct(*[c for c in observations.columns if c != key])).alias("observations"))
    doc = ev.join(ob, key, "full_outer")
    doc.select(F.col(key), F.to_json(F.struct("events", "observations")).alias("history")) \
        .write.mode("overwrite").json(path)


def read_history(spark: SparkSession, path: str, event_schema, observation_schema, key: str = "candidate_id"):
    """Parse the history documents back into the events and observations tables."""
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("events", T.ArrayType(event_schema)),
                           T.StructField("observations", T.ArrayType(observation_schema))])
    doc = spark.read.json(path).select(key, F.from_json("history", schema).alias("d"))
    return (doc.select(key, F.explode("d.events").alias("e")).select(key, "e.*"),
            doc.select(key, F.explode("d.observations").alias("o")).select(key, "o.*"))


def write_report(df: DataFrame, root: str, name: str) -> None:
    """One report table, overwritten (single CSV file: reports are small)."""
    df.coalesce(1).write.mode("overwrite").option("header", "true").csv(os.path.join(root, name))
