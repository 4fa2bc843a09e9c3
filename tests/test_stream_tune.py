"""Keyed stream state over landings and a restart, searches that stop in time, damaged input."""

import json
import time

import pytest
from pyspark.sql import functions as F

from foldwise.plans import ledger as ld
from foldwise.plans import models as md
from foldwise.plans import tune as tn
from foldwise.sources import tables as src
from foldwise.streaming import refresh as rf


def line(event, submitted, public, private="0.5", candidate="c1", name="f.csv"):
    tag = f"candidate={candidate} | " if candidate else ""
    return {"kaggle_submitted_at": submitted, "kaggle_file_name": name, "kaggle_description": f"{tag}submit={event}", "kaggle_status": "complete", "public_score": public, "private_score": private}


def land(folder, name, lines):
    folder.mkdir(exist_ok=True)
    (folder / f"{name}.json").write_text("\n".join(json.dumps(x) for x in lines))


def test_keyed_state_over_two_landings_and_a_restart(spark, tmp_path):
    events = spark.createDataFrame([("e1", "c1"), ("e2", "c1"), ("e3", "c9")], "submission_event_id string, candidate_id string")
    canon = spark.createDataFrame([("c1",), ("c2",)], "candidate_id string")
    stored = [("e1", "2024-01-01", "f.csv", "complete", 0.9, 0.5, "candidate=c1 | submit=e1", None, 0)]
    spark.createDataFrame(stored, rf.observation_schema()).write.parquet(str(tmp_path / "history"))
    landed, out = tmp_path / "landed", str(tmp_path / "out")

    def run():
        return rf.run_keyed_stream(spark, str(landed), out, str(tmp_path / "ck"), events, canon, str(tmp_path / "history"))

    land(landed, "one", [line("e1", "2024-01-01", "0.9"), line("e1", "2024-01-02", "0.8"), line("e1", "2024-01-02", "0.8"), line("e2", "2024-01-01", "", "None"),
                         line("e3", "2024-01-01", "0.1"), line("e7", "2024-01-03", "0.3", candidate="c2"), line("e8", "2024-01-03", "0.3", candidate=None), line("e1", "2024-01-05", "n/a")])
    first = run()
    assert sum(n for p in first for s, n in p["rows"].items() if "history" in s) == 1
    land(landed, "two", [line("e1", "2024-01-02", "0.8"), line("e1", "2024-01-04", "0.85", ""), line("e2", "2024-01-02", "0.7")])
    second = run()
    assert sum(n for p in second for s, n in p["rows"].items() if "history" in s) == 0  # no stored row is read again
    assert sum(n for p in second for s, n in p["rows"].items() if "landed" in s) >= 3
    obs = spark.read.parquet(f"{out}/observations")
    got = sorted((r.submission_event_id, r.kaggle_submitted_at, r.public_score, r.candidate_id) for r in obs.collect())
    assert got == [("e1", "2024-01-02", 0.8, "c1"), ("e1", "2024-01-04", 0.85, "c1"), ("e2", "2024-01-01", None, "c1"), ("e2", "2024-01-02", 0.7, "c1"), ("e7", "2024-01-03", 0.3, "c2")]
    # the same as the batch refresh over everything that landed
    remote = spark.read.schema(rf.REMOTE_SCHEMA).json(str(landed))
    parsed = rf.parse_remote(remote.where("coalesce(public_score, '') <> 'n/a'"))
    batch = rf.new_observations(rf.candidate_observations(parsed, events, canon), spark.read.parquet(str(tmp_path / "history")))
    assert sorted(map(str, batch.select(*rf.SIGNATURE, "candidate_id").collect())) == sorted(map(str, obs.select(*rf.SIGNATURE, "candidate_id").collect()))
    roll = {r.submission_event_id: r for r in rf.current_rollup(spark, f"{out}/rollup").collect()}
    e1 = roll["e1"]
    assert (e1.n_observations, e1.latest_public_score, e1.latest_private_score, e1.best_public_score) == (3, 0.85, 0.5, 0.8)
    assert (roll["e2"].n_observations, roll["e2"].latest_public_score) == (2, 0.7)
    assert [(r.submission_event_id, r.candidate_id) for r in spark.read.parquet(f"{out}/events").collect()] == [("e7", "c2")]
    bad = spark.read.parquet(f"{out}/quarantine").collect()
    assert len(bad) == 1 and "public_score=n/a" in bad[0].kaggle_description
    run()
    assert spark.read.parquet(f"{out}/observations").count() == 5


def test_a_slow_trial_ends_with_the_time(spark):
    from pyspark.ml.feature import VectorAssembler
    df = spark.createDataFrame([(i, i % 2 + 1, float(i % 3), float(i)) for i in range(40)], "id long, fold int, y double, x double")
    rows = df.withColumn("fit_fold", F.explode(F.sequence(F.lit(1), F.lit(2)))).withColumn("role", F.when(F.col("fold") == F.col("fit_fold"), "valid").otherwise("train"))

    def slow(train, rows, p):
        """Starts jobs in a loop, each of which would take a minute."""
        def wait(batches):
            for b in batches:
                time.sleep(60)
                yield b
        for _ in range(50):
            try:
                train.select("id").mapInPandas(wait, "id long").count()
            except Exception:  # noqa: BLE001 - goes on in spite of a cancelled job
                if _ >= 2:
                    raise
        return rows.withColumn("y_pred", F.lit(0.0))

    def quick(train, rows, p):
        return rows.withColumn("y_pred", F.lit(float(p["c"])))

    kind = {"params": frozenset({"c"})}
    families = md.ModelFamily("slow", "regression", scores=slow, **kind), md.ModelFamily("quick", "regression", scores=quick, **kind)
    space = {"c": ("float", 0.0, 1.0)}
    began = time.time()
    trials = tn.tune(rows, ["x"], "y", families[0], 2, "rmse", n_trials=3, timeout=6, parallel=2, space=space).orderBy("trial_number").collect()
    assert time.time() - began < 40
    assert [t.state for t in trials] == ["STOPPED", "STOPPED", "PRUNED"] and "6" in trials[0].error
    for _ in range(50):
        if not spark.sparkContext.statusTracker().getActiveJobsIds():
            break
        time.sleep(0.2)
    assert not spark.sparkContext.statusTracker().getActiveJobsIds()
    assert spark.sparkContext.getLocalProperty("spark.jobGroup.id") is None
    done = tn.tune(rows, ["x"], "y", families[1], 2, "rmse", n_trials=2, timeout=300, space=space).collect()
    assert [t.state for t in done] == ["COMPLETE", "COMPLETE"]


def test_kept_and_quarantined_lines_are_the_file(spark, tmp_path):
    lines = ['{"a": 1, "b": "x"}', '{"a": "one", "b": "y"}', '{"a": 3', "7", '{"b": null}', '{"a": 5, "b": "z", "c": 9}']
    (tmp_path / "rows.json").write_text("\n".join(lines))
    from pyspark.sql.types import IntegerType, StringType, StructField, StructType
    kind = StructType([StructField("a", IntegerType()), StructField("b", StringType())])
    kept, bad = src.read_checked(spark, str(tmp_path / "rows.json"), kind)
    assert sorted(map(str, kept.collect())) == sorted(["Row(a=1, b='x')", "Row(a=None, b=None)", "Row(a=5, b='z')"])
    assert sorted(r.line for r in bad.collect()) == sorted([lines[1], lines[2], lines[3]])
    (tmp_path / "rows.csv").write_text("a,b\n1,x\ntwo,y\n3\n4,z\n")
    kept, bad = src.read_checked(spark, str(tmp_path / "rows.csv"), kind, "csv")
    assert sorted(r.a for r in kept.collect()) == [1, 4] and sorted(r.line for r in bad.collect()) == ["3", "two,y"]


def test_unreadable_manifests_are_not_canonical(spark):
    runs = spark.createDataFrame([(f"r{i}", "c1", "canonical", "FINISHED") for i in range(7)], "run_id string, candidate_id string, run_kind string, status string")
    arts = spark.createDataFrame([(f"r{i}", p) for i in range(7) for p in ld.REQUIRED_ARTIFACT_PATHS], "run_id string, path string")
    good = '{"candidate_id": "c1", "cv": {"n_splits": 5}}'
    texts = [("r0", good), ("r1", good[:20]), ("r2", f"[{good}]"), ("r3", good.replace("c1", "c2")), ("r4", good.replace("5", '"x"')), ("r5", good), ("r5", good)]
    found = ld.canonical_runs(runs, arts, spark.createDataFrame(texts, "run_id string, text string"))
    assert sorted((r.run_id, r.n_splits) for r in found.collect()) == [("r0", 5), ("r4", None)]
    assert ld.canonical_runs(runs, arts).count() == 7
