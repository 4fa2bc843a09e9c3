import os
import uuid

from pyspark.sql import functions as F

from conftest import SF_SMALL
from foldwise.plans import contracts as ct
from foldwise.plans import ledger as ld
from foldwise.session import checkpoint_dir
from foldwise.sources import fixtures as fx
from foldwise.streaming import refresh as rf


def test_ledger_search_pushes_filters(spark, tmp_path):
    runs = fx.ledger_runs(spark, SF_SMALL)
    path = str(tmp_path / "runs")
    runs.write.parquet(path)
    found = ld.search_runs(spark.read.parquet(path), run_kind="canonical", status="FINISHED")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "run_kind" in plan.split("PushedFilters")[1]


def test_canonical_lookup_states(spark):
    rows = [("r1", "a", "canonical", "FINISHED"), ("r2", "b", "canonical", "FINISHED"),
            ("r3", "b", "canonical", "FINISHED"), ("r4", "c", "canonical", "FAILED"),
            ("r5", "d", "canonical", "FINISHED")]
    runs = spark.createDataFrame(rows, "run_id string, candidate_id string, run_kind string, status string")
    arts = [(r, p) for r in ("r1", "r2", "r3", "r4") for p in ld.REQUIRED_ARTIFACT_PATHS]
    arts += [("r5", p) for p in ld.REQUIRED_ARTIFACT_PATHS[:-1]]          # r5 misses one artifact
    a = spark.createDataFrame(arts, "run_id string, path string")
    got = {r["candidate_id"]: r["lookup_status"] for r in ld.canonical_lookup(runs, a).collect()}
    assert got == {"a": "ok", "b": "ambiguous", "c": "missing", "d": "missing"}


def test_parse_remote_tags_and_scores(spark):
    rows = [("t", "f.csv", "candidate=c1 | submit=sub_1 | metric=0.1", "complete", " NaN ", "0.5"),
            ("t", "g.csv", "submit=sub_2", "complete", "", "None"),
            ("t", "h.csv", "candidate=  | submit=BAD ID", "complete", "1.25", None)]
    df = spark.createDataFrame(rows, rf.REMOTE_SCHEMA)
    got = [r.asDict() for r in rf.parse_remote(df).collect()]
    assert (got[0]["submission_event_id"], got[0]["remote_candidate_id"], got[0]["public_score"],
            got[0]["private_score"]) == ("sub_1", "c1", None, 0.5)
    assert (got[1]["submission_event_id"], got[1]["remote_candidate_id"], got[1]["public_score"]) == ("sub_2", None, None)
    assert got[2]["submission_event_id"] is None and got[2]["remote_candidate_id"] is None


def test_refresh_stream_twice_appends_nothing_new(spark):
    root = checkpoint_dir(spark).rstrip("/") + f"/t-{uuid.uuid4().hex}"
    src, target = f"{root}/landed", f"{root}/obs"
    fx.remote_submissions(spark, SF_SMALL).repartition(2).write.json(src)
    spark.createDataFrame([], rf.observation_schema()).write.parquet(target)
    events = fx.tracked_events(spark, SF_SMALL)
    canon = ld.canonical_lookup(fx.ledger_runs(spark, SF_SMALL), fx.ledger_artifacts(spark, SF_SMALL)) \
        .where(F.col("n_canonical") >= 1).select("candidate_id")
    first = rf.run_stream(spark, src, target, f"{root}/ck1", events, canon, seq=1).count()
    assert first > 0
    second = rf.run_stream(spark, src, target, f"{root}/ck2", events, canon, seq=2)
    assert second.where(F.col("observed_seq") == 2).count() == 0
    assert second.count() == first


def test_submission_contract_hand_tables(spark):
    tmpl = spark.createDataFrame([(1, 0.0), (2, 0.0), (3, 0.0)], "id long, y double")
    same = spark.createDataFrame([(3, 1.0), (2, 2.0), (1, 3.0)], "id long, y double")
    v = {r["check"]: r["violations"] for r in ct.submission_violations(same, tmpl, "id", "y").collect()}
    assert all(x == 0 for x in v.values())
    tmpl_o = spark.createDataFrame([(1, 0), (2, 1), (3, 2)], "id long, row_idx int")
    pred_o = spark.createDataFrame([(3, 0), (2, 1), (1, 2)], "id long, row_idx int")
    assert ct.order_mismatches(pred_o, tmpl_o, "id").collect()[0][0] == 2   # same ids, other order
    bad = spark.createDataFrame([(1, 3.0), (1, 3.0), (4, float("nan"))], "id long, y double")
    v = {r["check"]: r["violations"] for r in ct.submission_violations(bad, tmpl, "id", "y").collect()}
    assert v["duplicate_ids"] == 1 and v["missing_ids"] == 2 and v["unknown_ids"] == 1
    assert v["non_finite_predictions"] == 1


def test_entry_smoke(spark):
    import __spark_entry__ as entry
    df = entry.entry(spark)
    rows = df.collect()
    assert df.columns == ["candidate_id", "metric_name", "cv_mean", "cv_std", "n_folds"]
    assert len(rows) == 3 and all(r["n_folds"] == 5 for r in rows)
    assert set(entry.oracle_sql()) <= set(entry.queries())
