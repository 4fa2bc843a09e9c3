"""Cases that the fixtures lacked: typed labels, nulls, NaN, missing rows, repeated polls, wide vocabularies, parameters."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foldwise.operators import stats as st
from foldwise.operators.representation import Representation
from foldwise.plans import blend as bl
from foldwise.plans import contracts as ct
from foldwise.plans import evaluate as ev
from foldwise.plans import ledger as ld
from foldwise.plans import metrics as mt
from foldwise.plans import models as md
from foldwise.plans import profile as pf
from foldwise.sources import artifacts as art
from foldwise.streaming import refresh as rf

PRED = "candidate_id string, row_idx long, fold int, y_true double, y_pred double"


def test_positive_label_by_column_type():
    assert pf.positive_label([True, False], T.BooleanType()) is True
    assert pf.positive_label([1, 0], T.IntegerType()) == 1
    assert pf.positive_label([7, 3], T.LongType(), configured=3) == 3
    for pair, kind in (([0.0, 1.0], T.DoubleType()), (["0", "1"], T.StringType()), ([1, 2], T.LongType())):
        with pytest.raises(ValueError):
            pf.positive_label(pair, kind)
    with pytest.raises(ValueError):
        pf.positive_label([0, 1], T.LongType(), configured=True)


@pytest.mark.parametrize("kind,values,labels,bad", [
    ("boolean", [True, False, None], (True, False), 0), ("double", [0.0, 1.0, 2.0], (0.0, 1.0), 1),
    ("double", [0.5, float("inf"), float("nan")], (0, 1), 3), ("string", ["Yes", "no"], ("Yes", "No"), 1)])
def test_label_contract_normalises_both_sides(spark, kind, values, labels, bad):
    pred = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"id long, y {kind}")
    got = {r["check"]: r["violations"] for r in ct.submission_violations(pred, pred, "id", "y", "label", labels).collect()}
    assert got["unknown_labels"] == bad


def test_metric_long_names():
    assert mt.normalize_metric("Area under the ROC curve", "binary") == "roc_auc"
    assert mt.normalize_metric("root mean squared logarithmic error", "regression") == "rmsle"
    with pytest.raises(ValueError):
        mt.normalize_metric("binary_crossentropy", "binary")


def _long(spark, P, y):
    return spark.createDataFrame([(f"c{j}", i, 1, float(y[i]), float(P[i, j])) for i in range(len(y)) for j in range(P.shape[1])], PRED)


def _loss(metric, y, p):
    if metric == "mae":
        return np.mean(np.abs(p - y))
    if metric == "rmsle":
        return math.sqrt(np.mean((np.log1p(y) - np.log1p(np.maximum(p, 0))) ** 2))
    if metric == "mse":
        return np.mean((p - y) ** 2)
    if metric == "rmse":
        return math.sqrt(np.mean((p - y) ** 2))
    if metric == "log_loss":
        q = np.clip(p, 2.220446049250313e-16, 1 - 2.220446049250313e-16)
        return -np.mean(y * np.log(q) + (1 - y) * np.log(1 - q))
    if metric == "accuracy":
        return -np.mean((p >= 0.5) == (y == 1))
    pos, neg = p[y == 1], p[y == 0]
    return -np.mean((pos[:, None] > neg[None]) + 0.5 * (pos[:, None] == neg[None]))


@pytest.mark.parametrize("metric", ["rmse", "mse", "mae", "rmsle", "roc_auc", "log_loss", "accuracy"])
def test_selection_optimises_the_given_metric(spark, metric):
    rng = np.random.default_rng(4)
    binary = metric in mt.BINARY_METRICS
    y = (rng.random(120) < 0.4).astype(float) if binary else np.abs(rng.normal(size=120)) * 3 + 1
    noise = np.stack([rng.normal(size=120) * s for s in (0.3, 0.5, 0.4)], 1)
    P = np.clip(0.5 + (y[:, None] - 0.5) * 0.3 + noise * 0.6, 0.01, 0.99) if binary else y[:, None] + noise * 3
    w, score = bl.select_ensemble(_long(spark, P, y), ["c0", "c1", "c2"], ["row_idx"], metric, 6)
    counts = np.eye(3)[int(np.argmin([_loss(metric, y, P[:, j]) for j in range(3)]))]
    now = _loss(metric, y, P @ counts)
    for _ in range(6):
        losses = [_loss(metric, y, P @ (counts + e) / (counts.sum() + 1)) for e in np.eye(3)]
        i = int(np.argmin(losses))
        counts, improves, now = counts + np.eye(3)[i], losses[i] < now, losses[i]
        if not improves:
            break
    assert [w[f"c{j}"] for j in range(3)] == pytest.approx(list(counts / counts.sum()))
    assert score == pytest.approx(-now if mt.greater_is_better(metric) else now, rel=1e-9)
    bags, _ = bl.bagged_select(_long(spark, P, y), ["c0", "c1", "c2"], ["row_idx"], n_bags=2, n_rounds=2, metric=metric)
    assert sum(bags.values()) == pytest.approx(1)


def test_unknown_metric_and_gaps_are_errors(spark):
    df = spark.createDataFrame([("a", 1, 1, 1.0, 1.0), ("b", 1, 1, 1.0, 2.0), ("a", 2, 1, 1.0, 1.0)], PRED)
    with pytest.raises(ValueError):
        bl.select_ensemble(df, ["a", "b"], ["row_idx"], "gini")
    with pytest.raises(Exception, match="same rows"):
        bl.gram(df, ["a", "b"], ["row_idx"])
    with pytest.raises(Exception, match="do not align"):
        bl.blend(df, {"a": 0.5, "b": 0.5}, ["row_idx"]).collect()


def test_alignment_and_truth_see_nulls_and_gaps(spark):
    rows = [("a", 1, 1, None, 1.0), ("b", 1, 1, 5.0, 1.0), ("a", 2, 1, 3.0, 1.0), ("b", 2, 2, 3.0 + 1e-9, 1.0), ("a", 3, 1, 1.0, 0.0)]
    df = spark.createDataFrame(rows, PRED)
    assert tuple(bl.alignment_violations(df, ["row_idx"], ["a", "b"]).first()) == (1, 1, 1)
    ref = spark.createDataFrame([(1, None, 1), (2, 3.0, 1), (4, 1.0, 1)], "row_idx long, y_true double, fold int")
    got = {r["candidate_id"]: tuple(r)[1:] for r in art.truth_mismatches(df, ref, ["a", "b", "c"]).collect()}
    assert got == {"a": (0, 0, 1, 1), "b": (1, 1, 0, 1), "c": (0, 0, 0, 3)}


@pytest.mark.parametrize("shape", ["heavy", "nan", "ties", "wide", "infinite"])
def test_rank_selection_in_a_fixed_number_of_passes(spark, shape, monkeypatch):
    rng = np.random.default_rng(1)
    x = {"heavy": np.exp(40 * rng.normal(size=3000)), "ties": rng.integers(0, 3, 3000).astype(float),
         "nan": np.where(rng.random(3000) < 0.2, np.nan, rng.normal(size=3000)), "infinite": np.where(rng.random(3000) < 0.1, np.inf, rng.normal(size=3000)),
         "wide": rng.choice([-1e300, -1e-300, 0.0, 1e-310, 1.0, 1e308], 3000) * (1 + rng.integers(0, 9, 3000) * 1e-15)}[shape]
    df = spark.createDataFrame([(i % 3 + 1, float(v)) for i, v in enumerate(x)], "fold int, v double")
    long = st.long_numeric(df, ["v"]).persist()
    fold = np.arange(3000) % 3 + 1
    targets = []
    want = {}
    for f in (1, 2, 3):
        rest = np.sort(x[(fold != f) & ~np.isnan(x)])
        for r in (0, 7, len(rest) // 2, len(rest) - 2):
            targets.append(("v", f, r))
            want[("v", f, r)] = rest[r]
    assert st.PASSES <= 8
    found = st.select_ranks(long, targets)
    assert found == want and found.passes <= 1
    monkeypatch.setattr(st, "VALUES", 100)  # as if there were millions: buckets first
    found = st.select_ranks(long, targets)
    assert found == want and found.passes <= 2
    assert st.select_ranks(long, targets, dict(st.fold_summary(long))) == want  # without sketches
    wrong = st.fold_summary(long)
    wrong.grid = {k: [v + 1e-3 for v in q] for k, q in wrong.grid.items()}  # sketches may mislead, not falsify
    assert st.select_ranks(long, targets, wrong) == want
    assert all(v[1] == int(np.isnan(x[fold == k[1]]).sum()) for k, v in st.null_counts(df, ["v"]).items())
    long.unpersist()


def test_families_by_name_and_their_parameters(spark):
    for name in ("hist_gradient_boosting", "lightgbm", "xgboost", "catboost", "random_forest", "knn"):
        for task in ("regression", "binary"):
            assert md.resolve(name, task).task == task
    for name, task in (("svm", "binary"), ("realmlp", "binary"), ("naive_bayes", "binary"), ("logistic_regression", "binary"), ("ridge", "regression"), ("elasticnet", "regression")):
        md.resolve(name, task)
    with pytest.raises(ValueError, match="not built"):
        md.resolve("extra_trees", "binary")
    with pytest.raises(ValueError, match="bogus"):
        md.resolve("logistic_regression", "binary").resolve_params({"bogus": 1})
    with pytest.raises(ValueError):
        md.check_compatibility(md.resolve("ridge", "regression"), "native")
    with pytest.raises(ValueError, match="registered already"):
        md.register(md.ModelFamily("ridge", "regression"))


def _binary(spark, n=240):
    rng = np.random.default_rng(6)
    X = rng.normal(size=(n, 2))
    y = (X[:, 0] + 0.3 * rng.normal(size=n) > 0.9).astype(float)
    rows = [(i, i % 2 + 1, float(y[i]), *map(float, X[i])) for i in range(n)]
    return spark.createDataFrame(rows, "id long, fold int, y double, a double, b double").withColumn("split", F.lit("train")), X, y


def test_balanced_weights_and_margin_link(spark):
    from foldwise.operators.base import one_fit
    df, X, y = _binary(spark)
    run = lambda fam, p: {r["id"]: r["y_pred"] for r in ev.oof(ev.cross_validate(lambda f: one_fit(df, f), ["a", "b"], "y", md.resolve(fam, "binary"), 2, p)).collect()}
    plain, balanced = run("logistic_regression", {}), run("logistic_regression", {"class_weight": "balanced"})
    assert np.mean(list(balanced.values())) > np.mean(list(plain.values())) + 0.05
    svm = run("svm", {})
    p = np.array([svm[i] for i in range(len(y))])
    assert ((p >= 0) & (p <= 1)).all() and abs(p.mean() - y.mean()) < 0.08
    near = run("knn", {"n_neighbors": 3})
    for i in range(0, 240, 17):
        others = np.flatnonzero(np.arange(240) % 2 != i % 2)
        best = others[np.lexsort((others, np.round(((X[others] - X[i]) ** 2).sum(1) ** 0.5, 9)))[:3]]
        assert near[i] == pytest.approx(y[best].mean())


def test_batch_isolates_failures_and_skips(spark):
    from foldwise.operators.base import one_fit
    df, _, _ = _binary(spark, 60)
    cands = [ev.Candidate("done", md.resolve("ridge", "regression"), {}), ev.Candidate("bad", md.resolve("ridge", "regression"), {"nope": 1}),
             ev.Candidate("mismatch", md.resolve("ridge", "regression"), {}, "native"), ev.Candidate("good", md.resolve("ridge", "regression"), {})]
    out, said = ev.run_batch(cands, lambda f: one_fit(df, f), ["a", "b"], "y", 2, "rmse", done=frozenset({"done"}))
    assert [s[:2] for s in said] == [("done", "skipped"), ("bad", "failed"), ("mismatch", "failed"), ("good", "trained")]
    assert {r["candidate_id"] for r in out.select("candidate_id").distinct().collect()} == {"good"}


def test_no_cached_tables_stay(spark):
    from foldwise.operators.base import one_fit
    df, _, _ = _binary(spark, 60)
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    ev.oof(ev.cross_validate(lambda f: one_fit(df, f), ["a", "b"], "y", md.resolve("ridge", "regression"), 2)).collect()
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before


def test_wide_vocabulary_native_and_missing_value(spark):
    n = 6500
    df = spark.createDataFrame([(i, i % 2 + 1, float(i % 7), f"v{i // 2}", None if i % 5 == 0 else f"g{i % 3}", None if i % 4 == 0 else float(i)) for i in range(2 * n)],
                               "id long, fold int, y double, c string, g string, x double").withColumn("split", F.lit("train"))
    rep = Representation([{"id": "rare_category_bucket", "min_frequency": 0.5, "missing_value": "none"}])
    fr = rep.fit(df, [], ["c", "g"], 2, "fold", "y")
    out = fr.transform(df, ["id", "fit_fold", "role", "y"], 1)
    vocab = fr.vocabulary(out)
    assert len(vocab) > 6000 and any(v.endswith("__g_none") for v in vocab) and not any("__missing__" in v for v in vocab)
    vector = fr.materialize(out, vocab).select("features").first()[0]
    assert vector.size == len(vocab) and vector.numNonzeros() == 2
    fr.release()
    native = Representation(["native_numeric", "native_categorical"]).fit(df.drop("c"), ["x"], ["g"], 2, "fold", "y")
    rows = native.materialize(native.transform(df, ["id", "fit_fold", "role", "y"], 2), [])
    attrs = rows.schema["features"].metadata["ml_attr"]["attrs"]
    assert attrs["nominal"][0]["vals"][:4] == ["__missing__", "g0", "g1", "g2"]


def test_refresh_order_duplicates_and_errors(spark):
    obs = [("e1", "t", "f", "complete", s, None, "d", seq) for s, seq in ((0.7, 1), (0.5, 2))]
    cols = ", ".join(f"{c} {'double' if c.endswith('score') else 'string'}" for c in rf.OBSERVATION_COLS) + ", observed_seq int"
    for rows in (obs, obs[::-1]):
        assert rf.score_rollup(spark.createDataFrame(rows, cols), False).first()["latest_public_score"] == 0.5
    events = spark.createDataFrame([("e1", "a"), ("e2", "b")], "submission_event_id string, candidate_id string")
    assert {tuple(r) for r in rf.append_events(events, spark.createDataFrame([("e3", "c"), ("e3", "c")], events.schema)).collect()} == {("e1", "a"), ("e2", "b"), ("e3", "c")}
    with pytest.raises(Exception, match="recorded twice"):
        rf.append_events(events, spark.createDataFrame([("e1", "z")], events.schema)).collect()
    listing = spark.createDataFrame([("t", "f.csv", "submit=e1", "complete", "n/a", "0.5")], rf.REMOTE_SCHEMA)
    assert rf.malformed_scores(listing).count() == 1
    none = spark.createDataFrame([], rf.observation_schema()).select(*rf.SIGNATURE)
    with pytest.raises(Exception, match="malformed score"):
        rf.refresh_batch(listing, events, events.select("candidate_id"), none).collect()


def test_stream_over_two_landings(spark, tmp_path):
    events = spark.createDataFrame([("e1", "a")], "submission_event_id string, candidate_id string")
    src, target, ck = (str(tmp_path / n) for n in ("in", "out", "ck"))
    for score in ("0.7", "0.5"):
        spark.createDataFrame([("t", "f.csv", "submit=e1", "complete", score, "")], rf.REMOTE_SCHEMA).write.mode("append").json(src)
        out = rf.run_stream(spark, src, target, ck, events, events.select("candidate_id"))
    rows = out.collect()
    assert len(rows) == 2 and len({r["observed_seq"] for r in rows}) == 2
    assert rf.score_rollup(out, False).first()["latest_public_score"] == 0.5


def test_message_round_trip(spark):
    said = ld.submission_message("cand_1", "sub_9", "rmse", 0.25, " first ")
    assert said == "first | candidate=cand_1 | submit=sub_9 | rmse=0.250000"
    row = rf.parse_remote(spark.createDataFrame([("t", "f", said, "complete", "1", None)], rf.REMOTE_SCHEMA)).first()
    assert (row["submission_event_id"], row["remote_candidate_id"], row["public_score"]) == ("sub_9", "cand_1", 1.0)
