"""Registry of named queries: name -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foldwise.sources import fixtures as fx

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def ctx(spark, sf_dir):
    return fx.context(spark, sf_dir)


def train(spark, sf_dir):
    return ctx(spark, sf_dir).where(F.col("split") == "train")


@query("folds_kfold")
def folds_kfold(spark, sf_dir):
    return train(spark, sf_dir).select("id", "fold")


@query("folds_stratified")
def folds_stratified(spark, sf_dir):
    return train(spark, sf_dir).select("id", "y_bin", F.col("sfold").alias("fold"))


# ---------------------------------------------------------------- numeric operators
from foldwise.functions.scalar import rnd  # noqa: E402
from foldwise.operators import numeric as num  # noqa: E402
from foldwise.operators.base import expand_fits  # noqa: E402
from foldwise.operators.stats import fit_folds_of  # noqa: E402

K = fx.K
_NS_CACHE: dict = {}


def numeric_stats(spark, sf_dir, cols=None, fold_col="fold"):
    cols = tuple(cols or fx.NUMERIC)
    key = (spark.sparkContext.applicationId, sf_dir, cols, fold_col)
    if key not in _NS_CACHE:
        _NS_CACHE[key] = num.NumericStats(train(spark, sf_dir), list(cols), fit_folds_of(K), fold_col)
    return _NS_CACHE[key]


def transformed(spark, sf_dir, fitted, digits=6, keep=("id", "fit_fold", "role"), fold_col="fold"):
    out = fitted.transform(ctx(spark, sf_dir), K, list(keep), fold_col=fold_col)
    vals = [rnd(n, digits).alias(n) if digits is not None else F.col(n) for n in fitted.names()]
    return out.select(*keep, *vals)


@query("standardize_cv")
def standardize_cv(spark, sf_dir):
    return transformed(spark, sf_dir, num.fit_standardize(numeric_stats(spark, sf_dir)))


@query("robust_scale_cv")
def robust_scale_cv(spark, sf_dir):
    return transformed(spark, sf_dir, num.fit_robust_scale(numeric_stats(spark, sf_dir)))


@query("signed_log")
def signed_log_q(spark, sf_dir):
    return transformed(spark, sf_dir, num.fit_signed_log(numeric_stats(spark, sf_dir)))


@query("quantile_bin_long")
def quantile_bin_long(spark, sf_dir):
    fitted = num.fit_quantile_bin(numeric_stats(spark, sf_dir))
    return fitted.transform(ctx(spark, sf_dir), K, ["id", "fit_fold", "role"])


@query("row_missing_count")
def row_missing_count(spark, sf_dir):
    fitted = num.fit_row_missing_count(fx.FEATURES)
    return ctx(spark, sf_dir).select("id", "split", *[c.alias(n) for n, c in fitted.columns.items()])


def _pairs(op):
    def run(spark, sf_dir):
        return transformed(spark, sf_dir, num.fit_pairs(numeric_stats(spark, sf_dir), op))
    return run


QUERIES["pair_multiply"] = _pairs("multiply_numeric_pairs")
QUERIES["pair_ratio"] = _pairs("ratio_numeric_pairs")
QUERIES["pair_difference"] = _pairs("difference_numeric_pairs")
QUERIES["pair_sum"] = _pairs("sum_numeric_pairs")


# ---------------------------------------------------------------- categorical operators
from foldwise.operators import categorical as cat  # noqa: E402

_CS_CACHE: dict = {}
RARE_MIN_FREQUENCY = 0.04


def category_stats(spark, sf_dir, cols=None, y_col=None, fold_col="fold"):
    cols = tuple(cols or fx.CATEGORICAL)
    key = (spark.sparkContext.applicationId, sf_dir, cols, y_col, fold_col)
    if key not in _CS_CACHE:
        tr = train(spark, sf_dir)
        _CS_CACHE[key] = cat.CategoryStats(tr, list(cols), K, fold_col, y_col,
                                           card=cat.cardinalities(tr, list(cols)))
    return _CS_CACHE[key]


def release_statistics() -> None:
    """Drop the statistics that queries of a session share."""
    for cache in (_NS_CACHE, _CS_CACHE):
        for stats in cache.values():
            stats.release()
        cache.clear()


def sparse_query(spark, sf_dir, fitted):
    out = fitted.transform(ctx(spark, sf_dir), K, ["id", "fit_fold", "role"])
    return cat.sparse_long(out, fitted.names(), ["id", "fit_fold", "role"])


@query("frequency_encode_cv")
def frequency_encode_cv(spark, sf_dir):
    return transformed(spark, sf_dir, cat.fit_frequency(category_stats(spark, sf_dir)))


@query("target_encode_cv")
def target_encode_cv(spark, sf_dir):
    cs = category_stats(spark, sf_dir, y_col="y_reg")
    return transformed(spark, sf_dir, cat.fit_target(cs, 1.0), digits=1)


@query("ordinal_encode_cv")
def ordinal_encode_cv(spark, sf_dir):
    return transformed(spark, sf_dir, cat.fit_ordinal(category_stats(spark, sf_dir)), digits=None)


@query("onehot_long")
def onehot_long(spark, sf_dir):
    cs = category_stats(spark, sf_dir)
    return sparse_query(spark, sf_dir, cat.fit_onehot(cs, cs.nunique_all(), 16))


@query("rare_bucket_long")
def rare_bucket_long(spark, sf_dir):
    cs = category_stats(spark, sf_dir)
    return sparse_query(spark, sf_dir, cat.fit_rare_bucket(cs, RARE_MIN_FREQUENCY))


# ---------------------------------------------------------------- interactions and pruning
from foldwise.operators import interactions as ix  # noqa: E402
from foldwise.operators import prune as pr  # noqa: E402
from foldwise.operators.base import merge, one_fit  # noqa: E402


def long_query(rows, fitted, digits=6):
    """(id, fit_fold, role, feature, value) of an operator's eligible outputs."""
    out = fitted.transform_long(rows, ["id", "fit_fold", "role"])
    return out.withColumn("value", rnd("value", digits))


@query("cross_cat_long")
def cross_cat_long(spark, sf_dir):
    plan = ix.CrossPlan(category_stats(spark, sf_dir), 10)
    fitted = ix.fit_cross_categoricals(plan)
    out = fitted.transform(plan.prepare(ctx(spark, sf_dir)), K, ["id", "fit_fold", "role"])
    return cat.sparse_long(out, fitted.names(), ["id", "fit_fold", "role"])


@query("frequency_cross_cv")
def frequency_cross_cv(spark, sf_dir):
    plan = ix.CrossPlan(category_stats(spark, sf_dir), 10)
    return long_query(plan.prepare(ctx(spark, sf_dir)), ix.fit_frequency_crosses(plan))


@query("cross_bin_long")
def cross_bin_long(spark, sf_dir):
    fitted = ix.fit_cross_binned(numeric_stats(spark, sf_dir), category_stats(spark, sf_dir), 5, 10)
    return fitted.transform_long(ctx(spark, sf_dir), ["id", "fit_fold", "role"])


@query("group_deviation_cv")
def group_deviation_cv(spark, sf_dir):
    fitted = ix.fit_group_deviation(numeric_stats(spark, sf_dir), category_stats(spark, sf_dir), 20)
    return long_query(ctx(spark, sf_dir), fitted)


@query("high_corr_prune")
def high_corr_prune(spark, sf_dir):
    """F21 on the dense block standardize_numeric + frequency_encode_categoricals."""
    fitted = merge(num.fit_standardize(numeric_stats(spark, sf_dir)),
                   cat.fit_frequency(category_stats(spark, sf_dir)))
    names = fitted.names()
    block = fitted.transform(ctx(spark, sf_dir), K, ["fit_fold", "role"]).where(F.col("role") == "train")
    corr = pr.correlations(block, names)
    dropped = pr.dropped_features(corr, names, list(range(1, K + 1)), 0.98)
    rows = [(f, n, int(n in dropped[f])) for f in range(1, K + 1) for n in names]
    return spark.createDataFrame(rows, "fit_fold int, feature string, dropped int")


# ---------------------------------------------------------------- profiles
from foldwise.plans import metrics as mt  # noqa: E402
from foldwise.plans import profile as pf  # noqa: E402


def eda_tables(spark, sf_dir):
    c = ctx(spark, sf_dir)
    tr = c.where(F.col("split") == "train").select("id", *fx.FEATURES, "y_reg")
    te = c.where(F.col("split") == "test").select("id", *fx.FEATURES)
    return tr, te


@query("column_summary")
def column_summary(spark, sf_dir):
    tr, _ = eda_tables(spark, sf_dir)
    return pf.column_summary(tr).withColumn("null_pct", rnd("null_pct", 9))


@query("missingness")
def missingness(spark, sf_dir):
    tr, te = eda_tables(spark, sf_dir)
    return pf.missingness(tr, te).withColumn("null_pct", rnd("null_pct", 9))


@query("cardinality")
def cardinality_q(spark, sf_dir):
    tr, te = eda_tables(spark, sf_dir)
    return pf.cardinality(tr, te).withColumn("null_pct", rnd("null_pct", 9))


@query("target_summary_numeric")
def target_summary_numeric(spark, sf_dir):
    tr, _ = eda_tables(spark, sf_dir)
    return pf.target_summary_numeric(tr, "y_reg").withColumn("value", rnd("value", 4))


@query("target_summary_categorical")
def target_summary_categorical(spark, sf_dir):
    return pf.target_summary_categorical(train(spark, sf_dir), "y_bin").withColumn("value", rnd("value", 9))


@query("feature_types")
def feature_types(spark, sf_dir):
    tr, _ = eda_tables(spark, sf_dir)
    numeric, categorical = pf.resolve_feature_types(tr, fx.FEATURES, low_cardinality_int_threshold=20)
    rows = [(c, "numeric" if c in numeric else "categorical") for c in fx.FEATURES]
    rows += [(f"__count_{k}", str(v)) for k, v in pf.feature_type_counts(numeric, categorical)]
    return spark.createDataFrame(rows, "column string, feature_type string")


@query("run_summary")
def run_summary(spark, sf_dir):
    tr, te = eda_tables(spark, sf_dir)
    return pf.run_summary(tr, te, len(fx.FEATURES)).withColumn("value", rnd("value", 9))


@query("target_stats_regression")
def target_stats_regression(spark, sf_dir):
    s = pf.target_stats_regression(train(spark, sf_dir), "y_reg")
    return s.select(*[rnd(c, 4).alias(c) for c in s.columns])


@query("target_stats_binary")
def target_stats_binary(spark, sf_dir):
    return pf.target_stats_binary(train(spark, sf_dir), "y_bin").withColumn("prevalence", rnd("prevalence", 9))


# ---------------------------------------------------------------- metrics
def _fold_metric(fixture, metric, digits):
    def run(spark, sf_dir):
        fm = mt.with_train_rows(mt.fold_metrics(fixture(spark, sf_dir), metric, decimals=4))
        return fm.withColumn("metric_value", rnd("metric_value", digits))
    return run


for _m in ("rmse", "mse", "mae", "rmsle"):
    QUERIES[f"metric_{_m}"] = _fold_metric(fx.oof_long, _m, 1 if _m == "mse" else 4)
QUERIES["metric_auc"] = _fold_metric(fx.oof_bin, "roc_auc", 9)
QUERIES["metric_logloss"] = _fold_metric(fx.oof_bin, "log_loss", 9)
QUERIES["metric_accuracy"] = _fold_metric(fx.oof_bin, "accuracy", 9)


@query("cv_summary")
def cv_summary(spark, sf_dir):
    reg = mt.fold_metrics(fx.oof_long(spark, sf_dir), "rmse")
    auc = mt.fold_metrics(fx.oof_bin(spark, sf_dir), "roc_auc")
    s = mt.cv_summary(reg.unionByName(auc))
    return s.select("candidate_id", "metric_name", rnd("cv_mean", 6).alias("cv_mean"),
                    rnd("cv_std", 6).alias("cv_std"), "n_folds")


# ---------------------------------------------------------------- blending and selection
from foldwise.plans import blend as bl  # noqa: E402
from foldwise.plans import contracts as ct  # noqa: E402

REG_CANDS = ["cand_a", "cand_b", "cand_c", "cand_d", "cand_e"]


@query("blend_weighted")
def blend_weighted(spark, sf_dir):
    w = bl.normalize_weights(["cand_a", "cand_b", "cand_c"], [2.0, 1.0, 1.0])
    b = bl.blend(fx.oof_long(spark, sf_dir), w, ["row_idx"], carry=["id", "y_true", "fold"])
    return b.withColumn("y_pred", rnd("y_pred", 6))


@query("blend_labels")
def blend_labels(spark, sf_dir):
    w = bl.normalize_weights(["bin_a", "bin_b"])
    b = bl.finalize(bl.blend(fx.oof_bin(spark, sf_dir), w, ["row_idx"], carry=["id"]), "accuracy")
    return b.select("row_idx", "id", "label", rnd("probability", 9).alias("probability"))


@query("blend_alignment")
def blend_alignment(spark, sf_dir):
    return bl.alignment_violations(fx.oof_defects(spark, sf_dir), ["row_idx"], REG_CANDS)


@query("oof_correlation")
def oof_correlation(spark, sf_dir):
    corr = bl.correlation_matrix(fx.oof_long(spark, sf_dir), REG_CANDS, ["row_idx"])
    rows = [(a, b, corr[(a, b)]) for i, a in enumerate(REG_CANDS) for b in REG_CANDS[i + 1:]]
    df = spark.createDataFrame(rows, "candidate_a string, candidate_b string, corr double")
    return df.withColumn("corr", rnd("corr", 9))


@query("greedy_ensemble")
def greedy_ensemble(spark, sf_dir):
    """B5 + B6: correlated candidates dropped, then forward selection."""
    pred = fx.oof_long(spark, sf_dir)
    corr = bl.correlation_matrix(pred, REG_CANDS, ["row_idx"])
    kept, _ = bl.filter_correlated(corr, REG_CANDS, 0.999999)
    w, score = bl.select_ensemble(pred, kept, ["row_idx"], "rmse", 50)
    return _weights_table(spark, {c: v for c, v in w.items() if v > 0}, score)


def _weights_table(spark, weights, score):
    rows = spark.createDataFrame([(c, float(v), float(score)) for c, v in weights.items()], "candidate_id string, weight double, score double")
    return rows.select("candidate_id", rnd("weight", 9).alias("weight"), rnd("score", 6).alias("score"))


# ---------------------------------------------------------------- contracts
@query("submission_violations")
def submission_violations(spark, sf_dir):
    pred, tmpl = fx.submission_fixture(spark, sf_dir, "regression")
    return ct.submission_violations(pred, tmpl, "id", "y_reg", "regression")


@query("violation_previews")
def violation_previews(spark, sf_dir):
    """The first ten duplicate, missing and unknown ids of a damaged submission."""
    pred, tmpl = fx.submission_fixture(spark, sf_dir, "regression")
    return ct.violation_previews(pred, tmpl, "id")


@query("probability_contracts")
def probability_contracts(spark, sf_dir):
    """Label contracts of candidates whose probabilities an accuracy blend would read."""
    return ct.probability_contracts(fx.probability_manifests(spark, sf_dir), 1, 0, (0, 1))


@query("probability_violations")
def probability_violations(spark, sf_dir):
    pred, tmpl = fx.submission_fixture(spark, sf_dir, "probability")
    return ct.submission_violations(pred, tmpl, "id", "y_bin", "probability")


@query("label_violations")
def label_violations(spark, sf_dir):
    pred, tmpl = fx.submission_fixture(spark, sf_dir, "label")
    return ct.submission_violations(pred, tmpl, "id", "y_bin", "label", labels=(0, 1))


# ---------------------------------------------------------------- run ledger
import functools  # noqa: E402
import uuid  # noqa: E402

from pyspark.sql import types as T  # noqa: E402

from foldwise.plans import ledger as ld  # noqa: E402
from foldwise.sources import tables as src  # noqa: E402
from foldwise.session import checkpoint_dir, cut_lineage  # noqa: E402
from foldwise.streaming import refresh as rf  # noqa: E402


def _ledger(spark, sf_dir):
    return fx.ledger_runs(spark, sf_dir), fx.ledger_artifacts(spark, sf_dir)


@query("canonical_runs")
def canonical_runs(spark, sf_dir):
    return ld.canonical_lookup(*_ledger(spark, sf_dir))


@query("ledger_search")
def ledger_search(spark, sf_dir):
    runs, _ = _ledger(spark, sf_dir)
    return ld.search_runs(runs, run_kind="canonical", status="FINISHED", family="economy") \
        .select("run_id", "candidate_id", "metric_value")


@query("cv_config_runs")
def cv_config_runs(spark, sf_dir):
    runs, _ = _ledger(spark, sf_dir)
    return ld.cv_config_filter(runs, 5, True, 42).select("run_id", "candidate_id")


@query("ledger_audit")
def ledger_audit(spark, sf_dir):
    runs, _ = _ledger(spark, sf_dir)
    return ld.audit(runs, "family", "run_kind")


@query("status_counts")
def status_counts(spark, sf_dir):
    runs, _ = _ledger(spark, sf_dir)
    return ld.status_counts(runs)


@query("variant_compare")
def variant_compare(spark, sf_dir):
    runs, _ = _ledger(spark, sf_dir)
    out = ld.variant_compare(runs, ["family", "recipe"], "variant", "cpu", "gpu", higher_is_better=True)
    return out.withColumn("delta", rnd("delta", 9))


@query("trial_parents")
def trial_parents(spark, sf_dir):
    runs, _ = _ledger(spark, sf_dir)
    return ld.trial_parents(runs)


@query("optimization_summary")
def optimization_summary(spark, sf_dir):
    runs, _ = _ledger(spark, sf_dir)
    trials = runs.where(F.col("run_kind") == "optimization_trial")
    return ld.optimization_summary(trials, higher_is_better=False)


# ---------------------------------------------------------------- submission refresh
def _refresh_inputs(spark, sf_dir):
    parsed = rf.parse_remote(fx.remote_submissions(spark, sf_dir))
    events = fx.tracked_events(spark, sf_dir)
    canon = ld.canonical_runs(*_ledger(spark, sf_dir)).select("candidate_id").distinct()
    return parsed, events, canon


@query("refresh_match")
def refresh_match(spark, sf_dir):
    parsed, events, _ = _refresh_inputs(spark, sf_dir)
    return rf.match(parsed, events).select("submission_event_id", "kaggle_submitted_at", "kaggle_file_name",
                                           "tracked_candidate_id", "remote_candidate_id", "candidate_mismatch")


@query("refresh_orphans")
def refresh_orphans(spark, sf_dir):
    parsed, events, canon = _refresh_inputs(spark, sf_dir)
    return rf.orphans(parsed, events, canon).select("submission_event_id", "kaggle_file_name",
                                                    "remote_candidate_id", "recovery")


def _appended(spark, sf_dir):
    parsed, events, canon = _refresh_inputs(spark, sf_dir)
    cands = rf.candidate_observations(parsed, events, canon)
    return rf.new_observations(cands, fx.observation_history(spark, sf_dir)), parsed, events, cands


@query("refresh_dedup")
def refresh_dedup(spark, sf_dir):
    new, *_ = _appended(spark, sf_dir)
    return new.select(*rf.OBSERVATION_COLS, "candidate_id")


@query("score_rollup")
def score_rollup(spark, sf_dir):
    new, *_ = _appended(spark, sf_dir)
    hist = fx.observation_history(spark, sf_dir)
    allobs = hist.unionByName(new.select(*rf.OBSERVATION_COLS).withColumn("observed_seq", F.lit(1)))
    return rf.score_rollup(allobs, higher_is_better=False)


@query("refresh_counters")
def refresh_counters(spark, sf_dir):
    new, parsed, events, cands = _appended(spark, sf_dir)
    return rf.refresh_counters(parsed, events, cands, new)


@query("event_id_duplicates")
def event_id_duplicates(spark, sf_dir):
    """J8 on recorded events plus what a second recording of every 50th event would add."""
    _, events, _ = _refresh_inputs(spark, sf_dir)
    again = events.where(F.substring_index("submission_event_id", "_", -1).cast("long") % 50 == 0)
    return rf.duplicate_event_ids(events.unionByName(again)).agg(F.count(F.lit(1)).alias("duplicate_event_ids"))


@query("event_ids")
def event_ids(spark, sf_dir):
    """An id for every event from its time and key."""
    ev = fx.fixture_table(spark, sf_dir, "events")
    return rf.event_ids(ev, "ts", ["event_id", "user_id"]).select("event_id", "submission_event_id")


@query("event_append")
def event_append(spark, sf_dir):
    """Recorded events plus the recovered orphans of the listing."""
    parsed, events, canon = _refresh_inputs(spark, sf_dir)
    recovered = rf.orphans(parsed, events, canon).where(F.col("recovery") == "recovered")
    return rf.append_events(events, recovered)


@query("candidate_scores")
def candidate_scores(spark, sf_dir):
    """A20 per candidate: submission events, latest and best scores over stored and new observations."""
    parsed, events, canon = _refresh_inputs(spark, sf_dir)
    cands = rf.candidate_observations(parsed, events, canon)
    hist = fx.observation_history(spark, sf_dir)
    new = rf.new_observations(cands, hist).select(*rf.OBSERVATION_COLS, "candidate_id").withColumn("observed_seq", F.lit(1))
    allev = rf.append_events(events, rf.orphans(parsed, events, canon).where(F.col("recovery") == "recovered"))
    old = hist.join(allev, "submission_event_id").select(*rf.OBSERVATION_COLS, "candidate_id", "observed_seq")
    return rf.candidate_scores(allev, old.unionByName(new), higher_is_better=False)


@query("malformed_scores")
def malformed_scores(spark, sf_dir):
    """Rows of a listing in which every 31st event's public score reads 'n/a'."""
    remote = fx.remote_submissions(spark, sf_dir)
    event = F.regexp_extract("kaggle_file_name", r"_(\d+)\.csv", 1).cast("long")
    return rf.malformed_scores(remote.withColumn("public_score", F.when(event % 31 == 0, "n/a").otherwise(F.col("public_score"))))


@query("quarantined_rows")
def quarantined_rows(spark, sf_dir):
    """A landed listing whose every 29th line is cut off and every 31st has a number for an object: kept and quarantined lines, per file name."""
    path = checkpoint_dir(spark).rstrip("/") + f"/damaged-{uuid.uuid4().hex}"
    remote = fx.remote_submissions(spark, sf_dir)
    event = F.regexp_extract("kaggle_file_name", r"_(\d+)\.csv", 1).cast("long")
    line = F.to_json(F.struct(*remote.columns))
    remote.select(F.when(event % 29 == 0, F.substring(line, 1, 60)).when(event % 31 == 0, event.cast("string")).otherwise(line).alias("value")).write.text(path)
    kept, bad = src.read_checked(spark, path, rf.REMOTE_SCHEMA, "json")
    a = kept.select(F.lit("kept").alias("part"), F.col("kaggle_file_name").alias("what"))
    return a.unionByName(bad.select(F.lit("quarantined").alias("part"), F.col("line").alias("what"))).groupBy("part", "what").agg(F.count(F.lit(1)).alias("n"))


@query("canonical_manifests")
def canonical_manifests(spark, sf_dir):
    """Canonical runs of which the manifest can be read too, with a typed value out of it."""
    runs, arts = _ledger(spark, sf_dir)
    return ld.canonical_runs(runs, arts, fx.ledger_manifests(spark, sf_dir)).select("run_id", "candidate_id", "n_splits")


@query("refresh_stream")
def refresh_stream(spark, sf_dir):
    """The same refresh as a file-source stream (available-now trigger) into a
    fresh observation table seeded with the stored history; returns the rows the
    stream appended."""
    root = checkpoint_dir(spark).rstrip("/") + f"/refresh-{uuid.uuid4().hex}"
    src, target, ck = f"{root}/landed", f"{root}/observations", f"{root}/_checkpoint"
    remote = fx.remote_submissions(spark, sf_dir)
    remote.repartition(3).write.mode("overwrite").json(src)
    hist = fx.observation_history(spark, sf_dir).withColumn("candidate_id", F.lit(None).cast("string"))
    hist.select(*[f.name for f in rf.observation_schema().fields]).write.mode("overwrite").parquet(target)
    _, events, canon = _refresh_inputs(spark, sf_dir)
    out = rf.run_stream(spark, src, target, ck, events, canon, seq=1, rollup_dir=f"{root}/rollup")
    return out.where(F.col("observed_seq") >= 1).select(*rf.OBSERVATION_COLS, "candidate_id")


@query("stream_rollup")
def stream_rollup(spark, sf_dir):
    """Score rollup kept current by the stream, for the events it touched."""
    root = checkpoint_dir(spark).rstrip("/") + f"/refresh-{uuid.uuid4().hex}"
    src, target, ck, roll = f"{root}/landed", f"{root}/observations", f"{root}/_checkpoint", f"{root}/rollup"
    fx.remote_submissions(spark, sf_dir).repartition(3).write.mode("overwrite").json(src)
    hist = fx.observation_history(spark, sf_dir).withColumn("candidate_id", F.lit(None).cast("string"))
    hist.select(*[f.name for f in rf.observation_schema().fields]).write.mode("overwrite").parquet(target)
    _, events, canon = _refresh_inputs(spark, sf_dir)
    rf.run_stream(spark, src, target, ck, events, canon, seq=1, rollup_dir=roll)
    return rf.current_rollup(spark, roll)


def _keyed_stream(spark, sf_dir):
    """Two landings of the listing, the second by a restarted stream, over state seeded with the stored history."""
    root = checkpoint_dir(spark).rstrip("/") + f"/refresh-{uuid.uuid4().hex}"
    remote = fx.remote_submissions(spark, sf_dir)
    hist = fx.observation_history(spark, sf_dir).withColumn("candidate_id", F.lit(None).cast("string"))
    hist.select(*[f.name for f in rf.observation_schema().fields]).write.parquet(f"{root}/history")
    _, events, canon = _refresh_inputs(spark, sf_dir)
    first = F.crc32(F.col("kaggle_file_name")) % 2 == 0
    for half in (first, ~first):
        remote.where(half).write.mode("append").json(f"{root}/landed")
        rf.run_keyed_stream(spark, f"{root}/landed", f"{root}/out", f"{root}/_checkpoint", events, canon, f"{root}/history")
    return f"{root}/out"


@query("refresh_keyed_stream")
def refresh_keyed_stream(spark, sf_dir):
    """X1 on keyed state: the observations that two landings and a restart appended."""
    return spark.read.parquet(f"{_keyed_stream(spark, sf_dir)}/observations").select(*rf.OBSERVATION_COLS, "candidate_id")


@query("keyed_rollup")
def keyed_rollup(spark, sf_dir):
    """X2 on keyed state: the current rollup of every event that the stream touched."""
    return rf.current_rollup(spark, f"{_keyed_stream(spark, sf_dir)}/rollup")


# ---------------------------------------------------------------- models and cross-validation
from foldwise.operators import knn as kn  # noqa: E402
from foldwise.operators import knn_lsh as kl  # noqa: E402
from foldwise.plans import evaluate as ev  # noqa: E402
from foldwise.plans import linear as ln  # noqa: E402
from foldwise.plans import models as md  # noqa: E402


def _features(spark, sf_dir, fold_col, label, with_target=True, stored=False):
    """Dense representation: standardized numerics + frequency (+ target) encodings; ``stored``: written once for several models."""
    ns = numeric_stats(spark, sf_dir, fold_col=fold_col)
    cs = category_stats(spark, sf_dir, fold_col=fold_col)
    parts = [num.fit_standardize(ns), cat.fit_frequency(cs)]
    if with_target:
        parts.append(cat.fit_target(category_stats(spark, sf_dir, y_col=label, fold_col=fold_col), 1.0))
    fitted = merge(*parts)
    feat = ev.FoldFeatures(fitted, ctx(spark, sf_dir), K, ["id", "fit_fold", "role", label], fold_col)
    return feat.store() if stored else feat, fitted.names()


def _cv(family_name, task, label, fold_col, params=None, with_target=True, stored=False):
    """``stored``: for families that read their rows several times a fold, so that the lookups are joined once."""
    def run(spark, sf_dir):
        feat, names = _features(spark, sf_dir, fold_col, label, with_target, stored)
        preds = ev.cross_validate(feat, names, label, md.resolve(family_name, task), K, params, score_only=True)
        feat.release()
        o = ev.oof(preds)
        return o.withColumn("y_pred", rnd("y_pred", 2 if task == "regression" else 9))
    return run


QUERIES["ridge_cv"] = _cv("ridge", "regression", "y_reg", "fold")
QUERIES["logistic_cv"] = _cv("logistic_regression", "binary", "y_bin", "sfold")
QUERIES["boosted_cv"] = _cv("gradient_boosted_trees", "regression", "y_reg", "fold",
                            {"n_estimators": 20, "max_depth": 4}, stored=True)
QUERIES["random_forest_cv"] = _cv("random_forest", "binary", "y_bin", "sfold", {"n_estimators": 30, "max_depth": 6}, stored=True)


@query("gaussian_nb_cv")
def gaussian_nb_cv(spark, sf_dir):
    ns = numeric_stats(spark, sf_dir, fold_col="sfold")
    fitted = num.fit_standardize(ns)
    feat = fitted.transform(ctx(spark, sf_dir), K, ["id", "fit_fold", "role", "y_bin"], fold_col="sfold")
    p = ev.gaussian_nb(feat, fitted.names(), "y_bin")
    return ev.oof(p).withColumn("y_pred", rnd("y_pred", 9))


@query("knn_join")
def knn_join(spark, sf_dir):
    emb = fx.fixture_table(spark, sf_dir, "embeddings")
    out = kn.knn_join(emb, "vec_id", "embedding", k=5)
    return out.withColumn("distance", rnd("distance", 6))


def _order_vectors(spark, sf_dir):
    """Four numbers an order, on like scales."""
    c = ctx(spark, sf_dir)
    parts = [F.coalesce("acctbal", F.lit(0.0)) / 3000, F.coalesce("avg_qty", F.lit(0.0)) / 10, F.coalesce("avg_discount", F.lit(0.0)) * 50, F.col("n_items").cast("double")]
    return c.select("id", F.array(*parts).alias("v"))


@query("knn_lsh_join")
def knn_lsh_join(spark, sf_dir):
    """J12 by planned tables of random projections: the orders whose id divides by 100 against all orders. How many pairs come
    back, and whether they have 90 % of the exact neighbours (ids of equal distances count by their distance)."""
    orders = _order_vectors(spark, sf_dir)
    asked = orders.where("id % 100 = 0")
    near = kl.knn_lsh_join(orders, "id", "v", k=5, queries=asked, tie_digits=6)
    exact = kn.knn_join(orders, "id", "v", k=5, queries=asked, tie_digits=6)
    both = exact.select("query_id", "rank", rnd("distance", 6).alias("d")).join(near.select("query_id", "rank", rnd("distance", 6).alias("found")), ["query_id", "rank"], "left")
    return both.agg(F.count_distinct("query_id").alias("n_queries"), F.count("found").alias("n_pairs"), (F.avg((F.col("d") == F.col("found")).cast("int")) >= 0.9).cast("int").alias("recall_reached"))


@query("knn_cv")
def knn_cv(spark, sf_dir):
    """M9 on embeddings: label of a vector predicted from its 5 nearest others."""
    emb = fx.fixture_table(spark, sf_dir, "embeddings")
    nb = kn.knn_join(emb, "vec_id", "embedding", k=5)
    pred = kn.knn_predict(nb, emb, "vec_id", "label")
    return pred.select(F.col("query_id").alias("vec_id"), rnd("y_pred", 9).alias("y_pred"))


@query("leaderboard")
def leaderboard(spark, sf_dir):
    """Flagship: ridge and random forest CV on the orders fixture plus their
    equal-weight blend, ranked by mean fold RMSE."""
    feat, names = _features(spark, sf_dir, "fold", "y_reg", stored=True)
    long = []
    for cid, fam, params in (("ridge", "ridge", None),
                             ("random_forest", "random_forest", {"n_estimators": 30, "max_depth": 6})):
        p = ev.oof(ev.cross_validate(feat, names, "y_reg", md.resolve(fam, "regression"), K, params, score_only=True))
        long.append(p.withColumn("candidate_id", F.lit(cid)))
    # scored once, read by the blend and by the metrics
    allp = cut_lineage(long[0].unionByName(long[1]))
    feat.release()
    b = bl.blend(allp, bl.normalize_weights(["ridge", "random_forest"]), ["id"], carry=["y_true", "fold"])
    allp = allp.unionByName(b.drop("n_components").withColumn("candidate_id", F.lit("blend__ridge_rf")))
    s = mt.cv_summary(mt.fold_metrics(allp, "rmse"))
    return s.select("candidate_id", "metric_name", rnd("cv_mean", 4).alias("cv_mean"),
                    rnd("cv_std", 4).alias("cv_std"), "n_folds").orderBy("cv_mean")


# ---------------------------------------------------------------- representations
from foldwise.operators.representation import Representation  # noqa: E402

FULL_SPEC = Representation(
    operators=["standardize_numeric", {"id": "target_encode_categoricals", "smoothing": 1.0},
               {"id": "onehot_encode_low_cardinality_categoricals", "max_cardinality": 16},
               "row_missing_count", "quantile_bin_numeric"],
    pruners=[{"id": "high_correlation_prune", "threshold": 0.98}])


@query("representation_cv")
def representation_cv(spark, sf_dir):
    """F22-F26 end to end: compile, fit (all folds), prune, materialise dense
    + sparse into one vector, ridge per fold; out-of-fold predictions."""
    c, tr = ctx(spark, sf_dir), train(spark, sf_dir)
    numeric, categorical = pf.resolve_feature_types(tr, fx.FEATURES, low_cardinality_int_threshold=20)
    fr = FULL_SPEC.fit(tr, numeric, categorical, K, "fold", "y_reg", raw_features=fx.FEATURES,
                       card=cat.cardinalities(tr, categorical))
    fr.fit_pruners(c)
    keep = ["id", "fit_fold", "role", "y_reg"]
    rows = fr.transform(c, keep)
    vocab = fr.vocabulary(rows)
    # materialised once for all folds; the fit and the scores read the vectors
    feat = ev.StoredFeatures.write(fr.materialize(rows, vocab).select(*keep, "features"), len(fr.dense) + len(vocab))
    fr.release()
    preds = ev.cross_validate(feat, [*fr.dense, *vocab], "y_reg", md.resolve("ridge", "regression"), K, score_only=True)
    return ev.oof(preds).select("id", "fold", "y_true", rnd("y_pred", 4).alias("y_pred"), F.lit(FULL_SPEC.id).alias("representation_id"))


# ---------------------------------------------------------------- more folds, artifacts, tuning
from foldwise.plans import tune as tn  # noqa: E402
from foldwise.sources import artifacts as art  # noqa: E402
from foldwise.plans import folds as fo  # noqa: E402


@query("folds_kfold_ordered")
def folds_kfold_ordered(spark, sf_dir):
    """V1: unshuffled KFold in id order."""
    return fo.kfold(train(spark, sf_dir).select("id"), "id", K, shuffle=False)


@query("fold_validation")
def fold_validation(spark, sf_dir):
    """O7 / P20 on the context's folds, damaged: fold 5 renamed to 6, every 89th id twice, no fold on every 97th."""
    folds, i = train(spark, sf_dir).select("id", "fold"), F.col("id")
    fold = F.when(i % 97 == 0, F.lit(None)).when(F.col("fold") == 5, 6).otherwise(F.col("fold"))
    return fo.validate_folds(folds.unionByName(folds.where(i % 89 == 0)).withColumn("fold", fold), "id", K)


def _artifact_root(spark):
    return checkpoint_dir(spark).rstrip("/") + f"/artifacts-{uuid.uuid4().hex}"


@query("artifact_roundtrip")
def artifact_roundtrip(spark, sf_dir):
    """Write context and per-candidate tables, read three back."""
    root = _artifact_root(spark)
    oofl = fx.oof_long(spark, sf_dir).persist()
    art.write_context(oofl.where(F.col("candidate_id") == "cand_a").select("row_idx", "fold"),
                      {"k": K, "seed": fx.SEED, "shuffle": True}, root)
    for cid in REG_CANDS:
        o = oofl.where(F.col("candidate_id") == cid)
        art.write_candidate(root, cid, o.select(*art.OOF_COLUMNS),
                            o.select("id", F.col("y_pred").alias("y_reg")))
    back = art.read_oof(spark, root, ["cand_a", "cand_c", "cand_e"])
    return back.select("candidate_id", "row_idx", "y_true", "y_pred", "fold")


@query("truth_check")
def truth_check(spark, sf_dir):
    """OOF truth and folds of damaged tables against a context that lacks every 109th id."""
    ref = fx.oof_long(spark, sf_dir).where((F.col("candidate_id") == "cand_a") & (F.col("id") % 109 != 0))
    return art.truth_mismatches(fx.oof_defects(spark, sf_dir), ref.select("row_idx", "y_true", "fold"), REG_CANDS)


@query("tune_trials")
def tune_trials(spark, sf_dir):
    """Three random-search trials of a random forest, AUC, score-only CV."""
    feat, names = _features(spark, sf_dir, "sfold", "y_bin", stored=True)
    fam = md.resolve("random_forest", "binary")
    space = {"max_depth": ("int", 3, 8), "min_samples_leaf": ("int", 1, 20)}
    return tn.tune(feat, names, "y_bin", fam, K, "roc_auc", n_trials=3, space=space,
                   fixed={"n_estimators": 20})


@query("bagged_ensemble")
def bagged_ensemble(spark, sf_dir):
    """Poisson-bootstrap bags of greedy selection, averaged."""
    w, score = bl.bagged_select(fx.oof_long(spark, sf_dir), REG_CANDS, ["row_idx"], n_bags=3, n_rounds=20)
    return _weights_table(spark, w, score)


# ---------------------------------------------------------------- families, test side, stored tables
from pyspark.ml.functions import array_to_vector  # noqa: E402


@query("knn_fold_cv")
def knn_fold_cv(spark, sf_dir):
    """M9 as a fold model: label of each embedding from the five nearest of the other folds, weighted by 1 / distance."""
    emb = fo.kfold(fx.fixture_table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), "embedding", "label"), "id", K)
    rows = emb.select("id", "fold", F.col("label").alias("y"), array_to_vector(F.col("embedding").cast("array<double>")).alias("features"), F.lit("train").alias("split"))

    def feat(f):
        return one_fit(rows, f)
    found = ev.oof(ev.cross_validate(feat, None, "y", md.resolve("knn", "regression"), K, {"weights": "distance"}, score_only=True))
    return found.withColumn("y_pred", rnd("y_pred", 6))


@query("test_predictions")
def test_predictions(spark, sf_dir):
    """V7: ridge predictions of the test rows, averaged over the fold models."""
    feat, names = _features(spark, sf_dir, "fold", "y_reg")
    preds = ev.cross_validate(feat, names, "y_reg", md.resolve("ridge", "regression"), K)
    feat.release()
    return ev.test_predictions(preds, "rmse").select("id", rnd("y_pred", 2).alias("y_pred"))


def _bounded(oof_rows, lo, hi):
    """1 where a prediction is a number within the bounds (no bounds: finite)."""
    p = F.col("y_pred")
    ok = p.isNotNull() & ~F.isnan(p) & (F.abs(p) < float("inf"))
    return oof_rows.select("id", "fold", "y_true", (ok if lo is None else ok & (p >= lo) & (p <= hi)).cast("int").alias("bounded"))


@query("regression_families_oof")
def regression_families_oof(spark, sf_dir):
    """V5-V9, M2, M4-M8: every regression family over the folds: each training row once per family, with its truth;
    averages of labels (trees) stay within the labels' range."""
    feat, names = _features(spark, sf_dir, "fold", "y_reg", stored=True)
    r = train(spark, sf_dir).agg(F.min("y_reg"), F.max("y_reg")).first()
    plan = [("elasticnet", {"alpha": 0.1, "max_iter": 50}, None), ("random_forest", {"n_estimators": 5, "max_depth": 4}, r)]
    plan += [(b, {"n_estimators": 2, "max_depth": 3}, None) for b in ("gradient_boosted_trees", *md.BOOSTING)]
    parts = [_bounded(ev.oof(ev.cross_validate(feat, names, "y_reg", md.resolve(f, "regression"), K, p, score_only=True)), *(b or (None, None)))
             .withColumn("family", F.lit(f)) for f, p, b in plan]
    return functools.reduce(lambda a, b: a.unionByName(b), parts)


@query("binary_families_oof")
def binary_families_oof(spark, sf_dir):
    """Every binary family over the stratified folds; scores are probabilities."""
    feat, names = _features(spark, sf_dir, "sfold", "y_bin", stored=True)
    plan = [("logistic_regression", {"class_weight": "balanced", "max_iter": 30}), ("random_forest", {"n_estimators": 5, "max_depth": 4})]
    plan += [(b, {"n_estimators": 2, "max_depth": 3}) for b in ("gradient_boosted_trees", *md.BOOSTING)]
    plan += [("knn", {}), ("naive_bayes", {}), ("svm", {"max_iter": 10}), ("realmlp", {"hidden": [4], "max_iter": 10})]
    parts = [_bounded(ev.oof(ev.cross_validate(feat, names, "y_bin", md.resolve(f, "binary"), K, p, score_only=True)), 0.0, 1.0)
             .withColumn("family", F.lit(f)) for f, p in plan]
    return functools.reduce(lambda a, b: a.unionByName(b), parts)


@query("native_trees_oof")
def native_trees_oof(spark, sf_dir):
    """Native numerics (missing values and all) and nominal categories straight into oblivious boosted trees."""
    c, tr = ctx(spark, sf_dir), train(spark, sf_dir)
    numeric, categorical = pf.resolve_feature_types(tr, fx.FEATURES, low_cardinality_int_threshold=20)
    spec = Representation(["native_numeric", "native_categorical"])
    family = md.resolve("catboost", "regression")
    md.check_compatibility(family, spec.matrix_kind())
    fr = spec.fit(tr, numeric, categorical, K, "fold", "y_reg")
    keep = ["id", "fit_fold", "role", "y_reg"]
    preds = ev.cross_validate(lambda f: fr.materialize(fr.transform(c, keep, f), [], nulls=family.takes_nan), None, "y_reg", family, K,
                              {"iterations": 2, "depth": 3, "border_count": 32, "learning_rate": 0.3}, score_only=True)
    return ev.oof(preds).withColumn("y_pred", rnd("y_pred", 3))


RAW_NUMERIC = ["acctbal", "avg_qty", "avg_discount", "n_items"]


def _raw_features(spark, sf_dir, fold_col, label):
    """Numeric columns as they are, with their nulls, for every fit fold."""
    return expand_fits(ctx(spark, sf_dir), K, fold_col).select("id", "fit_fold", "role", label, *RAW_NUMERIC)


@query("hist_boosting_cv")
def hist_boosting_cv(spark, sf_dir):
    """M7: two rounds of depth-wise histogram trees of all folds, on columns with missing values."""
    params = {"n_estimators": 2, "max_depth": 2, "max_bin": 16, "learning_rate": 0.5}
    preds = ev.cross_validate(_raw_features(spark, sf_dir, "fold", "y_reg"), RAW_NUMERIC, "y_reg", md.resolve("xgboost", "regression"), K, params, score_only=True)
    return ev.oof(preds).withColumn("y_pred", rnd("y_pred", 3))


@query("hist_boosting_binary_cv")
def hist_boosting_binary_cv(spark, sf_dir):
    """M8, V8: two rounds of oblivious histogram trees with logistic loss on the stratified folds."""
    params = {"iterations": 2, "depth": 2, "border_count": 16, "learning_rate": 0.5}
    preds = ev.cross_validate(_raw_features(spark, sf_dir, "sfold", "y_bin"), RAW_NUMERIC, "y_bin", md.resolve("catboost", "binary"), K, params, score_only=True)
    return ev.oof(preds).withColumn("y_pred", rnd("y_pred", 7))


#: (alpha, l1_ratio) of the elastic-net path, strongest first.
PENALTIES = [(20000.0, 1.0), (2000.0, 0.9), (200.0, 0.5)]


@query("elasticnet_path_cv")
def elasticnet_path_cv(spark, sf_dir):
    """M2: every fold's solutions along a path of penalties, from the moments of one scan; out-of-fold predictions."""
    feat, names = _features(spark, sf_dir, "fold", "y_reg", with_target=False, stored=True)
    table = feat.all_folds().withColumn("label", F.col("y_reg").cast("double"))
    path = ln.elasticnet_path(ln.fold_moments(table.where("role = 'train'")), PENALTIES)
    valid = table.where("role = 'valid'")
    parts = [valid.select("id", F.col("fit_fold").alias("fold"), F.lit(a).alias("alpha"), F.lit(r).alias("l1_ratio"), F.col("label").alias("y_true"), ln.score(valid, w).alias("y_pred")) for (a, r), w in zip(PENALTIES, path, strict=True)]
    return functools.reduce(lambda a, b: a.unionByName(b), parts).withColumn("y_pred", rnd("y_pred", 2))


@query("logistic_newton_cv")
def logistic_newton_cv(spark, sf_dir):
    """M3, V8: logistic regression of all folds by Newton steps, balanced classes."""
    feat, names = _features(spark, sf_dir, "sfold", "y_bin", with_target=False, stored=True)
    preds = ev.cross_validate(feat, names, "y_bin", md.resolve("logistic_regression", "binary"), K, {"class_weight": "balanced"}, score_only=True)
    return ev.oof(preds).withColumn("y_pred", rnd("y_pred", 7))


@query("blend_summary")
def blend_summary(spark, sf_dir):
    """The 19 columns of a blend's summary, written and read back."""
    w = bl.normalize_weights(["cand_a", "cand_b", "cand_c"], [2.0, 1.0, 1.0])
    about = {c: {"candidate_type": "model", "run_id": f"run_{c}", "model_registry_key": "ridge", "estimator_name": "Ridge"} for c in w}
    s = bl.blend_summary(fx.oof_long(spark, sf_dir), w, "rmse", "blend__abc", about, ["row_idx"])
    root = _artifact_root(spark)
    s.write.parquet(f"{root}/blend_summary")
    back = spark.read.parquet(f"{root}/blend_summary")
    return back.select(*[rnd(c, 6).alias(c) if t == "double" else F.col(c) for c, t in back.dtypes])


@query("ledger_write")
def ledger_write(spark, sf_dir):
    """Runs appended in two batches to the ledger's four tables, read back per run."""
    runs, arts = _ledger(spark, sf_dir)
    root = _artifact_root(spark)
    first = F.substring_index("run_id", "_", -1).cast("long") % 2 == 0
    for batch in (first, ~first):
        ld.write_runs(root, runs.where(batch), ["cv_n_splits", "cv_shuffle", "trial_number"], ["metric_value"], arts.where(batch))
    t = ld.read_ledger(spark, root)
    per = lambda name, c: t[name].groupBy("run_id").agg(F.count(F.lit(1)).alias(c))
    out = t["runs"].select("run_id", "candidate_id", "status").join(per("run_params", "n_params"), "run_id", "left").join(per("run_artifacts", "n_artifacts"), "run_id", "left")
    out = out.join(t["run_metrics"].where("key = 'metric_value'").select("run_id", F.col("value").alias("metric_value")), "run_id", "left")
    trial = t["run_params"].where("key = 'trial_number'").select("run_id", F.col("value").alias("trial_json"))
    return out.join(trial, "run_id", "left").withColumn("n_artifacts", F.coalesce("n_artifacts", F.lit(0)).cast("bigint"))


@query("history_roundtrip")
def history_roundtrip(spark, sf_dir):
    """Events and stored observations per candidate, as history documents and back."""
    _, events, _ = _refresh_inputs(spark, sf_dir)
    obs = fx.observation_history(spark, sf_dir).join(events, "submission_event_id").drop("observed_seq")
    path = _artifact_root(spark) + "/history"
    art.write_history(events, obs, path)
    kind = lambda df: T.StructType([f for f in df.schema.fields if f.name != "candidate_id"])
    ev_back, ob_back = art.read_history(spark, path, kind(events), kind(obs))
    a = ev_back.select("candidate_id", "submission_event_id", F.lit("event").alias("part"), F.lit(None).cast("double").alias("public_score"))
    return a.unionByName(ob_back.select("candidate_id", "submission_event_id", F.lit("observation").alias("part"), "public_score"))


@query("eda_reports")
def eda_reports(spark, sf_dir):
    """The report set as CSV files; the missingness report read back."""
    root = _artifact_root(spark)
    tr, te = eda_tables(spark, sf_dir)
    for name, df in (("columns", pf.column_summary(tr)), ("missingness", pf.missingness(tr, te)), ("cardinality", pf.cardinality(tr, te)),
                     ("target", pf.target_summary_numeric(tr, "y_reg")), ("run", pf.run_summary(tr, te, len(fx.FEATURES)))):
        art.write_report(df, root, name)
    kind = pf.missingness(tr, te).schema
    return spark.read.schema(kind).option("header", "true").csv(f"{root}/missingness").withColumn("null_pct", rnd("null_pct", 9))
