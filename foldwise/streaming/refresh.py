"""Submission refresh (S14, S15, J6-J8, O3, O4, A20, A21) in batch and as a stream.

Remote listing rows land as files. A refresh parses them, matches each to a
recorded submission event (left join on the event id taken from the
description), recovers orphans onto candidates that have a canonical run, and
appends only observations whose signature is not stored yet (null-safe
anti join, then a distinct on the signature). The stored observation table is
the dedup state, so re-running over the same files appends nothing; the
streaming version runs the same function per micro-batch (``foreachBatch``).
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foldwise.functions.scalar import malformed_number, parse_optional_number

# Tag names in submission descriptions, the id alphabet and the
# observation signature used for de-duplication.
SUBMIT_TAG = "submit"
CANDIDATE_TAG = "candidate"
SUBMIT_ID_PATTERN = r"^[a-z0-9_-]+$"
SIGNATURE = ("submission_event_id", "kaggle_submitted_at", "kaggle_file_name", "kaggle_status",
             "public_score", "private_score")
OBSERVATION_COLS = SIGNATURE + ("kaggle_description",)

REMOTE_SCHEMA = T.StructType([
    T.StructField("kaggle_submitted_at", T.StringType()),
    T.StructField("kaggle_file_name", T.StringType()),
    T.StructField("kaggle_description", T.StringType()),
    T.StructField("kaggle_status", T.StringType()),
    T.StructField("public_score", T.StringType()),
    T.StructField("private_score", T.StringType()),
])


def _last_tag(desc, tag: str):
    parts = F.split(F.coalesce(desc, F.lit("")), r" \| ")
    tagged = F.filter(parts, lambda p: p.startswith(tag + "="))
    value = F.trim(F.substring(F.element_at(tagged, -1), len(tag) + 2, 1 << 20))
    return F.when(F.size(tagged) > 0, value)


def parse_remote(remote: DataFrame) -> DataFrame:
    """Event id and candidate id from the description; scores to double."""
    d = F.col("kaggle_description")
    sub = _last_tag(d, SUBMIT_TAG)
    cand = _last_tag(d, CANDIDATE_TAG)
    return remote.select(
        F.when(sub.rlike(SUBMIT_ID_PATTERN), sub).alias("submission_event_id"),
        F.when(cand != "", cand).alias("remote_candidate_id"),
        "kaggle_submitted_at", "kaggle_file_name", "kaggle_description", "kaggle_status",
        parse_optional_number("public_score").alias("public_score"),
        parse_optional_number("private_score").alias("private_score"),
    )


def malformed_scores(remote: DataFrame) -> DataFrame:
    """Listing rows with a score text that is neither a number nor a known null text. A refresh
    must not record them: reading them as NULL would hide a changed listing format."""
    bad = malformed_number("public_score") | malformed_number("private_score")
    return remote.where(bad).select("kaggle_submitted_at", "kaggle_file_name", "public_score", "private_score")


def event_ids(rows: DataFrame, at: str, key: list[str]) -> DataFrame:
    """Rows with ``submission_event_id``: sub_<time in UTC to the microsecond>_<six hex digits of the key's digest>. The same row
    gets the same id when a task runs again; ids fit SUBMIT_ID_PATTERN."""
    digest = F.md5(F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in key]))
    stamp = F.date_format(F.col(at), "yyyyMMdd't'HHmmssSSSSSS")
    return rows.withColumn("submission_event_id", F.concat(F.lit("sub_"), stamp, F.lit("_"), F.substring(digest, 1, 6)))


def duplicate_event_ids(events: DataFrame) -> DataFrame:
    """Event ids recorded more than once (must be empty)."""
    return events.groupBy("submission_event_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def resolve(parsed: DataFrame, events: DataFrame, canonical_candidates: DataFrame) -> DataFrame:
    """J6 + J7 in one plan: each listing row with an event id, once, with its outcome.

    ``outcome``: matched, candidate_mismatch (tracked under another candidate), recovered
    (unknown event of a candidate that has a canonical run), missing_candidate_id or
    no_canonical_candidate_run. ``candidate_id`` is set for matched and recovered rows.
    The listing is read once; matches, orphans and observations are filters of it."""
    ev = events.select("submission_event_id", F.col("candidate_id").alias("tracked_candidate_id"))
    can = canonical_candidates.select(F.col("candidate_id").alias("remote_candidate_id"), F.lit(True).alias("_has_run")).distinct()
    rows = parsed.where(F.col("submission_event_id").isNotNull()).join(ev, "submission_event_id", "left").join(can, "remote_candidate_id", "left")
    remote, tracked = F.col("remote_candidate_id"), F.col("tracked_candidate_id")
    outcome = (F.when(tracked.isNotNull(), F.when(remote.isNotNull() & (remote != tracked), "candidate_mismatch").otherwise("matched"))
               .when(remote.isNull(), "missing_candidate_id")
               .when(F.col("_has_run").isNull(), "no_canonical_candidate_run").otherwise("recovered"))
    rows = rows.withColumn("outcome", outcome).drop("_has_run")
    return rows.withColumn("candidate_id", F.when(F.col("outcome") == "matched", tracked).when(F.col("outcome") == "recovered", remote))


def match(parsed: DataFrame, events: DataFrame, canonical_candidates: DataFrame | None = None) -> DataFrame:
    """Remote rows of recorded events, with the candidate consistency flag."""
    none = events.select("candidate_id").limit(0) if canonical_candidates is None else canonical_candidates
    rows = resolve(parsed, events, none).where(F.col("outcome").isin("matched", "candidate_mismatch"))
    return rows.withColumn("candidate_mismatch", (F.col("outcome") == "candidate_mismatch").cast("int"))


def orphans(parsed: DataFrame, events: DataFrame, canonical_candidates: DataFrame) -> DataFrame:
    """Remote rows of unknown events; recovered when the description names a candidate that has a
    canonical run."""
    rows = resolve(parsed, events, canonical_candidates)
    return rows.where(~F.col("outcome").isin("matched", "candidate_mismatch")).withColumnRenamed("outcome", "recovery")


def candidate_observations(parsed: DataFrame, events: DataFrame, canonical_candidates: DataFrame) -> DataFrame:
    """Observations a refresh would record: consistent matches plus recovered orphans."""
    rows = resolve(parsed, events, canonical_candidates)
    return rows.where(F.col("candidate_id").isNotNull()).select(*OBSERVATION_COLS, "candidate_id")


def append_events(events: DataFrame, recovered: DataFrame) -> DataFrame:
    """Recorded events plus one event per recovered orphan. An event id that is recorded twice,
    or recovered under two candidates, is an error."""
    new = recovered.select("submission_event_id", "candidate_id").distinct()
    both = events.select("submission_event_id", "candidate_id").unionByName(new)
    once = both.groupBy("submission_event_id").agg(F.count(F.lit(1)).alias("_n"), F.min("candidate_id").alias("candidate_id"))
    twice = F.raise_error(F.concat(F.lit("submission event recorded twice: "), F.col("submission_event_id"))).cast("string")
    return once.select("submission_event_id", F.when(F.col("_n") == 1, F.col("candidate_id")).otherwise(twice).alias("candidate_id"))


def new_observations(candidates: DataFrame, history: DataFrame) -> DataFrame:
    """O3: drop rows whose signature is stored (NULL scores compare equal), then keep one row per
    signature: of several, the first by description and candidate."""
    cond = None
    for c in SIGNATURE:
        one = candidates[c].eqNullSafe(history[c])
        cond = one if cond is None else cond & one
    fresh = candidates.join(history, cond, "left_anti")
    rest = [c for c in candidates.columns if c not in SIGNATURE]
    return fresh.groupBy(*SIGNATURE).agg(F.min(F.struct(*rest)).alias("_first")).select(*SIGNATURE, "_first.*").select(*candidates.columns)


def score_rollup(observations: DataFrame, higher_is_better: bool, *more) -> DataFrame:
    """Per event, observation count, latest non-null public / private score, and the best
    scores by metric direction. Latest is last appended: the highest ``observed_seq`` (each
    appended batch has its own), then submitted time, file and the rest of the signature, so
    that the order is total whatever the order of rows. ``more``: further aggregates."""
    order = F.struct("observed_seq", "kaggle_submitted_at", "kaggle_file_name", "kaggle_status", "public_score", "private_score")
    best = F.max if higher_is_better else F.min
    pub, priv = F.col("public_score"), F.col("private_score")
    return observations.groupBy("submission_event_id").agg(
        F.count(F.lit(1)).alias("n_observations"),
        F.max_by(pub, F.when(pub.isNotNull(), order)).alias("latest_public_score"),
        F.max_by(priv, F.when(priv.isNotNull(), order)).alias("latest_private_score"),
        best(pub).alias("best_public_score"),
        best(priv).alias("best_private_score"), *more)


def candidate_scores(events: DataFrame, observations: DataFrame, higher_is_better: bool) -> DataFrame:
    """A20 per candidate: number of its submission events (``submit_count``) beside the latest and
    best scores of all its observations. observations has candidate_id."""
    order = F.struct("observed_seq", "kaggle_submitted_at", "kaggle_file_name", "kaggle_status", "public_score", "private_score")
    best = F.max if higher_is_better else F.min
    pub, priv = F.col("public_score"), F.col("private_score")
    counts = events.groupBy("candidate_id").agg(F.count(F.lit(1)).alias("submit_count"))
    scores = observations.groupBy("candidate_id").agg(
        F.max_by(pub, F.when(pub.isNotNull(), order)).alias("latest_public_score"), best(pub).alias("best_public_score"),
        F.max_by(priv, F.when(priv.isNotNull(), order)).alias("latest_private_score"), best(priv).alias("best_private_score"))
    out = counts.join(scores, "candidate_id", "full_outer")
    return out.withColumn("submit_count", F.coalesce("submit_count", F.lit(0)).cast("bigint"))


def refresh_counters(parsed: DataFrame, events: DataFrame, cands: DataFrame, appended: DataFrame) -> DataFrame:
    """Tracked, matched, appended, scanned, updated-candidate counts (one row)."""
    tracked = events.agg(F.count_distinct("submission_event_id").alias("tracked_events"))
    matched = cands.agg(F.count_distinct("submission_event_id").alias("matched_events"))
    app = appended.agg(F.count(F.lit(1)).alias("appended_observations"),
                       F.count_distinct("candidate_id").alias("updated_candidates"))
    scanned = parsed.agg(F.count(F.lit(1)).alias("scanned_remote"))
    rows = []
    for df in (tracked, matched, app, scanned):
        rows.append(df.select(F.inline(F.array(*[F.struct(F.lit(c).alias("counter"), F.col(c).cast("bigint").alias("value"))
                                                  for c in df.columns]))))
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out


def refresh_batch(remote: DataFrame, events: DataFrame, canonical_candidates: DataFrame,
                  history: DataFrame) -> DataFrame:
    """Rows to append to the observation table for one landed batch. A malformed score is an error."""
    bad = malformed_number("public_score") | malformed_number("private_score")
    said = F.raise_error(F.concat(F.lit("malformed score in the listing of "), F.coalesce("kaggle_file_name", F.lit("?")))).cast("string")
    parsed = parse_remote(remote.withColumn("public_score", F.when(bad, said).otherwise(F.col("public_score"))))
    cands = candidate_observations(parsed, events, canonical_candidates)
    return new_observations(cands, history)


def run_stream(spark, source_dir: str, target_dir: str, checkpoint: str, events: DataFrame,
               canonical_candidates: DataFrame, seq: int = 1, rollup_dir: str | None = None,
               higher_is_better: bool = False):
    """File-source stream of landed listings; each micro-batch appends its new
    observations to ``target_dir`` (parquet), with ``observed_seq`` = seq + batch id, the append order. Trigger: available-now (drains and stops).
    Dedup state is the target table itself, so no watermark is needed.

    X2: with ``rollup_dir``, each batch also recomputes the score rollup of the
    events it touched and appends it tagged with the batch id; see
    :func:`current_rollup`."""
    events = events.cache()  # read by every batch; released when the stream ends
    canonical_candidates = canonical_candidates.cache()

    def stored() -> DataFrame:
        try:
            return spark.read.parquet(target_dir)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise  # an unreadable table is not an empty one
            return spark.createDataFrame([], observation_schema())

    def handle(batch: DataFrame, batch_id: int):
        history = stored()
        new = (refresh_batch(batch, events, canonical_candidates, history.select(*SIGNATURE))
               .select(*OBSERVATION_COLS, "candidate_id").withColumn("observed_seq", F.lit(seq + batch_id).cast("int"))
               .persist())
        # Everything derived from ``history`` is re-cached once the target path is
        # written (Spark refreshes plans reading a written path), so the rollup is
        # built from the pre-append history plus the new rows and written first.
        # A retried batch id re-runs idempotently: the anti join drops appended rows.
        if rollup_dir is not None:
            touched = new.select("submission_event_id").distinct()
            cols = list(OBSERVATION_COLS) + ["observed_seq"]
            obs = history.select(*cols).join(touched, "submission_event_id", "left_semi") \
                .unionByName(new.select(*cols))
            (score_rollup(obs, higher_is_better).withColumn("batch_id", F.lit(batch_id).cast("long"))
             .write.mode("append").parquet(rollup_dir))
        new.write.mode("append").parquet(target_dir)
        new.unpersist()

    q = (spark.readStream.schema(REMOTE_SCHEMA).json(source_dir)
         .writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    events.unpersist()
    canonical_candidates.unpersist()
    return spark.read.parquet(target_dir)


# ------------------------------------------------------------------ the same with keyed state
#: Keyed state is held outside the JVM heap (RocksDB): it has an entry per signature and one per event.
STATE_STORE = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
_ROLLUP_COLS = ("submission_event_id", "n_observations", "latest_public_score", "latest_private_score", "best_public_score", "best_private_score")


def _drain(rows: DataFrame, mode: str, checkpoint: str, handle) -> list[dict]:
    """Runs a stream over what is there and ends. Returns the progress of its batches (rows read per source)."""
    spark = rows.sparkSession
    before = spark.conf.get(STATE_STORE[0], None)
    spark.conf.set(*STATE_STORE)
    try:
        q = rows.writeStream.outputMode(mode).foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    finally:  # a started stream has its own copy of the settings
        spark.conf.unset(STATE_STORE[0]) if before is None else spark.conf.set(STATE_STORE[0], before)
    q.awaitTermination()
    return [{"batch_id": p["batchId"], "rows": {x["description"]: x["numInputRows"] for x in p["sources"]}} for p in q.recentProgress]


def first_of_signature(rows: DataFrame) -> DataFrame:
    """O3 on keyed state: one row a signature, of those of the batch that met it first: a stored one if there is one, else the
    first by description and candidate. ``_new``: that batch is this one. rows stream with observed_seq NULL where not stored."""
    rest = F.struct(F.col("observed_seq").isNull().alias("fresh"), "observed_seq", "kaggle_description", "candidate_id", "outcome")
    kept = rows.withColumn("_at", F.current_timestamp()).groupBy(*SIGNATURE).agg(
        F.min(F.struct(F.col("_at").alias("at"), rest.alias("rest"))).alias("_first"), F.max("_at").alias("_last"))
    return kept.select(*SIGNATURE, "_first.rest.*", (F.col("_first.at") == F.col("_last")).alias("_new"))


def run_keyed_stream(spark, source_dir: str, out_dir: str, checkpoint: str, events: DataFrame, canonical_candidates: DataFrame,
                     history_dir: str | None = None, seq: int = 1, higher_is_better: bool = False) -> list[dict]:
    """X1 + X2 on state stores keyed by signature and by submission event: a batch reads its landed files, never the observations before.

    Two streams, one after the other: the first keeps one row a signature and records the new ones, the second folds what the
    first recorded into the score rollup of its event. The state is seeded by the stored history (``history_dir``), a second
    file source whose files are read once. Writes per batch, under out_dir: ``observations`` (with observed_seq = seq +
    batch id), ``stored`` (the seeds), ``events`` (recovered orphans), ``quarantine`` (rows with a malformed score, which end up there and
    don't stop the stream) and, by the second stream, ``rollup`` (of the events with new observations). A batch that runs again overwrites
    its own folders; the second stream only reads folders of ended batches. Trigger: available-now. Returns the progress of the first
    stream's batches (rows read per source)."""
    events, canonical_candidates = events.cache(), canonical_candidates.cache()
    listing = spark.readStream.schema(REMOTE_SCHEMA).json(source_dir)
    bad = F.coalesce(malformed_number("public_score") | malformed_number("private_score"), F.lit(False))
    fresh = resolve(parse_remote(listing.where(~bad)), events, canonical_candidates).where(F.col("candidate_id").isNotNull())
    rows = fresh.select(*OBSERVATION_COLS, "candidate_id", "outcome", F.lit(None).cast("int").alias("observed_seq"))
    if history_dir is not None:
        stored = spark.readStream.schema(observation_schema()).parquet(history_dir)
        rows = rows.unionByName(stored.select(*OBSERVATION_COLS, "candidate_id", F.lit("stored").alias("outcome"), F.coalesce("observed_seq", F.lit(0)).alias("observed_seq")))
    first = first_of_signature(rows).where("_new").select(*OBSERVATION_COLS, "candidate_id", "outcome", "observed_seq")
    score = F.lit(None).cast("double")
    odd = listing.where(bad).select(F.lit("").alias("submission_event_id"), "kaggle_submitted_at", "kaggle_file_name", "kaggle_status", score.alias("public_score"), score.alias("private_score"),
                                    F.concat_ws(" | ", "kaggle_description", F.concat(F.lit("public_score="), "public_score"), F.concat(F.lit("private_score="), "private_score")).alias("kaggle_description"))
    found = first.unionByName(odd.select(*OBSERVATION_COLS, F.lit(None).cast("string").alias("candidate_id"), F.lit("malformed").alias("outcome"), F.lit(None).cast("int").alias("observed_seq")))

    def record(batch: DataFrame, batch_id: int):
        batch = batch.persist()
        new = batch.where("outcome in ('matched', 'recovered')")
        parts = {"observations": new.select(*OBSERVATION_COLS, "candidate_id", F.lit(seq + batch_id).cast("int").alias("observed_seq")),
                 "stored": batch.where("outcome = 'stored'").select(*OBSERVATION_COLS, "candidate_id", "observed_seq"),
                 "events": new.where("outcome = 'recovered'").select("submission_event_id", "candidate_id").distinct(),
                 "quarantine": batch.where("outcome = 'malformed'").select(*OBSERVATION_COLS[1:4], "kaggle_description")}
        for name, part in parts.items():
            part.write.mode("overwrite").parquet(f"{out_dir}/{name}/batch_id={batch_id}")
        batch.unpersist()

    progress = _drain(found, "update", checkpoint, record)
    events.unpersist()
    canonical_candidates.unpersist()
    try:
        spark.read.schema(observation_schema()).parquet(f"{out_dir}/observations")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return progress  # nothing has landed yet

    def recorded(name: str) -> DataFrame:
        files = spark.readStream.schema(observation_schema()).option("recursiveFileLookup", "true").parquet(f"{out_dir}/{name}")
        return files.withColumn("_fresh_at", F.when(F.lit(name == "observations"), F.current_timestamp()))

    rolled = score_rollup(recorded("observations").unionByName(recorded("stored")), higher_is_better, F.max("_fresh_at").alias("_fresh_at"))

    def roll(batch: DataFrame, batch_id: int):
        batch.select(*_ROLLUP_COLS).write.mode("overwrite").parquet(f"{out_dir}/rollup/batch_id={batch_id}")

    touched = rolled.where(F.col("_fresh_at") == F.current_timestamp())
    _drain(touched, "update", checkpoint.rstrip("/") + "-rollup", roll)
    return progress


def current_rollup(spark, rollup_dir: str) -> DataFrame:
    """The latest rollup row per event (highest batch id)."""
    r = spark.read.parquet(rollup_dir)
    cols = [c for c in r.columns if c not in ("submission_event_id", "batch_id")]
    latest = r.groupBy("submission_event_id").agg(F.max_by(F.struct(*cols), "batch_id").alias("s"))
    return latest.select("submission_event_id", "s.*")


def observation_schema() -> T.StructType:
    return T.StructType([
        T.StructField("submission_event_id", T.StringType()),
        T.StructField("kaggle_submitted_at", T.StringType()),
        T.StructField("kaggle_file_name", T.StringType()),
        T.StructField("kaggle_status", T.StringType()),
        T.StructField("public_score", T.DoubleType()),
        T.StructField("private_score", T.DoubleType()),
        T.StructField("kaggle_description", T.StringType()),
        T.StructField("candidate_id", T.StringType()),
        T.StructField("observed_seq", T.IntegerType()),
    ])
