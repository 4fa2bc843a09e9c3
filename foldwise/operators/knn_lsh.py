"""Approximate k-nearest-neighbour join (J12, M9 beyond the size where all pairs are affordable).

Several tables of random-projection buckets: in a table, a vector's bucket is the list of
floor((a . v + b) / width) over a few Gaussian projections, and near vectors share a bucket with
a probability that only depends on their distance. The number of tables, of projections
and the width are planned: a bounded sample of queries is joined exactly, and of all
settings that find the wanted share of those neighbours, the one that compares the fewest
pairs is taken. Buckets are compared inside tasks, and every distance returned is exact.

Equal vectors are one class that carries its smallest ids, so a vector with a third of all rows is
one row here. Buckets with more than BUCKET_ROWS queries or reference vectors are dealt as blocks of
pairs; inside a task the exact search of a unit (``knn.nearest``) leaves out what is too far.
"""

from __future__ import annotations

import math
from functools import partial
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from foldwise.operators.knn import _vectors, nearest
from foldwise.session import cut_lineage, ship_package

BUCKET_ROWS = 32_768
#: Queries and reference rows of the planning sample; most tables and projections considered.
PLAN_QUERIES, PLAN_ROWS, MOST_TABLES, MOST_PROJECTIONS = 64, 2048, 400, 24
SALTS = 16
_PAIRS = "q long, r long, distance double"


def collision(distance: np.ndarray, width: float) -> np.ndarray:
    """Probability that one projection puts two vectors at that distance into one cell."""
    c = np.maximum(np.asarray(distance, dtype=np.float64), 1e-300) / width
    tail = np.array([math.erfc(1 / (x * math.sqrt(2))) for x in c.ravel()]).reshape(c.shape)
    return np.where(c < 1e-9, 1.0, 1 - tail - 2 * c / math.sqrt(2 * math.pi) * (1 - np.exp(-1 / (2 * c * c))))


def plan_tables(near: np.ndarray, far: np.ndarray, recall: float) -> tuple[int, int, float]:
    """(tables, projections, width) that find ``recall`` of the pairs at the near distances for the least share of the far ones compared."""
    near = near[near > 0]
    if not len(near):
        return 1, 1, 1.0
    best = None
    middle = float(np.median(near))
    for factor in (1.0, 2.0, 4.0, 8.0, 16.0):
        one, other = collision(near, factor * middle), collision(far, factor * middle)
        for projections in range(1, MOST_PROJECTIONS + 1):
            p = one ** projections
            lo, hi = 1, MOST_TABLES
            if np.mean(1 - (1 - p) ** hi) < recall:
                break
            while lo < hi:
                mid = (lo + hi) // 2
                lo, hi = (lo, mid) if np.mean(1 - (1 - p) ** mid) >= recall else (mid + 1, hi)
            # pairs compared, and what a table costs by itself (about a thousandth of a comparison with all)
            cost = lo * (np.mean(other ** projections) + 1e-3)
            if best is None or cost < best[0]:
                best = cost, lo, projections, factor * middle
    if best is None:  # wide cells always reach it
        return MOST_TABLES, 1, 16.0 * middle
    return best[1:]


def _distances(a: np.ndarray, b: np.ndarray):
    """Blocks of (first row, distances of some rows of a to all of b)."""
    step = max(1, 2_000_000 // max(1, b.size))
    for lo in range(0, len(a), step):
        diff = a[lo:lo + step, None, :] - b[None, :, :]
        yield lo, np.sqrt(np.einsum("ijk,ijk->ij", diff, diff))


def _pairs(q_cls, q, r_cls, r, k: int, scale: float) -> pa.RecordBatch | None:
    """The k nearest other classes of every query (ties by class); vectors that are no numbers have none."""
    a, b = np.isfinite(q).all(axis=1), np.isfinite(r).all(axis=1)
    if not a.any() or not b.any():
        return None
    out = nearest(q_cls[a], q[a], r_cls[b], r[b], k, scale, True)
    return pa.RecordBatch.from_arrays([pa.array(x) for x in out], ["q", "r", "distance"]) if len(out[0]) else None


def _sample_near(batches, sample, k, scale):
    """Nearest of a partition's rows to the sampled queries."""
    ids, vectors = sample.value
    for batch in batches:
        if batch.num_rows and (found := _pairs(ids, vectors, batch.column("cls").to_numpy(), _vectors(batch.column("v"), batch.num_rows), k, scale)) is not None:
            yield found


def _projections(tables: int, projections: int, d: int, seed: int):
    rng = np.random.default_rng(seed)
    return rng.standard_normal((tables, projections, d)), rng.random((tables, projections))


def _hash(batches, plan, d, seed):
    """Every vector once per table, with its bucket."""
    tables, projections, width = plan
    a, b = _projections(tables, projections, d, seed)
    mix = np.random.default_rng(seed + 1).integers(1, 1 << 62, projections, dtype=np.int64) | 1
    for batch in batches:
        if not batch.num_rows:
            continue
        v = _vectors(batch.column("v"), batch.num_rows)
        for t in range(tables):
            cell = np.floor(v @ a[t].T / width + b[t]).astype(np.int64)
            with np.errstate(over="ignore"):
                bucket = (cell * mix).sum(axis=1)
                bucket = bucket ^ (bucket >> np.int64(29))
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(v), t, dtype=np.int32)), pa.array(bucket), *(batch.column(c) for c in ("cls", "role", "v"))], ["tab", "bucket", "cls", "role", "v"])


def _compare(batches, k, scale):
    """Units (table, bucket, query block, reference block) follow each other; each is compared when it is complete."""
    held: list = []
    unit = None

    def settle():
        cls, role, v = (np.concatenate(a) for a in zip(*held, strict=True))
        q, r = (role & 1) > 0, (role & 2) > 0
        return _pairs(cls[q], v[q], cls[r], v[r], k, scale) if len(cls) > 1 and q.any() and r.any() else None

    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.column_stack([batch.column(c).to_numpy().astype(np.int64) for c in ("tab", "bucket", "qb", "rb")])
        cls, role, v = batch.column("cls").to_numpy(), batch.column("role").to_numpy(), _vectors(batch.column("v"), batch.num_rows)
        cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
        for lo, hi in pairwise([0, *cuts.tolist(), len(keys)]):
            key = keys[lo].tolist()
            if key != unit and held:
                if (found := settle()) is not None:
                    yield found
                held = []
            unit = key
            held.append((cls[lo:hi], role[lo:hi], v[lo:hi]))
    if held and (found := settle()) is not None:
        yield found


def _classes(df: DataFrame, id_col: str, vec_col: str, keep: int) -> tuple[DataFrame, DataFrame]:
    """(classes (cls, v, ids: its ``keep`` smallest ids), members (id, cls)) of equal vectors; a frequent vector is reduced part by part first."""
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.transform(vec_col, lambda x: x.cast("double")).alias("v")).where("v is not null and id is not null")
    salted = rows.withColumn("_s", F.pmod("id", F.lit(64)))
    first = Window.partitionBy("v", "_s").orderBy("id")
    some = salted.withColumn("_n", F.row_number().over(first)).where(F.col("_n") <= keep)
    classes = some.groupBy("v").agg(F.slice(F.array_sort(F.collect_set("id")), 1, keep).alias("ids"))  # at most 64 * keep ids each
    return classes.withColumn("cls", F.get("ids", F.lit(0))), rows


def knn_lsh_join(data: DataFrame, id_col: str, vec_col: str, k: int = 5, *, recall: float = 0.95, queries: DataFrame | None = None,
                 exclude_self: bool = True, tie_digits: int = 9, seed: int = 42, plan: tuple[int, int, float] | None = None) -> DataFrame:
    """(query_id, neighbor_id, rank, distance): for every query about ``recall`` of its k nearest reference rows, with exact distances.

    As ``knn_join`` otherwise: ``queries`` defaults to data, ties after rounding to ``tie_digits`` go to the smaller id.
    Equal vectors always find each other. Rows with a null id or vector are left out. ``plan`` (tables, projections, width) replaces the planned one."""
    spark = data.sparkSession
    ship_package(spark)
    scale = float(10 ** tie_digits)
    classes, rows = _classes(data, id_col, vec_col, k + 1)
    if queries is None:
        both = cut_lineage(classes.withColumn("role", F.lit(3)))
        q_rows = rows
    else:
        # a class may be of queries, of reference rows or of both
        q_classes, q_rows = _classes(queries, id_col, vec_col, 1)
        merged = classes.select("v", "ids").join(q_classes.select("v", F.get("ids", F.lit(0)).alias("qid")), "v", "full_outer")
        role = F.when(F.col("qid").isNotNull(), 1).otherwise(0) + F.when(F.col("ids").isNotNull(), 2).otherwise(0)
        name = F.coalesce(2 * F.get("ids", F.lit(0)), 2 * F.col("qid") + 1)  # in the order of the smallest ids
        both = cut_lineage(merged.select(name.alias("cls"), "v", "ids", role.alias("role")))
    head = both.select(F.size("v").alias("d")).first()
    if head is None:
        return spark.createDataFrame([], "query_id long, neighbor_id long, rank int, distance double")
    if plan is None:
        turn = F.xxhash64("cls", F.lit(seed))
        asked = both.where(F.col("role").bitwiseAND(1) > 0).orderBy(turn).limit(PLAN_QUERIES).select("cls", "v").toPandas()
        refs = both.where(F.col("role").bitwiseAND(2) > 0)
        others = refs.orderBy(turn).limit(PLAN_ROWS).select("cls", "v").toPandas()
        ids, vectors = asked["cls"].to_numpy(), np.array(asked["v"].tolist(), dtype=np.float64).reshape(len(asked), -1)
        near = refs.select("cls", "v").mapInArrow(partial(_sample_near, sample=spark.sparkContext.broadcast((ids, vectors)), k=k, scale=scale), _PAIRS)
        top = Window.partitionBy("q").orderBy("distance", "r")
        near = near.withColumn("n", F.row_number().over(top)).where(F.col("n") <= k).toPandas()  # k rows a sampled query
        far = np.concatenate([d[d > 0].ravel() for _, d in _distances(vectors, np.array(others["v"].tolist(), dtype=np.float64).reshape(len(others), -1))] or [np.ones(1)])
        plan = plan_tables(near["distance"].to_numpy(), far[:: max(1, len(far) // 4096)] if len(far) else np.ones(1), recall)
    hashed = both.select("cls", "role", "v").mapInArrow(partial(_hash, plan=plan, d=head["d"], seed=seed), "tab int, bucket long, cls long, role int, v array<double>")
    # large buckets are dealt as blocks of pairs; a row a bucket of more than BUCKET_ROWS, so their table is small beside the rows
    asks, given = F.col("role").bitwiseAND(1) > 0, F.col("role").bitwiseAND(2) > 0
    sizes = hashed.groupBy("tab", "bucket").agg(F.count_if(asks).alias("nq"), F.count_if(given).alias("nr"))
    blocks = [F.greatest(F.ceil(F.col(n) / BUCKET_ROWS), F.lit(1)).cast("int").alias(p) for n, p in (("nq", "qbs"), ("nr", "rbs"))]
    hot = sizes.where(F.greatest("nq", "nr") > BUCKET_ROWS).select("tab", "bucket", *blocks)
    dealt = hashed.join(F.broadcast(hot), ["tab", "bucket"], "left")
    block = [F.pmod(F.xxhash64("cls"), F.col(n)).cast("int") for n in ("qbs", "rbs")]
    place = "struct<qb: int, rb: int, role: int>"
    none = F.array().cast(f"array<{place}>")
    to_refs = F.when(asks, F.transform(F.sequence(F.lit(0), F.col("rbs") - 1), lambda i: F.struct(block[0], i, F.lit(1)).cast(place))).otherwise(none)
    to_asks = F.when(given, F.transform(F.sequence(F.lit(0), F.col("qbs") - 1), lambda i: F.struct(i, block[1], F.lit(2)).cast(place))).otherwise(none)
    whole = F.array(F.struct(F.lit(0), F.lit(0), F.col("role")).cast(place))
    dealt = dealt.select("tab", "bucket", "cls", "v", F.explode(F.when(F.col("qbs").isNull(), whole).otherwise(F.concat(to_refs, to_asks))).alias("p"))
    units = dealt.select("tab", "bucket", "p.qb", "p.rb", "cls", "p.role", "v")
    unit = ["tab", "bucket", "qb", "rb"]
    units = units.repartition(*unit).sortWithinPartitions(*unit, "cls")
    found = units.mapInArrow(partial(_compare, k=k, scale=scale), _PAIRS).groupBy("q", "r").agg(F.min("distance").alias("distance"))
    level = F.floor(F.col("distance") * F.lit(scale) + F.lit(0.5))
    order = Window.partitionBy("q").orderBy(level, "r")
    found = found.withColumn("n", F.row_number().over(order)).where(F.col("n") <= k)
    refs = both.where("ids is not null").select(F.col("cls").alias("r"), "ids")
    pairs = found.select("q", "r", "distance").join(refs, "r").select("q", "ids", "distance")
    own = both.where(F.col("role") == 3).select(F.col("cls").alias("q"), "ids", F.lit(0.0).alias("distance"))
    listed = pairs.unionByName(own).select("q", "distance", F.explode("ids").alias("id"))
    best = Window.partitionBy("q").orderBy(level, "id")
    listed = listed.withColumn("n", F.row_number().over(best)).where(F.col("n") <= k + 1).groupBy("q").agg(F.array_sort(F.collect_list(F.struct("n", "id", "distance"))).alias("near"))
    # a frequent vector's list goes to its members in several tasks
    members = q_rows.join(both.select("cls", "v"), "v").select("id", "cls", F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int").alias("_s"))
    lists = listed.select(F.col("q").alias("cls"), "near", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_s"))
    joined = members.join(lists, ["cls", "_s"])
    near = F.filter("near", lambda x: x["id"] != F.col("id")) if exclude_self else F.col("near")
    out = joined.select(F.col("id").alias("query_id"), F.posexplode(F.slice(near, 1, k)).alias("p", "x"))
    return out.select("query_id", F.col("x.id").alias("neighbor_id"), (F.col("p") + 1).alias("rank"), "x.distance")
