"""Exact k-nearest-neighbour join.

Two exact strategies:

``blocked`` (default): planes through a bounded sample of the reference rows cut space into cells, and
every reference row goes to its cell. A query's k-th distance to the sampled rows of its cell bounds what it
looks for, so it goes to the cells within that distance only; the bound is a true one, so the sample decides
what is read but never the result. A cell is one co-grouped task (several, where it holds too many rows or queries)
that sorts its rows into small leaves of near ones, drops the leaves that are further than the k-th row found
so far, and measures the rest: by a product of matrices, and what is near enough again exactly. A final window
keeps the k best per query over its cells. Where few dimensions spread, the work is about that of sorting; where
no plane prunes (64-d embeddings), every query visits every cell, the inherent n x m of exact search.

``pivot``: triangle-inequality pruning, for low-dimensional or clustered data
where it skips most pairs (on isotropic high-dimensional data, e.g. 64-d
embeddings, it prunes almost nothing -- measured 0.4 % at 400 pivots).

1. ``m`` pivot vectors (the rows with the smallest seeded hash -- a top-m, not
   a sample) are inlined into the plan as a literal matrix; every row gets its
   distances to all pivots with higher-order array functions (no join), its
   cell (nearest pivot), and an upper bound ``u`` on its k-th neighbour
   distance: the (k+1)-th smallest pivot distance (pivots are data points;
   the +1 covers a row being a pivot itself).
2. Each cell's radius R_c (max member-to-pivot distance) is one small aggregate.
3. By the triangle inequality a row y in cell c is at least d(x, p_c) - R_c
   away from x, so x only visits cells with d(x, p_c) - R_c <= u(x). Those
   (x, cell) pairs are joined to the cell members on the cell id, exact
   distances are computed, and the k best per query (ties by neighbour id)
   are kept with a window partitioned by query.

The result is exact; the pruning only decides which pairs are ever formed.
"""

from __future__ import annotations

import math
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foldwise.session import ship_package

#: Vectors of one block, as doubles; a task holds a query block and a reference block.
BLOCK_BYTES = 32 << 20
#: Distances of one product of matrices: a task holds a few arrays of this many doubles.
PRODUCT_CELLS = 4 << 20
#: Most rows and bytes of the sample that the planes go through, and the fewest sampled rows of a cell.
PLANE_ROWS, PLANE_BYTES, CELL_SAMPLE = 8192, 16 << 20, 16
#: Rows of a leaf and queries that are compared with the same leaves, inside a task.
LEAF_ROWS, GROUP_ROWS = 128, 64
_PAIRS = "q_id long, r_id long, distance double"


def sq_dist(a: Column, b: Column) -> Column:
    """Squared Euclidean distance of two numeric arrays (double arithmetic)."""
    diffs = F.zip_with(a, b, lambda x, y: (x.cast("double") - y.cast("double")) * (x.cast("double") - y.cast("double")))
    return F.aggregate(diffs, F.lit(0.0), lambda acc, v: acc + v)


def knn_join(data: DataFrame, id_col: str, vec_col: str, k: int = 5, *, method: str = "blocked",
             queries: DataFrame | None = None, exclude_self: bool = True, tie_digits: int = 9,
             block_rows: int | None = None, seed: int = 42, n_pivots: int | None = None) -> DataFrame:
    if method == "blocked":
        return knn_blocked(data, id_col, vec_col, k, queries=queries, exclude_self=exclude_self,
                           tie_digits=tie_digits, block_rows=block_rows)
    return knn_pivot(data, id_col, vec_col, k, seed=seed, n_pivots=n_pivots, queries=queries,
                     exclude_self=exclude_self, tie_digits=tie_digits)


def _vectors(column: pa.Array | pa.ChunkedArray, n: int) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(n, -1)


class Cells:
    """Space cut by planes at medians of sampled rows, each across the dimension that spreads most; the sampled rows of a cell follow each other."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, most: int):
        self.lo, self.hi, self.planes, spans = [], [], {}, []
        d = rows.shape[1]
        todo = [(1, np.arange(len(rows)), np.full(d, -np.inf), np.full(d, np.inf), max(1, most))]
        while todo:
            node, at, lo, hi, parts = todo.pop()
            x = rows[at]
            spread = x.max(axis=0) - x.min(axis=0) if len(x) else np.zeros(d)
            if parts == 1 or len(at) < 2 * CELL_SAMPLE or not spread.max(initial=0.0) > 0:
                self.planes[node] = len(self.lo)
                self.lo.append(lo)
                self.hi.append(hi)
                spans.append(at)
                continue
            j = int(np.argmax(spread))
            values = np.sort(x[:, j])
            cut = values[int(len(values) * (parts // 2) / parts)]
            if cut == values[-1]:
                cut = values[values < cut][-1]
            below = x[:, j] <= cut
            self.planes[node] = (j, cut)
            todo.append((2 * node, at[below], lo, np.where(np.arange(d) == j, cut, hi), parts // 2))
            todo.append((2 * node + 1, at[~below], np.where(np.arange(d) == j, cut, lo), hi, parts - parts // 2))
        self.lo, self.hi = np.array(self.lo), np.array(self.hi)
        self.starts = np.cumsum([0, *map(len, spans)])
        self.ids, self.rows = ids[np.concatenate(spans)], rows[np.concatenate(spans)]

    def of(self, x: np.ndarray) -> np.ndarray:
        """The cell of every row."""
        out = np.zeros(len(x), dtype=np.int32)
        todo = [(1, np.arange(len(x)))]
        while todo:
            node, at = todo.pop()
            plane = self.planes[node]
            if not isinstance(plane, tuple):
                out[at] = plane
            elif len(at):
                below = x[at, plane[0]] <= plane[1]
                todo += [(2 * node, at[below]), (2 * node + 1, at[~below])]
        return out

    def reach(self, ids: np.ndarray, x: np.ndarray, k: int, slack: float, exclude_self: bool) -> np.ndarray:
        """At least the distance of every row's k-th neighbour (ties by ``slack`` included), by the sampled rows of its cell."""
        out = np.full(len(x), np.inf)
        mine = self.of(x)
        order = np.argsort(mine, kind="stable")
        for at in np.split(order, np.flatnonzero(np.diff(mine[order])) + 1):
            if not len(at):
                continue
            lo, hi = self.starts[mine[at[0]]], self.starts[mine[at[0]] + 1]
            if hi - lo <= k:
                lo, hi = 0, len(self.rows)
            step = max(1, PRODUCT_CELLS // max(1, hi - lo))
            for s in range(0, len(at), step):
                some = at[s:s + step]
                near, err = _rough(x[some], self.rows[lo:hi])
                if exclude_self:
                    near[ids[some, None] == self.ids[None, lo:hi]] = np.inf
                if near.shape[1] >= k:
                    out[some] = np.sqrt(np.maximum(np.partition(near, k - 1, axis=1)[:, k - 1] + err, 0.0)) + slack
        return out

    def visits(self, x: np.ndarray, reach: np.ndarray):
        """(row, cell) for every cell within reach of a row."""
        step = max(1, PRODUCT_CELLS // max(1, self.lo.size))
        for s in range(0, len(x), step):
            part = x[s:s + step, None, :]
            gap = np.maximum(np.maximum(self.lo - part, part - self.hi), 0.0)
            row, cell = np.nonzero(~(np.sqrt(np.einsum("ijk,ijk->ij", gap, gap)) > reach[s:s + step, None] * (1 + 1e-12)))
            yield row + s, cell.astype(np.int32)


def _rough(q: np.ndarray, r: np.ndarray, top: float | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Squared distances by a product of matrices, and how far they may be off, a query."""
    qq, rr = np.einsum("ij,ij->i", q, q), np.einsum("ij,ij->i", r, r)
    top = rr.max(initial=0.0) if top is None else top
    return qq[:, None] + rr[None, :] - 2.0 * (q @ r.T), 4.0 * (r.shape[1] + 4) * np.finfo(np.float64).eps * (qq + top)


def _finite(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """(ids, vectors) of a batch; a vector with a component that is no number is near to nothing."""
    x = _vectors(batch.column("v"), batch.num_rows)
    ok = np.isfinite(x).all(axis=1)
    return batch.column("id").to_numpy()[ok], x[ok]


def _table(cell, ids, x) -> pa.RecordBatch:
    offsets = np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]
    return pa.RecordBatch.from_arrays([pa.array(cell, pa.int32()), pa.array(ids, pa.int64()), pa.ListArray.from_arrays(pa.array(offsets), pa.array(x.ravel()))], ["cell", "id", "v"])


def _place(batches, cells):
    """Every reference row with its cell."""
    for batch in batches:
        if batch.num_rows:
            ids, x = _finite(batch)
            yield _table(cells.value.of(x), ids, x)


def _visit(batches, cells, k, slack, exclude_self):
    """Every query once a cell that may hold one of its neighbours."""
    for batch in batches:
        if batch.num_rows:
            ids, x = _finite(batch)
            for row, cell in cells.value.visits(x, cells.value.reach(ids, x, k, slack, exclude_self)):
                yield _table(cell, ids[row], x[row])


def _leaves(x: np.ndarray, size: int) -> list[np.ndarray]:
    """Rows in parts of at most ``size`` near ones: halves across the dimension that spreads most."""
    out, todo = [], [np.arange(len(x))]
    while todo:
        at = todo.pop()
        if len(at) <= size:
            out.append(at)
            continue
        part = x[at]
        half = len(at) // 2
        order = np.argpartition(part[:, int(np.argmax(part.max(axis=0) - part.min(axis=0)))], half)
        todo += [at[order[:half]], at[order[half:]]]
    return out


def _best(q, r, qid, rid, qi, ri, k, scale):
    """Of candidate pairs (places qi, ri): the k nearest of every query by exact distance, ties by id, as (qi, ri, distance)."""
    d = np.empty(len(qi))
    step = max(1, PRODUCT_CELLS // q.shape[1])
    for s in range(0, len(qi), step):
        diff = q[qi[s:s + step]] - r[ri[s:s + step]]
        d[s:s + step] = np.sqrt(np.einsum("jk,jk->j", diff, diff))
    ok = np.isfinite(d)
    qi, ri, d = qi[ok], ri[ok], d[ok]
    order = np.lexsort((rid[ri], np.floor(d * scale + 0.5), qi))
    qi, ri, d = qi[order], ri[order], d[order]
    first = np.searchsorted(qi, qi, side="left")
    keep = np.arange(len(qi)) - first < k
    return qi[keep], ri[keep], d[keep]


def nearest(qid: np.ndarray, q: np.ndarray, rid: np.ndarray, r: np.ndarray, k: int, scale: float, exclude_self: bool):
    """The k nearest of r for every row of q (ties after rounding by id), as (q id, r id, distance) arrays."""
    leaves = _leaves(r, LEAF_ROWS)
    place = np.concatenate(leaves)
    r, rid = r[place], rid[place]
    ends = np.cumsum([len(a) for a in leaves])
    starts = ends - [len(a) for a in leaves]
    lo, hi = np.minimum.reduceat(r, starts), np.maximum.reduceat(r, starts)
    top = np.einsum("ij,ij->i", r, r).max()
    out = []
    for group in _leaves(q, GROUP_ROWS):
        x, ids = q[group], qid[group]
        gap = np.maximum(np.maximum(lo - x.max(axis=0), x.min(axis=0) - hi), 0.0)
        gap = np.sqrt(np.einsum("ij,ij->i", gap, gap))
        order = np.argsort(gap, kind="stable")
        best, reach = np.full((len(x), k), np.inf), np.full(len(x), np.inf)
        held, at, take = [], 0, 4
        while at < len(order) and not gap[order[at]] > reach.max() * (1 + 1e-12):
            some = order[at:at + take]
            some = some[~(gap[some] > reach.max() * (1 + 1e-12))]
            at, take = at + take, max(4, min(2 * take, PRODUCT_CELLS // (LEAF_ROWS * len(x))))
            rows = np.concatenate([np.arange(starts[i], ends[i]) for i in some])
            near, err = _rough(x, r[rows], top)
            if exclude_self:
                near[ids[:, None] == rid[None, rows]] = np.inf
            best = np.partition(np.concatenate([best, near], axis=1), k - 1, axis=1)[:, :k]
            # the exact k-th distance is at most sqrt(kth + err); ties reach a step of the rounding further
            reach = np.sqrt(np.maximum(best[:, k - 1] + err, 0.0)) + 2.0 / scale
            qi, ri = np.nonzero(~(near > (reach ** 2 + err)[:, None]))
            if exclude_self:
                other = ids[qi] != rid[rows[ri]]
                qi, ri = qi[other], ri[other]
            held.append((qi, rows[ri]))
            if sum(len(a) for a, _ in held) > PRODUCT_CELLS // 4:
                held = [_best(x, r, ids, rid, *(np.concatenate(a) for a in zip(*held, strict=True)), k, scale)[:2]]
        if held:
            qi, ri, d = _best(x, r, ids, rid, *(np.concatenate(a) for a in zip(*held, strict=True)), k, scale)
            out.append((ids[qi], rid[ri], d))
    return [np.concatenate(a) for a in zip(*out, strict=True)] if out else [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]


def _unit(key, asked: pa.Table, given: pa.Table, k: int, scale: float, exclude_self: bool) -> pa.Table:
    found = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
    if asked.num_rows and given.num_rows:
        q, r = (_vectors(t.column("v"), t.num_rows) for t in (asked, given))
        found = nearest(asked.column("id").to_numpy(), q, given.column("id").to_numpy(), r, k, scale, exclude_self)
    return pa.table([pa.array(found[0], pa.int64()), pa.array(found[1], pa.int64()), pa.array(found[2], pa.float64())], ["q_id", "r_id", "distance"])


def knn_blocked(data: DataFrame, id_col: str, vec_col: str, k: int = 5, *, queries: DataFrame | None = None,
                exclude_self: bool = True, tie_digits: int = 9, block_rows: int | None = None) -> DataFrame:
    """Blocked exact kNN (see module doc). block_rows defaults to what BLOCK_BYTES of vectors hold."""
    spark = data.sparkSession
    ship_package(spark)
    scale = float(10 ** tie_digits)
    known = F.col("id").isNotNull() & F.col("v").isNotNull()
    given, asked = (df.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("v")).where(known)
                    for df in (data, queries if queries is not None else data))
    n_ref, d = given.agg(F.count(F.lit(1)), F.max(F.size("v"))).first()
    if not n_ref:
        return spark.createDataFrame([], "query_id long, neighbor_id long, rank int, distance double")
    block_rows = block_rows or max(1024, BLOCK_BYTES // (8 * max(1, d)))
    par = spark.sparkContext.defaultParallelism
    # a bounded sample by hash: it only places the planes and bounds what a query visits
    sample = given.orderBy(F.xxhash64("id", F.lit(29)), "id").limit(max(64, min(PLANE_ROWS, PLANE_BYTES // (8 * max(1, d))))).toPandas()
    rows = np.array(sample["v"].tolist(), dtype=np.float64).reshape(len(sample), -1)
    ok = np.isfinite(rows).all(axis=1)
    wanted = max(-(-2 * n_ref // block_rows), min(par, n_ref // (2 * LEAF_ROWS)), 1)
    cells = spark.sparkContext.broadcast(Cells(sample["id"].to_numpy()[ok], rows[ok], wanted))
    schema = "cell int, id long, v array<double>"
    placed = given.mapInArrow(partial(_place, cells=cells), schema)
    visits = asked.mapInArrow(partial(_visit, cells=cells, k=k, slack=2.0 / scale, exclude_self=exclude_self), schema)
    # cells with more rows or queries than a block are dealt to several tasks; a row a cell, no more than the sample has
    n_rows, n_asked = ({r["cell"]: r["count"] for r in df.groupBy("cell").count().collect()} for df in (placed, visits))
    dealt = [(c, -(-n_rows.get(c, 0) // block_rows), -(-n_asked.get(c, 0) // block_rows)) for c in {*n_rows, *n_asked} if max(n_rows.get(c, 0), n_asked.get(c, 0)) > block_rows]
    if dealt:
        parts = F.broadcast(spark.createDataFrame(dealt, "cell int, rbs int, qbs int"))
        placed, visits = (df.join(parts, "cell", "left") for df in (placed, visits))

    def units(df, own, other, seed):
        if not dealt:
            return df.select("cell", F.lit(0).alias("qb"), F.lit(0).alias("rb"), "id", "v")
        names = {"qbs": "qb", "rbs": "rb"}
        mine = F.pmod(F.xxhash64("id", F.lit(seed)), F.greatest(F.coalesce(F.col(own), F.lit(1)), F.lit(1))).cast("int")
        each = F.explode(F.sequence(F.lit(0), F.greatest(F.coalesce(F.col(other), F.lit(1)), F.lit(1)) - 1))
        return df.select("cell", mine.alias(names[own]), each.alias(names[other]), "id", "v").select("cell", "qb", "rb", "id", "v")

    unit = ["cell", "qb", "rb"]
    asked, given = units(visits, "qbs", "rbs", 17), units(placed, "rbs", "qbs", 29)
    pairs = asked.groupBy(*unit).cogroup(given.groupBy(*unit)).applyInArrow(lambda key, a, b: _unit(key, a, b, k, scale, exclude_self), _PAIRS)
    pairs = pairs.withColumn("_dr", F.floor(F.col("distance") * F.lit(scale) + F.lit(0.5)))
    w = Window.partitionBy("q_id").orderBy("_dr", "r_id")
    return (pairs.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
            .select(F.col("q_id").alias("query_id"), F.col("r_id").alias("neighbor_id"), "rank", "distance"))


def knn_pivot(data: DataFrame, id_col: str, vec_col: str, k: int = 5, *, seed: int = 42,
              n_pivots: int | None = None, queries: DataFrame | None = None, exclude_self: bool = True,
              tie_digits: int = 9) -> DataFrame:
    """(query_id, neighbor_id, rank, distance) for the k nearest reference rows.

    ``queries`` defaults to ``data`` itself (self join, own row excluded).
    Distances are compared after rounding to ``tie_digits`` decimals, so rows
    at equal distance up to floating noise are ordered by id.
    """
    queries = queries if queries is not None else data
    n = data.count()
    m = n_pivots or max(k + 1, min(256, int(math.sqrt(max(n, 1))) + 1))
    if m < k + 1:
        raise ValueError("need at least k + 1 pivots")
    h = F.sha2(F.concat_ws(":", F.lit(seed), F.col(id_col).cast("string")), 256)
    piv_rows = data.select(id_col, vec_col, h.alias("_h")).orderBy("_h", id_col).limit(m).collect()  # m rows
    pivots = F.array(*[F.array(*[F.lit(float(v)) for v in r[vec_col]]) for r in piv_rows])

    def pivot_dists(vec: Column) -> Column:
        return F.transform(pivots, lambda p: F.sqrt(sq_dist(p, vec)))

    ref = data.select(F.col(id_col).alias("r_id"), F.col(vec_col).alias("r_vec")).withColumn(
        "_pd", pivot_dists(F.col("r_vec")))
    ref = ref.withColumn("_md", F.array_min("_pd")).withColumn(
        "cell", F.array_position("_pd", F.col("_md")).cast("int")).drop("_pd")
    radius = ref.groupBy("cell").agg(F.max("_md").alias("radius"))       # <= m rows
    radii = F.broadcast(radius)

    q = queries.select(F.col(id_col).alias("q_id"), F.col(vec_col).alias("q_vec")).withColumn(
        "_pd", pivot_dists(F.col("q_vec")))
    q = q.withColumn("_u", F.element_at(F.array_sort("_pd"), k + 1))
    cand = q.select("q_id", "q_vec", "_u", F.posexplode("_pd").alias("_pos", "_dp")) \
        .withColumn("cell", (F.col("_pos") + 1).cast("int")) \
        .join(radii, "cell") \
        .where(F.col("_dp") - F.col("radius") <= F.col("_u") * F.lit(1.0 + 1e-9) + F.lit(1e-12)) \
        .select("q_id", "q_vec", "cell")
    pairs = cand.join(ref.select("r_id", "r_vec", "cell"), "cell")
    if exclude_self:
        pairs = pairs.where(F.col("q_id") != F.col("r_id"))
    d = F.sqrt(sq_dist(F.col("q_vec"), F.col("r_vec")))
    scale = float(10 ** tie_digits)
    pairs = pairs.select("q_id", "r_id", d.alias("distance")).withColumn(
        "_dr", F.floor(F.col("distance") * F.lit(scale) + F.lit(0.5)))
    w = Window.partitionBy("q_id").orderBy("_dr", "r_id")
    return (pairs.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
            .select(F.col("q_id").alias("query_id"), F.col("r_id").alias("neighbor_id"), "rank", "distance"))


def knn_predict(neighbors: DataFrame, labels: DataFrame, id_col: str, label_col: str,
                weights: str = "uniform") -> DataFrame:
    """M9: average (or 1/distance-weighted average) of the neighbours' labels."""
    j = neighbors.join(labels.select(F.col(id_col).alias("neighbor_id"), F.col(label_col).cast("double").alias("_y")),
                       "neighbor_id")
    if weights == "distance":
        w = F.try_divide(F.lit(1.0), F.col("distance"))
        zero = F.count_if(F.col("distance") == 0)
        return j.groupBy("query_id").agg(
            F.when(zero > 0, F.avg(F.when(F.col("distance") == 0, F.col("_y"))))
            .otherwise(F.try_divide(F.sum(w * F.col("_y")), F.sum(w))).alias("y_pred"))
    return j.groupBy("query_id").agg(F.avg("_y").alias("y_pred"))
