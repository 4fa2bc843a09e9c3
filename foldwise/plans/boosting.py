"""Histogram gradient boosting of all folds at once (M5-M8).

Features become bin codes once: quantile edges per fit fold come from one aggregate of mergeable
sketches, and blocks of codes and labels are checkpointed. From then on a level of the trees
of *all* folds is one scan: tasks send each row down its fold's tree, add gradient histograms
of the wanted nodes by (fold, feature, bin), and reducers that own a (fold, feature) find its best
split. The driver sees one row per fold, node and feature, and grows the trees.

Three ways to grow, as the usual libraries do:

* ``leaf``: best leaf first, up to a number of leaves. Leaves that the known gains would
  choose next are all looked at in the same scan, so a tree takes about as many scans as it
  is deep; what was looked at too early is dropped and the tree is that of the strict order.
* ``depth``: every node of a level, down to a depth.
* ``oblivious``: one split for all nodes of a level, the one with the largest summed gain.

Missing values (null or NaN) have a bin of their own and each split learns their side. Nominal
features (by the vector's metadata) are split into sets of categories ordered by gradient.
"""

from __future__ import annotations

import heapq
import math
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructType

from foldwise.operators.base import FIT_FOLD
from foldwise.session import cut_lineage, ship_package

#: Rows of a block, histogram cells (of 24 bytes) that a task holds in a scan, trees until the raw scores are written down.
BLOCK_ROWS = 16_384
SCAN_CELLS = 4_000_000
KEPT_TREES = 20
#: Ranks of the quantile sketches are exact up to this many rows and within n / ACCURACY beyond.
ACCURACY = 100_000


@dataclass(frozen=True)
class Settings:
    """What a boosting family is, besides its number of trees and learning rate."""

    growth: str = "depth"            # leaf | depth | oblivious
    n_estimators: int = 100
    learning_rate: float = 0.1
    max_depth: int | None = None
    max_leaves: int = 31
    min_samples: int = 1
    min_hessian: float = 0.0
    l2: float = 0.0
    min_gain: float = 0.0
    bins: int = 255

    def __post_init__(self):
        if self.growth not in ("leaf", "depth", "oblivious"):
            raise ValueError(f"unknown growth '{self.growth}'")
        if not 2 <= self.bins <= 65_000 or self.max_leaves < 2 or self.n_estimators < 0 or self.l2 < 0 or self.min_samples < 0:
            raise ValueError("bins from 2 to 65000, at least two leaves, no negative numbers")
        if self.growth != "leaf" and not self.max_depth:
            raise ValueError(f"{self.growth} growth needs max_depth")


@dataclass
class Split:
    gain: float
    feature: int
    left: np.ndarray                 # by code: whether it goes left
    left_sums: tuple[float, float, float]


@dataclass
class Node:
    depth: int
    sums: tuple[float, float, float]  # gradient, hessian, rows
    known: bool = False
    split: Split | None = None
    children: tuple[int, int] | None = None


class Growing:
    """A tree that grows; nodes are numbered by their path (1, then 2n and 2n + 1)."""

    def __init__(self, settings: Settings):
        self.s = settings
        self.nodes: dict[int, Node] = {1: Node(0, (0.0, 0.0, 0.0))}
        self.used: list[int] = []

    def splittable(self, n: int) -> bool:
        node = self.nodes[n]
        return n == 1 or ((self.s.max_depth is None or node.depth < self.s.max_depth) and (node.sums[2] >= 2 * self.s.min_samples and node.sums[2] >= 2 or self.s.growth == "oblivious"))

    def wanted(self) -> list[int]:
        """Nodes whose best split has to be found before the tree can go on; empty when it is done."""
        if self.s.growth != "leaf":
            self.used = [n for n, node in self.nodes.items() if node.children]
            return sorted(n for n, node in self.nodes.items() if not node.known and self.splittable(n))
        # best first with the gains known so far, as if unknown nodes had none
        self.used, heap, unknown = [], [], []

        def look(n):
            if self.nodes[n].split is not None:
                heapq.heappush(heap, (-_coarse(self.nodes[n].split.gain), n))
            elif not self.nodes[n].known and self.splittable(n):
                unknown.append(n)

        look(1)
        while heap and len(self.used) < self.s.max_leaves - 1:
            n = heapq.heappop(heap)[1]
            self.used.append(n)
            for c in self._split(n):
                look(c)
        # an unknown node may take the place of what was chosen after its parent, or have a place that is left
        full = len(self.used) == self.s.max_leaves - 1
        return sorted(n for n in unknown if not full or n >> 1 != self.used[-1])

    def _split(self, n: int) -> tuple[int, int]:
        node = self.nodes[n]
        if node.children is None:
            left = node.split.left_sums
            self.nodes[2 * n] = Node(node.depth + 1, left)
            self.nodes[2 * n + 1] = Node(node.depth + 1, tuple(a - b for a, b in zip(node.sums, left, strict=True)))
            node.children = 2 * n, 2 * n + 1
        return node.children

    def learn(self, found: dict[int, tuple[tuple, Split | None]]) -> None:
        """Sums and best splits of wanted nodes."""
        for n, (sums, split) in found.items():
            node = self.nodes[n]
            node.known = True
            if n == 1:
                node.sums = sums
            if split is not None and (split.gain > self.s.min_gain or self.s.growth == "oblivious"):
                node.split = split
                if self.s.growth != "leaf":
                    self._split(n)

    def finish(self, rate: float) -> "Tree":
        """The tree of the splits in use, with the values of its leaves."""
        tree, names = self.tree(set(self.used))
        for i, n in enumerate(names.tolist()):
            g, h, _ = self.nodes[n].sums
            tree.value[i] = -rate * g / (h + self.s.l2) if h + self.s.l2 > 0 else 0.0
        return tree

    def tree(self, split: set[int]) -> tuple["Tree", np.ndarray]:
        """The tree of those splits, and the path number of each of its nodes."""
        order, at = [1], {1: 0}
        for n in order:
            if n in split:
                for c in self.nodes[n].children:
                    at[c] = len(order)
                    order.append(c)
        width = max([len(self.nodes[n].split.left) for n in split], default=1)
        tree = Tree.empty(len(order), width)
        for n in split:
            i, by = at[n], self.nodes[n].split
            tree.feature[i], tree.left[i], tree.right[i] = by.feature, at[2 * n], at[2 * n + 1]
            tree.table[i, :len(by.left)] = by.left
        return tree, np.array(order, dtype=np.int64)

    def so_far(self) -> tuple["Tree", np.ndarray]:
        """The tree with everything that was split, wanted nodes among its leaves."""
        return self.tree({n for n, node in self.nodes.items() if node.children})


@dataclass
class Tree:
    """A tree as arrays; feature -1 is a leaf, table says by code whether a row goes left."""

    feature: np.ndarray
    left: np.ndarray
    right: np.ndarray
    table: np.ndarray
    value: np.ndarray

    @staticmethod
    def empty(n: int, width: int) -> "Tree":
        return Tree(np.full(n, -1, dtype=np.int32), np.zeros(n, dtype=np.int32), np.zeros(n, dtype=np.int32), np.zeros((n, width), dtype=bool), np.zeros(n))

    def leaves(self, codes: np.ndarray) -> np.ndarray:
        """Index of the leaf that each row (rows x features) falls into."""
        at = np.zeros(len(codes), dtype=np.int64)
        rows = np.arange(len(codes))
        while True:
            live = rows[self.feature[at[rows]] >= 0]
            if not len(live):
                return at
            node = at[live]
            left = self.table[node, codes[live, self.feature[node]]]
            at[live] = np.where(left, self.left[node], self.right[node])
            rows = live


def _coarse(x):
    """Numbers to nine significant digits, so that the order in which tasks were added up decides no tie."""
    x = np.asarray(x, dtype=np.float64)
    size = np.floor(np.log10(np.maximum(np.abs(x), 1e-300)))
    out = np.round(x / 10.0 ** (size - 8)) * 10.0 ** (size - 8)
    return float(out) if out.ndim == 0 else out


def _gains(hist: np.ndarray, s: Settings, free: bool) -> tuple[np.ndarray, np.ndarray]:
    """(gain, left sums) of sending the codes up to b left, for missing values (code 0) right, then left; by 2 x codes.

    Splits that break the limits have gain -inf; ``free``: without limits on the children."""
    total = hist.sum(axis=0)
    seen = np.cumsum(hist[1:], axis=0)
    left = np.stack([seen + hist[0], seen])      # missing left, missing right
    right = total - left

    def score(sums):
        h = sums[..., 1] + s.l2
        return np.where(h > 0, sums[..., 0] ** 2 / np.where(h > 0, h, 1), 0.0)

    gain = score(left) + score(right) - score(total)
    if not free:
        ok = (left[..., 2] >= max(s.min_samples, 1)) & (right[..., 2] >= max(s.min_samples, 1)) & (left[..., 1] >= s.min_hessian) & (right[..., 1] >= s.min_hessian)
        gain = np.where(ok, gain, -np.inf)
    return gain, left


def best_split(hist: np.ndarray, feature: int, nominal: bool, s: Settings) -> Split | None:
    """The best split of one node by one feature (hist: codes x (gradient, hessian, rows)); ties go to the lowest code, missing left."""
    if nominal:
        present = np.flatnonzero(hist[1:, 2] > 0) + 1
        order = present[np.argsort(_coarse(hist[present, 0] / (hist[present, 1] + s.l2 + 1e-12)), kind="stable")]
        hist = np.concatenate([hist[:1], hist[order]])
    if len(hist) < 2:
        return None
    gain, left = _gains(hist, s, False)
    coarse = _coarse(np.where(np.isfinite(gain), gain, -1.0))
    if coarse.max() <= 0:
        return None
    at = int(np.argmax(coarse.T))                # by code, then missing left before right
    code, side = at // 2, at % 2
    return Split(float(gain[side, code]), feature, _left_codes(code, side, order if nominal else None, s), tuple(left[side, code].tolist()))


def _left_codes(code: int, side: int, order, s: Settings) -> np.ndarray:
    out = np.zeros(s.bins + 1, dtype=bool)
    out[0] = side == 0
    out[(order[:code + 1] if order is not None else np.arange(1, code + 2))] = True
    return out


# ------------------------------------------------------------------ bins and blocks
def fold_edges(train: DataFrame, bins: int, nominal: dict[int, int], accuracy: int = ACCURACY) -> dict[int, list[np.ndarray]]:
    """{fit fold: ascending edges of each feature}: the distinct quantiles at 1/bins .. (bins - 1)/bins of the observed values, one aggregate for all folds.

    A value's code is 1 + the number of edges below it; nominal features have none."""
    x = F.posexplode(vector_to_array("features")).alias("feature", "x")
    points = [i / bins for i in range(1, bins)]
    found = train.select(FIT_FOLD, x).where(~F.isnan("x") & ~F.col("feature").isin(list(nominal))).groupBy(FIT_FOLD, "feature").agg(F.percentile_approx("x", points, accuracy).alias("q"))
    r = train.select(FIT_FOLD, F.size(vector_to_array("features")).alias("d")).groupBy(FIT_FOLD).agg(F.max("d").alias("d")).collect()
    out = {row[FIT_FOLD]: [np.zeros(0) for _ in range(row["d"])] for row in r}
    for row in found.collect():  # folds x features rows
        out[row[FIT_FOLD]][row["feature"]] = np.unique(np.array(row["q"], dtype=np.float64))
    return out


def codes_of(x: np.ndarray, edges: list[np.ndarray], nominal: dict[int, int], bins: int) -> np.ndarray:
    """rows x features codes: 0 for NaN, nominal index + 1 (unknown ones: 0), else 1 + edges below."""
    out = np.zeros(x.shape, dtype=np.uint16)
    for j in range(x.shape[1]):
        v = x[:, j]
        seen = ~np.isnan(v)
        if j in nominal:
            known = seen & (v >= 0) & (v < min(nominal[j], bins))
            out[known, j] = v[known].astype(np.uint16) + 1
        else:
            out[seen, j] = np.searchsorted(edges[j], v[seen], side="left") + 1
    return out


_BLOCK = f"{FIT_FOLD} int, codes binary, y binary, raw binary"


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("_x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)


def _encode(batches, edges, nominal, bins, base):
    """Blocks of one fold each: codes (feature-major), labels, raw scores."""
    held: dict[int, list] = {}

    def block(f):
        x, y = (np.concatenate(a) for a in zip(*held.pop(f), strict=True))
        codes = codes_of(x, edges.value[f], nominal, bins)
        return pa.RecordBatch.from_arrays([pa.array([f], pa.int32()), pa.array([codes.tobytes()], pa.binary()), pa.array([y.astype(np.float64).tobytes()], pa.binary()),
                                           pa.array([np.full(len(y), base[f]).tobytes()], pa.binary())], [FIT_FOLD, "codes", "y", "raw"])
    for batch in batches:
        if not batch.num_rows:
            continue
        x, y, folds = _matrix(batch), batch.column("label").to_numpy(zero_copy_only=False), batch.column(FIT_FOLD).to_numpy()
        for f in np.unique(folds):
            held.setdefault(int(f), []).append((x[folds == f], y[folds == f]))
            if sum(len(a[1]) for a in held[int(f)]) >= BLOCK_ROWS:
                yield block(int(f))
    for f in list(held):
        yield block(f)


def _blocks(batch: pa.RecordBatch, d: int):
    for row in batch.to_pylist():
        y = np.frombuffer(row["y"], np.float64)
        yield row[FIT_FOLD], np.frombuffer(row["codes"], np.uint16).reshape(len(y), d), y, np.frombuffer(row["raw"], np.float64)


def _gradients(y, raw, task):
    if task == "regression":
        return raw - y, np.ones(len(y))
    p = 1 / (1 + np.exp(-np.clip(raw, -500, 500)))
    return p - y, p * (1 - p)


def _histograms(batches, state, wanted, features, d, bins, task):
    """Per (fold, feature): histograms of the wanted nodes, added up over a task's blocks."""
    trees, growing = state.value
    held: dict[int, np.ndarray] = {}
    for batch in batches:
        for f, codes, y, raw in _blocks(batch, d):
            if not wanted.get(f):
                continue
            for t in trees[f]:
                raw = raw + t.value[t.leaves(codes)]
            tree, names = growing[f]
            slot = {n: i for i, n in enumerate(wanted[f])}
            place = np.array([slot.get(n, -1) for n in names.tolist()])[tree.leaves(codes)]
            rows = np.flatnonzero(place >= 0)
            g, h = _gradients(y[rows], raw[rows], task)
            cells = held.setdefault(f, np.zeros((len(features), len(slot), bins + 1, 3)))
            key = place[rows] * (bins + 1)
            for i, j in enumerate(features):
                at = key + codes[rows, j]
                for k, w in enumerate((g, h, None)):
                    cells[i, :, :, k] += np.bincount(at, w, minlength=len(slot) * (bins + 1)).reshape(len(slot), bins + 1)
    for f, cells in held.items():
        yield pa.RecordBatch.from_arrays([pa.array([f] * len(features), pa.int32()), pa.array(features, pa.int32()), pa.array([c.tobytes() for c in cells], pa.binary())], [FIT_FOLD, "feature", "cells"])


_CELLS = f"{FIT_FOLD} int, feature int, cells binary"
_FOUND = f"{FIT_FOLD} int, feature int, node long, gain double, left binary, left_g double, left_h double, left_n double, g double, h double, n double"


def _best(batches, wanted, bins, nominal, settings):
    """The best split of every wanted node by each (fold, feature) that this task owns."""
    held: dict[tuple[int, int], np.ndarray] = {}
    for batch in batches:
        for row in batch.to_pylist():
            key = row[FIT_FOLD], row["feature"]
            cells = np.frombuffer(row["cells"]).reshape(len(wanted[key[0]]), bins + 1, 3)
            held[key] = held[key] + cells if key in held else cells
    out = []
    for (f, j), cells in held.items():
        if settings.growth == "oblivious":
            # one split for all nodes of the level
            gains = [_gains(c, settings, True) for c in cells]
            total = _coarse(sum(np.where(np.isfinite(g), g, 0.0) for g, _ in gains))
            at = int(np.argmax(total.T))
            code, side = at // 2, at % 2
            good = total.max() > 0
            splits = [Split(float(total[side, code]), j, _left_codes(code, side, None, settings), tuple(left[side, code].tolist())) if good else None for _, left in gains]
        else:
            splits = [best_split(c, j, j in nominal, settings) for c in cells]
        for n, c, split in zip(wanted[f], cells, splits, strict=True):
            g, h, rows = c.sum(axis=0).tolist()
            left = split.left_sums if split else (0.0, 0.0, 0.0)
            out.append({FIT_FOLD: f, "feature": j, "node": n, "gain": split.gain if split else None, "left": split.left.tobytes() if split else None, "left_g": left[0], "left_h": left[1], "left_n": left[2], "g": g, "h": h, "n": rows})
    if out:
        yield pa.RecordBatch.from_pylist(out, pa.schema([(FIT_FOLD, pa.int32()), ("feature", pa.int32()), ("node", pa.int64()), ("gain", pa.float64()), ("left", pa.binary()), *[(c, pa.float64()) for c in ("left_g", "left_h", "left_n", "g", "h", "n")]]))


def _advance(batches, trees, d):
    """Blocks with the trees' values added to the raw scores."""
    for batch in batches:
        raws = []
        for f, codes, _, raw in _blocks(batch, d):
            for t in trees.value[f]:
                raw = raw + t.value[t.leaves(codes)]
            raws.append(raw.tobytes())
        names = batch.schema.names
        yield pa.RecordBatch.from_arrays([pa.array(raws, pa.binary()) if n == "raw" else batch.column(n) for n in names], names)


@dataclass
class Boosted:
    """Per fit fold: the base score, the edges and the trees."""

    base: dict[int, float]
    edges: dict[int, list[np.ndarray]]
    trees: dict[int, list[Tree]]
    nominal: dict[int, int]
    bins: int
    task: str
    scans: int = 0

    def predict(self, f: int, x: np.ndarray) -> np.ndarray:
        codes = codes_of(x, self.edges[f], self.nominal, self.bins)
        raw = np.full(len(x), self.base[f])
        for t in self.trees[f]:
            raw = raw + t.value[t.leaves(codes)]
        return raw if self.task == "regression" else 1 / (1 + np.exp(-np.clip(raw, -500, 500)))


def nominal_features(rows: DataFrame) -> dict[int, int]:
    """{position: categories} of the nominal features that the vector's metadata names."""
    attrs = (rows.schema["features"].metadata or {}).get("ml_attr", {}).get("attrs", {})
    return {a["idx"]: len(a.get("vals", [])) for a in attrs.get("nominal", [])}


def fit_boosting(train: DataFrame, settings: Settings, task: str, nominal: dict[int, int] | None = None, accuracy: int = ACCURACY) -> Boosted:
    """Boosted trees of every fit fold in train (fit_fold, label, features). Labels of a binary task are 0 and 1."""
    spark = train.sparkSession
    ship_package(spark)
    nominal = nominal_features(train) if nominal is None else nominal
    s = settings
    if any(n > s.bins for n in nominal.values()):
        s = Settings(**{**s.__dict__, "bins": max(nominal.values())})
    edges = fold_edges(train, s.bins, nominal, accuracy)
    means = {r[FIT_FOLD]: r["m"] for r in train.groupBy(FIT_FOLD).agg(F.avg(F.col("label").cast("double")).alias("m")).collect()}
    base = means if task == "regression" else {f: math.log(min(max(m, 1e-15), 1 - 1e-15) / (1 - min(max(m, 1e-15), 1 - 1e-15))) for f, m in means.items()}
    model = Boosted(base, edges, {f: [] for f in base}, nominal, s.bins, task)
    if not base:
        return model
    d = len(next(iter(edges.values())))
    held = spark.sparkContext.broadcast(edges)
    arrays = train.select(FIT_FOLD, F.col("label").cast("double").alias("label"), vector_to_array("features").alias("_x"))
    blocks = cut_lineage(arrays.mapInArrow(partial(_encode, edges=held, nominal=nominal, bins=s.bins, base=base), _BLOCK))
    since: dict[int, list[Tree]] = {f: [] for f in base}
    for _ in range(s.n_estimators):
        growing = {f: Growing(s) for f in base}
        while wanted := {f: nodes for f, g in growing.items() if (nodes := g.wanted())}:
            state = spark.sparkContext.broadcast((since, {f: g.so_far() for f, g in growing.items()}))
            # a scan adds up as many features as a task can hold cells of
            some = max(1, SCAN_CELLS // (sum(map(len, wanted.values())) * (s.bins + 1)))
            rows = []
            for lo in range(0, d, some):
                model.scans += 1
                parts = blocks.mapInArrow(partial(_histograms, state=state, wanted=wanted, features=list(range(lo, min(lo + some, d))), d=d, bins=s.bins, task=task), _CELLS)
                rows += parts.repartition(FIT_FOLD, "feature").mapInArrow(partial(_best, wanted=wanted, bins=s.bins, nominal=nominal, settings=s), _FOUND).collect()
            _learn(growing, rows)
            state.unpersist()
        for f, g in growing.items():
            tree = g.finish(s.learning_rate)
            model.trees[f].append(tree)
            since[f].append(tree)
        if len(next(iter(since.values()))) == KEPT_TREES:
            blocks = cut_lineage(blocks.mapInArrow(partial(_advance, trees=spark.sparkContext.broadcast(since), d=d), _BLOCK))
            since = {f: [] for f in base}
    return model


def _learn(growing: dict[int, Growing], rows) -> None:
    """Hand each tree the best split over the features; ties go to the first feature."""
    best: dict[tuple[int, int], tuple] = {}
    for r in sorted(rows, key=lambda r: r["feature"]):
        key = r[FIT_FOLD], r["node"]
        split = Split(r["gain"], r["feature"], np.frombuffer(r["left"], dtype=bool), (r["left_g"], r["left_h"], r["left_n"])) if r["gain"] is not None else None
        sums, have = best.get(key, ((r["g"], r["h"], r["n"]), None))
        if split is not None and (have is None or _coarse(split.gain) > _coarse(have.gain)):
            have = split
        best[key] = sums, have
    for f, g in growing.items():
        g.learn({n: v for (fold, n), v in best.items() if fold == f})


def _predict(batches, model, names):
    for batch in batches:
        x, folds = _matrix(batch), batch.column(FIT_FOLD).to_numpy()
        out = np.full(len(folds), np.nan)
        for f in np.unique(folds):
            if int(f) in model.value.base:
                out[folds == f] = model.value.predict(int(f), x[folds == f])
        yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(out)], [*names, "y_pred"])


def score_boosting(rows: DataFrame, model: Boosted) -> DataFrame:
    """rows (id, fit_fold, role, label) with y_pred by the trees of their fit fold."""
    names = ["id", FIT_FOLD, "role", "label"]
    kind = StructType([rows.schema[n] for n in names]).add("y_pred", DoubleType())
    held = rows.sparkSession.sparkContext.broadcast(model)
    return rows.select(*names, vector_to_array("features").alias("_x")).mapInArrow(partial(_predict, model=held, names=names), kind)
