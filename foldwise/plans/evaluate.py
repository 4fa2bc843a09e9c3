"""Cross-validated evaluation.

The representation is fitted for every fold at once (fold-complement statistics).
A fold's model is fitted on one projection of the unexpanded rows with that fold's
values, so a fold reads the table once and nothing is copied k times or cached.
Folds run concurrently from a small driver thread pool (they are independent Spark
jobs), as many as the executors' memory holds the cached rows of (``folds_at_once``). Out-of-fold rows are predicted once; test rows once per fold and averaged.
"""

from __future__ import annotations

import math
import time
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

from foldwise.functions.scalar import ACCURACY_THRESHOLD
from foldwise.operators.base import FIT_FOLD, Fitted
from foldwise.plans.models import DIRECT_FEATURES, ModelFamily
from foldwise.session import checkpoint_dir


def assemble(feat: DataFrame, names: list[str]) -> DataFrame:
    return VectorAssembler(inputCols=names, outputCol="features", handleInvalid="keep").transform(feat)


class FoldFeatures:
    """The features of one fit fold (call), or of all folds in one plan (``all_folds``), of a fitted operator
    over a table. Lookup tables, sized by categories, stay cached until ``release``."""

    def __init__(self, fitted: Fitted, rows: DataFrame, k: int, keep: list[str], fold_col: str = "fold"):
        self.fitted, self.tables = fitted.with_cached_lookups()
        self.rows, self.k, self.keep, self.fold_col = rows, k, keep, fold_col

    def __call__(self, f: int) -> DataFrame:
        return self.fitted.transform(self.rows, self.k, self.keep, self.fold_col, f)

    def all_folds(self) -> DataFrame:
        return self.fitted.transform(self.rows, self.k, self.keep, self.fold_col)

    def release(self) -> None:
        for t in self.tables:
            t.unpersist()

    def store(self) -> StoredFeatures:
        """The feature vectors of all folds, written once for many models: the lookups are joined once, and
        models read the vectors of their fold only."""
        out = StoredFeatures.write(assemble(self.all_folds(), self.fitted.names()).select(*self.keep, "features"), len(self.fitted.names()))
        self.release()
        return out


class StoredFeatures:
    """The vector column ``features`` of all folds in a table partitioned by fit fold."""

    def __init__(self, table: DataFrame, width: int):
        self.table, self.width = table, width
        self._train_rows: int | None = None

    @staticmethod
    def write(table: DataFrame, width: int) -> StoredFeatures:
        path = f"{checkpoint_dir(table.sparkSession).rstrip('/')}/features-{uuid.uuid4().hex}"
        table.write.partitionBy(FIT_FOLD).parquet(path)
        return StoredFeatures(table.sparkSession.read.parquet(path).select(*table.columns), width)

    def __call__(self, f: int) -> DataFrame:
        return self.table.where(F.col(FIT_FOLD) == f)

    def all_folds(self) -> DataFrame:
        return self.table

    def train_rows(self) -> int:
        """Rows of one fit; the fits of a table have about as many each."""
        if self._train_rows is None:
            self._train_rows = self(1).where(F.col("role") == "train").count()
        return self._train_rows

    def release(self) -> None:
        """Nothing is cached; the files stay as the results read them."""


def fold_rows(feat: DataFrame | Callable[[int], DataFrame], f: int) -> DataFrame:
    """The features of fit fold f: from a function of the fold, or from a table of all folds."""
    return feat(f) if callable(feat) else feat.where(F.col(FIT_FOLD) == f)


#: Bytes of a row that an estimator's fit caches, beside 4 for each feature and tree: its binned point with object headers, weight, label and error.
ROW_BYTES = 200


def storage_bytes(spark: SparkSession) -> int:
    """Memory that the block managers may cache in."""
    found, out = spark.sparkContext._jsc.sc().getExecutorMemoryStatus().valuesIterator(), 0
    while found.hasNext():
        out += found.next()._1()
    return out


def folds_at_once(spark: SparkSession, feat, family: ModelFamily, params: dict, k: int, share: int = 1) -> int:
    """Folds whose fits run side by side. A fit reads its cached rows in every pass; folds that don't fit into half of the storage memory
    together would push each other's rows out, to be read or made again in each. ``share``: cross-validations in flight."""
    if family.build is None or not isinstance(feat, StoredFeatures):
        return k
    trees = int(params.get("n_estimators", 100)) if family.name == "random_forest" else 1
    need = feat.train_rows() * (ROW_BYTES + 4 * (feat.width + trees))
    return max(1, min(k, storage_bytes(spark) // 2 // max(1, need * share)))


def cross_validate(feat: DataFrame | Callable[[int], DataFrame], names: list[str] | None, label: str, family: ModelFamily, k: int,
                   params: dict | None = None, score_only: bool = False, parallel: int | None = None, share: int = 1) -> DataFrame:
    """V5/V6/V8/V9: per-fold fit and predict.

    ``feat``: (id, fit_fold, role, label, features...) of a fitted representation,
    best as a function of the fit fold; with ``names`` None it has the vector column
    ``features`` already. Returns (id, fit_fold, role, y_true, y_pred) for valid rows
    (and test rows unless ``score_only``). Binary families yield P(positive).
    """
    params = family.resolve_params(params)
    roles = ["valid"] if score_only else ["valid", "test"]

    def prepared(rows: DataFrame) -> DataFrame:
        data = rows.withColumn("label", F.col(label).cast("double"))
        return (data if names is None or "features" in data.columns else assemble(data, names)).select("id", FIT_FOLD, "role", "label", "features")

    if family.all_folds and names is not None and len(names) <= DIRECT_FEATURES and (isinstance(feat, DataFrame) or hasattr(feat, "all_folds")):
        # one plan for all folds
        data = prepared(feat if isinstance(feat, DataFrame) else feat.all_folds())
        scored = family.scores(data.where(F.col("role") == "train"), data.where(F.col("role").isin(*roles)), params)
        return scored.select("id", FIT_FOLD, "role", F.col("label").alias("y_true"), "y_pred")

    def one(f: int) -> DataFrame:
        data = prepared(fold_rows(feat, f))
        tr, rows = data.where(F.col("role") == "train"), data.where(F.col("role").isin(*roles))
        if family.scores is not None:
            scored = family.scores(tr, rows, params)
        else:
            scored = family.build(tr, params).fit(tr).transform(rows)
            binary = family.task == "binary"
            scored = scored.withColumn("y_pred", vector_to_array("probability").getItem(1) if binary else F.col("prediction"))
        return scored.select("id", F.lit(f).alias(FIT_FOLD), "role", F.col("label").alias("y_true"), "y_pred")

    parallel = parallel or folds_at_once(SparkSession.active(), feat, family, params, k, share)
    with ThreadPoolExecutor(max_workers=parallel) as pool:
        # the folds' jobs belong to the caller's job group and pool; every thread has properties of its own
        started = [pool.submit(inheritable_thread_target(SparkSession.active())(one), f) for f in range(1, k + 1)]
        parts = [s.result() for s in started]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@dataclass(frozen=True)
class Candidate:
    """One configured candidate of a batch: a family with its parameters over a feature table."""

    candidate_id: str
    family: ModelFamily
    params: dict
    matrix_kind: str = "dense"


def run_batch(candidates: list[Candidate], feat, names: list[str], label: str, k: int, metric: str, done: frozenset = frozenset(),
              screening: bool = False) -> tuple[DataFrame | None, list[tuple]]:
    """Candidates in order. Returns (OOF of those that ran, long by candidate_id, or None) and a
    row (candidate_id, status, message, seconds) for each: a finished one is skipped, an incompatible
    or failing one is recorded and the next runs. ``screening`` scores on the first two folds' models only."""
    from foldwise.plans import metrics as mt
    from foldwise.plans.models import check_compatibility
    out, said = None, []
    for c in candidates:
        began = time.time()
        if c.candidate_id in done:
            said.append((c.candidate_id, "skipped", "exists already", 0.0))
            continue
        try:
            check_compatibility(c.family, c.matrix_kind)
            part = oof(cross_validate(feat, names, label, c.family, min(k, 2) if screening else k, c.params, score_only=True))
            part = part.withColumn("candidate_id", F.lit(c.candidate_id))
            mean = mt.cv_summary(mt.fold_metrics(part, metric)).first()["cv_mean"]
        except Exception as e:  # noqa: BLE001 - one candidate's failure is recorded, the batch goes on
            said.append((c.candidate_id, "failed", f"{type(e).__name__}: {e}"[:300], time.time() - began))
            continue
        said.append((c.candidate_id, "trained", f"{metric}={mean!r}", time.time() - began))
        out = part if out is None else out.unionByName(part)
    return out, said


def oof(preds: DataFrame) -> DataFrame:
    """V6: each training row predicted by the model that did not see it."""
    return preds.where(F.col("role") == "valid").select("id", F.col(FIT_FOLD).alias("fold"), "y_true", "y_pred")


def test_predictions(preds: DataFrame, metric: str | None = None) -> DataFrame:
    """V7: mean over folds; rmsle clips at 0; accuracy -> label + probability."""
    t = preds.where(F.col("role") == "test").groupBy("id").agg(F.avg("y_pred").alias("y_pred"))
    if metric == "rmsle":
        t = t.withColumn("y_pred", F.greatest("y_pred", F.lit(0.0)))
    if metric == "accuracy":
        t = t.withColumn("label", (F.col("y_pred") >= F.lit(ACCURACY_THRESHOLD)).cast("int"))
    return t


# ---------------------------------------------------------------- Gaussian naive Bayes
def gaussian_nb_scores(train: DataFrame, rows: DataFrame, var_smoothing: float = 1e-9) -> DataFrame:
    """M10 on a vector column ``features``: P(class 1) of rows, from the class statistics of train."""
    d = len(train.select("features").first()["features"])
    names = [f"x{i}" for i in range(d)]
    wide = [df.select("id", "role", "label", *[vector_to_array("features").getItem(i).alias(n) for i, n in enumerate(names)], F.lit(0).alias(FIT_FOLD)) for df in (train, rows)]
    both = wide[0].unionByName(wide[1])
    return gaussian_nb(both, names, "label", var_smoothing).select("id", "role", F.col("y_true").alias("label"), "y_pred")


def gaussian_nb(feat: DataFrame, names: list[str], label: str, var_smoothing: float = 1e-9) -> DataFrame:
    """Closed-form Gaussian NB per fit fold, fully in DataFrame expressions.

    Class priors, per-class means and population variances come from one
    grouped aggregate over the fit's training rows; variances get
    ``var_smoothing * max_j var(X_j)`` added. Returns (id, fit_fold, role,
    y_true, y_pred = P(class 1)) for valid and test rows.
    """
    y = F.col(label).cast("double")
    tr = feat.where(F.col("role") == "train")
    cls = tr.groupBy(FIT_FOLD, y.alias("cls")).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.avg(c).alias(f"mu_{i}") for i, c in enumerate(names)],
        *[F.var_pop(c).alias(f"var_{i}") for i, c in enumerate(names)])
    allv = tr.groupBy(FIT_FOLD).agg(F.count(F.lit(1)).alias("n_all"),
                                   F.greatest(*[F.var_pop(c) for c in names]).alias("vmax"))
    stats = cls.join(allv, FIT_FOLD)
    # (k folds x 2 classes) rows: bounded; pivot to one row per fold.
    per = []
    for c in (0.0, 1.0):
        s = stats.where(F.col("cls") == c)
        sel = [F.col(FIT_FOLD), F.log(F.col("n") / F.col("n_all")).alias(f"lp_{int(c)}")]
        for i in range(len(names)):
            v = F.col(f"var_{i}") + F.lit(var_smoothing) * F.col("vmax")
            sel += [F.col(f"mu_{i}").alias(f"mu{int(c)}_{i}"), v.alias(f"v{int(c)}_{i}")]
        per.append(s.select(*sel))
    model = per[0].join(per[1], FIT_FOLD)
    rows = feat.where(F.col("role").isin("valid", "test")).join(F.broadcast(model), FIT_FOLD)

    def jll(c: int):
        t = F.col(f"lp_{c}")
        for i, n in enumerate(names):
            v = F.col(f"v{c}_{i}")
            d = F.col(n) - F.col(f"mu{c}_{i}")
            t = t - F.lit(0.5) * F.log(F.lit(2.0 * math.pi) * v) - F.lit(0.5) * d * d / v
        return t
    p1 = F.lit(1.0) / (F.lit(1.0) + F.exp(jll(0) - jll(1)))
    return rows.select("id", FIT_FOLD, "role", y.alias("y_true"), p1.alias("y_pred"))
