"""Model families.

Most families are ``pyspark.ml`` estimators: a factory receives the fit's training
rows (so parameter mappings that depend on the data -- row count, label spread --
are computed per fold) and returns an unfitted estimator reading ``features`` /
``label``. The linear and boosting families, naive_bayes and knn are DataFrame plans
(``scores``): they receive the training rows and the rows to score and return the
scores, the linear and boosting ones of all folds at once (plans/linear.py, plans/boosting.py).

Linear families follow the usual single-machine definitions. Designs wider than
DIRECT_FEATURES have no scatter matrix; they go to Spark's iterative solvers, fold by fold:

* ridge: l-bfgs with ``regParam = alpha / n * std_samp(y)``.
* elastic net: ``regParam = alpha * l1 + alpha * (1 - l1) * std_pop(y)``,
  ``elasticNetParam = alpha * l1 / regParam``.
* logistic regression: ``regParam = 1 / (C * n)``, n the sum of weights;
  ``class_weight="balanced"`` weighs a row of class c by n / (2 n_c).

Parameters that a family has not got are rejected.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.ml import classification as mlc
from pyspark.ml import regression as mlr
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldwise.operators.base import FIT_FOLD
from foldwise.plans import boosting as bo
from foldwise.plans import linear as ln


@dataclass(frozen=True)
class ModelFamily:
    """What a family accepts and how to build it."""

    name: str
    task: str                      # regression | binary
    build: Callable[[DataFrame, dict], object] | None = None
    scores: Callable[[DataFrame, DataFrame, dict], DataFrame] | None = None
    params: frozenset = frozenset()
    tunable: bool = True
    accepts_sparse: bool = True
    native_categorical: bool = False
    all_folds: bool = False        # ``scores`` takes the rows of several fit folds at once
    takes_nan: bool = False        # learns a side for missing values
    defaults: dict = field(default_factory=dict)

    def resolve_params(self, overrides: dict | None) -> dict:
        """Defaults with the overrides on top; a parameter that the family has not got is an error."""
        unknown = set(overrides or {}) - self.params
        if unknown:
            raise ValueError(f"{self.name} ({self.task}) has no parameters {sorted(unknown)}; it has {sorted(self.params)}")
        return {**self.defaults, **(overrides or {})}


#: Widest design whose normal equations are solved directly: its scatter matrix is 32 MB a task and fold.
DIRECT_FEATURES = 2000


def _width(train: DataFrame) -> int:
    return len(train.select("features").first()["features"])


def _wide(train: DataFrame, what: str) -> bool:
    """Whether the design is too wide for its scatter matrix; then folds come one at a time."""
    if _width(train) <= DIRECT_FEATURES:
        return False
    if train.select(FIT_FOLD).distinct().count() > 1:
        raise ValueError(f"{what}: more than {DIRECT_FEATURES} features are fitted one fold at a time")
    return True


def _ridge(train: DataFrame, rows: DataFrame, p: dict) -> DataFrame:
    """M1: train and rows hold one or several fit folds (``fit_fold``); all are solved from one scan's moments."""
    alpha = float(p.get("alpha", 1.0))
    if _wide(train, "ridge"):
        r = train.agg(F.stddev_samp("label").alias("s"), F.count(F.lit(1)).alias("n")).first()
        wide = mlr.LinearRegression(featuresCol="features", labelCol="label", elasticNetParam=0.0, regParam=alpha / r["n"] * (r["s"] or 1.0),
                                    standardization=False, solver="l-bfgs", maxIter=1000, tol=1e-12)
        return wide.fit(train).transform(rows).withColumnRenamed("prediction", "y_pred")
    weights = ln.ridge_weights(ln.fold_moments(train), alpha)
    return rows.withColumn("y_pred", ln.score(rows, weights))


def _elasticnet(train: DataFrame, rows: DataFrame, p: dict) -> DataFrame:
    """M2: coordinate descent on the Gram matrix of each fold, from one scan's moments."""
    alpha, l1 = float(p.get("alpha", 1.0)), float(p.get("l1_ratio", 0.5))
    steps, tol = int(p.get("max_iter", 1000)), float(p.get("tol", 1e-8))
    if _wide(train, "elasticnet"):
        s = train.agg(F.stddev_pop("label").alias("s")).first()["s"] or 1.0
        reg = alpha * l1 + alpha * (1 - l1) * s
        model = mlr.LinearRegression(featuresCol="features", labelCol="label", regParam=reg, elasticNetParam=(alpha * l1 / reg) if reg > 0 else 0.0,
                                     standardization=False, maxIter=steps, tol=tol)
        return model.fit(train).transform(rows).withColumnRenamed("prediction", "y_pred")
    weights = ln.elasticnet_path(ln.fold_moments(train), [(alpha, l1)], steps, tol)[0]
    return rows.withColumn("y_pred", ln.score(rows, weights))


def _logistic(train: DataFrame, rows: DataFrame, p: dict) -> DataFrame:
    """M3: Newton steps of all folds, a scan each."""
    c, l1, balanced = float(p.get("C", 1.0)), float(p.get("l1_ratio", 0.0)), p.get("class_weight")
    if not _wide(train, "logistic_regression"):
        weights = ln.logistic_weights(train, c, l1, balanced, int(p.get("max_iter", 100)), float(p.get("tol", 1e-10)))
        return rows.withColumn("y_pred", F.lit(1.0) / (F.lit(1.0) + F.exp(-ln.score(rows, weights))))
    counts = {r["label"]: r["n"] for r in train.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    n = sum(counts.values())  # balanced weights sum to the number of rows as well
    weight = F.when(F.col("label") == 1.0, n / (2.0 * counts[1.0])).otherwise(n / (2.0 * counts[0.0])) if balanced else F.lit(1.0)
    model = mlc.LogisticRegression(featuresCol="features", labelCol="label", weightCol="_weight", regParam=1.0 / (c * n), elasticNetParam=l1,
                                   standardization=False, maxIter=int(p.get("max_iter", 1000)), tol=float(p.get("tol", 1e-10)))
    return model.fit(train.withColumn("_weight", weight)).transform(rows).withColumn("y_pred", vector_to_array("probability").getItem(1))


def _rf(task):
    def build(train, p):
        cls = mlr.RandomForestRegressor if task == "regression" else mlc.RandomForestClassifier
        return cls(featuresCol="features", labelCol="label", numTrees=int(p.get("n_estimators", 100)),
                   maxDepth=int(p.get("max_depth", 8)), minInstancesPerNode=int(p.get("min_samples_leaf", 1)),
                   maxBins=_bins(train, p.get("max_bins", 32)),
                   featureSubsetStrategy=str(p.get("max_features", "auto")), seed=int(p.get("seed", 42)))
    return build


def _bins(train: DataFrame, given) -> int:
    """maxBins, at least the number of values of the widest nominal feature."""
    attrs = (train.schema["features"].metadata or {}).get("ml_attr", {}).get("attrs", {})
    widest = max((len(a.get("vals", [])) for a in attrs.get("nominal", [])), default=0)
    return max(int(given), widest)


def _gbt(task):
    def build(train, p):
        cls = mlr.GBTRegressor if task == "regression" else mlc.GBTClassifier
        return cls(featuresCol="features", labelCol="label", maxIter=int(p.get("n_estimators", 100)),
                   stepSize=float(p.get("learning_rate", 0.1)), maxDepth=int(p.get("max_depth", 5)),
                   minInstancesPerNode=int(p.get("min_samples_leaf", 1)),
                   maxBins=_bins(train, p.get("max_bins", 64)), seed=int(p.get("seed", 42)))
    return build


class _Calibrated:
    """A margin classifier with a logistic link of one variable, fitted on its training margins."""

    def __init__(self, estimator):
        self.estimator = estimator

    def fit(self, train: DataFrame):
        margin = self.estimator.fit(train)
        link = mlc.LogisticRegression(featuresCol="_margin", labelCol="label", probabilityCol="probability", rawPredictionCol="_link", predictionCol="_linked")
        return _CalibratedModel(margin, link.fit(_CalibratedModel.margins(margin, train)))


class _CalibratedModel:
    def __init__(self, margin, link):
        self.margin, self.link = margin, link

    @staticmethod
    def margins(model, rows: DataFrame) -> DataFrame:
        scored = model.transform(rows).withColumn("_m", vector_to_array("rawPrediction").getItem(1))
        return VectorAssembler(inputCols=["_m"], outputCol="_margin").transform(scored)

    def transform(self, rows: DataFrame) -> DataFrame:
        return self.link.transform(self.margins(self.margin, rows))


def _svc(train, p):
    return _Calibrated(mlc.LinearSVC(featuresCol="features", labelCol="label", regParam=float(p.get("reg_param", 0.01)),
                                     maxIter=int(p.get("max_iter", 200))))


def _mlp(train, p):
    n_features = len(train.select("features").first()["features"])
    return mlc.MultilayerPerceptronClassifier(featuresCol="features", labelCol="label",
                                              layers=[n_features, *p.get("hidden", [32, 16]), 2], maxIter=int(p.get("max_iter", 200)),
                                              seed=int(p.get("seed", 42)))


def _naive_bayes(train: DataFrame, rows: DataFrame, p: dict) -> DataFrame:
    from foldwise.plans.evaluate import gaussian_nb_scores
    return gaussian_nb_scores(train, rows, float(p.get("var_smoothing", 1e-9)))


def _knn(train: DataFrame, rows: DataFrame, p: dict) -> DataFrame:
    from foldwise.operators import knn as kn
    if p.get("weights", "uniform") not in ("uniform", "distance"):
        raise ValueError("weights is 'uniform' or 'distance'")
    vectors = [df.select("id", "label", vector_to_array("features").alias("_v")) for df in (train, rows)]
    near = kn.knn_join(vectors[0], "id", "_v", k=int(p.get("n_neighbors", 5)), queries=vectors[1], exclude_self=False)
    found = kn.knn_predict(near, train, "id", "label", p.get("weights", "uniform"))
    return rows.join(found.withColumnRenamed("query_id", "id"), "id").select("id", "role", "label", "y_pred")


def _boosting(task: str, common: dict, names: dict):
    """A boosting family: its own settings, and its own names of parameters beside the common ones."""
    def scores(train: DataFrame, rows: DataFrame, p: dict) -> DataFrame:
        given = {names.get(k, _BOOST_NAMES.get(k)): v for k, v in p.items() if names.get(k, _BOOST_NAMES.get(k))}
        settings = bo.Settings(**{**common, **given})
        return bo.score_boosting(rows, bo.fit_boosting(train, settings, task))
    return scores


_FOREST = frozenset({"n_estimators", "max_depth", "min_samples_leaf", "max_features", "max_bins", "seed"})
_BOOST = frozenset({"n_estimators", "learning_rate", "max_depth", "min_samples_leaf", "max_bins", "seed"})

_BOOST_NAMES = {"n_estimators": "n_estimators", "learning_rate": "learning_rate", "max_depth": "max_depth", "min_samples_leaf": "min_samples", "max_bins": "bins"}
# Ids, defaults and parameter names of the usual histogram boosting libraries.
BOOSTING = {
    "hist_gradient_boosting": ({"growth": "leaf", "min_samples": 20}, {"max_iter": "n_estimators", "max_leaf_nodes": "max_leaves", "l2_regularization": "l2"}),
    "lightgbm": ({"growth": "leaf", "min_samples": 20, "min_hessian": 1e-3}, {"num_leaves": "max_leaves", "min_child_samples": "min_samples", "min_child_weight": "min_hessian", "reg_lambda": "l2", "min_split_gain": "min_gain", "max_bin": "bins"}),
    "xgboost": ({"growth": "depth", "max_depth": 6, "learning_rate": 0.3, "min_hessian": 1.0, "l2": 1.0, "bins": 256}, {"min_child_weight": "min_hessian", "reg_lambda": "l2", "gamma": "min_gain", "max_bin": "bins"}),
    "catboost": ({"growth": "oblivious", "max_depth": 6, "learning_rate": 0.03, "n_estimators": 1000, "l2": 3.0, "bins": 255}, {"iterations": "n_estimators", "depth": "max_depth", "l2_leaf_reg": "l2", "border_count": "bins"}),
}
#: (family, task) ids that Spark has no model for.
NOT_BUILT = {("extra_trees", "regression"), ("extra_trees", "binary"), ("realmlp", "regression")}

REGISTRY: dict[tuple[str, str], ModelFamily] = {}


def register(family: ModelFamily) -> ModelFamily:
    """Add a family under its name and task; a second one of both is an error."""
    key = (family.name, family.task)
    if key in REGISTRY:
        raise ValueError(f"model family {key} is registered already")
    REGISTRY[key] = family
    return family


register(ModelFamily("ridge", "regression", scores=_ridge, params=frozenset({"alpha"}), tunable=False, all_folds=True))
register(ModelFamily("elasticnet", "regression", scores=_elasticnet, params=frozenset({"alpha", "l1_ratio", "max_iter", "tol"}), tunable=False, all_folds=True))
register(ModelFamily("logistic_regression", "binary", scores=_logistic, all_folds=True, params=frozenset({"C", "l1_ratio", "class_weight", "max_iter", "tol"})))
for _task in ("regression", "binary"):
    register(ModelFamily("random_forest", _task, _rf(_task), params=_FOREST))
    register(ModelFamily("gradient_boosted_trees", _task, _gbt(_task), params=_BOOST, native_categorical=True))
    for _name, (_common, _names) in BOOSTING.items():
        register(ModelFamily(_name, _task, scores=_boosting(_task, _common, _names), params=_BOOST | _names.keys(), all_folds=True, takes_nan=True,
                             accepts_sparse=_name != "hist_gradient_boosting", native_categorical=_name in ("lightgbm", "catboost")))
    register(ModelFamily("knn", _task, scores=_knn, params=frozenset({"n_neighbors", "weights"})))
register(ModelFamily("naive_bayes", "binary", scores=_naive_bayes, params=frozenset({"var_smoothing"}), accepts_sparse=False))
register(ModelFamily("svm", "binary", _svc, params=frozenset({"reg_param", "max_iter"})))
register(ModelFamily("realmlp", "binary", _mlp, params=frozenset({"hidden", "max_iter", "seed"}), accepts_sparse=False, native_categorical=True))


def resolve(name: str, task: str) -> ModelFamily:
    """Registry lookup by family name and task."""
    family = REGISTRY.get((name, task))
    if family is None:
        why = "not built: Spark has no such model" if (name, task) in NOT_BUILT else "not available"
        raise ValueError(f"model family '{name}' is {why} for task '{task}'")
    return family


def check_compatibility(family: ModelFamily, matrix_kind: str) -> None:
    """Native categoricals only for families that take them; sparse input not for dense-only ones."""
    if matrix_kind == "native" and not family.native_categorical:
        raise ValueError(f"{family.name} does not accept native categorical input")
    if matrix_kind == "sparse" and not family.accepts_sparse:
        raise ValueError(f"{family.name} does not accept sparse input")
