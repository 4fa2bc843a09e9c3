"""Representations: ordered feature operators + pruners.

A representation is declared as data -- ``[{"id": ..., params...}, ...]`` --
validated, given a stable id, fitted once for all folds (each operator's
statistics are fold-complement aggregates) and applied as one projection over
rows expanded by fit fold. Pruners run after the generators, on the dense
training block of each fold.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml.feature import CountVectorizerModel, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldwise.operators import categorical as cat
from foldwise.operators import interactions as ix
from foldwise.operators import numeric as num
from foldwise.operators import prune as pr
from foldwise.operators.base import FIT_FOLD, Fitted, merge
from foldwise.plans.blend import short_hash

# operator id -> (output kind, allowed parameters)
OPERATORS = {
    "native_numeric": ("native", set()),
    "native_categorical": ("native", {"missing_value"}),
    "standardize_numeric": ("dense", set()),
    "robust_scale_numeric": ("dense", set()),
    "signed_log_expand_numeric": ("dense", set()),
    "quantile_bin_numeric": ("sparse", set()),
    "frequency_encode_categoricals": ("dense", {"missing_value"}),
    "ordinal_encode_categoricals": ("dense", set()),
    "onehot_encode_low_cardinality_categoricals": ("sparse", {"max_cardinality"}),
    "target_encode_categoricals": ("dense", {"smoothing", "missing_value"}),
    "rare_category_bucket": ("sparse", {"min_frequency", "missing_value"}),
    "row_missing_count": ("dense", set()),
    "multiply_numeric_pairs": ("dense", set()),
    "ratio_numeric_pairs": ("dense", set()),
    "difference_numeric_pairs": ("dense", set()),
    "sum_numeric_pairs": ("dense", set()),
    "cross_low_cardinality_categoricals": ("sparse", {"max_cardinality", "missing_value"}),
    "cross_categorical_with_binned_numeric": ("sparse", {"n_bins", "max_cardinality", "missing_value"}),
    "groupwise_deviation_features": ("dense", {"max_cardinality", "missing_value"}),
    "frequency_encode_categorical_crosses": ("dense", {"max_cardinality", "missing_value"}),
}
PRUNERS = {"high_correlation_prune": {"threshold"}}
SUPERVISED = {"target_encode_categoricals"}


def _check_params(op: str, params: dict) -> None:
    """unknown keys and ranges."""
    allowed = OPERATORS[op][1] if op in OPERATORS else PRUNERS[op]
    unknown = set(params) - allowed
    if unknown:
        raise ValueError(f"{op}: unknown parameters {sorted(unknown)}")
    if "min_frequency" in params and not 0 < params["min_frequency"] < 1:
        raise ValueError(f"{op}: min_frequency must be in (0, 1)")
    if "smoothing" in params and params["smoothing"] < 0:
        raise ValueError(f"{op}: smoothing must be >= 0")
    if "max_cardinality" in params and params["max_cardinality"] < 1:
        raise ValueError(f"{op}: max_cardinality must be >= 1")
    if "n_bins" in params and params["n_bins"] < 2:
        raise ValueError(f"{op}: n_bins must be >= 2")
    if "threshold" in params and not 0 < params["threshold"] <= 1:
        raise ValueError(f"{op}: threshold must be in (0, 1]")


def _normalize(specs) -> list[tuple[str, dict]]:
    out = []
    for s in specs:
        if isinstance(s, str):
            s = {"id": s}
        s = dict(s)
        op = s.pop("id")
        if op not in OPERATORS and op not in PRUNERS:
            raise ValueError(f"unknown operator '{op}'")
        _check_params(op, s)
        out.append((op, s))
    return out


@dataclass
class Representation:
    operators: list
    pruners: list = field(default_factory=list)

    def __post_init__(self):
        self.ops = _normalize(self.operators)
        self.prs = _normalize(self.pruners)
        if any(op not in OPERATORS for op, _ in self.ops) or any(p not in PRUNERS for p, _ in self.prs):
            raise ValueError("operators and pruners must come from their own registries")
        if not self.ops:
            raise ValueError("a representation needs at least one operator")

    @property
    def id(self) -> str:
        """'repr-' and the short hash of the components in order, each with its id and params."""
        parts = {kind: [{"id": o, "params": p} for o, p in specs] for kind, specs in (("operators", self.ops), ("pruners", self.prs))}
        return "repr-" + short_hash(parts)

    def matrix_kind(self) -> str:
        """native if any native operator (mixing with sparse is an error),
        else sparse if any sparse operator, else dense."""
        kinds = {OPERATORS[o][0] for o, _ in self.ops}
        if "native" in kinds and "sparse" in kinds:
            raise ValueError("native and sparse operators cannot be combined")
        return "native" if "native" in kinds else "sparse" if "sparse" in kinds else "dense"

    def fit(self, train: DataFrame, numeric: list[str], categorical: list[str], k: int,
            fold_col: str = "fold", label: str | None = None, raw_features: list[str] | None = None,
            card: dict | None = None) -> "FittedRepresentation":
        """fit every generator for all folds, then the pruners."""
        fits = list(range(1, k + 1))
        ns = num.NumericStats(train, numeric, fits, fold_col) if numeric else None
        by_token: dict = {}  # statistics are shared by the operators that use the same missing token

        def stats(missing):
            if missing not in by_token:
                by_token[missing] = cat.CategoryStats(train, categorical, k, fold_col, missing=missing, card=card) if categorical else None
            return by_token[missing]
        parts, sparse, prepare, owned = [], [], [], []
        for op, p in self.ops:
            kind = OPERATORS[op][0]
            cs = stats(p.get("missing_value", cat.MISSING_TOKEN)) if "categor" in op or op == "groupwise_deviation_features" else None
            f = self._one(op, p, train, ns, cs, numeric, categorical, k, fold_col, label, raw_features, card, prepare, owned)
            parts.append(f)
            if kind == "sparse":
                sparse += f.names()
        fitted = merge(*parts)
        native = [c for op, _ in self.ops if op == "native_categorical" for c in categorical]
        numbers = [c for op, _ in self.ops if op == "native_numeric" for c in numeric]
        return FittedRepresentation(self, fitted, sparse, k, fold_col, prepare, native=native, native_numeric=numbers,
                                    shared=[x for x in [ns, *by_token.values(), *owned] if x is not None])

    def _one(self, op, p, train, ns, cs, numeric, categorical, k, fold_col, label, raw, card, prepare, owned) -> Fitted:
        missing = p.get("missing_value", cat.MISSING_TOKEN)
        if op == "native_numeric":
            return num.fit_native_numeric(numeric)
        if op == "native_categorical":
            return cat.fit_native_categorical(train, categorical, missing)
        if op == "standardize_numeric":
            return num.fit_standardize(ns)
        if op == "robust_scale_numeric":
            return num.fit_robust_scale(ns)
        if op == "signed_log_expand_numeric":
            return num.fit_signed_log(ns)
        if op == "quantile_bin_numeric":
            return _sparse_bins(num.fit_quantile_bin(ns))
        if op == "frequency_encode_categoricals":
            return cat.fit_frequency(cs)
        if op == "ordinal_encode_categoricals":
            return cat.fit_ordinal(cs)
        if op == "onehot_encode_low_cardinality_categoricals":
            return cat.fit_onehot(cs, cs.nunique_all(), p.get("max_cardinality", 16))
        if op == "target_encode_categoricals":
            if label is None:
                raise ValueError("target_encode_categoricals is supervised: a label is required")
            ts = cat.CategoryStats(train, categorical, k, fold_col, label, missing, card)
            owned.append(ts)
            return cat.fit_target(ts, p.get("smoothing", 1.0))
        if op == "rare_category_bucket":
            return cat.fit_rare_bucket(cs, p.get("min_frequency", 0.01))
        if op == "row_missing_count":
            return num.fit_row_missing_count(raw or (numeric + categorical))
        if op in ("multiply_numeric_pairs", "ratio_numeric_pairs", "difference_numeric_pairs", "sum_numeric_pairs"):
            return num.fit_pairs(ns, op)
        if op in ("cross_low_cardinality_categoricals", "frequency_encode_categorical_crosses"):
            plan = ix.CrossPlan(cs, p.get("max_cardinality", 10))
            if plan.stats is not None:
                owned.append(plan.stats)
            prepare.append(plan.prepare)
            return ix.fit_cross_categoricals(plan) if op.startswith("cross") else ix.fit_frequency_crosses(plan)
        if op == "cross_categorical_with_binned_numeric":
            return ix.fit_cross_binned(ns, cs, p.get("n_bins", 5), p.get("max_cardinality", 10))
        if op == "groupwise_deviation_features":
            return ix.fit_group_deviation(ns, cs, p.get("max_cardinality", 20))
        raise ValueError(op)


def _sparse_bins(f: Fitted) -> Fitted:
    """Bin index -> hot feature name ``<op>__<col>_<bin>`` for the sparse block."""
    return Fitted({n: F.concat(F.lit(n + "_"), c.cast("string")) for n, c in f.columns.items()}, f.lookups)


@dataclass
class FittedRepresentation:
    spec: Representation
    fitted: Fitted
    sparse: list
    k: int
    fold_col: str
    prepare: list
    dropped: dict = field(default_factory=dict)
    native: list = field(default_factory=list)
    native_numeric: list = field(default_factory=list)
    shared: list = field(default_factory=list)

    @property
    def dense(self) -> list[str]:
        return [n for n in self.fitted.names() if n not in self.sparse and n not in self.native]

    def release(self) -> None:
        """Free the cached statistics; the fitted expressions and lookups stay usable."""
        for s in self.shared:
            s.release()

    def transform(self, rows: DataFrame, keep: list[str], fit_fold: int | None = None) -> DataFrame:
        """The features of every fit fold, or of one."""
        for p in self.prepare:
            rows = p(rows)
        out = self.fitted.transform(rows, self.k, keep, self.fold_col, fit_fold)
        if self.dropped:
            for n in self.dense:
                folds = [f for f, names in self.dropped.items() if n in names]
                if folds:
                    out = out.withColumn(n, F.when(~F.col(FIT_FOLD).isin(*folds), F.col(n)))
        return out

    def fit_pruners(self, rows: DataFrame) -> "FittedRepresentation":
        """F21 in sequence on the dense training block of every fold."""
        names = self.dense
        for op, p in self.spec.prs:
            block = self.transform(rows, [FIT_FOLD, "role"]).where(F.col("role") == "train")
            corr = pr.correlations(block, names)
            drops = pr.dropped_features(corr, names, list(range(1, self.k + 1)), p.get("threshold", 0.98))
            for f, d in drops.items():
                self.dropped.setdefault(f, set()).update(d)
        return self

    def vocabulary(self, transformed: DataFrame) -> list[str]:
        """Sparse feature names seen on training rows: one entry per model coefficient."""
        if not self.sparse:
            return []
        names = (transformed.where(F.col("role") == "train").select(F.explode(F.array(*self.sparse)).alias("f"))
                 .where(F.col("f").isNotNull()).distinct())
        return sorted(r["f"] for r in names.toLocalIterator())

    def materialize(self, transformed: DataFrame, vocabulary: list[str], out: str = "features", nulls: bool = False) -> DataFrame:
        """dense columns first, then one indicator per sparse feature, or one nominal position
        per native categorical column.

        The hot names of a row go through a fixed vocabulary into one sparse vector, so
        the plan does not grow with the number of sparse features. Native categoricals
        are indexed on the training rows (other values get an index of their own) and
        keep their nominal metadata, which trees split by category. Pruned or ineligible
        dense outputs enter as 0. A native numeric's null is NaN for models that learn a side for
        it (``nulls``); most of pyspark.ml takes no NaN, so there it is 0 beside an indicator of its own."""
        flags = [] if nulls else self.native_numeric
        dense = [F.col(c).cast("double").alias(c) if nulls and c in self.native_numeric else F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in self.dense]
        dense += [F.col(c).isNull().cast("double").alias(f"_null_{c}") for c in flags]
        keep = [c for c in transformed.columns if c not in self.dense]
        wide, cols = transformed.select(*keep, *dense), [*self.dense, *(f"_null_{c}" for c in flags)]
        if vocabulary:
            hot = F.array_compact(F.array(*self.sparse))
            indicators = CountVectorizerModel.from_vocabulary(vocabulary, inputCol="_hot", outputCol="_sparse", binary=True)
            wide = indicators.transform(wide.withColumn("_hot", hot)).drop("_hot")
            cols.append("_sparse")
        if self.native:
            indexed = [f"_n_{c}" for c in self.native]
            indexer = StringIndexer(inputCols=self.native, outputCols=indexed, handleInvalid="keep", stringOrderType="alphabetAsc")
            wide = indexer.fit(wide.where(F.col("role") == "train")).transform(wide)
            cols += indexed
        return VectorAssembler(inputCols=cols, outputCol=out, handleInvalid="keep").transform(wide)

