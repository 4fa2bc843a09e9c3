"""Numeric feature operators.

Each ``fit_*`` takes the training rows (with their fold column) and returns a
:class:`Fitted` whose expressions read the fit fold of an expanded row, so one
projection transforms train, valid and test rows of every fold. Statistics
are computed once for all folds (see :mod:`foldwise.operators.stats`) and
shared between operators through :class:`NumericStats`.
"""

from __future__ import annotations

import itertools
import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldwise.functions.scalar import RATIO_EPSILON, observed, per_fold, safe_div, signed_log
from foldwise.operators import stats as st
from foldwise.operators.base import FIT_FOLD, Fitted

EPS = 2.220446049250313e-16  # float64 machine epsilon: scales below 10*eps count as zero


class NumericStats:
    """Lazily computed, shared per-fold statistics of numeric columns."""

    def __init__(self, train: DataFrame, cols: list[str], fit_folds: list[int], fold_col: str = "fold"):
        self.train, self.cols, self.fit_folds, self.fold_col = train, list(cols), list(fit_folds), fold_col
        self._long = None
        self._summary = None
        self._medians = None
        self._moments = None
        self._quantiles: dict = {}

    @property
    def long(self) -> DataFrame:
        if self._long is None:
            # Read by every selection pass: keep it (recomputable from lineage if an executor is lost).
            self._long = st.long_numeric(self.train, self.cols, self.fold_col).persist()
        return self._long

    @property
    def summary(self) -> dict:
        if self._summary is None:
            self._summary = st.fold_summary(self.long)
        return self._summary

    @property
    def medians(self) -> dict:
        """{(col, f): (median, nulls, rows)}"""
        if self._medians is None:
            self._medians = st.complement_medians(self.train, self.cols, self.fit_folds, self.fold_col,
                                                  self.long, self.summary)
        return self._medians

    def median_of(self, c: str) -> dict:
        return {f: self.medians[(c, f)][0] for f in self.fit_folds}

    @property
    def moments(self) -> dict:
        """{(col, f): (mean, var_pop, var_samp, n)} of the imputed columns."""
        if self._moments is None:
            shifts = {}
            for c in self.cols:
                _, lo, hi = st.complement(self.summary, c, -1)
                shifts[c] = 0.5 * lo + 0.5 * hi
            self._moments = st.imputed_moments(self.train, self.cols, self.medians, self.fit_folds,
                                               self.fold_col, shifts)
        return self._moments

    def imputed_quantiles(self, probs: tuple, method: str) -> dict:
        key = (tuple(probs), method)
        if key not in self._quantiles:
            impute = {(c, f): (m, z) for (c, f), (m, z, _) in self.medians.items()}
            self._quantiles[key] = st.complement_quantiles(
                self.long, self.cols, self.fit_folds, list(probs), method, self.summary, impute)
        return self._quantiles[key]

    def imputed(self, c: str):
        return F.coalesce(observed(c), per_fold(FIT_FOLD, self.median_of(c)))

    def release(self):
        if self._long is not None:
            self._long.unpersist()


def _scale(v: float) -> float:
    return 1.0 if (v is None or math.isnan(v) or v < 10 * EPS) else v


def fit_native_numeric(cols: list[str]) -> Fitted:
    """pass-through, nulls kept (NaN is a null)."""
    return Fitted({c: observed(c) for c in cols})


def fit_standardize(ns: NumericStats, op: str = "standardize_numeric") -> Fitted:
    """median imputation, then (x - mean) / population std of the imputed column."""
    out = {}
    for c in ns.cols:
        mean = {f: ns.moments[(c, f)][0] for f in ns.fit_folds}
        scale = {f: _scale(math.sqrt(ns.moments[(c, f)][1])) for f in ns.fit_folds}
        out[f"{op}__{c}"] = (ns.imputed(c) - per_fold(FIT_FOLD, mean)) / per_fold(FIT_FOLD, scale)
    return Fitted(out)


def fit_robust_scale(ns: NumericStats, op: str = "robust_scale_numeric") -> Fitted:
    """median imputation, then (x - median) / IQR of the imputed column (linear quantiles)."""
    q = ns.imputed_quantiles((0.25, 0.5, 0.75), "linear")
    out = {}
    for c in ns.cols:
        center = {f: q[(c, f)][1] for f in ns.fit_folds}
        scale = {f: _scale(q[(c, f)][2] - q[(c, f)][0]) for f in ns.fit_folds}
        out[f"{op}__{c}"] = (ns.imputed(c) - per_fold(FIT_FOLD, center)) / per_fold(FIT_FOLD, scale)
    return Fitted(out)


def fit_signed_log(ns: NumericStats, op: str = "signed_log_expand_numeric") -> Fitted:
    """median imputation, then sign(x) * log1p(|x|)."""
    return Fitted({f"{op}__{c}": signed_log(ns.imputed(c)) for c in ns.cols})


def bin_edges(ns: NumericStats, n_bins: int = 5) -> dict:
    """{(col, f): edges} -- averaged-inverted-CDF quantile edges of the imputed
    column, edges closer than 1e-8 to their predecessor removed."""
    probs = tuple(i / n_bins for i in range(n_bins + 1))
    q = ns.imputed_quantiles(probs, "averaged_cdf")
    out = {}
    for key, edges in q.items():
        kept = [edges[0]] + [edges[i] for i in range(1, len(edges)) if edges[i] - edges[i - 1] > 1e-8]
        out[key] = kept
    return out


def bin_index(x, edges_by_fold: dict):
    """Number of inner edges <= x, with the edges of the row's fit fold.

    Inner edge j of each fold is a per-fold constant (folds with fewer inner
    edges pad with +inf, which no value reaches), so the expression is a short
    sum of comparisons whatever the number of folds."""
    inner = {f: e[1:-1] for f, e in edges_by_fold.items()}
    width = max((len(v) for v in inner.values()), default=0)
    count = F.lit(0)
    for j in range(width):
        ej = per_fold(FIT_FOLD, {f: (v[j] if j < len(v) else float("inf")) for f, v in inner.items()})
        count = count + F.when(x >= ej, 1).otherwise(0)
    return F.when(F.col(FIT_FOLD).isin(*list(edges_by_fold)), count).cast("int")


def fit_quantile_bin(ns: NumericStats, n_bins: int = 5, op: str = "quantile_bin_numeric") -> Fitted:
    """bin index (the hot position of the one-hot block) per column."""
    edges = bin_edges(ns, n_bins)
    out = {}
    for c in ns.cols:
        out[f"{op}__{c}"] = bin_index(ns.imputed(c), {f: edges[(c, f)] for f in ns.fit_folds})
    return Fitted(out)


def bin_counts(ns: NumericStats, n_bins: int = 5) -> dict:
    """{(col, f): number of bins after merging close edges}."""
    return {k: len(v) - 1 for k, v in bin_edges(ns, n_bins).items()}


def fit_row_missing_count(cols: list[str], op: str = "row_missing_count") -> Fitted:
    """number of null raw features in the row."""
    total = sum((F.col(c).isNull().cast("int") for c in cols), F.lit(0))
    return Fitted({f"{op}__value": total.cast("double")})


_PAIR_OPS = {
    "multiply_numeric_pairs": ("x", lambda a, b: a * b),
    "ratio_numeric_pairs": ("over", lambda a, b: safe_div(a, b + F.lit(RATIO_EPSILON))),
    "difference_numeric_pairs": ("minus", lambda a, b: a - b),
    "sum_numeric_pairs": ("plus", lambda a, b: a + b),
}


def fit_pairs(ns: NumericStats, op: str) -> Fitted:
    """Median-imputed pair arithmetic for each unordered pair in column order."""
    word, fn = _PAIR_OPS[op]
    out = {}
    for a, b in itertools.combinations(ns.cols, 2):
        out[f"{op}__{a}_{word}_{b}"] = fn(ns.imputed(a), ns.imputed(b))
    return Fitted(out)
