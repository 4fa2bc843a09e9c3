"""Categorical feature operators.

Per-category statistics are computed once per (column, category, fold) and
merged over the other folds (:func:`stats.complement_groups`). Each column's
result becomes a lookup table ``category -> map(fit_fold -> value)`` that is
joined to the *unexpanded* rows, so its size follows the number of categories,
not rows. It is broadcast when its size, from the column's (HyperLogLog) cardinality
and the bytes of an entry per fold, is at most BROADCAST_BYTES, otherwise joined by
shuffle (AQE splits skewed categories).

Sparse operators (one-hot, rare buckets) produce, per source column, the name
of the hot output feature or NULL; :func:`sparse_long` turns them into the
(id, fit_fold, feature, value) long form.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foldwise.functions.scalar import MISSING_TOKEN, category_text, per_fold
from foldwise.operators import stats as st
from foldwise.operators.base import FIT_FOLD, Fitted

#: Most bytes of one broadcast lookup, and what a category and one fold's entry of it take in memory.
BROADCAST_BYTES, CATEGORY_BYTES, ENTRY_BYTES = 8 << 20, 96, 48


def dtypes_of(df: DataFrame, cols: list[str]) -> dict:
    return {c: df.schema[c].dataType for c in cols}


def text(df: DataFrame, c: str, missing: str = MISSING_TOKEN) -> Column:
    return category_text(F.col(c), df.schema[c].dataType, missing)


def long_categorical(df: DataFrame, cols: list[str], fold_col: str = "fold", y_col: str | None = None,
                     missing: str = MISSING_TOKEN) -> DataFrame:
    """(fold, key, v, isnull[, y]) -- one row per (row, column)."""
    structs = [F.struct(F.lit(c).alias("key"), text(df, c, missing).alias("v"),
                        F.col(c).isNull().alias("isnull")) for c in cols]
    sel = [F.col(fold_col).cast("int").alias("fold")]
    if y_col:
        sel.append(F.col(y_col).cast("double").alias("y"))
    return df.select(*sel, F.inline(F.array(*structs)))


def cardinalities(df: DataFrame, cols: list[str]) -> dict:
    """Approximate distinct counts (HyperLogLog, bounded memory) for sizing lookups."""
    row = df.agg(*[F.approx_count_distinct(F.col(c)).alias(c) for c in cols]).collect()[0]
    return {c: int(row[c]) for c in cols}


class CategoryStats:
    """Per (column, category, fit fold): complement count (and target sum)."""

    def __init__(self, train: DataFrame, cols: list[str], k: int, fold_col: str = "fold",
                 y_col: str | None = None, missing: str = MISSING_TOKEN, card: dict | None = None):
        self.train, self.cols, self.k, self.fold_col, self.y_col = train, list(cols), k, fold_col, y_col
        self.missing = missing
        self.card = card or {}
        self.totals = st.fold_totals(train, k, fold_col, y_col)
        lg = long_categorical(train, cols, fold_col, y_col, missing)
        partial = {"n": F.count(F.lit(1))}
        combine = {"n": "sum"}
        if y_col:
            partial["s"] = F.sum("y")
            combine["s"] = "sum"
        self.comp = st.complement_groups(lg, ["key", "v", "isnull"], k, partial, combine, "fold").persist()
        self.cached = [self.comp]

    def release(self) -> None:
        """Free the cached statistics (plans that use them recompute them)."""
        for df in self.cached:
            df.unpersist()

    def broadcastable(self, c: str) -> bool:
        """Whether a lookup of the column is small enough; an unknown cardinality is not."""
        return c in self.card and self.card[c] * (CATEGORY_BYTES + self.k * ENTRY_BYTES) <= BROADCAST_BYTES

    def nunique(self, dropna: bool = True) -> dict:
        """{(col, f): distinct categories in the complement}."""
        d = self.comp.where(~F.col("isnull")) if dropna else self.comp
        rows = d.groupBy("key", "fit_fold").agg(F.count(F.lit(1)).alias("u")).collect()
        out = {(c, f): 0 for c in self.cols for f in range(1, self.k + 1)}
        out.update({(r["key"], r["fit_fold"]): r["u"] for r in rows})
        return out

    def nunique_all(self) -> dict:
        """{col: distinct non-null categories over all training rows}."""
        rows = (self.comp.where(~F.col("isnull")).select("key", "v").distinct()
                .groupBy("key").agg(F.count(F.lit(1)).alias("u")).collect())
        out = {c: 0 for c in self.cols}
        out.update({r["key"]: r["u"] for r in rows})
        return out

    def modes(self) -> dict:
        """{(col, f): most frequent non-null category, smallest on ties}."""
        best = F.min(F.struct((-F.col("n")).alias("neg"), F.col("v").alias("v")))
        rows = (self.comp.where(~F.col("isnull")).groupBy("key", "fit_fold").agg(best.alias("b")).collect())
        return {(r["key"], r["fit_fold"]): r["b"]["v"] for r in rows}

    def lookup(self, c: str, value: Column, name: str, null_rows: bool = True):
        """Lookup (table, join condition, broadcast) mapping the category text of
        ``c`` to the array of its values by fit fold as column ``name``: every row reads it
        once a fold, and an array is read by place where a map is searched."""
        comp = self.comp.where(F.col("key") == c)
        if not null_rows:
            comp = comp.where(~F.col("isnull"))
        comp = comp.select("v", "fit_fold", value.alias("val"))
        table = comp.groupBy("v").agg(F.map_from_entries(F.collect_list(F.struct("fit_fold", "val"))).alias("m"))
        table = table.select(F.col("v").alias(f"{name}_k"), F.array(*[F.element_at("m", F.lit(f)) for f in range(1, self.k + 1)]).alias(name))
        missing = self.missing
        train = self.train

        def cond(df, t):
            return category_text(df[c], train.schema[c].dataType, missing) == t[f"{name}_k"]
        return table, cond, self.broadcastable(c)


def _at(name: str) -> Column:
    return F.element_at(F.col(name), F.col(FIT_FOLD))


def fit_native_categorical(train: DataFrame, cols: list[str], missing: str = MISSING_TOKEN) -> Fitted:
    """category text with the missing token."""
    return Fitted({c: text(train, c, missing) for c in cols})


def fit_frequency(cs: CategoryStats, op: str = "frequency_encode_categoricals") -> Fitted:
    """share of the category among the fit rows; unseen -> 0."""
    n_fit = per_fold(FIT_FOLD, {f: float(n) for f, (n, _) in cs.totals.items()})
    cols, lookups = {}, []
    for c in cs.cols:
        name = f"_lk_freq_{c}"
        lookups.append(cs.lookup(c, F.col("n").cast("double"), name))
        cols[f"{op}__{c}"] = F.coalesce(_at(name) / n_fit, F.lit(0.0))
    return Fitted(cols, lookups)


def fit_target(cs: CategoryStats, smoothing: float = 1.0, op: str = "target_encode_categoricals") -> Fitted:
    """(sum_y + s * global_mean) / (n + s) per category; unseen -> fit global mean."""
    if cs.y_col is None:
        raise ValueError("target encoding needs a label column")
    if smoothing < 0:
        raise ValueError("smoothing must be >= 0")
    gm = {f: s / n for f, (n, s) in cs.totals.items()}
    gm_col = per_fold(FIT_FOLD, gm)
    cols, lookups = {}, []
    sm = F.lit(float(smoothing))
    for c in cs.cols:
        name = f"_lk_te_{c}"
        lookups.append(cs.lookup(c, F.struct(F.col("n").cast("double").alias("n"), F.col("s").alias("s")), name))
        hit = _at(name)
        enc = (hit["s"] + sm * gm_col) / (hit["n"] + sm)
        cols[f"{op}__{c}"] = F.coalesce(enc, gm_col)
    return Fitted(cols, lookups)


def fit_ordinal(cs: CategoryStats, op: str = "ordinal_encode_categoricals") -> Fitted:
    """F8: most-frequent imputation, index in the sorted fit categories, unseen -> -1."""
    k = cs.k
    modes = cs.modes()
    base = cs.comp.where(~F.col("isnull"))
    flags = [f"p{f}" for f in range(1, k + 1)]
    present = base.groupBy("key", "v").agg(
        *[F.max(F.when(F.col("fit_fold") == f, F.lit(True)).otherwise(F.lit(False))).alias(p)
          for f, p in zip(range(1, k + 1), flags)])
    ranks = st.conditional_ranks(present, "key", "v", flags).persist()
    cs.cached.append(ranks)
    mode_rows = {}
    wanted = [(c, f, v) for (c, f), v in modes.items()]
    if wanted:
        cond = None
        for c, f, v in wanted:
            one = (F.col("key") == c) & (F.col("v") == v)
            cond = one if cond is None else cond | one
        for r in ranks.where(cond).collect():
            mode_rows[(r["key"], r["v"])] = r
    cols, lookups = {}, []
    for c in cs.cols:
        name = f"_lk_ord_{c}"
        t = ranks.where(F.col("key") == c)
        val = F.map_from_arrays(
            F.array(*[F.lit(f) for f in range(1, k + 1)]),
            F.array(*[F.when(F.col(p), F.col(f"rank_{p}")) for p in flags]))
        table = t.select(F.col("v").alias(f"{name}_k"), val.alias(name))

        def cond(df, tb, c=c, name=name):
            return category_text(df[c], cs.train.schema[c].dataType, cs.missing) == tb[f"{name}_k"]
        lookups.append((table, cond, cs.broadcastable(c)))
        mode_idx = {f: int(mode_rows[(c, modes[(c, f)])][f"rank_p{f}"])
                    for f in range(1, k + 1) if (c, f) in modes}
        enc = F.when(F.col(c).isNull(), per_fold(FIT_FOLD, mode_idx)).otherwise(
            F.coalesce(_at(name), F.lit(-1)))
        cols[f"{op}__{c}"] = enc.cast("double")
    return Fitted(cols, lookups)


def low_cardinality(nunique: dict, cols: list[str], max_cardinality: int, fit_folds: list[int]) -> dict:
    """{f: [eligible columns in order]} with ``nunique <= max_cardinality``."""
    if max_cardinality < 1:
        raise ValueError("max_cardinality must be >= 1")
    return {f: [c for c in cols if nunique[(c, f)] <= max_cardinality] for f in fit_folds}


def fit_onehot(cs: CategoryStats, full_train_nunique: dict, max_cardinality: int = 16,
               op: str = "onehot_encode_low_cardinality_categoricals") -> Fitted:
    """F9 (sparse): most-frequent imputation, one indicator per fit category,
    unknown -> none. Eligibility uses the full training table."""
    eligible = [c for c in cs.cols if full_train_nunique[c] <= max_cardinality]
    modes = cs.modes()
    cols, lookups = {}, []
    for c in eligible:
        name = f"_lk_oh_{c}"
        lookups.append(cs.lookup(c, F.lit(True), name, null_rows=False))
        mode = per_fold(FIT_FOLD, {f: modes[(c, f)] for f in range(1, cs.k + 1) if (c, f) in modes})
        v = F.when(F.col(c).isNull(), mode).otherwise(text(cs.train, c, cs.missing))
        hit = F.when(F.col(c).isNull(), F.lit(True)).otherwise(_at(name))
        cols[f"{op}__{c}"] = F.when(hit, F.concat(F.lit(f"{op}__{c}_"), v))
    return Fitted(cols, lookups)


def fit_rare_bucket(cs: CategoryStats, min_frequency: float = 0.01, op: str = "rare_category_bucket") -> Fitted:
    """F11 (sparse): one indicator per category whose fit share is below
    ``min_frequency``; frequent and unseen categories -> none."""
    if not 0 < min_frequency < 1:
        raise ValueError("min_frequency must be in (0, 1)")
    n_fit = per_fold(FIT_FOLD, {f: float(n) for f, (n, _) in cs.totals.items()})
    cols, lookups = {}, []
    for c in cs.cols:
        name = f"_lk_rare_{c}"
        lookups.append(cs.lookup(c, F.col("n").cast("double"), name))
        share = _at(name) / n_fit
        cols[f"{op}__{c}"] = F.when(share < F.lit(min_frequency),
                                    F.concat(F.lit(f"{op}__{c}_"), text(cs.train, c, cs.missing)))
    return Fitted(cols, lookups)


def sparse_long(df: DataFrame, sparse_cols: list[str], keep: list[str]) -> DataFrame:
    """Hot-feature columns -> (keep..., feature, value) rows, value 1.0."""
    # explode then filter (a lambda filter over the array would leave whole-stage codegen)
    return (df.select(*keep, F.explode(F.array(*[F.col(c) for c in sparse_cols])).alias("feature"))
            .where(F.col("feature").isNotNull())
            .withColumn("value", F.lit(1.0).cast(T.DoubleType())))
