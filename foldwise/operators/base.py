"""Fitted-operator protocol: statistics become literals or small lookup tables,
the transform is a projection (plus bounded lookups) over rows expanded by fit fold."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FIT_FOLD = "fit_fold"


@dataclass
class LongForm:
    """An operator's outputs as rows of (feature, value).

    ``per_row``: what a joined row brings, once for all its features (arrays).
    ``entries``: one row (``fit_fold``, ``feature``, ...) per output of a fit, with its constants and its places in those
    arrays; outputs that a fit leaves out have none.
    ``value``: one expression over both. A column per output would make one method of all of them, which the JVM
    does not compile above 8000 bytes; this is the same short loop body whatever the number of outputs.
    ``feature``: the output's name where it depends on the row too; ``has``: whether the row has that output at all.
    """

    per_row: dict[str, Column]
    entries: list[dict]
    value: Column
    feature: Column | None = None
    has: Column | None = None


@dataclass
class Fitted:
    """Output columns of one fitted operator.

    ``columns``: name -> expression over the expanded rows (may use ``fit_fold``).
    ``lookups``: (table, join keys) left-joined before projecting; each table is
    keyed by category and carries one value per fit fold, so it is joined to
    the unexpanded rows and sized by cardinality, never by row count.
    """

    columns: dict[str, Column]
    lookups: list = field(default_factory=list)
    dropped: list = field(default_factory=list)
    long: LongForm | None = None

    def names(self) -> list[str]:
        return [n for n in self.columns if n not in self.dropped]

    def join_lookups(self, df: DataFrame) -> DataFrame:
        for table, cond, broadcast in self.lookups:
            t = F.broadcast(table) if broadcast else table
            df = df.join(t, cond(df, t) if callable(cond) else cond, "left")
        return df

    def with_cached_lookups(self) -> tuple[Fitted, list[DataFrame]]:
        """The same with its lookup tables persisted, for several actions over one fit, and those tables."""
        tables = [t.persist() for t, _, _ in self.lookups]
        return Fitted(self.columns, [(t, c, b) for t, (_, c, b) in zip(tables, self.lookups)], self.dropped, self.long), tables

    def project(self, df: DataFrame, keep: list[str]) -> DataFrame:
        return df.select(*keep, *[self.columns[n].alias(n) for n in self.names()])

    def transform(self, rows: DataFrame, k: int, keep: list[str], fold_col: str = "fold", fit_fold: int | None = None) -> DataFrame:
        """Lookups join the unexpanded rows (one row per category and k values
        per row), then rows are projected: for every fit fold (k rows per row), or
        for the given one, where the table keeps its size."""
        joined = self.join_lookups(rows)
        expanded = expand_fits(joined, k, fold_col) if fit_fold is None else one_fit(joined, fit_fold, fold_col)
        return self.project(expanded, keep)

    def transform_long(self, rows: DataFrame, keep: list[str], fold_col: str = "fold") -> DataFrame:
        """(keep..., feature, value) of every fit fold; a row a feature, without the wide table between."""
        if not self.long.entries:
            none = rows.withColumns({FIT_FOLD: F.lit(None).cast("int"), "role": F.lit(None).cast("string")})
            return none.select(*keep, F.lit(None).cast("string").alias("feature"), F.lit(None).cast("double").alias("value")).where(F.lit(False))
        entries = F.array(*[F.struct(*[F.lit(v).alias(n) for n, v in e.items()]) for e in self.long.entries])
        out = self.join_lookups(rows).withColumns(self.long.per_row).select("*", F.inline(entries))
        if self.long.has is not None:
            out = out.where(self.long.has)
        feature = F.col("feature") if self.long.feature is None else self.long.feature.alias("feature")
        return out.withColumn("role", _role(fold_col)).select(*keep, feature, self.long.value.cast("double").alias("value"))


def _role(fold_col: str):
    return (F.when(F.col("split") == "test", "test")
            .when(F.col(fold_col) == F.col(FIT_FOLD), "valid").otherwise("train"))


def one_fit(df: DataFrame, fit_fold: int, fold_col: str = "fold") -> DataFrame:
    """Each row once, with its role in the fit that leaves ``fit_fold`` out."""
    return df.withColumn(FIT_FOLD, F.lit(fit_fold)).withColumn("role", _role(fold_col))


def expand_fits(df: DataFrame, k: int, fold_col: str = "fold") -> DataFrame:
    """Each row once per fit fold 1..k (``explode(sequence(1, k))``, no join),
    with its role in that fit (train / valid / test)."""
    return (df.withColumn(FIT_FOLD, F.explode(F.sequence(F.lit(1), F.lit(k))))
            .withColumn("role", _role(fold_col)))


def outside_fold(fold_col: str, k: int):
    """Fit folds a training row belongs to: every fold but its own."""
    return F.explode(F.filter(F.sequence(F.lit(1), F.lit(k)), lambda f: f != F.col(fold_col)))


def merge(*fitted: Fitted) -> Fitted:
    cols, lookups, dropped = {}, [], []
    for f in fitted:
        cols.update(f.columns)
        lookups += f.lookups
        dropped += f.dropped
    return Fitted(cols, lookups, dropped)
