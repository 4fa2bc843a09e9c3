"""Column-expression helpers (all JVM-side built-ins, no Python UDFs)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values that must equal the reference's behaviour.
MISSING_TOKEN = "__missing__"      # token for a null category
CROSS_SEPARATOR = "__x__"          # separator of crossed categories
BIN_PREFIX = "bin_"                # prefix of a quantile-bin label in crosses
RATIO_EPSILON = 1e-8               # added to the denominator of ratio features
DEVIATION_EPSILON = 1e-8           # added to the group std of deviation features
PROBABILITY_EPSILON = 2.220446049250313e-16  # clip of probabilities in log loss
ACCURACY_THRESHOLD = 0.5           # score >= threshold is the positive label
NULL_SCORE_TEXTS = ("", "none", "nan")  # remote score strings read as null


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def rnd(c, digits: int = 6) -> Column:
    """Round half up through floor, identical in Spark and DuckDB.

    ``round()`` differs between engines on decimal ties (Spark rounds the
    shortest decimal text, DuckDB the binary value), so both sides use
    ``floor(x * 10^d + 0.5) / 10^d`` which is the same IEEE arithmetic.
    """
    scale = float(10 ** digits)
    return (F.floor(col_(c) * F.lit(scale) + F.lit(0.5)) / F.lit(scale)).cast("double")


def sql_rnd(expr: str, digits: int = 6) -> str:
    """DuckDB text of :func:`rnd`."""
    return f"CAST(floor(({expr}) * 1e{digits} + 0.5) / 1e{digits} AS DOUBLE)"


def category_text(c, dtype: T.DataType | None = None, missing: str = MISSING_TOKEN) -> Column:
    """Null -> missing token, else the value as text (booleans as True/False)."""
    c = col_(c)
    if isinstance(dtype, T.BooleanType):
        txt = F.when(c, F.lit("True")).when(~c, F.lit("False"))
    else:
        txt = c.cast("string")
    return F.coalesce(txt, F.lit(missing))


def safe_div(a, b) -> Column:
    """Division that yields NULL instead of an ANSI divide-by-zero error."""
    return F.try_divide(col_(a), col_(b))


def signed_log(c) -> Column:
    c = col_(c)
    return F.signum(c) * F.log1p(F.abs(c))


def parse_optional_number(c) -> Column:
    """Remote score text -> double; '', 'none', 'nan' (any case) -> NULL."""
    t = F.lower(F.trim(col_(c)))
    return F.when(t.isin(*NULL_SCORE_TEXTS) | t.isNull(), F.lit(None).cast("double")).otherwise(
        t.try_cast("double"))


def malformed_number(c) -> Column:
    """Whether a remote score text is neither a known null text nor a number."""
    t = F.lower(F.trim(col_(c)))
    return t.isNotNull() & ~t.isin(*NULL_SCORE_TEXTS) & t.try_cast("double").isNull()


def close(a, b, rtol: float = 1e-5, atol: float = 1e-8) -> Column:
    """|a - b| <= atol + rtol * |b|; NULL equals NULL only."""
    a, b = col_(a), col_(b)
    near = F.abs(a - b) <= F.lit(atol) + F.lit(rtol) * F.abs(b)
    return (a.isNull() & b.isNull()) | F.coalesce(near | a.eqNullSafe(b), F.lit(False))


def observed(c) -> Column:
    """A numeric column with NaN read as NULL."""
    c = col_(c).cast("double")
    return F.when(~F.isnan(c), c)


def per_fold(fold_col, values: dict, default=None) -> Column:
    """Per-fold constant: ``try_element_at(array(v_1, ..., v_k), fold)``.

    The literal array folds into one constant, so each use is a single array
    access in generated code (a CASE per fold per feature blows up method size
    and falls out of JIT compilation on wide projections). Missing folds and
    folds outside 1..k give ``default``.
    """
    fold_col = col_(fold_col)
    if not values:
        return F.lit(default)
    if all(isinstance(f, int) and f >= 1 for f in values):
        arr = F.array(*[F.lit(values.get(i)) for i in range(1, max(values) + 1)])
        expr = F.try_element_at(arr, fold_col.cast("int"))
    else:
        expr = None
        for f, v in values.items():
            expr = F.when(fold_col == f, F.lit(v)) if expr is None else expr.when(fold_col == f, F.lit(v))
    return F.coalesce(expr, F.lit(default)) if default is not None else expr
