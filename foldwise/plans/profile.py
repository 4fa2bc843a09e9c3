"""Dataset profiles (A1-A9) and feature typing.

Column-wise reports use a long (column, value-text) form, so one distinct
aggregation serves every column instead of one Expand copy per distinct
aggregate; quantiles come from the exact distributed selection.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foldwise.operators import stats as st

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)
INTEGER_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
UNSUPPORTED = (T.ArrayType, T.MapType, T.StructType, T.BinaryType)


def is_number(dt) -> bool:
    return isinstance(dt, NUMERIC_TYPES)


def _long_text(df: DataFrame, cols: list[str]) -> DataFrame:
    arr = F.array(*[F.struct(F.lit(c).alias("col"), F.col(c).cast("string").alias("v")) for c in cols])
    return df.select(F.inline(arr))


def null_and_distinct(df: DataFrame, cols: list[str]) -> DataFrame:
    """(column, rows, null_count, nunique_dropna, nunique) -- null counts as one value in nunique."""
    lg = _long_text(df, cols)
    per_value = lg.groupBy("col", "v").agg(F.count(F.lit(1)).alias("n"))
    return per_value.groupBy("col").agg(
        F.sum("n").alias("rows"),
        F.coalesce(F.sum(F.when(F.col("v").isNull(), F.col("n"))), F.lit(0)).alias("null_count"),
        F.count("v").alias("nunique_dropna"),
        F.count(F.lit(1)).alias("nunique"),
    ).withColumnRenamed("col", "column")


def column_summary(df: DataFrame) -> DataFrame:
    """A1: column, dtype, null_count, null_pct, nunique."""
    spark = df.sparkSession
    types = spark.createDataFrame([(c, df.schema[c].dataType.simpleString()) for c in df.columns],
                                  "column string, dtype string")
    s = null_and_distinct(df, df.columns)
    return (s.join(F.broadcast(types), "column")
            .select("column", "dtype", F.col("null_count").cast("bigint"),
                    (F.col("null_count") / F.col("rows")).alias("null_pct"), F.col("nunique").cast("bigint")))


def missingness(train: DataFrame, test: DataFrame) -> DataFrame:
    """A2: dataset, column, null_count, null_pct; sorted dataset, null_pct desc, column."""
    parts = []
    for name, df in (("train", train), ("test", test)):
        aggs = [F.count(F.lit(1)).alias("__rows")] + [F.count_if(F.col(c).isNull()).alias(c) for c in df.columns]
        one = df.agg(*aggs)
        arr = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("null_count")) for c in df.columns])
        parts.append(one.select(F.lit(name).alias("dataset"), F.col("__rows"), F.inline(arr)))
    out = parts[0].unionByName(parts[1])
    return (out.select("dataset", "column", F.col("null_count").cast("bigint"),
                       (F.col("null_count") / F.col("__rows")).alias("null_pct"))
            .orderBy("dataset", F.desc("null_pct"), "column"))


def cardinality(train: DataFrame, test: DataFrame) -> DataFrame:
    """A3: non-number columns of each table: dataset, column, nunique, null_count, null_pct."""
    parts = []
    for name, df in (("train", train), ("test", test)):
        cols = [c for c in df.columns if not is_number(df.schema[c].dataType)]
        s = null_and_distinct(df, cols)
        parts.append(s.select(F.lit(name).alias("dataset"), "column", F.col("nunique").cast("bigint"),
                              F.col("null_count").cast("bigint"),
                              (F.col("null_count") / F.col("rows")).alias("null_pct")))
    return parts[0].unionByName(parts[1]).orderBy("dataset", F.desc("nunique"), "column")


def target_summary_numeric(train: DataFrame, label: str) -> DataFrame:
    """A4: count, mean, std (sample), min, 25%, 50%, 75%, max of a numeric label."""
    spark = train.sparkSession
    y = F.col(label).cast("double")
    row = train.agg(F.count(y).alias("count"), F.avg(y).alias("mean"), F.stddev_samp(y).alias("std"),
                    F.min(y).alias("min"), F.max(y).alias("max")).collect()[0]
    lg = train.select(F.lit(1).alias("fold"), F.lit(label).alias("key"), y.alias("x")).where(F.col("x").isNotNull())
    q = st.complement_quantiles(lg, [label], [0], [0.25, 0.5, 0.75], "linear")[(label, 0)]
    rows = [("count", float(row["count"])), ("mean", row["mean"]), ("std", row["std"]), ("min", row["min"]),
            ("25%", q[0]), ("50%", q[1]), ("75%", q[2]), ("max", row["max"])]
    return spark.createDataFrame(rows, "metric string, value double")


def target_summary_categorical(train: DataFrame, label: str) -> DataFrame:
    """A5: value_<v>_count and value_<v>_ratio per label value (null included)."""
    total = F.sum("n").over(Window.partitionBy())
    counts = train.groupBy(F.col(label).cast("string").alias("v")).agg(F.count(F.lit(1)).alias("n"))
    # one row per distinct label value: a handful for a classification label
    with_total = counts.withColumn("t", total)
    v = F.coalesce(F.col("v"), F.lit("nan"))
    a = with_total.select(F.concat(F.lit("value_"), v, F.lit("_count")).alias("metric"),
                          F.col("n").cast("double").alias("value"))
    b = with_total.select(F.concat(F.lit("value_"), v, F.lit("_ratio")).alias("metric"),
                          (F.col("n") / F.col("t")).alias("value"))
    return a.unionByName(b)


def resolve_feature_types(train: DataFrame, features: list[str], force_categorical=(), force_numeric=(),
                          low_cardinality_int_threshold: int | None = None) -> tuple[list, list]:
    """Numeric vs categorical. Integer columns without nulls and with at most
    the threshold of distinct values become categorical; booleans, strings and
    timestamps are categorical; forced lists apply last (categorical first)."""
    overlap = set(force_categorical) & set(force_numeric)
    if overlap:
        raise ValueError(f"columns forced both numeric and categorical: {sorted(overlap)}")
    for c in features:
        if isinstance(train.schema[c].dataType, UNSUPPORTED):
            raise ValueError(f"unsupported feature type for column '{c}': {train.schema[c].dataType}")
    numeric = {c for c in features if is_number(train.schema[c].dataType)}
    if low_cardinality_int_threshold is not None:
        ints = [c for c in features if isinstance(train.schema[c].dataType, INTEGER_TYPES)]
        if ints:
            s = {r["column"]: r for r in null_and_distinct(train.select(*ints), ints).collect()}
            for c in ints:
                if s[c]["null_count"] == 0 and s[c]["nunique_dropna"] <= low_cardinality_int_threshold:
                    numeric.discard(c)
    numeric -= set(force_categorical)
    numeric |= set(force_numeric)
    return [c for c in features if c in numeric], [c for c in features if c not in numeric]


def feature_type_counts(numeric: list, categorical: list) -> list[tuple]:
    """A6."""
    return [("numeric", len(numeric)), ("categorical", len(categorical)), ("total", len(numeric) + len(categorical))]


def prepare_feature_frames(train: DataFrame, test: DataFrame, id_column: str, label_column: str,
                           drop_columns=(), force_categorical=(), force_numeric=()):
    """Feature tables without id, label and dropped columns; validated names."""
    for c in list(drop_columns) + list(force_categorical) + list(force_numeric):
        if c not in train.columns:
            raise ValueError(f"configured column '{c}' is not in the training table")
    if set(force_categorical) & set(force_numeric):
        raise ValueError("a column cannot be forced numeric and categorical")
    drop = {id_column, label_column, *drop_columns}
    feats = [c for c in train.columns if c not in drop]
    missing = [c for c in feats if c not in test.columns]
    if missing:
        raise ValueError(f"feature columns missing from the test table: {missing}")
    return train.select(*feats), test.select(*feats), train.select(label_column)


def run_summary(train: DataFrame, test: DataFrame, feature_count: int) -> DataFrame:
    """Rows, columns, mean missing share, duplicate rows, feature count."""
    spark = train.sparkSession
    vals = []
    for name, df in (("train", train), ("test", test)):
        cols = df.columns
        aggs = [F.count(F.lit(1)).alias("rows")] + [F.count_if(F.col(c).isNull()).alias(c) for c in cols]
        r = df.agg(*aggs).collect()[0]
        rows = r["rows"]
        miss = sum(r[c] / rows for c in cols) / len(cols) if rows else 0.0
        # rows that share 96 bits of hash are duplicates: two numbers a row are shuffled instead of the whole
        # row; the hashes skip NULLs, so where they are is hashed too
        nulls = F.concat(*[F.when(F.col(c).isNull(), "1").otherwise("0") for c in cols])
        distinct_rows = df.select(F.xxhash64(nulls, *cols).alias("h"), F.hash(nulls, *cols).alias("g")).distinct().count()
        vals += [(f"{name}_rows", float(rows)), (f"{name}_cols", float(len(cols))),
                 (f"{name}_missing_pct", miss), (f"{name}_duplicate_rows", float(rows - distinct_rows))]
    vals.append(("model_feature_count", float(feature_count)))
    return spark.createDataFrame(vals, "metric string, value double")


def target_stats_regression(train: DataFrame, label: str) -> DataFrame:
    """Mean, population std, min, max."""
    y = F.col(label).cast("double")
    return train.agg(F.avg(y).alias("mean"), F.stddev_pop(y).alias("std"), F.min(y).alias("min"),
                     F.max(y).alias("max"))


def target_stats_binary(train: DataFrame, label: str, positive=1) -> DataFrame:
    """Positive / negative counts and prevalence."""
    pos = F.col(label) == F.lit(positive)
    return train.agg(F.count_if(pos).alias("positive_count"), F.count_if(~pos).alias("negative_count"),
                     F.avg(pos.cast("double")).alias("prevalence"))


def binary_label_pair(train: DataFrame, label: str) -> list:
    """The two label values (null counts as a value); error otherwise."""
    vals = [r[0] for r in train.select(label).distinct().limit(3).collect()]
    if len(vals) != 2:
        raise ValueError(f"binary tasks need exactly two labels, got {len(vals)}: {vals}")
    return vals


# Label pairs whose positive member is known, by the type of the label column.
KNOWN_LABELS = (
    (T.BooleanType, False, True),
    (T.IntegralType, 0, 1),
    (T.StringType, "No", "Yes"),
)
PYTHON_LABELS = {bool: T.BooleanType(), int: T.LongType(), str: T.StringType()}


def positive_label(pair: list, dtype: T.DataType | None = None, configured=None):
    """The configured label, or the positive one where the label column's type and its two
    values are a known pair. The type decides: 0.0 / 1.0 in a floating column is not known."""
    if configured is not None:
        if not any(type(configured) is type(v) and configured == v for v in pair):
            raise ValueError("configured positive label is not one of the observed labels")
        return configured
    if dtype is None:  # no column at hand: the type that Spark gives such Python values
        kinds = {type(v) for v in pair}
        dtype = PYTHON_LABELS.get(kinds.pop()) if len(kinds) == 1 else None
    for kind, negative, positive in KNOWN_LABELS:
        if isinstance(dtype, kind) and set(pair) == {negative, positive}:
            return positive
    raise ValueError(f"cannot infer the positive label from {pair}; configure it")
