"""Fold assignment (KFold, shuffled KFold, stratified KFold) without a global sort.

A global ``row_number() OVER (ORDER BY ...)`` puts every row into one task.
Instead rows are ranked inside small key buckets and shifted by the row count of
all earlier buckets:

* shuffled order: bucket = first hex digits of ``md5('<seed>:' || id)``; md5 is
  uniform, so buckets are balanced whatever the id distribution is;
* natural order (unshuffled KFold): range partitions of the id
  (``repartitionByRange``) of about RANGE_ROWS rows, numbered by ``spark_partition_id()``.
  They are sorted and numbered where they are, without a second shuffle.

The per-bucket count table has at most ``16 ** prefix_len`` rows (per class), a
bound fixed by the parameter, or one row a range partition, so it is broadcast.

Fold sizes follow the usual k-fold rule: the first ``n % k`` folds get one extra
row. Stratified folds give class ``c`` the fold sizes obtained by dealing the
class-sorted label list round-robin over the folds, and assign them in blocks
along the hashed order inside the class. Folds are numbered 1..k.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foldwise.session import cut_lineage


def hash_key(id_col: str, seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string")))


def _kfold_from_rank(rank: Column, n: Column, k: int) -> Column:
    q = F.floor(n / F.lit(k))
    rem = n - q * F.lit(k)
    big = rem * (q + 1)
    return (F.when(rank < big, F.floor(rank / (q + 1)))
            .otherwise(rem + F.floor((rank - big) / q)) + 1).cast("int")


#: Hex digits of the hash prefix: 4096 buckets whatever the number of rows, so that the offsets table
#: and its window are bounded. Buckets grow with the data and are sorted with spilling.
PREFIX_LEN = 3
#: Rows of a range partition: their number grows with the data, so that no task does.
RANGE_ROWS = 250_000


def ranked(df: DataFrame, id_col: str, *, seed: int | None = 42, by: list[str] | None = None,
           prefix_len: int = PREFIX_LEN, range_partitions: int | None = None) -> DataFrame:
    """Adds ``_rank`` (0-based position in hashed or id order within ``by``) and
    ``_n`` (rows within ``by``)."""
    by = list(by or [])
    if seed is not None:
        h = hash_key(id_col, seed)
        base = df.withColumn("_h", h).withColumn("_b", F.substring("_h", 1, prefix_len))
        order = [F.col("_h"), F.col(id_col)]
    else:
        parts = range_partitions or max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // RANGE_ROWS))
        # Range bounds come from a sample seeded by the RDD id, so two executions
        # can cut differently: materialise the partition numbers once (reliable
        # checkpoint) so the counts and the in-partition ranks see the same cut.
        cut = df.repartitionByRange(parts, F.col(id_col)).sortWithinPartitions(id_col)
        part = F.spark_partition_id()
        # the id of a row is its partition's number, then 33 bits for its place in the partition
        place = F.monotonically_increasing_id() - F.shiftleft(part.cast("bigint"), 33) + 1
        base = cut_lineage(cut.withColumns({"_b": F.lpad(part.cast("string"), 10, "0"), "_rn": place}))
        order = [F.col(id_col)]
    counts = base.groupBy(*by, "_b").agg(F.count(F.lit(1)).alias("_cnt"))
    w_before = Window.partitionBy(*by).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        *by, "_b",
        F.coalesce(F.sum("_cnt").over(w_before), F.lit(0)).alias("_off"),
        F.sum("_cnt").over(Window.partitionBy(*by)).alias("_n"),
    )
    if seed is not None or by:
        base = base.withColumn("_rn", F.row_number().over(Window.partitionBy(*by, "_b").orderBy(*order)))
    out = (base.join(F.broadcast(offsets), on=[*by, "_b"], how="inner")
           .withColumn("_rank", F.col("_off") + F.col("_rn") - 1))
    drop = ["_b", "_rn", "_off"] + (["_h"] if seed is not None else [])
    return out.drop(*drop)


def kfold(df: DataFrame, id_col: str, k: int = 5, *, shuffle: bool = True, seed: int = 42,
          fold_col: str = "fold", prefix_len: int = PREFIX_LEN) -> DataFrame:
    """KFold (V1/V2): adds ``fold`` in 1..k."""
    r = ranked(df, id_col, seed=seed if shuffle else None, prefix_len=prefix_len)
    return r.withColumn(fold_col, _kfold_from_rank(F.col("_rank"), F.col("_n"), k)).drop("_rank", "_n")


def _count_congruent(start: Column, length: Column, j: int, k: int) -> Column:
    """#{i in [start, start+length) : i mod k == j}."""
    hi = F.floor((start + length - 1 - j) / F.lit(k))
    lo = F.floor((start - 1 - j) / F.lit(k))
    return hi - lo


def stratified_kfold(df: DataFrame, id_col: str, label_col: str, k: int = 5, *, seed: int = 42,
                     fold_col: str = "fold", prefix_len: int = PREFIX_LEN) -> DataFrame:
    """StratifiedKFold (V3): adds ``fold`` in 1..k.

    Classes are ordered by label value; class ``c`` occupies positions
    ``[start_c, start_c + n_c)`` of the sorted label list, and fold ``j`` takes
    the positions congruent to ``j - 1`` modulo k.
    """
    r = ranked(df, id_col, seed=seed, by=[label_col], prefix_len=prefix_len)
    class_n = r.groupBy(label_col).agg(F.first("_n").alias("_nc"))
    w = Window.orderBy(label_col).rowsBetween(Window.unboundedPreceding, -1)
    class_start = class_n.select(label_col, F.coalesce(F.sum("_nc").over(w), F.lit(0)).alias("_start"))
    r = r.join(F.broadcast(class_start), on=label_col, how="inner")
    start, n = F.col("_start"), F.col("_n")
    cum = None
    fold = None
    for j in range(k):
        size = _count_congruent(start, n, j, k)
        cum = size if cum is None else cum + size
        cond = F.col("_rank") < cum
        fold = F.when(cond, F.lit(j + 1)) if fold is None else fold.when(cond, F.lit(j + 1))
    return r.withColumn(fold_col, fold.cast("int")).drop("_rank", "_n", "_start")


def validate_folds(folds: DataFrame, id_col: str, k: int, fold_col: str = "fold") -> DataFrame:
    """(check, violations) rows; all zero means every row is in exactly
    one fold 1..k and every fold has rows on both sides."""
    per_id = folds.groupBy(id_col).agg(F.count(F.lit(1)).alias("c"))
    dup = per_id.agg(F.lit("duplicate_ids").alias("check"), F.count_if(F.col("c") > 1).cast("bigint").alias("violations"))
    sizes = folds.groupBy(fold_col).agg(F.count(F.lit(1)).alias("valid_rows"))
    total = F.sum("valid_rows").over(Window.partitionBy())  # at most k + 1 rows
    s = sizes.withColumn("n", total)
    bad = s.agg(
        F.count_if(F.col(fold_col).isNull() | (F.col(fold_col) < 1) | (F.col(fold_col) > k)).alias("out_of_range"),
        (F.lit(k) - F.count_if((F.col(fold_col) >= 1) & (F.col(fold_col) <= k))).alias("empty_folds"),
        F.count_if(F.col("valid_rows") >= F.col("n")).alias("empty_train_sides"))
    arr = F.array(*[F.struct(F.lit(c).alias("check"), F.col(c).cast("bigint").alias("violations"))
                    for c in ("out_of_range", "empty_folds", "empty_train_sides")])
    return dup.unionByName(bad.select(F.inline(arr)))
