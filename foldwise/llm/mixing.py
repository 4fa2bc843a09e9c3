"""Mixing sources to target weights.

Every document gets a hash-random key. Its source's rows are range-sorted by that
key in two levels: a fixed number of key ranges (cells) per source, and the order
inside a cell. Prefix sums of word counts are sums over earlier cells (a table of at
most CELLS rows a source) plus a running sum inside the cell, so no task ever
holds a source. Each source is cut at exactly its budget of words; budgets above
the source's size repeat whole epochs first. The document at the cut gives its
first words.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .base import WORD, cut, prepare

#: Key ranges per source (three hex digits of the key). Constant: it bounds the offsets table, while cells grow with the data and are sorted with spilling.
CELL_DIGITS = 3


def source_key():
    """The source as a key that is never null, so that windows and joins share one partitioning."""
    return F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit(""))


def source_targets(totals: DataFrame, weights=(1, 2, 3), most_epochs: int = 3) -> DataFrame:
    """(source, source_size) -> plus weight and target.

    Sources in code point order, null last, take the weights in turn. They share
    the sum of all sizes by weight; a target stops at most_epochs times its
    source's size and the excess is shared again by weight until none is above.
    Source ranks come from a distributed sort; each round sends three numbers to
    the driver."""
    spark = totals.sparkSession
    ordered = totals.orderBy(F.col("source").asc_nulls_last())
    ranked = spark.createDataFrame(ordered.rdd.zipWithIndex().map(lambda x: (x[0]["source"], x[0]["source_size"], x[1])), "source string, source_size long, rank long")
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    rows = cut(ranked.select("source", "source_size", weight.cast("long").alias("weight"), (F.col("source_size") * most_epochs).alias("_most")))
    capped = F.lit(False)
    seen = -1
    while True:
        at = rows.select(F.sum("source_size").alias("t"), F.sum(F.when(capped, F.col("_most")).otherwise(0)).alias("c"),
                         F.sum(F.when(~capped, F.col("weight")).otherwise(0)).alias("w"), F.sum(capped.cast("long")).alias("n")).first()
        total, fixed, weight_left, n = (int(x or 0) for x in (at["t"], at["c"], at["w"], at["n"]))
        left = total - fixed
        if n == seen or weight_left == 0:
            break
        seen = n
        # target > most  <=>  left * weight > most * weight_left, in whole numbers
        wide = "decimal(38,0)"
        capped = F.col("_most").cast(wide) * F.lit(weight_left).cast("decimal(18,0)") <= F.lit(left).cast(wide) * F.col("weight").cast("decimal(10,0)")
    share = (F.lit(float(left)) * F.col("weight")) / F.lit(float(max(weight_left, 1)))
    target = F.when(capped, F.col("_most").cast("double")).otherwise(share) if total else F.lit(0.0)
    return rows.select("source", "source_size", "weight", target.alias("target"))


def mix_sources(docs: DataFrame, weights=(1, 2, 3), most_epochs: int = 3, seed: int = 42, carry: list[str] | None = None) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, full_copies, extra_words, taken, and the columns of carry.

    ``taken = full_copies * size + extra_words`` is what the mix takes of the
    document. size counts words ``[^\\x20\\x09-\\x0D]+``; null or empty text: 0, then
    taken is 0 too. The order within a source is by md5 of seed and doc_id (of
    the text where doc_id is null), then by doc_id, size and text digest: equal
    rows are interchangeable, and reruns agree. A null source is a source of its
    own, the last in order. An empty table gives no rows. Other columns of docs
    are never read unless named in carry, and cannot clash: they travel in a struct."""
    prepare(docs.sparkSession)
    text = F.coalesce(F.col("text"), F.lit(""))
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.md5(text))))
    sized = docs.select("doc_id", "source", F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"), key.alias("_key"), F.xxhash64(text).alias("_th"),
                        *([F.struct(*[F.col(c) for c in carry]).alias("_row")] if carry else []))
    sized = sized.withColumn("_cell", F.substring("_key", 1, CELL_DIGITS)).withColumn("_source", source_key())
    cells = cut(sized.groupBy("source", "_cell").agg(F.sum("size").alias("_sum")))
    targets = source_targets(cells.groupBy("source").agg(F.sum("_sum").alias("source_size")), weights, most_epochs)
    cells = cells.withColumn("_source", source_key())
    earlier = Window.partitionBy("_source").orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    offsets = cells.withColumn("_before", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)))
    offsets = offsets.join(targets.withColumn("_source", source_key()).drop("source"), "_source").select("_source", "_cell", "_before", "source_size", "target")
    inside = Window.partitionBy("_source", "_cell").orderBy("_key", F.col("doc_id").asc_nulls_last(), "size", "_th").rowsBetween(Window.unboundedPreceding, -1)
    placed = sized.withColumn("_in", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    placed = placed.join(offsets, ["_source", "_cell"])
    budget = F.floor(F.col("target") + 0.5)
    copies = F.when(F.col("source_size") > 0, F.expr("floor(target + 0.5) div source_size")).otherwise(0).cast("long")
    out = placed.withColumn("full_copies", copies)
    rest = budget - F.col("full_copies") * F.col("source_size") - F.col("_before") - F.col("_in")
    out = out.withColumn("extra_words", F.least(F.col("size"), F.greatest(rest, F.lit(0))).cast("long"))
    return out.select("doc_id", "source", "size", "source_size", "target", "full_copies", "extra_words",
                      (F.col("full_copies") * F.col("size") + F.col("extra_words")).alias("taken"), *(["_row"] if carry else []))
