"""Prediction-table contracts (P10-P16, O1, O2, O8, J5) as violation tables.

A submission is checked against its template in one aggregate plus two anti
joins; the result is a small table ``(check, violations)`` so callers can
show every problem at once instead of failing on the first.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def normalize_label(df: DataFrame, c: str) -> Column:
    """P10: booleans and integral numbers as integer text, everything else as text."""
    dt = df.schema[c].dataType
    col = F.col(c)
    if isinstance(dt, T.BooleanType):
        return col.cast("int").cast("string")
    if isinstance(dt, (T.DoubleType, T.FloatType, T.DecimalType)):
        whole = (col == F.floor(col)) & (F.abs(col) < F.lit(1e15))
        return F.when(whole, F.floor(col).try_cast("bigint").cast("string")).otherwise(col.cast("string"))
    return col.cast("string")


def label_value(v) -> str:
    """P10 for a label given in Python."""
    if isinstance(v, bool) or (isinstance(v, (int, float, Decimal)) and v == int(v)):
        return str(int(v))
    return str(v)


def submission_violations(pred: DataFrame, template: DataFrame, id_col: str, label_col: str,
                          kind: str = "regression", labels: tuple | None = None) -> DataFrame:
    """P12-P16, O1, O2 (set part), O8, J5: one row per check with its violation count.

    ``kind``: 'regression' (numeric, non-null, finite), 'probability' (also in
    [0, 1]) or 'label' (non-null and one of ``labels``).
    """
    spark = pred.sparkSession
    cols_ok = int(pred.columns == [id_col, label_col])
    p = F.col(label_col)
    finite = ~(F.isnan(p.cast("double")) | (F.abs(p.cast("double")) == F.lit(float("inf"))))
    checks = [F.count(F.lit(1)).alias("pred_rows"), F.count_if(p.isNull()).alias("null_predictions")]
    if kind in ("regression", "probability"):
        checks.append(F.count_if(p.isNotNull() & ~finite).alias("non_finite_predictions"))
    if kind == "probability":
        checks.append(F.count_if(p.isNotNull() & finite & ((p < 0) | (p > 1))).alias("out_of_range"))
    if kind == "label":
        checks.append(F.count_if(p.isNotNull() & ~normalize_label(pred, label_col).isin(*[label_value(v) for v in labels]))
                      .alias("unknown_labels"))
    one = pred.agg(*checks)
    names = [c for c in one.columns if c != "pred_rows"]
    parts = [one.select(F.inline(F.array(*[F.struct(F.lit(n).alias("check"), F.col(n).cast("bigint").alias("violations"))
                                          for n in names])))]
    per_id = pred.groupBy(id_col).agg(F.count(F.lit(1)).alias("c"))
    parts.append(per_id.agg(F.lit("duplicate_ids").alias("check"), F.count_if(F.col("c") > 1).cast("bigint").alias("violations")))
    tmpl = template.select(id_col).distinct()
    parts.append(tmpl.join(pred.select(id_col), id_col, "left_anti")
                 .agg(F.lit("missing_ids").alias("check"), F.count(F.lit(1)).cast("bigint").alias("violations")))
    parts.append(pred.select(id_col).distinct().join(tmpl, id_col, "left_anti")
                 .agg(F.lit("unknown_ids").alias("check"), F.count(F.lit(1)).cast("bigint").alias("violations")))
    # row counts of both tables, signed, summed: |pred rows - template rows|
    counts = (pred.select(F.lit(1).alias("s")).unionByName(template.select(F.lit(-1).alias("s")))
              .agg(F.lit("row_count_mismatch").alias("check"), F.abs(F.sum("s")).cast("bigint").alias("violations")))
    parts.append(counts)
    spark = pred.sparkSession
    parts.append(spark.createDataFrame([("column_mismatch", 1 - cols_ok)], "check string, violations bigint"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def order_mismatches(pred: DataFrame, template: DataFrame, id_col: str, order_col: str = "row_idx") -> DataFrame:
    """O2 order part: ids present in both whose positions differ (needs explicit positions)."""
    a = pred.select(id_col, F.col(order_col).alias("p_pos"))
    b = template.select(id_col, F.col(order_col).alias("t_pos"))
    return a.join(b, id_col).agg(F.count_if(F.col("p_pos") != F.col("t_pos")).alias("order_mismatches"))


#: Values that a message shows of each kind.
PREVIEW = 10


def violation_previews(pred: DataFrame, template: DataFrame, id_col: str, most: int = PREVIEW) -> DataFrame:
    """(check, position, id): the first ids, in ascending order, that are duplicate, missing or unknown. Each is a top-k, not a sort."""
    ids, wanted = pred.select(id_col), template.select(id_col)
    found = {"duplicate_ids": ids.groupBy(id_col).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(id_col),
             "missing_ids": wanted.distinct().join(ids, id_col, "left_anti"), "unknown_ids": ids.distinct().join(wanted, id_col, "left_anti")}
    out = None
    for check, df in found.items():
        first = df.orderBy(id_col).limit(most).select(F.lit(check).alias("check"), F.col(id_col).cast("string").alias("id"), F.col(id_col).alias("_o"))
        out = first if out is None else out.unionByName(first)
    place = F.row_number().over(Window.partitionBy("check").orderBy("_o"))  # at most `most` rows a check
    return out.select("check", place.alias("position"), "id")


def raise_on_violations(violations: DataFrame, previews: DataFrame | None = None) -> None:
    """ValueError that names every violated check, with the ids of ``previews``."""
    bad = [(r["check"], r["violations"]) for r in violations.where(F.col("violations") > 0).collect()]
    if not bad:
        return
    shown: dict[str, list[str]] = {}
    for r in previews.orderBy("check", "position").collect() if previews is not None else []:
        shown.setdefault(r["check"], []).append(r["id"])
    raise ValueError("submission contract violated: " + ", ".join(f"{c}={n}" + (f" {shown[c]}" if c in shown else "") for c, n in bad))


#: Fixed value: the rule by which base candidates of an accuracy blend wrote their probabilities.
PROBABILITY_RULE = "average_fold_probabilities_then_threshold"


def probability_contracts(manifests: DataFrame, positive, negative, pair: tuple, rule: str = PROBABILITY_RULE) -> DataFrame:
    """(candidate_id, contract) of manifests (candidate_id, text): ok, unreadable, missing_contract (no rule, path, labels or pair),
    rule_mismatch or label_mismatch. Labels are compared as canonical text whatever their JSON type."""
    v = F.try_parse_json("text")
    get = lambda path: F.try_variant_get("m", path, "string")

    def label(path):
        # numbers: integral ones without a fraction; text as it is
        number = F.try_variant_get("m", path, "double")
        quoted = F.schema_of_variant(F.try_variant_get("m", path, "variant")) == "STRING"
        whole = (number == F.floor(number)) & (F.abs(number) < 1e15)
        truth = F.schema_of_variant(F.try_variant_get("m", path, "variant")) == "BOOLEAN"
        return F.when(truth, F.initcap(get(path))).when(~quoted & whole, F.floor(number).cast("bigint").cast("string")).otherwise(get(path))

    def named(value) -> str:
        return str(value) if isinstance(value, bool) else label_value(value)

    read = manifests.select("candidate_id", F.when(F.schema_of_variant(v).startswith("OBJECT"), v).alias("m"))
    fields = read.select("candidate_id", "m", get("$.binary_accuracy_blend_rule").alias("rule"), get("$.binary_accuracy_test_probability_path").alias("path"), label("$.positive_label").alias("pos"), label("$.negative_label").alias("neg"),
                         label("$.observed_label_pair[0]").alias("a"), label("$.observed_label_pair[1]").alias("b"), F.try_variant_get("m", "$.observed_label_pair[2]", "variant").isNull().alias("two"))
    absent = F.col("rule").isNull() | (F.coalesce("path", F.lit("")) == "") | F.col("pos").isNull() | F.col("neg").isNull() | F.col("a").isNull() | F.col("b").isNull() | ~F.col("two")
    same = (F.col("pos") == named(positive)) & (F.col("neg") == named(negative)) & (F.col("a") == named(pair[0])) & (F.col("b") == named(pair[1]))
    return fields.select("candidate_id", F.when(F.col("m").isNull(), "unreadable").when(absent, "missing_contract").when(F.col("rule") != rule, "rule_mismatch").when(~same, "label_mismatch").otherwise("ok").alias("contract"))
