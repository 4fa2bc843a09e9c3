"""Table sources (S1-S4) and role inference."""

from __future__ import annotations

import os
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType
from pyspark.sql.utils import AnalysisException

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def read_table(spark: SparkSession, sf_dir: str, name: str, fmt: str = "parquet",
               schema=None) -> DataFrame:
    """Read one table; a missing table is an error naming it."""
    path = name if os.path.isabs(name) or "://" in name else os.path.join(sf_dir, f"{name}.{fmt}")
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    try:
        if fmt == "csv":
            return reader.option("header", "true").option("inferSchema", schema is None).csv(path)
        return reader.format(fmt).load(path)
    except AnalysisException as exc:  # path does not exist
        raise FileNotFoundError(f"table '{name}' not found at {path}") from exc


def read_checked(spark: SparkSession, path: str, schema: StructType, fmt: str = "json", header: bool = True) -> tuple[DataFrame, DataFrame]:
    """S1 for text formats (json lines, csv): (rows that fit the schema, the other lines as ``line``).

    Kept and quarantined rows together are the file's lines; nothing is silently read as null. Blank lines, and csv lines
    that are the header, are none; a csv record is one line."""
    whole = StructType([*schema.fields, StructField("_corrupt", StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
    lines = spark.read.text(path).where(F.trim("value") != "")
    if fmt == "json":
        row = F.from_json("value", whole, options)
    else:
        lines = lines.where(F.col("value") != ",".join(schema.names)) if header else lines
        row = F.from_csv("value", ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in whole.fields), options)
    rows = lines.select("value", row.alias("row"))
    fits = F.col("row").isNotNull() & F.col("row._corrupt").isNull()
    return rows.where(fits).select(*[F.col(f"row.`{n}`").alias(n) for n in schema.names]), rows.where(~fits).select(F.col("value").alias("line"))


@dataclass(frozen=True)
class DatasetContext:
    """Train / test / template tables plus the resolved id and label names."""

    train: DataFrame
    test: DataFrame
    template: DataFrame
    id_column: str
    label_column: str


def resolve_id_and_label(train_cols, test_cols, template_cols, id_column=None, label_column=None):
    """id = in all three tables; label = in train and template but not test."""
    tr, te, tp = list(train_cols), set(test_cols), set(template_cols)
    id_candidates = [c for c in tr if c in te and c in tp]
    label_candidates = [c for c in tr if c in tp and c not in te]

    def pick(configured, candidates, what):
        if configured is not None:
            if configured not in candidates:
                raise ValueError(f"configured {what} column '{configured}' is not a candidate: {candidates}")
            return configured
        if len(candidates) != 1:
            raise ValueError(f"expected exactly one {what} column candidate, found {candidates}")
        return candidates[0]

    return pick(id_column, id_candidates, "id"), pick(label_column, label_candidates, "label")


def validate_template_schema(template_cols, id_column: str, label_column: str) -> None:
    """The template holds exactly [id, label], in this order."""
    if list(template_cols) != [id_column, label_column]:
        raise ValueError(
            f"template columns must be exactly {[id_column, label_column]}, got {list(template_cols)}")


def load_dataset(train: DataFrame, test: DataFrame, template: DataFrame,
                 id_column: str | None = None, label_column: str | None = None) -> DatasetContext:
    idc, lab = resolve_id_and_label(train.columns, test.columns, template.columns, id_column, label_column)
    validate_template_schema(template.columns, idc, lab)
    return DatasetContext(train, test, template, idc, lab)


def load_dataset_dir(spark: SparkSession, directory: str, fmt: str = "parquet", **kw) -> DatasetContext:
    """Train / test / template read from one directory in one call."""
    t = {n: read_table(spark, directory, n, fmt) for n in ("train", "test", "template")}
    return load_dataset(t["train"], t["test"], t["template"], **kw)
