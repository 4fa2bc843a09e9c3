"""The corpus pipeline: its stages over documents, each one of the ten operators.

quality classifier (documents that it rejects go) -> line dedup (frequent lines go) ->
n-gram Jaccard join (one document of each group of near duplicates stays) ->
benchmark decontamination (documents that hold a benchmark passage go) -> mixing
sources to target weights (documents that the mix takes, with how many words).
Each stage's result is written as Parquet in the shared folder and read again.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foldwise.llm.base import prepare, shared_dir
from foldwise.llm.decontaminate import drop_contaminated
from foldwise.llm.jaccard_join import keep_one_of_each
from foldwise.llm.line_dedup import dedup_lines
from foldwise.llm.mixing import mix_sources
from foldwise.llm.quality import fit, keep_quality

LEAST_QUALITY = 0.3


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose score is at least LEAST_QUALITY; learned from the labels whose crc32(doc_id) mod 5 is not 0."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(F.crc32(F.col("doc_id").cast("string")) % 5 != 0)
    return keep_quality(docs, fit(docs, labels, "quality"), LEAST_QUALITY)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row, its text without the lines that at least 10 documents have; n_chars follows the text."""
    kept = dedup_lines(docs, min_docs=10, carry=[c for c in docs.columns if c != "text"], as_row=True)
    text = {"text": F.col("kept_text"), "n_chars": F.length("kept_text").cast("long")}
    return kept.select(*[text[c].alias(c) if c in text else F.col("_row")[c].alias(c) for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates: five-word shingles, similarity 0.8 or more."""
    return keep_one_of_each(docs, size=5, num=80, den=100)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold no benchmark item, up to a fifth of its words edited."""
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), rate=0.2)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows that the mix takes: the columns of documents, size, source_size, target, and taken (words, repeats counted)."""
    mixed = mix_sources(docs.select("doc_id", "text", "lang", "source", "n_chars"), weights=(1, 2, 3), most_epochs=3, carry=["doc_id", "text", "lang", "source", "n_chars"])
    return mixed.where("taken > 0").select("_row.*", "size", "source_size", "target", "taken")


STAGES = [
    ("quality classifier", quality),
    ("line dedup", line_dedup),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontaminate),
    ("mixing sources", mix),
]

#: The quality stage votes among learned vectors, so its rows can't be written in SQL; tests/llm compares run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over documents: doc_id, text, lang, source, n_chars, size, source_size, target, taken.

    Null and empty texts have the score of a text without words, one line and no shingle or benchmark passage, and the mix takes
    nothing of them; rows without an id are rows like others, rows equal in id and text are one from the third stage on. An
    empty table gives no rows. Extra columns go along, whatever their names, up to the mix, which returns its own and those of documents."""
    prepare(spark)
    folder = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        path = f"{folder}/{i}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
