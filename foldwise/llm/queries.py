"""The operators applied to the given tables, each over its whole table, and the pipeline."""

from __future__ import annotations

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .chat_format import conversation_digests, format_conversations
from .conversation_repair import damage, repair_conversations, repair_digests
from .decontaminate import find_contaminated
from .exact_dedup import dedup_exact
from .jaccard_join import jaccard_components
from .line_dedup import dedup_lines
from .mixing import mix_sources
from .pii import BASE, find_pii, span_text
from .quality import fit, score_documents
from .substring_dedup import remove_repeats
from .toxicity import fit as fit_toxicity, score_toxicity
from .url_filter import filter_urls
from .vector_codes import encode_vectors

URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-7, 0, "user", marked), (-7, 1, "assistant", marked)], "conv_id long, turn long, role string, text string")
    turns = _read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(more)
    return conversation_digests(format_conversations(turns), ranged=True)


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix_sources(_read(spark, sf_dir, "documents"), weights=(1, 2, 3), most_epochs=3)
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op3_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard_components(_read(spark, sf_dir, "documents"), size=4, num=85, den=100)
    return found.select("doc_id", "n_shingles", "component_id")


def held_out():
    """The fifth of the ids whose labels are never learned from. A row without an id is not held out."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))


def quality_model(spark: SparkSession, sf_dir: str):
    labels = _read(spark, sf_dir, "labels").where(~held_out())
    return fit(_read(spark, sf_dir, "documents"), labels, "quality")


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = score_documents(_read(spark, sf_dir, "documents"), quality_model(spark, sf_dir))
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_exact(_read(spark, sf_dir, "documents"))


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(_read(spark, sf_dir, "pages"), URL_RULES).select("page_id", "host", "path", "rule", "verdict")


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = dedup_lines(_read(spark, sf_dir, "documents"), min_docs=10)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept_text"), 256).alias("kept_sha256"))


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_pii(_read(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return found.select("doc_id", *[count(k).alias(f"n_{k}") for k in BASE], F.sha2(span_text(base), 256).alias("base_sha256"), span_text(F.col("spans")).alias("spans"))


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_contaminated(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"), rate=0.2)


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = remove_repeats(_read(spark, sf_dir, "documents"), window=50)
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text"), 256).alias("kept_sha256"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = repair_conversations(damage(_read(spark, sf_dir, "conversations")), copies="copies")
    return repair_digests(pieces, ordered=True)


def toxicity_model(spark: SparkSession, sf_dir: str):
    labels = _read(spark, sf_dir, "labels").where(~held_out())
    return fit_toxicity(_read(spark, sf_dir, "documents"), labels, "toxic")


def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = score_toxicity(_read(spark, sf_dir, "documents"), toxicity_model(spark, sf_dir))
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = encode_vectors(_read(spark, sf_dir, "embeddings"), parts=4, entries=256, rounds=4, scale=1024.0)
    digest = books.sha256 if books else None
    return coded.select("vec_id", "code", "error", "label_error", F.lit(digest).cast("string").alias("codebooks_sha256"))


QUERIES = {
    "op1_chat_format": op1_chat_format,
    "op2_mix_sources": op2_mix_sources,
    "op3_ngram_jaccard": op3_ngram_jaccard,
    "op4_quality": op4_quality,
    "op5_exact_dedup": op5_exact_dedup,
    "op6_url_filter": op6_url_filter,
    "op7_line_dedup": op7_line_dedup,
    "op8_pii": op8_pii,
    "op9_decontaminate": op9_decontaminate,
    "op10_substring_dedup": op10_substring_dedup,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_toxicity": op12_toxicity,
    "op13_vector_codes": op13_vector_codes,
    "pipeline": corpus_pipeline.run,
}
