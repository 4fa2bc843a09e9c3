"""Exact dedup with an extendible-hash index on shared files.

A text's key is the 64-bit xxhash of the text with A-Z lower-cased. The directory
starts with one bucket; a bucket that holds more than ``bucket_bytes`` of text is
split by the next bit of the key, until every bucket fits or holds a single key,
whose entries are chained. The directory is kept as the sorted lowest keys of the
buckets, as many as the data fill. Owner tasks get contiguous bucket ranges, sort
them by key and text, compare bytes, and number the different texts of one key (a
collision chain). Their files on the shared folder are the index. Later batches are looked up
in it, or inserted: a bucket that overflows is split by further bits of the key (the directory doubles where
its depth doesn't reach), and the owners chain the new texts behind those that the index has.

Scan tasks combine each batch before the shuffle: a text travels once a batch,
with the list of its documents, however many copies the batch holds.
"""

from __future__ import annotations

import hashlib
import uuid
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .base import LOWER, cut, prepare, shared_dir, text_buffers

_SIGN = 1 << 63
_PIECE = "bucket int, h long, text binary, sha256 string, ids array<long>"
_ENTRY = "bucket int, h long, chain int, piece long, text binary, sha256 string, ids array<long>"


def _normal(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(lower-cased bytes, offsets, keys) of the batch; null texts are empty."""
    data, off = text_buffers(batch.column("text"))
    data = LOWER[data[:off[-1]]] if len(data) else data
    view = memoryview(data)
    keys = np.fromiter((xxhash.xxh3_64_intdigest(view[a:b]) for a, b in zip(off[:-1].tolist(), off[1:].tolist(), strict=True)), dtype=np.uint64, count=len(off) - 1)
    return data, off, keys


def _keys(batches):
    for batch in batches:
        _, off, keys = _normal(batch)
        yield pa.RecordBatch.from_arrays([pa.array((keys ^ np.uint64(_SIGN)).view(np.int64)), pa.array(np.diff(off))], ["h", "bytes"])


def _pieces(batches, starts: np.ndarray):
    """One row per different text of a batch: bucket, key, text, sha256, its documents (largest first, null last)."""
    for batch in batches:
        data, off, keys = _normal(batch)
        view = memoryview(data)
        texts: dict[tuple[int, bytes], int] = {}
        group = np.empty(len(keys), dtype=np.int64)
        rows, shas = [], []
        for i, (key, a, b) in enumerate(zip(keys.tolist(), off[:-1].tolist(), off[1:].tolist(), strict=True)):
            text = bytes(view[a:b])
            at = texts.setdefault((key, text), len(rows))
            if at == len(rows):
                rows.append(i)
                shas.append(hashlib.sha256(text).hexdigest())
            group[i] = at
        ids = batch.column("doc_id")
        known = np.asarray(ids.is_valid())
        value = ids.fill_null(0).to_numpy()
        order = np.lexsort((-value, ~known, group))
        ends = np.concatenate([[0], np.cumsum(np.bincount(group, minlength=len(rows)))])
        signed = (keys ^ np.uint64(_SIGN)).view(np.int64)[rows]
        text_column = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(off) - 1, [None, pa.py_buffer(np.ascontiguousarray(off)), pa.py_buffer(data)]).take(pa.array(rows, pa.int64())).cast(pa.binary())
        yield pa.RecordBatch.from_arrays([
            pa.array((np.searchsorted(starts, signed, side="right") - 1).astype(np.int32)), pa.array(signed), text_column, pa.array(shas, pa.string()),
            pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), ids.take(pa.array(order)))], ["bucket", "h", "text", "sha256", "ids"])


def _chained(batches):
    """Number the different texts of each key, comparing bytes of neighbours in (key, text) order; the text stays with its first piece."""
    key, text, chain, n = None, None, 0, 0
    for batch in batches:
        column = batch.column("text")
        chains, first = np.empty(batch.num_rows, dtype=np.int32), np.zeros(batch.num_rows, dtype=bool)
        for i, h in enumerate(batch.column("h").to_pylist()):
            now = column[i].as_py()
            if h != key:
                key, text, chain, first[i] = h, now, 0, True
            elif now != text:
                text, chain, first[i] = now, chain + 1, True
            chains[i] = chain
        pieces = np.arange(n, n + batch.num_rows)
        n += batch.num_rows
        yield pa.RecordBatch.from_arrays([batch.column("bucket"), batch.column("h"), pa.array(chains), pa.array(pieces), pa.compute.if_else(pa.array(first), column, pa.scalar(None, column.type)),
                                          batch.column("sha256"), batch.column("ids")], ["bucket", "h", "chain", "piece", "text", "sha256", "ids"])


def _extended(batches, generation: int):
    """Chain numbers of new pieces: rows come by key, the texts that the index has (chain set) before the new ones, these by text."""
    key, chains, text, n = None, {}, None, generation << 40
    for batch in batches:
        column, known = batch.column("text"), batch.column("chain").to_pylist()
        rows, numbers, first = [], [], []
        for i, h in enumerate(batch.column("h").to_pylist()):
            now = column[i].as_py()
            if h != key:
                key, chains = h, {}
            if known[i] is not None:
                chains[now] = known[i]
                continue
            rows.append(i)
            first.append(now not in chains)
            numbers.append(chains.setdefault(now, max(chains.values(), default=-1) + 1))
        if rows:
            at = pa.array(rows, pa.int64())
            texts = pa.compute.if_else(pa.array(first), column.take(at), pa.scalar(None, column.type))
            yield pa.RecordBatch.from_arrays([batch.column("bucket").take(at), batch.column("h").take(at), pa.array(numbers, pa.int32()), pa.array(np.arange(n, n + len(rows))), texts,
                                              batch.column("sha256").take(at), batch.column("ids").take(at)], ["bucket", "h", "chain", "piece", "text", "sha256", "ids"])
            n += len(rows)


def _bucketed(batches, starts: np.ndarray):
    """Rows with their bucket in the directory."""
    for batch in batches:
        bucket = (np.searchsorted(starts, batch.column("h").to_numpy(), side="right") - 1).astype(np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(bucket) if n == "bucket" else batch.column(n) for n in batch.schema.names], batch.schema.names)


def directory(keys: DataFrame, bucket_bytes: int) -> np.ndarray:
    """Lowest keys of the buckets, ascending; keys has h and bytes.

    Each round counts the cells of one depth for the buckets that are still
    overfull (a few bits at a time); cells that fit together are one bucket. The
    driver holds one number a bucket."""
    total = keys.agg(F.sum("bytes")).first()[0] or 0
    depth, parts = 0, keys
    overfull, done = [(0, 0)] if total > bucket_bytes else [], [(0, 0)] if total <= bucket_bytes else []
    while overfull and depth < 63:
        step = min(63 - depth, 8 if depth else max(4, int(np.ceil(np.log2(total / bucket_bytes))) + 1))
        deep = depth + step
        cell = F.shiftrightunsigned(F.col("h").bitwiseXOR(F.lit(-_SIGN)), 64 - deep)
        if depth:
            spark = keys.sparkSession
            wanted = spark.createDataFrame([(p,) for _, p in overfull], "_p long")
            parts = keys.withColumn("_p", F.shiftrightunsigned(F.col("h").bitwiseXOR(F.lit(-_SIGN)), 64 - depth)).join(wanted, "_p", "left_semi")
        sizes = {r["_c"]: (r["b"], r["one"]) for r in parts.groupBy(cell.alias("_c")).agg(F.sum("bytes").alias("b"), (F.min("h") == F.max("h")).alias("one")).collect()}
        prefixes = sorted(sizes)
        ends = np.cumsum([0, *(sizes[p][0] for p in prefixes)])
        todo, overfull = overfull, []
        while todo:
            d, p = todo.pop()
            lo, hi = np.searchsorted(prefixes, [p << (deep - d), (p + 1) << (deep - d)])
            if ends[hi] - ends[lo] <= bucket_bytes or (hi - lo == 1 and sizes[prefixes[lo]][1]):
                done.append((d, p))
            elif d == deep:
                overfull.append((d, p))
            else:
                todo += [(d + 1, 2 * p), (d + 1, 2 * p + 1)]
        depth = deep
    return np.sort(np.array([(p << (64 - d)) - _SIGN if d else -_SIGN for d, p in done + overfull], dtype=np.int64))


@dataclass
class HashIndex:
    """Files of (bucket, h, chain, piece, text, sha256, ids) under path, a folder a generation, and the directory.

    bucket is that of the directory as it was when the row was written; h gives the bucket of today."""

    path: str
    starts: np.ndarray
    spark: SparkSession
    bucket_bytes: int
    most_owners: int
    generation: int = 0

    @classmethod
    def build(cls, docs: DataFrame, bucket_bytes: int = 32 << 20, most_owners: int = 20_000, path: str | None = None) -> HashIndex:
        spark = prepare(docs.sparkSession)
        rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        starts = directory(cut(rows.select("text").mapInArrow(_keys, "h long, bytes long")), bucket_bytes)
        path = path or f"{shared_dir(spark)}/hash-index-{uuid.uuid4().hex}"
        index = cls(path, starts, spark, bucket_bytes, most_owners)
        pieces = rows.mapInArrow(partial(_pieces, starts=starts), _PIECE)
        index._owned(pieces).sortWithinPartitions("bucket", "h", "text").mapInArrow(_chained, _ENTRY).write.parquet(f"{path}/generation=0")
        return index

    def _owned(self, rows: DataFrame) -> DataFrame:
        """rows dealt to the owners of contiguous ranges of buckets."""
        owners = min(len(self.starts), self.most_owners)
        return rows.repartitionById(owners, F.expr(f"cast(bucket * {owners}L div {len(self.starts)}L as int)"))

    def insert(self, docs: DataFrame) -> HashIndex:
        """The index with docs added. Buckets that overflow are split first; only new pieces are written, as a further generation."""
        rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        held = self.table().where("text is not null").select("h", F.octet_length("text").cast("long").alias("bytes"))
        starts = np.union1d(self.starts, directory(cut(held.unionByName(rows.select("text").mapInArrow(_keys, "h long, bytes long"))), self.bucket_bytes))
        after = HashIndex(self.path, starts, self.spark, self.bucket_bytes, self.most_owners, self.generation + 1)
        new = rows.mapInArrow(partial(_pieces, starts=starts), _PIECE).withColumn("chain", F.lit(None).cast("int"))
        # the texts that the index has, of keys that come in
        keys = cut(new.select("h").distinct())
        known = self.table().where("text is not null").join(keys, "h", "left_semi").select("bucket", "h", "text", "sha256", "ids", "chain")
        known = known.mapInArrow(partial(_bucketed, starts=starts), known.schema)
        both = after._owned(known.unionByName(new)).sortWithinPartitions("bucket", "h", F.col("chain").isNull(), "text")
        both.mapInArrow(partial(_extended, generation=after.generation), _ENTRY).write.parquet(f"{self.path}/generation={after.generation}")
        return after

    def table(self) -> DataFrame:
        return self.spark.read.schema(_ENTRY).parquet(*[f"{self.path}/generation={g}" for g in range(self.generation + 1)])

    def members(self) -> DataFrame:
        """One row per indexed document: doc_id, keep_id, group_size, kept, text_sha256."""
        pieces = self.table().select("bucket", "h", "chain", "piece", "sha256", "ids").withColumn("_most", F.get("ids", F.lit(0)))
        best = F.struct(F.col("_most").isNotNull(), F.col("_most"), -F.col("piece"))
        groups = pieces.groupBy("h", "chain").agg(F.max("_most").alias("keep_id"), F.sum(F.size("ids")).alias("group_size"), F.max_by("piece", best).alias("_keeper"))
        rows = pieces.join(groups, ["h", "chain"]).select("piece", "_keeper", "keep_id", "group_size", "sha256", F.posexplode("ids").alias("_at", "doc_id"))
        return rows.select("doc_id", "keep_id", F.col("group_size").cast("long"), ((F.col("piece") == F.col("_keeper")) & (F.col("_at") == 0)).alias("kept"), F.col("sha256").alias("text_sha256"))

    def lookup(self, docs: DataFrame) -> DataFrame:
        """doc_id and keep_id (null: not indexed) of further documents; entries of their keys are joined, bytes decide."""
        rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        new = rows.mapInArrow(partial(_pieces, starts=self.starts), _PIECE)
        known = self.table()
        best = known.groupBy("h", "chain").agg(F.max(F.get("ids", F.lit(0))).alias("keep_id"))
        texts = known.where("text is not null").select("h", "chain", "text").join(best, ["h", "chain"])
        return new.join(texts, ["h", "text"], "left").select(F.explode("ids").alias("doc_id"), "keep_id")


def dedup_exact(docs: DataFrame, bucket_bytes: int = 32 << 20) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256 (of the normalised text in UTF-8).

    Texts are equal when identical after lower-casing A-Z only; null counts as
    empty, and empty texts are equal to each other. Of equal texts exactly one row
    is kept: the one with the largest doc_id (a null doc_id is below all others;
    of repeated rows with that id any one). An empty table gives no rows. Only
    doc_id and text are read. The index's files stay in the shared folder."""
    return HashIndex.build(docs, bucket_bytes).members()
