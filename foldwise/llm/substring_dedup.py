"""Substring dedup by difference-cover anchors.

Two equal windows of ``window`` words at positions p and q share, for some shift
d below the period, cover positions p+d and q+d (that is what a difference cover
is). So it is enough to hash windows of window-period+1 words at the cover
positions of each document, about a fifth of all positions: every long match has
an anchor that both documents emit. Anchors that only one document has are
dropped; around the others the match is extended: all full windows that contain a
shared anchor are hashed (96 bits), and those whose hash has a smaller document
mark their words.

Hot anchors and windows: a Python task first combines its batch, so that of equal
hashes in one batch only those of the smallest document are dealt by hash; the
others are already decided and are dealt by a key of their own. Whole equal
documents are found by one hash a document and take no part. The text is shuffled
once, by (doc_id, text digest); all three uses of it share that exchange.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, partial
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .base import Words, blocks, cut, join_words, prepare, ranged_hash, record_batches, splitmix, text_buffers, text_key


@lru_cache
def difference_cover(period: int) -> tuple[int, ...]:
    """The first smallest set of residues whose differences give every residue of the period."""
    size = 1
    while size * (size - 1) + 1 < period:
        size += 1
    while True:
        for rest in combinations(range(1, period), size - 1):
            cover = (0, *rest)
            if len({(a - b) % period for a in cover for b in cover}) == period:
                return cover
        size += 1


def _texts(batch: pa.RecordBatch) -> Iterator[tuple[int, int, Words]]:
    data, off = text_buffers(batch.column("text"))
    for lo, hi in blocks(off):
        yield lo, hi, Words(data, off[lo:hi + 1])


def _sequences(batches, window: int):
    """One 128-bit hash of the whole word sequence of each document that has a window."""
    for batch in batches:
        ids, keys = batch.column("_id").to_numpy(), batch.column("_th").to_numpy()
        out = {n: [] for n in ("_id", "_th", "_h", "_g")}
        for lo, hi, w in _texts(batch):
            has = np.flatnonzero(w.count >= window)
            h = w.hashes(0)
            out["_id"].append(ids[lo:hi][has])
            out["_th"].append(keys[lo:hi][has])
            for name, lane in (("_h", 1), ("_g", 2)):
                out[name].append(ranged_hash(h, w.first[:-1][has], w.first[1:][has], lane).view(np.int64))
        yield from record_batches(out, list(out))


def _combined(out: dict[str, list]) -> Iterator[pa.RecordBatch]:
    """Of equal hashes in the batch: kind 1 for the smallest document's, 2 for the others'; 0 where one document has the hash."""
    if not out["_h"]:
        return
    cols = {k: np.concatenate(v) for k, v in out.items()}
    h = cols["_h"]
    order = np.argsort(h, kind="stable")
    sorted_h = h[order]
    group = np.cumsum(np.r_[False, sorted_h[1:] != sorted_h[:-1]]) if len(h) else np.zeros(0, np.int64)
    begin = np.flatnonzero(np.r_[True, sorted_h[1:] != sorted_h[:-1]]) if len(h) else np.zeros(0, np.int64)
    ids = cols["_id"][order]
    kind = np.zeros(len(h), dtype=np.int8)
    if len(h):
        least, most = np.minimum.reduceat(ids, begin)[group], np.maximum.reduceat(ids, begin)[group]
        kind[order] = np.where(least == most, 0, np.where(ids == least, 1, 2))
    own = splitmix(cols["_th"].astype(np.uint64) + splitmix(cols["_pos"].astype(np.uint64)))
    cols["_kind"] = kind
    cols["_deal"] = np.where(kind == 2, own, h).view(np.int64)
    yield from record_batches({k: [v] for k, v in cols.items()}, [k for k in cols if k != "_h"])


def _anchors(batches, window: int, period: int):
    cover = np.isin(np.arange(period), difference_cover(period))
    size = window - period + 1
    for batch in batches:
        ids, keys = batch.column("_id").to_numpy(), batch.column("_th").to_numpy()
        out = {n: [] for n in ("_h", "_id", "_th", "_pos")}
        for lo, hi, w in _texts(batch):
            long_enough = np.repeat(w.count >= window, w.count)
            at = w.window_starts(size)
            at = at[long_enough[at]]
            doc = w.doc_of()[at]
            pos = at - w.first[doc]
            pick = cover[pos % period]
            at, doc, pos = at[pick], doc[pick], pos[pick]
            out["_h"].append(ranged_hash(w.hashes(0), at, at + size, 1))
            out["_id"].append(ids[lo:hi][doc])
            out["_th"].append(keys[lo:hi][doc])
            out["_pos"].append(pos.astype(np.int32))
        yield from _combined(out)


def _covered(n: int, positions: np.ndarray, before: int, after: int) -> np.ndarray:
    """Which of n places lie in [p - before, p + after] for some position p."""
    edge = np.zeros(n + 1, dtype=np.int64)
    np.add.at(edge, np.clip(positions - before, 0, n), 1)
    np.add.at(edge, np.clip(positions + after + 1, 0, n), -1)
    return np.cumsum(edge[:n]) > 0


def _windows(batches, window: int, period: int):
    """Every full window that holds a shared anchor where a match would have it."""
    for batch in batches:
        ids, keys = batch.column("_id").to_numpy(), batch.column("_th").to_numpy()
        lists = batch.column("_at")
        out = {n: [] for n in ("_h", "_g", "_id", "_th", "_pos")}
        for lo, hi, w in _texts(batch):
            mark = np.zeros(len(w.starts), dtype=bool)
            for i in range(lo, hi):
                a, b = w.first[i - lo], w.first[i - lo + 1]
                mark[a:b] = _covered(b - a, np.array(lists[i].values.to_numpy(), dtype=np.int64), period - 1, 0)
            at = w.window_starts(window)
            at = at[mark[at]]
            doc = w.doc_of()[at]
            h = w.hashes(0)
            out["_h"].append(ranged_hash(h, at, at + window, 1))
            out["_g"].append((ranged_hash(h, at, at + window, 2) >> np.uint64(32)).astype(np.uint32).view(np.int32))
            out["_id"].append(ids[lo:hi][doc])
            out["_th"].append(keys[lo:hi][doc])
            out["_pos"].append((at - w.first[doc]).astype(np.int32))
        yield from _combined(out)


def _remove(batches, window: int):
    for batch in batches:
        lists, copies = batch.column("_at"), batch.column("_copy").to_numpy(zero_copy_only=False)
        for lo, hi, w in _texts(batch):
            gone = np.zeros(len(w.starts), dtype=bool)
            for i in range(lo, hi):
                a, b = w.first[i - lo], w.first[i - lo + 1]
                if copies[i]:
                    gone[a:b] = True
                elif lists[i].is_valid:
                    gone[a:b] = _covered(b - a, np.array(lists[i].values.to_numpy(), dtype=np.int64), 0, window - 1)
            removed = np.diff(np.concatenate([[0], np.cumsum(gone)])[w.first])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(lo, hi - lo), pa.array(w.count.astype(np.int64)), pa.array(removed.astype(np.int64)), join_words(w, ~gone)],
                                             ["doc_id", "n_words", "n_removed", "kept_text"])


def remove_repeats(docs: DataFrame, window: int = 50, period: int = 31) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_text (kept words joined by one space).

    A word goes when a window of ``window`` consecutive words that covers it also
    starts in a document with a smaller doc_id. Words are ``[^\\x20\\x09-\\x0D]+``,
    unchanged; null and empty texts have none and give an empty kept_text. Rows
    without a doc_id come after all others, ordered by a digest of their text.
    Rows of one doc_id are one document for the comparison, so repeated rows don't
    remove each other; different texts under one doc_id are told apart by 32 bits (from some 80,000 under the same id on,
    two may be taken for one), rows without an id by 72. Documents shorter than the window keep everything. Only
    doc_id and text are read."""
    prepare(docs.sparkSession)
    if not 1 <= period <= window:
        raise ValueError("the period must be between 1 and the window")
    # A row's key is its id and 32 bits of its text; without an id, 40 more bits of the text stand for it.
    no_id = F.lit((1 << 63) - 1) - text_key("text").bitwiseAND(F.lit((1 << 40) - 1))
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.coalesce(F.col("doc_id").cast("long"), no_id).alias("_id"),
                       F.shiftright(text_key("text"), 32).cast("int").alias("_th"))
    key = ["_id", "_th"]
    whole = cut(base.select(*key, "text").mapInArrow(partial(_sequences, window=window), "_id long, _th int, _h long, _g long"))
    least = whole.groupBy("_h", "_g").agg(F.min("_id").alias("_least"), F.max("_id").alias("_most")).where("_least < _most")
    copies = cut(whole.join(least, ["_h", "_g"]).where("_id > _least").select(*key).distinct())
    placed = base.repartition(*key).join(copies.withColumn("_copy", F.lit(True)), key, "left")

    # doc_id goes along in all three uses: with equal columns they share one exchange of the text
    anchors = placed.where("_copy is null").select("doc_id", *key, "text").mapInArrow(partial(_anchors, window=window, period=period), "_id long, _th int, _pos int, _kind byte, _deal long")
    by_hash = Window.partitionBy("_deal")
    shared = anchors.select("*", F.min("_id").over(by_hash).alias("_least"), F.max("_id").over(by_hash).alias("_most"), F.max("_kind").over(by_hash).alias("_any")).where("_least < _most or _any > 0")
    near = shared.groupBy(*key).agg(F.collect_set("_pos").alias("_at"))

    windows = placed.where("_copy is null").join(near, key).select("doc_id", *key, "text", "_at").mapInArrow(
        partial(_windows, window=window, period=period), "_g int, _id long, _th int, _pos int, _kind byte, _deal long")
    same = Window.partitionBy("_deal", "_g")
    later = windows.select("*", F.min("_id").over(same).alias("_least")).where("_id > _least or _kind = 2")
    gone = later.groupBy(*key).agg(F.collect_set("_pos").alias("_at"))
    return placed.join(gone, key, "left").select("doc_id", *key, "text", "_at", F.coalesce("_copy", F.lit(False)).alias("_copy")).mapInArrow(
        partial(_remove, window=window), "doc_id long, n_words long, n_removed long, kept_text string")
