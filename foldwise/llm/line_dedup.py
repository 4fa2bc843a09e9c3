"""Line dedup with exact reference counts and sharded cuckoo filters.

The truth is a table of reference counts: the 128-bit digest of a line's key and
the number of documents that contain it. ``insert`` adds a batch of documents to
it, ``delete`` takes one away; both leave exactly the table that a build from the
remaining documents would give, so every drop can be undone. Keys that cross
``min_docs`` upwards are inserted into the cuckoo filter of their shard, keys that
fall below are deleted from it. ``apply`` probes the lines of a scan with the
filters; the few lines that pass are confirmed against the exact counts, and only
confirmed lines go. The filters (two bytes a slot) are broadcast when their total
size is at most ``max_filter_bytes``; beyond that no line is screened and all
line keys take the exact join, with the same result.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .base import SEPARATORS, cut, id_key, prepare, record_batches, text_key

BLANK = bytes(SEPARATORS)
SLOTS = 4
KEY = ["_k1", "_k2"]


def line_keys(text: bytes) -> list[bytes]:
    """The key of every line: A-Z lower-cased (bytes.lower does no more), separators stripped at both ends."""
    return [line.strip(BLANK) for line in text.lower().split(b"\n")]


def texts(column: pa.Array) -> list[bytes]:
    """UTF-8 of a string column; null counts as empty."""
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


def digests(keys: list[bytes]) -> np.ndarray:
    """128-bit digests as rows of two signed numbers."""
    return np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, keys)), dtype=np.int64).reshape(-1, 2)


class Cuckoo:
    """A cuckoo filter of 16-bit fingerprints in buckets of four: insert, delete and vectorised lookup."""

    def __init__(self, table: np.ndarray):
        self.table = table.reshape(-1, SLOTS)
        self.mask = np.uint64(len(self.table) - 1)

    @classmethod
    def sized(cls, keys: int) -> Cuckoo:
        buckets = 8
        while buckets * SLOTS * 0.85 < keys:
            buckets *= 2
        return cls(np.zeros((buckets, SLOTS), dtype=np.uint16))

    def _places(self, k1: np.ndarray, k2: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        mark = (k2.astype(np.uint64) >> np.uint64(48)).astype(np.uint16)
        mark[mark == 0] = 1
        one = k1.astype(np.uint64) & self.mask
        return mark, one, self._other(one, mark)

    def _other(self, place, mark):
        return place ^ ((np.uint64(0x5BD1E995) * (mark.astype(np.uint64) + np.uint64(1))) & self.mask)

    def contains(self, k1: np.ndarray, k2: np.ndarray) -> np.ndarray:
        mark, one, two = self._places(k1, k2)
        return ((self.table[one] == mark[:, None]) | (self.table[two] == mark[:, None])).any(axis=1)

    def insert(self, k1: np.ndarray, k2: np.ndarray) -> bool:
        """False when some key finds no place: the filter must then be made anew, larger."""
        for mark, one, two in zip(*self._places(k1, k2), strict=True):
            place = one
            for turn in range(500):
                for spot in (place, two) if turn == 0 else (place,):
                    free = np.flatnonzero(self.table[spot] == 0)
                    if len(free):
                        self.table[spot, free[0]] = mark
                        mark = None
                        break
                if mark is None:
                    break
                slot = turn % SLOTS
                mark, self.table[place, slot] = self.table[place, slot], mark
                place = self._other(place, mark)
            if mark is not None:
                return False
        return True

    def delete(self, k1: np.ndarray, k2: np.ndarray) -> None:
        for mark, one, two in zip(*self._places(k1, k2), strict=True):
            for place in (one, two):
                slots = np.flatnonzero(self.table[place] == mark)
                if len(slots):
                    self.table[place, slots[0]] = 0
                    break


def _postings(batches, filters=None, shards: int = 1):
    """The distinct line keys of each document; with filters, only those that pass."""
    for batch in batches:
        ids, rows = batch.column("_id").to_numpy(), batch.column("_th").to_numpy()
        keys = [set(line_keys(t)) - {b""} for t in texts(batch.column("text"))]
        doc = np.repeat(np.arange(len(keys)), [len(k) for k in keys])
        found = digests([key for of_doc in keys for key in of_doc])
        k1, k2 = np.ascontiguousarray(found[:, 0]), np.ascontiguousarray(found[:, 1])
        if filters is not None:
            passed = _probe(filters.value, shards, k1, k2)
            doc, k1, k2 = doc[passed], k1[passed], k2[passed]
        yield from record_batches({"_id": [ids[doc]], "_th": [rows[doc]], "_k1": [k1], "_k2": [k2]}, ["_id", "_th", *KEY])


def _probe(tables: dict[int, bytes], shards: int, k1: np.ndarray, k2: np.ndarray) -> np.ndarray:
    shard = (k1.view(np.uint64) >> np.uint64(40)) % np.uint64(shards)
    out = np.zeros(len(k1), dtype=bool)
    for s, table in tables.items():
        mine = np.flatnonzero(shard == s)
        if len(mine):
            out[mine] = Cuckoo(np.frombuffer(table, dtype=np.uint16)).contains(k1[mine], k2[mine])
    return out


def _rewrite(batches):
    for batch in batches:
        hot, total, dropped, kept = batch.column("_hot"), [], [], []
        for i, text in enumerate(texts(batch.column("text"))):
            total.append(text.count(b"\n") + 1)
            if hot[i].is_valid:
                struct = hot[i].values
                numbers = zip(*(struct.field(k).to_pylist() for k in KEY), strict=True)
                gone = {a.to_bytes(8, "little", signed=True) + b.to_bytes(8, "little", signed=True) for a, b in numbers}
                lines = text.split(b"\n")
                stay = [line for line, key in zip(lines, line_keys(text), strict=True) if not key or xxhash.xxh3_128_digest(key) not in gone]
                text = b"\n".join(stay)
                dropped.append(len(lines) - len(stay))
            else:
                dropped.append(0)
            kept.append(text)
        names = [c for c in batch.schema.names if c not in ("text", "_hot")]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(total, pa.int64()), pa.array(dropped, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())],
                                         [*names, "n_lines", "n_dropped", "kept_text"])


def _update(old: pd.DataFrame, change: pd.DataFrame) -> pd.DataFrame:
    """The filter of one shard after keys were deleted (by = -1) and inserted (by = 1); no table where it got too full."""
    up, down = change[change["by"] > 0], change[change["by"] < 0]
    shard = int((old if len(old) else change)["shard"].iloc[0])
    fits = Cuckoo(np.frombuffer(old["table"].iloc[0], dtype=np.uint16).copy()) if len(old) else Cuckoo.sized(len(up))
    fits.delete(down["_k1"].to_numpy(), down["_k2"].to_numpy())
    done = fits.insert(up["_k1"].to_numpy(), up["_k2"].to_numpy())
    return pd.DataFrame({"shard": [shard], "table": [fits.table.tobytes() if done else None]})


def _rebuild(keys: pd.DataFrame) -> pd.DataFrame:
    room = len(keys)
    while True:
        fits = Cuckoo.sized(room)
        if fits.insert(keys["_k1"].to_numpy(), keys["_k2"].to_numpy()):
            return pd.DataFrame({"shard": [int(keys["shard"].iloc[0])], "table": [fits.table.tobytes()]})
        room = 2 * room + 1


def _rows(docs: DataFrame, *more: str) -> DataFrame:
    return docs.select(id_key().alias("_id"), text_key("text").alias("_th"), "text", *more)


@dataclass
class LineIndex:
    """counts (_k1, _k2, n_docs), filters (shard, table), and how many shards and documents make a line frequent."""

    counts: DataFrame
    filters: DataFrame
    min_docs: int
    shards: int

    @classmethod
    def build(cls, docs: DataFrame, min_docs: int = 10, shard_keys: int = 1 << 19) -> LineIndex:
        """Of all docs. A filter shard holds about shard_keys keys; their number follows the number of frequent lines."""
        prepare(docs.sparkSession)
        counts = cut(_counted(docs))
        frequent = counts.where(F.col("n_docs") >= min_docs).count()
        shards = 1 + frequent // shard_keys
        empty = docs.sparkSession.createDataFrame([], "shard int, table binary")
        return cls(counts, empty, min_docs, shards)._filtered(counts.where(F.col("n_docs") >= min_docs).select(*KEY, F.lit(1).alias("by")))

    def insert(self, docs: DataFrame) -> LineIndex:
        return self._changed(docs, 1)

    def delete(self, docs: DataFrame) -> LineIndex:
        """docs must have been inserted before, with the texts they had then."""
        return self._changed(docs, -1)

    def _changed(self, docs: DataFrame, sign: int) -> LineIndex:
        prepare(docs.sparkSession)
        delta = _counted(docs).withColumn("n_docs", F.col("n_docs") * sign)
        both = self.counts.withColumn("was", F.col("n_docs")).unionByName(delta.withColumn("was", F.lit(0).cast("long")))
        both = cut(both.groupBy(*KEY).agg(F.sum("n_docs").alias("n_docs"), F.sum("was").alias("was")))
        step = (F.col("n_docs") >= self.min_docs).cast("int") - (F.col("was") >= self.min_docs).cast("int")
        after = LineIndex(both.where("n_docs > 0").drop("was"), self.filters, self.min_docs, self.shards)
        return after._filtered(both.select(*KEY, step.alias("by")).where("by <> 0"))

    def _shard(self):
        return F.pmod(F.shiftrightunsigned("_k1", 40), F.lit(self.shards)).cast("int")

    def _filtered(self, change: DataFrame) -> LineIndex:
        kind = "shard int, table binary"
        made = cut(self.filters.groupBy("shard").cogroup(change.withColumn("shard", self._shard()).groupBy("shard")).applyInPandas(_update, kind))
        full = made.where("table is null").select("shard")
        if full.count():
            keys = self.counts.where(F.col("n_docs") >= self.min_docs).select(*KEY, self._shard().alias("shard"))
            made = cut(made.where("table is not null").unionByName(keys.join(full, "shard").groupBy("shard").applyInPandas(_rebuild, kind)))
        return LineIndex(self.counts, made, self.min_docs, self.shards)

    def apply(self, docs: DataFrame, carry: list[str] | None = None, max_filter_bytes: int = 64 << 20, as_row: bool = False) -> DataFrame:
        """One row per row of docs: the columns of carry (default doc_id), n_lines, n_dropped, kept_text.

        ``as_row``: the carried columns are one struct, ``_row``, and may have any names; else names of the result's own columns raise ValueError.

        Frequent lines lose all their occurrences in every document. A line's key
        is the line without ``[\\x20\\x09-\\x0D]`` at its ends, A-Z lower-cased; lines
        with an empty key always stay. Null and empty texts have one, empty, line.
        Every row counts as a document, also repeated ones and those without a
        doc_id. Only doc_id, text and the columns of carry are read."""
        spark = prepare(docs.sparkSession)
        size = self.filters.select(F.sum(F.octet_length("table"))).first()[0] or 0
        filters = spark.sparkContext.broadcast({r["shard"]: bytes(r["table"]) for r in self.filters.collect()}) if size <= max_filter_bytes else None
        kind = "_id long, _th long, _k1 long, _k2 long"
        maybe = _rows(docs).mapInArrow(partial(_postings, filters=filters, shards=self.shards), kind)
        frequent = self.counts.where(F.col("n_docs") >= self.min_docs).select(*KEY)
        hot = maybe.distinct().join(frequent, KEY).groupBy("_id", "_th").agg(F.collect_list(F.struct(*KEY)).alias("_hot"))
        carry = carry or ["doc_id"]
        if not as_row and (clash := {"n_lines", "n_dropped", "kept_text"} & set(carry)):
            raise ValueError(f"columns {sorted(clash)} can only be carried as_row")
        row = F.struct(*[F.col(f"`{c}`") for c in carry]).alias("_row")
        joined = _rows(docs, row).join(hot, ["_id", "_th"], "left").select("_row", "text", "_hot")
        kind = StructType(joined.select("_row").schema.fields).add("n_lines", "long").add("n_dropped", "long").add("kept_text", "string")
        out = joined.mapInArrow(_rewrite, kind)
        return out if as_row else out.select("_row.*", "n_lines", "n_dropped", "kept_text")


def _counted(docs: DataFrame) -> DataFrame:
    keys = _rows(docs).mapInArrow(_postings, "_id long, _th long, _k1 long, _k2 long")
    return keys.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n_docs"))


def dedup_lines(docs: DataFrame, min_docs: int = 10, carry: list[str] | None = None, as_row: bool = False) -> DataFrame:
    """Index all docs and apply the index to them; see LineIndex.apply."""
    return LineIndex.build(docs, min_docs).apply(docs, carry, as_row=as_row)
