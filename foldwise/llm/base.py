"""Helpers shared by the corpus operators: checkpoints, row keys, word scanning.

Words are runs of bytes outside space and \\x09-\\x0D. The separators are ASCII,
so UTF-8 text is scanned as bytes: one pass of numpy over a block of documents
finds every word, and prefix sums of weighted byte values give each word, and
each window of words, its 64-bit hash without a Python loop.
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foldwise.session import ship_package

WORD = r"[^\x20\x09-\x0D]+"
#: Bytes of text that one numpy pass handles; documents are never cut, so a longer one is a block by itself.
BLOCK_BYTES = 1 << 20
SEPARATORS = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)

_IS_WORD = np.ones(256, dtype=bool)
_IS_WORD[list(SEPARATORS)] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def prepare(spark: SparkSession) -> SparkSession:
    """Bound the Arrow batches that go to Python, by rows and bytes, send the package to the workers, and make sure that a checkpoint folder is set."""
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))
    shared_dir(spark)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The shared folder of ``spark.checkpoint.dir``. Only a local master may go without: it gets a temporary one."""
    sc = spark.sparkContext
    if sc.getCheckpointDir():
        return sc.getCheckpointDir()
    folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not folder:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir is not set; a cluster needs a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="foldwise-llm-", dir=os.environ.get("TMPDIR"))
    sc.setCheckpointDir(folder)
    return sc.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """Write df to the shared checkpoint folder and read it from there (reliable, not localCheckpoint)."""
    return df.checkpoint(eager=True)


def text_key(text: str | Column) -> Column:
    """64 bits of a text. With the document's id it tells rows apart; rows that agree in both are interchangeable."""
    return F.xxhash64(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")))


def splitmix(x: np.ndarray) -> np.ndarray:
    """A fixed bijective mixing of 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=8)
def _byte_values(lane: int) -> np.ndarray:
    return splitmix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(lane * 0x51ED270B))


def _base(lane: int) -> int:
    return (0x5851F42D4C957F2D, 0xD1342543DE82EF95, 0x2545F4914F6CDD1D, 0xAF251AF3B0F025B5)[lane]


_POWERS: dict[tuple[int, bool], np.ndarray] = {}


def _powers(lane: int, inverse: bool, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, or the same of the base's inverse."""
    have = _POWERS.get((lane, inverse))
    if have is None or len(have) < n:
        b = _base(lane)
        b = pow(b, -1, 1 << 64) if inverse else b
        have = np.full(max(n, BLOCK_BYTES + 1), b, dtype=np.uint64)
        have[0] = 1
        have = np.cumprod(have, dtype=np.uint64)
        if n <= 4 * BLOCK_BYTES:
            _POWERS[lane, inverse] = have
    return have[:n]


def ranged_hash(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, lane: int) -> np.ndarray:
    """Hash of values[start:end] for every pair, the same wherever the run stands."""
    sums = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * _powers(lane, False, len(values)), out=sums[1:])
    return splitmix((sums[ends] - sums[starts]) * _powers(lane, True, len(values) + 1)[starts] + (ends - starts).astype(np.uint64))


class Words:
    """The words of a block of documents: byte starts and ends, and the first word of each document (plus the end)."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lower: bool = False):
        at = int(offsets[0])
        self.data = data[at:int(offsets[-1])]
        if lower:
            self.data = LOWER[self.data]
        self.offsets = offsets - at
        n = len(self.data)
        word = _IS_WORD[self.data]
        edge = np.zeros(n + 1, dtype=bool)
        edge[self.offsets] = True
        before = np.zeros(n, dtype=bool)
        before[1:] = word[:-1]
        before &= ~edge[:n]
        after = np.zeros(n, dtype=bool)
        after[:-1] = word[1:]
        after &= ~edge[1:]
        self.starts = np.flatnonzero(word & ~before)
        self.ends = np.flatnonzero(word & ~after) + 1
        self.first = np.searchsorted(self.starts, self.offsets)
        self.count = np.diff(self.first)

    def doc_of(self) -> np.ndarray:
        """Document index of each word."""
        return np.repeat(np.arange(len(self.count)), self.count)

    def hashes(self, lane: int = 0) -> np.ndarray:
        return ranged_hash(_byte_values(lane)[self.data], self.starts, self.ends, lane)

    def window_starts(self, size: int) -> np.ndarray:
        """Every word from which size words of its document follow (itself included)."""
        last = np.repeat(self.first[1:], self.count) - size
        at = np.arange(len(self.starts))
        return at[at <= last]


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and 64-bit offsets of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    if not (pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)):
        column = column.cast(pa.large_binary() if pa.types.is_binary(column.type) else pa.large_string())
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, dtype=np.int64, count=len(column) + 1, offset=8 * column.offset) if len(column) else np.zeros(1, np.int64)
    return (np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)), off


def blocks(offsets: np.ndarray, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows with at most limit bytes each, at least one row."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1)
        yield lo, min(hi, n)
        lo = min(hi, n)


def string_array(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """A string array over one buffer of bytes."""
    return pa.LargeStringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data)))


def gather_ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices of all the ranges, one after the other."""
    total = int(lengths.sum())
    shift = np.cumsum(lengths) - lengths
    return np.repeat(starts - shift, lengths) + np.arange(total)


def join_ranges(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, first: np.ndarray, separator: int) -> pa.Array:
    """One string per document: its byte ranges (first[i] up to first[i + 1]), joined by the separator byte."""
    spaced = lengths + 1
    last = first[1:][first[1:] > first[:-1]] - 1
    spaced[last] -= 1
    at = np.concatenate([[0], np.cumsum(spaced)])
    out = np.full(int(at[-1]), separator, dtype=np.uint8)
    out[gather_ranges(at[:-1], lengths)] = data[gather_ranges(starts, lengths)]
    return string_array(out, at[first]).cast(pa.string())


def join_words(words: Words, keep: np.ndarray) -> pa.Array:
    """The kept words of each document of the block, joined by one space."""
    kept = np.concatenate([[0], np.cumsum(keep)])[words.first]
    return join_ranges(words.data, words.starts[keep], (words.ends - words.starts)[keep], kept, 0x20)


def record_batches(columns: dict[str, list], names: list[str], most_rows: int = 100_000) -> Iterator[pa.RecordBatch]:
    """Batches of bounded size from lists of equally long numpy arrays."""
    arrays = [np.concatenate(columns[n]) if columns[n] else None for n in names]
    if arrays[0] is None:
        return
    for lo in range(0, len(arrays[0]), most_rows):
        yield pa.RecordBatch.from_arrays([pa.array(a[lo:lo + most_rows]) for a in arrays], names)


def id_key(doc_id: str = "doc_id") -> Column:
    """doc_id as a number that is never null: null is larger than every id."""
    return F.coalesce(F.col(doc_id).cast("long"), F.lit((1 << 63) - 1))
