"""Vector compression to one byte per part, by value dictionaries.

Components become integers. Blocks of vectors are encoded once: every dimension
of a block gets the sorted dictionary of its distinct integers, and each vector
keeps only its codes into those dictionaries. Whatever has to be compared with a
codebook later is read from tables: for one dimension, the squared differences of
the dictionary's integers to that component of all entries. The distance of a
part to all entries is then a gather of table rows by code and an addition for
each dimension; no difference is computed per vector.

The codebooks of all parts are refined together: one scan of the blocks a round,
whose tasks return sums and counts per part and entry. The driver holds the
codebooks and those sums, a few thousand rows whatever the input.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from .base import cut, prepare

#: Vectors in a block: the distances of one part of a block (int64) stay within a few MB.
BLOCK_ROWS = 2048
#: Integers beyond these limits are set to them, so that summed squares always fit 64 bits.
LIMIT = 1 << 27
SUMS = "part int, entry int, n long, total array<long>"
BLOCK = "ids binary, known binary, labels binary, dictionaries array<binary>, codes array<binary>"
#: Copies of each label's sum, so that rows of one frequent label are joined in as many tasks.
LABEL_SALTS = 16


@dataclass
class Codebooks:
    """entries[part, entry, position]: the integer components of all codebooks, and how vectors are made integers."""

    entries: np.ndarray
    dimensions: int
    scale: float

    @property
    def sha256(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.reshape(-1).tolist())).encode()).hexdigest()


def integers(vector: str | Column, scale: float) -> Column:
    """The vector's floor(scale * x) per component; null for vectors that are null, empty or hold null or non-finite components."""
    v = F.col(vector) if isinstance(vector, str) else vector
    finite = F.forall(v, lambda x: F.coalesce((x > float("-inf")) & (x < float("inf")), F.lit(False)))
    whole = F.transform(v, lambda x: F.greatest(F.lit(-LIMIT), F.least(F.lit(LIMIT), F.floor(x.cast("double") * scale))).cast("int"))
    return F.when(finite & (F.size(v) > 0), whole)


def _matrix(column: pa.Array, dimensions: int, width: int) -> np.ndarray:
    """rows x width integers; components from dimensions to width are 0."""
    values = column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dimensions)
    out = np.zeros((len(column), width), dtype=np.int32)
    out[:, :dimensions] = values
    return out


def encode(ids: pa.Array, labels: pa.Array, ints: np.ndarray) -> pa.RecordBatch:
    """One block: ids, labels, and per dimension the dictionary (int32) and the vectors' codes (uint16)."""
    dictionaries, codes = [], []
    for d in range(ints.shape[1]):
        values, code = np.unique(ints[:, d], return_inverse=True)
        dictionaries.append(values.astype(np.int32).tobytes())
        codes.append(code.astype(np.uint16).tobytes())
    sink = pa.BufferOutputStream()
    batch = pa.RecordBatch.from_arrays([labels], ["label"])
    with pa.ipc.new_stream(sink, batch.schema) as out:
        out.write_batch(batch)
    known = np.asarray(ids.is_valid())
    return pa.RecordBatch.from_arrays([
        pa.array([ids.fill_null(0).to_numpy().astype(np.int64).tobytes()]), pa.array([known.tobytes()]),
        pa.array([sink.getvalue().to_pybytes()], pa.binary()), pa.array([dictionaries], pa.list_(pa.binary())), pa.array([codes], pa.list_(pa.binary()))],
        ["ids", "known", "labels", "dictionaries", "codes"])


def _encode(batches, dimensions: int, width: int):
    held, rows = [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        rows += batch.num_rows
        if rows >= BLOCK_ROWS:
            yield from _blocks(held, dimensions, width)
            held, rows = [], 0
    if held:
        yield from _blocks(held, dimensions, width)


def _blocks(held, dimensions: int, width: int):
    table = pa.Table.from_batches(held).combine_chunks()
    for lo in range(0, table.num_rows, BLOCK_ROWS):
        part = table.slice(lo, BLOCK_ROWS).combine_chunks().to_batches()[0]
        yield encode(part.column("id"), part.column("label"), _matrix(part.column("ints"), dimensions, width))


@dataclass
class Block:
    """The vectors of a block as codes into the dictionaries of its dimensions."""

    dictionaries: list[np.ndarray]
    codes: list[np.ndarray]

    def part_distances(self, entries: np.ndarray, first: int) -> np.ndarray:
        """rows x entries: squared distances of the part that begins at dimension ``first`` to all entries (entry, position)."""
        size = entries.shape[1]
        spans = [max(abs(int(v[0]) - int(entries[:, j].max())), abs(int(v[-1]) - int(entries[:, j].min()))) for j, v in enumerate(self.dictionaries[first:first + size])]
        kind = np.int32 if sum(s * s for s in spans) < 1 << 31 else np.int64  # both exact
        out = np.zeros((len(self.codes[0]), len(entries)), dtype=kind)
        row = np.empty_like(out)
        for j in range(size):
            table = (self.dictionaries[first + j].astype(kind)[:, None] - entries[:, j].astype(kind)[None, :]) ** 2
            np.take(table, self.codes[first + j], axis=0, out=row, mode="clip")
            out += row
        return out

    def assign(self, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(parts x rows) nearest entries, ties to the lower index, and their squared distances."""
        parts, _, size = books.shape
        best, error = [], []
        for p in range(parts):
            distance = self.part_distances(books[p], p * size)
            at = distance.argmin(axis=1)
            best.append(at)
            error.append(distance[np.arange(len(at)), at].astype(np.int64))
        return np.array(best), np.array(error)

    def sums(self, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(parts x entries) counts and (parts x entries x positions) sums of the assigned integers."""
        parts, entries, size = books.shape
        best, _ = self.assign(books)
        count = np.zeros((parts, entries), dtype=np.int64)
        total = np.zeros((parts, entries, size), dtype=np.int64)
        for p in range(parts):
            count[p] = np.bincount(best[p], minlength=entries)
            order = np.argsort(best[p], kind="stable")
            used = np.flatnonzero(count[p])
            starts = (np.cumsum(count[p]) - count[p])[used]
            for j in range(size):
                values = self.dictionaries[p * size + j].astype(np.int64)[self.codes[p * size + j]]
                total[p, used, j] = np.add.reduceat(values[order], starts)
        return count, total


def _read(batch: pa.RecordBatch):
    for row in batch.to_pylist():
        yield row, Block([np.frombuffer(d, np.int32) for d in row["dictionaries"]], [np.frombuffer(c, np.uint16) for c in row["codes"]])


def _partial_sums(batches, books):
    entries = books.value.entries
    count = total = None
    for batch in batches:
        for _, block in _read(batch):
            c, t = block.sums(entries)
            count, total = (c, t) if count is None else (count + c, total + t)
    if count is not None:
        part, entry = np.nonzero(count)
        yield _sums_batch(part, entry, count[part, entry], list(total[part, entry]))


def _sums_batch(part, entry, n, total) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(entry, pa.int32()), pa.array(n, pa.int64()), pa.array(total, pa.list_(pa.int64()))], ["part", "entry", "n", "total"])


def _add_up(batches):
    """The sums of each part and entry that a task has, from all tasks' partial sums."""
    held: dict[tuple[int, int], list] = {}
    for batch in batches:
        part, entry, n = (batch.column(c).to_numpy() for c in ("part", "entry", "n"))
        totals = batch.column("total").flatten().to_numpy().reshape(batch.num_rows, -1)
        for key, count, total in zip(zip(part.tolist(), entry.tolist(), strict=True), n.tolist(), totals, strict=True):
            have = held.setdefault(key, [0, np.zeros(len(total), dtype=np.int64)])
            have[0] += count
            have[1] = have[1] + total
    if held:
        yield _sums_batch([p for p, _ in held], [e for _, e in held], [v[0] for v in held.values()], [v[1] for v in held.values()])


def _codes(batches, books):
    entries = books.value.entries
    for batch in batches:
        for row, block in _read(batch):
            best, error = block.assign(entries)
            known = np.frombuffer(row["known"], dtype=bool)
            ids = pa.array(np.frombuffer(row["ids"], np.int64), mask=~known)
            labels = pa.ipc.open_stream(row["labels"]).read_all().column("label").combine_chunks()
            digits = np.frombuffer(b"".join(b"%02x" % i for i in range(entries.shape[1])), dtype="S2")[best].T
            code = pa.array(np.ascontiguousarray(digits).view(f"S{2 * len(best)}")[:, 0].astype(str), pa.string())
            yield pa.RecordBatch.from_arrays([ids, labels, code, pa.array(error.sum(axis=0))], ["id", "label", "code", "error"])


def encode_vectors(vectors: DataFrame, parts: int = 4, entries: int = 256, rounds: int = 4, scale: float = 1024.0,
                   vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label") -> tuple[DataFrame, Codebooks | None]:
    """(rows, codebooks): one row per kept vector with vec_id, code, error, label and label_error; codebooks is None where nothing is kept.

    Kept are vectors that are not null or empty, without null or non-finite components,
    and as long as that of the smallest kept vec_id. The codebooks start as the parts of the
    first ``entries`` kept vectors (fewer where there are fewer) by vec_id (null last), then
    by their integers, so ties have one result. A length that ``parts`` doesn't divide is
    filled up with zeros. Integers beyond +-2**27 are set to that. ``entries`` is at most 256.
    label_error sums error over all rows of equal labels, nulls together. Other columns are not read."""
    if not 1 <= entries <= 256:
        raise ValueError("a code has two hex digits a part: 1 to 256 entries")
    spark = prepare(vectors.sparkSession)
    kind = vectors.schema[label].dataType
    rows = vectors.select(F.col(vec_id).cast("long").alias("id"), F.col(label).alias("label"), integers(embedding, scale).alias("ints")).where("ints is not null")
    order = [F.col("id").asc_nulls_last(), F.col("ints").asc()]
    # at most `entries` vectors reach the driver
    first = rows.orderBy(*order).limit(1).select(F.size("ints").alias("n")).collect()
    if not first:
        out = StructType([StructField("vec_id", vectors.schema[vec_id].dataType), StructField("label", kind)])
        return spark.createDataFrame([], out).select("vec_id", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"), "label", F.lit(0).cast("long").alias("label_error")), None
    dimensions = first[0]["n"]
    rows = rows.where(F.size("ints") == dimensions)
    size = -(-dimensions // parts)
    start = rows.orderBy(*order).limit(entries).select("ints").toPandas()["ints"]
    ints = np.zeros((len(start), parts * size), dtype=np.int64)
    ints[:, :dimensions] = np.array(start.tolist(), dtype=np.int64)
    books = Codebooks(np.ascontiguousarray(ints.reshape(len(start), parts, size).transpose(1, 0, 2)), dimensions, scale)
    blocks = cut(rows.mapInArrow(partial(_encode, dimensions=dimensions, width=parts * size), BLOCK))
    for _ in range(rounds):
        held = spark.sparkContext.broadcast(books)
        sums = blocks.mapInArrow(partial(_partial_sums, books=held), SUMS)
        merged = sums.repartition("part", "entry").mapInArrow(_add_up, SUMS).toPandas()  # parts x entries rows at most
        moved = books.entries.copy()
        for row in merged.itertuples():
            moved[row.part, row.entry] = np.asarray(row.total, dtype=np.int64) // row.n  # floor, also below zero
        books = Codebooks(moved, dimensions, scale)
        held.unpersist()
    done = StructType([StructField("id", rows.schema["id"].dataType), StructField("label", kind)]).add("code", "string").add("error", "long")
    coded = cut(blocks.mapInArrow(partial(_codes, books=spark.sparkContext.broadcast(books)), done))
    # every label's sum goes to several tasks, and so do the rows of a label
    key = [F.coalesce(F.col("label").cast("string"), F.lit("")).alias("_name"), F.col("label").isNull().alias("_none")]
    sums = coded.groupBy(*key).agg(F.sum("error").alias("label_error")).withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(LABEL_SALTS - 1))))
    rows = coded.select("*", *key, F.pmod(F.xxhash64("id", "code"), F.lit(LABEL_SALTS)).cast("int").alias("_salt"))
    joined = rows.join(sums, ["_name", "_none", "_salt"])
    return joined.select(F.col("id").alias("vec_id"), "code", "error", "label", "label_error"), books
