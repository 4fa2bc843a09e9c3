"""Quality classifier by nearest-neighbour voting in a latent-semantic space.

A document's terms are of two views. Shapes say how it is written: the classes of
characters of each word (runs of lower case, upper case and digits, and every
punctuation mark), marked when the word repeats the one before, and pairs of
neighbouring shapes. Words say what it says: runs of letters and digits of any script,
A-Z lower-cased (scripts without spaces count by single characters), and pairs of
neighbours. Both are hashed to columns of their own, weighted by log frequency and
inverse document frequency, brought to the same length and projected
on the leading singular vectors. The labelled vectors of a bounded sample (the
parameter ``sample``) are broadcast; for every document, exact cosine products with
all of them are computed block by block, and the nearest ``neighbours`` vote with
their labels, weighted by a power of the similarity.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from .base import LOWER, Words, _byte_values, blocks, prepare, ranged_hash, splitmix, text_buffers, text_key

#: Columns of the shapes, and of all terms: the words have the others.
SHAPES = 1 << 11
TERMS = SHAPES + (1 << 14)
#: Terms whose rows of the axes are held at a time.
CHUNK_TERMS = 100_000
_CLASS = np.arange(256, dtype=np.uint8)
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58], _CLASS[128:] = 1, 2, 3, 0
_LETTER = (_CLASS <= 3) & ~np.isin(np.arange(256), (0, 1, 2, 3))
#: First two UTF-8 bytes of characters that are words by themselves: Thai and Lao, Myanmar, Khmer, and from U+2000 on (marks, Han, kana, symbols) all but Hangul.
_ALONE = np.zeros(1 << 16, dtype=bool)
for _lo, _hi in ((0xE0B8, 0xE0BB), (0xE180, 0xE181), (0xE19E, 0xE19F), (0xE280, 0xEAAF), (0xED9F, 0xFFFF)):
    _ALONE[_lo:_hi + 1] = True


@dataclass
class Terms:
    """Distinct terms of documents: term[first[i]:first[i + 1]] are those of document i, log has the logarithms of 1 + their counts."""

    first: np.ndarray
    term: np.ndarray
    log: np.ndarray

    def chunks(self):
        """(first document, end) in ranges of about CHUNK_TERMS terms, at least one document."""
        return blocks(self.first, CHUNK_TERMS)

    def weights(self, idf: np.ndarray) -> np.ndarray:
        """Log frequencies times idf; the shapes and the words of a document have length 1 each."""
        out = np.empty(len(self.term), dtype=np.float32)
        for lo, hi in self.chunks():
            a, b = self.first[lo], self.first[hi]
            term = self.term[a:b]
            weight = self.log[a:b] * idf[term]
            view = 2 * np.repeat(np.arange(hi - lo), np.diff(self.first[lo:hi + 1])) + (term >= SHAPES)
            length = np.sqrt(np.bincount(view, weights=weight.astype(np.float64) ** 2, minlength=2 * (hi - lo)))
            out[a:b] = weight / np.maximum(length, 1e-9)[view]
        return out

    def times(self, weight: np.ndarray, matrix: np.ndarray) -> np.ndarray:
        """Documents x columns: the weighted terms times a matrix (TERMS x columns)."""
        out = np.zeros((len(self.first) - 1, matrix.shape[1]), dtype=np.float32)
        for lo, hi in self.chunks():
            a, b = self.first[lo], self.first[hi]
            some = np.flatnonzero(np.diff(self.first[lo:hi + 1]))
            if len(some):
                out[lo + some] = np.add.reduceat(matrix[self.term[a:b]] * weight[a:b, None], self.first[lo + some] - a, axis=0)
        return out

    def back(self, weight: np.ndarray, matrix: np.ndarray) -> np.ndarray:
        """TERMS x columns: the transposed weighted terms times a matrix (documents x columns)."""
        out = np.zeros((TERMS, matrix.shape[1]), dtype=np.float32)
        for lo, hi in self.chunks():
            a, b = self.first[lo], self.first[hi]
            turn = np.argsort(self.term[a:b], kind="stable")
            term = self.term[a:b][turn]
            doc = np.repeat(np.arange(lo, hi), np.diff(self.first[lo:hi + 1]))[turn]
            new = np.flatnonzero(np.r_[len(term) > 0, term[1:] != term[:-1]])
            if len(new):
                out[term[new]] += np.add.reduceat(matrix[doc] * weight[a:b][turn][:, None], new, axis=0)
        return out


@dataclass
class Model:
    """idf (TERMS), axes (TERMS x dimensions), labelled unit vectors and their labels."""

    idf: np.ndarray
    axes: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    neighbours: int
    power: float

    def project(self, terms: Terms) -> np.ndarray:
        out = terms.times(terms.weights(self.idf), self.axes)
        return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)

    def score(self, terms: Terms, block: int = 128) -> np.ndarray:
        """The share of votes for label 1; rows without terms get the labels' mean."""
        prior = float(self.labels.mean()) if len(self.labels) else 0.5
        out = np.full(len(terms.first) - 1, prior)
        rows = np.flatnonzero(np.diff(terms.first))
        if not len(self.labels) or not len(rows):
            return out
        k = min(self.neighbours, len(self.labels))
        places = self.project(terms)
        for lo in range(0, len(rows), block):
            part = rows[lo:lo + block]
            near = places[part] @ self.vectors.T
            top = np.argpartition(near, len(self.labels) - k, axis=1)[:, -k:]
            weight = np.clip(np.take_along_axis(near, top, axis=1), 1e-6, 1).astype(np.float64) ** self.power
            out[part] = np.clip((weight * self.labels[top]).sum(axis=1) / weight.sum(axis=1), 0, 1)
        return out


def _shape_terms(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """(document, hash) of every word's shape and of every pair of neighbouring shapes."""
    kind = _CLASS[w.data]
    ascii_at = np.flatnonzero(kind != 0)  # other letters are neither case
    kind = kind[ascii_at]
    begin, end = np.searchsorted(ascii_at, w.starts), np.searchsorted(ascii_at, w.ends)
    first = np.zeros(len(kind) + 1, dtype=bool)
    first[begin] = True
    fresh = np.ones(len(kind), dtype=bool)
    fresh[1:] = (kind[1:] != kind[:-1]) | (kind[1:] > 3) | first[1:-1]
    at = np.concatenate([[0], np.cumsum(fresh)])
    kept = splitmix(kind[fresh].astype(np.uint64) + np.uint64(11))
    shape = ranged_hash(kept, at[begin], at[end], 2)
    word = w.hashes(0)
    doc = w.doc_of()
    same = np.zeros(len(word), dtype=bool)
    same[1:] = (word[1:] == word[:-1]) & (doc[1:] == doc[:-1])
    return _with_pairs(doc, splitmix(shape + same.astype(np.uint64) * np.uint64(0x9E3779B9)))


def _with_pairs(doc: np.ndarray, term: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    pair = splitmix(term[1:] * np.uint64(3) + term[:-1])
    inner = doc[1:] == doc[:-1]
    return np.concatenate([doc, doc[1:][inner]]), np.concatenate([term, pair[inner]])


def _word_terms(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """(document, hash) of every run of letters and digits, or character that is a word by itself, and of every pair of neighbours."""
    data = w.data
    n = len(data)
    letter = _LETTER[data]
    lead = data >= 0xE0
    alone = np.zeros(n, dtype=bool)
    at = np.flatnonzero(lead[:-1])
    alone[at] = _ALONE[data[at].astype(np.int64) << 8 | data[at + 1]]
    opens = letter.copy()
    opens[1:] &= ~letter[:-1]
    opens |= alone
    edges = w.offsets[:-1][w.offsets[:-1] < n]
    opens[edges] = letter[edges]
    # what follows a character that is a word by itself opens the next one
    alone_at = np.flatnonzero(alone)
    after = alone_at + np.where(data[alone_at] >= 0xF0, 4, 3)
    after = after[after < n]
    opens[after] |= letter[after]
    starts = np.flatnonzero(opens)
    # a word ends with its run of letters, or where the next one opens
    gaps = np.concatenate([np.flatnonzero(~letter), [n]])
    ends = np.minimum(gaps[np.searchsorted(gaps, starts)], np.concatenate([starts[1:], [n]]))
    word = ranged_hash(_byte_values(0)[LOWER[data]], starts, ends, 0)
    doc = np.searchsorted(w.offsets, starts, side="right") - 1
    return _with_pairs(doc, word)


def count_terms(w: Words) -> Terms:
    """The terms of a block of documents."""
    docs = len(w.count)
    if not len(w.starts):
        return Terms(np.zeros(docs + 1, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.float32))
    shape_doc, shape = _shape_terms(w)
    word_doc, word = _word_terms(w)
    shape, word = shape % np.uint64(SHAPES), word % np.uint64(TERMS - SHAPES) + np.uint64(SHAPES)
    key = np.sort(np.concatenate([shape_doc * TERMS + shape.astype(np.int64), word_doc * TERMS + word.astype(np.int64)]))
    new = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    count = np.diff(np.r_[new, len(key)])
    first = np.searchsorted(key[new], np.arange(docs + 1) * TERMS)
    return Terms(first, key[new] % TERMS, np.log1p(count).astype(np.float32))


def _train_rows(batches):
    """Each document's terms (16 bits each) and the logarithms of 1 + their counts (float16: counts themselves would be infinite from 65,520 on)."""
    for batch in batches:
        data, off = text_buffers(batch.column("text"))
        for lo, hi in blocks(off):
            t = count_terms(Words(data, off[lo:hi + 1]))
            ranges = list(zip(t.first[:-1], t.first[1:], strict=True))
            term, log = t.term.astype(np.uint16), t.log.astype(np.float16)
            cells = [pa.array([x[a:b].tobytes() for a, b in ranges], pa.binary()) for x in (term, log)]
            yield pa.RecordBatch.from_arrays([batch.column("label").slice(lo, hi - lo), batch.column("turn").slice(lo, hi - lo), *cells], ["label", "turn", "terms", "logs"])


def learn(terms: Terms, y: np.ndarray, dimensions: int, neighbours: int, power: float) -> Model:
    """The model of labelled documents."""
    docs = len(terms.first) - 1
    idf = np.log((1 + docs) / (1 + np.bincount(terms.term, minlength=TERMS))).astype(np.float32) + 0.1
    weight = terms.weights(idf)
    # leading singular vectors by subspace iteration
    basis = np.random.default_rng(5).standard_normal((TERMS, min(dimensions + 8, docs))).astype(np.float32)
    for _ in range(4):
        basis = np.linalg.qr(terms.back(weight, terms.times(weight, basis)))[0]
    _, _, right = np.linalg.svd(terms.times(weight, basis), full_matrices=False)
    axes = np.ascontiguousarray((basis @ right.T)[:, :dimensions], dtype=np.float32)
    model = Model(idf, axes, np.zeros((0, axes.shape[1]), np.float32), y, neighbours, power)
    model.vectors = model.project(terms).astype(np.float32)
    return model


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", sample: int = 4000, dimensions: int = 48, neighbours: int = 25, power: float = 4.0) -> Model:
    """Fit on up to ``sample`` labelled documents, the first by a hash of their id; labels has doc_id and the label (0 or 1).

    Rows with a null label or id are ignored, and an id counts once, with the smallest of its labels. Of the
    rows of one id, the text with the smallest digest is learned from, so no more than ``sample`` rows reach the driver.
    The caller keeps held-out rows out of labels."""
    prepare(docs.sparkSession)
    known = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull()).groupBy("doc_id").agg(F.min(F.col(label).cast("double")).alias("label"))
    chosen = known.withColumn("turn", F.xxhash64(F.col("doc_id"), F.lit(17))).orderBy("turn", "doc_id").limit(sample)  # at most sample rows: small enough to broadcast
    wanted = docs.select("doc_id", "text").join(F.broadcast(chosen.select("doc_id")), "doc_id", "left_semi")
    texts = wanted.groupBy("doc_id").agg(F.min(F.struct(text_key("text").alias("digest"), "text")).alias("first"))
    rows = texts.join(F.broadcast(chosen), "doc_id").select("label", "turn", F.col("first.text").alias("text"))
    found = rows.mapInArrow(_train_rows, "label double, turn long, terms binary, logs binary").toPandas().sort_values(["turn", "label"], kind="stable")
    if not len(found):
        return Model(np.ones(TERMS, np.float32), np.zeros((TERMS, 1), np.float32), np.zeros((0, 1), np.float32), np.zeros(0), neighbours, power)
    y = found["label"].to_numpy(dtype=np.float64)
    first = np.concatenate([[0], np.cumsum([len(x) // 2 for x in found["terms"]])])
    term, log = np.frombuffer(b"".join(found["terms"]), np.uint16), np.frombuffer(b"".join(found["logs"]), np.float16)
    return learn(Terms(first, term, log), y, dimensions, neighbours, power)


def _scores(batch: pa.RecordBatch, model: Model) -> np.ndarray:
    data, off = text_buffers(batch.column("text"))
    parts = [model.score(count_terms(Words(data, off[lo:hi + 1]))) for lo, hi in blocks(off)]
    return np.concatenate(parts) if parts else np.zeros(0)


def _add_score(batches, model, column: str):
    for batch in batches:
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in batch.schema.names if c != "text"), pa.array(_scores(batch, model.value))], [*(c for c in batch.schema.names if c != "text"), column])


def _keep(batches, model, least: float):
    for batch in batches:
        yield batch.filter(pa.array(_scores(batch, model.value) >= least))


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    """One row per document: doc_id and score (0 to 1, higher: label 1 likelier), of the whole text.

    Null, empty and wordless texts get the mean label of the sample. Only doc_id
    and text are read; equal texts get equal scores."""
    spark = prepare(docs.sparkSession)
    rows = docs.select("doc_id", "text")
    kind = StructType([rows.schema["doc_id"], StructField("score", DoubleType())])
    return rows.mapInArrow(partial(_add_score, model=spark.sparkContext.broadcast(model), column="score"), kind)


def keep_quality(docs: DataFrame, model: Model, least: float = 0.3) -> DataFrame:
    """The rows of docs, all columns, with a score of at least ``least``. Nothing is shuffled."""
    spark = prepare(docs.sparkSession)
    return docs.mapInArrow(partial(_keep, model=spark.sparkContext.broadcast(model), least=least), docs.schema)
