"""Benchmark decontamination: CGK random-walk embedding, bit-sampling LSH, exact edit verification.

Everything is on words: runs outside space and \\x09-\\x0D, A-Z lower-cased. A
document is contaminated by an item when some stretch of it is within
``floor(rate * n)`` word edits of the item's n words.

A CGK walk reads a text from some word on: at each step it writes the word under
its pointer and a random bit of (step, word) decides whether the pointer moves. Two
walks over texts at a small edit distance fall back into step, so the edit distance
shows as a small Hamming distance between the written words. Each band samples a
few steps of a walk and hashes them. Documents are walked from every
``STRIDE``-th word, items from all their words, so wherever a passage stands, many
of its windows are aligned with some start in the item. The number of walks is
the least whose simulated recall on the given items, edited at the full rate, is
the target. Hits are verified exactly; verification decides alone.

The band tables are broadcast in blocks of items of at most ``max_table_bytes``;
more items make more passes over the documents, with the same results.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import Words, blocks, prepare, ranged_hash, record_batches, splitmix, text_buffers

#: Words between the window starts of a document.
STRIDE = 4
#: (steps of the walk, sampled steps) of each walk's bands: short ones stand edits better, long ones are more selective.
BANDS = ((8, 6), (14, 5), (22, 5), (4, 3))
#: The last band is for items of fewer words than this only.
SHORT_ITEM = 16
#: From so many words on, some window start of an exact copy fits the first band's walk; shorter items are also looked up whole.
SURE_WORDS = 8 + STRIDE - 1
STEPS = max(t for t, _ in BANDS)
MOST_WALKS = 12


@dataclass
class ItemTable:
    """Items as word hashes, their band keys, keys of whole items too short for an edit, and by length the keys of pieces."""

    words: list[np.ndarray]
    ids: list
    walks: int
    rate: float
    keys: np.ndarray
    item: np.ndarray
    offset: np.ndarray
    seen: np.ndarray
    short: dict[int, tuple[np.ndarray, np.ndarray]]
    bands: list[int]
    pieces: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]


def band_keys(words: np.ndarray, starts: np.ndarray, ends: np.ndarray, walk: int, bands: list[int] | None = None):
    """(band key, whether the walk stayed inside its text until the band's last step) for each band of one walk."""
    rng = np.random.default_rng(1000 + walk)
    wanted = range(len(BANDS)) if bands is None else bands
    picks = [np.sort(rng.choice(t, size=k, replace=False)) for t, k in BANDS]
    coins = splitmix(words ^ np.uint64(splitmix(np.array([walk + 1], np.uint64))[0]))
    padded = np.concatenate([words, [np.uint64(0)]])
    coins = np.concatenate([coins, [np.uint64(0)]])
    at = starts.copy()
    keys = [np.full(len(starts), (b + 1) * 0x9E3779B9 + walk, dtype=np.uint64) for b in range(len(BANDS))]
    inside = [np.ones(len(starts), dtype=bool) for _ in BANDS]
    for step in range(max((int(picks[b][-1]) + 1 for b in wanted), default=0)):
        here = padded[at]
        for b in wanted:
            if step in picks[b]:
                keys[b] = keys[b] * np.uint64(0xD1342543DE82EF95) + here
                inside[b] = at < ends
        at = np.minimum(at + ((coins[at] >> np.uint64(step)) & np.uint64(1)).astype(np.int64), ends)
    return [splitmix(keys[b]) for b in wanted], [inside[b] for b in wanted]


def infix_distance(item: np.ndarray, text: np.ndarray) -> int:
    """The least word edit distance between the item and any stretch of text (bit-parallel columns)."""
    n = len(item)
    masks: dict[int, int] = {}
    for i, w in enumerate(item.tolist()):
        masks[w] = masks.get(w, 0) | 1 << i
    full, top = (1 << n) - 1, 1 << (n - 1)
    up, down, score = full, 0, n
    best = n
    for w in text.tolist():
        eq = masks.get(w, 0)
        diagonal = (((eq & up) + up) ^ up) | eq | down
        right_up = down | (full & ~(diagonal | up))
        right_down = up & diagonal
        if right_up & top:
            score += 1
        elif right_down & top:
            score -= 1
        right_up, right_down = (right_up << 1) & full, (right_down << 1) & full
        up = right_down | (full & ~(diagonal | right_up))
        down = right_up & diagonal
        best = min(best, score)
    return best


def _edited(words: np.ndarray, edits: int, rng) -> np.ndarray:
    out = list(words)
    for _ in range(edits):
        at, kind = int(rng.integers(0, len(out))), int(rng.integers(0, 3))
        new = np.uint64(rng.integers(1, 1 << 63))
        if kind == 0:
            out[at] = new
        elif kind == 1:
            out.insert(at, new)
        elif len(out) > 1:
            out.pop(at)
    return np.array(out, dtype=np.uint64)


#: Lengths from which on items are planned in classes, and from which on as one: longer items are found by fewer walks.
CLASS_FROM, CLASS_STEP, CLASS_TO = 64, 16, 400


def plan_walks(n: int, rate: float, recall: float) -> int:
    """The walks for an item of n words: those that the shortest length of its class needs; 0 if MOST_WALKS don't find the target share."""
    return _plan_walks(n if n < CLASS_FROM else min(n - n % CLASS_STEP, CLASS_TO), rate, recall)


@lru_cache(maxsize=None)
def _plan_walks(n: int, rate: float, recall: float) -> int:
    """The least number of walks that finds the target share of edited items of n words, at every alignment; 0 if MOST_WALKS don't.

    Simulated on random words, so the plan of a length is the same whatever items stand beside it."""
    edits = int(rate * n)
    rng = np.random.default_rng(7)
    trials = min(max(20_000 // n, 50), 400)
    items = [rng.integers(1, 1 << 63, size=n).astype(np.uint64) for _ in range(trials)]
    edited = [_edited(w, edits, rng) for w in items]
    words, at = np.concatenate(items), np.arange(trials * n)
    size = np.array([len(x) for x in edited])
    tails = rng.integers(1, 1 << 63, size=(trials, STEPS)).astype(np.uint64)
    text = np.concatenate([part for x in zip(edited, tails, strict=True) for part in x])
    first = np.cumsum(size + STEPS) - size - STEPS
    trial = np.repeat(np.arange(trials), size)
    place = np.arange(len(trial)) - (np.cumsum(size) - size)[trial]
    found = np.zeros((trials, STRIDE), dtype=bool)
    for walk in range(MOST_WALKS):
        theirs, inside = band_keys(words, at, (at // n + 1) * n, walk)
        ours, _ = band_keys(text, first[trial] + place, (first + size + STEPS)[trial], walk)
        for a, ok, b in list(zip(theirs, inside, ours, strict=True))[:len(BANDS) if n < SHORT_ITEM else len(BANDS) - 1]:
            hit = np.isin(splitmix(b + trial.astype(np.uint64)), splitmix(a[ok] + (at[ok] // n).astype(np.uint64)))
            found[trial[hit], place[hit] % STRIDE] = True
        if found.mean() >= recall:
            return walk + 1
    return 0


def item_words(texts: list[str | None]) -> list[np.ndarray]:
    data, off = text_buffers(pa.array(texts, pa.large_string()))
    w = Words(data, off, lower=True)
    h = w.hashes(0)
    return [h[a:b] for a, b in zip(w.first[:-1], w.first[1:], strict=True)]


def build_table(ids: list, words: list[np.ndarray], rate: float, recall: float) -> ItemTable:
    keys, item, offset, bands, most = [], [], [], set(), 0
    parts: dict[int, list[tuple[int, int, int]]] = {}
    for i, w in enumerate(words):
        edits = int(rate * len(w))
        if edits < 1:
            continue
        walks = plan_walks(len(w), rate, recall)
        most = max(most, walks)
        if not walks:
            cuts = np.linspace(0, len(w), min(edits + 1, len(w)) + 1).astype(np.int64).tolist()
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                parts.setdefault(b - a, []).append((int(ranged_hash(w, np.array([a]), np.array([b]), 1)[0]), i, a))
        for walk in range(walks):
            found, inside = band_keys(w, np.arange(len(w)), np.full(len(w), len(w)), walk)
            for b, (k, ok) in enumerate(zip(found, inside, strict=True)):
                if b == len(BANDS) - 1 and len(w) >= SHORT_ITEM:
                    continue
                at = np.flatnonzero(ok)
                bands.add(b)
                keys.append(k[at])
                item.append(np.full(len(at), i, dtype=np.int32))
                offset.append(at.astype(np.int32))
    keys = np.concatenate(keys) if keys else np.zeros(0, np.uint64)
    order = np.argsort(keys, kind="stable")
    item, offset = (np.concatenate(x)[order] if len(keys) else np.zeros(0, np.int32) for x in (item, offset))
    seen = np.zeros(1 << 20, dtype=bool)
    seen[(keys >> np.uint64(44)).astype(np.int64)] = True
    short: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for n in sorted({len(w) for w in words if 0 < len(w) and (int(rate * len(w)) < 1 or len(w) < SURE_WORDS)}):
        rows = np.array([i for i, w in enumerate(words) if len(w) == n], dtype=np.int32)
        h = np.array([ranged_hash(words[i], np.array([0]), np.array([n]), 1)[0] for i in rows], dtype=np.uint64)
        turn = np.argsort(h)
        short[n] = (h[turn], rows[turn])
    pieces = {}
    for n, rows in parts.items():
        rows.sort()
        pieces[n] = np.array([x for x, _, _ in rows], np.uint64), np.array([x for _, x, _ in rows], np.int32), np.array([x for _, _, x in rows], np.int32)
    return ItemTable(words, ids, most, rate, keys[order], item, offset, seen, short, sorted(bands), pieces)


def _equal_ranges(sorted_keys: np.ndarray, probe: np.ndarray):
    """(index of probe, index of key) for every equal pair."""
    lo, hi = np.searchsorted(sorted_keys, probe, "left"), np.searchsorted(sorted_keys, probe, "right")
    which = np.repeat(np.arange(len(probe)), hi - lo)
    begin = np.repeat(lo - np.concatenate([[0], np.cumsum(hi - lo)[:-1]]), hi - lo)
    return which, begin + np.arange(len(which))


def block_matches(w: Words, table: ItemTable) -> list[tuple[int, int, int]]:
    """(document, item, distance) of a block of documents."""
    h = w.hashes(0)
    doc_of = w.doc_of()
    best: dict[tuple[int, int], int] = {}
    for n, (keys, rows) in table.short.items():
        at = w.window_starts(n)
        which, key = _equal_ranges(keys, ranged_hash(h, at, at + n, 1))
        for a, i in zip(at[which].tolist(), rows[key].tolist(), strict=True):
            if np.array_equal(h[a:a + n], table.words[i]):
                best[int(doc_of[a]), i] = 0
    hits = set()
    for n, (keys, item, offset) in table.pieces.items():
        at = w.window_starts(n)
        which, key = _equal_ranges(keys, ranged_hash(h, at, at + n, 1))
        hits.update(zip(doc_of[at[which]].tolist(), item[key].tolist(), (at[which] - offset[key]).tolist(), strict=True))
    if len(table.keys) and len(h):
        place = np.arange(len(h)) - w.first[doc_of]
        starts = np.flatnonzero(place % STRIDE == 0)
        ends = w.first[doc_of[starts] + 1]
        for walk in range(table.walks):
            keys, _ = band_keys(h, starts, ends, walk, table.bands)
            for k in keys:
                maybe = np.flatnonzero(table.seen[(k >> np.uint64(44)).astype(np.int64)])
                which, key = _equal_ranges(table.keys, k[maybe])
                at = starts[maybe[which]]
                hits.update(zip(doc_of[at].tolist(), table.item[key].tolist(), (at - table.offset[key]).tolist(), strict=True))
    for doc, i, begin in sorted(hits):
        item = table.words[i]
        most = int(table.rate * len(item))
        if best.get((doc, i), most + 1) == 0:
            continue
        a, b = max(begin - most, int(w.first[doc])), min(begin + len(item) + most, int(w.first[doc + 1]))
        distance = infix_distance(item, h[a:b])
        if distance <= most:
            best[doc, i] = min(distance, best.get((doc, i), distance))
    return [(doc, i, d) for (doc, i), d in sorted(best.items())]


def _matches(batches, table):
    table = table.value
    for batch in batches:
        data, off = text_buffers(batch.column("text"))
        for lo, hi in blocks(off):
            found = block_matches(Words(data, off[lo:hi + 1], lower=True), table)
            if found:
                doc, item, distance = (np.array(x) for x in zip(*found, strict=True))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(doc + lo)), pa.array([table.ids[i] for i in item], pa.int64()), pa.array(distance.astype(np.int64)),
                                                  pa.array([len(table.words[i]) for i in item], pa.int64())], ["doc_id", "item_id", "distance", "item_words"])


def _clean(batches, table):
    table = table.value
    for batch in batches:
        data, off = text_buffers(batch.column("text"))
        keep = np.ones(batch.num_rows, dtype=bool)
        for lo, hi in blocks(off):
            for doc, _, _ in block_matches(Words(data, off[lo:hi + 1], lower=True), table):
                keep[lo + doc] = False
        yield batch.filter(pa.array(keep))


def _tables(items: DataFrame, rate: float, recall: float, max_table_bytes: int):
    """The items in broadcast blocks of bounded size. items streams through the driver a block at a time."""
    spark = prepare(items.sparkSession)
    held, size, made = [], 0, False

    def flush():
        words = item_words([t for _, t in held])
        return spark.sparkContext.broadcast(build_table([i for i, _ in held], words, rate, recall))

    for row in items.select(F.col("item_id").cast("long").alias("item_id"), "text").toLocalIterator():
        need = 16 * (len(row["text"] or "") // 2 + 1) * len(BANDS) * MOST_WALKS
        if held and size + need > max_table_bytes:
            yield flush()
            held, size, made = [], 0, True
        held.append((row["item_id"], row["text"]))
        size += need
    if held or not made:
        yield flush()


def find_contaminated(docs: DataFrame, items: DataFrame, rate: float = 0.2, recall: float = 0.95, max_table_bytes: int = 256 << 20) -> DataFrame:
    """One row per document and item that it contains: doc_id, item_id, distance (word edits), item_words.

    Documents and items that are null, empty or without words match nothing. Exact
    copies are found always, and items of fewer words than 1/rate must be exact; for
    edited copies of items of each length recall is the target, and no pair beyond the edit bound is ever
    returned. Repeated documents and repeated items give a row each; a null
    doc_id or item_id is returned as null. Only doc_id, text and item_id, text
    are read. distance is the least found among the verified places."""
    prepare(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    kind = "doc_id long, item_id long, distance long, item_words long"
    out = None
    for table in _tables(items, rate, recall, max_table_bytes):
        part = rows.mapInArrow(partial(_matches, table=table), kind)
        out = part if out is None else out.unionByName(part)
    return out


def drop_contaminated(docs: DataFrame, items: DataFrame, rate: float = 0.2, recall: float = 0.95, max_table_bytes: int = 256 << 20) -> DataFrame:
    """The rows of docs, all columns, that contain no item; see find_contaminated. Nothing is shuffled."""
    prepare(docs.sparkSession)
    for table in _tables(items, rate, recall, max_table_bytes):
        docs = docs.mapInArrow(partial(_clean, table=table), docs.schema)
    return docs
