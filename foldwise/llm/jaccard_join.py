"""N-gram Jaccard join with several global token orders.

A document's set is its distinct word shingles, as 64-bit hashes. Equal sets are one
class, found by a set digest, so copies never meet again. A pair at or above the
threshold shares a token within the prefixes of both sets under *every* total order
of the tokens. The first order (frequent tokens last, then by hash) is an inverted
index: sets that share a prefix token stand in one group. Two more orders, by other
hashes, must agree before a pair is counted exactly.

No group emits all its pairs:

* a pair is looked at only in the first prefix token of a common run (rows carry the
  token before theirs), with the length bound and the shorter set's shorter index prefix;
* in groups of up to SMALL sets a parity bitmap of each set bounds the overlap from
  above, and only pairs that could be links leave the task;
* in larger groups the whole sets are compared inside the task, and what leaves it
  is a spanning forest of the links found, at most one link a set. Groups beyond
  ``BLOCK_TOKENS`` are dealt as pairs of blocks, still exact.

Components are what links reach, so no link between different texts is lost.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .base import WORD, Words, blocks, cut, id_key, prepare, ranged_hash, record_batches, splitmix, text_buffers, text_key
from .graph import components

#: Groups up to this many sets are compared by bitmaps, larger ones with their whole sets.
SMALL = 64
#: Tokens of a group that one task holds; more are dealt as pairs of blocks.
BLOCK_TOKENS = 4_000_000
#: Tokens in which a scan task looks for frequent ones at a time, and from how many sets on it reports them.
CHUNK_TOKENS, CHUNK_SETS = 4_000_000, 4
#: Entries of the broadcast order table: 9 bytes each, whatever the size of the corpus. It only orders tokens; any order is exact.
ORDER_ENTRIES = 1 << 20
ORDERS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)


def shingle_sets(column: pa.Array, size: int):
    """(row, first token of each row, tokens, digest) for blocks of rows; tokens of a row ascend and are distinct."""
    data, off = text_buffers(column)
    for lo, hi in blocks(off):
        w = Words(data, off[lo:hi + 1], lower=True)
        h = w.hashes(0)
        at = w.window_starts(size)
        few = np.flatnonzero((w.count > 0) & (w.count < size))
        tokens = np.concatenate([ranged_hash(h, at, at + size, 1), ranged_hash(h, w.first[:-1][few], w.first[1:][few], 1)])
        doc = np.concatenate([w.doc_of()[at], few])
        order = np.lexsort((tokens, doc))
        tokens, doc = tokens[order], doc[order]
        new = np.ones(len(tokens), dtype=bool)
        new[1:] = (tokens[1:] != tokens[:-1]) | (doc[1:] != doc[:-1])
        tokens, doc = tokens[new], doc[new]
        n = np.bincount(doc, minlength=hi - lo)
        first = np.concatenate([[0], np.cumsum(n)])
        sums = np.concatenate([[np.uint64(0)], np.cumsum(splitmix(tokens + np.uint64(77)), dtype=np.uint64)])
        yield lo, hi, first, tokens, doc, splitmix(sums[first[1:]] - sums[first[:-1]] + n.astype(np.uint64)).view(np.int64)


def bitmap_class(n: np.ndarray) -> np.ndarray:
    """Bitmaps have 512 << class bits: enough that unrelated sets differ in more bits than links may."""
    return np.ceil(np.log2(np.maximum(np.asarray(n), 1000) / 1000)).astype(np.int64)


def _bitmap(tokens: np.ndarray) -> bytes:
    bits = 512 << int(bitmap_class(len(tokens)))
    odd = np.bincount((tokens & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def _scan(batches, size: int):
    """kind 0: a set (a id, b text key, n, sid, bits); kind 1: a token (a) that b sets of a chunk share."""
    chunk, seen, held = [], set(), 0

    def frequent():
        tokens, counts = np.unique(np.concatenate(chunk), return_counts=True)
        often = counts >= CHUNK_SETS
        k = int(often.sum())
        return _scanned(np.ones(k, np.int8), tokens[often].view(np.int64), counts[often].astype(np.int64), np.zeros(k, np.int32), np.zeros(k, np.int64), pa.nulls(k, pa.binary()))

    for batch in batches:
        ids, keys = batch.column("_id").to_numpy(), batch.column("_th").to_numpy()
        for lo, hi, first, tokens, _, sid in shingle_sets(batch.column("text"), size):
            n = np.diff(first)
            bits = [_bitmap(tokens[a:b]) for a, b in zip(first[:-1], first[1:], strict=True)]
            yield _scanned(np.zeros(hi - lo, np.int8), ids[lo:hi], keys[lo:hi], n.astype(np.int32), sid, pa.array(bits, pa.binary()))
            for i, s in enumerate(sid.tolist()):
                if s not in seen:
                    seen.add(s)
                    chunk.append(tokens[first[i]:first[i + 1]])
                    held += int(n[i])
            if held >= CHUNK_TOKENS:
                yield frequent()
                chunk, seen, held = [], set(), 0
    if chunk:
        yield frequent()


def _scanned(kind, a, b, n, sid, bits) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(kind), pa.array(a), pa.array(b), pa.array(n), pa.array(sid), bits], ["kind", "a", "b", "n", "sid", "bits"])


def prefix_lengths(n: np.ndarray, num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
    """How many first tokens must meet: of any set, and of the set that is not the larger of its pair."""
    n = n.astype(np.int64)
    return n - -(-num * n // den) + 1, n - -(-2 * num * n // (den + num)) + 1


def _postings(batches, size: int, num: int, den: int, order):
    heavy, classes = order.value
    for batch in batches:
        out = {k: [] for k in ("token", "sid", "n", "prev", "role")}
        seen: set[int] = set()
        for lo, hi, first, tokens, doc, sid in shingle_sets(batch.column("text"), size):
            fresh = np.zeros(hi - lo, dtype=bool)
            for i, s in enumerate(sid.tolist()):
                if s not in seen and first[i + 1] > first[i]:
                    seen.add(s)
                    fresh[i] = True
            n = np.diff(first)
            rank = np.zeros(len(tokens), dtype=np.uint8)
            if len(heavy):
                at = np.minimum(np.searchsorted(heavy, tokens), len(heavy) - 1)
                rank = np.where(heavy[at] == tokens, classes[at], 0)
            turn = np.lexsort((splitmix(tokens ^ np.uint64(ORDERS[0])), rank, doc))
            tokens = tokens[turn]
            place = np.arange(len(tokens)) - first[doc]
            any_side, small_side = prefix_lengths(n, num, den)
            before = np.concatenate([[np.uint64(0)], tokens[:-1]])
            before = np.where(place == 0, splitmix(sid.view(np.uint64))[doc], before)
            pick = (place < any_side[doc]) & fresh[doc]
            for name, x in (("token", tokens.view(np.int64)), ("sid", sid[doc]), ("n", n[doc].astype(np.int32)), ("prev", before.view(np.int64)), ("role", place < small_side[doc])):
                out[name].append(x[pick])
        yield from record_batches(out, list(out))


def _groups(batches, keys: list[str]):
    """Whole groups of a sorted stream: tables whose last group is complete."""
    rest = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = pa.concat_tables([rest, table]).combine_chunks() if rest is not None else table
        if not table.num_rows:
            continue
        same = np.ones(table.num_rows, dtype=bool)
        for k in keys:
            column = table.column(k).to_numpy()
            same &= column == column[-1]
        cutoff = table.num_rows - int(np.argmin(same[::-1])) if not same.all() else 0
        if cutoff:
            yield table.slice(0, cutoff)
        rest = table.slice(cutoff)
    if rest is not None and rest.num_rows:
        yield rest


def _small_pairs(batches, num: int, den: int):
    """Pairs of small groups that pass length, run and bitmap bounds."""
    for table in _groups(batches, ["token"]):
        token, sid, n, prev, role = (table.column(c).to_numpy() for c in ("token", "sid", "n", "prev", "role"))
        n = n.astype(np.int64)
        data, off = text_buffers(table.column("bits"))
        kind = bitmap_class(n)
        own, folded, row_at = {}, {}, np.zeros(len(n), dtype=np.int64)
        for c in np.unique(kind):
            rows = np.flatnonzero(kind == c)
            row_at[rows] = np.arange(len(rows))
            width = 64 << int(c)
            own[c] = folded[c, c] = data[off[rows][:, None] + np.arange(width)].view(np.uint64)
            for lower in range(c - 1, -1, -1):
                half = folded[c, lower + 1].shape[1] // 2
                folded[c, lower] = folded[c, lower + 1][:, :half] ^ folded[c, lower + 1][:, half:]
        out = {"x": [], "y": []}
        live = np.arange(len(n))
        for k in range(1, SMALL):
            live = live[live + k < len(n)]
            live = live[token[live] == token[live + k]]
            if not len(live):
                break
            i = live[role[live] & (n[live] * den >= num * n[live + k]) & (prev[live] != prev[live + k]) & (sid[live] != sid[live + k])]
            for c in np.unique(kind[i]):
                a = i[kind[i] == c]
                for higher in np.unique(kind[a + k]):
                    p = a[kind[a + k] == higher]
                    differ = np.bitwise_count(own[c][row_at[p]] ^ folded[higher, c][row_at[p + k]]).sum(axis=1).astype(np.int64)
                    total = n[p] + n[p + k]
                    p = p[(total - differ) * (num + den) >= 2 * num * total]
                    out["x"].append(sid[p])
                    out["y"].append(sid[p + k])
        yield from record_batches(out, ["x", "y"])


def _tokens(batches, size: int):
    for batch in batches:
        for lo, hi, first, tokens, _, _ in shingle_sets(batch.column("text"), size):
            sets = pa.array([tokens[a:b].tobytes() for a, b in zip(first[:-1], first[1:], strict=True)], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("sid").slice(lo, hi - lo), sets], ["sid", "tokens"])


def shares_prefix(a: np.ndarray, b: np.ndarray, seed: int, num: int, den: int) -> bool:
    """Whether the prefixes of both sets meet under the order of one hash."""
    fronts = []
    for tokens in (a, b):
        rank = splitmix(tokens ^ np.uint64(seed))
        k = int(prefix_lengths(np.array([len(tokens)]), num, den)[0][0])
        fronts.append(rank if k >= len(rank) else np.partition(rank, k - 1)[:k])
    return bool(np.isin(fronts[0], fronts[1]).any())


def linked(a: np.ndarray, b: np.ndarray, num: int, den: int) -> bool:
    """The further orders first, then the exact count."""
    if not all(shares_prefix(a, b, seed, num, den) for seed in ORDERS[1:]):
        return False
    both = int(np.isin(a, b, assume_unique=True).sum())
    return both * den >= num * (len(a) + len(b) - both)


def _verify(batches, num: int, den: int):
    for batch in batches:
        left, right = batch.column("tx"), batch.column("ty")
        good = np.array([linked(np.frombuffer(left[i].as_buffer(), np.uint64), np.frombuffer(right[i].as_buffer(), np.uint64), num, den) for i in range(batch.num_rows)], dtype=bool)
        yield pa.RecordBatch.from_arrays([batch.column("x").filter(pa.array(good)), batch.column("y").filter(pa.array(good))], ["a", "b"])


def _marked(mark, code, first, rest) -> np.ndarray:
    """How many codes of each set in rest, which ascends, are marked."""
    lo, hi = rest[0], rest[-1] + 1
    if 4 * len(rest) > hi - lo:
        return np.add.reduceat(mark[code[first[lo]:first[hi]]], first[lo:hi] - first[lo])[rest - lo]
    return np.array([mark[code[first[j]:first[j + 1]]].sum() for j in rest])


def _forest(sid, n, prev, role, block, sets, num, den) -> list[tuple[int, int]]:
    """Links of one group that span its components, found by the further orders and exact counts of one set against all later ones at once."""
    flat = np.concatenate(sets)
    vocabulary, code = np.unique(flat, return_inverse=True)
    first = np.concatenate([[0], np.cumsum(n)])
    owner, depth = np.repeat(np.arange(len(n)), n), prefix_lengths(n, num, den)[0]
    edge, fronts = np.concatenate([[0], np.cumsum(depth)]), []
    for seed in ORDERS[1:]:
        turn = np.lexsort((splitmix(vocabulary ^ np.uint64(seed))[code], owner))
        fronts.append(code[turn[np.arange(len(code)) - first[owner] < depth[owner]]])
    label, links = np.arange(len(n)), []
    mark = np.zeros(int(code.max()) + 1, dtype=np.int32)
    for i in np.flatnonzero(role):
        hi = int(np.searchsorted(n, n[i] * den // num, side="right"))
        rest = np.arange(i + 1, hi)
        rest = rest[(label[rest] != label[i]) & (prev[rest] != prev[i]) & (sid[rest] != sid[i])]
        if block is not None:
            rest = rest[block[rest] != block[i]]
        for front, ends in ((fronts[0], edge), (fronts[1], edge), (code, first)):
            if not len(rest):
                break
            mine = front[ends[i]:ends[i + 1]]
            mark[mine] = 1
            counts = _marked(mark, front, ends, rest)
            mark[mine] = 0
            rest = rest[counts > 0 if front is not code else counts * den >= num * (n[i] + n[rest] - counts)]
        for j in rest:
            if label[j] != label[i]:
                links.append((sid[i], sid[j]))
                label[label == label[j]] = label[i]
    return links


def _large_links(batches, num: int, den: int):
    for table in _groups(batches, ["token", "lo", "hi"]):
        cols = [table.column(c).to_numpy() for c in ("token", "lo", "hi", "sid", "n", "prev", "role", "block")]
        token, lo, hi = cols[:3]
        edges = np.flatnonzero(np.r_[True, (token[1:] != token[:-1]) | (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1]), True])
        sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in table.column("tokens")]
        links = []
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            sid, n, prev, role, block = (x[a:b] for x in cols[3:])
            links += _forest(sid, n.astype(np.int64), prev, role, block if lo[a] != hi[a] else None, sets[a:b], num, den)
        if links:
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in links], pa.int64()), pa.array([y for _, y in links], pa.int64())], ["a", "b"])


def jaccard_links(docs: DataFrame, size: int, num: int, den: int) -> tuple[DataFrame, DataFrame]:
    """(rows, links): rows has doc_id, _id, _th, n, sid for each document; links (a, b) join set digests of linked classes so that links reach what all links reach."""
    spark = prepare(docs.sparkSession)
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", id_key().alias("_id"), text_key("text").alias("_th"))
    scan = cut(base.select("_id", "_th", "text").mapInArrow(partial(_scan, size=size), "kind byte, a long, b long, n int, sid long, bits binary"))
    rows = scan.where("kind = 0").select(F.col("a").alias("_id"), F.col("b").alias("_th"), "n", "sid")
    classes = scan.where("kind = 0 and n > 0").groupBy("sid").agg(F.min(F.struct("a", "b")).alias("rep"), F.min("bits").alias("bits"))

    top = scan.where("kind = 1").groupBy("a").agg(F.sum("b").alias("f")).orderBy(F.desc("f"), "a").limit(ORDER_ENTRIES).toPandas().sort_values("a")
    heavy = top["a"].to_numpy(dtype=np.int64).view(np.uint64)
    turn = np.argsort(heavy)
    order = spark.sparkContext.broadcast((heavy[turn], np.log2(np.maximum(top["f"].to_numpy(dtype=np.float64), 1))[turn].astype(np.uint8)))

    posted = base.select("text").mapInArrow(partial(_postings, size=size, num=num, den=den, order=order), "token long, sid long, n int, prev long, role boolean")
    group = Window.partitionBy("token")
    single = posted.withColumn("_lag", F.lag("sid").over(group.orderBy("n", "sid"))).where("_lag is null or _lag <> sid").drop("_lag")
    met = single.select("*", F.count(F.lit(1)).over(group).alias("m"), F.max("role").over(group).alias("_any"), F.sum("n").over(group).alias("total"))
    met = cut(met.where("m > 1 and _any").drop("_any"))

    small = met.where(F.col("m") <= SMALL).join(classes.select("sid", "bits"), "sid").select("token", "sid", "n", "prev", "role", "bits")
    small = small.repartition("token").sortWithinPartitions("token", "n", "sid")
    pairs = cut(small.mapInArrow(partial(_small_pairs, num=num, den=den), "x long, y long").distinct())
    large = met.where(F.col("m") > SMALL)

    needed = pairs.select(F.col("x").alias("sid")).union(pairs.select("y")).union(large.select("sid")).distinct()
    reps = needed.join(classes, "sid").select("sid", F.col("rep.a").alias("_id"), F.col("rep.b").alias("_th"))
    once = base.groupBy("_id", "_th").agg(F.first("text").alias("text"))  # repeated rows meet before they are dealt, so each sid has one row
    sets = cut(once.join(reps, ["_id", "_th"]).select("sid", "text").mapInArrow(partial(_tokens, size=size), "sid long, tokens binary"))

    checked = pairs.join(sets.select(F.col("sid").alias("x"), F.col("tokens").alias("tx")), "x").join(sets.select(F.col("sid").alias("y"), F.col("tokens").alias("ty")), "y")
    links = checked.mapInArrow(partial(_verify, num=num, den=den), "a long, b long")

    parts = (F.lit(1) + F.floor(F.col("total") / BLOCK_TOKENS)).cast("int")
    blocked = large.withColumn("_parts", parts).withColumn("block", F.pmod(F.col("sid"), F.col("_parts")).cast("int"))
    blocked = blocked.select("token", "sid", "n", "prev", "role", "block", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)).alias("_with"))
    blocked = blocked.select("token", F.least("block", "_with").alias("lo"), F.greatest("block", "_with").alias("hi"), "sid", "n", "prev", "role", "block").distinct()
    dealt = blocked.join(sets, "sid").repartition("token", "lo", "hi").sortWithinPartitions("token", "lo", "hi", "n", "sid")
    forest = dealt.select("token", "lo", "hi", "sid", "n", "prev", "role", "block", "tokens").mapInArrow(partial(_large_links, num=num, den=den), "a long, b long")
    return rows, links.unionByName(forest)


def jaccard_components(docs: DataFrame, size: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """One row per document: doc_id, text_key, n_shingles, class_id (set digest; null for empty sets), root_id (of the component), component_id.

    Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased; a set is the distinct
    ``size``-word shingles, or the whole sequence of fewer words. Two sets link when
    den * intersection >= num * union. component_id is the smallest doc_id that
    links reach, itself included. Null and empty texts, and texts without words,
    have empty sets and link with nothing: their component is their own doc_id.
    Equal sets link always. A null doc_id is never the smallest unless it is alone;
    repeated rows give repeated results. An empty table gives no rows. Only
    doc_id and text are read."""
    rows, links = jaccard_links(docs, size, num, den)
    rows = rows.withColumn("doc_id", F.when(F.col("_id") < (1 << 63) - 1, F.col("_id")))
    roots = components(links)
    least = rows.where("n > 0").groupBy("sid").agg(F.min("doc_id").alias("least"))
    placed = least.join(roots.withColumnRenamed("node", "sid"), "sid", "left").withColumn("root", F.coalesce("root", "sid"))
    smallest = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    found = placed.join(smallest, "root").select(F.col("sid").alias("class_id"), "root", "component_id")
    out = rows.withColumn("class_id", F.when(F.col("n") > 0, F.col("sid"))).join(found, "class_id", "left")
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", F.col("_th").alias("text_key"), F.col("n").cast("long").alias("n_shingles"), "class_id", F.col("root").alias("root_id"), component.alias("component_id"))


def keep_one_of_each(docs: DataFrame, size: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """The rows of docs, all columns, without near duplicates: of each component the row with the smallest doc_id stays.

    A null doc_id comes last, ties go by the text's digest, and of rows equal in id
    and text the one with the smallest digest of all its columns stays. Documents with empty sets all stay."""
    found = jaccard_components(docs, size, num, den).where("class_id is not null")
    order = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id"), F.col("text_key"))
    first = found.groupBy("root_id").agg(F.min(order).alias("f")).select(F.coalesce(F.col("f.doc_id"), F.lit((1 << 63) - 1)).alias("_id"), F.col("f.text_key").alias("_th"), F.lit(True).alias("_first"))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    words = F.coalesce(F.col("text"), F.lit("")).rlike(WORD)
    rows = docs.select(id_key().alias("_id"), text_key("text").alias("_th"), words.alias("_words"), row).join(first, ["_id", "_th"], "left")
    again = F.row_number().over(Window.partitionBy("_id", "_th").orderBy(F.xxhash64("_row")))
    return rows.withColumn("_again", again).where("not _words or (_first and _again = 1)").select("_row.*")
