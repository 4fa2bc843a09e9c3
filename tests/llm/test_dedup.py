import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm_data import clashing, documents, nothing, odd, prose  # noqa: F401

from foldwise.llm.exact_dedup import HashIndex, dedup_exact, directory
from foldwise.llm.line_dedup import Cuckoo, LineIndex, dedup_lines
from foldwise.llm.substring_dedup import difference_cover, remove_repeats

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def low(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# exact dedup

def check_exact(rows, ids, texts):
    groups = defaultdict(list)
    for i, t in zip(ids, texts, strict=True):
        groups[low(t)].append(i)
    best = {t: max((i for i in g if i is not None), default=None) for t, g in groups.items()}
    want = sorted(str((i, best[low(t)], len(groups[low(t)]), sha(low(t)))) for i, t in zip(ids, texts, strict=True))
    assert sorted(str((r.doc_id, r.keep_id, r.group_size, r.text_sha256)) for r in rows) == want
    kept = Counter(r.text_sha256 for r in rows if r.kept)
    assert kept == {sha(t): 1 for t in groups}
    assert all(r.doc_id == r.keep_id for r in rows if r.kept)


@pytest.mark.parametrize("bucket", [1 << 25, 300])
def test_exact_dedup(spark, bucket):
    texts = [prose(20, i % 17) for i in range(60)] + [prose(20, 3).upper(), None, "", None, "É", "é"] + ["hot"] * 50
    ids = [None if i % 13 == 5 else (i * 7) % 101 for i in range(len(texts))]
    check_exact(dedup_exact(documents(spark, texts, ids).repartition(6), bucket).collect(), ids, texts)


def test_exact_dedup_odd_rows(spark, odd, nothing, clashing):
    rows = odd.collect()
    check_exact(dedup_exact(clashing(odd)).collect(), [r.doc_id for r in rows], [r.text for r in rows])
    assert dedup_exact(nothing).count() == 0


def test_directory_splits_overfull_buckets(spark):
    keys = np.random.default_rng(3).integers(-(1 << 63), (1 << 63) - 1, size=4000)
    rows = [(int(k), 10) for k in keys] + [(int(keys[0]), 10)] * 500  # one key beyond a bucket: chained, not split for ever
    starts = directory(spark.createDataFrame(rows, "h long, bytes long"), 1000)
    assert starts[0] == -(1 << 63) and (np.diff(starts) > 0).all()
    at = np.searchsorted(starts, [h for h, _ in rows], side="right") - 1
    for bucket in np.unique(at):
        mine = {h for (h, _), b in zip(rows, at, strict=True) if b == bucket}
        assert len(mine) == 1 or 10 * sum(at == bucket) <= 1000


def test_exact_lookup_and_colliding_keys(spark, monkeypatch):
    index = HashIndex.build(documents(spark, ["One", "two", "two", "three"], [4, 5, 6, 7]), 8)
    found = {r.doc_id: r.keep_id for r in index.lookup(documents(spark, ["ONE", "Two", "four"], [11, 12, 13])).collect()}
    assert found == {11: 4, 12: 6, 13: None}
    import pyarrow as pa

    from foldwise.llm.exact_dedup import _chained
    batch = pa.RecordBatch.from_pydict({"bucket": pa.array([0] * 4, pa.int32()), "h": [9, 9, 9, 10], "text": pa.array([b"a", b"a", b"b", b"a"]), "sha256": ["x"] * 4, "ids": [[1], [2], [3], [4]]})
    out = next(_chained(iter([batch])))
    assert out.column("chain").to_pylist() == [0, 0, 1, 0] and out.column("text").to_pylist() == [b"a", None, b"b", b"a"]


def test_exact_inserts_split_buckets_and_chain(spark, tmp_path):
    """Batches inserted one by one give what one build gives; overfull buckets are split and the directory grows."""
    texts = [prose(8, i % 30) for i in range(90)] + ["HOT"] * 40 + [None, "É", "é"]
    ids = [None if i % 17 == 5 else (i * 7) % 211 for i in range(len(texts))]
    order = list(range(len(texts)))
    random.Random(4).shuffle(order)
    parts = [order[:20], order[20:70], order[70:], []]
    take = lambda at: documents(spark, [texts[i] for i in at], [ids[i] for i in at]).repartition(3)
    index = HashIndex.build(take(parts[0]), 300, path=str(tmp_path / "index"))
    sizes = [len(index.starts)]
    for part in parts[1:]:
        index = index.insert(take(part))
        sizes.append(len(index.starts))
    assert sizes[0] < sizes[1] < sizes[2] == sizes[3] and (np.diff(index.starts) > 0).all()
    check_exact(index.members().collect(), ids, texts)
    found = {r.doc_id: r.keep_id for r in index.lookup(documents(spark, ["hot", "nowhere"], [900, 901])).collect()}
    assert found[900] == max(i for i, t in zip(ids, texts, strict=True) if t == "HOT" and i is not None) and found[901] is None
    chains = index.table().groupBy("h").agg({"chain": "max"}).collect()
    assert all(r[1] == 0 for r in chains)


def test_new_texts_are_chained_behind_known_ones():
    import pyarrow as pa

    from foldwise.llm.exact_dedup import _extended
    batch = pa.RecordBatch.from_pydict({"bucket": pa.array([0] * 6, pa.int32()), "h": [9, 9, 9, 9, 9, 10], "text": pa.array([b"b", b"z", b"a", b"b", b"c", b"a"]), "sha256": ["x"] * 6,
                                        "ids": [[1], [2], [3], [4], [5], [6]], "chain": pa.array([0, 1, None, None, None, None], pa.int32())})
    out = next(_extended(iter([batch]), 2))
    assert out.column("chain").to_pylist() == [2, 0, 3, 0] and out.column("text").to_pylist() == [b"a", None, b"c", b"a"]
    assert out.column("piece").to_pylist() == [(2 << 40) + i for i in range(4)] and out.column("ids").to_pylist() == [[3], [4], [5], [6]]


# line dedup

def lines_by_hand(texts, counted, least):
    strip = " \t\n\v\f\r"
    counts = Counter(k for t in counted for k in {low(x.strip(strip)) for x in (t or "").split("\n")} if k)
    out = []
    for t in texts:
        lines = (t or "").split("\n")
        kept = [x for x in lines if counts[low(x.strip(strip))] < least or not low(x.strip(strip))]
        out.append((len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def line_texts():
    texts = [f"Common Line\n{prose(6, i)}\n \tcommon line \r\nrare {i % 40}\n\n" for i in range(30)]
    return texts + [None, "", "\n", "common line", "É\né", " \x0bX\x0c "]


def test_line_dedup(spark):
    texts = line_texts()
    rows = {r.doc_id: (r.n_lines, r.n_dropped, r.kept_text) for r in dedup_lines(documents(spark, texts), 10).collect()}
    assert [rows[i] for i in range(len(texts))] == lines_by_hand(texts, texts, 10)


@pytest.mark.parametrize("bound", [1 << 20, 0])
def test_line_index_is_reversible(spark, bound):
    a, b = [f"top\nboth\n{i}" for i in range(6)], [f"both\nlow {i}\n{i}" for i in range(6)]
    da, db = documents(spark, a), documents(spark, b, range(100, 106))
    grown = LineIndex.build(da, 6).insert(db)
    state = lambda x: sorted(map(tuple, x.counts.collect()))
    assert state(grown) == state(LineIndex.build(da.union(db), 6))
    back = grown.delete(db)
    assert state(back) == state(LineIndex.build(da, 6))
    for index, counted in ((grown, a + b), (back, a)):
        rows = {r.doc_id: (r.n_lines, r.n_dropped, r.kept_text) for r in index.apply(da, max_filter_bytes=bound).collect()}
        assert [rows[i] for i in range(6)] == lines_by_hand(a, counted, 6)
    emptied = back.delete(da)
    assert emptied.counts.count() == 0
    assert {r.n_dropped for r in emptied.apply(da).collect()} == {0}


def test_line_dedup_odd_rows(spark, odd, nothing, clashing):
    rows = odd.collect()
    texts = [r.text for r in rows]
    got = dedup_lines(clashing(odd), 3).collect()
    want = [(r.doc_id, *x) for r, x in zip(rows, lines_by_hand(texts, texts, 3), strict=True)]
    assert sorted(str((r.doc_id, r.n_lines, r.n_dropped, r.kept_text)) for r in got) == sorted(map(str, want))
    assert dedup_lines(nothing).count() == 0


def test_cuckoo_filter():
    rng = np.random.default_rng(1)
    k1, k2 = rng.integers(-(1 << 62), 1 << 62, size=(2, 5000))
    fits = Cuckoo.sized(5000)
    assert fits.insert(k1, k2) and fits.contains(k1, k2).all()
    o1, o2 = rng.integers(-(1 << 62), 1 << 62, size=(2, 20000))
    assert fits.contains(o1, o2).mean() < 0.002
    fits.delete(k1[:2500], k2[:2500])
    assert fits.contains(k1[2500:], k2[2500:]).all() and fits.contains(k1[:2500], k2[:2500]).mean() < 0.01
    assert not Cuckoo.sized(10).insert(k1, k2)


# substring dedup

def substrings_by_hand(ids, texts, window):
    order = [float("inf") if i is None else i for i in ids]
    words = [WORD.findall(t or "") for t in texts]
    least = {}
    for i, w in zip(order, words, strict=True):
        for p in range(len(w) - window + 1):
            key = tuple(w[p:p + window])
            least[key] = min(least.get(key, i), i)
    out = []
    for i, w in zip(order, words, strict=True):
        gone = set()
        for p in range(len(w) - window + 1):
            if least[tuple(w[p:p + window])] < i:
                gone.update(range(p, p + window))
        out.append((len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return out


@pytest.mark.parametrize("window,period", [(50, 31), (12, 7), (5, 1)])
def test_substring_dedup(spark, window, period):
    passage, long = prose(70, 500), prose(300, 501)
    texts = [prose(40 + 3 * i, i) for i in range(30)]
    texts += [f"{prose(i, 600 + i)} {passage} {prose(13, 700 + i)}" for i in range(40)]
    texts += [long, long, "copy " + long, long.replace("w1 ", "w2 "), "zu zu " * 200, "zu zu " * 180, passage, None, ""]
    texts += [" ".join(WORD.findall(passage)[k:k + 55]) for k in range(0, 16, 5)]
    ids = [(i * 37) % 211 for i in range(len(texts))]
    rows = {r.doc_id: (r.n_words, r.n_removed, r.kept_text) for r in remove_repeats(documents(spark, texts, ids).repartition(7), window, period).collect()}
    assert [rows[i] for i in ids] == substrings_by_hand(ids, texts, window)


def test_substring_odd_rows(spark, odd, nothing, clashing):
    rows = odd.where("doc_id is not null").collect()
    got = remove_repeats(clashing(odd)).where("doc_id is not null").collect()
    want = [(r.doc_id, *x) for r, x in zip(rows, substrings_by_hand([r.doc_id for r in rows], [r.text for r in rows], 50), strict=True)]
    assert sorted(str((r.doc_id, r.n_words, r.n_removed, r.kept_text)) for r in got) == sorted(map(str, want))
    assert remove_repeats(odd).count() == odd.count() and remove_repeats(nothing).count() == 0
    passage = prose(80, 9)  # without an id: after all others
    both = {r.doc_id: r.n_removed for r in remove_repeats(documents(spark, [passage, "x " + passage], [None, 5])).collect()}
    assert both == {None: 80, 5: 0}


@pytest.mark.parametrize("period", [1, 2, 7, 13, 31, 40])
def test_difference_cover(period):
    cover = difference_cover(period)
    assert {(a - b) % period for a in cover for b in cover} == set(range(period))
