import random
import re

import numpy as np
import pytest
from llm_data import clashing, documents, nothing, odd, prose  # noqa: F401

from foldwise.llm import jaccard_join
from foldwise.llm.decontaminate import drop_contaminated, find_contaminated, infix_distance
from foldwise.llm.graph import components
from foldwise.llm.jaccard_join import jaccard_components, keep_one_of_each

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def low(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def edit(text, n, seed):
    rng = random.Random(seed)
    words = text.split(" ")
    for _ in range(n):
        words[rng.randrange(len(words))] = f"e{rng.randrange(10**6)}"
    return " ".join(words)


def components_by_hand(ids, texts, size, num, den):
    sets = []
    for t in texts:
        w = WORD.findall(low(t))
        sets.append({tuple(w[i:i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set()))
    label = list(range(len(ids)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            k = len(a & sets[j])
            if k and den * k >= num * (len(a) + len(sets[j]) - k):
                label[root(i)] = root(j)
    least = {}
    for i, d in enumerate(ids):
        if d is not None:
            least[root(i)] = min(least.get(root(i), d), d)
    return [(d, len(s), least.get(root(i)) if s else d) for i, (d, s) in enumerate(zip(ids, sets, strict=True))]


def near_texts():
    texts = [prose(20 + 2 * i, i) for i in range(25)]
    base, chain = prose(120, 900), prose(150, 901)
    texts += [edit(base, k % 5, 1000 + k) for k in range(90)]  # a group beyond SMALL, linked in part
    for step in range(6):  # a chain: neighbours link, ends don't
        chain = edit(chain, 2, 2000 + step)
        texts.append(chain)
    boiler = prose(60, 902)
    texts += [f"{boiler} {prose(25, 3000 + i)}" for i in range(90)]  # share much, link with nothing
    texts += [base, base.upper(), base, "one two", "ONE two", "one", "", None, " \n", prose(2500, 7), edit(prose(2500, 7), 40, 1)]
    return texts


@pytest.mark.parametrize("size,num,block", [(4, 85, 4_000_000), (5, 80, 4_000_000), (4, 85, 3000)])
def test_components_against_all_pairs(spark, monkeypatch, size, num, block):
    monkeypatch.setattr(jaccard_join, "BLOCK_TOKENS", block)
    texts = near_texts()
    ids = [(i * 53) % 401 for i in range(len(texts))]
    rows = jaccard_components(documents(spark, texts, ids).repartition(5), size, num, 100).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in rows) == sorted(components_by_hand(ids, texts, size, num, 100))


def test_bitmap_classes_and_frequent_tokens(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "CHUNK_TOKENS", 2000)
    texts = [edit(prose(n, n, 10_000), k, n + k) for n in (990, 1010, 2050) for k in (0, 5, 20, 60, 200)]
    ids = list(range(len(texts)))
    rows = jaccard_components(documents(spark, texts, ids), 4, 85, 100).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in rows) == sorted(components_by_hand(ids, texts, 4, 85, 100))


def test_repeated_rows_have_one_set(spark, monkeypatch):
    made = []
    monkeypatch.setattr(jaccard_join, "cut", lambda df, cut=jaccard_join.cut: made.append(cut(df)) or made[-1])
    base = prose(60, 41, 10_000)
    texts = [base] * 2000 + [edit(base, 1, 9)] * 300 + [edit(prose(80, 42, 10_000), k // 2, k) for k in range(80)] * 2
    ids = [7] * 2000 + [None] * 300 + list(range(100, 180)) * 2
    rows = jaccard_components(documents(spark, texts, ids).repartition(6), 4, 80, 100).collect()
    assert sorted(map(str, {(r.doc_id, r.n_shingles, r.component_id) for r in rows})) == sorted(map(str, set(components_by_hand(ids[1999:2001] + ids[2300:2380], texts[1999:2001] + texts[2300:2380], 4, 80, 100))))
    assert len(rows) == len(texts)
    sets = next(df for df in made if df.columns == ["sid", "tokens"])
    assert sets.count() == sets.select("sid").distinct().count() > 2


def test_links_between_distant_bitmap_classes(spark):
    long = prose(4500, 61, 100_000).split(" ")
    texts = [" ".join(long[:n]) for n in (900, 2100, 4500)]
    rows = jaccard_components(documents(spark, texts), 4, 15, 100).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in rows) == sorted(components_by_hand([0, 1, 2], texts, 4, 15, 100))
    rows = jaccard_components(documents(spark, [texts[0], texts[2]]), 4, 15, 100).collect()
    assert {r.component_id for r in rows} == {0}


def test_large_groups_use_the_further_orders_before_counting(monkeypatch):
    rng = np.random.default_rng(6)
    sets = [np.unique(np.concatenate([np.arange(1, 3), rng.integers(9, 1 << 40, size=98)])).astype(np.uint64) for _ in range(100)]
    sets[40] = sets[30].copy()
    sets[40][-3:] += np.uint64(1)
    n = np.array([len(x) for x in sets])
    looked = []
    monkeypatch.setattr(jaccard_join, "_marked", lambda mark, code, first, rest, f=jaccard_join._marked: looked.append((len(code), len(rest))) or f(mark, code, first, rest))
    links = jaccard_join._forest(np.arange(100), n, np.arange(100), np.ones(100, bool), None, sets, 80, 100)
    assert links == [(30, 40)]
    assert sum(k for size, k in looked if size == n.sum()) < 4950 // 2


def test_near_odd_rows(spark, odd, nothing, clashing):
    rows = odd.collect()
    got = jaccard_components(clashing(odd), 5, 80, 100).collect()
    want = components_by_hand([r.doc_id for r in rows], [r.text for r in rows], 5, 80, 100)
    assert sorted(str((r.doc_id, r.n_shingles, r.component_id)) for r in got) == sorted(map(str, want))
    assert jaccard_components(nothing).count() == 0
    kept = keep_one_of_each(odd).collect()
    # "Ein Wort" (4), its copies 5 and null go to 4; of the two rows 20 one stays; rows without words stay
    assert sorted(str(r.doc_id) for r in kept) == sorted(["1", "2", "3", "4", "5", "6", "7", "8", "20", "None"])
    assert keep_one_of_each(clashing(odd)).columns == clashing(odd).columns and keep_one_of_each(nothing).count() == 0


def test_graph_components(spark):
    rng = random.Random(5)
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, rng.randrange(8, 60)) for _ in range(40)] + [(-5, -5), (3, 2), (2, 3)]
    label = {}
    for a, b in edges:
        label.setdefault(a, a)
        label.setdefault(b, b)
    for _ in range(200):
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {k: v for k, v in label.items() if k != -5}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# decontamination

def infix_by_hand(item, text):
    row = [0] * (len(text) + 1)
    for i, w in enumerate(item, 1):
        new = [i]
        for j, x in enumerate(text, 1):
            new.append(min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (w != x)))
        row = new
    return min(row)


def test_infix_distance():
    rng = np.random.default_rng(2)
    for _ in range(300):
        item = rng.integers(0, 4, size=rng.integers(1, 80)).astype(np.uint64)
        text = rng.integers(0, 4, size=rng.integers(0, 120)).astype(np.uint64)
        assert infix_distance(item, text) == infix_by_hand(item.tolist(), text.tolist())


def test_contaminated_documents(spark):
    items = [prose(n, 5000 + n, 3000) for n in (1, 3, 4, 5, 6, 9, 15, 22, 30, 38, 45, 59, 80)] + ["", None, " \t"]
    rng = random.Random(8)
    texts = []
    for k in range(240):
        item = items[k % 13]
        n = len(item.split())
        part = edit(item, rng.randrange(int(0.25 * n) + 1), k) if k % 3 else item
        if k % 7 == 0:
            words = part.split(" ")
            words.insert(rng.randrange(len(words)), "added")
            part = " ".join(words)
        texts.append(f"{prose(rng.randrange(90), 6000 + k, 3000)} {part.upper() if k % 5 == 0 else part}\n{prose(rng.randrange(90), 7000 + k, 3000)}")
    texts += [prose(300, 8000 + i, 3000) for i in range(40)] + [None, "", items[9], items[9]]
    docs = documents(spark, texts)
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    found = {(r.doc_id, r.item_id): r.distance for r in find_contaminated(docs, bench).collect()}
    want = {}
    for i, t in enumerate(texts):
        words = WORD.findall(low(t))
        for k, item in enumerate(items):
            target = WORD.findall(low(item))
            if target and words:
                d = infix_by_hand(target, words)
                if d <= int(0.2 * len(target)):
                    want[i, k] = d
    assert set(found) <= set(want) and all(found[p] >= want[p] for p in found)
    exact = {p for p, d in want.items() if d == 0}
    assert exact <= set(found)
    assert len(found) >= 0.95 * len(want)
    clean = {r.doc_id for r in drop_contaminated(docs, bench).collect()}
    assert clean == set(range(len(texts))) - {d for d, _ in found}
    blocks = {(r.doc_id, r.item_id): r.distance for r in find_contaminated(docs, bench, max_table_bytes=100_000).collect()}
    assert set(blocks) <= set(want) and len(blocks) >= 0.95 * len(want)


def test_decontaminate_odd_rows(spark, odd, nothing, clashing):
    bench = spark.createDataFrame([(None, "ein wort"), (2, None), (3, ""), (3, prose(90, 2))], "item_id long, text string")
    rows = find_contaminated(clashing(odd), clashing(bench)).collect()
    assert sorted(str((r.doc_id, r.item_id)) for r in rows) == sorted(["(4, None)", "(5, None)", "(None, None)", "(20, 3)", "(20, 3)"])
    none = spark.createDataFrame([], "item_id long, text string")
    assert find_contaminated(odd, none).count() == 0 and find_contaminated(nothing, bench).count() == 0
    assert drop_contaminated(odd, none).count() == odd.count()
    assert drop_contaminated(clashing(odd), bench).columns == clashing(odd).columns


def test_short_items_behind_long_ones_reach_the_recall(spark):
    rng = random.Random(4)
    items = [prose(40, 100 + i, 10**6) for i in range(160)] + [prose(5 + i % 2, 500 + i, 10**6) for i in range(240)]
    texts = []
    for i, item in enumerate(items):
        words = item.split(" ")
        at, kind = rng.randrange(len(words)), i % 3
        words[at:at + (kind != 1)] = [] if kind == 0 else ["edited"]
        texts.append(f"{prose(rng.randrange(9), 900 + i, 10**6)} {' '.join(words)} {prose(30, 1500 + i, 10**6)}")
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    found = {(r.doc_id, r.item_id) for r in find_contaminated(documents(spark, texts), bench).collect()}
    assert all((i, i) in found for i in range(160, 400, 2))  # five words: by pieces, exactly
    assert sum((i, i) in found for i in range(161, 400, 2)) >= 0.93 * 120 and len(found) <= 400


@pytest.mark.parametrize("rate", [0.2, 0.5])
def test_lengths_without_enough_walks_are_found_whole(spark, rate):
    items = [prose(n, n, 30) for n in (4, 5, 6, 7, 12)]
    texts = [prose(40, i, 30) for i in range(60)] + [edit(x, 1, i) for i, x in enumerate(items)]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    found = {(r.doc_id, r.item_id): r.distance for r in find_contaminated(documents(spark, texts), bench, rate=rate, recall=1.1).collect()}
    want = {(d, i): infix_by_hand(x.split(), t.split()) for d, t in enumerate(texts) for i, x in enumerate(items)}
    assert found == {p: n for p, n in want.items() if n <= int(rate * len(items[p[1]].split()))}


def test_of_equal_rows_the_same_one_stays(spark):
    from pyspark.sql import functions as F
    rows = documents(spark, [prose(40, 1)] * 60, ids=[5] * 60, sources=[f"s{i}" for i in range(60)]).withColumn("a b", F.col("source"))
    kept = [keep_one_of_each(rows.repartition(n)).collect() for n in (1, 3, 7)]
    assert all(len(k) == 1 for k in kept) and len({str(k) for k in kept}) == 1


def test_walks_are_planned_in_classes():
    from foldwise.llm import decontaminate as dc
    assert dc.plan_walks(79, 0.2, 0.95) == dc._plan_walks(64, 0.2, 0.95)
    assert dc.plan_walks(50_000, 0.2, 0.95) == dc._plan_walks(400, 0.2, 0.95) == 1
