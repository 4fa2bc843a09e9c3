"""run() of the pipeline, stage by stage, against brute force on a small corpus."""

import random
import re

import pytest
from llm_data import documents, prose
from test_dedup import lines_by_hand
from test_mixing_urls import targets_by_hand
from test_near import components_by_hand, edit, infix_by_hand, low

import corpus_pipeline

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rng = random.Random(2)
    good = [prose(40 + i % 30, 100 + i, 2000).capitalize() + "." for i in range(150)]
    common = "Terms of use apply here"
    good[:25] = [f"{common}\n{g}\n  terms OF use apply here " for g in good[:25]]
    base = prose(160, 900, 2000)
    good += [base, edit(base, 2, 1), edit(base, 3, 2), base, "", "short one"]
    items = [prose(n, 5000 + n, 2000) for n in (15, 24, 40)]
    good += [f"{prose(30, 700 + i, 2000)} {edit(items[i % 3], i % 2 * 2, i)} {prose(20, 800 + i, 2000)}" for i in range(9)]
    junk = [" ".join(w.upper() + "!!" for w in prose(50, i).split()) for i in range(30)] + [" | ".join(prose(50, i).split()) for i in range(30)]
    texts = good + junk
    order = list(range(len(texts)))
    rng.shuffle(order)
    sources = [None if i % 11 == 0 else f"src{i % 4}" for i in range(len(texts))]
    docs = documents(spark, texts, ids=[3 * i + 1 for i in order], sources=sources)
    folder = str(tmp_path_factory.mktemp("corpus"))
    docs.repartition(4).write.parquet(f"{folder}/documents.parquet")
    labels = [(3 * i + 1, int(k < len(good)), 0) for k, i in enumerate(order) if k % 3 or k >= len(good)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, {3 * i + 1 for k, i in enumerate(order) if k >= len(good)}, items


def test_stages_against_brute_force(spark, corpus, tmp_path):
    folder, junk, items = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs.collect()
        stage(spark, docs, folder).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        after = docs.collect()
        ids = sorted(r.doc_id for r in after)
        texts = {r.doc_id: r.text for r in before}
        if k < 4:
            assert docs.columns == columns, name
        if k == 0:
            # texts without words score the labels' mean, all others are told apart
            assert set(ids) == set(texts) - junk
        elif k == 1:
            want = lines_by_hand(list(texts.values()), list(texts.values()), 10)
            assert {r.doc_id: (r.text, r.n_chars) for r in after} == {i: (t, len(t)) for i, (_, _, t) in zip(texts, want, strict=True)}
            assert sum(d for _, d, _ in want) == 50
        elif k == 2:
            found = components_by_hand(list(texts), list(texts.values()), 5, 80, 100)
            assert ids == sorted(i for i, n, least in found if not n or least == i) and len(ids) < len(texts)
        elif k == 3:
            targets = [WORD.findall(low(i)) for i in items]
            dirty = {i for i, t in texts.items() if any(infix_by_hand(w, WORD.findall(low(t))) <= int(0.2 * len(w)) for w in targets)}
            assert set(ids) == set(texts) - dirty and len(dirty) == 9
        else:
            sizes = {}
            for r in before:
                sizes[r.source] = sizes.get(r.source, 0) + len(WORD.findall(r.text))
            want = targets_by_hand(sizes, (1, 2, 3))
            for source, target in want.items():
                assert sum(r.taken for r in after if r.source == source) == int(target + 0.5)
            assert all(0 < r.taken <= 3 * r.size and r.text == texts[r.doc_id] for r in after)
    got = sorted(map(str, corpus_pipeline.run(spark, folder).collect()))
    assert got == sorted(map(str, after))


def test_empty_corpus(spark, corpus, tmp_path):
    folder, _, _ = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder)
        assert docs.count() == 0


def test_odd_rows_and_clashing_columns_through_every_stage(spark, corpus):
    """Nulls in every column, empty and very long texts, repeated rows, and extra columns named like the operators' own."""
    from pyspark.sql import functions as F
    folder, _, _ = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet").where("doc_id < 200")
    odd = documents(spark, [None, "", " \n ", "x" * 100_000, prose(20_000, 7), "same same", "same same", None], ids=[2001, 2002, 2003, 2004, 2005, 2006, 2006, None], sources=[None, "src1", None, "src2", "src3", "src1", "src1", None])
    names = ["n_lines", "n_dropped", "kept_text", "_row", "_id", "a b", "score", "_first", "taken"]
    rows = docs.unionByName(odd).select("*", *[F.lit("clash").alias(n) for n in names])
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = rows.columns
        rows = stage(spark, rows, folder)
        assert rows.columns == before or k == 4, name
        rows = spark.createDataFrame(rows.collect(), rows.schema)
    assert rows.count() and all(r.taken > 0 for r in rows.collect())
