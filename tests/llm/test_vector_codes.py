"""Vector codes against plain loops, codebooks and odd vectors included."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from foldwise.llm import vector_codes as vc

VECTORS = "vec_id long, embedding array<float>, label int"


def by_hand(rows, parts=4, entries=256, rounds=4, scale=1024):
    """({vec_id: (code, error, label_error)}, codebooks) by all differences."""
    kept = [(i, [max(-vc.LIMIT, min(vc.LIMIT, math.floor(scale * float(np.float32(x))))) for x in v], label) for i, v, label in rows if v and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    if not kept:
        return {}, None
    d = len(kept[0][1])
    kept = [r for r in kept if len(r[1]) == d]
    size = -(-d // parts)
    cut = lambda v, p: (v + [0] * (parts * size - d))[p * size:(p + 1) * size]
    books = [[cut(v, p) for _, v, _ in kept[:entries]] for p in range(parts)]

    def near(v, book):
        return min((sum((a - b) ** 2 for a, b in zip(v, e, strict=True)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            groups = {}
            for _, v, _ in kept:
                groups.setdefault(near(cut(v, p), books[p])[1], []).append(cut(v, p))
            books[p] = [[sum(c) // len(c) for c in zip(*groups[k], strict=True)] if k in groups else e for k, e in enumerate(books[p])]
    found = [(i, label, [near(cut(v, p), books[p]) for p in range(parts)]) for i, v, label in kept]
    sums = {}
    for _, label, f in found:
        sums[label] = sums.get(label, 0) + sum(e for e, _ in f)
    return sorted(((-1 if i is None else i), "".join(f"{k:02x}" for _, k in f), sum(e for e, _ in f), sums[label]) for i, label, f in found), books


def compare(spark, rows, **options):
    coded, books = vc.encode_vectors(spark.createDataFrame(rows, VECTORS), **options)
    got = sorted((-1 if r["vec_id"] is None else r["vec_id"], r["code"], r["error"], r["label_error"]) for r in coded.collect())
    want, by_loops = by_hand(rows, **{k: v for k, v in options.items()})
    assert got == want
    assert books.entries.tolist() == by_loops


def test_as_by_hand(spark):
    rng = random.Random(1)
    rows = [(i, [rng.gauss(0, 0.2) for _ in range(12)], rng.choice([None, 0, 1, 2])) for i in rng.sample(range(5000), 700)]
    compare(spark, rows, entries=20)


def test_odd_vectors(spark):
    rng = random.Random(2)
    rows = [(i, [rng.choice([-0.5, 0.25, 0.0]) for _ in range(6)], 1) for i in range(40)]  # ties, and six doesn't divide by four
    rows += [(100, None, 1), (101, [], 1), (102, [1.0, None, 0.0, 0.0, 0.0, 0.0], 1), (103, [float("nan")] + [0.0] * 5, 1), (104, [float("inf")] + [0.0] * 5, 1), (105, [1.0, 2.0], 1)]
    rows += [(None, [0.5] * 6, None), (3, [0.5] * 6, 2), (3, [0.5] * 6, 2), (7, [3e38] + [0.0] * 5, 1), (8, [-3e38] * 6, 1)]
    compare(spark, rows, entries=16, rounds=3)
    compare(spark, rows)  # fewer vectors than entries


def test_a_third_of_the_rows_equal(spark):
    rng = random.Random(3)
    rows = [(i, [rng.gauss(0, 0.2) for _ in range(8)], i % 3) for i in range(400)] + [(1000 + i, [0.1] * 8, 5) for i in range(200)]
    compare(spark, rows, entries=32)


def test_nothing_kept_and_clashing_names(spark):
    for rows in ([], [(1, None, 1)]):
        coded, books = vc.encode_vectors(spark.createDataFrame(rows, VECTORS))
        assert coded.collect() == [] and books is None
        assert coded.columns == ["vec_id", "code", "error", "label", "label_error"]
    df = spark.createDataFrame([(i, [i / 10] * 4, i % 2) for i in range(30)], VECTORS)
    plain, _ = vc.encode_vectors(df, entries=8)
    clash, _ = vc.encode_vectors(df.select("*", *[F.lit("clash").alias(n) for n in ("id", "ints", "code", "error", "label_error", "_salt", "_name")]), entries=8)
    assert sorted(plain.collect()) == sorted(clash.collect())


def test_blocks_keep_whole_integers():
    rng = np.random.default_rng(4)
    ints = rng.integers(-vc.LIMIT, vc.LIMIT, (300, 8))
    books = rng.integers(-vc.LIMIT, vc.LIMIT, (2, 5, 4))
    import pyarrow as pa
    batch = vc.encode(pa.array(range(300)), pa.array([1] * 300), ints.astype(np.int32))
    (_, block), = vc._read(batch)
    for p in range(2):
        want = ((ints[:, None, 4 * p:4 * p + 4] - books[p][None]) ** 2).sum(axis=2)
        assert (block.part_distances(books[p], 4 * p) == want).all()


def test_entries_need_two_digits(spark):
    with pytest.raises(ValueError, match="256"):
        vc.encode_vectors(spark.createDataFrame([], VECTORS), entries=257)
