"""The toxicity grammar word by word, its learned stems, and held-out accuracy."""

import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from foldwise.llm import toxicity as tx
from foldwise.llm.base import blocks, text_buffers
from llm_data import clashing, documents, nothing, odd  # noqa: F401

LABELS = "doc_id long, toxic int"
CLOSED = {w: s for words, s in reversed(tx.CLOSED) for w in words}


def features(texts, grammar):
    data, off = text_buffers(pa.array(texts, pa.string()))
    return np.concatenate([tx.features(tx.Tokens(data, off[a:b]), grammar) for a, b in [(lo, hi + 1) for lo, hi in blocks(off)]])


def by_hand(text, stems):
    """Features of one text: a plain walk over its words."""
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    sums, n = [0.0] * tx.KINDS, 0
    for clause in re.split(r"[.!?;\n]", text):
        words = re.findall(r"(?:[a-z0-9\x80-\U0010ffff]|(?<=[a-z0-9\x80-\U0010ffff])'(?=[a-z0-9\x80-\U0010ffff]))+", clause)
        n += len(words)
        negated = reported = aimed = threat = 0
        last = None
        for i, w in enumerate(words):
            weight = max([v for s, v in stems.items() if w.startswith(s)], default=0) or (tx.SEED_WEIGHT if w in tx.INSULTS else 0)
            symbol = tx.INSULT if weight else CLOSED.get(w)
            if symbol is None:
                continue
            if last is not None and i - last > tx.SPAN:
                negated = aimed = threat = 0
            last = i
            if symbol == tx.INSULT:
                sums[4 * negated + 2 * reported + aimed] += weight
                negated = 0
            elif symbol == tx.TARGET:
                if threat == 2:
                    sums[8 + 2 * negated + reported] += tx.THREAT_WEIGHT
                    threat = 0
                aimed = 1
            elif symbol == tx.NEGATION:
                negated = 1
            elif symbol == tx.REPORT:
                reported = 1
            elif symbol == tx.INTENT:
                threat = max(threat, 1)
            elif symbol == tx.HARM:
                threat = 2 if threat else 0
    return [math.log1p(s) for s in sums] + [math.log1p(n)]


STEMS = {"blarg": 2.5, "blargel": 4.0, "zün": 3.0}


def test_matches_as_a_plain_walk():
    rng = random.Random(1)
    vocabulary = [*tx.TARGETS, *tx.NEGATIONS, *tx.REPORTS, *tx.INTENTS, *tx.HARMS, *tx.INSULTS, "blarg", "Blargelo", "blar", "zünx", "zü", "'tis", "word", "éa", "x1"] + ["filler"] * 120
    texts = ["", " .. ", None] + [" ".join(rng.choice(vocabulary) + rng.choice(["", "", "", "", ",", ".", "!", "\n", ";"]) for _ in range(rng.randrange(1, 60))) for _ in range(300)]
    texts.append(" ".join(rng.choice(vocabulary) for _ in range(5000)))  # one clause over many lanes
    got = features(texts, tx.lexicon(STEMS))
    want = np.array([by_hand(t, STEMS) for t in texts])
    assert np.allclose(got, want, atol=1e-9), np.argwhere(~np.isclose(got, want, atol=1e-9))[:5]


def test_lanes_are_stitched():
    rng = np.random.default_rng(2)
    symbols = rng.integers(0, 7, 3000)
    clause = np.sort(rng.integers(0, 5, 3000))
    want = tx.match_kinds(symbols, clause, lane=5000)
    for lane in (1, 3, 64):
        assert (tx.match_kinds(symbols, clause, lane=lane) == want).all()


def test_context_moves_the_score():
    model = tx.Model(tx.lexicon({}), tx.prior(), -1.5)
    score = dict(zip(
        ("plain", "aimed", "negated", "reported", "harmless", "threat", "no threat", "denied threat"),
        model.score(features(["an idiot", "you are an idiot", "you are not an idiot", "he said you are an idiot", "the cat sat", "I will kill you", "the cat will kill a mouse", "I will not kill you"], model.grammar)), strict=True))
    assert score["aimed"] > score["plain"] > 0.5 > score["reported"] > score["negated"] > score["harmless"] - 0.2
    assert score["threat"] > 0.5 > score["denied threat"] and score["no threat"] < 0.5


def test_stems_take_the_best_of_each_chain():
    prefixes = ["zor", "zorg", "zorgu", "zorgun", "the", "qua", "quat"]
    toxic = np.array([52, 50, 50, 10, 90, 30, 30], dtype=float)
    clean = np.array([300, 1, 1, 0, 900, 0, 0], dtype=float)
    chosen = tx.choose_stems(prefixes, toxic, clean, 100, 1000, 1000)
    assert set(chosen) == {"zorgu", "quat"}
    assert chosen["zorgu"] == pytest.approx(math.log(50.5 / 101) - math.log(1.5 / 1001))
    assert tx.choose_stems([], np.zeros(0), np.zeros(0), 5, 5, 0) == {}


def labelled(spark, n, seed):
    """Documents of an invented language, whose insults have two stems; those and others are labelled."""
    rng = random.Random(seed)
    syllables = ["ka", "lo", "mi", "ne", "ru", "ta", "so", "vi"]
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randrange(2, 5)))
    texts, toxic = [], []
    for i in range(n):
        words = [word() for _ in range(rng.randrange(20, 90))]
        bad = i % 6 == 0
        for _ in range(rng.randrange(2, 6) if bad else 0):
            words.insert(rng.randrange(len(words)), rng.choice(["drux", "gorf"]) + word())
        texts.append(" ".join(words))
        toxic.append(int(bad))
    return documents(spark, texts), spark.createDataFrame(list(enumerate(toxic)), LABELS), toxic


def test_held_out_documents(spark):
    docs, labels, toxic = labelled(spark, 900, 7)
    model = tx.fit(docs, labels.where("doc_id % 5 <> 0"))
    assert {"drux", "gorf"} <= set(model.grammar.texts)
    scores = {r["doc_id"]: r["score"] for r in tx.score_toxicity(docs, model).collect()}
    wrong = [i for i in range(0, 900, 5) if (scores[i] >= 0.5) != bool(toxic[i])]
    assert len(wrong) <= 2 and all(0 <= s <= 1 for s in scores.values())
    again = tx.fit(docs.repartition(5), labels.where("doc_id % 5 <> 0").repartition(3))
    assert again.grammar.texts == model.grammar.texts and np.allclose(again.weights, model.weights)


def test_labels_with_nulls_repeats_and_conflicts(spark):
    docs, labels, _ = labelled(spark, 300, 8)
    more = [(3, 0)] * 500 + [(6, 0)] + [(None, 1), (7, None), (99_999, 1)]
    both = labels.unionByName(spark.createDataFrame(more, LABELS))
    copies = docs.unionByName(docs.where("doc_id = 3").limit(1).crossJoin(spark.range(200)).select(docs.columns))
    assert tx.fit(copies, both).grammar.texts == tx.fit(docs, labels).grammar.texts
    small = tx.fit(docs, labels, sample=20)  # at most 20 of each label
    assert np.isfinite(small.weights).all()


def test_odd_tables(spark, odd, clashing, nothing):
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 9)], LABELS)
    model = tx.fit(odd, labels)
    rows = tx.score_toxicity(odd, model).collect()
    assert len(rows) == odd.count() and all(0 <= r["score"] <= 1 for r in rows)
    blank = {round(r["score"], 9) for r in rows if r["doc_id"] in (1, 2, 3)}
    assert len(blank) == 1
    assert sorted(map(tuple, tx.score_toxicity(clashing(odd), tx.fit(clashing(odd), labels)).collect()), key=str) == sorted(map(tuple, rows), key=str)
    assert tx.score_toxicity(nothing, tx.fit(nothing, labels)).collect() == []
    none = tx.fit(odd, spark.createDataFrame([], LABELS))
    assert len(tx.score_toxicity(odd, none).collect()) == odd.count()
    one = tx.fit(odd, labels.where("toxic = 1"))
    assert np.isfinite(one.weights).all()
