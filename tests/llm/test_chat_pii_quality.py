import hashlib
import random
import re

import numpy as np
import pytest
from llm_data import clashing, documents, nothing, odd, prose  # noqa: F401

from foldwise.llm.chat_format import CONTROL, conversation_digests, format_conversations, read_back, unescape
from foldwise.llm.pii import BASE, find_pii
from foldwise.llm.quality import fit, keep_quality, score_documents

TURNS = "conv_id long, turn long, role string, text string"


def digests_by_hand(rows):
    out = {}
    for conv, _, role, text in sorted(rows, key=lambda r: (str(r[0]), -1 if r[1] is None else r[1], r[2] is not None, r[2] or "", r[3] is not None, r[3] or "")):
        got = out.setdefault(conv, [0, hashlib.sha256(), 0, hashlib.sha256()])
        got[0] += 1
        got[1].update(f"{role or ''}\n{text or ''}\n".encode())
        if role == "assistant":
            got[2] += len(text or "")
            got[3].update((text or "").encode())
    return {c: (n, h.hexdigest(), k, g.hexdigest()) for c, (n, h, k, g) in out.items()}


def test_conversations_round_trip(spark):
    rng = random.Random(3)
    parts = ["</s>", "<s>", "[INST]", " [/INST]", "[ANS] ", "\\", "\\\\", "[ROLE x] ", "]", " ", "\n", "é😀", "text", "<s>[SYS] ", "[/ROLE]", ""]
    roles = ["user", "assistant", "system", "tool", None, "a]b\\", "[/ROLE] x"]
    rows = [(c, t, rng.choice(roles), rng.choice([None, "", "".join(rng.choices(parts, k=rng.randrange(12)))])) for c in range(60) for t in range(rng.randrange(1, 8))]
    rows += [(999, t, "assistant" if t % 2 else "user", f"turn {t}") for t in range(5000)]  # most of the rows
    rows += [(None, None, None, None), (None, 1, "user", "x"), (5, 1, "user", "tie"), (5, 1, "user", "tie"), (-7, 0, "user", "</s>[INST] ok [/INST]"), (7, 0, "assistant", "x" * 200_000)]
    turns = spark.createDataFrame(rows, TURNS).repartition(7)
    pieces = format_conversations(turns)
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in conversation_digests(pieces).collect()}
    assert got == digests_by_hand(rows)
    for hold in (4 << 20, 100):  # in their ranges, where neighbours share conversations and long ones pass on
        ranged = conversation_digests(format_conversations(turns), ranged=True, hold_chars=hold).collect()
        assert {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in ranged} == got and len(ranged) == len(got)
    chars = {r.conv_id: r.formatted_chars for r in conversation_digests(pieces).collect()}
    held = pieces.collect()
    assert sum(len(r.text) for r in held) == sum(chars.values())
    assert len({r.piece for r in held if r.conv_id == 999}) > 1  # a long conversation is several pieces
    for r in held:
        spans = [(s.start, s.end) for s in r.loss]
        assert spans == [(a, b) for role, _, a, b in read_back(r.text) if role == "assistant"]


def test_escapes_leave_no_control_string():
    for text in ("\\", "</s>", "\\</s>", "\\\\[INST]", "a\\nb", "[/ROLE"):
        escaped = re.sub(f"({CONTROL})", r"\\\1", text)
        assert unescape(escaped) == text
        assert not re.search(CONTROL, re.sub(r"\\.", "", escaped))


def test_chat_empty_and_clashing(spark):
    for ranged in (False, True):
        assert conversation_digests(format_conversations(spark.createDataFrame([], TURNS)), ranged).count() == 0
    rows = spark.createDataFrame([(1, 0, "user", "a", 5, "z")], TURNS + ", piece long, loss string")
    assert conversation_digests(format_conversations(rows)).first().n_turns == 1


# personal data

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def valid(kind, value):
    digits = re.sub("[^0-9]", "", value)
    return {"email": True, "ip": all(int(p) <= 255 for p in value.split(".")) if kind == "ip" else True,
            "card": 13 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]


def base_by_hand(text):
    return [(k, m.start(), m.end()) for k, p in PLAIN.items() for m in re.finditer(p, text or "") if valid(k, m[0])]


def spans(df):
    return {r.doc_id: [(s.kind, s.start, s.end) for s in r.spans] for r in df.collect()}


def test_base_spans_against_plain_patterns(spark):
    rng = random.Random(3)
    texts = ["".join(rng.choices("aA1.9@+-_% ()0é😀\nZ2", k=rng.choice([5, 30, 200]))) for _ in range(400)]
    texts += ["a@b.com_x@y.zz", "1.2.3.4.5.6.7.8 256.1.1.1 0001.2.3.4", "+1 (208) 555-1177 4284896609045836 4111-1111 1111 1111", None, ""]
    got = spans(find_pii(documents(spark, texts)))
    for i, t in enumerate(texts):
        assert [s for s in got[i] if s[0] in BASE] == base_by_hand(t), t


def test_long_runs_stay_linear(spark):
    texts = ["x" * 200_000, "1" * 200_000, "a@" * 50_000 + "b.c", "1 " * 50_000, "1." * 50_000, "+1" * 50_000]
    got = spans(find_pii(documents(spark, texts)))
    assert got[2] == [("email", 99_998, 100_003)] and got[0] == got[1] == got[3] == []


def test_validated_kinds_and_context(spark):
    texts = ["DE89 3704 0044 0532 0130 00", "DE88 3704 0044 0532 0130 00", "GB82WEST12345698765432", "ssn 123-45-6789", "nr 123-45-6789", "ssn 666-45-6789 ssn 123-45-67890"]
    got = spans(find_pii(documents(spark, texts)))
    assert [[k for k, _, _ in got[i] if k not in BASE] for i in range(6)] == [["iban"], [], ["iban"], ["ssn"], [], []]
    scores = {r.doc_id: r.spans[0].score for r in find_pii(documents(spark, ["my ip is 1.2.3.4", "it 1.2.3.4 was"])).collect()}
    assert scores[0] > scores[1]


def test_pii_odd_rows(spark, odd, nothing, clashing):
    rows = find_pii(clashing(odd)).collect()
    assert len(rows) == odd.count() and find_pii(nothing).count() == 0


# quality

@pytest.fixture(scope="module")
def labelled(spark):
    texts, labels = [], []
    for i in range(160):
        if i % 4:
            texts.append(prose(60, i).capitalize() + ".")
        else:
            texts.append([("W%d " % i) * 60, " ".join(w.upper() + "!!" for w in prose(60, i).split()), " | ".join(prose(60, i).split())][i // 4 % 3])
        labels.append((i, 1 if i % 4 else 0, None))
    return documents(spark, texts), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_votes_separate_the_classes(spark, labelled):
    docs, labels = labelled
    model = fit(docs, labels.where("doc_id % 5 <> 0"))
    rows = {r.doc_id: r.score for r in score_documents(docs, model).collect()}
    wrong = [i for i in range(160) if (rows[i] >= 0.3) != bool(i % 4)]
    assert not [i for i in wrong if i % 5 == 0] and len(wrong) <= 2
    again = {r.doc_id: r.score for r in score_documents(docs.repartition(9), fit(docs.repartition(3), labels.where("doc_id % 5 <> 0"))).collect()}
    assert all(abs(again[i] - rows[i]) < 1e-4 for i in rows)
    assert {r.doc_id for r in keep_quality(docs, model).collect()} == {i for i in rows if rows[i] >= 0.3}


def test_quality_odd_rows(spark, labelled, odd, nothing, clashing):
    docs, labels = labelled
    more = labels.union(spark.createDataFrame([(None, 1, 0), (3, None, 0), (10**9, 0, 0), (4, 0, 0)], labels.schema))
    model = fit(clashing(docs), more)
    rows = score_documents(clashing(odd), model).collect()
    assert len(rows) == odd.count() and all(0 <= r.score <= 1 for r in rows)
    assert {r.score for r in rows if r.doc_id in (1, 2, 3)} == {float(model.labels.mean())}
    assert keep_quality(clashing(odd), model).columns == clashing(odd).columns
    assert score_documents(nothing, model).count() == 0
    blank = fit(docs, labels.where("false"))
    assert {r.score for r in score_documents(odd, blank).collect()} == {0.5}


def test_very_long_labelled_document(spark, labelled):
    docs, labels = labelled
    long = documents(spark, ["word " * 100_000, " ".join(prose(50_000, 77).split() * 2)], [900, 901])
    model = fit(docs.union(long), labels.union(spark.createDataFrame([(900, 0, None), (901, 1, None)], labels.schema)))
    assert len(model.labels) == 162 and np.isfinite(model.vectors).all() and np.isfinite(model.axes).all()
    assert all(0 <= r.score <= 1 for r in score_documents(docs.union(long), model).collect())


def test_repeated_rows_of_a_labelled_document(spark, labelled):
    docs, labels = labelled
    again = documents(spark, ["Another text. " + prose(40, 5)] + ["W8 " * 60] * 500, [8] * 501)
    once, often = fit(docs, labels), fit(docs.union(again).repartition(7), labels)
    assert len(once.labels) == len(often.labels) == 160
    rows = [{r.doc_id: r.score for r in score_documents(docs, m).collect()} for m in (once, fit(docs.union(docs.where("doc_id = 8")), labels))]
    assert all(abs(rows[0][i] - rows[1][i]) < 1e-4 for i in rows[0])


@pytest.mark.parametrize("good,bad", [("river stone winter garden letter window", "casino bonus cheap pills click winner"), ("река камень зима сад письмо окно", "казино бонус дёшево таблетки жми выигрыш"), ("河石冬园信窗山水", "赌奖药买赢钱点击")])
def test_words_of_one_shape_are_told_apart(spark, good, bad):
    rng, texts = random.Random(3), []
    for i in range(120):
        words = (good if i % 2 else bad).split()
        texts.append("".join(rng.choices(words[0], k=50)) if len(words) == 1 else " ".join(rng.choices(words, k=40)))
    docs = documents(spark, texts)
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(80)], "doc_id long, quality int, toxic int")
    rows = {r.doc_id: r.score for r in score_documents(docs, fit(docs, labels)).collect()}
    assert all((rows[i] >= 0.5) == bool(i % 2) for i in range(80, 120))


def test_very_many_matches_in_one_text(spark):
    """Positions stay exact over blocks of matches, and the work stays in proportion."""
    import time

    from foldwise.llm.pii import find_pii
    n = 40_000
    text = "".join(f"é{i % 7}@a.bc ," + " " * (i % 3) for i in range(n))
    began = time.time()
    spans = find_pii(documents(spark, [text, "x@y.zz", ""])).collect()[0].spans
    assert time.time() - began < 60
    want = [(m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", text)]
    assert [(s.start, s.end) for s in spans if s.kind == "email"] == want and len(want) == n


def test_votes_as_by_dense_matrices(spark):
    """Scores against dense weights, all cosines and a full sort; axes against the singular vectors of the dense matrix."""
    import numpy as np

    from foldwise.llm import quality as ql
    texts = [prose(20 + i % 40, i) + (" !!" if i % 4 == 0 else ".") for i in range(200)]
    docs = documents(spark, texts)
    labels = spark.createDataFrame([(i, int(i % 4 != 0)) for i in range(160)], "doc_id long, quality int")
    model = ql.fit(docs, labels, neighbours=7, dimensions=16)
    assert len(model.labels) == 160

    def dense(some):
        import pyarrow as pa
        terms = ql.count_terms(ql.Words(*ql.text_buffers(pa.array(some))))
        out = np.zeros((len(some), ql.TERMS))
        for i in range(len(some)):
            at = slice(terms.first[i], terms.first[i + 1])
            out[i, terms.term[at]] = terms.log[at] * model.idf[terms.term[at]]
        for view in (slice(0, ql.SHAPES), slice(ql.SHAPES, ql.TERMS)):
            out[:, view] /= np.maximum(np.linalg.norm(out[:, view], axis=1, keepdims=True), 1e-9)
        return out

    order = {r.doc_id: r.turn for r in labels.selectExpr("doc_id", "xxhash64(doc_id, 17) AS turn").collect()}
    learned = sorted(order, key=lambda i: order[i])
    train = dense([texts[i] for i in learned])
    singular = np.linalg.svd(train, compute_uv=False)[:16]
    caught = np.linalg.norm(train @ model.axes, axis=0)
    caught = np.sort(caught)[::-1]
    # the axes that stand out are found; of nearly equal ones any mixture does
    assert np.allclose(caught[:3], singular[:3], rtol=1e-3) and (caught ** 2).sum() > 0.95 * (singular ** 2).sum()
    unit = lambda m: m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-9)
    near = unit(dense(texts) @ model.axes) @ unit(train @ model.axes).T
    y = np.array([int(i % 4 != 0) for i in learned])
    want = []
    for row in near:
        top = np.argsort(-row, kind="stable")[:7]
        weight = np.clip(row[top], 1e-6, 1) ** model.power
        want.append((weight * y[top]).sum() / weight.sum())
    got = {r.doc_id: r.score for r in ql.score_documents(docs, model).collect()}
    assert np.allclose([got[i] for i in range(200)], want, atol=2e-3)


def test_repeated_labels_take_one_place_each(spark):
    from foldwise.llm import quality as ql
    docs = documents(spark, [prose(30, i) for i in range(400)])
    rows = [(i, i % 2) for i in range(400)] + [(5, 1)] * 3000 + [(6, 0), (6, 1)] * 20
    model = ql.fit(docs, spark.createDataFrame(rows, "doc_id long, quality int"), sample=300)
    assert len(model.labels) == 300 and len(np.unique(model.vectors, axis=0)) == 300 and 0.3 < model.labels.mean() < 0.7
