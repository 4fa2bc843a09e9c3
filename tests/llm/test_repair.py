"""Conversation repair against a plain search over whole audit strings."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from foldwise.llm import conversation_repair as cr

TURNS = "conv_id long, turn long, role string, text string"
BLANK = " \t\n\x0b\x0c\r"
COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
STEP = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}


def best_edits(rows):
    """(cost, audit, lines) of the cheapest edits of (role, text, must go, truncated) rows; all choices, ties by the audit."""
    def insert(state, found):
        wanted = "a" if state == "u" else "u"
        cost, audit, lines = found[wanted]
        return cost + 2, "I" + audit, (("user:" if wanted == "u" else "assistant:"), *lines)

    def with_inserts(found):
        for _ in range(3):
            found = {q: min([found[q]] + ([insert(q, found)] if found["a" if q == "u" else "u"] else []), default=None) if found[q] else insert(q, found) if found["a" if q == "u" else "u"] else None for q in found}
        return found

    found = with_inserts({"": (0, "", ()), "s": None, "u": None, "a": (0, "", ())})
    for role, text, gone, cut_off in reversed(rows):
        now = {}
        for q in found:
            options = [(found[q][0] + 3, "D" + found[q][1], found[q][2])]
            if not gone:
                to = STEP.get((q, role[:1]))
                if to:
                    options.append((found[to][0] + cut_off, "K" + found[to][1], (f"{role}:{text}", *found[to][2])))
                for name in ("user", "assistant"):
                    to = STEP.get((q, name[0]))
                    if to:
                        options.append((found[to][0] + 2 + cut_off, "R" + found[to][1], (f"{name}:{text}", *found[to][2])))
            now[q] = min(options)
        found = with_inserts(now)
    return found[""]


def by_hand(turns, damaged=True):
    """{conv_id: row} of the contract."""
    out = {}
    for conv in {t[0] for t in turns}:
        rows = []
        for c, turn, role, text in turns:
            if c != conv:
                continue
            role, text = " " if role is None else role, " " if text is None else text
            kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if turn is None else turn}".encode()) % 20 if damaged else 9
            if kind == 4:
                role = "user"
            text = "" if kind == 1 else text.translate(str.maketrans("", "", ".!?")) if kind == 2 else text
            rows += [(turn is not None, turn or 0, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
        rows.sort()
        seen, marked, counts = set(), [], {"blank": 0, "duplicate": 0, "truncated": 0}
        for _, _, role, text in rows:
            blank, again = not text.strip(BLANK), (role, text) in seen
            seen.add((role, text))
            cut_off = int(not blank and text.rstrip(BLANK)[-1] not in ".!?")
            fault = "blank" if blank else "duplicate" if again else "truncated" if cut_off else None
            if fault:
                counts[fault] += 1
            marked.append((role, text, blank or again, cut_off))
        numbers = [r[1] for r in rows if r[0]]
        cost, audit, lines = best_edits(marked)
        out[conv] = {"gaps": max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0, **counts,
                     "illegal": sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:])),
                     "cost": cost, "audit": audit, "repaired_sha256": hashlib.sha256("\n".join(lines).encode()).hexdigest()}
    return out


def repaired(turns_df, damaged=True):
    pieces = cr.repair_conversations(cr.damage(turns_df), copies="copies") if damaged else cr.repair_conversations(turns_df)
    rows = cr.repair_digests(pieces, ordered=True).collect()
    assert len(rows) == len({r["conv_id"] for r in rows})
    return {r["conv_id"]: {c: r[c] for c in COLUMNS[1:]} for r in rows}


def test_lanes_of_any_length_find_the_same_edits():
    rng = random.Random(3)
    convs = [[rng.choice([0, 1, 2, 3, 2, 4, 5, 4, 6, 7, 8]) for _ in range(rng.randrange(16))] for _ in range(800)]
    convs += [[2, 4] * 40 + [2], [0] * 60, [8] * 50, [6] * 39, []]  # the last ones converge late or never
    flat, first = np.array([s for c in convs for s in c]), np.concatenate([[0], np.cumsum([len(c) for c in convs])])
    roles = ["system", "user", "assistant", "tool"]
    expected = [best_edits([("" if s == 8 else roles[s >> 1], "", s == 8, s & 1) for s in c])[:2] for c in convs]
    for lane in (1, 2, 5, 128):
        letters, turns, begin = cr.solve(flat, first, lane)
        for k, want in enumerate(expected):
            mine = slice(begin[k], begin[k + 1])
            assert (cr._cost(letters[mine], turns[mine], flat), cr.LETTERS[letters[mine]].tobytes().decode()) == want


def make_turns(seed, convs=60):
    rng = random.Random(seed)
    turns = []
    for c in range(convs):
        for t in sorted(rng.sample(range(14), rng.randrange(1, 11))):
            text = rng.choice(["", " \t", None, "a b.", "a b", "same!", "same!", "é 😀?", f"own {rng.random()}.", f"own {rng.random()}"])
            turns.append((c, t, rng.choice(["user", "assistant", "assistant", "user", "system", "tool", None, ""]), text))
    return turns


def test_damaged_conversations_as_by_hand(spark):
    turns = make_turns(5) + [(None, None, None, None), (None, 3, "user", "x."), (None, 3, "user", "x."), (900, None, "user", "a."), (900, None, "assistant", "b"), (900, 7, "user", "x.")]
    assert repaired(spark.createDataFrame(turns, TURNS)) == by_hand(turns)


def test_dropped_conversations_stay_with_zeros(spark):
    gone = next(c for c in range(1000, 2000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    got = repaired(spark.createDataFrame([(gone, 0, "user", "a.")], TURNS))[gone]
    assert got == {"gaps": 0, "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0, "cost": 0, "audit": "", "repaired_sha256": hashlib.sha256(b"").hexdigest()}


@pytest.mark.parametrize("kind", ["alternating", "repeated", "system", "mixed"])
def test_one_conversation_with_most_rows(spark, kind, monkeypatch):
    """Chunks of a table, cut by ranges; turns that never converge take the passes over growing groups."""
    rng, n = random.Random(9), 900
    role = {"alternating": lambda i: ("user", "assistant")[i % 2], "repeated": lambda i: "user", "system": lambda i: "system", "mixed": lambda i: rng.choice(["user", "assistant", "tool", "system"])}[kind]
    text = (lambda i: "same.") if kind == "repeated" else (lambda i: f"text {i}." if i % 5 else f"text {i % 50}")
    turns = [(1, i, role(i), text(i)) for i in range(n)] + make_turns(8, 5)
    monkeypatch.setattr(cr, "CHUNK", 16)
    monkeypatch.setattr(cr, "HOLD", 64)
    df = spark.createDataFrame(turns, TURNS).repartition(7)
    assert repaired(df, damaged=False) == by_hand(turns, damaged=False)


def test_odd_tables(spark):
    empty = spark.createDataFrame([], TURNS)
    assert repaired(empty) == {}
    turns = [(4, 0, "user", "x" * 300_000 + "."), (4, 0, "user", "x" * 300_000 + "."), (4, 1, "assistant", "y. " + " \n" * 1000)]
    df = spark.createDataFrame(turns, TURNS)
    clash = df.select("*", *[F.lit("clash").alias(n) for n in ("copies", "symbol", "piece", "idx", "_conv", "part", "at", "n")])
    assert repaired(clash, damaged=False) == by_hand(turns, damaged=False)
    pieces = cr.repair_conversations(df)
    assert {r["conv_id"]: r["audit"] for r in cr.repair_digests(pieces).collect()} == {4: by_hand(turns, damaged=False)[4]["audit"]}
