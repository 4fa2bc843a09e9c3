"""Conversation structure repair by rank-convergence parallel Viterbi.

A conversation's turns are edited at least cost until their role initials read
``(s?(ua)+)?``: keep a turn (0), set its role to user or assistant (2), delete it (3,
required for blank and repeated turns), insert an empty turn (2); a truncated turn
that stays costs 1. The four states of that pattern give every position a vector of
four costs to the end, and a turn is a 4 x 4 matrix over (min, +).

Conversations are cut into chunks, and all chunks run backward side by side. A
chunk doesn't know the vector at its right edge, so it starts from a speculative
one. Fix-up passes hand each chunk its neighbour's left vector and run it again,
until the vector differs from the one used, or, within the chunk, from the one
found before, only by a constant: everything to the left then holds up to that
constant, which decides nothing. The stitched vectors drive a forward walk that takes, at
every step, the least letter among the cheapest edits.

Within a task the chunks are lanes of numpy arrays. Conversations that a range
boundary cuts, or that are too long to hold, are chunks of a table: their fix-up
passes are Spark jobs over one byte per turn. Pass p runs 8**p neighbouring chunks
in one task, so even turns that never converge need a logarithmic number of passes.
"""

from __future__ import annotations

import hashlib
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .base import cut, prepare

BLANKS = " \t\n\x0b\x0c\r"
STATES = 4  # nothing yet, after the system turn, after a user turn, after an assistant turn
#: A turn as a symbol: 2 * (0 system, 1 user, 2 assistant, 3 other) + truncated; or it has to be deleted.
DELETED = 8
INFINITE = 1 << 40
LETTERS = np.frombuffer(b"DIKR", dtype=np.uint8)  # in the order that decides ties
DROP, INSERT, KEEP, REROLE = range(4)
ROLES = ("user", "assistant")

#: State after a turn that is set or inserted to fit, and after a kept turn of each role (-1: doesn't fit).
FIT = np.array([2, 2, 3, 2])
KEPT = np.array([[1, 2, -1, -1], [-1, 2, -1, -1], [-1, -1, 3, -1], [-1, 2, -1, -1]])
#: Cost to the end of a conversation: what is open gets its missing turns.
END = np.array([0, 4, 2, 0], dtype=np.int64)
GUESS = np.zeros(STATES, dtype=np.int64)

#: Turns in a lane, in a block of conversations, in a chunk of the table; turns and characters of a conversation that a task holds.
LANE = 128
BLOCK = 4096
CHUNK = 1024
HOLD = 16_384
HOLD_CHARS = 4 << 20


def _options() -> tuple[np.ndarray, np.ndarray]:
    """(symbol, state, letter): cost of consuming a turn by that letter, and the state after it."""
    cost = np.full((DELETED + 1, STATES, 4), INFINITE, dtype=np.int64)
    after = np.zeros((DELETED + 1, STATES, 4), dtype=np.int64)
    for symbol in range(DELETED + 1):
        role, truncated = symbol >> 1, symbol & 1
        for state in range(STATES):
            cost[symbol, state, DROP], after[symbol, state, DROP] = 3, state
            if symbol == DELETED:
                continue
            cost[symbol, state, REROLE], after[symbol, state, REROLE] = 2 + truncated, FIT[state]
            if KEPT[state, role] >= 0:
                cost[symbol, state, KEEP], after[symbol, state, KEEP] = truncated, KEPT[state, role]
    return cost, after


COST, AFTER = _options()


def choices(symbol: np.ndarray, after: np.ndarray) -> np.ndarray:
    """lanes x state x letter: cost to the end if that letter comes next, from the vectors behind the turns (lanes x state)."""
    lanes = np.arange(len(symbol))[:, None, None]
    out = COST[symbol] + after[lanes, AFTER[symbol]]
    once = out.min(axis=2)
    with_insert = 2 + np.minimum(once[:, FIT], 2 + once[:, FIT[FIT]])
    out[:, :, INSERT] = with_insert
    return out


def _level(v: np.ndarray) -> np.ndarray:
    """Vectors less their minimum: equal where they differ by a constant."""
    return v - v.min(axis=-1, keepdims=True)


def backward(symbols: np.ndarray, start: np.ndarray, end: np.ndarray, right: np.ndarray, found: np.ndarray, again: bool = False) -> np.ndarray:
    """Run lanes from their right edges; found[i] becomes the vector behind turn i. Returns the vectors at the left edges.

    ``again``: found has the vectors of an earlier run; a lane stops where a vector differs from
    that run's only by a constant, its left vector stays that of the earlier run, and -1 is returned for it."""
    now = _level(right.astype(np.int64))
    at = end.copy()
    stopped = np.zeros(len(start), dtype=bool)
    live = np.flatnonzero(at > start)
    while len(live):
        i = at[live] - 1
        if again:
            same = (found[i] == now[live]).all(axis=1) & (at[live] < end[live])
            stopped[live[same]] = True
            live, i = live[~same], i[~same]
        found[i] = now[live]
        now[live] = _level(choices(symbols[i], now[live]).min(axis=2))
        at[live] = i
        live = live[i > start[live]]
    now[stopped] = -1
    return now


def walk(symbols: np.ndarray, start: np.ndarray, end: np.ndarray, state: np.ndarray, last: np.ndarray, found: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Walk lanes forward from their states: (lane, letter, turn or -1) of every edit in order of lanes, and the states at the end."""
    at, state = start.copy(), state.copy()
    lanes, letters, turns = [], [], []
    live = np.arange(len(start))
    while len(live):
        over = at[live] >= end[live]
        inside, outside = live[~over], live[over]
        outside = outside[last[outside] & (END[state[outside]] > 0)]
        if len(inside):
            i = at[inside]
            letter = choices(symbols[i], found[i])[np.arange(len(inside)), state[inside]].argmin(axis=1)
            put = letter == INSERT
            lanes.append(inside)
            letters.append(letter)
            turns.append(np.where(put, -1, i))
            state[inside] = np.where(put, FIT[state[inside]], AFTER[symbols[i], state[inside], letter])
            at[inside] += ~put
        if len(outside):
            lanes.append(outside)
            letters.append(np.full(len(outside), INSERT))
            turns.append(np.full(len(outside), -1))
            state[outside] = FIT[state[outside]]
        live = np.concatenate([inside, outside])
    if not lanes:
        none = np.zeros(0, dtype=np.int64)
        return none, none, none, state
    lane = np.concatenate(lanes)
    order = np.argsort(lane, kind="stable")
    return lane[order], np.concatenate(letters)[order], np.concatenate(turns)[order], state


def solve(symbols: np.ndarray, first: np.ndarray, lane: int = LANE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Least edits of whole conversations (turns first[i] to first[i + 1]): their letters, the turn of each (-1: inserted), and where each conversation's begin (plus the end)."""
    n = np.diff(first)
    chunks = np.maximum(1, -(-n // lane))
    conv = np.repeat(np.arange(len(n)), chunks)
    number = np.arange(len(conv)) - np.repeat(np.cumsum(chunks) - chunks, chunks)
    start = first[conv] + number * lane
    end = np.minimum(start + lane, first[conv + 1])
    last = number == chunks[conv] - 1
    right = np.where(last[:, None], _level(END), GUESS)
    found = np.zeros((len(symbols), STATES), dtype=np.int64)
    left = backward(symbols, start, end, right, found)
    inner = np.flatnonzero(~last)
    while len(inner):
        wrong = inner[(left[inner + 1] != right[inner]).any(axis=1)]
        if not len(wrong):
            break
        right[wrong] = left[wrong + 1]
        again = backward(symbols, start[wrong], end[wrong], right[wrong], found, again=True)
        moved = again[:, 0] >= 0
        left[wrong[moved]] = again[moved]
    # a chunk's first state is known for the first one; the others walk from each state until the one before is known
    tries = np.where(number == 0, 1, STATES)
    copy = np.repeat(np.arange(len(conv)), tries)
    base = np.cumsum(tries) - tries
    state = np.arange(len(copy)) - base[copy]
    lanes, letters, turns, out = walk(symbols, start[copy], end[copy], state, last[copy], found)
    chosen = base.copy()
    for c in np.flatnonzero(number > 0):
        chosen[c] = base[c] + out[chosen[c - 1]]
    use = np.zeros(len(copy), dtype=bool)
    use[chosen] = True
    mine = use[lanes]
    lanes, letters, turns = lanes[mine], letters[mine], turns[mine]
    return letters, turns, np.searchsorted(conv[copy[lanes]], np.arange(len(n) + 1))


def repaired(letters, turns, state: int, roles, texts) -> tuple[list[str], list[str], int]:
    """Roles and texts of the repaired turns, and the state behind them; ``turns`` index roles and texts."""
    out_roles, out_texts = [], []
    for letter, i in zip(letters, turns, strict=True):
        if letter == DROP:
            continue
        if letter == KEEP:
            role = roles[i]
            state = KEPT[state, "sua".index(role[0])]
        else:
            state = FIT[state]
            role = ROLES[state - 2]
        out_roles.append(role)
        out_texts.append("" if letter == INSERT else texts[i])
    return out_roles, out_texts, state


class Faults:
    """Counts that need the neighbour: gaps between turn numbers, and pairs of roles that mustn't follow each other."""

    def __init__(self):
        self.turn = self.initial = None

    def add(self, turns, roles) -> tuple[int, int]:
        gaps = illegal = 0
        for turn, role in zip(turns, roles, strict=True):
            if turn is not None:
                if self.turn is not None and turn > self.turn:
                    gaps += turn - self.turn - 1
                self.turn = turn
            if self.initial is not None and self.initial + role[:1] not in ("su", "ua", "au"):
                illegal += 1
            self.initial = role[:1]
        return gaps, illegal


def _cost(letters: np.ndarray, turns: np.ndarray, symbols: np.ndarray) -> int:
    stays = (letters == KEEP) | (letters == REROLE)
    return int(3 * (letters == DROP).sum() + 2 * ((letters == INSERT) | (letters == REROLE)).sum() + (symbols[turns[stays]] & 1).sum())


_COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
_TURNS = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
_PIECE = pa.schema([("conv_id", pa.int64()), ("piece", pa.int64()), *[(c, pa.int64()) for c in _COUNTS], ("audit", pa.string()), ("turns", _TURNS)])
_OPEN = pa.schema([*_PIECE, ("part", pa.int32()), ("at", pa.list_(pa.int64())), ("symbols", pa.binary())])
PIECE = "conv_id long, piece long, " + ", ".join(f"{c} long" for c in _COUNTS) + ", audit string, turns array<struct<role: string, text: string>>"
_OPEN_DDL = f"{PIECE}, part int, at array<long>, symbols binary"


def _turn_lists(roles: list[list[str]], texts: list[list[str]]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in roles])]).astype(np.int32)
    flat = pa.StructArray.from_arrays([pa.array([x for r in roles for x in r], pa.string()), pa.array([x for t in texts for x in t], pa.string())], ["role", "text"])
    return pa.ListArray.from_arrays(pa.array(offsets), flat)


class _Conversation:
    """The turns of a conversation that a task has so far; ``number`` counts the chunks it has given away."""

    def __init__(self, conv, opened: bool):
        self.conv, self.opened, self.number = conv, opened, 0
        self.clear()

    def clear(self):
        self.at, self.roles, self.texts, self.symbols, self.chars = [], [], [], [], 0

    def add(self, turn, role, text, symbol, copies):
        for _ in range(copies):
            self.at.append(turn)
            self.roles.append(role)
            self.texts.append(text)
            self.symbols.append(symbol)
            self.chars += len(text)

    def chunks(self):
        """Batches of its turns as open chunks, at least one in all."""
        part = TaskContext.get().partitionId()
        for lo in range(0, len(self.at) or (0 if self.number else 1), CHUNK):
            hi = lo + CHUNK
            none = {c: pa.array([None], pa.int64()) for c in _COUNTS}
            columns = {"conv_id": pa.array([self.conv], pa.int64()), "piece": pa.array([self.number], pa.int64()), **none, "audit": pa.array([None], pa.string()),
                       "turns": _turn_lists([self.roles[lo:hi]], [self.texts[lo:hi]]), "part": pa.array([part], pa.int32()),
                       "at": pa.array([self.at[lo:hi]], pa.list_(pa.int64())), "symbols": pa.array([bytes(self.symbols[lo:hi])], pa.binary())}
            yield pa.RecordBatch.from_arrays([columns[n] for n in _OPEN.names], schema=_OPEN)
            self.number += 1
        self.clear()


def _closed(held: list[_Conversation]) -> pa.RecordBatch:
    """Pieces of whole conversations, one each."""
    symbols = np.array([s for c in held for s in c.symbols], dtype=np.uint8).astype(np.int64)
    first = np.concatenate([[0], np.cumsum([len(c.symbols) for c in held])])
    counts = {c: [] for c in _COUNTS}
    for c, lo, hi in zip(held, first[:-1], first[1:], strict=True):
        gaps, illegal = Faults().add(c.at, c.roles)
        blank = int((symbols[lo:hi] == DELETED).sum())
        seen: set = set()
        for i, key in enumerate(zip(c.roles, c.texts, strict=True)):
            if symbols[lo + i] != DELETED:
                if key in seen:
                    symbols[lo + i] = DELETED
                seen.add(key)
        deleted = symbols[lo:hi] == DELETED
        truncated = int((symbols[lo:hi][~deleted] & 1).sum())
        for name, n in zip(_COUNTS, (gaps, blank, int(deleted.sum()) - blank, truncated, illegal, 0), strict=True):
            counts[name].append(n)
    letters, turns, begin = solve(symbols, first)
    audits, roles, texts = [], [], []
    for k, c in enumerate(held):
        mine, where = letters[begin[k]:begin[k + 1]], turns[begin[k]:begin[k + 1]]
        counts["cost"][k] = _cost(mine, where, symbols)
        audits.append(LETTERS[mine].tobytes().decode())
        r, t, _ = repaired(mine.tolist(), (where - first[k]).tolist(), 0, c.roles, c.texts)
        roles.append(r)
        texts.append(t)
    n = len(held)
    columns = {"conv_id": pa.array([c.conv for c in held], pa.int64()), "piece": pa.array([0] * n, pa.int64()), **{c: pa.array(v, pa.int64()) for c, v in counts.items()},
               "audit": pa.array(audits, pa.string()), "turns": _turn_lists(roles, texts), "part": pa.array([-1] * n, pa.int32()),
               "at": pa.array([None] * n, pa.list_(pa.int64())), "symbols": pa.array([None] * n, pa.binary())}
    return pa.RecordBatch.from_arrays([columns[x] for x in _OPEN.names], schema=_OPEN)


def _settle(batches):
    """Repair conversations that lie inside a range; those at its edges, and long ones, leave as open chunks (part >= 0)."""
    now, held, size, chars = None, [], 0, 0
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text", "symbol", "copies")]
        for conv, turn, role, text, symbol, copies in zip(*columns, strict=True):
            if now is None or conv != now.conv:
                if now is not None:
                    if now.opened:
                        yield from now.chunks()
                    else:
                        held.append(now)
                        size += len(now.at)
                        chars += now.chars
                        if size >= BLOCK or chars >= HOLD_CHARS or len(held) >= BLOCK:
                            yield _closed(held)
                            held, size, chars = [], 0, 0
                now = _Conversation(conv, opened=now is None)
            now.add(turn, role, text, symbol, copies)
            if len(now.at) >= (CHUNK if now.opened else HOLD) or now.chars >= HOLD_CHARS:
                now.opened = True
                yield from now.chunks()
    if held:
        yield _closed(held)
    if now is not None:
        yield from now.chunks()


def damage(turns: DataFrame) -> DataFrame:
    """Rows as damaged by the crc32 of ``conv_id:turn`` modulo 20: 0 drops a row (copies 0), 1 empties its text,
    2 removes .!? from it, 3 repeats it (copies 2), 4 sets role user. Null roles and texts, and nulls in the key, are one space."""
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    kind = F.crc32(key) % 20
    text = F.coalesce(F.col("text").cast("string"), space)
    return turns.select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(F.coalesce(F.col("role").cast("string"), space)).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"))


def _symbol():
    bare = F.rtrim(F.col("text"), F.lit(BLANKS))
    initial = F.substring("role", 1, 1)
    role = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    return F.when(bare == "", DELETED).otherwise(2 * role + F.when(F.substring(bare, -1, 1).isin(".", "!", "?"), 0).otherwise(1)).alias("symbol")


def _key(name: str = "conv_id"):
    """conv_id and whether it is null, as join columns."""
    return [F.coalesce(F.col(name), F.lit(0)).alias("_conv"), F.col(name).isNull().alias("_none")]


_LINK = ["_conv", "_none", "idx"]
_CHUNK_DDL = "_conv long, _none boolean, idx long, last boolean, symbols binary, used array<long>, left array<long>"


def _vector(lists) -> np.ndarray:
    return np.array(lists, dtype=np.int64).reshape(-1, STATES)


def _run_chunk(symbols: bytes, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(left vector, vectors behind the turns) of one chunk of the table: its lanes' speculative runs, stitched."""
    s = np.frombuffer(symbols, dtype=np.uint8).astype(np.int64)
    start = np.arange(0, max(1, len(s)), LANE)
    end = np.minimum(start + LANE, len(s))
    found = np.zeros((len(s), STATES), dtype=np.int64)
    used = np.tile(GUESS, (len(start), 1))
    used[-1] = _level(right)
    left = backward(s, start, end, used, found)
    while True:
        wrong = np.flatnonzero((left[1:] != used[:-1]).any(axis=1))
        if not len(wrong):
            return left[0], found
        used[wrong] = left[wrong + 1]
        again = backward(s, start[wrong], end[wrong], used[wrong], found, again=True)
        moved = again[:, 0] >= 0
        left[wrong[moved]] = again[moved]


def _pass(batches, level: int):
    """One fix-up pass: neighbouring chunks of a group of 8**level follow each other from the right; a chunk runs
    only where its right vector differs from the used one by more than a constant."""
    before = None
    for batch in batches:
        rows = batch.to_pylist()
        for r in rows:
            follows = before is not None and level and (before["_conv"], before["_none"], before["idx"]) == (r["_conv"], r["_none"], r["idx"] + 1) and before["idx"] >> 3 * level == r["idx"] >> 3 * level
            right = _level(END) if r["last"] else np.array(before["left"] if follows else r["next"] or GUESS.tolist())
            if r["used"] is None or (right != np.array(r["used"])).any():
                r["used"], r["left"] = right.tolist(), _run_chunk(r["symbols"], right)[0].tolist()
            before = r
        yield pa.RecordBatch.from_pylist([{n: r[n] for n in ("_conv", "_none", "idx", "last", "symbols", "used", "left")} for r in rows], pa.schema(
            [("_conv", pa.int64()), ("_none", pa.bool_()), ("idx", pa.int64()), ("last", pa.bool_()), ("symbols", pa.binary()), ("used", pa.list_(pa.int64())), ("left", pa.list_(pa.int64()))]))


def _mark(batches):
    """Turns that aren't the first of their role and text have to be deleted."""
    for batch in batches:
        out = []
        for symbols, firsts in zip(batch.column("symbols").to_pylist(), batch.column("firsts").to_pylist(), strict=True):
            s = np.frombuffer(symbols, dtype=np.uint8).copy()
            again = np.ones(len(s), dtype=bool)
            again[np.array(firsts or [], dtype=np.int64)] = False
            s[again] = DELETED
            out.append(s.tobytes())
        names = [n for n in batch.schema.names if n != "firsts"]
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary()) if n == "symbols" else batch.column(n) for n in names], names)


def _finish(batches):
    """Walk the chunks of open conversations in order, each from the state the one before ended in."""
    key, state, faults, number = None, 0, None, 0
    for batch in batches:
        for r in batch.to_pylist():
            if key != (r["_conv"], r["_none"]):
                key, state, faults, number = (r["_conv"], r["_none"]), 0, Faults(), 0
            symbols = np.frombuffer(r["symbols"], dtype=np.uint8).astype(np.int64)
            blanks = np.frombuffer(r["blanks"], dtype=np.uint8) == DELETED
            roles, texts = [t["role"] for t in r["turns"]], [t["text"] for t in r["turns"]]
            gaps, illegal = faults.add(r["at"], roles)
            _, found = _run_chunk(r["symbols"], np.array(r["used"]))
            zero, n = np.zeros(1, dtype=np.int64), np.array([len(symbols)])
            _, letters, turns, _ = walk(symbols, zero, n, np.array([state]), np.array([r["last"]]), found)
            out_roles, out_texts, state = repaired(letters.tolist(), turns.tolist(), state, roles, texts)
            alive = symbols != DELETED
            row = {"conv_id": r["conv_id"], "piece": number, "gaps": gaps, "blank": int(blanks.sum()), "duplicate": int((~alive & ~blanks).sum()),
                   "truncated": int((symbols[alive] & 1).sum()), "illegal": illegal, "cost": _cost(letters, turns, symbols), "audit": LETTERS[letters].tobytes().decode(),
                   "turns": [{"role": a, "text": b} for a, b in zip(out_roles, out_texts, strict=True)]}
            number += 1
            yield pa.RecordBatch.from_pylist([row], _PIECE)


def _stitch(opened: DataFrame) -> DataFrame:
    """Pieces of the open conversations from their chunks."""
    chunks = opened.select("*", *_key())
    # chunks are numbered through the parts of a conversation: one row a part
    parts = chunks.groupBy("_conv", "_none", "part").agg((F.max("piece") + 1).alias("n"))
    order = Window.partitionBy("_conv", "_none").orderBy("part")
    offset = F.coalesce(F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    whole = F.sum("n").over(Window.partitionBy("_conv", "_none"))
    parts = parts.select("_conv", "_none", "part", offset.alias("offset"), whole.alias("whole"))
    numbered = cut(chunks.join(parts, ["_conv", "_none", "part"]).withColumn("idx", F.col("offset") + F.col("piece")).withColumn("last", F.col("idx") + 1 == F.col("whole")).drop("offset", "whole", "part", "piece"))
    turns = numbered.select("_conv", "_none", "idx", F.posexplode("turns").alias("pos", "turn"))
    digest = F.md5(F.concat_ws(":", F.length("turn.role"), "turn.role", "turn.text"))
    firsts = turns.groupBy("_conv", "_none", digest.alias("digest")).agg(F.min(F.struct("idx", "pos")).alias("first"))
    firsts = firsts.groupBy("_conv", "_none", F.col("first.idx").alias("idx")).agg(F.collect_list("first.pos").alias("firsts"))  # at most CHUNK a chunk
    light = numbered.select(*_LINK, "last", "symbols").join(firsts, _LINK, "left").mapInArrow(_mark, "_conv long, _none boolean, idx long, last boolean, symbols binary")
    none = F.lit(None).cast("array<long>")
    done = cut(light.withColumns({"used": none, "left": none, "next": none}).mapInArrow(partial(_pass, level=0), _CHUNK_DDL))
    level = 0
    while True:
        neighbour = done.select("_conv", "_none", (F.col("idx") - 1).alias("idx"), F.col("left").alias("next"))
        linked = cut(done.join(neighbour, _LINK, "left"))
        if linked.where("not last and next <> used").isEmpty():
            break
        level += 1
        group = F.shiftright("idx", 3 * level)
        dealt = linked.repartition("_conv", "_none", group).sortWithinPartitions("_conv", "_none", F.col("idx").desc())
        done = cut(dealt.mapInArrow(partial(_pass, level=level), _CHUNK_DDL))
    used = done.select(*_LINK, "symbols", "used")
    rows = numbered.withColumnRenamed("symbols", "blanks").join(used, _LINK).select("_conv", "_none", "idx", "conv_id", "last", "turns", "at", "blanks", "symbols", "used")
    return rows.repartition("_conv", "_none").sortWithinPartitions("_conv", "_none", "idx").mapInArrow(_finish, PIECE)


def repair_conversations(turns: DataFrame, copies: str | None = None) -> DataFrame:
    """Pieces of the repaired conversations: conv_id, piece, gaps, blank, duplicate, truncated, illegal, cost (to be added up over
    the pieces), audit (letters of the edits in order: D delete, I insert, K keep, R set the role) and turns (role, text).

    Reads conv_id, turn, role, text and, where named, a column of copies (how often a row stands there; 0 or null: only its
    conversation counts). Turns are taken by number (null first), ties by role and text. Null roles and
    texts are one space. A null conv_id is a conversation of its own. Most conversations are one piece;
    long ones and those that a range boundary cuts have several. The table is sorted by ranges, so a conversation with
    most rows is dealt to many tasks; its last walk, which needs the turns in order, streams through one.
    An empty table gives no pieces."""
    spark = prepare(turns.sparkSession)
    space = F.lit(" ")
    times = F.coalesce(F.col(copies).cast("int"), F.lit(0)) if copies else F.lit(1)
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role").cast("string"), space).alias("role"),
                        F.when(times > 0, F.coalesce(F.col("text").cast("string"), space)).otherwise("").alias("text"), times.alias("copies"))
    ranged = rows.repartitionByRange("conv_id", "turn", "role", F.substring("text", 1, 32)).sortWithinPartitions("conv_id", "turn", "role", "text")
    settled = cut(ranged.select("*", _symbol()).mapInArrow(_settle, _OPEN_DDL))
    pieces = [f.name for f in _PIECE]
    done = settled.where("part < 0").select(*pieces)
    opened = settled.where("part >= 0").select("conv_id", "piece", "part", "turns", "at", "symbols")
    return done.unionByName(_stitch(opened))


DIGEST = "conv_id long, " + ", ".join(f"{c} long" for c in _COUNTS) + ", audit string, repaired_sha256 string"


def _digests(batches):
    conv, begun, sums, audit, sha, lines = None, False, None, None, None, 0
    schema = pa.schema([("conv_id", pa.int64()), *[(c, pa.int64()) for c in _COUNTS], ("audit", pa.string()), ("repaired_sha256", pa.string())])

    def row():
        return {"conv_id": conv, **dict(zip(_COUNTS, sums, strict=True)), "audit": "".join(audit), "repaired_sha256": sha.hexdigest()}

    for batch in batches:
        out = []
        for r in batch.to_pylist():
            if not begun or r["conv_id"] != conv or r["piece"] == 0:
                if begun:
                    out.append(row())
                conv, begun, sums, audit, sha, lines = r["conv_id"], True, [0] * len(_COUNTS), [], hashlib.sha256(), 0
            sums = [a + r[c] for a, c in zip(sums, _COUNTS, strict=True)]
            audit.append(r["audit"])
            for turn in r["turns"]:
                sha.update((("\n" if lines else "") + f"{turn['role']}:{turn['text']}").encode())
                lines += 1
        if out:
            yield pa.RecordBatch.from_pylist(out, schema)
    if begun:
        yield pa.RecordBatch.from_pylist([row()], schema)


def repair_digests(pieces: DataFrame, ordered: bool = False) -> DataFrame:
    """One row per conversation: conv_id, the counts, cost, the whole audit and the SHA-256 of ``role:text`` lines.

    ``ordered``: pieces is what repair_conversations returned, whose pieces of a conversation follow each other in one task."""
    if not ordered:
        pieces = pieces.repartition("conv_id").sortWithinPartitions("conv_id", "piece")
    return pieces.mapInArrow(_digests, DIGEST)
