"""Chat formatting by columnar byte assembly.

Turns are range-partitioned and sorted by (conv_id, turn), so even one conversation
with most of the rows is formatted by many tasks. A task takes a block of turns
as columns: it computes the lengths of all segments (mark, text, closing mark), their
cumulative offsets, and scatter indices, and copies marks and texts into one
preallocated Arrow buffer. A row of the result is a piece: consecutive turns of
one conversation, in the order of ``first_turn`` and ``piece``. Loss spans are
code point ranges of a piece that hold the assistant's texts, as escaped.

Control strings in texts and role names get a backslash before them, and so does
every backslash: removing one backslash before any character undoes it.
"""

from __future__ import annotations

import hashlib
import re
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import blocks, gather_ranges, prepare, string_array, text_buffers

#: Opening and closing marks by role; other roles carry their name in the mark.
MARKS = {"system": ("<s>[SYS] ", " [/SYS]"), "user": ("<s>[INST] ", " [/INST]"), "assistant": ("<s>[ANS] ", "</s>")}
OTHER = ("<s>[ROLE {}] ", " [/ROLE]")
CONTROL = r"\\|</?s>|\[/?(?:SYS|INST|ANS|ROLE)"
_TOKEN = re.compile(r"\\.|<s>\[(?:(SYS|INST|ANS)|ROLE ((?:[^\\\]]|\\.)*))\] |( \[/(?:SYS|INST|ROLE)\]|</s>)", re.DOTALL)
_TAGS = {"SYS": "system", "INST": "user", "ANS": "assistant"}
PIECE = "conv_id long, first_turn long, piece long, text string, loss array<struct<start:long,end:long>>"


def escape(texts: pa.Array) -> pa.Array:
    return pc.replace_substring_regex(texts, pattern=f"({CONTROL})", replacement=r"\\\1")


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL) if "\\" in text else text


def marks(role: str) -> tuple[bytes, bytes]:
    if role in MARKS:
        return tuple(m.encode() for m in MARKS[role])
    return OTHER[0].format(re.sub(rf"({CONTROL}|\])", r"\\\1", role)).encode(), OTHER[1].encode()


def assemble(roles: list[str], data: np.ndarray, offsets: np.ndarray):
    """(bytes of all turns, start of each turn, and of its text, end of its text) from escaped texts."""
    names = {r: i for i, r in enumerate(dict.fromkeys(roles))}
    table = [marks(r) for r in names]
    kind = np.array([names[r] for r in roles])
    blob = np.frombuffer(b"".join(a + b for a, b in table), dtype=np.uint8)
    open_length, close_length = (np.array([len(t[i]) for t in table]) for i in (0, 1))
    open_at = np.concatenate([[0], np.cumsum(open_length + close_length)[:-1]])
    length = np.diff(offsets)
    turn = np.concatenate([[0], np.cumsum(open_length[kind] + length + close_length[kind])])
    text_at = turn[:-1] + open_length[kind]
    buffer = pa.allocate_buffer(int(turn[-1]))
    out = np.frombuffer(buffer, dtype=np.uint8)
    out[gather_ranges(turn[:-1], open_length[kind])] = blob[gather_ranges(open_at[kind], open_length[kind])]
    out[gather_ranges(text_at, length)] = data[offsets[0]:offsets[-1]]
    out[gather_ranges(text_at + length, close_length[kind])] = blob[gather_ranges((open_at + open_length)[kind], close_length[kind])]
    return out, turn, text_at, text_at + length


def _format(batches):
    piece = 0
    for batch in batches:
        conv, order = batch.column("conv_id"), batch.column("turn")
        roles = [r or "" for r in batch.column("role").to_pylist()]
        texts = batch.column("text").fill_null("")
        data, off = text_buffers(escape(texts))
        same = conv.fill_null(0).to_numpy()
        known = np.asarray(conv.is_valid())
        for lo, hi in blocks(off):
            out, turn, begin, end = assemble(roles[lo:hi], data, off[lo:hi + 1])
            points = np.concatenate([[0], np.cumsum((out & 0xC0) != 0x80)])
            first = np.flatnonzero(np.r_[True, (same[lo + 1:hi] != same[lo:hi - 1]) | (known[lo + 1:hi] != known[lo:hi - 1])])
            ends = np.r_[first[1:], hi - lo]
            spans, counts = [], []
            for a, b in zip(first, ends, strict=True):
                mine = [i for i in range(a, b) if roles[lo + i] == "assistant"]
                base = points[turn[a]]
                spans += [{"start": int(points[begin[i]] - base), "end": int(points[end[i]] - base)} for i in mine]
                counts.append(len(mine))
            loss = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), pa.array(spans, pa.struct([("start", pa.int64()), ("end", pa.int64())])))
            text = string_array(out, np.r_[turn[first], turn[-1]]).cast(pa.string())
            rows = pa.array(first + lo)
            yield pa.RecordBatch.from_arrays([conv.take(rows), order.take(rows), pa.array(np.arange(piece, piece + len(first))), text, loss], ["conv_id", "first_turn", "piece", "text", "loss"])
            piece += len(first)


def format_conversations(turns: DataFrame) -> DataFrame:
    """Pieces of formatted conversations: conv_id, first_turn, piece, text, loss (spans in code points).

    The turns of a conversation are ordered by turn (null first), then role and
    text, so ties and repeated rows have one result. Null texts and roles are
    empty; a role other than system, user and assistant keeps its name. A null
    conv_id is a conversation of its own. Most conversations are one piece; long
    ones, and those that a batch or task boundary cuts, are several. Only the four
    columns are read. An empty table gives no pieces."""
    prepare(turns.sparkSession)
    rows = turns.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.col("role").cast("string"), F.col("text").cast("string"))
    return rows.repartitionByRange("conv_id", "turn").sortWithinPartitions("conv_id", "turn", "role", "text").mapInArrow(_format, PIECE)


def read_back(text: str) -> list[tuple[str, str, int, int]]:
    """(role, text, start, end of the escaped text) of every turn of a piece."""
    out, role, at = [], None, 0
    for m in _TOKEN.finditer(text):
        if m[3] is not None:
            out.append((role, unescape(text[at:m.start()]), at, m.start()))
        elif m[0][0] != "\\":
            role, at = (_TAGS[m[1]] if m[1] else unescape(m[2])), m.end()
    return out


class _Digest:
    def __init__(self, conv):
        self.conv, self.turns, self.loss_chars, self.chars = conv, 0, 0, 0
        self.turn_hash, self.loss_hash = hashlib.sha256(), hashlib.sha256()

    def add(self, text: str, loss: list[dict]) -> None:
        self.chars += len(text)
        for role, body, _, _ in read_back(text):
            self.turns += 1
            self.turn_hash.update(f"{role}\n{body}\n".encode())
        for span in loss:
            body = unescape(text[span["start"]:span["end"]])
            self.loss_chars += len(body)
            self.loss_hash.update(body.encode())

    def row(self):
        return self.conv, self.turns, self.turn_hash.hexdigest(), self.loss_chars, self.loss_hash.hexdigest(), self.chars


NAMES = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
DIGEST = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
#: Characters of one conversation that _settle holds until it knows whether the partition has all of it.
HOLD_CHARS = 4 << 20


def _rows(batches):
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in batch.schema.names]
        for values in zip(*columns, strict=True):
            yield dict(zip(batch.schema.names, values, strict=True))


def _batches(rows, schema: pa.Schema, most_chars: int = 8 << 20):
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += 200 + len(row.get("text") or "")
        if size >= most_chars:
            yield pa.RecordBatch.from_pylist(held, schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


_DIGEST_FIELDS = [("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())]
_OPEN = pa.schema([("conv_id", pa.int64()), ("first_turn", pa.int64()), ("piece", pa.int64()), ("text", pa.string()),
                   ("loss", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), *_DIGEST_FIELDS])
_DONE = pa.schema([("conv_id", pa.int64()), *_DIGEST_FIELDS])


def _digest_of(conv, pieces) -> dict:
    digest = _Digest(conv)
    for p in pieces:
        digest.add(p["text"], p["loss"])
    return dict(zip(NAMES, digest.row(), strict=True))


def _settle(batches, hold: int):
    """Digests of the conversations that lie inside a range partition; the pieces of its first and last
    one, which neighbours may share, and of very long ones, pass on."""
    def rows():
        held, size, first, conv, begun = [], 0, True, None, False
        for p in _rows(batches):
            if begun and p["conv_id"] != conv:
                if first or size > hold:
                    yield from held
                else:
                    yield _digest_of(conv, held)
                held, size, first = [], 0, False
            conv, begun = p["conv_id"], True
            held.append(p)
            size += len(p["text"])
            if size > hold:
                yield from held
                held = []
        yield from held
    yield from _batches(rows(), _OPEN)


def _finish(batches):
    def rows():
        now = None
        for p in _rows(batches):
            if p["n_turns"] is not None:
                yield {n: p[n] for n in NAMES}
                continue
            if now is None or p["conv_id"] != now.conv:
                if now is not None:
                    yield dict(zip(NAMES, now.row(), strict=True))
                now = _Digest(p["conv_id"])
            now.add(p["text"], p["loss"])
        if now is not None:
            yield dict(zip(NAMES, now.row(), strict=True))
    yield from _batches(rows(), _DONE)


def conversation_digests(pieces: DataFrame, ranged: bool = False, hold_chars: int = HOLD_CHARS) -> DataFrame:
    """One row per conversation, read back from its pieces: conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars.

    ``ranged``: pieces is what format_conversations returned, still in its ranges; then
    only conversations at the edges of a range, and very long ones, are dealt again.
    A conversation's hash needs its turns in order, so its pieces stream through one
    task; the task holds a batch and the hash states, whatever the conversation's length."""
    kind = f"{PIECE}, {DIGEST.removeprefix('conv_id long, ')}"
    if ranged:
        pieces = pieces.mapInArrow(partial(_settle, hold=hold_chars), kind)
    else:
        pieces = pieces.select("conv_id", "first_turn", "piece", "text", "loss", *[F.lit(None).cast(t).alias(n) for n, t in (x.split() for x in DIGEST.split(", ")[1:])])
    return pieces.repartition("conv_id").sortWithinPartitions("conv_id", "first_turn", "piece").mapInArrow(_finish, DIGEST)
