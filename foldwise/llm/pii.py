"""Personal data in texts, with DataFrame functions only.

Regular expressions propose spans; a validator of the kind confirms them (parts of
an address, Luhn, digits of a number, mod 97, impossible areas); words near a span
adjust its score. The base kinds (email, ip, card, phone) are found by fixed
patterns and always stay; the further kinds (iban, ssn) stay from LEAST_SCORE on.

Positions come from the pieces between the matches: the text is split by the same
pattern, and lengths (code points) are summed. The patterns are written for an
engine that backtracks: possessive repeats, and a look-behind that starts a match
only where a run starts or the last match ended, so that long runs stay linear.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .base import prepare

#: Fixed patterns of the base kinds, in their order, equal in effect to:
#: [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+   [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)
#: [0-9]([\x20-]?[0-9])+   \+[0-9][\x20().0-9-]+[0-9]
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?",
    "ssn": r"[0-9]{3}-[0-9]{2}-[0-9]{4}",
}
BASE = ("email", "ip", "card", "phone")
#: A text without this substring has no match.
NEEDS = {"email": "@", "phone": "+", "ssn": "-", "ip": "."}
#: Score of a confirmed span, and words whose presence nearby adds NEAR to it.
SCORES = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.6, "iban": 0.8, "ssn": 0.4}
CONTEXT = {
    "email": r"(?i)mail|contact|write",
    "ip": r"(?i)\bip\b|address|server|host",
    "card": r"(?i)card|visa|credit|pay",
    "phone": r"(?i)phone|call|tel|mobile|fax",
    "iban": r"(?i)iban|account|bank|transfer",
    "ssn": r"(?i)ssn|social|security|taxpayer",
}
NEAR, AROUND, LEAST_SCORE = 0.3, 40, 0.5


#: Matches whose positions are added up one after the other; an array grows to at most this size by single items.
BLOCK = 256


def _let(value: Column, body) -> Column:
    """body(value), with value computed once however often body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def matches(text: Column, pattern: str) -> Column:
    """Array of (start, end, value) of the leftmost non-overlapping matches; code points, end exclusive.

    Positions are sums of the lengths before: first over whole blocks of matches, then inside each block, so the
    work stays in proportion to the matches."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pieces = F.split(text, pattern, -1)
    parts = F.arrays_zip(F.slice(pieces, F.lit(1), F.size(pieces) - 1).alias("gap"), found.alias("value"))
    none = F.array().cast("array<struct<start:int,end:int,value:string>>")

    def spans(parts):
        blocks = F.sequence(F.lit(0), F.floor((F.size(parts) - 1) / BLOCK).cast("int"))
        block = lambda b: F.slice(parts, b * BLOCK + 1, F.lit(BLOCK))

        def total(state, b):
            length = F.aggregate(block(b), F.lit(0), lambda n, p: n + F.length(p["gap"]) + F.length(p["value"]))
            return F.struct((state["at"] + length).alias("at"), F.concat(state["out"], F.array(state["at"])).alias("out"))

        def step(state, part):
            begin = state["at"] + F.length(part["gap"])
            end = begin + F.length(part["value"])
            span = F.struct(begin.alias("start"), end.alias("end"), part["value"].alias("value"))
            return F.struct(end.alias("at"), F.concat(state["out"], F.array(span)).alias("out"))

        starts = F.aggregate(blocks, F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out")), total, lambda s: s["out"])
        inside = lambda at, b: F.aggregate(block(b), F.struct(at.alias("at"), none.alias("out")), step, lambda s: s["out"])
        return _let(starts, lambda at: F.flatten(F.transform(at, inside)))

    return _let(parts, lambda p: F.when(F.size(p) > 0, spans(p)).otherwise(none))


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a string of digits has a valid Luhn check digit."""
    n = F.length(number)

    def add(total, i):
        digit = F.substring(number, n - i + 1, F.lit(1)).cast("int")
        double = digit * 2 - F.when(digit > 4, 9).otherwise(0)
        return total + F.when(i % 2 == 0, double).otherwise(digit)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add) % 10 == 0


def mod97(value: Column) -> Column:
    """Whether letters and digits, first four moved to the end, leave 1 modulo 97 (A is 10, Z is 35)."""
    moved = F.concat(F.substring(value, F.lit(5), F.length(value)), F.substring(value, 1, 4))

    def add(rest, i):
        code = F.ascii(F.substring(moved, i, F.lit(1)))
        return F.when(code < 58, (rest * 10 + code - 48) % 97).otherwise((rest * 100 + code - 55) % 97)

    return F.aggregate(F.sequence(F.lit(1), F.length(moved)), F.lit(0), add) == 1


def confirmed(kind: str, pieces: Column, span: Column) -> Column:
    value = span["value"]
    if kind == "ip":
        part = lambda p: F.regexp_replace(p, "^0+", "")
        return F.forall(F.split(value, r"\."), lambda p: (F.length(part(p)) <= 3) & (F.coalesce(part(p).try_cast("int"), F.lit(0)) <= 255))
    if kind == "card":
        return F.when(F.length(digits(value)).between(13, 19), luhn(digits(value))).otherwise(False)
    if kind == "phone":
        return F.length(digits(value)).between(9, 15)
    if kind == "iban":
        compact = F.replace(value, F.lit(" "), F.lit(""))
        return F.when(F.length(compact).between(15, 34), mod97(compact)).otherwise(False)
    if kind == "ssn":
        before = F.when(span["start"] > 0, _around(pieces, span["start"] - 1, F.lit(1))).otherwise("")
        after = _around(pieces, span["end"], F.lit(1))
        return ~before.rlike("[0-9-]") & ~after.rlike("[0-9-]") & ~value.rlike("^(000|666|9)|-00-|-0000$")
    return F.lit(True)


#: Code points of the pieces that contexts are read from, so that a span of a long text doesn't count through all that is before it.
PIECE = 1024


def _around(pieces: Column, start: Column, length: Column) -> Column:
    """length (at most PIECE) code points from start on, of a text given as its pieces."""
    at = F.floor(start / PIECE).cast("int")
    near = F.concat(F.coalesce(F.get(pieces, at), F.lit("")), F.coalesce(F.get(pieces, at + 1), F.lit("")))
    return F.substring(near, (start - at * PIECE + 1).cast("int"), length)


def score(kind: str, pieces: Column, span: Column) -> Column:
    begin = F.greatest(span["start"] - AROUND, F.lit(0))
    near = F.concat(_around(pieces, begin, span["start"] - begin), F.lit(" "), _around(pieces, span["end"], F.lit(AROUND)))
    return F.least(F.lit(1.0), F.lit(SCORES[kind]) + F.when(near.rlike(CONTEXT[kind]), NEAR).otherwise(0.0))


def find_pii(docs: DataFrame, carry: list[str] | None = None) -> DataFrame:
    """One row per row of docs: the columns of carry (default doc_id), and spans.

    spans: array of (kind, start, end, score), by kind in the order of PATTERNS,
    then start. Null and empty texts have none. Repeated rows are treated alike;
    other columns are not read and cannot clash. No row is dropped."""
    prepare(docs.sparkSession)
    row = F.struct(*[F.col(c) for c in carry or ["doc_id"]]).alias("_row")
    found = docs.select(row, F.coalesce(F.col("text"), F.lit("")).alias("_text"))
    text = F.col("_text")
    none = F.array().cast("array<struct<start:int,end:int,value:string>>")
    columns = []
    for kind, pattern in PATTERNS.items():
        has = text.rlike(pattern)
        if kind in NEEDS:
            has = text.contains(NEEDS[kind]) & has
        columns.append(F.when(has, matches(text, pattern)).otherwise(none).alias(f"_{kind}"))
    found = found.select("*", *columns)
    some = sum((F.size(f"_{kind}") for kind in PATTERNS), F.lit(0)) > 0
    found = found.withColumn("_pieces", F.when(some, F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))).otherwise(F.array().cast("array<string>")))
    return found.select("_row.*", _let(F.col("_pieces"), lambda pieces: F.concat(*[_scored(kind, pieces, F.col(f"_{kind}")) for kind in PATTERNS])).alias("spans"))


def _scored(kind: str, pieces: Column, spans: Column) -> Column:
    """The confirmed spans of a kind with their scores; of a further kind, those with LEAST_SCORE."""
    good = F.filter(spans, lambda s: confirmed(kind, pieces, s))
    out = F.transform(good, lambda s: F.struct(F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), score(kind, pieces, s).alias("score")))
    return out if kind in BASE else F.filter(out, lambda s: s["score"] >= LEAST_SCORE)


def span_text(spans: Column) -> Column:
    """kind:start:end of the spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
