"""Toxicity by a weighted finite-state pattern grammar.

Words become symbols: insult, target, negation, report, intent, harm, or a gap of
words that say nothing. Four small transducers read a clause's symbols: negation
and target reach as far as the next gap, a report holds to the clause's end, and a
threat needs intent, harm and target in that order. Their composition is one
deterministic transducer, whose output at an insult or a completed threat is the
kind of match: negated or not, reported or not, aimed at somebody or not. A text's
score comes from the weights of its matches by kind, not from single words.

Insult arcs are word stems. The fixed ones below have a prior weight; the others
are learned: prefixes of words that far more toxic than clean labelled documents
hold, weighted by their log odds. One stem is chosen of each chain of prefixes. The
weights of the kinds are a logistic fit whose prior says that negation and report
take weight away. Stems and weights are learned on different halves of the sample.
"""

from __future__ import annotations

import itertools
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from .base import LOWER, Words, _base, _byte_values, _powers, blocks, cut, prepare, ranged_hash, splitmix, text_buffers, text_key

# Words of the grammar's closed classes (English, German, French, Spanish), A-Z lower-cased.
TARGETS = "you your yours yourself you're u ur he she they them him his her their those these everyone all people du dich dir dein deine ihr euch euer sie er tu toi te vous votre ton ta il elle ils elles tú ti usted ustedes vosotros él ella ellos ellas".split()
NEGATIONS = "not no never neither nor don't doesn't didn't isn't aren't wasn't weren't won't can't cannot nobody nicht kein keine keinen keiner nie niemals ne pas jamais aucun aucune ni nunca jamás nadie ningún ninguna".split()
REPORTS = "said says saying called calls wrote writes quoted quotes quote claimed claims reported reports alleged sagte sagt nannte nennt schrieb schreibt zitiert behauptet dit disait appelé écrit cité déclaré dijo dice llamó escribió citó afirmó".split()
INTENTS = "will shall i'll we'll gonna going want must should let's werde werden wird muss soll vais va allons voy vamos va quiero".split()
HARMS = "kill hurt beat burn shoot stab destroy murder hang smash strangle töten umbringen schlagen verbrennen erschießen tuer frapper brûler détruire matar golpear quemar destruir".split()
INSULTS = "idiot idiots moron morons loser losers stupid scum trash garbage clown clowns pathetic worthless disgusting dumb dumbass imbecile filth vermin parasite cretin idioten dumm dummkopf abschaum müll wertlos widerlich erbärmlich versager imbécile crétin stupide ordure déchet minable dégoûtant estúpido idiota basura escoria imbécil patético asqueroso inútil".split()

FAR, TARGET, NEGATION, REPORT, INTENT, HARM, INSULT = range(7)
CLOSED = ((TARGETS, TARGET), (NEGATIONS, NEGATION), (REPORTS, REPORT), (INTENTS, INTENT), (HARMS, HARM))
#: Words between two symbols that make a gap.
SPAN = 6
#: Events of a clause that one lane reads.
LANE = 64
#: Kinds of match: 4 * negated + 2 * reported + aimed for insults, then 8 + 2 * negated + reported for threats.
KINDS = 12
#: Weight of a fixed insult that the sample says nothing about, and of a threat.
SEED_WEIGHT = 3.0
THREAT_WEIGHT = 4.0
#: Bytes of the shortest and longest prefixes that may become stems, documents that must hold one, least log odds, most stems.
SHORTEST, LONGEST, SUPPORT, LEAST_ODDS, MOST_STEMS = 3, 14, 4, 1.5, 8192
#: The hash of a word ends with this byte, which no text has; prefixes don't have it.
END = 0xFF


def _negation(state, symbol):
    return {NEGATION: 1, FAR: 0, INSULT: 0}.get(symbol, state)


def _reported(state, symbol):
    return 1 if symbol == REPORT else state


def _aimed(state, symbol):
    return {TARGET: 1, FAR: 0}.get(symbol, state)


def _threat(state, symbol):
    """0 nothing, 1 intent, 2 intent and harm."""
    if symbol in (FAR, TARGET):
        return 0 if symbol == FAR or state == 2 else state
    return {INTENT: max(state, 1), HARM: 2 if state else 0}.get(symbol, state)


def compose() -> tuple[np.ndarray, np.ndarray]:
    """The product of the four transducers: next state and kind of match (-1: none), by state and symbol. State 0 is the start."""
    states = list(itertools.product(range(2), range(2), range(2), range(3)))
    number = {s: i for i, s in enumerate(states)}
    after = np.zeros((len(states), 7), dtype=np.int64)
    kind = np.full((len(states), 7), -1, dtype=np.int64)
    for s, i in number.items():
        for x in range(7):
            after[i, x] = number[tuple(f(v, x) for f, v in zip((_negation, _reported, _aimed, _threat), s, strict=True))]
        kind[i, INSULT] = 4 * s[0] + 2 * s[1] + s[2]
        if s[3] == 2:
            kind[i, TARGET] = 8 + 2 * s[0] + s[1]
    return after, kind


NEXT, KIND = compose()


def prior() -> np.ndarray:
    """Weights of the kinds before anything is learned, then of the text's length."""
    out = np.ones(KINDS + 1)
    for k in range(8):
        out[k] = 1.6 * (0.15 if k & 4 else 1) * (0.4 if k & 2 else 1) * (1.2 if k & 1 else 1)
    for k in range(8, 12):
        out[k] = 1.6 * (0.15 if k & 2 else 1) * (0.4 if k & 1 else 1)
    out[KINDS] = -0.2
    return out


def match_kinds(symbols: np.ndarray, clause: np.ndarray, lane: int = LANE) -> np.ndarray:
    """The kind of match at each event (-1: none); events of a clause follow each other.

    All clauses are read side by side. Long ones are cut into lanes, read from every state, and the lanes' results stitched."""
    out = np.full(len(symbols), -1, dtype=np.int64)
    if not len(symbols):
        return out
    begin = np.flatnonzero(np.r_[True, clause[1:] != clause[:-1]])
    n = np.diff(np.r_[begin, len(symbols)])
    chunks = -(-n // lane)
    owner = np.repeat(np.arange(len(n)), chunks)
    number = np.arange(len(owner)) - np.repeat(np.cumsum(chunks) - chunks, chunks)
    start = begin[owner] + number * lane
    end = np.minimum(start + lane, begin[owner] + n[owner])
    entry = np.zeros(len(owner), dtype=np.int64)
    later = np.flatnonzero(number)
    if len(later):
        exits = np.tile(np.arange(len(NEXT)), (len(owner), 1))
        for t in range(lane):
            live = np.flatnonzero(start + t < end)
            exits[live] = NEXT[exits[live], symbols[start[live] + t][:, None]]
        for c in later:
            entry[c] = exits[c - 1, entry[c - 1]]
    state = entry
    for t in range(int((end - start).max())):
        live = np.flatnonzero(start + t < end)
        symbol = symbols[start[live] + t]
        out[start[live] + t] = KIND[state[live], symbol]
        state[live] = NEXT[state[live], symbol]
    return out


class Tokens:
    """Words of a block of texts: runs of letters, digits and inner apostrophes, A-Z lower-cased; with their clauses and the hashes of their prefixes."""

    _LETTER = np.zeros(256, dtype=bool)
    _LETTER[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True
    _ENDS = np.zeros(256, dtype=bool)
    _ENDS[[ord(c) for c in ".!?;\n"]] = True

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        at = int(offsets[0])
        self.data = data = LOWER[data[at:int(offsets[-1])]]
        self.offsets = offsets = offsets - at
        n = len(data)
        letter = self._LETTER[data]
        if n > 2:
            letter[1:-1] |= (data[1:-1] == 39) & letter[:-2] & self._LETTER[data[2:]]
        edge = np.zeros(n + 1, dtype=bool)
        edge[offsets] = True
        before, after = np.zeros(n, dtype=bool), np.zeros(n, dtype=bool)
        before[1:], after[:-1] = letter[:-1], letter[1:]
        self.starts = np.flatnonzero(letter & ~(before & ~edge[:n]))
        self.ends = np.flatnonzero(letter & ~(after & ~edge[1:])) + 1
        self.doc = np.searchsorted(offsets, self.starts, side="right") - 1
        stops = np.cumsum(self._ENDS[data])
        # a document ends a clause too
        self.clause = (stops[self.starts] if n else self.starts) + self.doc
        self.sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(_byte_values(0)[data] * _powers(0, False, n), out=self.sums[1:])
        self.inverse = _powers(0, True, n + 1)

    def prefixes(self, words: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        """(those of the words that have a prefix of that many bytes ending between characters, its hashes)."""
        words = words[self.ends[words] - self.starts[words] >= length]
        stop = self.starts[words] + length
        inside = stop < self.ends[words]
        cuts = inside & ((self.data[np.minimum(stop, len(self.data) - 1)] & 0xC0) == 0x80)
        words = words[~cuts]
        return words, self._hash(self.starts[words], length, 0)

    def whole(self, words: np.ndarray) -> np.ndarray:
        return self._hash(self.starts[words], self.ends[words] - self.starts[words], END)

    def _hash(self, start, length, end: int) -> np.ndarray:
        return _mixed((self.sums[start + length] - self.sums[start]) * self.inverse[start], length, end)


def _mixed(value: np.ndarray, length, end: int) -> np.ndarray:
    return splitmix(value + (np.asarray(length).astype(np.uint64) << np.uint64(8)) + np.uint64(end))


def word_hash(word: bytes, end: int) -> int:
    """The hash of a word (end: END) or prefix (end: 0), as Tokens has it."""
    values = _byte_values(0)[np.frombuffer(word, dtype=np.uint8)]
    powers = np.array([pow(_base(0), i, 1 << 64) for i in range(len(word))], dtype=np.uint64)
    return int(_mixed((values * powers).sum(dtype=np.uint64, keepdims=True), len(word), end)[0])


@dataclass
class Lexicon:
    """Words and stems by hash. closed: (sorted hashes, symbols) of whole words; insults: whole words with weights; stems: by length, sorted hashes and weights."""

    closed: tuple[np.ndarray, np.ndarray]
    insults: tuple[np.ndarray, np.ndarray]
    stems: dict[int, tuple[np.ndarray, np.ndarray]]
    texts: dict[str, float]


def _sorted(pairs: dict[int, float], kind) -> tuple[np.ndarray, np.ndarray]:
    keys = np.array(sorted(pairs), dtype=np.uint64)
    return keys, np.array([pairs[int(k)] for k in keys], dtype=kind)


def _lookup(table: tuple[np.ndarray, np.ndarray], keys: np.ndarray, none):
    names, values = table
    if not len(names) or not len(keys):
        return np.full(len(keys), none)
    at = np.minimum(np.searchsorted(names, keys), len(names) - 1)
    return np.where(names[at] == keys, values[at], none)


def lexicon(stems: dict[str, float]) -> Lexicon:
    """The fixed words and the learned stems with their weights."""
    closed = {}
    for words, symbol in CLOSED:
        for w in words:
            closed.setdefault(word_hash(w.encode(), END), symbol)
    by_length: dict[int, dict[int, float]] = {}
    for stem, weight in stems.items():
        raw = stem.encode()
        by_length.setdefault(len(raw), {})[word_hash(raw, 0)] = weight
    seeds = {word_hash(w.encode(), END): SEED_WEIGHT for w in INSULTS}
    return Lexicon(_sorted(closed, np.int64), _sorted(seeds, np.float64), {n: _sorted(x, np.float64) for n, x in by_length.items()}, stems)


def features(tokens: Tokens, grammar: Lexicon) -> np.ndarray:
    """documents x (kinds + 1): logarithms of 1 + the summed weights of the matches by kind, and of 1 + the number of words."""
    docs = len(tokens.offsets) - 1
    out = np.zeros((docs, KINDS + 1))
    words = np.arange(len(tokens.starts))
    out[:, KINDS] = np.log1p(np.bincount(tokens.doc, minlength=docs))
    if not len(words):
        return out
    weight = np.zeros(len(words))
    for length, table in grammar.stems.items():
        some, keys = tokens.prefixes(words, length)
        weight[some] = np.maximum(weight[some], _lookup(table, keys, 0.0))
    whole = tokens.whole(words)
    weight = np.where(weight > 0, weight, _lookup(grammar.insults, whole, 0.0))
    symbol = np.where(weight > 0, INSULT, _lookup(grammar.closed, whole, -1).astype(np.int64))
    # only clauses with an insult or harm can match
    clause = np.unique(tokens.clause[(symbol == INSULT) | (symbol == HARM)])
    if not len(clause):
        return out
    at = np.minimum(np.searchsorted(clause, tokens.clause), len(clause) - 1)
    event = np.flatnonzero((symbol >= 0) & (clause[at] == tokens.clause))
    gap = np.flatnonzero((np.diff(event) > SPAN) & (np.diff(tokens.clause[event]) == 0)) + 1
    order = np.argsort(np.concatenate([2 * event, 2 * event[gap] - 1]), kind="stable")
    source = np.concatenate([event, event[gap]])[order]
    symbols = np.concatenate([symbol[event], np.full(len(gap), FAR)])[order]
    kind = match_kinds(symbols, tokens.clause[source])
    hit = kind >= 0
    value = np.where(kind[hit] >= 8, THREAT_WEIGHT, weight[source[hit]])
    cell = tokens.doc[source[hit]] * KINDS + kind[hit]
    out[:, :KINDS] = np.log1p(np.bincount(cell, weights=value, minlength=docs * KINDS).reshape(docs, KINDS))
    return out


@dataclass
class Model:
    grammar: Lexicon
    weights: np.ndarray
    bias: float

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(x @ self.weights + self.bias, -40, 40)))


def _gain(toxic, clean, all_toxic, all_clean):
    """Log-likelihood ratio of a stem's documents (twice the gain over ignoring the label)."""
    def term(a, b):
        return np.where(a > 0, a * np.log(np.maximum(a, 1e-12) / np.maximum(b, 1e-12)), 0.0)
    share = all_toxic / (all_toxic + all_clean)
    held, rest = toxic + clean, all_toxic + all_clean - toxic - clean
    return 2 * (term(toxic, held * share) + term(clean, held * (1 - share)) + term(all_toxic - toxic, rest * share) + term(all_clean - clean, rest * (1 - share)))


def choose_stems(prefixes: list[str], toxic: np.ndarray, clean: np.ndarray, all_toxic: int, all_clean: int, tried: int) -> dict[str, float]:
    """Stems with their log odds: of each chain of prefixes the one of the largest gain, if the gain is above what
    the best of ``tried`` prefixes has by chance. Ties go to the longer prefix."""
    if not len(prefixes) or not all_toxic or not all_clean:
        return {}
    odds = np.log((toxic + 0.5) / (all_toxic + 1)) - np.log((clean + 0.5) / (all_clean + 1))
    gain = _gain(toxic, clean, all_toxic, all_clean)
    good = np.flatnonzero((gain > 2 * np.log(max(tried, 2))) & (odds >= LEAST_ODDS) & (toxic >= SUPPORT))
    ranked = sorted(good.tolist(), key=lambda i: (-round(float(gain[i]), 9), -len(prefixes[i]), prefixes[i]))
    taken: dict[str, float] = {}
    above: set[str] = set()
    for i in ranked:
        p = prefixes[i]
        if p in above or any(p[:k] in taken for k in range(1, len(p))):
            continue
        taken[p] = float(odds[i])
        above.update(p[:k] for k in range(1, len(p)))
        if len(taken) == MOST_STEMS:
            break
    return taken


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 2.0) -> tuple[np.ndarray, float]:
    """Weights and bias by Newton steps; the weights are drawn to the prior."""
    mean = np.r_[prior(), -3.0]
    penalty = np.r_[np.full(len(mean) - 1, ridge), 1e-3]
    z = np.c_[x, np.ones(len(x))]
    w = mean.copy()

    def loss(w):
        t = z @ w
        return float((weight * (np.logaddexp(0, t) - y * t)).sum() + (penalty * (w - mean) ** 2).sum() / 2)

    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -40, 40)))
        gradient = z.T @ (weight * (p - y)) + penalty * (w - mean)
        step = np.linalg.solve((z * (weight * p * (1 - p))[:, None]).T @ z + np.diag(penalty), gradient)
        size, here = 1.0, loss(w)
        while size > 1e-6 and loss(w - size * step) > here:
            size /= 2
        w = w - size * step
        if np.abs(size * step).max() < 1e-8:
            break
    return w[:-1], float(w[-1])


_COUNTS = "prefix string, toxic0 long, clean0 long, toxic1 long, clean1 long"


#: Words of the shingles by which copies in the sample are told.
COPY_WORDS = 8


def copy_keys(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """documents x 2: the least hash, in two orders, of each text's shingles (of all its words where it has fewer): near copies mostly agree in one."""
    w = Words(data, offsets, lower=True)
    word = w.hashes(0)
    last = np.minimum(np.arange(len(word)) + COPY_WORDS, np.repeat(w.first[1:], w.count))
    keep = (last - np.arange(len(word)) == COPY_WORDS) | (np.arange(len(word)) == np.repeat(w.first[:-1], w.count))
    shingle = ranged_hash(word, np.flatnonzero(keep), last[keep], 1)
    first = np.concatenate([[0], np.cumsum(keep)])[w.first]
    out = np.zeros((len(w.count), 2), dtype=np.uint64)
    some = np.flatnonzero(np.diff(first))
    for order in range(2):
        if len(some):
            out[some, order] = np.minimum.reduceat(splitmix(shingle + np.uint64(order)), first[some])
    return out.view(np.int64)


def _copy_keys(batches):
    for batch in batches:
        data, off = text_buffers(batch.column("text"))
        for lo, hi in blocks(off):
            keys = copy_keys(data, off[lo:hi + 1])
            names = batch.schema.names
            yield pa.RecordBatch.from_arrays([*(batch.column(n).slice(lo, hi - lo) for n in names), pa.array(keys[:, 0]), pa.array(keys[:, 1])], [*names, "copy0", "copy1"])


def _count_prefixes(batches):
    """Documents that hold each prefix, by label and half of the sample, summed over a batch."""
    for batch in batches:
        data, off = text_buffers(batch.column("text"))
        column = 2 * batch.column("half").to_numpy() + (1 - batch.column("label").to_numpy())
        for lo, hi in blocks(off):
            t = Tokens(data, off[lo:hi + 1])
            keys, docs, words, sizes = [], [], [], []
            for length in range(SHORTEST, LONGEST + 1):
                some, key = t.prefixes(np.arange(len(t.starts)), length)
                keys.append(key)
                docs.append(t.doc[some])
                words.append(some)
                sizes.append(np.full(len(some), length))
            key, doc, word, length = (np.concatenate(x) for x in (keys, docs, words, sizes))
            if not len(key):
                continue
            order = np.lexsort((doc, key))
            key, doc = key[order], doc[order]
            new = np.r_[True, (key[1:] != key[:-1]) | (doc[1:] != doc[:-1])]
            order, key, doc = order[new], key[new], doc[new]
            first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
            group = np.repeat(np.arange(len(first)), np.diff(np.r_[first, len(key)]))
            count = np.bincount(4 * group + column[lo:hi][doc], minlength=4 * len(first)).reshape(-1, 4)
            at, size = t.starts[word[order[first]]], length[order[first]]
            raw = t.data.tobytes()
            names = pa.array([raw[a:a + n].decode("utf-8", "replace") for a, n in zip(at.tolist(), size.tolist(), strict=True)], pa.string())
            yield pa.RecordBatch.from_arrays([names, *(pa.array(count[:, i]) for i in range(4))], ["prefix", "toxic0", "clean0", "toxic1", "clean1"])


def _crossed(batches, grammars):
    """Features of labelled texts under the grammar that the other half taught."""
    for batch in batches:
        data, off = text_buffers(batch.column("text"))
        half = batch.column("half").to_numpy()
        for lo, hi in blocks(off):
            t = Tokens(data, off[lo:hi + 1])
            x = np.where(half[lo:hi, None] == 0, features(t, grammars.value[1]), features(t, grammars.value[0]))
            yield pa.RecordBatch.from_arrays([batch.column("label").slice(lo, hi - lo), pa.array(list(x), pa.list_(pa.float64()))], ["label", "x"])


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", sample: int = 8000) -> Model:
    """Learn stems and weights from at most ``sample`` labelled documents of each label (0 and 1), the first by a hash of their id.

    labels has doc_id and the label. Rows with a null id or label are ignored; an id with both labels counts as
    1. Of the rows of one id, the text with the smallest digest is learned from, and of near copies that of the smallest id. The caller keeps held-out rows out of labels."""
    spark = prepare(docs.sparkSession)
    known = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull()).groupBy(F.col("doc_id").alias("doc_id")).agg(F.max((F.col(label).cast("double") > 0.5).cast("int")).alias("label"))
    known = known.withColumn("turn", F.pmod(F.xxhash64("doc_id", F.lit(23)), F.lit(1 << 40)))
    total = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    parts = []
    for value, n in sorted(total.items()):
        # the filter leaves somewhat more than the sample, the limit cuts it
        share = min(1.0, 1.1 * sample / n + 1000 / n)
        parts.append(known.where((F.col("label") == value) & (F.col("turn") <= int(share * (1 << 40)))).orderBy("turn", "doc_id").limit(sample))
    if not parts:
        return Model(lexicon({}), prior(), -3.0)
    chosen = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    chosen = cut(chosen.select("doc_id", "label", (F.col("turn") % 2).cast("int").alias("half")))  # at most 2 * sample rows: small enough to broadcast
    wanted = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    texts = wanted.groupBy("doc_id", "label", "half").agg(F.min(F.struct(text_key("text").alias("digest"), "text")).alias("first")).select("doc_id", "label", "half", F.col("first.text").alias("text"))
    # a stem is what many texts say, not copies of one: of near copies the smallest id teaches
    texts = texts.mapInArrow(_copy_keys, StructType([*texts.schema.fields]).add("copy0", "long").add("copy1", "long"))
    for key in ("copy0", "copy1"):
        texts = texts.groupBy("label", key).agg(F.min(F.struct(*[c for c in ("doc_id", "half", "text", "copy0", "copy1") if c != key])).alias("first")).select("label", key, "first.*")
    texts = cut(texts.select("label", "half", "text"))
    size = {(r["label"], r["half"]): r["n"] for r in texts.groupBy("label", "half").agg(F.count("*").alias("n")).collect()}
    sums = texts.mapInArrow(_count_prefixes, _COUNTS).groupBy("prefix").agg(*[F.sum(c).alias(c) for c in ("toxic0", "clean0", "toxic1", "clean1")])
    sums = cut(sums.where(F.col("toxic0") + F.col("clean0") + F.col("toxic1") + F.col("clean1") >= SUPPORT))
    tried = sums.count()
    # candidates: mostly toxic by rate; the driver gets the most frequent of them, several times what can be chosen
    t, c = F.col("toxic0") + F.col("toxic1"), F.col("clean0") + F.col("clean1")
    n1, n0 = size.get((1, 0), 0) + size.get((1, 1), 0), size.get((0, 0), 0) + size.get((0, 1), 0)
    rate = (t + 0.5) / (n1 + 1) / ((c + 0.5) / (n0 + 1))
    some = sums.where((t >= SUPPORT / 2) & (rate >= 2)).orderBy((t - c * (n1 + 1.0) / (n0 + 1.0)).desc(), "prefix").limit(16 * MOST_STEMS).toPandas()
    names = some["prefix"].tolist()
    toxic, clean = some[["toxic0", "toxic1"]].to_numpy(dtype=np.float64), some[["clean0", "clean1"]].to_numpy(dtype=np.float64)
    halves = [lexicon(choose_stems(names, toxic[:, h], clean[:, h], size.get((1, h), 0), size.get((0, h), 0), tried)) for h in (0, 1)]
    grammar = lexicon(choose_stems(names, toxic.sum(axis=1), clean.sum(axis=1), n1, n0, tried))
    rows = texts.mapInArrow(partial(_crossed, grammars=spark.sparkContext.broadcast(halves)), "label int, x array<double>").toPandas()  # at most 2 * sample rows
    if not n1 or not n0:
        return Model(grammar, prior(), -3.0)
    y = rows["label"].to_numpy(dtype=np.float64)
    x = np.array(rows["x"].tolist())
    order = np.lexsort((*x.T, y))  # sums don't depend on the order of arrival
    x, y = x[order], y[order]
    # each label weighs as in all labelled rows
    weight = np.where(y == 1, total[1] / n1, total[0] / n0)
    weights, bias = logistic(x, y, weight / weight.mean())
    return Model(grammar, weights, bias)


def _scored(batches, model):
    for batch in batches:
        data, off = text_buffers(batch.column("text"))
        parts = [model.value.score(features(Tokens(data, off[lo:hi + 1]), model.value.grammar)) for lo, hi in blocks(off)]
        names = [n for n in batch.schema.names if n != "text"]
        yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(np.concatenate(parts) if parts else np.zeros(0))], [*names, "score"])


def score_toxicity(docs: DataFrame, model: Model) -> DataFrame:
    """One row per document: doc_id and score (0 to 1, higher: label 1 likelier) of the whole text. Nothing is shuffled.

    Null, empty and wordless texts have the score of a text without matches. Equal texts get equal scores; only doc_id and text are read."""
    spark = prepare(docs.sparkSession)
    rows = docs.select("doc_id", "text")
    kind = StructType([rows.schema["doc_id"], StructField("score", DoubleType())])
    return rows.mapInArrow(partial(_scored, model=spark.sparkContext.broadcast(model)), kind)
