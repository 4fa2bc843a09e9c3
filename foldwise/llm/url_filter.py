"""URL filters: a sorted array of rule digests, memory-mapped by every Python worker.

A rule is (host, path prefix, verdict); it fits its host and all subdomains when
the url's path starts with its path. The rules become one binary file: 64-bit
xxhash digests in ascending order, each with the offsets of its full string in a
blob. Spark ships the file to the executors (``addFile``); workers map it and
probe a whole batch with vectorised binary search, then compare the stored string,
so a digest collision can't decide. Two arrays are probed: rule hosts (which give
the path lengths that occur under a host) and host + path.

The file is only shipped when its size is at most ``max_file_bytes``; a larger
rule table is joined by Spark on the host instead, with the same results.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .base import prepare

HOST = r"^.*?://([^/?#]*)"
PATH = r"^.*?://[^/?#]*([^?#]*)"


def split_url(url: str = "url"):
    """(host, path) columns of a url; both empty for null or without ``://``. A-Z of the host are lower-cased."""
    text = F.coalesce(F.col(url), F.lit(""))
    # (?s): a line break inside a url is a character like any other
    host = F.regexp_extract(text, "(?s)" + HOST, 1)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(host, upper, upper.lower()), F.regexp_extract(text, "(?s)" + PATH, 1)


def digest(texts: Iterable[bytes]) -> np.ndarray:
    return np.fromiter((xxhash.xxh64_intdigest(x) for x in texts), dtype=np.uint64)


class DigestArray:
    """Sorted digests with their strings and a number per entry, over memory-mapped arrays."""

    def __init__(self, digests, ends, values, blob):
        self.digests, self.ends, self.values, self.blob = digests, ends, values, blob

    @staticmethod
    def arrays(entries: dict[bytes, int]) -> list[np.ndarray]:
        keys = list(entries)
        found = digest(keys)
        order = np.argsort(found, kind="stable")
        ends = np.cumsum([0, *(len(keys[i]) for i in order)], dtype=np.int64)
        return [found[order], ends, np.array([entries[keys[i]] for i in order], dtype=np.int64), np.frombuffer(b"".join(keys[i] for i in order), dtype=np.uint8)]

    def find(self, keys: list[bytes]) -> np.ndarray:
        """The value of each key, -1 where it isn't stored."""
        out = np.full(len(keys), -1, dtype=np.int64)
        if not keys or not len(self.digests):
            return out
        probe = digest(keys)
        lo = np.searchsorted(self.digests, probe, side="left")
        hi = np.searchsorted(self.digests, probe, side="right")
        for i in np.flatnonzero(hi > lo):
            for at in range(lo[i], hi[i]):  # more than one only when digests collide
                if self.blob[self.ends[at]:self.ends[at + 1]].tobytes() == keys[i]:
                    out[i] = self.values[at]
                    break
        return out


def write_rules(rules: list[tuple[str, str, str]], folder: str) -> str:
    """The rules' arrays in one file; returns its path. Of rules with equal (host, path), a block counts."""
    last: dict[tuple[str, str], str] = {}
    for h, p, v in rules:
        place = "".join(c.lower() if "A" <= c <= "Z" else c for c in h), p
        last[place] = max(last.get(place, v), v)  # "block" is above "allow"
    hosts: dict[bytes, set[int]] = {}
    for host, path in last:
        hosts.setdefault(host.encode(), set()).add(len(path))
    rows = sorted(hosts)
    lengths = [np.array(sorted(hosts[h]), dtype=np.int64) for h in rows]
    host_arrays = DigestArray.arrays({h: i for i, h in enumerate(rows)})
    rule_arrays = DigestArray.arrays({f"{h}{p}".encode(): int(v == "block") for (h, p), v in last.items()})
    arrays = [*host_arrays, np.cumsum([0, *map(len, lengths)], dtype=np.int64), np.concatenate(lengths) if lengths else np.zeros(0, np.int64), *rule_arrays]
    path = os.path.join(folder, f"url-rules-{uuid.uuid4().hex}.bin")
    with open(path, "wb") as out:
        np.array([len(arrays), *(x.size for x in arrays), *(x.dtype.itemsize for x in arrays)], dtype=np.int64).tofile(out)
        for x in arrays:
            out.write(b"\0" * (-out.tell() % 8))
            x.tofile(out)
    return path


class Rules:
    """The file of write_rules, memory-mapped."""

    def __init__(self, path: str):
        raw = np.memmap(path, dtype=np.uint8, mode="r")
        n = int(raw[:8].view(np.int64)[0])
        head = raw[8:8 + 16 * n].view(np.int64)
        at, arrays = 8 + 16 * n, []
        kinds = [np.uint64, np.int64, np.int64, np.uint8, np.int64, np.int64, np.uint64, np.int64, np.int64, np.uint8]
        for i, kind in enumerate(kinds):
            at += -at % 8
            size = int(head[i] * head[n + i])
            arrays.append(raw[at:at + size].view(kind))
            at += size
        self.hosts, self.length_ends, self.lengths, self.rules = DigestArray(*arrays[:4]), arrays[4], arrays[5], DigestArray(*arrays[6:])

    def judge(self, hosts: list[str], paths: list[str]) -> tuple[list[str | None], list[str | None]]:
        """The longest fitting rule of each url (of equal lengths: the longer host) and its verdict."""
        suffixes, owner = [], []
        for i, host in enumerate(hosts):
            if not paths[i] and not host:
                continue
            labels = host.split(".")
            for k in range(len(labels)):
                suffixes.append(".".join(labels[k:]))
                owner.append(i)
        known = self.hosts.find([s.encode() for s in suffixes])
        keys, back = [], []
        for j in np.flatnonzero(known >= 0):
            row, path = int(known[j]), paths[owner[j]]
            for length in self.lengths[self.length_ends[row]:self.length_ends[row + 1]]:
                if length <= len(path):
                    keys.append(suffixes[j] + path[:length])
                    back.append((owner[j], len(suffixes[j])))
        verdicts = self.rules.find([k.encode() for k in keys])
        best: dict[int, tuple[int, int, str, int]] = {}
        for (i, host_length), key, verdict in zip(back, keys, verdicts.tolist(), strict=True):
            if verdict >= 0 and (i not in best or (len(key), host_length) > best[i][:2]):
                best[i] = (len(key), host_length, key, verdict)
        rule: list[str | None] = [None] * len(hosts)
        verdict_out: list[str | None] = [None] * len(hosts)
        for i, (_, _, key, verdict) in best.items():
            rule[i], verdict_out[i] = key, "block" if verdict else "allow"
        return rule, verdict_out


_MAPPED: dict[str, Rules] = {}


def _mapped(name: str) -> Rules:
    if name not in _MAPPED:
        _MAPPED.clear()
        _MAPPED[name] = Rules(SparkFiles.get(name))
    return _MAPPED[name]


VERDICTS = ("allow", "block")


def _known(verdicts) -> None:
    if unknown := {v for v in verdicts if v not in VERDICTS}:
        raise ValueError(f"verdicts are {VERDICTS}, not {unknown}")


def filter_urls(urls: DataFrame, rules: list[tuple[str, str, str]] | DataFrame, key: str = "page_id", url: str = "url",
                default: str = "allow", max_file_bytes: int = 256 << 20) -> DataFrame:
    """One row per row of urls: key, url, host, path, rule (host + path of the longest fitting rule, else null), verdict.

    Null urls, and urls without ``://``, have an empty host and path; no rule has an
    empty host, so they get the default verdict. Rules with a null or empty host
    are ignored, a null path is an empty one, A-Z of hosts are lower-cased; of rules with the same host and
    path a block counts, and a verdict other than allow or block raises ValueError. Repeated urls and repeated keys are
    judged row by row; no row is dropped. Other columns are not read."""
    spark = prepare(urls.sparkSession)
    host, path = split_url(url)
    parsed = urls.select(F.col(key), F.col(url), host.alias("host"), path.alias("path"))
    if isinstance(rules, DataFrame):
        rules = rules.where(F.length("host") > 0).select("host", "path", "verdict")
        _known(r["verdict"] for r in rules.select("verdict").distinct().limit(len(VERDICTS) + 1).collect())
        size = rules.select(F.sum(F.octet_length("host") + F.octet_length(F.coalesce("path", F.lit(""))) + 64)).first()[0] or 0
        if size > max_file_bytes:
            return _joined(parsed, rules, key, url, default)
        rules = [(r["host"], r["path"] or "", r["verdict"]) for r in rules.select("host", "path", "verdict").toLocalIterator()]
    rules = [(h, p or "", v) for h, p, v in rules if h]
    _known(v for _, _, v in rules)
    # The driver's file is only what addFile ships; executors map their own copy of it.
    file = write_rules(rules, tempfile.mkdtemp(prefix="url-rules-"))
    spark.sparkContext.addFile(file)
    name = os.path.basename(file)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mapped = _mapped(name)
        for batch in batches:
            rule, verdict = mapped.judge(batch.column("host").to_pylist(), batch.column("path").to_pylist())
            verdict = [v or default for v in verdict]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(rule, pa.string()), pa.array(verdict, pa.string())], [*batch.schema.names, "rule", "verdict"])

    kind = StructType([*parsed.schema.fields, StructField("rule", StringType()), StructField("verdict", StringType())])
    return parsed.mapInArrow(judge, kind)


def _joined(parsed: DataFrame, rules: DataFrame, key: str, url: str, default: str) -> DataFrame:
    """The same by a join on the host, for rule tables beyond the size bound: each distinct (host, path) once."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    rules = rules.groupBy(F.translate("host", upper, upper.lower()).alias("_h"), F.coalesce("path", F.lit("")).alias("_p")).agg(F.max("verdict").alias("_v"))
    labels = F.split("host", r"\.")
    places = parsed.select("host", "path").distinct()
    suffixes = places.select("host", "path", F.explode(F.transform(F.sequence(F.lit(1), F.size(labels)), lambda k: F.array_join(F.slice(labels, k, F.size(labels)), "."))).alias("_h"))
    fits = suffixes.join(rules, "_h").where(F.col("path").startswith(F.col("_p")))
    rule = F.concat("_h", "_p")
    best = fits.groupBy("host", "path").agg(F.max_by(F.struct(rule.alias("rule"), F.col("_v").alias("verdict")), F.struct(F.length(rule), F.length("_h"))).alias("_b"))
    return parsed.join(best, ["host", "path"], "left").select(key, url, "host", "path", F.col("_b.rule").alias("rule"), F.coalesce("_b.verdict", F.lit(default)).alias("verdict"))
