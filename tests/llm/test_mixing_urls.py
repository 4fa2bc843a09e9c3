import re

import pytest
from llm_data import clashing, documents, nothing, odd, prose  # noqa: F401

from foldwise.llm.mixing import mix_sources
from foldwise.llm.url_filter import DigestArray, filter_urls

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def targets_by_hand(sizes, weights):
    """Share by weight, cap at three times the size, share the excess again."""
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    capped = set()
    while True:
        left = sum(sizes.values()) - sum(3 * sizes[s] for s in capped)
        total = sum(weight[s] for s in order if s not in capped)
        above = {s for s in order if s not in capped and left * weight[s] > 3 * sizes[s] * total}
        if not above:
            return {s: 3 * sizes[s] if s in capped else left * weight[s] / total for s in order}
        capped |= above


def test_budgets_are_met_exactly(spark):
    sources = ["tiny", "big", "big", "mid", None, "a"]
    texts = [prose(7 + 11 * i, i) for i in range(120)]
    src = [sources[i % 6] if i % 6 or i < 12 else "big" for i in range(120)]
    docs = documents(spark, texts, sources=src)
    rows = mix_sources(docs).collect()
    sizes = {}
    for t, s in zip(texts, src, strict=True):
        sizes[s] = sizes.get(s, 0) + len(WORD.findall(t))
    want = targets_by_hand(sizes, (1, 2, 3))
    for s in sizes:
        mine = [r for r in rows if r.source == s]
        assert len({r.target for r in mine}) == 1 and mine[0].target == pytest.approx(want[s])
        assert sum(r.taken for r in mine) == int(want[s] + 0.5)
        assert all(r.taken <= 3 * r.size and r.source_size == sizes[s] for r in mine)
        # whole epochs differ by one at most, and one document at most is cut
        assert sum(0 < r.extra_words < r.size for r in mine) <= 1
    assert len(rows) == 120
    again = mix_sources(docs.repartition(5)).collect()
    assert sorted((r.doc_id, r.taken) for r in rows) == sorted((r.doc_id, r.taken) for r in again)


def test_mixing_odd_rows(spark, odd, nothing, clashing):
    rows = mix_sources(odd).collect()
    assert len(rows) == odd.count()
    assert all(r.taken == 0 for r in rows if r.size == 0)
    plain = sorted(map(str, rows))
    assert sorted(map(str, mix_sources(clashing(odd)).collect())) == plain
    assert mix_sources(nothing).count() == 0
    blank = documents(spark, ["", None, " "])
    assert [(r.target, r.taken) for r in mix_sources(blank).collect()] == [(0.0, 0)] * 3


RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"), ("deep.example.com", "", "block"), (None, "/x", "block")]


def by_hand(url, rules, default):
    m = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (m[1], m[2]) if m else ("", "")
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h + (p or "")), len(h), h + (p or ""), v) for h, p, v in rules if h and (host == h or host.endswith("." + h)) and path.startswith(p or "")]
    rule, verdict = max(fits)[2:] if fits else (None, default)
    return host, path, rule, verdict


@pytest.mark.parametrize("bound", [1 << 30, 0])
def test_urls_against_hand(spark, bound):
    urls = ["https://A.Example.NET/en/1", "http://example.net", "http://example.net/", "x://net/", "http://notnet/", "http://internet.org/fr/a?x#y", "http://q.org?/fr/", "ftp://a://b.net/c",
            None, "", "no scheme", "://", "http://ÄÖ.example.com/de/ü", "http://deep.example.com#frag", "http://x.deep.example.com/de/", "http://example.com/d", "http://a.net/\nb", "http://net:80/"] * 2
    pages = spark.createDataFrame([(i if i % 5 else None, u, "h") for i, u in enumerate(urls)], "page_id long, url string, host string")
    rules = RULES if bound else spark.createDataFrame(RULES, "host string, path string, verdict string")
    got = filter_urls(pages, rules, default="allow", max_file_bytes=bound).collect()
    want = [(i if i % 5 else None, *by_hand(u, RULES, "allow")) for i, u in enumerate(urls)]
    assert sorted(map(str, ((r.page_id, r.host, r.path, r.rule, r.verdict) for r in got))) == sorted(map(str, want))


def test_urls_empty_tables(spark):
    pages = spark.createDataFrame([], "page_id long, url string")
    assert filter_urls(pages, RULES).count() == 0
    one = spark.createDataFrame([(1, "http://a.net/")], "page_id long, url string")
    assert filter_urls(one, [], default="block").first().verdict == "block"


def test_digest_array_tells_collisions_apart(monkeypatch):
    import numpy as np

    from foldwise.llm import url_filter
    monkeypatch.setattr(url_filter, "digest", lambda keys: np.array([7 for _ in keys], dtype=np.uint64))
    table = DigestArray(*DigestArray.arrays({b"one": 1, b"two": 2}))
    assert table.find([b"two", b"one", b"three"]).tolist() == [2, 1, -1]


@pytest.mark.parametrize("bound", [1 << 30, 0])
def test_repeated_and_unknown_rules_on_both_paths(spark, bound):
    pages = spark.createDataFrame([(1, "http://A.com/x"), (2, "http://ä.com/x"), (3, "http://b.com/")], "page_id long, url string")
    rules = [("a.com", "/x", "block"), ("A.COM", "/x", "allow"), ("Ä.com", "", "block"), ("b.com", None, "allow"), ("b.com", "", "allow"), (None, "", "odd")]
    kind = "host string, path string, verdict string"
    for order in (rules, rules[::-1]):
        got = filter_urls(pages, spark.createDataFrame(order, kind), default="allow", max_file_bytes=bound)
        assert {r.page_id: (r.rule, r.verdict) for r in got.collect()} == {1: ("a.com/x", "block"), 2: (None, "allow"), 3: ("b.com", "allow")}
    with pytest.raises(ValueError, match="review"):
        filter_urls(pages, spark.createDataFrame([("a.com", "/x", "review")], kind), max_file_bytes=bound)
    long = spark.createDataFrame([(1, "http://" + "a." * 3000 + "com/" + "x" * 200_000)], "page_id long, url string")
    assert filter_urls(long, spark.createDataFrame([("com", "/" + "x" * 1000, "block")], kind), max_file_bytes=bound).first().verdict == "block"
