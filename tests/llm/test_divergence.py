"""Divergence audit against plain counting, and skybands against all pairs."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from relload.llm import divergence

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def _lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def plain(rows, min_docs, top):
    docs = [(lang or "", source or "", TERM.findall(_lower(text or ""))) for lang, source, text in rows]
    out = set()
    for lang in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == lang]
        of = Counter(t for d in mine for t in set(d[2]))
        kept = {t for t, n in of.items() if n >= min_docs}
        whole = Counter(t for d in mine for t in d[2] if t in kept)
        groups = defaultdict(Counter)
        for _, source, terms in mine:
            groups[source].update(t for t in terms if t in kept)
        share = lambda c: {t: 1 + 10**9 * (c[t] + 2) // (sum(c.values()) + 2 * len(kept)) for t in kept}
        q = share(whole)
        p = {s: share(c) for s, c in groups.items()}
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in groups:
            pairs = sorted(((-sum(f(p[s][t], p[o][t]) for t in kept), o.encode()) for o in groups if o != s))
            out |= {(lang, s, "pair", o.decode(), -v, i + 1) for i, (v, o) in enumerate(pairs)}
            terms = sorted((-f(p[s][t], q[t]), t.encode()) for t in kept if groups[s][t] and p[s][t] > q[t])
            out |= {(lang, s, "term", t.decode(), -v, i + 1) for i, (v, t) in enumerate(terms[:top])}
    return out


def _rows(r, n, langs, sources, words):
    return [
        (r.choice(langs), r.choice(sources), " ".join(r.choice(words) for _ in range(r.randint(0, 30))) if r.random() > 0.05 else None) for _ in range(n)
    ]


@pytest.mark.parametrize("seed", [1, 2])
def test_audit(spark, seed, monkeypatch):
    monkeypatch.setattr(divergence, "BLOCK", 5)
    monkeypatch.setattr(divergence, "ENTRIES", 20)
    monkeypatch.setattr(divergence, "CELLS", 12)
    r = random.Random(seed)
    words = ["Alpha", "alpha", "BÉTA", "bÉta", "don't", "x1y", "日本", "ﬀ", "zz", *(f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(40))]
    rows = _rows(r, 300, ["en", "de", None, "", "xx"], ["s1", "s2", None, "é", "Z"], words) + [("solo", "s1", "alpha " * 30), ("nil", "a", ""), ("nil", "b", None)]
    frame = spark.createDataFrame([(*x, 1, "t") for x in rows], "lang string, source string, text string, rank int, term string")
    got = divergence.audit(frame, min_docs=4, top=3).collect()
    assert len(got) == len(set(map(tuple, got)))
    assert {tuple(x) for x in got} == plain(rows, 4, 3)
    assert ("nil", "a", "pair", "b", 0, 1) in {tuple(x) for x in got}


def test_empty(spark):
    assert divergence.audit(spark.createDataFrame([], "lang string, source string, text string")).count() == 0


@pytest.mark.parametrize("k", [1, 3, 10])
def test_skyband_keeps_what_fewer_than_k_dominate(k):
    r = random.Random(k)
    n = [r.randint(1, 6) for _ in range(400)]
    m = [x + r.randint(0, 6) for x in n]
    terms = [f"{r.randint(0, 99999):05}{i}".encode() for i in range(400)]
    held = divergence.skyband(np.array(n), np.array(m), terms, k)
    beats = lambda a, b: a != b and n[a] >= n[b] and m[a] <= m[b] and terms[a] <= terms[b]
    assert set(held) == {b for b in range(400) if sum(beats(a, b) for a in range(400)) < k}


def test_bands_of_partitions_hold_the_top(spark, monkeypatch):
    monkeypatch.setattr(divergence, "BUFFER", 16)
    monkeypatch.setattr(divergence, "HELD", 64)
    r = random.Random(3)
    rows = [("en", f"s{r.randint(0, 9)}", f"t{i:04}", r.randint(1, 9), 0, 0) for i in range(2000)]
    rows = [(a, b, c, d, d + r.randint(0, 9), 0) for a, b, c, d, _, _ in rows]
    rows = [(a, b, c, d, e, d * 1000 - e) for a, b, c, d, e, _ in rows]  # grows with the count, falls with the language's
    frame = spark.createDataFrame(rows, divergence._BAND).repartition(5)
    got = divergence.partition_bands(frame, 4)
    for s in {x[1] for x in rows}:
        want = sorted((x for x in rows if x[1] == s), key=lambda x: (-x[5], x[2]))[:4]
        band = got.where(F.col("source") == s).collect()
        assert {x[2] for x in want} <= {x.term for x in band} and len({x.term for x in band}) == len(band)


def test_shares_are_exact():
    for c, total in [(0, 1), (5, 7), (10**12, 3 * 10**12 + 1), (2 * 10**15, 9 * 10**15)]:
        if c + 2 <= total:
            assert divergence._share(np.array([c]), np.array([total]))[0] == 1 + 10**9 * (c + 2) // total


def test_long_texts_in_pieces(monkeypatch):
    monkeypatch.setattr(divergence, "PIECE", 10)
    text = b"alpha beta" * 3 + b"x" * 40 + b" gamma"
    assert [t for p in divergence._pieces(text) for t in p.translate(divergence.TERM_BYTES).split()] == text.translate(divergence.TERM_BYTES).split()
