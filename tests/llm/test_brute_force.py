"""Registered queries without SQL against plain, slow versions of their contracts."""

import hashlib
import re
import zlib

import numpy as np
import xxhash

from relload.llm import queries


def held(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 4 == 2


def test_op1_recall_and_scores(spark, sf, table):
    rows = table("embeddings").toPandas()
    ids = rows["vec_id"].to_numpy()
    x = np.stack(rows["embedding"]).astype(float)
    found = queries.op1_hilbert_neighbours(spark, sf).toPandas()
    at = {v: i for i, v in enumerate(ids)}
    hit = total = 0
    for q, g in found.groupby("query_id"):
        g = g.sort_values("rank")
        score = x @ x[at[q]]
        order = [int(i) for i in np.lexsort((ids, -np.round(score, 12))) if ids[i] != q][:20]
        hit += len(set(ids[order]) & set(g["vec_id"]))
        total += 20
        assert list(g["rank"]) == list(range(1, 21)) and q not in set(g["vec_id"])
        np.testing.assert_allclose(g["score"], score[[at[v] for v in g["vec_id"]]], atol=1e-12)
        assert all(np.diff(g["score"]) <= 0)
    assert sorted(found["query_id"].unique()) == sorted(i for i in ids if i % 20 == 0)
    assert hit / total >= 0.9


def plain_simhash(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    grams = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    h = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in h) > len(h))


def test_op2_components(spark, sf, table):
    docs = [(r.doc_id, r.text) for r in table("documents").select("doc_id", "text").collect()]
    fp = {d: plain_simhash(t) for d, t in docs}
    ids = sorted(fp)
    v = np.array([fp[d] for d in ids], np.uint64)
    root = {d: d for d in ids}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    for i, d in enumerate(ids):
        near = np.flatnonzero(np.bitwise_count(v ^ v[i]) <= 2)
        for j in near[near < i]:
            a, b = find(d), find(ids[j])
            root[max(a, b)] = min(a, b)
    want = {d: (f"{fp[d]:016x}", find(d)) for d in ids}
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in queries.op2_simhash_components(spark, sf).collect()}
    assert got == want


def plain_strip(texts, n=200):
    data = [(t or "").encode() for t in texts]
    seen = {}
    for d in data:
        for i in range(len(d) - n + 1):
            w = d[i : i + n]
            seen[w] = seen.get(w, 0) + 1
    out = []
    for d in data:
        gone = bytearray(len(d))
        for i in range(len(d) - n + 1):
            if seen[d[i : i + n]] > 1:
                gone[i : i + n] = b"\1" * n
        runs = len(re.findall(rb"\x01+", bytes(gone)))
        out.append((len(d), sum(gone), runs, hashlib.sha256(bytes(c for c, g in zip(d, gone) if not g)).hexdigest()))
    return out


def test_op6_removed_bytes(spark, sf, table):
    docs = table("documents").select("doc_id", "text").collect()
    want = dict(zip((r.doc_id for r in docs), plain_strip([r.text for r in docs])))
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in queries.op6_repeated_passages(spark, sf).collect()}
    assert got == want
    assert sum(w[1] for w in want.values()) > 0


def test_op4_held_out_accuracy(spark, sf, table):
    docs = {r.doc_id: r for r in table("documents").collect()}
    out = queries.op4_language(spark, sf).collect()
    assert {r.doc_id for r in out} == set(docs) and all(r.held_out == held(r.doc_id) for r in out)
    assert all(0 <= r.score <= 1 for r in out)
    test = [r for r in out if r.held_out]
    assert sum(r.lang_pred == docs[r.doc_id].lang for r in test) / len(test) > 0.9


def test_op9_held_out_accuracy(spark):
    """At sf0.1: the smaller tables label too few toxic texts of each language."""
    sf = "/root/testdata/sf0.1"
    table = lambda name: spark.read.parquet(f"{sf}/{name}.parquet")
    labels = {r.doc_id: r.toxic for r in table("labels").collect()}
    out = queries.op9_toxicity(spark, sf).collect()
    assert len(out) == table("documents").count() and all(0 <= r.score <= 1 for r in out)
    assert all(r.predicted == (r.score >= 0.3) for r in out)
    test = [(labels[r.doc_id], r.predicted) for r in out if r.held_out and r.doc_id in labels]
    hit = sum(1 for y, p in test if y and p)
    assert hit >= 0.9 * sum(y for y, _ in test)
    assert sum(1 for y, p in test if p and not y) <= 0.03 * len(test)


def test_op7_finds_the_planted_notices(spark, sf, table):
    names = {
        "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0 notice",
        "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0 notice",
        "Licensed under the Apache License, Version 2.0.": "Apache-2.0 notice",
        "Released under the MIT License.": "MIT notice",
    }
    want = sorted(
        (r.doc_id, names[line]) for r in table("documents").collect() for line in (r.text or "").split("\n") if line in names
    )
    got = sorted((r.doc_id, r.license) for r in queries.op7_licenses(spark, sf).collect() if r.exact)
    assert got == want and want
