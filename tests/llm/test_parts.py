"""Parts of the operators against brute force on made-up small inputs."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from relload.llm import decontam, repeats, simhash
from relload.llm.common import ranked
from relload.llm.components import connected_components
from test_brute_force import plain_strip


def test_components_of_chains_stars_and_rings(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + i) for i in range(1, 80)] + [(200 + i, 200 + (i + 1) % 9) for i in range(9)]
    edges += [(5, 5), (None, 3), (4, None)] + [(b, a) for a, b in edges[:20]]
    rng.shuffle(edges)
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {**{i: 0 for i in range(61)}, **{100 + i: 100 for i in range(80)}, **{200 + i: 200 for i in range(9)}}
    assert got == want


@pytest.mark.parametrize("bits", [0, 1, 2])
def test_close_pairs_equal_all_pairs(spark, bits):
    rng = np.random.default_rng(5)
    base = rng.integers(0, 2**64, 40, dtype=np.uint64)
    values = {int(v) for v in base} | {0}
    for v in base[:20]:
        for _ in range(30):
            flips = rng.choice(64, rng.integers(1, 5), replace=False)
            values.add(int(v) ^ sum(1 << int(f) for f in flips))
    values = np.array(sorted(values), np.uint64)
    want = {
        (int(a), int(b)) for a, b in ((x, y) for x in values.view(np.int64) for y in values.view(np.int64) if x < y)
        if bin((int(a) ^ int(b)) & (2**64 - 1)).count("1") <= bits
    }
    got = [tuple(r) for r in simhash.close_pairs(spark.createDataFrame([(int(v),) for v in values.view(np.int64)], "fp long"), bits).collect()]
    assert len(got) == len(set(got)) and set(got) == want and (bits == 0 or want)


def test_guests_at_anchors_are_not_broadcast_however_few_fingerprints_there_are(spark):
    """Each fingerprint becomes some 68 rows that Spark does not expect."""
    pairs = simhash.close_pairs(spark.range(1000).select(F.xxhash64("id").alias("fp")))
    assert "Broadcast" not in pairs._jdf.queryExecution().executedPlan().toString()


def test_seeds_of_texts_are_not_broadcast_where_the_benchmark_is_too_large(spark, tmpdir_path, monkeypatch):
    plans = {}
    write = lambda df, name: plans.update({name: df._jdf.queryExecution().executedPlan().toString()}) or real(df, name)
    real = decontam.write_table
    monkeypatch.setattr(decontam, "write_table", write)
    monkeypatch.setattr(decontam, "BROADCAST_SEEDS", 0)
    text = " ".join(f"w{i}" for i in range(20))
    spark.createDataFrame([(1, f"a b {text} c"), (2, "none of it")], "doc_id long, text string").write.parquet(f"{tmpdir_path}/docs")
    found = decontam.contaminated(spark.read.parquet(f"{tmpdir_path}/docs"), spark.createDataFrame([(7, text)], "item_id long, text string"))
    assert [(r.doc_id, r.item_id, r.shift, r.matched) for r in found.collect()] == [(1, 7, 2, 13)]
    assert "Broadcast" not in plans["seed-hits"]


def test_every_anchor_lies_within_radius_plus_threshold():
    fps = np.random.default_rng(1).integers(0, 2**63, 300, dtype=np.int64)
    anchor, fp, home = simhash.anchors_within(fps, 2)
    assert home.sum() == len(fps) and len(set(zip(anchor.tolist(), fp.tolist()))) == len(fp)
    words = {}
    for block, shift in enumerate(simhash.BLOCKS):
        part = (anchor >> (12 * (1 - block))) & 0xFFF
        for m in set(part.tolist()):
            if m not in words:
                low = simhash._syndrome(np.array([m << 11]))[0]
                words[m] = (m << 11) ^ int(low)
        code = np.array([words[m] for m in part.tolist()])
        far = np.bitwise_count(((fp.view(np.uint64) >> np.uint64(shift)).astype(np.int64) & 0x7FFFFF) ^ code)
        assert far.max() <= 5 and far[home].max() <= 3


def texts_with_repeats(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdé") for _ in range(rng.randint(1, 6)))
    prose = lambda n: " ".join(word() for _ in range(n))
    shared = [prose(rng.randint(5, 40)) for _ in range(6)]
    out = []
    for _ in range(40):
        out.append(" ".join(rng.choice([prose(rng.randint(1, 30)), rng.choice(shared), rng.choice(shared)[3:-4]]) for _ in range(rng.randint(1, 6))))
    return [*out, out[0], out[1][5:], "ab" * 300, "x" * 400, "x" * 401, "", None]


@pytest.mark.parametrize("length,gram,crowd", [(40, 12, 4000), (40, 12, 2), (33, 8, 1), (64, 63, 4000)])
def test_stripped_bytes_equal_brute_force(spark, length, gram, crowd):
    texts = texts_with_repeats(length + crowd)
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in repeats.strip_repeats(rows, length=length, gram=gram, crowd=crowd).collect()}
    for i, want in enumerate(plain_strip(texts, length)):
        r = got[i]
        assert (r.n_bytes, sum(s.end - s.start for s in r.spans), len(r.spans)) == want[:3]


def test_long_texts_are_cut_alike(monkeypatch, spark):
    texts = texts_with_repeats(9)
    monkeypatch.setattr(repeats, "_CHUNK", 50)
    # the pieces of one text join to the windows of the whole
    for t in texts:
        data = (t or "").encode()
        kh, sh, st, en, at = repeats.segments(data, 40, 12)
        assert [w for a, b in zip(st, en) for w in range(a, b)] == list(range(max(0, len(data) - 39)))


def test_interval_tree_equals_brute_force_maximal_repeats():
    rng = random.Random(2)
    texts = ["".join(rng.choice("ab") for _ in range(60)).encode() for _ in range(4)]
    length = 5
    pieces = [{"file": 1, "pos": i, "kh": 0, "start": 0, "copies": 1, "before": -1, "data": t} for i, t in enumerate(texts)]
    out = repeats.interval_tree(pieces, length)
    rows = [dict(zip(out, v)) for v in zip(*out.values())]
    places = {}
    for i, t in enumerate(texts):
        for s in range(len(t) - length + 1):
            for n in range(length, len(t) - s + 1):
                places.setdefault(t[s : s + n], []).append((i, s))
    left = lambda i, s: texts[i][s - 1] if s else (-1, i)
    right = lambda i, s: texts[i][s] if s < len(texts[i]) else (-1, i)
    want = {
        (len(w), len(p)): 0 for w, p in places.items()
        if len(p) > 1 and len({left(*x) for x in p}) > 1 and len({right(i, s + len(w)) for i, s in p}) > 1
    }
    for w, p in places.items():
        if len(p) > 1 and len({left(*x) for x in p}) > 1 and len({right(i, s + len(w)) for i, s in p}) > 1:
            want[len(w), len(p)] += 1
    got = {}
    for r in rows:
        if r["kind"] == "interval" and r["maximal"]:
            got[r["length"], r["size"]] = got.get((r["length"], r["size"]), 0) + 1
    assert got == want
    # all occurrences hang below their interval
    nodes = {r["node"]: r for r in rows if r["kind"] == "interval"}
    below = {n: 0 for n in nodes}
    for r in rows:
        if r["kind"] == "occurrence":
            n = r["node"]
            while n is not None:
                below[n] += 1
                n = nodes[n]["parent"]
    assert all(below[n] == nodes[n]["size"] for n in nodes)


def test_ranked_equals_a_window(spark):
    rows = spark.range(5000).select(F.when(F.col("id") % 3 > 0, "hot").when(F.col("id") % 6 == 0, F.lit(None)).otherwise("cold").alias("g"), F.md5(F.col("id").cast("string")).alias("o"), (F.col("id") % 10).alias("w"))
    got = ranked(rows.repartition(7), ["g"], ["o"], "r", "w", "t").toPandas()
    for _, part in got.groupby("g", dropna=False):
        part = part.sort_values("o")
        assert list(part["r"]) == list(range(len(part))) and list(part["t"]) == list(part["w"].cumsum())


def test_license_winner_against_all_wordings(monkeypatch):
    """Blocks of several templates, cut and mixed: no template that is left out would have won."""
    import random

    from relload.llm import licenses

    rnd = random.Random(4)
    texts = list(licenses.TEMPLATES.values())
    blocks = [" ".join(rnd.sample(texts, rnd.randint(1, 5))) for _ in range(12)]
    blocks += [" ".join(w for w in b.split() if rnd.random() > 0.05) for b in blocks] + ["", "licensed", "x " * 3000 + texts[1]]
    got = [licenses._match(b, False) for b in blocks]
    assert sum(g is not None for g in got) >= 12 and got == [licenses.match_block(b) for b in blocks]
    every = {name: words for name, words in licenses._wordings()[0].items()}
    for block, hit in zip(blocks, got):
        alone = []
        for name in every:  # each template as if it were the only one
            monkeypatch.setattr(licenses, "_reductions", lambda flat, name=name: [x for x in licenses._all_reductions(flat) if x[1] == name])
            one = licenses._match(block, False)
            if one:
                words = len(every[name])
                alone.append((one["share"], round(one["share"] * words) - one["extra"], one["reduction"], name))
        assert (hit["license"] if hit else None) == (max(alone, key=lambda x: x[:3])[3] if alone else None)
