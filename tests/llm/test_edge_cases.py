"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns, for every operator and stage."""

import itertools
import zlib

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from relload.llm import ann, decontam, langid, licenses, mixing, repeats, shard, simhash, toxicity, urls

DOC = "doc_id long, text string, lang string, source string, n_chars long, fp long, rank int, shard int, __llm_file string, score double"
PROSE = "the quick brown fox jumps over the lazy dog while seven small birds sing loudly near an old stone bridge"


def doc(i, text, lang="en", source="a"):
    return (i, text, lang, source, None if text is None else len(text), 1, 1, 1, "x", 0.5)


@pytest.fixture(scope="module")
def odd(spark):
    """Every odd case at once; the long text is as long as Spark tests comfortably take."""
    rows = [
        doc(1, PROSE), doc(2, PROSE), doc(2, PROSE), doc(3, ""), doc(4, None), doc(None, PROSE + " again"), doc(None, None, None, None),
        doc(5, " \t\n"), doc(6, (PROSE + " ") * 20000, "de", None), doc(7, "ünïcödé 文字 !?", None, "b"), doc(8, "12 34"), doc(9, "a" * 5000),
    ]
    return spark.createDataFrame(rows, DOC)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOC)


def test_simhash(odd, none):
    got = simhash.near_duplicates(odd).collect()
    assert len(got) == odd.count()
    at = {r.doc_id: r for r in got if r.doc_id is not None}
    assert at[1].component_id == at[2].component_id == 1 and at[3].component_id == at[4].component_id == at[5].component_id == 3
    assert at[3].fp == 0 and sum(r.component_id == 3 for r in got) == 4  # blank and null texts, the null id among them
    assert simhash.near_duplicates(none).count() == 0


def test_simhash_of_null_ids_alone(spark):
    rows = spark.createDataFrame([(None, "x y z w"), (None, "x y z w")], "doc_id long, text string")
    assert [r.component_id for r in simhash.near_duplicates(rows).collect()] == [None, None]


def test_language(odd, none):
    model = langid.fit(odd, F.lit(True))
    got = langid.predict(odd, model, "text", "l", "s", "r").collect()
    assert len(got) == odd.count()
    for r in got:
        letters = any(c.isalpha() for c in r.text or "")
        assert (r.l == "und") == (not letters) and 0 <= r.s <= 1 and (letters or r.r)
    blank = langid.fit(none, F.lit(True))
    assert langid.predict(none, blank, "text", "l", "s", "r").count() == 0
    assert {r.l for r in langid.predict(odd, blank, "text", "l", "s", "r").collect()} == {"und"}


def _labelled(spark, langs):
    """Rows of (language, distinct texts, copies of the first); each language writes with letters of its own."""
    rows = []
    for i, (lang, texts, copies) in enumerate(langs):
        word = lambda n, i=i: "".join(chr(0x4E00 + 64 * i + (n >> s) % 60) for s in (0, 2, 5))
        made = [" ".join(word(97 * t + 31 * w) for w in range(12)) for t in range(texts)]
        rows += [(lang, t) for t in made] + [(lang, made[0])] * copies
    return spark.createDataFrame(rows, "lang string, text string")


def test_language_of_many_copies_is_learned(spark):
    docs = _labelled(spark, [("aa", 40, 60000), ("bb", 400, 0)])
    model = langid.fit(docs, F.lit(True))
    got = langid.predict(docs.distinct(), model, "text", "l", "s", "r").collect()
    assert set(model.langs) == {"aa", "bb"} and all(r.l == r.lang and not r.r for r in got)


def test_language_model_is_learned_from_all_texts(spark):
    """1,500 texts, far more than a sample held: one more text moves the centroids, and the dealing of the rows does not."""
    docs = _labelled(spark, [("aa", 1500, 0), ("bb", 1500, 0)])
    model = langid.fit(docs, F.lit(True))
    again = langid.fit(docs.repartition(7), F.lit(True))
    assert model.langs == again.langs and model.threshold == again.threshold and (model.centroids == again.centroids).all()
    texts = docs.where("lang = 'aa'").select("text").collect()
    seen = [r.text for r in texts[::150]]  # wherever its hash lies, each text counts
    for text in seen[:3]:
        less = langid.fit(docs.where(F.col("text") != text), F.lit(True))
        assert less.centroids.shape != model.centroids.shape or (less.centroids != model.centroids).any()


def test_language_sample_is_shared_by_all(spark, monkeypatch):
    monkeypatch.setattr(langid, "MAX_SAMPLE", 100)
    docs = _labelled(spark, [(f"big{i}", 2000, 0) for i in range(4)] + [("rare", 30, 0)])
    model = langid.fit(docs, F.lit(True))
    got = langid.predict(docs, model, "text", "l", "s", "r").where("lang = 'rare'").collect()
    assert len(set(model.langs)) == 5 and all(r.l == "rare" for r in got)


def test_shards(odd, none):
    got = shard.assign(odd, 5).collect()
    n = odd.count()
    sizes = [sum(r.shard == s for r in got) for s in range(5)]
    assert sum(sizes) == n and max(sizes) - min(sizes) <= 1
    for s in range(5):
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sizes[s]))
    texts = {r.doc_id: r.text for r in odd.collect()}
    for r in got:
        if r.doc_id not in (None, 2):
            data = (texts[r.doc_id] or "").encode()
            assert (r.size, r.text_crc32) == (len(data) + 1, zlib.crc32(data))
    assert shard.assign(none, 5).count() == 0


def test_shards_match_the_mixture(spark):
    rows = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 7)).alias("source"), F.lit("t").alias("text"))
    got = shard.assign(rows, 7).groupBy("shard", "source").count().toPandas()
    total = rows.groupBy("source").count().toPandas().set_index("source")["count"]
    assert all(abs(r["count"] - total[r["source"]] / 7) <= 2 for _, r in got.iterrows())


def test_repeats(odd, none):
    got = repeats.strip_repeats(odd).collect()
    assert len(got) == odd.count()
    at = {r.doc_id: r for r in got if r.doc_id is not None}
    assert at[3].n_bytes == at[4].n_bytes == 0 and at[3].spans == []
    assert at[9].kept == b"" and [tuple(s) for s in at[9].spans] == [(0, 5000)]
    assert at[6].kept == b"" and at[1].kept == PROSE.encode()  # shorter than the length
    assert repeats.strip_repeats(none).count() == 0


def test_licenses(spark, odd, none):
    assert licenses.scan(odd).count() == 0 and licenses.scan(none).count() == 0
    rows = [(1, "intro\nReleased under the MIT License.\nend"), (1, "intro\nReleased under the MIT License.\nend"), (None, "Licensed under CC BY-SA 4.0."), (3, "Released under the Foo License of licensing.")]
    got = licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((str(r.doc_id), r.start, r.license) for r in got if r.license) == [("1", 6, "MIT notice"), ("1", 6, "MIT notice"), ("None", 0, "CC-BY-SA-4.0 notice")]
    assert len(got) == 4


# as their publishers print them
MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software."""
BSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer."""
MPL = """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/."""
WRAPPED = {"MIT text": MIT, "BSD-3-Clause text": BSD, "MPL-2.0 header": MPL}


def test_licenses_in_wrapped_lines():
    for name, text in WRAPPED.items():
        for shown in (text, "\n".join(" * " + x for x in text.split("\n")), text.replace("\n", "\n\n"), text.replace("\n", "\r\n")):
            page = PROSE + "\n\n" + shown + "\n\n" + PROSE
            (got,) = licenses.find(page)
            assert (got["license"], got["exact"]) == (name, True), got
            held = page[got["found_at"] :][: got["found_chars"]]
            assert held.split()[0] == text.split()[0] and text.split()[-1].startswith(held.split()[-1])


def test_every_license_of_a_block():
    lines = ["Released under the MIT License.", "Licensed under CC BY 4.0.", "Licensed under CC BY-NC 4.0.", "Released under the MIT License."]
    text = "\n".join(lines)
    got = [(r["found_at"], r["license"]) for r in licenses.find(text)]
    assert got == [(0, "MIT notice"), (32, "CC-BY-4.0 notice"), (58, "CC-BY-NC-4.0 notice"), (87, "MIT notice")]
    every = "\n".join([*WRAPPED.values(), "Released under the Foo License of licensing."] * 40)
    got = [r["license"] for r in licenses.find(every) if r.get("license")]
    assert got == list(WRAPPED) * 40
    changed = MIT.replace("free of charge", "at no charge").replace("shall be included", "must be kept")
    (got,) = licenses.find(changed)
    assert got["license"] == "MIT text" and not got["exact"] and 0.9 < got["share"] < 1


def test_toxicity(spark, odd, none):
    labels = spark.createDataFrame([(1, 0), (2, 0), (None, 1), (6, None), (9, 1)], "doc_id long, toxic int")
    for model in (toxicity.fit(odd, labels, F.lit(True)), toxicity.fit(none, labels, F.lit(True)), toxicity.fit(odd, labels.limit(0), F.lit(True))):
        got = toxicity.score(odd, model, "text", "s2", "p").collect()
        assert len(got) == odd.count() and all(0 <= r.s2 <= 1 for r in got)
        assert toxicity.score(none, model, "text", "s2", "p").count() == 0


def test_toxicity_grammar():
    insult = {"fool": 2.0}
    kinds = lambda t: "".join(s for s, _ in toxicity.clause_patterns(t, insult))
    assert kinds("a fool.") == "I" and kinds("you fool") == "J" and kinds("no fool here") == "i"
    assert kinds("they said a fool came") == "q" and kinds("they said. a fool came") == "I"
    assert kinds("kill you") == "U" and kinds("nothing here") == ""
    scores = lambda t: toxicity.clause_scores(t, {"fool": 2.0, "oaf": 0.5})
    assert scores("nothing. a fool, you oaf! no fool here; fool oaf you") == [("I", 2.0), ("J", 0.5), ("i", 2.0), ("J", 2.5)]
    assert scores("they said fool oaf") == [("q", 2.5)] and scores("not kill or then came you fool, x") == [("J", 2.0)]
    assert scores("") == scores("you. said. not.") == []


def test_toxicity_acceptor_against_all_paths():
    """Every tape of four symbols: the strongest force alone is summed, and names the pattern by its strongest symbol."""
    weights = [1.0, 2.0, 4.0, 8.0]
    for tape in itertools.product("-NIJTUitq", repeat=4):
        marked = [(toxicity.FORCE[s], "qitITJU".index(s), s, w) for s, w in zip(tape, weights) if s in "IJTUitq"]
        want = None
        if marked:
            force = max(m[0] for m in marked)
            path = [m for m in marked if m[0] == force]
            want = (max(path, key=lambda m: m[1])[2], sum(m[3] for m in path))
        assert toxicity._accepted(list(tape), weights) == want


def test_mixing(odd, none):
    got = mixing.mix(odd, entropy_share=0.5).collect()
    assert all(r.block >= 0 for r in got)
    every = mixing.mix(odd, max_repeat=1e9, budget_share=None).collect()
    assert {r.doc_id for r in every} == {r.doc_id for r in odd.collect()}
    places = {}
    for r in every:
        places.setdefault((r.source, r.block), []).append(r.place)
    assert all(sorted(p) == list(range(len(p))) for p in places.values())
    assert mixing.mix(none, entropy_share=0.9).count() == 0


def test_mixing_meets_its_targets(spark):
    shares = spark.createDataFrame([("a", 800, 0.8), ("b", 150, 0.15), ("c", 50, 0.05)], "source string, tokens long, share double")
    g = mixing.exponent(shares, max_repeat=2.0)
    ratio = lambda x: mixing._measures(shares, [x])[x][1]
    assert ratio(g) <= 2.0 < ratio(g - 1)
    g = mixing.exponent(shares, entropy_share=0.9)
    import math

    entropy = lambda x: mixing._measures(shares, [x])[x][0]
    assert entropy(g) >= 0.9 * math.log(3) > entropy(g + 1)


def _shares(spark, sizes):
    total = float(sum(sizes.values()))
    return spark.createDataFrame([(s, n, n / total) for s, n in sizes.items()], "source string, tokens long, share double")


def test_small_sources_keep_their_quota_beside_a_huge_one(spark):
    shares = _shares(spark, {"big": 10**12} | {f"s{i}": 300 for i in range(20_000)})
    total = 10**12 + 300 * 20_000
    as_they_are = mixing.plan(shares, mixing.GRID, total)
    assert [tuple(r) for r in as_they_are.where("source <> 'big'").select("quota", "blocks", "rest").distinct().collect()] == [(300, 1, 0)]
    quota = {r.source: r.quota for r in mixing.plan(shares, mixing.exponent(shares, entropy_share=0.0), total).collect()}
    assert min(quota.values()) >= 300 and sum(quota.values()) <= total + 1


def test_entropy_repeats_no_source_beyond_the_limit(spark):
    shares = _shares(spark, {"big": 10**12, "tiny": 100})
    free = mixing.exponent(shares, entropy_share=0.95)
    bound = mixing.exponent(shares, entropy_share=0.95, max_repeat=100.0)
    assert free < bound == mixing.exponent(shares, max_repeat=100.0)
    blocks = {r.source: r.blocks for r in mixing.plan(shares, bound, 10**12).collect()}
    assert blocks["tiny"] <= 100 and blocks["big"] <= 1


def test_many_blocks_of_one_row(spark):
    docs = spark.createDataFrame([(1, "a", "x y"), (2, "b", "z " * 6001)], "doc_id long, source string, text string")
    got = mixing.mix(docs, max_repeat=1e9, entropy_share=1.0, budget_share=1.0).where("source = 'a'").collect()
    assert sorted(r.block for r in got) == list(range(1500))  # 6003 tokens in halves: 3001 for two tokens


def test_op10_meets_its_entropy_beside_a_tiny_source_as_its_sql_does(spark, tmpdir_path):
    """The query draws a source as often as 95 % of the largest entropy asks, here over 1,000 times as often as another."""
    import duckdb
    from relload.llm import queries

    docs = spark.createDataFrame([(1, "tiny", "x y"), (2, "big", "z " * 6001), (3, "big", None)], "doc_id long, source string, text string")
    docs.write.parquet(f"{tmpdir_path}/documents.parquet")
    got = queries.op10_temperature_mix(spark, tmpdir_path)
    with duckdb.connect() as db:
        db.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmpdir_path}/documents.parquet/*.parquet'")
        want = db.execute(queries.ORACLES["op10_temperature_mix"]).fetchall()
    rows = sorted(map(tuple, got.collect()))
    assert rows == sorted(want) and sum(r[1] == "tiny" for r in rows) > 1000


def test_contamination(spark, odd, none):
    item = PROSE.upper() + "!"
    bench = spark.createDataFrame([(1, item, 3), (2, None, 3), (3, "too short", 3), (None, "w1 w2 w3 w4 w5 w6 w7 w8 w9", 3), (1, item, 3)], "item_id long, text string, doc_id int")
    got = decontam.contaminated(odd, bench).collect()
    assert sorted(str(r.doc_id) for r in got if r.doc_id != 6) == ["1", "2", "2", "None"]
    assert sum(r.doc_id == 6 for r in got) >= 20000
    assert decontam.contaminated(none, bench).count() == 0 and decontam.contaminated(odd, bench.limit(0)).count() == 0


def test_contamination_with_substitutions_and_in_a_shuffle(spark, monkeypatch):
    words = [f"tok{i}" for i in range(13)]
    docs = []
    for i in range(13):
        for j in range(i + 1, 13):
            docs.append((len(docs), " ".join("xx" if k in (i, j) else w for k, w in enumerate(words))))
    docs.append((1000, " ".join("xx" if k in (0, 5, 10) else w for k, w in enumerate(words))))
    rows = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame([(7, " ".join(words))], "item_id long, text string")
    want = [d for d, _ in docs if d < 1000]
    assert sorted(r.doc_id for r in decontam.contaminated(rows, bench).collect()) == want
    monkeypatch.setattr(decontam, "BROADCAST_SEEDS", 0)
    assert sorted(r.doc_id for r in decontam.contaminated(rows, bench).collect()) == want


PAGE = "page_id long, url string, html string, host string, node string, verdict int"


def page(i, url, html=""):
    return (i, url, html, "x", "y", 1)


def test_urls(spark):
    link = lambda u: f'<head><LINK href="{u}" rel="canonical" /></head>'
    rules = [("block", "bad.com", "/"), ("allow", "good.com", "/"), ("block", "good.com", "/x/")]
    rows = [
        page(1, "http://a.net/1", '<link rel="canonical" href="http://BAD.com/p">'), page(2, "https://b.net/2#f", '<meta http-equiv="refresh" content="0; url=http://a.net/1">'),
        page(3, "http://good.com/ok", '<link rel=canonical href=http://a.net/1>'), page(4, "http://c.net/", None), page(5, None, None), page(6, "no scheme"),
        page(7, "http://sub.Bad.com/q?x"), page(8, "http://c.net/d/e", '<link rel="canonical" href="../x">'), page(8, "http://c.net/d/e"), page(None, "http://good.com/x/1"),
        page(9, "https://a.net/1"), page(10, "http://bad.com?x"), page(11, "http://a.net/2", '<link rel="canonical" href="/1">'),
    ]
    got = {r.page_id: (r.rule, r.verdict, r.alias_block) for r in urls.judge(spark.createDataFrame(rows, PAGE), rules).collect()}
    block, allow = (None, "block", True), (None, "allow", False)
    assert got[1] == got[2] == got[9] == got[11] == block and got[4] == got[5] == got[6] == got[8] == allow
    assert got[3] == ("good.com/", "allow", False) and got[7] == ("bad.com/", "block", False)
    assert got[None] == ("good.com/x/", "block", False) and got[10] == allow
    assert urls.judge(spark.createDataFrame([], PAGE), rules).count() == 0 and link("x")


def test_aliases_of_ordinary_pages(spark):
    link = lambda *u: "".join(f'<link rel="canonical" href="{x}">' for x in u)
    rules = [("block", "bad.com", "/")]
    bad = "http://bad.com/"
    rows = [
        page(1, "http://a.net/l?page=2&ref=x"), page(2, bad + "1", link("http://a.net/l?page=2&amp;ref=x")),
        page(3, "http://a.net/m?p=1&q=2&copy=3"), page(4, bad + "2", link("http://a.net/m?p=1&#38;q=2&#x26;copy=3")),
        page(5, "http://a.net/d/e/f", link("../../n/./o")), page(6, "http://a.net/n/o"), page(7, bad + "3", link("http://a.net/n/o")),
        page(8, "http://a.net/s/p?x=1", link("?x=2")), page(9, bad + "4", link("http://a.net/s/p?x=2")),
        page(10, "http://b.net/1"), page(11, "http://b.net/2"),
        page(12, bad + "5", link("http://c.net/", "http://b.net/1") + '<meta http-equiv="refresh" content="5"><meta http-equiv="refresh" content="0; url=//b.net/2">'),
        page(13, "http://d.net/x", link("/login?next=http://bad.com/1", "mailto:x@bad.com", "#top", "&unknown;&amp;amp;&#0;&#x110000;")),
        page(14, "http://e.net/x/../y"), page(15, bad + "6", link("http://e.net/x/../y")), page(16, "http://e.net/y"), page(17, "http://d.net/?a=1&copy=2&lt"),
        page(18, bad + "7", link("http://d.net/?a=1&copy=2&amp;lt")), page(19, "http://a.net/?p=1&q=2&copy=3"),
    ]
    got = {r.page_id: r.verdict for r in urls.judge(spark.createDataFrame(rows, PAGE), rules).collect() if not r.host == "bad.com"}
    assert got == {i: "allow" if i in (13, 19) else "block" for i in got} and len(got) == 12
    texts = spark.createDataFrame([("a&amp;amp;b&#233;&#xE9&eacute;&amp&nope;&#0;&#9999999999;&#x1F600;&&#;",)], "t string")
    assert texts.select(urls.decoded(F.col("t"))).first()[0] == "a&amp;b\u00e9\u00e9\u00e9&&nope;\ufffd\ufffd\U0001f600&&#;"


def test_search(spark):
    schema = "vec_id long, embedding array<float>, g int, id string"
    nan, inf = float("nan"), float("inf")
    rows = [(i, [1.0, 0.0], 1, "z") for i in range(0, 60)] + [(i, [0.6, 0.8], 1, "z") for i in range(60, 63)]
    rows += [(100, None, 1, "z"), (120, [0.0, 0.0], 1, "z"), (140, [nan, 1.0], 1, "z"), (160, [inf, 1.0], 1, "z"), (180, [None, 1.0], 1, "z"), (200, [1.0], 1, "z"), (None, [1.0, 0.0], 1, "z"), (20, [1.0, 0.0], 1, "z")]
    got = ann.search(spark.createDataFrame(rows, schema), F.col("vec_id") % 20 == 0, k=5, curves=4, block=8).orderBy("query_id", "rank").collect()
    # query 20 stands in two rows: each sees the other
    assert [r.vec_id for r in got if r.query_id == 0] == [1, 2, 3, 4, 5] and [r.vec_id for r in got if r.query_id == 40] == [0, 1, 2, 3, 4]
    assert sum(r.query_id == 20 for r in got) == 10
    last = [(r.vec_id, round(r.score, 6)) for r in got if r.query_id == 60]
    assert last[:2] == [(61, 1.0), (62, 1.0)] and last[2] == (0, 0.6) and {r.query_id for r in got} == {0, 20, 40, 60}
    assert ann.search(spark.createDataFrame([], schema), F.col("vec_id") % 20 == 0).count() == 0
    few = ann.search(spark.createDataFrame(rows[58:61], schema), F.col("vec_id") % 20 == 0)
    assert sorted((r.query_id, r.rank, r.vec_id) for r in few.collect()) == [(60, 1, 58), (60, 2, 59)]


def test_search_width_follows_the_rows(spark):
    """6,000 unclustered vectors against 8 x 3 x 32 = 768 slots of the least width: the recall must hold all the same."""
    import numpy as np

    x = np.random.default_rng(5).standard_normal((6000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = ann.search(rows, F.col("vec_id") % 20 == 0, curves=8, block=32).toPandas()
    score = x[::20] @ x.T
    score[np.arange(300), np.arange(0, 6000, 20)] = -2
    want = {(20 * q, int(c)) for q, best in enumerate(np.argsort(-score, axis=1)[:, :20]) for c in best}
    assert len(got) == 6000 and len(want & set(zip(got["query_id"], got["vec_id"]))) >= 0.9 * len(want)


def test_stages(spark, odd, none, tmp_path):
    spark.createDataFrame([(1, "w1 w2 w3 w4 w5 w6 w7 w8 w9 w10")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    for start in (odd, none):
        docs, left = start, []
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, str(tmp_path))
            if name != "sharding":
                assert out.columns == start.columns, name
            path = str(tmp_path / f"{name}-{start is none}")
            out.write.parquet(path)
            docs = spark.read.parquet(path)
            left.append(docs.count())
        assert left[0] >= left[1] >= left[2] and (left[0] > 0) == (start is odd)
