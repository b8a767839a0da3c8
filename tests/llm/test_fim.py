"""Skip list and fill-in-the-middle against plain slicing."""

import hashlib
import random
import re

import pytest

from relload.llm import fim

TEXTS = ["", "a", "ab", "aé", "日本語 text 𝄞 clef", "é" * 17, "x" * 256, "line one\nline two\n" * 40, "".join(chr(c) for c in range(32, 3000))]


@pytest.mark.parametrize("text", TEXTS)
def test_every_rank_of_code_points(text):
    units = fim.SkipList(text.encode())
    assert units.units == len(text)
    for rank in range(len(text) + 1):
        assert units.reach(rank) == (rank, len(text[:rank].encode()))


@pytest.mark.parametrize("text", TEXTS)
def test_every_rank_of_words(text):
    pattern = re.compile(r"\S+\s*")
    starts = [m.start() for m in pattern.finditer(text)]
    units = fim.SkipList(text.encode(), pattern)
    begins = ([0] + starts[1:] if starts else [0]) if text else []
    assert units.units == len(begins)
    for rank in range(len(begins) + 1):
        chars = (begins + [len(text)])[rank]
        assert units.reach(rank) == (chars, len(text[:chars].encode()))


def test_a_long_text_over_pieces(monkeypatch):
    monkeypatch.setattr(fim, "PIECE", 7)
    r = random.Random(1)
    text = "".join(r.choice("aé日𝄞") for _ in range(5000))
    units = fim.SkipList(text.encode())
    for rank in [0, 1, 15, 16, 17, 255, 256, 257, 4095, 4096, 4097, 5000, *(r.randint(0, 5000) for _ in range(200))]:
        assert units.reach(rank) == (rank, len(text[:rank].encode()))
    with pytest.raises(IndexError):
        units.reach(5001)


def _plain(i, text):
    x = hashlib.sha256(f"1:{i}".encode()).hexdigest()
    h = [int(x[k : k + 8], 16) for k in (0, 8, 16, 24)]
    n, a, b = len(text), *sorted((h[0] % (len(text) + 1), h[1] % (len(text) + 1)))
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    pre, mid, suf = text[:a], text[a:b], text[b:]
    if h[3] % 100 < 20:
        return n, "spm", a, b - a, f"<S>{suf}<P>{pre}<M>{mid}"
    return n, "psm", a, b - a, f"<P>{pre}<S>{suf}<M>{mid}"


def test_rows(spark):
    texts = [*TEXTS, "<<S>P> <M", "has <M> inside", "<S", "S>P>", None, "日本" * 40_000]
    rows = [(i, texts[i % len(texts)], "psm", 3) for i in range(len(texts) * 12)] + [(None, "null id", "x", 1), (5, "twice", "x", 1), (5, "twice", "x", 1)]
    got = fim.fill_in_middle(spark.createDataFrame(rows, "doc_id long, text string, form string, n int")).collect()
    want = sorted(((i, *_plain("" if i is None else i, t or "")) for i, t, _, _ in rows), key=repr)
    assert sorted(((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in got), key=repr) == want
    assert sorted(r.restored for r in got) == sorted(t or "" for _, t, _, _ in rows)
    assert {r.form for r in got} == {"plain", "psm", "spm"}


def test_empty_table(spark):
    assert fim.fill_in_middle(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_words_as_units(spark):
    rows = [(i, "one two  three\nfour five") for i in range(40)]
    got = fim.fill_in_middle(spark.createDataFrame(rows, "doc_id long, text string"), pattern=r"\S+\s*").collect()
    assert {r.n for r in got} == {5} and {r.restored for r in got} == {rows[0][1]}
    assert {r.prefix_chars for r in got if r.form != "plain"} <= {0, 4, 9, 15, 20, 24}
