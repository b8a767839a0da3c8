"""Source divergence audit: how far each source of a language is from the others and from the whole.

Terms of every (language, source) group are counted; a language keeps the terms of
enough documents.  Two parts come out: every pair of sources of a language with its
divergence over all kept terms, and for every source the terms in which it differs most
from its language.

The second part is a dominance skyband.  A term's value grows with its count in the
group and falls with its count in the language, ties go to the earlier term; so a term
that ``k`` others beat (or meet) in all three can't be among the first ``k``.  Every
partition keeps only the terms that fewer than ``k`` others dominate, those bands are
merged the same way, and what is left is ranked by the exact values.

All arithmetic is on integers.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from relload.llm.common import map_texts, texts_of, write_table

SCALE = 1_000_000_000  # probabilities are integers of this scale; worked out in three steps of 1,000

# Terms are runs of ASCII letters and of all that is not ASCII; only A-Z is lower-cased.
TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b > 127 else 32 for b in range(256))

PIECE = 4 << 20  # bytes of a long text that are cut into terms at once
ENTRIES = 300_000  # terms that a counting task holds before it hands its counts on
_DOC = 1 << 40  # a document's mark beside its count, so one number holds both

BLOCK = 8_192  # kept terms whose counts are compared between all sources at once
CELLS = 1 << 20  # terms x sources in one array
BUFFER = 4_096  # terms of a group that wait for the next band
HELD = 200_000  # terms of all groups that a task holds


def _pieces(text: bytes):
    """The text in pieces that end between terms."""
    at = 0
    while len(text) - at > PIECE:
        end = at + PIECE
        while end < len(text) and TERM_BYTES[text[end]] != 32:
            end += 1
        yield text[at:end]
        at = end
    yield text[at:]


def _count_terms(batches):
    import pyarrow as pa

    groups: dict = {}
    entries = 0

    def flush():
        for (lang, source), terms in groups.items():
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang] * len(terms), pa.string()), pa.array([source] * len(terms), pa.string()),
                    pa.array(terms.keys(), pa.binary()).cast(pa.string()),
                    pa.array([v % _DOC for v in terms.values()], pa.int64()), pa.array([v // _DOC for v in terms.values()], pa.int64()),
                ],
                names=["lang", "source", "term", "n", "docs"],
            )

    for batch in batches:
        for lang, source, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), texts_of(batch.column(2))):
            found: Counter = Counter()
            for piece in _pieces(text or b""):
                found.update(piece.translate(TERM_BYTES).split())
            terms = groups.setdefault((lang, source), {})
            entries -= len(terms)
            for term, n in found.items():
                terms[term] = terms.get(term, 0) + n + _DOC
            entries += len(terms)
            if entries >= ENTRIES:
                yield from flush()
                groups, entries = {}, 0
    yield from flush()


def kept_terms(docs: DataFrame, min_docs: int) -> DataFrame:
    """(lang, term, lang_count, sources): the terms in ``min_docs`` documents of a language, with their counts by source."""
    counts = map_texts(docs.select("lang", "source", "text"), _count_terms, "lang string, source string, term string, n long, docs long")
    by_source = counts.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    terms = by_source.groupBy("lang", "term").agg(
        F.sum("n").alias("lang_count"), F.sum("docs").alias("docs"), F.collect_list(F.struct("source", "n")).alias("sources")
    )
    return terms.where(F.col("docs") >= min_docs).drop("docs")


def share(count: Column, total: Column) -> Column:
    """1 + floor(SCALE * (count + 2) / total) for count + 2 up to total, without leaving 64 bits."""
    x, out = count + 2, F.lit(1).cast("long")
    for unit in (1_000_000, 1_000, 1):
        out = out + F.call_function("div", x * 1_000, total) * unit
        x = (x * 1_000) % total
    return out


def _share(count: np.ndarray, total: np.ndarray) -> np.ndarray:
    x, out = count + 2, np.ones(np.broadcast(count, total).shape, dtype=np.int64)
    for unit in (1_000_000, 1_000, 1):
        out += x * 1_000 // total * unit
        x = x * 1_000 % total
    return out


def _compare_block(terms, sources):
    """(lang, source, item, value): the divergence of each pair of sources over one block of kept terms."""
    import pyarrow as pa

    lang, names = sources.column("lang")[0].as_py(), sources.column("source").to_pylist()
    order = sorted(range(len(names)), key=lambda i: names[i].encode())
    names = [names[i] for i in order]
    place = {s: i for i, s in enumerate(names)}
    total = np.array(sources.column("total").to_pylist(), dtype=np.int64)[order]
    sums = np.zeros((len(names), len(names)), dtype=np.int64)
    rows = terms.column("sources").to_pylist() if terms.num_rows else []
    step = max(1, CELLS // len(names))
    for at in range(0, len(rows), step):
        some = rows[at : at + step]
        count = np.zeros((len(some), len(names)), dtype=np.int64)
        for i, row in enumerate(some):
            for s in row:
                count[i, place[s["source"]]] = s["n"]
        p = _share(count, total[None, :])
        for a in range(len(names) - 1):
            q = p[:, a : a + 1]
            d = p[:, a + 1 :] - q
            sums[a, a + 1 :] += (d * d // (p[:, a + 1 :] + q)).sum(axis=0)
    one, other = np.triu_indices(len(names), 1)
    return pa.table(
        {"lang": pa.array([lang] * len(one), pa.string()), "source": pa.array([names[i] for i in one], pa.string()),
         "item": pa.array([names[i] for i in other], pa.string()), "value": pa.array(sums[one, other], pa.int64())}
    )


def source_pairs(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value) of every pair of different sources of a language, both ways.

    Blocks of kept terms meet all sources of their language; a block adds up its terms
    before anything leaves it, so no pair of rows is written out.
    """
    blocks = F.greatest(F.lit(1), F.ceil(F.col("terms") / BLOCK)).cast("int")
    langs = groups.select("lang", "terms").distinct()
    left = kept.join(langs, "lang").select("lang", F.pmod(F.xxhash64("term"), blocks).cast("int").alias("block"), "sources")
    right = groups.select(
        "lang", F.explode(F.sequence(F.lit(0), blocks - 1)).alias("block"), "source", (F.col("group_total") + 2 * F.col("terms")).alias("total")
    )
    half = left.groupBy("lang", "block").cogroup(right.groupBy("lang", "block")).applyInArrow(
        _compare_block, "lang string, source string, item string, value long"
    )
    half = half.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    both = F.explode(F.array(F.struct("source", "item"), F.struct(F.col("item").alias("source"), F.col("source").alias("item"))))
    return half.select("lang", both.alias("s"), "value").select("lang", "s.source", "s.item", "value")


def skyband(count: np.ndarray, lang_count: np.ndarray, terms: list[bytes], k: int) -> list[int]:
    """Places of the terms that fewer than ``k`` others dominate.

    One term dominates another if its count is not lower, its language count not higher
    and its UTF-8 earlier.  Sorted by falling count and rising language count, only
    earlier rows can dominate, and a row that is not in the band has ``k`` dominators
    in it, so rows are compared with the band alone.
    """
    rank = np.empty(len(terms), dtype=np.int64)
    rank[sorted(range(len(terms)), key=terms.__getitem__)] = np.arange(len(terms))
    order = np.lexsort((rank, lang_count, -count))
    c, n = count[order], lang_count[order]
    first = np.flatnonzero(np.concatenate(([True], (c[1:] != c[:-1]) | (n[1:] != n[:-1]))))
    run = np.arange(len(order)) - np.repeat(first, np.diff(np.append(first, len(order))))
    order = order[run < k]  # equal counts: the first k by UTF-8 dominate the rest
    held, at, size = [], np.empty((2, len(order)), dtype=np.int64), 0
    for i, n, t in zip(order.tolist(), lang_count[order].tolist(), rank[order].tolist()):
        if np.count_nonzero((at[0, :size] <= n) & (at[1, :size] < t)) < k:
            at[:, size] = n, t
            size += 1
            held.append(i)
    return held


_BAND = "lang string, source string, term string, n long, lang_count long, value long"


def _band(table, k: int):
    """The rows of one group's table that are in its skyband."""
    terms = texts_of(table.column("term").combine_chunks())
    return table.take(skyband(table.column("n").to_numpy(), table.column("lang_count").to_numpy(), terms, k))


def _gathered(batches, rows: int):
    """Tables of about ``rows`` rows from smaller batches."""
    import pyarrow as pa

    some, n = [], 0
    for batch in batches:
        some.append(batch)
        n += batch.num_rows
        if n >= rows:
            yield pa.Table.from_batches(some)
            some, n = [], 0
    if n:
        yield pa.Table.from_batches(some)


def _by_group(table):
    """((lang, source), rows) for every group of a table."""
    lang, source = (table.column(c).combine_chunks().dictionary_encode() for c in ("lang", "source"))
    code = lang.indices.to_numpy().astype(np.int64) * len(source.dictionary) + source.indices.to_numpy()
    order = np.argsort(code, kind="stable")
    cut = np.flatnonzero(np.diff(code[order])) + 1
    table = table.take(order)
    for at, end in zip([0, *cut.tolist()], [*cut.tolist(), len(order)]):
        some = table.slice(at, end - at).combine_chunks()
        yield (some.column("lang")[0].as_py(), some.column("source")[0].as_py()), some


def partition_bands(rows: DataFrame, k: int) -> DataFrame:
    """The rows of every partition that fewer than ``k`` others of their group in it dominate."""

    def run(batches):
        import pyarrow as pa

        bands: dict = {}  # group -> [its band and the rows since, rows, rows since]
        held = 0

        def settle(group):
            nonlocal held
            band = _band(pa.concat_tables(bands[group][0]).combine_chunks(), k)
            held += band.num_rows - bands[group][1]
            bands[group] = [[band], band.num_rows, 0]

        for table in _gathered(batches, BUFFER * 8):
            for group, some in _by_group(table):
                entry = bands.setdefault(group, [[], 0, 0])
                entry[0].append(some)
                entry[1] += some.num_rows
                entry[2] += some.num_rows
                held += some.num_rows
                if entry[2] >= BUFFER:
                    settle(group)
            if held >= HELD:
                for group in bands:
                    settle(group)
                if held >= HELD // 2:  # very many groups: hand their bands on and begin anew
                    for entry in bands.values():
                        yield from entry[0][0].to_batches()
                    bands, held = {}, 0
        for group in bands:
            settle(group)
            yield from bands[group][0][0].to_batches()

    return rows.mapInArrow(run, _BAND)


def top_terms(kept: DataFrame, groups: DataFrame, top: int) -> DataFrame:
    """(lang, source, item, value): for each group the ``top`` and perhaps more terms that are likelier in it than in the language."""
    facts = groups.select("lang", "source", "terms", "group_total", "lang_total")
    rows = kept.select("lang", "term", "lang_count", F.explode("sources").alias("s")).select("lang", "s.source", "term", "s.n", "lang_count")
    rows = rows.join(facts, ["lang", "source"])
    p = share(F.col("n"), F.col("group_total") + 2 * F.col("terms"))
    q = share(F.col("lang_count"), F.col("lang_total") + 2 * F.col("terms"))
    rows = rows.withColumn("p", p).withColumn("q", q).where("n > 0 and p > q")
    rows = rows.select("lang", "source", "term", "n", "lang_count", F.expr("(p - q) * (p - q) div (p + q)").alias("value"))
    bands = partition_bands(rows, top)
    part = F.pmod(F.xxhash64("term"), F.lit(16)).alias("part")
    merged = bands.groupBy("lang", "source", part).applyInArrow(lambda t: _band(t.select(_names(_BAND)), top), _BAND)
    return merged.select("lang", "source", F.col("term").alias("item"), "value")


def _names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def audit(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text", min_docs: int = 10, top: int = 10) -> DataFrame:
    """(lang, source, part, item, value, rank): part ``pair`` (all other sources) and part ``term`` (the ``top`` terms).

    Null language, source and text count as ``''``.  Groups without terms take part in
    ``pair`` (value 0 where their language keeps no term); a language of one source has
    no pairs.  Repeated rows count as often as they come; ties go to the earlier item in
    UTF-8; an empty table gives an empty result; other columns are not read.
    """
    named = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))]
    docs = docs.select(*named)
    kept = write_table(kept_terms(docs, min_docs), "kept-terms")
    langs = kept.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("lang_count").alias("lang_total"))
    totals = kept.select("lang", F.explode("sources").alias("s")).groupBy("lang", "s.source").agg(F.sum("s.n").alias("group_total"))
    zero = F.lit(0).cast("long")
    groups = docs.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(langs, "lang", "left")
    groups = groups.select("lang", "source", *[F.coalesce(F.col(c), zero).alias(c) for c in ("group_total", "terms", "lang_total")])
    groups = write_table(groups, "term-groups")
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    out = []
    for part, rows in (("pair", source_pairs(kept, groups)), ("term", top_terms(kept, groups, top))):
        ranked = rows.withColumn("rank", F.row_number().over(order))
        ranked = ranked.where(F.col("rank") <= top) if part == "term" else ranked
        out.append(ranked.select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank"))
    return out[0].unionByName(out[1])
