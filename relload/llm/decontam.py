"""Benchmark decontamination by spaced-seed hashing, in DataFrame functions alone.

A seed is six of eight neighbouring tokens, chosen by a fixed mask that ignores the
other two.  Equal seeds of a benchmark item and a text put the item on the text at some
shift; the overlap there is verified token by token.  The two masks find every stretch
of 13 tokens in which any two are substituted, so for items of 13 tokens and more they
miss no overlap that the check would accept.  Shorter items can be missed: see below.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from relload.llm.common import ROW_KEY, with_row_key, write_table

# The token positions each mask keeps.
MASKS = ((0, 1, 2, 4, 6, 7), (0, 1, 4, 5, 6, 7))
SPAN = 8
WINDOW = 13  # tokens an overlap is judged over; shorter items are judged whole
# Benchmark seeds that are sent to every task (24 bytes each); with more, seeds meet in a shuffle.
BROADCAST_SEEDS = 1_000_000


def tokens(text: Column) -> Column:
    """Runs of letters and digits, lower case; empty for null."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))


def _seeds(rows: DataFrame, place: str) -> DataFrame:
    """``rows`` (column ``words``) with one row per position and mask: ``place`` and hash ``seed``."""
    hashed = rows.withColumn("words", F.transform("words", lambda w: F.xxhash64(w))).where(F.size("words") >= SPAN)
    at = hashed.withColumn(place, F.explode(F.sequence(F.lit(0), F.size("words") - SPAN)))
    word = lambda o: F.get("words", F.col(place) + o)
    masked = F.array(*[F.xxhash64(F.lit(m), *[word(o) for o in mask]) for m, mask in enumerate(MASKS)])
    return at.withColumn("seed", F.explode(masked)).drop("words")


def contaminated(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text: str = "text", similarity: tuple[int, int] = (4, 5),
) -> DataFrame:
    """(row key, doc_id, item_id, shift, window, matched): every verified overlap of a text with an item.

    ``shift`` is the text's token that meets the item's first (it may be negative where
    the text starts inside the item).  ``window`` is 13 tokens, or the item's length if
    shorter, and ``matched`` the most equal tokens in any such window at that shift; the
    overlap counts if ``matched / window`` is ``similarity`` (a fraction) or more.  Null
    and empty texts and items, and those of fewer than eight tokens, never match, not even
    when copied exactly.  Items of eight to twelve tokens may be missed though the check
    would accept them: with one token substituted at five of the eight places of an item
    of eight and at two of the nine of one of nine, and with two substituted.  Whole texts
    are read.  Repeated texts each match; repeated items count once; null ids are kept;
    empty tables give an empty result; other columns are not read.
    """
    num, den = similarity
    items = benchmark.select(F.col(item_col).alias("item_id"), F.col(item_text).alias("item_text")).distinct()
    items = write_table(items.select(F.monotonically_increasing_id().alias("item"), "item_id", tokens(F.col("item_text")).alias("item_words")), "benchmark-items")
    rows = with_row_key(docs, F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    ours = _seeds(items.select("item", F.col("item_words").alias("words")), "item_at").select("item", "item_at", "seed").distinct()
    ours = write_table(ours, "benchmark-seeds")
    theirs = _seeds(rows.select(*ROW_KEY, tokens(F.col("text")).alias("words")), "text_at")
    # in a shuffle neither side is broadcast: Spark does not see how many seeds a text is exploded into
    seeds = F.broadcast(ours) if ours.count() <= BROADCAST_SEEDS else ours.hint("merge")
    hits = theirs.join(seeds, "seed").select(*ROW_KEY, "item", (F.col("text_at") - F.col("item_at")).alias("shift"))
    hits = write_table(hits.distinct(), "seed-hits")

    # a text is cut around all of its hits in one row: only the cuts are copied, not the text
    sized = items.select("item", F.size("item_words").alias("of"))
    wanted = hits.join(sized, "item").groupBy(*ROW_KEY).agg(F.collect_list(F.struct("item", "shift", "of")).alias("hits"))
    cuts = rows.join(wanted, ROW_KEY).select(*ROW_KEY, "doc_id", "hits", tokens(F.col("text")).alias("words"))

    def cut(h):
        low = F.greatest(F.lit(0), -h["shift"])
        high = F.least(h["of"], F.size("words") - h["shift"])
        return F.struct(h["item"].alias("item"), h["shift"].alias("shift"), low.alias("low"), F.slice("words", h["shift"] + low + 1, F.greatest(high - low, F.lit(0))).alias("words"))

    met = cuts.select(*ROW_KEY, "doc_id", F.explode(F.transform("hits", cut)).alias("cut")).select(*ROW_KEY, "doc_id", "cut.*").join(items, "item")
    met = met.withColumn("window", F.least(F.lit(WINDOW), F.size("item_words"))).where(F.size("words") >= F.col("window"))
    same = F.transform("words", lambda w, i: (w == F.get("item_words", F.col("low") + i)).cast("int"))
    run = lambda s: F.aggregate(F.slice("same", s, F.col("window")), F.lit(0), lambda x, y: x + y)
    best = F.array_max(F.transform(F.sequence(F.lit(1), F.size("same") - F.col("window") + 1), run))
    return (
        met.withColumn("same", same).withColumn("matched", best).where(F.col("matched") * den >= F.col("window") * num)
        .select(*ROW_KEY, "doc_id", "item_id", "shift", "window", "matched")
    )
