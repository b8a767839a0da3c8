"""Proportional stratified interleaving: shards that each match the source mixture.

Rows are ranked inside their source in seeded-shuffled order; the fractional rank
(rank + 1/2) / (rows of the source) spreads every source evenly over the interval from
0 to 1.  All rows sorted by it are cut into shards of equal row counts, so each shard
holds its share of every source to within a row or so.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relload.llm.common import ranked, write_table


def assign(
    docs: DataFrame, shards: int, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", seed: str = "shards",
) -> DataFrame:
    """One row per row of ``docs``: doc_id, source, size, text_crc32, shard, slot.

    ``size`` is the UTF-8 bytes of the text (null: none) plus 1, ``text_crc32`` its CRC-32 (null as empty); ``slot`` counts from 0 inside
    the shard in interleaved order; row counts of shards differ by one at most.  Rows
    are shuffled by the MD5 of seed and id; rows with one id follow by size and crc.
    Null sources form a source of their own, null ids shuffle together by size and crc,
    and repeated rows each get a slot.  The text never leaves the scan: two narrow
    range shuffles give the ranks, so neither a hot source nor a long text is held by
    one task.  An empty table gives an empty result; other columns are not read.
    """
    text = F.col(text_col)
    narrow = write_table(
        docs.select(
            F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
            (F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1).alias("size"), F.crc32(F.coalesce(text, F.lit(""))).alias("text_crc32"),
            F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))).alias("mixed"),
        ),
        "shard-rows",
    )
    in_source = ranked(narrow, ["source"], ["mixed", "doc_id", "size", "text_crc32"], "rank")
    totals = narrow.groupBy("source").agg(F.count("*").alias("n"))
    named = totals.select(F.col("source").alias("s"), "n")
    spread = (
        in_source.join(named, F.col("source").eqNullSafe(F.col("s")))
        .withColumn("frac", (F.col("rank") * 2 + 1).cast("double") / (F.col("n") * 2).cast("double"))
        .select("doc_id", "source", "size", "text_crc32", "frac", "mixed")
    )
    all_ = ranked(write_table(spread, "fractional"), [], ["frac", "source", "mixed", "doc_id", "size", "text_crc32"], "place")
    n = narrow.count()
    # shard s holds places ceil(s * n / shards) up to, not including, ceil((s + 1) * n / shards)
    shard = F.expr(f"cast((place * {shards}) div {max(n, 1)} as int)")
    start = F.expr(f"cast((shard * {n} + {shards - 1}) div {shards} as long)")
    return (
        all_.withColumn("shard", shard).withColumn("slot", F.col("place") - start)
        .select("doc_id", "source", "size", "text_crc32", "shard", "slot")
    )
