"""Mixing sources to target weights by temperature.

The weight of a source is its share of the tokens raised to an exponent between 0 (all
sources alike) and 1 (as they are), normalised.  The exponent is found by sections: the
largest that meets a target entropy, or the smallest that keeps within a repetition
limit; with both targets the larger of the two, so no source is repeated beyond its
limit to please the entropy.  The weights then become token quotas of a budget, and a
quota becomes blocks: seeded permutations of the whole source, the last cut where the
quota is used up.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from relload.llm.common import free_name, ranked, write_table

GRID = 1_000_000  # exponents are multiples of 1 / GRID
_CUTS = 100  # grid points tried in one pass over the sources

_RUN = 1_000  # blocks in one array

TOKEN = r"[^\x20\x09-\x0D]+"


def token_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(TOKEN)), F.lit(0)).cast("long")


def source_tokens(docs: DataFrame, source_col: str, text_col: str) -> DataFrame:
    """(source, tokens, share) of every source; null is a source of its own."""
    sums = docs.groupBy(F.col(source_col).alias("source")).agg(F.sum(token_count(F.col(text_col))).alias("tokens"))
    sums = write_table(sums, "source-tokens")
    total = sums.agg(F.sum("tokens")).first()[0] or 0
    return sums.withColumn("share", F.col("tokens").cast("double") / F.lit(float(max(total, 1))))


def _measures(shares: DataFrame, grid: list[int]) -> dict:
    """Per grid point: entropy of the weights, and the largest over the smallest ratio of weight to share."""
    some = shares.where("share > 0").select(F.log("share").alias("lp"), F.explode(F.array(*map(F.lit, grid))).alias("g"))
    a = F.col("g") / F.lit(float(GRID))
    power = F.exp(a * F.col("lp"))
    rows = some.groupBy("g").agg(
        F.sum(power).alias("z"), F.sum(power * F.col("lp")).alias("s"), F.min("lp").alias("low"), F.max("lp").alias("high")
    ).collect()  # one row a grid point
    return {r["g"]: (math.log(r["z"]) - r["g"] / GRID * r["s"] / r["z"], math.exp((1 - r["g"] / GRID) * (r["high"] - r["low"]))) for r in rows}


def exponent(shares: DataFrame, entropy_share: float | None = None, max_repeat: float | None = None) -> int:
    """Exponent times ``GRID``: the largest whose entropy is ``entropy_share`` of the largest possible or
    more, the smallest that repeats no source over ``max_repeat`` times as often as another, or the larger of both.

    Entropy falls and the repetition falls as the exponent grows, so sections of the
    grid find it; the sources are summed by Spark in every pass and never collected.
    """
    if entropy_share is None and max_repeat is None:
        raise ValueError("give entropy_share, max_repeat or both")
    n = shares.where("share > 0").count()
    if n < 2:
        return GRID
    found = []
    if entropy_share is not None:  # the last point that fits
        found.append(_section(shares, lambda m: m[0] >= entropy_share * math.log(n), 0, GRID))
    if max_repeat is not None:  # the first point that fits
        found.append(_section(shares, lambda m: m[1] <= max_repeat, GRID, 0))
    return max(found)


def _section(shares: DataFrame, fits, held: int, out: int) -> int:
    """The grid point that fits and is nearest to ``out``; ``held`` fits, and whatever lies between it and a point that fits."""
    if fits(_measures(shares, [out])[out]):
        return out
    while abs(out - held) > 1:
        step = max(1, abs(out - held) // _CUTS)
        grid = list(range(min(held, out) + step, max(held, out), step))
        for g, m in sorted(_measures(shares, grid).items(), reverse=held < out):
            if fits(m):
                held = max(held, g) if held < out else min(held, g)
            else:
                out = min(out, g) if held < out else max(out, g)
    return held


def _floor(x: Column) -> Column:
    """Whole tokens of a product of doubles: one that misses an integer by the doubles' own error counts as it."""
    return F.floor(x * F.lit(1 + 1e-12) + F.lit(1e-6)).cast("long")


def plan(shares: DataFrame, grid_exponent: int, budget: int | None) -> DataFrame:
    """(source, tokens, weight, quota, blocks, rest): whole blocks of a source, and tokens of the cut one.

    A quota is the floor of weight times budget, from the weight as it is, so a small
    source keeps its share beside any large one.  Without a budget the quotas are the
    least that give every source one whole block.  A source without tokens gets one block.
    """
    a = grid_exponent / GRID
    power = F.when(F.col("share") > 0, F.exp(F.lit(a) * F.log("share"))).otherwise(0.0)
    z = shares.agg(F.sum(power)).first()[0] or 1.0
    weighted = shares.withColumn("weight", power / F.lit(z))
    if budget is None:
        need = weighted.where("weight > 0").agg(F.max(F.ceil(F.col("tokens") / F.col("weight")))).first()[0] or 0
        quota = F.greatest(_floor(F.col("weight") * F.lit(float(need))), F.col("tokens"))
    else:
        quota = _floor(F.col("weight") * F.lit(float(budget)))
    some = F.col("tokens") > 0
    return weighted.withColumn("quota", quota).select(
        "source", "tokens", "weight", "quota",
        F.when(some, F.expr("quota div greatest(tokens, 1L)")).otherwise(1).cast("long").alias("blocks"),
        F.when(some, F.expr("quota % greatest(tokens, 1L)")).otherwise(0).cast("long").alias("rest"),
    )


def draw(docs: DataFrame, quotas: DataFrame, row: list[str], source_col: str, text_col: str, seed: str = "mix") -> DataFrame:
    """(columns ``row``, source, tokens, block, place): one row per use of a row of ``docs``.

    ``place`` is the row's rank in the block's permutation, which orders the rows by the
    MD5 of seed, block and the first column of ``row``, then by ``row`` and tokens.  The
    cut block holds the rows whose running token sum stays within the quota.  Ranks
    and sums come from range partitions, so a hot source is spread over tasks; only
    narrow rows move.
    """
    narrow = docs.select(*row, F.col(source_col).alias("source"), token_count(F.col(text_col)).alias("tokens"))
    of = quotas.select(F.col("source").alias("of"), "blocks", "rest")
    last = F.col("blocks") - F.when(F.col("rest") > 0, 0).otherwise(1)
    used = (
        write_table(narrow, "mix-rows").join(of, F.col("source").eqNullSafe(F.col("of")))
        .where(last >= 0).withColumn("last", last)
        # in two steps, so no row ever holds an array of more than a thousand blocks or runs of blocks
        .withColumn("run", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"last div {_RUN}L"))))
        .withColumn("block", F.explode(F.sequence(F.col("run") * _RUN, F.least(F.col("last"), F.col("run") * _RUN + (_RUN - 1)))))
        .withColumn("mixed", F.md5(F.concat_ws(":", F.lit(seed), F.col("block").cast("string"), F.coalesce(F.col(row[0]).cast("string"), F.lit("")))))
        .select(*row, "source", "tokens", "block", "blocks", "rest", "mixed")
    )
    placed = ranked(write_table(used, "blocks"), ["source", "block"], ["mixed", *row, "tokens"], "place", "tokens", "used")
    return placed.where("block < blocks or used <= rest").select(*row, "source", "tokens", "block", "place")


def mix(
    docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
    entropy_share: float | None = None, max_repeat: float | None = None, budget_share: float | None = 1.0, seed: str = "mix",
) -> DataFrame:
    """(doc_id, source, tokens, block, place): the uses of every row under the mixture.

    ``entropy_share`` of the largest entropy is met however often that repeats a small
    source, unless ``max_repeat`` is given: then as far as no source is repeated over
    that many times as often as another.
    The budget is ``budget_share`` of the table's tokens, or with None the least that
    uses every row.  Tokens are runs of other than ASCII white space; null and empty
    texts have none and are drawn with the block of their source.  Null ids and sources
    and repeated rows are rows like others.  An empty table gives an empty result;
    other columns are not read.
    """
    shares = source_tokens(docs, source_col, text_col)
    total = shares.agg(F.sum("tokens")).first()[0] or 0
    budget = None if budget_share is None else int(total * budget_share)
    quotas = plan(shares, exponent(shares, entropy_share, max_repeat), budget)
    renamed = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), F.col(text_col).alias("text"))
    return draw(renamed, quotas, ["doc_id"], "source", "text", seed)


def repeat_rows(docs: DataFrame, uses: DataFrame, row: list[str], count: str) -> DataFrame:
    """``docs`` with each row as often as ``uses`` has its key ``row``."""
    n = uses.groupBy(*row).agg(F.count("*").alias(count))
    copy = free_name(docs, "__llm_copy")
    return docs.join(n, row).withColumn(copy, F.explode(F.sequence(F.lit(1).cast("long"), F.col(count)))).drop(copy, count)
