"""Foreign-key membership, violation and the missing-parent sets (JON-1..4, FKR-1, AGG-6).

Parents are read as key sets (``SELECT id``, SRC-8).  Semi and anti joins are plain
equi-joins, so Catalyst chooses broadcast hash (small parent) or sort-merge (large
parent) and AQE splits a skewed child key; flags for wide rows are looked up without
moving them (:func:`with_presence`).  NULL foreign keys reference nothing and never
violate.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.joins import BROADCAST_ROW_LIMIT, bounded_broadcast, is_broadcast, shuffled

BITMAP_LIMIT = 16_384  # bitmaps of 4 KB broadcast at most (64 MB): ids out of 537 million consecutive numbers


def parent_keys(parent: DataFrame, key: str = "id") -> DataFrame:
    """SRC-8: the parent's key column only (column-pruned at the scan)."""
    return parent.select(F.col(key).cast("int").alias("id"))


def _keyed(keys: DataFrame, col: str) -> DataFrame:
    return keys.select(F.col("id").alias(col))


def fk_valid(child: DataFrame, col: str, keys: DataFrame) -> DataFrame:
    """JON-1: child rows whose parent exists (left semi join)."""
    return child.join(_keyed(keys, col), col, "left_semi")


def fk_missing(child: DataFrame, col: str, keys: DataFrame) -> DataFrame:
    """JON-2: child rows whose (non-NULL) parent is missing (left anti join)."""
    return child.filter(F.col(col).isNotNull()).join(_keyed(keys, col), col, "left_anti")


def _missing_bits(missing: DataFrame) -> DataFrame:
    """The ids as bitmaps: one row of 4 KB for every 32,768 consecutive numbers that hold one."""
    bits = F.bitmap_construct_agg(F.bitmap_bit_position("id")).alias("__bits")
    return missing.groupBy(F.bitmap_bucket_number("id").alias("__bucket")).agg(bits)


def _has_bit(bits: Column, id_: Column) -> Column:
    at = F.bitmap_bit_position(id_)
    byte = F.conv(F.hex(F.substring(bits, (F.shiftright(at, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, (at % 8).cast("int")) == 1


def with_presence(
    child: DataFrame,
    col: str,
    keys: DataFrame | None,
    flag: str,
    row_limit: int = BROADCAST_ROW_LIMIT,
    bitmap_limit: int = BITMAP_LIMIT,
) -> DataFrame:
    """Add boolean ``flag``: the row's parent exists, or its FK is NULL, or no parent set was given.

    Presence is decided once per distinct FK value, on narrow tables of ids, so that the
    (possibly wide) child rows stay where they are.  What is broadcast is the first of
    these that its counted bound allows: all distinct values with their answer; the
    missing ids; the missing ids as bitmaps (``BITMAP_LIMIT`` of 4 KB).  Only if there are
    many missing ids that lie too far apart for that, the child is joined by a shuffle.
    """
    if keys is None:
        return child.withColumn(flag, F.lit(True))
    vals = child.select(F.col(col).cast("int").alias("id")).filter(F.col("id").isNotNull()).distinct()
    hits = vals.join(shuffled(keys.select("id").distinct()).withColumn("__hit", F.lit(True)), "id", "left").select(
        F.col("id").alias(f"__{flag}"), F.coalesce(F.col("__hit"), F.lit(False)).alias(f"__{flag}_hit")
    )
    hits = bounded_broadcast(hits, row_limit)
    if is_broadcast(hits):
        joined = child.join(hits, child[col] == F.col(f"__{flag}"), "left")
        present = F.col(col).isNull() | F.coalesce(F.col(f"__{flag}_hit"), F.lit(False))
        return joined.withColumn(flag, present).drop(f"__{flag}", f"__{flag}_hit")
    missing = bounded_broadcast(hits.filter(~F.col(f"__{flag}_hit")).select(F.col(f"__{flag}").alias("id")), row_limit)
    if not is_broadcast(missing):
        bits = bounded_broadcast(_missing_bits(missing), bitmap_limit)
        if is_broadcast(bits):
            at = F.col(col).cast("int")
            joined = child.join(bits, F.bitmap_bucket_number(at) == F.col("__bucket"), "left")
            lost = F.col("__bits").isNotNull() & _has_bit(F.col("__bits"), at)
            return joined.withColumn(flag, ~F.coalesce(lost, F.lit(False))).drop("__bucket", "__bits")
    lost = missing.select(F.col("id").alias(f"__{flag}"))
    if not is_broadcast(missing):
        lost = shuffled(lost)
    return child.join(lost, child[col] == F.col(f"__{flag}"), "left").withColumn(flag, F.col(f"__{flag}").isNull()).drop(f"__{flag}")


def missing_list(checks: Sequence[tuple[str, str]]) -> Column:
    """JON-3: names of the FK columns whose parent is missing (``checks`` = (column, flag))."""
    return F.array_compact(F.array(*[F.when(~F.col(flag), F.lit(col)) for col, flag in checks]))


def fk_reason(col: str, parent: str) -> Column:
    """FKR-1: reason text of a row rejected for an unknown parent."""
    return F.format_string(f"FK violation: {col}=%s not found in {parent}", F.col(col).cast("string"))


def distinct_missing(child: DataFrame, cols: Sequence[str], keys: DataFrame | None) -> DataFrame:
    """AGG-6 / JON-4: distinct referenced ids (over one or more FK columns) absent from the parent.

    The union is de-duplicated before the anti join (map-side partial
    aggregation), so a hot parent id referenced by many rows costs one row.
    """
    ids = None
    for c in cols:
        part = child.select(F.col(c).cast("int").alias("id")).filter(F.col("id").isNotNull())
        ids = part if ids is None else ids.unionByName(part)
    ids = ids.distinct()
    # No parent set given: nothing is known to be missing.
    return ids.limit(0) if keys is None else ids.join(shuffled(keys), "id", "left_anti")
