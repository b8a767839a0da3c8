"""Load report (AGG-1..4): counters per batch, failure categories, totals, samples.

``outcomes`` has one row per parsed record: ordinal (``_p``, ``_ob``, ``_om``),
``status`` (inserted / updated / duplicate_noop / rejected), ``reason``,
``category``.  The batch of a record is its position in file order divided by
the batch size (5,000 by default).  Records are range-partitioned by their place and
numbered as they lie; a running sum over one row a partition makes positions of that, so
no window spans records, whatever their places look like.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..plans.caching import cached
from ..plans.joins import bounded_broadcast
from ..session import scratch_path

DEFAULT_BATCH = 5000
BLOCK = 1 << 16  # numbers in one block
PLACE = ("_p", "_ob", "_om")


def numbering_blocks(outcomes: DataFrame) -> DataFrame:
    """Add ``_blk`` and ``_sub``: bounded blocks of records, in file order within a file.

    A record of a multi-line dump is known by the number of its first line; one of a
    single-line dump by its split's place and its line's read id, which counts up by one
    within the split.  Either way a block spans ``BLOCK`` numbers at most.
    """
    many = F.col("_om") == 0
    return outcomes.withColumn("_blk", F.when(many, F.floor(F.col("_ob") / BLOCK)).otherwise(F.col("_ob"))).withColumn(
        "_sub", F.when(many, F.lit(0)).otherwise(F.floor(F.col("_om") / BLOCK)).cast("long")
    )


def with_position(outcomes: DataFrame) -> DataFrame:
    """Add ``pos``: 0-based position of the record over all files in file order.

    The sorted partitions are written once, so that both the counts and the numbers see
    the same ones.  Records without a place (null file, record or line) have no position
    and are left out, but count for those behind them.
    """
    x = cached(outcomes)  # read twice: for the bounds of the ranges and for the sort
    x = x.repartitionByRange(*PLACE).sortWithinPartitions(*PLACE)
    x = x.withColumn("_part", F.spark_partition_id()).withColumn("_read", F.monotonically_increasing_id())
    path = scratch_path(outcomes.sparkSession, "positions")
    x.write.parquet(path)
    x = outcomes.sparkSession.read.schema(x.schema).parquet(path)
    parts = x.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"), F.min("_read").alias("_first"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row a partition
    parts = parts.select("_part", "_first", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_off"))
    placed = x.where(" and ".join(f"{c} is not null" for c in PLACE)).join(bounded_broadcast(parts), "_part")
    return placed.withColumn("pos", F.col("_off") + F.col("_read") - F.col("_first")).drop("_part", "_read", "_first", "_off")


def with_batch(outcomes: DataFrame, batch_size: int = DEFAULT_BATCH) -> DataFrame:
    return with_position(outcomes).withColumn("batch", F.floor(F.col("pos") / batch_size).cast("long"))


def _counts():
    s = F.col("status")
    return [
        F.count(F.lit(1)).alias("attempted"),
        F.count_if(s == "inserted").alias("inserted"),
        F.count_if(s == "updated").alias("updated"),
        F.count_if(s == "duplicate_noop").alias("duplicate_noop"),
        F.count_if(s == "rejected").alias("rejected"),
        # the original loaders count no-ops and updates as inserted (D9)
        F.count_if(s != "rejected").alias("reference_inserted"),
    ]


def batch_report(outcomes: DataFrame, batch_size: int = DEFAULT_BATCH, demands: DataFrame | None = None) -> DataFrame:
    """AGG-1: per-batch counters and the position range of the batch.

    With ``demands`` (missing parents and the first record that needs each), also how
    many placeholders each batch made necessary.
    """
    b = with_batch(outcomes, batch_size)
    out = b.groupBy("batch").agg(*_counts(), F.min("pos").alias("first_pos"), F.max("pos").alias("last_pos"))
    if demands is None:
        return out
    made = demands.join(b.select("_p", "_ob", "_om", "batch"), ["_p", "_ob", "_om"]).groupBy("batch").agg(F.count(F.lit(1)).alias("placeholders"))
    return out.join(made, "batch", "left").withColumn("placeholders", F.coalesce(F.col("placeholders"), F.lit(0).cast("long")))


def failure_categories(outcomes: DataFrame) -> DataFrame:
    """AGG-2: rejected rows per category (first failing check decides)."""
    return outcomes.filter(F.col("status") == "rejected").groupBy("category").agg(F.count(F.lit(1)).alias("n"))


def totals(outcomes: DataFrame, placeholder_ids: DataFrame | None = None) -> DataFrame:
    """AGG-3: run totals; with the created ids (parent, id), also how many there are."""
    out = outcomes.agg(*_counts())
    if placeholder_ids is None:
        return out
    return out.crossJoin(placeholder_ids.agg(F.count(F.lit(1)).alias("placeholders")))  # one row each


def sample_failures(outcomes: DataFrame, per_batch: int = 5, batch_size: int = DEFAULT_BATCH) -> DataFrame:
    """AGG-4: the first ``per_batch`` failures of every batch (a batch is bounded)."""
    b = with_batch(outcomes, batch_size).filter(F.col("status") == "rejected")
    w = Window.partitionBy("batch").orderBy("pos")
    return b.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= per_batch).drop("_rn")


def first_bad_records(outcomes: DataFrame, n: int = 10) -> DataFrame:
    """AGG-4: the first ``n`` rejected records of the run (a top-k; the limit is the feature)."""
    return outcomes.filter(F.col("status") == "rejected").orderBy("_p", "_ob", "_om").limit(n)
