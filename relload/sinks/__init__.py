"""Sinks (SNK-1..4): target tables, bad-record CSVs and placeholder-id CSVs.

Only these functions act; everything else returns DataFrames.  Each writes a
whole directory with Spark's committers, so a re-run (or a replayed streaming
batch) replaces its output instead of appending twice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CSV_OPTS = {"header": "true", "quoteAll": "true", "escape": '"', "lineSep": "\n"}


def write_table(df: DataFrame, path: str, mode: str = "overwrite", partition_by: Sequence[str] = ()) -> None:
    """SNK-1: the new state of a target table as Parquet (parents are written before children)."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def bad_records_typed(rejects: DataFrame, columns: Sequence[str]) -> DataFrame:
    """SNK-2 rows: the table's columns in fixed order plus ``reason``."""
    return rejects.orderBy("_p", "_ob", "_om").select(*[F.col(c).cast("string").alias(c) for c in columns], "reason")


def bad_records_raw(rejects: DataFrame) -> DataFrame:
    """SNK-3 rows: ``reason``, ``raw_record``."""
    return rejects.orderBy("_p", "_ob", "_om").select("reason", F.col("raw").alias("raw_record"))


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """SNK-2/3/4 writer: every field quoted, quotes doubled (SCL-12)."""
    df.write.mode(mode).options(**CSV_OPTS).csv(path)


def write_placeholder_ids(ids: DataFrame, path: str, mode: str = "overwrite") -> None:
    """SNK-4: the created placeholder ids, one folder per parent table."""
    ids.write.mode(mode).partitionBy("parent").options(**CSV_OPTS).csv(path)
