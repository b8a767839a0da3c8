"""Turn the given Parquet tables into dump text, written by Spark to the shared scratch folder.

The loaders read CSV dumps; the test tables are Parquet.  These helpers derive
dumps from the tables (so the work grows with them) and cache the written
folder per (table set, layout) for the session.

* :func:`render_csv` - standard CSV (quotes doubled, fields with newlines
  quoted and spanning lines): the multi-line dialect-L dumps.
* :func:`render_lines` - one pre-built text line per row (dialects T and E).
Both write the header as the first line of every part file, like a dump.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from ..sources.assemble import Dump

_CACHE: dict[tuple, str] = {}


def _cached(spark: SparkSession, key: tuple, write) -> str:
    k = (id(spark),) + key
    if k not in _CACHE:
        path = scratch_path(spark, "dump-" + "-".join(str(x).replace("/", "_")[-40:] for x in key))
        write(path)
        _CACHE[k] = path
    return _CACHE[k]


def render_csv(spark: SparkSession, df: DataFrame, key: tuple, sort: str | None = None) -> str:
    """Write ``df`` as CSV dump files (header per file, quotes doubled); return the folder."""

    def write(path: str) -> None:
        out = df.orderBy(sort) if sort else df
        (
            out.write.option("header", True)
            .option("quote", '"')
            .option("escape", '"')
            .option("lineSep", "\n")
            .option("emptyValue", "")
            .csv(path)
        )

    return _cached(spark, key, write)


def render_lines(
    spark: SparkSession, df: DataFrame, line: Column, header: str, key: tuple, sort: list | None = None
) -> str:
    """Write one text line per row with ``header`` atop every part file; return the folder.

    The CSV writer is used only for its per-file header: a single column, with
    a separator and quote character that never occur, writes each value as is.
    """

    def write(path: str) -> None:
        src = df.orderBy(*sort) if sort else df  # range-partitioned: part files follow the order
        (
            src.select(line.alias(header))
            .write.option("header", True)
            .option("sep", "\u0001")
            .option("quote", "\u0000")
            .option("escape", "\u0000")
            .option("emptyValue", "")
            .option("nullValue", "")
            .option("lineSep", "\n")
            .csv(path)
        )

    return _cached(spark, key, write)


def frame_dump(
    df: DataFrame, raw: Column, header: str, ob: Column, om: Column, name: str, carry: list[str] | None = None
) -> Dump:
    """A :class:`Dump` straight from a DataFrame of pre-built lines (no files).

    ``ob``/``om`` give the file order (``om`` > 0 as for single-line dumps);
    ``carry`` columns of ``df`` ride along through parsing untouched.
    """
    records = df.select(
        F.lit(name).alias("_p"),
        ob.cast("long").alias("_ob"),
        om.cast("long").alias("_om"),
        F.lit(None).cast("long").alias("line_no"),
        raw.alias("raw"),
        *(carry or []),
    )
    headers = df.sparkSession.range(1).select(F.lit(name).alias("_p"), F.lit(header).alias("header"))
    return Dump(records, headers)
