"""Helpers the operators share: row keys, written tables, free column names."""

from __future__ import annotations

import re
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F

from relload.session import scratch_root

# Row key columns: a hash of the file's path and the row's position in that file.
# They do not depend on how Spark cuts the files into tasks, so two scans of one
# table agree even when executors come and go between them.
ROW_FILE, ROW_POS = "__llm_file", "__llm_pos"
ROW_KEY = [ROW_FILE, ROW_POS]

ARROW_LIMITS = {"spark.sql.execution.arrow.maxRecordsPerBatch": 500, "spark.sql.execution.arrow.maxBytesPerBatch": 8 << 20}

ASCII_UPPER, ASCII_LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def write_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared scratch folder and read it back.

    This cuts the lineage: the rows survive lost executors and the plan that made
    them is not run again.
    """
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/llm/{re.sub(r'[^A-Za-z0-9]+', '-', name)}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_table(df: DataFrame) -> None:
    """Delete the files of a table that ``write_table`` made."""
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if "/llm/" in folder:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def release_shuffles(spark: SparkSession) -> None:
    """Ask the driver to drop the shuffle files of plans that no one holds any more.

    Spark's context cleaner deletes them when the driver's JVM collects its garbage,
    which on an idle driver may be half an hour later.
    """
    spark.sparkContext._jvm.System.gc()


def as_files(df: DataFrame) -> DataFrame:
    """``df`` itself if it is a Parquet scan whose rows have places in files, else a written copy."""
    try:
        df.select("_metadata.file_path", "_metadata.row_index").schema
        return df
    except AnalysisException:
        return write_table(df, "input")


def with_row_key(df: DataFrame, *cols) -> DataFrame:
    """``cols`` of ``df`` plus the row key; a frame that is no file scan is written first."""
    place = F.xxhash64(F.col("_metadata.file_path")).alias(ROW_FILE), F.col("_metadata.row_index").alias(ROW_POS)
    return as_files(df).select(*place, *cols)


def free_name(df: DataFrame, base: str) -> str:
    """``base``, lengthened until no column of ``df`` has that name."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base


def ascii_lower(col):
    """Lower-case A-Z alone."""
    return F.translate(col, ASCII_UPPER, ASCII_LOWER)


def held_out(doc_id):
    """The rows no model learns from: crc32 of the id as text leaves 2 modulo 4."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def map_texts(df: DataFrame, function, schema) -> DataFrame:
    """``df.mapInArrow`` with batches that stay small however long the texts are.

    The session's limits on rows and bytes of an Arrow batch are lowered, never raised:
    a Python worker holds a few copies of its batch beside the executor's heap.
    """
    for key, most in ARROW_LIMITS.items():
        now = df.sparkSession.conf.get(key, None)
        if now is not None and not 0 < int(re.sub(r"\D", "", now) or 0) <= most:
            df.sparkSession.conf.set(key, str(most))
    return df.mapInArrow(function, schema)


def texts_of(column) -> list:
    """The values of an Arrow string column as UTF-8 bytes (None for null)."""
    import pyarrow as pa

    return column.cast(pa.binary()).to_pylist()


def ranked(df: DataFrame, groups: list[str], order: list[str], rank: str, weight: str | None = None, total: str | None = None) -> DataFrame:
    """``df`` with ``rank``: each row's place (from 0) among the rows of its ``groups`` values.

    With ``weight``, also ``total``: the sum of that column over the group's rows up to
    and including this one.

    Rows are range-partitioned by (groups, order) and sorted inside each task; one row
    per task and group carries the counts that turn a place in a task into a place in
    the group.  No task holds a whole group.  ``order`` should tell rows apart; rows
    that tie in all of it may land in either order.
    """
    part, mid, first, rows, sums = (free_name(df, f"__llm_{x}") for x in ("part", "mid", "first", "rows", "sums"))
    placed = write_table(
        df.repartitionByRange(*groups, *order)
        .sortWithinPartitions(*groups, *order)
        .withColumn(part, F.spark_partition_id())
        .withColumn(mid, F.monotonically_increasing_id()),
        "sorted",
    )
    adds = [F.count("*").alias(rows)] + ([F.sum(weight).alias(sums)] if weight else [])
    runs = placed.groupBy(*groups, part).agg(F.min(mid).alias(first), *adds)
    earlier = Window.partitionBy(*groups).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    keys, same = [], F.lit(True)
    for i, g in enumerate([*groups, part]):
        name = free_name(df, f"__llm_group_{i}")
        keys.append(F.col(g).alias(name))
        same = same & F.col(g).eqNullSafe(F.col(name))
    for c in (rows, sums) if weight else (rows,):
        keys.append(F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(c))
    out = placed.join(runs.select(*keys, first), same).withColumn(rank, F.col(mid) - F.col(first) + F.col(rows))
    if weight:
        here = Window.partitionBy(*groups, part).orderBy(mid).rowsBetween(Window.unboundedPreceding, 0)
        out = out.withColumn(total, F.sum(weight).over(here) + F.col(sums))
    return out.select(*df.columns, rank, *([total] if weight else []))
