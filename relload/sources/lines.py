"""Physical-line scan of dump files with the position columns assembly needs.

Every line carries the file it came from (``_p``), the start offset of the
input split that read it (``_b``) and an id that increases with the read order
inside a task (``_m``).  (``_p``, ``_b``, ``_m``) is therefore a total order
that follows the file, without any global sort and without relying on the
partition id (Spark packs several splits into one task by size).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """``value``, ``_p``, ``_b``, ``_m`` for every physical line.

    ``lineSep='\\n'`` matches ``getline``: a CR stays part of the line (the
    default separator would also split on a lone CR).
    """
    if isinstance(paths, str):
        paths = [paths]
    return (
        spark.read.option("lineSep", "\n")
        .text(list(paths))
        .select(
            F.col("value"),
            F.col("_metadata.file_path").alias("_p"),
            F.col("_metadata.file_block_start").alias("_b"),
            F.monotonically_increasing_id().alias("_m"),
        )
    )
