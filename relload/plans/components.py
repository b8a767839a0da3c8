"""Connected components of an edge table by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path


def _write(df: DataFrame) -> DataFrame:
    path = scratch_path(df.sparkSession, "edges")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _drop(df: DataFrame) -> None:
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every end of an edge (a, b); root is the component's smallest node.

    Each round is two aggregations and two joins on the edge table alone, written to
    the shared folder, so no task holds a component and a lost executor costs one
    round.  A node with very many edges is pre-aggregated for its minimum, and
    adaptive execution splits its rows in the join.  Rounds grow with the logarithm
    of the longest path.  Null ends and loops are ignored; no edges, no rows.
    """
    cur = _write(
        edges.where("a is not null and b is not null and a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct()
    )
    seen = None
    while True:
        mark = cur.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if mark == seen or mark[0] == 0:
            break
        seen = mark
        nxt = _write(_small_star(_large_star(cur)))
        _drop(cur)
        cur = nxt
    pairs = cur.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return pairs.union(cur.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _large_star(cur: DataFrame) -> DataFrame:
    """Hang every larger neighbour of a node on the node's smallest neighbour."""
    both = cur.union(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(cur: DataFrame) -> DataFrame:
    """Hang a node and its smaller neighbours on the smallest of them."""
    low = cur.groupBy("u").agg(F.min("v").alias("m"))
    moved = cur.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(low.select("u", F.col("m").alias("v"))).distinct()
