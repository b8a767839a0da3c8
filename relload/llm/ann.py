"""Approximate nearest neighbours over shifted space-filling curves.

Each curve projects the vectors on a few random orthogonal directions, shifts and
cuts every projection into equally likely cells and orders the vectors by the Hilbert
key of their cell.  The orderings are range-partitioned by Spark; every run of
``block`` neighbours on a curve forms a window.  A query meets its own window and those
beside it on every curve; each window reranks by the exact inner product, and the
windows' best are merged.

How far a query looks along the curves is learned at every run: the true neighbours of
a few queries, found by brute force, must lie within that distance on some curve for
the asked share of them.  Vectors without clusters need a distance proportional to the
rows, so their work grows with rows x queries; clustered ones need little.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from relload.llm.common import ranked, write_table

SAMPLE = 4096  # distinct vectors that the cells of the curves are fitted on, at most
PROBES = 64  # distinct queries whose true neighbours set the width, at most
MOST = 8192  # rows in a window, at most; beyond it a query meets more windows
CELLS = 1 << 22  # scores held at once by a window


def search(
    vectors: DataFrame, is_query: Column, id_col: str = "vec_id", vec_col: str = "embedding",
    k: int = 20, curves: int = 32, dims: int = 8, bits: int = 4, block: int = 512, seed: int = 7, recall: float = 0.95,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` rows of largest inner product found per query row.

    ``block`` is the least distance that a query looks along a curve; it looks further
    where ``recall`` of the probes' true neighbours takes that.

    Nearest first, ties to the smaller id.  Candidates are all rows but the query's
    own.  Vectors that are null, all zero, or hold null or non-finite components take
    no part, nor do those whose length is not the table's most common one (of equally
    common lengths, the larger).  Equal vectors are searched once, with their k + 1
    smallest ids, which is all that any answer can need; so copies and repeated rows
    are whole candidates however many there are.  Rows with a null id take no part.
    Fewer than ``k`` candidates give fewer rows; an empty table gives none.
    """
    vec = F.col(vec_col)
    rows = vectors.select(F.col(id_col).alias("id"), vec.cast("array<double>").alias("v"), is_query.alias("is_query"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(F.col("id").isNotNull() & (F.size("v") > 0)).where(finite & F.exists("v", lambda x: x != 0))
    common = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    width = common["d"] if common else 1
    rows = write_table(rows.where(F.size("v") == width), "vectors")

    nth = Window.partitionBy("v").orderBy("id")
    few = rows.select("id", "v", F.row_number().over(nth).alias("nth")).where(F.col("nth") <= k + 1)
    groups = few.groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    asked = rows.where("is_query").select("v").distinct().withColumn("asked", F.lit(True))
    groups = write_table(
        groups.join(asked, "v", "left").select(
            F.monotonically_increasing_id().alias("g"), "v", "ids", F.coalesce("asked", F.lit(False)).alias("asked")
        ),
        "distinct-vectors",
    )
    met = _windows(groups, width, k, curves, dims, bits, block, seed, recall)
    best = Window.partitionBy("q").orderBy(F.desc("score"), "first_id")
    merged = (
        met.repartition("q").groupBy("q", "c").agg(F.max("score").alias("score"), F.min("first_id").alias("first_id"))
        .withColumn("nth", F.row_number().over(best)).where(F.col("nth") <= k + 1)
    )
    single = Window.partitionBy("q").orderBy(F.desc("score"), "id", "c")
    found = (
        merged.join(groups.select(F.col("g").alias("c"), "ids"), "c")
        .select("q", "c", "score", F.explode("ids").alias("id"))
        .withColumn("nth", F.row_number().over(single)).where(F.col("nth") <= k + 1)
        .groupBy("q").agg(F.sort_array(F.collect_list(F.struct("nth", "id", "c", "score"))).alias("found"))
    )
    queries = rows.where("is_query").join(groups.where("asked").select("v", "g"), "v").select(F.col("id").alias("query_id"), "g")
    # the query's own row, if it is among the k + 1
    own = F.array_position(F.transform("found", lambda x: (x["id"] == F.col("query_id")) & (x["c"] == F.col("g"))), True)
    return (
        queries.join(found, queries["g"] == found["q"])
        .withColumn("own", own)
        .select("query_id", F.posexplode(F.slice(F.filter("found", lambda x, i: i + 1 != F.col("own")), 1, k)).alias("i", "hit"))
        .select("query_id", (F.col("i") + 1).cast("int").alias("rank"), F.col("hit.id").alias("vec_id"), F.col("hit.score").alias("score"))
    )


def _windows(groups: DataFrame, width: int, k: int, curves: int, dims: int, bits: int, block: int, seed: int, recall: float) -> DataFrame:
    """(q, c, score, first_id): the best of every window for every query that meets it."""
    import numpy as np
    import pyarrow as pa

    sample = groups.select("v").orderBy(F.xxhash64("v")).limit(SAMPLE).toPandas()["v"]
    fit = np.stack(sample) if len(sample) else np.ones((1, width))
    places = [_curve(width, c, min(dims, width), fit, seed) for c in range(curves)]

    def keys(batches):
        for b in batches:
            n = b.num_rows
            v = b.column(1).flatten().to_numpy().reshape(n, width)
            out = [hilbert_key(_cells(v, p, bits), bits) for p in places]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.tile(b.column(0).to_numpy(), curves)), pa.array(np.repeat(np.arange(curves, dtype=np.int32), n)), pa.array(np.concatenate(out).view(np.int64))],
                names=["g", "curve", "key"],
            )

    keyed = groups.select("g", "v").mapInArrow(keys, "g long, curve int, key long")
    placed = ranked(keyed, ["curve"], ["key", "g"], "pos").select("g", "curve", "pos")
    far = max(block, _reach(groups, placed, width, k, recall))
    block = min(far, max(block, MOST))
    sides = -(-far // block)  # windows on either side that a query meets
    at = placed.select("g", "curve", F.floor(F.col("pos") / block).alias("block"))
    places_of = at.groupBy("g").agg(F.collect_list(F.struct("curve", "block")).alias("at"))
    vec32 = F.col("v")
    rows = places_of.join(groups.select("g", vec32, F.col("ids")[0].alias("first_id"), "asked"), "g")
    beside = F.flatten(F.transform("at", lambda p: F.transform(F.sequence(F.lit(-sides), F.lit(sides)), lambda d: F.struct(p["curve"].alias("curve"), (p["block"] + d).alias("block")))))
    guests = rows.where("asked").select("g", "v", "first_id", F.lit(True).alias("asks"), F.explode(beside).alias("p"))
    residents = rows.select("g", "v", "first_id", F.lit(False).alias("asks"), F.explode("at").alias("p"))
    window = residents.union(guests).select("g", "v", "first_id", "asks", "p.curve", "p.block")

    def rerank(table):
        asks = table.column("asks").to_numpy(zero_copy_only=False)
        g = table.column("g").to_numpy()
        first = table.column("first_id").to_numpy()
        v = table.column("v").combine_chunks().flatten().to_numpy().reshape(len(g), width)
        asking, held = np.flatnonzero(asks), np.flatnonzero(~asks)
        parts = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
        best, step = min(k + 1, len(held)), max(1, CELLS // max(1, len(held)))
        for i in range(0, len(asking) if best else 0, step):
            score = v[asking[i : i + step]] @ v[held].T
            q, c = np.nonzero(score >= np.partition(score, -best, axis=1)[:, -best][:, None])
            parts.append((asking[i + q], held[c], score[q, c]))
        q, c, score = (np.concatenate(x) for x in zip(*parts))
        return pa.table({"q": g[q], "c": g[c], "score": score, "first_id": first[c]})

    schema = f"q long, c long, score double, first_id {dict(window.dtypes)['first_id']}"
    return window.groupBy("curve", "block").applyInArrow(rerank, schema)


def _reach(groups: DataFrame, placed: DataFrame, width: int, k: int, recall: float) -> int:
    """Distance within which, on the curve where they lie closest, ``recall`` of the probes' true neighbours lie."""
    import numpy as np
    import pyarrow as pa

    probes = groups.where("asked").select("g", "v").orderBy(F.xxhash64("v"), "g").limit(PROBES).toPandas()
    if not len(probes):
        return 0
    own, asked = probes["g"].to_numpy(), np.stack(probes["v"])

    def nearest(batches):
        for b in batches:
            g = b.column(0).to_numpy()
            score = asked @ b.column(1).flatten().to_numpy().reshape(b.num_rows, width).T
            score[own[:, None] == g[None, :]] = -np.inf
            best = np.argsort(-score, axis=1, kind="stable")[:, :k]
            q = np.repeat(np.arange(len(own)), best.shape[1])
            yield pa.RecordBatch.from_arrays([pa.array(own[q]), pa.array(g[best.ravel()]), pa.array(score[q, best.ravel()])], names=["q", "c", "score"])

    order = Window.partitionBy("q").orderBy(F.desc("score"), "c")
    true = groups.select("g", "v").mapInArrow(nearest, "q long, c long, score double").where("q <> c")
    true = true.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= k).select("q", "c").toPandas()  # k rows a probe
    if not len(true):
        return 0
    asks = groups.sparkSession.createDataFrame([(int(g),) for g in sorted({*true["q"], *true["c"]})], "g long")
    at = placed.join(F.broadcast(asks), "g").toPandas().pivot(index="g", columns="curve", values="pos")  # a row a curve for each
    apart = np.abs(at.loc[true["q"]].to_numpy() - at.loc[true["c"]].to_numpy()).min(axis=1)
    return int(np.quantile(apart, recall, method="higher"))


def _curve(width: int, curve: int, dims: int, fit, seed: int):
    """Directions, centre, scale and shift of one curve; curves of one rotation use its directions in turn."""
    import numpy as np

    turn, part = divmod(curve, max(1, width // dims))
    rotation = np.linalg.qr(np.random.default_rng([seed, turn]).standard_normal((width, width)))[0]
    axes = rotation[:, part * dims : (part + 1) * dims]
    shift = np.random.default_rng([seed, turn, part]).uniform(-0.25, 0.25, axes.shape[1])
    along = fit @ axes
    return axes, along.mean(axis=0), np.maximum(along.std(axis=0), 1e-12), shift


def _cells(v, place, bits: int):
    """Cell numbers, 0 to 2**bits - 1, of each vector along the curve's directions."""
    import numpy as np

    axes, centre, scale, shift = place
    z = (v @ axes - centre) / scale + shift
    share = 1 / (1 + np.exp(-1.702 * np.clip(z, -30, 30)))  # close to the normal distribution function
    return np.minimum((share * 2**bits).astype(np.uint64), np.uint64(2**bits - 1))


def hilbert_key(cells, bits: int):
    """Place on the Hilbert curve of each row of cell numbers (Skilling's transposed form, read out bit by bit)."""
    import numpy as np

    x, one = cells.T.copy(), np.uint64(1)
    for level in range(bits - 1, 0, -1):
        bit, low = one << np.uint64(level), (one << np.uint64(level)) - one
        for axis in range(len(x)):
            set_ = (x[axis] & bit) != 0
            swap = np.where(set_, np.uint64(0), (x[0] ^ x[axis]) & low)
            x[0] = np.where(set_, x[0] ^ low, x[0]) ^ swap
            x[axis] ^= swap
    for axis in range(1, len(x)):
        x[axis] ^= x[axis - 1]
    turn = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        bit = one << np.uint64(level)
        turn = np.where((x[-1] & bit) != 0, turn ^ (bit - one), turn)
    x ^= turn
    key = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for axis in range(len(x)):
            key = (key << one) | ((x[axis] >> np.uint64(level)) & one)
    return key
