"""SimHash near-duplicates by anchor-point covering.

The anchors are the codewords of two perfect binary Golay codes, laid over bits 0-22
and 23-45 of the fingerprint (2**24 anchors; the other 18 bits take part in the bit
distance alone).  A Golay code covers its 23 bits with radius 3, so every fingerprint
has one home anchor.  If two fingerprints differ in at most ``d`` bits, ``d1`` of them
in the first block and ``d2`` in the second, then the home of one lies within 3 + d1
and 3 + d2 of the other.  So each fingerprint is replicated, as a guest, to every
anchor within covering radius plus threshold (about 68 anchors for two bits), and each
anchor compares the fingerprints at home with its guests.  Every close pair meets
exactly once with the smaller fingerprint at home.
"""

from __future__ import annotations

import itertools
from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from relload.llm.common import ROW_FILE, ROW_KEY, ROW_POS, map_texts, texts_of, with_row_key, write_table
from relload.llm.components import connected_components

SEED = 42
GOLAY_BITS, GOLAY_RADIUS, GOLAY_POLY = 23, 3, 0xC75
BLOCKS = (0, 23)  # first bit of each Golay block
_CHUNK = 1 << 15
_GUESTS = 2000  # fingerprints replicated at a time


def simhash64(data: bytes | None, shingle: int) -> int:
    """The unsigned 64-bit fingerprint of one UTF-8 text; no words (or null) give 0."""
    import numpy as np
    from xxhash import xxh64_intdigest

    words = data.lower().split() if data else []  # bytes: only A-Z fold, only 0x20 and 0x09-0x0D split
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxh64_intdigest(joined, SEED)  # one shingle: its bits are the majority
    size = np.fromiter(map(len, words), np.int64, len(words))
    end = np.cumsum(size + 1) - 1
    start = end - size
    ones, n = np.zeros(64, np.int64), len(words) - shingle + 1
    for at in range(0, n, _CHUNK):
        pairs = zip(start[at : min(n, at + _CHUNK)].tolist(), end[at + shingle - 1 : at + shingle - 1 + _CHUNK].tolist())
        h = np.array([xxh64_intdigest(joined[s:e], SEED) for s, e in pairs], np.uint64)
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """Row key, ``doc_id`` and signed 64-bit ``fp`` of every row; one pass over whole texts."""
    rows = with_row_key(docs, F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for b in batches:
            fp = np.array([simhash64(t, shingle) for t in texts_of(b.column(3))], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(fp)], names=[ROW_FILE, ROW_POS, "doc_id", "fp"])

    schema = T.StructType([*rows.schema.fields[:3], T.StructField("fp", T.LongType())])
    return map_texts(rows, run, schema)


def close_pairs(fps: DataFrame, max_bits: int = 2) -> DataFrame:
    """(a, b), a < b: every pair of distinct values of column ``fp`` at ``max_bits`` bits or fewer.

    A fingerprint has a fixed number of neighbours in that radius (2,080 for two
    bits), so the result is linear in the distinct fingerprints.
    """
    if not 0 <= max_bits <= 2:
        raise ValueError("the anchor tables cover thresholds of 0, 1 or 2 bits")
    distinct = fps.select("fp").where("fp is not null").distinct()

    def guests(batches):
        import pyarrow as pa

        for b in (b.slice(at, _GUESTS) for b in batches for at in range(0, b.num_rows, _GUESTS)):
            anchor, fp, home = anchors_within(b.column(0).to_numpy(), max_bits)
            yield pa.RecordBatch.from_arrays([pa.array(anchor), pa.array(fp), pa.array(home)], names=["anchor", "fp", "home"])

    placed = distinct.mapInArrow(guests, "anchor int, fp long, home boolean")
    at_home = placed.where("home").select("anchor", F.col("fp").alias("a"))
    met = placed.select("anchor", F.col("fp").alias("b"))
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits
    # Spark takes a fingerprint and its guests for one row each, so it would broadcast 68 times what it expects
    return at_home.join(met.hint("merge"), "anchor").where((F.col("a") < F.col("b")) & near).select("a", "b")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """One row per row of ``docs``: row key, doc_id, fp, group (a fingerprint), component_id.

    Rows whose fingerprints link directly or through others share a group, and
    ``component_id`` is the smallest doc_id of the group.  Equal fingerprints meet in
    one aggregated row before anything is replicated, so copies cost nothing beyond
    their scan.  Null, empty and blank texts have fingerprint 0 and are linked like
    any other.  A null doc_id keeps its row and never becomes a component id unless
    the whole group has none (then it is null).  Repeated rows each keep a row.  An
    empty table gives an empty result; other columns are not read.
    """
    rows = write_table(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    low = write_table(rows.groupBy("fp").agg(F.min("doc_id").alias("low")), "distinct-fingerprints")
    roots = connected_components(close_pairs(low, max_bits)).withColumnRenamed("node", "fp")
    linked = low.join(roots, "fp")
    merged = linked.groupBy("root").agg(F.min("low").alias("merged"))
    linked = linked.join(merged, "root").select("fp", "root", "merged")
    named = low.join(linked, "fp", "left").select(
        "fp", F.coalesce("root", "fp").alias("group"), F.coalesce("merged", "low").alias("component_id")
    )
    named = write_table(named, "components")  # so that the join below is a plain one, whose hot fingerprints can be split
    return rows.join(named, "fp").select(*ROW_KEY, "doc_id", "fp", "group", "component_id")


def anchors_within(fps, max_bits: int):
    """Arrays (anchor, fp, is home): each fingerprint at every anchor within radius plus threshold."""
    import numpy as np

    tables = _patterns()
    value = fps.view(np.uint64)
    block = [((value >> np.uint64(s)) & np.uint64((1 << GOLAY_BITS) - 1)).astype(np.int64) for s in BLOCKS]
    syndrome = [_syndrome(v) for v in block]
    anchor, row, home = [], [], []
    for over in itertools.product(range(max_bits + 1), repeat=len(BLOCKS)):
        if sum(over) > max_bits:
            continue
        flips = [tables[x][s] for x, s in zip(over, syndrome)]  # rows x patterns, -1 where there are fewer
        i, p, q = np.nonzero((flips[0][:, :, None] >= 0) & (flips[1][:, None, :] >= 0))
        words = [(block[0][i] ^ flips[0][i, p]) >> 11, (block[1][i] ^ flips[1][i, q]) >> 11]
        anchor.append((words[0] << 12 | words[1]).astype(np.int32))
        row.append(i)
        home.append(np.full(len(i), sum(over) == 0))
    return np.concatenate(anchor), fps[np.concatenate(row)], np.concatenate(home)


def _syndrome(words):
    """The remainder of each 23-bit word modulo the generator polynomial; linear, so the halves are looked up."""
    high, low = _remainders()
    return high[words >> 12] ^ low[words & 0xFFF]


@lru_cache(maxsize=1)
def _remainders():
    import numpy as np

    out = []
    for shift, bits in ((12, 11), (0, 12)):
        s = np.arange(1 << bits, dtype=np.int64) << shift
        for bit in range(GOLAY_BITS - 1, 10, -1):
            s = np.where(s >> bit & 1, s ^ (GOLAY_POLY << (bit - 11)), s)
        out.append(s)
    return out


@lru_cache(maxsize=1)
def _patterns():
    """Per excess x of 0, 1, 2 over the radius: by syndrome, the error patterns that reach an anchor."""
    import numpy as np

    unit = _syndrome(1 << np.arange(GOLAY_BITS))
    found = [[[] for _ in range(1 << 11)] for _ in range(3)]
    for weight in range(GOLAY_RADIUS + 3):
        for bits in itertools.combinations(range(GOLAY_BITS), weight):
            s = 0
            for b in bits:
                s ^= int(unit[b])
            found[max(0, weight - GOLAY_RADIUS)][s].append(sum(1 << b for b in bits))
    out = []
    for rows in found:
        wide = np.full((len(rows), max(map(len, rows))), -1, np.int64)
        for s, r in enumerate(rows):
            wide[s, : len(r)] = r
        out.append(wide)
    return out
