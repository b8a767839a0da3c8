"""Repeated passages by common-prefix interval trees over enhanced suffix arrays.

Two places that share ``length`` bytes also share the smallest-hashed ``gram`` bytes
inside them, at the same offset.  So every window of ``length`` bytes is filed under
its smallest-hashed gram, its *anchor*; neighbouring windows with one anchor form a
*segment* (about 80 window starts).  Counting anchors and segments over the whole
corpus, with map-side sums, leaves three kinds of segments:

* the anchor occurs once: none of its windows repeats;
* the segment occurs as a whole elsewhere: all of its windows repeat;
* the anchor is shared but the segment is unlike the others (an edge of a repeat).

The distinct segments of the shared anchors are gathered by anchor.  Each task sorts
the window starts of a few anchors into a suffix array, finds the common prefixes of
neighbours, and a stack scan turns them into the tree of common-prefix intervals.  An
interval whose occurrences are preceded by different bytes is a maximal repeat.  The
tree has one row per interval and one per occurrence, so its size is linear even
where the repeats nest.  Anchors with more than ``crowd`` distinct segments go an exact
other way that needs no group in one task: their windows are counted by hash.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from relload.llm.common import ROW_FILE, ROW_KEY, ROW_POS, map_texts, release_shuffles, texts_of, with_row_key, write_table

GRAM = 40
CROWD = 4000
_CHUNK = 1 << 20  # window starts handled at a time in one text
_TREE_BYTES = 2 << 20  # segment bytes of one suffix array, beyond which the next anchor starts another
_ODD = 0x5851F42D4C957F2D

TREE_SCHEMA = "kind string, file long, pos long, start int, length int, node long, parent long, size int, maximal boolean, copies long"


def repeat_trees(rows: DataFrame, length: int = 200, gram: int = GRAM, crowd: int = CROWD) -> tuple[DataFrame, DataFrame]:
    """Interval trees and whole repeated segments of ``rows`` (row key, ``text``).

    The first frame has rows of two kinds.  ``interval``: ``node``, ``parent`` (null at a
    root), common prefix ``length``, ``size`` (distinct occurrences below it) and
    ``maximal`` (they are preceded by different bytes).  ``occurrence``: where (row key
    as ``file`` and ``pos``, byte ``start``), the deepest interval ``node`` it belongs to,
    that interval's ``length``, and ``copies``: the number of equal segments this one
    stands for.  All occurrences of a group are those below its node.  The second frame
    lists the repeated segments by place: row key and segment hash ``sh``.
    """
    if not 0 < gram < length:
        raise ValueError("gram must be shorter than length")
    texts = rows.where(F.octet_length("text") >= length)

    def file_anchors(batches):
        import numpy as np
        import pyarrow as pa

        for b in batches:
            kept, kh, sh, n = [], [], [], []
            for i, data in enumerate(texts_of(b.column(2))):
                k, s, *_ = segments(data, length, gram)
                s, first, count = np.unique(s, return_index=True, return_counts=True)
                kept.append(np.full(len(s), i))
                kh.append(k[first]), sh.append(s), n.append(count)
            if kept:
                at = np.concatenate(kept)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(b.column(c).to_numpy()[at]) for c in (0, 1)]
                    + [pa.array(np.concatenate(x).view(np.int64)) for x in (kh, sh)]
                    + [pa.array(np.concatenate(n).astype(np.int32))],
                    names=[ROW_FILE, ROW_POS, "kh", "sh", "n"],
                )

    filed = map_texts(texts.select(*ROW_KEY, "text"), file_anchors, f"{ROW_FILE} long, {ROW_POS} long, kh long, sh long, n int")
    shared = filed.groupBy("kh").agg(F.sum("n").alias("all")).where(F.col("all") > 1).select("kh")
    filed = write_table(filed.join(shared, "kh", "left_semi"), "anchors")
    release_shuffles(rows.sparkSession)

    distinct = write_table(
        filed.groupBy("kh", "sh").agg(F.sum("n").alias("n"), F.first(ROW_FILE).alias(ROW_FILE), F.first(ROW_POS).alias(ROW_POS)),
        "segments",
    )
    mixed = distinct.groupBy("kh").agg(F.count("*").alias("kinds")).where(F.col("kinds") > 1)
    wanted = (
        distinct.join(mixed, "kh")
        .groupBy(*ROW_KEY)
        .agg(F.collect_list(F.struct("sh", "n", (F.col("kinds") > crowd).alias("crowded"))).alias("wanted"))
    )
    cut = texts.select(*ROW_KEY, "text").join(wanted.hint("shuffle_hash"), ROW_KEY)

    def cut_segments(batches):
        import numpy as np
        import pyarrow as pa

        for b in batches:
            out = {c: [] for c in ("file", "pos", "kh", "start", "copies", "before", "part", "data")}
            for f, p, data, wanted in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), texts_of(b.column(2)), b.column(3)):
                kh, sh, st, en, an = segments(data, length, gram)
                sh, kh = sh.view(np.int64), kh.view(np.int64)
                order = np.argsort(sh, kind="stable")
                for w in wanted.as_py():
                    i = order[np.searchsorted(sh, w["sh"], sorter=order)]
                    a, z = int(st[i]), int(en[i])
                    if not w["crowded"]:
                        parts = [(int(kh[i]), a, data[a : z - 1 + length])]
                    else:  # one row a window, named by its place about the anchor and its content
                        parts = [(_content(data[s : s + length], int(an[i]) - s), s, None) for s in range(a, z)]
                    for key, s, piece in parts:
                        for c, v in zip(out, (f, p, key, s, w["n"], data[s - 1] if s else -1, w["crowded"], piece)):
                            out[c].append(v)
                    if len(out["pos"]) > 20000:
                        yield pa.RecordBatch.from_pydict(out, schema=arrow)
                        out = {c: [] for c in out}
            yield pa.RecordBatch.from_pydict(out, schema=arrow)

    import pyarrow as pa

    arrow = pa.schema([("file", pa.int64()), ("pos", pa.int64()), ("kh", pa.int64()), ("start", pa.int32()), ("copies", pa.int64()), ("before", pa.int16()), ("part", pa.bool_()), ("data", pa.binary())])
    pieces = write_table(
        map_texts(cut, cut_segments, "file long, pos long, kh long, start int, copies long, before short, part boolean, data binary"), "pieces"
    )
    release_shuffles(rows.sparkSession)

    trees = (
        pieces.where("not part").drop("part").repartition("kh").sortWithinPartitions("kh")
        .mapInArrow(lambda batches: _trees(batches, length), TREE_SCHEMA)
    )
    crowded = pieces.where("part").select("file", "pos", "kh", "start", "copies")
    often = crowded.groupBy("kh").agg(F.count("*").alias("size")).where(F.col("size") > 1)
    windows = crowded.join(often, "kh").select(
        F.lit("occurrence").alias("kind"), "file", "pos", "start", F.lit(length).alias("length"), F.col("kh").alias("node"),
        F.lit(None).cast("long").alias("parent"), F.col("size").cast("int").alias("size"), F.lit(None).cast("boolean").alias("maximal"), "copies",
    )
    whole = filed.join(distinct.where(F.col("n") > 1).select("kh", "sh"), ["kh", "sh"]).select(*ROW_KEY, "sh")
    return write_table(trees.unionByName(windows), "interval-trees"), whole


def strip_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 200, gram: int = GRAM, crowd: int = CROWD) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, spans (start, end of each maximal repeated run), kept (bytes).

    A byte is repeated if some string of ``length`` bytes that covers it also starts
    anywhere else, in the same text or another.  Texts are UTF-8 bytes; null and empty
    texts, and those shorter than ``length``, have no repeats.  Repeated rows repeat
    each other.  Null ids keep their rows; an empty table gives an empty result; other
    columns are not read.
    """
    rows = with_row_key(docs, F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    trees, whole = repeat_trees(rows, length, gram, crowd)
    one = trees.where("kind = 'occurrence' and copies = 1").select(
        F.col("file").alias(ROW_FILE), F.col("pos").alias(ROW_POS), F.lit(None).cast("long").alias("sh"),
        F.struct("start", (F.col("start") + F.col("length")).alias("end")).alias("span"),
    )
    all_ = one.unionByName(whole.withColumn("span", F.lit(None).cast(one.schema["span"].dataType)))
    cover = all_.groupBy(*ROW_KEY).agg(F.collect_list("sh").alias("sh"), F.collect_list("span").alias("span"))
    joined = rows.join(cover.hint("shuffle_hash"), ROW_KEY, "left").select("doc_id", "text", "sh", "span.start", "span.end")

    def apply(batches):
        import numpy as np
        import pyarrow as pa

        for b in batches:
            size, spans, kept = [], [], []
            for data, sh, start, end in zip(texts_of(b.column(1)), b.column(2), b.column(3), b.column(4)):
                data = data or b""
                step = np.zeros(len(data) + 1, np.int32)
                if sh.is_valid:
                    np.add.at(step, start.values.to_numpy(), 1)
                    np.add.at(step, end.values.to_numpy(), -1)
                    if len(sh.values):
                        _, h, st, en, _ = segments(data, length, gram)
                        hit = np.isin(h.view(np.int64), sh.values.to_numpy())
                        np.add.at(step, st[hit], 1)
                        np.add.at(step, en[hit] - 1 + length, -1)
                covered = np.concatenate(([False], np.cumsum(step)[:-1] > 0, [False]))
                edge = np.flatnonzero(covered[1:] != covered[:-1])
                size.append(len(data))
                spans.append([{"start": s, "end": e} for s, e in edge.reshape(-1, 2).tolist()])
                kept.append(np.frombuffer(data, np.uint8)[~covered[1:-1]].tobytes())
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(size, pa.int64()), pa.array(spans, kind), pa.array(kept, pa.binary())], names=["doc_id", "n_bytes", "spans", "kept"])

    span = T.StructType().add("start", T.LongType()).add("end", T.LongType())
    schema = T.StructType([joined.schema["doc_id"]]).add("n_bytes", T.LongType()).add("spans", T.ArrayType(span)).add("kept", T.BinaryType())
    return map_texts(joined, apply, schema)


def _content(window: bytes, offset: int) -> int:
    return int.from_bytes(hashlib.blake2b(window, digest_size=8, salt=offset.to_bytes(4, "little")).digest(), "little", signed=True)


@lru_cache(maxsize=None)
def _powers(n: int):
    """Powers of an odd base and of its inverse modulo 2**64, and a random value for each byte."""
    import numpy as np

    out = []
    for base in (_ODD, pow(_ODD, -1, 2**64)):
        p, m = np.ones(n, np.uint64), 1
        while m < n:
            e = min(m, n - m)
            p[m : m + e] = p[:e] * np.uint64(pow(base, m, 2**64))
            m += e
        out.append(p)
    return out[0], out[1], np.random.default_rng(7).integers(0, 2**64, 256, dtype=np.uint64)


def _mix(x):
    import numpy as np

    for _ in range(2):
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def segments(data: bytes, length: int, gram: int):
    """Arrays (anchor hash, segment hash, first window start, end of window starts, anchor place) of one text."""
    import numpy as np

    n = len(data) - length + 1  # window starts
    parts = [_segments(data, at, min(n, at + _CHUNK), length, gram) for at in range(0, n, _CHUNK)]
    if not parts:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64), *(np.zeros(0, np.int64) for _ in range(3))
    return parts[0] if len(parts) == 1 else tuple(map(np.concatenate, zip(*parts)))


def _segments(data: bytes, lo: int, hi: int, length: int, gram: int):
    import numpy as np

    a = np.frombuffer(data, np.uint8)[lo : hi - 1 + length]
    n = len(a)
    up, down, value = _powers(1 << max(14, (n + 1).bit_length()))
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(value[a] * up[:n], out=total[1:])
    grams = _mix((total[gram:] - total[:-gram]) * down[: n - gram + 1])
    # smallest hash of each window, the leftmost of equals: high half hash, low half place
    low = (grams & np.uint64(0xFFFFFFFF00000000)) | np.arange(n - gram + 1, dtype=np.uint64)
    span, width = length - gram + 1, 1
    while width * 2 <= span:
        low, width = np.minimum(low[:-width], low[width:]), width * 2
    if width < span:
        low = np.minimum(low[: len(low) - span + width], low[span - width :])
    anchor = (low & np.uint64(0xFFFFFFFF)).astype(np.int64)
    start = np.flatnonzero(np.concatenate(([True], anchor[1:] != anchor[:-1])))
    end = np.concatenate((start[1:], [len(anchor)]))
    at = anchor[start]
    body = _mix((total[end - 1 + length] - total[start]) * down[start])
    shape = ((at - start).astype(np.uint64) << np.uint64(32)) | (end - start).astype(np.uint64)
    return grams[at], body ^ _mix(shape + np.uint64(1)), start + lo, end + lo, at + lo


def _trees(batches, length: int):
    """Interval trees of the anchors in the task, a few anchors at a time; rows come sorted by anchor."""
    import pyarrow as pa

    held, size = [], 0
    for b in batches:
        for row in b.to_pylist():
            if size > _TREE_BYTES and held[-1]["kh"] != row["kh"]:
                yield pa.RecordBatch.from_pydict(interval_tree(held, length), schema=_tree_schema())
                held, size = [], 0
            held.append(row)
            size += len(row["data"])
    if held:
        yield pa.RecordBatch.from_pydict(interval_tree(held, length), schema=_tree_schema())


def _tree_schema():
    import pyarrow as pa

    kinds = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_()}
    return pa.schema([(c, kinds[k]) for c, k in (x.split() for x in TREE_SCHEMA.split(", "))])


def interval_tree(pieces: list[dict], length: int) -> dict:
    """Columns of ``TREE_SCHEMA`` for segments given as dicts (file, pos, kh, start, copies, before, data).

    Only window starts are suffixes here, so every suffix has ``length`` bytes left in its
    segment.  Where all occurrences of a window are preceded by one byte inside their
    segments, the longer repeat that starts there covers this one, and the scan skips it.
    """
    import numpy as np

    text = b"\0".join(p["data"] for p in pieces)
    size = np.array([len(p["data"]) for p in pieces])
    first = np.cumsum(size + 1) - size - 1
    a = np.frombuffer(text, np.uint8).astype(np.uint16) + np.uint16(1)
    a[first[1:] - 1] = 0  # the end of a segment sorts before every byte
    count = size - length + 1
    owner = np.repeat(np.arange(len(pieces)), count)
    suffix = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count) + first[owner]
    order, levels = _sorted_suffixes(a, suffix, int(size.max()))
    suffix, owner = suffix[order], owner[order]
    left = first[owner] + size[owner] - suffix  # bytes to the end of the segment
    common = np.minimum(_common_prefix(a, levels, suffix[:-1], suffix[1:]), np.minimum(left[:-1], left[1:]))
    lcp = np.concatenate(([0], common, [0]))  # lcp[i]: of suffixes i - 1 and i
    at_start = suffix == first[owner]
    before = np.where(at_start, np.array([p["before"] for p in pieces])[owner], a[np.maximum(suffix - 1, 0)].astype(np.int64) - 1)
    before = np.where(before < 0, -1 - np.arange(len(before)), before)  # a text's start is unlike any other
    begins = np.flatnonzero(lcp[:-1] < length)
    ends = np.concatenate((begins[1:], [len(suffix)]))
    diverse = np.minimum.reduceat(before, begins) != np.maximum.reduceat(before, begins)
    kept = (ends - begins > 1) & (diverse | np.maximum.reduceat(at_start, begins))
    out = {c.split()[0]: [] for c in TREE_SCHEMA.split(", ")}
    for lo, hi in zip(begins[kept].tolist(), ends[kept].tolist()):
        _scan(out, text, pieces, suffix[lo:hi].tolist(), owner[lo:hi].tolist(), lcp[lo : hi + 1].tolist(), before[lo:hi].tolist(), first)
    return out


def _scan(out: dict, text: bytes, pieces, suffix, owner, lcp, before, first) -> None:
    """Stack scan of one run of suffixes with a long common prefix: intervals bottom-up, and where each suffix hangs."""
    lcp[0] = lcp[-1] = 0
    leaf, hanging = [None] * len(suffix), []  # suffixes that no interval has taken yet
    many = object()
    merge = lambda x, y: x if x == y else many

    def emit(depth, lo, hi, seen, parent):
        node = _content(text[suffix[lo] : suffix[lo] + depth], depth)
        for c, v in zip(out, ("interval", None, None, None, depth, node, parent, hi - lo, seen is many, None)):
            out[c].append(v)
        return node

    stack: list[list] = []  # [common prefix, first suffix, byte before all of them or `many`]
    for i in range(1, len(suffix) + 1):
        lo, seen = i - 1, before[i - 1]
        hanging.append(i - 1)
        while stack and stack[-1][0] > lcp[i]:
            depth, lo, above = stack.pop()
            seen = merge(above, seen)
            # the enclosing interval is as deep as the larger neighbour of this one
            outer = max(stack[-1][0] if stack else 0, lcp[i])
            parent = _content(text[suffix[lo] : suffix[lo] + outer], outer) if outer else None
            node = emit(depth, lo, i, seen, parent)
            while hanging and hanging[-1] >= lo:  # deeper intervals came first
                leaf[hanging.pop()] = node, depth
        if i < len(suffix):
            if stack and stack[-1][0] == lcp[i]:
                stack[-1][2] = merge(stack[-1][2], seen)
            else:
                stack.append([lcp[i], lo, seen])
    for j, s in enumerate(suffix):
        p = pieces[owner[j]]
        for c, v in zip(out, ("occurrence", p["file"], p["pos"], p["start"] + s - int(first[owner[j]]), leaf[j][1], leaf[j][0], None, None, None, p["copies"])):
            out[c].append(v)


def _sorted_suffixes(a, suffix, depth: int):
    """Order of the suffixes by their first ``depth`` bytes or more, and ranks by prefixes of 7, 14, 28, ... bytes."""
    import numpy as np

    n = len(a)
    padded = np.concatenate((a, np.zeros(7, a.dtype))).astype(np.uint64)
    key = np.zeros(n, np.uint64)
    for i in range(7):  # seven symbols of nine bits
        key = (key << np.uint64(9)) | padded[i : n + i]
    levels, width = [], 7
    while True:
        by = np.argsort(key)
        fresh = key[by[1:]] != key[by[:-1]]
        rank = np.empty(n, np.uint32)
        rank[by] = np.concatenate(([1], 1 + np.cumsum(fresh)))
        levels.append((width, rank))
        if width >= depth:
            return np.argsort(rank[suffix], kind="stable"), levels
        later = np.zeros(n, np.uint64)
        if width < n:
            later[: n - width] = rank[width:]
        key = (rank.astype(np.uint64) << np.uint64(32)) | later
        width *= 2


def _common_prefix(a, levels, x, y):
    """Length of the common prefix of the suffixes at x and y, pairwise: doubling steps downwards, then single bytes."""
    import numpy as np

    n = len(a)
    got = np.zeros(len(x), np.int64)
    for width, rank in reversed(levels):
        i, j = np.minimum(x + got, n - 1), np.minimum(y + got, n - 1)
        got += np.where((rank[i] == rank[j]) & (np.maximum(x, y) + got + width <= n), width, 0)
    more = np.ones(len(x), bool)
    for _ in range(6):
        i, j = x + got, y + got
        more &= (np.maximum(i, j) < n) & (a[np.minimum(i, n - 1)] == a[np.minimum(j, n - 1)])
        got += more
    return got
