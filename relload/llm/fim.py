"""Fill-in-the-middle transformation over an indexable skip list.

A text is cut at two ranks into prefix, middle and suffix, which are put in another
order between sentinels.  The ranks count units (code points, or the matches of a
pattern); the place of a rank is found in an indexable skip list: a base lane with one
link a unit, and express lanes over it whose links skip ``FAN`` links of the lane
below.  Each link carries how many units, code points and bytes it passes, so walking
down from the top lane and adding up reaches any rank exactly, in bytes and in code
points, without counting from the start of the text.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relload.llm.common import map_texts, texts_of

FAN = 16  # links of a lane under one link of the lane above
PIECE = 1 << 20  # bytes of a text whose code points are marked at once

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"


class SkipList:
    """Units of one text (UTF-8 bytes) by rank.

    ``pattern`` is a compiled regular expression over ``str`` whose non-empty matches,
    left to right, begin the units; text before the first match belongs to the first
    unit.  Without it every code point is a unit.
    """

    def __init__(self, data: bytes, pattern=None):
        sizes = _code_point_sizes(data)
        points = None
        if pattern is not None:
            first = [m.start() for m in pattern.finditer(data.decode("utf-8", "replace")) if m.end() > m.start()]
            if sizes.size:
                first = np.array([0, *first[1:]] if first else [0], dtype=np.int64)
                points = np.diff(np.append(first, sizes.size))
                sizes = np.add.reduceat(sizes, first, dtype=np.int64)
        self.units = int(sizes.size)
        #: lanes from the base up: (units, code points, bytes) that each link passes; None for one a link
        self.lanes = [(None, points, sizes)]
        while len(self.lanes[-1][2]) > FAN:
            self.lanes.append(tuple(_express(w, len(self.lanes[-1][2])) for w in self.lanes[-1]))

    def reach(self, rank: int) -> tuple[int, int]:
        """Code points and bytes before the unit of ``rank`` (0 to ``units``)."""
        if not 0 <= rank <= self.units:
            raise IndexError(rank)
        left, points, size, link = rank, 0, 0, 0
        for units_w, points_w, bytes_w in reversed(self.lanes):
            link *= FAN
            for u, p, b in zip(_links(units_w, link, bytes_w), _links(points_w, link, bytes_w), _links(bytes_w, link, bytes_w)):
                if u > left:
                    break
                left, points, size, link = left - u, points + p, size + b, link + 1
        return points, size


def _code_point_sizes(data: bytes) -> np.ndarray:
    """Bytes of every code point; marked piece by piece, so a long text needs little more than its own size."""
    octets = np.frombuffer(data, dtype=np.uint8)
    parts, last = [], 0
    for at in range(0, octets.size, PIECE):
        starts = np.flatnonzero((octets[at : at + PIECE] & 0xC0) != 0x80) + at
        if at == 0 and octets.size and (not starts.size or starts[0]):
            starts = np.insert(starts, 0, 0)  # a stray continuation byte begins the first unit
        if at:
            starts = np.insert(starts, 0, last)
        parts.append(np.diff(starts))
        last = int(starts[-1])
    if octets.size:
        parts.append(np.array([octets.size - last]))
    sizes = np.concatenate(parts) if parts else np.zeros(0, dtype=np.int64)
    return sizes.astype(np.uint8) if sizes.size and sizes.max() < 256 else sizes


def _express(widths: np.ndarray | None, links: int) -> np.ndarray:
    """Widths of the lane above: sums over each ``FAN`` links."""
    first = np.arange(0, links, FAN)
    if widths is None:
        return np.minimum(FAN, links - first)
    return np.add.reduceat(widths, first, dtype=np.int64)


def _links(widths: np.ndarray | None, link: int, lane: np.ndarray) -> list[int]:
    """The widths of the at most ``FAN`` links from ``link`` on that a walk can still need."""
    if widths is None:
        return [1] * min(FAN, len(lane) - link)
    return widths[link : link + FAN].tolist()


def arrange(data: bytes, first: int, second: int, form: str) -> bytes:
    """The text cut at two byte places, in the order of ``form``."""
    prefix, middle, suffix = data[:first], data[first:second], data[second:]
    if form == PSM:
        return b"".join((PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle))
    if form == SPM:
        return b"".join((SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle))
    return data


def rebuild(output: bytes, form: str) -> bytes:
    """The text that ``arrange`` was given, from its output and form alone.

    No part holds a sentinel and a sentinel cannot begin inside another one, so the
    first of each kind is the one that was put there.
    """
    if form == PLAIN:
        return output
    one, two = (PREFIX, SUFFIX) if form == PSM else (SUFFIX, PREFIX)
    cut, end = output.index(two), output.index(MIDDLE)
    a, b, middle = output[len(one) : cut], output[cut + len(two) : end], output[end + len(MIDDLE) :]
    prefix, suffix = (a, b) if form == PSM else (b, a)
    return prefix + middle + suffix


def transform(data: bytes, key: str, salt: str, percent: int, spm_percent: int, pattern=None):
    """(units, form, prefix code points, middle code points, output) of one text."""
    digest = hashlib.sha256(f"{salt}:{key}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[i : i + 8], 16) for i in (0, 8, 16, 24))
    units = SkipList(data, pattern)
    n = units.units
    if not data or h3 % 100 >= percent or any(s in data for s in (PREFIX, SUFFIX, MIDDLE)):
        return n, PLAIN, None, None, data
    form = SPM if h4 % 100 < spm_percent else PSM
    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
    (chars, first), (upto, second) = units.reach(low), units.reach(high)
    return n, form, chars, upto - chars, arrange(data, first, second, form)


def fill_in_middle(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    salt: str = "1", percent: int = 90, spm_percent: int = 20, pattern: str | None = None,
) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output, restored) of every row.

    ``percent`` of the texts are cut, ``spm_percent`` of those with the suffix first;
    the choice and both cuts come from the SHA-256 of salt and id.  ``n`` counts units
    (code points without ``pattern``).  ``restored`` is rebuilt from output and form.

    Null and empty texts, and texts that hold a sentinel, stay plain (null counts as
    empty).  A null id is hashed as an empty one; repeated rows give repeated results;
    an empty table gives an empty one; other columns are not read, whatever their names.
    The work is map-only: one pass, no shuffle.
    """

    def run(batches):
        import re

        import pyarrow as pa
        import pyarrow.compute as pc

        units = re.compile(pattern) if pattern is not None else None
        text = pc.CastOptions(target_type=pa.string(), allow_invalid_utf8=True)
        for batch in batches:
            rows = [
                transform(t or b"", "" if i is None else str(i), salt, percent, spm_percent, units)
                for i, t in zip(batch.column(1).to_pylist(), texts_of(batch.column(2)))
            ]
            back = [rebuild(r[4], r[1]) for r in rows]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.string()),
                    pa.array([r[2] for r in rows], pa.int64()), pa.array([r[3] for r in rows], pa.int64()),
                    pc.cast(pa.array([r[4] for r in rows], pa.binary()), options=text), pc.cast(pa.array(back, pa.binary()), options=text),
                ],
                names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output", "restored"],
            )

    ids = F.col(id_col)
    schema = f"doc_id {docs.select(ids).schema[0].dataType.simpleString()}, n long, form string, prefix_chars long, middle_chars long, output string, restored string"
    return map_texts(docs.select(ids.alias("doc_id"), ids.cast("string").alias("key"), F.col(text_col).alias("text")), run, schema)
