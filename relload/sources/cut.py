"""Cutting a split's lines into records where they are read.

Spark hands a scan task the lines of its splits in file order, so what depends on the
order inside a split (quote state, running counts, record starts, joining lines) is
worked out in the scan task itself on Arrow batches.  Where a rule looks back only, a task
holds a batch and the record that is still open; the rules that look ahead (``resync``,
``skip3``) hold the text of one split, whose size is Spark's ``maxPartitionBytes``, and a
few small numbers a line.  What comes from other splits arrives as a few numbers joined to
the lines from a table with one row a split; of these a task keeps one copy a split.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator

import numpy as np

# Fixed: an optionally quoted date, as the original scanner looks for it behind the third field.
DATE_AHEAD = re.compile(r'"?[0-9]{4}-[0-9]{2}-[0-9]{2}')

State = tuple  # quote parity, commas at even and at odd parity


def parts(batches: Iterable) -> Iterator[tuple[int, object]]:
    """The batches cut at the ends of splits: the split (``_s``), and rows of it alone."""
    for batch in batches:
        if not batch.num_rows:
            continue
        split = batch.column("_s").to_numpy()
        cuts = [0, *(np.flatnonzero(split[1:] != split[:-1]) + 1).tolist(), len(split)]
        for at, end in zip(cuts, cuts[1:]):
            yield int(split[at]), batch.slice(at, end - at)


def _own(lines):
    """A copy of some lines: a view would keep the whole batch they came in."""
    import pyarrow as pa

    return lines.take(pa.array(np.arange(len(lines)))).cast(pa.string())


def by_split(batches: Iterable, keys: list[str]) -> Iterator[dict]:
    """The lines of each split in order: ``keys`` (the same on all of its lines) as values, ``value`` as a list of
    Arrow arrays, other columns as arrays."""
    now, x = None, {}

    def whole():  # hands the lines over: only the caller holds them from then on
        out = {c: v if c in keys or c == "value" else np.concatenate(v) for c, v in x.items()}
        x.clear()
        return out

    for split, rows in parts(batches):
        if split != now:
            if x:
                yield whole()
            now, x = split, {c: rows.column(c)[0].as_py() if c in keys else [] for c in rows.schema.names}
        for c, held in x.items():
            if c == "value":
                held.append(_own(rows.column(c)))
            elif c not in keys:
                held.append(rows.column(c).to_numpy(zero_copy_only=False).copy())
    if x:
        yield whole()


def line_of(x: dict, i: int) -> str:
    """The ``i``-th line of a split."""
    ends = x.setdefault("_ends", np.cumsum([len(v) for v in x["value"]]))
    part = int(np.searchsorted(ends, i, side="right"))
    return x["value"][part][i - int(ends[part]) + len(x["value"][part])].as_py() or ""


def counts(x: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per line, from the split's first on: quote parity before it, and its commas at even and at odd parity."""
    parity = (np.cumsum(x["q"]) - x["q"]) % 2
    even, odd = x["even"].astype(np.int64), x["odd"].astype(np.int64)
    return parity, np.where(parity == 0, even, odd), np.where(parity == 0, odd, even)


def header_line(x: dict, first: bool) -> None:
    """The header is one physical line: its quotes open nothing."""
    if first:
        x["q"] = x["q"].copy()
        x["q"][0] = 0


# ------------------------------------------------------------------ starts by mode


class LookingBack:
    """Record starts of the modes that need only what is before a line, a batch at a time."""

    def __init__(self, mode: str, quotes_before: int, lines_before: int):
        self.mode, self.quotes, self.line = mode, quotes_before, lines_before

    def starts(self, rows) -> np.ndarray:
        found = np.ones(rows.num_rows, dtype=bool)
        if self.mode != "pattern":
            q = rows.column("q").to_numpy(zero_copy_only=False).astype(np.int64)
            if self.mode == "parity_pattern" and self.line == 0:
                q[0] = 0  # the header is one physical line: its quotes open nothing
            found &= (self.quotes + np.cumsum(q) - q) % 2 == 0
            self.quotes = (self.quotes + int(q.sum())) % 2
        if self.mode != "parity":
            found &= rows.column("cand").to_numpy(zero_copy_only=False).astype(bool)
            found[: max(0, 2 - self.line)] = True  # the header, and the line after it; with ``parity`` a header may run over lines
        self.line += rows.num_rows
        return found


def candidates(x: dict) -> np.ndarray:
    """Lines that look like a record start; the line after the header always does."""
    c = x["cand"].astype(bool)
    line = x["_n0"] + np.arange(len(c))
    return np.flatnonzero((line == 1) | ((line > 1) & c))


def _fields(a: State, b: State):
    """Fields of the text between two places, read as if its quotes opened at the first."""
    return np.where(a[0] == 0, b[1] - a[1], b[2] - a[2]) + 1


def resync_starts(x: dict) -> np.ndarray:
    """Record starts of the resync rule in one split; see :func:`relload.sources.assemble._resync_splits`."""
    header_line(x, x["_n0"] == 0)
    n = len(x["q"])
    starts = np.zeros(n, dtype=bool)
    at = candidates(x)
    if not len(at):
        return starts
    parity, even, odd_commas = counts(x)
    c0, c1 = np.cumsum(even) - even, np.cumsum(odd_commas) - odd_commas
    if x["_q0"]:  # a quote is open before the split: its even commas are the file's odd ones
        c0, c1 = c1, c0
    s = ((x["_q0"] + parity[at]) % 2, x["_off0"] + c0[at], x["_off1"] + c1[at])
    beyond = (x["_bp"], x["_b0"], x["_b1"])
    e = tuple(np.append(a[1:], b) for a, b in zip(s, beyond))
    odd = s[0] != e[0]
    full = ~odd & (_fields(s, e) == x["_n"])
    k = np.arange(len(at))
    before = np.maximum.accumulate(np.where(odd, k, -1))
    before = np.append(-1, before[:-1])  # the last odd segment before each
    after = np.minimum.accumulate(np.where(odd, k, len(at))[::-1])[::-1]
    after = np.append(after[1:], len(at))  # the next odd segment after each
    none = -1  # no such segment in the file: no parity
    opened = tuple(np.where(before >= 0, a[np.maximum(before, 0)], none if b is None else b) for a, b in zip(s, (x["_op"], x["_o0"], x["_o1"])))
    closed = tuple(np.where(after < len(at), a[np.minimum(after, len(at) - 1)], none if b is None else b) for a, b in zip(e, (x["_cp"], x["_c0"], x["_c1"])))
    one = (opened[0] >= 0) & (closed[0] >= 0) & (_fields(opened, closed) == x["_n"])
    reset = full & ~one
    odds = np.cumsum(odd) - odd
    last = np.maximum.accumulate(np.where(reset, k, -1))
    last = np.append(-1, last[:-1])
    since = np.where(last >= 0, odds - odds[np.maximum(last, 0)], x["_in"] + odds)
    starts[at] = (since % 2 == 0) | reset
    return starts


def _date_behind(line: str, parity: int, wanted: int, rank: int) -> bool:
    """Does a date follow the ``rank``-th comma of this line that sits at the ``wanted`` quote parity?"""
    place = 0
    for i, run in enumerate(line.split('"')):
        if (parity + i) % 2 == wanted:
            commas = run.count(",")
            if commas >= rank:
                at = -1
                for _ in range(rank):
                    at = run.index(",", at + 1)
                return bool(DATE_AHEAD.match(line, place + at + 1))
            rank -= commas
        place += len(run) + 1
    return False


def _targets(x: dict):
    """Candidates whose third comma is not on their own line: their line, its parity, and which comma of that parity in the split."""
    parity, even, odd = counts(x)
    upto = (np.cumsum(even), np.cumsum(odd))
    open_ = np.flatnonzero(x["cand"].astype(bool) & ~x["inline"].astype(bool) & (x["k"] < 3))
    goal = np.where(parity[open_] == 0, upto[0][open_], upto[1][open_]) + 3 - x["k"][open_]
    return open_, parity[open_], goal, parity, (even, odd), upto


def _date_at(x: dict, wanted: int, goal: int, parity, commas, upto) -> bool:
    line = int(np.searchsorted(upto[wanted], goal))
    rank = int(goal - (upto[wanted][line] - commas[wanted][line]))
    return _date_behind(line_of(x, line), int(parity[line]), wanted, rank)


def skip3_starts(x: dict) -> np.ndarray:
    """``<id>,``, three fields, a date: on the line itself, further on in the split, or found in a later one (``_far``)."""
    header_line(x, x["_n0"] == 0)
    starts = x["cand"].astype(bool) & x["inline"].astype(bool)
    lines, wanted, goal, parity, commas, upto = _targets(x)
    for i, w, g in zip(lines.tolist(), wanted.tolist(), goal.tolist()):
        if g <= upto[w][-1]:
            starts[i] = _date_at(x, w, g, parity, commas, upto)
    far = x.get("_far")
    if far:
        starts[np.array(far)] = True
    return starts


LOOK_AHEAD: dict[str, Callable[[dict], np.ndarray]] = {"resync": resync_starts, "skip3": skip3_starts}

# ------------------------------------------------------------------ passes


def summary(mode: str):
    """One row a split: lines, quote parity, commas by parity relative to its start, and its candidates or open targets."""

    def run(batches):
        import pyarrow as pa

        for x in by_split(batches, ["_s", "_p", "_b"]):
            x["_n0"] = 0 if x["_b"] == 0 else 2  # a second line that begins a split is told later, from the lines before it
            header_line(x, x["_b"] == 0)
            parity, even, odd = counts(x)
            if mode == "resync":
                at = candidates(x)
                lists = at, parity[at], (np.cumsum(even) - even)[at], (np.cumsum(odd) - odd)[at]
            else:
                at, wanted, goal, *_, upto = _targets(x)
                far = goal > np.where(wanted == 0, upto[0][-1], upto[1][-1])
                lists = at[far], wanted[far], goal[far], goal[far]
            row = [x["_p"], x["_b"], len(parity), int(x["q"].sum() % 2), int(even.sum()), int(odd.sum()), int(even[0]) + 1 if x["_b"] == 0 else None]
            arrays = [pa.array([v], pa.string() if i == 0 else pa.int64()) for i, v in enumerate(row)]
            arrays += [pa.ListArray.from_arrays(pa.array([0, len(a)], pa.int32()), pa.array(a.astype(np.int64))) for a in lists]
            yield pa.RecordBatch.from_arrays(arrays, names=["_p", "_b", "n", "q", "t0", "t1", "hn", "at", "par", "c0", "c1"])

    return run


def sizes(batches):
    """One row a split: its lines, the read id of the first, and, where it begins a file, that line."""
    import pyarrow as pa

    def row(of):
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(of, (pa.string(), *[pa.int64()] * 3, pa.string()))], names=["_p", "_b", "n", "_m0", "header"])

    now, held = None, None
    for split, rows in parts(batches):
        if split != now:
            if held:
                yield row(held)
            p, b, m, header = (rows.column(c)[0].as_py() for c in ("_p", "_b", "_m", "value"))
            now, held = split, [p, b, 0, m, header if b == 0 else None]
        held[2] += rows.num_rows
    if held:
        yield row(held)


SIZES = "_p string, _b long, n long, _m0 long, header string"

SUMMARY = "_p string, _b long, n long, q long, t0 long, t1 long, hn long, at array<long>, par array<long>, c0 array<long>, c1 array<long>"


def far_dates(batches):
    """For targets that lie in this split (``_want``: parity, comma, and the split and line that ask): is there a date?"""
    import pyarrow as pa

    for x in by_split(batches, ["_s", "_p", "_n0", "_q0", "_want"]):
        header_line(x, x["_n0"] == 0)
        parity, even, odd = counts(x)
        upto = (np.cumsum(even), np.cumsum(odd))
        found = []
        for w in x["_want"]:
            wanted = (w["par"] + x["_q0"]) % 2  # relative to this split's start
            if _date_at(x, wanted, w["goal"], parity, (even, odd), upto):
                found.append((x["_p"], w["b"], w["at"]))
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*found)], names=["_p", "_b", "at"])


class Cutter:
    """Joins the lines of one split to records as they come; it keeps the record that is still open."""

    def __init__(self, split: int, lines_before: int, last: bool):
        self.split, self.line, self.last = split, lines_before, last
        self.open, self.at, self.edge = [], None, None  # lines of the open record, the number of its first, its ``edge``

    def _batch(self, numbers, raw, edge):
        import pyarrow as pa

        n = len(raw)
        return pa.RecordBatch.from_arrays([pa.array([self.split] * n, pa.int64()), pa.array(numbers, pa.int64()), raw, pa.array(edge, pa.bool_())], names=["_s", "line_no", "raw", "edge"])

    def _joined(self, lines, offsets):
        import pyarrow as pa
        import pyarrow.compute as pc

        return pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), lines), "\n")

    def feed(self, lines, starts: np.ndarray):
        """The records that end in these lines."""
        import pyarrow as pa

        lines = lines.cast(pa.string())
        at = np.flatnonzero(starts)
        if self.at is None and not starts[0]:  # begins in an earlier split
            at, self.edge = np.append(0, at), False
        if len(at):
            raw, numbers, edge = [], [], []
            if self.at is not None:
                text = pa.concat_arrays([*self.open, lines.slice(0, at[0])])
                raw.append(self._joined(text, [0, len(text)])), numbers.append(self.at), edge.append(self.edge)
                self.edge = None
            if len(at) > 1:
                raw.append(self._joined(lines, at))
                numbers += (at[:-1] + self.line + 1).tolist()
                edge += [self.edge] + [None] * (len(at) - 2)
                self.edge = None
            if raw:
                yield self._batch(numbers, pa.concat_arrays(raw), edge)
            self.open, self.at = [], int(at[-1]) + self.line + 1
        self.open.append(_own(lines.slice(at[-1] if len(at) else 0)))
        self.line += len(lines)

    def close(self):
        """The last record of the split."""
        import pyarrow as pa

        text = pa.concat_arrays(self.open)
        edge = True if self.edge is None and not self.last else self.edge
        return self._batch([self.at], self._joined(text, [0, len(text)]), [edge])


def records(mode: str):
    """Records of each split: ``line_no`` of their first line, ``raw``, and ``edge``: null for a whole one, else whether it begins here."""

    def looking_back(batches):
        now, cutter, rule = None, None, None
        for split, rows in parts(batches):
            if split != now:
                if cutter:
                    yield cutter.close()
                first, quotes, last = (rows.column(c)[0].as_py() for c in ("_n0", "_q0", "_last"))
                now, cutter, rule = split, Cutter(split, first, last), LookingBack(mode, quotes, first)
            yield from cutter.feed(rows.column("value"), rule.starts(rows))
        if cutter:
            yield cutter.close()

    def looking_ahead(batches):
        keys = ["_s", "_n0", "_q0", "_last", "_off0", "_off1", "_n", "_bp", "_b0", "_b1", "_op", "_o0", "_o1", "_cp", "_c0", "_c1", "_in", "_far"]
        for x in by_split(batches, keys):
            starts = LOOK_AHEAD[mode](x)
            starts[: max(0, 2 - x["_n0"])] = True  # the header, and the line after it
            cutter, done = Cutter(x["_s"], x["_n0"], x["_last"]), 0
            lines = x["value"][::-1]
            x.clear()
            while lines:  # text goes as its records leave
                some = lines.pop()
                yield from cutter.feed(some, starts[done : done + len(some)])
                done += len(some)
            yield cutter.close()

    return looking_ahead if mode in LOOK_AHEAD else looking_back


RECORDS = "_s long, line_no long, raw string, edge boolean"
