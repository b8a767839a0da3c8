"""Distributed record assembly (SRC-1..7, SRC-9).

A dump record may span physical lines.  The original loaders find record
starts with a single sequential scan; here every rule is re-expressed so that a file
of any size is cut into records by many tasks at once, and its text is not shuffled:

1. Per line, Spark expressions find what the rule looks at (quote parity, commas, does
   the line look like a record start).  A first pass over these narrow facts leaves one
   row a split; running sums over the splits of a file (a tiny table) turn them into
   the state at each split's start.
2. A second pass joins that state to the lines (a broadcast of one row a split) and
   cuts each split into records in the scan task itself (:mod:`relload.sources.cut`).
   A line starts a record when the rule of the mode says so:

   ``parity``          quote parity before the line is even (SRC-2)
   ``pattern``         the line looks like ``<digits>,<yyyy-mm-dd>`` (SRC-3)
   ``parity_pattern``  both (SRC-4)
   ``resync``          as before, but a stray quote harms its own record only:
                       see :func:`_resync_splits`
   ``skip3``           ``<id>,`` then three CSV fields then a date (SRC-5);
                       the fields may run over any number of lines
   ``single``          every non-blank line is a record (SRC-6)

   The header is the first record of every file; in the pattern modes it is
   the first physical line and the line after it always starts a record.
3. Only the records at a split's edges (at most two a split) are shuffled, by file and
   first line, to be put together.

"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.dialects import split_fields
from ..functions.scalars import C_SPACE, ctrim
from ..plans.caching import cached
from ..plans.joins import bounded_broadcast, is_broadcast
from ..session import scratch_path
from . import cut
from .lines import read_lines

MODES = ("single", "parity", "pattern", "parity_pattern", "resync", "skip3")

# Fixed record-start patterns of the original scanners.
# SRC-3: digits/quotes up to the first comma, then an optionally quoted date.
START_ID_TS = r'^"*[0-9][0-9"]*,"?[0-9]{4}-[0-9]{2}-[0-9]{2}'
# SRC-4: optional CR/space/tab, optionally quoted id, optional space/tab, comma,
# optional quotes/spaces/tabs, date.
START_ID_TS_WS = r'^[ \t\r]*(?:"[0-9]+"|[0-9]+)[ \t]*,["\t ]*[0-9]{4}-[0-9]{2}-[0-9]{2}'
# SRC-5: optionally quoted id, comma, three CSV fields (quote-aware, may cross
# lines), then an optionally quoted date.
_FIELD = r'(?:[^",]|"(?:""|[^"])*+")*+,'
# commas per parity are located through buckets of this many commas (bounded join fan-out)
COMMA_BUCKET = 1 << 20
_ID_PREFIX = r'^(?:"[0-9]+"|[0-9]+),'
_FIELDS3_DATE = r"^" + _FIELD * 3 + r'"?[0-9]{4}-[0-9]{2}-[0-9]{2}'


@dataclass(frozen=True)
class Dump:
    """Assembled records plus the per-file header records."""

    records: DataFrame  # _p, _ob, _om, line_no, raw, _pos  (data records only)
    headers: DataFrame  # _p, header (raw header text)


def quote_parity(value: Column, literal_escaped: bool = True) -> Column:
    """Quote count mod 2; ``""`` pairs cancel.  ``\\"`` is a literal (not counted) unless told otherwise."""
    stripped = F.regexp_replace(value, r'\\"', "") if literal_escaped else value
    return ((F.length(stripped) - F.length(F.replace(stripped, F.lit('"'), F.lit("")))) % 2).cast("int")


def _file_offsets(per_split: DataFrame, sums: dict[str, str]) -> DataFrame:
    """Exclusive running sums over the splits of each file (one row per split)."""
    wb = Window.partitionBy("_p").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    cols = [F.coalesce(F.sum(src).over(wb), F.lit(0)).cast("long").alias(dst) for src, dst in sums.items()]
    return per_split.select(*per_split.columns, *cols)


def _commas(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(","), F.lit("")))


def _facts(lines: DataFrame, mode: str) -> tuple[DataFrame, list[str]]:
    """Lines with what the rule of ``mode`` looks at, and the names of those columns."""
    v = F.col("value")
    facts = {}
    if mode != "pattern":  # the original field skipper counts every quote
        facts["q"] = quote_parity(v, literal_escaped=mode != "skip3")
    if mode != "parity":
        facts["cand"] = v.rlike({"pattern": START_ID_TS, "skip3": _ID_PREFIX}.get(mode, START_ID_TS_WS))
    if mode in ("resync", "skip3"):
        text = F.regexp_replace(v, r'\\"', "") if mode == "resync" else v
        facts["even"] = _commas(F.regexp_replace(text, r'"[^"]*+(?:"|\z)', ""))
        facts["odd"] = _commas(text) - facts["even"]
    if mode == "skip3":
        rest = F.regexp_replace(v, _ID_PREFIX, "")
        facts["inline"] = facts["cand"] & rest.rlike(_FIELDS3_DATE)
        facts["k"] = F.size(F.regexp_extract_all(F.regexp_extract(rest, "^((?:" + _FIELD + ")*+)", 1), F.lit(_FIELD), 0))
    split = F.xxhash64("_p", "_b").alias("_s")
    return lines.select(v, "_p", "_b", "_m", split, *[c.alias(n) for n, c in facts.items()]), list(facts)


def _written(narrow: DataFrame, name: str) -> DataFrame:
    """A bookkeeping table written to the shared folder and read back: later plans stay short."""
    path = scratch_path(narrow.sparkSession, name)
    narrow.write.parquet(path)
    return narrow.sparkSession.read.schema(narrow.schema).parquet(path)


def _with_totals(per_split: DataFrame) -> DataFrame:
    """``_n0`` lines and ``_q0`` quote parity before each split, and whether it is the last of its file."""
    last = F.lead("_b").over(Window.partitionBy("_p").orderBy("_b")).isNull().alias("_last")
    x = _file_offsets(per_split, {"n": "_n0", "q": "_qs"})
    return x.select(*per_split.columns, "_n0", (F.col("_qs") % 2).alias("_q0"), last)


def _with_file_places(splits: DataFrame) -> DataFrame:
    """``_f0``: lines in the files before each split's file, in the order of their paths (a row a file)."""
    files = splits.groupBy("_p").agg(F.sum("n").alias("_fn"))
    before = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    files = files.select("_p", F.coalesce(F.sum("_fn").over(before), F.lit(0)).cast("long").alias("_f0"))
    return splits.join(files, "_p")


def _with_commas(splits: DataFrame) -> DataFrame:
    """``_off0``/``_off1``: commas of the file at even and odd parity before each split."""
    even = F.when(F.col("_q0") == 0, F.col("t0")).otherwise(F.col("t1"))
    x = splits.withColumn("_t0", even).withColumn("_t1", F.col("t0") + F.col("t1") - even)
    return _file_offsets(x, {"_t0": "_off0", "_t1": "_off1"})


def _skip3_splits(facts: DataFrame, splits: DataFrame, in_order: bool) -> DataFrame:
    """Splits with ``_far``: their lines whose three fields end, before a date, in a later split (SRC-5).

    Quote state at any character is the parity of all quotes before it in the file.
    Each field ends at a comma whose parity equals that at the field's start, so the
    rule needs the third such comma after ``<id>,``.  Within a split the cutting pass
    finds it.  For the few candidates whose comma lies further on, its number in the
    file is known from running counts; the split that holds it comes from a bucketed
    equi-join on the table with one row a split, and only the lines of such splits are
    looked at again.  No window of lines, no cap on how far the fields run.
    """
    splits = _written(_with_commas(splits), "splits")
    abs_par = (F.col("_q0") + F.col("x.par")) % 2
    off = F.when(abs_par == 0, F.col("_off0")).otherwise(F.col("_off1"))
    pending = cached(
        splits.select("_p", F.col("_b").alias("_cb"), "_q0", "_off0", "_off1", F.explode(F.arrays_zip("at", "par", "c0")).alias("x"))
        .select("_p", "_cb", F.col("x.at").alias("_at"), abs_par.cast("int").alias("_tp"), (off + F.col("x.c0")).alias("_t"))
    )
    if pending.limit(1).count() == 0:
        return splits.withColumn("_far", F.lit(None).cast("array<long>"))
    spans = splits.select(
        "_p", "_b", F.explode(F.array(
            F.struct(F.lit(0).alias("_tp"), (F.col("_off0") + 1).alias("_lo"), (F.col("_off0") + F.col("_t0")).alias("_hi")),
            F.struct(F.lit(1).alias("_tp"), (F.col("_off1") + 1).alias("_lo"), (F.col("_off1") + F.col("_t1")).alias("_hi")),
        )).alias("_s")
    ).select("_p", "_b", "_s.*").filter(F.col("_hi") >= F.col("_lo"))
    spans = spans.withColumn(
        "_bk", F.explode(F.sequence(F.floor(F.col("_lo") / COMMA_BUCKET), F.floor(F.col("_hi") / COMMA_BUCKET)))
    )
    wanted = pending.withColumn("_bk", F.floor(F.col("_t") / COMMA_BUCKET)).join(spans, ["_p", "_tp", "_bk"]).filter(
        (F.col("_t") >= F.col("_lo")) & (F.col("_t") <= F.col("_hi"))
    )
    ask = F.struct(F.col("_tp").alias("par"), (F.col("_t") - F.col("_lo") + 1).alias("goal"), F.col("_cb").alias("b"), F.col("_at").alias("at"))
    wanted = wanted.groupBy("_p", "_b").agg(F.collect_list(ask).alias("_want")).join(splits.select("_p", "_b", "_n0", "_q0"), ["_p", "_b"])
    looked = _in_file_order(facts, wanted, in_order).select("value", "q", "even", "odd", "_s", "_p", "_n0", "_q0", "_want")
    found = looked.mapInArrow(cut.far_dates, "_p string, _b long, at long").groupBy("_p", "_b").agg(F.collect_list("at").alias("_far"))
    return splits.join(_written(found, "far"), ["_p", "_b"], "left")


# the next set value of a column, strictly after the row: among its split's candidates, and over the splits of its file
_NEXT_IN_SPLIT = "lead({}) IGNORE NULLS OVER (PARTITION BY _p, _b ORDER BY _at)"
_NEXT_IN_FILE = "lead({}) IGNORE NULLS OVER (PARTITION BY _p ORDER BY _b)"


def _fields_between(start: Column, end: Column) -> Column:
    """Fields of the text between two places, read as if its quotes opened at ``start``."""
    return F.when(start["par"] == 0, end["c0"] - start["c0"]).otherwise(end["c1"] - start["c1"]) + 1


def _resync_splits(splits: DataFrame) -> DataFrame:
    """Splits with what the resync rule needs to know of the rest of the file.

    The text is cut at every line that looks like a record start.  A segment with an
    odd quote count opens or closes a quoted run; a segment with an even count and
    the header's number of fields is *full*: it reads as a record of its own.  A
    line starts a record when no quote is open before it.  A full segment inside
    an open run ends that run and starts a record as well, unless the run, taken
    whole from its opening to its closing segment, has the header's number of
    fields: then its lines are the body of one record.  (So a stray quote whose run
    happens to have exactly that number of fields is taken for a long record; the
    more columns a table has, the less likely that is.)

    A split needs the state at its first line, the one at the next candidate beyond it,
    the odd segments around it and how many of them follow the last reset before
    it.  All of that comes from the candidates' states (narrow rows) and from windows
    over a table with one row a split.
    """
    state = lambda par, c0, c1: F.struct(par.cast("int").alias("par"), c0.cast("long").alias("c0"), c1.cast("long").alias("c1"))
    files = Window.partitionBy("_p").orderBy("_b")
    earlier = files.rowsBetween(Window.unboundedPreceding, -1)
    whole_file = files.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = Window.partitionBy("_p", "_b").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)

    splits = _with_commas(splits)
    q0, off0, off1 = F.col("_q0"), F.col("_off0"), F.col("_off1")
    swap = lambda a, b: (F.when(q0 == 0, a).otherwise(b), F.when(q0 == 0, b).otherwise(a))
    t0, t1 = swap(F.col("t0"), F.col("t1"))
    splits = splits.withColumn("_eof", state((q0 + F.col("q")) % 2, off0 + t0, off1 + t1))
    splits = splits.withColumn("_n", F.max("hn").over(whole_file))
    # the second line of a file is a candidate whatever it looks like, also as the first line of a split
    zero = F.struct(*[F.lit(0).cast("long").alias(c) for c in ("at", "par", "c0", "c1")])
    listed = F.arrays_zip("at", "par", "c0", "c1")
    second = (F.col("_n0") == 1) & (F.size("at") == 0) | (F.col("_n0") == 1) & (F.get("at", 0) != 0)
    splits = splits.withColumn("_list", F.when(second, F.concat(F.array(zero), listed)).otherwise(listed)).drop("at", "par", "c0", "c1")
    splits = _written(splits, "splits")

    c = splits.select("_p", "_b", "_q0", "_off0", "_off1", F.explode("_list").alias("x"))  # a row a candidate, no text
    c0, c1 = swap(F.col("x.c0"), F.col("x.c1"))
    c = c.select("_p", "_b", F.col("x.at").alias("_at"), state((q0 + F.col("x.par")) % 2, off0 + c0, off1 + c1).alias("_s"))

    # where the segment of each candidate ends, and whether it is odd or full
    firsts = c.groupBy("_p", "_b").agg(F.min(F.struct("_at", "_s"))["_s"].alias("_first"))
    ends = splits.select("_p", "_b", "_n", "_eof").join(firsts, ["_p", "_b"], "left").select(
        "_p", "_b", "_n", F.coalesce(F.expr(_NEXT_IN_FILE.format("_first")), F.last("_eof").over(whole_file)).alias("_beyond")
    )
    ends = _written(ends, "ends")
    c = c.join(ends, ["_p", "_b"]).withColumn("_end", F.coalesce(F.expr(_NEXT_IN_SPLIT.format("_s")), F.col("_beyond")))
    odd = F.col("_end.par") != F.col("_s.par")
    full = ~odd & (_fields_between(F.col("_s"), F.col("_end")) == F.col("_n"))
    c = _written(c.select("_p", "_b", "_at", "_s", "_end", "_n", odd.alias("_odd"), full.alias("_full")), "segments")

    # the odd segments around each full one: do they and all between make one record?
    odds = c.groupBy("_p", "_b").agg(
        F.max(F.when(F.col("_odd"), F.struct("_at", "_s")))["_s"].alias("_lo"),
        F.min(F.when(F.col("_odd"), F.struct("_at", "_end")))["_end"].alias("_fo"),
    )
    odds = splits.select("_p", "_b").join(odds, ["_p", "_b"], "left").select(
        "_p", "_b", F.last("_lo", ignorenulls=True).over(earlier).alias("_open"), F.expr(_NEXT_IN_FILE.format("_fo")).alias("_close")
    )
    odds = _written(odds, "odds")
    c = c.withColumn("_os", F.when(F.col("_odd"), F.col("_s"))).withColumn("_oe", F.when(F.col("_odd"), F.col("_end")))
    c = c.join(odds, ["_p", "_b"])
    opened = F.coalesce(F.last("_os", ignorenulls=True).over(before), F.col("_open"))
    closed = F.coalesce(F.expr(_NEXT_IN_SPLIT.format("_oe")), F.col("_close"))
    one = F.coalesce(_fields_between(opened, closed) == F.col("_n"), F.lit(False))
    before_me = F.coalesce(F.sum(F.col("_odd").cast("long")).over(before), F.lit(0))
    c = c.select("_p", "_b", "_odd", (F.col("_full") & ~one).alias("_reset"), before_me.alias("_odds"))

    # odd segments between the last reset before a split and the split
    sums = c.groupBy("_p", "_b").agg(
        F.sum(F.col("_odd").cast("long")).alias("_to"), F.max(F.when(F.col("_reset"), F.col("_odds"))).alias("_ta")
    )
    sums = splits.select("_p", "_b").join(sums, ["_p", "_b"], "left").withColumn("_to", F.coalesce(F.col("_to"), F.lit(0)))
    sums = _file_offsets(sums, {"_to": "_so"})
    base = F.last(F.when(F.col("_ta").isNotNull(), F.col("_so") + F.col("_ta")), ignorenulls=True).over(earlier)
    sums = sums.select("_p", "_b", (F.col("_so") - F.coalesce(base, F.lit(0))).alias("_in"))
    out = splits.select("_p", "_b", "n", "_n0", "_q0", "_last", "_off0", "_off1").join(ends, ["_p", "_b"]).join(odds, ["_p", "_b"]).join(sums, ["_p", "_b"])
    flat = [F.col(f"{c}.{f}").alias(f"_{n}{g}") for c, n in (("_beyond", "b"), ("_open", "o"), ("_close", "c")) for f, g in (("par", "p"), ("c0", "0"), ("c1", "1"))]
    return _written(out.select("_p", "_b", "n", "_n0", "_q0", "_last", "_off0", "_off1", F.coalesce("_n", F.lit(-1)).alias("_n"), *flat, "_in"), "states")


def _ordered(lines: DataFrame) -> DataFrame:
    return lines.repartition("_p", "_b").sortWithinPartitions("_p", "_b", "_m")


def _in_file_order(lines: DataFrame, per_split: DataFrame, in_order: bool) -> DataFrame:
    """Lines with their split's row of ``per_split``, in file order within their task.

    The table has one row a split.  Beyond the broadcast bound (some 12 TB of text in
    splits of 128 MB) the lines have to move to it, and are put in order again.
    """
    small = bounded_broadcast(per_split)
    met = lines.join(small, ["_p", "_b"])
    return met if in_order and is_broadcast(small) else _ordered(met)


def _cut(lines: DataFrame, mode: str, in_order: bool) -> tuple[DataFrame, DataFrame]:
    """The records of every split (``_s``, ``line_no``, ``raw``, ``edge``), and the file of each split (``_s``, ``_p``)."""
    facts, names = _facts(lines, mode)
    if mode in ("resync", "skip3"):
        narrow = (facts if in_order else _ordered(facts.drop("value"))).select("_p", "_b", "_s", *names)
        splits = _with_totals(_written(narrow.mapInArrow(cut.summary(mode), cut.SUMMARY), "summary"))
        splits = _resync_splits(splits) if mode == "resync" else _skip3_splits(facts, splits, in_order)
        numbers = [c for c in splits.columns if c.startswith("_") and c not in ("_p", "_b", "_t0", "_t1")]
    else:
        q = F.sum("q") if "q" in names else F.lit(0).cast("long")
        header = F.when(F.col("_b") == 0, F.min_by("q", "_m")).otherwise(0) if mode == "parity_pattern" else F.lit(0)
        per_split = facts.groupBy("_p", "_b").agg(F.count(F.lit(1)).alias("n"), (q - header).alias("q"))
        splits, numbers = _with_totals(per_split), ["_n0", "_q0", "_last"]
    splits = cached(splits.select("_p", "_b", "n", *numbers))
    marked = _in_file_order(facts, splits, in_order).select("value", "_s", *names, *numbers)
    places = _with_file_places(splits.select("_p", "_b", "n")).select(F.xxhash64("_p", "_b").alias("_s"), "_p", "_f0")
    return cached(marked.mapInArrow(cut.records(mode), cut.RECORDS)), places


def _whole_records(pieces: DataFrame, splits: DataFrame) -> DataFrame:
    """``_p``, ``line_no``, ``raw``, ``_f0`` of all records; those in pieces at split edges are put together."""
    found = pieces.join(bounded_broadcast(splits), "_s").select("_p", "line_no", "raw", "edge", "_f0")
    edges = found.filter(F.col("edge").isNotNull())
    order = Window.partitionBy("_p").orderBy("line_no").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    begin = F.last(F.when(F.col("edge"), F.col("line_no")), ignorenulls=True).over(order)
    of = edges.select("_p", "line_no", "edge").select("_p", "line_no", begin.alias("_begin"))  # at most two narrow rows a split
    whole = edges.join(of, ["_p", "line_no"]).groupBy("_p", F.col("_begin").alias("line_no"), "_f0").agg(
        F.collect_list(F.struct("line_no", "raw")).alias("_parts")
    )
    joined = F.array_join(F.transform(F.array_sort("_parts"), lambda s: s["raw"]), "\n").alias("raw")
    return found.filter(F.col("edge").isNull()).select("_p", "line_no", "raw", "_f0").unionByName(whole.select("_p", "line_no", joined, "_f0"))


def _is_blank(c: Column) -> Column:
    return ctrim(c, C_SPACE) == F.lit("")


def assemble_lines(lines: DataFrame, mode: str, in_order: bool = True) -> Dump:
    """Cut physical lines (from :func:`read_lines`) into records.

    The lines of a split lie together and in order, as a scan reads them; those of any
    other frame (``in_order=False``) are brought there first.
    """
    if mode not in MODES:
        raise ValueError(f"unknown assembly mode {mode!r}; expected one of {MODES}")
    if mode == "single":
        # One pass leaves a row a split: how many lines it has, the read id of the first
        # and, at a file's start, the header.  Running sums make of it the place of every
        # line in the whole dump, one number that orders all records.
        if not in_order:
            lines = _ordered(lines)
        split = F.xxhash64("_p", "_b").alias("_s")
        narrow = lines.select(F.when(F.col("_b") == 0, F.col("value")).alias("value"), "_p", "_b", "_m", split)
        splits = cached(narrow.mapInArrow(cut.sizes, cut.SIZES))
        headers = splits.filter(F.col("_b") == 0).select("_p", "header")
        places = _with_file_places(_file_offsets(splits.select("_p", "_b", "n", "_m0"), {"n": "_n0"}))
        x = lines.join(bounded_broadcast(places.select("_p", "_b", "_m0", (F.col("_f0") + F.col("_n0")).alias("_n0"))), ["_p", "_b"])
        is_header = (F.col("_b") == 0) & (F.col("_m") == F.col("_m0"))
        records = x.filter(~is_header & ~_is_blank(F.col("value"))).select(
            "_p",
            F.col("_b").alias("_ob"),
            (F.col("_m") + 1).alias("_om"),  # > 0 marks single-line ordinals
            F.lit(None).cast("long").alias("line_no"),
            F.col("value").alias("raw"),
            (F.col("_n0") + F.col("_m") - F.col("_m0")).alias("_pos"),
        )
        return Dump(records, headers)

    recs = _whole_records(*_cut(lines, mode, in_order))
    if mode == "pattern":  # SRC-3 trims trailing whitespace of every record
        recs = recs.withColumn("raw", F.when(F.col("line_no") > 1, F.regexp_replace("raw", r"[ \t\n\r\x0b\x0c]+\z", "")).otherwise(F.col("raw")))
    headers = recs.filter(F.col("line_no") == 1).select("_p", F.col("raw").alias("header"))
    records = recs.filter((F.col("line_no") > 1) & ~_is_blank(F.col("raw"))).select(
        "_p", F.col("line_no").alias("_ob"), F.lit(0).cast("long").alias("_om"), "line_no", "raw", (F.col("_f0") + F.col("line_no") - 1).alias("_pos")
    )
    return Dump(records, headers)


def read_dump(spark: SparkSession, paths: str | Sequence[str], mode: str) -> Dump:
    """Read dump files and assemble records (``records`` ordinal = ``_p``, ``_ob``, ``_om``)."""
    return assemble_lines(read_lines(spark, paths), mode)


def read_head(spark: SparkSession, file: str, lines: int) -> DataFrame:
    """The first ``lines`` physical lines of one file; collecting it reads no more of the file than that."""
    return read_lines(spark, file).limit(lines)


def read_first(spark: SparkSession, paths: str | Sequence[str], mode: str, n: int) -> Dump:
    """SRC-9: a dump of the first ``n`` records in file order, from the leading lines of the leading files.

    Files are taken in the order of their paths.  Of each, twice as many lines are read
    as before until ``n`` records are closed (another one begins behind them) or the
    file ends; what comes back through the driver is bounded by the preview's size.
    """
    found: Dump | None = None
    left = n
    for file in sorted(read_lines(spark, paths).select("_p").inputFiles()):
        k = 2 * left + 2
        while True:
            rows = read_head(spark, file, k).collect()
            dump = assemble_lines(spark.createDataFrame(rows, "value string, _p string, _b long, _m long"), mode, in_order=False)
            closed = dump.records.count() - (1 if mode != "single" and len(rows) == k else 0)
            if closed >= left or len(rows) < k:
                break
            k *= 2
        some = Dump(dump.records.orderBy("_ob", "_om").limit(left).drop("_pos"), dump.headers)
        found = some if found is None else Dump(found.records.unionByName(some.records), found.headers.unionByName(some.headers))
        left -= min(closed, left) if len(rows) == k else min(dump.records.count(), left)
        if left <= 0:
            break
    if found is None:
        raise ValueError("no dump files")
    return found


# ---------------------------------------------------------------- header (SRC-1/7)


def check_files(spark: SparkSession, paths: str | Sequence[str], table: str) -> None:
    """SRC-7: fail before any load work when a file is empty, also one among many."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    files = spark.read.format("binaryFile").load(paths)  # only names are read, no content; a file without bytes gives no row
    plain = lambda c: F.regexp_replace(c, "^file:/+", "file:/")
    listed = spark.createDataFrame([(f,) for f in files.inputFiles()], "path string").select(plain("path").alias("path"))
    empty = listed.join(files.select(plain("path").alias("path")), "path", "left_anti").limit(10).collect()
    if empty:
        raise ValueError(f"{table}: dump file is empty (no header line): {', '.join(sorted(r['path'] for r in empty))}")


def header_names(headers: DataFrame, dialect: str) -> DataFrame:
    """``_p``, ``_hdr`` = trimmed column names of each file's header."""
    return headers.select("_p", F.transform(split_fields(F.col("header"), dialect), lambda c: ctrim(c)).alias("_hdr"))


def common_header(headers: DataFrame, dialect: str) -> list[str] | None:
    """The one header layout of all files (the usual case), or None where files differ."""
    rows = header_names(headers, dialect).select("_hdr").distinct().limit(2).collect()
    return list(rows[0]["_hdr"]) if len(rows) == 1 else None


def check_required(headers: DataFrame, dialect: str, required: Sequence[str], table: str) -> None:
    """SRC-7: fail before any load work when there is no header at all or one lacks a required column."""
    names = header_names(headers, dialect)
    lacks = F.array_except(F.array(*map(F.lit, required)), F.col("_hdr")) if required else F.array().cast("array<string>")
    bad = names.select(lacks.alias("lacks")).where(F.size("lacks") > 0).limit(1).collect()
    if bad:
        raise ValueError(f"{table}: header lacks required column(s) {list(bad[0]['lacks'])}")
    if names.limit(1).count() == 0:
        raise ValueError(f"{table}: dump is empty (no header line)")


def position_of(hdr: Column, name: str) -> Column:
    """0-based position of ``name`` in the header; the last duplicate wins; NULL if absent."""
    rpos = F.array_position(F.reverse(hdr), F.lit(name))
    return F.when(rpos > 0, F.size(hdr) - rpos)


def preview(records: DataFrame, n: int = 100) -> DataFrame:
    """SRC-9: the first ``n`` records in file order (the limit is the feature)."""
    return records.orderBy("_p", "_ob", "_om").limit(n)
