"""Split, named projection and row-local validation (PRJ-4, VAL-1..7).

``parse_records`` turns assembled records into typed rows of a table spec.  The
header of each file maps names to positions (SRC-1); when every file shares one
header layout (the usual case) the positions are literals, otherwise each row
looks its names up in its own file's header, joined by file.

Validation is one pass adding ``reasons`` (all failed checks, in check order)
plus ``reason``/``category`` of the first one.  Categories: ``parse`` (the
reader would drop the row), ``not_null`` and ``other`` (the target would refuse
the row); foreign keys and key conflicts are judged later.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..functions.dialects import split_fields
from ..plans.joins import bounded_broadcast
from ..sources.assemble import Dump, check_required, common_header, header_names, position_of
from ..specs import TableSpec

ORDINAL = ("_p", "_ob", "_om")


def _typed(kind: str, v: Column) -> Column:
    if kind == "int":
        return S.parse_int(v)
    if kind == "int_opt":
        return S.parse_optional_int(v)
    if kind == "bool":
        return S.parse_bool(v)
    if kind == "double":
        return S.parse_double(v)
    if kind == "str":
        return F.coalesce(v, F.lit(""))
    if kind == "str_trim":
        return F.coalesce(S.ctrim(v), F.lit(""))
    if kind == "str_ptrim":
        return F.coalesce(S.paren_trim(v), F.lit(""))
    if kind == "url":
        return S.blank_to_null(v)
    if kind == "str_opt":
        return S.blank_to_null(v, trim_value=True)
    if kind == "ts":
        return S.cast_timestamp(v)
    if kind in ("date", "date_opt"):
        return S.cast_date(v)
    raise ValueError(kind)


def _with_positions(dump: Dump, spec: TableSpec, check_header: bool = True):
    """Records with ``_cols`` and a function name -> field Column (SRC-1, SRC-7)."""
    names = common_header(dump.headers, spec.dialect)
    if check_header:
        check_required(dump.headers, spec.dialect, spec.required, spec.name)
    recs = dump.records.withColumn("_cols", split_fields(F.col("raw"), spec.dialect))
    if names is not None:
        pos = {}
        for i, n in enumerate(names):
            pos[n] = i  # last duplicate wins
        recs = recs.withColumn("_hsize", F.lit(len(names)))

        def field(name: str) -> Column:
            p = pos.get(name)
            return F.get(F.col("_cols"), p) if p is not None else F.lit(None).cast("string")

        def present(name: str) -> Column:
            p = pos.get(name)
            return (F.size("_cols") > p) if p is not None else F.lit(False)

        return recs, field, present
    hdr = bounded_broadcast(header_names(dump.headers, spec.dialect))
    recs = recs.join(hdr, "_p").withColumn("_hsize", F.size("_hdr"))

    def field(name: str) -> Column:
        return F.get(F.col("_cols"), position_of(F.col("_hdr"), name))

    def present(name: str) -> Column:
        p = position_of(F.col("_hdr"), name)
        return F.coalesce(F.size("_cols") > p, F.lit(False))

    return recs, field, present


def parse_records(dump: Dump, spec: TableSpec, strict: bool = True, check_header: bool = True) -> DataFrame:
    """Typed, validated rows: ordinal, ``raw``, spec columns, ``reasons``/``reason``/``category``.

    ``strict=False`` skips VAL-1/VAL-2 for opinions, like the original load path (D3).
    """
    recs, field, present = _with_positions(dump, spec, check_header)
    out = [*ORDINAL, "line_no", "raw", F.size("_cols").alias("n_cols")]
    texts = {}
    for c in spec.columns:
        v = field(c.name)
        if c.kind == "date_opt":
            v = S.blank_to_null(v, trim_value=True)
        texts[c.name] = v
        typed = _typed(c.kind, v)
        if c.name == "docket_id" and spec.docket_sentinel:
            typed = S.docket_sentinel(typed)
        out.append(typed.alias(c.name))
        if c.kind in ("ts", "date", "date_opt"):
            out.append(v.alias(f"_txt_{c.name}"))

    # ---- row-local checks, in the order the original reader/target apply them
    checks: list[tuple[Column, str, Column]] = []
    if spec.validate_opinion_row and strict:
        checks.append(
            (
                F.size("_cols") > F.col("_hsize"),
                "parse",
                F.format_string("more columns than the header (%d > %d)", F.size("_cols"), F.col("_hsize")),
            )
        )
        id_ok = S.int_prefix_text(field("id")).try_cast("int").isNotNull()
        date_ok = F.coalesce(S.ctrim(field("date_created")) != F.lit(""), F.lit(False))
        checks.append(
            (
                (F.size("_cols") < 2) | ~id_ok | ~date_ok,
                "parse",
                F.lit("invalid row (missing id or date_created)"),
            )
        )
    if spec.min_columns:
        checks.append(
            (
                F.size("_cols") < spec.min_columns,
                "parse",
                F.format_string(
                    "insufficient columns (expected at least %d, got %d)", F.lit(spec.min_columns), F.size("_cols")
                ),
            )
        )
    if spec.assembly == "single":  # the single-line readers look every key column up
        miss = None
        for name in spec.required:
            m = ~present(name)
            miss = m if miss is None else (miss | m)
        if miss is not None:
            checks.append((miss, "parse", F.lit("missing required key columns")))
    if spec.key_rule == "le0":
        checks.append((F.col("id") <= 0, "parse", F.lit("invalid primary key: id is missing or <= 0")))
    elif spec.key_rule == "eq0":
        checks.append((F.col("id") == 0, "parse", F.lit("invalid id=0")))
    for c in spec.columns:
        if c.not_null:
            checks.append(
                (
                    F.col(c.name).isNull() & (F.lit(c.kind not in ("ts", "date")) | ~S.cast_failed(texts[c.name], F.col(c.name))),
                    "not_null",
                    F.lit(f"null value in column {c.name}"),
                )
            )
    for c in spec.columns:
        if c.max_len is not None:
            checks.append(
                (
                    F.coalesce(F.char_length(c.name) > c.max_len, F.lit(False)),
                    "other",
                    F.lit(f"value too long for {c.name} (max {c.max_len})"),
                )
            )
        if c.kind in ("ts", "date", "date_opt"):
            checks.append(
                (S.cast_failed(f"_txt_{c.name}", c.name), "other", F.lit(f"invalid {c.kind.split('_')[0]} in {c.name}"))
            )

    # columns a caller attached to the records ride along untouched
    carried = [c for c in dump.records.columns if c not in (*ORDINAL, "line_no", "raw")]
    header = [c for c in recs.columns if c == "_hdr"]  # the checks look names up in it where files differ
    typed = recs.select(*out, *carried, F.col("_hsize"), F.col("_cols"), *header)
    fails = [F.when(F.coalesce(cond, F.lit(False)), F.struct(F.lit(cat).alias("category"), msg.alias("reason"))) for cond, cat, msg in checks]
    typed = typed.withColumn("_fails", F.filter(F.array(*fails), lambda s: s.isNotNull()))
    return (
        typed.withColumn("reasons", F.transform("_fails", lambda s: s["reason"]))
        .withColumn("reason", F.get("_fails", 0)["reason"])
        .withColumn("category", F.get("_fails", 0)["category"])
        .drop("_fails", "_hsize", "_cols", "_hdr")
    )


def diagnose_mismatches(parsed: DataFrame, header_size: int | Column, keep: tuple[str, ...] = ()) -> DataFrame:
    """SCL-13: diagnostics for every record whose column count differs from its header.

    Re-aimed from a debug dump of two hard-coded ids: record length, quote count
    (odd means an unbalanced quote), newline count and column count.
    """
    hs = header_size if isinstance(header_size, Column) else F.lit(header_size)
    return parsed.filter(F.col("n_cols") != hs).select(
        *ORDINAL, "line_no", *S.record_diagnostics(F.col("raw")), F.col("n_cols").alias("column_count"), *keep
    )
