"""Checks over the given tables: one Spark query per operator plus its DuckDB oracle SQL.

Every query reads whole tables (or dumps Spark renders from them) and runs the
library's operators; the oracle states the expected result in plain SQL over
the same tables.  Keys of the registry are the check names of the blueprint.

Mapping of the test tables onto the loader's world (blueprint §7.4):
documents/pages/conversations supply multi-line and quoted text, lineitem
supplies volume for keys, foreign keys and conflicts, and filtered parents
(suppliers with a positive balance, parts larger than 5, finished orders)
leave orphans to repair.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..functions.dialects import split_escape_all, split_lenient, split_toggle
from ..operators import fk as FKO
from ..operators import placeholders as PH
from ..operators import report as R
from ..operators.project import parse_records
from ..operators.upsert import upsert_ignore, upsert_last, upsert_natural, upsert_partial
from ..sinks import bad_records_raw, bad_records_typed, write_csv
from ..session import scratch_path
from ..sources.assemble import Dump, assemble_lines, preview, read_dump
from ..specs import CITED, JOINED_BY, OPINION, PANEL, PARENTHETICAL, SEARCH_CITATION, Col, TableSpec
from .jobs import load
from .render import frame_dump, render_csv, render_lines

AS_OF = dt.datetime(2026, 1, 1, 0, 0, 0)
AS_OF_TXT = "2026-01-01 00:00:00"

Query = Callable[[SparkSession, str], DataFrame]


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf.rstrip('/')}/{name}.parquet")


def _ts_text(n: Column) -> Column:
    """A deterministic timestamp text derived from a key (time-zone free)."""
    return F.format_string("2020-%02d-%02d 12:%02d:00", n % 12 + 1, n % 28 + 1, n % 60)


def _q(c: Column) -> Column:
    """Quote a field CSV-style (quotes doubled)."""
    return F.concat(F.lit('"'), F.replace(c.cast("string"), F.lit('"'), F.lit('""')), F.lit('"'))


def _s(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


# lineitem rows in a fixed file order: (l_orderkey, l_linenumber, l_partkey, l_suppkey) is unique
def _li_ob() -> Column:
    return F.col("l_orderkey") * 8 + F.col("l_linenumber")


def _li_om() -> Column:
    return F.col("l_partkey") * 1048576 + F.col("l_suppkey") + 1


def _li_nth() -> Column:
    """Place of a lineitem row among those of one order line; with ``_li_ob`` unique at any scale."""
    same_line = Window.partitionBy("l_orderkey", "l_linenumber")
    return F.row_number().over(same_line.orderBy("l_partkey", "l_suppkey", "l_extendedprice", "l_quantity"))


LI_KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
LI_SORT = LI_KEYS + ["l_extendedprice", "l_quantity"]  # file order of rendered lineitem dumps
LI_ORD_SQL = "l_orderkey, l_linenumber, l_partkey, l_suppkey"


def _li_ord() -> Column:
    """File-order stand-in for lineitem rows; price and quantity break the rare full-key ties."""
    return F.struct(
        F.lit("lineitem").alias("_p"),
        _li_ob().cast("long").alias("_ob"),
        _li_om().cast("long").alias("_om"),
        F.col("l_extendedprice").alias("_t1"),
        F.col("l_quantity").alias("_t2"),
    )


def _supp_ok(spark, sf):
    return _t(spark, sf, "supplier").filter(F.col("s_acctbal") > 0).select(F.col("s_suppkey").alias("id"))


def _part_big(spark, sf):
    return _t(spark, sf, "part").filter(F.col("p_size") > 5).select(F.col("p_partkey").alias("id"))


def _orders_f(spark, sf):
    return _t(spark, sf, "orders").filter(F.col("o_orderstatus") == "F").select(F.col("o_orderkey").alias("id"))


SUPP_OK_SQL = "(SELECT s_suppkey FROM supplier WHERE s_acctbal > 0)"
PART_BIG_SQL = "(SELECT p_partkey FROM part WHERE p_size > 5)"
ORDERS_F_SQL = "(SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')"

# ------------------------------------------------------------------ specs for derived dumps

DOC_DUMP = TableSpec(
    name="documents_dump",
    columns=(Col("id", "int"), Col("ts", "str"), Col("text", "str")),
    dialect="L",
    assembly="parity",
    upsert="ignore",
    required=("id",),
)
PAGE_DUMP = TableSpec(
    name="pages_dump",
    columns=(Col("id", "int"), Col("ts", "str"), Col("url", "str"), Col("html", "str")),
    dialect="L",
    assembly="pattern",
    upsert="ignore",
    required=("id",),
)
DOC6_DUMP = TableSpec(
    name="documents_cluster_dump",
    columns=(Col("id", "int"), Col("date_created", "str"), Col("date_modified", "str"), Col("judges", "str"),
             Col("date_filed", "str"), Col("text", "str")),
    dialect="L",
    assembly="skip3",
    upsert="ignore",
    required=("id",),
)
CUST_DUMP = TableSpec(
    name="customer_dump",
    columns=(Col("c_custkey", "int"), Col("c_name", "str"), Col("c_nationkey", "int"), Col("c_acctbal", "double"),
             Col("c_mktsegment", "str")),
    dialect="T",
    assembly="single",
    upsert="ignore",
    required=("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"),
)
ROW3 = TableSpec(
    name="opinion_rows",
    columns=(Col("id", "int"), Col("date_created", "str"), Col("status", "str")),
    dialect="L",
    assembly="pattern",
    upsert="ignore",
    validate_opinion_row=True,
)
ROW5 = TableSpec(
    name="opinion_rows5",
    columns=(Col("id", "int"), Col("date_created", "str"), Col("a", "str"), Col("b", "str"), Col("c", "str")),
    dialect="L",
    assembly="pattern",
    upsert="ignore",
    min_columns=3,
    validate_opinion_row=True,
)
VARCHAR3 = TableSpec(
    name="cluster_strings",
    columns=(Col("id", "int"), Col("slug", "str_opt", max_len=75, not_null=False), Col("scdb_id", "str_trim", max_len=10)),
    dialect="L",
    assembly="skip3",
    upsert="ignore",
)
TS2 = TableSpec(
    name="opinion_ts",
    columns=(Col("id", "int"), Col("date_created", "ts")),
    dialect="L",
    assembly="pattern",
    upsert="ignore",
)

# ------------------------------------------------------------------ SRC: assembly and scans


def _doc_dump_path(spark, sf) -> str:
    d = _t(spark, sf, "documents")
    src = d.select(F.col("doc_id").alias("id"), _ts_text(F.col("doc_id")).alias("ts"), "text")
    return render_csv(spark, src, (sf, "documents", "id-ts-text"), sort="id")


def _doc_rows(spark, sf, mode) -> DataFrame:
    dump = read_dump(spark, _doc_dump_path(spark, sf), mode)
    return parse_records(dump, DOC_DUMP).select(F.col("id").cast("long").alias("doc_id"), "text")


def assemble_parity(spark, sf):
    """SRC-2: records rebuilt by quote parity."""
    return _doc_rows(spark, sf, "parity")


def assemble_parity_pattern(spark, sf):
    """SRC-4: records rebuilt by parity plus the id/timestamp pattern."""
    return _doc_rows(spark, sf, "parity_pattern")


def assemble_pattern_id_ts(spark, sf):
    """SRC-3: records rebuilt by the id/timestamp pattern alone."""
    p = _t(spark, sf, "pages")
    src = p.select(F.col("page_id").alias("id"), _ts_text(F.col("page_id")).alias("ts"), "url", "html")
    path = render_csv(spark, src, (sf, "pages", "id-ts-url-html"))
    rows = parse_records(read_dump(spark, path, "pattern"), PAGE_DUMP)
    return rows.select(F.col("id").cast("long").alias("page_id"), "url", "html")


def assemble_skip3_date(spark, sf):
    """SRC-5: id, three skipped fields, then a date decide a record start."""
    d = _t(spark, sf, "documents")
    src = d.select(
        F.col("doc_id").alias("id"),
        _ts_text(F.col("doc_id")).alias("date_created"),
        _ts_text(F.col("doc_id") + 7).alias("date_modified"),
        F.col("source").alias("judges"),
        F.format_string("19%02d-01-01", F.col("doc_id") % 100).alias("date_filed"),
        "text",
    )
    path = render_csv(spark, src, (sf, "documents", "cluster-like"))
    rows = parse_records(read_dump(spark, path, "skip3"), DOC6_DUMP)
    return rows.select(F.col("id").cast("long").alias("doc_id"), "text")


def _cust_line(cols: list[str]) -> Column:
    parts = []
    for c in cols:
        if c in ("c_name", "c_mktsegment"):
            parts.append(_q(F.col(c)))
        else:
            parts.append(_s(c))
    return F.concat_ws(",", *parts)


def _cust_rows(spark, sf, cols: list[str], tag: str) -> DataFrame:
    c = _t(spark, sf, "customer")
    path = render_lines(spark, c, _cust_line(cols), ",".join(cols), (sf, "customer", tag))
    rows = parse_records(read_dump(spark, path, "single"), CUST_DUMP)
    return rows.select(
        F.col("c_custkey").cast("long").alias("c_custkey"), "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"
    )


def scan_single_line(spark, sf):
    """SRC-6: one line per record, dialect T, header-driven (SRC-1)."""
    return _cust_rows(spark, sf, ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"], "natural")


def scan_header_order(spark, sf):
    """SRC-1/7: the same rows under a permuted header."""
    return _cust_rows(spark, sf, ["c_mktsegment", "c_acctbal", "c_name", "c_custkey", "c_nationkey"], "permuted")


def assemble_resync(spark, sf):
    """SRC-4 for opinions: private-use characters, dated body lines in quoted text, and a stray quote in each 50th row."""
    d = _t(spark, sf, "documents")
    fill = [F.lit("").alias(f"c{i}") for i in range(16)]
    src = d.select(
        F.col("doc_id").alias("id"),
        _ts_text(F.col("doc_id")).alias("date_created"),
        F.when(F.col("doc_id") % 50 == 7, F.lit(None))
        .when(F.col("doc_id") % 50 > 20, F.concat(F.lit("12,2013-01-01 entry\n\ue000\n13,2014-01-01\n"), "text"))
        .otherwise(F.concat(F.lit("\ue000"), "text")).alias("body"),
        *fill,
        F.lit("end").alias("last"),
    )
    line = F.concat_ws(
        ",", _s("id"), F.col("date_created"), F.coalesce(_q(F.col("body")), F.lit('5" tall')), *[f"c{i}" for i in range(16)], "last"
    )
    # 50 documents make a file of five splits; physical lines go straight to the assembly
    header = F.lit(",".join(["id", "date_created", "body", *[f"c{i}" for i in range(16)], "last"]))
    file, split = F.floor(F.col("id") / 50), F.floor(F.col("id") % 50 / 10)
    lines = src.select(
        file.cast("string").alias("_p"), split.alias("_b"), "id", F.posexplode(F.split(line, "\n", -1)).alias("_l", "value")
    ).select("value", "_p", "_b", (F.col("id") * F.lit(1 << 32) + F.col("_l") + 1).alias("_m"))
    heads = lines.select("_p").distinct().select(header.alias("value"), "_p", F.lit(0).cast("long").alias("_b"), F.lit(0).cast("long").alias("_m"))
    dump = assemble_lines(heads.unionByName(lines), "resync", in_order=False)
    rows = dump.records.withColumn("_f", split_lenient(F.col("raw")))
    return rows.select(
        S.parse_int(F.get("_f", 0)).cast("long").alias("doc_id"),
        F.when(F.col("raw").rlike('^[^"]*"[^"]*$'), F.lit("stray")).otherwise(F.get("_f", 2)).alias("body"),
    )


def preview_limit(spark, sf):
    """SRC-9: the first 10 records in file order (the limit is the feature)."""
    dump = read_dump(spark, _doc_dump_path(spark, sf), "parity")
    first = Dump(preview(dump.records, 10), dump.headers)
    return parse_records(first, DOC_DUMP).select(F.col("id").cast("long").alias("doc_id"), "text")


CUST_SQL = "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer"

# ------------------------------------------------------------------ PRJ: dialects


def split_lenient_q(spark, sf):
    """PRJ-1: dialect L on a line per document (text quoted, quotes doubled)."""
    d = _t(spark, sf, "documents")
    line = F.concat_ws(",", _s("doc_id"), _q(F.col("text")), F.col("lang"))
    f = split_lenient(line)
    return d.select(
        S.parse_int(F.get(f, 0)).cast("long").alias("doc_id"),
        F.get(f, 1).alias("text"),
        F.get(f, 2).alias("lang"),
        F.size(f).alias("n_fields"),
    )


def split_toggle_q(spark, sf):
    """PRJ-2: dialect T on a line per conversation turn."""
    c = _t(spark, sf, "conversations")
    line = F.concat_ws(",", _s("conv_id"), _s("turn"), _q(F.col("role")), _q(F.col("text")))
    f = split_toggle(line)
    return c.select(
        S.parse_int(F.get(f, 0)).cast("long").alias("conv_id"),
        S.parse_int(F.get(f, 1)).cast("long").alias("turn"),
        F.get(f, 2).alias("role"),
        F.get(f, 3).alias("text"),
        F.size(f).alias("n_fields"),
    )


def _esc_all(c: Column) -> Column:
    for x in '\\",':  # the backslash first: later ones are escapes
        c = F.replace(c, F.lit(x), F.lit("\\" + x))
    return c


def split_escape_all_q(spark, sf):
    """PRJ-3: dialect E on backslash-escaped pages."""
    p = _t(spark, sf, "pages")
    line = F.concat_ws(",", _s("page_id"), _esc_all(F.col("url")), _esc_all(F.col("html")))
    f = split_escape_all(line)
    return p.select(
        S.parse_int(F.get(f, 0)).cast("long").alias("page_id"),
        F.get(f, 1).alias("url"),
        F.get(f, 2).alias("html"),
        F.size(f).alias("n_fields"),
    )


# ------------------------------------------------------------------ SCL: scalars


def scalar_trim(spark, sf):
    c = _t(spark, sf, "customer")
    return c.select(
        "c_custkey",
        S.ctrim(F.concat(F.lit(" \t"), "c_name", F.lit(" \n\u000b\u000c "))).alias("name"),
        S.paren_trim(F.concat(F.lit("\t "), "c_mktsegment", F.lit("\r\n"))).alias("seg"),
    )


def scalar_bool(spark, sf):
    lb = _t(spark, sf, "labels")
    return lb.select(
        "doc_id",
        S.parse_bool(F.when(F.col("quality") == 1, F.lit(" Yes ")).otherwise(F.lit("y"))).alias("quality_b"),
        S.parse_bool(F.when(F.col("toxic") == 1, F.lit("T")).otherwise(F.lit("no"))).alias("toxic_b"),
        S.parse_bool(_s("quality")).alias("one_b"),
    )


def scalar_int_prefix(spark, sf):
    o = _t(spark, sf, "orders")
    return o.select(
        "o_orderkey",
        S.parse_int("o_orderpriority").alias("prio_n"),
        S.parse_int(F.concat(_s("o_orderkey"), F.lit("0000000000"))).alias("big_n"),
        S.parse_int(F.concat(F.lit("  +"), _s("o_custkey"), F.lit("abc"))).alias("cust_n"),
        S.parse_int(F.concat(F.lit("-"), _s("o_custkey"), F.lit(".5"))).alias("neg_n"),
    )


def scalar_int_wrap(spark, sf):
    o = _t(spark, sf, "orders")
    v = F.col("o_orderkey") * 1000003 + 2147483000
    txt = F.when(F.col("o_orderstatus") == "P", F.lit("  ")).otherwise(_s(v))
    return o.select("o_orderkey", S.parse_optional_int(txt).alias("wrapped"))


def scalar_double_prefix(spark, sf):
    li = _t(spark, sf, "lineitem")
    return li.select(
        *LI_KEYS,
        S.parse_double(F.concat(_s("l_discount"), F.lit("abc"))).alias("disc"),
        S.parse_double(F.concat(F.lit(" "), _s("l_tax"), F.lit("e0x"))).alias("tax"),
        S.parse_double(F.concat(F.lit("x"), _s("l_tax"))).alias("junk"),
    )


def scalar_score6(spark, sf):
    li = _t(spark, sf, "lineitem")
    return li.select(*LI_KEYS, S.score6("l_extendedprice").alias("score"))


def scalar_ts_cast(spark, sf):
    o = _t(spark, sf, "orders")
    txt = (
        F.when(F.col("o_orderpriority") == "5-LOW", F.concat(F.date_format("o_orderdate", "yyyy"), F.lit("-13-45 00:00:00")))
        .when(F.col("o_orderstatus") == "P", F.lit(""))
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))
    )
    ts = S.cast_timestamp(txt)
    return o.select(
        "o_orderkey",
        F.date_format(ts, "yyyy-MM-dd HH:mm:ss").alias("ts_out"),
        S.cast_failed(txt, ts).alias("failed"),
    )


def scalar_blank_null(spark, sf):
    c = _t(spark, sf, "customer")
    building = F.col("c_mktsegment") == "BUILDING"
    slug_txt = F.when(building, F.lit(" \t ")).otherwise(F.concat(F.lit(" "), "c_mktsegment", F.lit(" ")))
    url_txt = F.when(building, F.lit("  ")).otherwise(F.concat(F.lit(" "), "c_mktsegment"))
    return c.select(
        "c_custkey",
        S.blank_to_null(slug_txt, trim_value=True).alias("slug"),
        S.null_to_empty(S.blank_to_null(url_txt)).alias("url"),
    )


def scalar_sentinel(spark, sf):
    c = _t(spark, sf, "customer")
    return c.select("c_custkey", S.docket_sentinel("c_nationkey").alias("docket_id"))


def csv_escape_q(spark, sf):
    p = _t(spark, sf, "pages")
    return p.select("page_id", S.csv_escape("html").alias("html_csv"))


def record_diagnostics_q(spark, sf):
    d = _t(spark, sf, "documents")
    return d.select("doc_id", *S.record_diagnostics(F.col("text")))


# ------------------------------------------------------------------ VAL: validation


def _reason_cols(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.select(*keys, "category", "reason")


def validate_opinion_row(spark, sf):
    o = _t(spark, sf, "orders")
    id_txt = F.when(F.col("o_orderpriority") == "2-HIGH", F.concat(F.lit("x"), _s("o_orderkey"))).otherwise(_s("o_orderkey"))
    dc = F.when(F.col("o_orderstatus") == "P", F.lit("")).otherwise(F.lit("2020-01-01"))
    raw = F.concat_ws(",", id_txt, dc, F.col("o_orderstatus"))
    dump = frame_dump(o, raw, "id,date_created,status", F.col("o_orderkey"), F.lit(1), "orders")
    rows = parse_records(dump, ROW3)
    return rows.select(F.col("_ob").alias("o_orderkey"), F.col("reason").isNull().alias("valid"), "reason")


def _li_varcols() -> Column:
    vals = F.array(_s("l_orderkey"), _s("l_linenumber"), _s("l_partkey"), _s("l_suppkey"), F.col("l_returnflag"),
                   F.col("l_linestatus"), _s(F.col("l_orderkey") + 1))
    return F.array_join(F.slice(vals, 1, F.col("l_linenumber")), ",")


def _li_varcount_rows(spark, sf) -> DataFrame:
    li = _t(spark, sf, "lineitem")
    dump = frame_dump(li, _li_varcols(), "id,date_created,a,b,c", _li_ob(), _li_nth(), "lineitem", carry=LI_KEYS)
    return parse_records(dump, ROW5)


def record_diagnostics_mismatch(spark, sf):
    """SCL-13: diagnostics of the records whose column count differs from the header."""
    from ..operators.project import diagnose_mismatches

    li = _t(spark, sf, "lineitem")
    dump = frame_dump(li, _li_varcols(), "id,date_created,a,b,c", _li_ob(), _li_nth(), "lineitem", carry=LI_KEYS)
    d = diagnose_mismatches(parse_records(dump, ROW5), 5, keep=tuple(LI_KEYS))
    return d.select(*LI_KEYS, "record_length", "quote_count", "newline_count", "column_count")


def validate_column_count(spark, sf):
    rows = _li_varcount_rows(spark, sf)
    return rows.select(*LI_KEYS, "n_cols", "reason")


def quarantine(spark, sf):
    """VAL-8: every rejected row with its reason and raw text."""
    rows = _li_varcount_rows(spark, sf)
    return rows.filter(F.col("category").isNotNull()).select(*LI_KEYS, "reason", "raw")


def validate_key(spark, sf):
    li = _t(spark, sf, "lineitem")
    drop_id = (F.col("l_linestatus") == "O") & (F.col("l_returnflag") == "N")
    id_txt = F.when(F.col("l_returnflag") == "R", F.lit("0")).otherwise(_s(_li_ob()))
    raw = F.when(drop_id, F.concat_ws(",", _s("l_partkey"), _s("l_suppkey"), F.col("l_returnflag"))).otherwise(
        F.concat_ws(",", _s("l_partkey"), _s("l_suppkey"), F.col("l_returnflag"), id_txt)
    )
    dump = frame_dump(li, raw, "person_id,opinioncluster_id,extra,id", _li_ob(), _li_nth(), "lineitem", carry=LI_KEYS)
    spec = TableSpec(
        name="panel_keys", columns=PANEL.columns, dialect="T", assembly="single", upsert="natural",
        min_columns=3, key_rule="eq0", required=PANEL.required,
    )
    return parse_records(dump, spec).select(*LI_KEYS, "id", "reason")


def validate_varchar(spark, sf):
    p = _t(spark, sf, "part")
    raw = F.concat_ws(",", _s("p_partkey"), _q(F.concat_ws(" ", "p_name", "p_name")), F.col("p_type"))
    dump = frame_dump(p, raw, "id,slug,scdb_id", F.col("p_partkey"), F.lit(1), "part")
    rows = parse_records(dump, VARCHAR3)
    return rows.select(F.col("_ob").alias("p_partkey"), "category", "reason")


def validate_not_null(spark, sf):
    o = _t(spark, sf, "orders")
    dc = (
        F.when(F.col("o_orderstatus") == "F", F.lit(""))
        .when(F.col("o_orderpriority") == "1-URGENT", F.lit("garbage"))
        .otherwise(F.lit("2020-01-01 00:00:00"))
    )
    raw = F.concat_ws(",", _s("o_orderkey"), dc)
    dump = frame_dump(o, raw, "id,date_created", F.col("o_orderkey"), F.lit(1), "orders")
    rows = parse_records(dump, TS2)
    return rows.select(F.col("_ob").alias("o_orderkey"), "category", "reason")


# ------------------------------------------------------------------ JON / FKR: foreign keys


def fk_valid_q(spark, sf):
    li = _t(spark, sf, "lineitem").select(*LI_KEYS)
    return FKO.fk_valid(li, "l_suppkey", _supp_ok(spark, sf))


def fk_missing_q(spark, sf):
    li = _t(spark, sf, "lineitem").select(*LI_KEYS)
    return FKO.fk_missing(li, "l_suppkey", _supp_ok(spark, sf))


def fk_multi(spark, sf):
    li = _t(spark, sf, "lineitem").select(*LI_KEYS)
    x = FKO.with_presence(li, "l_suppkey", _supp_ok(spark, sf), "_has_supp")
    x = FKO.with_presence(x, "l_partkey", _part_big(spark, sf), "_has_part")
    missing = FKO.missing_list([("l_suppkey", "_has_supp"), ("l_partkey", "_has_part")])
    return x.select(*LI_KEYS, F.array_join(missing, ",").alias("missing"))


def fk_reject(spark, sf):
    li = _t(spark, sf, "lineitem").select(*LI_KEYS)
    return FKO.fk_missing(li, "l_suppkey", _supp_ok(spark, sf)).select(*LI_KEYS, FKO.fk_reason("l_suppkey", "supplier").alias("reason"))


def placeholder_cluster(spark, sf):
    li = _t(spark, sf, "lineitem")
    ids = FKO.distinct_missing(li, ["l_suppkey"], _supp_ok(spark, sf))
    rows = PH.cluster_rows(ids, "T2", AS_OF)
    return rows.select(
        "id", "judges", "case_name", "case_name_full", "source", "precedential_status", "docket_id", "citation_count",
        "blocked", "slug", F.date_format("date_filed", "yyyy-MM-dd").alias("date_filed"),
        F.date_format("date_created", "yyyy-MM-dd HH:mm:ss").alias("date_created"),
    )


def placeholder_opinion(spark, sf):
    li = _t(spark, sf, "lineitem")
    ids = FKO.distinct_missing(li, ["l_partkey"], _part_big(spark, sf))
    rows = PH.opinion_rows(ids, "T4", AS_OF)
    return rows.select("id", "type", "sha1", "cluster_id", "download_url", "extracted_by_ocr", "author_id")


def placeholder_ids(spark, sf):
    li = _t(spark, sf, "lineitem")
    a = FKO.distinct_missing(li, ["l_suppkey"], _supp_ok(spark, sf)).select(F.lit("search_opinioncluster").alias("parent"), "id")
    b = FKO.distinct_missing(li, ["l_partkey"], _part_big(spark, sf)).select(F.lit("search_opinion").alias("parent"), "id")
    return a.unionByName(b)


def placeholder_two_fk(spark, sf):
    li = _t(spark, sf, "lineitem")
    ids = FKO.distinct_missing(li, ["l_partkey", "l_suppkey"], _part_big(spark, sf))
    return PH.opinion_rows(ids, "T4", AS_OF).select("id", "sha1", "cluster_id")


def _paren_lines(spark, sf) -> tuple[DataFrame, Column]:
    li = _t(spark, sf, "lineitem")
    text = F.concat(F.lit("note "), "l_returnflag", F.lit(","), "l_linestatus", F.lit(' "q" \\'))
    score = F.col("l_extendedprice") / F.col("l_quantity")
    raw = F.concat_ws(
        ",", _s(_li_ob()), _esc_all(text), _s(score), _s("l_partkey"), _s("l_suppkey"), _s("l_orderkey")
    )
    return li, raw


PAREN_HEADER = "id,text,score,described_opinion_id,describing_opinion_id,group_id"


def _paren_load(spark, sf):
    li, raw = _paren_lines(spark, sf)
    path = render_lines(spark, li, raw, PAREN_HEADER, (sf, "lineitem", "parentheticals"), sort=LI_SORT)
    parents = {
        "search_opinion": _part_big(spark, sf),
        "search_parentheticalgroup": _orders_f(spark, sf),
        "search_opinioncluster": _t(spark, sf, "supplier").select(F.col("s_suppkey").alias("id")),
    }
    return load(spark, PARENTHETICAL, path, parents=parents, as_of=AS_OF)


def placeholder_three_fk(spark, sf):
    """FKR-4: two FKs into opinions and one into groups, repaired in one pass (+ base rows)."""
    return _paren_load(spark, sf).placeholder_ids


def placeholder_base(spark, sf):
    """FKR-6: the circular base rows (opinion 1, group 1) created with the first group placeholder."""
    r = _paren_load(spark, sf)
    return r.placeholder_ids.filter(F.col("id") == 1)


def placeholder_base_trio(spark, sf):
    """FKR-6: opinion 1 and group 1 are missing parents, so the base trio comes with the first group placeholder."""
    li, raw = _paren_lines(spark, sf)
    path = render_lines(spark, li, raw, PAREN_HEADER, (sf, "lineitem", "parentheticals"), sort=LI_SORT)
    without_one = lambda df: df.filter(F.col("id") != 1)
    parents = {
        "search_opinion": without_one(_part_big(spark, sf)),
        "search_parentheticalgroup": without_one(_orders_f(spark, sf)),
        "search_opinioncluster": _t(spark, sf, "supplier").select(F.col("s_suppkey").alias("id")),  # holds the cluster of the placeholders
    }
    r = load(spark, PARENTHETICAL, path, parents=parents, as_of=AS_OF)
    base = r.target.filter((F.col("id") == 1) & (F.col("text") == "PLACEHOLDER")).select(F.lit(PARENTHETICAL.name).alias("parent"), "id")
    return r.placeholder_ids.unionByName(base)


def _jb_load(spark, sf, create_docket: bool = True):
    li = _t(spark, sf, "lineitem")
    raw = F.concat_ws(",", _s(_li_ob()), _s("l_orderkey"), _s("l_linenumber"))
    path = render_lines(spark, li, raw, "id,opinion_id,person_id", (sf, "lineitem", "joined_by"))
    parents = {
        "search_opinion": _orders_f(spark, sf),
        "search_opinioncluster": _t(spark, sf, "supplier").filter(F.col("s_suppkey") > 1).select(F.col("s_suppkey").alias("id")),
        "search_docket": _t(spark, sf, "region").filter(F.col("r_regionkey") > 1).select(F.col("r_regionkey").alias("id")),
    }
    return load(spark, JOINED_BY, path, parents=parents, as_of=AS_OF, create_docket=create_docket)


def placeholder_ids_csv(spark, sf):
    """SNK-4: the placeholder ids of the chain load written as CSV per parent and read back."""
    from ..sinks import write_placeholder_ids

    path = scratch_path(spark, "placeholder-ids")
    write_placeholder_ids(_jb_load(spark, sf).placeholder_ids, path)
    back = spark.read.options(header=True, escape='"').csv(path)
    return back.select("parent", F.col("id").cast("int").alias("id"))


def placeholder_chain(spark, sf):
    """FKR-5: placeholder opinions need cluster 1, which needs docket 1 (created on request)."""
    return _jb_load(spark, sf).placeholder_ids


# ------------------------------------------------------------------ UPS: conflict rules


def _li_rows(spark, sf) -> DataFrame:
    li = _t(spark, sf, "lineitem")
    ok = FKO.with_presence(li, "l_suppkey", _supp_ok(spark, sf), "_ok")
    return ok.select(
        _li_ob().alias("id"), *LI_KEYS, "l_quantity", "l_returnflag", "l_linestatus", _li_ord().alias("_ord"), "_ok",
        F.when(~F.col("_ok"), FKO.fk_reason("l_suppkey", "supplier")).alias("_fkr"),
    )


UPS_COLS = ["id", "l_partkey", "l_suppkey", "l_quantity"]


def upsert_ignore_q(spark, sf):
    return upsert_ignore(_li_rows(spark, sf), None, UPS_COLS).target


def upsert_ignore_status(spark, sf):
    st = upsert_ignore(_li_rows(spark, sf), None, UPS_COLS).status
    return st.select(F.col("_ord._ob").alias("ob"), F.col("_ord._om").alias("om"), "status", "reason")


def upsert_partial_q(spark, sf):
    return upsert_partial(_li_rows(spark, sf), None, UPS_COLS, ["l_quantity"]).target


def upsert_last_q(spark, sf):
    return upsert_last(_li_rows(spark, sf), None, UPS_COLS).target


def _nat_rows(spark, sf) -> DataFrame:
    r = _li_rows(spark, sf).withColumn("_ok", F.lit(True)).withColumn("_fkr", F.lit(None).cast("string"))
    code = (F.position(F.col("l_returnflag"), F.lit("ARN")) - 1) * 2 + (F.col("l_linestatus") == "O").cast("int")
    return r.withColumn("type", F.col("l_suppkey")).withColumn("id4", F.col("id") * 6 + code)


def upsert_natural_key(spark, sf):
    r = _nat_rows(spark, sf)
    cols = ["id", "l_orderkey", "l_linenumber", "type"]
    return upsert_natural(r, None, cols, ["l_orderkey", "l_linenumber"], ["id", "type"]).target


def upsert_natural_key4(spark, sf):
    r = _nat_rows(spark, sf).drop("id").withColumnRenamed("id4", "id")
    cols = ["id", "l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus", "type"]
    return upsert_natural(r, None, cols, ["l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus"], ["id", "type"]).target


def upsert_natural_dirty(spark, sf):
    """UPS-4 with ids shared by several keys: the first key of an id keeps it, and a key moves on to its last id."""
    r = _nat_rows(spark, sf)
    cols = ["id", "l_partkey", "l_suppkey", "type"]
    up = upsert_natural(r, None, cols, ["l_partkey", "l_suppkey"], ["id", "type"])
    return up.target


def upsert_natural_claims(spark, sf):
    """UPS-4 where all lines of an order claim one id: the first key keeps it, later keys are rejected."""
    r = _nat_rows(spark, sf).withColumn("id", F.col("l_orderkey"))
    cols = ["id", "l_orderkey", "l_linenumber", "type"]
    return upsert_natural(r, None, cols, ["l_orderkey", "l_linenumber"], ["id", "type"]).target


def upsert_natural_moves(spark, sf):
    """UPS-5 where every row brings an id of its own: the key takes the last one."""
    r = _nat_rows(spark, sf).withColumn("id", F.col("id") * 64 + F.row_number().over(
        Window.partitionBy("l_orderkey", "l_linenumber").orderBy("_ord")
    ))
    cols = ["id", "l_orderkey", "l_linenumber", "type"]
    return upsert_natural(r, None, cols, ["l_orderkey", "l_linenumber"], ["id", "type"]).target


def _contested(spark, sf):
    """Lines of an order that ask for few ids in turn: ids are claimed, refused, released and claimed again."""
    r = _nat_rows(spark, sf).withColumn("id", F.col("l_orderkey") * 8 + F.col("l_partkey") % 4).withColumn("k", F.col("l_suppkey") % 3)
    cols = ["id", "l_orderkey", "k", "type"]
    return upsert_natural(r, None, cols, ["l_orderkey", "k"], ["id", "type"])


def upsert_natural_contested(spark, sf):
    """UPS-4 where ids change hands within an order: the final rows."""
    return _contested(spark, sf).target


def upsert_natural_contested_status(spark, sf):
    """UPS-4 where ids change hands within an order: how many rows of each order were inserted, updated and refused."""
    st = _contested(spark, sf).status.withColumn("l_orderkey", F.floor(F.col("_ord._ob") / 8))
    return st.groupBy("l_orderkey", "status").agg(F.count("*").alias("n"))


# ------------------------------------------------------------------ AGG / SNK: report and outputs


def _panel_reject_load(spark, sf):
    li = _t(spark, sf, "lineitem")
    bad = (F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F")
    id_txt = F.when(bad, F.lit("0")).otherwise(_s(_li_ob()))
    raw = F.concat_ws(",", id_txt, _s("l_orderkey"), _s("l_linenumber"))
    dump = frame_dump(li, raw, "id,opinioncluster_id,person_id", _li_ob(), _li_nth(), "lineitem")
    return load(spark, PANEL, dump, parents={"search_opinioncluster": _orders_f(spark, sf)}, on_missing_parent="reject")


def load_report(spark, sf):
    return R.batch_report(_panel_reject_load(spark, sf).outcomes)


def _panel_repair_load(spark, sf):
    """The same dump in placeholder mode: unknown clusters are created."""
    li = _t(spark, sf, "lineitem")
    bad = (F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F")
    raw = F.concat_ws(",", F.when(bad, F.lit("0")).otherwise(_s(_li_ob())), _s("l_orderkey"), _s("l_linenumber"))
    dump = frame_dump(li, raw, "id,opinioncluster_id,person_id", _li_ob(), _li_nth(), "lineitem")
    return load(spark, PANEL, dump, parents={"search_opinioncluster": _orders_f(spark, sf)}, as_of=AS_OF)


def load_report_placeholders(spark, sf):
    """AGG-1: placeholders by the batch that first needed them."""
    return _panel_repair_load(spark, sf).batch_report().select("batch", "attempted", "rejected", "placeholders")


def load_totals_placeholders(spark, sf):
    """AGG-3: run totals with the placeholders created."""
    return _panel_repair_load(spark, sf).totals().select("attempted", "inserted", "updated", "rejected", "placeholders")


def load_totals(spark, sf):
    return R.totals(_panel_reject_load(spark, sf).outcomes)


def failure_categories_q(spark, sf):
    return R.failure_categories(_panel_reject_load(spark, sf).outcomes)


def sample_failures_q(spark, sf):
    s = R.sample_failures(_panel_reject_load(spark, sf).outcomes)
    return s.select("batch", "pos", "reason")


def first_bad_records_q(spark, sf):
    """AGG-4: the first 10 rejected records of the run (a top-k report)."""
    r = _panel_reject_load(spark, sf)
    return R.first_bad_records(r.outcomes, 10).select("_ob", "_om", "reason")


def bad_records(spark, sf):
    """SNK-2: typed bad-records CSV written and read back."""
    r = _panel_reject_load(spark, sf)
    path = scratch_path(spark, "bad-records")
    write_csv(bad_records_typed(r.rejects, PANEL.names), path)
    return spark.read.options(header=True, escape='"').csv(path)


def bad_records_raw_q(spark, sf):
    """SNK-3: raw bad-records CSV (rows that failed parsing) written and read back."""
    r = _panel_reject_load(spark, sf)
    path = scratch_path(spark, "bad-records-raw")
    write_csv(bad_records_raw(r.rejects.filter(F.col("category") == "parse")), path)
    return spark.read.options(header=True, escape='"', multiLine=True).csv(path)


# ------------------------------------------------------------------ PIP: load jobs


def _opinion_src(spark, sf) -> DataFrame:
    d = _t(spark, sf, "documents")
    vals = {
        "id": _s("doc_id"),
        "date_created": _ts_text(F.col("doc_id")),
        "date_modified": _ts_text(F.col("doc_id") + 3),
        "type": F.col("lang"),
        "sha1": F.col("source"),
        "plain_text": F.col("text"),
        "extracted_by_ocr": F.when(F.col("n_chars") > 1000, F.lit("true")).otherwise(F.lit("f")),
        "cluster_id": _s("doc_id"),
        "per_curiam": F.lit("false"),
        "page_count": _s(F.col("n_chars")),
    }
    return d.select(*[(vals.get(c.name, F.lit(""))).alias(c.name) for c in OPINION.columns])


def _opinion_load(spark, sf):
    path = render_csv(spark, _opinion_src(spark, sf), (sf, "documents", "opinions"))
    parents = {"search_opinioncluster": _t(spark, sf, "labels").select(F.col("doc_id").alias("id"))}
    return load(spark, OPINION, path, parents=parents, as_of=AS_OF)


def load_opinions(spark, sf):
    t = _opinion_load(spark, sf).target
    return t.select(
        F.col("id").cast("long").alias("id"), "type", "sha1", "plain_text", F.col("cluster_id").cast("long").alias("cluster_id"),
        "extracted_by_ocr", "page_count", "download_url", "author_id",
    )


def load_opinions_placeholders(spark, sf):
    c = _opinion_load(spark, sf).placeholders["search_opinioncluster"]
    return c.select(
        F.col("id").cast("long").alias("id"), "case_name", "source", "precedential_status", "docket_id",
        F.date_format("date_filed", "yyyy-MM-dd").alias("date_filed"),
    )


def _cluster_dump_path(spark, sf) -> str:
    c = _t(spark, sf, "customer")
    first = ["id", "date_created", "date_modified", "judges", "date_filed"]
    from ..specs import CLUSTER

    order = first + [x.name for x in CLUSTER.columns if x.name not in first]
    vals = {
        "id": _s("c_custkey"),
        "date_created": _ts_text(F.col("c_custkey")),
        "date_modified": _ts_text(F.col("c_custkey") + 1),
        "judges": F.col("c_name"),
        "date_filed": F.format_string("19%02d-06-15", F.col("c_custkey") % 100),
        "case_name": F.concat(F.lit("In re "), F.col("c_name"), F.lit(",\nappeal")),
        "slug": F.concat(F.lit(" "), F.col("c_mktsegment")),
        "source": F.lit("X"),
        "precedential_status": F.lit("Published"),
        "citation_count": _s("c_acctbal"),
        "docket_id": _s("c_nationkey"),
        "blocked": F.when(F.col("c_acctbal") < 0, F.lit("TRUE")).otherwise(F.lit("0")),
    }
    src = c.select(*[(vals.get(n, F.lit(""))).alias(n) for n in order])
    return render_csv(spark, src, (sf, "customer", "clusters"))


def _cluster_load(spark, sf):
    from ..specs import CLUSTER

    return load(spark, CLUSTER, _cluster_dump_path(spark, sf), as_of=AS_OF)


def load_clusters(spark, sf):
    t = _cluster_load(spark, sf).target
    return t.select(
        F.col("id").cast("long").alias("id"), "judges", "case_name", "slug", "docket_id", "citation_count", "blocked",
        F.date_format("date_filed", "yyyy-MM-dd").alias("date_filed"),
    )


def _panel_lines_path(spark, sf) -> str:
    li = _t(spark, sf, "lineitem")
    bad = (F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F")
    id_txt = F.when(bad, F.lit("0")).otherwise(_s(_li_ob()))
    raw = F.concat_ws(",", _q(id_txt), _s("l_orderkey"), _s("l_linenumber"))
    return render_lines(spark, li, raw, "id,opinioncluster_id,person_id", (sf, "lineitem", "panels"))


def load_panels(spark, sf):
    parents = {"search_opinioncluster": _orders_f(spark, sf)}
    r = load(spark, PANEL, _panel_lines_path(spark, sf), parents=parents, as_of=AS_OF)
    return r.target


def load_panels_written(spark, sf):
    """SNK-1: the panel target written as Parquet (parents first) and read back."""
    from ..sinks import write_table

    parents = {"search_opinioncluster": _orders_f(spark, sf)}
    r = load(spark, PANEL, _panel_lines_path(spark, sf), parents=parents, as_of=AS_OF)
    root = scratch_path(spark, "tables")
    for parent, rows in r.placeholders.items():
        write_table(rows, f"{root}/{parent}_placeholders")
    write_table(r.target, f"{root}/{PANEL.name}")
    return spark.read.parquet(f"{root}/{PANEL.name}")


def load_panels_placeholders(spark, sf):
    parents = {"search_opinioncluster": _orders_f(spark, sf)}
    r = load(spark, PANEL, _panel_lines_path(spark, sf), parents=parents, as_of=AS_OF)
    return r.placeholders["search_opinioncluster"].select("id", "judges", "source", "docket_id")


def load_joined_by(spark, sf):
    return _jb_load(spark, sf).target


def load_citation_map(spark, sf):
    li = _t(spark, sf, "lineitem")
    raw = F.concat_ws(",", _s(_li_ob()), _s(F.col("l_quantity").cast("int")), _s("l_partkey"), _s("l_suppkey"))
    path = render_lines(spark, li, raw, "id,depth,cited_opinion_id,citing_opinion_id", (sf, "lineitem", "cited"), sort=LI_SORT)
    parents = {"search_opinion": _part_big(spark, sf), "search_opinioncluster": _t(spark, sf, "supplier").select(F.col("s_suppkey").alias("id"))}
    return load(spark, CITED, path, parents=parents, as_of=AS_OF).target


def load_reporter_citations(spark, sf):
    li = _t(spark, sf, "lineitem")
    code = (F.position(F.col("l_returnflag"), F.lit("ARN")) - 1) * 2 + (F.col("l_linestatus") == "O").cast("int")
    raw = F.concat_ws(
        ",", _s(_li_ob() * 6 + code), _s("l_linenumber"), _q(F.concat(F.lit(" "), "l_returnflag")), _q(F.col("l_linestatus")),
        _s("l_suppkey"), _s("l_orderkey"),
    )
    path = render_lines(spark, li, raw, "id,volume,reporter,page,type,cluster_id", (sf, "lineitem", "citations"), sort=LI_SORT)
    parents = {"search_opinioncluster": _orders_f(spark, sf)}
    return load(spark, SEARCH_CITATION, path, parents=parents, as_of=AS_OF).target


def load_parentheticals(spark, sf):
    return _paren_load(spark, sf).target


def load_all_tables(spark, sf):
    """PIP-1..7 as one load: rows, sum of ids and orphans of every table; no child lacks its parent."""
    from ..specs import CLUSTER
    from .load_all import DOCKET, load_all

    li = _t(spark, sf, "lineitem")
    pl, paren = _paren_lines(spark, sf)
    code = (F.position(F.col("l_returnflag"), F.lit("ARN")) - 1) * 2 + (F.col("l_linestatus") == "O").cast("int")
    cites = F.concat_ws(",", _s(_li_ob() * 6 + code), _s("l_linenumber"), "l_returnflag", "l_linestatus", _s("l_suppkey"), _s("l_orderkey"))
    joined = F.concat_ws(",", _s(_li_ob()), _s("l_orderkey"), _s("l_linenumber"))
    cited = F.concat_ws(",", _s(_li_ob()), _s(F.col("l_quantity").cast("int")), _s("l_partkey"), _s("l_suppkey"))
    dumps = {
        CLUSTER.name: _cluster_dump_path(spark, sf),
        OPINION.name: render_csv(spark, _opinion_src(spark, sf), (sf, "documents", "opinions")),
        PANEL.name: _panel_lines_path(spark, sf),
        SEARCH_CITATION.name: render_lines(spark, li, cites, "id,volume,reporter,page,type,cluster_id", (sf, "lineitem", "all-citations")),
        JOINED_BY.name: render_lines(spark, li, joined, "id,opinion_id,person_id", (sf, "lineitem", "joined_by")),
        CITED.name: render_lines(spark, li, cited, "id,depth,cited_opinion_id,citing_opinion_id", (sf, "lineitem", "cited"), sort=LI_SORT),
        PARENTHETICAL.name: render_lines(spark, pl, paren, PAREN_HEADER, (sf, "lineitem", "parentheticals"), sort=LI_SORT),
    }
    dockets = _t(spark, sf, "nation").select(
        F.when(F.col("n_nationkey") > 0, F.col("n_nationkey")).otherwise(S.DOCKET_SENTINEL).cast("int").alias("id")
    )
    done = load_all(spark, dumps, scratch_path(spark, "load-all"), parents={DOCKET: dockets}, as_of=AS_OF)
    orphans = done.orphans().groupBy(F.col("child").alias("table")).agg(F.sum("orphans").alias("orphans"))
    out = None
    for name, rows in done.tables.items():
        part = rows.agg(F.count(F.lit(1)).alias("rows"), F.sum(F.col("id").cast("long")).alias("id_sum")).select(F.lit(name).alias("table"), "rows", "id_sum")
        out = part if out is None else out.unionByName(part)
    return out.join(orphans, "table", "left").select("table", "rows", "id_sum", F.coalesce("orphans", F.lit(0).cast("long")).alias("orphans"))


def stream_equals_batch(spark, sf):
    """STR-1: the panel dump loaded as a file stream (available-now trigger) equals the batch load."""
    from ..streaming.incremental import load_stream

    parents = {"search_opinioncluster": _orders_f(spark, sf)}
    return load_stream(spark, PANEL, _panel_lines_path(spark, sf), parents=parents, as_of=AS_OF)


# ------------------------------------------------------------------ oracle SQL

_LI_FIRST_OK = f"""
  SELECT l_orderkey * 8 + l_linenumber AS id, l_partkey, l_suppkey, l_quantity,
         row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey, l_extendedprice, l_quantity) AS rn
  FROM lineitem WHERE l_suppkey IN {SUPP_OK_SQL}"""

_PANEL_OUTCOMES = f"""
  SELECT l_orderkey * 8 + l_linenumber AS ob, l_orderkey, l_linenumber,
    row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey, l_extendedprice, l_quantity) AS om,
    CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN 'rejected'
         WHEN l_orderkey NOT IN {ORDERS_F_SQL} THEN 'rejected'
         WHEN row_number() OVER (PARTITION BY l_orderkey, l_linenumber, (l_returnflag = 'R' AND l_linestatus = 'F')
                                 ORDER BY l_partkey, l_suppkey) = 1 THEN 'inserted'
         ELSE 'updated' END AS status,
    CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN 'invalid id=0'
         WHEN l_orderkey NOT IN {ORDERS_F_SQL}
           THEN 'FK violation: opinioncluster_id=' || l_orderkey || ' not found in search_opinioncluster' END AS reason,
    CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN 'parse'
         WHEN l_orderkey NOT IN {ORDERS_F_SQL} THEN 'fk' END AS category,
    row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey) - 1 AS pos
  FROM lineitem"""

_COUNTS_SQL = """count(*) AS attempted,
    count(*) FILTER (WHERE status = 'inserted') AS inserted,
    count(*) FILTER (WHERE status = 'updated') AS updated,
    count(*) FILTER (WHERE status = 'duplicate_noop') AS duplicate_noop,
    count(*) FILTER (WHERE status = 'rejected') AS rejected,
    count(*) FILTER (WHERE status <> 'rejected') AS reference_inserted"""

_NAT_CODE = "((position(l_returnflag IN 'ARN') - 1) * 2 + CAST(l_linestatus = 'O' AS INTEGER))"

_PAREN_SQL_ROWS = """
  SELECT l_orderkey * 8 + l_linenumber AS id, 'note ' || l_returnflag || ',' || l_linestatus || ' "q" \\' AS text,
         CAST(printf('%.6g', l_extendedprice / l_quantity) AS DOUBLE) AS score,
         CAST(l_partkey AS INTEGER) AS described_opinion_id, CAST(l_suppkey AS INTEGER) AS describing_opinion_id,
         CAST(l_orderkey AS INTEGER) AS group_id,
         row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey DESC, l_suppkey DESC, l_extendedprice DESC, l_quantity DESC) AS rn
  FROM lineitem"""

# Replay of each order's rows in turn; ``held`` are the rows of its keys so far.
_CONTESTED_SQL = """e AS (
          SELECT l_orderkey, l_orderkey * 8 + l_partkey % 4 AS id, l_suppkey % 3 AS k, l_suppkey AS type,
                 row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity) AS nth
          FROM lineitem
        ), step AS (
          SELECT DISTINCT l_orderkey, 0::BIGINT AS nth, []::STRUCT(id BIGINT, k BIGINT, type BIGINT)[] AS held, '' AS status FROM e
          UNION ALL
          SELECT e.l_orderkey, e.nth,
                 CASE WHEN len(list_filter(s.held, lambda x: x.id = e.id AND x.k <> e.k)) > 0 THEN s.held
                      ELSE list_append(list_filter(s.held, lambda x: x.k <> e.k), {'id': e.id::BIGINT, 'k': e.k::BIGINT, 'type': e.type::BIGINT}) END,
                 CASE WHEN len(list_filter(s.held, lambda x: x.id = e.id AND x.k <> e.k)) > 0 THEN 'rejected'
                      WHEN len(list_filter(s.held, lambda x: x.k = e.k)) > 0 THEN 'updated' ELSE 'inserted' END
          FROM step s JOIN e ON e.l_orderkey = s.l_orderkey AND e.nth = s.nth + 1
        ), last AS (SELECT l_orderkey, arg_max(held, nth) AS held FROM step GROUP BY 1)"""

ORACLES: dict[str, str] = {
    "assemble_parity": "SELECT doc_id, text FROM documents",
    "assemble_parity_pattern": "SELECT doc_id, text FROM documents",
    "assemble_pattern_id_ts": "SELECT page_id, url, html FROM pages",
    "assemble_skip3_date": "SELECT doc_id, text FROM documents",
    "assemble_resync": """SELECT doc_id, CASE WHEN doc_id % 50 = 7 THEN 'stray'
        WHEN doc_id % 50 <= 20 THEN chr(57344) || text
        ELSE '12,2013-01-01 entry' || chr(10) || chr(57344) || chr(10) || '13,2014-01-01' || chr(10) || text END AS body FROM documents""",
    "scan_single_line": CUST_SQL,
    "scan_header_order": CUST_SQL,
    "preview_limit": "SELECT doc_id, text FROM documents ORDER BY doc_id LIMIT 10",
    "split_lenient": "SELECT doc_id, text, lang, 3 AS n_fields FROM documents",
    "split_toggle": "SELECT conv_id, turn, role, text, 4 AS n_fields FROM conversations",
    "split_escape_all": "SELECT page_id, url, html, 3 AS n_fields FROM pages",
    "scalar_trim": "SELECT c_custkey, c_name AS name, c_mktsegment AS seg FROM customer",
    "scalar_bool": "SELECT doc_id, quality = 1 AS quality_b, toxic = 1 AS toxic_b, quality = 1 AS one_b FROM labels",
    "scalar_int_prefix": """SELECT o_orderkey, CAST(left(o_orderpriority, 1) AS INTEGER) AS prio_n, 0 AS big_n,
        CAST(o_custkey AS INTEGER) AS cust_n, -CAST(o_custkey AS INTEGER) AS neg_n FROM orders""",
    "scalar_int_wrap": """SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE CAST(
        CASE WHEN (o_orderkey * 1000003 + 2147483000) % 4294967296 >= 2147483648
             THEN (o_orderkey * 1000003 + 2147483000) % 4294967296 - 4294967296
             ELSE (o_orderkey * 1000003 + 2147483000) % 4294967296 END AS INTEGER) END AS wrapped FROM orders""",
    "scalar_double_prefix": f"SELECT {LI_ORD_SQL}, l_discount AS disc, l_tax AS tax, 0.0 AS junk FROM lineitem",
    "scalar_score6": f"SELECT {LI_ORD_SQL}, CAST(printf('%.6g', l_extendedprice) AS DOUBLE) AS score FROM lineitem",
    "scalar_ts_cast": """SELECT o_orderkey,
        CASE WHEN o_orderpriority = '5-LOW' OR o_orderstatus = 'P' THEN NULL
             ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS ts_out,
        o_orderpriority = '5-LOW' AS failed FROM orders""",
    "scalar_blank_null": """SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE c_mktsegment END AS slug,
        CASE WHEN c_mktsegment = 'BUILDING' THEN '' ELSE ' ' || c_mktsegment END AS url FROM customer""",
    "scalar_sentinel": "SELECT c_custkey, CASE WHEN c_nationkey <= 0 THEN 2147483647 ELSE c_nationkey END AS docket_id FROM customer",
    "csv_escape": """SELECT page_id, replace(html, '"', '""') AS html_csv FROM pages""",
    "record_diagnostics": """SELECT doc_id, CAST(length(text) AS INTEGER) AS record_length,
        CAST(length(text) - length(replace(text, '"', '')) AS INTEGER) AS quote_count,
        CAST(length(text) - length(replace(text, chr(10), '')) AS INTEGER) AS newline_count FROM documents""",
    "validate_opinion_row": """SELECT o_orderkey,
        NOT (o_orderpriority = '2-HIGH' OR o_orderstatus = 'P') AS valid,
        CASE WHEN o_orderpriority = '2-HIGH' OR o_orderstatus = 'P' THEN 'invalid row (missing id or date_created)' END AS reason
        FROM orders""",
    "validate_column_count": f"""SELECT {LI_ORD_SQL}, l_linenumber AS n_cols,
        CASE WHEN l_linenumber > 5 THEN 'more columns than the header (' || l_linenumber || ' > 5)'
             WHEN l_linenumber < 2 THEN 'invalid row (missing id or date_created)'
             WHEN l_linenumber < 3 THEN 'insufficient columns (expected at least 3, got 2)' END AS reason
        FROM lineitem""",
    "record_diagnostics_mismatch": f"""SELECT {LI_ORD_SQL},
        CAST(length(array_to_string(list_slice([CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR),
            CAST(l_partkey AS VARCHAR), CAST(l_suppkey AS VARCHAR), l_returnflag, l_linestatus,
            CAST(l_orderkey + 1 AS VARCHAR)], 1, l_linenumber), ',')) AS INTEGER) AS record_length,
        0 AS quote_count, 0 AS newline_count, l_linenumber AS column_count
        FROM lineitem WHERE l_linenumber <> 5""",
    "quarantine": f"""SELECT {LI_ORD_SQL},
        CASE WHEN l_linenumber > 5 THEN 'more columns than the header (' || l_linenumber || ' > 5)'
             WHEN l_linenumber < 2 THEN 'invalid row (missing id or date_created)'
             ELSE 'insufficient columns (expected at least 3, got 2)' END AS reason,
        array_to_string(list_slice([CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR), CAST(l_partkey AS VARCHAR),
            CAST(l_suppkey AS VARCHAR), l_returnflag, l_linestatus, CAST(l_orderkey + 1 AS VARCHAR)], 1, l_linenumber), ',') AS raw
        FROM lineitem WHERE l_linenumber NOT IN (3, 4, 5)""",
    "validate_key": f"""SELECT {LI_ORD_SQL},
        CAST(CASE WHEN (l_linestatus = 'O' AND l_returnflag = 'N') OR l_returnflag = 'R' THEN 0
                  ELSE l_orderkey * 8 + l_linenumber END AS INTEGER) AS id,
        CASE WHEN l_linestatus = 'O' AND l_returnflag = 'N' THEN 'missing required key columns'
             WHEN l_returnflag = 'R' THEN 'invalid id=0' END AS reason FROM lineitem""",
    "validate_varchar": """SELECT p_partkey,
        CASE WHEN length(p_name || ' ' || p_name) > 75 OR length(p_type) > 10 THEN 'other' END AS category,
        CASE WHEN length(p_name || ' ' || p_name) > 75 THEN 'value too long for slug (max 75)'
             WHEN length(p_type) > 10 THEN 'value too long for scdb_id (max 10)' END AS reason FROM part""",
    "validate_not_null": """SELECT o_orderkey,
        CASE WHEN o_orderstatus = 'F' THEN 'not_null' WHEN o_orderpriority = '1-URGENT' THEN 'other' END AS category,
        CASE WHEN o_orderstatus = 'F' THEN 'null value in column date_created'
             WHEN o_orderpriority = '1-URGENT' THEN 'invalid ts in date_created' END AS reason FROM orders""",
    "fk_valid": f"SELECT {LI_ORD_SQL} FROM lineitem WHERE l_suppkey IN {SUPP_OK_SQL}",
    "fk_missing": f"SELECT {LI_ORD_SQL} FROM lineitem WHERE l_suppkey NOT IN {SUPP_OK_SQL}",
    "fk_multi": f"""SELECT {LI_ORD_SQL}, concat_ws(',',
        CASE WHEN l_suppkey NOT IN {SUPP_OK_SQL} THEN 'l_suppkey' END,
        CASE WHEN l_partkey NOT IN {PART_BIG_SQL} THEN 'l_partkey' END) AS missing FROM lineitem""",
    "fk_reject": f"""SELECT {LI_ORD_SQL}, 'FK violation: l_suppkey=' || l_suppkey || ' not found in supplier' AS reason
        FROM lineitem WHERE l_suppkey NOT IN {SUPP_OK_SQL}""",
    "placeholder_cluster": f"""SELECT DISTINCT CAST(l_suppkey AS INTEGER) AS id, 'PLACEHOLDER' AS judges,
        'PLACEHOLDER' AS case_name, 'PLACEHOLDER' AS case_name_full, 'R' AS source, 'Unknown' AS precedential_status,
        1 AS docket_id, 0 AS citation_count, false AS blocked, CAST(NULL AS VARCHAR) AS slug,
        '1900-01-01' AS date_filed, '{AS_OF_TXT}' AS date_created
        FROM lineitem WHERE l_suppkey NOT IN {SUPP_OK_SQL}""",
    "placeholder_opinion": f"""SELECT DISTINCT CAST(l_partkey AS INTEGER) AS id, '010' AS type, 'PLACEHOLDER_' || l_partkey AS sha1,
        1 AS cluster_id, '' AS download_url, false AS extracted_by_ocr, CAST(NULL AS INTEGER) AS author_id
        FROM lineitem WHERE l_partkey NOT IN {PART_BIG_SQL}""",
    "placeholder_ids": f"""SELECT DISTINCT 'search_opinioncluster' AS parent, CAST(l_suppkey AS INTEGER) AS id
        FROM lineitem WHERE l_suppkey NOT IN {SUPP_OK_SQL}
        UNION ALL SELECT DISTINCT 'search_opinion', CAST(l_partkey AS INTEGER) FROM lineitem WHERE l_partkey NOT IN {PART_BIG_SQL}""",
    "placeholder_two_fk": f"""SELECT DISTINCT CAST(k AS INTEGER) AS id, 'PLACEHOLDER_' || k AS sha1, 1 AS cluster_id
        FROM (SELECT l_partkey AS k FROM lineitem UNION ALL SELECT l_suppkey FROM lineitem) WHERE k NOT IN {PART_BIG_SQL}""",
    "placeholder_three_fk": f"""
        WITH op AS (SELECT DISTINCT k FROM (SELECT l_partkey AS k FROM lineitem UNION ALL SELECT l_suppkey FROM lineitem)
                    WHERE k NOT IN {PART_BIG_SQL}),
             gr AS (SELECT DISTINCT l_orderkey AS k FROM lineitem WHERE l_orderkey NOT IN {ORDERS_F_SQL}),
             base AS (SELECT 1 AS k WHERE EXISTS (SELECT 1 FROM gr) AND 1 NOT IN {ORDERS_F_SQL})
        SELECT DISTINCT parent, CAST(k AS INTEGER) AS id FROM (
          SELECT 'search_opinion' AS parent, k FROM op
          UNION ALL SELECT 'search_opinion', k FROM base WHERE 1 NOT IN {PART_BIG_SQL}
          UNION ALL SELECT 'search_parentheticalgroup', k FROM gr
          UNION ALL SELECT 'search_parentheticalgroup', k FROM base)""",
    "placeholder_base": f"""
        WITH gr AS (SELECT DISTINCT l_orderkey AS k FROM lineitem WHERE l_orderkey NOT IN {ORDERS_F_SQL}),
             base AS (SELECT 1 AS k WHERE EXISTS (SELECT 1 FROM gr) AND 1 NOT IN {ORDERS_F_SQL}),
             op AS (SELECT DISTINCT k FROM (SELECT l_partkey AS k FROM lineitem UNION ALL SELECT l_suppkey FROM lineitem)
                    WHERE k NOT IN {PART_BIG_SQL})
        SELECT DISTINCT parent, CAST(k AS INTEGER) AS id FROM (
          SELECT 'search_opinion' AS parent, k FROM op WHERE k = 1
          UNION ALL SELECT 'search_opinion', k FROM base WHERE 1 NOT IN {PART_BIG_SQL}
          UNION ALL SELECT 'search_parentheticalgroup', k FROM gr WHERE k = 1
          UNION ALL SELECT 'search_parentheticalgroup', k FROM base)""",
    "placeholder_base_trio": f"""
        WITH op AS (SELECT k FROM (SELECT l_partkey AS k FROM lineitem UNION SELECT l_suppkey FROM lineitem UNION SELECT 1)
                    WHERE k = 1 OR k NOT IN {PART_BIG_SQL}),
             gr AS (SELECT k FROM (SELECT l_orderkey AS k FROM lineitem UNION SELECT 1) WHERE k = 1 OR k NOT IN {ORDERS_F_SQL})
        SELECT 'search_opinion' AS parent, CAST(k AS INTEGER) AS id FROM op
        UNION ALL SELECT 'search_parentheticalgroup', CAST(k AS INTEGER) FROM gr
        UNION ALL SELECT 'search_parenthetical', 1 WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey * 8 + l_linenumber = 1)""",
    "placeholder_chain": f"""
        WITH op AS (SELECT DISTINCT l_orderkey AS k FROM lineitem WHERE l_orderkey NOT IN {ORDERS_F_SQL})
        SELECT parent, CAST(k AS INTEGER) AS id FROM (
          SELECT 'search_opinion' AS parent, k FROM op
          UNION ALL SELECT 'search_opinioncluster', 1 WHERE EXISTS (SELECT 1 FROM op)
          UNION ALL SELECT 'search_docket', 1 WHERE EXISTS (SELECT 1 FROM op))""",
    "upsert_ignore": f"SELECT id, l_partkey, l_suppkey, l_quantity FROM ({_LI_FIRST_OK}) WHERE rn = 1",
    "upsert_ignore_status": f"""
        WITH r AS (SELECT l_orderkey * 8 + l_linenumber AS ob, l_partkey * 1048576 + l_suppkey + 1 AS om, l_suppkey,
                          l_suppkey IN {SUPP_OK_SQL} AS ok,
                          row_number() OVER (PARTITION BY l_orderkey * 8 + l_linenumber
                                             ORDER BY l_partkey, l_suppkey, l_extendedprice, l_quantity) AS rk
                   FROM lineitem),
             w AS (SELECT *, min(CASE WHEN ok THEN rk END) OVER (PARTITION BY ob) AS win FROM r)
        SELECT ob, om,
          CASE WHEN win IS NULL OR rk < win THEN 'rejected' WHEN rk = win THEN 'inserted' ELSE 'duplicate_noop' END AS status,
          CASE WHEN win IS NULL OR rk < win THEN 'FK violation: l_suppkey=' || l_suppkey || ' not found in supplier' END AS reason
        FROM w""",
    "upsert_partial": f"""
        WITH f AS (SELECT id, l_partkey, l_suppkey FROM ({_LI_FIRST_OK}) WHERE rn = 1),
             l AS (SELECT l_orderkey * 8 + l_linenumber AS id, l_quantity,
                          row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey DESC, l_suppkey DESC, l_extendedprice DESC, l_quantity DESC) AS rn
                   FROM lineitem)
        SELECT f.id, f.l_partkey, f.l_suppkey, l.l_quantity FROM f JOIN l ON f.id = l.id AND l.rn = 1""",
    "upsert_last": f"""SELECT id, l_partkey, l_suppkey, l_quantity FROM (
        SELECT l_orderkey * 8 + l_linenumber AS id, l_partkey, l_suppkey, l_quantity,
               row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey DESC, l_suppkey DESC, l_extendedprice DESC, l_quantity DESC) AS rn
        FROM lineitem WHERE l_suppkey IN {SUPP_OK_SQL}) WHERE rn = 1""",
    "upsert_natural_key": """SELECT id, l_orderkey, l_linenumber, type FROM (
        SELECT l_orderkey * 8 + l_linenumber AS id, l_orderkey, l_linenumber, l_suppkey AS type,
               row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey DESC, l_suppkey DESC, l_extendedprice DESC, l_quantity DESC) AS rn
        FROM lineitem) WHERE rn = 1""",
    "upsert_natural_key4": f"""SELECT id, l_orderkey, l_linenumber, l_returnflag, l_linestatus, type FROM (
        SELECT (l_orderkey * 8 + l_linenumber) * 6 + {_NAT_CODE} AS id, l_orderkey, l_linenumber, l_returnflag, l_linestatus,
               l_suppkey AS type,
               row_number() OVER (PARTITION BY l_orderkey, l_linenumber, l_returnflag, l_linestatus
                                  ORDER BY l_partkey DESC, l_suppkey DESC, l_extendedprice DESC, l_quantity DESC) AS rn
        FROM lineitem) WHERE rn = 1""",
    "upsert_natural_claims": """
        WITH r AS (SELECT l_orderkey, l_linenumber, l_suppkey,
                          row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                                             ORDER BY l_partkey DESC, l_suppkey DESC, l_extendedprice DESC, l_quantity DESC) AS rn,
                          min(l_linenumber) OVER (PARTITION BY l_orderkey) AS first_line
                   FROM lineitem)
        SELECT l_orderkey AS id, l_orderkey, l_linenumber, l_suppkey AS type FROM r WHERE rn = 1 AND l_linenumber = first_line""",
    "upsert_natural_moves": """
        WITH r AS (SELECT l_orderkey, l_linenumber, l_suppkey,
                          row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                                             ORDER BY l_partkey, l_suppkey, l_extendedprice, l_quantity) AS rn,
                          count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS n
                   FROM lineitem)
        SELECT (l_orderkey * 8 + l_linenumber) * 64 + rn AS id, l_orderkey, l_linenumber, l_suppkey AS type FROM r WHERE rn = n""",
    # the rows of an id follow one another, so it stays with the first row's key; among the rows let in, a key's last one stands
    "upsert_natural_dirty": """
        WITH r AS (SELECT *, first_value(l_partkey) OVER w AS p1, first_value(l_suppkey) OVER w AS s1 FROM lineitem
                   WINDOW w AS (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey)),
        q AS (SELECT l_orderkey * 8 + l_linenumber AS id, l_partkey, l_suppkey,
                     row_number() OVER (PARTITION BY l_partkey, l_suppkey ORDER BY l_orderkey DESC, l_linenumber DESC) AS rn
              FROM r WHERE l_partkey = p1 AND l_suppkey = s1)
        SELECT id, l_partkey, l_suppkey, l_suppkey AS type FROM q WHERE rn = 1""",
    "upsert_natural_contested": f"""WITH RECURSIVE {_CONTESTED_SQL}
        SELECT x.id AS id, l_orderkey, x.k AS k, x.type AS type FROM (SELECT l_orderkey, unnest(held) AS x FROM last)""",
    "upsert_natural_contested_status": f"""WITH RECURSIVE {_CONTESTED_SQL}
        SELECT l_orderkey, status, count(*) AS n FROM step WHERE nth > 0 GROUP BY ALL""",
    "load_report": f"""SELECT CAST(floor(pos / 5000) AS BIGINT) AS batch, {_COUNTS_SQL},
        min(pos) AS first_pos, max(pos) AS last_pos FROM ({_PANEL_OUTCOMES}) GROUP BY 1""",
    "load_totals": f"SELECT {_COUNTS_SQL} FROM ({_PANEL_OUTCOMES})",
    "failure_categories": f"""SELECT category, count(*) AS n FROM ({_PANEL_OUTCOMES}) WHERE status = 'rejected' GROUP BY 1""",
    "sample_failures": f"""SELECT batch, pos, reason FROM (
        SELECT CAST(floor(pos / 5000) AS BIGINT) AS batch, pos, reason,
               row_number() OVER (PARTITION BY floor(pos / 5000) ORDER BY pos) AS rn
        FROM ({_PANEL_OUTCOMES}) WHERE status = 'rejected') WHERE rn <= 5""",
    "first_bad_records": f"""SELECT ob AS _ob, om AS _om, reason FROM ({_PANEL_OUTCOMES})
        WHERE status = 'rejected' ORDER BY ob, om LIMIT 10""",
    "bad_records": f"""SELECT CASE WHEN category = 'parse' THEN '0' ELSE CAST(l_orderkey * 8 + l_linenumber AS VARCHAR) END AS id,
        CAST(l_orderkey AS VARCHAR) AS opinioncluster_id, CAST(l_linenumber AS VARCHAR) AS person_id, reason
        FROM ({_PANEL_OUTCOMES}) WHERE status = 'rejected'""",
    "bad_records_raw": f"""SELECT reason,
        (CASE WHEN category = 'parse' THEN '0' ELSE CAST(l_orderkey * 8 + l_linenumber AS VARCHAR) END)
          || ',' || l_orderkey || ',' || l_linenumber AS raw_record
        FROM ({_PANEL_OUTCOMES}) WHERE status = 'rejected' AND category = 'parse'""",
    "load_opinions": """SELECT doc_id AS id, lang AS type, source AS sha1, text AS plain_text, doc_id AS cluster_id,
        n_chars > 1000 AS extracted_by_ocr, CAST(n_chars AS INTEGER) AS page_count, '' AS download_url,
        CAST(NULL AS INTEGER) AS author_id FROM documents""",
    "load_opinions_placeholders": f"""SELECT doc_id AS id, 'NA' AS case_name, 'NA' AS source, 'Unknown' AS precedential_status,
        2147483647 AS docket_id, '{AS_OF.date().isoformat()}' AS date_filed
        FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)""",
    "load_clusters": """SELECT c_custkey AS id, c_name AS judges, 'In re ' || c_name || ',' || chr(10) || 'appeal' AS case_name,
        c_mktsegment AS slug, CASE WHEN c_nationkey <= 0 THEN 2147483647 ELSE c_nationkey END AS docket_id,
        CAST(trunc(c_acctbal) AS INTEGER) AS citation_count, c_acctbal < 0 AS blocked,
        '19' || lpad(CAST(c_custkey % 100 AS VARCHAR), 2, '0') || '-06-15' AS date_filed
        FROM customer WHERE c_custkey > 0""",
    "load_panels": """SELECT DISTINCT CAST(l_orderkey * 8 + l_linenumber AS INTEGER) AS id, CAST(l_orderkey AS INTEGER) AS opinioncluster_id,
        CAST(l_linenumber AS INTEGER) AS person_id FROM lineitem WHERE NOT (l_returnflag = 'R' AND l_linestatus = 'F')""",
    "load_panels_placeholders": f"""SELECT DISTINCT CAST(l_orderkey AS INTEGER) AS id, 'PLACEHOLDER' AS judges, 'R' AS source, 1 AS docket_id
        FROM lineitem WHERE NOT (l_returnflag = 'R' AND l_linestatus = 'F') AND l_orderkey NOT IN {ORDERS_F_SQL}""",
    "load_joined_by": """SELECT DISTINCT CAST(l_orderkey * 8 + l_linenumber AS INTEGER) AS id, CAST(l_orderkey AS INTEGER) AS opinion_id,
        CAST(l_linenumber AS INTEGER) AS person_id FROM lineitem WHERE l_orderkey * 8 + l_linenumber <> 0""",
    "load_citation_map": """
        WITH r AS (SELECT l_orderkey * 8 + l_linenumber AS id, CAST(l_quantity AS INTEGER) AS depth, l_partkey, l_suppkey,
                          row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey, l_extendedprice, l_quantity) AS rf,
                          row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                                             ORDER BY l_partkey DESC, l_suppkey DESC, l_extendedprice DESC, l_quantity DESC) AS rl
                   FROM lineitem WHERE l_orderkey * 8 + l_linenumber <> 0)
        SELECT CAST(f.id AS INTEGER) AS id, l.depth, CAST(f.l_partkey AS INTEGER) AS cited_opinion_id,
               CAST(f.l_suppkey AS INTEGER) AS citing_opinion_id
        FROM r f JOIN r l ON f.id = l.id AND f.rf = 1 AND l.rl = 1""",
    "load_reporter_citations": f"""SELECT CAST(id AS INTEGER) AS id, CAST(volume AS INTEGER) AS volume, reporter, page,
        CAST(type AS INTEGER) AS type, CAST(cluster_id AS INTEGER) AS cluster_id FROM (
        SELECT (l_orderkey * 8 + l_linenumber) * 6 + {_NAT_CODE} AS id, l_linenumber AS volume, l_returnflag AS reporter,
               l_linestatus AS page, l_suppkey AS type, l_orderkey AS cluster_id,
               row_number() OVER (PARTITION BY l_orderkey, l_linenumber, l_returnflag, l_linestatus
                                  ORDER BY l_partkey DESC, l_suppkey DESC, l_extendedprice DESC, l_quantity DESC) AS rn
        FROM lineitem WHERE (l_orderkey * 8 + l_linenumber) * 6 + {_NAT_CODE} <> 0) WHERE rn = 1""",
    "load_parentheticals": f"""
        WITH r AS ({_PAREN_SQL_ROWS}),
             gr AS (SELECT 1 AS x FROM lineitem WHERE l_orderkey NOT IN {ORDERS_F_SQL} LIMIT 1)
        SELECT CAST(id AS INTEGER) AS id, text, score, described_opinion_id, describing_opinion_id, group_id FROM r WHERE rn = 1
        UNION ALL
        SELECT 1, 'PLACEHOLDER', 0.0, 1, 1, 1
        WHERE EXISTS (SELECT 1 FROM gr) AND 1 NOT IN {ORDERS_F_SQL} AND NOT EXISTS (SELECT 1 FROM r WHERE id = 1)""",
}
ORACLES["load_all_tables"] = """
  WITH li AS (SELECT *, l_orderkey * 8 + l_linenumber AS ob FROM lineitem),
  ids("table", id) AS (
    SELECT 'search_docket', CASE WHEN n_nationkey > 0 THEN n_nationkey ELSE 2147483647 END FROM nation
    UNION SELECT 'search_opinioncluster', unnest([c_custkey]) FROM customer UNION SELECT 'search_opinioncluster', doc_id FROM documents
    UNION SELECT 'search_opinioncluster', l_orderkey FROM li
    UNION SELECT 'search_opinion', doc_id FROM documents UNION SELECT 'search_opinion', unnest([l_orderkey, l_partkey, l_suppkey, 1]) FROM li
    UNION SELECT 'search_parentheticalgroup', unnest([l_orderkey, 1]) FROM li
    UNION SELECT 'search_parenthetical', unnest([ob, 1]) FROM li UNION SELECT 'search_opinionscited', ob FROM li
    UNION SELECT 'search_opinion_joined_by', ob FROM li
    UNION SELECT 'search_opinioncluster_panel', ob FROM li WHERE NOT (l_returnflag = 'R' AND l_linestatus = 'F')
    UNION SELECT 'search_citation', ob * 6 + (position(l_returnflag IN 'ARN') - 1) * 2 + (l_linestatus = 'O')::INT FROM li)
  SELECT "table", count(*) AS rows, sum(id)::BIGINT AS id_sum, 0::BIGINT AS orphans FROM ids GROUP BY 1"""
_PANEL_REPAIRS = f"""
  SELECT row_number() OVER (ORDER BY ob, om) - 1 AS pos, l_orderkey, bad, NOT bad AND l_orderkey NOT IN {ORDERS_F_SQL} AS lacks,
    NOT bad AND row_number() OVER (PARTITION BY l_orderkey, l_linenumber, bad ORDER BY om) = 1 AS first
  FROM (SELECT l_orderkey, l_linenumber, l_orderkey * 8 + l_linenumber AS ob, l_returnflag = 'R' AND l_linestatus = 'F' AS bad,
    row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey, l_extendedprice, l_quantity) AS om FROM lineitem)"""
ORACLES["load_report_placeholders"] = f"""
  WITH r AS ({_PANEL_REPAIRS}), m AS (SELECT min(pos) // 5000 AS batch FROM r WHERE lacks GROUP BY l_orderkey)
  SELECT b.batch, attempted, rejected, coalesce(n, 0) AS placeholders
  FROM (SELECT pos // 5000 AS batch, count(*) AS attempted, count(*) FILTER (bad) AS rejected FROM r GROUP BY 1) b
  LEFT JOIN (SELECT batch, count(*) AS n FROM m GROUP BY 1) c ON b.batch = c.batch"""
ORACLES["load_totals_placeholders"] = f"""
  SELECT count(*) AS attempted, count(*) FILTER (first) AS inserted, count(*) FILTER (NOT bad AND NOT first) AS updated,
    count(*) FILTER (bad) AS rejected, count(DISTINCT l_orderkey) FILTER (lacks) AS placeholders FROM ({_PANEL_REPAIRS})"""
ORACLES["stream_equals_batch"] = ORACLES["load_panels"]
ORACLES["load_panels_written"] = ORACLES["load_panels"]
ORACLES["placeholder_ids_csv"] = ORACLES["placeholder_chain"]

QUERIES: dict[str, Query] = {
    "assemble_parity": assemble_parity,
    "assemble_parity_pattern": assemble_parity_pattern,
    "assemble_pattern_id_ts": assemble_pattern_id_ts,
    "assemble_skip3_date": assemble_skip3_date,
    "assemble_resync": assemble_resync,
    "scan_single_line": scan_single_line,
    "scan_header_order": scan_header_order,
    "preview_limit": preview_limit,
    "split_lenient": split_lenient_q,
    "split_toggle": split_toggle_q,
    "split_escape_all": split_escape_all_q,
    "scalar_trim": scalar_trim,
    "scalar_bool": scalar_bool,
    "scalar_int_prefix": scalar_int_prefix,
    "scalar_int_wrap": scalar_int_wrap,
    "scalar_double_prefix": scalar_double_prefix,
    "scalar_score6": scalar_score6,
    "scalar_ts_cast": scalar_ts_cast,
    "scalar_blank_null": scalar_blank_null,
    "scalar_sentinel": scalar_sentinel,
    "csv_escape": csv_escape_q,
    "record_diagnostics": record_diagnostics_q,
    "validate_opinion_row": validate_opinion_row,
    "validate_column_count": validate_column_count,
    "validate_key": validate_key,
    "validate_varchar": validate_varchar,
    "validate_not_null": validate_not_null,
    "quarantine": quarantine,
    "record_diagnostics_mismatch": record_diagnostics_mismatch,
    "fk_valid": fk_valid_q,
    "fk_missing": fk_missing_q,
    "fk_multi": fk_multi,
    "fk_reject": fk_reject,
    "placeholder_cluster": placeholder_cluster,
    "placeholder_opinion": placeholder_opinion,
    "placeholder_ids": placeholder_ids,
    "placeholder_two_fk": placeholder_two_fk,
    "placeholder_three_fk": placeholder_three_fk,
    "placeholder_base": placeholder_base,
    "placeholder_base_trio": placeholder_base_trio,
    "placeholder_chain": placeholder_chain,
    "placeholder_ids_csv": placeholder_ids_csv,
    "upsert_ignore": upsert_ignore_q,
    "upsert_ignore_status": upsert_ignore_status,
    "upsert_partial": upsert_partial_q,
    "upsert_last": upsert_last_q,
    "upsert_natural_key": upsert_natural_key,
    "upsert_natural_key4": upsert_natural_key4,
    "upsert_natural_dirty": upsert_natural_dirty,
    "upsert_natural_claims": upsert_natural_claims,
    "upsert_natural_moves": upsert_natural_moves,
    "upsert_natural_contested": upsert_natural_contested,
    "upsert_natural_contested_status": upsert_natural_contested_status,
    "load_report": load_report,
    "load_totals": load_totals,
    "load_report_placeholders": load_report_placeholders,
    "load_totals_placeholders": load_totals_placeholders,
    "failure_categories": failure_categories_q,
    "sample_failures": sample_failures_q,
    "first_bad_records": first_bad_records_q,
    "bad_records": bad_records,
    "bad_records_raw": bad_records_raw_q,
    "load_opinions": load_opinions,
    "load_opinions_placeholders": load_opinions_placeholders,
    "load_clusters": load_clusters,
    "load_panels": load_panels,
    "load_panels_written": load_panels_written,
    "load_panels_placeholders": load_panels_placeholders,
    "load_joined_by": load_joined_by,
    "load_citation_map": load_citation_map,
    "load_reporter_citations": load_reporter_citations,
    "load_parentheticals": load_parentheticals,
    "load_all_tables": load_all_tables,
    "stream_equals_batch": stream_equals_batch,
}


def fk_reject_flagship(spark, sf):
    """The flagship: a panel dump derived from lineitem, loaded in reject mode; the rejected rows."""
    r = _panel_reject_load(spark, sf)
    return r.rejects.select("id", "opinioncluster_id", "person_id", "reason", "category")
