"""Rows that demand placeholder parents are told by the conflict rule itself, without a join by place in the dump."""

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from relload import PARENTHETICAL, load
from relload.functions.scalars import _six_digits
from relload.operators.upsert import upsert_ignore, upsert_last, upsert_partial
from relload.plans.jobs import _demand
from relload.specs import CITED, CLUSTER


@pytest.mark.parametrize("held", [False, True])
@pytest.mark.parametrize("rule", ["ignore", "partial", "last"])
def test_reached_rows_are_those_of_the_status(spark, rule, held):
    rows = [(i, i * 7 % 11, i % 3 > 0, i * 10) for i in range(60)]
    rows = spark.createDataFrame(rows, "_ord long, id int, _ok boolean, depth int").withColumn("_fkr", F.when(~F.col("_ok"), F.lit("fk")))
    existing = spark.createDataFrame([(3, 1), (99, 2)], "id int, depth int") if held else None
    cols = ["id", "depth"]
    spec, up = {
        "ignore": (CLUSTER, lambda: upsert_ignore(rows, existing, cols)),
        "partial": (CITED, lambda: upsert_partial(rows, existing, cols, ["depth"])),
        "last": (PARENTHETICAL, lambda: upsert_last(rows, existing, cols)),
    }[rule]
    assert spec.upsert == rule
    up = up()
    reached = sorted(r["_ord"] for r in up.reached.select("_ord").collect())
    assert reached == sorted(r["_ord"] for r in _demand(rows, up.status, spec).select("_ord").collect())
    assert 0 < len(reached) <= 60


def test_placeholders_of_a_load_move_no_rows_by_their_place(spark, tmp_path):
    lines = [f"{i % 40},t,{i}.5,{i % 9},{i % 7},{i % 5}" for i in range(1, 200)]
    (tmp_path / "d.csv").write_text("\n".join(["id,text,score,described_opinion_id,describing_opinion_id,group_id", *lines]))
    few = spark.createDataFrame([(2,), (4,)], "id int")
    r = load(spark, PARENTHETICAL, str(tmp_path), parents={"search_opinion": few, "search_parentheticalgroup": few, "search_opinioncluster": spark.range(3)})
    plans = [df._jdf.queryExecution().optimizedPlan().toString() for df in r.placeholders.values()]
    assert plans and not any(re.search(r"Join.*_ord#", p) for p in plans)
    got = {(x["parent"], x["id"]) for x in r.placeholder_ids.collect()}
    assert got == {("search_opinion", k) for k in (0, 1, 3, 5, 6, 7, 8)} | {("search_parentheticalgroup", k) for k in (0, 1, 3)}
    r.release()


def test_six_digits_equal_the_printed_value():
    r = np.random.default_rng(5)
    v = np.concatenate([
        (r.random(20_000) - 0.5) * 10.0 ** r.integers(-20, 25, 20_000),
        np.round(r.random(20_000) * 1e5, 2) / r.integers(1, 51, 20_000),
        r.integers(0, 10**8, 20_000) / 16,  # exact halves
        [0.0, -0.0, np.nan, np.inf, -np.inf, 12345.65, 999999.5, 99999.95, 9.999995, 1e-12, 1e18, 5e-324, 1.7e308],
    ])
    want = np.char.mod("%.6g", v).astype("float64")
    assert np.array_equal(_six_digits(v).view("int64"), want.view("int64"))
