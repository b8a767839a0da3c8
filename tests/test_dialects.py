import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from relload.functions import dialects as D

ALPHA = ['a', 'b', '"', ',', '\\', '\n', ' ']


def _split_all(spark, lines):
    df = spark.createDataFrame([(i, s) for i, s in enumerate(lines)], "i int, s string")
    rows = df.select(
        "i",
        D.split_lenient(F.col("s")).alias("l"),
        D.split_toggle(F.col("s")).alias("t"),
        D.split_escape_all(F.col("s")).alias("e"),
    ).collect()
    return {r.i: (list(r.l), list(r.t), list(r.e)) for r in rows}


def test_reference_unit_cases(spark):
    got = _split_all(spark, ['a,"b,c",d', 'a,"b""c",d'])
    assert got[0][0] == ["a", "b,c", "d"]  # quoted comma
    assert got[1][0] == ["a", 'b"c', "d"]  # doubled quote


def test_bare_inner_quotes_and_escapes(spark):
    lines = ['1,"he said "hi" there",2', 'p"q,r"s', '\\"x,y', 'a\\,b,c\\', '"ab""']
    got = _split_all(spark, lines)
    assert got[0][0] == ["1", 'he said "hi" there', "2"]  # L keeps bare inner quotes
    assert got[0][1] == ["1", "he said hi there", "2"]  # T toggles on them
    assert got[1][0] == ['pq,r"s'] and got[1][1] == ["pq,rs"]  # a quote opens mid-field; L never closes it before s
    assert got[2][0] == ['"x', "y"] and got[2][1] == ['"x', "y"]
    assert got[3][2] == ["a,b", "c"]  # E: \, is a literal comma, trailing \ dropped
    assert got[4] == (['ab"'], ['ab"'], ['ab"'])


def write_field(rnd, field, dialect):
    """One of the ways to write ``field`` in a dialect."""
    quoted = any(c in field for c in '",') and dialect != "E" or rnd.random() < 0.5
    out = []
    for c, following in zip(field, [*field[1:], ""]):
        if c == '"':
            ways = ['\\"'] + ['""'] * quoted
            if quoted and dialect == "L" and following in ("a", "b", " "):
                ways.append('"')  # bare inside quotes
            out.append(rnd.choice(ways))
        elif dialect == "E" and (c == "\\" or c == "," and not quoted or rnd.random() < 0.1):
            out.append("\\" + c)
        else:
            out.append(c)
    body = "".join(out)
    return f'"{body}"' if quoted else body


def test_written_fields_come_back(spark):
    rnd = random.Random(7)
    for n, dialect in enumerate("LTE"):
        chars = ["a", "b", '"', ",", "\n", " ", *D.RESERVED, "0"] + (["\\"] if dialect == "E" else [])
        want = [["".join(rnd.choice(chars) for _ in range(rnd.randint(0, 9))) for _ in range(rnd.randint(1, 5))] for _ in range(2000)]
        got = _split_all(spark, [",".join(write_field(rnd, f, dialect) for f in fields) for fields in want])
        for i, fields in enumerate(want):
            assert got[i][n] == fields


@settings(max_examples=15, deadline=None)
@given(st.lists(st.lists(st.text(alphabet=ALPHA, max_size=12), min_size=1, max_size=6), min_size=1, max_size=30), st.randoms(use_true_random=False))
def test_property_escaped_fields(spark, want, rnd):
    got = _split_all(spark, [",".join(write_field(rnd, f, "E") for f in fields) for fields in want])
    assert [got[i][2] for i in range(len(want))] == want


def test_megabyte_field_with_many_quotes(spark):
    big = '"' + ('ab""' * 60000) + '"'
    df = spark.createDataFrame([(big + ",x",)], "s string")
    r = df.select(D.split_lenient(F.col("s")).alias("l"), D.split_toggle(F.col("s")).alias("t")).collect()[0]
    assert r.l[0] == 'ab"' * 60000 and r.l[1] == "x"
    assert r.t[0] == 'ab"' * 60000


def test_lines_with_and_without_quotes_split_alike(spark):
    rnd = random.Random(11)
    alphabet = ['a', '"', ',', '\\', '\n', 'é', '𝒳', *D.RESERVED, "0", "3"]
    lines = ["".join(rnd.choices(alphabet if i % 2 else [c for c in alphabet if c != '"'], k=rnd.randrange(12))) for i in range(600)]

    def fields(line):  # dialect E, character by character
        out, cur, quoted, i = [], "", False, 0
        while i < len(line):
            c = line[i]
            if c == "\\":
                cur += line[i + 1 : i + 2]
                i += 1
            elif c == '"' and quoted and line[i + 1 : i + 2] == '"':
                cur += c
                i += 1
            elif c == '"':
                quoted = not quoted
            elif c == "," and not quoted:
                out, cur = [*out, cur], ""
            else:
                cur += c
            i += 1
        return [*out, cur]

    got = _split_all(spark, lines)
    assert [got[i][2] for i in range(len(lines))] == [fields(x) for x in lines]
    plan = spark.createDataFrame([("a",)], "s string").select(D.split_escape_all(F.col("s")))._jdf.queryExecution().optimizedPlan().toString()
    assert "translate" not in plan and plan.count("regexp_replace") == 0  # a field costs no pass over its characters but plain replacements
