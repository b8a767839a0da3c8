import os
import random

import pytest
from pyspark.sql import functions as F

from dump_files import write
from relload.sources.assemble import read_dump


def _text_field(rnd, dated=True):
    """A field of body lines; the skip-3 rule alone may start a record at a dated one, so its dumps have none."""
    parts = []
    for _ in range(rnd.randint(1, 6)):
        w = rnd.choice(["alpha", "beta gamma", 'say ""hi""', "x,y", "12,2013-01-01" if dated else "12", "  ", "\\", "q"])
        parts.append(w)
    if parts[-1] == "\\":  # a backslash would take the closing quote
        parts.append("q")
    return '"' + "\n".join(parts) + '"' if rnd.random() < 0.7 else "plain"


def make_dump(rnd, n, cluster_like=False):
    if cluster_like:
        lines = ["id,date_created,date_modified,judges,date_filed,text"]
    else:
        lines = ["id,date_created,text"]
    for i in range(1, n + 1):
        ts = f"2020-01-{(i % 28) + 1:02d} 10:00:00"
        if cluster_like:
            judges = '"Judge\nA, B"' if rnd.random() < 0.3 else "J"
            lines.append(f"{i},{ts},{ts},{judges},1999-01-01,{_text_field(rnd, dated=False)}")
        else:
            lines.append(f"{i},{ts},{_text_field(rnd)}")
    return lines[1:], "\n".join(lines) + ("\n" if rnd.random() < 0.5 else "")


@pytest.mark.parametrize("mode", ["parity", "parity_pattern", "resync", "skip3"])
def test_written_records_come_back_across_tiny_splits(spark, tmpdir_path, mode):
    rnd = random.Random(mode)
    texts = []
    for f in range(2):
        records, t = make_dump(rnd, 300, cluster_like=(mode == "skip3"))
        texts.append(records)
        write(os.path.join(tmpdir_path, f"part-{f}.csv"), t)
    expected = []
    for f, records in enumerate(texts):
        expected += [(os.path.join(tmpdir_path, f"part-{f}.csv"), r) for r in records]
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("2048", "134217728"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            dump = read_dump(spark, tmpdir_path, mode)
            got = sorted((r._p.replace("file:", ""), r._ob, r.raw) for r in dump.records.collect())
            assert [(p, raw) for p, _, raw in got] == sorted(expected, key=lambda x: x) or sorted(
                (p, raw) for p, _, raw in got
            ) == sorted(expected)
            # records are numbered densely in file order
            by_file = {}
            for p, ob, raw in got:
                by_file.setdefault(p, []).append(ob)
            hdrs = {r._p.replace("file:", ""): r.header for r in dump.headers.collect()}
            assert all(h.startswith("id,") for h in hdrs.values()) and len(hdrs) == 2
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_pattern_mode_splits_on_body_lines_like_the_original(spark, tmpdir_path):
    text = 'id,date_created,text\n1,2020-01-01,"a\n12,2013-01-01 inside"\n2,2020-01-02,b  \n'
    write(os.path.join(tmpdir_path, "d.csv"), text)
    dump = read_dump(spark, tmpdir_path, "pattern")
    got = [r.raw for r in dump.records.orderBy("_ob").collect()]
    assert got == ['1,2020-01-01,"a', '12,2013-01-01 inside"', "2,2020-01-02,b"]  # blanks at a record's end go
    assert len(got) == 3  # the body line looks like a record start (open issue kept from the original)


def test_single_line_skips_blank_lines_and_keeps_cr(spark, tmpdir_path):
    text = "id,opinioncluster_id,person_id\r\n1,100,200\r\n\n   \n2,101,201"
    write(os.path.join(tmpdir_path, "p.csv"), text)
    dump = read_dump(spark, tmpdir_path, "single")
    got = [r.raw for r in dump.records.orderBy("_ob", "_om").collect()]
    assert got == ["1,100,200\r", "2,101,201"]
    assert dump.headers.collect()[0].header == "id,opinioncluster_id,person_id\r"


def test_crlf_header_names_are_trimmed(spark, tmpdir_path):
    from relload import PANEL, load

    write(os.path.join(tmpdir_path, "p.csv"), "person_id , id,opinioncluster_id\r\n200,1,100\r\n")
    r = load(spark, PANEL, tmpdir_path)
    assert [tuple(x) for x in r.target.collect()] == [(1, 100, 200)]


def test_skip3_fields_spanning_many_lines(spark, tmpdir_path):
    long_judges = '"' + "\n".join(f"judge {i}, jr." for i in range(50)) + '"'
    many_quotes = '"' + '""' * 100000 + '"'
    text = (
        "id,date_created,date_modified,judges,date_filed,text\n"
        f"1,2020-01-01,2020-01-02,{long_judges},1999-01-01,a\n"
        f"2,2020-01-01,2020-01-02,J,1999-01-01,{many_quotes}\n"
        '3,"x\n'  # a candidate whose quote never closes: not a start, joins record 2
        "4,2020-01-01,2020-01-02,J,1999-01-01,b\n"
    )
    write(os.path.join(tmpdir_path, "c.csv"), text)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "1024")
        dump = read_dump(spark, tmpdir_path, "skip3")
        got = [r.raw for r in dump.records.orderBy("_ob").collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == [
        f"1,2020-01-01,2020-01-02,{long_judges},1999-01-01,a",
        f'2,2020-01-01,2020-01-02,J,1999-01-01,{many_quotes}\n3,"x',
        "4,2020-01-01,2020-01-02,J,1999-01-01,b",
    ]
    assert [g.split(",", 1)[0] for g in got] == ["1", "2", "4"]  # "3,\"x" never closes its quote


@pytest.mark.parametrize("size", ["700", "134217728"])
def test_resync_keeps_body_lines_and_confines_stray_quotes(spark, tmpdir_path, size):
    rnd = random.Random("resync")
    records = []
    for i in range(1, 200):
        ts = f"2020-01-{(i % 28) + 1:02d} 10:00:00"
        stray = '"x" and "y' if i % 23 == 2 else "plain"  # one quote too many: it stays in its own record
        body = _text_field(rnd)
        if i % 7 == 0:  # a body that quotes a whole record
            body = f'"see\n{i},2013-01-01,a,b,5,6,7,8\n{i},2013-01-02,c,d\nend"'
        # the harmed record has no dated body line (there it may be cut), and the next reads as one by itself
        if i % 23 in (2, 3):
            body = "short"
        records.append(f"{i},{ts},{stray},{body},5,6,7,8")
    text = "id,date_created,note,text,e,f,g,h\n" + "\n".join(records) + "\n"
    write(os.path.join(tmpdir_path, "d.csv"), text)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        got = [r.raw for r in read_dump(spark, tmpdir_path, "resync").records.orderBy("_ob").collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == records


@pytest.mark.parametrize("mode", ["parity", "pattern", "parity_pattern", "resync", "skip3"])
def test_the_text_of_lines_is_not_shuffled(spark, tmpdir_path, mode, monkeypatch):
    from relload.sources import assemble

    _, text = make_dump(random.Random(1), 60, cluster_like=mode == "skip3")
    write(os.path.join(tmpdir_path, "d.csv"), text)
    monkeypatch.setattr(assemble, "cached", lambda df: df)  # the plan as one piece
    records = read_dump(spark, tmpdir_path, mode).records
    plan = records._jdf.queryExecution().explainString(records._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    nodes = plan.split("\n\n")
    exchanges = [n for n in nodes if " Exchange\n" in n]
    assert exchanges and not any("value#" in n for n in exchanges)
    assert any("MapInArrow" in n and "value#" in n for n in nodes)


@pytest.mark.parametrize("size", ["40", "134217728"])
def test_a_header_alone_in_its_split_and_files_of_one_line(spark, tmpdir_path, size):
    head = "id,date_created,date_modified,judges,date_filed,text"
    write(os.path.join(tmpdir_path, "a.csv"), head + "\nnot,like,a,record,start,x\n7,2020-01-01,2020-01-02,J,1999-01-01,b\n")
    write(os.path.join(tmpdir_path, "b.csv"), head)
    write(os.path.join(tmpdir_path, "c.csv"), head + "\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        for mode in ("parity", "parity_pattern", "resync", "skip3"):
            dump = read_dump(spark, tmpdir_path, mode)
            got = [(r.line_no, r.raw) for r in dump.records.orderBy("_p", "_ob").collect()]
            assert got == [(2, "not,like,a,record,start,x"), (3, "7,2020-01-01,2020-01-02,J,1999-01-01,b")], mode
            assert sorted(r.header for r in dump.headers.collect()) == [head] * 3
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_cutting_holds_no_more_than_the_open_record():
    """A split of many batches: the rules that look back keep the open record, and the ends of a split are told as before."""
    import weakref

    import pyarrow as pa
    from relload.sources import cut

    alive = []

    def lines():
        for i in range(50):
            value = [f'{i * 100 + j},2020-01-01,"a' if j % 2 == 0 else 'b"' for j in range(100)]
            batch = pa.RecordBatch.from_pydict({
                "value": value, "_s": pa.array([7] * 100, pa.int64()), "q": pa.array([1] * 100, pa.int32()), "cand": [j % 2 == 0 for j in range(100)],
                "_n0": pa.array([1000] * 100, pa.int64()), "_q0": pa.array([0] * 100, pa.int64()), "_last": [False] * 100,
                "_p": ["file"] * 100, "_b": pa.array([0] * 100, pa.int64()), "_m": pa.array(range(i * 100, i * 100 + 100), pa.int64()),
            })
            alive.append(weakref.ref(batch))
            held.append(sum(r() is not None for r in alive))
            yield batch

    for mode in ("parity", "pattern", "parity_pattern"):
        held, got = [], []
        for out in cut.records(mode)(lines()):
            got += out.to_pylist()
        assert max(held) <= 3
        assert [r["line_no"] for r in got] == list(range(1001, 6001, 2))
        assert [r["raw"] for r in got[:2]] == ['0,2020-01-01,"a\nb"', '2,2020-01-01,"a\nb"']
        assert [r["edge"] for r in got] == [None] * 2499 + [True]
    held = []
    (row,) = [r for b in cut.sizes(lines()) for r in b.to_pylist()]
    assert max(held) <= 3 and row == {"_p": "file", "_b": 0, "n": 5000, "_m0": 0, "header": '0,2020-01-01,"a'}
