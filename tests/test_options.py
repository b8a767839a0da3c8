"""Options of ``load``: previews, parse-only runs, rejects as files, batches; empty files."""

import os

import pytest

from dump_files import write
from relload import CITED, OPINION, PANEL, load
from relload.sources.assemble import read_first, read_head

PANELS = "id,opinioncluster_id,person_id\n"


def _leaf_rows(df):
    plan = df._jdf.queryExecution().executedPlan()
    while plan.children().size():
        plan = plan.children().head()
    return plan.metrics().apply("numOutputRows").value()


def test_a_preview_reads_little_of_a_large_file(spark, tmpdir_path):
    path = write(os.path.join(tmpdir_path, "big.csv"), PANELS + "".join(f"{i},{i},{i}\n" for i in range(1, 200_001)))
    head = read_head(spark, path, 22)
    assert len(head.collect()) == 22 and _leaf_rows(head) < 20_000
    r = load(spark, PANEL, path, limit=10)
    assert sorted(x.id for x in r.target.collect()) == list(range(1, 11))


def test_a_preview_goes_on_until_its_records_are_closed(spark, tmpdir_path):
    body = '"' + "\n".join(f"line {i}" for i in range(40)) + '"'
    for f in range(2):
        write(os.path.join(tmpdir_path, f"p{f}.csv"), "id,date_created,text\n" + "".join(f"{10 * f + i},2020-01-0{i},{body}\n" for i in range(1, 4)))
    for mode in ("parity", "parity_pattern"):
        got = [r.raw.split(",")[0] for r in read_first(spark, tmpdir_path, mode, 2).records.collect()]
        assert sorted(got) == ["1", "2"]
        got = [r.raw.split(",", 2)[0] + r.raw[-1] for r in read_first(spark, tmpdir_path, mode, 5).records.collect()]
        assert sorted(got) == ['1"', '11"', '12"', '2"', '3"']
    assert read_first(spark, tmpdir_path, "parity", 100).records.count() == 6


def test_parse_only_stops_before_the_keys(spark, tmpdir_path):
    path = write(os.path.join(tmpdir_path, "p.csv"), PANELS + "1,5,6\n1,5,6\n0,1,1\n2,7\n")
    nobody = spark.createDataFrame([], "id int")
    r = load(spark, PANEL, path, parents={"search_opinioncluster": nobody}, on_missing_parent="reject", parse_only=True)
    assert [tuple(x) for x in r.target.collect()] == [(1, 5, 6)] * 2
    assert sorted(x.status for x in r.outcomes.collect()) == ["parsed", "parsed", "rejected", "rejected"]
    assert {x.category for x in r.rejects.collect()} == {"parse"}
    assert not r.placeholders


def test_bad_records_and_batches(spark, tmpdir_path):
    rows = "".join(f"{i if i % 4 else 0},{100 + i // 3},{i}\n" for i in range(1, 13))
    path = write(os.path.join(tmpdir_path, "p.csv"), PANELS + rows)
    out = os.path.join(tmpdir_path, "bad")
    clusters = spark.createDataFrame([(100,), (101,)], "id int")
    r = load(spark, PANEL, path, parents={"search_opinioncluster": clusters}, batch=5, bad_records=out)
    bad = spark.read.options(header=True, escape='"').csv(out).collect()
    assert [(x.id, x.reason) for x in bad] == [("0", "invalid id=0")] * 3
    report = {x.batch: x for x in r.batch_report().collect()}
    assert {b: (x.attempted, x.rejected) for b, x in report.items()} == {0: (5, 1), 1: (5, 1), 2: (2, 1)}
    # clusters 102 (records 6 and 7), 103 (9; 8 is rejected, 10 and 11 follow) and 104 are missing; 12, the first of 104, is rejected
    assert {b: x.placeholders for b, x in report.items()} == {0: 0, 1: 2, 2: 0}
    assert r.totals().first().placeholders == 2
    assert sorted(x.id for x in r.placeholders["search_opinioncluster"].collect()) == [102, 103]


def test_an_empty_file_among_others_fails_by_name(spark, tmpdir_path):
    for name, text in (("a.csv", PANELS + "1,2,3\n"), ("b.csv", ""), ("c.csv", PANELS)):
        write(os.path.join(tmpdir_path, name), text)
    with pytest.raises(ValueError, match="b.csv") as e:
        load(spark, PANEL, tmpdir_path)
    assert "a.csv" not in str(e.value) and "c.csv" not in str(e.value)


def test_caches_are_given_back(spark, tmpdir_path):
    path = write(os.path.join(tmpdir_path, "c.csv"), "id,depth,cited_opinion_id,citing_opinion_id\n1,1,2,3\n")
    before = len(spark.sparkContext._jsc.getPersistentRDDs())
    r = load(spark, CITED, path, parents={"search_opinion": spark.createDataFrame([(2,)], "id int")})
    assert r.target.count() == 1 and len(spark.sparkContext._jsc.getPersistentRDDs()) > before
    r.release()
    assert len(spark.sparkContext._jsc.getPersistentRDDs()) <= before


def test_opinions_preview(spark, tmpdir_path):
    text = ",".join(OPINION.names) + "\n" + "".join(f'{i},2020-01-01,2020-01-02,010,s,,,"a\nb","","","","",f,,5,f,,"","","","",,\n' for i in range(1, 30))
    r = load(spark, OPINION, write(os.path.join(tmpdir_path, "o.csv"), text), limit=3, parse_only=True)
    assert [(x.id, x.plain_text) for x in r.target.orderBy("id").collect()] == [(1, "a\nb"), (2, "a\nb"), (3, "a\nb")]


def test_files_of_different_layouts(spark, tmpdir_path):
    write(os.path.join(tmpdir_path, "a.csv"), PANELS + "1,2,3\n")
    write(os.path.join(tmpdir_path, "b.csv"), "person_id,id,opinioncluster_id\n30,10,20\n")
    r = load(spark, PANEL, tmpdir_path)
    assert sorted(map(tuple, r.target.collect())) == [(1, 2, 3), (10, 20, 30)]
    r.release()  # what was cached of the folder must not stand for it once it has another file
    write(os.path.join(tmpdir_path, "c.csv"), "id,person_id\n4,5\n")
    with pytest.raises(ValueError, match="opinioncluster_id"):
        load(spark, PANEL, tmpdir_path)
