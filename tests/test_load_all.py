"""All dumps as one load, and bounded numbering windows of the report."""

import os

import pytest
from pyspark.sql import functions as F

from dump_files import write
from relload import load, load_all
from relload import CITED, CLUSTER, JOINED_BY, OPINION, PANEL, PARENTHETICAL, SEARCH_CITATION
from relload.operators import report
from relload.operators.fk import distinct_missing
from relload.plans.load_all import Loaded


def _opinion(i, cluster):
    v = {"id": i, "date_created": "2020-01-01", "date_modified": "2020-01-02", "type": "010", "cluster_id": cluster}
    return ",".join(str(v.get(c, "")) for c in OPINION.names)


def _cluster(i, docket):
    first = ["id", "date_created", "date_modified", "judges", "date_filed"]
    names = first + [c for c in CLUSTER.names if c not in first]
    v = {"id": i, "date_created": "2020-01-01", "date_modified": "2020-01-02", "judges": "J", "date_filed": "1999-01-01", "docket_id": docket}
    return names, ",".join(str(v.get(c, "")) for c in names)


@pytest.fixture()
def dumps(tmpdir_path):
    names, _ = _cluster(1, 1)
    texts = {
        CLUSTER: [",".join(names), _cluster(10, 4)[1], _cluster(11, 99)[1], _cluster(12, 0)[1]],
        OPINION: [",".join(OPINION.names), _opinion(100, 10), _opinion(101, 50)],
        PANEL: ["id,opinioncluster_id,person_id", "1,10,7", "2,60,7", "3,10,8"],
        SEARCH_CITATION: ["id,volume,reporter,page,type,cluster_id", "1,2,U.S.,3,1,70"],
        JOINED_BY: ["id,opinion_id,person_id", "1,200,7"],
        CITED: ["id,depth,cited_opinion_id,citing_opinion_id", "1,1,100,300"],
        PARENTHETICAL: ["id,text,score,described_opinion_id,describing_opinion_id,group_id", "5,t,0.5,100,400,900"],
    }
    return {s.name: write(os.path.join(tmpdir_path, f"{s.name}.csv"), "\n".join(t) + "\n") for s, t in texts.items()}


def test_no_child_lacks_its_parent(spark, tmpdir_path, dumps):
    parents = {
        "search_docket": spark.createDataFrame([(4,), (2147483647,)], "id int"),
        "people_db_person": spark.createDataFrame([(7,)], "id int"),
    }
    out = os.path.join(tmpdir_path, "db")
    done = load_all(spark, dumps, out, parents=parents, bad_records=os.path.join(tmpdir_path, "bad"))
    ids = {t: sorted(r.id for r in df.select("id").collect()) for t, df in done.tables.items()}
    assert ids["search_opinioncluster"] == [1, 10, 12, 50, 60, 70]  # 11 names docket 99; 1 holds the placeholder opinions
    assert ids["search_opinion"] == [1, 100, 101, 200, 300, 400]
    assert ids["search_parentheticalgroup"] == [1, 900] and ids["search_parenthetical"] == [1, 5]
    assert ids["search_docket"] == [1, 4, 2147483647]  # docket 1 came with the first placeholder that needs it
    assert ids["search_opinioncluster_panel"] == [1, 2]  # person 8 is not there
    assert {tuple(r)[:2] for r in done.orphans().where("orphans > 0").collect()} == set()
    assert done.orphans().count() == 13
    assert done.totals["search_opinioncluster_panel"]["rejected"] == 1 and done.totals["search_citation"]["placeholders"] == 1
    read = spark.read.parquet(f"{out}/search_opinioncluster")
    assert sorted(r.id for r in read.select("id").collect()) == ids["search_opinioncluster"]
    assert {r.part for r in read.select("part").collect()} == {"loaded", *(f"for-{s.name}" for s in (OPINION, PANEL, SEARCH_CITATION, JOINED_BY))}
    bad = spark.read.options(header=True, escape='"', multiLine=True).csv(os.path.join(tmpdir_path, "bad", CLUSTER.name)).collect()
    assert len(bad) == 1 and bad[0].reason == "FK violation: docket_id=99 not found in search_docket"


def test_unknown_tables_are_refused(spark, tmpdir_path):
    with pytest.raises(ValueError, match="no table spec"):
        load_all(spark, {"search_court": "x"}, tmpdir_path)


def test_numbering_windows_are_bounded_within_a_split(spark, tmpdir_path, monkeypatch):
    monkeypatch.setattr(report, "BLOCK", 16)
    path = write(os.path.join(tmpdir_path, "p.csv"), "id,opinioncluster_id,person_id\n" + "".join(f"{i},{i},{i}\n" for i in range(1, 501)))
    outcomes = load(spark, PANEL, path).outcomes  # one file, one split
    sizes = report.numbering_blocks(outcomes).groupBy("_p", "_blk", "_sub").count()
    assert sizes.agg(F.max("count")).first()[0] <= 16 and sizes.count() >= 32
    placed = report.with_position(outcomes).orderBy("_ob", "_om").collect()
    assert [r.pos for r in placed] == list(range(500))


def test_positions_of_places_far_apart_need_no_window_over_records(spark):
    """Every record lies in a block of its own: the running sum is over partitions, not over blocks."""
    rows = [("b", 7 * i % 501 * 1000, 1, "inserted") for i in range(501)] + [("a", 5, 1, "rejected"), ("a", None, 1, "rejected")]
    placed = report.with_position(spark.createDataFrame(rows, "_p string, _ob long, _om long, status string"))
    got = [(r.pos, r._p, r._ob) for r in placed.orderBy("pos").collect()]
    assert got == [(1, "a", 5)] + [(i + 2, "b", i * 1000) for i in range(501)]
    plan = placed._jdf.queryExecution().toString()
    assert "Window" in plan and "_ob" not in "".join(x for x in plan.splitlines() if "Window" in x)


def test_ids_of_parents_are_not_broadcast_however_small_their_files_look(spark):
    """Ids beside literals, as in placeholder rows, are far more than their column's share of a file says."""
    parent, child = spark.range(500).select(F.col("id").cast("int").alias("id")), spark.range(400, 600).select(F.col("id").cast("int").alias("opinioncluster_id"), "id")
    missing = distinct_missing(child, ["opinioncluster_id"], parent)
    done = Loaded("", {CLUSTER.name: parent, PANEL.name: child})
    for df in (missing, done.orphans()):
        assert "Broadcast" not in df._jdf.queryExecution().executedPlan().toString()
    assert sorted(r.id for r in missing.collect()) == list(range(500, 600))
    assert [tuple(r) for r in done.orphans().collect()] == [(PANEL.name, "opinioncluster_id", CLUSTER.name, 100)]
