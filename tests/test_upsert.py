import random

from pyspark.sql import functions as F

import models
import pytest
from relload.operators import upsert
from relload.operators.upsert import upsert_ignore, upsert_last, upsert_natural


def _rows(spark, data, schema):
    df = spark.createDataFrame(data, schema)
    return df.withColumn("_ord", F.struct(F.lit("f").alias("_p"), F.col("seq").alias("_ob"), F.lit(1).cast("long").alias("_om")))


def _statuses(up):
    return [r.status for r in up.status.orderBy(F.col("_ord._ob")).collect()]


@pytest.mark.parametrize("in_one_task", [0, 12, 10**6])
def test_conflicting_rows_match_sequential_replay(spark, in_one_task, monkeypatch):
    monkeypatch.setattr(upsert, "REPLAY_ROWS", in_one_task)  # rounds only, rounds and then a replay, a replay only
    rnd = random.Random(3)
    for trial in range(2):
        existing = [(i, f"k{i % 5}") for i in range(3)] if trial % 2 else []
        rows = [(rnd.randint(0, 14), f"k{rnd.randint(0, 11)}", rnd.random() < 0.85) for _ in range(24)]
        state, st = models.natural_replay(existing, rows)
        data = [(s, i, k, ok, None if ok else "FK violation") for s, (i, k, ok) in enumerate(rows)]
        r = _rows(spark, data, "seq long, id long, k string, _ok boolean, _fkr string")
        ex = spark.createDataFrame(existing, "id long, k string") if existing else None
        up = upsert_natural(r, ex, ["id", "k"], ["k"], ["id"])
        got = {x.k: x.id for x in up.target.collect()}
        assert got == state
        assert _statuses(up) == st


def test_ignore_and_last_match_sequential(spark):
    rnd = random.Random(5)
    rows = [(rnd.randint(0, 10), rnd.randint(0, 100), rnd.random() < 0.7) for _ in range(80)]
    data = [(s, i, p, ok, None if ok else "fk") for s, (i, p, ok) in enumerate(rows)]
    r = _rows(spark, data, "seq long, id long, p long, _ok boolean, _fkr string")
    ex = spark.createDataFrame([(0, -1), (1, -1)], "id long, p long")
    up = upsert_ignore(r, ex, ["id", "p"])
    stored, st = models.ignore_replay([0, 1], rows)
    got = {x.id: x.p for x in up.target.collect() if x.p != -1}
    assert got == stored
    assert _statuses(up) == st
    up = upsert_last(r, None, ["id", "p"])
    stored, st = models.last_replay(rows)
    assert {x.id: x.p for x in up.target.collect()} == stored
    assert _statuses(up) == st


def test_a_large_component_is_settled_in_few_rounds(spark, monkeypatch):
    """One component of 40,000 rows (a ring of ids shared by neighbouring keys): set operations over all of it."""
    monkeypatch.setattr(upsert, "REPLAY_ROWS", 0)
    rounds = []
    settle = upsert._settle
    monkeypatch.setattr(upsert, "_settle", lambda e, s: settle(e, s) if rounds.append(1) or len(rounds) <= 4 else 1 / 0)
    n = 20_000
    first = [(i, i, f"k{i}", True, None) for i in range(n)]
    second = [(2 * n - i, i, f"k{(i + 1) % n}", True, None) for i in range(n)]  # each id asked for by the next key, the last first
    r = _rows(spark, first + second, "seq long, id long, k string, _ok boolean, _fkr string")
    up = upsert_natural(r, None, ["id", "k"], ["k"], ["id"])
    got = {x["status"]: x["count"] for x in up.status.groupBy("status").count().collect()}
    assert got == {"inserted": n, "rejected": n} and up.target.count() == n
    assert len(rounds) <= 4


def test_hot_key_runs_are_compressed_but_exact(spark):
    rnd = random.Random(11)
    rows = []
    for _ in range(400):  # one hot key with mostly private ids, a few shared ones
        if rnd.random() < 0.7:
            rows.append((1000 + rnd.randint(0, 300), "hot", True))
        else:
            rows.append((rnd.randint(0, 5), f"k{rnd.randint(0, 4)}" if rnd.random() < 0.5 else "hot", rnd.random() < 0.9))
    state, st = models.natural_replay([], rows)
    data = [(s, i, k, ok, None if ok else "FK violation") for s, (i, k, ok) in enumerate(rows)]
    r = _rows(spark, data, "seq long, id long, k string, _ok boolean, _fkr string")
    up = upsert_natural(r, None, ["id", "k"], ["k"], ["id"])
    assert {x.k: x.id for x in up.target.collect()} == state
    assert _statuses(up) == st


def test_partial_matches_sequential_with_existing(spark):
    from relload.operators.upsert import upsert_partial

    rnd = random.Random(9)
    rows = [(rnd.randint(0, 12), rnd.randint(0, 50), rnd.randint(0, 9), rnd.random() < 0.75) for _ in range(90)]
    existing = {0: (-1, -1), 1: (-2, -2)}  # id -> (endpoint, depth)
    state = {k: list(v) for k, v in existing.items()}
    st = []
    for i, ep, depth, ok in rows:  # INSERT ... ON CONFLICT (id) DO UPDATE SET depth
        if i in state:
            state[i][1] = depth
            st.append("updated")
        elif not ok:
            st.append("rejected")
        else:
            state[i] = [ep, depth]
            st.append("inserted")
    data = [(s, i, ep, d, ok, None if ok else "fk") for s, (i, ep, d, ok) in enumerate(rows)]
    r = _rows(spark, data, "seq long, id long, ep long, depth long, _ok boolean, _fkr string")
    ex = spark.createDataFrame([(k, v[0], v[1]) for k, v in existing.items()], "id long, ep long, depth long")
    up = upsert_partial(r, ex, ["id", "ep", "depth"], ["depth"])
    assert {x.id: [x.ep, x.depth] for x in up.target.collect()} == state
    assert _statuses(up) == st


def test_no_payload_goes_through_an_aggregate(spark, tmpdir_path):
    """UPS-1 to 5 over real dumps: ordinals are one number, so every aggregate is a hash aggregate."""
    import os

    from dump_files import write
    from relload import CITED, CLUSTER, PANEL, PARENTHETICAL, SEARCH_CITATION, load

    dumps = {
        CITED: "id,depth,cited_opinion_id,citing_opinion_id\n1,2,3,4\n1,5,6,7\n",
        PANEL: "id,opinioncluster_id,person_id\n1,2,3\n4,2,3\n",
        SEARCH_CITATION: "id,volume,reporter,page,type,cluster_id\n1,2,U.S.,3,1,5\n",
        PARENTHETICAL: "id,text,score,described_opinion_id,describing_opinion_id,group_id\n1,a,0.5,1,1,1\n1,b,0.5,1,1,1\n",
        CLUSTER: ",".join(CLUSTER.names) + "\n" + ",".join(["1", "j", "2020-01-01", "2020-01-01", "2020-01-01", *["x"] * 31]) + "\n",
    }
    mode = spark.sparkContext._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    for spec, text in dumps.items():
        path = write(os.path.join(tmpdir_path, f"{spec.name}.csv"), text)
        target = load(spark, spec, path).target
        plan = target._jdf.queryExecution().explainString(mode)
        assert "HashAggregate" in plan and "SortAggregate" not in plan, spec.name
        assert target.count() == (0 if spec is CLUSTER else 1), spec.name  # the cluster row has no dates


@pytest.mark.parametrize("few", [True, False])
def test_groups_of_conflicting_rows_are_replayed_apart(spark, few, monkeypatch):
    """Many small groups, more rows than one task replays: each group is settled at once, without a round over the rest."""
    monkeypatch.setattr(upsert, "REPLAY_ROWS", 60)
    monkeypatch.setattr(upsert, "_settle", lambda *_: 1 / 0)
    if not few:
        monkeypatch.setattr(upsert, "is_broadcast", lambda df: False)
    rnd = random.Random(17)
    existing = [(100 * g, f"k{g}_0") for g in range(0, 12, 2)]
    rows = []
    for _ in range(400):
        g = rnd.randint(0, 11)
        k = rnd.randint(0, 3)
        # ids of a group's keys; ids that no other key asks for; keys that fail their check
        i = 100 * g + (rnd.randint(0, 3) if rnd.random() < 0.8 else 10 + 10 * k + rnd.randint(0, 3))
        rows.append((i, f"k{g}_{k}", k != 3))
    rows += [(9000 + n // 2, f"m{rnd.randint(0, 30)}", True) for n in range(300)]  # ids asked for twice running: keys move from one to the next
    state, st = models.natural_replay(existing, rows)
    data = [(s, i, k, ok, None if ok else "FK violation") for s, (i, k, ok) in enumerate(rows)]
    r = _rows(spark, data, "seq long, id long, k string, _ok boolean, _fkr string")
    up = upsert_natural(r, spark.createDataFrame(existing, "id long, k string"), ["id", "k"], ["k"], ["id"])
    assert {x.k: x.id for x in up.target.collect()} == state
    assert _statuses(up) == st


@pytest.mark.parametrize("in_one_task", [6, 10**6])
def test_many_dirty_ids_match_sequential_replay(spark, in_one_task, monkeypatch):
    """Above the broadcast bound all rows are looked at by id and by key; FK results differ within a key, too."""
    monkeypatch.setattr(upsert, "REPLAY_ROWS", in_one_task)
    monkeypatch.setattr(upsert, "is_broadcast", lambda df: False)
    rnd = random.Random(23)
    existing = [(i, f"k{i}") for i in range(4)]
    rows = [(rnd.randint(0, 14), f"k{rnd.randint(0, 11)}", rnd.random() < 0.8) for _ in range(30)]
    rows += [(100 + n, f"c{n % 3}", n % 3 != 1) for n in range(9)]  # keys that share no id
    state, st = models.natural_replay(existing, rows)
    data = [(s, i, k, ok, None if ok else "FK violation") for s, (i, k, ok) in enumerate(rows)]
    r = _rows(spark, data, "seq long, id long, k string, _ok boolean, _fkr string")
    up = upsert_natural(r, spark.createDataFrame(existing, "id long, k string"), ["id", "k"], ["k"], ["id"])
    assert {x.k: x.id for x in up.target.collect()} == state
    assert _statuses(up) == st


def test_rows_that_come_twice_have_one_status_each(spark):
    data = [(0, 1, "a"), (1, 1, "b"), (2, 50, "a"), (2, 50, "a"), (3, 51, "a"), (4, 52, "a")]
    r = _rows(spark, [(*d, True, None) for d in data], "seq long, id long, k string, _ok boolean, _fkr string")
    up = upsert_natural(r, None, ["id", "k"], ["k"], ["id"])
    assert _statuses(up) == ["inserted", "rejected", *["updated"] * 4]
    assert [(x.id, x.k) for x in up.target.collect()] == [(52, "a")]
