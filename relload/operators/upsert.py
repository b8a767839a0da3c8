"""Conflict resolution as set operations (UPS-1..5, SRT-1).

Rows are applied in file order in the original loaders.  Each rule below is
its set-based equivalent over the ordinal ``_ord`` (a struct: file, record,
line) with existing target rows first.  Inputs carry:

``_ord``  ordinal: a long (a record's place in the dump) or a struct
``_ok``   the row passes (or repairs) every FK      ``_fkr``  FK reason when not ok

Per key the work is an aggregation of ordinals (partial, map-side; a hash aggregate
where the ordinal is a long) followed by a join back, which tells each row its fate and
finds the winners' columns; no payload goes through an aggregate.  A key holding a large
share of the rows is pre-aggregated before the shuffle and AQE splits its partition in
the join.  Every function returns the new target state and a per-row status.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import logging

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans.caching import cached
from ..plans.components import connected_components
from ..plans.joins import bounded_broadcast, is_broadcast, shuffled
from ..session import scratch_path

_log = logging.getLogger("relload.upsert")
PLACE = ("_p", "_ob", "_om")  # a record's place in its file; rides along to the status where rows have it
REPLAY_ROWS = 500_000  # conflicting rows that one task replays in order; more are settled in rounds


@dataclass
class Upserted:
    target: DataFrame  # new table state
    status: DataFrame  # _ord, status, reason, category (one row per incoming row)
    reached: DataFrame | None = None  # incoming rows whose write reaches the FK check, where the rule tells them without a join


def _place(df: DataFrame) -> list[str]:
    return [c for c in PLACE if c in df.columns]


def _status(df: DataFrame, status, reason, category) -> DataFrame:
    return df.select("_ord", *_place(df), status.alias("status"), reason.alias("reason"), category.alias("category"))


def _existing_keys(existing: DataFrame | None, keys: Sequence[str]) -> DataFrame | None:
    if existing is None:
        return None
    return existing.select(*keys).distinct().withColumn("_ex", F.lit(True))


def _with_existing(agg: DataFrame, existing: DataFrame | None, keys: Sequence[str]) -> DataFrame:
    ex = _existing_keys(existing, keys)
    if ex is None:
        return agg.withColumn("_ex", F.lit(False))
    return agg.join(ex, list(keys), "left").withColumn("_ex", F.coalesce(F.col("_ex"), F.lit(False)))


def _inserting(r: DataFrame) -> DataFrame:
    """Rows that inserted or failed at the FK check; no-ops and rewrites of other columns never reach it."""
    return r.filter(F.col("_st").isin("inserted", "rejected"))


def upsert_ignore(rows: DataFrame, existing: DataFrame | None, cols: Sequence[str], key: str = "id") -> Upserted:
    """UPS-1 ``ON CONFLICT (id) DO NOTHING``.

    The existing row wins; else the first row (by ordinal) that passes its FK
    checks.  Rows before that winner fail as ``fk``; rows after it are no-ops.
    """
    agg = rows.groupBy(key).agg(F.min(F.when(F.col("_ok"), F.col("_ord"))).alias("_win"))
    agg = _with_existing(agg, existing, [key])
    r = rows.join(agg, key)
    st = (
        F.when(F.col("_ex"), F.lit("duplicate_noop"))
        .when(F.col("_win").isNull() | (F.col("_ord") < F.col("_win")), F.lit("rejected"))
        .when(F.col("_ord") == F.col("_win"), F.lit("inserted"))
        .otherwise(F.lit("duplicate_noop"))
    )
    r = r.withColumn("_st", st)
    rej = F.col("_st") == "rejected"
    status = _status(r, F.col("_st"), F.when(rej, F.col("_fkr")), F.when(rej, F.lit("fk")))
    new = r.filter(F.col("_st") == "inserted").select(*cols)
    target = new if existing is None else existing.select(*cols).unionByName(new)
    return Upserted(target, status, _inserting(r))


def upsert_partial(
    rows: DataFrame, existing: DataFrame | None, cols: Sequence[str], update: Sequence[str], key: str = "id"
) -> Upserted:
    """UPS-2 ``ON CONFLICT (id) DO UPDATE SET <update>``.

    The inserting row is the first that passes its FK checks (rows before it
    fail as ``fk``); later rows only rewrite ``update`` columns, which are not
    foreign keys, so they always succeed.  Result: the other columns of the
    first row, ``update`` of the last.
    """
    keep = [c for c in cols if c != key and c not in update]
    agg = rows.groupBy(key).agg(F.min(F.when(F.col("_ok"), F.col("_ord"))).alias("_win"), F.max("_ord").alias("_last"))
    agg = _with_existing(agg, existing, [key])
    r = rows.join(agg, key)
    st = (
        F.when(F.col("_ex"), F.lit("updated"))
        .when(F.col("_win").isNull() | (F.col("_ord") < F.col("_win")), F.lit("rejected"))
        .when(F.col("_ord") == F.col("_win"), F.lit("inserted"))
        .otherwise(F.lit("updated"))
    )
    r = r.withColumn("_st", st)
    rej = F.col("_st") == "rejected"
    status = _status(r, F.col("_st"), F.when(rej, F.col("_fkr")), F.when(rej, F.lit("fk")))
    last = r.filter((F.col("_ord") == F.col("_last")) & (F.col("_ex") | F.col("_win").isNotNull()))
    upd = last.select(key, "_ex", *[F.col(c).alias(f"_u_{c}") for c in update])
    new = r.filter(F.col("_st") == "inserted").select(key, *keep).join(upd.drop("_ex"), key)
    new = new.select(key, *keep, *[F.col(f"_u_{c}").alias(c) for c in update]).select(*cols)
    if existing is None:
        return Upserted(new, status, _inserting(r))
    old = existing.select(*cols).join(upd.filter(F.col("_ex")).drop("_ex").withColumn("_hit", F.lit(True)), key, "left")
    old = old.select(*[F.when(F.col("_hit"), F.col(f"_u_{c}")).otherwise(F.col(c)).alias(c) if c in update else F.col(c) for c in cols])
    return Upserted(old.unionByName(new), status, _inserting(r))


def upsert_last(rows: DataFrame, existing: DataFrame | None, cols: Sequence[str], key: str = "id") -> Upserted:
    """UPS-3 ``ON CONFLICT (id) DO UPDATE SET <all>``: the last row passing its FK checks wins."""
    mine = F.when(F.col("_ok"), F.col("_ord"))
    agg = _with_existing(rows.groupBy(key).agg(F.max(mine).alias("_last"), F.min(mine).alias("_first")), existing, [key])
    r = rows.join(agg, key)
    st = (
        F.when(~F.col("_ok"), F.lit("rejected"))
        .when(~F.col("_ex") & (F.col("_ord") == F.col("_first")), F.lit("inserted"))
        .otherwise(F.lit("updated"))
    )
    r = r.withColumn("_st", st)
    rej = F.col("_st") == "rejected"
    status = _status(r, F.col("_st"), F.when(rej, F.col("_fkr")), F.when(rej, F.lit("fk")))
    won = r.filter(F.col("_ord") == F.col("_last")).select(*cols)
    reached = rows.filter(F.col(key).isNotNull())  # each row is written in full or refused for a foreign key
    if existing is None:
        return Upserted(won, status, reached)
    kept = existing.select(*cols).join(won.select(key), key, "left_anti")
    return Upserted(kept.unionByName(won), status, reached)


# ---------------------------------------------------------------- UPS-4 / UPS-5


def _key(nkey: Sequence[str]):
    return F.struct(*[F.col(c) for c in nkey])


def _written(df: DataFrame, name: str) -> DataFrame:
    """A table of a round, written to the shared folder and read back: short plans, and rows that survive lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _settle(events: DataFrame, state: DataFrame) -> DataFrame:
    """The events whose outcome is certain by now, with ``status``, ``reason`` and ``category``.

    An event is settled when no earlier open one has its key or its id, none can take the
    id away from the key that holds it, and, unless it is refused, none asks for the id
    that its key releases.  Events settled together have different keys and ids, and none of them
    decides another: one that releases an id is settled before any later one that asks
    for it, and after all earlier ones.
    """
    by_key = events.groupBy("_k").agg(F.min("_ord").alias("_mk"))
    by_id = events.groupBy("id").agg(F.min("_ord").alias("_mi"))
    c = events.join(by_key, "_k").where(F.col("_ord") == F.col("_mk")).join(by_id, "id").where(F.col("_ord") == F.col("_mi"))
    c = c.join(state.select("id", F.col("_k").alias("_owner")), "id", "left")
    c = c.join(state.select("_k", F.col("id").alias("_held")), "_k", "left")
    c = c.join(by_key.select(F.col("_k").alias("_owner"), F.col("_mk").alias("_mo")), "_owner", "left")
    foreign = F.col("_owner").isNotNull() & (F.col("_owner") != F.col("_k"))
    c = c.where(~foreign | F.col("_mo").isNull() | (F.col("_mo") > F.col("_ord")))
    c = c.join(by_id.select(F.col("id").alias("_held"), F.col("_mi").alias("_mh")), "_held", "left")
    c = c.where(foreign | F.col("_mh").isNull() | (F.col("_held") == F.col("id")) | (F.col("_mh") > F.col("_ord")))
    no_parent = F.col("_held").isNull() & ~F.col("_ok")
    status = F.when(foreign | no_parent, "rejected").when(F.col("_held").isNull(), "inserted").otherwise("updated")
    reason = F.when(foreign, F.format_string("Duplicate key violation: id=%d", "id")).when(no_parent, F.col("_fkr"))
    return c.select("_k", "id", "_src", status.alias("status"), reason.alias("reason"), F.when(foreign, "unique").when(no_parent, "fk").alias("category"))


def _resolve(events: DataFrame, state: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Outcome of each event (``_src``, ``status``, ``reason``, ``category``) and the final rows (``_k``, ``id``, ``_src``).

    ``events`` are rows in order (``_ord``) that ask for an id under a key, ``state`` the
    existing rows (``_src`` -1).  A round settles all events that are certain, with joins
    and aggregates over the open ones.  Where that is less than one task can replay in
    order (long chains of events that wait for one another, or few events altogether),
    the next ``REPLAY_ROWS`` events are replayed instead; so every step settles that many
    or all, and no task holds more.
    """
    outcomes = []
    events, state = _written(events, "events"), _written(state, "held")
    left = events.count()
    while left:
        done = _written(_settle(events, state), "settled") if left > REPLAY_ROWS else None
        if done is not None and done.count() >= REPLAY_ROWS:
            taken = done.where("status <> 'rejected'").select("_k", "id", "_src")
            state = state.join(taken.select("_k"), "_k", "left_anti").unionByName(taken)
        else:
            done, state = _replay_first(events if left <= REPLAY_ROWS else events.orderBy("_ord").limit(REPLAY_ROWS), state)
        outcomes.append(done.select("_src", "status", "reason", "category"))
        state = _written(state, "held")
        events = _written(events.join(done.select("_src"), "_src", "left_anti"), "events")
        before, left = left, events.count()
        _log.info("conflicts, step %d: %d of %d rows settled", len(outcomes), before - left, before)
    every = outcomes[0]
    for o in outcomes[1:]:
        every = every.unionByName(o)
    return every, state


def _replay_first(events: DataFrame, state: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Outcome of the earliest events, replayed in one task with the held rows of their keys and ids, and the new state."""
    near = state.join(events.select("_k").distinct(), "_k", "left_semi").unionByName(state.join(events.select("id").distinct(), "id", "left_semi"))
    near = _written(near.distinct(), "near")
    rows = events.select(
        "_k", "id", F.lit(True).alias("_new"), "_ok", "_fkr", "_src", F.row_number().over(Window.orderBy("_ord")).cast("long").alias("_seq")
    ).unionByName(near.select(
        "_k", "id", F.lit(False).alias("_new"), F.lit(True).alias("_ok"), F.lit(None).cast("string").alias("_fkr"), "_src",
        F.lit(0).cast("long").alias("_seq"),
    ))
    replayed = _written(rows.groupBy(F.lit(0).alias("_all")).applyInPandas(_replay, _REPLAY_SCHEMA), "replayed")
    finals = replayed.where("_kind = 'final'").select("_k", "id", "_src")
    state = state.join(near.select("_k"), "_k", "left_anti").unionByName(finals)
    return replayed.where("_kind = 'status'"), state


_REPLAY_SCHEMA = T.StructType(
    [
        T.StructField("_kind", T.StringType()),
        T.StructField("_k", T.StringType()),
        T.StructField("id", T.LongType()),
        T.StructField("_src", T.LongType()),
        T.StructField("status", T.StringType()),
        T.StructField("reason", T.StringType()),
        T.StructField("category", T.StringType()),
    ]
)


def _replay(pdf: pd.DataFrame) -> pd.DataFrame:
    """Sequential replay of a bounded rest of conflicting rows (held rows first, then in order).

    A plain state machine over two dicts: key -> (id, source row), id -> key.
    """
    pdf = pdf.sort_values(["_new", "_seq"], kind="mergesort")
    by_key: dict[str, tuple[int, int]] = {}
    owner: dict[int, str] = {}
    out = []
    cols = [pdf[c].tolist() for c in ("_k", "id", "_new", "_ok", "_fkr", "_src")]
    for k, i, new, ok, fkr, src in zip(*cols):
        i = int(i)
        if not new:
            by_key[k] = (i, int(src))
            owner[i] = k
            continue
        cur = by_key.get(k)
        holder = owner.get(i)
        if holder is not None and holder != k:
            out.append(("status", k, i, src, "rejected", "Duplicate key violation: id=%d" % i, "unique"))
            continue
        if cur is None and not ok:
            out.append(("status", k, i, src, "rejected", fkr, "fk"))
            continue
        if cur is not None:
            owner.pop(cur[0], None)
        owner[i] = k
        by_key[k] = (i, int(src))
        out.append(("status", k, i, src, "inserted" if cur is None else "updated", None, None))
    for k, (i, src) in by_key.items():
        out.append(("final", k, i, src, None, None, None))
    return pd.DataFrame(out, columns=[f.name for f in _REPLAY_SCHEMA.fields])


def upsert_natural(
    rows: DataFrame,
    existing: DataFrame | None,
    cols: Sequence[str],
    nkey: Sequence[str],
    update: Sequence[str],
) -> Upserted:
    """UPS-4/5 ``ON CONFLICT (<natural key>) DO UPDATE SET <update>`` (``update`` includes ``id``).

    The foreign keys are part of the natural key, so only an insert (a new key)
    is FK-checked.  An id that ever appears under two keys (in existing or
    incoming rows) is *dirty*, and so are its keys: their rows fall into groups that
    cannot decide one another (:func:`_seeds`) and are replayed group by group, in file order.
    All other keys take the last row (an aggregation), which is exact there.
    """
    inc = rows.withColumn("_k", _key(nkey))
    ex = existing.withColumn("_k", _key(nkey)) if existing is not None else None
    edges = inc.select("id", "_k")
    if ex is not None:
        edges = edges.unionByName(ex.select("id", "_k"))
    edges = edges.distinct()
    dirty_ids = cached(edges.groupBy("id").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1 and id is not null").select("id"))
    has_dirty = dirty_ids.limit(1).count() > 0

    mixed = None  # rows of dirty keys, existing ones (``_e``) among them
    if has_dirty and is_broadcast(few := bounded_broadcast(dirty_ids)):
        # few dirty ids: the rows of their keys are found where the rows are
        dirty_keys = bounded_broadcast(edges.join(few, "id", "left_semi").select("_k").distinct().withColumn("_c", F.lit(True)))
        if not is_broadcast(dirty_keys):
            dirty_keys = shuffled(dirty_keys)
        inc = inc.join(dirty_keys, "_k", "left")
        if ex is not None:
            ex = ex.join(dirty_keys, "_k", "left")
        mixed = _written(_seeds(_events(inc.filter("_c"), None if ex is None else ex.filter("_c"), cols, nkey)), "conflicts")
    elif has_dirty:
        # many: all rows are looked at by id and by key once, and written with what that shows
        every = _written(_seeds(_events(inc, ex, cols, nkey)), "conflicts").withColumn("_c", F.when(F.col("_kd"), F.lit(True)))
        mixed = every.filter("_c")
        back = [F.col("_k")[c].alias(c) for c in nkey]
        inc = every.filter("NOT _e").select("*", *back)
        if ex is not None:
            ex = every.filter("_e").select("*", *back)
    else:
        inc = inc.withColumn("_c", F.lit(None).cast("boolean"))
        if ex is not None:
            ex = ex.withColumn("_c", F.lit(None).cast("boolean"))

    # ---- clean keys: last row wins; first row inserts unless the key exists.
    clean = inc.filter(F.col("_c").isNull())
    agg = clean.groupBy("_k").agg(
        F.max("_ord").alias("_last"), F.min("_ord").alias("_first"), F.min("_ok").alias("_aok")
    )
    ex_keys = None if ex is None else ex.filter(F.col("_c").isNull()).select("_k").distinct().withColumn("_ex", F.lit(True))
    agg = agg.withColumn("_ex", F.lit(False)) if ex_keys is None else agg.join(ex_keys, "_k", "left").withColumn(
        "_ex", F.coalesce(F.col("_ex"), F.lit(False))
    )
    r = clean.join(agg, "_k")
    st = (
        F.when(F.col("_ex"), F.lit("updated"))
        .when(~F.col("_aok"), F.lit("rejected"))
        .when(F.col("_ord") == F.col("_first"), F.lit("inserted"))
        .otherwise(F.lit("updated"))
    )
    r = r.withColumn("_st", st)
    rej = F.col("_st") == "rejected"
    status = _status(r, F.col("_st"), F.when(rej, F.col("_fkr")), F.when(rej, F.lit("fk")))
    won = r.filter((F.col("_ord") == F.col("_last")) & (F.col("_ex") | F.col("_aok"))).select("_k", "_ex", *cols)
    if ex is None:
        target = won.select(*cols)
    else:
        ex_clean = ex.filter(F.col("_c").isNull())
        kept = ex_clean.join(won.select("_k"), "_k", "left_anti").select(*cols)
        upd = ex_clean.select("_k", *[c for c in cols if c not in update]).join(
            won.filter(F.col("_ex")).select("_k", *update), "_k"
        )
        target = kept.unionByName(upd.select(*cols)).unionByName(won.filter(~F.col("_ex")).select(*cols))

    if not has_dirty:
        return Upserted(target, status)

    # ---- dirty keys: the last row let in stands, the first one let in inserts unless the key exists.
    done = cached(_in_groups(mixed))
    let_in = F.col("status").isin("inserted", "updated")
    latest = Window.partitionBy("_k").orderBy(F.col("_ord").desc_nulls_last())
    d_target = done.filter(F.col("_e") | let_in).withColumn("_nth", F.row_number().over(latest)).filter("_nth = 1")
    d_target = d_target.select("*", *[F.col("_k")[c].alias(c) for c in nkey]).select(*cols)
    so_far = Window.partitionBy("_k").orderBy("_ord").rowsBetween(Window.unboundedPreceding, 0)
    d = done.filter("NOT _e").withColumn("_in", F.sum(let_in.cast("long")).over(so_far))
    first = ~F.col("_kx") & (F.col("_in") == 1)
    d_status = _status(d, F.when(let_in, F.when(first, "inserted").otherwise("updated")).otherwise(F.col("status")), F.col("reason"), F.col("category"))
    return Upserted(target.unionByName(d_target), status.unionByName(d_status))


def _events(inc: DataFrame, ex: DataFrame | None, cols: Sequence[str], nkey: Sequence[str]) -> DataFrame:
    """Incoming rows and, marked ``_e`` and without an ordinal, the existing ones; the key's columns are in ``_k`` alone."""
    rest = [c for c in cols if c != "id" and c not in nkey]
    new = inc.select("_k", "id", *rest, "_ord", *_place(inc), "_ok", "_fkr", F.lit(False).alias("_e"))
    if ex is None:
        return new
    old = ex.select("_k", "id", *rest, F.lit(True).alias("_ok"), F.lit(True).alias("_e"))
    return new.unionByName(old, allowMissingColumns=True)


def _seeds(events: DataFrame) -> DataFrame:
    """The events with what their ids and keys show of them: which ones can decide one another.

    ``_idd``: several keys ask for the id.  ``_kd``: the key asks for such an id; ``_kx``: it
    exists, so its rows are ``_ok``; ``_kok``: all rows of it are.  ``_seed``: the smallest
    dirty id of the event's stretch, null where no dirty id matters to it.

    Who holds a dirty id matters until the last row that asks for it (``_until``).  So a key's
    rows, in order, form one stretch as long as an id asked for before is still asked for
    by the rows that follow, and a new stretch begins where none is.  Rows decide one another only
    through a common stretch or a common dirty id.  Whether the key exists adds no tie, as its
    rows pass the FK check together; a key where they do not is one stretch.
    """
    of_id = Window.partitionBy("id")
    asked = F.col("id").isNotNull() & ~F.min("_k").over(of_id).eqNullSafe(F.max("_k").over(of_id))
    e = events.withColumn("_idd", asked).withColumn("_until", F.when(F.col("_idd"), F.max("_ord").over(of_id)))
    in_order = Window.partitionBy("_k").orderBy("_ord")
    of_key = in_order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = in_order.rowsBetween(Window.unboundedPreceding, -1)
    e = e.select(
        "*",
        F.max("_idd").over(of_key).alias("_kd"),
        F.max("_e").over(of_key).alias("_kx"),
        F.min("_ok").over(of_key).alias("_all_ok"),
        F.max(~F.col("_e") & F.col("_ok")).over(of_key).alias("_some_ok"),
        F.max("_until").over(before).alias("_before"),
        F.row_number().over(in_order).alias("_row"),
    )
    torn = ~F.col("_kx") & ~F.col("_all_ok") & F.col("_some_ok")
    begins = F.when(F.col("_row") == 1, 1).when(torn, 0).when(F.col("_before").isNull() | (F.col("_before") < F.col("_ord")), 1).otherwise(0)
    e = e.withColumn("_stretch", F.sum(begins).over(in_order.rowsBetween(Window.unboundedPreceding, 0)))
    seed = F.min(F.when(F.col("_idd"), F.col("id").cast("long"))).over(Window.partitionBy("_k", "_stretch"))
    e = e.withColumn("_seed", seed).withColumn("_ok", F.col("_kx") | F.col("_ok")).withColumn("_kok", F.col("_kx") | F.col("_all_ok"))
    return e.drop("_until", "_before", "_row", "_stretch", "_all_ok", "_some_ok")


_OUTCOME = "status string, reason string, category string"


def _in_groups(events: DataFrame) -> DataFrame:
    """``events`` of :func:`_seeds` with their outcome (null for existing rows).

    Dirty ids that share a stretch are tied; all events of tied ids form a group.  A group of
    at most ``REPLAY_ROWS`` is replayed in order by one task, which takes its groups one after
    the other; a larger one is settled in rounds (:func:`_in_rounds`).  Here each stretch that
    lets its key in first says "inserted": the caller keeps that for the key's first one.
    """
    alone = events.filter("_seed IS NULL")
    rejected = ~F.col("_kok")
    alone = alone.withColumn("status", F.when(~F.col("_e"), F.when(rejected, "rejected").otherwise("updated")))
    alone = alone.withColumn("reason", F.when(rejected, F.col("_fkr"))).withColumn("category", F.when(rejected, F.lit("fk")))
    tied = events.filter("_seed IS NOT NULL")
    ties = cached(tied.filter("_idd AND id <> _seed").select(F.col("id").cast("long").alias("a"), F.col("_seed").alias("b")).distinct())
    if ties.limit(1).count():
        roots = bounded_broadcast(connected_components(ties).select(F.col("node").alias("_seed"), F.col("root").alias("_group")))
        tied = tied.join(roots, "_seed", "left").withColumn("_group", F.coalesce("_group", "_seed"))
    else:
        tied = tied.withColumn("_group", F.col("_seed"))
    large = cached(tied.groupBy("_group").count().filter(F.col("count") > REPLAY_ROWS).select("_group"))
    some_large = large.limit(1).count() > 0
    large = bounded_broadcast(large)
    small = tied.join(large, "_group", "left_anti") if some_large else tied
    small = small.repartition("_group").sortWithinPartitions("_group", "_ord").withColumn("_key", F.to_json("_k"))
    fields = [f for f in small.schema.fields if f.name not in ("_key", "_group")]
    out = T.StructType(fields + T.StructType.fromDDL(_OUTCOME).fields)
    small = small.mapInArrow(_replay_groups, out)
    done = alone.unionByName(small)
    if some_large:
        done = done.unionByName(_in_rounds(tied.join(large, "_group", "left_semi").drop("_group")))
    return done


def _replay_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sequential replay of events sorted by group and order (existing rows first); one group's two dicts are held.

    A plain state machine: key -> id, id -> key.
    """
    group, by_key, owner = None, {}, {}
    for batch in batches:
        out = []
        for g, k, i, old, ok, fkr in zip(*(batch.column(c).to_pylist() for c in ("_group", "_key", "id", "_e", "_ok", "_fkr"))):
            if g != group:
                group, by_key, owner = g, {}, {}
            holder = owner.get(i)
            if old:
                out.append((None, None, None))
            elif holder is not None and holder != k:
                out.append(("rejected", "Duplicate key violation: id=%d" % i, "unique"))
                continue
            elif k not in by_key and not ok:
                out.append(("rejected", fkr, "fk"))
                continue
            else:
                out.append(("updated" if k in by_key else "inserted", None, None))
            owner.pop(by_key.get(k), None)
            if i is not None:
                owner[i] = k
            by_key[k] = i
        names = [c for c in batch.schema.names if c not in ("_key", "_group")]
        found = [pa.array([o[j] for o in out], pa.string()) for j in range(3)]
        yield pa.RecordBatch.from_arrays([batch.column(c) for c in names] + found, names=[*names, "status", "reason", "category"])


def _in_rounds(events: DataFrame) -> DataFrame:
    """Outcome of the events of large groups: rounds over the rows that can conflict."""
    dirty_inc = (
        events.filter("NOT _e")
        .repartitionByRange("_k", "_ord")
        .withColumn("_src", F.monotonically_increasing_id())
        .withColumn("_slice", F.spark_partition_id())
    )
    dirty_inc = _written(dirty_inc, "conflicts")  # fixes _src and _slice for the joins back below
    kept, middle = _compress_clean_runs(dirty_inc)
    key = F.to_json("_k").alias("_k")
    held = events.filter("_e")
    rep_status, _ = _resolve(
        kept.select(key, F.col("id").cast("long").alias("id"), "_ok", "_fkr", "_src", "_ord"),
        held.select(key, F.col("id").cast("long").alias("id"), F.lit(-1).cast("long").alias("_src")),
    )
    settled = dirty_inc.join(rep_status, "_src")
    # rows left out of the rounds: their key exists after the first row of their run, or
    # that first row failed its FK check (the key is new) and so do they
    first_st = rep_status.select("_src", "status").join(kept.filter(F.col("_runfirst")).select("_src", "_k", "_run"), "_src").select(
        "_k", "_run", F.col("status").alias("_fst")
    ).dropDuplicates(["_k", "_run"])
    m_rej = F.col("_fst") == "rejected"
    m = middle.join(first_st, ["_k", "_run"]).withColumns({
        "status": F.when(m_rej, F.lit("rejected")).otherwise(F.lit("updated")),
        "reason": F.when(m_rej, F.col("_fkr")),
        "category": F.when(m_rej, F.lit("fk")),
    })
    nothing = {c: F.lit(None).cast("string") for c in ("status", "reason", "category")}
    names = [*events.columns, *nothing]
    return settled.select(*names).unionByName(m.select(*names)).unionByName(held.withColumns(nothing).select(*names))


def _compress_clean_runs(dirty_inc: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split the rows of dirty keys into those the rounds need and the rest.

    A row whose id is clean (owned by this key only) can never be a unique
    violation; between two rows with dirty ids of the same key, only the first
    clean row (it frees the key's previous id) and the last one (the key's id
    from then on) can matter to other keys.  So per key every run of clean rows
    is cut to its first and last row: the rounds grow with the conflicting
    rows, not with how often a key repeats.  A run's number is how many dirty rows of
    its key come before it: counted inside each slice of the rows (``_slice``, cut by key
    and ordinal, so a hot key spans many), plus the counts of the key's earlier slices.
    """
    dirty = F.col("_idd").cast("long")
    slices = dirty_inc.groupBy("_k", "_slice").agg(F.sum(dirty).alias("_n"))
    earlier = Window.partitionBy("_k").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = slices.select("_k", "_slice", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    inside = F.sum(dirty).over(Window.partitionBy("_k", "_slice").orderBy("_ord").rowsBetween(Window.unboundedPreceding, 0))
    rows = dirty_inc.withColumn("_inside", inside).join(slices, ["_k", "_slice"])
    rows = rows.withColumn("_run", F.col("_before") + F.col("_inside")).drop("_before", "_inside")
    dirty_rows, clean = rows.filter("_idd"), rows.filter("NOT _idd")
    ends = clean.groupBy("_k", "_run").agg(F.min("_ord").alias("_rfirst"), F.max("_ord").alias("_rlast"))
    clean = clean.join(ends, ["_k", "_run"])
    is_first = F.col("_ord") == F.col("_rfirst")
    is_end = is_first | (F.col("_ord") == F.col("_rlast"))
    kept_clean = clean.filter(is_end).withColumn("_runfirst", is_first).drop("_rfirst", "_rlast")
    middle = clean.filter(~is_end).drop("_rfirst", "_rlast")
    kept = dirty_rows.withColumn("_run", F.lit(-1).cast("long")).withColumn("_runfirst", F.lit(False)).unionByName(kept_clean)
    return kept, middle
