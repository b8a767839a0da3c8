"""Load jobs (PIP-1..7): dump text -> target table state, rejects, placeholders, report.

Plan of every job (Spark stages in brackets):

  text scan -> record assembly [shuffle by split, multi-line only]
  -> split + coerce + validate [narrow]
  -> FK presence per distinct FK value [small; broadcast when under the bound]
  -> conflict rule per key [partial aggregate + join back]
  -> placeholder parents = distinct missing ids x template literals
  -> new target state (returned as a DataFrame; sinks write it)

Placeholder repair follows the static parent DAG docket -> cluster -> opinion
-> group -> parenthetical; every missing parent is repaired in one pass,
independently of row order (D8).  Whether a template *can* be created depends
on a few fixed parent rows (docket 1 / 2147483647, cluster 1, group 1); those
are single-id existence checks.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import DOCKET_SENTINEL, null_to_empty, score6
from ..operators import placeholders as PH
from ..operators.fk import distinct_missing, parent_keys, with_presence
from ..operators.project import ORDINAL, parse_records
from ..operators.upsert import Upserted, upsert_ignore, upsert_last, upsert_natural, upsert_partial
from ..operators import report as R
from ..sinks import bad_records_raw, bad_records_typed, write_csv
from ..sources.assemble import Dump, check_files, preview, read_dump, read_first
from ..specs import CLUSTER, OPINION, TableSpec
from .caching import Caches, cached
from .joins import shuffled

DEFAULT_AS_OF = dt.datetime(2026, 1, 1, 0, 0, 0)

# Which template repairs which parent table.
_TEMPLATE_PARENT = {
    "T1": "search_opinioncluster",
    "T2": "search_opinioncluster",
    "T3": "search_opinioncluster",
    "T4": "search_opinion",
    "T5": "search_opinion",
    "T6": "search_parentheticalgroup",
}


@dataclass
class LoadResult:
    target: DataFrame  # new state of the loaded table
    outcomes: DataFrame  # one row per parsed record: ordinal, status, reason, category
    rejects: DataFrame  # rejected records: ordinal, raw, typed columns, reason, category
    placeholders: dict[str, DataFrame] = field(default_factory=dict)  # parent table -> new rows
    placeholder_ids: DataFrame | None = None  # parent, id (FKR-7)
    demands: DataFrame | None = None  # parent, id, and the first record that made it necessary
    batch: int = R.DEFAULT_BATCH
    caches: Caches = field(default_factory=Caches)

    def batch_report(self) -> DataFrame:
        """AGG-1: counters of each batch, with the placeholders that its records were the first to need."""
        return R.batch_report(self.outcomes, self.batch, self.demands)

    def totals(self) -> DataFrame:
        """AGG-3: run totals, with all placeholders created."""
        return R.totals(self.outcomes, self.placeholder_ids)

    def release(self) -> None:
        """Drop what the load cached; call it once the results are written."""
        self.caches.release()

    def parent_state(self, name: str, parent: DataFrame) -> DataFrame:
        """SET-1: the parent table after the repair: its rows and the placeholders it lacks, columns by name."""
        made = self.placeholders.get(name)
        if made is None:
            return parent
        made = made.join(parent.select("id"), "id", "left_anti")
        return parent.unionByName(made.select(*[c for c in parent.columns if c in made.columns]), allowMissingColumns=True)


def _exists(keys: DataFrame | None, ident: int) -> bool:
    if keys is None:
        return True  # no parent set given: assumed present
    return keys.filter(F.col("id") == ident).limit(1).count() > 0


class _Parents:
    """Key sets of the parent tables plus the fixed-row existence facts."""

    def __init__(self, parents: Mapping[str, DataFrame] | None, create_docket: bool):
        self.keys = {n: parent_keys(df) for n, df in (parents or {}).items()}
        self.create_docket = create_docket
        self._memo: dict[tuple[str, int], bool] = {}

    def get(self, name: str) -> DataFrame | None:
        return self.keys.get(name)

    def exists(self, name: str, ident: int) -> bool:
        k = (name, ident)
        if k not in self._memo:
            self._memo[k] = _exists(self.keys.get(name), ident)
        return self._memo[k]

    def docket_ok(self, ident: int) -> bool:
        return self.create_docket or self.exists("search_docket", ident)

    def creatable(self, template: str) -> bool:
        if template == "T1":
            return self.docket_ok(DOCKET_SENTINEL)
        if template in ("T2", "T3"):
            return self.docket_ok(1)
        if template == "T4":  # ensures cluster 1 (T3) first
            return self.exists("search_opinioncluster", 1) or self.docket_ok(1)
        if template == "T5":  # assumes cluster 1
            return self.exists("search_opinioncluster", 1)
        if template == "T6":  # base trio is written with checks off
            return True
        raise ValueError(template)


def _ordinal(parsed: DataFrame) -> Column:
    """The place in the dump where assembly gave one number, else file, record and line."""
    return F.col("_pos") if "_pos" in parsed.columns else F.struct(*[F.col(c) for c in ORDINAL])


def _fk_stage(valid: DataFrame, spec: TableSpec, parents: _Parents, on_missing: str):
    """Presence flags, ``_ok`` and ``_fkr``; in reject mode also the pre-rejected rows (FKR-1)."""
    checks = []
    for fk in spec.fks:
        flag = f"_has_{fk.column}"
        valid = with_presence(valid, fk.column, parents.get(fk.parent), flag)
        checks.append((fk, flag))
    pre_rejected = None
    if on_missing == "reject":
        bad = None
        reason = None
        for fk, flag in checks:
            if fk.repair is None:
                continue
            miss = ~F.col(flag)
            bad = miss if bad is None else (bad | miss)
            r = F.when(miss, F.format_string(f"FK violation: {fk.column}=%s not found in {fk.parent}", F.col(fk.column).cast("string")))
            reason = r if reason is None else F.coalesce(reason, r)
        if bad is not None:
            pre_rejected = valid.filter(bad).withColumn("reason", reason).withColumn("category", F.lit("fk"))
            valid = valid.filter(~bad)
    ok = F.lit(True)
    fkr = None
    repaired = F.lit(False)  # a placeholder is created for this row before its retry
    for fk, flag in checks:
        if fk.repair is not None and on_missing == "placeholder":
            if parents.creatable(fk.repair):
                repaired = repaired | ~F.col(flag)
                continue
            msg = f"FK violation, failed to create placeholder: {fk.column}=%s not found in {fk.parent}"
        else:
            msg = f"FK violation: {fk.column}=%s not found in {fk.parent}"
        ok = ok & F.col(flag)
        r = F.when(~F.col(flag), F.format_string(msg, F.col(fk.column).cast("string")))
        fkr = r if fkr is None else F.coalesce(fkr, r)
    if fkr is not None:
        # AGG-5: the repairable parent was created, the retry failed on another FK
        fkr = F.when(repaired, F.concat(F.lit("FK violation, placeholder created but retry failed: "), fkr)).otherwise(fkr)
    valid = valid.withColumn("_ok", ok).withColumn("_fkr", fkr if fkr is not None else F.lit(None).cast("string"))
    return valid, checks, pre_rejected


def _demand(rows: DataFrame, status: DataFrame, spec: TableSpec) -> DataFrame:
    """Rows whose write reaches the FK check, and so demand their missing repairable parents.

    Inserts (and, for the full-row and natural-key rules, updates) that
    succeeded, plus rows rejected at the FK check itself: the original created
    the placeholder before the retry that failed.  No-ops, parse failures and
    unique violations never reach the check.  For rules that do not name these
    rows themselves (``Upserted.reached``).
    """
    st = ["inserted"] if spec.upsert in ("ignore", "partial") else ["inserted", "updated"]
    reached = status.filter(
        F.col("status").isin(*st) | ((F.col("status") == "rejected") & (F.col("category") == "fk"))
    ).select("_ord")
    return rows.join(reached, "_ord", "left_semi")


def _first_demands(demand: DataFrame, spec: TableSpec, parents: _Parents) -> DataFrame | None:
    """Parent, missing id, and the place of the first record that needs it (AGG-1): a minimum per id, then one join back."""
    by_parent: dict[str, list[str]] = {}
    for fk in spec.fks:
        if fk.repair is not None and parents.get(fk.parent) is not None and parents.creatable(fk.repair):
            by_parent.setdefault(fk.parent, []).append(fk.column)
    out = None
    for parent, cols in by_parent.items():
        ids = None
        for c in cols:
            part = demand.select(F.col(c).cast("int").alias("id"), "_ord").filter(F.col("id").isNotNull())
            ids = part if ids is None else ids.unionByName(part)
        first = ids.groupBy("id").agg(F.min("_ord").alias("_ord")).join(shuffled(parents.get(parent)), "id", "left_anti")
        part = first.join(demand.select("_ord", *ORDINAL), "_ord").select(F.lit(parent).alias("parent"), "id", *ORDINAL)
        out = part if out is None else out.unionByName(part)
    return out


def _placeholders(
    spark: SparkSession, spec: TableSpec, demand: DataFrame, checks, parents: _Parents, as_of: dt.datetime
) -> dict[str, DataFrame]:
    """Placeholder rows per parent table for every missing repairable parent (FKR-2..6)."""
    out: dict[str, list[DataFrame]] = {}
    by_template: dict[str, list[str]] = {}
    for fk, _flag in checks:
        if fk.repair is not None and parents.creatable(fk.repair):
            by_template.setdefault(fk.repair, []).append(fk.column)
    ids_by_template: dict[str, DataFrame] = {}
    for tpl, cols in by_template.items():
        parent = _TEMPLATE_PARENT[tpl]
        ids = cached(distinct_missing(demand, cols, parents.get(parent)))
        ids_by_template[tpl] = ids
        if tpl in ("T1", "T2", "T3"):
            rows = PH.cluster_rows(ids, tpl, as_of)
        elif tpl in ("T4", "T5"):
            rows = PH.opinion_rows(ids, tpl, as_of)
        else:
            rows = PH.group_rows(ids)
        out.setdefault(parent, []).append(rows)
        # transitive parents (FKR-5/6): fixed rows added once when any placeholder exists
        # id 1 exactly when at least one placeholder of this template exists
        one = ids.limit(1).select(F.lit(1).cast("int").alias("id"))
        if tpl == "T4" and not parents.exists("search_opinioncluster", 1):
            out.setdefault("search_opinioncluster", []).append(PH.cluster_rows(one, "T3", as_of))
        if tpl == "T6" and not parents.exists("search_parentheticalgroup", 1):
            base_op = PH.opinion_rows(one, "T5", as_of)
            if not parents.exists("search_opinion", 1):
                out.setdefault("search_opinion", []).append(base_op)
            out.setdefault("search_parentheticalgroup", []).append(PH.group_rows(one))
    if parents.create_docket:
        for d, tpls in ((DOCKET_SENTINEL, ("T1",)), (1, ("T2", "T3", "T4"))):
            if parents.exists("search_docket", d):
                continue
            need = [ids_by_template[t].limit(1) for t in tpls if t in ids_by_template]
            if need:
                anyone = need[0]
                for extra in need[1:]:
                    anyone = anyone.unionByName(extra)
                one = anyone.limit(1).select(F.lit(d).cast("int").alias("id"))
                out.setdefault("search_docket", []).append(PH.docket_rows(one, as_of))
    merged = {}
    for parent, dfs in out.items():
        df = dfs[0]
        for extra in dfs[1:]:
            df = df.unionByName(extra)
        merged[parent] = df.dropDuplicates(["id"])
    return merged


def load(
    spark: SparkSession,
    spec: TableSpec,
    source: str | Sequence[str] | Dump,
    *,
    existing: DataFrame | Callable[[DataFrame], DataFrame | None] | None = None,
    parents: Mapping[str, DataFrame] | None = None,
    on_missing_parent: str = "placeholder",
    as_of: dt.datetime = DEFAULT_AS_OF,
    create_docket: bool = False,
    strict: bool = True,
    assembly: str | None = None,
    score_precision: int | None = 6,
    limit: int | None = None,
    parse_only: bool = False,
    batch: int = R.DEFAULT_BATCH,
    bad_records: str | None = None,
    keep_status: bool = False,
) -> LoadResult:
    """Load one dump into the new state of ``spec``'s table.

    ``existing`` is the table's state, or a function that takes the rows which passed
    parsing and returns the part of the state that they can change or collide with;
    ``target`` is then the new state of that part.

    ``source`` is a path/list of paths of dump files or an already assembled
    :class:`Dump`.  ``parents`` maps parent table names (``search_opinion``,
    ``search_opinioncluster``, ``search_docket``, ``people_db_person``,
    ``search_parentheticalgroup``) to DataFrames with an ``id`` column; a parent
    not given is not checked.  ``on_missing_parent`` is ``placeholder`` (create
    template parents, the implemented behaviour) or ``reject`` (the documented
    one).  Nothing is written (see :mod:`relload.sinks`) but the rejected records, as CSV
    to the folder ``bad_records`` if one is given.

    ``limit`` loads the first records in file order only, reading little more of the
    files than they take; ``parse_only`` stops after parsing and validation: ``target``
    is then the rows that passed (status ``parsed``).  ``batch`` is the size of the
    report's batches.  ``keep_status`` caches the status of the records, for a caller that
    writes outcomes, rejects and placeholders.
    """
    with Caches() as caches:
        mode = assembly or spec.assembly
        if not isinstance(source, Dump):
            check_files(spark, source, spec.name)
            source = read_dump(spark, source, mode) if limit is None else read_first(spark, source, mode, limit)
        elif limit is not None:
            source = Dump(preview(source.records, limit), source.headers)
        result = _load(spark, spec, source, existing, parents, on_missing_parent, as_of, create_docket, strict, score_precision, parse_only, keep_status)
        if bad_records is not None:  # the original writes raw records for clusters, typed ones for all others
            rows = bad_records_raw(result.rejects) if spec.name == CLUSTER.name else bad_records_typed(result.rejects, spec.names)
            write_csv(rows, bad_records)
    result.batch, result.caches = batch, caches
    return result


def _load(spark, spec, source, existing, parents, on_missing_parent, as_of, create_docket, strict, score_precision, parse_only, keep_status=False) -> LoadResult:
    if on_missing_parent not in ("placeholder", "reject"):
        raise ValueError(on_missing_parent)
    if score_precision not in (None, 6):
        raise ValueError("score_precision is 6 (the original's text form) or None (as parsed)")
    P = _Parents(parents, create_docket)
    parsed = parse_records(source, spec, strict=strict)
    # The raw text is only needed for rows that fail parsing (SNK-3); dropping it
    # elsewhere halves what is cached for wide dumps.
    parsed = parsed.withColumn("raw", F.when(F.col("category").isNotNull(), F.col("raw")))
    if spec.name == "search_parenthetical" and score_precision == 6:
        parsed = parsed.withColumn("score", score6("score"))  # once, before the cache
    parsed = cached(parsed.withColumn("_ord", _ordinal(parsed)).drop("_pos"))
    # Fill the cache in one job: every later branch (FK lookups, conflict rule,
    # rejects, outcomes) reads it, and concurrent branches would otherwise each
    # re-parse the dump while the cache is still empty.
    parsed.count()
    cols = spec.names
    bad = parsed.filter(F.col("category").isNotNull())
    if parse_only:
        status = F.when(F.col("category").isNull(), F.lit("parsed")).otherwise(F.lit("rejected")).alias("status")
        outcomes = parsed.select(*ORDINAL, status, "reason", "category")
        return LoadResult(parsed.filter(F.col("category").isNull()).select(*cols), outcomes, bad.drop("reasons", "_ord"))
    valid = parsed.filter(F.col("category").isNull())
    valid, checks, pre_rejected = _fk_stage(valid, spec, P, on_missing_parent)

    # base parenthetical (T6b) acts as an existing row when the base trio is created (D10)
    ex = existing(valid.select(*cols)) if callable(existing) else existing
    base_trio = False
    if spec.name == "search_parenthetical" and on_missing_parent == "placeholder":
        group_flag = [flag for fk, flag in checks if fk.parent == "search_parentheticalgroup"]
        if group_flag and not P.exists("search_parentheticalgroup", 1):
            base_trio = valid.filter(~F.col(group_flag[0])).limit(1).count() > 0
        if base_trio:
            base = PH.base_parenthetical_row(spark)
            ex = base if ex is None else ex.select(*cols).unionByName(base.join(ex.select("id"), "id", "left_anti"))

    rows = valid.select(*cols, *ORDINAL, "_ord", "_ok", "_fkr", *[f for _, f in checks])
    if spec.upsert == "ignore":
        up: Upserted = upsert_ignore(rows, ex, cols)
    elif spec.upsert == "partial":
        up = upsert_partial(rows, ex, cols, spec.update_cols)
    elif spec.upsert == "last":
        up = upsert_last(rows, ex, cols)
    elif spec.upsert == "natural":
        up = upsert_natural(rows, ex, cols, spec.natural_key, spec.update_cols)
    else:  # pragma: no cover
        raise ValueError(spec.upsert)

    status = cached(up.status) if keep_status else up.status
    kept = ["_ord", *ORDINAL, F.lit("rejected").alias("status"), "reason", "category"]
    every = status.unionByName(bad.select(*kept))
    if pre_rejected is not None:
        every = every.unionByName(pre_rejected.select(*kept))
    outcomes = every.drop("_ord")

    placeholders, demands = {}, None
    if on_missing_parent == "placeholder":
        demand = _demand(rows, status, spec) if up.reached is None else up.reached
        placeholders = _placeholders(spark, spec, demand, checks, P, as_of)
        demands = _first_demands(demand, spec, P)
    ids = None
    for parent, df in placeholders.items():
        part = df.select(F.lit(parent).alias("parent"), F.col("id"))
        ids = part if ids is None else ids.unionByName(part)

    target = up.target
    if spec.name == OPINION.name:
        target = target.withColumn("download_url", null_to_empty("download_url"))  # SCL-8
    why = every.filter(F.col("status") == "rejected").select("_ord", "reason", "category")
    rejects = parsed.drop("reason", "category", "reasons").join(why, "_ord").drop("_ord")
    return LoadResult(target, outcomes, rejects, placeholders, ids, demands)
