"""Placeholder parent rows (FKR-2..7): template literals over a DataFrame of ids.

A template is a set of literals; the only per-row values are the id (and the
sha1 derived from it).  ``as_of`` stands for the database's NOW() so results
are reproducible.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import DOCKET_SENTINEL
from ..specs import CLUSTER, OPINION, PARENTHETICAL

# Fixed template values of the placeholder rows (T1..T7).  Columns not listed
# take '' for text, false for booleans, 0 for counts and NULL when nullable.
T1_CLUSTER = {  # cluster created by the opinion load
    "judges": "",
    "case_name_short": "NA",
    "case_name": "NA",
    "case_name_full": "NA",
    "source": "NA",
    "precedential_status": "Unknown",
    "docket_id": DOCKET_SENTINEL,
    "date_filed": "__as_of_date__",
}
T2_CLUSTER = {  # cluster created by the panel load
    "judges": "PLACEHOLDER",
    "date_filed": "1900-01-01",
    "case_name_short": "PLACEHOLDER",
    "case_name": "PLACEHOLDER",
    "case_name_full": "PLACEHOLDER",
    "source": "R",
    "precedential_status": "Unknown",
    "docket_id": 1,
}
T3_CLUSTER = {  # cluster created by the reporter-citation load; also cluster 1
    "judges": "",
    "date_filed": "0001-01-01",
    "case_name_short": "Placeholder",
    "case_name": "Placeholder Case",
    "case_name_full": "Placeholder Case",
    "source": "C",
    "precedential_status": "Published",
    "docket_id": 1,
}
T4_OPINION = {"type": "010", "sha1": "__placeholder_sha1__", "cluster_id": 1, "download_url": ""}
T5_OPINION = {"type": "010", "sha1": "__placeholder_sha1__", "cluster_id": 1, "download_url": None}
T6_GROUP = {"score": 0.0, "size": 0, "opinion_id": 1, "representative_id": 1}
T6B_PARENTHETICAL = {
    "id": 1,
    "text": "PLACEHOLDER",
    "score": 0.0,
    "described_opinion_id": 1,
    "describing_opinion_id": 1,
    "group_id": 1,
}
# Fixed column names of the docket table.
T7_DOCKET_COLUMNS = (
    "id",
    "date_created",
    "date_modified",
    "case_name_short",
    "case_name",
    "case_name_full",
    "slug",
    "docket_number",
    "blocked",
    "court_id",
    "cause",
    "filepath_ia",
    "filepath_local",
    "jurisdiction_type",
    "jury_demand",
    "nature_of_suit",
    "pacer_case_id",
    "source",
    "assigned_to_str",
    "referred_to_str",
    "view_count",
    "appeal_from_str",
    "appellate_case_type_information",
    "appellate_fee_status",
    "panel_str",
    "mdl_status",
    "filepath_ia_json",
    "docket_number_core",
    "federal_dn_case_type",
    "federal_dn_judge_initials_assigned",
    "federal_dn_judge_initials_referred",
    "federal_dn_office_code",
)
T7_DOCKET = {
    "case_name_short": "PLACEHOLDER",
    "case_name": "PLACEHOLDER",
    "case_name_full": "PLACEHOLDER",
    "slug": "placeholder-max",
    "blocked": False,
    "court_id": "scotus",
    "pacer_case_id": None,
    "source": 0,
    "view_count": 0,
}

CLUSTER_TEMPLATES = {"T1": T1_CLUSTER, "T2": T2_CLUSTER, "T3": T3_CLUSTER}
OPINION_TEMPLATES = {"T4": T4_OPINION, "T5": T5_OPINION}
GROUP_COLUMNS = (("id", "int"), ("score", "double"), ("size", "int"), ("opinion_id", "int"), ("representative_id", "int"))

_SQL_TYPE = {
    "int": "int",
    "int_opt": "int",
    "bool": "boolean",
    "double": "double",
    "ts": "timestamp",
    "date": "date",
    "date_opt": "date",
}


def _as_of_lit(as_of: dt.datetime) -> Column:
    return F.lit(as_of).cast("timestamp")


def _spec_row(spec, values: dict, id_col: Column, as_of: dt.datetime) -> list[Column]:
    out = []
    for c in spec.columns:
        typ = _SQL_TYPE.get(c.kind, "string")
        if c.name == "id":
            v = id_col.cast("int")
        elif c.name in ("date_created", "date_modified"):
            v = _as_of_lit(as_of)
        elif c.name in values:
            raw = values[c.name]
            if raw == "__as_of_date__":
                v = F.lit(as_of.date())
            elif raw == "__placeholder_sha1__":
                v = F.concat(F.lit("PLACEHOLDER_"), id_col.cast("string"))
            else:
                v = F.lit(raw)
        elif not c.not_null:
            v = F.lit(None)
        elif typ == "boolean":
            v = F.lit(False)
        elif typ in ("int", "double"):
            v = F.lit(0)
        else:
            v = F.lit("")
        out.append(v.cast(typ).alias(c.name))
    return out


def cluster_rows(ids: DataFrame, template: str, as_of: dt.datetime) -> DataFrame:
    """Placeholder clusters (T1/T2/T3) for a one-column DataFrame ``id``."""
    return ids.select(*_spec_row(CLUSTER, CLUSTER_TEMPLATES[template], F.col("id"), as_of))


def opinion_rows(ids: DataFrame, template: str, as_of: dt.datetime) -> DataFrame:
    """Placeholder opinions (T4/T5) for a one-column DataFrame ``id``."""
    return ids.select(*_spec_row(OPINION, OPINION_TEMPLATES[template], F.col("id"), as_of))


def group_rows(ids: DataFrame) -> DataFrame:
    """Placeholder parenthetical groups (T6)."""
    cols = [F.col("id").cast("int").alias("id")]
    cols += [F.lit(T6_GROUP[n]).cast(t).alias(n) for n, t in GROUP_COLUMNS[1:]]
    return ids.select(*cols)


def docket_rows(ids: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Placeholder dockets (T7; docket 1 reuses it)."""
    cols = []
    for n in T7_DOCKET_COLUMNS:
        if n == "id":
            v = F.col("id").cast("int")
        elif n in ("date_created", "date_modified"):
            v = _as_of_lit(as_of)
        elif n in T7_DOCKET:
            raw = T7_DOCKET[n]
            v = F.lit(raw).cast("string") if raw is None else F.lit(raw)
            if n in ("source",):
                v = v.cast("smallint")
            elif n == "view_count":
                v = v.cast("int")
            elif n == "pacer_case_id":
                v = v.cast("int")
        else:
            v = F.lit("")
        cols.append(v.alias(n))
    return ids.select(*cols)


def base_parenthetical_row(spark: SparkSession) -> DataFrame:
    """The base parenthetical of the circular trio (T6b)."""
    return spark.range(1).select(
        *[F.lit(T6B_PARENTHETICAL[c.name]).cast(_SQL_TYPE.get(c.kind, "string")).alias(c.name) for c in PARENTHETICAL.columns]
    )
