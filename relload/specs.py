"""Table specifications: columns, coercions, limits, keys, foreign keys, upsert rule.

One spec drives the whole load of a table: the projection (PRJ-4), the
row-local validation (VAL-*), the foreign-key checks and placeholder repair
(JON-*, FKR-*) and the conflict rule (UPS-*).
"""

from __future__ import annotations

from dataclasses import dataclass

# Column kinds (the coercion applied to the split text):
#   int        SCL-3  digit prefix, default 0
#   int_opt    SCL-4  NULL when blank/unparsable, 64-bit parse narrowed to 32 bits
#   bool       SCL-5
#   double     SCL-6  decimal prefix, default 0.0
#   str        raw field text ('' when the column is absent)
#   str_trim   C-trimmed text
#   str_ptrim  text trimmed of space/tab/CR/LF (parenthetical reader)
#   url        raw text, blank -> NULL (SCL-7), written as '' (SCL-8)
#   str_opt    trimmed text, blank -> NULL (SCL-7)
#   ts         TIMESTAMP cast at write (SCL-10)
#   date       DATE cast at write (SCL-10)
#   date_opt   trimmed, blank -> NULL, then DATE cast


@dataclass(frozen=True)
class Col:
    name: str
    kind: str
    max_len: int | None = None  # VAL-6 varchar limit
    not_null: bool = True  # VAL-7


@dataclass(frozen=True)
class FK:
    column: str
    parent: str  # parent table name (key column is always ``id``)
    repair: str | None = None  # placeholder template name, None = hard FK


@dataclass(frozen=True)
class TableSpec:
    name: str
    columns: tuple[Col, ...]
    dialect: str  # L, T or E
    assembly: str  # single, parity, pattern, parity_pattern, resync, skip3
    upsert: str  # ignore, partial, last, natural
    min_columns: int = 0  # VAL-3 (0 = no check)
    key_rule: str | None = None  # VAL-4: 'le0' rejects id <= 0, 'eq0' rejects id == 0
    required: tuple[str, ...] = ()  # SRC-7 header check and VAL-5 per-row presence
    natural_key: tuple[str, ...] = ()  # UPS-4/5 conflict target
    update_cols: tuple[str, ...] = ()  # columns a conflict rewrites (UPS-2/4/5)
    fks: tuple[FK, ...] = ()
    validate_opinion_row: bool = False  # VAL-1/VAL-2
    docket_sentinel: bool = False  # SCL-11 on docket_id

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]

    def col(self, name: str) -> Col:
        for c in self.columns:
            if c.name == name:
                return c
        raise KeyError(name)


S = "str"

OPINION = TableSpec(
    name="search_opinion",
    columns=(
        Col("id", "int"),
        Col("date_created", "ts"),
        Col("date_modified", "ts"),
        Col("type", S),
        Col("sha1", S),
        Col("download_url", "url", not_null=False),
        Col("local_path", S),
        Col("plain_text", S),
        Col("html", S),
        Col("html_lawbox", S),
        Col("html_columbia", S),
        Col("html_with_citations", S),
        Col("extracted_by_ocr", "bool"),
        Col("author_id", "int_opt", not_null=False),
        Col("cluster_id", "int"),
        Col("per_curiam", "bool"),
        Col("page_count", "int_opt", not_null=False),
        Col("author_str", S),
        Col("joined_by_str", S),
        Col("xml_harvard", S),
        Col("html_anon_2020", S),
        Col("ordering_key", "int_opt", not_null=False),
        Col("main_version_id", "int_opt", not_null=False),
    ),
    dialect="L",
    assembly="resync",  # body lines inside quotes are no records, a stray quote stays in its own
    upsert="ignore",
    required=("id", "date_created"),
    fks=(FK("cluster_id", "search_opinioncluster", "T1"), FK("author_id", "people_db_person")),
    validate_opinion_row=True,
)

_CLUSTER_COLS = (
    Col("id", "int"),
    Col("judges", "str_trim"),
    Col("date_created", "ts"),
    Col("date_modified", "ts"),
    Col("date_filed", "date"),
    Col("slug", "str_opt", max_len=75, not_null=False),
    Col("case_name_short", "str_trim"),
    Col("case_name", "str_trim"),
    Col("case_name_full", "str_trim"),
    Col("scdb_id", "str_trim", max_len=10),
    Col("source", "str_trim", max_len=10),
    Col("procedural_history", "str_trim"),
    Col("attorneys", "str_trim"),
    Col("nature_of_suit", "str_trim"),
    Col("posture", "str_trim"),
    Col("syllabus", "str_trim"),
    Col("citation_count", "int"),
    Col("precedential_status", "str_trim", max_len=50),
    Col("date_blocked", "date_opt", not_null=False),
    Col("blocked", "bool"),
    Col("docket_id", "int"),
    Col("scdb_decision_direction", "int_opt", not_null=False),
    Col("scdb_votes_majority", "int_opt", not_null=False),
    Col("scdb_votes_minority", "int_opt", not_null=False),
    Col("date_filed_is_approximate", "bool"),
    Col("correction", "str_trim"),
    Col("cross_reference", "str_trim"),
    Col("disposition", "str_trim"),
    Col("filepath_json_harvard", "str_trim", max_len=1000),
    Col("headnotes", "str_trim"),
    Col("history", "str_trim"),
    Col("other_dates", "str_trim"),
    Col("summary", "str_trim"),
    Col("arguments", "str_trim"),
    Col("headmatter", "str_trim"),
    Col("filepath_pdf_harvard", "str_trim", max_len=100),
)

CLUSTER = TableSpec(
    name="search_opinioncluster",
    columns=_CLUSTER_COLS,
    dialect="L",
    assembly="skip3",
    upsert="ignore",
    min_columns=21,
    key_rule="le0",
    required=("id",),
    fks=(FK("docket_id", "search_docket"),),
    docket_sentinel=True,
)

PANEL = TableSpec(
    name="search_opinioncluster_panel",
    columns=(Col("id", "int"), Col("opinioncluster_id", "int"), Col("person_id", "int")),
    dialect="T",
    assembly="single",
    upsert="natural",
    min_columns=3,
    key_rule="eq0",
    required=("id", "opinioncluster_id", "person_id"),
    natural_key=("opinioncluster_id", "person_id"),
    update_cols=("id",),
    fks=(FK("opinioncluster_id", "search_opinioncluster", "T2"), FK("person_id", "people_db_person")),
)

JOINED_BY = TableSpec(
    name="search_opinion_joined_by",
    columns=(Col("id", "int"), Col("opinion_id", "int"), Col("person_id", "int")),
    dialect="T",
    assembly="single",
    upsert="natural",
    min_columns=3,
    key_rule="eq0",
    required=("id", "opinion_id", "person_id"),
    natural_key=("opinion_id", "person_id"),
    update_cols=("id",),
    fks=(FK("opinion_id", "search_opinion", "T4"), FK("person_id", "people_db_person")),
)

CITED = TableSpec(
    name="search_opinionscited",
    columns=(Col("id", "int"), Col("depth", "int"), Col("cited_opinion_id", "int"), Col("citing_opinion_id", "int")),
    dialect="T",
    assembly="single",
    upsert="partial",
    min_columns=4,
    key_rule="eq0",
    required=("id", "depth", "cited_opinion_id", "citing_opinion_id"),
    update_cols=("depth",),
    fks=(FK("cited_opinion_id", "search_opinion", "T4"), FK("citing_opinion_id", "search_opinion", "T4")),
)

SEARCH_CITATION = TableSpec(
    name="search_citation",
    columns=(
        Col("id", "int"),
        Col("volume", "int"),
        Col("reporter", "str_trim"),
        Col("page", "str_trim"),
        Col("type", "int"),
        Col("cluster_id", "int"),
    ),
    dialect="T",
    assembly="single",
    upsert="natural",
    min_columns=6,
    key_rule="eq0",
    required=("id", "volume", "reporter", "page", "type", "cluster_id"),
    natural_key=("cluster_id", "volume", "reporter", "page"),
    update_cols=("id", "type"),
    fks=(FK("cluster_id", "search_opinioncluster", "T3"),),
)

PARENTHETICAL = TableSpec(
    name="search_parenthetical",
    columns=(
        Col("id", "int"),
        Col("text", "str_ptrim"),
        Col("score", "double"),
        Col("described_opinion_id", "int"),
        Col("describing_opinion_id", "int"),
        Col("group_id", "int"),
    ),
    dialect="E",
    assembly="single",
    upsert="last",
    min_columns=6,
    required=("id", "text", "score", "described_opinion_id", "describing_opinion_id", "group_id"),
    fks=(
        FK("described_opinion_id", "search_opinion", "T5"),
        FK("describing_opinion_id", "search_opinion", "T5"),
        FK("group_id", "search_parentheticalgroup", "T6"),
    ),
)

SPECS = {s.name: s for s in (OPINION, CLUSTER, PANEL, JOINED_BY, CITED, SEARCH_CITATION, PARENTHETICAL)}
