"""The corpus pipeline: five stages, each one operator of ``relload.llm``.

Language ID, SimHash near-dedup, benchmark decontamination, temperature mixing and
sharding.  Every stage reads what the one before it kept; all but the last return the
columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from relload.llm import decontam, langid, mixing, shard, simhash
from relload.llm.common import ROW_FILE, ROW_KEY, ROW_POS, as_files, free_name, held_out, with_row_key, write_table

MAX_REPEAT = 2.0
SHARDS = 16


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text the language model does not reject.

    The model learns from the labelled rows that are not held out.  Null texts, texts
    without a letter and texts too far from every centroid go; all else stays,
    repeated rows included.  An empty table stays empty.
    """
    columns = docs.columns
    names = [free_name(docs, n) for n in ("__llm_lang", "__llm_score", "__llm_rejected")]
    model = langid.fit(docs, ~held_out(F.col("doc_id")))
    return langid.predict(docs, model, "text", *names).where(~F.col(names[2])).select(*columns)


def _keyed(docs: DataFrame) -> tuple[DataFrame, list]:
    """Row key and all columns of ``docs`` under names of their own, and what gives them their names back."""
    names = {c: f"__llm_column_{i}" for i, c in enumerate(docs.columns)}
    rows = with_row_key(docs, *[F.col(f"`{c}`").alias(n) for c, n in names.items()])
    return rows, [F.col(n).alias(c) for c, n in names.items()]


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group: the smallest id, of rows with that id the first in the files.

    Rows with null ids count after all others; repeated rows leave one.
    """
    docs = as_files(docs)
    rows, named = _keyed(docs)
    keyed = simhash.near_duplicates(docs, shingle=3, max_bits=2)
    place = F.struct(F.col("doc_id").isNull(), "doc_id", ROW_FILE, ROW_POS)
    kept = keyed.groupBy("group").agg(F.min(place).alias("first")).select(*[F.col(f"first.{c}").alias(c) for c in ROW_KEY])
    return rows.join(kept.hint("shuffle_hash"), ROW_KEY, "left_semi").select(*named)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a verified overlap with a benchmark item; null and short texts stay."""
    docs = as_files(docs)
    rows, named = _keyed(docs)
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = write_table(decontam.contaminated(docs, benchmark).select(*ROW_KEY).distinct(), "contaminated")
    return rows.join(found, ROW_KEY, "left_anti").select(*named)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture uses them.

    The exponent is the smallest at which no source is repeated more than twice as
    often as another, and the budget the least that uses every document, so sources
    are flattened by repeating small ones and no clean document goes.
    """
    docs = as_files(docs)
    rows, named = _keyed(docs)
    shares = mixing.source_tokens(docs, "source", "text")
    quotas = mixing.plan(shares, mixing.exponent(shares, max_repeat=MAX_REPEAT), None)
    uses = mixing.draw(with_row_key(docs, "doc_id", "source", "text"), quotas, ["doc_id", *ROW_KEY], "source", "text")
    return mixing.repeat_rows(rows, uses, ROW_KEY, free_name(rows, "__llm_uses")).select(*named)


def shard_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and slot of every use of a document: doc_id, source, size, text_crc32, shard, slot."""
    return shard.assign(docs, SHARDS)


STAGES = [
    ("language", identify_language),
    ("near_dedup", near_dedup),
    ("decontamination", decontaminate),
    ("mixing", mix_sources),
    ("sharding", shard_documents),
]

# Language ID learns its centroids and SimHash hashes shingles: SQL has neither.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again before the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = write_table(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
