"""The corpus pipeline: language ID, near-duplicates, secrets, packing, each on what the one before kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that the runner writes as Parquet and
reads again. All but the last return the columns of ``docs``. Clean documents are kept as they are.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.llm import langid, packing, secrets, simhash
from textloom.llm.common import attach, limited, materialize, table


def anonymous(docs: DataFrame) -> tuple[DataFrame, list[str], dict[str, str]]:
    """``docs`` under names of our own, in order, so that no column clashes with those a stage adds: (frame, names, names by old name)."""
    names = [f"__d{i}" for i in range(len(docs.columns))]
    return docs.toDF(*names), names, dict(zip(docs.columns, names, strict=True))


def identify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents of no recognisable language (null texts, and those without a letter).

    The filters are learned from the stage's own input, held-out documents apart. If these leave nothing to learn
    from (no language given, say), texts with a letter all stay. Repeated rows stay as
    often as they come, and other columns, of any name, stay as they are; no input gives no output.
    """
    own, names, of = anonymous(limited(docs))
    key, text = F.col(of["doc_id"]), of["text"]
    filters = langid.fit(own.where(~langid.held_out(key)), key, text, of["lang"])
    if not filters.langs:
        return langid.lettered(own, text).toDF(*docs.columns)
    marked = langid.predict_column(own, filters, text, carry=names)
    return marked.where(F.col("lang_pred") != langid.UNKNOWN).select(*names).toDF(*docs.columns)


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each class of near-duplicates: the one with the smallest id.

    Null texts count as empty, and texts without words are duplicates of each other. Of rows that share the
    class's id, the first by all its columns stays. Rows of a class that has no id (all null) all stay, as
    none can be named. Other columns, of any name, stay as they are; no input gives no output.
    """
    own, names, of = anonymous(limited(docs))
    key = of["doc_id"]
    classes = simhash.near_duplicates(own, of["text"], key).where(F.col("component_id") == F.col(key))
    kept = materialize(classes.groupBy(F.col(key).cast("string").alias("own")).agg(F.lit(True).alias("keeps"), F.count("*").alias("n")), "kept")
    marked = attach(own.withColumn("own", F.coalesce(F.col(key).cast("string"), F.lit("none"))), kept, "own", "keeps", "n", F.xxhash64(*names))
    stays = marked.where(F.col("keeps") | F.col(key).isNull())
    if kept.where("n > 1").isEmpty():
        return stays.select(*names).toDF(*docs.columns)
    firsts = stays.groupBy(key).agg(F.min(F.struct(*names)).alias("first")).where(F.col(key).isNotNull()).select("first.*")
    return firsts.unionByName(stays.where(F.col(key).isNull()).select(*names)).toDF(*docs.columns)


def scrub(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces each secret in a text by a mark, and counts the letters anew; other documents stay as they are.

    Null texts stay null. No row is dropped or merged; other columns, of any name, stay as they are.
    """
    own, names, of = anonymous(docs)
    text, n_chars = of["text"], of.get("n_chars")
    scanned = secrets.scan(own, text, carry=names)
    changed, scrubbed = F.size("spans") > 0, secrets.redact(scanned, "spans", text)
    marked = scanned.withColumn("scrubbed", scrubbed)
    new = {text: F.col("scrubbed"), n_chars: F.when(changed, F.length("scrubbed").cast("bigint")).otherwise(F.col(n_chars)) if n_chars else None}
    return marked.select(*(new.get(c, F.col(c)).alias(c) for c in names)).toDF(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the texts' tokens into sequences of 1024: a row per piece.

    A null or empty text is its end token alone; repeated rows and null ids are packed like any other.
    """
    return packing.pack_documents(limited(docs), public_tokenizers.path("byte_bpe_50k.json"), carry=["doc_id"])


STAGES = [
    ("language_id", identify),
    ("simhash_near_dedup", deduplicate),
    ("secret_scan", scrub),
    ("best_fit_packing", pack),
]

#: Stages learn models and read tokenizers, which SQL can't express; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
