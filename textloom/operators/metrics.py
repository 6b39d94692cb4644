"""Counts and means of a run."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.operators.validate import STATUSES


def status_counts(df: DataFrame, status: str = "status") -> DataFrame:
    """(status, n) of every known status, 0 where none occurs, and of any other that does."""
    known = df.sparkSession.createDataFrame([(s,) for s in STATUSES], f"{status} string")  # a row a status
    counted = df.groupBy(status).agg(F.count("*").alias("n"))
    return counted.unionByName(known.withColumn("n", F.lit(0).cast("bigint"))).groupBy(status).agg(F.sum("n").alias("n"))


def merged(first: DataFrame, second: DataFrame, key: str = "status", n: str = "n") -> DataFrame:
    """Counts of two parts of a run by key, added up; a key that only one part has keeps its count."""
    return first.select(key, n).unionByName(second.select(key, n)).groupBy(key).agg(F.sum(n).alias(n))


def run_metrics(prepared: DataFrame, rows_loaded: int | None = None) -> DataFrame:
    """One row of counters. Flags count on their own: a row can have several, though it has one status."""
    flags = {"rows_too_long_for_model": "too_long_for_model", "rows_url_like_skipped": "url_like_skipped", "rows_exceeding_max_translate_tokens": "exceeds_max_translate_tokens", "rows_chunked": "was_chunked"}
    processed = F.count("*").alias("rows_processed")
    own = [F.count_if(F.col(c)).alias(n) for n, c in flags.items() if c in prepared.columns]
    out = prepared.agg(processed, *own)
    if rows_loaded is not None:
        out = out.withColumn("rows_loaded", F.lit(rows_loaded).cast("bigint")).withColumn("rows_dropped_empty", F.col("rows_loaded") - F.col("rows_processed"))
    return out


def mean_score(df: DataFrame, score: str = "qe_score") -> DataFrame:
    """Mean of the scores that there are, null without any, and how many."""
    return df.agg(F.avg(score).alias("mean_score"), F.count(score).alias("scored"))
