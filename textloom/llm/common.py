"""Helpers that every operator of this subpackage shares."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.sources.store import discard, new_path, scratch, shared_folder, written

__all__ = ["attach", "blocks", "discard", "kept", "limited", "materialize", "new_path", "scratch", "shared_folder", "table", "text_or_empty"]

#: Rows and bytes that an Arrow batch holds at most (a longer row has one of its own); both bound a worker's memory.
BATCH_ROWS = 512
BATCH_BYTES = 16 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the data folder; only Spark opens the path, so any Hadoop file system will do."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def limited(df: DataFrame, rows: int = BATCH_ROWS, size: int = BATCH_BYTES) -> DataFrame:
    """The same rows in a session of their own, whose Arrow batches hold at most ``rows`` rows and ``size`` bytes.

    Batches are cut when a plan runs, long after an operator has returned, so the limits can't be set and taken back;
    the caller's session keeps its own settings.
    """
    spark = df.sparkSession
    if spark.conf.get("spark.textloom.limited", None):
        return df
    session = SparkSession(spark.sparkContext, spark._jsparkSession.cloneSession())
    session.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    session.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(size))
    session.conf.set("spark.textloom.limited", "true")
    return DataFrame(spark._jvm.org.apache.spark.sql.classic.Dataset.ofRows(session._jsparkSession, df._jdf.logicalPlan()), session)


#: Writes a frame once into the shared folder and reads it back: cuts lineage, survives lost executors.
materialize = written


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def kept(carry: list[str] | None, *own: str) -> list[str]:
    """The columns to carry along: where a result has a column of its own of that name, its own is given."""
    return [c for c in carry or [] if c not in own]


def blocks(rows: int, per_block: int) -> int:
    """How many blocks of at most about ``per_block`` rows hold ``rows`` rows."""
    return max(1, -(-rows // per_block))


#: A key is hot if it holds more than this share of the rows; so there are fewer than 1 / HOT_SHARE hot keys.
HOT_SHARE = 0.001


def attach(left: DataFrame, facts: DataFrame, key: str, value: str, rows: str, spread: Column) -> DataFrame:
    """``left`` with the column ``value`` of ``facts`` (one row a key, with the key's number of rows).

    Hot keys, at most 1 / HOT_SHARE of them at any size, are broadcast; their rows are dealt by
    ``spread`` in the join of the others, so that no task gets a key with more than HOT_SHARE of the rows.
    ``facts`` is read three times: materialise it first. Keys are strings and never null.
    """
    total = facts.agg(F.sum(rows)).first()[0] or 0
    is_hot = F.col(rows) > HOT_SHARE * total
    hot = facts.where(is_hot).select(F.col(key).alias("__hot"), F.col(value).alias("__hot_value"))
    rest = facts.where(~is_hot).select(F.col(key).alias("__dealt"), value)
    marked = left.join(F.broadcast(hot), F.col(key) == F.col("__hot"), "left")
    dealt = F.when(F.col("__hot").isNull(), F.col(key)).otherwise(F.concat(F.lit("hot "), spread.cast("string")))
    # The rest grows with the input, so it is never broadcast: plans, and the room they need, are the same at every size.
    joined = marked.withColumn("__dealt_key", dealt).join(rest.hint("merge"), F.col("__dealt_key") == F.col("__dealt"), "left")
    found = F.when(F.col("__hot").isNull(), F.col(value)).otherwise(F.col("__hot_value"))
    return joined.withColumn(value, found).drop("__hot", "__hot_value", "__dealt_key", "__dealt")
