"""Row filters, numbering, limits, ordering and batch packing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.functions.text import filled, strip
from textloom.sources.store import written


def require(df: DataFrame, columns: list[str]) -> DataFrame:
    """The DataFrame itself, or a ValueError that names the columns it lacks."""
    if missing := sorted(set(columns) - set(df.columns)):
        raise ValueError(f"missing required columns: {', '.join(missing)}")
    return df


def number(df: DataFrame, by: list[str | Column], name: str = "input_row_number", key: list[str] | None = None) -> DataFrame:
    """Adds 1-based row numbers in the order of ``by``, without bringing rows to one task.

    With a ``key`` (columns that no two rows agree in, and that ``by`` is made of) keys alone are sorted, written
    and numbered, and rows get their numbers by a join; without it whole rows are.

    A range-partitioned sort gives each partition its place; the sizes of those before come from a table of
    as many rows as there are partitions. The sorted rows are written first, so that partitions that are
    computed again after a loss can't be others than those that were counted.
    """
    if key:
        keys = number(df.select(*key), by, name).withColumnsRenamed({c: f"__k{i}" for i, c in enumerate(key)})
        same = [F.col(f"`{c}`").eqNullSafe(F.col(f"__k{i}")) for i, c in enumerate(key)]
        return df.join(keys, same).drop(*(f"__k{i}" for i in range(len(key))))
    part, place = F.spark_partition_id().alias("__part"), F.monotonically_increasing_id().alias("__place")
    placed = written(df.orderBy(*by).select("*", part, place), "numbered")
    sizes = placed.groupBy("__part").count().orderBy("__part").collect()
    starts, total = [], 0
    for r in sizes:
        starts.append((r["__part"], total))
        total += r["count"]
    offsets = df.sparkSession.createDataFrame(starts, "__part int, __start bigint")
    within = F.col("__place").bitwiseAND(F.lit((1 << 33) - 1))
    joined = placed.join(F.broadcast(offsets), "__part")
    return joined.select(*(F.col(f"`{c}`") for c in df.columns), (F.col("__start") + within + 1).alias(name))


def drop_blank(df: DataFrame, text: str = "message", null_text: str = "nan") -> DataFrame:
    """Rows whose text is more than white space. A null is the text that a cast of it gives, so it stays."""
    whole = df.withColumn(text, filled(F.col(text), null_text))
    return whole.where(strip(F.col(text)) != "")


def head(df: DataFrame, n: int, number_column: str = "input_row_number") -> DataFrame:
    if n <= 0:
        raise ValueError("the limit must be greater than 0")
    return df.where(F.col(number_column) <= n)


def skip(df: DataFrame, n: int, number_column: str = "input_row_number") -> DataFrame:
    return df.where(F.col(number_column) > n)


def drop_skipped(df: DataFrame, status: str = "status") -> DataFrame:
    """Without rows that were left untranslated for their length."""
    return df.where(strip(F.coalesce(F.col(status), F.lit(""))) != "skipped_max_translate_tokens")


def chunk_of(number_column: str, size: int) -> Column:
    """0-based number of the block of ``size`` rows that a row number falls into."""
    if size <= 0:
        raise ValueError("the chunk size must be greater than 0")
    return F.floor((F.col(number_column) - 1) / size)


def order_by_length(df: DataFrame, chunk: str, tokens: str, number_column: str, name: str = "position") -> DataFrame:
    """Adds a row's place in its chunk by token count, of equals by row number."""
    w = Window.partitionBy(chunk).orderBy(tokens, number_column)
    return df.withColumn(name, F.row_number().over(w))


def pack_batches(df: DataFrame, chunk: str, order: str, tokens: str, max_rows: int, budget: int, name: str = "batch") -> DataFrame:
    """Adds the number of the greedy batch that a row falls into, within its chunk.

    Rows are taken in order; a batch ends when it is full or the next row's tokens would exceed the budget. A
    row beyond the budget has a batch of its own. A chunk is as long as the input's chunk size, so the fold
    over one is bounded.
    """
    if max_rows <= 0 or budget <= 0:
        raise ValueError("the batch size and the token budget must be greater than 0")
    others = [c for c in df.columns if c != chunk]
    row = F.struct(F.col(order).alias("__order"), F.col(tokens).alias("__tokens"), F.struct(*others).alias("__row"))
    chunks = df.groupBy(chunk).agg(F.array_sort(F.collect_list(row), lambda a, b: F.when(a["__order"] < b["__order"], -1).when(a["__order"] > b["__order"], 1).otherwise(0)).alias("__rows"))

    def step(state: Column, r: Column) -> Column:
        full = (state["rows"] >= max_rows) | ((state["rows"] > 0) & (state["tokens"] + r["__tokens"] > budget))
        batch = state["batch"] + full.cast("int")
        return F.struct(
            batch.alias("batch"),
            F.when(full, 1).otherwise(state["rows"] + 1).alias("rows"),
            (F.when(full, F.lit(0)).otherwise(state["tokens"]) + r["__tokens"]).cast("bigint").alias("tokens"),
            F.concat(state["out"], F.array(batch)).alias("out"),
        )

    start = F.struct(F.lit(0).alias("batch"), F.lit(0).alias("rows"), F.lit(0).cast("bigint").alias("tokens"), F.array().cast("array<int>").alias("out"))
    numbered = chunks.withColumn("__batches", F.aggregate("__rows", start, step, lambda s: s["out"]))
    flat = numbered.select(chunk, F.explode(F.arrays_zip("__rows", "__batches")).alias("__r"))
    return flat.select(*(F.col(chunk) if c == chunk else F.col(f"__r.__rows.__row.{c}").alias(c) for c in df.columns), F.col("__r.__batches").alias(name))
