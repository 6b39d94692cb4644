"""Resumable runs: files arrive as micro-batches, each written exactly once.

A batch's rows go to a folder named after its number, overwritten if the batch is run again after a
failure; Spark's checkpoint remembers which files are done. A later run takes up where the last one ended.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def process(spark: SparkSession, source: DataFrame, transform: Callable[[DataFrame], DataFrame], output: str, checkpoint: str, file_format: str = "parquet", **options: str) -> int:
    """Runs ``transform`` over what is new in a streaming ``source``; the number of batches run so far.

    The output is a table partitioned by batch_id, Parquet or of another format with its options (CSV with a header, say).
    """

    def write(batch: DataFrame, number: int) -> None:
        transform(batch).write.mode("overwrite").format(file_format).options(**options).save(f"{output}/batch_id={number}")

    query = source.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    if query.exception():
        raise query.exception()
    return 1 + (query.lastProgress["batchId"] if query.lastProgress else -1)


def file_stream(spark: SparkSession, path: str, schema: str, file_format: str = "parquet", files_per_batch: int = 1, **options: str) -> DataFrame:
    return spark.readStream.schema(schema).options(maxFilesPerTrigger=files_per_batch, **options).format(file_format).load(path)


def totals(spark: SparkSession, output: str, file_format: str = "parquet", by: str | None = None, **options: str) -> DataFrame:
    """Rows and batches of the output so far, in all or ``by`` a column: counters that outlive a restart, as they are read
    from what was written exactly once."""
    rows = spark.read.format(file_format).options(**options).load(output)
    return rows.groupBy(*[by] * bool(by)).agg(F.count("*").alias("rows"), F.count_distinct("batch_id").alias("batches"))
