"""CSV sources and sinks, output paths and reports.

Quoted fields may hold doubled quotes and line feeds. Everything is read as text. Rows are numbered
in the order of the files' names and of the lines in each.
"""

from __future__ import annotations

import csv
import io
import json
import os
from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: What the usual CSV readers take for a missing value.
NA = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]
_NEVER = "never-a-value"


_OPTIONS = {"header": True, "multiLine": True, "escape": '"', "nullValue": _NEVER, "emptyValue": "", "mode": "PERMISSIVE", "recursiveFileLookup": True}


def read_csv(spark: SparkSession, path: str, na_values: bool = False, number: str | None = "input_row_number") -> DataFrame:
    """All columns as strings, an empty field as an empty string unless ``na_values`` makes usual markers null.

    A file that is short of fields gives nulls; fields beyond the header are left out (`read_records` keeps them). Files in
    folders below are read too.
    """
    raw = spark.read.csv(path, inferSchema=False, **_OPTIONS)
    columns = raw.columns
    if na_values:
        raw = raw.withColumns({c: F.when(~F.col(f"`{c}`").isin(NA), F.col(f"`{c}`")) for c in columns})
    return raw if number is None else _numbered(raw, number)


def _numbered(raw: DataFrame, number: str) -> DataFrame:
    """Rows with their numbers in the order of the files' names and of the lines in each."""
    # A file with line feeds in fields is read by one task in order; files take their places by name.
    placed = raw.select("*", F.col("_metadata.file_path").alias("__file"), F.monotonically_increasing_id().alias("__place"))
    sizes = placed.groupBy("__file").agg(F.count("*").alias("__n"), F.min("__place").alias("__first"))
    before = F.coalesce(F.sum("__n").over(Window.orderBy("__file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = sizes.select("__file", "__first", before.alias("__before"))  # a row a file
    joined = placed.join(F.broadcast(starts), "__file")
    return joined.select(*(F.col(f"`{c}`") for c in raw.columns), (F.col("__before") + F.col("__place") - F.col("__first") + 1).alias(number))


def read_records(spark: SparkSession, path: str, number: str = "input_row_number") -> tuple[str, DataFrame]:
    """The header line, and rows (record, number): each record as CSV text, one with too many or too few fields as it stands in its file."""
    columns = spark.read.csv(path, inferSchema=False, **_OPTIONS).columns
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*columns, "__ragged"]])
    raw = spark.read.schema(schema).csv(path, columnNameOfCorruptRecord="__ragged", **_OPTIONS)
    own = _numbered(raw, number)
    line = F.to_csv(F.struct(*(F.col(f"`{c}`") for c in columns)), {"escape": '"', "emptyValue": "", "nullValue": "", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"})
    header = io.StringIO()
    csv.writer(header, lineterminator="").writerow(columns)
    return header.getvalue(), own.select(F.coalesce("__ragged", line).alias("record"), number)


def write_records(header: str, records: DataFrame, path: str, number: str = "input_row_number", mode: str = "overwrite") -> int:
    """Writes records in order, whatever fields each has; the header is the first line of every file, as readers skip one in each. The number of records."""
    first = records.sparkSession.createDataFrame([(header, 0)], f"record string, {number} bigint")  # stands for the header if there is no record
    seen = Observation()
    ordered = first.unionByName(records.select("record", number)).orderBy(number)
    counted = ordered.observe(seen, F.count(F.lit(1)).alias("rows"))  # above the sort, which reads its input twice
    placed = counted.select("record", number, F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("__at"))
    headed = F.when((F.col("__at") == 0) & (F.col(number) > 0), F.array(F.lit(header), F.col("record"))).otherwise(F.array("record"))
    placed.select(F.explode(headed).alias("record")).write.option("maxRecordsPerFile", 0).mode(mode).text(path)
    return seen.get["rows"] - 1


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", header: bool = True) -> int:
    """Writes a folder of CSV files and returns the number of rows written."""
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.csv(path, mode=mode, header=header, escape='"', emptyValue="", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    return seen.get["rows"]


def append_csv(df: DataFrame, path: str) -> int:
    return write_csv(df, path, mode="append")


def default_path(path: str, kind: str, n: int | None = None) -> str:
    """Where an output goes that is given no path: next to the input, named after it."""
    stem, suffix = os.path.splitext(path)
    endings = {"progress": ".progress.json", "sample": f"_sample{suffix}", "lowercase": f"_lowercase{suffix}", "first": f"_first_{n}{suffix}"}
    return stem + endings[kind]


def write_report(report: dict[str, Any], path: str) -> None:
    """A run report on the driver's disk: JSON, indented, letters as they are, with a byte-order mark."""
    os.makedirs(os.path.dirname(path) or ".", exist_ok=True)
    with open(path, "w", encoding="utf-8-sig") as f:
        json.dump(report, f, ensure_ascii=False, indent=2)
