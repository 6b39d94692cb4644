"""Putting two tables side by side by row position."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

QE_COLUMNS = ["qe_score", "qe_label", "qe_error", "qe_backend", "qe_model_name"]


def rename_clashes(left: DataFrame, right: DataFrame, reserved: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Columns that both sides have, or that clash with ``reserved``, get _source and _translated."""
    reserved = QE_COLUMNS if reserved is None else reserved
    both = set(left.columns) & set(right.columns)

    def renamed(df: DataFrame, suffix: str) -> DataFrame:
        return df.withColumnsRenamed({c: f"{c}{suffix}" for c in df.columns if c in both or c in reserved})

    return renamed(left, "_source"), renamed(right, "_translated")


def rename_reserved(df: DataFrame, suffix: str = "_input", reserved: list[str] | None = None) -> DataFrame:
    return df.withColumnsRenamed({c: f"{c}{suffix}" for c in df.columns if c in (QE_COLUMNS if reserved is None else reserved)})


def zip_rows(left: DataFrame, right: DataFrame, number: str = "input_row_number") -> DataFrame:
    """Rows of equal number side by side; both sides must have equally many. The number is kept once."""
    sizes = left.count(), right.count()
    if sizes[0] != sizes[1]:
        raise ValueError(f"both inputs need the same number of paired rows, not {sizes[0]} and {sizes[1]}")
    own, other = rename_clashes(left.withColumnRenamed(number, "__left"), right.withColumnRenamed(number, "__right"))
    joined = own.join(other, F.col("__left") == F.col("__right")).drop("__right")
    return joined.withColumnRenamed("__left", number)
