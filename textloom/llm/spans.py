"""Spans of regular expressions as native expressions: places in code points, without a Python worker.

A span is struct<start, kind, end, value, gap>; kind is a number, so that spans sort by start and then
kind; gap is the text since the match before. Patterns must match no empty string. Repeated
groups are written with possessive quantifiers, which the engine runs in a loop, so that texts of any
length are safe.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPAN = "struct<start:int,kind:int,end:int,value:string,gap:string>"
NONE = f"array<{SPAN}>"


def add_spans(df: DataFrame, text: str, name: str, pattern: str, kind: int, only_if: str | None = None) -> DataFrame:
    """Adds the array ``name`` of the pattern's leftmost non-overlapping matches.

    ``only_if`` is a string that every match holds: texts without it aren't scanned. Matches and the
    gaps between them are columns of their own for a while, so each is computed once.
    """
    found, gaps = f"__m_{name}", f"__g_{name}"
    matches = F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(0))
    if only_if:
        matches = F.when(F.contains(F.col(text), F.lit(only_if)), matches)
    df = df.withColumn(found, matches)
    df = df.withColumn(gaps, F.when(F.size(found) > 0, F.split(F.col(text), pattern, -1)))

    def step(state: Column, pair: Column) -> Column:
        start = state["at"] + F.length(pair["gap"])
        end = start + F.length(pair["value"])
        span = F.struct(start.alias("start"), F.lit(kind).alias("kind"), end.alias("end"), pair["value"].alias("value"), pair["gap"].alias("gap"))
        return F.struct(end.alias("at"), F.concat(state["out"], F.array(span)).alias("out"))

    pairs = F.zip_with(F.slice(F.col(gaps), F.lit(1), F.size(found)), F.col(found), lambda g, m: F.struct(g.alias("gap"), m.alias("value")))
    none = F.array().cast(NONE)
    placed = F.aggregate(pairs, F.struct(F.lit(0).alias("at"), none.alias("out")), step, lambda s: s["out"])
    return df.withColumn(name, F.when(F.size(found) > 0, placed).otherwise(none)).drop(found, gaps)


def narrow(spans: Column) -> Column:
    """Spans without value and gap, by start, kind and end."""
    return F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"))))


def listed(spans: Column, kinds: list[str]) -> Column:
    """kind:start:end, joined by commas."""
    names = F.array(*(F.lit(k) for k in kinds))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


def count(spans: Column, kind: int) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")


def overlaps(span: Column, others: Column) -> Column:
    return F.exists(others, lambda o: (o["start"] < span["end"]) & (span["start"] < o["end"]))
