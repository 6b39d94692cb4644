"""Fuzzy merging of overlapping translated chunks: an ordered fold that stays in Python.

Each chunk is joined to what came before by the first of these that there is: the longest exact overlap
of words at the seam, the best fuzzy one, a short seed of the chunk's first words found in the tail, or
plain joining. An exact one goes first because in repetitive text a longer fuzzy one can score above it,
and would drop words that don't repeat.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from difflib import SequenceMatcher

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Sizes, thresholds and (below) weights that decide the merged text, so they must be these.
LEAST_OVERLAP, MOST_OVERLAP = 5, 30
FULL_RATIO, INNER_RATIO, EDGE_TRIM = 0.72, 0.85, 2
TAIL, SEEDS = 80, (3, 2)
_AROUND = re.compile(r"^[^\w<]+|[^\w>]+$")


def ratio(a: list[str], b: list[str]) -> float:
    return SequenceMatcher(None, a, b).ratio() if a and b else 0.0


def exact_size(before: list[str], after: list[str]) -> int:
    """Words at the end of ``before`` with which ``after`` begins, as many as an overlap may have; 0 if fewer than the least."""
    sizes = range(min(len(before), len(after), MOST_OVERLAP), LEAST_OVERLAP - 1, -1)
    return next((n for n in sizes if before[-n] == after[0] and before[-n:] == after[:n]), 0)


def overlap_size(before: list[str], after: list[str]) -> int:
    """Words of ``after`` that repeat the end of ``before``, more or less; 0 if none do.

    A size is scored by how alike both sides are, as a whole and without unsteady edges, and a little by
    itself; the first of equal scores wins.
    """
    best, best_score = 0, float("-inf")
    for size in range(LEAST_OVERLAP, min(len(before), len(after), MOST_OVERLAP) + 1):
        a, b = before[len(before) - size :], after[:size]
        whole = ratio(a, b)
        inner = max(whole, *(ratio(a[t : size - t], b[t : size - t]) for t in range(1, EDGE_TRIM + 1)))
        score = 0.45 * whole + 0.55 * inner + 0.01 * size
        if (whole >= FULL_RATIO or inner >= INNER_RATIO) and score > best_score:
            best, best_score = size, score
    return best


def bare(token: str) -> str:
    low = token.lower().strip()
    return low if low[:1] == "<" and low[-1:] == ">" else _AROUND.sub("", low)


def seed_place(before: list[str], after: list[str]) -> int | None:
    """Where in ``before`` the first words of ``after`` stand last within the tail; longer seeds are tried first."""
    tail_at = max(0, len(before) - TAIL)
    tail, head = [bare(w) for w in before[tail_at:]], [bare(w) for w in after[: SEEDS[0]]]
    for size in SEEDS:
        if len(head) >= size:
            for at in range(len(tail) - size, -1, -1):
                if tail[at : at + size] == head[:size]:
                    return tail_at + at
    return None


def merge_fuzzy(chunks: list[str]) -> str:
    """The chunks as one text. A blank chunk is passed over."""
    merged = chunks[0].strip() if len(chunks) else ""
    for chunk in chunks[1:]:
        chunk = chunk.strip()
        if not chunk:
            continue
        before, after = merged.split(), chunk.split()
        if size := exact_size(before, after) or overlap_size(before, after):
            merged = " ".join(before + after[size:])
        elif (at := seed_place(before, after)) is not None:
            merged = " ".join(before[:at] + after)
        else:
            merged = f"{merged} {chunk}".strip()
    return merged.strip()


def with_merged(df: DataFrame, chunks: str, name: str) -> DataFrame:
    """``df`` with the array column ``chunks`` replaced by their fuzzy merge ``name``; a null array gives an empty text.

    An operator of its own rather than an expression, so that the JVM never has to evaluate the fold.
    Select few columns first: all others pass through Python too.
    """
    others = [c for c in df.columns if c != chunks]
    own = df.select(*(F.col(f"`{c}`") for c in others), F.col(f"`{chunks}`"))
    schema = T.StructType([*(f for f in own.schema if f.name != chunks), T.StructField(name, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            merged = [merge_fuzzy(v.as_py() or []) for v in batch.column(len(others))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(merged, pa.string())], names=[*others, name])

    return own.mapInArrow(run, schema)
