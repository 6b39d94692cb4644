"""Vector best-fit packing of token sequences under token, document-count and attention-cost capacities.

Pieces of one length are interchangeable, so the packing is planned on the histogram of lengths:
at most ``tokens`` rows at any corpus size. The plan says which ranks within a length go to which
bins; every piece then finds its place from its rank, without any other piece being looked at.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textloom.llm.common import blocks, kept, materialize

TOKENS = 1024
END_ID = 2
#: Rows of one length that are ranked together.
RANK_ROWS = 4096


@dataclass(frozen=True)
class Capacity:
    """What one sequence holds. Attention cost is the sum of squared lengths (block-diagonal attention).

    The default capacities for documents and cost can never bind before the tokens do, as a piece has a token at least
    and squares sum to no more than the sum's square; their residuals count in the choice of bins all the same.
    """

    tokens: int = TOKENS
    documents: int = TOKENS
    cost: int = TOKENS * TOKENS
    #: How tokens, documents and cost count when bins are compared.
    weights: tuple[float, float, float] = (1.0, 0.25, 0.25)
    #: "norm": the bin with the smallest weighted residual after the piece; "dot": the largest weighted product of piece and residual.
    choose: str = "norm"


@dataclass
class Plan:
    """Runs of ranks: pieces of ``length`` with ranks from ``first`` on go to bins from ``bin`` on, at ``offset``."""

    length: np.ndarray
    first: np.ndarray
    bin: np.ndarray
    offset: np.ndarray
    bins: int

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = self.length << 40 | self.first
        at = np.searchsorted(key, length << 40 | rank, "right") - 1
        return self.bin[at] + (rank - self.first[at]), self.offset[at]


def plan_bins(histogram: dict[int, int], capacity: Capacity = Capacity()) -> Plan:
    """Packs ``histogram`` (pieces by length), longest first. Bins with equal residuals are handled as one run.

    A bin takes as many pieces of the length as fit before the next bin is chosen. Raises if a piece
    fits no empty bin.
    """
    caps = np.array([capacity.tokens, capacity.documents, capacity.cost], np.int64)
    weights = np.array(capacity.weights)
    left = np.zeros((0, 3), np.int64)  # residuals of the open runs of bins
    start, count = np.zeros(0, np.int64), np.zeros(0, np.int64)
    runs: list[tuple[int, int, int, int]] = []
    bins = 0
    for length in sorted(histogram, reverse=True):
        todo, rank = histogram[length], 0
        item = np.array([length, 1, length * length], np.int64)
        if todo and (item > caps).any():
            raise ValueError(f"a piece of {length} tokens exceeds the capacity")
        while todo:
            fit = np.flatnonzero((left >= item).all(1) & (count > 0))
            if len(fit):
                share = left[fit] / caps
                if capacity.choose == "norm":
                    at = fit[np.argmin((weights * (share - item / caps) ** 2).sum(1))]
                else:
                    at = fit[np.argmax((weights * share * (item / caps)).sum(1))]
                residual, base, have = left[at], int(start[at]), int(count[at])
            else:
                at, residual, base, have = -1, caps, bins, todo
            each = int((residual // np.maximum(item, 1)).min())
            each, taken = (each, min(have, todo // each)) if todo >= each else (todo, 1)
            for k in range(each):
                runs.append((length, rank, base, int(capacity.tokens - residual[0]) + k * length))
                rank += taken
            todo -= each * taken
            if at < 0:
                bins += taken
            else:
                start[at] += taken
                count[at] -= taken
            rest = residual - each * item
            if (rest[:2] > 0).all():
                left, start, count = np.vstack([left, rest]), np.append(start, base), np.append(count, taken)
        keep = count > 0
        left, start, count = left[keep], start[keep], count[keep]
    columns = np.array(sorted(runs), np.int64).reshape(-1, 4).T
    return Plan(*columns, bins)


@lru_cache(2)
def byte_level_encoder(path: str):
    """The byte-level BPE of a tokenizers file, run by tiktoken, which gives the same ids several times as fast.

    Strings of added tokens in a text are ordinary text here; `token_ids` splits at them.
    """
    import tiktoken

    with open(path, encoding="utf-8") as f:
        vocabulary = json.load(f)["model"]["vocab"]
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(sorted(set(range(256)) - set(own)))}
    ranks = {bytes(letters[c] for c in word): i for word, i in vocabulary.items() if all(c in letters for c in word) and not (word.startswith("<|") and word.endswith("|>"))}
    pattern = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
    return tiktoken.Encoding("byte-level", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


@lru_cache(2)
def added_tokens(path: str) -> tuple[re.Pattern[str] | None, dict[str, int]]:
    """What splits a text at the file's added tokens (of two that begin alike the longer), and their ids."""
    with open(path, encoding="utf-8") as f:
        found = json.load(f)["added_tokens"]
    if any(t[flag] for t in found for flag in ("single_word", "lstrip", "rstrip", "normalized")):
        raise ValueError("added tokens that take more or less than their own letters aren't supported")
    ids = {t["content"]: t["id"] for t in found}
    return re.compile(f"({'|'.join(map(re.escape, sorted(ids, key=len, reverse=True)))})") if ids else None, ids


def token_ids(text: str, path: str, end_id: int = END_ID, added: bool = False) -> np.ndarray:
    """A document's ids, its end id last, as little-endian unsigned 32-bit numbers.

    With ``added``, a string of the file's added tokens is that token, as the tokenizers library has it by
    default; else it is ordinary text (the library's ``encode_special_tokens``).
    """
    encoder = byte_level_encoder(path)
    splits, ids_of = added_tokens(path) if added else (None, {})
    ids: list[int] = []
    for k, part in enumerate(splits.split(text) if splits else [text]):
        ids += [ids_of[part]] if k % 2 else encoder.encode_ordinary(part)
    ids.append(end_id)
    return np.array(ids, "<u4")


def cut(n: int, tokens: int) -> list[tuple[int, int]]:
    """(start, length) of each piece of a document of ``n`` ids; only the first piece may be shorter."""
    first = n % tokens or tokens
    return [(0, first), *((at, tokens) for at in range(first, n, tokens))]


def token_pieces(df: DataFrame, tokenizer: str, tokens: int = TOKENS, text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """A row per piece: carried columns, piece, start, length, ids_crc32. A null or empty text has its end id alone.

    Ids are the tokenizers library's, added tokens in the text included. Texts are cut whole at any length, repeated rows
    each give their pieces, an empty table gives none; columns that aren't carried are left out whatever their names.
    """
    carry = kept(carry, "piece", "start", "length", "ids_crc32")
    narrow = df.select(*carry, F.coalesce(F.col(text), F.lit("")).alias("__text"))
    schema = ", ".join([*(f"`{c}` {t}" for c, t in narrow.dtypes if c != "__text"), "piece int, start bigint, length bigint, ids_crc32 bigint"])
    names = [*carry, "piece", "start", "length", "ids_crc32"]
    types = [pa.int32(), pa.int64(), pa.int64(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, found = [], []
            for i, value in enumerate(batch.column(len(carry))):
                ids = token_ids(value.as_py(), tokenizer, added=True)
                for piece, (start, length) in enumerate(cut(len(ids), tokens)):
                    rows.append(i)
                    found.append((piece, start, length, zlib.crc32(ids[start : start + length].tobytes())))
            kept = batch.take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays([*kept.columns[: len(carry)], *(pa.array([r[k] for r in found], t) for k, t in enumerate(types))], names=names)

    return narrow.mapInArrow(run, schema)


def pack(pieces: DataFrame, capacity: Capacity = Capacity(), rank_rows: int = RANK_ROWS) -> DataFrame:
    """Adds sequence_id and offset to rows with a ``length``, in place of columns of these names. Read several times:
    materialise it first. Repeated rows get places of their own, and an empty table gives no row.

    Ranks within a length come from a number within small blocks of equal length and the sizes of
    the blocks before, so a length that most pieces share is still spread over all tasks.
    """
    pieces = pieces.drop("sequence_id", "offset")
    sizes = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}  # at most `tokens` rows
    plan = plan_bins(sizes, capacity)
    n_blocks = blocks(sum(sizes.values()), rank_rows)
    others = [c for c in pieces.columns if c != "length"]
    marked = pieces.withColumn("__block", F.pmod(F.xxhash64(*others), F.lit(n_blocks)))
    within = Window.partitionBy("length", "__block")
    before = Window.partitionBy("length").orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    counts = marked.groupBy("length", "__block").agg(F.count("*").alias("__n"))
    offsets = counts.select("length", "__block", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    ranked = marked.withColumn("__rank", F.row_number().over(within.orderBy(*others)) - 1).join(offsets, ["length", "__block"])
    ranked = ranked.select(*pieces.columns, (F.col("__rank") + F.col("__before")).alias("__rank"))
    types = dict(pieces.dtypes)
    schema = ", ".join([*(f"`{c}` {types[c]}" for c in pieces.columns), "sequence_id bigint, offset bigint"])
    names = [*pieces.columns, "sequence_id", "offset"]
    at = names.index("length")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in (at, batch.num_columns - 1))
            where, offset = plan.place(length, rank) if len(rank) else (rank, rank)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(where), pa.array(offset)], names=names)

    return ranked.mapInArrow(run, schema)


def pack_documents(df: DataFrame, tokenizer: str, capacity: Capacity = Capacity(), text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """Tokenises, cuts and packs: a row per piece with its sequence and place.

    A null or empty text is one piece of its end id alone; texts of any length are cut, never shortened. Equal
    and repeated rows are packed each on its own, null keys like any other. Columns that aren't carried are left
    out whatever their names; an empty table gives no row.
    """
    return pack(materialize(token_pieces(df, tokenizer, capacity.tokens, text, carry), "pieces"), capacity)
