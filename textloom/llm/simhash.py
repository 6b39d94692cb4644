"""SimHash near-duplicates by a byte-position inverted index with count filtering.

Of a fingerprint's eight bytes, two that differ in at most three bits share at least five. Any five
positions hold one of a few sets of three (or four) positions, so an index on the values at these
sets brings every such pair together. A list's members are indexed by the bytes at the other positions; the postings
that hold both of a pair are tallied, pairs with five or more shared positions kept, and verified by their differing
bits. Of a list only a spanning forest of its links goes out, never all pairs.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import attach, kept, materialize, scratch
from textloom.llm.components import components

SEED = 42
SHINGLE = 3
BITS = 3
#: Positions that a linked pair shares at least: each differing bit spoils one byte at most.
SHARED = 8 - BITS
#: Longer posting lists are dealt anew by sets of five positions, in which pairs are found by neighbours.
LIST_ROWS = 4096
#: Fingerprints a value of an index set is shared by on average, at most; more positions are taken beyond.
MEAN_LIST = 8

_LOWER = {c: c + 32 for c in range(65, 91)}
_WORD = re.compile("[^\x20\x09-\x0d]+")
_TEXT_PIECE = 1 << 16


def shingles(text: str, size: int = SHINGLE) -> Iterator[list[str]]:
    """A text's word shingles, repeats included, some thousands at a time."""
    words = _WORD.findall(text.translate(_LOWER))
    if words and len(words) < size:
        yield [" ".join(words)]
    for at in range(0, len(words) - size + 1, _TEXT_PIECE):
        part = words[at : at + _TEXT_PIECE + size - 1]
        yield [" ".join(s) for s in zip(*(part[k:] for k in range(size)), strict=False)]


def fingerprint(text: str | None, size: int = SHINGLE) -> int:
    """Unsigned 64-bit SimHash; 0 for a text without words."""
    total, counts, hash64 = 0, np.zeros(64, np.int64), xxhash.xxh64_intdigest
    for part in shingles(text or "", size):
        own = np.fromiter((hash64(s, SEED) for s in part), np.uint64, len(part))
        for bit in range(64):
            counts[bit] += np.count_nonzero(own & _BIT[bit])
        total += len(part)
    return sum(1 << bit for bit in range(64) if 2 * counts[bit] > total)


_BIT = [np.uint64(1 << b) for b in range(64)]


@lru_cache(8)
def index_sets(size: int) -> tuple[tuple[int, ...], ...]:
    """Sets of ``size`` byte positions of which every SHARED positions hold one, by greedy cover (three: two halves)."""
    if size == 3:
        return tuple(s for half in ((0, 1, 2, 3), (4, 5, 6, 7)) for s in combinations(half, 3))
    todo, chosen = set(combinations(range(8), SHARED)), []
    while todo:
        best = max(combinations(range(8), size), key=lambda s: sum(set(s) <= set(t) for t in todo))
        todo = {t for t in todo if not set(best) <= set(t)}
        chosen.append(best)
    return tuple(chosen)


def index_size(fingerprints: int) -> int:
    """Positions of an index set, such that a posting list stays short at this many fingerprints. Any choice is exact."""
    return next((k for k in (3, 4) if fingerprints <= MEAN_LIST << 8 * k), SHARED)


def postings(prints: DataFrame, size: int) -> DataFrame:
    """Rows (key, fp), a row per index set. The key holds the set's number and the bytes at its positions."""

    def key(number: int, positions: tuple[int, ...]) -> Column:
        packed = F.lit(number).cast("bigint")
        for p in positions:
            packed = F.shiftleft(packed, 8).bitwiseOR(F.shiftrightunsigned("fp", 8 * p).bitwiseAND(F.lit(255)))
        return packed

    return prints.select("fp", F.explode(F.array(*(key(i, s) for i, s in enumerate(index_sets(size))))).alias("key")).select("key", "fp")


class Postings:
    """The inverted index of a list of fingerprints: for each byte position, the members by value.

    Positions in ``known`` are shared by all members, as they have the list in common, and aren't indexed.
    """

    def __init__(self, fps: np.ndarray, known: tuple[int, ...] = ()):
        self.fps, self.known = fps, len(known)
        values = fps.view(np.uint8).reshape(-1, 8)
        self.lists = []
        for p in set(range(8)) - set(known):
            own = values[:, p]
            self.lists.append((own, np.argsort(own, kind="stable"), np.bincount(own, minlength=256)))

    def tally(self, rows: np.ndarray) -> np.ndarray:
        """For each of the rows and each member, the positions they share: a hit for every posting that holds both."""
        n = len(self.fps)
        hits = np.full(len(rows) * n, self.known, np.int64)
        for values, members, sizes in self.lists:
            own = values[rows]
            length, start = sizes[own], (np.cumsum(sizes) - sizes)[own]
            place = np.repeat(start - (np.cumsum(length) - length), length) + np.arange(length.sum())
            hits += np.bincount(np.repeat(np.arange(len(rows)) * n, length) + members[place], minlength=len(hits))
        return hits.reshape(len(rows), n)

    def linked(self, rows: np.ndarray, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
        """(row, member) of pairs that link: those with enough hits, once their differing bits are counted."""
        at, member = np.nonzero(self.tally(rows) >= 8 - bits)
        near = np.bitwise_count(self.fps[rows[at]] ^ self.fps[member]) <= bits
        return rows[at[near]], member[near]


def forest(fps: np.ndarray, known: tuple[int, ...] = (), bits: int = BITS, block: int = 256) -> tuple[np.ndarray, np.ndarray]:
    """(member, smallest member of its component) over a posting list of distinct sorted fingerprints, which share the
    ``known`` positions."""
    index = Postings(fps, known)
    found = [index.linked(np.arange(at, min(at + block, len(fps))), bits) for at in range(0, len(fps), block)]
    rows, members = (np.concatenate(x) for x in zip(*found, strict=True))

    def minimum(label: np.ndarray) -> np.ndarray:
        low = label.copy()
        np.minimum.at(low, rows, label[members])
        return low

    return _spread(fps, np.arange(len(fps)), minimum)


def _spread(fps: np.ndarray, label: np.ndarray, minimum) -> tuple[np.ndarray, np.ndarray]:
    while True:
        new = np.minimum(label, minimum(label))
        new = new[new]
        if (new == label).all():
            moved = label != np.arange(len(fps))
            return fps[moved], fps[label[moved]]
        label = new


def forest_by_neighbours(fps: np.ndarray, shared: tuple[int, ...], bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """As `forest`, for fingerprints that agree at the ``shared`` positions: looks up every value that differs in
    up to ``bits`` bits elsewhere, so work and memory are in proportion to the list, which has 2 ** 24 members at most."""
    free = [np.uint64(1 << 8 * p + b) for p in range(8) if p not in shared for b in range(8)]
    masks = [np.bitwise_or.reduce(c) for n in range(1, bits + 1) for c in combinations(free, n)]

    def minimum(label: np.ndarray) -> np.ndarray:
        low = label.copy()
        for mask in masks:
            other = fps ^ mask
            at = np.minimum(np.searchsorted(fps, other), len(fps) - 1)
            hit = fps[at] == other
            low[hit] = np.minimum(low[hit], label[at[hit]])
        return low

    return _spread(fps, np.arange(len(fps)), minimum)


def _lists(batches: Iterator[pa.RecordBatch], most: int | None) -> Iterator[tuple[int, np.ndarray, bool]]:
    """Posting lists of a partition that is sorted by key: (key, fingerprints, long). A list longer than ``most``
    comes in parts, marked as long."""
    held_key, held, long = None, np.zeros(0, np.uint64), False
    for batch in batches:
        keys, fps = batch.column(0).to_numpy(), batch.column(1).to_numpy().view(np.uint64)
        edges = np.flatnonzero(np.diff(keys)) + 1
        for a, b in zip(np.r_[0, edges], np.r_[edges, len(keys)], strict=True):
            if a == b:
                continue
            if keys[a] != held_key:
                if len(held) > 1 or long and len(held):
                    yield held_key, held, long
                held_key, held, long = keys[a], fps[a:b], False
            else:
                held = np.concatenate([held, fps[a:b]])
            if most and len(held) > most:
                long = True
                yield held_key, held, True
                held = held[:0]
    if len(held) > 1 or long and len(held):
        yield held_key, held, long


def _dealt(postings: DataFrame) -> DataFrame:
    return postings.repartition("key").sortWithinPartitions("key")


def links(prints: DataFrame, size: int | None = None, list_rows: int = LIST_ROWS) -> DataFrame:
    """Links (a, b) that connect what fingerprints within BITS bits connect. ``prints`` has distinct ``fp`` (bigint)."""
    size = size or index_size(prints.count())
    first_sets = index_sets(size)

    def join_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, fps, long in _lists(batches, list_rows):
            a, b = (fps, fps) if long else forest(np.sort(fps), first_sets[int(key) >> 8 * size])
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

    first = materialize(_dealt(postings(prints, size)).mapInArrow(join_lists, "a bigint, b bigint"), "list-links")
    found = first.where("a != b")
    crowded = first.where("a = b").select(F.col("a").alias("fp")).distinct()  # members of long lists
    if crowded.isEmpty():
        return found
    sets = index_sets(SHARED)

    def join_long(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, fps, _ in _lists(batches, None):
            fps = np.sort(fps)
            shared = sets[int(key) >> 8 * SHARED]
            a, b = forest(fps, shared) if len(fps) <= LIST_ROWS else forest_by_neighbours(fps, shared)
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

    return found.union(_dealt(postings(crowded, SHARED)).mapInArrow(join_long, "a bigint, b bigint"))


def fingerprints(df: DataFrame, text: str = "text", carry: list[str] | None = None, size: int = SHINGLE) -> DataFrame:
    """The carried columns and the fingerprint ``fp`` as a signed bigint, a row per row.

    A null text is an empty one; it, and a text without words, has fingerprint 0. Texts are read whole at any length, equal
    texts and repeated rows get equal fingerprints, an empty table gives no row; columns that aren't carried are left out.
    """
    carry = kept(carry, "fp")
    narrow = df.select(*carry, F.coalesce(F.col(text), F.lit("")).alias("__text"))
    schema = ", ".join([*(f"`{c}` {t}" for c, t in narrow.dtypes if c != "__text"), "fp bigint"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = np.array([fingerprint(t.as_py(), size) for t in batch.column(len(carry))], np.uint64)
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(carry)], pa.array(own.view(np.int64))], names=[*carry, "fp"])

    return narrow.mapInArrow(run, schema)


def near_duplicates(df: DataFrame, text: str = "text", key: str = "doc_id", list_rows: int = LIST_ROWS) -> DataFrame:
    """A row per row of ``df``: the key, its fingerprint in hexadecimal, and the smallest key reachable by links.

    A null, empty or blank text has fingerprint zero, and such texts link like any other; a bit that half the
    shingles have is 0. Equal fingerprints are one node, so repeated rows are members of one component. Rows with a
    null key are members too, but name no component unless it has no other. Columns besides text and key are
    left out whatever their names; an empty table gives no row.
    """
    prints = materialize(fingerprints(df, text, [key]).withColumnRenamed(key, "__key"), "fingerprints")
    with scratch(df.sparkSession) as keep:
        nodes = materialize(prints.groupBy("fp").agg(F.min("__key").alias("least"), F.count("*").alias("n")), "nodes")
        roots = components(links(nodes.select("fp"), list_rows=list_rows))
        placed = nodes.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "n", "least", F.coalesce("root", "fp").cast("string").alias("root"))
        placed = materialize(placed, "placed")
        classes = materialize(placed.groupBy("root").agg(F.min("least").alias("component_id"), F.count("*").alias("members")), "classes")
        named = attach(placed, classes, "root", "component_id", "members", F.col("fp"))
        facts = materialize(named.select(F.col("fp").cast("string").alias("print"), "component_id", "n"), "named")
        keep.append(facts)
    joined = attach(prints.withColumn("print", F.col("fp").cast("string")), facts, "print", "component_id", "n", F.xxhash64("__key"))
    return joined.select(F.col("__key").alias(key), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
