"""Language ID with language-bitmask n-gram filters.

One table of masks holds a Bloom filter per language, bit-sliced: bit l of a slot belongs to
language l's filter. An n-gram's two slots, and-ed, give every language whose filter holds it. A
document's count per language is the number of its n-grams whose mask has the language's bit,
freed from the false positives that the filter's fill leads to expect; the largest share decides.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from unicodedata import category

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.llm.common import kept, materialize, scratch

#: Labelled rows that the filters are learned from, per language, about: rows are taken by a hash, so the bound holds in expectation.
SAMPLE_ROWS = 4000
ORDERS = (2, 3, 4)
#: Slots of a filter for each n-gram of the language that has most, at least; with two slots an n-gram, a fifth is filled.
SLOTS_PER_GRAM = 8
#: An n-gram belongs to a language if it is at least this share as frequent there as where it is most frequent.
KEEP_RATIO = 0.5
UNKNOWN = "und"
_PIECE = 1 << 16
_MULTIPLIERS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


_MARK = 0


@lru_cache(1)
def _letters() -> np.ndarray:
    """Every code point's lower-case letter, 0 for marks (and joiners), which are part of a word after a letter, else 32."""
    table = np.full(0x110000, 32, np.uint32)
    for c in range(0x110000):
        if chr(c).isalpha():
            low = chr(c).lower()
            table[c] = ord(low) if len(low) == 1 else c
        elif category(chr(c)) in ("Mn", "Mc", "Me") or c in (0x200C, 0x200D):
            table[c] = _MARK
    return table


def _words(points: np.ndarray, inside: bool) -> np.ndarray:
    """Letters and the marks that follow them, all else as single spaces; ``inside`` says whether a word goes on."""
    out = _letters()[points]
    marks = np.flatnonzero(out == _MARK)
    if len(marks):
        place = np.arange(1, len(out) + 1)
        letter, other = (np.maximum.accumulate(np.where(x, place, 0)) for x in ((out != 32) & (out != _MARK), out == 32))
        follows = (letter[marks] > other[marks]) | (inside & (other[marks] == 0))
        out[marks] = np.where(follows, points[marks], 32)
    blank = out == 32
    return out[np.r_[True, ~(blank[1:] & blank[:-1])]] if len(out) else out


def letters_of(text: str) -> np.ndarray:
    """Code points of the letters, lower case, and their marks; what lies between words, and around them, is one space."""
    return np.concatenate([new for _, new in pieces_of(text)])


def gram_hashes(letters: np.ndarray, order: int) -> np.ndarray:
    """A 64-bit hash for each n-gram that has no space inside."""
    n = len(letters) - order + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h = np.full(n, order, np.uint64)
    for k in range(order):
        h = (h ^ letters[k : k + n].astype(np.uint64)) * np.uint64(0x100000001B3) + np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    inside = np.ones(n, bool)
    for k in range(1, order - 1):
        inside &= letters[k : k + n] != 32
    if order == 2:
        inside &= (letters[:n] != 32) | (letters[1:] != 32)
    return h[inside]


def pieces_of(text: str) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """A text's letters in pieces of bounded size: (the letters just before, the piece). The whole text is covered."""
    before = np.zeros(0, np.uint32)
    for at in range(0, len(text), _PIECE):
        points = np.frombuffer(text[at : at + _PIECE].encode("utf-32-le", "surrogatepass"), np.uint32)
        new = _words(points, bool(len(before)) and before[-1] != 32)
        if not len(before):
            new = np.r_[np.uint32(32), new[new[:1].tolist() == [32] :]]
        elif before[-1] == 32 and new[:1].tolist() == [32]:
            new = new[1:]
        yield before, new
        before = np.r_[before, new][1 - max(ORDERS) :]
    if not len(before) or before[-1] != 32:
        yield before, np.array([32], np.uint32)


def grams_of(text: str) -> Iterator[np.ndarray]:
    """Hashes of all n-grams of a text, each once for every time it occurs, wherever pieces are cut."""
    for before, new in pieces_of(text):
        for order in ORDERS:
            yield gram_hashes(np.r_[before[len(before) - min(len(before), order - 1) :], new], order)


@dataclass
class Filters:
    """The learned masks. ``langs`` are in order; bit l of a mask is language l's.

    Up to eight languages share a byte a slot; beyond, a slot has a word for every 64 of them.
    """

    langs: list[str]
    masks: np.ndarray
    #: Per language: the chance that an n-gram the filter doesn't hold seems to be in it.
    false_rate: np.ndarray

    def containing(self, hashes: np.ndarray) -> np.ndarray:
        """For each n-gram, the mask of all languages that (seem to) contain it."""
        first, second = slots(hashes, len(self.masks).bit_length() - 1)
        return self.masks[first] & self.masks[second]

    def counts(self, text: str) -> tuple[np.ndarray, int]:
        """How many of the text's n-grams each language contains, and how many there are."""
        found, total = np.zeros(len(self.langs), np.int64), 0
        for hashes in grams_of(text):
            masks = self.containing(hashes)
            total += len(masks)
            if len(self.langs) <= 8:
                by_mask = np.bincount(masks, minlength=256)
                found += [int(by_mask[_HAS[lang]].sum()) for lang in range(len(self.langs))]
            else:  # popcounts by language, of the bits of a word side by side
                bits = np.unpackbits(masks.view(np.uint8).reshape(len(masks), -1), axis=1, bitorder="little").sum(0, dtype=np.int64)
                found += bits[: len(self.langs)]
        return found, total

    def predict(self, text: str | None) -> tuple[str, float]:
        """The language whose corrected count is largest (of equals the first by name), and its share of all counts.

        ``und`` with score 0 for a null text and one without a letter, and if nothing was learned.
        """
        if not text or not self.langs:
            return UNKNOWN, 0.0
        found, total = self.counts(text)
        if not total:
            return UNKNOWN, 0.0
        true = np.maximum(0.0, (found - total * self.false_rate) / (1 - self.false_rate))
        if true.sum() == 0:
            true = found + 1.0
        best = int(np.argmax(true))
        return self.langs[best], float(true[best] / true.sum())


_HAS = [np.flatnonzero(np.arange(256) >> lang & 1) for lang in range(8)]


def slots(hashes: np.ndarray, bits: int) -> list[np.ndarray]:
    """The two slots of each n-gram in a filter of ``2 ** bits``."""
    shift = np.uint64(64 - bits)
    return [(hashes * np.uint64(m)) >> shift for m in _MULTIPLIERS]


def slot_bits(grams: int) -> int:
    """Such that the language with most n-grams, ``grams``, has SLOTS_PER_GRAM slots for each."""
    return max(8, (max(1, grams) * SLOTS_PER_GRAM - 1).bit_length())


def _filters(langs: list[str], bits: int, slot: np.ndarray, word: np.ndarray, mask: np.ndarray) -> Filters:
    """Filters of masks that are given by slot and word (of 64 languages each)."""
    masks = np.zeros((1 << bits, max(1, -(-len(langs) // 64))), np.uint64)
    np.bitwise_or.at(masks, (slot.astype(np.int64), word.astype(np.int64)), mask)
    fill = [np.count_nonzero(masks[:, k >> 6] >> np.uint64(k & 63) & np.uint64(1)) / len(masks) for k in range(len(langs))]
    return Filters(langs, masks[:, 0].astype(np.uint8) if len(langs) <= 8 else masks, np.minimum(0.99, np.square(fill)))


def build(grams: dict[str, np.ndarray]) -> Filters:
    """Filters from each language's n-gram hashes."""
    langs = sorted(grams)
    bits = slot_bits(max((len(g) for g in grams.values()), default=0))
    parts = [(own, k) for k, lang in enumerate(langs) for own in slots(grams[lang], bits)]
    places = [np.concatenate([f(own, k) for own, k in parts] or [np.zeros(0, np.uint64)]) for f in (lambda own, k: own, lambda own, k: np.full(len(own), k >> 6), lambda own, k: np.full(len(own), 1 << (k & 63), np.uint64))]
    return _filters(langs, bits, *places)


def fit(labelled: DataFrame, key: Column, text: str = "text", lang: str = "lang", sample_rows: int = SAMPLE_ROWS) -> Filters:
    """Learns from rows with a language and a text. ``key`` and text only say which rows the bounded sample takes: about
    ``sample_rows`` a language, by a hash, so that equal rows are drawn together; one row at least.

    Every language is learned, with every n-gram of its sample that is frequent enough beside other languages. The masks are put
    together in Spark; what comes to the driver, a row a language and at most the masks' words, grows with the
    number of languages and the sample, not with the rows.
    """
    rows = labelled.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"), key.alias("key"))
    drawn = rows.withColumn("draw", F.pmod(F.xxhash64("key", "text"), F.lit(1 << 30)) / (1 << 30))
    sizes = drawn.groupBy("lang").agg(F.count("*").alias("n"), F.min("draw").alias("least")).collect()
    if not sizes:
        return build({})
    limit = F.element_at(F.create_map(*(F.lit(x) for r in sizes for x in (r["lang"], float(max(sample_rows / r["n"], r["least"]))))), F.col("lang"))
    sample = drawn.where(F.col("draw") <= limit).select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            by_lang: dict[str, list[np.ndarray]] = {}
            for name, value in zip(batch.column(0), batch.column(1), strict=True):
                by_lang.setdefault(name.as_py(), []).extend(grams_of(value.as_py()))
            for name, parts in by_lang.items():
                values, n = np.unique(np.concatenate(parts), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(values), pa.string()), pa.array(values.view(np.int64)), pa.array(n.astype(np.int64))], names=["lang", "gram", "n"])

    with scratch(labelled.sparkSession):
        counted = materialize(sample.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")), "grams")
        totals = {r["lang"]: r["all"] for r in counted.groupBy("lang").agg(F.sum("n").alias("all")).collect()}  # a row a language
        if not totals:
            return build({})
        share = F.col("n") / F.element_at(F.create_map(*(F.lit(x) for pair in totals.items() for x in pair)), F.col("lang"))
        top = F.max("share").over(Window.partitionBy("gram"))
        learned = materialize(counted.withColumn("share", share).withColumn("top", top).where(F.col("share") >= KEEP_RATIO * F.col("top")).select("lang", "gram"), "learned")
        langs = sorted(totals)
        bits = slot_bits(learned.groupBy("lang").count().agg(F.max("count")).first()[0])
        number = {name: k for k, name in enumerate(langs)}

        def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                own = np.array([number[x] for x in batch.column(0).to_pylist()], np.int64)
                for slot in slots(batch.column(1).to_numpy().view(np.uint64), bits):
                    mask = np.uint64(1) << (own & 63).astype(np.uint64)
                    yield pa.RecordBatch.from_arrays([pa.array(slot.astype(np.int32)), pa.array((own >> 6).astype(np.int16)), pa.array(mask.view(np.int64))], names=["slot", "word", "mask"])

        masks = learned.mapInArrow(place, "slot int, word smallint, mask long").groupBy("slot", "word").agg(F.bit_or("mask").alias("mask")).toArrow()
    return _filters(langs, bits, *(masks.column(c).to_numpy() for c in ("slot", "word")), masks.column("mask").to_numpy().view(np.uint64))


def predict_column(df: DataFrame, filters: Filters, text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """The carried columns with lang_pred and score, from the text alone, a row per row.

    A null text, and one without a letter, is ``und`` with score 0; so is every text if nothing was learned.
    Texts count whole; of equal shares the first language by name wins. Equal texts get equal results; columns
    that aren't carried are left out whatever their names.
    """
    carry = kept(carry, "lang_pred", "score")
    narrow = df.select(*carry, F.col(text).alias("__text"))
    schema = ", ".join([*(f"`{c}` {t}" for c, t in narrow.dtypes if c != "__text"), "lang_pred string, score double"])
    shipped = df.sparkSession.sparkContext.broadcast(pickle.dumps(filters))  # grows with languages and their sample alone

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = pickle.loads(shipped.value)
        for batch in batches:
            found = [own.predict(t.as_py()) for t in batch.column(len(carry))]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(carry)], pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())], names=[*carry, "lang_pred", "score"])

    return narrow.mapInArrow(run, schema)


def lettered(df: DataFrame, text: str = "text") -> DataFrame:
    """The rows whose text has a letter, by the same letters as the prediction; a null text has none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [any((p != 32).any() for _, p in pieces_of(t.as_py() or "")) for t in batch.column(text)]
            yield batch.filter(pa.array(found, pa.bool_()))

    return df.mapInArrow(run, df.schema)


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from learning: crc32 of its id as text is 2 modulo 4. A null id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(4)) == 2
