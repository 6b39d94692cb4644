"""Exact merge-type SentencePiece encoding by backtracking, and decoding.

Merging the best adjacent pair again and again gives the one segmentation in which every two
neighbours, merged on their own, come out as these two. So the encoder takes the longest piece that
an Aho-Corasick automaton finds at a position, asks whether it may follow its neighbour, steps to
the next shorter piece or back to the position before if not, and keeps a bitfield of positions
from which no way leads on, so that none is tried twice.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import kept

SPACE = "▁"
#: Words whose encodings a worker keeps; the store is emptied when full, so memory is bounded on any text.
KEPT_WORDS = 800_000
#: Neighbours whose compatibility a worker keeps.
KEPT_PAIRS = 1_000_000
#: Longer words aren't kept.
KEPT_LENGTH = 64

NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6


class _Words(dict):
    """Encodings by word, made when first asked for. Emptied when full."""

    def __init__(self, make: Callable[[str], list[int]]):
        super().__init__()
        self.make = make

    def __missing__(self, word: str) -> list[int]:
        own = self.make(word)
        if len(word) <= KEPT_LENGTH:
            if len(self) >= KEPT_WORDS:
                self.clear()
            self[word] = own
        return own


class PieceModel:
    """A merge-type model with byte fallback and the identity normaliser."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2 as proto

        model = proto.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        trainer, normal = model.trainer_spec, model.normalizer_spec
        if trainer.model_type != proto.TrainerSpec.BPE or normal.precompiled_charsmap or normal.remove_extra_whitespaces or not normal.escape_whitespaces or trainer.treat_whitespace_as_suffix or not trainer.byte_fallback:
            raise ValueError("only merge-type models with byte fallback and the identity normaliser are supported")
        self.prefix = SPACE if normal.add_dummy_prefix else ""
        self.end_id = next(i for i, p in enumerate(model.pieces) if p.piece == (trainer.eos_piece or "</s>"))
        self.kinds = [p.type for p in model.pieces]
        if USER in self.kinds or UNUSED in self.kinds:
            raise ValueError("user-defined and unused pieces are not supported")
        self.strings = [p.piece for p in model.pieces]
        self.ids = {p.piece: i for i, p in enumerate(model.pieces) if p.type == NORMAL}
        self.scores = {p.piece: p.score for p in model.pieces if p.type == NORMAL}
        self.bytes = {int(p.piece[3:5], 16): i for i, p in enumerate(model.pieces) if p.type == BYTE}
        self.of_byte = {i: bytes((b,)) for b, i in self.bytes.items()}
        self.special = {i: "" if k == CONTROL else " ⁇ " for i, k in enumerate(self.kinds) if k in (CONTROL, UNKNOWN)}
        self.unknown = next(i for i, p in enumerate(model.pieces) if p.type == UNKNOWN)
        # No piece goes on past a space sign after something else, so no merge crosses such a place.
        if any(SPACE in s.lstrip(SPACE) for s in self.ids):
            raise ValueError("pieces that hold a space sign inside are not supported")
        letters = {c for s in self.ids for c in s}
        known = "".join(re.escape(c) for c in sorted(letters - {SPACE}))
        self.words = re.compile(f"{SPACE}*[{known}]+|{SPACE}+|.", re.S)
        self.letters = letters & set(self.ids)
        if letters != self.letters:
            raise ValueError("every letter must be a piece")
        # A piece that its own merges don't give is never a result.
        whole = {s for s in self.ids if len(s) == 1 or self.merge(s) == [s]}
        self.automaton = ahocorasick.Automaton()
        for s in whole:
            if len(s) > 1:
                self.automaton.add_word(s, self.ids[s])
        self.letter = {s: self.ids[s] for s in whole if len(s) == 1}
        self.automaton.make_automaton()
        self.lengths = [len(s) for s in self.strings]
        #: By id: the longest piece that is a shorter prefix, or -1.
        self.shorter = [-1] * len(self.strings)
        for s in whole:
            self.shorter[self.ids[s]] = next((self.ids[s[:k]] for k in range(len(s) - 1, 0, -1) if s[:k] in whole), -1)
        self.pairs: dict[int, bool] = {}
        self.shift = len(self.strings).bit_length()
        self.kept = _Words(self.encode_word)
        #: Ids whose text depends on their neighbours: parts of a character of several bytes, and the unknown id.
        self.odd = frozenset(i for i, b in self.of_byte.items() if b[0] >= 128) | {self.unknown}
        self.shown = [self.of_byte[i].decode("latin-1") if k == BYTE else "" if k == CONTROL else p for i, (p, k) in enumerate(zip(self.strings, self.kinds, strict=True))]

    def merge(self, text: str) -> list[str]:
        """Best pair first, leftmost of equals: the definition, for texts as short as two pieces."""
        parts, scores = list(text), self.scores
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = scores.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if at < 0:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def compatible(self, a: int, b: int) -> bool:
        """Whether two pieces stay as they are when their letters are merged anew."""
        if len(self.pairs) >= KEPT_PAIRS:
            self.pairs.clear()
        own = [self.strings[a], self.strings[b]]
        known = self.pairs[a << self.shift | b] = self.merge("".join(own)) == own
        return known

    def segment(self, word: str) -> list[int]:
        """The ids of a run of letters that the model knows."""
        n, lengths, shorter, pairs, shift = len(word), self.lengths, self.shorter, self.pairs.get, self.shift
        longest = list(map(self.letter.__getitem__, word))  # every letter is a piece
        for last, piece in self.automaton.iter(word):  # later matches at a place are longer
            longest[last + 1 - lengths[piece]] = piece
        failed = 0  # bit i: no way leads from place i on
        path: list[int] = []
        at, before, piece = 0, -1, longest[0]
        while True:
            while piece >= 0:
                end = at + lengths[piece]
                if not failed or not failed >> end & 1:
                    if before < 0:
                        break
                    fits = pairs(before << shift | piece)
                    if fits or fits is None and self.compatible(before, piece):
                        break
                piece = shorter[piece]
            if piece >= 0:
                path.append(piece)
                if end == n:
                    return path
                at, before, piece = end, piece, longest[end]
            else:  # a way exists, so the path isn't empty
                failed |= 1 << at
                piece = path.pop()
                at -= lengths[piece]
                piece, before = shorter[piece], path[-1] if path else -1

    def encode_word(self, word: str) -> list[int]:
        if word[0] not in self.letters:
            return [self.bytes[b] for b in word.encode("utf-8", "surrogatepass")]
        return self.segment(word)

    def encode(self, text: str, end: bool = True) -> list[int]:
        """Ids of a text, the end id last if wanted; an empty text has no other id."""
        words = self.words.findall(self.prefix + text.replace(" ", SPACE)) if text else []
        ids = list(chain.from_iterable(map(self.kept.__getitem__, words)))
        if end:
            ids.append(self.end_id)
        return ids

    def decode(self, ids: list[int]) -> str:
        """The text of ids: control ids are nothing, bytes that are no UTF-8 become U+FFFD each, and the prefix goes."""
        if self.odd.isdisjoint(ids):
            return "".join(map(self.shown.__getitem__, ids)).removeprefix(self.prefix).replace(SPACE, " ")
        of_byte, strings, special = self.of_byte, self.strings, self.special
        parts: list[str] = []
        held, begun = b"", not self.prefix
        for i in ids:
            if i in of_byte:
                held += of_byte[i]
                continue
            if held:
                parts.append(_utf8(held))
                held, begun = b"", True
            if i in special:
                parts.append(special[i])
                begun = begun or bool(special[i])
            elif begun:
                parts.append(strings[i])
            else:
                parts.append(strings[i].removeprefix(SPACE))
                begun = True
        if held:
            parts.append(_utf8(held))
        return "".join(parts).replace(SPACE, " ")


def _utf8(data: bytes) -> str:
    """UTF-8, with U+FFFD for each byte that is not part of a whole character."""
    try:
        return data.decode()
    except UnicodeDecodeError:
        out, at = [], 0
        while at < len(data):
            for n in (1, 2, 3, 4):
                try:
                    out.append(data[at : at + n].decode())
                    break
                except UnicodeDecodeError:
                    continue
            else:
                n = 1
                out.append("�")
            at += n
        return "".join(out)


@lru_cache(2)
def load(path: str) -> PieceModel:
    return PieceModel(path)


def encode_column(df: DataFrame, model: str, text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """The carried columns and ``ids``, the end id last, a row per row.

    A null text is an empty one, which has its end id alone. Texts are encoded whole at any length, equal texts alike;
    columns that aren't carried are left out whatever their names.
    """
    carry = kept(carry, "ids")
    narrow = df.select(*carry, F.coalesce(F.col(text), F.lit("")).alias("__text"))
    schema = ", ".join([*(f"`{c}` {t}" for c, t in narrow.dtypes if c != "__text"), "ids array<int>"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = load(model).encode
        for batch in batches:
            ids = [encode(t.as_py()) for t in batch.column(len(carry))]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(carry)], pa.array(ids, pa.list_(pa.int32()))], names=[*carry, "ids"])

    return narrow.mapInArrow(run, schema)


def decode_column(df: DataFrame, model: str, ids: str = "ids", carry: list[str] | None = None) -> DataFrame:
    """The carried columns and the decoded ``text``; null ids give an empty text."""
    carry = kept(carry, "text")
    narrow = df.select(*carry, F.col(ids).alias("__ids"))
    schema = ", ".join([*(f"`{c}` {t}" for c, t in narrow.dtypes if c != "__ids"), "text string"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decode = load(model).decode
        for batch in batches:
            texts = [decode(t.as_py() or []) for t in batch.column(len(carry))]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(carry)], pa.array(texts, pa.string())], names=[*carry, "text"])

    return narrow.mapInArrow(run, schema)


def encoding_digest(df: DataFrame, model: str, text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """Per text: n_tokens, and digests of its ids and of the text decoded from them."""
    carry = kept(carry, "n_tokens", "ids_sha256", "decoded_sha256")
    narrow = df.select(*carry, F.coalesce(F.col(text), F.lit("")).alias("__text"))
    schema = ", ".join([*(f"`{c}` {t}" for c, t in narrow.dtypes if c != "__text"), "n_tokens bigint, ids_sha256 string, decoded_sha256 string"])
    names = [*carry, "n_tokens", "ids_sha256", "decoded_sha256"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = load(model)
        decimal = [str(i) for i in range(len(own.strings))]
        for batch in batches:
            counts, encoded, decoded = [], [], []
            for value in batch.column(len(carry)):
                ids = own.encode(value.as_py())
                counts.append(len(ids))
                encoded.append(hashlib.sha256(" ".join(map(decimal.__getitem__, ids)).encode()).hexdigest())
                decoded.append(hashlib.sha256(own.decode(ids).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(carry)], pa.array(counts, pa.int64()), pa.array(encoded, pa.string()), pa.array(decoded, pa.string())], names=names)

    return narrow.mapInArrow(run, schema)
