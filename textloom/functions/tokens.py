"""Token counts, sliding windows and plain merges over arrays of tokens.

The built-in tokenizer takes white-space words as tokens and, like translation models, counts one
more for the end of the text. Other tokenizers come in through `textloom.operators.backends`.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from textloom.functions.text import bound, strip, words


def token_count(text: Column) -> Column:
    """Tokens with the end token; 0 for an empty or null text."""
    return F.when(F.coalesce(text, F.lit("")) == "", F.lit(0)).otherwise(F.size(words(text)) + 1)


def check_window(limit: int, overlap: int) -> None:
    if limit <= 0:
        raise ValueError("the token limit must be greater than 0")
    if not 0 <= overlap < limit:
        raise ValueError("the overlap must be at least 0 and less than the token limit")


def windows(tokens: Column, limit: int, overlap: int = 0) -> Column:
    """array<struct<text, start, end>> of sliding windows; one empty window for no tokens.

    The last window is the first that reaches the end.
    """
    check_window(limit, overlap)
    step = limit - overlap

    def cut(own: Column) -> Column:
        last = F.greatest(F.lit(0), F.ceil((F.size(own) - limit) / step).cast("int"))
        return F.transform(
            F.sequence(F.lit(0), last),
            lambda i: F.struct(
                F.array_join(F.slice(own, i * step + 1, F.lit(limit)), " ").alias("text"),
                (i * step).cast("int").alias("start"),
                F.least(F.size(own), i * step + limit).cast("int").alias("end"),
            ),
        )

    return bound(tokens, lambda own: F.filter(cut(own), lambda w: (w["text"] != "") | (F.size(own) == 0)))


def window_count(tokens: Column, limit: int, overlap: int = 0) -> Column:
    check_window(limit, overlap)
    return bound(F.size(tokens), lambda n: F.when(n <= limit, 1).otherwise(F.ceil((n - overlap) / (limit - overlap))).cast("int"))


def hard_split(tokens: Column, limit: int) -> Column:
    """Windows without overlap, none for no tokens."""
    return F.filter(windows(tokens, limit), lambda w: w["end"] > 0)


def merge_plain(chunks: Column) -> Column:
    """Non-empty chunks joined by one space."""
    return strip(F.array_join(F.filter(chunks, lambda c: c != ""), " "))


def merge_exact(chunks: Column, most: int = 30) -> Column:
    """Chunks joined with the longest exact overlap of words, up to ``most``, taken once; blank chunks are passed over.

    The fold keeps the last words, and each chunk's rest as it stands and tidied: an overlap tidies all before it.
    """
    parts = "array<struct<raw:string,tidy:string>>"

    def join(state: Column, raw: Column) -> Column:
        def fitted(new: Column) -> Column:
            old = state["tail"]
            top = F.least(F.size(old), F.size(new), F.lit(most))
            sizes = F.when(top > 0, F.sequence(top, F.lit(1), F.lit(-1))).otherwise(F.array().cast("array<int>"))
            fits = F.filter(sizes, lambda k: (F.get(old, F.size(old) - k) == F.get(new, F.lit(0))) & (F.slice(old, F.size(old) - k + 1, k) == F.slice(new, F.lit(1), k)))
            return bound(F.coalesce(F.get(fits, F.lit(0)), F.lit(0)), lambda overlap: F.when(F.size(new) == 0, state).otherwise(added(new, overlap)))

        def added(new: Column, overlap: Column) -> Column:
            rest = F.slice(new, overlap + 1, F.size(new))
            both = F.concat(state["tail"], rest)
            part = F.struct(strip(raw).alias("raw"), F.array_join(rest, " ").alias("tidy"))
            return F.struct(
                F.slice(both, F.greatest(F.lit(1), F.size(both) - most + 1), F.lit(most)).alias("tail"),
                F.concat(state["parts"], F.array(part)).alias("parts"),
                F.when(overlap > 0, F.size(state["parts"]) + 1).otherwise(state["tidied"]).alias("tidied"),
            )

        return bound(words(raw), fitted)

    def text(state: Column) -> Column:
        shown = F.transform(state["parts"], lambda p, i: F.when(i < state["tidied"], p["tidy"]).otherwise(p["raw"]))
        return F.array_join(F.filter(shown, lambda t: t != ""), " ")

    start = F.struct(F.array().cast("array<string>").alias("tail"), F.array().cast(parts).alias("parts"), F.lit(0).alias("tidied"))
    return F.aggregate(chunks, start, join, text)
