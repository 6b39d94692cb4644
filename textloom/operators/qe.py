"""Quality estimation: pluggable scorers behind a gate, and their columns."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache
from importlib import import_module

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.functions.text import quality_label, strip
from textloom.operators.combine import QE_COLUMNS, rename_reserved, zip_rows

GOOD = ("ok", "ok_chunked")
DISABLED = ("transquest",)
#: The built-in backend: the shorter length as a share of the longer, as an expression.
NATIVE = "length_ratio"


def _comet(model_name: str) -> Callable[[list[tuple[str, str]]], list[float]]:
    from comet import download_model, load_from_checkpoint

    model = load_from_checkpoint(download_model(model_name))
    return lambda pairs: [float(s) for s in model.predict([{"src": a, "mt": b} for a, b in pairs], batch_size=8)["scores"]]


def _transquest(model_name: str) -> Callable[[list[tuple[str, str]]], list[float]]:
    """Kept, but not offered: `check_backend` turns it away. A model may return numbers or lists of one, for one pair or many."""
    from transquest.algo.sentence_level.monotransquest.run_model import MonoTransQuestModel

    model = MonoTransQuestModel("xlmroberta", model_name, use_cuda=False)
    return lambda pairs: transquest_scores(pairs, model.predict)


def transquest_scores(pairs: list[tuple[str, str]], predict: Callable[[list[list[str]]], object]) -> list[float]:
    """A score a pair from whatever shape the model returns; an empty side, or another number of scores, is an error."""
    if any(not a or not b for a, b in pairs):
        raise ValueError("Source or translated text is empty.")
    found = predict([list(p) for p in pairs])
    if isinstance(found, tuple) and len(found) == 2 and len(pairs) != 2:  # scores and raw outputs
        found = found[0]
    flat = list(found) if isinstance(found, Iterable) else [found]
    scores = [float(x[0]) if isinstance(x, Iterable) else float(x) for x in flat]
    if len(scores) != len(pairs):
        raise ValueError(f"{len(scores)} scores for {len(pairs)} pairs")
    return scores


def length_scorer(model_name: str) -> Callable[[list[tuple[str, str]]], list[float]]:
    """The built-in backend's score by way of a Python scorer, as any model of one's own would be plugged in."""
    return lambda pairs: [min(len(a), len(b)) / (max(len(a), len(b)) or 1) for a, b in pairs]


#: Scorers of lists of (source, translation) pairs, by backend; a maker gets the model's name.
_SCORERS: dict[str, Callable[[str], Callable[[list[tuple[str, str]]], list[float]]]] = {"comet": _comet, "transquest": _transquest}


def check_backend(name: str | None, model_name: str | None) -> None:
    if name in DISABLED:
        raise ValueError(f"quality backend {name!r} is disabled")
    if name != NATIVE and name not in _SCORERS and ":" not in (name or ""):
        raise ValueError(f"unsupported quality backend {name!r}; there are {sorted({NATIVE, *_SCORERS} - {*DISABLED})}")
    if name != NATIVE and not model_name:
        raise ValueError("a quality model name is required")


@lru_cache(4)
def _scorer(name: str, model_name: str) -> Callable[[list[tuple[str, str]]], list[float]]:
    """A known backend, or what ``module:attribute`` makes; workers import it."""
    if ":" in name:
        module, _, attribute = name.partition(":")
        return getattr(import_module(module), attribute)(model_name)
    return _SCORERS[name](model_name)


def _result(source: Column, translated: Column, backend: str, model_name: str | None) -> Column:
    """struct<score, error> of pairs; a failure of the backend is an error of each pair, not of the run."""
    if backend == NATIVE:
        a, b = F.length(source), F.length(translated)
        score = F.when(F.greatest(a, b) > 0, F.least(a, b) / F.greatest(a, b)).otherwise(F.lit(0.0))
        return F.struct(score.alias("score"), F.lit(None).cast("string").alias("error"))

    @F.pandas_udf("score double, error string")
    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for a, b in batches:
            pairs = list(zip(a, b, strict=True))
            try:
                score = _scorer(backend, model_name or "")
            except Exception as e:  # whatever a model's loader raises is a result here
                yield pd.DataFrame({"score": [None] * len(a), "error": [f"{backend.upper()} load failed: {e}"] * len(a)})
                continue
            rows: list[tuple[float | None, str | None]] = []
            try:
                rows = [(s, None) for s in score(pairs)]
            except Exception:  # one bad pair must not take the others with it
                for pair in pairs:
                    try:
                        rows.append((score([pair])[0], None))
                    except Exception as e:
                        rows.append((None, str(e)))
            yield pd.DataFrame(rows, columns=["score", "error"])

    return run(source, translated)


def _columns(df: DataFrame, source: Column, translated: Column, wanted: Column, reason: Column, backend: str | None, model_name: str | None, high: float, medium: float) -> DataFrame:
    """The five columns: scored where ``wanted``, with ``reason`` as the error elsewhere."""
    none = F.lit(None).cast("string")
    if backend is None:
        return df.withColumns({"qe_score": F.lit(None).cast("double"), "qe_label": none, "qe_error": F.when(~wanted, reason), "qe_backend": none, "qe_model_name": none})
    check_backend(backend, model_name)
    native = backend == NATIVE
    # Without a native expression the scorer sees only the rows that it is to score.
    kept = df.withColumns({"__want": wanted, "__reason": reason, "__a": source, "__b": translated})
    parts = [kept.withColumn("__r", _result(F.col("__a"), F.col("__b"), backend, model_name))] if native else [
        kept.where("__want").withColumn("__r", _result(F.col("__a"), F.col("__b"), backend, model_name)),
        kept.where("not __want").withColumn("__r", F.lit(None).cast("struct<score:double,error:string>")),
    ]
    out = parts[0] if native else parts[0].unionByName(parts[1])
    want, score = F.col("__want"), F.col("__r.score")
    return out.withColumns({
        "qe_score": F.when(want, score),
        "qe_label": F.when(want, quality_label(score, high, medium)),
        "qe_error": F.when(want, F.col("__r.error")).otherwise(F.col("__reason")),
        "qe_backend": F.when(want, F.lit(backend)),
        "qe_model_name": F.when(want, F.lit(model_name).cast("string")),
    }).drop("__want", "__reason", "__a", "__b", "__r")


def with_quality(df: DataFrame, source: str = "message", translated: str = "translated_text", status: str = "status", backend: str | None = NATIVE, model_name: str | None = None, high: float = 0.7, medium: float = 0.4) -> DataFrame:
    """Quality of good translations. Rows of another status get nulls; an empty text says so."""
    good = F.coalesce(F.col(status).isin(*GOOD), F.lit(False))
    blank = F.coalesce(F.col(translated), F.lit("")) == ""
    reason = F.when(good & blank, F.lit("QE skipped: translated_text is empty."))
    return _columns(df, F.coalesce(source if isinstance(source, Column) else F.col(source), F.lit("")), F.coalesce(F.col(translated), F.lit("")), good & ~blank, reason, backend, model_name, high, medium)


def score_combined(df: DataFrame, source: str = "message", translated: str = "translated_text", backend: str = NATIVE, model_name: str | None = None, high: float = 0.7, medium: float = 0.4) -> DataFrame:
    """Scores a table that holds both sides. With a status column only good rows; empty texts are scored too."""
    wanted, reason = F.lit(True), F.lit(None).cast("string")
    if "status" in df.columns:
        said = strip(F.coalesce(F.col("status").cast("string"), F.lit("")))
        wanted = said.isin(*GOOD)
        reason = F.when(~wanted, F.concat(F.lit("QE skipped: translation status is '"), said, F.lit("'.")))
    own = df.withColumns({"__s": F.coalesce(F.col(source), F.lit("")), "__t": F.coalesce(F.col(translated), F.lit("")), "__w": wanted, "__why": reason})
    own = rename_reserved(own)
    return _columns(own, F.col("__s"), F.col("__t"), F.col("__w"), F.col("__why"), backend, model_name, high, medium).drop("__s", "__t", "__w", "__why")


def score_paired(left: DataFrame, right: DataFrame, source: str = "message", translated: str = "message", number: str = "input_row_number", **options: object) -> DataFrame:
    """Scores two tables of as many rows, row by row, whatever their statuses."""
    own = left.withColumn("__s", F.coalesce(F.col(source), F.lit("")))
    other = right.withColumn("__t", F.coalesce(F.col(translated), F.lit("")))
    zipped = zip_rows(own, other, number)
    backend = options.get("backend", NATIVE)
    return _columns(zipped, F.col("__s"), F.col("__t"), F.lit(True), F.lit(None).cast("string"), backend, options.get("model_name"), options.get("high", 0.7), options.get("medium", 0.4)).drop("__s", "__t")


__all__ = ["QE_COLUMNS", "check_backend", "score_combined", "score_paired", "with_quality"]
