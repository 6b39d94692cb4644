"""Preparing, routing and translating messages, with batches packed before any model runs."""

from __future__ import annotations

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.config import Config
from textloom.functions.emoji import mask, unmask
from textloom.functions.text import is_url_like
from textloom.functions.tokens import token_count
from textloom.operators.backends import translator
from textloom.operators.qe import with_quality
from textloom.operators.rows import chunk_of, drop_blank, order_by_length, pack_batches, require
from textloom.operators.validate import route, validation
from textloom.sources.store import written

NUMBER = "input_row_number"
#: Columns of a run's result after those of its input, in order.
RESULT = [NUMBER, "flag_contains_emoji", "token_count", "too_long_for_model", "exceeds_max_translate_tokens", "url_like_skipped", "translated_text", "status", "placeholder_ok", "validation_error", "was_chunked", "chunk_count", "model_name", "source_lang", "target_lang", "qe_score", "qe_label", "qe_error", "qe_backend", "qe_model_name"]
_BUILT_IN = ("echo", "forgetful", "fragile")
#: What a model's run adds to a row: the raw text, a status and message if it has one, and how it was cut.
_OUTCOME = T.StructType().add("raw", T.StringType()).add("said", T.StringType()).add("why", T.StringType()).add("was_chunked", T.BooleanType()).add("chunk_count", T.IntegerType())

_OUTCOME_TYPES = [pa.string(), pa.string(), pa.string(), pa.bool_(), pa.int32()]


def native_count(config: Config) -> bool:
    return config.model_name in _BUILT_IN or config.model_name is None


def counted(text: Column, config: Config) -> Column:
    """Tokens by the model's tokenizer; the built-in models' are an expression."""
    if native_count(config):
        return token_count(text)
    name, options = config.model_name, (config.device, config.max_new_tokens, config.num_beams)

    @F.pandas_udf("int")
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(translator(name, *options).count)

    return run(text)


def prepare(df: DataFrame, config: Config) -> DataFrame:
    """Numbered rows with a message: blank ones dropped, emoji masked, counted, flagged and routed."""
    text = config.text_column
    require(df, [text, config.label_column, NUMBER])
    own = drop_blank(df, text).withColumn("__mask", mask(F.col(text)))
    own = own.withColumn("masked", F.col("__mask.masked_text")).withColumn("replacements", F.col("__mask.replacements")).withColumn("flag_contains_emoji", F.col("__mask.contains_emoji")).drop("__mask")
    own = own.withColumn("token_count", counted(F.col("masked"), config))
    cap = config.max_translate_tokens
    own = own.withColumns({
        "too_long_for_model": F.col("token_count") > config.max_input_length,
        "exceeds_max_translate_tokens": F.lit(False) if cap is None else F.col("token_count") > cap,
        "url_like_skipped": is_url_like(F.col("masked")) if config.skip_url_like else F.lit(False),
    })
    where = route(F.col("url_like_skipped"), F.col("exceeds_max_translate_tokens"), F.col("too_long_for_model"))
    # The partition keeps the optimizer from moving a filter by route below all this, where it would mask and count anew.
    return own.withColumn("route", F.when(F.spark_partition_id() >= 0, where))


def _placed(rows: DataFrame, done: DataFrame, config: Config) -> DataFrame:
    """All rows with what became of them: the model's outcome by number, or why they were skipped."""
    cap = F.format_string(f"Record exceeds max_translate_tokens limit (%d > {config.max_translate_tokens}).", F.col("token_count"))
    why = F.when(F.col("route") == "skipped_url_like", "Record looks like a URL-like string and was skipped.").otherwise(cap)
    skipped = F.col("route").startswith("skipped")
    joined = rows.join(done.withColumnRenamed(NUMBER, "__number"), F.col(NUMBER) == F.col("__number"), "left").drop("__number")
    return joined.withColumns({"said": F.when(skipped, F.col("route")).otherwise(F.col("said")), "why": F.when(skipped, why).otherwise(F.col("why")), "was_chunked": F.coalesce("was_chunked", F.lit(False)), "chunk_count": F.coalesce("chunk_count", F.lit(0))})


def _translate(rows: DataFrame, config: Config) -> DataFrame:
    """(row number, outcome) of rows that are translated: normal ones by batch within chunks of the input, long ones one by one.

    An error in a batch is the result of all its rows, so batches are the same however rows are partitioned. Only number and
    text go through the model. Long rows are dealt by number, so that a chunk of many is no task of its own.
    """
    narrow = rows.select(NUMBER, "masked", "token_count", "route")
    normal = narrow.where(F.col("route") == "normal").drop("route").withColumn("__chunk", chunk_of(NUMBER, config.input_chunk_size))
    order = NUMBER
    if config.sort_batches_by_length:
        normal, order = order_by_length(normal, "__chunk", "token_count", NUMBER, "__order"), "__order"
    packed = pack_batches(normal, "__chunk", order, "token_count", config.batch_size, config.batch_token_budget, "__batch")
    packed = packed.select(NUMBER, "masked", "__chunk", "__batch", F.col(order).cast("bigint").alias("__at"))
    name, options = config.model_name or "echo", (config.device, config.max_new_tokens, config.num_beams)
    most, limit, overlap = config.max_input_length, config.chunk_token_limit, config.chunk_overlap_tokens
    schema = T.StructType([rows.schema[NUMBER], *_OUTCOME])

    def outcome(numbers: pa.Array | pa.ChunkedArray, found: list[tuple]) -> list:
        return [numbers, *(pa.array([r[k] for r in found], kind) for k, kind in enumerate(_OUTCOME_TYPES))]

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("__batch", "ascending"), ("__at", "ascending")])
        batches, texts = table.column("__batch").to_pylist(), table.column("masked").to_pylist()
        model, out, at = translator(name, *options), [], 0
        while at < len(texts):
            end = next((k for k in range(at, len(texts)) if batches[k] != batches[at]), len(texts))
            try:
                out += [(t, None, None, False, 0) for t in model.translate(texts[at:end], most)]
            except Exception as e:
                out += [(None, "translation_error", f"Batch translation failed: {e}", False, 0)] * (end - at)
            at = end
        return pa.table(outcome(table.column(NUMBER), out), names=schema.names)

    def run_long(batches):
        model = translator(name, *options)
        for batch in batches:
            out = []
            for text in batch.column(1).to_pylist():
                try:
                    done, n = model.translate_long(text, limit, overlap, most)
                    out.append((done, "ok_chunked", None, True, n))
                except Exception as e:
                    out.append((None, "translation_error", f"Chunked translation failed: {e}", False, 0))
            yield pa.RecordBatch.from_arrays(outcome(batch.column(0), out), names=schema.names)

    long = narrow.where(F.col("route") == "chunked").select(NUMBER, "masked").repartition(NUMBER)
    return packed.groupBy("__chunk").applyInArrow(run, schema).unionByName(long.mapInArrow(run_long, schema))


def _judged(rows: DataFrame, config: Config) -> DataFrame:
    restored = rows.withColumn("translated_text", unmask(F.col("raw"), F.col("replacements")))
    return restored.withColumn("__v", validation(F.col(config.text_column), F.col("translated_text"), F.col("said"), F.col("why"))).withColumns({"status": F.col("__v.status"), "placeholder_ok": F.col("__v.placeholder_ok"), "validation_error": F.col("__v.validation_error")}).drop("__v")


def _retried(rows: DataFrame, config: Config) -> DataFrame:
    """Translates rows once more, alone, at half the input length."""
    name, options = config.model_name or "echo", (config.device, config.max_new_tokens, config.num_beams)
    most, limit, overlap = max(1, config.max_input_length // 2), config.chunk_token_limit, config.chunk_overlap_tokens
    kept = rows.drop("raw", "said", "why", "was_chunked", "chunk_count", "translated_text", "status", "placeholder_ok", "validation_error")
    schema = T.StructType([*kept.schema, *_OUTCOME])

    def run(batches):
        model = translator(name, *options)
        for batch in batches:
            out = []
            for text in batch.column("masked").to_pylist():
                try:
                    done, status, n = model.translate_limited(text, most, limit, overlap)
                    out.append((done, status, None, status == "ok_chunked", n))
                except Exception as e:
                    out.append((None, "translation_error", f"Retry translation failed after placeholder_mismatch: {e}", False, 0))
            added = [pa.array([r[k] for r in out], kind) for k, kind in enumerate(_OUTCOME_TYPES)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], names=[*batch.schema.names, "raw", "said", "why", "was_chunked", "chunk_count"])

    return _judged(kept.mapInArrow(run, schema), config)


def translate(df: DataFrame, config: Config) -> DataFrame:
    """Every non-blank row of a numbered table with the columns of RESULT after its own."""
    prepared = written(prepare(df, config), "prepared")  # read by both ways through the model and by what joins them again
    first = _judged(_placed(prepared, _translate(prepared, config), config), config)
    if config.retry_placeholder_mismatch:
        first = written(first, "translated")  # the model's work is used twice from here on
        bad = F.col("status") == "placeholder_mismatch"
        first = first.where(~bad).unionByName(_retried(first.where(bad), config))
    named = first.withColumns({"model_name": F.lit(config.model_name).cast("string"), "source_lang": F.lit(config.source_lang).cast("string"), "target_lang": F.lit(config.target_lang).cast("string")})
    backend = config.qe_backend if config.enable_qe else None
    scored = with_quality(named, config.text_column, "translated_text", "status", backend, config.qe_model_name, config.qe_high_threshold, config.qe_medium_threshold)
    return scored.select(*[c for c in df.columns if c not in RESULT], *RESULT)
