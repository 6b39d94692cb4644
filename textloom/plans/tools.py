"""The small tools: sample export, lower-casing, first rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.functions.text import ANGLE, is_url_like, lowercase, remove_emoji_words, strip, strip_punctuation
from textloom.operators.rows import drop_skipped, head, require


def url_like_skipped(df: DataFrame) -> Column:
    """Whether a row was left untranslated as an address: by its status, its flag, or its message."""

    def text(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit("")) if name in df.columns else F.lit("")

    flagged = F.lower(strip(text("url_like_skipped"))).isin("1", "true", "yes")
    return (strip(text("status")) == "skipped_url_like") | flagged | is_url_like(text("message"))


def sample_export(df: DataFrame, autopopulate_url_like: bool = False, drop_skipped_max_translate_tokens: bool = False, remove_emoji_placeholders: bool = False, lowercase_messages: bool = False, remove_punctuation: bool = False) -> DataFrame:
    """(message, label) of a run's result: dropped, filled in, cleaned, lower-cased, without punctuation, in this order."""
    needed = ["translated_text", "label"] + ["message"] * autopopulate_url_like + ["status"] * drop_skipped_max_translate_tokens
    own = require(df, needed)
    if drop_skipped_max_translate_tokens:
        own = drop_skipped(own)
    text = F.coalesce(F.col("translated_text"), F.lit(""))
    if autopopulate_url_like:
        text = F.when((text == "") & url_like_skipped(own), F.coalesce(F.col("message"), F.lit(""))).otherwise(text)
    if remove_emoji_placeholders:
        text = remove_emoji_words(text)
    if lowercase_messages:
        text = lowercase(text)
    if remove_punctuation:
        text = strip_punctuation(text)
    return own.select(text.alias("message"), F.col("label"))


def lowercase_messages(df: DataFrame) -> DataFrame:
    """The message in lower case, but for placeholders in angle brackets."""
    return require(df, ["message"]).withColumn("message", lowercase(F.coalesce(F.col("message"), F.lit("")), ANGLE))


def first_rows(df: DataFrame, n: int, number: str = "input_row_number") -> DataFrame:
    return head(df, n, number).drop(number)
