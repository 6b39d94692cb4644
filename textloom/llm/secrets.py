"""Secret scans, native: fixed forms, and a randomness test battery for strings of no known form.

A string's encoding is inferred as the smallest alphabet that holds its symbols. Under the
hypothesis of uniform symbols it takes a chi-squared test of the symbols' shares, a runs test about
the alphabet's middle, and a test of the correlation of neighbours. What passes all is weighed
against text: the likelihood ratio of uniform symbols to the symbols' shares in the corpus's own words is an
e-value, so 2 ** -bits bounds the chance that text looks so random, and it falls with length. A Benjamini-
Hochberg threshold over all strings of the corpus, on whole bits, holds the false discovery rate.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.functions.text import bound
from textloom.llm.common import kept, materialize
from textloom.llm.spans import add_spans, count, listed, narrow

KINDS = ["assign", "access", "hex", "random"]
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
#: Symbols that a string of no known form has at least.
LEAST = 20
STRING = rf"[A-Za-z0-9+/_-]{{{LEAST},}}"

#: Share of false ones among the random strings reported, at most, in expectation.
FDR = 0.01
#: A uniform string is rejected by the battery with about this chance.
ALPHA = 0.001
MOST_BITS = 4096

_UPPER, _LOWER, _DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"
#: Encodings from the smallest alphabet on; a string of digits alone is a number and not tested.
ENCODINGS = [("hex", _DIGITS + "abcdef"), ("HEX", _DIGITS + "ABCDEF"), ("base32", _UPPER + "234567"), ("base36", _DIGITS + _LOWER), ("BASE36", _DIGITS + _UPPER), ("base62", _DIGITS + _UPPER + _LOWER), ("base64", _UPPER + _LOWER + _DIGITS + "+/"), ("base64url", _UPPER + _LOWER + _DIGITS + "-_")]
#: Per cent of letters in text (published averages over Latin-script languages, rounded).
_LETTERS = {"e": 13.5, "a": 8.5, "i": 7.5, "n": 7.5, "s": 7.0, "r": 6.8, "t": 7.0, "o": 6.5, "l": 4.7, "d": 4.2, "u": 4.2, "c": 3.1, "m": 2.8, "h": 4.0, "p": 2.2, "g": 2.0, "b": 1.6, "f": 1.6, "v": 1.3, "w": 1.2, "y": 1.0, "k": 0.9, "q": 0.5, "z": 0.5, "x": 0.3, "j": 0.3}
#: What a symbol's share is taken to be before any text is seen, and how many symbols' weight that has.
_SHARES = {c: 0.86 * p / 100.7 for c, p in _LETTERS.items()} | {c.upper(): 0.06 * p / 100.7 for c, p in _LETTERS.items()} | dict.fromkeys(_DIGITS, 0.004) | dict.fromkeys("+/-_", 0.01)
PRIOR_SYMBOLS = 100_000
_PARTS = "array<struct<start:int,kind:int,end:int,value:string>>"


def text_bits(df: DataFrame, text: str) -> dict[str, float]:
    """Bits of each symbol in text: minus the logarithm of its share in all rows' words of fewer than LEAST symbols, whole texts.

    Longer strings are what is tested, so they take no part. Shares start from those of Latin-script text, with the weight of
    PRIOR_SYMBOLS symbols, so that a small table has shares too. Words are counted first, on the map's side, and taken apart
    once each; what comes to the driver is a count a symbol.
    """
    words = df.select(F.explode(F.split(F.coalesce(F.col(text), F.lit("")), "[^A-Za-z0-9+/_-]+")).alias("word"))
    words = words.where(F.length("word").between(1, LEAST - 1)).groupBy("word").agg(F.count("*").alias("n"))
    symbols = words.select("n", F.explode(F.split("word", "")).alias("symbol"))
    found = {r["symbol"]: r["n"] for r in symbols.groupBy("symbol").agg(F.sum("n").alias("n")).collect()}
    counts = {c: found.get(c, 0) + PRIOR_SYMBOLS * p for c, p in _SHARES.items()}
    total = sum(counts.values())
    return {c: math.log2(total / n) for c, n in counts.items()}


def _alphabet(value: Column) -> Column:
    out = F.lit(None).cast("string")
    for _, symbols in reversed(ENCODINGS):
        escaped = symbols.replace("-", r"\-")
        out = F.when(value.rlike(f"^[{escaped}]+$"), F.lit(symbols)).otherwise(out)
    return F.when(value.rlike("^[0-9]+$"), F.lit(None)).otherwise(out)


def _two_sided(z: Column) -> Column:
    """The chance of a normal value beyond +-z, by the logistic approximation (within 0.0002)."""
    a = F.abs(z)
    return 2 / (1 + F.exp(1.5976 * a + 0.07056 * a * a * a))


def battery(value: Column, text_bits: dict[str, float]) -> Column:
    """struct<bits, p_chi, p_runs, p_serial> of a string; null if it has no testable encoding."""
    bits_of = F.create_map(*(x for c, b in text_bits.items() for x in (F.lit(c), F.lit(b))))

    def tested(alphabet: Column) -> Column:
        symbols, n, size = F.regexp_extract_all(alphabet, F.lit("."), F.lit(0)), F.length(value).cast("double"), F.length(alphabet).cast("double")
        tallies = F.transform(symbols, lambda c: F.struct(c.alias("symbol"), (n - F.length(F.replace(value, c, F.lit("")))).alias("n")))
        squares = F.aggregate(tallies, F.lit(0.0), lambda a, t: a + t["n"] * t["n"])
        bits = F.aggregate(tallies, F.lit(0.0), lambda a, t: a + t["n"] * (F.element_at(bits_of, t["symbol"]) - F.log2(size)))
        chi, free = squares * size / n - n, size - 1
        # Wilson and Hilferty: the cube root of chi-squared over its freedom is about normal. Only too uneven counts.
        z_chi = (F.pow(chi / free, F.lit(1 / 3)) - (1 - 2 / (9 * free))) / F.sqrt(2 / (9 * free))
        places = F.transform(F.regexp_extract_all(value, F.lit("."), F.lit(0)), lambda c: F.position(c, alphabet))
        middle = (size + 1) / 2
        start = F.struct(F.lit(None).cast("double").alias("last"), *(F.lit(0.0).alias(k) for k in ("runs", "high", "cross", "square")))

        def step(s: Column, place: Column) -> Column:
            x = place.cast("double") - middle
            return F.struct(
                x.alias("last"),
                (s["runs"] + F.when(s["last"].isNull() | ((s["last"] > 0) != (x > 0)), 1.0).otherwise(0.0)).alias("runs"),
                (s["high"] + F.when(x > 0, 1.0).otherwise(0.0)).alias("high"),
                (s["cross"] + F.coalesce(s["last"] * x, F.lit(0.0))).alias("cross"),
                (s["square"] + x * x).alias("square"),
            )

        def close(s: Column) -> Column:
            high, low = s["high"], n - s["high"]
            mean, spread = 2 * high * low / n + 1, 2 * high * low * (2 * high * low - n) / (n * n * (n - 1))
            z_runs = F.when(spread > 0, (s["runs"] - mean) / F.sqrt(spread)).otherwise(99.0)
            z_serial = F.when(s["square"] > 0, s["cross"] / s["square"] * F.sqrt(n)).otherwise(99.0)
            p_chi = F.when(z_chi > 0, _two_sided(z_chi) / 2).otherwise(0.5)
            return F.struct(bits.alias("bits"), p_chi.alias("p_chi"), _two_sided(z_runs).alias("p_runs"), _two_sided(z_serial).alias("p_serial"))

        return F.aggregate(places, start, step, close)

    alphabet = _alphabet(value)
    return F.element_at(F.transform(F.array(alphabet), lambda a: F.when(a.isNotNull(), tested(a))), 1)


def remaining(span: Column, base: Column) -> Column:
    """The parts of a string outside all base spans, as spans with values; parts of fewer than LEAST symbols are left out.

    ``base`` is sorted by start.
    """
    none = F.array().cast(_PARTS)

    def until(s: Column, end: Column) -> Column:
        value = F.substring(span["value"], s["at"] - span["start"] + 1, end - s["at"])
        part = F.struct(s["at"].alias("start"), span["kind"].alias("kind"), end.alias("end"), value.alias("value"))
        return F.when(end - s["at"] >= LEAST, F.concat(s["out"], F.array(part))).otherwise(s["out"])

    def step(s: Column, own: Column) -> Column:
        return F.struct(F.greatest(s["at"], own["end"]).alias("at"), until(s, own["start"]).alias("out"))

    covering = F.filter(base, lambda b: (b["start"] < span["end"]) & (span["start"] < b["end"]))
    return F.aggregate(covering, F.struct(span["start"].alias("at"), none.alias("out")), step, lambda s: until(s, span["end"]))


def segments(part: Column) -> Column:
    """The runs of letters and digits between the signs in a part, as spans with values, if they have LEAST symbols or more.

    A part without signs has none.
    """

    def step(s: Column, run: Column) -> Column:
        end = s["at"] + F.length(run)
        own = F.struct(s["at"].alias("start"), part["kind"].alias("kind"), end.alias("end"), run.alias("value"))
        keep = (F.length(run) >= LEAST) & (F.length(run) < F.length(part["value"]))
        return F.struct((end + 1).alias("at"), F.when(keep, F.concat(s["out"], F.array(own))).otherwise(s["out"]).alias("out"))

    start = F.struct(part["start"].alias("at"), F.array().cast(_PARTS).alias("out"))
    return F.aggregate(F.split(part["value"], "[+/_-]", -1), start, step, lambda s: s["out"])


def tests_of(part: Column, text_bits: dict[str, float]) -> Column:
    """struct<start, kind, end, test> of a part and, if it isn't uniform as a whole, of each of its segments; so no two that are overlap."""

    def tested(own: Column, test: Column) -> Column:
        return F.struct(own["start"].alias("start"), own["kind"].alias("kind"), own["end"].alias("end"), test.alias("test"))

    none = F.array().cast("array<struct<start:int,kind:int,end:int,test:struct<bits:double,p_chi:double,p_runs:double,p_serial:double>>>")

    def with_segments(test: Column) -> Column:
        inner = F.transform(segments(part), lambda s: tested(s, battery(s["value"], text_bits)))
        return F.concat(F.array(tested(part, test)), F.when(~F.coalesce(uniform(test), F.lit(False)), inner).otherwise(none))

    return bound(battery(part["value"], text_bits), with_segments)


def uniform(test: Column) -> Column:
    """Whether no test of the battery rejects."""
    return F.least(test["p_chi"], test["p_runs"], test["p_serial"]) >= ALPHA / 3


def scan(df: DataFrame, text: str = "text", carry: list[str] | None = None, fdr: float = FDR) -> DataFrame:
    """The carried columns, ``base`` (spans of the fixed forms) and ``spans`` (all), arrays of struct<start, kind, end>.

    A row per row: a null or empty text has no spans, repeated rows have equal ones, and texts are searched whole.
    Spans that begin alike come in the order of their kinds. Base spans are cut out of each string of no known form,
    and every part of 20 symbols or more that remains is tested by itself; where it fails, so are its runs of letters and digits.
    Texts are read twice, first for the shares of symbols.
    Columns that aren't carried are left out whatever their names; an empty table gives no row.
    """
    carry = kept(carry, "base", "spans")
    own = df.select(*(F.col(c).alias(f"__c{i}") for i, c in enumerate(carry)), F.coalesce(F.col(text), F.lit("")).alias("__text"))
    bits = text_bits(own, "__text")
    own = add_spans(own, "__text", "assign", ASSIGN, 0)
    own = add_spans(own, "__text", "access", ACCESS, 1, "AKIA")
    own = add_spans(own, "__text", "hex", HEX, 2)
    own = add_spans(own, "__text", "string", STRING, 3)
    assigned = F.filter("assign", lambda s: F.length(F.regexp_extract(s["value"], ASSIGN, 1)) >= 6)
    own = own.withColumn("base", narrow(F.concat(assigned, F.col("access"), F.col("hex"))))
    own = own.withColumn("parts", F.flatten(F.transform("string", lambda s: remaining(s, F.col("base")))))
    tested = F.flatten(F.transform("parts", lambda p: tests_of(p, bits)))
    own = own.withColumn("tested", F.filter(tested, lambda s: s["test"].isNotNull()))
    carried = [F.col(f"__c{i}") for i in range(len(carry))]
    scanned = materialize(own.select(*carried, "base", "tested"), "secrets")
    threshold = bits_threshold(scanned.select(F.explode("tested").alias("s")).select("s.test.*"), fdr)
    random = F.filter("tested", lambda s: passes(s["test"], threshold))
    return scanned.select(*(c.alias(name) for c, name in zip(carried, carry, strict=True)), "base", F.array_sort(F.concat("base", narrow(random))).alias("spans"))


def passes(test: Column, threshold: float) -> Column:
    """Uniform by every test, and more bits from text than the threshold."""
    return (test["bits"] >= threshold) & uniform(test)


def bits_threshold(tests: DataFrame, fdr: float) -> float:
    """Whole bits from which on strings are discoveries: the smallest b with 2 ** -b <= fdr * (strings of b bits or more) / all.

    What comes to the driver is a count for each number of bits up to MOST_BITS.
    """
    bits = F.greatest(F.lit(0), F.least(F.lit(MOST_BITS), F.floor("bits"))).cast("int")
    eligible = uniform(F.struct("p_chi", "p_runs", "p_serial"))
    rows = tests.groupBy(bits.alias("bits")).agg(F.count("*").alias("all"), F.count_if(eligible).alias("n")).collect()
    total, reached, best = sum(r["all"] for r in rows), 0, math.inf
    for r in sorted(rows, key=lambda r: -r["bits"]):
        reached += r["n"]
        if reached and -r["bits"] <= math.log2(fdr * reached / total):
            best = r["bits"]
    return float(best)


def report(scanned: DataFrame, carry: list[str]) -> DataFrame:
    """Counts by fixed form, the digest of the base spans, and all spans as text."""
    return scanned.select(*carry, *(count(F.col("base"), k).alias(f"n_{KINDS[k]}") for k in range(3)), F.sha2(listed(F.col("base"), KINDS), 256).alias("base_sha256"), listed(F.col("spans"), KINDS).alias("spans"))


def redact(df: DataFrame, spans: str, text: str = "text", mark: str = "[SECRET]") -> Column:
    """The text with each run of overlapping spans replaced by ``mark``; all else stays as it is."""
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(s: Column, span: Column) -> Column:
        new = span["start"] >= s["at"]
        between = F.substring(F.col(text), s["at"] + 1, span["start"] - s["at"])
        return F.struct(F.greatest(s["at"], span["end"]).alias("at"), F.when(new, F.concat(s["out"], between, F.lit(mark))).otherwise(s["out"]).alias("out"))

    def close(s: Column) -> Column:
        return F.concat(s["out"], F.substring(F.col(text), s["at"] + 1, F.length(F.col(text))))

    return F.when(F.size(spans) > 0, F.aggregate(F.col(spans), start, step, close)).otherwise(F.col(text))
