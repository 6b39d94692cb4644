"""Personal data, native: fixed forms, and contextual extraction bootstrapped from them.

The fixed forms are seeds. The two words before an entity, an earlier entity counting as one, are a lexical pattern. Patterns and values
form a graph that Spark scores in rounds: a pattern's confidence for a kind is the share of its
values that are known to be of the kind, an unknown value's is one less the product of its patterns'
doubts. Confident patterns thus find identifiers of an unseen form, and these count for the next round.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.functions.text import bound
from textloom.llm.common import attach, kept, materialize
from textloom.llm.spans import add_spans, count, listed, narrow, overlaps

KINDS = ["email", "ip", "card", "phone", "ctx_email", "ctx_ip", "ctx_card", "ctx_phone"]
BASE = 4
# The look-behind and \G let a search start only where a leftmost match can, so that long runs cost no more than
# their length; possessive groups hold because nothing after them could take back what they took.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}+"
CARD = r"[0-9](?:[\x20-]?[0-9]){11,}+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
#: A whole run of these characters, at any length, with a digit or an at sign anywhere in it, up to its last letter or
#: digit: what may be an identifier of an unseen form.
LIKE = r"(?<![A-Za-z0-9@._:+-])(?=[A-Za-z._:+-]*+[0-9@])[A-Za-z0-9@._:+-]{5,}[A-Za-z0-9]"

ROUNDS = 3
#: Distinct known values that a pattern needs.
SUPPORT = 5
#: Share of a pattern's values that must be known to be of the kind.
PATTERN_CONFIDENCE = 0.8
VALUE_CONFIDENCE = 0.9
#: Patterns of more letters are kept as their first ones and a digest of the whole, so that equal ones stay equal.
PATTERN_LETTERS = 80
#: What stands for an earlier entity in a pattern, and for the start of the text.
ENTITY, START = "<id>", "^"
#: What may stand between the words and the entity.
_OPENERS = " \t\n\r\x0b\x0c(\"'[<"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    n = F.length(digits)

    def add(total: Column, i: Column) -> Column:
        d = F.substring(digits, n - i + 1, F.lit(1)).cast("int")
        doubled = 2 * d - F.when(d > 4, 9).otherwise(0)
        return total + F.when(i % 2 == 0, doubled).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add) % 10 == 0


def _byte(part: Column) -> Column:
    bare = F.regexp_replace(part, "^0+", "")
    return (F.length(bare) < 3) | ((F.length(bare) == 3) & (bare <= "255"))


def with_base(df: DataFrame, text: str) -> DataFrame:
    """Adds the arrays email, ip, card and phone: the fixed forms' spans that pass their checks."""
    df = add_spans(df, text, "email", EMAIL, 0, "@")
    df = add_spans(df, text, "ip", IP, 1, ".")
    df = add_spans(df, text, "card", CARD, 2)
    df = add_spans(df, text, "phone", PHONE, 3, "+")
    df = df.withColumn("ip", F.filter("ip", lambda s: F.forall(F.split(s["value"], r"\."), _byte)))
    df = df.withColumn("card", F.filter("card", lambda s: F.length(_digits(s["value"])).between(12, 19) & luhn(_digits(s["value"]))))
    return df.withColumn("phone", F.filter("phone", lambda s: F.length(_digits(s["value"])).between(9, 15)))


def _words(gap: Column) -> Column:
    bare = F.rtrim(F.ltrim(gap, F.lit(_OPENERS)), F.lit(_OPENERS))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, r"\s+"))


def with_pattern(spans: Column) -> Column:
    """Spans (of one form, in order) with the pattern of each: the two words before it, of any length, in lower case with
    digits as 0. The match before counts as one word, whatever it is, and the start of the text as two."""
    start, entity = F.array(F.lit(START), F.lit(START)), F.array(F.lit(ENTITY))

    def own(s: Column, i: Column) -> Column:
        last = F.get(spans, i - 1)["gap"]
        before = F.when(i == 0, start).otherwise(F.concat(F.array(F.lit(START)), F.slice(_words(last), -1, 1), entity))
        near = bound(_words(s["gap"]), lambda w: F.when(F.size(w) >= 2, F.slice(w, -2, 2)).otherwise(F.slice(F.concat(before, w), -2, 2)))
        text = F.lower(F.regexp_replace(F.array_join(near, " "), "[0-9]", "0"))
        kept = bound(text, lambda t: F.when(F.length(t) > PATTERN_LETTERS, F.concat(F.left(t, F.lit(PATTERN_LETTERS)), F.lit("#"), F.sha1(t.cast("binary")))).otherwise(t))
        return F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"), s["value"].alias("value"), kept.alias("pattern"))

    return F.transform(spans, own)


def shapes(value: Column) -> Column:
    """For each kind, whether an unknown value could be of it at all."""
    digits = F.length(_digits(value))
    return F.array(
        F.contains(value, F.lit("@")),
        value.rlike(r"^[0-9A-Fa-f]++(?:[.:]++[0-9A-Fa-f]++){2,}+$") & (digits >= 3),
        (digits >= 10) & value.rlike("^[0-9.:-]++$"),
        (digits >= 7) & value.rlike("^[0-9+.-]++$"),
    )


def bootstrap(graph: DataFrame, rounds: int = ROUNDS, support: int = SUPPORT, pattern_confidence: float = PATTERN_CONFIDENCE, value_confidence: float = VALUE_CONFIDENCE) -> DataFrame | None:
    """Rows (value, kind) of newly found identifiers; None if no pattern is confident enough to find any.

    ``graph`` has distinct rows (pattern, value, kind, shapes); kind is null where it is unknown. A value
    gets the kind with the highest score, of equals the first.
    """
    state = materialize(graph.withColumn("score", F.when(F.col("kind").isNotNull(), 1.0)), "pii-graph")
    found = None
    for _ in range(rounds):
        known = [F.coalesce(F.sum(F.when(F.col("kind") == k, F.col("score"))), F.lit(0.0)) for k in range(BASE)]
        rated = state.groupBy("pattern").agg(F.array(*known).alias("known"), F.count("*").alias("n"), F.count_if(F.col("kind").isNull()).alias("unknown"))
        best = F.array_max("known")
        rated = rated.where((F.col("unknown") > 0) & (best >= support) & (best >= pattern_confidence * F.col("n")))
        rated = rated.select("pattern", "n", F.struct((F.array_position("known", best) - 1).cast("int").alias("kind"), F.least(best / F.col("n"), F.lit(0.999)).alias("confidence")).alias("rating"))
        rated = materialize(rated, "pii-patterns")
        if rated.isEmpty():
            break
        unknown = state.where(F.col("kind").isNull())
        rows = attach(unknown, rated, "pattern", "rating", "n", F.xxhash64("value")).where(F.col("rating").isNotNull() & F.get(F.col("shapes"), F.col("rating.kind")))
        scored = rows.groupBy("value", "rating.kind").agg((1 - F.exp(F.sum(F.log(1 - F.col("rating.confidence"))))).alias("score"))
        scored = scored.where(F.col("score") >= value_confidence)
        chosen = scored.groupBy("value").agg(F.max(F.struct("score", -F.col("kind"))).alias("best"))
        chosen = chosen.select("value", F.struct((-F.col("best.col2")).cast("int").alias("kind"), F.col("best.score").alias("score")).alias("new"))
        sizes = state.groupBy("value").agg(F.count("*").alias("n"))
        chosen = materialize(chosen.join(sizes, "value"), "pii-values")
        if chosen.isEmpty():
            break
        found = chosen.select("value", "new.kind") if found is None else found.union(chosen.select("value", "new.kind"))
        told = attach(state, chosen, "value", "new", "n", F.xxhash64("pattern"))
        state = materialize(told.select("pattern", "value", F.coalesce("kind", "new.kind").alias("kind"), "shapes", F.coalesce("score", "new.score").alias("score")), "pii-graph")
    return found


def find(df: DataFrame, text: str = "text", carry: list[str] | None = None, **options: float) -> DataFrame:
    """The carried columns, ``base`` (the fixed forms' spans) and ``spans`` (all), arrays of struct<start, kind, end>.

    A row per row: a null or empty text has no spans, repeated rows have equal ones, and texts are searched whole.
    Spans that begin alike come in the order of their kinds. Columns that aren't carried are left out whatever
    their names; an empty table gives no row. ``options`` go to `bootstrap`.
    """
    carry = kept(carry, "base", "spans")
    own = df.select(*(F.col(c).alias(f"__c{i}") for i, c in enumerate(carry)), F.coalesce(F.col(text), F.lit("")).alias("__text"))
    own = with_base(own, "__text")
    own = add_spans(own, "__text", "like", LIKE, BASE)
    own = own.withColumn("base", narrow(F.concat("email", "ip", "card", "phone")))
    free = F.filter(with_pattern(F.col("like")), lambda s: ~overlaps(s, F.col("base")) & F.exists(shapes(s["value"]), lambda x: x))
    in_context = F.concat(*(with_pattern(F.col(k)) for k in ("email", "ip", "card", "phone")), free)
    carried = [f"__c{i}" for i in range(len(carry))]
    # Rows are told apart by two unlike hashes (96 bits; 64 would meet by chance in some billions of rows) of all that is
    # carried and the text; rows that agree in all of it have equal spans.
    row = F.struct(F.xxhash64(*carried, "__text").alias("a"), F.hash(*carried, "__text").alias("b"))
    scanned = materialize(own.select(*carried, row.alias("__row"), "base", in_context.alias("entities")), "pii")
    entities = scanned.select("__row", F.explode("entities").alias("e")).select("__row", "e.*")
    graph = entities.groupBy("pattern", "value").agg(F.min(F.when(F.col("kind") < BASE, F.col("kind"))).alias("kind"))
    found = bootstrap(graph.withColumn("shapes", shapes(F.col("value"))), **options)
    if found is None:
        full = scanned.withColumn("spans", F.col("base"))
    else:
        unknown = entities.where(F.col("kind") == BASE).drop("kind")
        counts = unknown.groupBy("value").agg(F.count("*").alias("n"))
        facts = materialize(found.join(counts, "value").select("value", F.col("kind").alias("new"), "n"), "pii-found")
        hits = attach(unknown, facts, "value", "new", "n", F.xxhash64("__row", "start")).where(F.col("new").isNotNull())
        more = hits.groupBy("__row").agg(F.collect_set(F.struct("start", (F.col("new") + BASE).alias("kind"), "end")).alias("more")).withColumnRenamed("__row", "__more_row")
        joined = scanned.join(more, F.col("__row") == F.col("__more_row"), "left")
        full = joined.withColumn("spans", F.array_sort(F.concat("base", F.coalesce("more", F.array()))))
    return full.select(*(F.col(c).alias(name) for c, name in zip(carried, carry, strict=True)), "base", "spans")


def report(found: DataFrame, carry: list[str]) -> DataFrame:
    """Counts by fixed form, the digest of the base spans, and all spans as text."""
    return found.select(*carry, *(count(F.col("base"), k).alias(f"n_{KINDS[k]}") for k in range(BASE)), F.sha2(listed(F.col("base"), KINDS), 256).alias("base_sha256"), listed(F.col("spans"), KINDS).alias("spans"))
