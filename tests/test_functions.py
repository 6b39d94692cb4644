"""Column functions against plain Python, on made-up texts and on property-based ones."""

import random
import re
import unicodedata
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from textloom.functions import emoji, merge, text, tokens


def column(spark, values, f, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r.r for r in df.select("i", f(F.col("v")).alias("r")).orderBy("i").collect()]


def _mixed(n=300):
    rng = random.Random(2)
    pool = [" ", "  ", "\t", "\n", "\x1c", "\x85", "\xa0", "　", "a", "B", "É", "ß", "<AB_C>", "__EMOJI_3__", "__emoji_1_", "_", "__", "em oji 4", "E_M_O_J_I", "!", "¿", "⹓", "$", "<x>", "İ", "Σ", "."]
    return ["".join(rng.choice(pool) for _ in range(rng.randrange(14))) for _ in range(n)]


def test_strip_collapse_and_words(spark):
    values = _mixed()
    assert column(spark, values, text.strip) == [v.strip() for v in values]
    assert column(spark, values, text.words) == [v.split() for v in values]
    assert column(spark, values, text.collapse) == [re.sub(r"\s{2,}", " ", v).strip() for v in values]


def _outside(v, protected, change):
    out, at = [], 0
    for m in re.finditer(protected, v):
        out += [change(v[at : m.start()]), m[0]]
        at = m.end()
    return "".join([*out, change(v[at:])])


def test_lowercase_and_punctuation(spark):
    values = _mixed()
    both = r"<[A-Z_]+>|__EMOJI_\d+__"
    assert column(spark, values, text.lowercase) == [_outside(v, both, str.lower) for v in values]
    assert column(spark, values, lambda c: text.lowercase(c, text.ANGLE)) == [_outside(v, r"<[A-Z_]+>", str.lower) for v in values]

    def bare(v):
        v = _outside(v, both, lambda p: "".join(" " if unicodedata.category(c)[0] == "P" else c for c in p))
        return re.sub(r"\s{2,}", " ", v).strip()

    assert column(spark, values, text.strip_punctuation) == [bare(v) for v in values]


def test_remove_emoji_words(spark):
    assert column(spark, ["go __EMOJI_1_ now", "a __ b", "hot \U0001f525 __EMOJI _ 2__ end", "the Emoji word", "➖➖ __➖"], text.remove_emoji_words) == ["go now", "a b", "hot \U0001f525 end", "the word", "➖➖ __➖"]


@pytest.mark.parametrize("value, want", [
    ("httpswwwnewscomarticle", True), ("WWWexample", True), ("myaccountverifyloginexamplecomsecurehtml", True), ("  http  ", True), ("software123", False),
    ("", False), ("   ", False), ("http with spaces", False), ("tab\thttp", False), ("x" * 30 + "com", True), ("com" + "x" * 10, False), ("loginverify" + "q" * 20, True), (None, False),
])
def test_url_like(spark, value, want):
    assert column(spark, [value], text.is_url_like) == [want]


def test_placeholders(spark):
    assert column(spark, ["a <X> <Y_Z> <X> <x>", None, ""], text.extract_placeholders) == [["<X>", "<Y_Z>", "<X>"], [], []]
    assert column(spark, ["<A> <B> <A>", "<B> <A>", None], lambda c: text.placeholders_match(c, F.lit("<A> x <A> <B>"))) == [True, False, False]


def test_normalize_token_and_labels(spark):
    values = ["(Hello),", "<NAME>", "É!", "--", "<b", "don't.", "_x_"]
    assert column(spark, values, text.normalize_token) == [merge.bare(v) for v in values]
    assert column(spark, [0.85, 0.7, 0.5, 0.4, 0.2, None], text.quality_label, "double") == ["high_confidence", "high_confidence", "medium_confidence", "medium_confidence", "low_confidence", None]


def _mask(v):
    pattern = re.compile("[\U0001f1e6-\U0001f1ff]{2}|[\U0001f525✅\U0001f44d][\U0001f3fb-\U0001f3ff]?")
    out, kept, at = [], [], 0
    for i, m in enumerate(pattern.finditer(v)):
        left, right = v[m.start() - 1 : m.start()], v[m.end() : m.end() + 1]
        kept.append((f"__EMOJI_{i}__", m[0], bool(left) and not left.isspace(), bool(right) and not right.isspace()))
        out += [v[at : m.start()], f" __EMOJI_{i}__ "]
        at = m.end()
    return (" ".join("".join([*out, v[at:]]).split()) if kept else v), kept


def test_mask_and_unmask(spark):
    rng = random.Random(3)
    pool = ["\U0001f525", "✅", "\U0001f44d\U0001f3fd", "\U0001f1e9\U0001f1ea", " ", "\n", "a", "word", "é"]
    values = ["hello \U0001f525 world", "click now ✅\U0001f525", "", "plain  text", *("".join(rng.choice(pool) for _ in range(rng.randrange(9))) for _ in range(300))]
    got = column(spark, values, emoji.mask)
    for v, r in zip(values, got, strict=True):
        masked, kept = _mask(v)
        assert (r.masked_text, [tuple(x) for x in r.replacements], r.contains_emoji) == (masked, kept, bool(kept)), repr(v)
    back = column(spark, values, lambda c: emoji.unmask(emoji.mask(c)["masked_text"], emoji.mask(c)["replacements"]))
    assert back[0] == "hello \U0001f525 world" and back[3] == "plain  text"
    assert column(spark, ["a\U0001f525b"], lambda c: emoji.unmask(F.lit("x__EMOJI_0__ y"), emoji.mask(c)["replacements"])) == ["x\U0001f525y"]
    assert column(spark, ["2 # * 7 ☇ →", "©", "©️", "1️⃣", "\U0001f469‍\U0001f680"], emoji.contains_emoji) == [False, True, True, True, True]


def test_windows(spark):
    for n in (0, 1, 3, 6, 7, 8):
        for limit, overlap in ((3, 0), (3, 1), (3, 2), (6, 5)):
            words = [f"w{i}" for i in range(n)]
            got = column(spark, [words], lambda c, k=limit, o=overlap: tokens.windows(c, k, o), "array<string>")[0]
            want = max(1, -(-(n - overlap) // (limit - overlap))) if n > limit else 1
            assert len(got) == want and got[-1].end == n
            assert all(w.text.split() == words[w.start : w.end] and len(w.text.split()) <= limit for w in got)
            assert all(a.start + limit - overlap == b.start for a, b in zip(got, got[1:], strict=False))
            assert column(spark, [words], lambda c, k=limit, o=overlap: tokens.window_count(c, k, o), "array<string>") == [want]
    for limit, overlap in ((0, 0), (3, 3), (3, -1)):
        with pytest.raises(ValueError):
            tokens.check_window(limit, overlap)
    assert column(spark, [[]], lambda c: tokens.hard_split(c, 3), "array<string>") == [[]]
    assert column(spark, ["", None, "a b", " "], tokens.token_count) == [0, 0, 3, 1]


def test_merges(spark):
    chunks = [["a b c", "b c d", " ", "d e"], ["x  y", "z"], [], ["one"], ["a b", "a b"]]
    assert column(spark, chunks, tokens.merge_exact, "array<string>") == ["a b c d e", "x  y z", "", "one", "a b"]
    assert column(spark, [["a", "", " b "]], tokens.merge_plain, "array<string>") == ["a  b"]
    whole = " ".join(f"w{i}" for i in range(100)).split()
    cut = [" ".join(whole[i : i + 30]) for i in range(0, 90, 22)]
    assert merge.merge_fuzzy(cut) == " ".join(whole[:100])
    rows = spark.createDataFrame([(1, cut, "kept"), (2, None, None)], "i int, cut array<string>, other string")
    assert [tuple(r) for r in merge.with_merged(rows, "cut", "m").orderBy("i").collect()] == [(1, "kept", " ".join(whole[:100])), (2, None, "")]
    assert merge.merge_fuzzy(["it was a dark night and", "A dark, stormy night it seemed"]) == "it was A dark, stormy night it seemed"
    assert merge.merge_fuzzy(["he said The End. then more", "the end was near"]) == "he said the end was near"
    assert merge.merge_fuzzy(["no word is", "shared by these"]) == "no word is shared by these"
    assert merge.merge_fuzzy(["  ", "x"]) == "x" and merge.merge_fuzzy([]) == ""


def test_exact_overlap_goes_first():
    """Words of a period: a longer overlap that is nearly exact would score above the exact one, and drop the end."""
    whole = [f"w{i}" for i in range(60)] + "on and on it goes".split() * 6
    cut = [" ".join(whole), " ".join([*whole[-10:], *"on and on it".split(), "<END>"])]
    assert merge.overlap_size(cut[0].split(), cut[1].split()) == 15
    assert merge.merge_fuzzy(cut) == " ".join([*whole, *"on and on it".split(), "<END>"])
    assert merge.exact_size("a b c d".split(), "a b c d".split()) == 0 and merge.exact_size([], ["a"]) == 0


def test_overlap_by_definition():
    rng = random.Random(4)

    def ratio(a, b):
        return SequenceMatcher(None, a, b).ratio() if a and b else 0.0

    for _ in range(200):
        before = [rng.choice("abc") for _ in range(rng.randrange(3, 20))]
        after = before[-rng.randrange(1, 9) :] + [rng.choice("abc") for _ in range(5)]
        scores = []
        for n in range(5, min(len(before), len(after), 30) + 1):
            a, b = before[-n:], after[:n]
            inner = max(ratio(a[t : n - t], b[t : n - t]) for t in range(3))
            if ratio(a, b) >= 0.72 or inner >= 0.85:
                scores.append((0.45 * ratio(a, b) + 0.55 * inner + 0.01 * n, -n))
        assert merge.overlap_size(before, after) == (-max(scores)[1] if scores else 0)
