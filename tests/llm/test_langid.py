import random
import unicodedata
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from textloom.llm import langid
from textloom.llm.queries import op5_language_id

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    truth = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = op5_language_id(spark, SF).collect()
    assert len(rows) == len(truth)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    apart = [r for r in rows if r.held_out and truth[r.doc_id].lang]
    assert sum(r.lang_pred == truth[r.doc_id].lang for r in apart) >= 0.98 * len(apart)
    assert all(0 <= r.score <= 1 for r in rows)


def test_grams_against_strings():
    text = "Ab c1dé  FGH\n"
    words = ["ab", "c", "dé", "fgh"]
    for order in langid.ORDERS:
        want = {f" {w} "[i : i + order] for w in words for i in range(len(w) + 3 - order)}
        want_h = {int(langid.gram_hashes(np.array([ord(c) for c in g], np.uint32), order)[0]) for g in want if len(g) == order}
        assert set(langid.gram_hashes(langid.letters_of(text), order).tolist()) == want_h


def test_masks_return_every_language():
    a, b = (langid.gram_hashes(langid.letters_of(t), 3) for t in ("hello world", "hello monde"))
    own = langid.build({"x": a, "y": b})
    assert (own.containing(a) & 1 == 1).all() and (own.containing(b) & 2 == 2).all()
    both = np.intersect1d(a, b)
    assert len(both) and (own.containing(both) == 3).all()


def test_false_positives_are_taken_off():
    rng = np.random.default_rng(1)
    full = rng.integers(0, 1 << 63, 200_000, np.uint64)
    own = langid.build({"big": full, "small": full[:50]})
    stray = rng.integers(0, 1 << 63, 20_000, np.uint64)
    share = (own.containing(stray) & np.uint8(1)).mean()
    assert abs(share - own.false_rate[0]) < 0.02 and own.false_rate[1] < 1e-6


def test_more_than_eight_languages():
    grams = {f"l{k:02d}": langid.gram_hashes(langid.letters_of(f"zz{chr(97 + k)}q" * 5), 3) for k in range(20)}
    own = langid.build(grams)
    assert all(own.predict(f"zz{chr(97 + k)}q" * 5)[0] == f"l{k:02d}" for k in range(20))


def test_more_languages_than_a_word_has_bits():
    words = {f"l{k:03d}": f"q{chr(97 + k // 26)}{chr(97 + k % 26)}x " * 5 for k in range(150)}
    own = langid.build({name: langid.gram_hashes(langid.letters_of(t), 4) for name, t in words.items()})
    assert own.masks.shape[1] == 3 and [own.predict(t)[0] for t in words.values()] == list(words)


def test_edge_cases(spark):
    texts = ["the house and the garden", None, "", "123 ... !!", "das Haus und der Garten", "x", "haus " * 40_000, "the house and the garden"]
    rows = [(i, t, lang, "clash") for i, (t, lang) in enumerate(zip(texts, ["en", "en", None, "de", "de", None, None, "en"], strict=True))]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, score string")
    own = langid.fit(df, F.col("doc_id"))
    got = {r.doc_id: (r.lang_pred, r.score) for r in langid.predict_column(df, own, carry=["doc_id"]).collect()}
    assert own.langs == ["de", "en"]
    assert got[1] == got[2] == got[3] == ("und", 0.0)
    assert got[0][0] == got[7][0] == "en" and got[4][0] == got[6][0] == "de" and got[5][0] in own.langs
    none = langid.fit(df.limit(0), F.col("doc_id"))
    assert none.langs == [] and langid.predict_column(df.limit(1), none).collect()[0].lang_pred == "und"
    assert langid.predict_column(df.limit(0), own).count() == 0


def test_long_texts_are_whole():
    text = "word " * 30_000 + "zzq"
    assert sum(len(g) for k, g in enumerate(langid.grams_of(text)) if k % 3 == 1) == 4 * 30_000 + 3


def _brute_grams(text):
    """All n-grams by definition: words are letters and the marks after them."""
    words, word = [], ""
    for c in text:
        mark = unicodedata.category(c) in ("Mn", "Mc", "Me") or c in "\u200c\u200d"
        if c.isalpha() or mark and word:
            word += c if mark or len(c.lower()) > 1 else c.lower()
        elif word:
            words.append(word)
            word = ""
    words += [word] if word else []
    return Counter(f" {w} "[i : i + n] for w in words for n in langid.ORDERS for i in range(len(w) + 3 - n))


def _hash(gram):
    return int(langid.gram_hashes(np.array([ord(c) for c in gram], np.uint32), len(gram))[0])


def test_grams_do_not_depend_on_where_pieces_are_cut(monkeypatch):
    rng = random.Random(5)
    pool = ["a", "É", "न", "म", "स", "्", "ते", "ท", "ี", "่", " ", ".", "1", "\u200d", "İ", "中", "文", "\u0301", "-", "\n"]
    for piece in (1, 2, 3, 5, 1000):
        monkeypatch.setattr(langid, "_PIECE", piece)
        for _ in range(60):
            text = "".join(rng.choice(pool) for _ in range(rng.randrange(1, 30)))
            want = Counter()
            for gram, n in _brute_grams(text).items():
                want[_hash(gram)] += n
            assert Counter(h for part in langid.grams_of(text) for h in part.tolist()) == want, (piece, text)


def test_long_text_without_spaces():
    text = "".join(chr(0x4E00 + i * 7919 % 20_000) for i in range(200_000))
    assert [sum(len(g) for k, g in enumerate(langid.grams_of(text)) if k % 3 == j) for j in range(3)] == [200_001, 200_000, 199_999]


def test_marks_are_part_of_words():
    assert "".join(map(chr, langid.letters_of("नमस्ते ́x"))) == " नमस्ते x "


def test_three_hundred_languages_and_every_gram(spark):
    letters = "abcdefghijklmnopqrst"
    rows = [(k, f"{letters[k // 20]}{letters[k % 20]}z{letters[k % 20]} " * 4, f"l{k:03d}") for k in range(300)]
    own = langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), F.col("doc_id"))
    assert len(own.langs) == 300 and own.masks.shape[1] == 5
    assert sum(own.predict(t)[0] == name for _, t, name in rows) >= 298
    whole = "".join(chr(0x4E00 + i) for i in range(19_000))  # more n-grams than any fixed number would hold
    one = langid.fit(spark.createDataFrame([(1, whole, "zh"), (2, "abc", "xx")], "doc_id long, text string, lang string"), F.col("doc_id"))
    assert all((one.containing(g) & 2 == 2).all() for g in langid.grams_of(whole))


def test_equal_labelled_rows_are_learned_from(spark):
    df = spark.createDataFrame([(1, "the same row", "en")] * 50, "doc_id long, text string, lang string")
    assert langid.fit(df, F.col("doc_id"), sample_rows=1).predict("same")[0] == "en"


def test_fit_against_brute_force(spark):
    rows = [(i, t, lang) for i, (t, lang) in enumerate([("the house and the garden", "en"), ("das Haus und der Garten", "de"), ("la maison et le jardin", "fr"), ("the old man", "en")])]
    own = langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), F.col("doc_id"))
    counts = {}
    for _, t, lang in rows:
        counts.setdefault(lang, Counter()).update(_brute_grams(t))
    share = {lang: {g: n / sum(c.values()) for g, n in c.items()} for lang, c in counts.items()}
    kept = {lang: [g for g, x in c.items() if x >= langid.KEEP_RATIO * max(o.get(g, 0) for o in share.values())] for lang, c in share.items()}
    want = langid.build({lang: np.array([_hash(g) for g in grams], np.uint64) for lang, grams in kept.items()})
    assert own.langs == want.langs and (own.masks == want.masks).all() and (own.false_rate == want.false_rate).all()
