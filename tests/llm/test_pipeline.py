import zlib

import public_tokenizers
from pyspark.sql import functions as F

import corpus_pipeline as cp
from tests.llm.test_secrets import _base
from tests.llm.test_simhash import _classes, _print
from textloom.llm.packing import token_ids

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def test_pipeline_against_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    docs = sorted((tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()), key=lambda r: r[0])
    named = [d for d in docs if d[1] and any(c.isalpha() for c in d[1])]
    prints = [_print(d[1]) for d in named]
    single = [d for i, (d, c) in enumerate(zip(named, _classes(prints), strict=True)) if i == c]
    stages, at = [], spark.read.parquet(f"{sf}/documents.parquet")
    for _, stage in cp.STAGES:
        at = spark.createDataFrame(stage(spark, at, sf).collect() or [], at.schema) if stage is not cp.pack else stage(spark, at, sf)
        stages.append(sorted((tuple(r) for r in at.collect()), key=repr))
    assert stages[0] == sorted(named, key=repr)
    assert stages[1] == sorted(single, key=repr)
    clean = {d for d in single if not _base(d[1])}
    assert clean <= set(stages[2]) and len(stages[2]) == len(single)
    for d in set(stages[2]) - clean:
        assert "[SECRET]" in d[1] and d[4] == len(d[1]) and not [b for b in _base(d[1]) if b[1] != 0]
    ids = {d[0]: len(token_ids(d[1], public_tokenizers.path("byte_bpe_50k.json"))) for d in stages[2]}
    rows = at.groupBy("doc_id").agg(F.sum("length").alias("n")).collect()
    assert {r.doc_id: r.n for r in rows} == ids


def test_nulls_repeats_and_empty(spark):
    text = "one two three four five six seven eight nine ten"
    rows = [(1, text, "en", "s", 9), (1, text, "en", "s", 9), (1, text, None, "s", 9), (2, text, "en", "s", 9), (None, text, "en", None, None), (3, None, "en", "s", 0), (4, "", None, "s", 0), (5, "123", "en", "s", 3), (6, "something quite different, password = hunter2xyz indeed", "en", "s", None)]
    docs = spark.createDataFrame(rows, COLUMNS)
    named = cp.identify(spark, docs, "")
    assert sorted(str(r.doc_id) for r in named.collect()) == ["1", "1", "1", "2", "6", "None"]
    single = cp.deduplicate(spark, named, "")
    assert sorted((tuple(r) for r in single.collect()), key=repr) == sorted([(1, text, None, "s", 9), rows[4], rows[8]], key=repr)
    scrubbed = {r.doc_id: r for r in cp.scrub(spark, single, "").collect()}
    assert scrubbed[6].text == "something quite different, [SECRET] indeed" and scrubbed[6].n_chars == 42
    assert tuple(scrubbed[1]) == (1, text, None, "s", 9)
    for _, stage in cp.STAGES:
        assert stage(spark, docs.limit(0), "").count() == 0


def test_nothing_to_learn_a_language_from(spark):
    apart = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 4 == 2)
    texts = ["clean words", "é", "x1", "clean words", "123 !", "", None, "7 " * 70_000 + "ü"]
    for lang, ids in ((None, range(len(texts))), ("en", [apart] * len(texts))):
        rows = [(i, t, lang, "s", 9) for i, t in zip(ids, texts, strict=True)]
        got = cp.identify(spark, spark.createDataFrame(rows, COLUMNS), "")
        assert got.schema.names == [c.split()[0] for c in COLUMNS.split(", ")]
        assert sorted(map(tuple, got.collect()), key=repr) == sorted((r for r in rows if any(c.isalpha() for c in r[1] or "")), key=repr)


def test_columns_of_any_name(spark):
    extra = ["own", "keeps", "n", "lang_pred", "score", "spans", "base", "fp", "component_id", "first", "scrubbed", "a.b", "piece", "length", "__text", "key"]
    rows = [(i, f"one two three four five six {w} eight nine secret=abcdefgh", "en", "s", 9, *range(len(extra))) for i, w in enumerate(["apple", "apple", "melon", "quite another thing this is"])]
    docs = spark.createDataFrame(rows, COLUMNS + ", " + ", ".join(f"`{c}` int" for c in extra))
    at = docs
    for _, stage in cp.STAGES[:3]:
        at = stage(spark, at, "")
        assert at.schema.names == docs.columns
        at = spark.createDataFrame(at.collect(), docs.schema)
    got = {r.doc_id: r for r in at.collect()}
    assert 1 not in got and got[0]["a.b"] == 11 and got[0].spans == 5 and got[0].text.endswith("nine [SECRET]")
    assert cp.pack(spark, at, "").count() == len(got)
