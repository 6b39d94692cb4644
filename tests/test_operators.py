import json
import random

import pytest
from pyspark.sql import functions as F

from textloom import cli
from textloom.config import Config, parse_bool
from textloom.operators import combine, metrics, qe, rows, validate
from textloom.operators.translate import NUMBER, RESULT, translate
from textloom.plans import run as plans
from textloom.plans import tools
from textloom.sources.csv import append_csv, default_path, read_csv, read_records, write_csv, write_records
from textloom.sources import store
from textloom.streaming import stream


def test_number_is_global_and_stable(spark):
    rng = random.Random(1)
    keys = [rng.randrange(50) for _ in range(3000)]
    df = spark.createDataFrame([(k, i, "c") for i, k in enumerate(keys)], "k int, i int, n string").repartition(7)
    got = rows.number(df, ["k", F.desc("i")], "rn").orderBy("rn").collect()
    assert [r.rn for r in got] == list(range(1, 3001))
    assert [(r.k, r.i) for r in got] == sorted(((k, i) for i, k in enumerate(keys)), key=lambda x: (x[0], -x[1]))
    assert rows.number(df.limit(0), ["k"]).count() == 0


def test_filters(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, " \t\xa0"), (4, "")], "input_row_number long, message string")
    assert [r.message for r in rows.drop_blank(df).orderBy("input_row_number").collect()] == ["a", "nan"]
    assert rows.head(df, 2).count() == 2 and rows.skip(df, 3).count() == 1
    with pytest.raises(ValueError):
        rows.head(df, 0)
    with pytest.raises(ValueError, match="label, text"):
        rows.require(df, ["message", "text", "label"])
    said = spark.createDataFrame([("ok",), (" skipped_max_translate_tokens ",), (None,)], "status string")
    assert rows.drop_skipped(said).count() == 2


def _greedy(counts, most, budget):
    out, batch, held, used = [], 0, 0, 0
    for c in counts:
        if held and (held >= most or used + c > budget):
            batch, held, used = batch + 1, 0, 0
        out.append(batch)
        held, used = held + 1, used + c
    return out


def test_pack_batches(spark):
    rng = random.Random(2)
    chunks = {k: [rng.randrange(1, 30) for _ in range(rng.randrange(1, 60))] for k in range(12)}
    chunks[99] = [2, 3, 5, 6]
    df = spark.createDataFrame([(k, i, c, [str(c)]) for k, v in chunks.items() for i, c in enumerate(v)], "chunk int, i int, tokens int, x array<string>").repartition(5)
    for most, budget in ((10, 10), (3, 40), (1, 5)):
        got = rows.pack_batches(df, "chunk", "i", "tokens", most, budget)
        assert got.columns == [*df.columns, "batch"]
        by = {}
        for r in got.orderBy("chunk", "i").collect():
            by.setdefault(r.chunk, []).append(r.batch)
        assert by == {k: _greedy(v, most, budget) for k, v in chunks.items()}
    assert _greedy([2, 3, 5, 6], 10, 10) == [0, 0, 0, 1]
    for most, budget in ((0, 1), (1, 0)):
        with pytest.raises(ValueError):
            rows.pack_batches(df, "chunk", "i", "tokens", most, budget)


@pytest.mark.parametrize("source, target, said, why, want", [
    ("<A> x", "y <A>", None, None, ("ok", True, None)),
    ("x", "y", "ok_chunked", None, ("ok_chunked", True, None)),
    ("x", "y", "ok", None, ("ok", True, None)),
    ("<A>", " \xa0", None, None, ("empty_translation", False, "Translated text is empty.")),
    ("x", None, None, None, ("empty_translation", True, "Translated text is empty.")),
    ("<A> <A>", "<A>", None, None, ("placeholder_mismatch", False, "Source and target placeholders do not match.")),
    ("<A>", None, "translation_error", "why", ("translation_error", True, "why")),
    ("<A>", None, "translation_error", None, ("translation_error", True, "Translation failed.")),
    ("<A>", None, "skipped_url_like", "", ("skipped_url_like", True, "Record looks like a URL and was skipped.")),
    (None, "y", None, None, ("ok", True, None)),
])
def test_validation(spark, source, target, said, why, want):
    df = spark.createDataFrame([(source, target, said, why)], "a string, b string, c string, d string")
    r = df.select(validate.validation(*(F.col(c) for c in "abcd")).alias("v")).first().v
    assert (r.status, r.placeholder_ok, r.validation_error) == want


def _run(spark, texts, **settings):
    df = spark.createDataFrame([(i + 1, t, i % 2, "kept") for i, t in enumerate(texts)], f"{NUMBER} long, message string, label int, extra string")
    done = translate(df, Config(**settings))
    assert done.columns == ["message", "label", "extra", *RESULT]
    return {r[NUMBER]: r for r in done.collect()}


def test_translate_routes_and_failures(spark):
    long = "word " * 300
    texts = ["hello <A> there", "and <A> more", "FAIL now", "with FAIL's batch", "  ", None, "httpswwwexamplecom", "x " * 2000, long, long + "FAIL", "Hi\U0001f525you", "NEVER <A> x", "fine"]
    got = _run(spark, texts, model_name="tests.fakes:Failing", batch_size=2, enable_qe=True, qe_backend="length_ratio")
    assert sorted(got) == [1, 2, 3, 4, *range(6, 14)]
    assert (got[1].status, got[1].translated_text) == ("ok", "hello <A> there")  # mended by the retry
    assert got[3].status == got[4].status == "translation_error" and got[4].validation_error == "Batch translation failed: model broke"
    assert got[6].message == "nan" and got[6].status == "ok"
    assert (got[7].status, got[7].url_like_skipped, got[7].translated_text) == ("skipped_url_like", True, None)
    assert got[8].status == "skipped_max_translate_tokens" and "(2001 > 1024)" in got[8].validation_error and got[8].too_long_for_model
    assert (got[9].status, got[9].chunk_count, got[9].was_chunked, got[9].translated_text) == ("ok_chunked", 2, True, long.strip())
    assert got[10].validation_error == "Chunked translation failed: model broke"
    assert (got[11].translated_text, got[11].flag_contains_emoji) == ("Hi\U0001f525you", True)
    assert got[12].validation_error == "Retry translation failed after placeholder_mismatch: broke again" and got[12].translated_text is None
    assert got[1].qe_score == 1.0 and got[1].qe_label == "high_confidence" and got[3].qe_score is None and got[3].qe_error is None


def test_translate_without_retry_and_sorted(spark):
    got = _run(spark, ["a <A>", "b", "c d e"], model_name="tests.fakes:Failing", retry_placeholder_mismatch=False, sort_batches_by_length=True)
    assert [got[i].status for i in (1, 2, 3)] == ["placeholder_mismatch", "ok", "ok"]
    assert _run(spark, ["   "], model_name="echo") == {}


def test_counts(spark):
    df = spark.createDataFrame([("ok",), ("ok",), ("new",)], "status string")
    got = {r.status: r.n for r in metrics.status_counts(df).collect()}
    assert got["ok"] == 2 and got["new"] == 1 and got["translation_error"] == 0 and len(got) == 9


def test_quality_backends(spark):
    df = spark.createDataFrame([(1, "src", "0123456789", "ok"), (2, "BAD", "01234", "ok_chunked"), (3, "src", "", "ok"), (4, "src", None, "translation_error")], "i int, message string, translated_text string, status string")
    got = {r.i: r for r in qe.with_quality(df, backend="tests.fakes:scorer", model_name="m").collect()}
    assert (got[1].qe_score, got[1].qe_label, got[1].qe_backend, got[1].qe_model_name) == (1.0, "high_confidence", "tests.fakes:scorer", "m")
    assert got[2].qe_score is None and got[2].qe_error == "bad pair"
    assert got[3].qe_error == "QE skipped: translated_text is empty." and got[3].qe_backend is None
    assert got[4].qe_error is None
    lost = {r.i: r for r in qe.with_quality(df, backend="tests.fakes:scorer", model_name="missing").collect()}
    assert lost[1].qe_error.endswith("load failed: no such model")
    both = {r.i: r for r in qe.score_combined(df.withColumn("qe_score", F.lit("old"))).collect()}
    assert both[1].qe_score_input == "old" and both[4].qe_error == "QE skipped: translation status is 'translation_error'." and both[3].qe_score == 0.0
    assert {r.i: r.qe_error for r in qe.with_quality(df, backend=None).collect()}[1] is None
    for name, model in (("transquest", "m"), ("other", "m"), ("comet", None)):
        with pytest.raises(ValueError):
            qe.check_backend(name, model)


def test_disabled_scorer_shapes():
    pairs = [("a", "b"), ("c", "d"), ("e", "f")]
    for shape, want in ((lambda p: [0.5] * len(p), [0.5] * 3), (lambda p: [[0.25]] * len(p), [0.25] * 3), (lambda p: ([0.1] * len(p), "raw"), [0.1] * 3)):
        assert qe.transquest_scores(pairs, shape) == want
    assert qe.transquest_scores(pairs[:1], lambda p: 0.75) == [0.75]
    for bad in ([("", "x")], [("x", "")]):
        with pytest.raises(ValueError, match="empty"):
            qe.transquest_scores(bad, lambda p: [1.0])
    with pytest.raises(ValueError, match="2 scores for 3"):
        qe.transquest_scores(pairs, lambda p: [0.1, 0.2])


def test_zip_and_pairs(spark):
    a = spark.createDataFrame([(1, "x", 7), (2, None, 8)], f"{NUMBER} long, message string, id int")
    b = spark.createDataFrame([(1, "xy", "q"), (2, "z", "q")], f"{NUMBER} long, message string, qe_label string")
    zipped = combine.zip_rows(a, b)
    assert zipped.columns == [NUMBER, "message_source", "id", "message_translated", "qe_label_translated"] and zipped.count() == 2
    assert {r[NUMBER]: r.qe_score for r in qe.score_paired(a, b).collect()} == {1: 0.5, 2: 0.0}
    with pytest.raises(ValueError, match="same number of paired rows"):
        combine.zip_rows(a, b.limit(1))


def test_sample_export(spark):
    df = spark.createDataFrame([("Hi, __EMOJI_1_ <NAME>!", 1, "ok", "m", None), ("", 0, "skipped_url_like", "Some.Where", None), ("x", 1, " skipped_max_translate_tokens", "m", None), (None, 0, "ok", "wwwthere", "no"), ("", 1, "ok", "m", " TRUE ")], "translated_text string, label int, status string, message string, url_like_skipped string")
    every = dict(autopopulate_url_like=True, drop_skipped_max_translate_tokens=True, remove_emoji_placeholders=True, lowercase_messages=True, remove_punctuation=True)
    assert [tuple(r) for r in tools.sample_export(df, **every).collect()] == [("hi <NAME>", 1), ("some where", 0), ("wwwthere", 0), ("m", 1)]
    assert [r.message for r in tools.sample_export(df).collect()] == ["Hi, __EMOJI_1_ <NAME>!", "", "x", "", ""]
    with pytest.raises(ValueError, match="status"):
        tools.sample_export(df.drop("status"), drop_skipped_max_translate_tokens=True)
    assert tools.lowercase_messages(spark.createDataFrame([("A <B> __EMOJI_1__",)], "message string")).first().message == "a <B> __emoji_1__"


def test_config():
    assert Config.load({"batch_size": 3}, {"BATCH_SIZE": "9", "SKIP_URL_LIKE": "off", "QE_HIGH_THRESHOLD": ".9"}) == Config(batch_size=3, skip_url_like=False, qe_high_threshold=0.9)
    assert parse_bool(" Yes") and not parse_bool("N")
    with pytest.raises(ValueError):
        parse_bool("perhaps")
    good = dict(model_name="m")
    Config(**good).validate()
    for bad in ({"model_name": None}, {"batch_size": 0}, {"chunk_token_limit": 300}, {"chunk_overlap_tokens": 160}, {"device": "tpu"}, {"log_level": "loud"}, {"limit": 0}, {"enable_qe": True}, {"enable_qe": True, "qe_backend": "length_ratio", "qe_medium_threshold": 0.9}):
        with pytest.raises(ValueError):
            Config(**good | bad).validate()
    with pytest.raises(ValueError):
        Config.load({"nonsense": 1}, {})


def test_csv_and_run_and_cli(spark, tmp_path):
    source = tmp_path / "in.csv"
    source.write_text('﻿message,label\n"two\nlines ""quoted""",1\n,0\nNA,1\nplain text,0\nhttpswwwsite,1\n', encoding="utf-8")
    got = [tuple(r) for r in read_csv(spark, str(source)).orderBy(NUMBER).collect()]
    assert got == [('two\nlines "quoted"', "1", 1), ("", "0", 2), ("NA", "1", 3), ("plain text", "0", 4), ("httpswwwsite", "1", 5)] or got[1][0] is None
    assert [r.message for r in read_csv(spark, str(source), na_values=True).orderBy(NUMBER).collect()][1:3] == [None, None]
    report = plans.run(spark, Config(input_path=str(source), output_path=str(tmp_path / "out"), model_name="echo", limit=4, report_path=str(tmp_path / "r" / "report.json")))
    assert (report["rows_loaded"], report["rows_processed"], report["validation_summary"]["ok"]) == (4, 4, 4)
    raw = (tmp_path / "r" / "report.json").read_bytes()
    assert raw[:3] == b"\xef\xbb\xbf" and json.loads(raw.decode("utf-8-sig"))["rows_loaded"] == 4
    back = read_csv(spark, str(tmp_path / "out"))
    assert back.count() == 4 and append_csv(back.drop(NUMBER), str(tmp_path / "out")) == 4 and read_csv(spark, str(tmp_path / "out")).count() == 8
    assert cli.main(["sample", "--input", str(source), "--rows", "2"], spark) == "rows: 2"
    assert cli.main(["lowercase", "--input", str(source), "--output", str(tmp_path / "low")], spark) == "rows: 5"
    assert cli.main(["to-sample", "--input", str(tmp_path / "out"), "--output", str(tmp_path / "sample"), "--remove-punctuation"], spark) == "rows: 8"
    assert cli.main(["qe", "--input", str(tmp_path / "out"), "--translated-column", "translated_text", "--output", str(tmp_path / "qe"), "--backend", "length_ratio"], spark).startswith("rows: 8, mean score: ")
    assert cli.main(["translate", "--input", str(source), "--output", str(tmp_path / "o2"), "--model", "echo", "--no-skip-url-like"], spark) == "rows: 5"
    with pytest.raises(ValueError):
        cli.main(["qe", "--input", "a", "--output", "b"], spark)
    assert [default_path("d/a.csv", k, 3) for k in ("progress", "sample", "lowercase", "first")] == ["d/a.progress.json", "d/a_sample.csv", "d/a_lowercase.csv", "d/a_first_3.csv"]
    assert write_csv(back.limit(0), str(tmp_path / "empty")) == 0


def test_resume_with_counters(spark, tmp_path):
    source = tmp_path / "in.csv"
    source.write_text("message,label\n" + "".join(f"{'   ' if i % 7 == 0 else 'text <A> ' + str(i)},{i % 2}\n" for i in range(50)), encoding="utf-8")
    settings = dict(input_path=str(source), model_name="echo", input_chunk_size=4, checkpoint_interval=3)
    names = ("rows_loaded", "rows_processed", "rows_dropped_empty", "rows_too_long_for_model", "rows_chunked", "chunks_completed", "validation_summary")
    once = plans.run(spark, Config(output_path=str(tmp_path / "once"), progress_path=str(tmp_path / "once.json"), **settings))
    config = Config(output_path=str(tmp_path / "out"), progress_path=str(tmp_path / "state.json"), report_path=str(tmp_path / "report.json"), **settings)
    part = plans.run(spark, config, most_groups=2)
    assert (part["rows_loaded"], part["resumed"], part["chunks_completed"]) == (24, False, 6) and (tmp_path / "state.json").exists()
    # Killed in the third group after its output was written, but before the state was.
    state = (tmp_path / "state.json").read_bytes()
    plans.run(spark, config, most_groups=1)
    (tmp_path / "state.json").write_bytes(state)
    whole = plans.run(spark, config)
    assert whole["resumed"] and not (tmp_path / "state.json").exists() and not (tmp_path / "state.json.tmp").exists()
    assert {n: whole[n] for n in names} == {n: once[n] for n in names} and whole["rows_loaded"] == 50 and whole["rows_dropped_empty"] == 8
    rows_of = lambda out: sorted(tuple(r) for r in read_csv(spark, str(tmp_path / out), number=None).select(NUMBER, "message", "status").collect())
    assert rows_of("out") == rows_of("once") and len(rows_of("out")) == 42
    # A state of other paths, or of a finished run, is ignored.
    other = json.loads(state.decode("utf-8-sig"))
    for change in ({"output_path": "elsewhere"}, {"input_path": "elsewhere"}, {"completed": True}):
        (tmp_path / "state.json").write_text(json.dumps(other | change), encoding="utf-8-sig")
        assert plans.load_progress(config) is None
    assert not plans.run(spark, config)["resumed"] and len(rows_of("out")) == 42
    with pytest.raises(ValueError, match="label"):
        (tmp_path / "bad.csv").write_text("message\nx\n")
        plans.run(spark, Config(input_path=str(tmp_path / "bad.csv"), model_name="echo", progress_path=str(tmp_path / "b.json"), output_path=str(tmp_path / "b")))


def test_ragged_records_are_kept(spark, tmp_path):
    source = tmp_path / "in.csv"
    lines = ["id,text", "1,a", "2", '3,b,extra,"q, ""x"""', '4,"two\nlines"', '5,"a ""b"""', "6, spaced "]
    source.write_text("\n".join(lines) + "\n", encoding="utf-8")
    assert cli.main(["sample", "--input", str(source), "--rows", "6", "--output", str(tmp_path / "out")], spark) == "rows: 6"
    parts = sorted((tmp_path / "out").glob("part-*"))
    assert "".join(p.read_text(encoding="utf-8") for p in parts) == "\n".join(lines) + "\n"
    assert cli.main(["sample", "--input", str(source), "--rows", "2", "--output", str(tmp_path / "out")], spark) == "rows: 2"


def test_records_of_many_files(spark, tmp_path):
    """Each file is read without its first line, so each must begin with the header."""
    own = spark.range(1, 401).select(F.concat("id", F.lit(",x"), F.repeat(F.lit(",y"), (F.col("id") % 3).cast("int"))).alias("record"), F.col("id").alias("n"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert write_records("a,b", own, str(tmp_path / "out"), "n") == 400
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(list((tmp_path / "out").glob("part-*"))) > 1
    header, back = read_records(spark, str(tmp_path / "out"))
    assert header == "a,b" and sorted(back.collect(), key=lambda r: r[1]) == own.orderBy("n").collect()
    assert write_records("a,b", own.limit(0), str(tmp_path / "none"), "n") == 0
    assert read_records(spark, str(tmp_path / "none"))[1].count() == 0


def test_number_by_key_and_counts_by_column(spark, tmp_path):
    df = spark.createDataFrame([(i * 7 % 50, i, "x" * i) for i in range(50)] + [(None, 99, "n")], "k int, v int, payload string").repartition(5)
    got = rows.number(df, ["k"], "n", key=["k"]).orderBy("n").collect()
    assert got[0].v == 99 and [r.k for r in got[1:]] == list(range(50)) and [r.n for r in got] == list(range(1, 52))
    stream.process(spark, stream.file_stream(spark, _written(df, tmp_path / "in"), "k int, v int, payload string"), lambda b: b.withColumn("odd", F.col("v") % 2), str(tmp_path / "csv"), str(tmp_path / "state"), "csv", header="true")
    found = stream.totals(spark, str(tmp_path / "csv"), "csv", by="odd", header="true").collect()
    assert sum(r.rows for r in found) == 51 and {r.odd for r in found} == {"0", "1"}


def _written(df, path):
    df.write.parquet(str(path))
    return str(path)


def test_tables_are_deleted(spark):
    first = store.written(spark.range(3), "t")
    with store.scratch(spark) as keep:
        with store.scratch(spark) as inner:
            a, b = store.written(spark.range(4), "t"), store.written(spark.range(5), "t")
            inner.append(a)
        with pytest.raises(Exception):
            b.count()
        c = store.written(spark.range(6), "t")
        keep.append(c)
        assert a.count() == 4
    with pytest.raises(Exception):
        a.count()
    assert c.count() == 6 and first.count() == 3
    store.discard(c)
    store.release(spark)
    with pytest.raises(Exception):
        first.count()


def test_stream_resumes_and_writes_once(spark, tmp_path):
    folder, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    parts = spark.range(30).select(F.col("id"), F.lit("x").alias("message"))
    parts.where("id < 20").repartition(3).write.parquet(folder)
    failed = []

    def once(batch):
        if not failed:
            failed.append(1)
            raise RuntimeError("lost")
        return batch.withColumn("seen", F.lit(True))

    def go(f):
        return stream.process(spark, stream.file_stream(spark, folder, "id long, message string"), f, out, state)

    with pytest.raises(Exception, match="lost"):
        go(once)
    go(once)
    first = stream.totals(spark, out).first()
    assert first.rows == 20 and first.batches == 3
    parts.where("id >= 20").coalesce(1).write.mode("append").parquet(folder)
    go(once)
    again = stream.totals(spark, out).first()
    assert again.rows == 30 and spark.read.parquet(out).select("id").distinct().count() == 30
