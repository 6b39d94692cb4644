import math

import numpy as np
from pyspark.sql import functions as F

from tests.llm.oracle import agree
from textloom.llm import ann


def test_query_against_sql(spark):
    assert agree(spark, "op2_one_bit_search")


def test_bounds_hold():
    rng = np.random.default_rng(2)
    for dim in (3, 64, 100):
        vectors = rng.standard_normal((3000, dim)) * rng.exponential(1, (3000, 1))
        codes = ann.Codes.of(vectors)
        queries = rng.standard_normal((40, dim)) * 7
        value, error = codes.estimate(queries)
        truth = queries @ vectors.T
        assert (np.abs(value - truth) > error).mean() < (0.1 if dim < 10 else 0.005)
        slopes = [np.polyfit(t, v, 1)[0] for t, v in zip(truth, value, strict=True)]
        assert dim < 10 or abs(np.mean(slopes) - 1) < 0.03  # unbiased


def test_bounds_leave_few_to_rerank():
    rng = np.random.default_rng(3)
    vectors = rng.standard_normal((5000, 256))
    value, error = ann.Codes.of(vectors).estimate(vectors[:3])
    for q in range(3):
        assert (value[q] + error[q] >= np.sort(vectors @ vectors[q])[-20]).mean() < 0.5


def test_recall_and_ties_against_brute_force(spark):
    rng = np.random.default_rng(4)
    v = rng.standard_normal((900, 48)).astype(np.float32)
    v[100:500] = v[7]  # a large group of copies
    rows = [(i, [float(x) for x in r], "c") for i, r in enumerate(v)]
    rows += [(2000, None, "c"), (2020, [], "c"), (2040, [0.0] * 48, "c"), (2060, [math.nan] * 48, "c"), (2080, [None] + [1.0] * 47, "c"), (2100, [math.inf] * 48, "c"), (None, [1.0] * 48, "c"), (2120, [1.0, 2.0], "c"), (2140, [1.0, 1.0], "c")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score string")
    got = {}
    for r in ann.search(df, F.col("vec_id") % 20 == 0, block_rows=200, query_rows=17).collect():
        got.setdefault(r.query_id, {})[r["rank"]] = (r.vec_id, r.score)
    assert set(got) == {*range(0, 900, 20), 2120, 2140}
    assert got[2120] == {1: (2140, 3.0)} and got[2140] == {1: (2120, 3.0)}
    hits = 0
    for q in range(0, 900, 20):
        scores = ann.exact(v.astype(float), v[q].astype(float))
        want = [i for i in sorted(range(900), key=lambda i: (-scores[i], i)) if i != q][:20]
        assert sorted(got[q]) == list(range(1, 21))
        assert all(s == scores[i] for i, s in got[q].values())
        hits += len({i for i, _ in got[q].values()} & set(want))
        if 100 <= q < 500:
            assert [got[q][r][0] for r in range(1, 21)] == want
    assert hits >= 0.98 * 20 * 45


def test_empty_and_repeated_rows(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (0, [1.0, 0.0]), (1, [2.0, 0.0]), (1, [2.0, 0.0])], "vec_id long, embedding array<double>")
    assert [tuple(r) for r in ann.search(df, F.col("vec_id") % 20 == 0).collect()] == [(0, 1, 1, 2.0)]
    assert ann.search(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0
    many = [(0, [1.0, 0.5])] * 40 + [(i, [1.0, 0.0]) for i in range(1, 25) for _ in range(30)]
    got = ann.search(spark.createDataFrame(many, "vec_id long, embedding array<double>"), F.col("vec_id") % 20 == 0).where("query_id = 0").orderBy("rank").collect()
    assert [(r["rank"], r.vec_id) for r in got] == [(i, i) for i in range(1, 21)]
