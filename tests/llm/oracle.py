"""Runs a query and its DuckDB SQL side by side over one data folder."""

import duckdb

import textloom.llm.queries as llm

TABLES = "documents embeddings pages benchmark labels conversations".split()
SMALL = "/root/testdata/sf0.001"


def agree(spark, name, sf_dir=SMALL):
    db = duckdb.connect()
    for t in TABLES:
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    df = llm.QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    got = sorted((tuple(r) for r in df.select(columns).collect()), key=repr)
    want = sorted(db.execute(f"SELECT {', '.join(columns)} FROM ({llm.ORACLES[name]})").fetchall(), key=repr)
    assert got == want
    return got
