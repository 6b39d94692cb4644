"""Runs a query and its DuckDB SQL side by side over one data folder."""

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def compare(spark, queries, oracles, name, sf_dir):
    """None if both give the same rows, else what differs."""
    db = duckdb.connect()
    for t in TABLES:
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    df = queries[name](spark, sf_dir)
    columns = sorted(df.columns)
    quoted = ", ".join(f'"{c}"' for c in columns)
    got = sorted((tuple(r) for r in df.select(columns).collect()), key=repr)
    want = sorted(db.execute(f"SELECT {quoted} FROM ({oracles[name]})").fetchall(), key=repr)
    if len(got) != len(want):
        return f"{len(got)} rows, not {len(want)}"
    return next((f"{g} is not {w}" for g, w in zip(got, want, strict=True) if g != w), None)
