"""Compares a query with its SQL on the same files."""

import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
SMALL = "/root/testdata/sf0.001"


def same(spark, query, sql, sf_dir=SMALL):
    db = duckdb.connect()
    for t in TABLES:
        if os.path.exists(f"{sf_dir}/{t}.parquet"):
            db.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    got, want = query(spark, sf_dir).toPandas(), db.sql(sql).df()
    assert sorted(got.columns) == sorted(want.columns)
    cols = sorted(got.columns)

    def plain(frame):
        frame = frame[cols].astype(str).replace({"None": "<NA>", "nan": "<NA>", "NaT": "<NA>"})
        return frame.sort_values(cols).reset_index(drop=True)

    a, b = plain(got), plain(want)
    assert len(a) == len(b)
    assert a.equals(b), a[(a != b).any(axis=1)].head().to_string() + "\n" + b[(a != b).any(axis=1)].head().to_string()
