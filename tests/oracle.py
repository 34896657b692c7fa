"""Compares a query with its DuckDB twin as the driver does: columns by name, rows in any order."""

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def database(sf_dir):
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return c


def rows(names, values):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(repr([v[i] for i in order]) for v in values)


def compare(spark, sf_dir, query, sql):
    df = query(spark, sf_dir)
    got = df.collect()
    want = database(sf_dir).sql(sql)
    assert sorted(df.columns) == sorted(want.columns)
    assert rows(df.columns, got) == rows(want.columns, want.fetchall())
