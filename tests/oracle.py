"""Runs a query and its SQL over the same tables and compares the rows."""

import math

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def _plain(x):
    if isinstance(x, float):
        return None if math.isnan(x) else round(x, 6)
    return str(x) if type(x).__name__ in ("Decimal", "datetime") else x


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=str), sorted(names)


def compare(spark, name, f, sql, sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    want = con.execute(sql)
    expected = rows_of([d[0] for d in want.description], want.fetchall())
    df = f(spark, sf_dir)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    assert got[1] == expected[1], f"{name}: columns {got[1]} {expected[1]}"
    assert len(got[0]) == len(expected[0]), f"{name}: {len(got[0])} rows, SQL has {len(expected[0])}"
    assert got[0] == expected[0], f"{name}: {next((a, b) for a, b in zip(got[0], expected[0]) if a != b)}"
    return len(got[0])
