"""Run a registered query on Spark and its SQL on DuckDB and compare the rows."""

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.6f}".replace("-0.000000", "0.000000")
    if isinstance(value, bool) or value is None:
        return str(value)
    return str(value)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def compare(spark_df, con, sql):
    """None when equal, else a short description of the difference."""
    columns = spark_df.columns
    got = spark_df.collect()
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    want = cur.fetchall()
    if sorted(names) != sorted(columns):
        return f"columns {sorted(columns)} != {sorted(names)}"
    ours, theirs = _rows(columns, got), _rows(names, want)
    if ours == theirs:
        return None if ours else "both empty"
    extra = [r for r in ours if r not in set(theirs)][:2]
    lacking = [r for r in theirs if r not in set(ours)][:2]
    return f"{len(ours)} rows vs {len(theirs)}; only Spark {extra}; only SQL {lacking}"
