"""Compare Spark query results with DuckDB results, ignoring row and column order."""

from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def spark_rows(df):
    names = sorted(df.columns)
    return names, [tuple(r) for r in df.select(*names).collect()]


def duck_rows(con, sql):
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], [tuple(r[i] for i in order) for r in cur.fetchall()]


def difference(left, right):
    a, b = Counter(left), Counter(right)
    return list((a - b).items())[:3], list((b - a).items())[:3]
