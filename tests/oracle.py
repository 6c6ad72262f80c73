"""Results of a query and of its SQL, made comparable."""

import os

import duckdb

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def rows(columns, values):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    plain = lambda v: list(v) if isinstance(v, tuple | list) else (float(v) if isinstance(v, int | float) and not isinstance(v, bool) else v)
    return sorted([columns[i] for i in order]), sorted((repr([plain(r[i]) for i in order]) for r in values))


def expected(sql, data=DATA):
    db = duckdb.connect()
    for t in TABLES:
        if os.path.exists(f"{data}/{t}.parquet"):
            db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{data}/{t}.parquet'")
    got = db.execute(sql)
    return rows([c[0] for c in got.description], got.fetchall())


def found(df):
    return rows(df.columns, [tuple(r) for r in df.collect()])
