"""Run registered queries against their SQL statements on one data folder."""

import math
import os
import time

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir):
    import duckdb

    con = duckdb.connect()
    for table in TABLES:
        path = os.path.join(sf_dir, f"{table}.parquet")
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{path}')")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return "\0" if value is None else str(value)


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_cell(row[i]) for i in order) for row in rows)


_KINDS = {
    "BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "DOUBLE": "double",
    "BOOLEAN": "boolean",
}


def compare(spark, con, name, query, sql, sf_dir):
    """None if both agree in columns, types and rows, else what differs."""
    start = time.time()
    df = query(spark, sf_dir)
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    took = time.time() - start
    relation = con.sql(sql)
    want = _rows(relation.columns, relation.fetchall())
    took_sql = time.time() - start - took
    types = dict(df.dtypes)
    sql_types = {
        c: _KINDS.get(str(t), str(t)) for c, t in zip(relation.columns, relation.types)
    }
    note = f"{len(got)} rows, {took:.1f} s, sql {took_sql:.1f} s"
    if types != sql_types:
        return f"types {types} / {sql_types}", note
    if got != want:
        extra = [r for r in got if r not in set(want)][:2]
        missing = [r for r in want if r not in set(got)][:2]
        return f"{len(got)} rows / {len(want)}; only here {extra}; only there {missing}", note
    return None, note
