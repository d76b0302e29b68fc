"""Run a registered query in Spark and its SQL in DuckDB and compare whole results."""

import duckdb

TABLES = "region nation customer supplier part orders lineitem events".split()


def duck(folder):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def kind(spark_type):
    return {
        "bigint": "BIGINT",
        "int": "INTEGER",
        "double": "DOUBLE",
        "string": "VARCHAR",
        "boolean": "BOOLEAN",
        "date": "DATE",
    }.get(spark_type, spark_type)


def rows(data, order):
    return sorted((tuple(r[i] for i in order) for r in data), key=lambda r: [(v is None, str(v)) for v in r])


def compare(df, con, sql):
    """None when equal, else a short reason."""
    result = con.execute(sql)
    theirs = {d[0]: str(t) for d, t in zip(result.description, con.sql(sql).types)}
    mine = {f.name: kind(f.dataType.simpleString()) for f in df.schema}
    if mine != theirs:
        return f"schema: {sorted(set(mine.items()) ^ set(theirs.items()))}"
    names = sorted(mine)
    other = [d[0] for d in result.description]
    left = rows(df.select(*names).collect(), range(len(names)))
    right = rows(result.fetchall(), [other.index(n) for n in names])
    if len(left) != len(right):
        return f"rows: {len(left)} != {len(right)}"
    bad = [(a, b) for a, b in zip(left, right) if a != b]
    return f"values: {len(bad)} of {len(left)} differ, first {bad[0]}" if bad else None
