"""Compare a registered query with its SQL oracle, value by value."""

import glob
import os

import duckdb


def connect(folder):
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


SPARK_TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "boolean": "BOOLEAN",
}


def differences(df, con, sql):
    """Problems as text, empty when schema and rows agree."""
    relation = con.sql(sql)
    ours = {name: SPARK_TYPES.get(kind, kind) for name, kind in df.dtypes}
    theirs = dict(zip(relation.columns, map(str, relation.types)))
    if ours != theirs:
        return f"schema {ours} != {theirs}"
    columns = sorted(ours)
    mine = sorted((tuple(row[c] for c in columns) for row in df.collect()), key=repr)
    order = [relation.columns.index(c) for c in columns]
    expected = sorted((tuple(row[i] for i in order) for row in relation.fetchall()), key=repr)
    if len(mine) != len(expected):
        return f"{len(mine)} rows != {len(expected)} rows"
    for left, right in zip(mine, expected):
        if left != right:
            return f"{left} != {right}"
    return ""
