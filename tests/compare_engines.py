"""Compare a Spark result with DuckDB's on names, types, rows and values, in any order."""

from __future__ import annotations

import math

import duckdb

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]

TYPE_GROUPS = {
    "bigint": "integer", "int": "integer", "integer": "integer", "smallint": "integer", "hugeint": "integer",
    "double": "double", "float": "double", "string": "text", "varchar": "text", "boolean": "boolean",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _cell(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return ""
    if isinstance(v, float):
        return repr(v + 0.0)
    return str(v)


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def differences(spark_df, con, sql) -> list[str]:
    got_rows = list(zip(*spark_df.toArrow().to_pydict().values()))
    relation = con.sql(sql)
    want_rows = relation.fetchall()
    found = []
    if sorted(spark_df.columns) != sorted(relation.columns):
        return [f"columns {sorted(spark_df.columns)} != {sorted(relation.columns)}"]
    left = {c: TYPE_GROUPS.get(t, t) for c, t in spark_df.dtypes}
    right = {c: TYPE_GROUPS.get(str(t).lower(), str(t)) for c, t in zip(relation.columns, relation.types)}
    exact_left = dict(spark_df.dtypes)
    exact_right = {c: str(t).lower() for c, t in zip(relation.columns, relation.types)}
    for c in left:
        if left[c] != right[c] or exact_right[c] == "hugeint" or (
            left[c] == "integer" and (exact_left[c] == "bigint") != (exact_right[c] == "bigint")
        ):
            found.append(f"type of {c}: {exact_left[c]} != {exact_right[c]}")
    a, b = canonical(spark_df.columns, got_rows), canonical(relation.columns, want_rows)
    if len(a) != len(b):
        found.append(f"rows {len(a)} != {len(b)}")
    if a != b:
        left_only, right_only = set(a) - set(b), set(b) - set(a)
        found.append(
            f"values differ in {len(left_only)}: spark {sorted(left_only)[:2]} duckdb {sorted(right_only)[:2]}"
        )
    return found
