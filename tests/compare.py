"""Runs registered queries against their SQL twins."""

from __future__ import annotations

import glob
import os

import duckdb

KINDS = {"bigint": "int", "int": "int", "string": "text", "double": "real", "boolean": "bool"}
DUCK_KINDS = {"BIGINT": "int", "INTEGER": "int", "VARCHAR": "text", "DOUBLE": "real", "BOOLEAN": "bool"}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _sorted_rows(rows, names):
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted((tuple(row[i] for i in order) for row in rows),
                  key=lambda row: [(v is not None, str(v)) for v in row])


def difference(df, con, sql) -> str | None:
    """None when columns, kinds and values agree, else what does not."""
    relation = con.execute(sql)
    duck_types = {d[0]: DUCK_KINDS.get(str(d[1]), str(d[1])) for d in relation.description}
    spark_types = {n: KINDS.get(t, t) for n, t in df.dtypes}
    if duck_types != spark_types:
        odd = {n for n in duck_types.keys() | spark_types.keys()
               if duck_types.get(n) != spark_types.get(n)}
        return f"columns differ: {[(n, spark_types.get(n), duck_types.get(n)) for n in sorted(odd)]}"
    expected = _sorted_rows(relation.fetchall(), [d[0] for d in relation.description])
    actual = _sorted_rows([tuple(row) for row in df.collect()], df.columns)
    if len(expected) != len(actual):
        return f"{len(actual)} rows, expected {len(expected)}"
    unequal = [(a, e) for a, e in zip(actual, expected) if a != e]
    return f"{len(unequal)} rows differ, first: {unequal[0]}" if unequal else None
