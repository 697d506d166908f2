"""Runs a registered query on Spark and its SQL on DuckDB, and compares the rows."""

from __future__ import annotations

import math
import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"create view {t} as select * from read_parquet('{path}{'/*.parquet' if os.path.isdir(path) else ''}')")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6) + 0.0
    if isinstance(value, dict):
        return tuple((k, plain(v)) for k, v in value.items())
    if isinstance(value, list):
        return tuple(plain(v) for v in value)
    return value


def rows(table) -> tuple[list[str], list[str]]:
    names = sorted(table.column_names)
    return names, sorted(repr([plain(r[n]) for n in names]) for r in table.to_pylist())


def difference(spark_table, duck_table) -> str:
    """Empty if both have the same columns and rows."""
    (a_names, a), (b_names, b) = rows(spark_table), rows(duck_table)
    if a_names != b_names:
        return f"columns {a_names} and {b_names}"
    if a == b:
        return ""
    only_a, only_b = sorted(set(a) - set(b)), sorted(set(b) - set(a))
    return f"{len(a)} and {len(b)} rows; only Spark: {only_a[:2]}; only DuckDB: {only_b[:2]}"
