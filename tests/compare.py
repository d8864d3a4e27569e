"""Run queries in Spark and their SQL in DuckDB and compare columns, types and rows."""

from __future__ import annotations

import decimal
import math
from pathlib import Path

import duckdb

TYPES = {"BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "DOUBLE": "double", "BOOLEAN": "boolean"}
TYPES |= {"DATE": "date", "TIMESTAMP": "timestamp_ntz"}


def connect(sf_dir: str, files: str = "*.parquet") -> duckdb.DuckDBPyConnection:
    """A view per table; a table may also be a folder of files (``*.parquet/*.parquet``)."""
    con = duckdb.connect()
    for table in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {table.stem} AS SELECT * FROM '{table}{files.removeprefix('*.parquet')}'")
    return con


def _norm(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    if isinstance(value, decimal.Decimal):
        return str(value)
    return value


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


def differences(spark, con, query, sql: str, sf_dir: str) -> list[str]:
    """What differs; empty if nothing does."""
    df = query(spark, sf_dir)
    answer = con.execute(sql)
    described = answer.description
    names, rows = [d[0] for d in described], answer.fetchall()
    kinds = {d[0]: TYPES.get(str(d[1]), str(d[1]).lower()) for d in described}
    mine = {f.name: f.dataType.simpleString() for f in df.schema}
    found = []
    if sorted(mine) != sorted(kinds):
        return [f"columns {sorted(mine)} != {sorted(kinds)}"]
    if mine != kinds:
        found.append(f"types {[(c, mine[c], kinds[c]) for c in mine if mine[c] != kinds[c]]}")
    left, right = _rows(df.columns, df.collect()), _rows(names, rows)
    if not right:
        found.append("no rows to compare")
    if len(left) != len(right):
        found.append(f"row count {len(left)} != {len(right)}")
    if left != right:
        pairs = [(a, b) for a, b in zip(left, right) if a != b][:3]
        found.append(f"rows differ, first: {pairs}")
    return found
