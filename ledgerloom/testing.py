"""Comparison of a Spark result with a DuckDB result."""

from __future__ import annotations

import pyarrow as pa

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
    "embeddings", "pages", "benchmark", "labels", "conversations",
]


def duck_tables(connection, sf_dir: str):
    for name in TABLES:
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return connection


def _kind(kind: pa.DataType) -> str:
    if pa.types.is_timestamp(kind):
        return "timestamp"
    if pa.types.is_large_string(kind) or pa.types.is_string(kind):
        return "string"
    return str(kind)


def _rows(table: pa.Table, names: list[str]) -> list[tuple]:
    columns = []
    for name in names:
        column = table.column(name)
        if pa.types.is_timestamp(column.type):
            column = column.cast(pa.timestamp("us"))
        columns.append(column.to_pylist())
    return sorted(zip(*columns, strict=True), key=repr)


def compare(got: pa.Table, expected: pa.Table, allow_empty: bool = False) -> str | None:
    """None if names, types, row count and values agree, else what differs first."""
    names = sorted(got.column_names)
    if names != sorted(expected.column_names):
        return f"columns {names} but oracle {sorted(expected.column_names)}"
    kinds = [(n, _kind(got.schema.field(n).type), _kind(expected.schema.field(n).type)) for n in names]
    wrong = [k for k in kinds if k[1] != k[2]]
    if wrong:
        return f"types differ: {wrong}"
    if got.num_rows != expected.num_rows:
        return f"{got.num_rows} rows but oracle {expected.num_rows}"
    if got.num_rows == 0 and not allow_empty:
        return "no rows"
    for mine, theirs in zip(_rows(got, names), _rows(expected, names), strict=True):
        if repr(mine) != repr(theirs):
            pairs = [(n, a, b) for n, a, b in zip(names, mine, theirs, strict=True) if repr(a) != repr(b)]
            return f"values differ: {pairs[:4]}"
    return None
