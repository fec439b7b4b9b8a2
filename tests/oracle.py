"""Compare a query with its SQL on the same tables."""

from collections import Counter
from pathlib import Path

import duckdb
import pyarrow as pa


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


def _kind(kind: pa.DataType) -> str:
    if pa.types.is_timestamp(kind):
        return "timestamp"
    if pa.types.is_string(kind) or pa.types.is_large_string(kind):
        return "string"
    return str(kind)


def _schema(table: pa.Table) -> dict[str, str]:
    return {field.name: _kind(field.type) for field in table.schema}


def _rows(table: pa.Table) -> Counter:
    names = sorted(table.column_names)
    return Counter(zip(*(table.column(name).to_pylist() for name in names)))


def difference(spark_frame, sql: str, con: duckdb.DuckDBPyConnection) -> str | None:
    ours, theirs = spark_frame.toArrow(), con.sql(sql).to_arrow_table()
    if _schema(ours) != _schema(theirs):
        return f"schemas: {_schema(ours)} / {_schema(theirs)}"
    left, right = _rows(ours), _rows(theirs)
    if left != right:
        return f"rows: {ours.num_rows} / {theirs.num_rows}; {list((left - right).items())[:2]} / {list((right - left).items())[:2]}"
    return None
