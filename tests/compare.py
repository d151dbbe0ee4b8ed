"""Side-by-side comparison of a registered query with its DuckDB SQL."""

from __future__ import annotations

import glob
import os
from collections import Counter

import duckdb

SF = os.environ.get("TICKLOOM_SF_DIR", "/root/testdata/sf0.001")


def connect(folder: str = SF):
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"create view {name} as select * from '{path}'")
    return con


def _plain(column, kind: str) -> list:
    values = column.to_pylist()
    if kind == "double":
        return [None if v is None else f"{v:.6f}" if v else "0.000000" for v in values]
    return values


def _rows(table, order: list[str]) -> Counter:
    columns = [
        _plain(table.column(c), "double" if str(table.schema.field(c).type) == "double" else "")
        for c in order
    ]
    return Counter(zip(*columns, strict=True))


def spark_rows(df):
    order = sorted(df.columns)
    return order, dict(df.dtypes), _rows(df.toArrow(), order)


def duck_rows(con, sql: str):
    rel = con.sql(sql)
    types = dict(zip(rel.columns, [str(t) for t in rel.types], strict=True))
    order = sorted(rel.columns)
    return order, types, _rows(rel.to_arrow_table(), order)


SAME = {
    "string": "VARCHAR",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
    "decimal(18,2)": "DECIMAL(18,2)",
}


def differences(spark_side, duck_side) -> list[str]:
    """Empty if columns, types and the multiset of rows agree."""
    s_cols, s_types, s_rows = spark_side
    d_cols, d_types, d_rows = duck_side
    if s_cols != d_cols:
        return [f"columns {s_cols} != {d_cols}"]
    found = [
        f"type of {c}: {s_types[c]} != {d_types[c]}"
        for c in s_cols
        if SAME.get(s_types[c]) != d_types[c]
    ]
    if s_rows != d_rows:
        only_s, only_d = s_rows - d_rows, d_rows - s_rows
        found.append(
            f"{s_cols}: {sum(s_rows.values())} vs {sum(d_rows.values())} rows, "
            f"{sum(only_s.values())} only in Spark {list(only_s)[:3]}, "
            f"{sum(only_d.values())} only in DuckDB {list(only_d)[:3]}"
        )
    return found
