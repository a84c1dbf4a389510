"""Runs a query and its SQL counterpart and compares all rows."""

from __future__ import annotations

import glob
import os

import duckdb
import pandas as pd


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def _normal(frame: pd.DataFrame) -> list[tuple]:
    columns = sorted(frame.columns)
    rows = []
    for row in frame[columns].itertuples(index=False, name=None):
        rows.append(tuple(None if v is None or v is pd.NaT or v != v else v for v in row))
    return sorted(rows, key=repr)


def differences(spark_frame: pd.DataFrame, sql_frame: pd.DataFrame) -> list[str]:
    if sorted(spark_frame.columns) != sorted(sql_frame.columns):
        return [f"columns {sorted(spark_frame.columns)} != {sorted(sql_frame.columns)}"]
    if len(spark_frame) != len(sql_frame):
        return [f"rows {len(spark_frame)} != {len(sql_frame)}"]
    out = []
    for c in spark_frame.columns:
        left, right = spark_frame[c].dtype.kind, sql_frame[c].dtype.kind
        if left != right:
            out.append(f"type of {c}: {spark_frame[c].dtype} != {sql_frame[c].dtype}")
    pairs = [(a, b) for a, b in zip(_normal(spark_frame), _normal(sql_frame)) if a != b]
    if pairs:
        out.append(f"{len(pairs)} rows differ, e.g. {pairs[0][0]} != {pairs[0][1]}")
    return out
