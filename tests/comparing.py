"""Runs a query and its SQL on the same tables and compares whole results."""

from __future__ import annotations

import duckdb
import pandas as pd

TABLES = ("documents", "pages", "conversations", "benchmark", "labels")


def _rows(frame: pd.DataFrame) -> list[str]:
    def plain(v):
        if pd.isna(v):
            return None
        return int(v) if isinstance(v, (float, bool)) and v == int(v) else v

    ordered = frame[sorted(frame.columns)].astype(object)
    return sorted(repr(tuple(map(plain, r))) for r in ordered.itertuples(index=False))


def assert_same(spark, query, sql: str, sf_dir: str) -> None:
    connection = duckdb.connect()
    for t in TABLES:
        connection.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    want = connection.sql(sql).df()
    got = query(spark, sf_dir).toPandas()
    assert sorted(got.columns) == sorted(want.columns)
    assert _rows(got) == _rows(want)
