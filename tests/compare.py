"""Compare a Spark result with a DuckDB result as multisets of typed rows."""

from __future__ import annotations

import datetime
from collections import Counter
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute("set TimeZone = 'UTC'")
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    return value


_KINDS = {
    "BIGINT": "bigint",
    "INTEGER": "int",
    "VARCHAR": "string",
    "DOUBLE": "double",
    "BOOLEAN": "boolean",
    "DATE": "date",
    "TIMESTAMP": "timestamp",
}


def assert_same(df, connection, sql: str) -> None:
    relation = connection.sql(sql)
    columns = sorted(df.columns)
    assert columns == sorted(relation.columns)
    expected_kinds = {
        name: _KINDS.get(str(kind), str(kind))
        for name, kind in zip(relation.columns, relation.types)
    }
    assert dict(df.dtypes) == expected_kinds
    quoted = [f"`{c}`" for c in columns]
    actual = Counter(tuple(map(_plain, row)) for row in df.select(*quoted).collect())
    order = [relation.columns.index(c) for c in columns]
    expected = Counter(tuple(_plain(row[i]) for i in order) for row in relation.fetchall())
    only_actual, only_expected = actual - expected, expected - actual
    assert not only_actual and not only_expected, (
        f"{sum(only_actual.values())} rows only in Spark, e.g. {list(only_actual)[:2]}; "
        f"{sum(only_expected.values())} only in SQL, e.g. {list(only_expected)[:2]}"
    )
    assert expected, "an empty result checks nothing"
