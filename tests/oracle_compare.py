"""Run registered queries and their SQL side by side and compare all values."""

from __future__ import annotations

import datetime
import decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def oracle_connection(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, decimal.Decimal):
        return str(value)
    if isinstance(value, (datetime.date, datetime.datetime)):
        return value.isoformat()
    return value


def _sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(row[i]) for i in order) for row in rows), key=repr)


# Spark type to the SQL type the oracle must have.  Fixed values.
TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "date": "DATE",
    "boolean": "BOOLEAN",
}


def compare(frame, connection, sql: str) -> str | None:
    """None when equal, else what differs."""
    relation = connection.sql(sql)
    columns = list(relation.columns)
    if sorted(columns) != sorted(frame.columns):
        return f"columns {frame.columns} against {columns}"
    types = dict(zip(columns, map(str, relation.types)))
    for field in frame.schema.fields:
        spark_type = field.dataType.simpleString()
        expected = TYPES.get(spark_type, spark_type.upper())
        if types[field.name].replace(" ", "") != expected.replace(" ", ""):
            return f"type of {field.name}: {spark_type} against {types[field.name]}"
    ours = _sorted_rows(frame.columns, [tuple(row) for row in frame.collect()])
    theirs = _sorted_rows(columns, relation.fetchall())
    if len(ours) != len(theirs):
        return f"{len(ours)} rows against {len(theirs)}"
    for mine, other in zip(ours, theirs):
        if mine != other:
            return f"{mine} against {other}"
    return None
