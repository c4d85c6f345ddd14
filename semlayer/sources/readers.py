"""Frames from files, catalog tables and SQL text, wrapped as sources."""

from __future__ import annotations

from pathlib import PurePosixPath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.types import StructType

from semlayer.sources.source import Source

# File extensions, the Spark formats they stand for, and their separators.  Fixed values.
FORMATS = {".parquet": "parquet", ".csv": "csv", ".tsv": "tsv", ".json": "json", ".orc": "orc"}
SCHEMA_FREE = {"csv", "tsv", "json"}
#: How text is written, and read back without loss: names in a header, doubled quotes, quoted line
#: breaks, blanks kept, null apart from the empty string.
DELIMITED = {
    "header": "true",
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "nullValue": "\\N",
}
WRITING = {
    "csv": ("csv", DELIMITED),
    "tsv": ("csv", {**DELIMITED, "sep": "\t"}),
    "json": ("json", {"ignoreNullFields": "false"}),
}
#: A header that differs from the schema and a value of another type raise.
STRICT = {"enforceSchema": "false", "mode": "FAILFAST"}
#: Types whose values may hold a line break.  One file with such a column is read by one task, as
#: only a reader from its start knows which breaks are quoted.  So `write_files` ends a file after
#: FILE_ROWS rows; files without such a column are cut anywhere.
BREAKING = (T.StringType, T.CharType, T.VarcharType, T.BinaryType, T.VariantType)
FILE_ROWS = 100_000


def may_hold_breaks(schema: StructType | str) -> bool:
    """Whether a quoted line break can stand in a delimited file of this schema."""
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    return any(isinstance(field.dataType, BREAKING) for field in schema.fields)


def read_file(
    spark: SparkSession,
    path: str,
    schema: StructType | str | None = None,
    file_format: str | None = None,
    **options: str,
) -> DataFrame:
    """A file or directory by `file_format` or else its extension.  Text formats need a schema:
    inferring one would read the data an extra time."""
    extension = PurePosixPath(path.rstrip("/")).suffix.lower()
    kind = file_format or FORMATS.get(extension)
    if kind not in FORMATS.values():
        raise ValueError(f"'{path}' has none of the extensions {sorted(FORMATS)}; pass file_format")
    if kind in SCHEMA_FREE and schema is None:
        raise ValueError(f"'{path}' carries no types; pass a schema")
    spark_format, defaults = WRITING.get(kind, (kind, {}))
    if kind in ("csv", "tsv"):
        defaults = {**defaults, **STRICT, "multiLine": str(may_hold_breaks(schema)).lower()}
    elif kind == "json":
        defaults = {"mode": "FAILFAST"}
    reader = spark.read.format(spark_format).options(**{**defaults, **options})
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def file_source(
    spark: SparkSession,
    name: str,
    path: str,
    schema: StructType | str | None = None,
    file_format: str | None = None,
    **options: str,
) -> Source:
    return Source(name, read_file(spark, path, schema, file_format, **options))


def table_source(spark: SparkSession, table: str, name: str | None = None) -> Source:
    """A catalog table of one to three name parts; the source is named by the last."""
    return Source(name or table.split(".")[-1].strip("`"), spark.table(table))


def sql_source(spark: SparkSession, name: str, text: str) -> Source:
    return Source(name, spark.sql(text))
