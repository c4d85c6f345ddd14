"""Results as tables, views and files, with a record of what was written.

A table is written in full to a folder of its own before the catalog hears of it, so a failed
write leaves the old table as it was.  Publishing only touches the catalog: the table is pointed
at the new folder, or, where its schema changes, swapped by rename.
"""

from __future__ import annotations

import re
import time
import uuid
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from semlayer.sources.readers import FILE_ROWS, WRITING, may_hold_breaks

PREVIEW_ROWS = 5
MODES = ("table", "view")


@dataclass(frozen=True)
class Written:
    """What one materialisation did.  A view has no row count: nothing was computed."""

    target_table: str
    mode: str
    row_count: int | None
    columns: tuple[tuple[str, str], ...]
    duration_seconds: float
    location: str | None = None
    previous_location: str | None = None
    preview: tuple[Row, ...] = ()


def schema_columns(frame: DataFrame) -> tuple[tuple[str, str], ...]:
    return tuple((field.name, field.dataType.simpleString()) for field in frame.schema.fields)


def materialize(
    frame: DataFrame,
    target: str,
    mode: str = "table",
    file_format: str = "parquet",
    folder: str | None = None,
    preview_rows: int = 0,
) -> Written:
    """Create or replace a table (``folder`` defaults to the warehouse) or a session view.

    A view made of a DataFrame lives as long as the session; use ``materialize_sql`` for a stored
    one.  The folder of a replaced table is kept for its readers and returned as
    ``previous_location``; ``release`` drops it.  A preview reads that many rows of what was written.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, not {mode!r}")
    started = time.monotonic()
    if mode == "view":
        frame.createOrReplaceTempView(target)
        return Written(target, mode, None, schema_columns(frame), _since(started))

    spark = frame.sparkSession
    _check_target(spark, target)
    root = folder or spark.conf.get("spark.sql.warehouse.dir")
    location = f"{root.rstrip('/')}/{target}/run-{uuid.uuid4().hex}"
    rows = write_files(frame, location, file_format)
    previous = _publish(spark, target, location, file_format, frame.schema)
    head = tuple(preview(spark, target, preview_rows)) if preview_rows else ()
    return Written(target, mode, rows, schema_columns(frame), _since(started), location, previous, head)


def release(spark: SparkSession, written: Written) -> bool:
    """Drop the folder that a materialisation replaced; True if there was one.

    For the caller to call when no reader of the old table is left.  Only a folder that
    ``materialize`` made is dropped, and never the one the table stands on now.
    """
    old = written.previous_location
    if not old or not re.fullmatch(r"run-[0-9a-f]{32}", old.rstrip("/").rsplit("/", 1)[-1]):
        return False
    if spark.catalog.tableExists(written.target_table) and _same_folder(_stored_as(spark, written.target_table)[1], old):
        return False
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(old)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def _same_folder(one: str, other: str) -> bool:
    """Whether two spellings of a location, with or without a scheme, are one path."""
    plain = [re.sub(r"^file:/*", "/", text).rstrip("/") for text in (one, other)]
    return plain[0] == plain[1]


def materialize_sql(spark: SparkSession, text: str, target: str) -> Written:
    """A stored view of SQL text over catalog tables or files."""
    started = time.monotonic()
    spark.sql(f"CREATE OR REPLACE VIEW {_quoted(target)} AS {text.strip().rstrip(';')}")
    return Written(target, "view", None, schema_columns(spark.table(target)), _since(started))


def write_files(
    frame: DataFrame, path: str, file_format: str = "parquet", **options: str
) -> int:
    """Write a new folder and return its row count, counted by the writing job itself.

    Text formats are written as `read_file` reads them, those that one task must read from its start
    in files of FILE_ROWS rows; pass ``maxRecordsPerFile`` for very long or very short rows.
    """
    spark_format, defaults = WRITING.get(file_format, (file_format, {}))
    if spark_format == "csv" and may_hold_breaks(frame.schema):
        defaults = {**defaults, "maxRecordsPerFile": str(FILE_ROWS)}
    observation = Observation()
    counted = frame.observe(observation, F.count(F.lit(1)).alias("rows"))
    counted.write.format(spark_format).options(**{**defaults, **options}).mode("errorifexists").save(path)
    return observation.get["rows"]


def write_rows(spark: SparkSession, rows: list, schema: StructType | str, path: str) -> int:
    """Small literal reference data as Parquet."""
    return write_files(spark.createDataFrame(rows, schema), path)


def preview(spark: SparkSession, target: str, rows: int = PREVIEW_ROWS) -> list[Row]:
    """A few rows of what was written; reads no more files than it needs."""
    return spark.table(target).limit(rows).collect()


def to_arrow(frame: DataFrame, row_limit: int) -> pa.Table:
    """A bounded result as an Arrow table; the limit is required."""
    return frame.limit(row_limit).toArrow()


def _check_target(spark: SparkSession, target: str) -> None:
    """Refuse a target that could not be published, before anything is written."""
    parts = target.split(".")
    in_session_catalog = len(parts) < 3 or parts[0] == "spark_catalog"
    if in_session_catalog and not all(re.fullmatch(r"\w+", part, re.ASCII) for part in parts):
        raise ValueError(f"'{target}': table names hold letters, digits and underscores only")
    if len(parts) > 1 and not spark.catalog.databaseExists(".".join(parts[:-1])):
        raise ValueError(f"'{target}' names a schema that does not exist")
    if spark.catalog.tableExists(target):
        found = spark.catalog.getTable(target)
        if found.isTemporary or found.tableType == "VIEW":
            raise ValueError(f"'{target}' is a view; drop it to make it a table")


def _publish(
    spark: SparkSession, target: str, location: str, file_format: str, schema: StructType
) -> str | None:
    if not spark.catalog.tableExists(target):
        _create(spark, target, location, file_format, schema)
        return None
    old_format, old_location = _stored_as(spark, target)
    old_schema = [(f.name, f.dataType) for f in spark.table(target).schema.fields]
    same = old_schema == [(f.name, f.dataType) for f in schema.fields]
    if same and old_format == file_format:
        spark.sql(f"ALTER TABLE {_quoted(target)} SET LOCATION '{_escaped(location)}'")
        spark.catalog.refreshTable(target)
        return old_location
    mark = uuid.uuid4().hex[:8]
    staged, retired = f"{target}__new_{mark}", f"{target}__old_{mark}"
    _create(spark, staged, location, file_format, schema)
    _rename(spark, target, retired)
    try:
        _rename(spark, staged, target)
    except Exception:
        _rename(spark, retired, target)
        raise
    spark.sql(f"DROP TABLE {_quoted(retired)}")
    return old_location


def _escaped(text: str) -> str:
    """The inside of a SQL string literal."""
    return text.replace("\\", "\\\\").replace("'", "\\'")


def _create(spark, table: str, location: str, file_format: str, schema: StructType) -> None:
    spark.catalog.createTable(table, path=location, source=file_format, schema=schema)


def _rename(spark: SparkSession, table: str, name: str) -> None:
    inside_catalog = ".".join(name.split(".")[-2:])
    spark.sql(f"ALTER TABLE {_quoted(table)} RENAME TO {_quoted(inside_catalog)}")


def _stored_as(spark: SparkSession, table: str) -> tuple[str, str]:
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {_quoted(table)}")
    facts = {row.col_name: row.data_type for row in described.collect()}
    return facts["Provider"].lower(), facts["Location"]


def _quoted(name: str) -> str:
    return ".".join(f"`{part}`" for part in name.split("."))


def _since(started: float) -> float:
    return round(time.monotonic() - started, 4)
