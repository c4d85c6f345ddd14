"""A semantic layer on Spark: sources with joins, dimensions, measures and views.

Every query is an ordinary lazy DataFrame; measures keep the grain of the source they belong to.
"""

from semlayer.functions.measures import count, derived, divide, ratio, sum_of
from semlayer.operators.checks import Check, checks_of, is_check, run_check, run_suite
from semlayer.operators.closure import shared_folder, source_edges, transitive_closure
from semlayer.operators.keys import primary_key_violations
from semlayer.operators.materialize import (
    PREVIEW_ROWS,
    Written,
    materialize,
    materialize_sql,
    preview,
    release,
    to_arrow,
    write_files,
    write_rows,
)
from semlayer.plans.view import View, view
from semlayer.sources.readers import file_source, read_file, sql_source, table_source
from semlayer.sources.source import Source

__all__ = [
    "PREVIEW_ROWS",
    "Check",
    "Source",
    "View",
    "Written",
    "checks_of",
    "count",
    "derived",
    "divide",
    "file_source",
    "is_check",
    "materialize",
    "materialize_sql",
    "preview",
    "primary_key_violations",
    "ratio",
    "read_file",
    "release",
    "run_check",
    "run_suite",
    "shared_folder",
    "source_edges",
    "sql_source",
    "sum_of",
    "table_source",
    "to_arrow",
    "transitive_closure",
    "view",
    "write_files",
    "write_rows",
]
