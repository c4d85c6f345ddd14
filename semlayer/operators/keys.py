"""Guards for what a model declares about its sources."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from semlayer.sources.scope import quoted
from semlayer.sources.source import Source


def primary_key_violations(source: Source) -> DataFrame:
    """Key values that occur more than once, with how often; nulls in a key count as a value."""
    if not source.key:
        raise ValueError(f"'{source.name}' declares no primary key")
    keys = [quoted(column) for column in source.key]
    counted = source.frame.groupBy(*keys).agg(F.count(F.lit(1)).alias("occurrences"))
    return counted.filter(F.col("occurrences") > 1)
