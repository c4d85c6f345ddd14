"""Everything upstream of everything: the transitive closure of an edge table."""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from semlayer.operators.materialize import write_files
from semlayer.sources.source import Source


def shared_folder(spark: SparkSession) -> str:
    """The folder the session names for checkpoints, else its warehouse; all executors see both."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return (folder or spark.conf.get("spark.sql.warehouse.dir")).rstrip("/")


def transitive_closure(edges: DataFrame, source: str = "src", target: str = "dst") -> DataFrame:
    """All pairs (src, dst) joined by a path of one or more edges; cycles end by themselves.

    Paths double: a round continues the pairs whose shortest path has exactly the length reached so
    far by every known pair, and writes the pairs not seen yet.  So the rounds grow with the
    logarithm of the longest shortest path, and end when no pair is as long as a round allows.
    The written rounds are the result; a lost executor costs its tasks and not the rounds so far.
    """
    spark = edges.sparkSession
    folder = f"{shared_folder(spark)}/closure-{uuid.uuid4().hex}"
    steps = edges.select(F.col(source).alias("src"), F.col(target).alias("dst")).dropna().distinct()
    steps = steps.withColumn("length", F.lit(1).cast("bigint"))
    schema = steps.schema

    def written(rounds: Iterable[str]) -> DataFrame:
        return spark.read.schema(schema).parquet(*rounds)

    rounds = [f"{folder}/round-0"]
    write_files(steps, rounds[0])
    reach = 1
    while True:
        longest = written(rounds[-1:]).where(F.col("length") == reach)
        if reach > 1 and longest.isEmpty():
            return written(rounds).select("src", "dst")
        known = written(rounds)
        onward = known.selectExpr("src AS dst", "dst AS next", "length AS more")
        reached = longest.join(onward, "dst").groupBy("src", F.col("next").alias("dst")).agg(F.min("more").alias("more"))
        unseen = reached.join(known, ["src", "dst"], "left_anti")
        rounds.append(f"{folder}/round-{len(rounds)}")
        write_files(unseen.select("src", "dst", (F.col("more") + reach).alias("length")), rounds[-1])
        reach *= 2


def source_edges(spark: SparkSession, sources: Iterable[Source]) -> DataFrame:
    """Edges (src, dst) from each source to the bases and joined sources it is built from."""
    pairs = sorted({pair for source in sources for pair in source.upstream()})
    return spark.createDataFrame(pairs, "src string, dst string")
