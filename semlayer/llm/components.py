"""Connected components of an undirected graph held in a table, by alternating stars.

Each round links every node to the smallest node it knows, first over its larger neighbours,
then over its smaller ones, until nothing changes; the number of rounds grows with the logarithm
of the longest path.  Rounds are written to the shared folder, so no round depends on what an
executor holds.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share; `spark.checkpoint.dir`, else the warehouse."""
    return spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")


def written(frame: DataFrame, name: str) -> DataFrame:
    """The rows of `frame` from a new Parquet folder below the shared folder."""
    spark = frame.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of `edges` (a, b bigint); root is the smallest node reachable."""
    links = written(
        edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "links"
    )
    before = None
    while True:
        both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (
            both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        )
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
        links = written(small.where("u <> v").distinct(), "links")
        now = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(now) == before:
            break
        before = tuple(now)
    stars = links.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return stars.union(links.select(F.col("v"), F.col("v"))).distinct()
