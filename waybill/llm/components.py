"""Connected components of a table of edges, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waybill.llm import common as C


def _large(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")


def _small(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    near = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return near.unionByName(least.select("u", F.col("m").alias("v"))).filter("u <> v")


def components(edges: DataFrame) -> DataFrame:
    """(u, v): each node of an edge but the least of its component, and that least node.

    Every round is a table in the shared folder; the rounds grow with the logarithm of the size."""
    spark = edges.sparkSession
    now = C.written(edges.select(F.col("u").cast("long").alias("u"), F.col("v").cast("long").alias("v"))
                    .filter("u <> v").distinct(), "edges")
    mark = None
    while True:
        following = C.written(_small(_large(now).distinct()).distinct(), "edges")
        found = following.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if tuple(found) == mark:
            return following
        C.drop_folder(spark, now.inputFiles()[0].rsplit("/", 1)[0]) if now.inputFiles() else None
        now, mark = following, tuple(found)
