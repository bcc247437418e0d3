"""What several operators need: stage tables, links to components."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assaylake.session import scratch_dir


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a stage table under the shared scratch folder and read it back.

    This cuts the lineage: a lost executor costs the stage at hand, not those before it.
    """
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def components(spark: SparkSession, links: DataFrame, rounds: int = 60) -> DataFrame:
    """The smallest id reachable from each linked id, but for those that are it: (id, component).

    ``links`` has the columns (a, b). Every round lets each id take the smallest id among its neighbours
    (large star), then hangs those on the smallest of their own (small star); the number of links never
    grows, and a group of any size needs about the logarithm of its width in rounds. A hub's rows are
    combined before they are shuffled.
    """
    edges = stored(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                   .where("a <> b").distinct(), "links")
    seen = _digest(edges)
    for _ in range(rounds):
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        large = stored(large.where("a <> b").distinct(), "large-star")
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(low, "a").select("b", "low", "a")
        small = (small.select(F.col("b").alias("a"), F.col("low").alias("b"))
                 .unionAll(low.select("a", F.col("low").alias("b"))))
        after = stored(small.where("a <> b").distinct(), "small-star")
        before, seen = seen, _digest(after)
        if before == seen:
            return after.groupBy("a").agg(F.min("b").alias("component")).select(F.col("a").alias("id"), "component")
        edges = after
    raise RuntimeError(f"links have not settled after {rounds} rounds")


def _digest(links: DataFrame):
    return links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
