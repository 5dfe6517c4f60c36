"""Connected components of a table of links, by Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sampleflow.sources.storage import work_dir


def kept(df: DataFrame, name: str) -> DataFrame:
    """The table written to the shared folder and read again: its lineage ends there."""
    spark = df.sparkSession
    path = work_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: A written table of a few short columns up to so many rows is broadcast, a larger one is joined by shuffle.
BROADCAST_ROWS = 500_000


def small(df: DataFrame) -> DataFrame:
    """A written table, marked for broadcast if it has few rows."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def _large_star(links: DataFrame) -> DataFrame:
    both = links.select("u", "v").union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    sides = down.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return sides.union(least.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """``u``, ``v`` links to ``node``, ``component``: the smallest node reachable, for every linked node.

    Alternates large and small stars (Kiveris et al., 2014) until nothing changes. A
    node's neighbours are only ever reduced to their least, before the shuffle too, and
    a node with many links is a skewed join that Spark splits. Links of a node with
    itself and null ends count for nothing.
    """
    state = F.struct(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")))
    links = kept(links.where("u <> v").select("u", "v").distinct(), "links")
    seen = links.agg(state.alias("s")).first().s
    while seen[0]:
        links = kept(_small_star(_large_star(links)), "links")
        now = links.agg(state.alias("s")).first().s
        if now == seen:
            break
        seen = now
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
