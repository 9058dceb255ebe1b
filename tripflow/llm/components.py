"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.session import stage


def smallest_reachable(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (columns a and b, same type): the smallest node it reaches.

    Every step keeps at most as many links as it got and points them at smaller nodes; it ends when a
    step changes nothing. Steps are joins with a pre-aggregated minimum, so a node with very many
    links is combined on the map side and its join can be split. Each round is written to the shared
    folder, which cuts the lineage. Only a count and a checksum reach the driver. Self links and
    repeated links are allowed; no links give no rows.
    """
    links = stage(_ordered(links), "links")
    seen = _checksum(links)
    while seen[0]:
        links = stage(_small_star(_large_star(links)), "links")
        now = _checksum(links)
        if now == seen:
            break
        seen = now
    roots = links.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root"))
    return roots.union(links.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()


def _ordered(links: DataFrame) -> DataFrame:
    high, low = F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    return links.select(high, low).where("a <> b").distinct()


def _checksum(links: DataFrame) -> tuple:
    mixed = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
    return tuple(links.agg(F.count(F.lit(1)), mixed).first())


def _large_star(links: DataFrame) -> DataFrame:
    """Larger neighbours of a node point to the smallest node among it and its neighbours."""
    both = links.union(links.select("b", "a")).toDF("a", "b")
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours point to the smallest of them."""
    least = links.groupBy("a").agg(F.min("b").alias("least"))
    below = links.join(least, "a").where("b > least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return below.union(least.select("a", F.col("least").alias("b"))).distinct()
