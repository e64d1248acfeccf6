"""Connected components by alternating large and small stars, every round written to the shared folder."""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..sources.shared import stage


def _both_ways(links: DataFrame) -> DataFrame:
    return links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _with_least(links: DataFrame) -> DataFrame:
    """Each directed link with the least of the node and its neighbours; the minimum is pre-aggregated before the shuffle."""
    least = links.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return links.join(least, "a")


def _large_star(links: DataFrame) -> DataFrame:
    return _with_least(_both_ways(links)).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    starred = _with_least(down)
    return starred.select(F.col("b").alias("a"), F.col("m").alias("b")).union(starred.select("a", F.col("m").alias("b")))


def _distinct(links: DataFrame) -> DataFrame:
    return links.where("a <> b").select("a", "b").distinct()


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``least`` (smallest node reachable) for every node of ``links(a, b)`` that is not the smallest itself."""
    links = stage(_distinct(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))))
    state = None
    while True:
        now = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            return links.select(F.col("a").alias("node"), F.col("b").alias("least"))
        state = now
        links = stage(_distinct(_small_star(_distinct(_large_star(links)))))
