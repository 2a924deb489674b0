"""Connected components of a table of links, by large-star and small-star rounds.

Links are never gathered: a round is two aggregations and joins over the link table, and
the tables between rounds lie in the shared folder. The number of rounds grows with the
logarithm of the largest component.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.operators.joins import lookup
from clickloom.session import stage


def _star(links: DataFrame, large: bool) -> DataFrame:
    """Hang the larger (or the smaller and own) neighbours of each node on its least one."""
    if large:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        both = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    hung = lookup(both, least, "a", "inner")
    if large:
        out = hung.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = hung.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            hung.select(F.col("a"), F.col("m").alias("b"))
        )
    return out.where("a <> b").distinct()


def _sum(links: DataFrame) -> tuple:
    return tuple(links.agg(
        F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
    ).first())


def components(links: DataFrame) -> DataFrame:
    """`node`, `root` of every node in `links` (`a`, `b`); the root is the least node."""
    links = stage(links.select("a", "b").where("a <> b").distinct(), "links")
    before = _sum(links)
    while before[0]:
        links = stage(_star(_star(links, True), False), "links")
        now = _sum(links)
        if now == before:
            break
        before = now
    rooted = links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    roots = links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return rooted.unionByName(roots)
