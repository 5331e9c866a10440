"""Connected components of a link table, as alternating large-star and small-star rounds.

Every round is a grouped minimum (pre-aggregated map-side) and a join of the
links with it, written to the shared folder. A star's centre with very many
links is one row on the grouped side, so the join's hot side can be split.
The driver sees only two numbers a round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewatch.llm.common import written


def _minima(links: DataFrame) -> DataFrame:
    """(u, m): the least of u and its neighbours. Written, so that the join with it shuffles the links
    on their own and Spark can split the partition of a centre."""
    return written(links.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "minima")


def _both(links: DataFrame) -> DataFrame:
    return links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _large_star(links: DataFrame) -> DataFrame:
    both = _both(links)
    return (both.join(_minima(both), "u").where(F.col("v") > F.col("u"))
            .select(F.col("v").alias("u"), F.col("m").alias("v")))


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = _minima(down)
    return (down.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(low.select("u", F.col("m").alias("v"))))


def _state(links: DataFrame) -> tuple:
    row = links.agg(F.count("*").alias("n"),
                    F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], row["h"]


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component) of links (u, v): component is the least node reachable.

    Nodes without a link do not appear; links to oneself, repeated links,
    either direction and nulls (dropped) are fine. Ends when a round leaves
    the links as they were, which is when every node points at its root.
    """
    links = (links.where("u IS NOT NULL AND v IS NOT NULL AND u <> v")
             .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    links = written(links, "links")
    before = _state(links)
    while before[0]:
        links = _small_star(_large_star(links)).where("u <> v").distinct()
        links = written(links, "links")
        after = _state(links)
        if after == before:
            break
        before = after
    roots = links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
