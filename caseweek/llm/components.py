"""Connected components of a link table by large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def _state(links: DataFrame) -> tuple[int, int]:
    row = links.agg(F.count(F.lit(1)).alias("n"),
                    F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.lit(0)).alias("s")).first()
    return row["n"], int(row["s"])


def connect(links: DataFrame) -> DataFrame:
    """(u, v) links of long nodes to (node, root) rows: root is the smallest node of node's component.

    Nodes that are roots themselves or have no links don't occur. Each round hooks every node's larger
    neighbours, then its smaller ones, to its smallest neighbour; the links stay as many as the nodes and
    shrink to one star a component. Each node's smallest neighbour is stored before it is joined back, so
    both sides of the join come straight from a shuffle and a node with very many links can be split.
    The rounds are as many as the logarithm of the longest path; only a count and a checksum come to
    the driver.
    """
    links = stored(links.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                   .distinct(), "links")
    state = _state(links)
    while state[0]:
        both = links.unionAll(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = stored(both.groupBy("u").agg(F.least("u", F.min("v")).alias("m")), "links-least")
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stored(large.distinct(), "links-large")
        least = stored(large.groupBy("u").agg(F.min("v").alias("m")), "links-least")
        small = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        links = stored(small.unionAll(least.select("u", F.col("m").alias("v"))).distinct(), "links")
        before, state = state, _state(links)
        if state == before:
            break
    return links.select(F.col("u").alias("node"), F.col("v").alias("root"))
