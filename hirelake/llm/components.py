"""Connected components by alternating large-star and small-star steps."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelake.scratch import materialise


def _stars(links: DataFrame) -> DataFrame:
    """Each node with its neighbours and the smallest of both. The minimum is an
    aggregation and comes back by a join, so a node with very many neighbours is
    summed up before the shuffle and split by the join."""
    low = links.groupBy("u").agg(F.min("v").alias("_m"))
    return links.join(low.select(F.col("u").alias("_u"), "_m"), F.col("u") == F.col("_u")).select("u", "v", "_m")


def components(links: DataFrame) -> DataFrame:
    """(``node``, ``component``) for every node of the links (``u``, ``v``, in any
    direction, repeats and loops allowed); the component is its smallest node.

    Each round's links are a written table. Rounds end when the links have become
    stars around the smallest nodes, which takes a number of rounds that grows
    with the logarithm of a component's size.
    """
    links = links.select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
    ).where(F.col("u") != F.col("v")).distinct()
    links = materialise(links, "links")
    before = None
    while True:
        both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _stars(both).select("u", "v", F.least("u", "_m").alias("_m"))
        large = large.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("_m").alias("v")).distinct()
        small = _stars(large)
        links = materialise(
            small.where(F.col("v") != F.col("_m")).select(F.col("v").alias("u"), F.col("_m").alias("v"))
            .union(small.select("u", F.col("_m").alias("v"))).distinct(),
            "links",
        )
        now = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before or not now[0]:
            break
        before = now
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
