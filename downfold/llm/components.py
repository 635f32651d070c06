"""Connected components of a link table, by alternating large and small stars."""

from pyspark.sql import DataFrame, functions as F

from downfold.llm.common import rows_of, written


def _both_ways(links: DataFrame) -> DataFrame:
    return links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _fingerprint(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b); component is the smallest node reachable.

    Each round writes its links, hangs what is larger than a node on the smallest thing the
    node knows and then hangs what is smaller there, until the links are stars. The number
    of rounds grows with the logarithm of the longest chain; links stay at most as many.
    Nulls and links of a node to itself are ignored.
    """
    links = links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    links = written(links.filter(F.col("a") < F.col("b")).distinct(), "links")
    seen = _fingerprint(links)
    if not seen[0]:
        return rows_of(links, links.schema).select(F.col("a").alias("node"), F.col("b").alias("component"))
    while True:
        around = _both_ways(links)
        least = around.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        large = around.filter(F.col("b") > F.col("a")).join(least, "a").select(F.col("m").alias("a"), "b")
        large = large.filter(F.col("a") < F.col("b")).distinct()
        # each row of large has its smaller end first: the smaller neighbours of b
        low = large.groupBy("b").agg(F.min("a").alias("m"))
        hung = large.join(low, "b")
        small = hung.select(F.col("m").alias("a"), F.col("a").alias("b")).unionByName(hung.select(F.col("m").alias("a"), "b"))
        links = written(small.filter(F.col("a") < F.col("b")).distinct(), "links")
        now = _fingerprint(links)
        if now == seen:
            break
        seen = now
    stars = links.select(F.col("b").alias("node"), F.col("a").alias("component"))
    return stars.unionByName(links.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct())
