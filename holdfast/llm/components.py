"""Connected components of a table of links, by rounds of joins."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast.session import store


def components(links: DataFrame) -> DataFrame:
    """Columns node and root (the smallest node of its component) for each node of the links (columns a, b).

    Alternates two star steps: each node hands its larger neighbours to its smallest one, then its smaller ones. Every
    round works on as many links as there are nodes and links at most, their number of rounds grows with the logarithm
    of the longest chain. Minima are aggregates, so a node with very many links is summed up before it is shuffled.
    """
    links = store(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
                  "links")
    while True:
        # Large star: neighbours above the node link to its smallest neighbour or itself.
        both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = store(both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                      .where("a <> b").distinct(), "links")
        # Small star: the node and its smaller neighbours link to the smallest.
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = store(large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
                      .union(least.select("a", F.col("m").alias("b"))).distinct(), "links")
        before, after = _signature(links), _signature(small)
        links = small
        if before == after:
            break
    roots = links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)


def _signature(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
