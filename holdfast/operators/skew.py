"""Equi-joins and groupings that stay balanced when a few keys own most rows."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HEAVY_SHARE = 0.001


def heavy_keys(df: DataFrame, key: str, heavy_share: float = HEAVY_SHARE) -> DataFrame:
    """Keys that own more than the given share of all rows: fewer than ``1 / heavy_share`` rows, whatever the data."""
    total = df.agg(F.count(F.lit(1)).alias("rows"))
    counts = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
    return counts.filter(F.col("rows") > total.scalar() * heavy_share).select(key, F.lit(True).alias("_heavy"))


def split_heavy_join(
    large: DataFrame, lookup: DataFrame, key: str, how: str = "inner", heavy_share: float = HEAVY_SHARE
) -> DataFrame:
    """Join ``large`` to ``lookup`` (unique on ``key``).

    Heavy keys are joined by broadcasting just their lookup rows; all other keys take the ordinary shuffled join.
    """
    heavy_rows = F.broadcast(heavy_keys(large, key, heavy_share))
    heavy_lookup = lookup.join(heavy_rows, key).drop("_heavy")
    tagged = large.join(heavy_rows, key, "left")
    hot = tagged.filter(F.col("_heavy").isNotNull()).drop("_heavy")
    cold = tagged.filter(F.col("_heavy").isNull()).drop("_heavy")
    joined_hot = hot.join(F.broadcast(heavy_lookup), key, how)
    return joined_hot.unionByName(cold.join(lookup, key, how))
