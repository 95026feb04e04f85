"""Class balance: weights and synthetic minority rows."""

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast.operators.neighbours import nearest_neighbours
from holdfast.operators.skew import split_heavy_join
from holdfast.plans.features import SEED, hash_cuts, up_to_cut
from holdfast.session import store


def class_sizes(df: DataFrame, label: str = "label") -> DataFrame:
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("rows"))


def class_weights(df: DataFrame, label: str = "label") -> DataFrame:
    """Rows over (number of classes times rows of the class), per class."""
    sizes = class_sizes(df, label)
    facts = sizes.agg(F.sum("rows").cast("double").alias("total"), F.count(F.lit(1)).alias("classes"))
    share = facts.select(F.col("total") / F.col("classes"))
    return sizes.select(label, "rows", (share.scalar() / F.col("rows")).alias("weight"))


def with_class_weights(df: DataFrame, label: str = "label") -> DataFrame:
    # One row per class of a binary label.
    return df.join(F.broadcast(class_weights(df, label).select(label, "weight")), label)


def smote(
    train: DataFrame, k: int = 5, seed: int = SEED, id_col: str = "customer_id", label: str = "label"
) -> DataFrame:
    """Bring the smaller class to the size of the larger one with points between a row and one of its k neighbours.

    Every minority row makes the same number of points, and the first rows in hash order make one more, so that the
    classes come out equal. Neighbour and position are drawn from hashes of (id, number): reruns give the same rows.
    """
    # Three rows at most: a third class is an error.
    sizes = {r[label]: r["rows"] for r in class_sizes(train, label).limit(3).collect()}
    if len(sizes) != 2:
        raise ValueError(f"oversampling needs two classes, found {'more' if len(sizes) > 2 else len(sizes)}")
    minority = min(sizes, key=lambda c: (sizes[c], c))
    if sizes[minority] < 2:
        raise ValueError("oversampling needs two minority rows at least")
    missing = max(sizes.values()) - sizes[minority]
    each, extra = divmod(missing, sizes[minority])
    original = train.select(id_col, label, "features", F.lit(False).alias("synthetic"))
    if missing == 0:
        return original
    small = train.filter(F.col(label) == minority).select(id_col, label, vector_to_array("features").alias("x"))
    near = nearest_neighbours(small, k, id_col, label, "x").filter(F.size("neighbours") > 0)
    if extra:
        cuts = hash_cuts(small, id_col, label, F.lit(extra), seed)
        # One row: there is one minority class.
        near = near.join(F.broadcast(cuts), label, "left")
        points = F.lit(each) + F.when(up_to_cut(id_col, seed), 1).otherwise(0)
    else:
        points = F.lit(each)
    drawn = near.withColumn("points", points).filter(F.col("points") > 0)
    drawn = drawn.select(
        id_col, label, "vec", "neighbours", F.explode(F.sequence(F.lit(1), F.col("points"))).alias("number")
    )
    # Neighbour and position from one digest.
    digest = F.md5(F.concat_ws("|", id_col, F.col("number").cast("string"), F.lit(str(seed))))
    pick = F.pmod(F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint"), F.size("neighbours")).cast("int")
    drawn = store(drawn.select(
        id_col, label, "vec", "number", F.get("neighbours", pick)["id"].alias("other"),
        (F.conv(F.substring(digest, 9, 8), 16, 10).cast("double") / float(2**32)).alias("u"),
    ), "draws")
    # Some rows are the neighbour of very many others.
    paired = split_heavy_join(drawn, small.select(F.col(id_col).alias("other"), F.col("x").alias("other_vec")), "other")
    point = F.zip_with("vec", "other_vec", lambda a, b: a + F.col("u") * (b - a))
    synthetic = paired.select(
        F.concat_ws("#", id_col, F.col("number").cast("string")).alias(id_col),
        label,
        array_to_vector(point).alias("features"),
        F.lit(True).alias("synthetic"),
    )
    return original.unionByName(synthetic)


def balance_audit(before: DataFrame, after: DataFrame, label: str = "label") -> DataFrame:
    stages = [class_sizes(d, label).withColumn("stage", F.lit(s)) for s, d in (("before", before), ("after", after))]
    return stages[0].unionByName(stages[1]).select("stage", label, "rows")
