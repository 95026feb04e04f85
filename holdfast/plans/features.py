"""Training data: derived columns, exact stratified split, scaling, one-hot encoding."""

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from holdfast import schemas as S
from holdfast.functions import columns as C
from holdfast.operators.selection import column_guard
from holdfast.operators.skew import split_heavy_join
from holdfast.session import store

SEED = 42
TEST_SHARE = 0.2
CATEGORIES_PER_RANGE = 200_000


def add_derived_features(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "tenure_band": C.tenure_band(),
        "num_services": C.num_services(),
        "charge_per_month_ratio": C.charge_ratio(),
        "revenue_at_risk": C.revenue_at_risk(),
    })


def model_matrix(df: DataFrame, exclude: tuple[str, ...] = ()) -> DataFrame:
    """Customer, label and the model inputs; every other column is dropped.

    ``churn_score`` is itself a prediction of churn; exclude it for an honest estimate.
    """
    inputs = [c for c in [*S.NUMERIC_COLUMNS, *S.NOMINAL_COLUMNS] if c not in exclude]
    labelled = C.label_target(df).withColumnRenamed("churn_label", "label")
    return column_guard(labelled, ["customer_id", "label", *inputs])


# --- selection by hash order -------------------------------------------------------------------------------------


def hash_key(id_col: str, seed: int) -> Column:
    return F.md5(F.concat(F.col(id_col), F.lit(f"|{seed}")))


def hash_cuts(
    df: DataFrame, id_col: str, class_col: str, wanted: Column, seed: int, digits: int = 3
) -> DataFrame:
    """Per class the hash of the row that is ``wanted``-th in hash order.

    ``wanted`` may use ``class_rows``, the size of the class. Hashes spread evenly over 16^digits buckets, so bucket
    counts locate the row and only its bucket - one 4096th of the class - is sorted.
    """
    hashed = df.select(F.col(class_col), F.col(id_col).alias("_id"), hash_key(id_col, seed).alias("_hash"))
    hashed = hashed.withColumn("_bucket", F.substring("_hash", 1, digits))
    counts = hashed.groupBy(class_col, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    whole = W.partitionBy(class_col)
    running = whole.orderBy("_bucket").rowsBetween(W.unboundedPreceding, W.currentRow)
    located = counts.select(
        class_col, "_bucket", "_n",
        F.sum("_n").over(running).alias("_upto"),
        F.sum("_n").over(whole).alias("class_rows"),
    ).withColumn("_wanted", wanted.cast("bigint"))
    holds = (F.col("_wanted") > F.col("_upto") - F.col("_n")) & (F.col("_wanted") <= F.col("_upto"))
    target = located.filter(holds).select(
        class_col, "_bucket", (F.col("_wanted") - F.col("_upto") + F.col("_n")).alias("_need")
    )
    # One row per class.
    inside = hashed.join(F.broadcast(target), [class_col, "_bucket"])
    position = F.row_number().over(W.partitionBy(class_col).orderBy("_hash", "_id"))
    picked = inside.withColumn("_position", position).filter(F.col("_position") == F.col("_need"))
    return picked.select(class_col, F.struct(F.col("_hash").alias("h"), F.col("_id").alias("i")).alias("cut"))


def up_to_cut(id_col: str, seed: int) -> Column:
    own = F.struct(hash_key(id_col, seed).alias("h"), F.col(id_col).alias("i"))
    return F.coalesce(own <= F.col("cut"), F.lit(False))


def stratified_split(
    df: DataFrame,
    label: str = "label",
    id_col: str = "customer_id",
    test_share: float = TEST_SHARE,
    seed: int = SEED,
    keys: DataFrame | None = None,
) -> DataFrame:
    """Exact split per class: the rows first in hash order are the test rows.

    The wide rows are neither sorted nor shuffled. ``keys`` may give (id, label) from a cheaper source than ``df``.
    """
    wanted = F.floor(F.col("class_rows") * test_share + 0.5)
    cuts = hash_cuts(df if keys is None else keys, id_col, label, wanted, seed)
    # One row per class of a binary label.
    split = F.when(up_to_cut(id_col, seed), "test").otherwise("train")
    return df.join(F.broadcast(cuts), label, "left").withColumn("split", split).drop("cut").select(*df.columns, "split")


def hashed_split(df: DataFrame, id_col: str = "customer_id", test_share: float = TEST_SHARE, seed: int = SEED) -> DataFrame:
    """One-pass split by hash threshold: no counting, shares hold in expectation only."""
    draw = F.pmod(F.xxhash64(F.col(id_col), F.lit(seed)), F.lit(1_000_000)) / 1_000_000
    return df.withColumn("split", F.when(draw < test_share, "test").otherwise("train"))


def split_audit(df: DataFrame, label: str = "label") -> DataFrame:
    return df.groupBy("split").agg(F.count(F.lit(1)).alias("rows"), C.mean_exact(F.col(label)).alias("churn_rate"))


# --- scaling and encoding ----------------------------------------------------------------------------------------


def numeric_moments(train: DataFrame, columns: list[str]) -> DataFrame:
    """Mean and population deviation of each column in one row."""
    measures = []
    for c in columns:
        value = F.col(c).cast("double")
        measures += [F.avg(value).alias(f"{c}_mean"), F.stddev_pop(value).alias(f"{c}_std")]
    return train.agg(*measures)


def standard_scale(df: DataFrame, train: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """z-scores with the moments of the training rows; a constant column keeps a deviation of one."""
    columns = columns or [c for c in S.NUMERIC_COLUMNS if c in df.columns]
    moments = numeric_moments(train, columns).first()
    scaled = {}
    for c in columns:
        mean, std = moments[f"{c}_mean"], moments[f"{c}_std"] or 1.0
        scaled[c] = (F.col(c).cast("double") - F.lit(mean)) / F.lit(std)
    return df.withColumns(scaled)


def train_categories(train: DataFrame, columns: list[str] | None = None, null_name: str = "None") -> DataFrame:
    """(column, category) pairs present in the training rows; null is a category of its own."""
    columns = columns or [c for c in S.NOMINAL_COLUMNS if c in train.columns]
    filled = train.select(*[F.coalesce(F.col(c), F.lit(null_name)).alias(c) for c in columns])
    return filled.unpivot([], columns, "column_name", "category").distinct()


def category_dictionary(train: DataFrame, columns: list[str] | None = None, null_name: str = "None") -> DataFrame:
    """(column_name, category, idx): the categories of the training rows with dense ids from 0, by column of the list and
    category. A stored table.

    The pairs are sorted by ranges, and a range is numbered from the size of those before it: no task sees more than a range.
    """
    columns = columns or [c for c in S.NOMINAL_COLUMNS if c in train.columns]
    pairs = store(train_categories(train, columns, null_name), "categories")
    ranges = -(-pairs.count() // CATEGORIES_PER_RANGE) or 1
    order = ["_column", "category"]
    placed = store(
        pairs.withColumn("_column", F.array_position(F.lit(columns), F.col("column_name")))
        .repartitionByRange(ranges, *order).sortWithinPartitions(*order)
        # The upper bits are the number of the range, the lower 33 the place inside it.
        .withColumn("_at", F.monotonically_increasing_id()), "ordered-categories",
    ).withColumn("_range", F.shiftright("_at", 33))
    sizes = placed.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    # One row per range.
    before = W.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    starts = sizes.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    inside = F.col("_at").bitwiseAND(F.lit(2**33 - 1))
    return store(placed.join(starts, "_range").select("column_name", "category", (F.col("_start") + inside).alias("idx")), "dictionary")


def one_hot_vectors(
    df: DataFrame, dictionary: DataFrame, columns: list[str] | None = None, null_name: str = "None"
) -> DataFrame:
    """(customer_id, indexes): each customer's 0/1 vector as the ids of its ones, in order.

    A category that is not in the dictionary sets nothing. Common categories meet their id by broadcast, all others by a
    shuffled join, so neither a common category nor a column of very many makes a large task.
    """
    columns = columns or [c for c in S.NOMINAL_COLUMNS if c in df.columns]
    filled = df.select("customer_id", *[F.coalesce(F.col(c), F.lit(null_name)).alias(c) for c in columns])
    own = filled.unpivot(["customer_id"], columns, "column_name", "category").select(
        "customer_id", F.struct("column_name", "category").alias("pair"))
    ids = dictionary.select(F.struct("column_name", "category").alias("pair"), "idx")
    # At most one id per column of the list.
    return split_heavy_join(own, ids, "pair", "left").groupBy("customer_id").agg(
        F.array_sort(F.collect_list("idx")).alias("indexes"))


def one_hot(df: DataFrame, train: DataFrame, columns: list[str] | None = None, null_name: str = "None") -> DataFrame:
    """(customer_id, feature, value): `one_hot_vectors` in long form, all 0/1 columns for every customer.

    A category not seen in training has zeros everywhere.
    """
    columns = columns or [c for c in S.NOMINAL_COLUMNS if c in df.columns]
    dictionary = category_dictionary(train, columns, null_name)
    width = dictionary.count()
    vectors = one_hot_vectors(df, dictionary, columns, null_name)
    every = F.sequence(F.lit(0).cast("bigint"), F.lit(width - 1).cast("bigint"))
    places = vectors.select("customer_id", "indexes", F.explode(every).alias("idx")) if width else vectors.select(
        "customer_id", "indexes", F.lit(0).cast("bigint").alias("idx")).limit(0)
    return places.join(dictionary, "idx").select(
        "customer_id",
        F.concat_ws("_", "column_name", "category").alias("feature"),
        F.array_contains("indexes", F.col("idx")).cast("int").alias("value"),
    )


def build_preprocessor(train: DataFrame, null_name: str = "None") -> Pipeline:
    """Scaling with training moments, one-hot encoding and assembly into ``features``."""
    numeric = [c for c in S.NUMERIC_COLUMNS if c in train.columns]
    nominal = [c for c in S.NOMINAL_COLUMNS if c in train.columns]
    moments = numeric_moments(train, numeric).first()
    scaled = [
        f"(cast({c} as double) - {moments[f'{c}_mean']!r}D) / {(moments[f'{c}_std'] or 1.0)!r}D as {c}_z" for c in numeric
    ]
    filled = [f"coalesce({c}, '{null_name}') as {c}_s" for c in nominal]
    indexed = [f"{c}_i" for c in nominal]
    encoded = [f"{c}_v" for c in nominal]
    return Pipeline(stages=[
        SQLTransformer(statement=f"select *, {', '.join([*scaled, *filled])} from __THIS__"),
        StringIndexer(
            inputCols=[f"{c}_s" for c in nominal], outputCols=indexed, handleInvalid="keep",
            stringOrderType="alphabetAsc",
        ),
        OneHotEncoder(inputCols=indexed, outputCols=encoded, dropLast=True),
        VectorAssembler(inputCols=[*[f"{c}_z" for c in numeric], *encoded], outputCol="features"),
    ])


def apply_preprocessor(model: PipelineModel, df: DataFrame) -> DataFrame:
    kept = [c for c in ("customer_id", "label", "split") if c in df.columns]
    return model.transform(df).select(*kept, "features")


def feature_names(model: PipelineModel) -> list[str]:
    """Numeric names, then column_category for every category of every nominal column."""
    assembler = model.stages[-1]
    numeric = [c.removesuffix("_z") for c in assembler.getInputCols() if c.endswith("_z")]
    indexer = next(s for s in model.stages if isinstance(s, StringIndexerModel))
    names = list(numeric)
    for column, labels in zip(indexer.getInputCols(), indexer.labelsArray):
        names += [f"{column.removesuffix('_s')}_{label}" for label in labels]
    return names


def feature_name_table(model: PipelineModel, df: DataFrame) -> DataFrame:
    rows = list(enumerate(feature_names(model)))
    return df.sparkSession.createDataFrame(rows, "idx int, name string")
