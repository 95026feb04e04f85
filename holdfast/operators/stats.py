"""Distribution, summary and correlation tables."""

from itertools import combinations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast import schemas as S
from holdfast.operators.quantiles import exact_quantiles, first_pass, long_values, stored_columns, value_counts
from holdfast.session import small_table, store

QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}


def numeric_summary(df: DataFrame, columns: list[str] | None = None, decimals: int = 2) -> DataFrame:
    """count, mean, std, min, quartiles and max per column, one row per column."""
    columns = columns or S.SUMMARY_COLUMNS
    long = long_values(stored_columns(df, columns), columns)
    moments = [F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"), F.min("value").alias("min"), F.max("value").alias("max")]
    first = first_pass(long, (), *moments)
    quartiles = exact_quantiles(df, columns, QUARTILES, long=long, first=first)
    figures = ["mean", "std", "min", "q1", "median", "q3", "max"]
    # One row per column of the list on either side.
    return first.join(quartiles, "metric").select(
        "metric", F.col("rows").alias("count"), *[F.round(c, decimals).alias(c) for c in figures])


def null_profile(df: DataFrame) -> DataFrame:
    """Columns with nulls and how many."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    long = counts.unpivot([], df.columns, "column_name", "nulls")
    return long.filter(F.col("nulls") > 0)


def schema_profile(df: DataFrame) -> DataFrame:
    """Position, name and type of each column with the number of rows of the table."""
    fields = df.schema.fields
    described = small_table(
        df.sparkSession,
        {
            "position": list(range(len(fields))),
            "column_name": [f.name for f in fields],
            "data_type": [f.dataType.simpleString() for f in fields],
        },
        "position int, column_name string, data_type string",
    )
    return described.withColumn("row_count", df.agg(F.count(F.lit(1))).scalar())


def correlation(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Pearson coefficient of each pair of columns (lower triangle), each over the rows where both are present."""
    columns = columns or S.CORRELATION_COLUMNS
    numeric = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    # One small aggregate over (pair, a, b) rows: they are summed where they arise, and the code stays compact. An
    # aggregate per pair in one row is twice as slow.
    pairs = [
        F.struct(F.lit(y).alias("x"), F.lit(x).alias("y"), F.col(y).alias("a"), F.col(x).alias("b"))
        for x, y in combinations(columns, 2)
    ]
    return numeric.select(F.inline(F.array(*pairs))).groupBy("x", "y").agg(F.corr("a", "b").alias("r"))


def histogram(df: DataFrame, columns: list[str] | None = None, bins: int = 10) -> DataFrame:
    """Equal-width bins between the smallest and largest value; the largest value belongs to the last bin.

    A column with a single value gets bins of half a unit to either side of it.
    """
    columns = columns or S.DISTRIBUTION_COLUMNS
    numeric = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    ends = numeric.agg(*[f(c).alias(f"{c}_{f.__name__}") for c in columns for f in (F.min, F.max)]).first()
    limits = {}
    for c in columns:
        low, high = ends[f"{c}_min"], ends[f"{c}_max"]
        if low is not None:
            limits[c] = (low - 0.5, high + 0.5) if low == high else (low, high)
    if not limits:
        return df.sparkSession.createDataFrame([], "metric string, bin int, bin_start double, bin_end double, rows bigint")
    # The bins are found where the rows are read: only counts per bin are shuffled.
    placed = numeric.select(*[
        F.when(F.col(c) >= high, bins - 1).otherwise(F.floor((F.col(c) - low) / F.lit(high - low) * bins)).cast("int").alias(c)
        for c, (low, high) in limits.items()
    ]).unpivot([], list(limits), "metric", "bin").filter(F.col("bin").isNotNull())
    counted = placed.groupBy("metric", "bin").agg(F.count(F.lit(1)).alias("rows"))
    edges = small_table(
        df.sparkSession,
        {"metric": list(limits), "low": [l for l, _ in limits.values()], "width": [(h - l) / bins for l, h in limits.values()]},
        "metric string, low double, width double",
    )
    # One row per column of the list.
    return counted.join(F.broadcast(edges), "metric").select(
        "metric", "bin",
        (F.col("low") + F.col("bin") * F.col("width")).alias("bin_start"),
        (F.col("low") + (F.col("bin") + 1) * F.col("width")).alias("bin_end"),
        "rows",
    )


def density(df: DataFrame, columns: list[str] | None = None, points: int = 200, cut: float = 3.0) -> DataFrame:
    """Gaussian kernel density per column: over all rows and per churn value.

    Scott's bandwidth (n^-1/5 times the sample deviation); the grid reaches ``cut`` bandwidths beyond the data. Rows
    are weighted distinct values; the kernel's values at all grid points are one vector, summed where they are made.
    """
    columns = columns or S.DISTRIBUTION_COLUMNS
    # One scan: counts per class, then the classes added up. Rows without a class only count overall.
    labelled = df.select(F.coalesce("churn", F.lit("")).alias("subset"), *columns)
    classes = store(value_counts(labelled, columns, ("subset",)), "value-counts")
    everyone = classes.groupBy(F.lit("all").alias("subset"), "metric", "value").agg(F.sum("n").alias("n"))
    weighted = everyone.unionByName(classes.filter(F.col("subset") != ""))
    keys = ["subset", "metric"]
    means = weighted.groupBy(*keys).agg(
        F.sum("n").alias("total"),
        (F.sum(F.col("n") * F.col("value")) / F.sum("n")).alias("mean"),
        F.min("value").alias("low"),
        F.max("value").alias("high"),
    )
    # Subsets times columns: a handful of rows.
    spread = weighted.join(F.broadcast(means), keys).groupBy(*keys, "total", "low", "high").agg(
        F.sqrt(F.try_divide(F.sum(F.col("n") * (F.col("value") - F.col("mean")) ** 2), F.col("total") - 1)).alias("std")
    )
    width = F.col("std") * F.pow(F.col("total").cast("double"), F.lit(-0.2))
    shape = spread.filter(F.col("std") > 0).select(*keys, "total", "low", "high", width.alias("bandwidth"))
    start = F.col("low") - cut * F.col("bandwidth")
    stop = F.col("high") + cut * F.col("bandwidth")
    grid = ["total", "bandwidth", "start", "step"]
    placed = weighted.join(F.broadcast(shape), keys).select(
        *keys, "value", "n", "total", "bandwidth", start.alias("start"), ((stop - start) / (points - 1)).alias("step"))
    # One row of all points per value, added in place: a value never becomes more than one row.
    numbers = F.sequence(F.lit(0), F.lit(points - 1))

    def kernel(point: Column) -> Column:
        u = (F.col("start") + point * F.col("step") - F.col("value")) / F.col("bandwidth")
        return F.col("n") * F.exp(-0.5 * u * u)

    masses = Summarizer.metrics("sum").summary(array_to_vector(F.transform(numbers, kernel)))
    summed = placed.groupBy(*keys, *grid).agg(masses.alias("masses"))
    norm = F.col("total") * F.col("bandwidth") * F.sqrt(2 * F.pi())
    # The points of the grid are the rows of the result.
    return summed.select(*keys, *grid, F.posexplode(vector_to_array("masses.sum")).alias("point", "mass")).select(
        *keys, "point", (F.col("start") + F.col("point") * F.col("step")).alias("x"), (F.col("mass") / norm).alias("density"))


def box_stats(df: DataFrame, columns: list[str], groups: tuple[str, ...]) -> DataFrame:
    """Quartiles, whisker ends (furthest value within 1.5 interquartile ranges) and the number of points outside.

    The stored columns are read again beside the quartiles, one row per group and column, which Spark broadcasts while they
    are few; whiskers and outliers are summed where the rows are read.
    """
    keys = [*groups, "metric"]
    long = long_values(stored_columns(df, columns, groups), columns, groups)
    quartiles = store(exact_quantiles(df, columns, QUARTILES, groups, long=long), "quartiles")
    spread = F.col("q3") - F.col("q1")
    inside = F.col("value").between(F.col("q1") - 1.5 * spread, F.col("q3") + 1.5 * spread)
    return long.join(quartiles, keys).groupBy(*keys, *QUARTILES).agg(
        F.count(F.lit(1)).alias("count"),
        F.min(F.when(inside, F.col("value"))).alias("whisker_low"),
        F.max(F.when(inside, F.col("value"))).alias("whisker_high"),
        F.count_if(~inside).alias("outliers"),
    ).select(*keys, "count", *QUARTILES, "whisker_low", "whisker_high", "outliers")
