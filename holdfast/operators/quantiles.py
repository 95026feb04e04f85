"""Exact order statistics and running sums that no single task has to hold.

``exact_quantiles`` selects by bracket. A mergeable sketch per group and column, built where the rows are read, gives two
values that the wanted rank lies between. One pass counts the rows below and inside the bracket, which proves it or sends it
back, and sketches the inside anew; brackets narrow until few rows lie strictly inside. Only those are shuffled, as (value,
count). What is shuffled depends on ``INSIDE_ROWS``, not on the rows or distinct values of the data.

``running_sums`` needs all values: they are cut into ranges of about ``ROWS_PER_RANGE`` at split points found by an
approximate sketch, in as many levels of at most ``FAN`` ranges as that takes. The split points only balance the ranges:
any choice gives the same, exact answer.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from holdfast.session import store

FAN = 512
ROWS_PER_RANGE = 1_000_000
#: Rows strictly inside a bracket that are shuffled and sorted, the size of a sketch, and how far beyond the wanted rank a
#: bracket reaches as a share of the rows sketched, several times the sketch's error.
INSIDE_ROWS = 200_000
SKETCH_K = 2048
REACH = 0.005
#: Steps of equal share in which a sketch is read.
GRID = 200


def value_counts(df: DataFrame, columns: list[str], groups: tuple[str, ...] = ()) -> DataFrame:
    """(groups, metric, value, n) for every non-null value of the columns."""
    return long_values(df, columns, groups).groupBy(*groups, "metric", "value").agg(F.count(F.lit(1)).alias("n"))


def stored_columns(df: DataFrame, columns: list[str], groups: tuple[str, ...] = ()) -> DataFrame:
    """The columns as doubles, written once for the passes over them; rows without a group are left out."""
    narrow = df.select(*groups, *[F.col(c).cast("double").alias(c) for c in columns])
    for g in groups:
        narrow = narrow.filter(F.col(g).isNotNull())
    return store(narrow, "columns")


def long_values(df: DataFrame, columns: list[str], groups: tuple[str, ...] = ()) -> DataFrame:
    """(groups, metric, value) for every non-null value of the columns and group."""
    narrow = df.select(*groups, *[F.col(c).cast("double").alias(c) for c in columns])
    long = narrow.unpivot(list(groups), columns, "metric", "value").filter(F.col("value").isNotNull())
    for g in groups:
        long = long.filter(F.col(g).isNotNull())
    return long


def with_ranges(counts: DataFrame) -> DataFrame:
    """Add an order-preserving range number per metric to a stored table, whose rows are counted.

    The splits are written, so that they are the same in every branch and every retry of the query.
    """
    wanted = max(1, -(-counts.count() // ROWS_PER_RANGE))
    ranged = counts.withColumn("part", F.lit(0).cast("bigint"))
    while wanted > 1:
        ranges = min(FAN, wanted)
        fractions = [i / ranges for i in range(1, ranges)]
        sketch = F.percentile_approx("value", fractions, 20 * ranges).alias("splits")
        splits = store(ranged.groupBy("metric", "part").agg(sketch), "splits")
        # One row per metric and range so far. Spark knows the size of the written table and broadcasts it if it is small.
        inside = F.size(F.filter("splits", lambda s: s < F.col("value")))
        part = (F.col("part") * ranges + inside).alias("part")
        ranged = ranged.join(splits, ["metric", "part"]).select(*counts.columns, part)
        wanted = -(-wanted // ranges)
    return ranged


def range_offsets(ranged: DataFrame, groups: tuple[str, ...], sums: list[str], descending: bool = False) -> DataFrame:
    """Totals before each range. The windows run over one row per range."""
    totals = ranged.groupBy(*groups, "part").agg(*[F.sum(s).alias(f"_{s}") for s in sums])
    part = F.col("part").desc() if descending else F.col("part").asc()
    running = W.partitionBy(*groups).orderBy(part).rowsBetween(W.unboundedPreceding, W.currentRow)
    whole = W.partitionBy(*groups)
    columns = []
    for s in sums:
        columns.append((F.sum(f"_{s}").over(running) - F.col(f"_{s}")).alias(f"{s}_before"))
        columns.append(F.col(f"_{s}").alias(f"{s}_inside"))
        columns.append(F.sum(f"_{s}").over(whole).alias(f"{s}_total"))
    return totals.select(*groups, "part", *columns)


def _sketch(value: Column) -> Column:
    return F.kll_sketch_agg_double(value, F.lit(SKETCH_K))


def first_pass(long: DataFrame, groups: tuple[str, ...] = (), *figures: Column) -> DataFrame:
    """One row per (groups, metric): rows, a sketch, and further aggregates of ``value``. A stored table."""
    return store(long.groupBy(*groups, "metric").agg(F.count(F.lit(1)).alias("rows"), _sketch(F.col("value")).alias("sketch"), *figures), "first-pass")


def _steps(sketch: str, inside: str) -> Column:
    """The values of a sketch in GRID steps; null for a sketch of nothing."""
    shares = ", ".join(f"{i / GRID!r}D" for i in range(GRID + 1))
    return F.expr(f"if({inside} > 0, kll_sketch_get_quantile_double({sketch}, array({shares})), null)")


def _narrowed(probabilities: dict[str, float], keys: list[str], told: dict[str, Column], reach: float) -> list[Column]:
    """Brackets for the next pass, from the steps of a sketch of what lies strictly inside the last ones."""
    out = [*[F.col(k) for k in keys], F.col("rows")]
    for name, p in probabilities.items():
        lo, hi, below, inside, steps = (told[f"{name}_{part}"] for part in ("lo", "hi", "below", "inside", "steps"))
        low, high = (f((F.col("rows") - 1) * F.lit(float(p))) for f in (F.floor, F.ceil))
        least = F.try_divide(low - below, inside) - reach
        most = F.try_divide(high + 1 - below, inside) + reach
        # A rank that lies at an end of the bracket makes the bracket that one value.
        out.append(F.when((least > 0) & (least < 1), F.get(steps, F.floor(least * GRID).cast("int"))).when(
            low >= below + inside, hi).otherwise(lo).alias(f"{name}_lo"))
        out.append(F.when((most > 0) & (most < 1), F.get(steps, F.ceil(most * GRID).cast("int"))).when(
            high < below, lo).otherwise(hi).alias(f"{name}_hi"))
    return out


def exact_quantiles(
    df: DataFrame, columns: list[str], probabilities: dict[str, float], groups: tuple[str, ...] = (),
    long: DataFrame | None = None, first: DataFrame | None = None,
) -> DataFrame:
    """Linearly interpolated quantiles, one row per (groups, metric) and one column per named probability.

    ``long`` may pass ``long_values`` of stored columns and ``first`` the result of ``first_pass``.
    """
    long = long_values(stored_columns(df, columns, groups), columns, groups) if long is None else long
    first = first_pass(long, groups) if first is None else first
    keys = [*groups, "metric"]
    names = list(probabilities)
    # From below all values to above all values: NaN is the largest double.
    open_ends = {f"{n}_{end}": F.lit(float(v)) for n in names for end, v in (("lo", "-inf"), ("hi", "nan"))}
    whole = {f"{n}_{part}": c for n in names for part, c in (
        ("below", F.lit(0)), ("inside", F.col("rows")), ("steps", F.col("steps")))}
    reach, last_inside = REACH, float("inf")
    read = first.withColumn("steps", _steps("sketch", "rows"))
    brackets = store(read.select(*_narrowed(probabilities, keys, open_ends | whole, reach)), "brackets")
    value = F.col("value")
    while True:
        # A row per group and column; Spark knows the size of the written table and broadcasts it if it is small.
        held = long.join(brackets, keys)
        counts = []
        for n in names:
            lo, hi = F.col(f"{n}_lo"), F.col(f"{n}_hi")
            strictly = (value > lo) & (value < hi)
            counts += [
                F.count_if(value < lo).alias(f"{n}_under"), F.count_if(value == lo).alias(f"{n}_at_lo"),
                F.count_if(strictly).alias(f"{n}_inside"), F.count_if((value == hi) & (hi != lo)).alias(f"{n}_at_hi"),
                _sketch(F.when(strictly, value)).alias(f"{n}_sketch"),
            ]
        ends = [f"{n}_{end}" for n in names for end in ("lo", "hi")]
        told = store(held.groupBy(*keys, "rows", *ends).agg(*counts), "bracket-counts")
        below = {f"{n}_below": F.col(f"{n}_under") + F.col(f"{n}_at_lo") for n in names}
        missed, wide = F.lit(False), F.lit(False)
        for name, p in probabilities.items():
            low, high = (f((F.col("rows") - 1) * F.lit(float(p))) for f in (F.floor, F.ceil))
            early = low < F.col(f"{name}_under")
            late = high >= below[f"{name}_below"] + F.col(f"{name}_inside") + F.col(f"{name}_at_hi")
            missed |= early | late
            wide |= F.col(f"{name}_inside") > INSIDE_ROWS
        inside = sum(F.col(f"{n}_inside") for n in names)
        state = told.agg(F.count_if(missed).alias("missed"), F.count_if(wide).alias("wide"), F.sum(inside).alias("inside")).first()
        if not state["missed"] and (not state["wide"] or state["inside"] >= last_inside):
            break
        if state["missed"]:
            # A sketch was further off than the reach: those brackets open, and the next ones reach further.
            reach, last_inside = 2 * reach + 1 / GRID, float("inf")
            brackets = store(told.select(*keys, "rows", *[
                F.when(missed, F.lit(float("-inf" if c.endswith("_lo") else "nan"))).otherwise(F.col(c)).alias(c) for c in ends
            ]), "brackets")
        else:
            last_inside = state["inside"]
            current = {c: F.col(c) for n in names for c in (f"{n}_lo", f"{n}_hi", f"{n}_inside", f"{n}_steps")} | below
            read = told.withColumns({f"{n}_steps": _steps(f"{n}_sketch", f"{n}_inside") for n in names})
            brackets = store(read.select(*_narrowed(probabilities, keys, current, reach)), "brackets")
    # What lies strictly inside, and the two ends with their counts: a few rows per bracket.
    inside = long.join(told.select(*keys, *ends), keys).select(
        *keys, "value", F.explode(F.filter(
            F.array(*[F.when((value > F.col(f"{n}_lo")) & (value < F.col(f"{n}_hi")), n) for n in names]),
            lambda x: x.isNotNull())).alias("name"))
    counted = inside.groupBy(*keys, "name", "value").agg(F.count(F.lit(1)).alias("n"))
    edges = told.select(*keys, F.inline(F.array(*[
        F.struct(F.lit(n).alias("name"), F.col(f"{n}_{end}").alias("value"), F.col(f"{n}_at_{end}").alias("n"))
        for n in names for end in ("lo", "hi")]))).filter("n > 0")
    facts = told.select(*keys, F.inline(F.array(*[
        F.struct(F.lit(n).alias("name"), ((F.col("rows") - 1) * F.lit(float(p))).alias("position"), F.col(f"{n}_under").alias("under"))
        for n, p in probabilities.items()])))
    # At most INSIDE_ROWS values and two ends in each window.
    running = W.partitionBy(*keys, "name").orderBy("value").rowsBetween(W.unboundedPreceding, W.currentRow)
    ranked = counted.unionByName(edges).withColumn("upto", F.sum("n").over(running)).join(facts, [*keys, "name"])
    upto = F.col("under") + F.col("upto")

    def value_at(rank: Column) -> Column:
        return F.max(F.when((rank < upto) & (rank >= upto - F.col("n")), value))

    low, high = value_at(F.floor("position")), value_at(F.ceil("position"))
    found = ranked.groupBy(*keys, "name", "position").agg(low.alias("low"), high.alias("high"))
    step = F.col("position") - F.floor("position")
    # Infinite ends are taken as they are: their difference is no number.
    between = F.when(F.col("low") == F.col("high"), F.col("low")).otherwise(
        F.col("low") + step * (F.col("high") - F.col("low")))
    return found.withColumn("quantile", between).groupBy(*keys).agg(
        *[F.max(F.when(F.col("name") == n, F.col("quantile"))).alias(n) for n in names])


def median_exact(df: DataFrame, column: str, approx: bool = False) -> DataFrame:
    """One row, one column ``median``; null when the column holds no value."""
    if approx:
        return df.agg(F.percentile_approx(F.col(column).cast("double"), 0.5).alias("median"))
    return exact_quantiles(df, [column], {"median": 0.5}).agg(F.max("median").alias("median"))


def fill_median(df: DataFrame, column: str, approx: bool = False) -> DataFrame:
    """Replace nulls by the median of all present values, as a scalar subquery."""
    median = median_exact(df, column, approx).select(F.col("median").cast(df.schema[column].dataType))
    return df.withColumn(column, F.coalesce(F.col(column), median.scalar()))


def running_sums(df: DataFrame, value: str, sums: list[str], descending: bool = True) -> DataFrame:
    """Inclusive running sums over distinct values. ``df`` holds one row per value."""
    counts = store(df.select(F.lit(value).alias("metric"), F.col(value).cast("double").alias("value"), *sums), "sums")
    ranged = with_ranges(counts)
    offsets = range_offsets(ranged, (), sums, descending)
    joined = ranged.join(offsets, "part")
    order = F.col("value").desc() if descending else F.col("value").asc()
    inside = W.partitionBy("part").orderBy(order).rowsBetween(W.unboundedPreceding, W.currentRow)
    return joined.select(
        F.col("value").alias(value),
        *sums,
        *[(F.col(f"{s}_before") + F.sum(s).over(inside)).alias(f"{s}_upto") for s in sums],
        *[F.col(f"{s}_total") for s in sums],
    )
