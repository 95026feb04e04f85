"""Attributions of a score to its features."""

from functools import reduce

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast.plans import tree_effects
from holdfast.plans.features import SEED
from holdfast.session import store, wide_parallelism

#: Share of the mean effect that a customer's standard errors may have, and rounds that a customer gets at most.
TARGET_ERROR, MOST_ROUNDS = 0.02, 64


def feature_means(train: DataFrame, names: list[str]) -> list[float]:
    """Mean of each feature over the training rows: one bounded row."""
    x = vector_to_array("features")
    row = train.agg(*[F.avg(F.get(x, F.lit(i))).alias(f"m{i}") for i in range(len(names))]).first()
    return list(row)


def _long(df: DataFrame, phi: Column, names: list[str]) -> DataFrame:
    exploded = df.select("customer_id", F.posexplode(phi).alias("idx", "phi"))
    labels = F.array(*[F.lit(n) for n in names])
    return exploded.select("customer_id", F.get(labels, F.col("idx")).alias("feature"), "phi")


def linear_attribution(
    df: DataFrame, coefficients: list[float], means: list[float], names: list[str], vector: bool = True
) -> DataFrame:
    """Coefficient times distance from the training mean, per customer and feature (long form)."""
    x = vector_to_array("features") if vector else F.col("features")
    pairs = F.arrays_zip(
        x.alias("x"), F.lit([float(b) for b in coefficients]).alias("b"), F.lit([float(m) for m in means]).alias("m")
    )
    return _long(df, F.transform(pairs, lambda p: p["b"] * (p["x"] - p["m"])), names)


def background_rows(train: DataFrame, rows: int = 4, seed: int = SEED) -> list[list[float]]:
    """A fixed number of reference points, chosen by hash."""
    chosen = train.orderBy(F.md5(F.concat("customer_id", F.lit(f"|{seed}|background")))).limit(rows)
    return [list(r["x"]) for r in chosen.select(vector_to_array("features").alias("x")).collect()]


def pair_effects(
    model, customers: DataFrame, background: list[list[float]], width: int, first: int, pairs: int, seed: int = SEED
) -> DataFrame:
    """(customer_id, idx, base, phi): the effect of each feature in each of the given pairs of permutations.

    A pair is a permutation and its reverse, whose errors partly cancel, against one background row, ``base``; the rows take
    turns. The features are switched one after the other from the background row to the customer's own values; each change
    of the margin belongs to the feature switched. All hybrid points are scored by one ``transform``, and differences between
    consecutive steps telescope, so that the effects of a pair sum to the customer's margin minus the background row's.
    """
    drawn = customers.select(
        "customer_id", "x", F.explode(F.sequence(F.lit(2 * first), F.lit(2 * (first + pairs) - 1))).alias("draw"))
    pair = F.floor(F.col("draw") / 2)
    drawn = drawn.withColumn("at", (pair % len(background)).cast("int")).withColumn("base", F.get(F.lit(background), F.col("at")))
    # Rank of each feature in this draw: by hash of (customer, pair, feature), every second time backwards.
    ticket = F.transform(
        F.sequence(F.lit(0), F.lit(width - 1)),
        lambda i: F.struct(F.xxhash64("customer_id", pair, i, F.lit(seed)).alias("h"), i.alias("i")),
    )
    forward = F.transform(F.array_sort(ticket), lambda t: t["i"])
    order = F.when(F.col("draw") % 2 == 0, forward).otherwise(F.reverse(forward))
    ranked = drawn.withColumn("order", order).withColumn("rank", F.transform(
        F.sequence(F.lit(0), F.lit(width - 1)), lambda i: F.array_position("order", i).cast("int")))
    steps = ranked.select("*", F.explode(F.sequence(F.lit(0), F.lit(width))).alias("step"))
    mixed = F.transform(
        F.arrays_zip("x", "base", "rank"),
        lambda z: F.when(z["rank"] <= F.col("step"), z["x"]).otherwise(z["base"]),
    )
    hybrids = steps.select(
        "customer_id", "draw", "at", array_to_vector(mixed).alias("features"),
        F.get("order", F.col("step") - 1).alias("entered"), F.get("order", F.col("step")).alias("entering"),
    )
    scored = model.transform(hybrids).withColumn("margin", margin(model))
    # Step s adds its margin to the feature that entered at s and takes it from the feature that enters at s + 1.
    signed = scored.select("customer_id", "at", pair.alias("pair"), F.explode(F.array(
        F.struct(F.col("entered").alias("idx"), F.col("margin").alias("part")),
        F.struct(F.col("entering").alias("idx"), (-F.col("margin")).alias("part")),
    )).alias("s")).select("customer_id", "at", "pair", "s.idx", "s.part").filter(F.col("idx").isNotNull())
    return signed.groupBy("customer_id", "idx", "at", "pair").agg((F.sum("part") / 2).alias("phi")).select(
        "customer_id", "idx", F.col("at").alias("base"), "phi")


def _pair_sums(
    model, customers: DataFrame, background: list[list[float]], width: int, first: int, pairs: int, seed: int
) -> DataFrame:
    """(customer_id, s, ss): sums over the given pairs of the effects and of their squares, as lists by base and feature."""
    if not type(model).__name__.startswith("GBT"):
        effects = pair_effects(model, customers, background, width, first, pairs, seed).groupBy("customer_id", "base", "idx").agg(
            F.sum("phi").alias("s"), F.sum(F.col("phi") ** 2).alias("ss"))
        own = effects.groupBy("customer_id").agg(F.array_sort(F.collect_list(F.struct("base", "idx", "s", "ss"))).alias("own"))
        return own.select("customer_id", "own.s", "own.ss")
    # The same orders as in `pair_effects`.
    order = F.transform(F.sequence(F.lit(first).cast("bigint"), F.lit(first + pairs - 1).cast("bigint")), lambda pair: F.transform(
        F.array_sort(F.transform(F.sequence(F.lit(0), F.lit(width - 1)), lambda i: F.struct(
            F.xxhash64("customer_id", pair, i, F.lit(seed)).alias("h"), i.alias("i")))),
        lambda t: t["i"]))
    work = tree_effects.summed_effects(tree_effects.parsed_trees(model.toDebugString, 2.0), background)
    kind = dict(customers.dtypes)["customer_id"]
    return customers.sortWithinPartitions("customer_id").select("customer_id", "x", order.alias("orders")).mapInArrow(
        work, f"customer_id {kind}, s array<double>, ss array<double>")


def _with_errors(sums: DataFrame, bases: int, width: int) -> DataFrame:
    """Adds the attributions phi and their standard errors as lists, and the customer's error and effect."""

    def over_bases(values: Column) -> Column:
        return reduce(lambda a, b: F.zip_with(a, b, lambda x, y: x + y), [F.slice(values, at * width + 1, width) for at in range(bases)])

    n = F.col("n")
    variance = F.zip_with("s", "ss", lambda s, ss: F.greatest(ss - s**2 / n, F.lit(0.0)) / F.greatest(n - 1, F.lit(1)) / n)
    return sums.withColumns({
        "phi": F.transform(over_bases(F.transform("s", lambda s: s / n)), lambda v: v / bases),
        "errors": F.transform(over_bases(variance), lambda v: F.sqrt(v) / bases),
    }).withColumns({
        "error": F.sqrt(F.aggregate("errors", F.lit(0.0), lambda a, e: a + e**2) / width),
        "effect": F.aggregate("phi", F.lit(0.0), lambda a, p: a + F.abs(p)),
    })


def _latest(parts: list[DataFrame], *columns: str) -> DataFrame:
    """The columns of each customer from the last of the parts that has it."""
    chosen = [p.select("customer_id", F.lit(i).alias("part"), F.struct(*columns).alias("own")) for i, p in enumerate(parts)]
    return reduce(DataFrame.unionByName, chosen).groupBy("customer_id").agg(F.max_by("own", "part").alias("own")).select(
        "customer_id", "own.*")


def sampled_shapley(
    model, rows: DataFrame, background: list[list[float]], names: list[str], target: float = TARGET_ERROR,
    most_rounds: int = MOST_ROUNDS, seed: int = SEED,
) -> DataFrame:
    """(customer_id, feature, phi, error) in log-odds, for every row given, by sequential sampling.

    A round is one pair of permutations against each background row, so the attributions of a customer always sum to its
    margin minus the mean margin of the background rows. ``error`` is the standard error of phi: the pairs of one background
    row differ by chance only, and their spread is taken for each background row alone. After two rounds, a customer is
    finished once the root mean square of its errors is at most ``target`` times the mean effect, the mean over customers of
    the sum of absolute attributions; the others get as many rounds again as they had, up to ``most_rounds`` in all. What is above
    the target then shows in ``error``. Sums are kept as one row of lists per customer, and a round stores those it works on only.
    """
    width, bases, spread = len(names), len(background), wide_parallelism(rows.sparkSession)
    # A row's work is out of proportion to its bytes, so the rows are spread over all cores first, whatever the size of
    # the files they come from. Rows of a customer meet in one task.
    waiting = everyone = rows.select("customer_id", vector_to_array("features").alias("x"))
    parts, rounds, wanted = [], 0, 2
    while True:
        fresh = _pair_sums(
            model, waiting.repartition(spread, "customer_id"), background, width, rounds * bases, (wanted - rounds) * bases, seed
        ).withColumn("n", F.lit(wanted - rounds).cast("bigint"))
        if parts:
            earlier = _latest([p.join(late, "customer_id", "left_semi") for p in parts], "n", "s", "ss").toDF("customer_id", "n0", "s0", "ss0")
            add = {c: F.zip_with(c, f"{c}0", lambda x, y: x + y) for c in ("s", "ss")} | {"n": F.col("n") + F.col("n0")}
            # Spark takes a list to have one value, so it would broadcast more than it knows.
            fresh = fresh.join(earlier.hint("merge"), "customer_id").withColumns(add).drop("n0", "s0", "ss0")
        parts.append(store(_with_errors(fresh, bases, width), "pair-sums"))
        rounds = wanted
        if rounds >= most_rounds:
            break
        each = store(_latest(parts, "error", "effect"), "errors")
        scale = each.agg(F.avg("effect")).first()[0] or 0.0
        # A sum of squares that only rounding tells from a square is no error.
        late = each.filter(F.col("error") > target * scale + 1e-7).select("customer_id")
        if late.isEmpty():
            break
        waiting = everyone.join(late, "customer_id", "left_semi")
        wanted = min(2 * rounds, most_rounds)
    labels = F.array(*[F.lit(n) for n in names])
    found = _latest(parts, "phi", "errors").select("customer_id", F.posexplode(F.arrays_zip("phi", "errors")).alias("idx", "own"))
    return found.select("customer_id", F.get(labels, F.col("idx")).alias("feature"), "own.phi", F.col("own.errors").alias("error"))


def margin(model) -> Column:
    """Log-odds of churn. Boosted trees report half of it as raw prediction."""
    factor = 2.0 if type(model).__name__.startswith("GBT") else 1.0
    return factor * F.get(vector_to_array("rawPrediction"), F.lit(1))


def base_value(model, spark, background: list[list[float]]) -> float:
    """Mean margin of the background rows."""
    points = spark.createDataFrame([(b,) for b in background], "x array<double>").select(array_to_vector("x").alias("features"))
    return model.transform(points).agg(F.avg(margin(model))).first()[0]


def global_importance(attributions: DataFrame) -> DataFrame:
    return attributions.groupBy("feature").agg(F.avg(F.abs("phi")).alias("importance"))


def top_features(attributions: DataFrame, n: int = 15) -> DataFrame:
    return global_importance(attributions).orderBy(F.desc("importance"), "feature").limit(n)


def explain_customer(attributions: DataFrame, riskiest: DataFrame, base: float) -> DataFrame:
    """Attributions of the one customer in ``riskiest``, strongest first, with the base value."""
    # One row.
    own = attributions.join(F.broadcast(riskiest.select("customer_id", "churn_probability")), "customer_id")
    return own.withColumn("base_value", F.lit(base)).orderBy(F.desc(F.abs("phi")), "feature")
