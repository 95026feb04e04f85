"""Evaluation of (label, score) columns."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast.operators.quantiles import running_sums
from holdfast.session import small_table

OUTCOMES = {0: "Retained", 1: "Churned"}


def _by_score(df: DataFrame, label: str, score: str) -> DataFrame:
    """One row per distinct score with the numbers of positive and negative rows."""
    rated = df.filter(F.col(label).isNotNull() & F.col(score).isNotNull())
    return rated.groupBy(F.col(score).cast("double").alias("score")).agg(
        F.count_if(F.col(label) == 1).alias("positives"), F.count_if(F.col(label) != 1).alias("negatives")
    )


def _cumulative(df: DataFrame, label: str, score: str) -> DataFrame:
    return running_sums(_by_score(df, label, score), "score", ["positives", "negatives"], descending=True)


def roc_auc(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """Share of (positive, negative) pairs ranked correctly, ties counting half. Null when a class is absent."""
    c = _cumulative(df, label, score)
    below = F.col("negatives_total") - F.col("negatives_upto")
    won = F.sum(F.col("positives").cast("double") * (below + 0.5 * F.col("negatives")))
    pairs = F.max(F.col("positives_total").cast("double") * F.col("negatives_total"))
    return c.agg(F.try_divide(won, pairs).alias("roc_auc"))


def roc_curve(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """False and true positive rate at each distinct score as threshold; the origin has an infinite threshold."""
    c = _cumulative(df, label, score)
    points = c.select(
        F.col("score").alias("threshold"),
        F.try_divide(F.col("negatives_upto").cast("double"), F.col("negatives_total").cast("double")).alias("fpr"),
        F.try_divide(F.col("positives_upto").cast("double"), F.col("positives_total").cast("double")).alias("tpr"),
    )
    start = {"threshold": [float("inf")], "fpr": [0.0], "tpr": [0.0]}
    origin = small_table(df.sparkSession, start, "threshold double, fpr double, tpr double")
    return origin.unionByName(points)


def confusion_matrix(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """The four counts, zeros included."""
    cells = {(t, p): F.count_if((F.col(label) == t) & (F.col(prediction) == p)) for t in OUTCOMES for p in OUTCOMES}
    wide = df.agg(*[n.alias(f"{t}{p}") for (t, p), n in cells.items()])
    long = wide.unpivot([], wide.columns, "cell", "rows")
    return long.select(
        F.substring("cell", 1, 1).cast("int").alias("label"), F.substring("cell", 2, 1).cast("int").alias("prediction"),
        "rows",
    )


def classification_report(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """precision, recall, f1 and support per class, their macro and weighted averages, and accuracy."""
    right = {c: F.count_if((F.col(label) == c) & (F.col(prediction) == c)) for c in OUTCOMES}
    counts = df.agg(
        F.count(F.lit(1)).alias("all_rows"),
        *[right[c].alias(f"right_{c}") for c in OUTCOMES],
        *[F.count_if(F.col(label) == c).alias(f"true_{c}") for c in OUTCOMES],
        *[F.count_if(F.col(prediction) == c).alias(f"said_{c}") for c in OUTCOMES],
    )

    def ratio(a, b):
        return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))

    figures = {}
    for c in OUTCOMES:
        figures[f"p{c}"] = ratio(F.col(f"right_{c}"), F.col(f"said_{c}"))
        figures[f"r{c}"] = ratio(F.col(f"right_{c}"), F.col(f"true_{c}"))
        # Harmonic mean of precision and recall in terms of counts.
        figures[f"f{c}"] = ratio(F.col(f"right_{c}") * 2, F.col(f"said_{c}") + F.col(f"true_{c}"))
    one = counts.withColumns(figures)
    support = F.col("true_0") + F.col("true_1")

    def row(name, parts, rows):
        return F.struct(
            F.lit(name).alias("row_name"), parts[0].alias("precision"), parts[1].alias("recall"), parts[2].alias("f1"),
            rows.alias("support"),
        )

    def weighted(kind):
        return ratio(F.col(f"{kind}0") * F.col("true_0") + F.col(f"{kind}1") * F.col("true_1"), support)

    accuracy = ratio(F.col("right_0") + F.col("right_1"), F.col("all_rows"))
    rows = [row(name, [F.col(f"{k}{c}") for k in "prf"], F.col(f"true_{c}")) for c, name in OUTCOMES.items()]
    rows.append(row("accuracy", [accuracy] * 3, F.col("all_rows")))
    rows.append(row("macro avg", [(F.col(f"{k}0") + F.col(f"{k}1")) / 2 for k in "prf"], support))
    rows.append(row("weighted avg", [weighted(k) for k in "prf"], support))
    return one.select(F.inline(F.array(*rows)))


def model_compare(runs: DataFrame, challenger: str = "boosted_trees") -> DataFrame:
    """Runs by area under the curve; the challenger wins a tie."""
    first = F.when(F.col("run_name") == challenger, 0).otherwise(1)
    ordered = runs.select("run_name", "roc_auc", first.alias("_tie"))
    best = ordered.agg(F.max_by("run_name", F.struct(F.col("roc_auc"), -F.col("_tie"))).alias("best")).scalar()
    return ordered.select("run_name", "roc_auc", (F.col("run_name") == best).alias("best"))
