"""Order statistics over several ranges equal those of numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from holdfast.operators import quantiles as Q
from holdfast.operators import stats


@pytest.fixture
def many_ranges(monkeypatch):
    """Several levels of few ranges, and brackets that narrow in several passes."""
    monkeypatch.setattr(Q, "INSIDE_ROWS", 3)
    monkeypatch.setattr(Q, "ROWS_PER_RANGE", 20)
    monkeypatch.setattr(Q, "FAN", 4)


@pytest.fixture(scope="module")
def numbers(spark):
    # A third of all rows share one value, the rest is long-tailed.
    rng = np.random.default_rng(7)
    rows = [("g1", 5.0)] * 400 + [("g1", float(v)) for v in rng.lognormal(2, 2, 500)]
    rows += [("g2", float(v)) for v in rng.normal(0, 1, 299)] + [("g2", None), ("g3", 1.5), ("g4", None)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(5)
    return df, rows


def test_grouped_quantiles(numbers, many_ranges):
    df, rows = numbers
    probabilities = {"p0": 0.0, "p10": 0.1, "p25": 0.25, "p50": 0.5, "p99": 0.99, "p100": 1.0}
    got = {r["g"]: r for r in Q.exact_quantiles(df, ["v"], probabilities, ("g",)).collect()}
    assert set(got) == {"g1", "g2", "g3"}
    for g in got:
        own = [v for k, v in rows if k == g and v is not None]
        for name, p in probabilities.items():
            assert got[g][name] == pytest.approx(np.quantile(own, p), rel=1e-12), (g, name)


def test_the_width_of_brackets_does_not_show(numbers, monkeypatch):
    df, _ = numbers
    found = []
    # The last one: sketches that are too coarse for their reach, so that brackets miss and are opened again.
    for inside, k, reach in ((200_000, 2048, 0.005), (0, 2048, 0.005), (60, 8, 0.0)):
        monkeypatch.setattr(Q, "INSIDE_ROWS", inside)
        monkeypatch.setattr(Q, "SKETCH_K", k)
        monkeypatch.setattr(Q, "REACH", reach)
        found.append(sorted(map(tuple, Q.exact_quantiles(df, ["v"], stats.QUARTILES, ("g",)).collect())))
    assert all(f == found[0] for f in found)


def test_quantiles_of_infinite_values_and_no_numbers(spark):
    values = [float("-inf")] * 2 + [1.0, 2.0, 3.0] + [float("inf")] * 2 + [float("nan")] * 2
    df = spark.createDataFrame([(v,) for v in values], "v double")
    wanted = {f"p{i}": i / 8 for i in (0, 3, 5, 7)}
    row = Q.exact_quantiles(df, ["v"], wanted).first()
    assert [str(row[f"p{i}"]) for i in (0, 3, 5, 7)] == [str(values[i]) for i in (0, 3, 5, 7)]
    assert Q.exact_quantiles(df.filter("v > 5 and v < 6"), ["v"], wanted).collect() == []


def test_selection_shuffles_little_whatever_the_number_of_values(spark, monkeypatch):
    monkeypatch.setattr(Q, "INSIDE_ROWS", 100)
    rows = []
    dealt = Q.store

    def counted(df, name):
        out = dealt(df, name)
        rows.append((name, out.count()))
        return out

    monkeypatch.setattr(Q, "store", counted)
    for n in (2_000, 50_000):
        rows.clear()
        df = spark.range(n).selectExpr("double(hash(id)) v").repartition(3)
        got = Q.exact_quantiles(df, ["v"], stats.QUARTILES)
        values = sorted(r[0] for r in df.collect())
        assert tuple(got.first())[1:] == pytest.approx(np.quantile(values, [0.25, 0.5, 0.75]), rel=1e-12)
        # One row per column in each pass, whatever the number of values; the columns themselves are written, not dealt.
        assert {c for name, c in rows if name != "columns"} == {1} and len(rows) <= 8
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "Exchange SinglePartition" not in plan


def test_whiskers_are_found_where_rows_are_read(spark):
    df = spark.range(5000).selectExpr("string(id % 2) g", "double(hash(id)) v").repartition(3)
    found = stats.box_stats(df, ["v"], ("g",))
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and plan.count("Exchange hashpartitioning") == 1


def test_density_makes_no_rows_of_grid_points(spark):
    df = spark.range(500).selectExpr("if(id % 2 = 0, 'Yes', 'No') churn", "double(id * id) v")
    found = stats.density(df, ["v"])
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    # The only rows made of one are those of the result, above the sum.
    assert plan.count("Generate") == 1 and plan.index("Generate") < plan.index("Aggregate")


def test_ranges_stay_small_and_in_order(spark, many_ranges):
    counts = Q.store(spark.range(2000).selectExpr("'m' metric", "double(id * id) value", "1 n"), "counts")
    ranges = Q.with_ranges(counts).groupBy("part").agg(
        F.count("*").alias("rows"), F.min("value").alias("low"), F.max("value").alias("high")).orderBy("part").collect()
    assert max(r["rows"] for r in ranges) <= 4 * 20 and sum(r["rows"] for r in ranges) == 2000
    assert all(x["high"] < y["low"] for x, y in zip(ranges, ranges[1:]))


def test_running_sums(spark, many_ranges):
    rng = np.random.default_rng(3)
    scores = rng.permutation(500) / 500
    df = spark.createDataFrame([(float(s), int(i % 3)) for i, s in enumerate(scores)], "s double, n bigint")
    got = sorted((r["s"], r["n_upto"], r["n_total"]) for r in Q.running_sums(df, "s", ["n"]).collect())
    order = sorted(((float(s), i % 3) for i, s in enumerate(scores)), reverse=True)
    total, want = 0, []
    for s, n in order:
        total += n
        want.append((s, total))
    assert got == sorted((s, t, total) for s, t in want)


def test_median_fill(spark):
    df = spark.createDataFrame([(1, 10), (2, None), (3, 30), (4, 50)], "k int, v int").select(
        "k", F.col("v").cast("decimal(10,2)").alias("v"))
    got = {r["k"]: float(r["v"]) for r in Q.fill_median(df, "v").collect()}
    assert got == {1: 10.0, 2: 30.0, 3: 30.0, 4: 50.0}
    empty = df.withColumn("v", F.lit(None).cast("decimal(10,2)"))
    assert {r["v"] for r in Q.fill_median(empty, "v").collect()} == {None}


def test_summary_of_large_offsets(spark):
    base = 1e9
    df = spark.createDataFrame([(base + v,) for v in (0.0, 1.0, 2.0, 3.0, 4.0)], "v double")
    row = stats.numeric_summary(df, ["v"], decimals=6).first()
    assert (row["count"], row["mean"], row["std"], row["median"]) == (5, base + 2, 1.581139, base + 2)


def test_histogram_puts_the_maximum_into_the_last_bin(spark):
    df = spark.createDataFrame([(float(v),) for v in range(11)], "v double")
    got = {r["bin"]: r["rows"] for r in stats.histogram(df, ["v"], bins=5).collect()}
    assert got == {0: 2, 1: 2, 2: 2, 3: 2, 4: 3}
    flat = spark.createDataFrame([(2.0,)] * 4, "v double")
    assert [(r["bin"], r["rows"]) for r in stats.histogram(flat, ["v"]).collect()] == [(5, 4)]


def test_histogram_shuffles_counts_only(spark):
    df = spark.range(20_000).selectExpr("double(id) v", "double(id % 7) w").repartition(3)
    found = stats.histogram(df, ["v", "w"])
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString()
    # The scan appears once, and what is dealt by a key is summed before.
    assert plan.split("== Initial Plan ==")[0].count("hashpartitioning(metric") == 1 and "value" not in plan


def test_histogram_without_values(spark):
    df = spark.createDataFrame([(None, 1.0), (None, None)], "v double, w double")
    assert [(r["metric"], r["rows"]) for r in stats.histogram(df, ["v", "w"]).collect()] == [("w", 1)]
    assert stats.histogram(df, ["v"]).collect() == []


def test_box_outliers(spark):
    values = [1.0, 2.0, 3.0, 4.0, 5.0, 100.0]
    df = spark.createDataFrame([("x", v) for v in values], "g string, v double")
    row = stats.box_stats(df, ["v"], ("g",)).first()
    assert (row["q1"], row["q3"], row["whisker_low"], row["whisker_high"], row["outliers"]) == (2.25, 4.75, 1.0, 5.0, 1)


def test_density_integrates_to_one(spark):
    rng = np.random.default_rng(1)
    df = spark.createDataFrame([("Yes" if i % 3 else "No", float(v)) for i, v in enumerate(rng.normal(0, 1, 300))],
                               "churn string, v double")
    rows = stats.density(df, ["v"], cut=6.0).collect()
    for subset in ("all", "Yes", "No"):
        points = sorted((r["x"], r["density"]) for r in rows if r["subset"] == subset)
        xs, ys = zip(*points)
        assert np.trapezoid(ys, xs) == pytest.approx(1.0, abs=1e-3)


def test_correlation_is_pairwise_complete(spark):
    df = spark.createDataFrame([(1.0, 2.0, None), (2.0, 4.0, 1.0), (3.0, 6.0, 0.0), (None, 1.0, 5.0)],
                               "a double, b double, c double")
    got = {(r["x"], r["y"]): r["r"] for r in stats.correlation(df, ["a", "b", "c"]).collect()}
    assert got[("b", "a")] == pytest.approx(1.0)
    assert got[("c", "a")] == pytest.approx(-1.0)
    assert got[("c", "b")] == pytest.approx(np.corrcoef([4, 6, 1], [1, 0, 5])[0, 1])


def test_null_profile_of_an_empty_column(spark):
    df = spark.createDataFrame([(1, None), (2, None)], "a int, b int")
    assert [tuple(r) for r in stats.null_profile(df).collect()] == [("b", 2)]
