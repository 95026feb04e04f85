"""Joins and neighbours with hot keys equal the plain computation."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from holdfast.operators import neighbours, periods
from holdfast.operators.skew import split_heavy_join
from holdfast.session import store


@pytest.mark.parametrize("how", ["inner", "left"])
def test_heavy_keys(spark, how):
    large = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 7 == 0, None)
        .otherwise(F.concat(F.lit("k"), F.col("id") % 2500)).alias("key"), "id"
    )
    lookup = spark.range(2500).filter("id % 2 = 0").select(F.concat(F.lit("k"), "id").alias("key"), "id").union(
        spark.createDataFrame([("hot", 9)], "key string, id bigint")).withColumnRenamed("id", "value")
    got = split_heavy_join(large, lookup, "key", how, heavy_share=0.01)
    want = large.join(lookup, "key", how)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.select(*got.columns).collect()))


def brute_force(rows, k):
    out = set()
    for i, c, x in rows:
        others = sorted((round(float(np.sqrt(((x - y) ** 2).sum())), 9), j) for j, d, y in rows if d == c and j != i)
        out |= {(i, c, rank + 1, j, round(dist, 6)) for rank, (dist, j) in enumerate(others[:k])}
    return out


@pytest.mark.parametrize("block,fan", [(None, 32), (12, 3), (40, 2)])
def test_neighbours_equal_brute_force(spark, monkeypatch, block, fan):
    monkeypatch.setattr(neighbours, "CHUNK_VALUES", 40)
    monkeypatch.setattr(neighbours, "PART_ROWS", 16)
    rng = np.random.default_rng(5)
    centres = rng.normal(0, 8, (4, 3))
    rows = [(i, int(i % 10 == 0), centres[i % 4] + rng.normal(0, 1, 3)) for i in range(60)]
    # A third of all rows are copies of one vector, and one class has a single row.
    rows += [(100 + i, 0, centres[0]) for i in range(30)] + [(999, 7, centres[1])]
    df = spark.createDataFrame([(i, c, [float(v) for v in x]) for i, c, x in rows], "id bigint, c int, x array<double>")
    near = neighbours.nearest_neighbours(df, 4, "id", "c", "x", block, fan)
    assert near.count() == len(rows)
    got = {(r[0], r[1], r[2], r[3], round(r[4], 6)) for r in neighbours.neighbour_table(near, "id", "c").collect()}
    assert got == brute_force(rows, 4)


def test_neighbours_over_three_levels_and_without_a_class(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "PART_ROWS", 50)
    rng = np.random.default_rng(8)
    rows = [(i, "a|b" if i % 4 else "0.|a", rng.normal(0, 1, 2) * 10.0 ** rng.integers(0, 4)) for i in range(400)]
    data = [(i, c, [float(v) for v in x]) for i, c, x in rows] + [(1000, None, [0.0, 0.0])]
    df = spark.createDataFrame(data, "id bigint, c string, x array<double>")
    distinct = store(neighbours.distinct_vectors(df, 3, "id", "c", "x"), "vectors")
    leaves, levels = neighbours.cell_tree(distinct, 3, 20, 4)
    assert len(levels) >= 3 and leaves.groupBy("node").count().agg(F.max("count")).first()[0] <= 20
    near = neighbours.nearest_neighbours(df, 3, "id", "c", "x", 20, 4)
    got = {tuple(r)[:4]: r[4] for r in neighbours.neighbour_table(near, "id", "c").collect()}
    assert near.count() == 400 and got == pytest.approx({r[:4]: r[4] for r in brute_force(rows, 3)}, abs=2e-6)


def test_neighbours_without_clusters_leave_out_cells_beyond_half_planes(spark):
    """Half of the columns are zero or one, as categories are: balls around pivots leave out little there."""
    made = np.random.default_rng(5)
    points = np.hstack([made.normal(size=(3000, 2)), made.integers(0, 2, (3000, 4))]).astype(float)
    df = spark.createDataFrame([(i, 0, p.tolist()) for i, p in enumerate(points)], "id long, c int, x array<double>")
    distinct = store(neighbours.distinct_vectors(df, 5, "id", "c", "x"), "vectors")
    leaves, levels = neighbours.cell_tree(distinct, 5, 100, 16)
    searched = store(neighbours.own_leaves(leaves, 5), "own-leaves")
    visits = neighbours.leaves_in_reach(searched, levels)
    # 71 leaves; by radius alone a row looked into 29.0 of them on the mean, with half-planes into 9.4.
    assert leaves.select("node").distinct().count() > 40 and visits.count() < 15 * 3000
    near = neighbours.nearest_neighbours(df, 5, "id", "c", "x", 100, 16)
    got = {(r[0], r[2]): r[3] for r in neighbours.neighbour_table(near, "id", "c").collect()}
    gaps = np.sqrt(((points[:, None] - points[None]) ** 2).sum(axis=2))
    np.fill_diagonal(gaps, np.inf)
    order = np.argsort(gaps, axis=1, kind="stable")[:, :5]
    assert got == {(i, n + 1): int(order[i, n]) for i in range(3000) for n in range(5)}


def test_neighbours_in_clusters_look_into_few_cells(spark):
    """Rows travel to a few cells, not to all: 90 and more leaves, and no more than two visits a row."""
    rng = np.random.default_rng(9)
    centres = rng.uniform(-100, 100, (40, 8))
    data = [(i, 0, [float(v) for v in centres[i % 40] + rng.normal(0, 0.5, 8)]) for i in range(4000)]
    df = spark.createDataFrame(data, "id bigint, c int, x array<double>")
    distinct = store(neighbours.distinct_vectors(df, 5, "id", "c", "x"), "vectors")
    leaves, levels = neighbours.cell_tree(distinct, 5, 128, 8)
    searched = store(neighbours.own_leaves(leaves, 5), "own-leaves")
    visits = neighbours.leaves_in_reach(searched, levels)
    cells = leaves.select("node").distinct().count()
    assert cells >= 40 and visits.count() <= 2 * 4000, (cells, visits.count())


def test_event_ids_are_dense_and_ordered_within_hot_customers(spark):
    cdr = spark.range(600).select(
        F.col("id").alias("event_id"),
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 == 1, None).otherwise(
            F.concat(F.lit("c"), F.col("id") % 40)).alias("customer_id"),
        F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, cast(id * 7919 % 6000 as int))")
        .alias("event_date"),
    )
    rows = periods.event_ids(cdr).collect()
    assert sorted(r["event_id"] for r in rows) == list(range(1, 601))
    hot = [r for r in sorted(rows, key=lambda r: r["event_id"]) if r["customer_id"] == "hot"]
    assert [r["event_date"] for r in hot] == sorted(r["event_date"] for r in hot)
    ids = [r["event_id"] for r in hot]
    assert ids == list(range(ids[0], ids[0] + len(ids)))


def test_event_ids_split_one_customer_of_one_instant(spark, monkeypatch):
    written = []
    monkeypatch.setattr(periods, "store", lambda df, name: written.append(store(df, name)) or written[-1])
    cdr = spark.range(1000).selectExpr(
        "if(id % 10 = 0, null, id % 300) event_id", "if(id < 900, 'hot', null) customer_id",
        "if(id % 2 = 0, timestamp_ntz'2024-01-01 00:00:00', null) event_date")
    rows = periods.event_ids(cdr, rows_per_part=100)
    got = sorted(tuple(r) for r in rows.select("event_id", "customer_id", "event_date", "source_event_id").collect())
    assert [g[0] for g in got] == list(range(1, 1001))
    order = [(g[2] is not None, g[3] is not None, g[3] or 0) for g in got if g[1] == "hot"]
    assert order == sorted(order) and len(order) == 900
    sizes = [r["count"] for r in written[0].groupBy(F.shiftright("_at", 33)).count().collect()]
    # Ten ranges, none with more than a few times its share, whatever the customer and time.
    assert max(sizes) <= 300
