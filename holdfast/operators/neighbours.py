"""Exact k nearest neighbours within a class, without forming all pairs.

1. Equal vectors are reduced to one row that keeps its ``k + 1`` smallest ids - enough to answer for every copy.
2. Each class is the root of a tree of cells. A cell with more rows than a block is split around a few of its own vectors
   (pivots): each row goes to the nearest one. Cells are split until each fits a block, whatever the size of the data. A row
   carries one distance only, that to the pivot of its cell, and the best bound its path gave for its k-th neighbour.
3. Each leaf is searched on its own first, which makes the bound of its rows a real distance. Then rows descend from the
   root: by the triangle inequality a cell can hold a nearer vector only if the distance to its pivot, less its radius, is
   within the bound, and as its rows are nearer to its pivot than to any sibling's, only if the planes half way to these are
   within the bound. A row is handed on to those children only, and at the end to the leaves it has to look into.
4. Rows of a cell are dealt to parts of limited size, each with a copy of the cell's pivots or members, so no task depends on
   the size of a cell or on how many rows look into it. Only the best ``k + 1`` of a part come back.

The bounds only ever discard cells that cannot contribute, so the answer is that of the full comparison.
"""

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from holdfast.operators.skew import split_heavy_join
from holdfast.session import store, wide_parallelism

SALTS = 256
#: Rows of a leaf, values of a leaf, and distances that are computed at once.
BLOCK_ROWS = 8192
BLOCK_VALUES = 2**21
CHUNK_VALUES = 2**22
#: Children of a cell at most, rows drawn for each of its pivots, and rows that descend together.
FAN = 32
DRAWN = 8
PART_ROWS = 4096
SLACK = 1e-9


def _rows(df: DataFrame, id_col: str, class_col: str, vector_col: str) -> DataFrame:
    return df.select(
        F.col(id_col).alias("id"),
        F.col(class_col).alias("cls"),
        F.transform(F.col(vector_col), lambda x: x.cast("double")).alias("vec"),
    )


def distinct_vectors(df: DataFrame, k: int, id_col: str, class_col: str, vector_col: str) -> DataFrame:
    """One row per (class, vector) with its smallest ids; copies are thinned in salted groups before they meet."""
    salted = _rows(df, id_col, class_col, vector_col).withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)))
    first = F.row_number().over(W.partitionBy("cls", "vec", "salt").orderBy("id"))
    thinned = salted.withColumn("rn", first).filter(F.col("rn") <= k + 1)
    second = F.row_number().over(W.partitionBy("cls", "vec").orderBy("id"))
    kept = thinned.withColumn("rn", second).filter(F.col("rn") <= k + 1)
    groups = kept.groupBy("cls", "vec").agg(F.array_sort(F.collect_list("id")).alias("ids"))
    return groups.select("cls", "vec", "ids", F.get("ids", F.lit(0)).alias("rep"))


def _wider(bound: Column) -> Column:
    return bound * (1 + SLACK) + SLACK


def _root() -> Column:
    """Node of a class. Children put their number and a point before the name of their parent."""
    return F.concat(F.lit("|"), F.col("cls").cast("string"))


def _parts(size: str, rows: int) -> Column:
    return F.greatest(F.lit(1), F.ceil(F.col(size) / rows)).cast("int")


def _own_part(cuts: str) -> Column:
    return F.pmod(F.xxhash64("vec", F.lit("part")), F.col(cuts)).cast("int").alias("part")


def _every_part(cuts: str) -> Column:
    return F.explode(F.sequence(F.lit(0), F.col(cuts) - 1)).alias("part")


def _pivots(inner: DataFrame, fan: int, block_rows: int, level: int) -> DataFrame:
    """(node, place, pivot, cuts): a few vectors of each cell, chosen by hash; they steer the search, not its result.

    Only some DRAWN rows per pivot are ranked, whatever the size of the cell.
    """
    draw = F.pmod(F.xxhash64("vec", F.lit(level)), F.lit(1 << 30))
    wanted = F.least(F.lit(fan), F.greatest(F.lit(2), 2 * F.ceil(F.col("rows") / block_rows)))
    drawn = inner.withColumn("draw", draw).filter(F.col("draw").cast("double") * F.col("rows") <= float(DRAWN * fan << 30))
    place = F.row_number().over(W.partitionBy("node").orderBy("draw", "rep"))
    return drawn.withColumn("place", place).filter(F.col("place") <= wanted).select(
        "node", "place", F.col("vec").alias("pivot"), _parts("rows", block_rows).alias("cuts"))


def _distances(x: np.ndarray, points: np.ndarray) -> np.ndarray:
    out = np.empty((len(x), len(points)))
    for j, p in enumerate(points):
        out[:, j] = np.sqrt(((x - p) ** 2).sum(axis=1))
    return out


def _to_nearest(rows: pd.DataFrame, pivots: pd.DataFrame) -> pd.DataFrame:
    """Rows of a cell with the child they go to and their distance to its pivot."""
    if rows.empty:
        return rows[["cls", "node", "vec", "ids", "rep", "gap", "bound"]]
    gaps = _distances(np.stack(rows["vec"].to_numpy()), np.stack(pivots["pivot"].to_numpy()))
    nearest = gaps.argmin(axis=1)
    places = pivots["place"].to_numpy()[nearest]
    return rows.assign(
        node=[f"{place}.{node}" for place, node in zip(places, rows["node"])], gap=gaps[np.arange(len(rows)), nearest],
    )[["cls", "node", "vec", "ids", "rep", "gap", "bound"]]


def cell_tree(distinct: DataFrame, k: int, block_rows: int, fan: int = FAN) -> tuple[DataFrame, list[DataFrame]]:
    """The rows with their leaf (``node``) and bound, and for each level the children (parent, child, pivot, radius, leaf).

    ``distinct`` holds each vector of a class once, so every split makes smaller cells.
    """
    kinds = dict(distinct.dtypes)
    schema = (f"cls {kinds['cls']}, node string, vec array<double>, ids {kinds['ids']}, rep {kinds['rep']}, gap double, "
              "bound double")
    far = F.lit(float("inf"))
    rows = distinct.filter(F.col("cls").isNotNull()).select(
        "cls", _root().alias("node"), "vec", "ids", "rep", far.alias("gap"), far.alias("bound"))
    leaves, levels, pivots = None, [], None
    while True:
        cells = store(rows.groupBy("node").agg(
            F.count(F.lit(1)).alias("rows"), F.sum(F.size("ids")).alias("members"), F.max("gap").alias("radius")), "cells")
        if pivots is not None:
            named = pivots.select(
                F.col("node").alias("parent"), F.concat(F.col("place").cast("string"), F.lit("."), "node").alias("child"), "pivot")
            levels.append(store(named.join(cells, named["child"] == cells["node"]).select(
                "parent", "child", "pivot", "radius", (F.col("rows") <= block_rows).alias("leaf")), "children"))
        # A row per cell; Spark broadcasts the stored table where it is small.
        reach = F.when(F.col("members") > k, F.least("bound", _wider(F.col("gap") + F.col("radius")))).otherwise(F.col("bound"))
        known = rows.join(cells, "node").withColumn("bound", reach)
        done = known.filter(F.col("rows") <= block_rows).select(*distinct.columns, "node", "bound")
        leaves = done if leaves is None else leaves.unionByName(done)
        if cells.filter(F.col("rows") > block_rows).isEmpty():
            return leaves, levels
        inner = known.filter(F.col("rows") > block_rows)
        pivots = store(_pivots(inner, fan, block_rows, len(levels)), "pivots")
        dealt = inner.withColumn("cuts", _parts("rows", block_rows)).select(*rows.columns, _own_part("cuts"))
        copies = pivots.select("node", "place", "pivot", _every_part("cuts"))
        rows = store(dealt.groupBy("node", "part").cogroup(copies.groupBy("node", "part")).applyInPandas(
            _to_nearest, schema), "cell-rows")


def _best(asking: pd.DataFrame, held: pd.DataFrame, k: int, bounds: np.ndarray | None = None) -> pd.DataFrame:
    """(row, dist, id): for each asking row the k + 1 nearest of the held vectors' ids, nearest first; with bounds, as far as
    a row's bound lets them count."""
    q, m = np.stack(asking["vec"].to_numpy()), np.stack(held["vec"].to_numpy())
    ids, lowest = held["ids"].to_numpy(), held["rep"].to_numpy()
    copies = np.array([len(i) for i in ids])
    length, largest = (m**2).sum(axis=1), (q**2).sum(axis=1).max()
    # One vector more than k, because the row itself may be among them.
    take = min(k + 1, len(m))
    parts = []
    step = max(1, CHUNK_VALUES // len(m))
    for at in range(0, len(q), step):
        part = q[at : at + step]
        # Fast squared distances (less a constant per row) pick the candidates with room for rounding, exact ones
        # rank them.
        rough = length[None, :] - 2.0 * (part @ m.T)
        room = 1e-9 * (1.0 + largest + length.max())
        if bounds is None:
            limit = np.partition(rough, take - 1, axis=1)[:, take - 1] + room
        else:
            limit = bounds[at : at + step] ** 2 - (part**2).sum(axis=1) + room
            many = np.flatnonzero((rough <= limit[:, None]).sum(axis=1) > take)
            limit[many] = np.minimum(limit[many], np.partition(rough[many], take - 1, axis=1)[:, take - 1] + room)
        rows, cols = np.nonzero(rough <= limit[:, None])
        exact = np.sqrt(((part[rows] - m[cols]) ** 2).sum(axis=1))
        order = np.lexsort((lowest[cols], exact, rows))
        rows, cols, exact = rows[order], cols[order], exact[order]
        kept = np.arange(len(rows)) - np.searchsorted(rows, rows) < take
        if bounds is not None:
            kept &= exact <= bounds[at + rows]
        rows, cols, exact = rows[kept], cols[kept], exact[kept]
        if not len(rows):
            continue
        frame = pd.DataFrame({
            "row": np.repeat(at + rows, copies[cols]), "dist": np.repeat(exact, copies[cols]),
            "id": np.concatenate([ids[c] for c in cols]),
        })
        if copies[cols].max() > 1:
            frame = frame.sort_values(["row", "dist", "id"]).groupby("row").head(k + 1)
        parts.append(frame)
    return pd.concat(parts) if parts else pd.DataFrame({"row": np.zeros(0, dtype=int), "dist": np.zeros(0), "id": ids[:0]})


def own_leaves(leaves: DataFrame, k: int) -> DataFrame:
    """(cls, node, vec, rep, bound, dists, near) per row: what its own leaf holds; the bound is the k-th distance found
    there if there are so many."""
    kinds = dict(leaves.dtypes)

    def search(pdf: pd.DataFrame) -> pd.DataFrame:
        found = _best(pdf, pdf, k)
        first = np.searchsorted(found["row"].to_numpy(), np.arange(len(pdf) + 1))
        dists, near = found["dist"].to_numpy(), found["id"].to_numpy()
        spans = list(zip(first[:-1], first[1:]))
        reached = np.array([dists[b - 1] if b - a > k else np.inf for a, b in spans])
        return pdf.assign(
            bound=np.minimum(pdf["bound"].to_numpy(), reached * (1 + SLACK) + SLACK),
            dists=[dists[a:b] for a, b in spans], near=[near[a:b] for a, b in spans],
        )[["cls", "node", "vec", "rep", "bound", "dists", "near"]]

    dealt = leaves.repartition(wide_parallelism(leaves.sparkSession), "node").groupBy("node")
    return dealt.applyInPandas(search, f"cls {kinds['cls']}, node string, vec array<double>, rep {kinds['rep']}, bound double, "
                               f"dists array<double>, near {kinds['ids']}")


def _children_in_reach(rows: pd.DataFrame, children: pd.DataFrame) -> pd.DataFrame:
    columns = ["rep", "vec", "bound", "home", "node", "leaf"]
    if rows.empty:
        return pd.DataFrame({c: [] for c in columns})
    pivots, bound = np.stack(children["pivot"].to_numpy()), rows["bound"].to_numpy()
    gaps = _distances(np.stack(rows["vec"].to_numpy()), pivots)
    reach = gaps - children["radius"].to_numpy()[None, :] <= bound[:, None]
    # Without an end, a bound times nothing would be no number.
    squares, apart = gaps**2, np.maximum(_distances(pivots, pivots), np.finfo(float).tiny)
    for j in range(len(pivots)):
        # Distances from the planes half way between pivot j and the others, times twice the distance of these.
        past = squares - squares[:, j, None]
        reach &= past <= 2 * bound[:, None] * apart[None, j] + SLACK * (squares + squares[:, j, None])
    at, to = np.nonzero(reach)
    out = rows.iloc[at].assign(node=children["child"].to_numpy()[to], leaf=children["leaf"].to_numpy()[to])
    return out[out["node"] != out["home"]][columns]


def leaves_in_reach(searched: DataFrame, levels: list[DataFrame]) -> DataFrame | None:
    """(rep, vec, bound, node): the leaves besides its own that each row has to look into."""
    kind = dict(searched.dtypes)["rep"]
    schema = f"rep {kind}, vec array<double>, bound double, home string, node string, leaf boolean"
    frontier = searched.select("rep", "vec", "bound", F.col("node").alias("home"), _root().alias("node")).filter("home <> node")
    visits = None
    for children in levels:
        cuts = store(frontier.groupBy("node").agg(_parts_of_rows(PART_ROWS)), "frontier-sizes")
        dealt = frontier.join(cuts, "node").select("rep", "vec", "bound", "home", "node", _own_part("cuts"))
        copies = children.join(cuts, children["parent"] == cuts["node"]).select(
            "node", "child", "pivot", "radius", "leaf", _every_part("cuts"))
        reached = store(dealt.groupBy("node", "part").cogroup(copies.groupBy("node", "part")).applyInPandas(
            _children_in_reach, schema), "frontier")
        some = reached.filter("leaf").select("rep", "vec", "bound", "node")
        visits = some if visits is None else visits.unionByName(some)
        frontier = reached.filter("not leaf").select("rep", "vec", "bound", "home", "node")
    return visits


def _parts_of_rows(rows: int) -> Column:
    return F.greatest(F.lit(1), F.ceil(F.count(F.lit(1)) / rows)).cast("int").alias("cuts")


def _visited(leaves: DataFrame, visits: DataFrame, k: int, block_rows: int) -> DataFrame:
    """(rep, dist, id): the best of each leaf that a row looks into, as far as its bound lets them count."""
    kind = dict(leaves.dtypes)["rep"]

    def search(asking: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        if asking.empty:
            return pd.DataFrame({"rep": [], "dist": [], "id": []})
        found = _best(asking, held, k, asking["bound"].to_numpy())
        return found.assign(rep=asking["rep"].to_numpy()[found["row"].to_numpy()])[["rep", "dist", "id"]]

    cuts = store(visits.groupBy("node").agg(_parts_of_rows(block_rows)), "visits-of-leaves")
    tasks = wide_parallelism(leaves.sparkSession)
    asking = visits.join(cuts, "node").select("node", "rep", "vec", "bound", _own_part("cuts")).repartition(tasks, "node", "part")
    held = leaves.join(cuts, "node").select("node", "rep", "vec", "ids", _every_part("cuts")).repartition(tasks, "node", "part")
    return asking.groupBy("node", "part").cogroup(held.groupBy("node", "part")).applyInPandas(
        search, f"rep {kind}, dist double, id {kind}")


def nearest_neighbours(
    df: DataFrame,
    k: int = 5,
    id_col: str = "customer_id",
    class_col: str = "label",
    vector_col: str = "features",
    block_rows: int | None = None,
    fan: int = FAN,
) -> DataFrame:
    """(id, class, vec, neighbours): the k nearest other rows of the same class, nearest first, ties by id.

    ``neighbours`` is an array of (dist, id). The rows of a leaf follow the width of the vectors unless given; rows without
    a class have no neighbours and are left out.
    """
    distinct = store(distinct_vectors(df, k, id_col, class_col, vector_col), "vectors")
    facts = distinct.agg(F.max(F.size("ids")).alias("copies"), F.max(F.size("vec")).alias("width")).first()
    if block_rows is None:
        block_rows = max(1024, min(BLOCK_ROWS, BLOCK_VALUES // (facts["width"] or 1)))
    leaves, levels = cell_tree(distinct, k, block_rows, fan)
    searched = own_leaves(leaves, k)
    own = F.arrays_zip(F.col("dists").alias("dist"), F.col("near").alias("id"))
    if levels:
        searched = store(searched, "own-leaves")
        visits = store(leaves_in_reach(searched, levels), "visits")
        partial = searched.select("rep", F.inline(own)).unionByName(_visited(leaves, visits, k, block_rows))
        # k others and one entry for the row itself. The rank filter is applied before the shuffle as well.
        nearest = F.row_number().over(W.partitionBy("rep").orderBy("dist", "id"))
        best = partial.withColumn("nearest", nearest).filter(F.col("nearest") <= k + 1)
        shortlist = best.groupBy("rep").agg(F.array_sort(F.collect_list(F.struct("dist", "id"))).alias("found"))
    else:
        shortlist = searched.select("rep", own.alias("found"))

    known = distinct.join(shortlist, "rep")
    answered = known.select(F.explode("ids").alias("id"), "cls", "vec", "found")
    if facts["copies"] is not None and facts["copies"] > k:
        # Vectors with more than k copies: their further copies get the same list, hot vectors by broadcast.
        crowded = known.filter(F.size("ids") > k).select(F.struct("cls", "vec").alias("key"), "found")
        rows = _rows(df, id_col, class_col, vector_col).withColumn("key", F.struct("cls", "vec"))
        rest = split_heavy_join(rows, crowded, "key").drop("key")
        answered = answered.join(crowded, F.struct("cls", "vec") == F.col("key"), "left_anti").unionByName(rest)
    others = F.slice(F.filter("found", lambda f: f["id"] != F.col("id")), 1, k)
    return answered.select(F.col("id").alias(id_col), F.col("cls").alias(class_col), "vec", others.alias("neighbours"))


def neighbour_table(neighbours: DataFrame, id_col: str = "customer_id", class_col: str = "label") -> DataFrame:
    """Long form: one row per neighbour with its rank."""
    exploded = neighbours.select(id_col, class_col, F.posexplode("neighbours").alias("pos", "near"))
    return exploded.select(
        id_col, class_col, (F.col("pos") + 1).alias("rank"), F.col("near.id").alias("neighbour_id"),
        F.col("near.dist").alias("distance"),
    )
