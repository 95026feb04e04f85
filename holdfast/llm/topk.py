"""Exact top-k inner products by columnar branch and bound.

Vectors are kept as blocks in vertical layout, one row of numbers per dimension. For a query a block's scores are
accumulated some dimensions at a time. What the dimensions still to come can add is at most the product of the two
vectors' remaining masses (Cauchy-Schwarz), so each candidate has a lower and an upper bound; candidates whose upper bound
is below the k-th largest lower bound are dropped and the others' columns are compacted.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from holdfast.session import store

#: Candidates and queries that meet in one call.
BLOCK_ROWS, QUERY_ROWS = 8192, 512
#: Blocks, and blocks of queries, that meet in one group: some 50 MB at 64 dimensions.
GROUP_BLOCKS, GROUP_QUERIES = 8, 64
#: Dimensions that are added between two prunings.
STEP = 16


def prepared(vectors: DataFrame, scale: float, key: str, vector: str) -> DataFrame:
    """vec_id, dims and v: floor(scale * x) of each usable vector."""
    usable = F.col(key).isNotNull() & F.col(vector).isNotNull() & F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.where(usable).select(
        F.col(key).cast("long").alias("vec_id"), F.size(vector).alias("dims"),
        F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("long")).alias("v"))


def packed(rows: DataFrame, size: int) -> DataFrame:
    """Rows of one number of dimensions to blocks of up to `size`: their ids, and their numbers in vertical layout."""

    def block(dims: int, held: list[tuple[int, list[int]]]) -> pa.RecordBatch:
        columns = np.array([v for _, v in held], dtype=np.int64).reshape(len(held), dims).T
        return pa.RecordBatch.from_arrays(
            [pa.array([dims], pa.int32()), pa.array([[i for i, _ in held]], pa.list_(pa.int64())),
             pa.array([np.ascontiguousarray(columns).tobytes()], pa.binary())], names=["dims", "ids", "columns"])

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for batch in batches:
            for key, dims, v in zip(*(batch.column(i).to_pylist() for i in range(3))):
                own = held.setdefault(dims, [])
                own.append((key, v))
                if len(own) == size:
                    yield block(dims, held.pop(dims))
        yield from (block(dims, own) for dims, own in held.items())

    return rows.mapInArrow(mapped, "dims int, ids array<long>, columns binary")


def meetings(blocks: DataFrame, queries: DataFrame, group_blocks: int, group_queries: int) -> DataFrame:
    """Every block beside every query block of as many dimensions.

    They meet in a grid: a block goes to one row of cells, a query block to one column, and a cell holds about
    group_blocks of the ones and group_queries of the others, so no task grows with the data.
    """
    rows = -(-blocks.count() // group_blocks) or 1
    columns = -(-queries.count() // group_queries) or 1
    place = F.xxhash64("ids")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = blocks.select("*", F.pmod(place, F.lit(rows)).cast("int").alias("row"), every(columns).alias("column"))
    right = queries.select(
        "query_block", "dims", F.col("ids").alias("query_ids"), F.col("columns").alias("queries"),
        F.pmod(place, F.lit(columns)).cast("int").alias("column"), every(rows).alias("row"))
    return left.join(right, ["dims", "row", "column"])


def rest_masses(columns: np.ndarray, step: int) -> np.ndarray:
    """For each pruning point, the norm of each vector's dimensions from there on."""
    squares = columns.astype(np.float64) ** 2
    tails = np.cumsum(squares[::-1], axis=0)[::-1]
    return np.sqrt(np.vstack([tails, np.zeros((1, columns.shape[1]))])[::step] if len(columns) % step == 0 else np.vstack(
        [tails[::step], np.zeros((1, columns.shape[1]))]))


def best(query: np.ndarray, query_rest: np.ndarray, columns: np.ndarray, rest: np.ndarray, ids: np.ndarray, k: int,
         step: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and scores of the k best candidates, ties to smaller ids."""
    alive, score, own = np.arange(columns.shape[1]), np.zeros(columns.shape[1], dtype=np.int64), columns
    for number, start in enumerate(range(0, len(query), step)):
        score = score + query[start:start + step] @ own[start:start + step]
        slack = query_rest[number + 1] * rest[number + 1][alive] * (1 + 1e-9) + 1e-6
        if len(alive) > k:
            worst = score - slack
            bound = np.partition(worst, len(worst) - k)[len(worst) - k]
            stay = score + slack >= bound
            if stay.sum() < 0.7 * len(stay):
                alive, score, own = alive[stay], score[stay], own[:, stay]
    order = np.lexsort((ids[alive], -score))[:k]
    return alive[order], score[order]


def search(joined: DataFrame, k: int, step: int) -> DataFrame:
    """The k + 1 best candidates of each block for each query of the block it met; `same` marks equal id and vector."""

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in (batch.slice(i, 1).to_pylist()[0] for i in range(batch.num_rows)):
                dims, ids = row["dims"], np.array(row["ids"], dtype=np.int64)
                columns = np.frombuffer(row["columns"], dtype=np.int64).reshape(dims, -1)
                query_ids = np.array(row["query_ids"], dtype=np.int64)
                queries = np.frombuffer(row["queries"], dtype=np.int64).reshape(dims, -1)
                rest, query_rest = rest_masses(columns, step), rest_masses(queries, step)
                out: list[list] = [[], [], [], [], []]
                for q, query_id in enumerate(query_ids):
                    query = np.ascontiguousarray(queries[:, q])
                    at, scores = best(query, query_rest[:, q], columns, rest, ids, k + 1, step)
                    same = (ids[at] == query_id) & (columns[:, at] == query[:, None]).all(0)
                    for column, values in zip(out, (
                            np.full(len(at), query_id), np.full(len(at), q), ids[at], scores, same)):
                        column.append(values)
                columns = [np.concatenate(c) for c in out]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(columns[0]), pa.array(np.full(len(columns[0]), row["query_block"], np.int64)),
                     *map(pa.array, columns[1:])],
                    names=["query_id", "query_block", "query_row", "vec_id", "score", "same"])

    return joined.mapInArrow(
        mapped, "query_id long, query_block long, query_row long, vec_id long, score long, same boolean")


def top_k(
    vectors: DataFrame, k: int = 10, every: int = 100, scale: float = 1024.0, block_rows: int = BLOCK_ROWS,
    query_rows: int = QUERY_ROWS, step: int = STEP, key: str = "vec_id", vector: str = "embedding",
    group_blocks: int = GROUP_BLOCKS, group_queries: int = GROUP_QUERIES,
) -> DataFrame:
    """query_id, rank, vec_id, score: the k largest inner products of floor(scale * x) for each vector whose id is
    divisible by `every`, among all rows of as many dimensions but its own; ties to smaller ids.

    Vectors that are null or hold a null or non-finite component, and rows with a null id, take no part. A repeated row is
    a candidate for its copy, and each copy of a query is answered. Scores are 64-bit integers; components and sums
    have to stay below 2**53. An empty table gives no rows.
    """
    rows = prepared(vectors, scale, key, vector)
    blocks = store(packed(rows, block_rows), "vector-blocks")
    queries = store(
        packed(rows.where(F.col("vec_id") % every == 0).coalesce(1 + _queries(rows, every) // query_rows), query_rows)
        .withColumn("query_block", F.monotonically_increasing_id()), "query-blocks")
    found = search(meetings(blocks, queries, group_blocks, group_queries), k, step)
    # The query's own row is one of those equal to it; the first of them is left out.
    per_query = Window.partitionBy("query_block", "query_row")
    ordered = per_query.orderBy(F.desc("score"), "vec_id", F.desc("same"))
    first = found.withColumn("place", F.row_number().over(ordered)).where(F.col("place") <= k + 1)
    own = F.min(F.when(F.col("same"), F.col("place"))).over(per_query)
    rest = first.withColumn("own", own).where("own is null or place <> own").withColumn(
        "rank", F.row_number().over(per_query.orderBy("place")))
    return rest.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _queries(rows: DataFrame, every: int) -> int:
    return rows.where(F.col("vec_id") % every == 0).count()
