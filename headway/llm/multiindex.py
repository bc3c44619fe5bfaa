"""Approximate nearest neighbours by an inverted multi-index.

The two halves of a vector are quantised separately, with ``centroids`` centres
each, fitted on a bounded sample. The pair of nearest centres is a vector's
*cell*, so there are ``centroids`` squared fine cells from two small tables. A
query visits cells in the order of summed distance (here: of summed inner
product, the larger the nearer), which a heap over the two sorted lists yields
one by one, until the visited cells hold enough vectors. All of these are scored exactly,
in double precision, and the best are kept.

Vectors are stored by cell, and all cells with one centre of the first half
make up a list. For each list it visits a query has a row with the set of cells
it has reached there, so it has ``centroids`` rows at most however many cells it
visits. Rows meet their list by a grouped join; a list with more than
``LIST_ROWS`` vectors or queries is split by a hash, every part of the list meeting
every block of its queries. Each part keeps a query's best ``k`` among the cells
reached; the bests of all parts are ranked by query.

Scores are sums over the components in order, so equal vectors score the same
wherever they are computed, and ties go to the smaller id. Vectors that are
null, zero, of another dimension than most, or hold a null or a component that
isn't finite take no part; neither do rows without an id. Rows that repeat an id
are candidates one by one, never of a query with that id.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from headway.llm.frames import free_name, written

#: Vectors that fit the centres at most, and rounds of fitting.
SAMPLE, ROUNDS = 8_000, 12
#: Vectors of a list, and queries of a list, that one task holds together.
LIST_ROWS = 4_096
#: Scores of one numpy step.
SCORES = 1 << 18


def usable(vectors: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """(id, vector) of the rows that take part."""
    vector = F.col("vector")
    good = (
        vector.isNotNull() & F.col("id").isNotNull()
        & F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists("vector", lambda x: x != 0)
    )
    kind = vectors.schema[vector_column].dataType.simpleString()
    own = F.col(vector_column) if kind == "array<float>" else F.col(vector_column).cast("array<double>")
    return vectors.select(F.col(id_column).cast("bigint").alias("id"), own.alias("vector")).where(good)


def _dimension(rows: DataFrame) -> int:
    """The commonest number of components; 0 without vectors."""
    found = rows.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return found["n"] if found else 0


def matrix(column: pa.Array, dimension: int) -> np.ndarray:
    """The vectors as rows, in double precision."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), dimension)


def centres(points: np.ndarray, count: int, seed: int) -> np.ndarray:
    """k-means (Lloyd's rounds) of a half; fewer centres for fewer points."""
    random = np.random.default_rng(seed)
    distinct = np.unique(points, axis=0)
    found = distinct[random.permutation(len(distinct))[:count]]
    for _ in range(ROUNDS):
        nearest = assign(points, found)
        sums = np.zeros_like(found)
        np.add.at(sums, nearest, points)
        sizes = np.bincount(nearest, minlength=len(found))
        full = sizes > 0
        found[full] = sums[full] / sizes[full, None]
    return found


def assign(points: np.ndarray, found: np.ndarray) -> np.ndarray:
    """The nearest centre of each point."""
    return np.argmin((found**2).sum(axis=1) - 2 * points @ found.T, axis=1)


def pairs_by_sum(first: np.ndarray, second: np.ndarray) -> Iterator[tuple[int, int]]:
    """Index pairs in descending order of first[i] + second[j]: a heap holds
    the pairs whose neighbours before them have come out."""
    i_order, j_order = np.argsort(-first, kind="stable"), np.argsort(-second, kind="stable")
    a, b = first[i_order].tolist(), second[j_order].tolist()
    heap = [(-(a[0] + b[0]), 0, 0)]
    reached = [0] * len(a)  # how many j of each i have come out
    while heap:
        _, i, j = heapq.heappop(heap)
        yield int(i_order[i]), int(j_order[j])
        reached[i] = j + 1
        if j == 0 and i + 1 < len(a):
            heapq.heappush(heap, (-(a[i + 1] + b[0]), i + 1, 0))
        if j + 1 < len(b):
            heapq.heappush(heap, (-(a[i] + b[j + 1]), i, j + 1))


class Index:
    """Centres of both halves, and the sizes of all cells (a table of
    ``centroids`` squared numbers)."""

    def __init__(self, halves: tuple[np.ndarray, np.ndarray]):
        self.halves, self.cut = halves, halves[0].shape[1]
        self.sizes = np.zeros((len(halves[0]), len(halves[1])), dtype=np.int64)

    def cells(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return assign(points[:, : self.cut], self.halves[0]), assign(points[:, self.cut :], self.halves[1])

    def visits(self, query: np.ndarray, enough: int) -> np.ndarray:
        """Which cells are reached, nearest first, until they hold ``enough``."""
        sizes, reached, held = self.sizes.tolist(), np.zeros(self.sizes.shape, dtype=bool), 0
        found: tuple[list[int], list[int]] = ([], [])
        for i, j in pairs_by_sum(self.halves[0] @ query[: self.cut], self.halves[1] @ query[self.cut :]):
            if sizes[i][j]:
                found[0].append(i)
                found[1].append(j)
                held += sizes[i][j]
                if held >= enough:
                    break
        reached[found] = True
        return reached


def fit(rows: DataFrame, dimension: int, centroids: int) -> tuple[np.ndarray, np.ndarray]:
    """Centres from at most ``SAMPLE`` vectors, those with the smallest hashes."""
    sample = rows.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).select("vector").toArrow()
    points = matrix(sample.column(0).combine_chunks(), dimension)
    half = max(1, dimension // 2)
    return centres(points[:, :half], centroids, 1), centres(points[:, half:], centroids, 2)


def best(queries: np.ndarray, points: np.ndarray, reached: np.ndarray, ids: np.ndarray,
         cells: np.ndarray, columns: np.ndarray, k: int) -> list[np.ndarray]:
    """(query, id, score) of the best ``k`` of a list for each query, among the
    cells it has reached.

    ``ids`` ascend; ``columns`` has the list's vectors, a row for each component.
    """
    out = [[np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0)]]
    step = max(1, SCORES // max(1, len(ids)))
    for at in range(0, len(queries), step):
        own, part = queries[at : at + step], points[at : at + step]
        score = np.zeros((len(own), len(ids)))
        for d in range(len(columns)):  # in order, so that equal vectors score alike
            score += part[:, d, None] * columns[d]
        score[(own[:, None] == ids) | ~reached[at : at + step][:, cells]] = -np.inf
        order = np.argsort(-score, axis=1, kind="stable")[:, :k]
        found = np.take_along_axis(score, order, axis=1)
        row, place = np.nonzero(found > -np.inf)
        for column, values in zip(out, (own[row], ids[order[row, place]], found[row, place])):
            column.append(values)
    return [np.concatenate(c) for c in out]


def nearest(vectors: DataFrame, is_query: Column, k: int = 20, centroids: int = 128, share: float = 0.4,
            least: int = 2_000, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` vectors found for each row where
    ``is_query`` (a condition on the columns of ``vectors``) holds, without the
    rows of its own id. A query visits cells until they hold ``share`` of all
    vectors, and ``least`` vectors. Without usable vectors, no rows.

    The default share suits vectors without structure, where half the centres
    are about as near as the nearest; clustered ones need far less.
    """
    spark = vectors.sparkSession
    mark = free_name(vectors, "is_query")
    marked = vectors.withColumn(mark, F.coalesce(is_query, F.lit(False)))
    rows = usable(marked, id_column, vector_column)
    asked = usable(marked.where(F.col(mark)), id_column, vector_column)
    dimension = _dimension(rows)
    result = "query_id bigint, rank int, vec_id bigint, score double"
    if dimension == 0:
        return spark.createDataFrame([], result)
    rows, asked = (r.where(F.size("vector") == dimension) for r in (rows, asked))
    index, kind = Index(fit(rows, dimension, centroids)), rows.schema["vector"].dataType.simpleString()

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = index.cells(matrix(batch.column(1), dimension))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, pa.int32()) for c in found), batch.column(1)],
                names=["id", "list", "cell", "vector"],
            )

    lists = written(rows.mapInArrow(place, f"id bigint, list int, cell int, vector {kind}"), "index-lists")
    # A row for each cell: bounded by centroids squared.
    for row in lists.groupBy("list", "cell").count().collect():
        index.sizes[row["list"], row["cell"]] = row["count"]
    enough = max(least, int(share * index.sizes.sum()))

    def visits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, number, reached = [], [], []
            for i, point in enumerate(matrix(batch.column(1), dimension)):
                cells = index.visits(point, enough)
                own = np.flatnonzero(cells.any(axis=1))
                row += [i] * len(own)
                number += own.tolist()
                reached += [c.tobytes() for c in np.packbits(cells[own], axis=1)]
            of_row = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(of_row), pa.array(number, pa.int32()), pa.array(reached, pa.binary()),
                 batch.column(1).take(of_row)],
                names=["id", "list", "reached", "vector"],
            )

    # Finding the cells is most of a query's work, and queries are few.
    spread = asked.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "id")
    visited = written(spread.mapInArrow(visits, f"id bigint, list int, reached binary, vector {kind}"), "index-visits")
    asking = {r["list"]: r["count"] for r in visited.groupBy("list").count().collect()}
    # Lists in parts and queries in blocks: a row for each list.
    splits = F.broadcast(spark.createDataFrame(
        [(c, -(-int(index.sizes[c].sum()) // LIST_ROWS), -(-n // LIST_ROWS)) for c, n in asking.items()],
        "list int, parts bigint, blocks bigint",
    ))
    own = F.xxhash64("id", "vector")
    every = {n: F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(f"{n}s") - 1)).alias(n) for n in ("part", "block")}
    vectors_of = lists.join(splits, "list").select(
        "list", F.pmod(F.monotonically_increasing_id(), "parts").alias("part"), every["block"], "id", "cell", "vector"
    )
    queries_of = visited.join(splits, "list").select(
        "list", every["part"], F.pmod(own, "blocks").alias("block"), "id", "reached", "vector"
    )

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        """One part of a list and one block of queries, each of about ``LIST_ROWS`` rows."""
        if not len(left) or not len(right):
            return pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())]).empty_table()
        ids = left.column("id").to_numpy()
        order = np.argsort(ids, kind="stable")
        columns = np.ascontiguousarray(matrix(left.column("vector").combine_chunks(), dimension)[order].T)
        bits = np.frombuffer(b"".join(right.column("reached").to_pylist()), np.uint8).reshape(len(right), -1)
        found = best(
            right.column("id").to_numpy(), matrix(right.column("vector").combine_chunks(), dimension),
            np.unpackbits(bits, axis=1).astype(bool), ids[order], left.column("cell").to_numpy()[order], columns, k,
        )
        return pa.table([pa.array(found[0]), pa.array(found[1]), pa.array(found[2])],
                        names=["query_id", "vec_id", "score"])

    key = ["list", "part", "block"]
    found = vectors_of.groupBy(*key).cogroup(queries_of.groupBy(*key)).applyInArrow(
        score, "query_id bigint, vec_id bigint, score double"
    )
    by_rank = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(by_rank)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )
