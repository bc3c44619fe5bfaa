"""Near-duplicate vectors by a subspace pigeonhole join.

Two unit vectors of cosine ``least`` or more are at most a squared distance of
2 - 2 * least apart. A fixed random rotation spreads that distance over all
components; the rotated vector is split into ``blocks`` blocks, and a block of m of d
components has the budget m / d of it. The budgets add up to the whole, so in
some block a close pair keeps within the budget. Each block is a range join; the
pairs that meet in any block are verified by their cosine in double precision.

The range join of a block cuts its space into boxes at medians of a bounded sample. A
vector is at home in one box and visits every box within the budget of it; of two
boxes only one gets the other's vectors, so a pair meets once in a block. Home vectors
and visitors of a box are dealt into parts of bounded size, and each pair of parts is a
task of its own, so a box that holds a third of all rows is many tasks. A pair that
meets in several blocks counts in the first one whose budget it keeps. Tasks
return link counts for each vector and links that join the same vectors as all
of theirs do, never all pairs.

Equal vectors are one node with a number of copies. Rows whose vector is null, zero or
holds a null or a component that isn't finite are linked with nothing. Vectors of
different lengths are never linked; each length is joined on its own.

Boxes prune as far as vectors have structure. Without any, a budget reaches most
boxes, and the number of box pairs compared grows with the square of the input.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.llm.components import components
from headway.llm.frames import written

#: Blocks of the rotated components.
BLOCKS = 4
#: Vectors that place the cuts at most; vectors of a box aimed at; boxes of a block at most.
SAMPLE, BOX_ROWS, MOST_BOXES = 8_192, 32_768, 4_096
#: Home vectors, and visitors, that one task holds.
HOME_PART, VISIT_PART = 32_768, 32_768
#: Distances of one numpy step, and pairs verified at once.
DISTANCES, VERIFIED = 1 << 22, 1 << 14
#: Different vector lengths in one table at most.
LENGTHS = 64
#: Added to budgets where distances are rounded.
SLACK, SINGLE_SLACK = 1e-9, 1e-5


def rotation(dimension: int) -> np.ndarray:
    """An orthogonal matrix, the same for every run."""
    q, r = np.linalg.qr(np.random.default_rng(13).standard_normal((dimension, dimension)))
    return q * np.sign(np.diag(r))


def matrix(column: pa.Array, dimension: int) -> np.ndarray:
    """The vectors as rows, in double precision."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), dimension)


class Blocks:
    """The rotation, where blocks start, and their budgets."""

    def __init__(self, dimension: int, least: float, blocks: int):
        count = min(blocks, dimension)
        self.turn = rotation(dimension)
        self.cuts = [dimension * b // count for b in range(count + 1)]
        self.budgets = (2 - 2 * least) * np.diff(self.cuts) / dimension + SLACK

    def units(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Lengths, and rotated unit vectors. Components are added in a fixed order, so a
        vector gives the same numbers in every task."""
        largest = np.abs(vectors).max(axis=1)  # keeps squares from overflow
        scaled = vectors / largest[:, None]
        lengths = np.sqrt(np.einsum("ij,ij->i", scaled, scaled))
        turned = np.zeros_like(vectors)
        for d, row in enumerate(self.turn):
            turned += (scaled[:, d] / lengths)[:, None] * row
        return lengths * largest, turned

    def of(self, turned: np.ndarray, block: int) -> np.ndarray:
        return turned[:, self.cuts[block] : self.cuts[block + 1]]


def boxes(points: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of ``count`` boxes at most, from halving the fullest at
    the median of its widest component. Together they cover the space."""
    low, high = np.full(points.shape[1], -np.inf), np.full(points.shape[1], np.inf)
    parts = [(points, low, high)]
    while len(parts) < count:
        parts.sort(key=lambda p: len(p[0]))
        own, low, high = parts[-1]
        if len(own) < 2:
            break
        widest = int(np.argmax(own.var(axis=0)))
        cut = float(np.median(own[:, widest]))
        if not (own[:, widest] < cut).any():
            above = own[:, widest][own[:, widest] > cut]
            if not len(above):
                break
            cut = float(above.min())
        below = own[:, widest] < cut
        middle_high, middle_low = high.copy(), low.copy()
        middle_high[widest] = middle_low[widest] = cut
        parts[-1:] = [(own[below], low, middle_high), (own[~below], middle_low, high)]
    return np.array([p[1] for p in parts]), np.array([p[2] for p in parts])


def places(points: np.ndarray, bounds: tuple[np.ndarray, np.ndarray], budget: float):
    """(row, box, at home) of the boxes where each point is at home or visits."""
    low, high = bounds
    distance = np.zeros((len(points), len(low)))
    inside = np.ones((len(points), len(low)), dtype=bool)
    for d in range(points.shape[1]):
        x = points[:, d, None]
        distance += np.square(np.maximum(np.maximum(low[:, d] - x, x - high[:, d]), 0))
        inside &= (x >= low[:, d]) & (x < high[:, d])
    home = np.argmax(inside, axis=1)
    box = np.arange(len(low))
    # Of two boxes the one whose turn it is gets the other's vectors.
    turn = (box < home[:, None]) != ((box + home[:, None]) % 2 == 1)
    visits = (distance <= budget) & turn & (box != home[:, None])
    row, visited = np.nonzero(visits)
    return (
        np.concatenate([np.arange(len(points)), row]),
        np.concatenate([home, visited]),
        np.arange(len(points) + len(row)) < len(points),
    )


class Side:
    """What a task holds of one side."""

    def __init__(self, rows: pa.Table, dimension: int, split: Blocks):
        order = np.argsort(rows.column("node").to_numpy(), kind="stable")
        self.node = rows.column("node").to_numpy()[order]
        self.copies = rows.column("copies").to_numpy()[order]
        self.vectors = matrix(rows.column("vector").combine_chunks(), dimension)[order]
        self.lengths, self.turned = split.units(self.vectors)


def close_pairs(left: Side, right: Side, split: Blocks, block: int, least: float):
    """(i, j) of the pairs within the budget of this block, and of none before it, that
    the cosine confirms. ``right`` may be ``left``: then each pair comes once."""
    a = split.of(left.turned, block).astype(np.float32)
    b = split.of(right.turned, block).astype(np.float32)
    of_a, of_b = np.square(a).sum(axis=1), np.square(b).sum(axis=1)
    step = max(1, DISTANCES // max(1, len(b)))
    starts = split.cuts[:-1]
    for at in range(0, len(a), step):
        first = at if left is right else 0
        near = -2 * (a[at : at + step] @ b[first:].T)
        near += of_b[first:]
        limit = np.float32(split.budgets[block] + SINGLE_SLACK) - of_a[at : at + step]
        met = np.flatnonzero(near <= limit[:, None])
        i, j = at + met // (len(b) - first), first + met % (len(b) - first)
        if left is right:
            i, j = i[i < j], j[i < j]
        for part in range(0, len(i), VERIFIED):
            x, y = i[part : part + VERIFIED], j[part : part + VERIFIED]
            parts = np.add.reduceat(np.square(left.turned[x] - right.turned[y]), starts, axis=1)
            kept = parts <= split.budgets
            own = kept[:, block] & ~kept[:, :block].any(axis=1)
            x, y = x[own], y[own]
            products = np.einsum("ij,ij->i", left.vectors[x] / left.lengths[x, None],
                                 right.vectors[y] / right.lengths[y, None])
            linked = products >= least
            yield x[linked], y[linked]


def star(nodes: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The least node that each node reaches over the links (i, j)."""
    root = np.arange(nodes)
    while True:
        least = np.minimum(root[i], root[j])
        before = root.copy()
        np.minimum.at(root, root[i], least)
        np.minimum.at(root, root[j], least)
        while True:
            further = root[root]
            if (further == root).all():
                break
            root = further
        if (root == before).all():
            return root


def compared(left: pa.Table, right: pa.Table | None, dimension: int, split: Blocks, block: int,
             least: float) -> pa.Table:
    """(node, other, links): link counts of nodes, and rows with ``other`` that join what is linked."""
    one = Side(left, dimension, split)
    two = one if right is None else Side(right, dimension, split)
    offset = 0 if two is one else len(one.node)
    nodes = one.node if two is one else np.concatenate([one.node, two.node])
    links, root = np.zeros(len(nodes), dtype=np.int64), np.arange(len(nodes))
    for i, j in close_pairs(one, two, split, block, least):
        np.add.at(links, i, two.copies[j])
        np.add.at(links, j + offset, one.copies[i])
        new = root[i] != root[j + offset]
        if new.any():
            root = star(len(nodes), np.concatenate([np.arange(len(nodes)), i[new]]),
                        np.concatenate([root, j[new] + offset]))
    linked, joined = np.flatnonzero(links), np.flatnonzero(root != np.arange(len(nodes)))
    return pa.table({
        "node": pa.array(np.concatenate([nodes[linked], nodes[joined]])),
        "other": pa.array(np.concatenate([nodes[linked], nodes[root[joined]]]),
                          mask=np.arange(len(linked) + len(joined)) < len(linked)),
        "links": pa.array(np.concatenate([links[linked], np.zeros(len(joined), dtype=np.int64)])),
    })


def slices(batch: pa.RecordBatch, dimension: int, split: Blocks):
    """(rows, rotated vectors) of a batch (node, copies, vector), some rows at a time."""
    for at in range(0, batch.num_rows, 1024):
        own = batch.slice(at, 1024)
        yield own, split.units(matrix(own.column(2), dimension))[1]


FOUND = "node bigint, other bigint, links bigint"


def joined(nodes: DataFrame, dimension: int, least: float, blocks: int) -> DataFrame:
    """``FOUND`` rows of distinct vectors (node, copies, vector) of one length."""
    spark = nodes.sparkSession
    split, count = Blocks(dimension, least, blocks), nodes.count()
    of_block = range(len(split.budgets))
    sample = nodes.orderBy(F.xxhash64("node"), "node").limit(SAMPLE).select("vector").toArrow()
    turned = split.units(matrix(sample.column(0).combine_chunks(), dimension))[1]
    wanted = min(MOST_BOXES, -(-count // BOX_ROWS))
    bounds = [boxes(split.of(turned, b), wanted) for b in of_block]
    kind = nodes.schema["vector"].dataType.simpleString()

    def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [np.zeros((2, len(low)), dtype=np.int64) for low, _ in bounds]
        for batch in batches:
            for _, turned in slices(batch, dimension, split):
                for b in of_block:
                    _, box, home = places(split.of(turned, b), bounds[b], split.budgets[b])
                    total[b] += np.array([np.bincount(box[home == h], minlength=len(bounds[b][0])) for h in (True, False)])
        rows = [(b, box, int(homes), int(visits)) for b in of_block for box, (homes, visits) in enumerate(total[b].T)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.int32(), pa.int64(), pa.int64()))],
            names=["block", "box", "homes", "visits"],
        )

    # A row for each box: their number is bounded.
    parts = [np.ones((2, len(low)), dtype=np.int64) for low, _ in bounds]
    for row in nodes.mapInArrow(sizes, "block int, box int, homes bigint, visits bigint").groupBy("block", "box").agg(
        F.sum("homes").alias("homes"), F.sum("visits").alias("visits")
    ).collect():
        parts[row["block"]][:, row["box"]] = -(-row["homes"] // HOME_PART), -(-row["visits"] // VISIT_PART)

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Tasks of a box are (first, second), first being a part of its home vectors. Where
        both are the same, that part meets itself and the visitors' first part; else
        second is a later part of the home vectors or, behind these, of the visitors."""
        for batch in batches:
            for rows, turned in slices(batch, dimension, split):
                for b in of_block:
                    row, box, home = places(split.of(turned, b), bounds[b], split.budgets[b])
                    homes, visits = parts[b][:, box]
                    own = rows.column(0).to_numpy()[row] * 0x9E3779B1 >> 7
                    part = own % np.maximum(np.where(home, homes, visits), 1)
                    times = np.where(home, homes + np.maximum(visits - 1, 0), homes)
                    k = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
                    row, box, home, part, homes = (np.repeat(c, times) for c in (row, box, home, part, homes))
                    left = home & (k >= part)
                    first = np.where(left, part, k)
                    second = np.where(left, k, np.where(home, part, np.where(part > 0, homes + part - 1, k)))
                    taken = pa.array(row)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(row), b, dtype=np.int32)), pa.array(box.astype(np.int32)),
                         pa.array(first), pa.array(second), pa.array(left),
                         *(c.take(taken) for c in rows.columns)],
                        names=["block", "box", "first", "second", "left", "node", "copies", "vector"],
                    )

    def compare(key: tuple, rows: pa.Table) -> pa.Table:
        block, _, first, second = (k.as_py() for k in key)
        left, right = rows.filter(rows.column("left")), rows.filter(pc.invert(rows.column("left")))
        found = [pa.schema([(c, pa.int64()) for c in ("node", "other", "links")]).empty_table()]
        if left.num_rows and first == second:
            found.append(compared(left, None, dimension, split, block, least))
        if left.num_rows and right.num_rows:
            found.append(compared(left, right, dimension, split, block, least))
        return pa.concat_tables(found)

    rows = nodes.mapInArrow(
        dealt,
        f"block int, box int, first bigint, second bigint, left boolean, node bigint, copies bigint, vector {kind}",
    )
    return rows.groupBy("block", "box", "first", "second").applyInArrow(compare, FOUND)


def near_duplicates(vectors: DataFrame, least: float = 0.9, blocks: int = BLOCKS, id_column: str = "vec_id",
                    vector_column: str = "embedding") -> DataFrame:
    """Per row: id, ``n_links`` (other rows of a cosine of ``least`` or more), ``component_id``
    (the smallest id reachable over links, its own included) and ``kept`` (whether it is that id).

    Rows that repeat an id are vectors like others. Rows without an id take part; their
    id names no component, so a component of such rows alone has a null id. An empty
    table gives no rows.
    """
    spark = vectors.sparkSession
    kind = vectors.schema[vector_column].dataType.simpleString()
    own = F.col(vector_column) if kind == "array<float>" else F.col(vector_column).cast("array<double>")
    rows = vectors.select(F.col(id_column).cast("bigint").alias("id"), own.alias("vector"))
    usable = (
        F.col("vector").isNotNull()
        & F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists("vector", lambda x: x != 0)
    )
    nodes = written(
        rows.where(usable).groupBy("vector").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("copies"))
        .withColumn("node", F.monotonically_increasing_id()),
        "subspace-nodes",
    )
    lengths = [r[0] for r in nodes.select(F.size("vector")).distinct().limit(LENGTHS + 1).collect()]
    if len(lengths) > LENGTHS:
        raise ValueError(f"vectors of more than {LENGTHS} lengths")
    found = spark.createDataFrame([], FOUND)
    for length in lengths:
        one = nodes.where(F.size("vector") == length).select("node", "copies", "vector")
        found = found.unionAll(joined(one, length, least, blocks))
    found = written(found, "subspace-links")
    links = found.where("other is null").groupBy("node").agg(F.sum("links").alias("links"))
    root = components(found.where("other is not null").select("node", "other"), "subspace-components")
    named = nodes.join(root, "node", "left").withColumn("root", F.coalesce("root", "node"))
    ids = named.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = named.join(ids, "root").join(links, "node", "left").select(
        "vector", "component_id", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")
    )
    marked = rows.withColumn("vector", F.when(usable, F.col("vector")))
    alone = F.col("n_links").isNull()
    return (
        marked.join(classes, "vector", "left")
        .withColumn("component_id", F.when(alone, F.col("id")).otherwise(F.col("component_id")))
        .select(
            F.col("id").alias(id_column),
            F.coalesce("n_links", F.lit(0).cast("bigint")).alias("n_links"),
            "component_id",
            F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept"),
        )
    )
