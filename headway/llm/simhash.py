"""Near duplicates by SimHash: pigeonhole blocks, then Hamming distance.

A fingerprint has 64 bits, each the majority over the hashes of all word
shingles of a text. Two fingerprints within ``distance`` bits agree on at least
``pieces - distance`` of ``pieces`` bit ranges, so they share a block: the
value of the bits of some ``pieces - distance`` ranges. Distinct fingerprints are
grouped by block, compared within it, and linked components get the
smallest document id.

No block is compared unless it is small: a larger one is split again by the
same argument (of ``distance + 1`` ranges of the bits it doesn't fix, a close
pair shares one), until at most ``BLOCK_ROWS`` fingerprints share a block or so
few bits are free that there can't be more. So no pair is lost and no task
gets an unbounded group. A block gives a spanning forest of its links, not all
pairs.

Documents that share a fingerprint are one node. Null and empty texts have no
words; their fingerprint is zero and links like any other.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from headway.llm.components import components
from headway.llm.frames import batch_parts, free_name, written

BITS = 64
SEED = 42
#: Most fingerprints compared with each other in one block.
BLOCK_ROWS = 256
#: Words of a text are taken in blocks of about this many bytes.
TEXT_BLOCK = 1 << 20
SPACE = re.compile(rb"[\x20\x09-\x0D]")


def word_blocks(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text, in lists of bounded size."""
    at = 0
    while len(text) - at > TEXT_BLOCK:
        cut = SPACE.search(text, at + TEXT_BLOCK)
        if cut is None:
            break
        yield text[at : cut.start()].split()
        at = cut.end()
    yield (text[at:] if at else text).split()


def shingle_hashes(text: bytes, words: int) -> Iterator[bytes]:
    """XXH64 digests (big-endian, joined) of all shingles, repeats included; of
    the whole sequence where it is shorter; none without words."""
    digest, kept, seen = xxhash.xxh64_digest, [], False
    for block in word_blocks(text.lower()):
        kept += block
        if len(kept) < words:
            continue
        seen = True
        joined = b" ".join(kept)
        ends = np.cumsum(np.fromiter(map(len, kept), np.int64, len(kept)) + 1) - 1
        starts = [0, *(ends[: len(ends) - words] + 1).tolist()]
        yield b"".join([digest(joined[a:b], SEED) for a, b in zip(starts, ends[words - 1 :].tolist())])
        kept = kept[len(kept) - words + 1 :]
    if kept and not seen:
        yield digest(b" ".join(kept), SEED)


def simhash(text: bytes, words: int) -> int:
    """A bit is 1 if it is set in over half of the hashes."""
    total, ones = 0, np.zeros(BITS, dtype=np.int64)
    for digests in shingle_hashes(text, words):
        for at in range(0, len(digests), 8 << 14):
            rows = np.frombuffer(digests, np.uint8)[at : at + (8 << 14)].reshape(-1, 8)
            ones += np.unpackbits(rows, axis=1).sum(axis=0, dtype=np.int32)
            total += len(rows)
    return int.from_bytes(np.packbits(2 * ones > total).tobytes(), "big", signed=True)


def fingerprint(text: Column, words: int) -> Column:
    """The fingerprint of a text column, as a signed bigint."""

    @F.arrow_udf("bigint")
    def of(texts: pa.Array) -> pa.Array:
        return pa.array(
            [
                simhash((t or "").encode(), words)
                for part in batch_parts(texts)
                for t in part.to_pylist()
            ],
            pa.int64(),
        )

    return of(text)


def signed(bits: int) -> int:
    return bits - (1 << BITS) if bits >> (BITS - 1) else bits


def ranges(bits: int, pieces: int) -> list[int]:
    """The set bits of ``bits`` as ``pieces`` masks of nearly equal size."""
    places = [i for i in range(BITS) if bits >> i & 1]
    cuts = [len(places) * k // pieces for k in range(pieces + 1)]
    return [sum(1 << i for i in places[a:b]) for a, b in zip(cuts, cuts[1:])]


def block_masks(distance: int, pieces: int) -> list[int]:
    """Bits that a block fixes, for every choice of ranges that may be equal."""
    every = ranges((1 << BITS) - 1, pieces)
    return [sum(c) for c in combinations(every, pieces - distance)]


def finer_masks(mask: int, distance: int) -> list[int]:
    return [mask | part for part in ranges(~mask & ((1 << BITS) - 1), distance + 1)]


def _blocks(prints: DataFrame, distance: int, pieces: int) -> DataFrame:
    """(mask, value, print) of all blocks with company, each small enough."""
    spark = prints.sparkSession
    key = ["mask", "value"]
    masks = block_masks(distance, pieces)
    options = F.array(*[F.lit(signed(m)).cast("bigint") for m in masks])
    rows = prints.select("print", F.explode(options).alias("mask"))
    rows = rows.select("mask", F.col("print").bitwiseAND(F.col("mask")).alias("value"), "print")
    done: DataFrame | None = None
    while True:
        sizes = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        rows = written(rows.join(sizes, key), "simhash-blocks")
        free = {m: BITS - bin(m).count("1") for m in masks}
        last = [signed(m) for m in masks if 1 << free[m] <= BLOCK_ROWS]
        small = (F.col("n") <= BLOCK_ROWS) | F.col("mask").isin(last)
        ready = rows.where(small).drop("n")
        done = ready if done is None else done.unionAll(ready)
        large = rows.where(~small)
        # At most one row for each mask; their number doesn't grow with the data.
        hot = [r[0] & ((1 << BITS) - 1) for r in large.select("mask").distinct().collect()]
        if not hot:
            return done
        finer = {m: finer_masks(m, distance) for m in hot}
        masks = sorted({f for fs in finer.values() for f in fs})
        steps = spark.createDataFrame(
            [(signed(m), signed(f)) for m, fs in finer.items() for f in fs],
            T.StructType([T.StructField(c, T.LongType()) for c in ("mask", "finer")]),
        )
        rows = (
            large.join(F.broadcast(steps), "mask")
            .select(F.col("finer").alias("mask"), "print",
                    F.col("print").bitwiseAND(F.col("finer")).alias("value"))
            .distinct()
            .select("mask", "value", "print")
        )


def _forest(prints: np.ndarray, starts: np.ndarray, distance: int) -> tuple[list[int], list[int]]:
    """Spanning forests of the links within blocks; ``starts`` numbers the
    block of each row, rows of a block being together."""
    parent = np.arange(len(prints))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    left, right = [], []
    shift = 1
    while shift < len(prints):
        same = np.flatnonzero(starts[shift:] == starts[:-shift])
        if not len(same):
            break
        near = np.bitwise_count(prints[same] ^ prints[same + shift]) <= distance
        for i in same[near].tolist():
            a, b = root(i), root(i + shift)
            if a != b:
                parent[max(a, b)] = min(a, b)
                left.append(i)
                right.append(i + shift)
        shift += 1
    return left, right


def links(prints: DataFrame, distance: int, pieces: int) -> DataFrame:
    """(a, b): links between distinct fingerprints that join the same
    fingerprints as all pairs within ``distance`` bits do.

    ``prints`` has one bigint column ``print``, without repeats or nulls.
    """

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = [np.empty(0, np.int64)] * 3

        def edges(columns: list[np.ndarray]) -> pa.RecordBatch:
            mask, value, fp = columns
            change = np.ones(len(fp), dtype=np.int64)
            change[1:] = (mask[1:] != mask[:-1]) | (value[1:] != value[:-1])
            a, b = _forest(fp.view(np.uint64), np.cumsum(change), distance)
            return pa.RecordBatch.from_arrays([pa.array(fp[a]), pa.array(fp[b])], names=["a", "b"])

        for batch in batches:
            kept = [np.concatenate([k, c.to_numpy(zero_copy_only=False)]) for k, c in zip(kept, batch.columns)]
            if len(kept[0]) > 4 * BLOCK_ROWS:  # the last block may go on in the next batch
                mask, value, _ = kept
                last = int(np.flatnonzero((mask != mask[-1]) | (value != value[-1]))[-1]) + 1
                yield edges([k[:last] for k in kept])
                kept = [k[last:] for k in kept]
        yield edges(kept)

    key = ["mask", "value"]
    blocks = _blocks(prints, distance, pieces).repartition(*key).sortWithinPartitions(*key)
    return blocks.mapInArrow(compare, "a bigint, b bigint").distinct()


def components_by_print(docs: DataFrame, id_column: str, print_column: str, distance: int,
                        pieces: int) -> DataFrame:
    """(print, root, least, component_id, documents): for each distinct
    fingerprint the smallest fingerprint of its component, the smallest id of
    its rows and of its component, and the number of its rows.

    Null ids count as rows but never name a component that has another id.
    """
    prints = written(
        docs.groupBy(F.col(print_column).alias("print")).agg(
            F.min(id_column).alias("least"), F.count(F.lit(1)).alias("documents")
        ),
        "simhash-prints",
    )
    roots = components(links(prints.select("print"), distance, pieces), "simhash-components")
    joined = prints.join(roots.withColumnRenamed("node", "print"), "print", "left").withColumn(
        "root", F.coalesce("root", "print")
    )
    least = joined.groupBy("root").agg(F.min("least").alias("component_id"))
    return joined.join(least, "root").select("print", "root", "least", "component_id", "documents")


def near_duplicates(docs: DataFrame, words: int = 3, distance: int = 3, pieces: int = 6,
                    id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row: id, ``fingerprint`` (16 hexadecimal digits) and
    ``component_id``, the smallest id reachable over links of at most
    ``distance`` bits. Rows with a null or repeated id are rows like others."""
    found = written(
        docs.select(F.col(id_column).alias("id"), fingerprint(F.col(text_column), words).alias("print")),
        "simhash-documents",
    )
    classes = components_by_print(found, "id", "print", distance, pieces)
    return found.join(classes, "print").select(
        F.col("id").alias(id_column),
        F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def deduplicate(docs: DataFrame, words: int = 3, distance: int = 3, pieces: int = 6,
                id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row of each component, all columns kept: one with the smallest id
    (a null id only if there is no other). Of rows that repeat this id it is
    the one with the smallest hash of the text; of wholly equal rows, any one.
    """
    fp, key = free_name(docs, "simhash_print"), free_name(docs, "simhash_row")
    marked = written(
        docs.withColumns({fp: fingerprint(F.col(text_column), words), key: F.monotonically_increasing_id()}),
        "simhash-documents",
    )
    classes = components_by_print(marked, id_column, fp, distance, pieces)
    first = classes.where("least <=> component_id").select("print", "root", "component_id")
    rows = marked.select(F.col(id_column).alias("id"), F.col(fp).alias("print"), F.col(key).alias("row"),
                         F.xxhash64(text_column).alias("text"))
    keepers = (
        rows.join(first, "print")
        .where(F.col("id").eqNullSafe(F.col("component_id")))
        .groupBy("root")
        .agg(F.min(F.struct("text", "row")).alias("kept"))
        .select(F.col("kept.row").alias(key))
    )
    return marked.join(keepers, key, "left_semi").select(*docs.columns)
