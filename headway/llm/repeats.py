"""Exact repeated substrings by bucket-pointer refinement.

Every byte covered by a ``length``-byte string that also starts anywhere else, in
the same text or another, is removed. Two places belong together if their
strings are equal, so positions are kept in buckets and buckets are refined:

* The initial bucket of a position is its 8-gram. The identifier of the bucket
  of the string of 2n bytes at p is made of the identifiers of the buckets of n
  bytes at p and at the *later offset* p + n, each update being used again by
  the next: 8, 16, 32 ... ``length`` bytes. Identifiers are made of content (two
  mixed 64-bit lanes), not ranks, so they agree between tasks without a sort of
  all suffixes.
* A string can only be repeated if its bucket at a smaller length has company.
  Of each window of ``length`` bytes one *anchor* is looked at: the position whose
  bucket of ``GRAM`` bytes has the smallest identifier. Equal windows have equal
  anchors at equal offsets, and neighbouring windows share theirs, so a *run* of
  windows is one row. Rows alone in their anchor's bucket are done.
* A run whose whole string, refined to its full length by the buckets of later
  offsets, has company is repeated as a whole. Only where runs of one anchor
  bucket differ, at the edges of repeated regions, are single windows refined to
  ``length`` bytes. Of runs already known to be repeated one representative
  takes part in that. The strings of a bucket's runs are brought together in a
  task if at most ``BUCKET_ROWS`` differ; a larger bucket is refined first, in
  blocks of fewer and fewer windows, until its buckets are small or all alike.

All other counts are partial aggregations joined back, so a passage in a third
of all documents is spread over tasks. Texts travel compressed. Texts are UTF-8
bytes; null is the empty text. Matches never cross texts. Rows that repeat an
id, null ids included, are texts of their own; equal texts repeat each other.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.llm.frames import free_name, written

#: Bytes whose bucket picks the anchors; a power of two below ``length``.
GRAM = 32
#: Bytes whose buckets make up those of longer runs; a power of two below ``length``.
BLOCK = 128
#: Bytes of one numpy step; work arrays take about 150 times as much.
STEP = 1 << 18
#: Most differing runs of an anchor's bucket that one task compares.
BUCKET_ROWS = 1024
#: Windows of a block, in the rounds that refine larger buckets; the last must
#: be 1, where the strings of a bucket are all alike.
WIDTHS = (48, 12, 3, 1)
#: Lower bits of an identifier that give way to the place; more than a step has places.
PLACE_BITS = 20
#: Odd multipliers of the two lanes, for the earlier and the later bucket.
LANES = ((0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F), (0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD))


def _mix(early: np.ndarray, late: np.ndarray, lane: int) -> np.ndarray:
    """The identifier of the refined bucket of a pair of buckets."""
    first, second = (np.uint64(m) for m in LANES[lane])
    out = early * first
    out ^= out >> np.uint64(29)
    out += late
    out *= second
    out ^= out >> np.uint64(32)
    return out


class Buckets:
    """Bucket identifiers of the strings at every position of a byte array.

    An identifier near the end that would need bytes behind it is missing: the
    arrays get shorter as the strings get longer.
    """

    def __init__(self, grams: np.ndarray, lane: int):
        self.lane, self.levels = lane, {8: _mix(grams, grams, lane)}

    def at(self, size: int) -> np.ndarray:
        """Identifiers of ``size`` bytes (8 at least), refined from shorter ones."""
        if size not in self.levels:
            shorter = max(8, 1 << (size - 1).bit_length() - 1)
            part, later = self.at(shorter), size - shorter
            n = max(0, len(part) - later)
            self.levels[size] = _mix(part[:n], part[later : later + n], self.lane)
        return self.levels[size]

    def spans(self, starts: np.ndarray, sizes: np.ndarray, block: int) -> np.ndarray:
        """Identifiers of strings of different sizes, ``block`` or more: made
        of the buckets at later offsets, the last of which may overlap."""
        ids = self.at(block)
        out = _mix(ids[starts], sizes.astype(np.uint64), self.lane)
        done = np.full(len(starts), block)
        left = np.flatnonzero(done < sizes)
        while len(left):
            done[left] = np.minimum(done[left] + block, sizes[left])
            out[left] = _mix(out[left], ids[starts[left] + done[left] - block], self.lane)
            left = left[done[left] < sizes[left]]
        return out


def eight_grams(data: np.ndarray) -> np.ndarray:
    """The 8 bytes at every position, as integers: the initial buckets."""
    n = max(0, len(data) - 7)
    grams = np.empty(n, dtype=np.uint64)
    for i in range(min(8, n)):
        part = data[i : i + (n - i + 7) // 8 * 8]
        grams[i::8] = part.view(np.uint64)
    return grams


def _least(ids: np.ndarray, width: int) -> np.ndarray:
    """The smallest of each ``width`` neighbours."""
    low, size = ids, 1
    while size * 2 <= width:
        low, size = np.minimum(low[:-size], low[size:]), size * 2
    rest = width - size
    return np.minimum(low[:-rest], low[rest:]) if rest else low


def anchor_runs(gram: np.ndarray, starts: np.ndarray, stops: np.ndarray, width: int):
    """(first window, last window, anchor) of maximal runs of neighbouring
    windows that share their anchor, within the ranges of windows given.

    The anchor is the position with the smallest identifier among the ``width``
    of a window, compared by its upper bits; of equal ones the last.
    """
    places = np.uint64((1 << PLACE_BITS) - 1)
    place = np.arange(len(gram), dtype=np.uint64)
    low = _least((gram & ~places) | (places - place), width)
    anchors = (places - (low & places)).astype(np.int64)
    windows = np.concatenate([np.arange(a, b) for a, b in zip(starts, stops)] or [np.empty(0, np.int64)])
    if not len(windows):
        return windows, windows, windows
    own = anchors[windows]
    new = np.ones(len(windows), dtype=bool)
    new[1:] = (own[1:] != own[:-1]) | (windows[1:] != windows[:-1] + 1)
    new[np.searchsorted(windows, starts[starts < stops])] = True
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(windows)) - 1
    return windows[first], windows[last], own[first]


def segments(texts: pa.Array, length: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(bytes, rows, starts, offsets): stretches of about ``STEP`` bytes made of
    whole texts. A longer text comes in several, at fixed places of its own,
    which overlap by a window. ``starts`` has where a row's bytes begin, and
    one more; ``offsets`` where these are in its text. Short texts are left out.
    """
    raw = texts.cast(pa.large_binary())
    edges = np.frombuffer(raw.buffers()[1], np.int64)[raw.offset : raw.offset + len(raw) + 1]
    data = np.frombuffer(raw.buffers()[2] or b"", np.uint8)
    sizes = np.diff(edges)
    if raw.null_count:
        sizes = np.where(np.asarray(raw.is_valid()), sizes, 0)
    rows: list[tuple[int, int, int, int]] = []
    total = 0

    def ready() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        part = np.concatenate([data[a:b] for _, a, b, _ in rows])
        cuts = np.cumsum([0, *(b - a for _, a, b, _ in rows)])
        return part, np.array([r[0] for r in rows]), cuts, np.array([r[3] for r in rows])

    for row in np.flatnonzero(sizes >= length).tolist():
        begin, size = int(edges[row]), int(sizes[row])
        for at in range(0, size - length + 1, STEP):
            stop = min(size, at + STEP + length - 1)
            if rows and total + stop - at > STEP + length:
                yield ready()
                rows, total = [], 0
            rows.append((row, begin + at, begin + stop, at))
            total += stop - at
    if rows:
        yield ready()


def _row_key(df: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """(id, text_hash, text): rows with equal id and text are alike in every
    step, so the first two stand for a row."""
    return df.select(
        F.col(id_column).alias("id"), F.xxhash64(text_column).alias("text_hash"),
        F.col(text_column).alias("text"),
    )


def packed(text: Column) -> Column:
    """Texts compressed one by one, for a shuffle; null stays null."""

    @F.arrow_udf("binary")
    def pack(texts: pa.Array) -> pa.Array:
        press, raw = zstandard.ZstdCompressor(level=1).compress, texts.cast(pa.large_binary())
        return pa.array([press(t.as_buffer()) if t.is_valid else None for t in raw], pa.binary())

    return pack(text)


def unpacked(text: pa.Scalar) -> np.ndarray:
    raw = zstandard.ZstdDecompressor().decompress(text.as_buffer()) if text.is_valid else b""
    return np.frombuffer(raw, np.uint8)


def runs(rows: DataFrame, length: int) -> DataFrame:
    """(id, text_hash, first, last, anchor, whole): runs of windows that share
    their anchor, the anchor's bucket, and the bucket of the run's string."""
    kind = rows.schema["id"].dataType.simpleString()

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data, row, cuts, offsets in segments(batch.column(2), length):
                grams = eight_grams(data)
                gram = Buckets(grams, 0).at(GRAM)
                first, last, anchor = anchor_runs(gram, cuts[:-1], cuts[1:] - length + 1, length - GRAM + 1)
                whole = Buckets(grams, 1).spans(first, last - first + length, BLOCK)
                piece = np.searchsorted(cuts, first, side="right") - 1
                shift = offsets[piece] - cuts[piece]
                of_row = pa.array(row[piece])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(of_row), batch.column(1).take(of_row),
                     pa.array((first + shift).astype(np.int64)), pa.array((last + shift).astype(np.int64)),
                     pa.array(gram[anchor].view(np.int64)), pa.array(whole.view(np.int64))],
                    names=["id", "text_hash", "first", "last", "anchor", "whole"],
                )

    return rows.mapInArrow(
        find, f"id {kind}, text_hash bigint, first bigint, last bigint, anchor bigint, whole bigint"
    )


def contexts(rows: DataFrame, length: int) -> DataFrame:
    """(id, text_hash, first, anchor, known, company, string): the bytes of the
    runs listed in the column ``todo``, cut out of the packed texts."""
    kind = rows.schema["id"].dataType.simpleString()

    def cut(batch: pa.RecordBatch, strings: list[bytes]) -> pa.RecordBatch:
        todo = batch.column(3)
        flat = todo.flatten()
        of_row = pa.array(np.repeat(np.arange(len(batch)), np.diff(np.asarray(todo.offsets))))
        return pa.RecordBatch.from_arrays(
            [batch.column(0).take(of_row), batch.column(1).take(of_row), flat.field(0),
             flat.field(2), flat.field(3), flat.field(4), pa.array(strings, pa.binary())],
            names=["id", "text_hash", "first", "anchor", "known", "company", "string"],
        )

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Strings overlap, so a batch may hold more bytes of them than of
        texts; they go out in parts of some megabytes."""
        for batch in batches:
            texts, todo = batch.column(2), batch.column(3)
            strings: list[bytes] = []
            begin = total = 0
            for i in range(len(batch)):
                own, data = todo[i].values, unpacked(texts[i]).tobytes()
                fresh = [data[a : b + length] for a, b in zip(own.field(0).to_pylist(), own.field(1).to_pylist())]
                strings += fresh
                total += sum(map(len, fresh))
                if total > 16 * STEP:
                    yield cut(batch.slice(begin, i + 1 - begin), strings)
                    begin, total, strings = i + 1, 0, []
            if begin < len(batch):
                yield cut(batch.slice(begin), strings)

    return rows.select("id", "text_hash", "packed", "todo").mapInArrow(
        find, f"id {kind}, text_hash bigint, first bigint, anchor bigint, known boolean, company bigint, string binary"
    )


def _every_window(strings: pa.Array, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, offset, identifier) of the windows of all strings."""
    raw = strings.cast(pa.large_binary())
    edges = np.frombuffer(raw.buffers()[1], np.int64)[raw.offset : raw.offset + len(raw) + 1]
    data = np.frombuffer(raw.buffers()[2], np.uint8)[edges[0] : edges[-1]]
    sizes = np.diff(edges) - length + 1
    row = np.repeat(np.arange(len(sizes)), sizes)
    offset = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    ids = Buckets(eight_grams(data), 1).at(length)
    return row, offset, ids[np.repeat(edges[:-1] - edges[0], sizes) + offset]


def finer(strings: DataFrame, length: int, width: int) -> DataFrame:
    """The runs cut into blocks of up to ``width`` windows: rows of (id,
    text_hash, first, last, anchor, whole, known, string).

    Blocks lie at fixed distances from the anchor, so those of different runs
    line up. All windows of a block contain the same middle; the new bucket,
    again called ``anchor``, is refined by the middle's identifier, and ``whole``
    is that of the block's string.
    """
    kind = strings.schema["id"].dataType.simpleString()
    places = np.uint64((1 << PLACE_BITS) - 1)

    def blocks(key: int, text: bytes) -> list[tuple[int, int, int, int]]:
        """(first window, last window, bucket, whole) of the blocks of a run."""
        grams = eight_grams(np.frombuffer(text, np.uint8))
        gram, ids = Buckets(grams, 0).at(GRAM)[: length - GRAM + 1], Buckets(grams, 1)
        place = int(np.argmin((gram & ~places) | (places - np.arange(len(gram), dtype=np.uint64))))
        low = place - (len(text) - length)
        number = np.arange(low // width, place // width + 1)
        first = place - np.minimum(place, (number + 1) * width - 1)
        last = place - np.maximum(low, number * width)
        middle = ids.at(length - width + 1)[place - number * width]
        bucket = _mix(_mix(np.full(len(number), key).view(np.uint64), number.view(np.uint64), 0), middle, 0)
        whole = ids.spans(first, last - first + length, BLOCK)
        return list(zip(first.tolist(), last.tolist(), bucket.view(np.int64).tolist(), whole.view(np.int64).tolist()))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, out, text = [], [], []
            for i, (key, string) in enumerate(zip(batch.column("anchor").to_pylist(), batch.column("string").to_pylist())):
                for block in blocks(key, string):
                    rows.append(i)
                    out.append(block)
                    text.append(string[block[0] : block[1] + length])
            of_row = pa.array(rows, pa.int64())
            first, last, bucket, whole = (np.array([o[k] for o in out], np.int64) for k in range(4))
            start = batch.column("first").to_numpy()[np.array(rows, np.int64)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(of_row), batch.column("text_hash").take(of_row), pa.array(start + first),
                 pa.array(start + last), pa.array(bucket), pa.array(whole), batch.column("known").take(of_row),
                 pa.array(text, pa.binary())],
                names=["id", "text_hash", "first", "last", "anchor", "whole", "known", "string"],
            )

    return strings.select("id", "text_hash", "first", "anchor", "known", "string").mapInArrow(
        find, f"id {kind}, text_hash bigint, first bigint, last bigint, anchor bigint, whole bigint, "
        "known boolean, string binary"
    )


def _settled(rows: DataFrame, carried: list[str]) -> DataFrame:
    """Runs with their bucket's standing: ``twice`` if their whole string is
    there again, ``company`` as the number of different strings in the bucket,
    and ``goes_on`` if finer blocks must be looked at: runs neither repeated
    as a whole nor alone, and one that stands for those that are."""
    row = ["id", "text_hash", "first", "last"]
    wholes = written(
        rows.groupBy("anchor", "whole").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(*row)).alias("one")),
        "repeats-wholes",
    )
    company = wholes.groupBy("anchor").agg(F.count(F.lit(1)).alias("company"))
    counts = written(wholes.join(company, "anchor").where("n > 1 or company > 1"), "repeats-counts")
    stands = F.col("one").eqNullSafe(F.struct(*row)) | ((F.col("n") == 1) & ~F.col("known"))
    return rows.join(counts, ["anchor", "whole"]).select(
        *row, "anchor", "known", (F.col("n") > 1).alias("twice"), "company",
        (stands & (F.col("company") > 1)).alias("goes_on"), *carried,
    )


def compared(strings: DataFrame, length: int) -> DataFrame:
    """(id, text_hash, first, last): the repeated windows of the runs not known
    to be repeated; buckets are compared whole, each in one task."""
    kind = strings.schema["id"].dataType.simpleString()

    def ranges(rows: pa.RecordBatch) -> pa.RecordBatch:
        row, offset, ids = _every_window(rows.column("string"), length)
        bucket = _mix(rows.column("anchor").to_numpy().view(np.uint64)[row], ids, 0)
        order = np.argsort(bucket, kind="stable")
        ordered = bucket[order]
        same = ordered[1:] == ordered[:-1]
        twice = np.zeros(len(bucket), dtype=bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        hit = np.flatnonzero(twice & ~rows.column("known").to_numpy(zero_copy_only=False)[row])
        new = np.ones(len(hit), dtype=bool)
        new[1:] = (np.diff(hit) != 1) | (row[hit[1:]] != row[hit[:-1]])
        begin = hit[new]
        end = hit[np.append(np.flatnonzero(new)[1:], len(hit)) - 1] if len(hit) else hit
        of_row = pa.array(row[begin])
        start = rows.column("first").to_numpy()[row[begin]]
        return pa.RecordBatch.from_arrays(
            [rows.column("id").take(of_row), rows.column("text_hash").take(of_row),
             pa.array(start + offset[begin]), pa.array(start + offset[end])],
            names=["id", "text_hash", "first", "last"],
        )

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = None  # the last bucket may go on in the next batch
        for batch in batches:
            rows = batch if kept is None else pa.concat_batches([kept, batch])
            anchors = rows.column("anchor").to_numpy()
            cuts = [0, *(np.flatnonzero(anchors[1:] != anchors[:-1]) + 1).tolist()]
            begin = 0
            for cut_at in cuts:
                if cut_at - begin >= BUCKET_ROWS or cut_at == cuts[-1] > begin:
                    yield ranges(rows.slice(begin, cut_at - begin))
                    begin = cut_at
            kept = rows.slice(begin)
        if kept is not None and len(kept):
            yield ranges(kept)

    together = strings.repartition("anchor").sortWithinPartitions("anchor")
    return together.mapInArrow(find, f"id {kind}, text_hash bigint, first bigint, last bigint")


def _same_row(a: DataFrame, b: DataFrame) -> Column:
    return a["id"].eqNullSafe(b["id"]) & (a["text_hash"] == b["text_hash"])


def repeated_windows(rows: DataFrame, length: int) -> DataFrame:
    """(id, text_hash, first, last): ranges of windows that also stand elsewhere."""
    row = ["id", "text_hash", "first", "last"]
    every = runs(rows, length)
    # Buckets of anchors; those with company live on.
    anchors = written(
        every.groupBy("anchor").agg(
            F.count(F.lit(1)).alias("n"), F.min("whole").alias("low"), F.max("whole").alias("high")
        ).where("n > 1").select("anchor", F.expr("low <> high").alias("mixed")),
        "repeats-anchors",
    )
    live = written(every.join(anchors, "anchor").select(*row, "anchor", "whole", "mixed"), "repeats-live")
    found = live.where("not mixed").select(*row)

    settled = written(
        _settled(live.where("mixed").withColumn("known", F.lit(False)), []), "repeats-settled"
    )
    found = found.unionAll(settled.where("twice").select(*row))
    todo = (
        settled.where("goes_on").groupBy("id", "text_hash")
        .agg(F.collect_set(F.struct("first", "last", "anchor", F.col("twice").alias("known"), "company")).alias("todo"))
    )
    texts = rows.select("id", "text_hash", packed("text").alias("packed"))
    strings = written(
        contexts(texts.join(todo, _same_row(texts, todo)).select(texts["id"], texts["text_hash"], "packed", "todo"),
                 length),
        "repeats-strings",
    )
    for width in WIDTHS:
        found = found.unionAll(compared(strings.where(F.col("company") <= BUCKET_ROWS), length))
        large = strings.where(F.col("company") > BUCKET_ROWS)
        if large.isEmpty():
            break
        blocks = written(finer(large, length, width), "repeats-blocks")
        settled = written(_settled(blocks, ["string"]), "repeats-settled")
        found = found.unionAll(settled.where("twice and not known").select(*row))
        strings = settled.where("goes_on").select(
            "id", "text_hash", "first", "anchor", (F.col("twice") | F.col("known")).alias("known"), "company", "string"
        )
    return found


def removed_spans(docs: DataFrame, length: int, id_column: str, text_column: str) -> tuple[DataFrame, DataFrame]:
    """The rows as (id, text_hash, text), and their ranges of windows to remove
    as (id, text_hash, ranges)."""
    rows = _row_key(docs, id_column, text_column)
    ranges = (
        repeated_windows(rows, length).groupBy("id", "text_hash")
        .agg(F.collect_set(F.struct("first", "last")).alias("ranges"))
    )
    return rows, ranges


def merged(first: np.ndarray, last: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(starts, stops): the maximal runs of bytes that the windows cover."""
    order = np.argsort(first, kind="stable")
    starts, stops = first[order], np.maximum.accumulate(last[order] + length) if len(order) else last
    new = np.ones(len(starts), dtype=bool)
    new[1:] = starts[1:] > stops[:-1]
    at = np.flatnonzero(new)
    return starts[at], stops[np.append(at[1:], len(starts)) - 1] if len(at) else stops


def cut(data: np.ndarray, ranges: pa.Scalar, length: int) -> tuple[bytes, int, int, int]:
    """What is left of a text, its bytes, the bytes removed, the spans removed."""
    if not ranges.is_valid:
        return data.tobytes(), len(data), 0, 0
    first, last = (ranges.values.field(k).to_numpy(zero_copy_only=False) for k in (0, 1))
    starts, stops = merged(first, last, length)
    edges = np.zeros(len(data) + 1, dtype=np.int8)
    edges[starts] += 1
    edges[stops] -= 1
    keep = np.cumsum(edges[:-1], dtype=np.int8) == 0
    return data[keep].tobytes(), len(data), int((stops - starts).sum()), len(starts)


def removals(docs: DataFrame, length: int = 200, id_column: str = "doc_id",
             text_column: str = "text") -> DataFrame:
    """Per row: id, n_bytes, n_removed, n_spans (maximal removed runs) and
    kept_sha256, the digest of the remaining bytes."""
    kind = docs.schema[id_column].dataType.simpleString()

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, ranges = batch.column(1), batch.column(2)
            out = [cut(unpacked(texts[i]), ranges[i], length) for i in range(len(batch))]
            numbers = [pa.array([o[k] for o in out], pa.int64()) for k in (1, 2, 3)]
            sha = pa.array([hashlib.sha256(o[0]).hexdigest() for o in out], pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *numbers, sha], names=["id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
            )

    rows, ranges = removed_spans(docs, length, id_column, text_column)
    texts = rows.select("id", "text_hash", packed("text").alias("packed"))
    return (
        texts.join(ranges, _same_row(texts, ranges), "left").select(texts["id"], "packed", "ranges")
        .mapInArrow(digest, f"id {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string")
        .withColumnRenamed("id", id_column)
    )


def remove_repeats(docs: DataFrame, length: int = 200, id_column: str = "doc_id",
                   text_column: str = "text") -> DataFrame:
    """The rows with the repeated bytes gone from their text, all other columns
    as they were. Where a cut falls inside a character, its remaining bytes are
    dropped, so that the text stays UTF-8. Null texts stay null."""
    row_hash, own = free_name(docs, "text_hash"), free_name(docs, "ranges")
    _, ranges = removed_spans(docs, length, id_column, text_column)
    ranges = ranges.select(F.col("id").alias(free_name(docs, "row_id")), F.col("text_hash").alias(row_hash),
                           F.col("ranges").alias(own))
    joined = docs.join(
        ranges,
        docs[id_column].eqNullSafe(ranges[ranges.columns[0]])
        & (F.xxhash64(docs[text_column]) == ranges[row_hash]),
        "left",
    )

    @F.arrow_udf("string")
    def left_over(texts: pa.Array, spans: pa.Array) -> pa.Array:
        parts = []
        for at in range(0, len(texts), 250):
            raw, own_spans = texts.slice(at, 250).cast(pa.large_binary()), spans.slice(at, 250)
            parts.append(pa.array(
                [cut(np.frombuffer(t.as_buffer(), np.uint8), r, length)[0].decode("utf-8", "ignore")
                 if t.is_valid else None for t, r in zip(raw, own_spans)], pa.string()
            ))
        return pa.concat_arrays(parts or [pa.array([], pa.string())])

    text = F.when(F.col(own).isNull(), docs[text_column]).otherwise(left_over(docs[text_column], F.col(own)))
    return joined.select(*[text.alias(c) if c == text_column else docs[c] for c in docs.columns])
