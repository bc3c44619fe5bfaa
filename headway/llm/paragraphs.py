"""Near-duplicate paragraphs by MinHash banding and exact Jaccard.

A text's paragraphs are its lines of ``min_words`` words or more; equal ones are
found by their words' hash. Each paragraph of ``size`` words or more is a set of
word shingles, with one minimum for each of ``bands`` x ``rows`` hash functions; paragraphs with all minima of a band equal collide. For a
similarity of 0.8 the chance of colliding in none of 12 bands of 4 is
(1 - 0.8 ** 4) ** 12 = 0.2 %, see ``recall``.

Equal paragraphs (by words) are one node. Colliding ones are linked if the
exact Jaccard similarity of their shingles is ``similarity`` or more, and
connected components of links are classes. Of a class the first occurrence (by
document id, then place) stays, the others are removals. Lines of less than a
whole shingle ("}", "of.") are classes if they are equal, but stay: alone they are no
passage, and together with their neighbours they are found by windows.

Not all pairs of a bucket are compared: each member is compared with the bucket's
smallest, and what is then in one component needs no more. Only buckets that
still hold several components are compared across these, in blocks of at most
``BLOCK_ROWS`` paragraphs against each other, so no task gets a whole large
bucket and nothing but links leaves a task. No collision between different
components goes unverified.

Passages that stand inside otherwise different lines are sought in what stays,
whatever the lines: of each ``ANCHOR_SPAN`` neighbouring places the one with the
smallest hash of its words is an anchor, and the ``PASSAGE_WORDS`` words from an
anchor on are a window. Equal windows are a class, of which the first occurrence
stays and the words of the others are cut out of their lines. Copies of a passage
share the anchors inside it, so one of ``PASSAGE_WORDS + ANCHOR_SPAN - 1`` words
or more is always found, but for at most ``ANCHOR_SPAN - 1`` words at either end.
A window that overlaps the first of its class stays.

Words are runs of characters other than ASCII white space, A-Z lowered. A
paragraph of fewer words than a shingle is one shingle of its whole, so only an
equal one is similar to it. Null and
empty texts have no paragraphs. Rows that repeat an id are documents of their
own; of equal ids the smaller text hash comes first, null ids come last. Rows
equal in id and text are one occurrence and share their fate.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.llm.components import components
from headway.llm.frames import batch_parts, free_name, written

#: Most paragraphs of a block when a bucket is compared across components.
BLOCK_ROWS = 512
#: Words of a window, and the places of which one is an anchor.
PASSAGE_WORDS, ANCHOR_SPAN = 20, 12
#: Words whose hash makes a place an anchor.
ANCHOR_WORDS = 3
#: Odd multiplier that spreads hash values.
SPREAD = np.uint64(0x9E3779B97F4A7C15)


def recall(similarity: float, bands: int, rows: int) -> float:
    """Chance that two paragraphs of this similarity collide in some band."""
    return 1 - (1 - similarity**rows) ** bands


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(map(xxhash.xxh64_digest, words)), dtype=">u8").astype(np.uint64)


def shingles(words: list[bytes], size: int) -> np.ndarray:
    """Distinct shingle hashes, ascending."""
    if len(words) < size:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words))], dtype=np.uint64)
    one = word_hashes(words)
    n = len(one) - size + 1
    out = one[:n].copy()
    for k in range(1, size):
        out = (out ^ (out >> np.uint64(31))) * SPREAD + one[k : k + n]
    return np.unique(out ^ (out >> np.uint64(29)))


def minima(sets: list[np.ndarray], count: int) -> np.ndarray:
    """(set, function): the minimum of each of ``count`` hash functions."""
    random = np.random.default_rng(11)
    factors = random.integers(0, 1 << 63, count, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    flat = np.concatenate(sets)
    starts = np.cumsum([0, *map(len, sets)])[:-1]
    out = np.empty((len(sets), count), dtype=np.uint64)
    for k in range(count):
        mixed = flat * factors[k]
        mixed ^= mixed >> np.uint64(32)
        mixed *= SPREAD
        out[:, k] = np.minimum.reduceat(mixed, starts)
    return out


def band_keys(low: np.ndarray, bands: int) -> np.ndarray:
    """(set, band): one value for the minima of each band, band included."""
    rows = low.shape[1] // bands
    out = np.empty((len(low), bands), dtype=np.uint64)
    for b in range(bands):
        key = np.full(len(low), b + 1, dtype=np.uint64)
        for r in range(b * rows, (b + 1) * rows):
            key = (key ^ (key >> np.uint64(31))) * SPREAD + low[:, r]
        out[:, b] = key
    return out.view(np.int64)


def paragraph_words(text: bytes) -> Iterator[tuple[int, bytes, list[bytes]]]:
    """(place, paragraph, words) of every line, places from 0."""
    for place, line in enumerate(text.split(b"\n")):
        yield place, line, line.lower().split()


def _texts(batch: pa.RecordBatch, column: int) -> Iterator[tuple[int, bytes]]:
    at = 0
    for part in batch_parts(batch.column(column)):
        for text in part.to_pylist():
            yield at, (text or "").encode()
            at += 1


def _content(words: list[bytes]) -> int:
    return xxhash.xxh3_64_intdigest(b" ".join(words))


def occurrences(docs: DataFrame, min_words: int, size: int, bands: int, rows: int) -> DataFrame:
    """(id, text_hash, place, paragraph, short, keys): the paragraphs long enough;
    equal words have equal numbers. ``short`` are those of less than one whole
    shingle. The others have their band keys in ``keys`` where they are first
    met in a batch; elsewhere it is empty. ``docs`` has the columns id and text."""
    kind = docs.schema["id"].dataType.simpleString()

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def ready(batch, found, signed, sets) -> pa.RecordBatch:
            row, place, content, short = zip(*found)
            of_row = pa.array(row, pa.int64())
            lengths = np.zeros(len(found) + 1, dtype=np.int32)
            lengths[np.array(signed, dtype=np.int64) + 1] = bands
            keys = band_keys(minima(sets, bands * rows), bands).ravel() if sets else np.empty(0, dtype=np.int64)
            return pa.RecordBatch.from_arrays(
                [batch.column(0).take(of_row), batch.column(1).take(of_row), pa.array(place, pa.int32()),
                 pa.array(np.array(content, dtype=np.uint64).view(np.int64)), pa.array(short, pa.bool_()),
                 pa.ListArray.from_arrays(pa.array(np.cumsum(lengths, dtype=np.int32)), pa.array(keys))],
                names=["id", "text_hash", "place", "paragraph", "short", "keys"],
            )

        for batch in batches:
            seen: set[int] = set()
            found, signed, sets, total = [], [], [], 0
            for i, text in _texts(batch, 2):
                for p, _, words in paragraph_words(text):
                    if len(words) < min_words:
                        continue
                    content, short = _content(words), len(words) < size
                    total += 1
                    if not short and content not in seen:
                        seen.add(content)
                        signed.append(len(found))
                        sets.append(shingles(words, size))
                        total += len(words)
                    found.append((i, p, content, short))
                    if total > 1 << 18:
                        yield ready(batch, found, signed, sets)
                        found, signed, sets, total = [], [], [], 0
            if found:
                yield ready(batch, found, signed, sets)

    return docs.select("id", "text_hash", "text").mapInArrow(
        find, f"id {kind}, text_hash bigint, place int, paragraph bigint, short boolean, keys array<bigint>"
    )


def shingle_sets(docs: DataFrame, wanted: DataFrame, min_words: int, size: int) -> DataFrame:
    """(paragraph, shingles) of the wanted paragraphs, one row each; ``wanted``
    has (id, text_hash, paragraph), one occurrence of each."""
    asked = wanted.groupBy("id", "text_hash").agg(F.collect_set("paragraph").alias("asked"))
    rows = docs.join(
        asked, docs["id"].eqNullSafe(asked["id"]) & (docs["text_hash"] == asked["text_hash"])
    ).select("asked", "text")

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            content, sets = [], []
            for i, text in _texts(batch, 1):
                left = set(batch.column(0)[i].values.to_numpy().view(np.uint64).tolist())
                for _, _, words in paragraph_words(text):
                    if len(words) >= min_words and (c := _content(words)) in left:
                        left.discard(c)
                        content.append(c)
                        sets.append(shingles(words, size).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.array(content, dtype=np.uint64).view(np.int64)), pa.array(sets, pa.list_(pa.int64()))],
                names=["paragraph", "shingles"],
            )

    return rows.mapInArrow(find, "paragraph bigint, shingles array<bigint>").dropDuplicates(["paragraph"])


def jaccard(a: Column, b: Column) -> Column:
    """Exact Jaccard similarity of two columns of distinct ascending numbers."""

    @F.arrow_udf("double")
    def of(left: pa.Array, right: pa.Array) -> pa.Array:
        out = []
        for x, y in zip(left, right):
            x, y = x.values.to_numpy(), y.values.to_numpy()
            both = len(np.intersect1d(x, y, assume_unique=True))
            out.append(both / (len(x) + len(y) - both))
        return pa.array(out, pa.float64())

    return of(a, b)


def _across(residue: DataFrame, similarity: float) -> DataFrame:
    """(a, b): links between paragraphs of different components of a bucket.
    ``residue`` has (key, n, root, paragraph, shingles)."""
    blocks = F.ceil(F.col("n") / BLOCK_ROWS)
    own = F.pmod(F.xxhash64("paragraph"), blocks)
    # Every block meets every other, and itself.
    dealt = residue.select(
        "key", "root", "paragraph", "shingles", own.alias("block"),
        F.explode(F.sequence(F.lit(0).cast("bigint"), blocks - 1)).alias("other"),
    ).select("key", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
             "root", "paragraph", "shingles")

    def compare(rows: pa.Table) -> pa.Table:
        names = rows.column("paragraph").to_pylist()
        parent = {r: r for r in set(rows.column("root").to_pylist())}
        roots, sets = rows.column("root").to_pylist(), [s.values.to_numpy() for s in rows.column("shingles")]

        def top(r):
            while parent[r] != r:
                parent[r] = parent[parent[r]]
                r = parent[r]
            return r

        a, b = [], []
        order = np.argsort([len(s) for s in sets], kind="stable").tolist()
        for at, i in enumerate(order):
            for j in order[at + 1 :]:
                if len(sets[i]) < similarity * len(sets[j]):
                    break  # no longer set can be similar enough
                if top(roots[i]) != top(roots[j]):
                    both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                    if both >= similarity * (len(sets[i]) + len(sets[j]) - both):
                        parent[top(roots[i])] = top(roots[j])
                        a.append(names[i])
                        b.append(names[j])
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return dealt.groupBy("key", "low", "high").applyInArrow(compare, "a bigint, b bigint")


def classes(docs: DataFrame, found: DataFrame, min_words: int, size: int, similarity: float) -> DataFrame:
    """(paragraph, class) of the paragraphs linked to a different one; ``found``
    are the occurrences."""
    members = found.select("paragraph", F.explode("keys").alias("key"))
    # A paragraph may be here once for each batch, so a bucket counts by what differs.
    buckets = written(
        members.groupBy("key").agg(F.min("paragraph").alias("least"), F.max("paragraph").alias("most"))
        .where("least < most").select("key", "least"),
        "paragraph-buckets",
    )
    together = written(members.join(buckets, "key").distinct(), "paragraph-collisions")
    # Of equal paragraphs, only those with keys: one for each batch.
    wanted = found.where("size(keys) > 0").join(together.select("paragraph").distinct(), "paragraph").groupBy("paragraph").agg(
        F.min(F.struct("id", "text_hash")).alias("at")
    ).select("at.*", "paragraph")
    sets = written(shingle_sets(docs, wanted, min_words, size), "paragraph-shingles")

    pairs = together.where("paragraph <> least").select(F.col("least").alias("a"), F.col("paragraph").alias("b")).distinct()
    left = sets.select(F.col("paragraph").alias("a"), F.col("shingles").alias("of_a"))
    right = sets.select(F.col("paragraph").alias("b"), F.col("shingles").alias("of_b"))
    # Sizes alone rule out most chance collisions.
    near = pairs.join(left, "a").join(right, "b").where(
        (F.size("of_a") >= similarity * F.size("of_b")) & (F.size("of_b") >= similarity * F.size("of_a"))
    )
    stars = written(near.where(jaccard(F.col("of_a"), F.col("of_b")) >= similarity).select("a", "b"), "paragraph-links")
    roots = written(components(stars, "paragraph-components"), "paragraph-roots")

    labelled = together.join(roots.withColumnRenamed("node", "paragraph"), "paragraph", "left").select(
        "key", "paragraph", F.coalesce("root", "paragraph").alias("root")
    )
    several = labelled.groupBy("key").agg(
        F.count(F.lit(1)).alias("n"), F.min("root").alias("low"), F.max("root").alias("high")
    ).where("low <> high")
    residue = labelled.join(several.select("key", "n"), "key").join(sets, "paragraph")
    more = written(_across(residue, similarity), "paragraph-links")
    every = components(stars.unionAll(more), "paragraph-components")
    return every.select(F.col("node").alias("paragraph"), F.col("root").alias("class"))


def repeated(docs: DataFrame, min_words: int = 20, size: int = 5, similarity: float = 0.8, bands: int = 12,
             rows: int = 4, id_column: str = "doc_id", text_column: str = "text") -> tuple[DataFrame, DataFrame]:
    """The documents as (id, text_hash, text), and their paragraphs of classes
    with more than one occurrence: (id, text_hash, place, class, short, stays)."""
    own = docs.select(F.col(id_column).alias("id"), F.xxhash64(text_column).alias("text_hash"),
                      F.col(text_column).alias("text"))
    found = written(occurrences(own, min_words, size, bands, rows), "paragraph-occurrences")
    named = found.join(classes(own, found, min_words, size, similarity), "paragraph", "left").select(
        "id", "text_hash", "place", "short", F.coalesce("class", "paragraph").alias("class")
    )
    first = F.struct(F.col("id").isNull().alias("none"), "id", "text_hash", "place")
    heads = written(
        named.groupBy("class").agg(F.count(F.lit(1)).alias("n"), F.min(first).alias("head")).where("n > 1"),
        "paragraph-heads",
    )
    return own, named.join(heads, "class").select(
        "id", "text_hash", "place", "class", "short", (F.col("short") | F.col("head").eqNullSafe(first)).alias("stays")
    )


def windows(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(place, hash) of the windows of a text's words; hashes as signed numbers."""
    if len(words) < PASSAGE_WORDS:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    one = word_hashes(words)
    n = len(one) - ANCHOR_WORDS + 1
    near = one[:n].copy()
    for k in range(1, ANCHOR_WORDS):
        near = (near ^ (near >> np.uint64(31))) * SPREAD + one[k : k + n]
    near = (near ^ (near >> np.uint64(29))) * SPREAD
    spans = np.lib.stride_tricks.sliding_window_view(near, ANCHOR_SPAN)
    at = np.unique(spans.argmin(axis=1) + np.arange(len(spans)))
    at = at[at <= len(one) - PASSAGE_WORDS]
    out = one[at]
    for k in range(1, PASSAGE_WORDS):
        out = (out ^ (out >> np.uint64(31))) * SPREAD + one[at + k]
    return at, (out ^ (out >> np.uint64(29))).view(np.int64)


def passages(own: DataFrame, marked: DataFrame) -> DataFrame:
    """(id, text_hash, at, passage, stays): the windows that stand more than once
    in the texts without their removed lines; ``at`` counts the words left."""
    kind = own.schema["id"].dataType.simpleString()

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, place, content = [np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0, np.int64)]
            for i, text in _texts(batch, 2):
                gone = batch.column(3)[i].as_py()
                at, hashes = windows((_without(text, set(gone)) if gone else text).lower().split())
                row.append(np.full(len(at), i))
                place.append(at)
                content.append(hashes)
            of_row = pa.array(np.concatenate(row))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(of_row), batch.column(1).take(of_row),
                 pa.array(np.concatenate(place).astype(np.int32)), pa.array(np.concatenate(content))],
                names=["id", "text_hash", "at", "passage"],
            )

    gone = marked.where("not stays").groupBy("id", "text_hash").agg(F.collect_set("place").alias("removed"))
    rows = _with_row(own, gone, ["removed"]).select("id", "text_hash", "text", "removed")
    found = written(rows.mapInArrow(find, f"id {kind}, text_hash bigint, at int, passage bigint"), "paragraph-windows")
    # Both grouped sides are written, so that the joins can split a hot window.
    several = written(
        found.groupBy("passage").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("passage"), "paragraph-several"
    )
    again = written(found.join(several, "passage"), "paragraph-repeats")
    first = F.struct(F.col("id").isNull().alias("none"), "id", "text_hash", "at")
    # Rows equal in id and text are one occurrence.
    heads = written(again.groupBy("passage").agg(F.min(first).alias("head"), F.max(first).alias("last")).where(
        ~F.col("head").eqNullSafe(F.col("last"))
    ), "paragraph-windows-first")
    same = F.col("head.id").eqNullSafe(F.col("id")) & (F.col("head.text_hash") == F.col("text_hash"))
    return written(again.join(heads, "passage").select(
        "id", "text_hash", "at", "passage", (same & (F.col("at") - F.col("head.at") < PASSAGE_WORDS)).alias("stays")
    ), "paragraph-passages")


def _with_row(own: DataFrame, asked: DataFrame, names: list[str]) -> DataFrame:
    return own.join(
        asked, own["id"].eqNullSafe(asked["id"]) & (own["text_hash"] == asked["text_hash"]), "left"
    ).select(own["id"], own["text_hash"], "text", *names)


def _marks(marked: DataFrame, spans: DataFrame) -> DataFrame:
    """(id, text_hash, marks, spans): of lines and of windows, a row for each text
    that has some."""
    mark, span = F.struct("place", "class", "short", "stays"), F.struct("at", "passage", "stays")
    both = marked.select("id", "text_hash", mark.alias("mark")).unionByName(
        spans.select("id", "text_hash", span.alias("span")), allowMissingColumns=True
    )
    return both.groupBy("id", "text_hash").agg(
        F.collect_set("mark").alias("marks"), F.collect_set("span").alias("spans")
    )


def _gone(marks: str, name: str) -> Column:
    """Places of the lines or windows that don't stay, ascending."""
    places = F.array_sort(F.transform(F.filter(marks, lambda m: ~m["stays"]), lambda m: m[name]))
    return F.coalesce(places, F.array().cast("array<int>"))


def _without(text: bytes, places: set[int]) -> bytes:
    return b"\n".join(line for place, line, _ in paragraph_words(text) if place not in places)


def _cut(text: bytes, starts: list[int]) -> bytes:
    """The text without the windows at ``starts``, ascending, and the white space
    inside them."""
    bounds = [m.span() for m in re.finditer(rb"\S+", text)]
    out, kept = [], 0
    for at in starts:
        out.append(text[kept : max(kept, bounds[at][0])])
        kept = bounds[at + PASSAGE_WORDS - 1][1]
    return b"".join([*out, text[kept:]])


def _left(text: str | None, places: list[int] | None, starts: list[int] | None) -> bytes:
    data = (text or "").encode()
    data = _without(data, set(places)) if places else data
    return _cut(data, starts) if starts else data


def kept_text(text: Column, places: Column, starts: Column) -> Column:
    """The text without the lines at ``places`` and then without the windows at
    ``starts``; null stays null."""

    @F.arrow_udf("string")
    def of(texts: pa.Array, removed: pa.Array, cut: pa.Array) -> pa.Array:
        rows = zip(texts.to_pylist(), removed.to_pylist(), cut.to_pylist())
        return pa.array([_left(t, r, c).decode() if t is not None and (r or c) else t for t, r, c in rows], pa.string())

    return of(text, places, starts)


def report(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", **settings) -> DataFrame:
    """Per row: id, n_paragraphs (lines), n_repeated (those of a class with more
    than one occurrence), n_removed, classes (ascending, of lines of a whole shingle or
    more and of windows), short_classes (of shorter lines), removed (places), kept_sha256 of the text without the removed lines and the
    words cut, n_passages (windows of a class in the lines that stay) and n_cut
    (words cut out of these)."""
    own, marked = repeated(docs, id_column=id_column, text_column=text_column, **settings)
    marked = written(marked, "paragraph-marks")
    rows = _with_row(own, _marks(marked, passages(own, marked)), ["marks", "spans"])
    places, starts = _gone("marks", "place"), _gone("spans", "at")
    lines = F.transform(F.filter("marks", lambda m: ~m["short"]), lambda m: m["class"])
    found = F.concat(lines, F.transform("spans", lambda m: m["passage"]))
    brief = F.transform(F.filter("marks", lambda m: m["short"]), lambda m: m["class"])
    covered = F.flatten(F.transform(starts, lambda at: F.sequence(at, at + PASSAGE_WORDS - 1)))

    @F.arrow_udf("string")
    def digest(texts: pa.Array, removed: pa.Array, cut: pa.Array) -> pa.Array:
        parts = zip(texts.to_pylist(), removed.to_pylist(), cut.to_pylist())
        return pa.array([hashlib.sha256(_left(*p)).hexdigest() for p in parts], pa.string())

    text = F.coalesce("text", F.lit(""))
    return rows.select(
        F.col("id").alias(id_column),
        F.when(text == "", 0).otherwise(F.size(F.split(text, "\n"))).cast("bigint").alias("n_paragraphs"),
        F.coalesce(F.size("marks"), F.lit(0)).cast("bigint").alias("n_repeated"),
        F.size(places).cast("bigint").alias("n_removed"),
        F.coalesce(F.array_sort(F.array_distinct(found)), F.array().cast("array<bigint>")).alias("classes"),
        F.coalesce(F.array_sort(F.array_distinct(brief)), F.array().cast("array<bigint>")).alias("short_classes"),
        places.alias("removed"), digest("text", places, starts).alias("kept_sha256"),
        F.coalesce(F.size("spans"), F.lit(0)).cast("bigint").alias("n_passages"),
        F.size(F.array_distinct(covered)).cast("bigint").alias("n_cut"),
    )


def remove_repeats(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", **settings) -> DataFrame:
    """The rows with removed paragraphs and cut passages gone from their text,
    other columns as they were."""
    own, marked = repeated(docs, id_column=id_column, text_column=text_column, **settings)
    marked = written(marked, "paragraph-marks")
    key, other, places, starts = (free_name(docs, n) for n in ("row_id", "row_text", "removed", "cut"))
    asked = _marks(marked.where("not stays"), passages(own, marked).where("not stays")).select(
        F.col("id").alias(key), F.col("text_hash").alias(other),
        _gone("marks", "place").alias(places), _gone("spans", "at").alias(starts),
    )
    joined = docs.join(
        asked, docs[id_column].eqNullSafe(asked[key]) & (F.xxhash64(docs[text_column]) == asked[other]), "left"
    )
    text = kept_text(docs[text_column], F.col(places), F.col(starts)).alias(text_column)
    return joined.select(*[text if c == text_column else docs[c] for c in docs.columns])
