"""Spelling variants: words one edit apart, joined on asymmetric chunks.

Of two words that differ by one inserted, deleted or replaced code point, call the
shorter (or, of one length, either) *r* and the other *s*. r gives two disjoint
chunks, its halves. One edit lies in one of the halves, so the other chunk stands in s: the
first half where it stands in r, the second half as far back as s is longer, that is
within a shift of one. s gives its positional grams; only those at a place that a
chunk of a word of its length, or one less, can shift to, can meet a chunk, so only
these are made. Words meet by an equi-join on (length of r, place, gram), and a
Levenshtein distance of exactly one is verified for each pair that meets.

A chunk that many words share is not joined. The same argument holds for what the
chunk leaves open: an edit spares one half of the gap, so a group with more than
``GROUP_PAIRS`` pairs is split by the chunk and either half of the gap, again and
again until groups are small or the gap is one code point, which bounds a group by the
alphabet. Groups are split the same way at every size and no pair is lost.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.llm.frames import batch_parts, written

#: Pairs that one group of a shared chunk may compare.
GROUP_PAIRS = 4_096
#: Different words a task counts before it hands the counts on.
COUNTED = 200_000

# Letters of the contract are the code points of ISO 8859-1 that stay here; A-Z become
# lower case, all else, and whatever the encoding lacks, becomes a blank.
_LETTERS = bytes(
    c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 0xC0 else 32 for c in range(256)
)

#: A word of a document, as ISO 8859-1, to the word that counts in its place.
Altered = Callable[[object, bytes], bytes]


def letter_runs(text: str) -> list[bytes]:
    """Maximal runs of A-Z, a-z and U+00C0 to U+00FF, A-Z in lower case, as ISO 8859-1."""
    return text.encode("latin-1", "replace").translate(_LETTERS).split()


def letter_dropper(every: int) -> Altered:
    """Let h be the CRC-32 of ``id:word`` in UTF-8. Where ``every`` divides h, the word
    without its code point h % length. Rows without an id keep all letters."""
    last: list = [None, 0]

    def altered(key: object, word: bytes) -> bytes:
        if key is None:
            return word
        if key != last[0]:
            last[:] = key, zlib.crc32(f"{key}:".encode())
        h = zlib.crc32(word if word.isascii() else word.decode("latin-1").encode(), last[1])
        if h % every:
            return word
        place = h % len(word)
        return word[:place] + word[place + 1 :]

    return altered


def word_counts(docs: DataFrame, min_length: int = 6, min_count: int = 5, altered: Altered | None = None,
                id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(word, n): words of at least ``min_length`` code points and their occurrences, if
    at least ``min_count``. Tasks add up what they read, so a word that is everywhere is
    a row for each task."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[bytes] = Counter()

        def out() -> pa.RecordBatch:
            found = pa.RecordBatch.from_arrays(
                [pa.array([w.decode("latin-1") for w in total], pa.string()),
                 pa.array(list(total.values()), pa.int64())],
                names=["word", "n"],
            )
            total.clear()
            return found

        for batch in batches:
            at = 0
            for part in batch_parts(batch.column(1)):
                keys = batch.column(0).slice(at, len(part)).to_pylist()
                for key, text in zip(keys, part.to_pylist()):
                    own = [w for w in letter_runs(text or "") if len(w) >= min_length]
                    if altered is None:
                        total.update(own)
                        continue
                    for word, n in Counter(own).items():
                        total[altered(key, word)] += n
                at += len(part)
                if len(total) > COUNTED:
                    yield out()
        yield out()

    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    counts = rows.mapInArrow(count, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    return counts.where((F.length("word") >= min_length) & (F.col("n") >= min_count))


def _chunk(before: Column, behind: Column) -> Column:
    """The code points ``before`` the gap and ``behind`` it."""
    word = F.col("word")
    tail = F.length(word) - behind + 1
    return F.concat_ws("|", F.substring(word, F.lit(1), before), F.substring(word, tail, behind))


def _halves(before: Column, behind: Column, length: Column) -> Column:
    """(before, behind) with one half of the gap, or the other, closed."""
    gap = length - before - behind
    half = F.floor(gap / 2).cast("int")
    return F.array(
        F.struct((before + half).alias("before"), behind.alias("behind")),
        F.struct(before.alias("before"), (behind + gap - half).alias("behind")),
    )


def _met(words: DataFrame) -> DataFrame:
    """(r, r_n, s, s_n): pairs that share a chunk, from groups of bounded size."""
    # Each word is r for its own length, s for words of its length or one less.
    length = F.length("word")
    sides = F.array(
        F.struct(F.lit(True).alias("r"), length.alias("of")),
        F.struct(F.lit(False).alias("r"), length.alias("of")),
        F.struct(F.lit(False).alias("r"), (length - 1).alias("of")),
    )
    rows = words.select("word", "n", F.explode(sides).alias("side")).select("word", "n", "side.r", "side.of")
    before, behind = F.lit(0), F.lit(0)
    key = ["of", "before", "behind", "chunk"]
    ready: DataFrame | None = None
    while True:
        split = rows.select("word", "n", "r", "of", F.explode(_halves(before, behind, F.col("of"))).alias("part"))
        rows = split.select(
            "word", "n", "r", "of", "part.before", "part.behind",
            _chunk(F.col("part.before"), F.col("part.behind")).alias("chunk"),
        ).distinct()
        sizes = rows.groupBy(*key).agg(
            F.count_if("r").alias("of_r"), F.count_if(~F.col("r")).alias("of_s")
        ).where("of_r >= 1 and of_s >= 2")
        rows = written(rows.join(sizes, key), "variant-chunks")
        small = (F.col("of_r") * F.col("of_s") <= GROUP_PAIRS) | (F.col("of") - F.col("before") - F.col("behind") <= 1)
        done = rows.where(small).drop("of_r", "of_s")
        ready = done if ready is None else ready.unionAll(done)
        rows = rows.where(~small).drop("of_r", "of_s")
        if rows.isEmpty():
            break
        before, behind = F.col("before"), F.col("behind")
    left = ready.where("r").select(*key, F.col("word").alias("r"), F.col("n").alias("r_n"))
    right = ready.where("not r").select(*key, F.col("word").alias("s"), F.col("n").alias("s_n"))
    return left.join(right, key).select("r", "r_n", "s", "s_n")


def near_pairs(words: DataFrame) -> DataFrame:
    """(r, r_n, s, s_n): all pairs of words one edit apart, each once, the shorter or
    smaller word first. ``words`` has a row (word, n) for each word."""
    ordered = (F.length("r") < F.length("s")) | (F.col("r") < F.col("s"))
    return _met(words).where(ordered & (F.levenshtein("r", "s", 1) == 1)).distinct()


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of rows (word, form): the word where following forms ends. Each round
    doubles the steps taken. Forms must lead to no circle."""
    found = written(forms.select("word", F.col("form").alias("root")), "variant-roots")
    while True:
        on = found.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = found.join(on, "root")
        if moved.isEmpty():
            return found
        found = written(
            found.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root")), "variant-roots"
        )


def group(words: DataFrame, ratio: int = 5) -> DataFrame:
    """Per word: ``word``, ``n``, ``n_near`` (words one edit apart, 0 if none), ``form``
    and ``form_n`` (the near word of largest n, ties to the first in code-point order, if
    it has at least ``ratio`` times the word's n, else null), ``root`` (where forms lead).

    ``words`` has a row (word, n) for each word; a table without rows gives none.
    """
    words = written(words.select("word", "n"), "variant-words")
    pairs = written(near_pairs(words), "variant-pairs")
    both = pairs.select(F.col("r").alias("word"), F.col("s").alias("near"), F.col("s_n").alias("near_n")).unionAll(
        pairs.select(F.col("s").alias("word"), F.col("r").alias("near"), F.col("r_n").alias("near_n"))
    )
    best = both.groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("n"), "near")).alias("best")
    )
    chosen = F.col("best.n") <= -ratio * F.col("n")
    found = written(
        words.join(best, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"),
            F.when(chosen, F.col("best.near")).alias("form"),
            F.when(chosen, -F.col("best.n")).alias("form_n"),
        ),
        "variant-forms",
    )
    ends = roots(found.where("form is not null"))
    return found.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def spelling_variants(docs: DataFrame, min_length: int = 6, min_count: int = 5, ratio: int = 5,
                      altered: Altered | None = None, id_column: str = "doc_id",
                      text_column: str = "text") -> DataFrame:
    """``group`` over the words of whole texts. Null and empty texts have no words; rows
    that repeat an id count one by one. ``ratio`` must be above 1, so that forms
    lead upwards."""
    return group(word_counts(docs, min_length, min_count, altered, id_column, text_column), ratio)
