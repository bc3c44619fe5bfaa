"""Periodic runs of words: squares caught online over dyadic blocks.

A run is a stretch of words with a smallest period q that neither neighbour
extends, such as a phrase said over and over. Words arrive one after another. At
level k each completed aligned block of 2**k words is a *catcher*: it waits for
a copy of itself 2**(k+1) - 1 to 2**(k+2) - 2 words later. The first half of every square
of such a period holds one of these blocks, so some catcher meets every square.
Only two catchers of a level can be met by the block that ends at the word just
appended, so a word costs two comparisons of block names a level. Names are hashes;
a match is only a reason to compare the words themselves.

A match at distance p opens a comparison of the text with itself p words back:
it reaches back at once as far as words are equal, and each appended word
advances it until words differ. A comparison that has covered p words is a square,
and as it goes on the squares merge into one run. Matches inside a known run at a
multiple of its period tell nothing new and are left out.

Work is a few numpy operations a level for all words appended together, so the
state of a text is its word numbers and their block names.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.llm.frames import batch_parts
from headway.llm.simhash import word_blocks

#: Words appended together.
PIECE = 1 << 16
#: Odd factors that mix the names of two halves.
MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F], dtype=np.uint64)
SHIFT = np.uint64(29)

Run = tuple[int, int, int]


class Catchers:
    """Runs (start, length, period) of appended word numbers: those of at least
    ``least`` words and ``exponent`` periods (2 or more)."""

    def __init__(self, least: int = 0, exponent: int = 2):
        self.least, self.exponent = least, exponent
        self.words, self.n = np.empty(0, dtype=np.int64), 0
        self.names: list[np.ndarray] = []  # of a level, for every place
        self.open: dict[int, int] = {}  # period of a comparison that goes on, and its start
        self.squares: dict[int, tuple[list[int], list[int]]] = {}  # what has ended: period, starts and ends

    def append(self, words: np.ndarray) -> None:
        before, self.n = self.n, self.n + len(words)
        self.words = np.concatenate([self.words, words.astype(np.int64)])
        for period, start in list(self.open.items()):
            if (end := self._forward(before, period)) < self.n:
                del self.open[period]
                self._ended(start, end, period)
        level = 0
        while self.exponent * ((2 << level) - 1) <= self.n:
            self._catch(level, self._name(level))
            level += 1

    def _name(self, level: int) -> int:
        """Names the blocks that are complete now; the first place not caught yet."""
        if level == 0:
            done = len(self.names[0]) if self.names else 0
            self.names[:1] = [self.words.view(np.uint64)]
            return done
        if level == len(self.names):
            self.names.append(np.empty(0, dtype=np.uint64))
        lower, own, half = self.names[level - 1], self.names[level], 1 << (level - 1)
        done = len(own)
        fresh = lower[done : len(lower) - half] * MIX[0] + lower[done + half :] * MIX[1]
        fresh ^= fresh >> SHIFT
        self.names[level] = np.concatenate([own, fresh]) if done else fresh
        return done

    def _together(self, level: int) -> int:
        """Blocks in a row that a run of this level holds, however it lies."""
        size = 1 << level
        shortest = min(
            max(self.least - p, (self.exponent - 1) * p)
            for p in {2 * size - 1, 4 * size - 2, *range(2 * size - 1, min(4 * size - 2, self.least) + 1)}
        )
        return max(1, (shortest - size + 1) // size)

    def _catch(self, level: int, done: int) -> None:
        """Blocks at ``done`` and later against the two catchers in reach."""
        size, names = 1 << level, self.names[level]
        near = 2 * size - 1
        first = max(done, near)
        if first >= len(names):
            return
        places = np.arange(first, len(names))
        blocks = (places - near) >> level << level
        own = names[first:]
        one = np.flatnonzero(own == names[blocks])
        late = int(np.searchsorted(places, near + size))  # the second catcher exists from here on
        two = np.flatnonzero(own[late:] == names[blocks[late:] - size]) + late
        at = np.concatenate([blocks[one], blocks[two] - size])
        x = np.concatenate([places[one], places[two]])
        for back in sorted({1, self._together(level) - 1} - {0}) if self._together(level) > 1 else ():
            there = at >= back * size
            at, x = at[there], x[there]
            same = names[at - back * size] == names[x - back * size]
            at, x = at[same], x[same]
        if not len(at):
            return
        new = ~self._explained(at, x, size)
        at, x = at[new], x[new]
        order = np.lexsort((at, x - at))
        at, periods = at[order], (x - at)[order]
        cuts = np.flatnonzero(np.diff(periods, prepend=-1, append=-1))
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            period, blocks, i = int(periods[a]), at[a:b], 0
            while i < len(blocks):
                block = int(blocks[i])
                start, end = self._backward(block, period), self._forward(block + size + period, period)
                if end == self.n:
                    self.open[period] = start
                else:
                    self._ended(start, end, period)
                i = int(np.searchsorted(blocks, end - size - period, side="right"))

    def _explained(self, at: np.ndarray, x: np.ndarray, size: int) -> np.ndarray:
        """The matches inside a known run at a multiple of its period."""
        period, inside = x - at, np.zeros(len(at), dtype=bool)
        for q in {*self.squares, *self.open}:
            some = np.flatnonzero(period % q == 0)
            if not len(some):
                continue
            starts, ends = (list(c) for c in self.squares.get(q, ((), ())))
            if q in self.open and self.n - self.open[q] >= 2 * q:
                starts.append(self.open[q])
                ends.append(self.n)
            if starts:
                place = np.searchsorted(starts, at[some], side="right") - 1
                inside[some] |= (place >= 0) & (np.array(ends)[place] >= x[some] + size)
        return inside

    def _forward(self, place: int, period: int) -> int:
        """The first place from here whose word isn't that of ``period`` before."""
        step = 16
        while place < self.n:
            stop = min(place + step, self.n)
            other = np.flatnonzero(self.words[place:stop] != self.words[place - period : stop - period])
            if len(other):
                return place + int(other[0])
            place, step = stop, min(4 * step, PIECE)
        return self.n

    def _backward(self, place: int, period: int) -> int:
        """The least place from which all words to here are those ``period`` later."""
        step = 16
        while place > 0:
            start = max(place - step, 0)
            other = np.flatnonzero(self.words[start:place] != self.words[start + period : place + period])
            if len(other):
                return start + int(other[-1]) + 1
            place, step = start, min(4 * step, PIECE)
        return 0

    def _ended(self, start: int, end: int, period: int) -> None:
        if end - start >= 2 * period:
            starts, ends = self.squares.setdefault(period, ([], []))
            starts.append(start)
            ends.append(end)

    def runs(self) -> list[Run]:
        """(start, length, period) by start, then period, of all words so far."""
        every = [(p, s, e) for p, (starts, ends) in self.squares.items() for s, e in zip(starts, ends)]
        every += [(p, s, self.n) for p, s in self.open.items()]
        of: dict[int, tuple[list[int], list[int]]] = {}
        for period, start, end in sorted(every):
            if end - start >= max(self.least, self.exponent * period):
                starts, ends = of.setdefault(period, ([], []))
                starts.append(start)
                ends.append(end)

        def smallest(start: int, end: int, period: int) -> bool:
            # A stretch with a smaller period lies in a run of a divisor, which is found too.
            for q, (starts, ends) in of.items():
                if q >= period:
                    break
                if period % q == 0:
                    place = bisect_right(starts, start) - 1
                    if place >= 0 and ends[place] >= end:
                        return False
            return True

        return sorted(
            (
                (s, e - s, p)
                for p, (starts, ends) in of.items()
                for s, e in zip(starts, ends)
                if smallest(s, e, p)
            ),
            key=lambda r: (r[0], r[2]),
        )


def word_runs(text: bytes, least: int, exponent: int) -> tuple[int, list[Run]]:
    """The number of words and their runs. Words are what lies between blanks
    (U+0020 and U+0009 to U+000D)."""
    numbers: dict[bytes, int] = {}
    catchers = Catchers(least, exponent)
    for block in word_blocks(text):
        for at in range(0, len(block), PIECE):
            part = block[at : at + PIECE]
            catchers.append(
                np.fromiter((numbers.setdefault(w, len(numbers)) for w in part), np.int64, len(part))
            )
    return catchers.n, catchers.runs()


def kept_blocks(text: bytes, runs: list[Run]) -> Iterator[list[bytes]]:
    """The words, without those that repeat a run's first period."""
    stretches: list[list[int]] = []
    for start, end in sorted((s + p, s + n) for s, n, p in runs):
        if stretches and start <= stretches[-1][1]:
            stretches[-1][1] = max(end, stretches[-1][1])
        else:
            stretches.append([start, end])
    at = 0
    for block in word_blocks(text):
        kept, last = [], 0
        for start, end in stretches:
            if start < at + len(block) and end > at:
                kept += block[last : max(start - at, last)]
                last = min(end - at, len(block))
        yield kept + block[last:] if stretches else block
        at += len(block)


def collapsed(text: bytes, runs: list[Run]) -> Iterator[bytes]:
    """The kept words with one blank between them, in parts."""
    first = True
    for block in kept_blocks(text, runs):
        if block:
            yield (b"" if first else b" ") + b" ".join(block)
            first = False


def runs_of(text: Column, least: int = 24, exponent: int = 3) -> Column:
    """The runs of a text column, as array<struct<start, length, period>> in bigint,
    by start, then period; empty for null and empty texts."""

    @F.arrow_udf("array<struct<start: bigint, length: bigint, period: bigint>>")
    def of(texts: pa.Array) -> pa.Array:
        kind = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))
        return pa.array(
            [
                [dict(zip(("start", "length", "period"), r)) for r in word_runs((t or "").encode(), least, exponent)[1]]
                for part in batch_parts(texts)
                for t in part.to_pylist()
            ],
            kind,
        )

    return of(text)


def periodic_runs(docs: DataFrame, least: int = 24, exponent: int = 3, id_column: str = "doc_id",
                  text_column: str = "text") -> DataFrame:
    """(id, start, length, period): a row for each run of each document."""
    found = docs.select(F.col(id_column).alias("id"), F.explode(runs_of(F.col(text_column), least, exponent)).alias("run"))
    return found.select(F.col("id").alias(id_column), "run.start", "run.length", "run.period")


def collapse(docs: DataFrame, least: int = 24, exponent: int = 3, text_column: str = "text") -> DataFrame:
    """The documents, each run cut to its first period. Texts without a run, and
    null, stay as they are; in others one blank stands between words."""

    @F.arrow_udf("string")
    def of(texts: pa.Array) -> pa.Array:
        def left(text: str | None) -> str | None:
            own = (text or "").encode()
            runs = word_runs(own, least, exponent)[1]
            return b"".join(collapsed(own, runs)).decode() if runs else text

        return pa.array([left(t) for part in batch_parts(texts) for t in part.to_pylist()], pa.string())

    return docs.withColumn(text_column, of(F.col(text_column)))


REPORT = {
    "n_runs": pa.int64(), "start": pa.int64(), "length": pa.int64(), "period": pa.int64(),
    "exponent_milli": pa.int64(), "runs_sha256": pa.string(), "collapsed_sha256": pa.string(),
}


def _report(text: bytes, least: int, exponent: int) -> tuple:
    _, runs = word_runs(text, least, exponent)
    best: tuple = (None,) * 4
    for start, length, period in runs:  # by start, then period: a tie goes to the first
        if best[0] is None or length * best[2] > best[1] * period:
            best = (start, length, period, 1000 * length // period)
    listed, left = hashlib.sha256(), hashlib.sha256()
    for run in runs:
        listed.update(("%d,%d,%d\n" % run).encode())
    for part in collapsed(text, runs):
        left.update(part)
    return len(runs), *best, listed.hexdigest(), left.hexdigest()


def report(docs: DataFrame, text: Column | None = None, least: int = 24, exponent: int = 3,
           id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row: id, ``n_runs``, the run of greatest length / period (ties: smallest
    start, then period; nulls without a run) with 1000 times that quotient rounded down,
    and digests of all runs and of the text that ``collapse`` would leave.

    ``text`` may be an expression over the columns; else it is ``text_column``. Null
    and empty texts have no words. Rows with a null or repeated id are rows like others.
    """
    own = F.col(text_column) if text is None else text
    rows = docs.select(F.col(id_column).alias("id"), own.alias("text"))

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for part in batch_parts(batch.column(1)):
                found = [_report((t or "").encode(), least, exponent) for t in part.to_pylist()]
                columns = [pa.array(c, kind) for c, kind in zip(zip(*found), REPORT.values())]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(part)), *columns], names=["id", *REPORT]
                )
                at += len(part)

    kinds = ", ".join(f"{c} {'string' if k == pa.string() else 'bigint'}" for c, k in REPORT.items())
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(of, f"id {kind}, {kinds}").withColumnRenamed("id", id_column)
