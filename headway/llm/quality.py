"""Quality classifier over supervised subword embeddings.

A text is a bag of its words, pairs of neighbouring words, and character 3- and
4-grams, hashed into buckets. Every bucket has a learned vector; a text is the mean of its vectors,
and a softmax over a linear layer gives the class. Vectors and layer are
trained together by stochastic gradient descent in numpy, on a bounded sample
of labelled rows (``Settings.rows_per_class`` of each class, chosen by a hash of
their id), which is the only part of the work that doesn't grow with the data.

With the layer fixed, a text's score depends on one number for each bucket (the
vector's part in the difference of the two classes), so whole texts are scored
by table look-ups over their bytes.

Case, punctuation and layout are kept, as quality shows there. Words are runs
of bytes without white space; n-grams are bytes of UTF-8, and white space of any
kind counts as one blank. Null and empty texts have no features; their score is
that of the layer alone. Labels other than 0 and 1, and labels without a text,
are not learned from; without both classes there is nothing to learn, and every
score is 0.5 or the share of the only class.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.llm.frames import batch_parts

#: White space in texts, as bytes.
BLANKS = b" \t\n\r\x0b\x0c"
#: Odd multipliers that spread words, 3-grams and 4-grams over the buckets.
SPREAD = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93)
#: Bytes of one numpy step.
STEP = 1 << 18
#: Places whose powers are stored; those of longer words are products.
WORD_BYTES = 64

_IS_BLANK = np.zeros(256, dtype=bool)
_IS_BLANK[list(BLANKS)] = True
_POWERS = np.cumprod(np.full(WORD_BYTES, 0x100000001B3, dtype=np.uint64))


@dataclass(frozen=True)
class Settings:
    rows_per_class: int = 1500
    bits: int = 16  # buckets of words, pairs, 3-grams and 4-grams: 2 ** bits each
    size: int = 16
    passes: int = 6
    rate: float = 0.5
    seed: int = 7


def features(data: np.ndarray, cuts: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, position) of the features of a stretch of bytes, each text of
    which begins and ends with a blank; ``cuts`` has where texts begin."""
    blank = _IS_BLANK[data]
    data = np.where(blank, np.uint8(32), data).astype(np.uint64)
    shift, out = np.uint64(64 - bits), []
    n = len(data)
    three = data[: max(0, n - 2)] | data[1 : max(1, n - 1)] << np.uint64(8) | data[2:] << np.uint64(16)
    # An n-gram may begin or end with a blank but has none inside.
    fits = np.flatnonzero(~blank[1 : max(1, n - 1)])
    out.append((three[fits] * np.uint64(SPREAD[1]) >> shift | np.uint64(1 << bits), fits))
    four = three[: max(0, n - 3)] | data[3:] << np.uint64(24)
    fits = np.flatnonzero(~(blank[1 : max(1, n - 2)] | blank[2 : max(2, n - 1)]))
    out.append((four[fits] * np.uint64(SPREAD[2]) >> shift | np.uint64(2 << bits), fits))
    # Words: a sum of bytes, each times a power of its place.
    starts = np.flatnonzero(~blank & np.append(True, blank[:-1]))
    if len(starts):
        lead = np.zeros(starts[0], dtype=np.int64)
        place = np.arange(n) - np.append(lead, np.repeat(starts, np.diff(np.append(starts, n))))
        weight = _POWERS[place % WORD_BYTES]
        far = np.flatnonzero(place >= WORD_BYTES)
        if len(far):
            blocks = place[far] // WORD_BYTES
            weight[far] *= np.cumprod(np.full(blocks.max(), _POWERS[-1]))[blocks - 1]
        sums = np.add.reduceat(np.where(blank, np.uint64(0), data * weight), starts)
        out.append((sums * np.uint64(SPREAD[0]) >> shift, starts))
        # Pairs of words: the difference, so a word that follows itself has one
        # bucket whatever the word.
        text = np.searchsorted(cuts, starts, side="right")
        pairs = np.flatnonzero(text[1:] == text[:-1])
        steps = sums[pairs + 1] - sums[pairs]
        out.append((steps * np.uint64(SPREAD[0]) >> shift | np.uint64(3 << bits), starts[pairs]))
    return tuple(np.concatenate([o[k] for o in out]).astype(np.int64) for k in (0, 1))


def stretches(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(bytes, rows, cuts): texts one after the other, a blank before and after
    each, about ``STEP`` bytes at a time; a long text comes in several. Row i
    of a stretch has the bytes from cuts[i] to cuts[i + 1]."""
    blank = np.full(1, 32, dtype=np.uint8)
    parts: list[np.ndarray] = []
    rows: list[int] = []
    total = 0

    def ready():
        sizes = [len(p) for p in parts]
        return np.concatenate(parts), np.array(rows), np.cumsum([0, *sizes])

    for i, text in enumerate(texts.cast(pa.large_binary())):
        data = np.frombuffer(text.as_buffer(), np.uint8) if text.is_valid else blank[:0]
        for at in range(0, len(data), STEP):
            part = data[at : at + STEP]
            parts.append(np.concatenate([blank, part, blank]))
            rows.append(i)
            total += len(part) + 2
            if total >= STEP:
                yield ready()
                parts, rows, total = [], [], 0
    if parts:
        yield ready()


class Model:
    """Softmax over two classes of mean bucket vectors."""

    def __init__(self, vectors: np.ndarray, layer: np.ndarray, bias: np.ndarray, bits: int):
        self.bits = bits
        self.table = (vectors @ (layer[1] - layer[0])).astype(np.float32)
        self.bias = float(bias[1] - bias[0])

    def scores(self, texts: pa.Array) -> np.ndarray:
        total, count = np.zeros(len(texts)), np.zeros(len(texts))
        for data, rows, cuts in stretches(texts):
            bucket, position = features(data, cuts, self.bits)
            row = rows[np.repeat(np.arange(len(rows)), np.diff(cuts))][position]
            total += np.bincount(row, self.table[bucket], minlength=len(texts))
            count += np.bincount(row, minlength=len(texts))
        margin = self.bias + total / np.maximum(count, 1)
        return 1 / (1 + np.exp(-np.clip(margin, -500, 500)))


def train(rows: list[tuple[int, np.ndarray, np.ndarray]], settings: Settings) -> Model:
    """SGD over (label, buckets, counts); the classes weigh the same."""
    random = np.random.default_rng(settings.seed)
    buckets = 4 << settings.bits
    vectors = random.uniform(-1, 1, (buckets, settings.size)).astype(np.float32) / settings.size
    layer, bias = np.zeros((2, settings.size), np.float32), np.zeros(2, np.float32)
    labels = np.array([r[0] for r in rows])
    shares = np.bincount(labels, minlength=2) if len(rows) else np.zeros(2)
    if not shares.all():
        bias = np.log(shares + 1e-6).astype(np.float32) if len(rows) else bias
        return Model(vectors, layer, bias, settings.bits)
    weight = len(rows) / (2 * shares)
    steps, step = settings.passes * len(rows), 0
    for _ in range(settings.passes):
        for i in random.permutation(len(rows)).tolist():
            label, ids, counts = rows[i]
            share = (counts / max(1, counts.sum())).astype(np.float32)
            own = vectors[ids]
            mean = share @ own
            logits = layer @ mean + bias
            error = np.exp(logits - logits.max())
            error /= error.sum()
            error[label] -= 1
            rate = np.float32(settings.rate * weight[label] * (1 - step / steps))
            back = error @ layer
            layer -= rate * np.outer(error, mean)
            bias -= rate * error
            # The mean shares one gradient out; buckets of a text are distinct.
            vectors[ids] = own - (rate * buckets_gain(share))[:, None] * back
            step += 1
    return Model(vectors, layer, bias, settings.bits)


def buckets_gain(share: np.ndarray) -> np.ndarray:
    """How much of a text's gradient each of its buckets gets. Plain shares of
    thousands of features would hardly move a vector, so they are scaled to a
    greatest step of one."""
    return share / max(float(share.max(initial=0)), 1e-9)


def counted(samples: DataFrame, bits: int) -> DataFrame:
    """(place, label, buckets, counts) of labelled texts (place, label, text); as long
    as there are buckets at most."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, numbers = [], []
            for i in range(len(batch)):
                total = np.zeros(4 << bits, dtype=np.int64)
                for data, _, cuts in stretches(batch.column(2).slice(i, 1)):
                    total += np.bincount(features(data, cuts, bits)[0], minlength=len(total))
                ids.append(np.flatnonzero(total).astype(np.int32))
                numbers.append(total[ids[-1]].astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(ids, pa.list_(pa.int32())),
                 pa.array(numbers, pa.list_(pa.int32()))],
                names=["place", "label", "buckets", "counts"],
            )

    return samples.mapInArrow(count, "place bigint, label int, buckets array<int>, counts array<int>")


def in_order(found: pa.Table) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """The rows of ``counted`` by place, as views of the columns, which aren't copied."""
    rows = []
    for batch in found.to_batches():
        places, labels = (batch.column(n).to_pylist() for n in (0, 1))
        ids, numbers = (batch.column(n).flatten().to_numpy() for n in (2, 3))
        ends = [np.cumsum([0, *(len(x) for x in batch.column(n))]) for n in (2, 3)]
        for i, (place, label) in enumerate(zip(places, labels)):
            rows.append((
                place, label, ids[ends[0][i] : ends[0][i + 1]], numbers[ends[1][i] : ends[1][i + 1]],
            ))
    return [row[1:] for row in sorted(rows, key=lambda r: r[0])]


def held_out(id_column: str) -> Column:
    """Rows that are never learned from: a fifth, by the id's CRC-32."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, settings: Settings = Settings(), label_column: str = "quality",
        id_column: str = "doc_id", text_column: str = "text") -> Model:
    """Learns from at most ``rows_per_class`` rows of each class that aren't held
    out, those with the smallest hash of their id. A document with several
    labels takes the largest."""
    usable = (
        labels.where(F.col(label_column).isin(0, 1) & F.col(id_column).isNotNull() & ~held_out(id_column))
        .groupBy(F.col(id_column).alias("id")).agg(F.max(label_column).cast("int").alias("label"))
    )
    chosen = None
    for label in (0, 1):
        some = usable.where(F.col("label") == label).orderBy(F.xxhash64("id"), "id").limit(settings.rows_per_class)
        chosen = some if chosen is None else chosen.unionAll(some)
    # At most two times rows_per_class rows, so a broadcast is bounded.
    texts = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text")).where("text is not null")
    samples = texts.join(F.broadcast(chosen), "id").groupBy("id").agg(
        F.min("label").alias("label"), F.min("text").alias("text")
    )
    # The order of training: the same every run, however rows arrive.
    place = F.xxhash64("id").alias("place")
    return train(in_order(counted(samples.select(place, "label", "text"), settings.bits).toArrow()), settings)


def score(text: Column, model: Model) -> Column:
    """Probability of label 1, between 0 and 1."""

    @F.arrow_udf("double")
    def scores(texts: pa.Array) -> pa.Array:
        return pa.array(np.concatenate([model.scores(p) for p in batch_parts(texts)] or [np.empty(0)]))

    return scores(text)


def scored(docs: DataFrame, labels: DataFrame, settings: Settings = Settings(), threshold: float = 0.3,
           label_column: str = "quality", id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row: id, held_out, score and predicted (1 from ``threshold`` on)."""
    model = fit(docs, labels, settings, label_column, id_column, text_column)
    rows = docs.select(F.col(id_column), held_out(id_column).alias("held_out"),
                       score(F.col(text_column), model).alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame, settings: Settings = Settings(), threshold: float = 0.3,
              label_column: str = "quality", id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows whose score reaches ``threshold``, all columns as they were."""
    model = fit(docs, labels, settings, label_column, id_column, text_column)
    return docs.where(score(F.col(text_column), model) >= threshold)
