"""Token ids as Arrow stream files of equal-length sequences.

Documents are dealt to parts by id range; a part writes two files of the Arrow
stream format into a shared folder:

* ``part-N.ids.arrow``: batches of fixed-size lists, ``ids`` (unsigned integers as
  wide as the vocabulary asks) and ``mask`` (1 for an id, 0 for padding). A
  part's documents follow each other in ascending id order, each closed by the end
  id, cut into sequences of one length; only the part's last one is padded. As all
  lists have one size, sequence i of a memory-mapped file is found by
  arithmetic, without copying.
* ``part-N.docs.arrow``: document ids with the place of their ids in the part.

A part is written under a name of its attempt and renamed when complete, and
only the names that the finished attempts report are used, so lost or repeated
tasks leave no trace. The folder may be any that pyarrow's file systems know
by URI; reading goes through the same.

Null and empty texts have the end id alone. Rows with equal ids stand next to
each other in the order of their texts, null ids before all others.
"""

from __future__ import annotations

import json
import os
import posixpath
import uuid
import zlib
from codecs import charmap_decode
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from headway.llm.bpe import byte_characters
from headway.llm.frames import batch_parts, written
from headway.session import work_path

#: Ids of a sequence, and sequences of a batch.
LENGTH, BATCH = 2048, 256
#: Chunks of a cache generation (a Python worker keeps two).
CACHE_CHUNKS = 800_000
#: Bytes of text that are encoded together.
PART_BYTES = 1 << 20
#: Letters below are letters in every version of Unicode's tables.
SIMPLE = "\u0530"
#: Letters below are composed as they stand; only the dotted I has a lower case
#: of two characters.
LATIN, DOTTED = "\u0180", "\u0130"
#: Marks that end a chunk; they are encoded apart from the letters before.
MARKS = ".,!?;:$%&#*+-=/@^_|~"


class Encoder:
    """Ids of texts by the ``tokenizers`` library, as bytes of ``dtype``.

    With vocabularies that drop white space and lower A-Z, a text's ids are
    those of its chunks between blanks and line ends, one after the other, and
    chunks seen before are looked up. A new chunk of letters with marks behind
    is looked up by its letters; the letters that are new are encoded as one
    text of words, where each word's last id is one that ends words. Words of
    Latin letters are lowered and spelt as bytes here, so that the library need
    only run its model on them. Other vocabularies are encoded text by text.
    """

    def __init__(self, path: str, special_as_text: bool = False):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.library.encode_special_tokens = special_as_text
        self.size = self.library.get_vocab_size(with_added_tokens=True)
        self.dtype = np.dtype("<u2" if self.size <= 1 << 16 else "<u4")
        self.cache: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        mark = json.loads(self.library.to_str())["model"].get("end_of_word_suffix")
        self.ends_word = np.zeros(self.size, dtype=bool)
        if mark:
            self.ends_word[[i for t, i in self.library.get_vocab().items() if t.endswith(mark)]] = True
        whole, a, b, c, blank = self._batch(["Ab cd.\nEf,", "ab", "cd", "ef", "  \n"])
        stop, comma = self._batch([".", ","])
        self.by_chunk = bool(mark) and whole == a + b + stop + c + comma and not blank
        whole, *parts = self._batch(["ab" + MARKS, "ab", MARKS])
        self.marks = MARKS if whole == sum(parts, []) else ".,"
        self._make_plain()

    def _make_plain(self) -> None:
        """The model alone, for words that are lowered and spelt as bytes."""
        from tokenizers import Tokenizer, pre_tokenizers

        plain = Tokenizer(self.library.model)
        plain.pre_tokenizer = pre_tokenizers.CharDelimiterSplit(" ")
        char_of = {b: c for c, b in byte_characters().items()} | {32: " "}
        self.spelling = "".join(map(char_of.__getitem__, range(256)))
        self.plain = plain
        letters = "".join(c for c in map(chr, range(65, ord(LATIN))) if c.isalpha() and c != DOTTED)
        words = [letters[i : i + n] for n in (1, 2, 7) for i in range(0, len(letters), n)]
        if self.by_chunk and self._plain_ids(" ".join(words)) != self._batch([" ".join(words)])[0]:
            self.plain = None

    def _plain_ids(self, text: str) -> list[int]:
        """Ids of words of letters with a blank between."""
        if self.plain is None or not text.isascii() and (max(text) >= LATIN or DOTTED in text):
            return self._batch([text])[0]
        spelt = text.lower()
        if not spelt.isascii():
            spelt = charmap_decode(spelt.encode(), "strict", self.spelling)[0]
        return self.plain.encode_batch_fast([spelt], add_special_tokens=False)[0].ids

    def _batch(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def _bytes(self, ids: list[int]) -> bytes:
        return np.array(ids, dtype=self.dtype).tobytes()

    def _encode_words(self, words: list[str]) -> Iterator[bytes]:
        """Ids of words made of letters."""
        for at in range(0, len(words), 200):
            part = words[at : at + 200]
            ids = np.array(self._plain_ids(" ".join(part)), dtype=self.dtype)
            ends = np.flatnonzero(self.ends_word[ids]) + 1
            if len(ends) != len(part):
                yield from map(self._bytes, self._batch(part))
                continue
            raw, width = ids.tobytes(), self.dtype.itemsize
            begin = 0
            for end in (ends * width).tolist():
                yield raw[begin:end]
                begin = end

    def _learn(self, new: set[str]) -> None:
        """Puts the ids of chunks that aren't in the cache into it. A full cache
        becomes the older generation, from which chunks in use come back."""
        if len(self.cache) + len(new) > CACHE_CHUNKS:
            self.older, self.cache = self.cache, {}
        known = new.intersection(self.older)
        self.cache.update(zip(known, map(self.older.__getitem__, known)))
        # Lists side by side, as the garbage collector would visit tuples.
        split: list[str] = []
        word_of: list[str] = []
        tail_of: list[str] = []
        other: list[str] = []
        for chunk in new.difference(known):
            word = letters = chunk.rstrip(self.marks)
            if letters.isascii():
                simple, word = letters.isalpha(), letters.lower()
            else:
                simple = letters.isalpha() and letters[-1] < SIMPLE and letters.lower().isalpha()
            if simple:
                split.append(chunk)
                word_of.append(word)
                tail_of.append(chunk[len(letters) :])
            else:
                other.append(chunk)
        find = self.cache.get
        tails = list(set(tail_of) - {""})
        behind = {"": b""} | dict(zip(tails, map(self._bytes, self._batch(tails)), strict=True))
        fresh = [w for w in dict.fromkeys(word_of) if find(w) is None]
        self.cache.update(zip(fresh, self._encode_words(fresh), strict=True))
        found = [find(w) + behind[t] for w, t in zip(word_of, tail_of)]
        self.cache.update(zip(split, found, strict=True))
        self.cache.update(zip(other, map(self._bytes, self._batch(other)), strict=True))

    def encode(self, texts: list[str | None]) -> Iterator[bytes]:
        if not self.by_chunk:
            for text in texts:
                yield self._bytes(self._batch([text or ""])[0])
            return
        chunks: list[str] = []
        ends = [0]
        for text in texts:
            if text:
                # Lower case is what the vocabulary makes of A-Z, but for marks
                # of special tokens.
                if text.isascii() and "<|" not in text:
                    text = text.lower()
                chunks += text.replace("\n", " ").split(" ")
            ends.append(len(chunks))
        pieces = list(map(self.cache.get, chunks))
        new = [i for i, piece in enumerate(pieces) if piece is None]
        if new:
            self._learn({chunks[i] for i in new})
            for i in new:
                pieces[i] = self.cache[chunks[i]]
        for begin, end in zip(ends, ends[1:]):
            yield b"".join(pieces[begin:end])


@lru_cache(maxsize=4)
def encoder(path: str, special_as_text: bool = False) -> Encoder:
    """Loaded once per Python worker; Spark already runs a task on every core."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    return Encoder(path, special_as_text)


def encoded(path: str, texts: pa.Array, special_as_text: bool = False) -> Iterator[np.ndarray]:
    own = encoder(path, special_as_text)
    for part in batch_parts(texts, PART_BYTES):
        for ids in own.encode(part.to_pylist()):
            yield np.frombuffer(ids, own.dtype)


def token_ids(text: Column, path: str) -> Column:
    """Token ids of a text column: array<int>; empty for null."""

    @F.arrow_udf("array<int>")
    def ids(texts: pa.Array) -> pa.Array:
        rows = list(encoded(path, texts))
        ends = np.cumsum([0, *map(len, rows)], dtype=np.int32)
        flat = np.concatenate([*rows, np.empty(0, np.int32)]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))

    return ids(text)


def open_uri(uri: str):
    """(file system, path) of a URI or a plain path."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)


class PartWriter:
    """Writes one part's ids as equal-length sequences."""

    def __init__(self, stream, kind: pa.DataType, length: int, batch: int):
        self.length, self.batch = length, batch
        self.dtype = kind.to_pandas_dtype()
        self.schema = pa.schema([("ids", pa.list_(kind, length)), ("mask", pa.list_(pa.bool_(), length))])
        self.writer = pa.ipc.new_stream(stream, self.schema)
        self.kept: list[np.ndarray] = []
        self.held = self.total = 0

    def add(self, ids: np.ndarray) -> None:
        self.kept.append(ids.astype(self.dtype))
        self.held += len(ids)
        self.total += len(ids)
        if self.held >= self.length * self.batch:
            self._write(self.held // self.length * self.length)

    def _write(self, count: int) -> None:
        flat = np.concatenate([*self.kept, np.empty(0, self.dtype)])
        ids, rest = flat[:count], flat[count:]
        self.kept, self.held = [rest], len(rest)
        for at in range(0, len(ids), self.length * self.batch):
            part = ids[at : at + self.length * self.batch]
            full = -(-len(part) // self.length) * self.length
            row = np.concatenate([part, np.zeros(full - len(part), self.dtype)])
            columns = [pa.FixedSizeListArray.from_arrays(pa.array(row), self.length),
                       pa.FixedSizeListArray.from_arrays(pa.array(np.arange(full) < len(part)), self.length)]
            self.writer.write_batch(pa.RecordBatch.from_arrays(columns, schema=self.schema))

    def close(self) -> None:
        self._write(self.held)
        self.writer.close()


PARTS = "part int, ids_file string, docs_file string, documents bigint, ids bigint"


def write(docs: DataFrame, path: str, folder: str, end_id: int, parts: int | None = None,
          length: int = LENGTH, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Encodes all texts into files in ``folder`` and returns the parts, in order:
    (part, ids_file, docs_file, documents, ids). ``parts`` is the number of id
    ranges (Spark's number of shuffle partitions by default)."""
    kind = docs.schema[id_column].dataType
    arrow_id = pa.int64() if isinstance(kind, (T.LongType, T.IntegerType, T.ShortType, T.ByteType)) else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        wide = pa.uint16() if max(encoder(path, False).size, end_id + 1) <= 1 << 16 else pa.uint32()
        files, root = open_uri(folder)
        names = [posixpath.join(root, f"part-{part:05d}.{k}.arrow") for k in ("ids", "docs")]
        tries = [f"{n}.{uuid.uuid4().hex}" for n in names]
        end, documents, total, docs_writer = np.array([end_id], np.uint32), 0, 0, None
        with files.open_output_stream(tries[0]) as ids_stream, files.open_output_stream(tries[1]) as docs_stream:
            writer = PartWriter(ids_stream, wide, length, BATCH)
            for batch in batches:
                counts = []
                for ids in encoded(path, batch.column(1)):
                    writer.add(ids)
                    writer.add(end)
                    counts.append(len(ids) + 1)
                own = batch.column(0) if arrow_id is None else batch.column(0).cast(arrow_id)
                starts = total + np.cumsum([0, *counts])[:-1]
                rows = pa.RecordBatch.from_arrays(
                    [own, pa.array(starts, pa.int64()), pa.array(counts, pa.int64())],
                    names=["id", "start", "n_tokens"],
                )
                docs_writer = docs_writer or pa.ipc.new_stream(docs_stream, rows.schema)
                docs_writer.write_batch(rows)
                total += int(sum(counts))
                documents += len(batch)
            writer.close()
            if docs_writer is not None:
                docs_writer.close()
        if not documents:
            for name in tries:
                files.delete_file(name)
            return
        # Attempts write equal files; the last to finish stays.
        for now, name in zip(tries, names):
            files.move(now, name)
        yield pa.RecordBatch.from_pydict(
            {"part": pa.array([part], pa.int32()), "ids_file": [posixpath.basename(names[0])],
             "docs_file": [posixpath.basename(names[1])], "documents": pa.array([documents], pa.int64()),
             "ids": pa.array([total], pa.int64())}
        )

    files, root = open_uri(folder)
    files.create_dir(root, recursive=True)
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    count = parts or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.repartitionByRange(count, "id").sortWithinPartitions("id", "text")
    return ordered.mapInArrow(run, PARTS)


def documents(spark: SparkSession, parts: DataFrame, folder: str, id_type: str = "bigint",
              id_column: str = "doc_id") -> DataFrame:
    """Per document, as read from the files: id, ``start`` (ids of all documents
    before it), ``n_tokens`` (with the end id) and ``ids_crc32`` (of the ids as
    little-endian 32-bit integers).

    The parts' totals are summed on the driver: a number for each file.
    """
    done = written(parts, "token-parts")
    rows = sorted(done.collect(), key=lambda r: r["part"])
    bases = np.cumsum([0, *(r["ids"] for r in rows)]).tolist()
    listed = spark.createDataFrame(
        [(b, r["ids_file"], r["docs_file"]) for b, r in zip(bases, rows)],
        "base bigint, ids_file string, docs_file string",
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = open_uri(folder)
        for batch in batches:
            for row in batch.to_pylist():
                ids = IdStream(files, posixpath.join(root, row["ids_file"]))
                with files.open_input_stream(posixpath.join(root, row["docs_file"])) as stream:
                    for own in pa.ipc.open_stream(stream):
                        crc = [zlib.crc32(ids.take(n).astype("<u4").tobytes()) for n in own.column(2).to_pylist()]
                        yield pa.RecordBatch.from_arrays(
                            [own.column(0), pa.array(own.column(1).to_numpy() + row["base"]), own.column(2),
                             pa.array(crc, pa.int64())],
                            names=["id", "start", "n_tokens", "ids_crc32"],
                        )

    out = listed.repartition(max(1, len(rows))).mapInArrow(
        read, f"id {id_type}, start bigint, n_tokens bigint, ids_crc32 bigint"
    )
    return out.withColumnRenamed("id", id_column)


class IdStream:
    """Ids of a file in order, batch by batch; padding is left out."""

    def __init__(self, files, name: str):
        self.reader = pa.ipc.open_stream(files.open_input_stream(name))
        self.held = np.empty(0, np.uint32)

    def take(self, count: int) -> np.ndarray:
        pieces, missing = [], count
        while missing > len(self.held):
            pieces.append(self.held)
            missing -= len(self.held)
            batch = self.reader.read_next_batch()
            mask = batch.column("mask").values.to_numpy(zero_copy_only=False)
            self.held = batch.column("ids").values.to_numpy()[mask]
        pieces.append(self.held[:missing])
        self.held = self.held[missing:]
        return pieces[0] if len(pieces) == 1 else np.concatenate(pieces)


class Sequences:
    """Random access to the sequences of an ids file on a file system that can be
    memory-mapped: ``ids(i)`` and ``mask(i)`` are views, nothing is copied but
    the mask's bits."""

    def __init__(self, path: str):
        self.batches = list(pa.ipc.open_stream(pa.memory_map(path)))
        self.starts = np.cumsum([0, *map(len, self.batches)])

    def __len__(self) -> int:
        return int(self.starts[-1])

    def _at(self, i: int, column: str) -> pa.Array:
        if not 0 <= i < len(self):
            raise IndexError(i)
        b = int(np.searchsorted(self.starts, i, side="right")) - 1
        lists = self.batches[b].column(column)
        size = lists.type.list_size
        return lists.values.slice((i - int(self.starts[b])) * size, size)

    def ids(self, i: int) -> np.ndarray:
        return self._at(i, "ids").to_numpy()

    def mask(self, i: int) -> np.ndarray:
        return self._at(i, "mask").to_numpy(zero_copy_only=False)


def round_trip(docs: DataFrame, path: str, end_id: int, id_column: str = "doc_id",
               text_column: str = "text") -> DataFrame:
    """Writes the documents to a new shared folder and reads the files back."""
    spark = docs.sparkSession
    folder = work_path(spark, "token-files")
    kind = docs.schema[id_column].dataType
    whole = isinstance(kind, (T.LongType, T.IntegerType, T.ShortType, T.ByteType))
    parts = write(docs, path, folder, end_id, id_column=id_column, text_column=text_column)
    return documents(spark, parts, folder, "bigint" if whole else kind.simpleString(), id_column)
