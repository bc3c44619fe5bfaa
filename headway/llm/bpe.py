"""BPE encoding and decoding: speculate, verify, and merge only what fails.

A word is first cut greedily into the longest vocabulary entries. That guess is
right exactly when every adjacent pair of entries is *compatible*, that is, when
encoding the two entries' bytes together gives the same two entries again. All
pairs of a block of words are tested at once with numpy; only the words with an
incompatible pair (or with an entry that merging can't reach) are merged step
by step.

Texts are cut into words with the byte-level pattern, after added tokens such
as the end-of-text marker have been cut out, as the ``tokenizers`` library does
for byte-level vocabularies. Null and empty texts have no ids.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.llm.frames import batch_parts

#: The byte-level word pattern (white space spelt out) and the
#: bytes that stand for themselves in vocabulary files; other bytes are
#: written as the characters from U+0100 on, in byte order.
WHITE = r"\p{White_Space}"
WORDS = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+"
    rf"| ?[^{WHITE}\p{{L}}\p{{N}}]+|{WHITE}+(?!\P{{White_Space}})|{WHITE}+"
)
PRINTABLE = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAC + 1), *range(0xAE, 0xFF + 1)]

#: Words of a cache generation (a Python worker keeps two): of ids beside other
#: work, and of digests, which have a worker to themselves.
CACHE_WORDS, SPELLING_WORDS = 60_000, 300_000
#: Bytes of text whose words are looked up together.
PART_BYTES = 1 << 20
#: Longest word, in bytes, that is merged by scanning.
SCANNED = 48
#: Words taken from one text at a time.
BLOCK_WORDS = 100_000
NONE = 1 << 40
NEVER = np.int64(NONE)


def byte_characters() -> dict[str, int]:
    others = [b for b in range(256) if b not in set(PRINTABLE)]
    return {chr(b): b for b in PRINTABLE} | {chr(256 + i): b for i, b in enumerate(others)}


class Vocabulary:
    """A byte-level BPE vocabulary file and the tables its encoder needs."""

    def __init__(self, path: str, cache_words: int | None = None):
        self.cache_words = cache_words or CACHE_WORDS
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, byte_of = spec["model"], byte_characters()
        self.added = {t["content"]: t["id"] for t in spec.get("added_tokens", ())}
        size = max([*model["vocab"].values(), *self.added.values()]) + 1
        self.bytes_of: list[bytes] = [b""] * size
        for token, i in model["vocab"].items():
            self.bytes_of[i] = bytes(map(byte_of.__getitem__, token))
        for token, i in self.added.items():
            self.bytes_of[i] = token.encode()
        self.digits = [b"%d" % i for i in range(size)]
        self.id_of = {self.bytes_of[i]: i for i in model["vocab"].values()}
        self.longest = max(map(len, self.id_of), default=1)
        self._read_merges(model, size)
        self.pattern = regex.compile(WORDS)
        marks = sorted(self.added, key=len, reverse=True)
        self.added_pattern = regex.compile("|".join(map(regex.escape, marks))) if marks else None
        self.cache: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _read_merges(self, model: dict, size: int) -> None:
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        vocab = model["vocab"]
        left = np.array([vocab[a] for a, _ in pairs], dtype=np.int64)
        right = np.array([vocab[b] for _, b in pairs], dtype=np.int64)
        whole = np.array([vocab[a + b] for a, b in pairs], dtype=np.int64)
        rank = np.arange(len(pairs), dtype=np.int64)
        self.merge_of = {a * size + b: (r, w) for a, b, r, w in zip(
            left.tolist(), right.tolist(), rank.tolist(), whole.tolist(), strict=True)}
        # The merge that forms an entry; -1 for single bytes.
        self.formed = np.full(size, -1, dtype=np.int64)
        self.head = np.arange(size, dtype=np.int64)
        self.tail = np.arange(size, dtype=np.int64)
        for values, of in ((rank, self.formed), (left, self.head), (right, self.tail)):
            of[whole[::-1]] = values[::-1]  # the first merge of an entry stays
        keys = left * size + right
        order = np.argsort(keys, kind="stable")
        self.pair_keys, self.pair_ranks, self.size = keys[order], rank[order], size
        # Pairs can only be judged by formation ranks if parts are always
        # formed before they are used; entries where that fails are merged.
        sound = (self.formed[left] < rank) & (self.formed[right] < rank)
        own = np.ones(size, dtype=bool)
        fits = self.compatible(left, right, self.formed[whole])
        for w, a, b, ok in zip(whole.tolist(), left.tolist(), right.tolist(),
                               (sound & fits).tolist(), strict=True):
            own[w] = ok and own[a] and own[b]
        own[list(self.added.values())] = False
        self.own = own
        self.trusted = bool(sound.all())

    def _pair_rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        if not len(self.pair_keys):
            return np.full(len(a), NEVER)
        keys = a * self.size + b
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == keys, self.pair_ranks[at], NEVER)

    def compatible(self, a: np.ndarray, b: np.ndarray, before: np.ndarray | None = None):
        """Whether no merge joins the bytes of ``a`` and ``b`` across their
        boundary (of a rank below ``before``, if given).

        Goes back in time from the finished entries: the symbols left and right
        of the boundary are undone latest first. Two of them meet from the time
        both exist until either is merged into a larger one; of equal ranks the
        leftmost merge comes first.
        """
        n = len(a)
        x, y = np.array(a, dtype=np.int64), np.array(b, dtype=np.int64)
        until_x = np.full(n, NEVER) if before is None else np.array(before, dtype=np.int64)
        until_y = until_x - (before is not None)
        good, at = np.ones(n, dtype=bool), np.arange(n)
        while len(at):
            rank = self._pair_rank(x, y)
            clash = (rank < until_x) & (rank <= until_y) & (rank < NEVER)
            good[at[clash]] = False
            fx, fy = self.formed[x], self.formed[y]
            go = ~clash & ((fx >= 0) | (fy >= 0))
            undo_x = fx > fy
            until_x, until_y = np.where(undo_x, fx, until_x)[go], np.where(undo_x, until_y, fy)[go]
            x, y = np.where(undo_x, self.tail[x], x)[go], np.where(undo_x, y, self.head[y])[go]
            at = at[go]
        return good

    def greedy(self, word: bytes) -> list[int]:
        """The longest entry at each place; every byte is an entry."""
        ids, at, n, find = [], 0, len(word), self.id_of.get
        while at < n:
            stop = min(n, at + self.longest)
            while (i := find(word[at:stop])) is None:
                stop -= 1
                if stop == at:
                    raise ValueError(f"the vocabulary has no entry for byte {word[at]}")
            ids.append(i)
            at = stop
        return ids

    def merge(self, word: bytes) -> list[int]:
        """Exact merging: lowest rank first, leftmost among equals."""
        ids = [self.id_of[word[i : i + 1]] for i in range(len(word))]
        if len(ids) > SCANNED:
            return self._merge_long(ids)
        find, size, none = self.merge_of.get, self.size, (NONE, -1)
        found = [find(a * size + b, none) for a, b in zip(ids, ids[1:])]
        while found:
            best = min(found)
            rank, whole = best
            if rank == NONE:
                break
            i = found.index(best)
            ids[i : i + 2] = [whole]
            del found[i]
            if i:
                found[i - 1] = find(ids[i - 1] * size + whole, none)
            if i < len(found):
                found[i] = find(whole * size + ids[i + 1], none)
        return ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        """The same with a heap of pairs over a linked list, so that the time
        for long words stays near-linear."""
        n, find, size = len(ids), self.merge_of.get, self.size
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(m[0], i, ids[i], ids[i + 1], m[1]) for i in range(n - 1)
                if (m := find(ids[i] * size + ids[i + 1]))]
        heapq.heapify(heap)
        while heap:
            _, i, a, b, whole = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue
            ids[i], ids[j], after[i] = whole, -1, after[j]
            if after[j] < n:
                before[after[j]] = i
            for k in (before[i], i):
                if k >= 0 and after[k] < n and (m := find(ids[k] * size + ids[after[k]])):
                    heapq.heappush(heap, (m[0], k, ids[k], ids[after[k]], m[1]))
        return [i for i in ids if i >= 0]

    def encode_words(self, words: list[str]) -> list[list[int]]:
        """Greedy guesses, one vectorised check of all distinct adjacent
        pairs, exact merging of the words that fail."""
        raw = [w.encode() for w in words]
        guesses = [self.greedy(w) for w in raw]
        counts = np.fromiter(map(len, guesses), np.int64, len(guesses))
        flat = np.fromiter(chain.from_iterable(guesses), np.int64, int(counts.sum()))
        word = np.repeat(np.arange(len(words)), counts)
        bad = np.zeros(len(words), dtype=bool)
        if self.trusted:
            bad[word[~self.own[flat]]] = True
            inside = np.flatnonzero(word[1:] == word[:-1])
            pairs, back = np.unique(flat[inside] * self.size + flat[inside + 1], return_inverse=True)
            good = self.compatible(pairs // self.size, pairs % self.size)
            bad[word[inside[~good[back]]]] = True
        else:
            bad[:] = True
        for i in np.flatnonzero(bad).tolist():
            guesses[i] = self.merge(raw[i])
        return guesses

    def _word_blocks(self, text: str) -> Iterator[list[str] | int]:
        """Blocks of words, and the ids of added tokens between them."""
        at = 0
        while at < len(text) or at == 0:
            mark = self.added_pattern and self.added_pattern.search(text, at)
            part = text[at : mark.start()] if mark else text[at:] if at else text
            if len(part) <= 8 * BLOCK_WORDS:
                yield self.pattern.findall(part)
            else:
                found = (m.group() for m in self.pattern.finditer(part))
                while block := list(islice(found, BLOCK_WORDS)):
                    yield block
            if not mark:
                return
            yield self.added[mark.group()]
            at = mark.end()

    def entry(self, ids: list[int]):
        """What the cache keeps of a word."""
        return array("i", ids).tobytes()

    def _learn(self, new: set[str]) -> None:
        """Puts the ids of words that aren't in the cache into it. A full cache
        becomes the older generation, from which words in use come back."""
        if len(self.cache) + len(new) > self.cache_words:
            self.older, self.cache = self.cache, {}
        known = new.intersection(self.older)
        self.cache.update(zip(known, map(self.older.__getitem__, known)))
        fresh = list(new.difference(known))
        self.cache.update(zip(fresh, map(self.entry, self.encode_words(fresh)), strict=True))

    def _looked_up(self, words: list[str]) -> list:
        pieces = list(map(self.cache.get, words))
        new = [i for i, piece in enumerate(pieces) if piece is None]
        if new:
            self._learn({words[i] for i in new})
            for i in new:
                pieces[i] = self.cache[words[i]]
        return pieces

    def entries(self, texts: list[str | None]) -> Iterator[list]:
        """The cache entries of each text's words, in order. The words of all
        short texts are looked up together, which keeps the numpy steps for new
        words long; a long text goes block by block."""
        most = 8 * BLOCK_WORDS
        words: list[str] = []
        parts: list[list[tuple[int, int] | int]] = []
        for text in texts:
            parts.append([])
            for block in self._word_blocks(text) if text and len(text) <= most else ():
                if isinstance(block, list):
                    parts[-1].append((len(words), len(words) + len(block)))
                    words += block
                else:
                    parts[-1].append(block)
        found = self._looked_up(words)
        for text, own in zip(texts, parts, strict=True):
            if text and len(text) > most:
                pieces = []
                for block in self._word_blocks(text):
                    pieces += self._looked_up(block) if isinstance(block, list) else [self.entry([block])]
            elif len(own) == 1 and isinstance(own[0], tuple):
                pieces = found[slice(*own[0])]
            else:
                pieces = []
                for part in own:
                    pieces += found[slice(*part)] if isinstance(part, tuple) else [self.entry([part])]
            yield pieces

    def encode(self, texts: list[str | None]) -> Iterator[array]:
        """The ids of each text, in order."""
        for pieces in self.entries(texts):
            ids = array("i")
            ids.frombytes(b"".join(pieces))
            yield ids

    def decode(self, ids: Iterable[int]) -> str:
        """Bytes of the entries, as text; bytes that aren't UTF-8 become U+FFFD."""
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")


class Spelling(Vocabulary):
    """Keeps, of each word, its ids as decimals and the bytes they decode to."""

    def entry(self, ids: list[int]) -> tuple[bytes, bytes]:
        return b",".join(map(self.digits.__getitem__, ids)), b"".join(map(self.bytes_of.__getitem__, ids))

    def digests(self, texts: list[str | None]) -> Iterator[tuple[int, str, str]]:
        """Number of ids, digests of the ids and of what they decode to, of each text."""
        for pieces in self.entries(texts):
            ids = b",".join([ids for ids, _ in pieces])
            decoded = b"".join([own for _, own in pieces]).decode("utf-8", "replace").encode()
            yield (
                ids.count(b",") + 1 if ids else 0,
                hashlib.sha256(ids).hexdigest(),
                hashlib.sha256(decoded).hexdigest(),
            )


@lru_cache(maxsize=4)
def spelling(path: str) -> Spelling:
    """Loaded once per Python worker."""
    return Spelling(path, SPELLING_WORDS)


@lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    """Loaded once per Python worker."""
    return Vocabulary(path)


def encoded(path: str, texts: pa.Array) -> Iterator[array]:
    """Ids of an Arrow column of texts, a few megabytes at a time."""
    vocab = vocabulary(path)
    for part in batch_parts(texts, PART_BYTES):
        yield from vocab.encode(part.to_pylist())


def encode(text: Column, path: str) -> Column:
    """Token ids of a text column: array<int>, empty for null and empty texts."""

    @F.arrow_udf("array<int>")
    def ids(texts: pa.Array) -> pa.Array:
        rows = list(encoded(path, texts))
        ends = np.cumsum([0, *map(len, rows)], dtype=np.int32)
        flat = np.concatenate([np.frombuffer(r, np.int32) for r in rows if len(r)] or [np.empty(0, np.int32)])
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))

    return ids(text)


def decode(ids: Column, path: str) -> Column:
    """The text of a column of ids; null ids give null."""

    @F.arrow_udf("string")
    def text(column: pa.Array) -> pa.Array:
        vocab = vocabulary(path)
        return pa.array([None if r is None else vocab.decode(r) for r in column.to_pylist()], pa.string())

    return text(ids)


def digests(docs: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row: number of ids, SHA-256 of the ids as decimals joined by commas,
    and SHA-256 of the text decoded from these ids. One row out for each row
    in, repeated and null ids included."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = spelling(path)
        for batch in batches:
            found = [d for part in batch_parts(batch.column(1), PART_BYTES) for d in vocab.digests(part.to_pylist())]
            counts, of_ids, of_text = zip(*found) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(of_ids, pa.string()),
                 pa.array(of_text, pa.string())],
                names=["id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    kind = docs.schema[id_column].dataType.simpleString()
    out = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text")).mapInArrow(
        rows, f"id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    )
    return out.withColumnRenamed("id", id_column)
