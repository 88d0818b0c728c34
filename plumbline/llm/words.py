"""Texts of an Arrow batch as flat numpy arrays: pieces of bounded size, words, word hashes."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
import xxhash
from pyspark.sql import Column
from pyspark.sql import functions as F

_WHITE = np.zeros(256, bool)
_WHITE[[9, 10, 11, 12, 13, 32]] = True
MIXER = np.uint64(0x9E3779B97F4A7C15)
PIECE_BYTES = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64): equal inputs give equal, well spread outputs."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def texts_of(array: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string array; null is empty."""
    return [text or b"" for text in array.cast(pa.binary()).to_pylist()]


def pieces(batches: Iterator[pa.RecordBatch], column: str, limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches in slices whose texts have at most ``limit`` bytes; a longer text comes alone.

    Workers live on after a task, several to an executor, and Arrow keeps what it has freed; after each batch that goes back.
    """
    for batch in batches:
        sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends, lo = np.cumsum(sizes, dtype=np.int64), 0
        while lo < len(sizes):
            before = ends[lo - 1] if lo else 0
            hi = max(lo + 1, int(np.searchsorted(ends, before + limit, side="right")))
            yield batch.slice(lo, hi - lo)
            lo = hi
        del batch
        pa.default_memory_pool().release_unused()


class Words:
    """The words ``[^\\x20\\x09-\\x0D]+`` of several texts.

    ``words`` are their bytes in order, ``first[i]:first[i + 1]`` those of text i;
    ``start`` and ``end`` are byte positions in ``raw``, where texts follow each other
    with one line end between.
    """

    def __init__(self, texts: list[bytes], lower: bool = False):
        joined = b"\n".join(texts)
        if lower:
            joined = joined.lower()  # of bytes: A-Z only
        self.raw = np.frombuffer(joined, np.uint8)
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        self.text_start = np.concatenate([[0], np.cumsum(sizes + 1)])
        edge = np.concatenate([[True], _WHITE[self.raw], [True]])
        edges = np.flatnonzero(edge[1:] != edge[:-1])
        self.start, self.end = edges[0::2], edges[1::2]
        self.words = joined.split()  # of bytes: these six white spaces
        self.first = np.searchsorted(self.start, self.text_start)
        self.counts = np.diff(self.first)

    @property
    def doc(self) -> np.ndarray:
        """The number of the text that each word belongs to."""
        return np.repeat(np.arange(len(self.counts)), self.counts)


class Memo(dict):
    """What ``make`` gives for a word, computed once; emptied between pieces when it is large."""

    def __init__(self, make: Callable[[bytes], int], limit: int = 400_000):
        super().__init__()
        self._make, self._limit = make, limit

    def __missing__(self, word: bytes) -> int:
        value = self[word] = self._make(word)
        return value

    def of(self, words: list[bytes], dtype=np.uint64) -> np.ndarray:
        if len(self) > self._limit:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), dtype, len(words))


def word_hashes() -> Memo:
    """64-bit hashes of words, the same on every machine."""
    return Memo(xxhash.xxh3_64_intdigest)


def grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """Rolling hashes of n neighbours; element i covers ``hashes[i:i + n]`` (texts are not told apart)."""
    if len(hashes) < n:
        return np.empty(0, np.uint64)
    out = hashes[: len(hashes) - n + 1].copy()
    for k in range(1, n):
        out = out * MIXER + hashes[k : len(hashes) - n + 1 + k]
    return mix(out)


def id_remainder(column: Column, divisor: int) -> Column:
    """crc32 of an id as text, modulo ``divisor``; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")), F.lit(divisor))


def documents(spark, sf_dir: str):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


class Numbers(dict):
    """Distinct words of one piece, numbered as they come; ``list(numbers)`` has them in that order."""

    def __missing__(self, word: bytes) -> int:
        value = self[word] = len(self)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))


def sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of ``values[first[i]:first[i + 1]]``, zero for empty stretches."""
    return np.diff(np.concatenate([[0], np.cumsum(values)])[first])
