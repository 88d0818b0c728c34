"""Language identification with hyperdimensional profiles.

A letter is a random vector of signs. An n-gram binds its letters: each vector is rotated
by the letter's distance from the end of the n-gram, and they are multiplied. A text bundles
(adds) its n-grams, a language bundles those of its training texts; texts go to the language
of the largest cosine, after the part common to all languages has been taken off both.

Everything that training adds up is whole numbers, so it does not depend on the order of tasks.
A model has one vector per language; that is what reaches the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from plumbline.llm.words import MIXER, mix, pieces, texts_of

DIMENSIONS = 1024
ORDER = 3
UNDETERMINED = "und"
_PIECE = 1 << 20  # bytes of text looked at together; a longer text comes alone
_BLOCK = 4096  # n-grams whose vectors are held at once
_MATRIX_CELLS = 2_000_000
_GAP = 0  # what is no letter; a run of it is one symbol


def letter_vectors(letters: np.ndarray, dimensions: int) -> np.ndarray:
    """A fixed random vector of -1 and 1 for each code point."""
    words = np.arange(dimensions // 64, dtype=np.uint64)
    bits = mix(mix(letters.astype(np.uint64)[:, None] + MIXER) ^ (words + np.uint64(1)) * MIXER)
    signs = np.unpackbits(bits.view(np.uint8).reshape(len(letters), -1), axis=1)
    return signs.astype(np.int8) * 2 - 1


class Profiles:
    """Bundles the n-grams of many texts."""

    def __init__(self, dimensions: int = DIMENSIONS, order: int = ORDER):
        self.dimensions, self.order = dimensions, order
        points = [chr(k) for k in range(0x3000)]
        lowered = [c.lower() for c in points]
        self.fold = np.array([ord(c) if c.isalpha() and len(c) == 1 else (ord(p) if p.isalpha() else _GAP) for p, c in zip(points, lowered)], np.uint32)

    def letters(self, raw: np.ndarray) -> np.ndarray:
        """Lower-cased letters as code points, anything else as 0."""
        if not len(raw) or raw.max() < len(self.fold):
            return self.fold[raw]
        out = self.fold[np.minimum(raw, len(self.fold) - 1)]
        far = np.flatnonzero(raw >= len(self.fold))
        kinds, at = np.unique(raw[far], return_inverse=True)
        folded = [chr(k) for k in kinds.tolist()]
        lower = [c.lower() if len(c.lower()) == 1 else c for c in folded]
        out[far] = np.array([ord(c) if c.isalpha() else _GAP for c in lower], np.uint32)[at]
        return out

    def count(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Letters; distinct n-grams, as codes over them; for each n-gram in the texts its text (ascending) and its number; which texts have a letter."""
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        raw = np.frombuffer("\0".join(["", *texts, ""]).encode("utf-32-le", "replace"), np.uint32)
        symbol = self.letters(raw)
        doc = np.zeros(len(raw), np.int32)
        starts = np.cumsum(np.concatenate([[1], sizes[:-1] + 1])) if len(texts) else np.empty(0, np.int64)
        doc[starts] = 1
        doc = np.maximum(np.cumsum(doc, dtype=np.int32) - 1, 0)
        some = np.bincount(doc[symbol != _GAP], minlength=len(texts)) > 0
        keep = np.concatenate([[True], (symbol[1:] != _GAP) | (symbol[:-1] != _GAP)])
        symbol, doc = symbol[keep], doc[keep]
        kinds, small = _number(symbol, 0x110000)
        n = self.order
        if len(symbol) < n:
            return kinds, np.empty(0, np.int64), np.empty(0, np.int32), np.empty(0, np.int64), some
        code = np.zeros(len(symbol) - n + 1, np.int64)
        for k in range(n):
            code = code * len(kinds) + small[k : len(small) - n + 1 + k]
        # an n-gram ends in its text and does not reach over a gap between words
        owner = doc[n - 1 :]
        inner = np.ones(len(code), bool)
        for k in range(1, n - 1):
            inner &= symbol[k : len(symbol) - n + 1 + k] != _GAP
        code, owner = code[inner], owner[inner]
        grams, number = _number(code, len(kinds) ** n)
        return kinds, grams, owner, number, some

    def bind(self, letters: np.ndarray, grams: np.ndarray) -> np.ndarray:
        """Vectors of n-grams, n-grams x dimensions."""
        bound = np.ones((len(grams), self.dimensions), np.int8)
        for k in range(self.order):
            bound *= np.roll(letters, k, axis=1)[grams % len(letters)]
            grams = grams // len(letters)
        return bound

    def bundle(self, texts: list[str], rows: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Sums of the vectors of all n-grams (``size`` x dimensions; text i adds to ``rows[i]``), and which texts have a letter.

        Vectors exist for one block of n-grams at a time, whatever the number of distinct ones. Sums are exact.
        """
        kinds, grams, owner, number, some = self.count(texts)
        letters, kind = letter_vectors(kinds, self.dimensions), np.float32 if len(owner) < 1 << 24 else np.float64
        out, owner = np.zeros((size, self.dimensions), kind), rows[owner]
        if len(grams) > _BLOCK:
            order = np.argsort(number // _BLOCK, kind="stable")
            owner, number = owner[order], number[order]
        ends = np.searchsorted(number // _BLOCK, np.arange(-(-len(grams) // _BLOCK) + 1)) if len(grams) > _BLOCK else [0, len(number)]
        for k, lo in enumerate(range(0, len(grams), _BLOCK)):
            to, at = owner[ends[k] : ends[k + 1]], number[ends[k] : ends[k + 1]] - lo
            vectors = self.bind(letters, grams[lo : lo + _BLOCK]).astype(kind)
            step = max(1, _MATRIX_CELLS // len(vectors))
            for first in range(0, size, step):
                last = min(first + step, size)
                mine = slice(None) if last - first == size else (to >= first) & (to < last)
                counts = np.bincount((to[mine] - first) * len(vectors) + at[mine], minlength=(last - first) * len(vectors))
                out[first:last] += counts.reshape(last - first, -1).astype(kind) @ vectors
        return out, some


def _number(values: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values in order, and each value's place among them; ``span`` is above all values."""
    if span > 4 * len(values) + 2_000_000:
        return np.unique(values, return_inverse=True)
    there = np.zeros(span, bool)
    there[values] = True
    distinct = np.flatnonzero(there)
    place = np.empty(span, np.int32)
    place[distinct] = np.arange(len(distinct))
    return distinct, place[values]


def _texts(batch: pa.RecordBatch, column: str) -> list[str]:
    return [t.decode("utf-8", "replace") for t in texts_of(batch.column(column))]


def _bundle(dimensions: int, order: int):
    """Sums of all vectors for each language that a task meets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        profiles, totals = Profiles(dimensions, order), {}
        for batch in pieces(batches, "text", _PIECE):
            languages = batch.column("lang").to_pylist()
            names = sorted(set(languages))
            which = np.array([names.index(x) for x in languages])
            added, _ = profiles.bundle(_texts(batch, "text"), which, len(names))
            for name, vector in zip(names, added.astype(np.int64)):
                totals[name] = totals.get(name, 0) + vector
        for name, vector in totals.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * dimensions, pa.string()), pa.array(np.arange(dimensions)), pa.array(vector)], ["lang", "place", "total"]
            )

    return run


def train(df: DataFrame, dimensions: int = DIMENSIONS, order: int = ORDER) -> tuple[list[str], np.ndarray]:
    """Languages in order, and their unit vectors (languages x dimensions), from columns ``text, lang`` without nulls."""
    sums = df.select("text", "lang").mapInArrow(_bundle(dimensions, order), "lang string, place long, total long")
    rows = sums.groupBy("lang", "place").agg(F.sum("total").alias("total")).toArrow()
    names = sorted(set(rows.column("lang").to_pylist()))
    table = np.zeros((len(names), dimensions))
    at = {name: k for k, name in enumerate(names)}
    table[[at[x] for x in rows.column("lang").to_pylist()], rows.column("place").to_numpy()] = rows.column("total").to_numpy()
    return names, _unit(table)


def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)


def _predict(names: list[str], prototypes: np.ndarray, dimensions: int, order: int, carry: list[str], text_column: str):
    shared = prototypes.mean(axis=0) if len(names) > 1 else np.zeros(dimensions)
    centred = _unit(prototypes - shared).astype(np.float32)
    shared = shared.astype(np.float32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        profiles = Profiles(dimensions, order)
        for batch in pieces(batches, text_column, _PIECE):
            texts = _texts(batch, text_column)
            bundles, some = profiles.bundle(texts, np.arange(len(texts)), len(texts))
            cosine = _unit(_unit(bundles.astype(np.float32)) - shared) @ centred.T
            picked = cosine.argmax(axis=1) if names else np.zeros(len(texts), np.int64)
            score = cosine.max(axis=1).astype(float) if names else np.zeros(len(texts))
            known = some & bool(names)
            answer = [names[p] if yes else UNDETERMINED for p, yes in zip(picked.tolist(), known.tolist())]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in carry), pa.array(answer, pa.string()), pa.array(np.where(known, np.clip(score, 0, 1), 0.0))],
                [*carry, "lang_pred", "score"],
            )

    return run


def identify(
    df: DataFrame, training: Column, id_column: str = "doc_id", text_column: str = "text", lang_column: str = "lang", *,
    carry: tuple[str, ...] = (), dimensions: int = DIMENSIONS, order: int = ORDER,
) -> DataFrame:
    """One row per row of ``df``: the id, columns named in ``carry``, ``held_out`` (``training`` is false), ``lang_pred``,
    ``score`` (the cosine, 0 to 1). Carried columns of these names are replaced.

    Learns from rows of ``training`` with text and language. A null text, or one without a letter, is ``und`` with score 0,
    and so is everything if there is nothing to learn from. Equal cosines go to the first language in order.
    Repeated rows are answered each; other columns are not looked at.
    """
    held_out = ~F.coalesce(training, F.lit(False))
    learnt = df.where(~held_out & F.col(text_column).isNotNull() & F.col(lang_column).isNotNull())
    names, prototypes = train(
        learnt.select(F.col(text_column).alias("text"), F.col(lang_column).alias("lang")), dimensions, order
    )
    carried = [c for c in dict.fromkeys([id_column, *carry]) if c not in ("held_out", "lang_pred", "score")]
    sent = text_column if text_column in carried else "_text"  # a carried text is sent once
    source = df.select(*carried, held_out.alias("held_out"), *([] if sent in carried else [F.col(text_column).alias(sent)]))
    fields = source.schema.fields[: len(carried) + 1]
    schema = StructType([*fields, StructField("lang_pred", StringType()), StructField("score", DoubleType())])
    return source.mapInArrow(_predict(names, prototypes, dimensions, order, [f.name for f in fields], sent), schema)
