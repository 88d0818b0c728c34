"""Quality rules on repetition: how many characters of a text lie in n-grams or lines seen before.

Words become numbers, n-grams rolling hashes over them, in flat numpy arrays for many texts
at once. A window of n + 1 words can only repeat where a window of n words does, so each
length looks at what the shorter one left; prose leaves little.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DoubleType, LongType, StructField, StructType

from plumbline.llm.words import MIXER, Numbers, Words, mix, pieces, sums, texts_of

LENGTHS = (5, 6, 7, 8, 9, 10)
# Largest shares of a text's word characters in repeated n-grams of 5 to 10 words, and in repeated
# lines: fixed values of the published Gopher rules.
NGRAM_LIMITS = (0.15, 0.14, 0.13, 0.12, 0.11, 0.10)
LINE_CHARS_LIMIT = 0.20
LINES_LIMIT = 0.30
_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[[ord(c) for c in "#*$%&|<>"]] = True


def _repeats(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which keys occur more than once, and which have occurred before."""
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    same = np.zeros(len(keys) + 1, bool)
    same[1:-1] = ranked[1:] == ranked[:-1]
    repeated, later = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
    repeated[order], later[order] = same[1:] | same[:-1], same[:-1]
    return repeated, later


def _covered(starts: np.ndarray, n: int, size: int) -> np.ndarray:
    """Which of ``size`` words lie in a window of n words that begins at one of ``starts``."""
    edge = np.bincount(starts, minlength=size + 1) - np.bincount(starts + n, minlength=size + 1)[: size + 1]
    return np.cumsum(edge[:size]) > 0


def measure(texts: list[bytes], lengths: tuple[int, ...] = LENGTHS) -> dict[str, np.ndarray]:
    """Counts per text; ``ngram_chars`` has one column per length."""
    w = Words(texts)
    size, docs = len(w.words), len(texts)
    starts_char = (w.raw & 0xC0) != 0x80
    upto = np.concatenate([[0], np.cumsum(starts_char)])
    chars = upto[w.end] - upto[w.start]
    code = Numbers().of(w.words).astype(np.uint64)
    doc = w.doc
    left = w.first[doc + 1] - np.arange(size)  # words from here to the end of the text
    salt = mix(doc.astype(np.uint64) + np.uint64(1))

    out = {"n_words": w.counts, "word_chars": sums(chars, w.first), "n_symbols": _between(_SYMBOLS[w.raw], w.text_start)}
    at, hashed, ngram_chars = np.arange(size), mix(code + salt), []
    mixed = mix(code + MIXER)
    for n in range(2, max(3, *lengths) + 1):
        fits = left[at] >= n
        at, hashed = at[fits], hashed[fits]
        hashed = mix(hashed * MIXER + mixed[at + n - 1])
        repeated, later = _repeats(hashed)
        if n == 3:
            out["n_repeat_words"] = sums(_covered(at[repeated], n, size), w.first)
        if n in lengths:  # what a second or later occurrence covers
            ngram_chars.append(sums(np.where(_covered(at[later], n, size), chars, 0), w.first))
        at, hashed = at[repeated], hashed[repeated]
    out["ngram_chars"] = np.stack(ngram_chars, axis=1) if ngram_chars else np.zeros((docs, 0), np.int64)

    dup_lines, dup_chars, lines = np.zeros(docs, np.int64), np.zeros(docs, np.int64), np.zeros(docs, np.int64)
    blank = b" \t\r\x0b\x0c"
    for k, text in enumerate(texts):
        seen = set()
        for line in text.split(b"\n"):
            if line.strip(blank):
                lines[k] += 1
                if line in seen:
                    dup_lines[k] += 1
                    dup_chars[k] += len(b"".join(line.split()).decode("utf-8", "replace"))
                seen.add(line)
    return out | {"n_lines": lines, "n_dup_lines": dup_lines, "dup_line_chars": dup_chars}


def _between(flags: np.ndarray, text_start: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags)])
    return total[text_start[1:] - 1] - total[text_start[:-1]]


_COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "dup_line_chars"]


def repetition(
    df: DataFrame, id_column: str = "doc_id", text_column: str = "text", *, lengths: tuple[int, ...] = LENGTHS,
    ngram_limits: tuple[float, ...] = NGRAM_LIMITS, line_chars_limit: float = LINE_CHARS_LIMIT, lines_limit: float = LINES_LIMIT,
) -> DataFrame:
    """One row per row of ``df``: the id, counts, ``base_failed``, ``kept``, and the measured shares.

    Words are runs of anything but space, tab and line breaks; a null text has none and fails. A text is kept
    unless it has under 50 words, more than half its words in repeated windows of three, or a share of word
    characters in repeated n-grams or lines, or of lines, above its limit. Repeated rows are judged each;
    null ids stay null; other columns are not looked at.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            found = measure(texts_of(batch.column("text")), lengths)
            shares = found["ngram_chars"] / np.maximum(found["word_chars"], 1)[:, None]
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(shares) + 1, dtype=np.int32) * len(lengths)), pa.array(shares.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(found[c]) for c in _COUNTS), lists], ["id", *_COUNTS, "shares"])

    source = df.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    schema = StructType(
        [source.schema["id"], *(StructField(c, LongType()) for c in _COUNTS), StructField("shares", ArrayType(DoubleType()))]
    )
    found = source.mapInArrow(run, schema)
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    line_chars = F.col("dup_line_chars") / F.greatest("word_chars", F.lit(1))
    lines = F.col("n_dup_lines") / F.greatest("n_lines", F.lit(1))
    within: Column = (line_chars <= line_chars_limit) & (lines <= lines_limit)
    for k, limit in enumerate(ngram_limits):
        within &= F.col("shares")[k] <= limit
    return found.select(
        F.col("id").alias(id_column), *_COUNTS[:5], failed.alias("base_failed"), (~failed & within).alias("kept"),
        line_chars.alias("dup_line_char_share"), lines.alias("dup_line_share"),
        *(F.col("shares")[k].alias(f"dup_{n}gram_char_share") for k, n in enumerate(lengths)),
    )
