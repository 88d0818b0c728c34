"""Toxicity of texts: a linear-chain conditional random field over tokens.

Labels are of whole texts. Tokens get theirs from words that mark toxic texts: the log-odds of
each word and word beginning over labelled training texts, counted in Spark. The field learns those tags with
features of the word, its ends and its neighbours, so that it also tags what it has not seen spelled
that way. Marginal probabilities of the tokens become offsets and, by a logistic model on the
texts' labels, the score of the text.

The classifier is fitted on a bounded sample of labelled rows: words are counted in ``fit_texts`` texts of each
label, those with the smallest hashes of their ids; the field and the logistic model see ``sample_texts`` of
these. The field is fitted on chains of words taken evenly from the whole of each, some ``sample_words`` words; the logistic model
on what the field says of whole texts. The shares of the labels are of all rows. So only ids are joined with
labels, and no text is shuffled. Scoring reads whole texts.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.crf import Crf, train
from plumbline.llm.words import Words, pieces, texts_of
from plumbline.sources.staging import Staging

FEATURES = 1 << 18
BEGINNINGS = (5, 6, 7, 8)  # characters of word beginnings that are looked at
FIT_TEXTS = 10_000
SAMPLE_TEXTS, SAMPLE_WORDS = 600, 1000
CHAIN = 128  # words of a chain; longer texts are several
MARKERS = 10_000
_LOG_ODDS, _TEXTS, _EVIDENCE = math.log(8.0), 5, 25.0
_FLUSH = 300_000
_EDGES = b".,;:!?\"'()[]{}<>"


@dataclass(frozen=True)
class ToxicityModel:
    field: Crf
    logistic: np.ndarray


def _units(word: bytes) -> list[bytes]:
    """A word without its punctuation, and its beginnings (marked by a space behind them)."""
    bare = word.strip(_EDGES)
    text = bare.decode("utf-8", "replace")
    return [bare, *(text[:n].encode() + b" " for n in BEGINNINGS if len(text) > n)] if bare else []


class _Units(dict):
    def __missing__(self, word: bytes) -> list[bytes]:
        value = self[word] = _units(word)
        return value


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In how many toxic and other texts each word and beginning occurs; the row of the empty word counts the texts."""

    def rows(counts: dict[bytes, list[int]]) -> pa.RecordBatch:
        a, b = zip(*counts.values())
        return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), pa.array(a), pa.array(b)], ["word", "toxic", "clean"])

    counts: dict[bytes, list[int]] = {}
    units = _Units()
    for batch in pieces(batches, "text"):
        if len(units) > _FLUSH:
            units.clear()
        for text, toxic in zip(texts_of(batch.column("text")), batch.column("toxic").to_pylist()):
            for word in {b""}.union(*map(units.__getitem__, set(text.lower().split()))):
                counts.setdefault(word, [0, 0])[0 if toxic else 1] += 1
        if len(counts) > _FLUSH:
            yield rows(counts)
            counts = {}
    if counts:
        yield rows(counts)


def _hash(part: bytes) -> int:
    return zlib.crc32(part) % FEATURES


_BEGIN_MARKS = [(n, b"b%d " % n) for n in BEGINNINGS]
_SHORT = _hash(b"short")


class _WordFeatures(dict):
    """Numbers of words, and a table of the features that each has by itself; emptied when it is large."""

    def __init__(self, limit: int = 300_000):
        super().__init__()
        self.limit, self.table, self.new = limit, np.empty((0, 2 + len(BEGINNINGS)), np.int64), []

    def __missing__(self, word: bytes) -> int:
        bare = word.strip(_EDGES)
        text = bare.decode("utf-8", "replace")
        begins = [_hash(mark + text[:n].encode()) if len(text) > n else _SHORT for n, mark in _BEGIN_MARKS]  # not the whole word
        self.new.append((_hash(b"w" + bare), _hash(b"t" + bare[-4:]), *begins))
        value = self[word] = len(self)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        if len(self) > self.limit:
            self.clear()
            self.table = self.table[:0]
        at = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        if self.new:
            self.table = np.concatenate([self.table, np.array(self.new, np.int64)])
            self.new = []
        return self.table[at]


def _features(words: Words, known: _WordFeatures) -> tuple[np.ndarray, np.ndarray]:
    """The features of each word, and the bounds of the chains."""
    alone = known.of(words.words)
    own, size = alone[:, 0], len(alone)
    index = np.arange(size) - np.repeat(words.first[:-1], words.counts)
    starts = index % CHAIN == 0
    before, after = np.full(size, _hash(b"<first>")), np.full(size, _hash(b"<last>"))
    before[1:] = np.where(starts[1:], before[1:], (own[:-1] * 31 + 7) % FEATURES)
    after[:-1] = np.where(starts[1:], after[:-1], (own[1:] * 37 + 11) % FEATURES)
    bias = np.full(size, _hash(b"<any>"))
    return np.column_stack([alone, before, after, bias]), np.append(np.flatnonzero(starts), size)


def _summary(p: np.ndarray, words: Words) -> np.ndarray:
    """Per text: a constant, the probability of at least one toxic token, the expected number and share of them, and the second and third largest probabilities."""
    first, doc = words.first, words.doc
    likely = np.flatnonzero(p > 0.02)
    likely = likely[np.lexsort((-p[likely], doc[likely]))]
    owner = doc[likely]
    place = np.arange(len(likely)) - np.searchsorted(owner, owner)
    largest = np.zeros((len(words.counts), 2))
    for k in (1, 2):
        largest[owner[place == k], k - 1] = p[likely[place == k]]
    upto = np.concatenate([[0.0], np.cumsum(p)])
    expected = np.diff(upto[first])
    none = np.diff(np.concatenate([[0.0], np.cumsum(np.log1p(-np.minimum(p, 1 - 1e-9)))])[first])
    some = 1 - np.exp(none)
    n = np.maximum(words.counts, 1)
    return np.stack([np.ones(len(n)), some, np.log1p(np.maximum(expected, 0)), np.minimum(100 * expected / n, 10) / 10, *largest.T], axis=1)


def _logistic(x: np.ndarray, y: np.ndarray, rounds: int = 50) -> np.ndarray:
    """Newton's method with a small ridge, classes weighted as they are."""
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (y - p) - 0.1 * w
        curve = (x * (p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(len(w))
        move = np.linalg.solve(curve, slope)
        w += move
        if np.abs(move).max() < 1e-9:
            break
    return w


def _chains(most: int):
    """Each text's chains; of a text with more than ``most``, so many evenly from its first to its last."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            found, toxic = [], []
            for text, label in zip(texts_of(batch.column("text")), batch.column("toxic").to_pylist()):
                words = text.split()
                chains = -(-len(words) // CHAIN)
                for k in range(chains) if chains <= most else np.linspace(0, chains - 1, most).round().astype(int).tolist():
                    found.append(b" ".join(words[k * CHAIN : (k + 1) * CHAIN]).decode("utf-8", "replace"))
                    toxic.append(label)
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.string()), pa.array(toxic, pa.int32())], ["text", "toxic"])

    return run


def _summaries(field: Crf):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _WordFeatures()
        for batch in pieces(batches, "text"):
            words = Words(texts_of(batch.column("text")), lower=True)
            x = _summary(field.marginals(*_features(words, known)), words)
            yield pa.RecordBatch.from_arrays([pa.array(x.tolist(), pa.list_(pa.float64())), batch.column("toxic").cast(pa.int32())], ["x", "toxic"])

    return run


def fit(
    labelled: DataFrame, shares: dict[int, int], staging: Staging, sample_texts: int = SAMPLE_TEXTS, sample_words: int = SAMPLE_WORDS
) -> ToxicityModel:
    """From columns ``id, text, toxic`` (0 or 1); ``shares`` are the numbers of either label in all rows."""
    counts = labelled.select("text", "toxic").mapInArrow(_word_counts, "word binary, toxic long, clean long")
    counts = counts.groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    counts = staging.put(counts, "word-labels")
    texts = counts.where(F.col("word") == F.lit(b"")).first() or {"toxic": 0, "clean": 0}
    rate = lambda name: (F.col(name) + 0.5) / (texts[name] + 1)
    odds = F.log(rate("toxic") / rate("clean"))
    # the likelihood ratio against a word that falls on texts of both kinds alike
    share, n = texts["toxic"] / max(1, texts["toxic"] + texts["clean"]), F.col("toxic") + F.col("clean")
    part = lambda name, p: F.when(F.col(name) > 0, F.col(name) * F.log(F.col(name) / (n * max(p, 1e-9)))).otherwise(0.0)
    evidence = 2 * (part("toxic", share) + part("clean", 1 - share))
    sure = (F.col("toxic") >= _TEXTS) & (odds >= _LOG_ODDS) & (evidence >= _EVIDENCE) & (F.col("word") != F.lit(b""))
    ranked = counts.where(sure).orderBy(F.desc(evidence), "word").limit(MARKERS)
    markers = {bytes(r.word) for r in ranked.collect()}

    sample = labelled.where("text is not null")
    picked = [sample.where(F.col("toxic") == label).orderBy(F.xxhash64("id"), "id", "text").limit(sample_texts).select("text", "toxic") for label in (0, 1)]
    picked = staging.put(picked[0].union(picked[1]), "sample")  # at most 2 * sample_texts rows
    rows = picked.mapInArrow(_chains(-(-sample_words // CHAIN)), "text string, toxic int").collect()
    rows.sort()
    words = Words([r.text.encode() for r in rows], lower=True)
    features, chains = _features(words, _WordFeatures())
    tags = np.array([not markers.isdisjoint(_units(w)) for w in words.words], np.int64)
    # words of clean texts are clean whatever they are; a marker there would be a false friend
    clean = np.array([r.toxic == 0 for r in rows], bool)
    tags[clean[words.doc]] = 0
    field = train(features, chains, tags, FEATURES) if len(tags) else Crf(np.zeros((FEATURES, 2)), np.array([0.0, -9.0]), np.zeros((2, 2)))

    # the sample is balanced, the corpus is not: weights of the logistic model restore the labels' shares
    field = Crf(field.weights.astype(np.float32), field.start, field.step)
    seen = sorted(picked.mapInArrow(_summaries(field), "x array<double>, toxic int").collect())
    x, y = np.array([r.x for r in seen]), np.array([r.toxic for r in seen], float)
    logistic = np.array([-4.0, 8.0, 0.0, 0.0, 0.0, 0.0])
    if 0 < y.sum() < len(y):
        logistic = _logistic(x, y)
        logistic[0] += math.log(shares[1] / shares[0]) - math.log(y.sum() / (len(y) - y.sum()))
    return ToxicityModel(field, logistic)


def _score(model: ToxicityModel, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _WordFeatures()
        span = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("probability", pa.float64())])
        for batch in pieces(batches, "text", 2 << 20):
            words = Words(texts_of(batch.column("text")), lower=True)
            features, chains = _features(words, known)
            p = model.field.marginals(features, chains)
            score = 1 / (1 + np.exp(-np.clip(_summary(p, words) @ model.logistic, -30, 30)))
            point = np.cumsum((words.raw & 0xC0) != 0x80)  # code points up to each byte
            spans = [[] for _ in range(len(words.counts))]
            doc = words.doc
            for k in np.flatnonzero(p >= threshold).tolist():
                base = point[words.text_start[doc[k]]] if words.text_start[doc[k]] < len(point) else 0
                spans[doc[k]].append({"start": int(point[words.start[k]] - base), "end": int(point[words.end[k] - 1] - base + 1), "probability": float(p[k])})
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("held_out"), pa.array(score), pa.array((score >= 0.5).astype(np.int32)), pa.array(spans, pa.list_(span))],
                ["id", "held_out", "score", "predicted", "spans"],
            )

    return run


def toxicity(
    df: DataFrame, labels: DataFrame, training: Column, id_column: str = "doc_id", text_column: str = "text", label_column: str = "toxic", *,
    threshold: float = 0.5, fit_texts: int = FIT_TEXTS, sample_texts: int = SAMPLE_TEXTS, sample_words: int = SAMPLE_WORDS, staging: Staging | None = None,
) -> DataFrame:
    """One row per row of ``df``: the id, ``held_out`` (``training`` is false), ``score``, ``predicted``, ``spans``.

    ``labels`` has the id column and ``label_column`` (0, 1 or null); several labels of an id count as toxic if one is.
    ``spans`` are the tokens tagged toxic: start, end (code points, end exclusive), probability. A null or empty text has the score
    of a text without toxic tokens. Without labels of both kinds a fixed logistic model is used. Repeated rows are scored each.
    """
    staging = staging or Staging(df.sparkSession)
    source = df.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"), (~F.coalesce(training, F.lit(False))).alias("held_out"))
    learnt = source.where("not held_out")
    marks = labels.where(F.col(label_column).isNotNull()).groupBy(F.col(id_column).alias("id"))
    marks = marks.agg(F.max((F.col(label_column) != 0).cast("int")).alias("toxic"))
    marks = staging.put(marks.join(learnt.select("id"), "id", "left_semi"), "labels")
    shares = dict(marks.groupBy("toxic").count().collect())
    chosen = [marks.where(F.col("toxic") == label).orderBy(F.xxhash64("id"), "id").limit(fit_texts) for label in (0, 1)]
    chosen = staging.put(chosen[0].union(chosen[1]), "chosen")  # at most 2 * fit_texts rows
    labelled = staging.put(learnt.join(F.broadcast(chosen), "id").select("id", "text", "toxic"), "labelled")
    model = fit(labelled, shares, staging, sample_texts, sample_words)
    kind = source.schema["id"].dataType.simpleString()
    found = source.mapInArrow(
        _score(model, threshold),
        f"id {kind}, held_out boolean, score double, predicted int, spans array<struct<start:bigint,end:bigint,probability:double>>",
    )
    return found.withColumnRenamed("id", id_column)
