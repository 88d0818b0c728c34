"""Hard negatives by a secondary sort: one ordered stream of scores per anchor, positives open windows, negatives fall into them.

Scores of a pair become a key (anchor, falling score, positives first, id) of fixed width, whose
bytes sort as the tuple does. Keys are dealt out by anchor and sorted within partitions (repartition
and sort within partitions, which spills), and an iterator reads them once: it holds the open
windows of one anchor and nothing else, so an anchor's keys are never gathered.

Before that shuffle the tasks keep what can matter. Anchors come in chunks of bounded size, scored
against all rows in blocks. A first pass keeps each task's best positives of each anchor; their
shuffle gives the scores at which windows open. A second pass keeps for each window the best
negatives inside it. A pair among the first of all rows is among the first of its task, so
nothing is lost, and a task sends at most ``positives * (1 + negatives)`` keys per anchor, whatever
its rows are.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.vectors import matrices
from plumbline.sources.staging import Staging

POSITIVES, NEGATIVES = 5, 5
LEAST = (4, 5)  # a negative has at least this share of the positive's score
SCALE = 256.0
CHUNK = 4096  # anchors that a pass scores
_CELLS = 1 << 21  # scores in memory at once
_EXACT = 2**53
_TOP = 2**63 - 1


def _quantised(matrix: np.ndarray, scale: float) -> np.ndarray:
    """floor(scale * v): whole numbers, as doubles."""
    with np.errstate(over="ignore"):
        return np.floor(np.nan_to_num(matrix * scale))


def _identities(labels: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Hashes that tell rows of one id apart; repeats of a row share it."""
    return np.array([xxhash.xxh3_64_intdigest(row.tobytes(), seed=int(label) & 0xFFFFFFFF) >> 1 for row, label in zip(x + 0.0, labels.tolist())], np.int64)


def _scores(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Inner products of all rows as int64, exact, held to a long's range; of unlike lengths, over what both have."""
    d = min(x.shape[1], y.shape[1])
    x, y = x[:, :d], y[:, :d]
    if np.abs(x).max(initial=0) * np.abs(y).max(initial=0) * d < _EXACT:
        return (x @ y.T).astype(np.int64)
    exact = [np.array([[int(v) for v in row] for row in m.tolist()], object).reshape(m.shape) for m in (x, y)]
    return np.clip(exact[0] @ exact[1].T, -_TOP, _TOP).astype(np.int64).reshape(len(x), len(y))


@dataclass(frozen=True)
class _Anchors:
    """A chunk of anchors; ``windows`` are the scores of their positives, the rest of a row filled with ``none``."""

    ids: np.ndarray
    labels: np.ndarray
    marks: np.ndarray
    groups: list[tuple[np.ndarray, np.ndarray]]  # anchors of one length: their numbers and vectors

    def scores(self, x: np.ndarray) -> np.ndarray:
        out = np.empty((len(x), len(self.ids)), np.int64)
        for at, y in self.groups:
            out[:, at] = _scores(x, y)
        return out


class _Best:
    """The first ``most`` (score, id, mark) of each of so many slots, higher scores first, then smaller ids."""

    def __init__(self, slots: int, most: int):
        self.most, self.slots = most, slots
        self.slot = self.score = self.id = self.mark = np.empty(0, np.int64)
        self._worst, self._worst_id = np.full(slots, -(2**63), np.int64), np.full(slots, _TOP, np.int64)

    def beats(self, slots: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Where a score can still be among the first of its slot."""
        worst = self._worst[slots]
        return (scores > worst) | ((scores == worst) & (ids <= self._worst_id[slots]))

    def add(self, slot: np.ndarray, score: np.ndarray, ids: np.ndarray, mark: np.ndarray) -> None:
        slot, score = np.concatenate([self.slot, slot]), np.concatenate([self.score, score])
        ids, mark = np.concatenate([self.id, ids]), np.concatenate([self.mark, mark])
        order = np.lexsort((mark, ids, ~score, slot))
        slot, score, ids, mark = slot[order], score[order], ids[order], mark[order]
        new = np.ones(len(slot), bool)
        new[1:] = (np.diff(slot) != 0) | (np.diff(score) != 0) | (np.diff(ids) != 0) | (np.diff(mark) != 0)
        slot, score, ids, mark = slot[new], score[new], ids[new], mark[new]
        rank = np.arange(len(slot)) - np.searchsorted(slot, slot)
        keep = rank < self.most
        self.slot, self.score, self.id, self.mark = slot[keep], score[keep], ids[keep], mark[keep]
        last = rank[keep] == self.most - 1
        self._worst[self.slot[last]], self._worst_id[self.slot[last]] = self.score[last], self.id[last]


def _key_bytes(anchor: np.ndarray, mark: np.ndarray, score: np.ndarray, kind: int, ids: np.ndarray, other: np.ndarray) -> pa.Array:
    """Keys whose bytes sort by anchor, falling score, kind, id."""
    sign = np.int64(-(2**63))
    columns = [anchor ^ sign, mark, ~score ^ sign, ids ^ sign, other]
    data = [np.ascontiguousarray(c.astype(">i8")).view(np.uint8).reshape(-1, 8) for c in columns]
    data = np.hstack([*data[:3], np.full((len(anchor), 1), kind, np.uint8), *data[3:]])
    offsets = np.arange(len(data) + 1, dtype=np.int32) * 41
    return pa.Array.from_buffers(pa.binary(), len(data), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))])


def _read_keys(array: pa.Array) -> list[tuple[int, int, int, int, int, int]]:
    """(anchor, its mark, score, kind, id, its mark) of keys, in their order."""
    data = np.frombuffer(b"".join(array.to_pylist()), np.uint8).reshape(-1, 41)
    number = lambda lo: np.ascontiguousarray(data[:, lo : lo + 8]).view(">i8").ravel().astype(np.int64)
    sign = np.int64(-(2**63))
    columns = [number(0) ^ sign, number(8), ~(number(16) ^ sign), data[:, 24], number(25) ^ sign, number(33)]
    return list(zip(*(column.tolist() for column in columns)))


def _in_order(keys: DataFrame) -> DataFrame:
    """Keys of one anchor in one partition, sorted: the secondary-sort shuffle."""
    return keys.repartition(F.substring("key", 1, 16)).sortWithinPartitions("key")


def _first(keys: DataFrame, most: int, fields: str) -> DataFrame:
    """The first so many keys of each anchor as (anchor, its mark, score); repeats count once."""

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, last, count = None, None, 0
        for batch in batches:
            out = []
            for key in _read_keys(batch.column(0)):
                if key == last:
                    continue
                last = key
                if key[:2] != held:
                    held, count = key[:2], 0
                count += 1
                if count <= most:
                    out.append((key[0], key[1], key[2], key[4], key[5]))
            yield _batch(out, fields)

    return _in_order(keys).mapInArrow(stream, fields)


def _batch(rows: list[tuple], fields: str) -> pa.RecordBatch:
    names, kinds = zip(*(field.split() for field in fields.split(", ")))
    columns = zip(*rows) if rows else [()] * len(names)
    types = {"long": pa.int64(), "int": pa.int32()}
    return pa.RecordBatch.from_arrays([pa.array(c, types[k]) for c, k in zip(columns, kinds)], names=list(names))


@dataclass(frozen=True)
class Mining:
    positives: int = POSITIVES
    negatives: int = NEGATIVES
    least: tuple[int, int] = LEAST
    scale: float = SCALE
    chunk: int = CHUNK

    def inside(self, positive, negative):
        """least * positive <= negative <= positive, in whole numbers."""
        return (negative <= positive) & (negative >= self._low(positive))

    def _low(self, positive):
        """The least whole number that is at least the share of a score."""
        share, of = self.least
        if isinstance(positive, np.ndarray):
            return positive // of * share - (-(positive % of * share) // of)
        return -(-positive * share // of)

    def _rows(self, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """(ids, labels, marks, vectors) of the rows that take part."""
        for batch in batches:
            known = ~(batch.column("id").is_null().to_numpy(zero_copy_only=False) | batch.column("label").is_null().to_numpy(zero_copy_only=False))
            ids, labels = (batch.column(c).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("id", "label"))
            for at, matrix in matrices(batch.column("vector"), known):
                x = _quantised(matrix, self.scale)
                yield ids[at], labels[at], _identities(labels[at], x), x

    def _blocks(self, batches: Iterator[pa.RecordBatch], anchors: _Anchors):
        step = max(1, _CELLS // max(1, len(anchors.ids)))
        for ids, labels, marks, x in self._rows(batches):
            for lo in range(0, len(ids), step):
                cut = slice(lo, lo + step)
                yield ids[cut], labels[cut], marks[cut], anchors.scores(x[cut])

    def positives_of(self, rows: DataFrame, anchors: _Anchors) -> DataFrame:
        """Keys of each task's best rows of an anchor's label; the anchor's own row does not count."""

        def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            found = _Best(len(anchors.ids), self.positives)
            slots = np.arange(len(anchors.ids))[None, :]
            for ids, labels, marks, scores in self._blocks(batches, anchors):
                fit = labels[:, None] == anchors.labels[None, :]
                fit &= (ids[:, None] != anchors.ids[None, :]) | (marks[:, None] != anchors.marks[None, :])
                fit &= found.beats(slots, scores, ids[:, None])
                row, slot = np.nonzero(fit)
                found.add(slot, scores[row, slot], ids[row], marks[row])
            s = found.slot
            yield pa.RecordBatch.from_arrays([_key_bytes(anchors.ids[s], anchors.marks[s], found.score, 0, found.id, found.mark)], names=["key"])

        return rows.mapInArrow(best, "key binary")

    def negatives_of(self, rows: DataFrame, anchors: _Anchors, windows: np.ndarray) -> DataFrame:
        """Keys of each task's best rows of other labels inside each window; ``windows`` has a row of scores per anchor, unused ones are -1."""

        def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            width = windows.shape[1]
            found = _Best(windows.size, self.negatives)
            lows = np.where(windows >= 0, self._low(windows), _TOP)
            slots = np.arange(windows.size).reshape(windows.shape)
            for ids, labels, marks, scores in self._blocks(batches, anchors):
                other = labels[:, None] != anchors.labels[None, :]
                for k in range(width):
                    fit = other & (scores <= windows[None, :, k]) & (scores >= lows[None, :, k])
                    fit &= found.beats(slots[None, :, k], scores, ids[:, None])
                    row, anchor = np.nonzero(fit)
                    found.add(slots[anchor, k], scores[row, anchor], ids[row], marks[row])
            a = found.slot // max(width, 1)
            yield pa.RecordBatch.from_arrays([_key_bytes(anchors.ids[a], anchors.marks[a], found.score, 1, found.id, found.mark)], names=["key"])

        return rows.mapInArrow(best, "key binary")

    def emitted(self, keys: DataFrame) -> DataFrame:
        """Negatives per anchor and positive, from keys of positives (kind 0) and negatives (kind 1)."""
        fields = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"

        def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            anchor, last, opened, windows = None, None, 0, []
            for batch in batches:
                out = []
                for key in _read_keys(batch.column(0)):
                    if key == last:
                        continue
                    last = key
                    if key[:2] != anchor:
                        anchor, opened, windows = key[:2], 0, []
                    _, _, score, kind, other, _ = key
                    if kind == 0:
                        if opened < self.positives:
                            windows.append([score, other, 0])
                            opened += 1
                        continue
                    windows = [w for w in windows if w[2] < self.negatives and self.inside(w[0], score)]
                    for window in windows:
                        window[2] += 1
                        out.append((anchor[0], window[1], window[2], other, window[0], score))
                yield _batch(out, fields)

        return _in_order(keys).mapInArrow(stream, fields)


def mine_hard_negatives(
    vectors: DataFrame, anchors: Column, *, key: str = "vec_id", column: str = "embedding", label: str | Column = "label",
    staging: Staging | None = None, mining: Mining = Mining(),
) -> DataFrame:
    """Hard negatives for the rows where ``anchors`` holds: anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    A score is the inner product of floor(scale * v). An anchor's positives are its first rows of
    the same label; its negatives, per positive, the first rows of other labels whose score is at
    most the positive's and at least the least share of it (none, then, for scores below zero). Higher scores come first, ties by smaller id.
    Rows whose id, label or vector is null, or whose vector holds nulls or no finite numbers, take
    no part. A row repeated with its id, label and vector counts once; rows that share an id only
    are rows of their own. Vectors of unlike length are compared over what both have. Scores are
    held to the range of a long. Empty tables, and anchors without positives or negatives, give no
    rows; no other column is read.
    """
    spark = vectors.sparkSession
    staging = staging or Staging(spark)
    label = F.col(label) if isinstance(label, str) else label
    rows = vectors.select(F.col(key).cast("long").alias("id"), F.col(column).alias("vector"), label.cast("long").alias("label"), F.coalesce(anchors, F.lit(False)).alias("anchor"))
    everything = rows.select("id", "label", "vector")

    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, labels, marks, x in mining._rows(batches):
            vectors = pa.array(list(x), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(labels), pa.array(marks), vectors], names=["id", "label", "mark", "x"])

    asked = rows.where("anchor").select("id", "label", "vector").mapInArrow(chosen, "id long, label long, mark long, x array<double>")
    asked = staging.put(asked.dropDuplicates(["id", "label", "mark"]), "anchors")
    chunks = -(-2 * asked.count() // mining.chunk)  # hashing deals out half a chunk, give or take a little
    results = []
    for number in range(chunks):
        mine = asked.where(F.pmod(F.xxhash64("id", "mark"), F.lit(chunks)) == number).toPandas()
        if len(mine):
            results.append(_mine_chunk(everything, mine, mining, staging))
    if not results:
        return mining.emitted(spark.createDataFrame([], "key binary"))
    return reduce(DataFrame.union, results)


def _mine_chunk(rows: DataFrame, mine, mining: Mining, staging: Staging) -> DataFrame:
    lengths = mine["x"].map(len).to_numpy()
    groups = [(at, np.array(mine["x"].iloc[at].tolist(), float).reshape(len(at), n)) for n in np.unique(lengths).tolist() for at in [np.flatnonzero(lengths == n)]]
    anchors = _Anchors(*(mine[c].to_numpy(np.int64) for c in ("id", "label", "mark")), groups)
    fields = "anchor long, mark long, score long, id long, other long"
    positives = staging.put(_first(mining.positives_of(rows, anchors), mining.positives, fields), "positives")
    # At most ``positives`` numbers for each anchor of the chunk.
    found = positives.select("anchor", "mark", "score").toPandas()
    place = {pair: k for k, pair in enumerate(zip(anchors.ids.tolist(), anchors.marks.tolist()))}
    windows, used = np.full((len(anchors.ids), mining.positives), -1, np.int64), [0] * len(anchors.ids)
    for anchor, mark, score in found.itertuples(index=False):
        k = place[anchor, mark]
        windows[k, used[k]] = max(score, -1)
        used[k] += 1

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            anchor, mark, score, ids, other = (batch.column(c).to_numpy() for c in range(5))
            yield pa.RecordBatch.from_arrays([_key_bytes(anchor, mark, score, 0, ids, other)], names=["key"])

    negatives = mining.negatives_of(rows, anchors, windows)
    return staging.put(mining.emitted(negatives.union(positives.mapInArrow(keyed, "key binary"))), "hard-negatives")
