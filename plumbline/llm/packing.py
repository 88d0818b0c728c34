"""Best-fit packing of tokenised documents into sequences of a fixed capacity.

Lengths are whole numbers up to the capacity, so everything that a packing depends on is how many
pieces there are of each length. That histogram (at most ``capacity`` rows, whatever the corpus) is
packed on the driver, many equal bins at a time; pieces then find their place by their rank within
their length, which the tasks number. No task sees more than its own pieces.

* Large items, over a third of the capacity, come at most two to a bin. Those over a half open
  bins; the others, longest first, join the bin that they fill best, else one of their kind. A
  shorter item fits wherever a longer one does, so this greedy matching makes as many pairs as
  there can be.
* Small items, longest first, go to the smallest gap that holds them, else to a new bin.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Callable, Iterator, Mapping
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from plumbline.llm.words import pieces as slices
from plumbline.sources.staging import Staging

CAPACITY = 2048
END = 0
# Byte-level pre-tokenisation of the vocabulary's kind (fixed value).
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_bpe(source: str) -> Callable[[str], np.ndarray]:
    """Ids of a text as the tokenizers library gives them for this byte-level BPE file (its JSON text).

    Merges of such a file are in the order of their ids, so the same table as ranks gives the same
    ids, four times as fast; what that encoder refuses (white space by the million) goes to the
    library itself. A special token in a text is one id, as by default in the library.
    """
    described = json.loads(source)
    special = {token["content"]: token["id"] for token in described["added_tokens"]}
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that stand for themselves
    hidden = [byte for byte in range(256) if byte not in shown]
    byte_of = {chr(byte): byte for byte in shown} | {chr(256 + k): byte for k, byte in enumerate(hidden)}
    ranks = {bytes(map(byte_of.__getitem__, word)): i for word, i in described["model"]["vocab"].items() if word not in special}
    fast = tiktoken.Encoding("byte_bpe", pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens=special)
    library = lru_cache(1)(lambda: Tokenizer.from_str(source))

    def encode(text: str) -> np.ndarray:
        try:
            return fast.encode_to_numpy(text, allowed_special="all").astype(np.uint32)
        except ValueError:
            return np.array(library().encode(text, add_special_tokens=False).ids, np.uint32)

    return encode


def tokenized(
    docs: DataFrame, tokenizer: str, *, key: str = "doc_id", column: str = "text",
    capacity: int = CAPACITY, end: int = END, keep_ids: bool = True,
) -> DataFrame:
    """Pieces of at most ``capacity`` ids: key, piece, start, length, ids_crc32 and, if asked for, ids.

    ``tokenizer`` is the path of a byte-level BPE file on the driver. A document is its ids and
    ``end``; a null or empty text is ``end`` alone. Only longer documents are cut, into pieces of
    the capacity, the first of which may be shorter. Null and repeated keys are rows as others.
    """
    with open(tokenizer, encoding="utf-8") as file:
        source = file.read()
    shared = docs.sparkSession.sparkContext.broadcast(source)
    key_type = docs.schema[key].dataType.simpleString()
    fields = f"`{key}` {key_type}, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * keep_ids

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = byte_bpe(shared.value)
        for batch in slices(batches, column):
            rows, places, crcs, ids = [], [], [], []
            for row, text in enumerate(batch.column(column).to_pylist()):
                whole = np.append(encode(text) if text else np.empty(0, np.uint32), np.uint32(end)).astype("<u4")
                edges = [0, *range(len(whole) % capacity or capacity, len(whole) + 1, capacity)]
                for number, (lo, hi) in enumerate(zip(edges, edges[1:])):
                    rows.append(row)
                    places.append((number, lo, hi - lo))
                    crcs.append(zlib.crc32(whole[lo:hi].tobytes()))
                    if keep_ids:
                        ids.append(whole[lo:hi].astype(np.int32))
            number, start, length = np.array(places, np.int64).reshape(-1, 3).T
            columns = [batch.column(key).take(pa.array(rows, pa.int64())), pa.array(number.astype(np.int32)), pa.array(start), pa.array(length), pa.array(crcs, pa.int64())]
            names = [key, "piece", "start", "length", "ids_crc32"]
            if keep_ids:
                offsets = np.concatenate([[0], np.cumsum(length)]).astype(np.int32)
                columns.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([*ids, np.empty(0, np.int32)]))))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.select(key, column).mapInArrow(cut, fields)


def plan(counts: Mapping[int, int], capacity: int = CAPACITY) -> list[tuple[int, list[tuple[int, int]]]]:
    """Bins for so many pieces of each length: (number of equal bins, what each holds as (length, how many))."""
    gaps: dict[int, list[tuple[int, tuple]]] = {}  # gap -> groups of equal bins

    def add(bins: int, gap: int, held: tuple) -> None:
        if bins:
            gaps.setdefault(gap, []).append((bins, held))

    def fill(length: int, left: int, most: int) -> int:
        """Put pieces into the smallest gaps, at most so many into a bin; returns how many found no place."""
        for gap in range(length, capacity):
            groups = gaps.get(gap)
            if not left:
                break
            if not groups:
                continue
            each, kept = min(most, gap // length), []
            for bins, held in groups:
                full = min(bins, left // each)
                left -= full * each
                add(full, gap - each * length, (*held, (length, each)))
                some = left if full < bins and left else 0
                add(int(some > 0), gap - some * length, (*held, (length, some)))
                left -= some
                if bins - full - (some > 0):
                    kept.append((bins - full - (some > 0), held))
            gaps[gap] = kept
        return left

    def open_bins(length: int, left: int, each: int) -> None:
        add(left // each, capacity - each * length, ((length, each),))
        if left % each:
            add(1, capacity - left % each * length, ((length, left % each),))

    for length in sorted((length for length, count in counts.items() if count), reverse=True):
        if 2 * length > capacity:
            open_bins(length, counts[length], 1)
        elif 3 * length > capacity:
            open_bins(length, fill(length, counts[length], 1), 2)
        else:
            open_bins(length, fill(length, counts[length], capacity), capacity // length)
    return [(bins, list(held)) for gap in sorted(gaps) for bins, held in gaps[gap]]


def _places(groups: list[tuple[int, list[tuple[int, int]]]], counts: Mapping[int, int]):
    """For ranges of pieces ordered by length and rank: where they begin, and first bin, pieces per bin, offset, length."""
    first = dict(zip(sorted(counts), np.cumsum([0, *(counts[length] for length in sorted(counts))]).tolist()))
    given, rows, bin_number = dict.fromkeys(counts, 0), [], 0
    for bins, held in groups:
        offset = 0
        for length, each in held:
            rows.append((first[length] + given[length], bin_number, each, offset, length))
            given[length] += bins * each
            offset += length * each
        bin_number += bins
    return first, np.array(sorted(rows), np.int64).reshape(-1, 5).T


def ranked(pieces: DataFrame) -> DataFrame:
    """Adds ``_part``, the task's number, and ``_slot``, the rank among the task's pieces of equal length."""

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen = TaskContext.get().partitionId(), {}
        for batch in batches:
            length = batch.column("length").to_numpy()
            order = np.argsort(length, kind="stable")
            values, first, counts = np.unique(length[order], return_index=True, return_counts=True)
            before = np.array([seen.get(v, 0) for v in values.tolist()], np.int64)
            slot = np.empty(len(length), np.int64)
            slot[order] = np.arange(len(length)) - np.repeat(first - before, counts)
            seen |= zip(values.tolist(), (before + counts).tolist())
            yield batch.append_column("_part", pa.array(np.full(len(length), part, np.int32))).append_column("_slot", pa.array(slot))

    kinds = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in pieces.schema)
    return pieces.mapInArrow(number, f"{kinds}, _part int, _slot long")


def pack(pieces: DataFrame, *, capacity: int = CAPACITY, staging: Staging | None = None) -> DataFrame:
    """Adds ``sequence_id``, dense from 0, and ``offset`` to pieces with a long ``length`` of 1 to ``capacity``.

    Pieces are written once with their task's number and rank; the ranks in the whole table come
    from sums over tasks, so a length that a third of all pieces have is spread as they are.
    Other columns are kept. Pieces of equal length are told apart by where they are stored, so
    repeated rows get places of their own; an empty table gives no sequences.
    """
    spark = pieces.sparkSession
    staged = (staging or Staging(spark)).put(ranked(pieces), "pieces")
    by_task = staged.groupBy("length", "_part").agg(F.count(F.lit(1)).alias("n"))
    counts = {row["length"]: row["n"] for row in staged.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    if counts and not 0 < min(counts) <= max(counts) <= capacity:
        raise ValueError(f"lengths must be 1 to {capacity}")
    first, ranges = _places(plan(counts, capacity), counts)
    earlier = Window.partitionBy("length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = by_task.select("length", "_part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("_before"))
    numbered = staged.join(before, ["length", "_part"]).withColumn("_slot", F.col("_slot") + F.col("_before"))
    columns = [field for field in pieces.schema if field.name not in ("sequence_id", "offset")]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths, starts = np.array(sorted(first), np.int64), np.array([first[k] for k in sorted(first)], np.int64)
        begin, bin_number, each, offset, _ = ranges
        for batch in batches:
            length = batch.column("length").to_numpy()
            position = starts[np.searchsorted(lengths, length)] + batch.column("_slot").to_numpy()
            at = np.searchsorted(begin, position, side="right") - 1
            rank = position - begin[at]
            arrays = [batch.column(field.name) for field in columns]
            arrays += [pa.array(bin_number[at] + rank // each[at]), pa.array(offset[at] + rank % each[at] * length)]
            yield pa.RecordBatch.from_arrays(arrays, names=[*(field.name for field in columns), "sequence_id", "offset"])

    kinds = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in columns)
    return numbered.mapInArrow(place, f"{kinds}, sequence_id long, offset long")


def sequences(packed: DataFrame) -> DataFrame:
    """The packed ids: sequence_id, ids, and ``starts``, where each piece begins; a group has at most a capacity of ids."""
    held = packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("held"))
    return held.select("sequence_id", F.flatten("held.ids").alias("ids"), F.col("held.offset").alias("starts"))


def pack_documents(docs: DataFrame, tokenizer: str, *, staging: Staging | None = None, capacity: int = CAPACITY, **options) -> DataFrame:
    """Tokenised, cut and packed documents; see :func:`tokenized` and :func:`pack`."""
    return pack(tokenized(docs, tokenizer, capacity=capacity, **options), capacity=capacity, staging=staging)
