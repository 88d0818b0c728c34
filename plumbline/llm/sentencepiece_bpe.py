"""Encoding and decoding with a SentencePiece BPE vocabulary, in vectorised merge rounds.

The pieces come from the model file; the work on texts is done here. A text is cut
into segments that no piece can cross; distinct segments of a task are encoded once.
All new segments are then merged together: flat arrays hold their symbols, each round
finds the best pair of every segment and merges it, and finished segments drop out.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from heapq import heappop, heappush
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from plumbline.llm.words import MIXER, Numbers, pieces, texts_of

SPACE = "▁"
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6  # fixed values of the file format
_NONE = np.int64(1 << 40)
_KEPT_SEGMENTS = 300_000
_LONG = 512  # symbols from which on a segment is merged by a queue
_AT_ONCE = 1 << 18  # symbols that are merged together: a round holds some ten numbers for each
_IDS = 1 << 17  # ids that are decoded together
_SLOT_BITS = 19


def _fields(data: bytes) -> Iterator[tuple[int, object]]:
    """Field numbers and values of a protocol buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = varint()
        if key & 7 == 0:
            yield key >> 3, varint()
        else:
            size = {1: 8, 5: 4}.get(key & 7) or varint()
            yield key >> 3, data[at : at + size]
            at += size


@dataclass(frozen=True)
class Vocabulary:
    """Pieces, scores and kinds, and whether a space is put before each text."""

    pieces: list[str]
    scores: np.ndarray
    kinds: np.ndarray
    dummy_prefix: bool

    @classmethod
    def from_bytes(cls, model: bytes) -> "Vocabulary":
        """Only BPE models without text normalisation, user-defined or unused pieces are taken; others raise ValueError."""
        names, scores, kinds, prefix, bpe = [], [], [], True, False
        for field, value in _fields(model):
            if field == 1:
                piece = dict(_fields(value))
                names.append(piece.get(1, b"").decode())
                scores.append(np.frombuffer(piece.get(2, b"\0\0\0\0"), "<f4")[0])
                kinds.append(piece.get(3, NORMAL))
            elif field == 2:
                bpe = dict(_fields(value)).get(3, 1) == 2
            elif field == 3:
                spec = dict(_fields(value))
                prefix = bool(spec.get(3, 1))
                if spec.get(2) or spec.get(4, 1) or not spec.get(5, 1):
                    raise ValueError("only models with identity normalisation and kept white space are supported")
        kinds = np.array(kinds)
        if not bpe or not (kinds == BYTE).sum() == 256 or np.isin(kinds, (USER_DEFINED, UNUSED)).any():
            raise ValueError("only BPE models with byte fallback and plain pieces are supported")
        return cls(names, np.array(scores, np.float64), kinds, prefix)


class Encoder:
    """Encodes segments; remembers those it has seen, up to a bounded number."""

    def __init__(self, vocabulary: Vocabulary):
        v = self.vocabulary = vocabulary
        self.ids = {p: k for k, p in enumerate(v.pieces) if v.kinds[k] == NORMAL}
        self.byte_ids = np.zeros(256, np.int32)
        for k in np.flatnonzero(v.kinds == BYTE):
            self.byte_ids[int(v.pieces[k][3:5], 16)] = k
        order = np.argsort(-v.scores, kind="stable")
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        # equal scores have equal rank, so that the leftmost wins between them
        same = np.concatenate([[False], np.diff(v.scores[order]) == 0])
        rank[order] = np.maximum.accumulate(np.where(same, 0, np.arange(len(order))))
        self.rank = rank
        self._made_of: dict[int, int] | None = None  # the pair table as a dict, for long segments
        self._pair_table()
        self._segment_pattern()
        self.forget()

    def _pair_table(self) -> None:
        """Every way to make a piece of two symbols, sorted by the symbols' numbers.

        Symbols are pieces and, above them, single characters that no piece starts from.
        """
        keys, made, risky = [], [], set()
        chars = {c for p in self.ids if len(p) > 1 for c in p}
        symbol = dict(self.ids)
        for c in sorted(chars - symbol.keys()):
            symbol[c] = len(self.vocabulary.pieces) + len(symbol)
        for piece, k in self.ids.items():
            for cut in range(1, len(piece)):
                a, b = symbol.get(piece[:cut]), symbol.get(piece[cut:])
                if a is not None and b is not None:
                    keys.append((a << 20) | b)
                    made.append(k)
                # a merge that gives a better pair must not be done in several places at once
                risky.update(s for s in (a, b) if s is not None and s < len(self.rank) and self.rank[s] >= self.rank[k])
        order = np.argsort(keys)
        self.symbol = symbol
        self.pair_keys, self.pair_made = np.array(keys, np.int64)[order], np.array(made, np.int64)[order]
        slots = self._slots(self.pair_keys)
        self.slot_key, self.slot_made = np.full(1 << _SLOT_BITS, -1, np.int64), np.full(1 << _SLOT_BITS, -1, np.int64)
        self.slot_key[slots], self.slot_made[slots] = self.pair_keys, self.pair_made
        self.risky = np.zeros(len(self.rank), bool)
        self.risky[list(risky)] = True

    @staticmethod
    def _slots(keys: np.ndarray) -> np.ndarray:
        return (keys.astype(np.uint64) * MIXER >> np.uint64(64 - _SLOT_BITS)).astype(np.int64)

    def _segment_pattern(self) -> None:
        longer = [p for p in self.ids if len(p) > 1]
        mergeable = {c for p in longer for c in p}
        inner = any(SPACE in p.lstrip(SPACE) for p in longer)
        plain = "".join(map(re.escape, sorted(mergeable - {SPACE})))
        if inner:  # pieces may hold spaces anywhere: cut only at characters that never merge
            self.pattern = re.compile(f"[{SPACE}{plain}]+|[^{SPACE}{plain}]+")
        else:
            self.pattern = re.compile(f"{SPACE}*[{plain}]+|{SPACE}+|[^{SPACE}{plain}]+")

    def forget(self) -> None:
        self.numbers = Numbers()
        self.flat, self.first = np.empty(0, np.int32), np.zeros(1, np.int64)

    def segments(self, text: str) -> list[str]:
        if not text:
            return []
        escaped = text.replace(" ", SPACE)
        return self.pattern.findall(SPACE + escaped if self.vocabulary.dummy_prefix else escaped)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, flat, and where each text's begin."""
        if len(self.numbers) > _KEPT_SEGMENTS:
            self.forget()
        found, counts, seen = [], [], len(self.numbers)
        for text in texts:
            before = len(found)
            found += self.segments(text)
            counts.append(len(found) - before)
        chosen = self.numbers.of(found)
        if len(self.numbers) > seen:
            flat, sizes = zip(*map(self._merge, self._runs(list(islice(self.numbers, seen, None)))))
            self.flat = np.concatenate([self.flat, *flat])
            self.first = np.concatenate([self.first, self.first[-1] + np.cumsum(np.concatenate(sizes))])
        sizes = np.diff(self.first)[chosen]
        out = gather(self.flat, self.first[chosen], sizes)
        per_text = np.concatenate([[0], np.cumsum(sizes)])[np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)]
        return out, per_text

    @staticmethod
    def _runs(segments: list[str]) -> Iterator[list[str]]:
        """The segments in runs of a bounded number of symbols; a longer one is a run by itself."""
        ends, lo = np.cumsum(np.fromiter(map(len, segments), np.int64, len(segments))), 0
        while lo < len(segments):
            hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + _AT_ONCE, side="right")))
            yield segments[lo:hi]
            lo = hi

    def _merge_long(self, symbols: list[int]) -> list[int]:
        """The merges of one long segment, from a queue of pairs by rank and place.

        A round looks at the whole segment, and a segment can need as many rounds as it has
        symbols; here a merge touches only the pairs beside it.
        """
        if self._made_of is None:
            self._made_of = dict(zip(self.pair_keys.tolist(), self.pair_made.tolist()))
        made_of, rank, size = self._made_of, self.rank, len(symbols)
        symbols, before, after = list(symbols), list(range(-1, size - 1)), [*range(1, size), -1]
        queue: list[tuple[int, int, int, int, int]] = []

        def offer(i: int) -> None:
            j = after[i]
            if j >= 0 and symbols[i] >= 0 and symbols[j] >= 0:
                made = made_of.get(symbols[i] << 20 | symbols[j])
                if made is not None:
                    heappush(queue, (int(rank[made]), i, symbols[i], symbols[j], made))

        for i in range(size):
            offer(i)
        gone = [False] * size
        while queue:
            _, i, left, right, made = heappop(queue)
            j = after[i]
            if gone[i] or j < 0 or symbols[i] != left or symbols[j] != right:
                continue  # one of them was merged meanwhile
            symbols[i], gone[j], after[i] = made, True, after[j]
            if after[j] >= 0:
                before[after[j]] = i
            if before[i] >= 0:
                offer(before[i])
            offer(i)
        return [symbol for symbol, dropped in zip(symbols, gone) if not dropped]

    def _merge(self, segments: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the segments, flat, and their number in each."""
        raw = np.frombuffer("".join(segments).encode("utf-32-le"), np.uint32)
        lengths = np.fromiter(map(len, segments), np.int64, len(segments))
        chars, at = np.unique(raw, return_inverse=True)
        known = np.array([self.symbol.get(chr(c), -1 - c) for c in chars.tolist()], np.int64)
        symbols, owner = known[at], np.repeat(np.arange(len(segments)), lengths)

        done_symbols, done_owner = [], []
        first = np.cumsum(lengths) - lengths
        for k in np.flatnonzero(lengths > _LONG).tolist():
            merged = self._merge_long(symbols[first[k] : first[k] + lengths[k]].tolist())
            done_symbols.append(np.array(merged, np.int64))
            done_owner.append(np.full(len(merged), k))
        short = (lengths <= _LONG)[owner]
        symbols, owner = symbols[short], owner[short]
        while len(symbols):
            made = self._pairs(symbols, owner)
            rank = np.where(made >= 0, self.rank[made], _NONE)
            starts = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
            best = np.minimum.reduceat(rank, starts)
            spans = np.diff(np.concatenate([starts, [len(owner)]]))
            ends = np.repeat(best == _NONE, spans)
            done_symbols.append(symbols[ends])
            done_owner.append(owner[ends])
            hit = (rank == np.repeat(best, spans)) & ~ends
            hit = self._leftmost(hit, made, starts)
            gone = np.concatenate([[False], hit[:-1]])
            symbols = np.where(hit, made, symbols)
            keep = ~gone & ~ends
            symbols, owner = symbols[keep], owner[keep]
        symbols, owner = np.concatenate(done_symbols), np.concatenate(done_owner)
        order = np.argsort(owner, kind="stable")
        return self._to_ids(symbols[order], owner[order], len(segments))

    def _pairs(self, symbols: np.ndarray, owner: np.ndarray) -> np.ndarray:
        """The piece that each symbol makes with the next one of its segment, or -1."""
        made = np.full(len(symbols), -1, np.int64)
        can = np.flatnonzero((owner[1:] == owner[:-1]) & (symbols[1:] >= 0) & (symbols[:-1] >= 0))
        key = (symbols[can] << 20) | symbols[can + 1]
        slot = self._slots(key)
        held = self.slot_key[slot]
        found = np.where(held == key, self.slot_made[slot], -1)
        shared = np.flatnonzero((held != key) & (held >= 0))  # another pair has the slot
        at = np.minimum(np.searchsorted(self.pair_keys, key[shared]), len(self.pair_keys) - 1)
        found[shared] = np.where(self.pair_keys[at] == key[shared], self.pair_made[at], -1)
        made[can] = found
        return made

    def _leftmost(self, hit: np.ndarray, made: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Of overlapping hits in a row every second is taken from the left; where a merge could
        give a better pair, or different pieces tie, only the segment's first hit."""
        at = np.flatnonzero(hit)
        if not len(at):
            return hit
        segment = np.searchsorted(starts, at, side="right")
        first = np.concatenate([[True], segment[1:] != segment[:-1]])
        lead = np.maximum.accumulate(np.where(first, np.arange(len(at)), 0))
        careful = self.risky[made[at]] | (made[at] != made[at][lead])
        careful = np.maximum.reduceat(careful, np.flatnonzero(first))[np.cumsum(first) - 1]
        run = np.concatenate([[True], at[1:] != at[:-1] + 1]) | first
        offset = np.arange(len(at)) - np.maximum.accumulate(np.where(run, np.arange(len(at)), 0))
        take = np.where(careful, first, offset % 2 == 0)
        out = np.zeros_like(hit)
        out[at[take]] = True
        return out

    def _to_ids(self, symbols: np.ndarray, owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Symbols that are no piece become the ids of their UTF-8 bytes."""
        plain = (symbols >= 0) & (symbols < len(self.vocabulary.pieces))
        ids, sizes = symbols.astype(np.int32), np.ones(len(symbols), np.int64)
        if not plain.all():
            extra = {s: c for c, s in self.symbol.items() if s >= len(self.vocabulary.pieces)}
            odd = np.flatnonzero(~plain)
            kinds, at = np.unique(symbols[odd], return_inverse=True)
            spelled = [np.frombuffer((extra[s] if s >= 0 else chr(-1 - s)).encode(), np.uint8) for s in kinds.tolist()]
            width = np.array([len(x) for x in spelled])
            sizes[odd] = width[at]
            begin = np.cumsum(sizes) - sizes
            out = np.repeat(ids, sizes)
            filled = gather(np.concatenate(spelled), (np.cumsum(width) - width)[at], width[at])
            out[gather(np.arange(len(out)), begin[odd], sizes[odd])] = self.byte_ids[filled]
            ids = out
        return ids, np.bincount(owner, weights=sizes, minlength=n).astype(np.int64)


def gather(flat: np.ndarray, start: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """``flat[start[i]:start[i] + sizes[i]]`` of all i, one after another."""
    shift = start - (np.cumsum(sizes) - sizes)
    return flat[np.repeat(shift, sizes) + np.arange(sizes.sum())]


class Decoder:
    """Texts from ids. Control pieces are silent; a first space is the prefix of encoding and dropped;
    bytes that are no UTF-8 become U+FFFD each. Unknown pieces show as the model's sign for them."""

    def __init__(self, vocabulary: Vocabulary, unknown: str = " ⁇ "):
        kinds = vocabulary.kinds
        spelled = []
        for piece, kind in zip(vocabulary.pieces, kinds.tolist()):
            if kind == CONTROL:
                spelled.append(b"")
            elif kind == BYTE:
                spelled.append(bytes([int(piece[3:5], 16)]))
            elif kind == UNKNOWN:
                spelled.append(unknown.encode())
            else:
                spelled.append(piece.replace(SPACE, " ").encode())
        self.sizes = np.fromiter(map(len, spelled), np.int64, len(spelled))
        self.flat = np.frombuffer(b"".join(spelled), np.uint8)
        self.first = np.cumsum(self.sizes) - self.sizes
        self.drops = np.array([p.startswith(SPACE) and k == NORMAL for p, k in zip(vocabulary.pieces, kinds)]) & vocabulary.dummy_prefix
        self.silent, self.bytes = self.sizes == 0, kinds == BYTE

    def decode(self, ids: np.ndarray, first: np.ndarray) -> list[str]:
        sizes = self.sizes[ids]
        data = gather(self.flat, self.first[ids], sizes).tobytes()
        ends = np.concatenate([[0], np.cumsum(sizes)])[first]
        # the first piece that says something loses its leading space
        loud = np.flatnonzero(~self.silent[ids])
        lead = np.searchsorted(loud, first[:-1])
        drop = np.zeros(len(first) - 1, bool)
        has = lead < len(loud)
        has[has] = loud[lead[has]] < first[1:][has]
        drop[has] = self.drops[ids[loud[lead[has]]]]
        out = []
        for k, (lo, hi) in enumerate(zip(ends[:-1].tolist(), ends[1:].tolist())):
            try:
                out.append(data[lo + drop[k] : hi].decode())
            except UnicodeDecodeError:
                out.append(self._repair(ids[first[k] : first[k + 1]], bool(drop[k])))
        return out

    def _repair(self, ids: np.ndarray, drop: bool) -> str:
        """Runs of byte pieces are read as UTF-8 by themselves, each bad byte on its own."""
        parts, run = [], b""
        for k in [*ids.tolist(), None]:
            if k is not None and self.bytes[k]:
                run += self.flat[self.first[k] : self.first[k] + 1].tobytes()
                continue
            while run:
                for size in range(min(4, len(run)), 0, -1):
                    try:
                        one = run[:size].decode()
                    except UnicodeDecodeError:
                        continue
                    if len(one) == 1:
                        parts.append(one)
                        run = run[size:]
                        break
                else:
                    parts.append("�")
                    run = run[1:]
            if k is not None:
                parts.append(self.flat[self.first[k] : self.first[k] + self.sizes[k]].tobytes().decode())
        return "".join(parts)[drop:]


def read_model(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()


def encode(df: DataFrame, model: bytes, text_column: str = "text", into: str = "ids") -> DataFrame:
    """``df`` with the ids of each text and the end id behind them; a null text is empty.

    The model (half a megabyte for 32,000 pieces) is sent with the tasks. A column named as
    the result is replaced; other columns are kept.
    """
    vocabulary = Vocabulary.from_bytes(model)
    end = vocabulary.pieces.index("</s>")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(Vocabulary.from_bytes(model))
        for batch in pieces(batches, text_column):
            texts = [t.decode("utf-8", "replace") for t in texts_of(batch.column(text_column))]
            flat, first = encoder.encode(texts)
            out = np.insert(flat, first[1:], end)
            offsets = pa.array((first + np.arange(len(first))).astype(np.int32))
            yield _with(batch, into, pa.ListArray.from_arrays(offsets, pa.array(out.astype(np.int32))))

    return _added(df, run, into, ArrayType(IntegerType()))


def decode(df: DataFrame, model: bytes, ids_column: str = "ids", into: str = "decoded") -> DataFrame:
    """``df`` with the text of each row's ids; null ids give the empty text. A column named as the result is replaced."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(Vocabulary.from_bytes(model))
        for whole in batches:
            sizes = pa.compute.fill_null(pa.compute.list_value_length(whole.column(ids_column)), 0).to_numpy(zero_copy_only=False)
            ends, lo = np.cumsum(sizes, dtype=np.int64), 0
            while lo < len(sizes):
                hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + _IDS, side="right")))
                batch, first = whole.slice(lo, hi - lo), np.concatenate([[0], np.cumsum(sizes[lo:hi])])
                flat = batch.column(ids_column).flatten().to_numpy().astype(np.int64)
                yield _with(batch, into, pa.array(decoder.decode(flat, first), pa.string()))
                lo = hi
            pa.default_memory_pool().release_unused()

    return _added(df, run, into, StringType())


def _with(batch: pa.RecordBatch, name: str, values: pa.Array) -> pa.RecordBatch:
    kept = [k for k, other in enumerate(batch.schema.names) if other != name]
    return pa.RecordBatch.from_arrays([*(batch.column(k) for k in kept), values], [*(batch.schema.names[k] for k in kept), name])


def _added(df: DataFrame, run, into: str, kind) -> DataFrame:
    fields = [field for field in df.schema.fields if field.name != into]
    return df.mapInArrow(run, StructType([*fields, StructField(into, kind)]))
