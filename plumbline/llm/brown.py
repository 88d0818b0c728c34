"""Language-model scoring with Brown classes.

Words fall into classes found by exchange clustering; a word's probability is that of
its class after the class before, times that of the word within its class.

* Texts are read once, in parts of a few megabytes: a part is a row of its distinct words, their counts, and its texts as numbers of
  these. All that follows works on parts, so that a word is looked up once in a part, not wherever it stands.
* Word counts cover all training texts and stay a distributed table. Only statistics of a
  stated size reach the driver: the most frequent words, and counts of neighbouring units and classes.
* The ``vocabulary`` most frequent words are exchanged there, together with groups of rarer words with equal hash of their last
  three bytes, so that the clustering sees every token. A group only gives its words a class to begin with.
* Then every other word moves, in ``rounds``, to the class that its own counts of classes before and after it fit best. These
  counts, summed in the part and packed into a row per word, and the classes are distributed tables, by a 64-bit hash of the word.
* A word that is in no training text has the class of its group, and there the count of nothing.
* Counts and classes of words outside the ``frequent`` are joined to the parts that hold them, and meet these in a cogroup. Each text then is
  a row of its sums and of its pairs of neighbouring classes. Counts of these over the training texts are exact; classes follow the likelihood
  that they give: moves that lower it are taken back. Scores are sums over the same pairs.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.words import Memo, Numbers, Words, pieces, sums, texts_of
from plumbline.sources.staging import Staging, forget_shuffles

END = b"\n"  # the end of a text; never a word, as it is white space
VOCABULARY, GROUPS, CLASSES = 1000, 256, 64
FREQUENT = 50_000
SWEEPS, ROUNDS = 4, 1
_PART = 4 << 20  # bytes of text
_PARTS_BITS, _NUMBER_BITS, _KIND_BITS = 15, 28, 16  # of a task's parts, of a part's words, of classes
_FEW = 4  # counts up to this one have their gains looked up
_COUNT_BITS = 40
_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
_SEED = 42  # of Spark's xxhash64
_PRIOR = 20.0


@dataclass(frozen=True)
class ClassModel:
    """What scoring needs of a trained model; its size is bounded by the parameters."""

    frequent: dict[bytes, int]  # counts of the most frequent words
    unit: dict[bytes, int]  # the vocabulary
    transition: np.ndarray  # log10 P(class | class before)
    emission: np.ndarray  # log10 P(unit | its class), less the log of the group's size for groups
    unit_class: np.ndarray
    tokens: int
    types: int
    between: np.ndarray  # counts of neighbouring classes, of two words of the vocabulary


@dataclass(frozen=True)
class WordClasses:
    """What scoring needs when every word has its class; those of rarer words are in a table."""

    frequent: dict[bytes, tuple[int, int]]  # counts and classes of the most frequent words, and of the end
    transition: np.ndarray  # log10 P(class | class before)
    mass: np.ndarray  # log10 of the summed counts of a class, one more for each word and each group of unknown ones
    unknown: np.ndarray  # the class of each group
    tokens: int
    types: int


def group_of(word: bytes, groups: int) -> int:
    return zlib.crc32(word[-3:]) % groups


def _part_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per part: its words, their counts in training texts, and of its texts the words by number, how many each has, which are held out, and the ids."""
    first = TaskContext.get().partitionId() << _PARTS_BITS
    for k, batch in enumerate(pieces(batches, "text", _PART)):
        words, numbers = Words(texts_of(batch.column("text")), lower=True), Numbers()
        codes, held = numbers.of(words.words), batch.column("held_out").to_numpy(zero_copy_only=False).astype(bool)
        n = np.bincount(codes[np.repeat(~held, words.counts)], minlength=len(numbers))
        blobs = [b"\n".join(numbers), *(x.tobytes() for x in (n.astype(np.int32), _halves(codes), words.counts.astype(np.int32), held))]
        ids = pa.ListArray.from_arrays(pa.array([0, len(held)], pa.int32()), batch.column("id"))
        yield pa.RecordBatch.from_arrays([pa.array([first + k]), *(pa.array([x], pa.binary()) for x in blobs), ids], _PART_NAMES)


def _halves(codes: np.ndarray) -> np.ndarray:
    """Lower halves of the numbers, then the upper ones, which are mostly zero and so pack well."""
    return codes.astype("<u4").view("<u2").reshape(-1, 2).T


_PART_NAMES = ["part", "words", "n", "codes", "sizes", "held", "ids"]


def _parts(docs: DataFrame, staging: Staging) -> DataFrame:
    """Rows ``id, text, held_out`` as staged parts."""
    kind = docs.schema["id"].dataType.simpleString()
    made = docs.select("id", "text", "held_out").mapInArrow(
        _part_rows, f"part long, words binary, n binary, codes binary, sizes binary, held binary, ids array<{kind}>"
    )
    return staging.put(made, "parts", "zstd")


_TEXTS = ["words", "codes", "sizes", "held"]


def _training_parts(texts: DataFrame, staging: Staging) -> DataFrame:
    return _parts(texts.select(F.lit(None).cast("long").alias("id"), "text", F.lit(False).alias("held_out")), staging)


def _unpacked(columns, k: int) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray]:
    """Words, numbers of the texts' words, how many each text has, and which are held out, of one part."""
    words, codes, sizes, held = (columns.column(name)[k].as_py() for name in ("words", "codes", "sizes", "held"))
    low, high = np.frombuffer(codes, "<u2").reshape(2, -1).astype(np.int32)
    return words.split(), low | high << 16, np.frombuffer(sizes, np.int32), np.frombuffer(held, bool)


def _learnt(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[bytes], np.ndarray, np.ndarray]]:
    """Of each part the words and an end behind them, and for each token of its training texts, ends among them, the number of the one before and its own."""
    for batch in batches:
        for k in range(batch.num_rows):
            words, codes, sizes, held = _unpacked(batch, k)
            if held.all():
                continue
            b, _ = _with_ends(codes[np.repeat(~held, sizes)], sizes[~held], len(words))
            yield [*words, END], np.concatenate([[len(words)], b[:-1]]), b


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words of the training texts with their counts in each part."""
    for batch in batches:
        for k in range(batch.num_rows):
            words, n, held = batch.column("words")[k].as_py().split(), np.frombuffer(batch.column("n")[k].as_py(), np.int32), batch.column("held")[k].as_py()
            n = np.append(n, held.count(0)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array([*words, END], pa.binary()), pa.array(n)], ["word", "n"]).filter(pa.array(n > 0))


def _units(words: list[bytes], unit: dict[bytes, int], groups: int) -> np.ndarray:
    size = len(unit)
    return np.array([unit[w] if w in unit else size + group_of(w, groups) for w in words], np.int64)


def _with_ends(values: np.ndarray, counts: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Each text's values with ``end`` behind them, and where each text's begin."""
    first = np.concatenate([[0], np.cumsum(counts + 1)])
    out = np.full(first[-1], end, np.int64)
    keep = np.ones(len(out), bool)
    keep[first[1:] - 1] = False
    out[keep] = values
    return out, first


def _bigrams(unit: dict[bytes, int], groups: int):
    size = len(unit) + groups

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size * size, np.int64)
        for words, a, b in _learnt(batches):
            units = _units(words, unit, groups)
            total += np.bincount(units[a] * size + units[b], minlength=size * size)
        at = np.flatnonzero(total)
        for lo in range(0, len(at), 100_000):
            part = at[lo : lo + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(total[part])], ["pair", "n"])

    return run


def exchange(pairs: np.ndarray, classes: int, sweeps: int) -> np.ndarray:
    """Classes of units (``pairs[a, b]``: how often b follows a) by exchange: each unit in turn
    moves to the class that raises the likelihood of the class bigram model most. Ends early when none moves."""
    size = len(pairs)
    weight = pairs.sum(axis=0) + pairs.sum(axis=1)
    order = np.argsort(-weight, kind="stable")
    label = np.empty(size, np.int64)
    label[order] = np.arange(size) % classes
    member = np.zeros((size, classes))
    member[np.arange(size), label] = 1
    onward, backward = pairs @ member, pairs.T @ member  # unit by class, after and before it
    between = member.T @ onward
    entropy = lambda x: x * np.log(np.maximum(x, 1))
    for _ in range(sweeps):
        moved = 0
        for u in order:
            if not weight[u]:
                continue
            old, after, prior, self_ = label[u], onward[u].copy(), backward[u].copy(), pairs[u, u]
            after[old] -= self_
            prior[old] -= self_
            between[old, :] -= after
            between[:, old] -= prior
            between[old, old] -= self_
            diagonal = np.diag(between)
            gain = (entropy(between + after) - entropy(between)).sum(axis=1)
            gain += (entropy(between + prior[:, None]) - entropy(between)).sum(axis=0)
            gain += entropy(diagonal + after + prior + self_) - entropy(diagonal + after) - entropy(diagonal + prior) + entropy(diagonal)
            out, into = between.sum(axis=1), between.sum(axis=0)
            gain -= entropy(out + after.sum() + self_) - entropy(out) + entropy(into + prior.sum() + self_) - entropy(into)
            new = int(np.argmax(gain))
            if gain[new] <= gain[old] + 1e-6:
                new = old
            between[new, :] += after
            between[:, new] += prior
            between[new, new] += self_
            if new != old:
                label[u], moved = new, moved + 1
                onward[:, old] -= pairs[:, u]
                onward[:, new] += pairs[:, u]
                backward[:, old] -= pairs[u]
                backward[:, new] += pairs[u]
        if not moved:
            break
    return label


def train(texts: DataFrame, staging: Staging, vocabulary=VOCABULARY, groups=GROUPS, classes=CLASSES, frequent=FREQUENT) -> tuple[ClassModel, DataFrame]:
    """The model of the column ``text``, and the table ``word, c`` of all training words."""
    return _train(_training_parts(texts, staging), staging, vocabulary, groups, classes, frequent)


def _train(parts: DataFrame, staging: Staging, vocabulary: int, groups: int, classes: int, frequent: int) -> tuple[ClassModel, DataFrame]:
    counts = parts.select("words", "n", "held").mapInArrow(_count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("c"))
    counts = staging.put(counts, "word-counts", "zstd")
    types, tokens = counts.agg(F.count(F.lit(1)), F.coalesce(F.sum("c"), F.lit(0))).first()
    top = [(bytes(r.word), r.c) for r in counts.orderBy(F.desc("c"), "word").limit(frequent).collect()]
    if END not in dict(top):
        top += [(END, r.c) for r in counts.where(F.col("word") == F.lit(END)).collect()]
    unit = {word: k for k, word in enumerate(dict.fromkeys([END, *(w for w, _ in top[:vocabulary])]))}

    rare = counts.join(F.broadcast(parts.sparkSession.createDataFrame([(w,) for w in unit], "word binary")), "word", "left_anti")
    group = F.pmod(F.crc32(F.substring("word", -3, 3)), F.lit(groups))
    sizes = np.ones(groups)
    for row in rare.groupBy(group.alias("g")).agg((F.sum("c") + F.count(F.lit(1)) + 1).alias("size")).collect():
        sizes[row.g] = row["size"]

    size = len(unit) + groups
    pairs = parts.select(*_TEXTS).mapInArrow(_bigrams(unit, groups), "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    found = pairs.toArrow()  # at most size * size rows
    table = np.zeros(size * size)
    table[found.column("pair").to_numpy()] = found.column("n").to_numpy()
    table = table.reshape(size, size)

    label = exchange(table, classes, SWEEPS)
    member = np.zeros((size, classes))
    member[np.arange(size), label] = 1
    between = member.T @ table @ member
    each = table.sum(axis=0)
    share = (each + 1) / ((each + 1) @ member)[label]
    prior = ((each + 1) @ member) / (each + 1).sum()
    transition = (between + _PRIOR * prior) / (between.sum(axis=1, keepdims=True) + _PRIOR)
    n = len(unit)
    inner = member[:n].T @ table[:n, :n] @ member[:n]
    emission = np.log10(share)
    emission[len(unit) :] -= np.log10(sizes)
    model = ClassModel(dict(top), unit, np.log10(np.maximum(transition, 1e-300)), emission, label, int(tokens), int(types), inner)
    return model, counts


class _Known:
    """Words that each task knows, by number, with what they stand for in arrays; a number of -1 is any other word."""

    def __init__(self, words: list[bytes], *values: list[int]):
        self.number = {word: k for k, word in enumerate(words)}
        self.values = [np.append(np.array(v, np.int64), -1) for v in values]

    def of(self, words: list[bytes]) -> tuple[np.ndarray, ...]:
        """Numbers of the words, and their values, -1 for others."""
        get = self.number.get
        at = np.fromiter((get(word, -1) for word in words), np.int64, len(words))
        return at, *(v[at] for v in self.values)


_BEFORE_FIXED, _BEFORE, _AFTER = 0, 1, 2


def word_key(word: bytes) -> int:
    """The hash that Spark's xxhash64 gives for the word."""
    value = xxhash.xxh64_intdigest(word, seed=_SEED)
    return value - (1 << 64) if value >> 63 else value


def _packed(key: np.ndarray, code: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    """A row per key: its codes with their counts, each pair in one number."""
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.empty(0, np.int64)
    offsets = np.append(first, len(key)).astype(np.int32)
    lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array((code.astype(np.int64) << _COUNT_BITS) | n))
    return pa.RecordBatch.from_arrays([pa.array(key[first]), lists], ["key", "contexts"])


def _blobs(values: np.ndarray, first: np.ndarray) -> pa.Array:
    """The bytes of ``values[first[i]:first[i + 1]]``."""
    offsets = (first * values.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(first) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(values)])


def _contexts(kinds: dict[bytes, int], unknown: np.ndarray, fixed: frozenset[bytes], classes: int):
    """How often each word that is not fixed has a class before and after it: ``key, contexts``."""

    common = [w for w in kinds if w not in fixed]  # added up in one array; as many as are frequent
    known = _Known([*common, *(w for w in kinds if w in fixed)], [kinds[w] for w in common] + [kinds[w] for w in kinds if w in fixed])
    width = 3 * classes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(common) * width, np.int32)
        keys_of = Memo(word_key)
        for words, a, b in _learnt(batches):
            place, kind = known.of(words)
            other = np.flatnonzero(place < 0)
            others = [words[w] for w in other.tolist()]
            kind[other] = unknown[np.fromiter((group_of(w, len(unknown)) for w in others), np.int64, len(others))]
            keys = keys_of.of(others, np.int64)
            order = np.argsort(keys, kind="stable")
            keys, moves = keys[order], place < len(common)
            place[other[order]] = len(known.number) + np.arange(len(others))  # behind all that are known, by key
            into, out = moves[b], moves[a]
            side = np.where(into & out, _BEFORE, _BEFORE_FIXED) * classes
            found = np.concatenate([place[b[into]] * width + (side + kind[a])[into], place[a[out]] * width + _AFTER * classes + kind[b[out]]])
            found, n = np.unique(found, return_counts=True)
            often = int(np.searchsorted(found, len(total)))
            total[found[:often]] += n[:often].astype(np.int32)
            word, code = np.divmod(found[often:], width)
            yield _packed(keys[word - len(known.number)], code, n[often:])
        at = np.flatnonzero(total)
        keys = np.fromiter(map(word_key, common), np.int64, len(common))
        yield _packed(keys[at // width], at % width, total[at].astype(np.int64))

    return run


def _entries(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of a batch of words with their contexts: each entry's word, code and count; a word's codes are different."""
    lists = batch.column("contexts")
    flat = lists.flatten().to_numpy()
    owner = np.repeat(np.arange(len(lists)), pa.compute.list_value_length(lists).to_numpy(zero_copy_only=False))
    key, at = np.unique(owner << 20 | flat >> _COUNT_BITS, return_inverse=True)
    n = np.bincount(at, weights=flat & ((1 << _COUNT_BITS) - 1), minlength=len(key)).astype(np.int64)
    return key >> 20, key & ((1 << 20) - 1), n


def _between(classes: int):
    """Counts of neighbouring classes, but for those of two fixed words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(classes * classes, np.int64)
        for batch in batches:
            owner, code, n = _entries(batch)
            own, side, other = batch.column("kind").to_numpy()[owner], code // classes, code % classes
            at, into = side == _AFTER, side == _BEFORE_FIXED
            np.add.at(total, own[at] * classes + other[at], n[at])
            np.add.at(total, other[into] * classes + own[into], n[into])
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["pair", "n"])

    return run


def _entropy(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1))


def _growth(rows: np.ndarray, place: np.ndarray, m: np.ndarray, own: np.ndarray) -> np.ndarray:
    """By how much the entropy of each count in row ``place[i]`` grows when ``m[i]`` is added; in class ``own[i]`` these are counted by now.
    Most m are small: their growth is looked up."""
    table = np.stack([_entropy(rows + few) - _entropy(rows) for few in range(_FEW + 1)])
    few = m <= _FEW
    out = table[np.where(few, m, 0).astype(np.int64), place]
    many = np.flatnonzero(~few)
    if len(many):
        out[many] = _entropy(rows[place[many]] + m[many, None]) - _entropy(rows[place[many]])
    rest = rows[place, own] - m
    out[np.arange(len(m)), own] = _entropy(rest + m) - _entropy(rest)
    return out


def best_classes(owner: np.ndarray, code: np.ndarray, n: np.ndarray, label: np.ndarray, between: np.ndarray) -> np.ndarray:
    """The classes to which words move by exchange, most frequent first; ``owner`` ascends, and ``between``, which counts each word in its own class,
    follows the moves. Words that are together a thousandth of the tokens decide at once; what a word counts beside itself stays where it was."""
    classes, size = len(between), len(label)
    first = np.searchsorted(owner, np.arange(size + 1))
    weight = np.bincount(owner, weights=n, minlength=size)
    order = np.argsort(-weight, kind="stable")
    entries, tokens = np.cumsum(np.diff(first)[order]), np.cumsum(weight[order])
    share, new, lo = between.sum() / 1000, label.copy(), 0
    while lo < size:
        done, past = (entries[lo - 1], tokens[lo - 1]) if lo else (0, 0)
        hi = max(lo + 1, min(np.searchsorted(entries, done + 20_000, side="right"), np.searchsorted(tokens, past + share, side="right")))
        words, lo = order[lo:hi], hi
        rows, lengths = np.arange(len(words)), first[words + 1] - first[words]
        who = np.repeat(rows, lengths)
        at = np.arange(len(who)) + np.repeat(first[words] - np.cumsum(lengths) + lengths, lengths)
        side, other, m = code[at] // classes, code[at] % classes, n[at].astype(float)
        old, after = label[words], side == _AFTER
        starts = np.cumsum(lengths) - lengths
        gain = np.add.reduceat(_growth(np.concatenate([between, between.T]), other + classes * after, m, old[who]), starts, axis=0)
        for total, mine in ((between.sum(axis=1), after), (between.sum(axis=0), ~after)):
            counted = np.bincount(who, weights=m * mine, minlength=len(words))
            gain -= _growth(total[None], np.zeros(len(words), np.int64), counted, old)
        best = np.argmax(gain, axis=1)
        best = np.where(gain[rows, best] > gain[rows, old] + 1e-6, best, old)
        new[words] = best
        moved = (best != old)[who]
        for kind, sign in ((old, -1), (best, 1)):
            a, b, k = kind[who][moved], other[moved], after[moved]
            np.add.at(between, (np.where(k, a, b), np.where(k, b, a)), sign * m[moved])
        np.maximum(between, 0, out=between)
    return new


def _move(between: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counted = between.copy()
        for batch in batches:
            label = best_classes(*_entries(batch), batch.column("kind").to_numpy().astype(np.int64), counted)
            columns = [batch.column(c) for c in ("key", "word", "c")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(label.astype(np.int32))], ["key", "word", "c", "kind"])

    return run


def classify(texts: DataFrame, model: ClassModel, counts: DataFrame, staging: Staging, groups=GROUPS, classes=CLASSES, rounds=ROUNDS) -> tuple[WordClasses, DataFrame]:
    """A class for each training word, starting from those of ``train``: what scoring needs, and the table ``word, c, kind`` of all words but the vocabulary.

    While words move, a neighbour outside the frequent ones is seen in its group's class; in the first round all words are in theirs.
    """
    return _classify(_training_parts(texts, staging), model, counts, staging, groups, classes, rounds)[:2]


def _classify(
    parts: DataFrame, model: ClassModel, counts: DataFrame, staging: Staging, groups: int, classes: int, rounds: int
) -> tuple[WordClasses, DataFrame, DataFrame]:
    """What ``classify`` gives, and all texts of the parts as rows of sums and pairs of classes."""
    spark, size = parts.sparkSession, len(model.unit)
    unknown, fixed = model.unit_class[size:], frozenset(model.unit)
    kinds = {w: int(model.unit_class[u]) for w, u in model.unit.items()}
    few = F.broadcast(spark.createDataFrame([(w,) for w in model.unit], "word binary"))
    group = F.pmod(F.crc32(F.substring("word", -3, 3)), F.lit(groups))
    begin = F.broadcast(spark.createDataFrame(list(enumerate(unknown.tolist())), "g long, kind int"))
    table = counts.join(few, "word", "left_anti").withColumn("g", group.cast("long")).join(begin, "g")
    table = staging.put(table.select(F.xxhash64("word").alias("key"), "word", "c", "kind"), "classes", "zstd")
    known = spark.createDataFrame([(w,) for w in model.frequent if w not in fixed], "word binary")
    near = kinds | {w: int(unknown[group_of(w, groups)]) for w in model.frequent if w not in fixed}

    passing = Staging(spark)  # what is of use here only, and as large as the texts
    likelihood = lambda m: _entropy(m).sum() - _entropy(m.sum(axis=1)).sum() - _entropy(m.sum(axis=0)).sum()
    start = None
    for _ in range(rounds):
        between, moved = _round(parts, model, table, near, classes, staging, passing)
        start = start or (likelihood(between), table, near)
        table = moved
        near = kinds | {bytes(r.word): r.kind for r in table.join(F.broadcast(known), "word", "left_semi").select("word", "kind").collect()}
        passing.clear()
        forget_shuffles(spark)
    words, coded, between = _coded(parts, model, table, near, classes, staging)
    if start is not None and likelihood(between) <= start[0]:
        _, table, near = start
        words, coded, _ = _coded(parts, model, table, near, classes, staging)
    return words, table.drop("key"), coded


def _round(
    parts: DataFrame, model: ClassModel, table: DataFrame, near: dict[bytes, int], classes: int, staging: Staging, passing: Staging
) -> tuple[np.ndarray, DataFrame]:
    """Counts of neighbouring classes as words have them in ``table``, and the table after one round of moves."""
    around = parts.select(*_TEXTS).mapInArrow(_contexts(near, model.unit_class[len(model.unit) :], frozenset(model.unit), classes), "key long, contexts array<long>")
    around = around.groupBy("key").agg(F.flatten(F.collect_list("contexts")).alias("contexts")).join(table, "key")
    around = passing.put(around, "contexts", "zstd")
    between = model.between.copy()
    found = around.select("kind", "contexts").mapInArrow(_between(classes), "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    for pair, n in found.collect():  # at most classes * classes rows
        between[divmod(pair, classes)] += n
    return between, staging.put(around.mapInArrow(_move(between), "key long, word binary, c long, kind int"), "classes", "zstd")


def _coded(
    parts: DataFrame, model: ClassModel, table: DataFrame, near: dict[bytes, int], classes: int, staging: Staging
) -> tuple[WordClasses, DataFrame, np.ndarray]:
    """The model, all texts by the classes of their words, staged, and the counts of neighbouring classes in those of training."""
    unknown = model.unit_class[len(model.unit) :]
    mass = np.bincount(unknown, minlength=classes).astype(float)
    for word in model.unit:
        mass[near[word]] += model.frequent.get(word, 0) + 1
    for kind, n in table.groupBy("kind").agg(F.sum(F.col("c") + 1)).collect():
        mass[kind] += n
    frequent = {w: (model.frequent.get(w, 0), kind) for w, kind in near.items()}
    words = WordClasses(frequent, np.empty((0, classes)), np.log10(np.maximum(mass, 1)), unknown, model.tokens, model.types)

    rare = parts.select("part", "words").mapInArrow(_rare_words(frozenset(near)), "place long, word binary")
    # As few and as small columns as can be, as these rows are many.
    number = F.col("place").bitwiseAND((1 << _NUMBER_BITS) - 1)
    rare = rare.join(table.select("word", "kind", "c"), "word").select(
        F.shiftright("place", _NUMBER_BITS).alias("part"), (F.shiftleft(number, _KIND_BITS) + F.col("kind")).alias("number_kind"), "c"
    )
    kind = parts.schema["ids"].dataType.elementType.simpleString()
    coded = parts.drop("n").groupBy("part").cogroup(rare.groupBy("part")).applyInArrow(
        _texts(words), f"id {kind}, held_out boolean, n_tokens long, n_known long, base double, own double, pairs binary"
    )
    coded = staging.put(coded, "coded", "zstd")
    found = coded.where("not held_out").select("pairs").mapInArrow(_pair_counts(classes), "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    between = np.zeros((classes, classes))
    for pair, n in found.collect():  # at most classes * classes rows
        between[divmod(pair, classes)] += n
    prior = mass / mass.sum()
    transition = (between + _PRIOR * prior) / (between.sum(axis=1, keepdims=True) + _PRIOR)
    return replace(words, transition=np.log10(np.maximum(transition, 1e-300))), coded, between


def _rare_words(known: frozenset[bytes]):
    """The words of each part that are not known to all tasks, with their place: the part, then their number there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                rare = [(number, word) for number, word in enumerate(batch.column("words")[k].as_py().split()) if word not in known]
                place = np.array([number for number, _ in rare], np.int64) + (batch.column("part")[k].as_py() << _NUMBER_BITS)
                yield pa.RecordBatch.from_arrays([pa.array(place), pa.array([word for _, word in rare], pa.binary())], ["place", "word"])

    return run


def _pair_kind(classes: int) -> type:
    return np.uint16 if classes * classes <= 1 << 16 else np.uint32


def _texts(model: WordClasses):
    """A part and those of its words that are not frequent, as rows of its texts: their sums, and their pairs of neighbouring classes as numbers."""
    known, classes = _Known(list(model.frequent), *zip(*model.frequent.values())), len(model.mass)
    base_norm = math.log10(model.tokens + model.types + 1)

    def run(part: pa.Table, rare: pa.Table) -> pa.Table:
        out = []
        for k in range(part.num_rows):
            words, codes, sizes, held = _unpacked(part, k)
            _, count, kind = known.of([*words, END])
            at, found = np.divmod(rare.column("number_kind").to_numpy(), 1 << _KIND_BITS)
            count[at], kind[at] = rare.column("c").to_numpy(), found
            other = np.flatnonzero(kind < 0)
            kind[other] = model.unknown[np.fromiter((group_of(words[w], len(model.unknown)) for w in other.tolist()), np.int64, len(other))]
            bonus = np.log10(np.maximum(count, 0) + 1)
            codes, first = _with_ends(codes, sizes, len(words))
            kinds = kind[codes]
            pairs = (np.concatenate([kinds[-1:], kinds[:-1]]) * classes + kinds).astype(_pair_kind(classes))
            columns = [
                part.column("ids")[k].values, pa.array(held), pa.array(np.diff(first)), pa.array(sums(count[codes] > 0, first)),
                pa.array(np.add.reduceat(bonus[codes] - base_norm, first[:-1])), pa.array(np.add.reduceat((bonus - model.mass[kind])[codes], first[:-1])),
                _blobs(pairs, first),
            ]
            out.append(pa.Table.from_arrays(columns, ["id", "held_out", "n_tokens", "n_known", "base", "own", "pairs"]))
        return pa.concat_tables(out)

    return run


def _pair_counts(classes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(classes * classes, np.int64)
        for batch in pieces(batches, "pairs"):
            total += np.bincount(np.frombuffer(b"".join(batch.column("pairs").to_pylist()), _pair_kind(classes)), minlength=len(total))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["pair", "n"])

    return run


def _scores(transition: np.ndarray):
    """The sum of its own and its transitions, of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "pairs"):
            pairs = np.frombuffer(b"".join(batch.column("pairs").to_pylist()), _pair_kind(len(transition)))
            first = np.cumsum(batch.column("n_tokens").to_numpy()) - batch.column("n_tokens").to_numpy()
            score = batch.column("own").to_numpy() + np.add.reduceat(transition.ravel()[pairs], first)
            kept = ["id", "held_out", "n_tokens", "n_known", "base"]
            yield pa.RecordBatch.from_arrays([*(batch.column(name) for name in kept), pa.array(score)], [*kept, "score"])

    return run


def class_scores(
    df: DataFrame, training: Column, id_column: str = "doc_id", text_column: str = "text", *,
    vocabulary: int = VOCABULARY, groups: int = GROUPS, classes: int = CLASSES, frequent: int = FREQUENT, rounds: int = ROUNDS,
    staging: Staging | None = None,
) -> DataFrame:
    """One row per row of ``df``: the id, ``held_out`` (``training`` is false), ``n_tokens``,
    ``n_known``, ``train_tokens``, ``base_score`` (add-one unigram), ``score`` (class model), both log10.

    A null text is empty: one token, the end. Without any training text every token is unknown. Repeated
    rows are scored (and counted) each. Other columns are not looked at.
    """
    spark = df.sparkSession
    staging = staging or Staging(spark)
    source = df.select(
        F.col(id_column).alias("id"), F.col(text_column).alias("text"), (~F.coalesce(training, F.lit(False))).alias("held_out")
    )
    passing, batch_bytes = Staging(spark), spark.conf.get(_BATCH_BYTES)
    spark.conf.set(_BATCH_BYTES, "4m")  # a part is a large row, and an executor holds a batch several times for each of its tasks
    try:
        parts = _parts(source, passing)
        seed, counts = _train(parts, staging, vocabulary, groups, classes, frequent)
        forget_shuffles(spark)
        model, _, coded = _classify(parts, seed, counts, staging, groups, classes, rounds)
    finally:
        spark.conf.set(_BATCH_BYTES, batch_bytes)
        passing.clear()
    kind = source.schema["id"].dataType.simpleString()
    scored = coded.mapInArrow(_scores(model.transition), f"id {kind}, held_out boolean, n_tokens long, n_known long, base double, score double")
    return scored.select(
        F.col("id").alias(id_column), "held_out", "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"),
        F.col("base").alias("base_score"), "score",
    )
