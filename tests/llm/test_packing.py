import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from plumbline.llm.packing import _places, byte_bpe, pack, pack_documents, plan, sequences, tokenized
from plumbline.llm.queries import op11_packing

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def pieces_of(library, text, capacity):
    ids = [*library.encode(text or "", add_special_tokens=False).ids, 0]
    first = len(ids) % capacity or capacity
    return [ids[:first], *(ids[k : k + capacity] for k in range(first, len(ids), capacity))]


def check(rows, capacity):
    """Every sequence is filled without gaps and within capacity; returns what each holds."""
    held = defaultdict(list)
    for row in rows:
        held[row["sequence_id"]].append((row["offset"], row["length"]))
    for places in held.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= capacity
    return held


def test_ids_equal_the_library(library, sample):
    encode = byte_bpe(open(PATH, encoding="utf-8").read())
    odd = ["a  b\n \n c", " <|endoftext|> x", "\n<|endoftext|>\n y", "né 日本語😀 ' s I'll", "x" * 30_000, " " * 5_000 + "a", "\x00\x1c \x85\xa0", "١٢3 ½"]
    for text in [text for _, text, _, _ in sample if text][::7] + odd:
        assert encode(text).tolist() == library.encode(text, add_special_tokens=False).ids
    white = " " * 1_500_000 + "a"  # more than the fast encoder takes
    assert encode(white).tolist() == library.encode(white, add_special_tokens=False).ids


def test_query_gives_every_piece_once(spark, sf_dir, library, sample):
    rows = op11_packing(spark, sf_dir).collect()
    check(rows, 2048)
    expected = []
    for doc_id, text, _, _ in sample:
        start = 0
        for number, ids in enumerate(pieces_of(library, text, 2048)):
            expected.append((doc_id, number, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
            start += len(ids)
    assert sorted(tuple(row)[:5] for row in rows) == sorted(expected)
    tokens, used = sum(row["length"] for row in rows), {row["sequence_id"] for row in rows}
    assert used == set(range(len(used)))
    assert len(used) <= -(-tokens // 2048) * 1.02 + 1


def best_fit_decreasing(lengths, capacity):
    """Plain best fit, one item after the other."""
    gaps = []
    for length in sorted(lengths, reverse=True):
        fits = [gap for gap in gaps if gap >= length]
        if fits:
            gaps.remove(min(fits))
            gaps.append(min(fits) - length)
        else:
            gaps.append(capacity - length)
    return len(gaps)


@pytest.mark.parametrize("seed", range(12))
def test_plan_is_as_good_as_best_fit(seed):
    rng = np.random.default_rng(seed)
    capacity = int(rng.integers(5, 60))
    counts = {int(k): int(v) for k, v in zip(rng.integers(1, capacity + 1, 12), rng.integers(0, 40, 12))}
    groups = plan(counts, capacity)
    held = Counter()
    for bins, contents in groups:
        assert bins > 0 and sum(length * each for length, each in contents) <= capacity
        assert sum(each for length, each in contents if 3 * length > capacity) <= 2
        for length, each in contents:
            held[length] += bins * each
    assert held == +Counter(counts)
    assert sum(bins for bins, _ in groups) <= best_fit_decreasing(list(Counter(counts).elements()), capacity)


def test_large_items_get_the_most_pairs():
    # 60 fits with 40 only; the 50s pair among themselves.
    groups = plan({60: 3, 40: 2, 50: 3}, 100)
    assert sum(bins for bins, _ in groups) == 5
    assert sorted(c for _, c in groups) == [[(50, 1)], [(50, 2)], [(60, 1)], [(60, 1), (40, 1)]]


def test_places_cover_every_rank():
    counts = {1: 7, 2: 3, 5: 4, 9: 2}
    first, ranges = _places(plan(counts, 10), counts)
    assert ranges[0].tolist()[0] == 0 and first == {1: 0, 2: 7, 5: 10, 9: 14}


def test_equal_lengths_from_many_tasks_are_told_apart(spark):
    """A length that most pieces have, over many tasks, with repeated rows and clashing names."""
    rows = spark.range(0, 900, 1, 7).select(
        (F.col("id") % 50).alias("k"), F.when(F.col("id") % 3 == 0, 3).otherwise(F.col("id") % 11 + 1).cast("long").alias("length"),
        F.lit("x").alias("offset"), F.lit("y").alias("sequence_id"), F.lit(1).alias("part"), F.lit(2).alias("slot"), F.lit(3).alias("n"),
    )
    out = pack(rows, capacity=12)
    assert out.columns == ["k", "length", "part", "slot", "n", "sequence_id", "offset"]
    packed = out.collect()
    assert len(packed) == 900
    assert sum(len(places) for places in check(packed, 12).values()) == 900
    lengths = [row["length"] for row in packed]
    assert len({row["sequence_id"] for row in packed}) <= best_fit_decreasing(lengths, 12)


def test_odd_documents_and_sequences(spark, odd_documents, no_documents, library):
    packed = pack_documents(odd_documents, PATH, capacity=64)
    rows = packed.collect()
    check(rows, 64)
    given = [row for row in odd_documents.collect()]
    assert sorted(tuple(p) for row in given for p in pieces_of(library, row["text"], 64)) == sorted(tuple(row["ids"]) for row in rows)
    whole = {row["sequence_id"]: row for row in sequences(packed).collect()}
    for row in rows:
        ids = whole[row["sequence_id"]]["ids"]
        assert ids[row["offset"] : row["offset"] + row["length"]] == row["ids"]
        assert row["offset"] in whole[row["sequence_id"]]["starts"]
    empty = pack_documents(no_documents, PATH, keep_ids=False)
    assert empty.collect() == [] and empty.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert tokenized(no_documents, PATH).columns[-1] == "ids"


def test_lengths_outside_the_capacity_are_refused(spark):
    with pytest.raises(ValueError):
        pack(spark.range(3).select((F.col("id") + 9).alias("length")), capacity=10)
