"""SimHash fingerprints of documents, and all fingerprints within a Hamming radius.

Terms are the words of a text and its runs of three words, which weigh more; repeating a term adds to
its weight with the logarithm. A term votes on every bit with the bits of its hash; a bit is set when the votes for it prevail.
Votes are counted per byte value and multiplied by the table of a byte's signs, so a text of any length costs a
few counts per term.

Near fingerprints: cut into more blocks than bits may differ, at least one block is equal. There is one
table per block, keyed by it. Equal fingerprints are one entry. A pair is taken only from the first block that agrees.
For wider radii queries also ask for blocks with up to ``flips`` bits changed: if fewer than blocks x (flips + 1) bits
differ, one block differs in no more than ``flips``. So only the queries grow, and nothing within the radius is missed.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.words import MIXER, Words, grams, mix, pieces, texts_of, word_hashes
from plumbline.sources.staging import Staging

BITS, SHINGLE = 256, 3
WORD_WEIGHT, SHINGLE_WEIGHT = 1, 2
RADIUS, BLOCKS = 7, 8
WIDE_RADIUS, WIDE_FLIPS = 15, 1


def fingerprints(texts: list[bytes], hashes, bits: int = BITS, shingle: int = SHINGLE) -> np.ndarray:
    """Texts x ``bits`` / 8 bytes. Without words all bits are zero; with fewer than ``shingle`` words only they vote."""
    words = Words(texts)
    codes, docs = hashes.of(words.words), len(texts)
    doc = words.doc
    runs = grams(codes, shingle)
    inside = words.first[doc[: len(runs)] + 1] - np.arange(len(runs)) >= shingle
    runs, run_doc = runs[inside], doc[: len(inside)][inside]
    signs = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64) * 2 - 1
    votes = np.zeros((docs, bits // 8, 8), np.int64)
    for terms, owner, weight in ((codes, doc, WORD_WEIGHT), (runs, run_doc, SHINGLE_WEIGHT)):
        terms, owner = _weighted(terms, owner)
        row = owner * 256
        for word in range(bits // 64):
            drawn = mix(terms + np.uint64((word + 1) * int(MIXER) & 0xFFFFFFFFFFFFFFFF)).view(np.uint8).reshape(len(terms), 8)
            for k in range(8):
                counts = np.bincount(row + drawn[:, k], minlength=docs * 256).reshape(docs, 256)
                votes[:, word * 8 + k] += weight * (counts @ signs)
    return np.packbits((votes > 0).reshape(docs, bits), axis=1)


def _weighted(terms: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each text's distinct terms, 1 + log2(occurrences) times each."""
    _, at, n = np.unique(mix(terms + owner.astype(np.uint64) * MIXER), return_index=True, return_counts=True)
    at = np.repeat(at, 1 + np.log2(n).astype(np.int64))
    return terms[at], owner[at]


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The cosine of the term weights, estimated from the share of different bits; 0 where it would be negative."""
    bits = a.shape[1] * 8
    apart = np.bitwise_count(a ^ b).sum(axis=1, dtype=np.int64)
    return np.where(apart == 0, 1.0, np.clip(np.cos(np.pi * apart / bits), 0, 1))


def _hex(rows: np.ndarray) -> list[str]:
    return [row.tobytes().hex() for row in rows]


_COLUMNS = ["n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
_SCHEMA = "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _compared(ids: pa.Array, texts: list[str], following: list[str], own: np.ndarray, after: np.ndarray, hashes, bits: int, extra=()) -> list[pa.Array]:
    edited = [(t[: len(t) - len(t) // 2] + f[: len(t) // 2]).encode() for t, f in zip(texts, following)]
    changed = fingerprints(edited, hashes, bits)
    return [
        ids, pa.array([len(t) for t in texts], pa.int64()), pa.array([hashlib.sha256(e).hexdigest() for e in edited], pa.string()),
        pa.array(_hex(own), pa.string()), pa.array(_hex(changed), pa.string()), pa.array(likeness(own, changed)), pa.array(likeness(own, after)),
    ]


def _in_order(bits: int):
    """Rows of a task come in order; each is compared with the next. The first and the last are also handed out with their texts, for the neighbours in other tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, part, held = word_hashes(), TaskContext.get().partitionId(), None

        def edge(kind: int, id_: pa.Array, text: str, print_: np.ndarray) -> pa.RecordBatch:
            blank = [pa.nulls(1, t) for t in (pa.int64(), pa.string())]
            none = [pa.nulls(1, t) for t in (pa.string(), pa.float64(), pa.float64())]
            arrays = [id_, *blank, pa.array(_hex(print_)), *none, pa.array([kind], pa.int32()), pa.array([part], pa.int32()), pa.array([text], pa.string())]
            return pa.RecordBatch.from_arrays(arrays, ["id", *_COLUMNS, "kind", "part", "text"])

        for batch in pieces(batches, "text", 2 << 20):
            raw = texts_of(batch.column("text"))
            texts, ids = [t.decode("utf-8", "replace") for t in raw], batch.column("id")
            own = fingerprints(raw, hashes, bits)
            if held is None:
                yield edge(1, ids.slice(0, 1), texts[0], own[:1])
            else:
                ids = pa.concat_arrays([held[0], ids])
                texts, own = [held[1], *texts], np.concatenate([held[2], own])
            n = len(texts) - 1
            if n:
                arrays = _compared(ids.slice(0, n), texts[:-1], texts[1:], own[:-1], own[1:], hashes, bits)
                kind, where = pa.array(np.zeros(n, np.int32)), pa.array(np.full(n, part, np.int32))
                yield pa.RecordBatch.from_arrays([*arrays, kind, where, pa.nulls(n, pa.string())], ["id", *_COLUMNS, "kind", "part", "text"])
            held = ids.slice(n, 1), texts[-1], own[-1:]
        if held is not None:
            yield edge(2, *held)

    return run


def _across(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = word_hashes()
        for batch in batches:
            prints = [np.array([list(bytes.fromhex(x)) for x in batch.column(c).to_pylist()], np.uint8).reshape(-1, bits // 8) for c in ("own", "after")]
            texts = [batch.column(c).to_pylist() for c in ("text", "following")]
            yield pa.RecordBatch.from_arrays(_compared(batch.column("id"), *texts, *prints, hashes, bits), ["id", *_COLUMNS])

    return run


def fingerprint_documents(df: DataFrame, id_column: str = "doc_id", text_column: str = "text", *, bits: int = BITS, staging: Staging | None = None) -> DataFrame:
    """One row per row of ``df``: the id, ``n_chars``, ``edited_sha256``, ``fingerprint``, ``edited_fingerprint``, ``near_edited``, ``near_next``.

    The edited text has its last half (rounded down) replaced by as much of the beginning of the next document, in ascending order of
    ids (null first; equal ids by a hash of their text); after the last comes the first. A null text is empty; two empty
    texts are alike. Texts move once, to be in order; only those at the bounds of tasks are met again. Other columns are not read.
    """
    staging = staging or Staging(df.sparkSession)
    source = df.select(F.col(id_column).alias("id"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    kind = source.schema["id"].dataType.simpleString()
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["id", "tie"]
    ordered = source.withColumn("tie", F.xxhash64("text")).repartitionByRange(partitions, *order).sortWithinPartitions(*order).drop("tie")
    done = ordered.mapInArrow(_in_order(bits), f"id {kind}, {_SCHEMA}, kind int, part int, text string")
    done = staging.put(done, "compared")

    firsts = done.where("kind = 1").select("part", F.col("text").alias("following"), F.col("fingerprint").alias("after"))
    lasts = done.where("kind = 2").select("id", "part", "text", F.col("fingerprint").alias("own"))
    parts = sorted(row.part for row in done.where("kind = 1").select("part").collect())  # one number per task
    if not parts:
        return done.select(F.col("id").alias(id_column), *_COLUMNS)
    follows = df.sparkSession.createDataFrame(list(zip(parts, [*parts[1:], parts[0]])), "part int, next int")
    edges = lasts.join(follows, "part").join(firsts.withColumnRenamed("part", "next"), "next")
    edges = edges.select("id", "text", "following", "own", "after").mapInArrow(_across(bits), f"id {kind}, {_SCHEMA}")
    return done.where("kind = 0").select("id", *_COLUMNS).union(edges).withColumnRenamed("id", id_column)


def hamming(a: Column, b: Column, bits: int = BITS) -> Column:
    """Bits in which two fingerprints (hexadecimal) differ."""
    word = lambda c, k: F.conv(F.substring(c, 16 * k + 1, 16), 16, -10).cast("long")
    return sum((F.bit_count(word(a, k).bitwiseXOR(word(b, k))) for k in range(bits // 64)), F.lit(0))


def _tables(prints: DataFrame, name: str, bits: int, blocks: int, flips: int = 0) -> DataFrame:
    width = bits // 4 // blocks
    cut = F.array(*(_block(name, k, width) for k in range(blocks)))
    tables = prints.select("*", F.posexplode(cut).alias("block", "key"))
    changes = [sum(1 << b for b in bits_) for n in range(flips + 1) for bits_ in itertools.combinations(range(4 * width), n)]
    if flips:
        changes = [c - (1 << 64) if c >> 63 else c for c in changes]
        tables = tables.withColumn("change", F.explode(F.array(*map(F.lit, changes)).cast("array<long>")))
        tables = tables.withColumn("key", F.col("key").bitwiseXOR(F.col("change"))).drop("change")
    return tables.withColumn(name, F.unhex(name))


def _block(name: str, k: int, width: int) -> Column:
    return F.conv(F.substring(name, k * width + 1, width), 16, -10).cast("long")


def within_radius(
    queries: DataFrame, entries: DataFrame, column: str = "fingerprint", *, radius: int = RADIUS, bits: int = BITS, blocks: int = BLOCKS, flips: int = 0
) -> DataFrame:
    """All pairs ``query, found, distance`` of distinct fingerprints at most ``radius`` bits apart, equal ones included.

    ``blocks`` times ``flips`` + 1 must exceed ``radius``, so that no pair is missed, and ``blocks`` divide the fingerprint's digits into
    blocks of at most 64 bits. Null fingerprints are left out.
    """
    if blocks * (flips + 1) <= radius or (bits // 4) % blocks or bits // blocks > 64:
        raise ValueError("blocks must exceed radius and divide the digits of a fingerprint")
    left = _tables(queries.select(F.col(column).alias("query")).where("query is not null").distinct(), "query", bits, blocks, flips)
    right = _tables(entries.select(F.col(column).alias("found")).where("found is not null").distinct(), "found", bits, blocks)
    near = left.join(right, ["block", "key"]).select("block", F.lower(F.hex("query")).alias("query"), F.lower(F.hex("found")).alias("found"))
    first = F.lit(blocks)
    for k in reversed(range(blocks)):
        differ = F.bit_count(_block("query", k, bits // 4 // blocks).bitwiseXOR(_block("found", k, bits // 4 // blocks)))
        first = F.when(differ <= flips, k).otherwise(first)
    apart = hamming(F.col("query"), F.col("found"), bits)
    near = near.where((first == F.col("block")) & (apart <= radius))
    return near.select("query", "found", apart.alias("distance"))
