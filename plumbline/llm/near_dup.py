"""Near-duplicate documents: SuperMinHash, banding, exact verification, grouping.

Documents are linked when the Jaccard similarity of their sets of word shingles reaches
a threshold. Equal sets are one node; a node's copies never become pairs.

* Banding finds candidates: two sets that share all signature places of a band meet in a
  bucket. With the defaults a pair of similarity 0.75 is missed with probability 5e-6.
* Star rounds compare each node with one member of its buckets: a number of pairs that is
  linear in the nodes. A bucket whose members are by then of one component is done.
* What is left is compared exhaustively inside each bucket, by an inverted index in blocks of
  bounded size that spread one bucket over many tasks. No pair is emitted but links that join
  two components. So every pair that meets in a bucket is either compared on its full sets or
  already known to be in one component.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.components import components, forest
from plumbline.llm.superminhash import band_hashes, signatures
from plumbline.llm.words import Words, grams, mix, pieces, texts_of, word_hashes
from plumbline.sources.staging import Staging

SHINGLE = 5
PERCENT = 75
BANDS, ROWS = 45, 5
STAR_ROUNDS = 2
BLOCK_BYTES = 4 << 20


def shingle_sets(texts: list[bytes], hashes, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, flat, and where each text's begin."""
    words = Words(texts, lower=True)
    codes = hashes.of(words.words)
    rolled, sets = grams(codes, shingle), []
    for lo, hi in zip(words.first[:-1].tolist(), words.first[1:].tolist()):
        if hi - lo >= shingle:
            sets.append(np.unique(rolled[lo : hi - shingle + 1]))
        else:
            sets.append(grams(codes[lo:hi], hi - lo) + np.uint64(hi - lo) if hi > lo else rolled[:0])
    first = np.concatenate([[0], np.cumsum([len(x) for x in sets])]).astype(np.int64)
    return np.concatenate(sets) if sets else rolled[:0], first


def _digests(flat: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit digests of each set."""
    total = lambda x: np.diff(np.concatenate([[np.uint64(0)], np.cumsum(x, dtype=np.uint64)])[first])
    return total(mix(flat + np.uint64(1))).view(np.int64), total(mix(flat ^ np.uint64(0x5851F42D4C957F2D))).view(np.int64)


def _sketch(text_column: str, shingle: int, bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = word_hashes()
        for batch in pieces(batches, text_column):
            flat, first = shingle_sets(texts_of(batch.column(text_column)), hashes, shingle)
            found = band_hashes(signatures(flat, first, bands * rows), bands, rows)
            one, two = _digests(flat, first)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(found) + 1, dtype=np.int32) * bands), pa.array(found.view(np.int64).ravel()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.diff(first)), pa.array(one), pa.array(two), lists],
                ["id", "n", "d1", "d2", "bands"],
            )

    return run


def _sets(text_column: str, shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = word_hashes()
        for batch in pieces(batches, text_column):
            flat, first = shingle_sets(texts_of(batch.column(text_column)), hashes, shingle)
            one, two = _digests(flat, first)
            lists = pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(flat.view(np.int64)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.diff(first)), pa.array(one), pa.array(two), lists], ["n", "d1", "d2", "elements"]
            )

    return run


def links_within(sets: list[np.ndarray], groups: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Links (a forest of them) between members of different groups, by an inverted index.

    The largest group is only indexed; members of the others look up all their partners.
    """
    sizes = np.array([len(x) for x in sets])
    flat, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    kinds, group, counts = np.unique(groups, return_inverse=True, return_counts=True)
    merged = list(range(len(kinds)))

    def root(x: int) -> int:
        while merged[x] != x:
            merged[x] = merged[merged[x]]
            x = merged[x]
        return x

    found = []
    for x in np.flatnonzero(group != np.argmax(counts)).tolist():
        lo, hi = np.searchsorted(flat, sets[x], "left"), np.searchsorted(flat, sets[x], "right")
        lengths = hi - lo
        at = np.repeat(lo - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths) + np.arange(lengths.sum())
        shared = np.bincount(owner[at], minlength=len(sets))
        for y in np.flatnonzero(100 * shared >= percent * (sizes + sizes[x] - shared)).tolist():
            if (a := root(group[x])) != (b := root(group[y])):
                merged[max(a, b)] = min(a, b)
                found.append((x, y))
    return found


def _compare(percent: int):
    """Rows of one unit (bucket, i, j) come together; a unit has bounded size. Gives links a, b."""

    def links(rows: list[pa.RecordBatch]) -> pa.RecordBatch | None:
        table = pa.Table.from_batches(rows).combine_chunks()
        nodes, at = np.unique(table.column("node").to_numpy(), return_index=True)
        groups = table.column("component").to_numpy()[at]
        elements = table.column("elements").chunk(0) if len(nodes) else []
        sets = [elements[int(k)].values.to_numpy() for k in at]
        pairs = links_within(sets, groups, percent) if len(nodes) > 1 and (groups != groups[0]).any() else []
        if not pairs:
            return None
        a, b = np.array(pairs).T
        return pa.RecordBatch.from_arrays([pa.array(nodes[a]), pa.array(nodes[b])], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, last = [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            unit = np.stack([batch.column(c).to_numpy() for c in ("bucket", "i", "j")], axis=1)
            cuts = [0, *(np.flatnonzero((unit[1:] != unit[:-1]).any(axis=1)) + 1).tolist(), batch.num_rows]
            for lo, hi in zip(cuts[:-1], cuts[1:]):
                if held and tuple(unit[lo]) != last:
                    if (out := links(held)) is not None:
                        yield out
                    held = []
                last = tuple(unit[lo])
                held.append(batch.slice(lo, hi - lo))
        if held and (out := links(held)) is not None:
            yield out

    return run


def linked(shared: Column, a: Column, b: Column, percent: int) -> Column:
    return 100 * shared >= percent * (a + b - shared)


def near_duplicates(
    df: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    *,
    shingle: int = SHINGLE,
    percent: int = PERCENT,
    bands: int = BANDS,
    rows: int = ROWS,
    staging: Staging | None = None,
) -> DataFrame:
    """One row per row of ``df``: the id, ``n_shingles``, ``component_id``, ``kept``.

    Words are lower-cased (A-Z). A text of fewer words than ``shingle`` is one shingle; a null
    text or one without words has none, and is linked with nothing: its component is its own id.
    ``component_id`` is the smallest id reachable over links, ``kept`` whether it is the row's own.
    Repeated rows are copies of each other and get the same answer; a null id never names a
    component unless all its members have null ids. Other columns of ``df`` are not looked at.
    """
    staging = staging or Staging(df.sparkSession)
    source = df.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    id_type = source.schema["id"].dataType.simpleString()

    sketched = source.mapInArrow(
        _sketch("text", shingle, bands, rows), f"id {id_type}, n long, d1 long, d2 long, bands array<long>"
    )
    sketched = staging.put(sketched.withColumn("row", F.monotonically_increasing_id()), "sketches")
    key = ["n", "d1", "d2"]
    nodes = staging.put(
        sketched.where("n > 0").groupBy(*key).agg(F.min("row").alias("node"), F.min("id").alias("least_id")), "nodes"
    )
    firsts = sketched.join(nodes.select(F.col("node").alias("row")), "row", "left_semi")
    banded = firsts.select(F.col("row").alias("node"), F.explode("bands").alias("bucket"))
    hubs = banded.groupBy("bucket").agg(F.min("node").alias("hub"), F.max("node").alias("top")).where("hub < top")
    members = staging.put(banded.join(hubs.select("bucket", "hub"), "bucket"), "members")

    active = nodes.join(members.select("node").distinct(), "node", "left_semi")
    texts = source.join(active.select("least_id").distinct(), F.col("id").eqNullSafe(F.col("least_id")), "left_semi")
    made = texts.select("text").mapInArrow(_sets("text", shingle), "n long, d1 long, d2 long, elements array<long>")
    sets = made.join(active.select("node", *key), key).dropDuplicates(["node"])
    sets = staging.put(sets.select("node", "n", "elements"), "sets")

    def verified(pairs: DataFrame) -> DataFrame:
        left = sets.select(F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("elements").alias("set_a"))
        right = sets.select(F.col("node").alias("b"), F.col("n").alias("n_b"), F.col("elements").alias("set_b"))
        fits = (100 * F.col("n_a") >= percent * F.col("n_b")) & (100 * F.col("n_b") >= percent * F.col("n_a"))
        shared = F.size(F.array_intersect("set_a", "set_b"))
        both = pairs.join(left, "a").join(right, "b").where(fits)
        return both.where(linked(shared, F.col("n_a"), F.col("n_b"), percent)).select("a", "b")

    links = None
    placed = members.withColumn("component", F.col("node"))
    for turn in range(STAR_ROUNDS):
        if turn == 0:
            pairs = members.where("node <> hub").groupBy("node").agg(F.min("hub").alias("b"))
            pairs = pairs.select(F.col("node").alias("a"), "b")
        else:
            pairs = _toward_hubs(placed, turn)
        found = staging.put(verified(pairs), "links")
        links = found if links is None else links.union(found)
        placed = staging.put(_mixed(members, components(links, staging)), "placed")

    compared = staging.put(_exhaustive(placed, sets, percent), "links")
    links = links.union(compared)

    labels = components(links, staging)
    joined = nodes.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    named = joined.groupBy("component").agg(F.min("least_id").alias("component_id"))
    named = joined.join(named, "component").select(*key, "component_id")
    own = sketched.select("id", *key).join(named, key, "left")
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id"))
    return own.select(
        F.col("id").alias(id_column),
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.col("id").eqNullSafe(component).alias("kept"),
    )


def _mixed(members: DataFrame, labels: DataFrame) -> DataFrame:
    """Members of the buckets that still hold more than one component."""
    placed = members.select("bucket", "node").join(labels, "node", "left")
    placed = placed.select("bucket", "node", F.coalesce("component", "node").alias("component"))
    spread = placed.groupBy("bucket").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
    return placed.join(spread.where("lo < hi").select("bucket"), "bucket", "left_semi")


def _toward_hubs(placed: DataFrame, turn: int) -> DataFrame:
    """Each node with one node of another component: of its buckets' random hubs, the one that comes first."""
    hub = F.min(F.struct(F.xxhash64("node", F.lit(turn)), F.col("node"), F.col("component"))).alias("hub")
    hubs = placed.groupBy("bucket").agg(hub)
    other = placed.join(hubs, "bucket").where("component <> hub.component")
    return other.groupBy(F.col("node").alias("a")).agg(F.min("hub").alias("hub")).select("a", F.col("hub.node").alias("b"))


def _exhaustive(placed: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between components in each mixed bucket; a large bucket is compared block by block, each pair of blocks in a unit of its own."""
    sized = placed.join(sets.select("node", "n"), "node")
    blocks = sized.groupBy("bucket").agg(F.ceil(F.sum(F.col("n") * 8) / BLOCK_BYTES).cast("int").alias("blocks"))
    block = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    dealt = sized.join(blocks, "bucket").withColumn("block", block)
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select(
        "bucket", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "node", "component"
    )
    loaded = dealt.join(sets.select("node", "elements"), "node")
    partitions = int(placed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (
        loaded.repartition(partitions, "bucket", "i", "j")
        .sortWithinPartitions("bucket", "i", "j")
        .mapInArrow(_compare(percent), "a long, b long")
    )
