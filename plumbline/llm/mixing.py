"""Mixing sources to target weights by iterative proportional fitting.

The tokens of each cell (source, language, topic) are counted; cell weights are raked until the weighted
tokens match the target share of every source, every language and every topic. A document is
kept with the probability weight * budget. As no probability may exceed 1, weights are trimmed to 1 / budget
in every sweep and the others make up for it; the expected tokens kept then have the target shares, wherever
the corpus has enough of a value to reach its share.

The unit of fitting is the cell. A measured number of cells up to ``LOCAL_CELLS`` is fitted on the driver;
more are fitted by the same steps on distributed tables, where cells are already sums and no margin is gathered in one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from plumbline.llm.words import Numbers, Words, mix, pieces, texts_of, word_hashes
from plumbline.sources.staging import Staging

TOPICS, LONG_WORD = 8, 6
POWER = 0.7  # of a value's share of tokens in its target: 1 keeps the corpus, 0 makes all equal
BUDGET = 0.7  # share of the tokens to keep
SWEEPS, TOLERANCE = 200, 1e-6
LOCAL_CELLS = 50_000


def lead_topics(words: Words, hashes, topics: int) -> np.ndarray:
    """A stand-in for topics where a corpus has none: the text's most repeated long word (of the
    smallest hash among equals), hashed to one of ``topics`` groups; -1 for a text without long words."""
    numbers = Numbers()
    codes, doc = numbers.of(words.words), words.doc
    hashed = mix(hashes.of(list(numbers)))
    long = np.flatnonzero(words.end - words.start >= LONG_WORD)
    pair, n = np.unique(doc[long] * max(1, len(numbers)) + codes[long], return_counts=True)
    owner, code = np.divmod(pair, max(1, len(numbers)))
    order = np.lexsort((hashed[code], -n, owner))
    owner, code = owner[order], code[order]
    first = np.concatenate([[True], owner[1:] != owner[:-1]])[: len(owner)]
    out = np.full(len(words.counts), -1, np.int64)
    out[owner[first]] = (hashed[code[first]] % np.uint64(topics)).astype(np.int64)
    return out


def measured(df: DataFrame, text_column: str = "text", topics: int = TOPICS) -> DataFrame:
    """``df`` with ``n_tokens`` (words) and ``topic``; columns of these names are replaced."""
    fields = [field for field in df.schema.fields if field.name not in ("n_tokens", "topic")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = word_hashes()
        for batch in pieces(batches, text_column):
            words = Words(texts_of(batch.column(text_column)), lower=True)
            kept = batch.select([field.name for field in fields])
            added = [pa.array(words.counts, pa.int64()), pa.array(lead_topics(words, hashes, topics))]
            yield pa.RecordBatch.from_arrays([*kept.columns, *added], [*kept.schema.names, "n_tokens", "topic"])

    return df.mapInArrow(run, StructType([*fields, StructField("n_tokens", LongType()), StructField("topic", LongType())]))


def tempered(cells: DataFrame, dimension: str, power: float) -> DataFrame:
    """``value, share``: the shares of tokens of a dimension's values, raised to ``power``; they sum to 1."""
    sums = cells.groupBy(F.col(dimension).alias("value")).agg(F.pow(F.sum("mass").cast("double"), F.lit(power)).alias("raw"))
    total = sums.agg(F.sum("raw")).first()[0]
    return sums.select("value", (F.col("raw") / F.lit(total or 1.0)).alias("share"))


def rake(
    cells: DataFrame, targets: dict[str, DataFrame], staging: Staging, most: float = float("inf"), *,
    sweeps: int = SWEEPS, tolerance: float = TOLERANCE, local_cells: int = LOCAL_CELLS,
) -> DataFrame:
    """``cells`` (dimensions and ``mass`` above 0) with ``weight``, at most ``most``: its weighted mass has the target shares of
    each dimension and the total mass, as closely as ``most`` and ``sweeps`` allow (they end when no weight moves by ``tolerance``).

    Shares are of the values that occur; a value without target has weight 0. Null is a value of its own.
    """
    names = list(targets)
    if cells.count() <= local_cells:
        return _rake_local(cells, targets, most, sweeps, tolerance)
    total = cells.agg(F.sum("mass")).first()[0]
    current = cells.withColumn("weight", F.lit(1.0))
    goals = {name: staging.put(goal, "target") for name, goal in targets.items()}
    for _ in range(sweeps):
        current = current.withColumn("_before", F.col("weight"))
        for name in names:
            sums = current.groupBy(F.col(name).alias("value")).agg(F.sum(F.col("mass") * F.col("weight")).alias("sum"))
            factor = sums.join(goals[name], sums["value"].eqNullSafe(goals[name]["value"]), "left").select(
                sums["value"], F.coalesce(F.when(F.col("sum") > 0, F.col("share") * total / F.col("sum")), F.lit(0.0)).alias("factor")
            )
            current = current.join(factor, current[name].eqNullSafe(factor["value"])).drop("value")
            current = current.withColumn("weight", F.least(F.col("weight") * F.col("factor"), F.lit(most))).drop("factor")
        current = staging.put(current, "raked")
        moved = current.agg(F.max(F.abs(F.col("weight") - F.col("_before")))).first()[0] or 0.0
        current = current.drop("_before")
        if moved < tolerance:
            break
    return current


def _rake_local(cells: DataFrame, targets: dict[str, DataFrame], most: float, sweeps: int, tolerance: float) -> DataFrame:
    rows = sorted(cells.collect(), key=str)
    mass = np.array([r["mass"] for r in rows], float)
    weight = np.ones(len(rows))
    codes, goals = [], []
    for name, goal in targets.items():
        share = {r["value"]: r["share"] for r in goal.collect()}
        values = list(dict.fromkeys(r[name] for r in rows))
        at = {v: k for k, v in enumerate(values)}
        codes.append(np.array([at[r[name]] for r in rows], np.int64))
        goals.append(np.array([share.get(v, 0.0) for v in values]) * mass.sum())
    for _ in range(sweeps):
        before = weight.copy()
        for code, goal in zip(codes, goals):
            sums = np.bincount(code, weights=mass * weight, minlength=len(goal))
            factor = np.divide(goal, sums, out=np.zeros_like(goal), where=sums > 0)
            weight = np.minimum(weight * factor[code], most)
        if np.abs(weight - before).max(initial=0) < tolerance:
            break
    schema = StructType([*cells.schema.fields]).add("weight", "double")
    return cells.sparkSession.createDataFrame([(*r, float(w)) for r, w in zip(rows, weight)], schema)


def mix_to_targets(
    df: DataFrame, id_column: str = "doc_id", text_column: str = "text", dimensions: tuple[str, ...] = ("source", "lang", "topic"), *,
    targets: dict[str, DataFrame] | None = None, budget: float = BUDGET, power: float = POWER, topics: int = TOPICS, seed: int = 1,
    local_cells: int = LOCAL_CELLS, staging: Staging | None = None,
) -> DataFrame:
    """``df`` with ``n_tokens``, ``topic``, ``weight``, ``probability``, ``selected``; columns of these names are replaced.

    ``targets`` (``value, share`` per dimension) default to tempered shares of the corpus. The
    probability is ``weight * budget``. ``selected`` compares it with a hash of the id
    (of the text for a null id): repeated rows share their fate. Texts without words hold no tokens: they have no weight and are
    not selected. Null is a source, language or topic of its own.
    """
    staging = staging or Staging(df.sparkSession)
    full = measured(df, text_column, topics)
    counts = full.groupBy(*dimensions).agg(F.sum("n_tokens").alias("mass")).where("mass > 0")
    cells = staging.put(counts, "cells")
    goals = {name: (targets or {}).get(name) for name in dimensions}
    goals = {name: tempered(cells, name, power) if goal is None else goal for name, goal in goals.items()}
    raked = staging.put(rake(cells, goals, staging, 1 / budget, local_cells=local_cells), "weights")
    keys = [F.col(name).alias(f"_cell_{name}") for name in dimensions]
    weights = raked.select(*keys, F.round("weight", 9).alias("_weight"))
    same = [F.col(name).eqNullSafe(F.col(f"_cell_{name}")) for name in dimensions]
    full = full.select(*[c for c in full.columns if c not in ("weight", "probability", "selected")])
    joined = full.join(weights, _all(same), "left")
    weight = F.when(F.col("n_tokens") > 0, F.coalesce("_weight", F.lit(0.0))).otherwise(0.0)
    chance = F.least(weight * budget, F.lit(1.0))
    identity = F.when(F.col(id_column).isNull(), F.xxhash64(text_column, F.lit(seed))).otherwise(F.xxhash64(id_column, F.lit(seed)))
    draw = F.pmod(identity, F.lit(1 << 52)) / F.lit(float(1 << 52))
    return joined.select(*full.columns, weight.alias("weight"), chance.alias("probability"), (draw < chance).alias("selected"))


def _all(conditions: list[Column]) -> Column:
    out = conditions[0]
    for condition in conditions[1:]:
        out &= condition
    return out
