"""Join a table, which may be skewed, to a set of unique keys."""

from __future__ import annotations

import math
import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.sources.staging import Staging

# Items of the sketch that finds hot keys: many more than keys that can hold a fair partition's rows.
_SKETCH_ITEMS = 8192
_BYTES_PER_FIELD = 16

_UNITS = {"": 0, "b": 0, "k": 10, "kb": 10, "m": 20, "mb": 20, "g": 30, "gb": 30, "t": 40, "tb": 40}


def broadcast_limit(spark: SparkSession) -> int:
    """The session's own bound for broadcast sides, in bytes; -1 forbids them."""
    text = str(spark.conf.get("spark.sql.autoBroadcastJoinThreshold")).strip().lower()
    number, unit = re.fullmatch(r"(-?\d+)\s*([a-z]*)", text).groups()
    return int(number) << _UNITS[unit] if int(number) > 0 else -1


@dataclass(frozen=True)
class KeySet:
    """Staged unique keys ``_k0, _k1, ...`` with ``n``, the rows each stands for."""

    keys: DataFrame
    key_count: int
    row_count: int
    size_in_bytes: int

    @property
    def key_names(self) -> list[str]:
        return [name for name in self.keys.columns if re.fullmatch(r"_k\d+", name)]


def stage_keys(keys: DataFrame, staging: Staging, label: str) -> KeySet:
    """Materialise unique keys and measure them, so a broadcast has a proven bound."""
    staged = staging.put(keys, label)
    return KeySet(staged, *staged.agg(*_measures(_width(staged))).first())


def measured_sets(staged: DataFrame, part: str, names: list[list[str]]) -> list[KeySet]:
    """The key sets of a staged table of several, told apart by a number from 0, with the names of each one's keys; measured in one pass."""
    keys = [
        staged.filter(F.col(part) == i).select(*[F.col(name).alias(f"_k{j}") for j, name in enumerate(some)], "n") for i, some in enumerate(names)
    ]
    widths = [F.when(F.col(part) == i, _width(staged.select(*some, "n"))) for i, some in enumerate(names)]
    sizes = {row[0]: row[1:] for row in staged.groupBy(part).agg(*_measures(F.coalesce(*widths))).collect()}
    return [KeySet(keys[i], *sizes.get(i, (0, 0, 0))) for i in range(len(names))]


def _width(staged: DataFrame) -> Column:
    """Bytes of a row."""

    def width(field) -> Column:
        if isinstance(field.dataType, (T.NumericType, T.BooleanType, T.DatetimeType)):
            return F.lit(_BYTES_PER_FIELD)
        if isinstance(field.dataType, T.BinaryType):
            return F.coalesce(F.octet_length(F.col(field.name)), F.lit(0)) + _BYTES_PER_FIELD
        return F.coalesce(F.octet_length(F.col(field.name).cast("string")), F.lit(0)) + _BYTES_PER_FIELD

    return reduce(lambda a, b: a + b, [width(field) for field in staged.schema.fields])


def _measures(width: Column) -> list[Column]:
    """Keys, rows they stand for, bytes."""
    return [F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum(width.cast("long")), F.lit(0))]


def hashable(kind: T.DataType) -> bool:
    """Whether equal values of a type have equal hashes. Texts of a collation other than byte by byte may not."""
    if isinstance(kind, T.StringType):
        return kind.isUTF8BinaryCollation()
    if isinstance(kind, T.ArrayType):
        return hashable(kind.elementType)
    if isinstance(kind, T.StructType):
        return all(hashable(field.dataType) for field in kind.fields)
    return isinstance(kind, (T.NumericType, T.BooleanType, T.DatetimeType, T.BinaryType))


def hot_hashes(rows: DataFrame, keys: list[Column], partitions: int) -> dict[int, int]:
    """Hashes of the keys that hold more rows than a fair partition, and over how many tasks to spread each."""
    most = min(partitions, _SKETCH_ITEMS // 4)
    found = rows.select(F.xxhash64(*keys).alias("h")).agg(
        F.count(F.lit(1)).alias("total"),
        F.call_function("approx_top_k", "h", F.lit(most), F.lit(_SKETCH_ITEMS)).alias("top"),
    )
    row = found.first()
    fair = max(row["total"] / most, 2)
    hot = [item for item in row["top"] or [] if item["count"] >= fair]
    # Powers of two: few kinds of salting, and so short expressions, whatever the number of hot keys.
    return {item["item"]: min(partitions, 1 << math.ceil(math.log2(2 * item["count"] / fair))) for item in hot}


def probe(rows: DataFrame, on: list[Column], key_set: KeySet, how: str, null_safe: bool = False) -> DataFrame:
    """``rows`` joined ``how`` (semi, anti or left) to a key set.

    A small set is broadcast, so ``rows`` are not shuffled. For a large one both
    sides are shuffled by key; the hot keys of ``rows`` are spread over all shuffle
    partitions and their (unique) partners copied to each of these.
    """
    spark = rows.sparkSession
    names = key_set.key_names
    left_names = [f"_probe{i}" for i in range(len(on))]
    left = rows.select("*", *[column.alias(name) for column, name in zip(on, left_names)])
    right = key_set.keys
    pairs = [(F.col(a), F.col(b)) for a, b in zip(left_names, names)]
    matched = [a.eqNullSafe(b) if null_safe else a == b for a, b in pairs]

    if key_set.size_in_bytes <= broadcast_limit(spark):
        right = F.broadcast(right)
    else:
        kinds = [(left.schema[a].dataType, right.schema[b].dataType) for a, b in zip(left_names, names)]
        salts: dict[int, list[int]] = {}
        # Hashes of both sides must agree; for other types Spark's own handling of skew is left.
        if all(a == b and hashable(a) for a, b in kinds):
            partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
            for key, count in hot_hashes(left, [F.col(name) for name in left_names], partitions).items():
                salts.setdefault(count, []).append(key)
        if salts:
            spread = lambda columns: reduce(
                lambda other, n: F.when(F.xxhash64(*columns).isin(salts[n]), n).otherwise(other), salts, F.lit(1)
            )
            left = left.withColumn("_salt_left", F.pmod(F.spark_partition_id(), spread(left_names)))
            right = right.withColumn("_salt_right", F.explode(F.sequence(F.lit(0), spread(names) - 1)))
            matched.append(F.col("_salt_left") == F.col("_salt_right"))
    joined = left.join(right, reduce(lambda a, b: a & b, matched), how)
    return joined.drop(*left_names, *names, "_salt_left", "_salt_right")
