"""Combine a table with newer rows of it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.functions.expressions import named, quoted

OVERWRITE, COALESCE = "overwrite", "coalesce"


def upserted(target: DataFrame, source: DataFrame, key: str, mode: str = OVERWRITE) -> DataFrame:
    """Target rows updated by, and completed with, the source rows.

    ``overwrite`` takes all source columns of a matched row; ``coalesce`` keeps the
    old value where the source has null. Columns that only the target has are kept.
    """
    if mode not in (OVERWRITE, COALESCE):
        raise ValueError(f"unknown upsert mode: {mode}")
    given = set(source.columns)
    old = target.select(*[named(c).alias(f"old_{c}") for c in target.columns])
    new = source.select(*[named(c).alias(f"new_{c}") for c in target.columns if c in given], F.lit(True).alias("matched"))
    joined = old.join(new, named(f"old_{key}") == named(f"new_{key}"), "full_outer")

    def merged(column: str):
        before = named(f"old_{column}")
        if column not in given:
            return before.alias(column)
        after = named(f"new_{column}")
        if mode == COALESCE or column == key:
            return F.coalesce(after, before).alias(column)
        return F.when(F.col("matched"), after).otherwise(before).alias(column)

    return joined.select(*[merged(column) for column in target.columns])


def repeated_keys(source: DataFrame, key: str) -> DataFrame:
    return source.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def merge_statement(target: str, source: str, key: str, columns: Sequence[str]) -> str:
    """MERGE for table formats that support it."""

    updates = ", ".join(f"target.{quoted(c)} = source.{quoted(c)}" for c in columns)
    names = ", ".join(quoted(c) for c in columns)
    values = ", ".join(f"source.{quoted(c)}" for c in columns)
    return (
        f"MERGE INTO {target} AS target USING {source} AS source ON target.{quoted(key)} = source.{quoted(key)} "
        f"WHEN MATCHED THEN UPDATE SET {updates} WHEN NOT MATCHED THEN INSERT ({names}) VALUES ({values})"
    )
