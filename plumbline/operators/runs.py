"""The run table: where runs begin and end, and which of them are committed.

A run is logged twice: as started, with the keys it is about to use, before its first append, and as
committed after its last. The rows of a run that broke off in between carry validation keys of its
range, whatever partition they are in; readers leave them out, and no later run uses its keys.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import astuple, dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.schemas import DQ_RUNS
from plumbline.sources.local import local_rows

STARTED, COMMITTED = "started", "committed"


@dataclass(frozen=True)
class RunEntry:
    """A run: the one it is compared with, and the keys it uses, above the first and up to the last."""

    execution_key: int
    previous_execution_key: int
    first_validation_key: int
    last_validation_key: int
    last_exception_key: int

    def logged(self, spark: SparkSession, state: str) -> DataFrame:
        fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in DQ_RUNS.fields if f.name not in ("state", "logged_at_ts"))
        row = local_rows(spark, [astuple(self)], fields.replace("bigint", "long"))
        return row.withColumns({"state": F.lit(state), "logged_at_ts": F.current_timestamp()})


@dataclass(frozen=True)
class History:
    """What the next run must know of all earlier ones."""

    last_validation_key: int = 0
    last_execution_key: int = 0
    last_exception_key: int = 0
    committed_execution_key: int = 0
    broken: tuple[tuple[int, int], ...] = ()  # ranges of validation keys: above the first, up to the last

    def committed(self, rows: DataFrame) -> DataFrame:
        """Ledger or validation rows without those of runs that broke off."""
        return without_ranges(rows, self.broken)


def without_ranges(rows: DataFrame, ranges: Sequence[tuple[int, int]]) -> DataFrame:
    if not ranges:
        return rows
    inside = [(F.col("validation_key") > low) & (F.col("validation_key") <= high) for low, high in ranges]
    return rows.filter(~reduce(lambda a, b: a | b, inside))


def history(runs: DataFrame) -> History | None:
    """From the run table, two rows per run; None when it is empty, as for a ledger that was written before there was one."""
    done = F.max(F.col("state") == COMMITTED).alias("done")
    names = [name for name in RunEntry.__dataclass_fields__ if name != "execution_key"]
    by_run = runs.groupBy("execution_key").agg(done, *[F.max(name).alias(name) for name in names])
    committed = F.max(F.when(F.col("done"), F.col("execution_key")))
    # Before the first run that was committed here, runs are compared with one of the time before the table.
    earlier = F.min_by("previous_execution_key", "execution_key")
    broken = F.collect_list(F.when(~F.col("done"), F.struct("first_validation_key", "last_validation_key")))
    row = by_run.agg(
        F.max("last_validation_key"), F.max("execution_key"), F.max("last_exception_key"), F.coalesce(committed, earlier), broken
    ).first()
    if row[1] is None:
        return None
    return History(*row[:4], tuple(sorted((low, high) for low, high in row[4])))
