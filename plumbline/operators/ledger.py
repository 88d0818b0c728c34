"""Compare a run's exceptions with those left open by earlier runs."""

from __future__ import annotations

from collections.abc import Collection, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.operators.probe import KeySet, probe, stage_keys
from plumbline.sources.staging import Staging

ROW = ["rule_key", "exception_row_pk"]


def last_run(validations: DataFrame) -> DataFrame:
    """Keys of the latest validation, zeros when there is none."""
    latest = F.max(F.struct("validation_key", "execution_key"))
    return validations.agg(latest.alias("last")).select(
        F.coalesce(F.col("last.validation_key"), F.lit(0)).cast("long").alias("validation_key"),
        F.coalesce(F.col("last.execution_key"), F.lit(0)).cast("int").alias("execution_key"),
    )


def max_exception_key(ledger: DataFrame, at_least: int = 0) -> DataFrame:
    """Largest key given out; a known lower bound lets the scan skip what lies below it."""
    above = ledger.filter(F.col("exception_key") > at_least)
    return above.agg(F.coalesce(F.max("exception_key"), F.lit(at_least)).cast("long").alias("max_exception_key"))


def starting_point(validations: DataFrame, ledger: DataFrame) -> tuple[int, int, int]:
    """Last validation, execution and exception key in use.

    A run that broke off after its exceptions were stored has no validations. Its keys
    count as used, so the next run compares itself with it and repeats nothing. Both
    looks into the ledger filter on keys that grow from run to run, and so read little
    more than file footers.
    """
    last = last_run(validations).first()
    unfinished = (
        ledger.filter(F.col("validation_key") > last["validation_key"])
        .agg(F.max("validation_key").alias("validation_key"), F.max("execution_key").alias("execution_key"))
        .first()
    )
    # Fixed rows keep the key of an earlier run, so a run that stored nothing else shows by its validation keys only.
    begun = 0 if unfinished["validation_key"] is None else max(unfinished["execution_key"] or 0, last["execution_key"] + 1)
    stored = F.col("known_exception_count") + F.col("new_exception_count") + F.col("fixed_exception_count")
    numbered = validations.agg(F.coalesce(F.sum(stored), F.lit(0))).first()[0]
    return (
        max(last["validation_key"], unfinished["validation_key"] or 0),
        max(last["execution_key"], begun),
        max_exception_key(ledger, numbered).first()[0],
    )


def unfinished_rules(ledger: DataFrame, validations: DataFrame) -> list[int]:
    """Rules of which a run that broke off before its validations has stored rows."""
    last = last_run(validations).first()["validation_key"]
    return [row[0] for row in ledger.filter(F.col("validation_key") > last).select("rule_key").distinct().collect()]


def last_evaluated(validations: DataFrame, rule_keys: Collection[int], before: int) -> DataFrame:
    """Per rule the latest run before ``before`` that really checked it.

    A rule that broke leaves a failed validation without elements.
    """
    broke = ~F.col("success_flag") & (F.col("element_count") == 0)
    checked = validations.filter(
        (F.col("execution_key") < before) & F.col("rule_key").isin(*rule_keys) & ~broke
    )
    return checked.groupBy("rule_key").agg(F.max("execution_key").alias("execution_key"))


def prior_open(ledger: DataFrame, previous: Mapping[int, int]) -> DataFrame:
    """Open exceptions of each rule's previous run (rule key -> execution key).

    The filter holds literals only, so it prunes the ledger's partitions.
    """
    by_run: dict[int, list[int]] = {}
    for rule_key, execution_key in sorted(previous.items()):
        by_run.setdefault(execution_key, []).append(rule_key)
    runs = [(F.col("execution_key") == run) & F.col("rule_key").isin(*keys) for run, keys in by_run.items()]
    chosen = reduce(lambda a, b: a | b, runs, F.lit(False))
    return ledger.filter(chosen & ~F.col("fixed_exception_flag"))


def _row_keys(rows: DataFrame, *more: Column) -> DataFrame:
    keys = [F.col(name).alias(f"_k{i}") for i, name in enumerate(ROW)]
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), *more)


def prior_keys(prior: DataFrame, staging: Staging) -> KeySet:
    """One row per open exception key, with the time it was first seen.

    Row keys need not be unique in the ledger; reducing them here keeps the
    comparison from multiplying rows, and a frequent key from gathering in one task.
    """
    return stage_keys(_row_keys(prior, F.min("created_at_ts").alias("first_seen_ts")), staging, "prior-keys")


def current_keys(current: DataFrame, staging: Staging) -> KeySet:
    return stage_keys(_row_keys(current), staging, "current-keys")


def mark_known_and_new(current: DataFrame, prior: KeySet) -> DataFrame:
    """Current exceptions with ``new_exception_flag`` and ``first_seen_ts`` (null when new).

    A left join to unique keys, not a full outer join: frequent row keys of the
    current side can then be spread over tasks.
    """
    marked = probe(current, [F.col(name) for name in ROW], prior, "left")
    return marked.withColumn("new_exception_flag", F.col("n").isNull()).drop("n")


def known_counts(current: KeySet, prior: KeySet) -> DataFrame:
    """Known exceptions per rule, from the unique keys of both sides."""
    both = current.keys.join(prior.keys.select("_k0", "_k1"), ["_k0", "_k1"])
    return both.groupBy(F.col("_k0").alias("rule_key")).agg(F.sum("n").alias("known_exception_count"))


def fixed_rows(prior: DataFrame, current: KeySet) -> DataFrame:
    """Open exceptions whose row no longer fails, marked as fixed."""
    gone = probe(prior, [F.col(name) for name in ROW], current, "left_anti")
    return gone.withColumns({"fixed_exception_flag": F.lit(True), "new_exception_flag": F.lit(False)})
