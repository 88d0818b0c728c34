"""One run of a set of rules: evaluate, compare with the ledger, number, report."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import date, datetime
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.functions.expressions import NULL_TEXT, generated_id
from plumbline.operators import ledger as L
from plumbline.operators.align import align_to_schema
from plumbline.operators.checks import Check, ReadTable
from plumbline.operators.evaluate import (
    COLUMN,
    EXCEPTION_ROWS,
    RAW_COUNTS,
    Evaluation,
    as_rule_error,
    evaluate_all,
    exception_rows,
    isolate,
    measures,
)
from plumbline.operators.numbering import number_staged_rows
from plumbline.operators.together import AT_ONCE, together
from plumbline.spec import RuleError, RuleSpec
from plumbline.schemas import DQ_EXCEPTIONS_TABLE, DQ_VALIDATIONS_TABLE, RULE_ERRORS
from plumbline.sources.local import local_rows
from plumbline.sources.staging import Staging

# Errors of rules that were built but could not be checked: these get a failed
# validation. Rules with other errors were never run and get none.
CHECK_ERRORS = {"analysis", "runtime", "unknown_column", "bad_key"}

# Below this share of failing rows a scan task yields too few rows for a file of
# its own, so the (few) failing rows are gathered into files of a sensible size.
SPARSE_SHARE = 0.05

RULE_RUN = "rule_key long, validation_key long, asset_count long, stored_count long"


@dataclass
class RunResult:
    execution_key: int
    validations: DataFrame
    exceptions: DataFrame
    errors: DataFrame
    staging: Staging
    last_validation_key: int
    last_exception_key: int


def run_rules(
    spark: SparkSession,
    specs: Sequence[RuleSpec],
    read_asset: Callable[[RuleSpec], DataFrame],
    read_table: ReadTable,
    *,
    today: date,
    run_ts: datetime | Column,
    execution_key: int = 1,
    last_validation_key: int = 0,
    last_exception_key: int = 0,
    ledger: DataFrame | None = None,
    previous: dict[int, int] | None = None,
    staging: Staging | None = None,
    parallel_assets: int = AT_ONCE,
) -> RunResult:
    """Check rules on their tables and classify the exceptions.

    ``previous`` maps a rule to the run to compare with; by default that is the run
    just before this one. Failing rows stay in DataFrames; the driver sees one row of
    counts per rule.
    """
    staging = staging or Staging(spark)
    now = run_ts if isinstance(run_ts, Column) else F.lit(run_ts)
    evaluations, errors = _evaluate_assets(spark, specs, read_asset, read_table, today, staging, parallel_assets)
    checks = {c.rule_key: c for e in evaluations for c in e.checks}
    counts = {key: row for e in evaluations for key, row in e.counts.items()}
    table_counts = {s.rule_key: e.table_count for e in evaluations for s in e.specs}

    reported = sorted(
        (s for s in specs if s.rule_key in checks or _has_validation(errors.get(s.rule_key))),
        key=lambda s: (s.asset, s.rule_key),
    )
    validation_keys = {s.rule_key: last_validation_key + i for i, s in enumerate(reported, 1)}
    nothing_counted = {"check_kind": COLUMN, "mostly": 1.0} | dict.fromkeys(
        ["table_count", "scope_count", "missing_count", "bad_count"], 0
    )

    def measured_now() -> DataFrame:
        raw = [
            {"rule_key": s.rule_key} | nothing_counted | (counts.get(s.rule_key, {}) if s.rule_key not in errors else {})
            for s in reported
        ]
        return measures(local_rows(spark, [tuple(row.values()) for row in raw], RAW_COUNTS)).withColumn(
            # A rule that could not be checked has not succeeded.
            "success_flag", F.col("success_flag") & ~F.col("rule_key").isin(*errors)
        )

    measured = measured_now()
    unsuccessful = measured.filter(~F.col("success_flag")).select("rule_key")
    failing = {row["rule_key"] for row in unsuccessful.collect()} & set(checks)
    kept = {key for key, check in checks.items() if check.stores_rows}
    bad = {key for key in kept if counts[key]["bad_count"] > 0}

    def spoilt(place: tuple[Evaluation, Check], error: RuleError) -> None:
        """A rule whose rows cannot be made counts as one that could not be checked."""
        errors[place[1].rule_key] = error
        kept.discard(place[1].rule_key)

    staged = _stage_exceptions(evaluations, bad & failing, staging, spoilt)

    # Earlier exceptions matter only for rules whose failing rows are known now.
    compared = {key: execution_key - 1 for key in kept} if previous is None else previous

    def earlier() -> DataFrame:
        return L.prior_open(ledger, {key: run for key, run in compared.items() if key in kept})

    prior, prior_rules = None, set()
    if ledger is not None and kept:
        prior = earlier()
        prior_rules = {row["rule_key"] for row in prior.select("rule_key").distinct().collect()}
    # Rows that still fail under a rule that passes as a whole (``mostly``) are not
    # exceptions, but they are not fixed either.
    tolerated = _stage_exceptions(evaluations, (bad - failing) & prior_rules, staging, spoilt)
    if not prior_rules <= kept:
        prior, prior_rules = earlier(), prior_rules & kept
    measured = measured_now()

    # Of the rows that are stored, not of the scan that counted: a condition may look at the clock.
    stored_counts = {} if staged is None else dict(staged.groupBy("rule_key").count().collect())

    rule_run = local_rows(
        spark,
        [
            (
                s.rule_key,
                validation_keys[s.rule_key],
                table_counts.get(s.rule_key, 0),
                stored_counts.get(s.rule_key, 0),
            )
            for s in reported
        ],
        RULE_RUN,
    )
    exceptions, compared_counts, fixed_count = _classify(
        spark, staged, tolerated, prior if prior_rules else None, rule_run, execution_key, now,
        last_exception_key, sum(stored_counts.values()), staging,
    )
    return RunResult(
        execution_key=execution_key,
        validations=_validations(measured, rule_run, compared_counts, execution_key, now),
        exceptions=exceptions,
        errors=local_rows(spark, [(k, e.reason, e.message) for k, e in sorted(errors.items())], RULE_ERRORS),
        staging=staging,
        last_validation_key=last_validation_key + len(reported),
        last_exception_key=last_exception_key + sum(stored_counts.values()) + fixed_count,
    )


def _has_validation(error: RuleError | None) -> bool:
    return error is not None and error.reason in CHECK_ERRORS


def _evaluate_assets(
    spark: SparkSession, specs: Sequence[RuleSpec], read_asset, read_table, today: date, staging: Staging, parallel: int
) -> tuple[list[Evaluation], dict[int, RuleError]]:
    by_asset: dict[str, list[RuleSpec]] = {}
    for spec in specs:
        by_asset.setdefault(spec.asset, []).append(spec)
    errors: dict[int, RuleError] = {}

    def evaluate_asset(asset: str) -> list[Evaluation]:
        try:
            df = read_asset(by_asset[asset][0])
        except Exception as error:
            fault = as_rule_error(error)
            for spec in by_asset[asset]:
                errors[spec.rule_key] = RuleError("asset", f"cannot read {asset}: {fault.message}")
            return []
        return evaluate_all(df, by_asset[asset], read_table, today, staging)

    evaluated = together(spark, [partial(evaluate_asset, asset) for asset in sorted(by_asset)], parallel)
    evaluations = [evaluation for some in evaluated for evaluation in some]
    for evaluation in evaluations:
        errors.update(evaluation.errors)
    return evaluations, errors


def _stage_exceptions(
    evaluations: Sequence[Evaluation], wanted: set[int], staging: Staging, failed: Callable[[tuple, RuleError], None]
) -> DataFrame | None:
    """Write the failing rows of the wanted rules of all tables once.

    A rule that cannot make its rows is told to ``failed``; what others wrote while it was looked for is kept.
    """
    places = [(e, check) for e in evaluations for check in e.checks if check.rule_key in wanted]
    parts: list[DataFrame] = []
    isolate(lambda some: parts.append(staging.put(_rows_of(some), "exceptions")), places, failed)
    if len(parts) > 1:
        return staging.put(reduce(DataFrame.unionAll, parts), "exceptions")
    return parts[0] if parts else None


def _rows_of(places: Sequence[tuple[Evaluation, Check]]) -> DataFrame:
    by_table: dict[int, tuple[Evaluation, list[Check]]] = {}
    for evaluation, check in places:
        by_table.setdefault(id(evaluation), (evaluation, []))[1].append(check)
    parts = []
    for evaluation, checks in by_table.values():
        rows = exception_rows(evaluation.df, checks)
        bad = sum(evaluation.counts[check.rule_key]["bad_count"] for check in checks)
        parts.append(rows.hint("rebalance") if bad < SPARSE_SHARE * evaluation.table_count else rows)
    return reduce(DataFrame.unionAll, parts)


def _classify(
    spark, staged, tolerated, prior, rule_run, execution_key, now, last_exception_key, stored_count, staging
) -> tuple[DataFrame, DataFrame, int]:
    """Ledger rows of the run, per rule the counts of known and fixed ones, and the number of fixed ones."""
    nothing = local_rows(spark, [], EXCEPTION_ROWS)
    known = local_rows(spark, [], "rule_key long, known_exception_count long")
    fixed_counts = local_rows(spark, [], "rule_key long, fixed_exception_count long")
    # One row per rule of the run.
    run_keys = F.broadcast(rule_run.select("rule_key", "validation_key"))

    if staged is None:
        current = nothing.withColumn("exception_key", F.lit(0).cast("long"))
    else:
        current = number_staged_rows(staged, "exception_key", last_exception_key)
    if prior is None:
        current = current.withColumns(
            {"new_exception_flag": F.lit(True), "first_seen_ts": F.lit(None).cast("timestamp")}
        )
    else:
        still_bad = reduce(DataFrame.unionAll, [rows for rows in (staged, tolerated) if rows is not None], nothing)
        prior_set, current_set = together(
            spark, [partial(L.prior_keys, prior, staging), partial(L.current_keys, still_bad, staging)]
        )
        current = L.mark_known_and_new(current, prior_set)
        known = L.known_counts(current_set, prior_set)
    rows = _as_ledger(
        current.join(run_keys, "rule_key").withColumns(
            {
                "exception_row_value": F.coalesce("exception_row_value", F.lit(NULL_TEXT)),
                "execution_key": F.lit(execution_key),
                "fixed_exception_flag": F.lit(False),
                "row_delete_flag": F.lit(False),
                "created_at_ts": F.coalesce("first_seen_ts", now),
                "modified_at_ts": now,
            }
        )
    )
    fixed_count = 0
    if prior is not None:
        fixed = staging.put(L.fixed_rows(prior, current_set).drop("exception_key", "validation_key"), "fixed")
        fixed_counts = fixed.groupBy("rule_key").agg(F.count(F.lit(1)).alias("fixed_exception_count"))
        fixed_count = fixed.count()
        fixed = number_staged_rows(fixed, "exception_key", last_exception_key + stored_count)
        rows = rows.unionByName(_as_ledger(fixed.join(run_keys, "rule_key")))
    return rows, known.join(fixed_counts, "rule_key", "full_outer"), fixed_count


def _as_ledger(rows: DataFrame) -> DataFrame:
    keyed = rows.withColumn("integration_id", generated_id(F.col("exception_row_pk"), F.col("modified_at_ts")))
    return align_to_schema(keyed, DQ_EXCEPTIONS_TABLE)


def _validations(measured, rule_run, compared, execution_key, now) -> DataFrame:
    """Validation rows: measures, plus new, known and fixed exceptions as shares of the table."""
    rows = measured.join(rule_run, "rule_key").join(compared, "rule_key", "left")
    base, stored = F.greatest("asset_count", F.lit(1)), F.col("stored_count")
    known = F.when(stored > 0, F.coalesce("known_exception_count", F.lit(0))).otherwise(0)
    counted = {
        "known_exception_count": known,
        "new_exception_count": stored - known,
        "fixed_exception_count": F.coalesce("fixed_exception_count", F.lit(0)),
    }
    rows = rows.withColumns(counted)
    rows = rows.withColumns({name.replace("_count", "_percent"): F.col(name) / base for name in counted})
    rows = rows.withColumns(
        {
            "execution_key": F.lit(execution_key),
            "created_at_ts": now,
            "modified_at_ts": now,
        }
    )
    rows = rows.withColumn("integration_id", generated_id(F.col("rule_key"), F.col("execution_key")))
    return align_to_schema(rows, DQ_VALIDATIONS_TABLE)
