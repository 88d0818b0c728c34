"""The whole workflow over catalog tables: ingest rules, run them, save the results."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.operators import ledger as L
from plumbline.operators.runs import COMMITTED, STARTED, History, RunEntry, history
from plumbline.plans import rulebook as R
from plumbline.plans.run import RunResult, run_rules
from plumbline.schemas import DQ_RULE, DQ_RULE_TYPE, RULE_ERRORS
from plumbline.sources import catalog
from plumbline.sources.local import local_rows
from plumbline.sources.staging import Staging
from plumbline.sources.store import Store
from plumbline.spec import RuleError, RuleSpec


def update_rule_types(store: Store, source: str, staging: Staging) -> bool:
    """Upsert the rule types; False, and nothing is changed, when the source cannot be read."""
    try:
        types = R.ingest_rule_types(store.table(source))
    except AnalysisException:
        return False
    if types.isEmpty():
        raise ValueError(f"no current rule types in {source}")
    store.upsert(types, store.rule_types, "rule_type_key", DQ_RULE_TYPE, staging)
    return True


def update_rules(store: Store, rule_tables: Sequence[str], staging: Staging, mode: str | None = None) -> DataFrame:
    """Ingest the rule tables and upsert the rules by their business key.

    Source rows that are no rules by their values are returned as errors and left out; the others are stored.
    """
    if not rule_tables:
        return local_rows(store.spark, [], RULE_ERRORS)
    incoming = staging.put(R.ingest_rules([store.table(name) for name in rule_tables]), "rule-sources")
    keyed = R.assign_rule_keys(R.fit_rules(incoming), store.table(store.rules), staging)
    store.upsert(keyed, store.rules, "integration_id", DQ_RULE, staging, mode)
    return R.unfit_rules(incoming)


@dataclass
class Selection:
    """The rules of a run: those to check, those skipped with a reason, those with an error."""

    specs: list[RuleSpec]
    skipped: DataFrame
    errors: DataFrame


def select_rules(rules: DataFrame, today: date, assets: Iterable[str] | None = None) -> Selection:
    """Active rules of resolved rules. One row per active rule reaches the driver."""
    marked = R.with_status(rules, today, assets)
    skipped = marked.filter(F.col("status") != "active").select("rule_key", F.col("status").alias("reason"))
    specs, errors = [], []
    active = R.parse_rules(marked.filter(F.col("status") == "active"))
    for row in active.orderBy("rule_key").collect():
        try:
            specs.append(RuleSpec.from_row(row))
        except RuleError as error:
            errors.append((row["rule_key"], error.reason, error.message))
    return Selection(specs, skipped, local_rows(rules.sparkSession, errors, RULE_ERRORS))


def _unlogged(store: Store) -> History:
    """The history of a ledger from before the run table; its last run counts as committed."""
    keys = L.starting_point(store.table(store.validations), store.table(store.exceptions))
    return History(*keys, committed_execution_key=keys[1])


def run_stored_rules(
    store: Store,
    *,
    source: str = catalog.HIVE,
    today: date | None = None,
    run_ts: datetime | None = None,
    assets: Iterable[str] | None = None,
    previous: str = "last_run",
    staging: Staging | None = None,
) -> tuple[RunResult, Selection]:
    """Check the stored active rules and append the results to the ledger.

    The run table tells where to begin, and which run to compare with: the last one that was
    committed. A run that breaks off before it is committed leaves rows that no reader of
    committed rows sees, so nothing of it has to be undone.
    ``previous`` is what exceptions are compared with: ``last_run``, or
    ``last_evaluated``, the last run in which the rule itself was checked.
    """
    if previous not in ("last_run", "last_evaluated"):
        raise ValueError(f"unknown previous: {previous}")
    spark = store.spark
    staging = staging or Staging(spark)
    run_ts = run_ts or datetime.now()
    today = today or run_ts.date()
    rules = R.resolve_rules(store.table(store.rules), store.table(store.rule_types))
    selection = select_rules(rules, today, assets)
    past = history(store.table(store.runs)) or _unlogged(store)
    validations, ledger = past.committed(store.table(store.validations)), past.committed(store.table(store.exceptions))
    execution_key = past.last_execution_key + 1
    keys = [spec.rule_key for spec in selection.specs]
    earlier = dict.fromkeys(keys, past.committed_execution_key)
    if previous == "last_evaluated":
        rows = L.last_evaluated(validations, keys, execution_key).collect()
        earlier = {row["rule_key"]: row["execution_key"] for row in rows}
        # A run without validations checked the rules that it left rows of.
        earlier |= dict.fromkeys(L.unfinished_rules(ledger, validations), past.last_execution_key)
    result = run_rules(
        spark,
        selection.specs,
        lambda spec: store.table(catalog.asset_table(source, spec.catalog, spec.schema, spec.table)),
        store.table,
        today=today,
        run_ts=run_ts,
        execution_key=execution_key,
        last_validation_key=past.last_validation_key,
        last_exception_key=past.last_exception_key,
        ledger=ledger,
        previous=earlier,
        staging=staging,
    )
    entry = RunEntry(execution_key, past.committed_execution_key, past.last_validation_key, result.last_validation_key, result.last_exception_key)
    store.log_run(entry, STARTED)
    store.append(result.exceptions, store.exceptions)
    store.append(result.validations, store.validations)
    store.log_run(entry, COMMITTED)
    # What was stored can be read when the staged tables behind it are gone.
    stored = F.col("validation_key") > past.last_validation_key
    result.exceptions = store.table(store.exceptions).filter(stored)
    result.validations = store.table(store.validations).filter(stored)
    return result, selection


def run_workflow(
    spark: SparkSession,
    rule_tables: Sequence[str],
    rule_type_table: str | None,
    *,
    schema: str = "dqops",
    table_format: str = "parquet",
    keep_staging: bool = False,
    **run_options,
) -> tuple[RunResult, Selection]:
    """Update rule types and rules from their sources (where given), then run and save.

    The staged tables of the run are deleted at its end, also after a failure, unless they
    are to be kept; who calls the parts of the workflow with a staging of their own clears it.
    """
    store = Store(spark, schema, table_format, enforce=True)
    store.create()
    staging = Staging(spark)
    try:
        if rule_type_table is not None:
            update_rule_types(store, rule_type_table, staging)
        # One row per unsuitable source row, as for other rule errors.
        rejected = [tuple(row) for row in update_rules(store, rule_tables, staging).collect()]
        result, selection = run_stored_rules(store, staging=staging, **run_options)
        selection.errors = local_rows(spark, rejected, RULE_ERRORS).unionByName(selection.errors)
        return result, selection
    finally:
        if not keep_staging:
            staging.clear()
