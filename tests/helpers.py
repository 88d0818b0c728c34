"""Small tables and rules for tests."""

from datetime import date, datetime

from plumbline.operators.checks import build_check
from plumbline.operators.evaluate import check_table
from plumbline.spec import RuleSpec
from plumbline.plans.run import run_rules
from plumbline.sources.staging import Staging

TODAY = date(2024, 5, 1)
RUN_TS = datetime(2024, 5, 1, 12)

BETWEEN = "ExpectColumnValuesToBeBetween"
UNIQUE = "ExpectColumnValuesToBeUnique"
COMPOUND = "ExpectCompoundColumnsToBeUnique"
IN_SET = "ExpectColumnValuesToBeInSet"
NOT_IN_SET = "ExpectColumnValuesToNotBeInSet"
NOT_NULL = "ExpectColumnValuesToNotBeNull"
REGEX = "ExpectColumnValuesToMatchRegex"
LIKE = "ExpectColumnValuesToMatchLikePattern"
PAIR = "ExpectColumnPairValuesAToBeGreaterThanB"
SQL = "UnexpectedRowsExpectation"


def rule(check, arguments, column="x", keys=("id",), rule_key=1, **more):
    return RuleSpec(rule_key, check, arguments, tuple(keys), column, table=more.pop("table", "t"), **more)


def check_one(df, spec, lookups=None):
    """Measures of one rule as a dict, and its exceptions as a sorted list."""
    measures, rows = check_table(df, [spec], (lookups or {}).__getitem__, TODAY, Staging(df.sparkSession))
    found = [(r["exception_row_pk"], r["exception_row_value"]) for r in rows.collect()]
    return measures.first().asDict(), sorted(found, key=str)


def bad_ids(df, spec, lookups=None):
    return [int(pk) for pk, _ in sorted(check_one(df, spec, lookups)[1], key=lambda row: int(row[0]))]


def build(df, spec):
    return build_check(spec, df, {}.__getitem__, TODAY)


def run(spark, specs, tables, **options):
    options.setdefault("run_ts", RUN_TS)
    return run_rules(spark, specs, lambda spec: tables[spec.table], tables.__getitem__, today=TODAY, **options)


def ledger_of(result):
    """The exceptions of a run as a stored ledger."""
    return result.staging.put(result.exceptions, "ledger")


def kinds(result):
    """(rule key, row key) -> kind, for unique row keys."""
    found = {}
    for row in result.exceptions.collect():
        kind = "fixed" if row["fixed_exception_flag"] else "new" if row["new_exception_flag"] else "known"
        found[row["rule_key"], row["exception_row_pk"]] = kind
    return found
