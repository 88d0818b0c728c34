"""Run checks over one table: counts per rule, then the failing rows."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field, replace
from datetime import date
from functools import partial, reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions.expressions import named
from plumbline.operators.checks import (
    Check,
    KeyedCheck,
    ReadTable,
    RowCheck,
    SqlCheck,
    build_check,
    columns_named,
    condition_of,
    has_subquery,
    prepare_repeated,
)
from plumbline.operators.probe import broadcast_limit
from plumbline.operators.together import together
from plumbline.spec import RuleError, RuleSpec
from plumbline.sources.local import local_rows
from plumbline.sources.staging import Staging

# Rules per scan. A scan keeps its generated code only up to 100 output fields
# (spark.sql.codegen.maxFields), and one rule takes three counters.
COUNTERS_PER_SCAN = 30
ROW_RULES_PER_SCAN = 100
KEYED_RULES_PER_SCAN = 20
# A shared aggregation costs more than a scan or two of the columns: with fewer uniqueness rules each is faster by itself.
PACKED_RULES_FROM = 4

# The rule that a repeated row breaks; a name that no checked table should use.
RULE = "_plumbline_rule"

RAW_COUNTS = (
    "rule_key long, check_kind string, mostly double, table_count long, scope_count long, missing_count long, bad_count long"
)
EXCEPTION_ROWS = "rule_key long, exception_row_pk string, exception_row_value string"

NOT_NULL, SQL_ROWS, COLUMN = "not_null", "sql_rows", "column"

# SQLSTATE classes of errors that the rule's own text or the data under it cause:
# data exceptions, syntax and analysis, cardinality, user-raised, unsupported, limits.
_RULE_FAULTS = ("22", "42", "21", "P0", "0A", "54")


def rule_fault(error: Exception) -> str | None:
    """Message of an error that a rule caused; None for any other failure."""
    if isinstance(error, RuleError):
        return error.message
    text = str(error).split("JVM stacktrace")[0].strip()
    if isinstance(error, AnalysisException):
        return text
    if isinstance(error, PySparkException):
        return text if (error.getSqlState() or "").startswith(_RULE_FAULTS) else None
    if isinstance(error, Py4JJavaError) and "java.util.regex.PatternSyntaxException" in text:
        return text[text.index("java.util.regex.PatternSyntaxException") :].splitlines()[0]
    return None


@dataclass
class Evaluation:
    """Checks of one table that ran, their counts, and the rules that did not run."""

    df: DataFrame
    specs: Sequence[RuleSpec]
    checks: list[Check] = field(default_factory=list)
    counts: dict[int, dict] = field(default_factory=dict)
    errors: dict[int, RuleError] = field(default_factory=dict)
    table_count: int = 0


def kind_of(check: Check) -> str:
    if isinstance(check, SqlCheck):
        return SQL_ROWS
    return NOT_NULL if check.counts_nulls else COLUMN


def raw_counts(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """One row of counts per rule.

    All rules of a group share one scan of their columns and one aggregate. Keyed and
    SQL checks must be prepared; of these only scope and missing rows are counted here.
    """
    return reduce(DataFrame.unionAll, [_grouped_counts(df, group) for group in _groups(checks, COUNTERS_PER_SCAN)])


def _groups(checks: Sequence[Check], size: int) -> list[list[Check]]:
    """Groups of checks; those of one column stay together, so few columns are read twice."""
    spread = sorted(checks, key=lambda check: str(check.spec.column))
    return [spread[i : i + size] for i in range(0, len(spread), size)]


def _count_where(predicate: Column) -> Column:
    # Half the time of count_if, which adds a projection of shared expressions.
    return F.count(F.when(predicate, 1))


def _grouped_counts(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    counters = [F.count(F.lit(1)).alias("table_count")]

    def counter(name: str, predicate: Column) -> str:
        counters.append(_count_where(predicate).alias(name))
        return name

    rows = []
    for check in checks:
        key = check.rule_key
        scope, missing = "table_count", "0L"
        if isinstance(check, SqlCheck):
            missing, bad = f"{check.missing_count}L", f"{check.row_count}L"
        else:
            if check.scope is not None:
                scope = counter(f"scope_{key}", check.scope)
            if check.missing is not None:
                missing = counter(f"missing_{key}", check.in_scope(check.missing))
            if isinstance(check, RowCheck):
                bad = counter(f"bad_{key}", check.failing())
            else:
                bad = f"{check.key_set.row_count}L"
        rows.append(f"{key}L, '{kind_of(check)}', {check.mostly!r}D, table_count, {scope}, {missing}, {bad}")
    # SQL text here and in row_key: each Column operation is a call into the JVM, and
    # with hundreds of rules these calls add up on the driver.
    names = ", ".join(field.split()[0] for field in RAW_COUNTS.split(","))
    return df.agg(*counters).selectExpr(f"stack({len(rows)}, {', '.join(rows)}) AS ({names})")


def measures(counts: DataFrame) -> DataFrame:
    """Success, counts and percentages of each rule, from its raw counts.

    Percentages are 0 to 100. For SQL checks the last two are pass rates, for the
    others exception rates; a rate without a base is 0.
    """
    sql, null_check = F.col("check_kind") == SQL_ROWS, F.col("check_kind") == NOT_NULL
    bad, missing, scope = F.col("bad_count"), F.col("missing_count"), F.col("scope_count")
    present = scope - missing
    table = F.greatest("table_count", F.lit(1))

    def percent(part: Column, whole: Column) -> Column:
        return F.when(whole > 0, part * 100.0 / whole).otherwise(0.0)

    share_sql, missing_sql = percent(bad, table), percent(missing, table)
    share = percent(bad, present)
    success = (present == 0) | ((present - bad) / F.greatest(present, F.lit(1)) >= F.col("mostly"))
    return counts.select(
        "rule_key",
        F.when(sql, bad == 0).otherwise(success).alias("success_flag"),
        F.when(sql, table).otherwise(scope).alias("element_count"),
        bad.alias("exception_count"),
        F.when(sql, share_sql).otherwise(share).alias("exception_percent"),
        F.when(sql, bad.cast("string")).otherwise("0").alias("observed_value"),
        F.when(null_check, bad).otherwise(missing).alias("missing_count"),
        F.when(sql, missing_sql)
        .when(null_check, share)
        .otherwise(percent(missing, scope))
        .alias("missing_percent"),
        F.when(sql, 100.0 - share_sql).otherwise(percent(bad, scope)).alias("exception_percent_total"),
        F.when(sql, 100.0 - missing_sql)
        .when(null_check, F.lit(0.0))
        .otherwise(share)
        .alias("exception_percent_nonmissing"),
    )


def exception_rows(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """One row per rule and failing row: rule, key and value (null when missing)."""
    row_checks = [c for c in checks if isinstance(c, RowCheck)]
    parts = [_row_exceptions(df, group) for group in _groups(row_checks, ROW_RULES_PER_SCAN)]
    fused = [c for c in checks if isinstance(c, KeyedCheck) and c.key_set.size_in_bytes <= broadcast_limit(df.sparkSession)]
    parts += [_keyed_exceptions(df, group) for group in _fitting(fused, broadcast_limit(df.sparkSession))]
    for check in checks:
        if isinstance(check, KeyedCheck) and check not in fused:
            parts.append(check.bad_rows(df).select(_key(check), "exception_row_pk", "exception_row_value"))
        elif isinstance(check, SqlCheck):
            parts.append(check.staged.select(_key(check), "exception_row_pk", "exception_row_value"))
    if not parts:
        return local_rows(df.sparkSession, [], EXCEPTION_ROWS)
    return reduce(DataFrame.unionAll, parts)


def _fitting(checks: Sequence[KeyedCheck], limit: int) -> list[list[KeyedCheck]]:
    """Groups of checks whose bad keys can be broadcast together."""
    groups, size = [], 0
    for check in checks:
        size += check.key_set.size_in_bytes
        if not groups or size > limit or len(groups[-1]) == KEYED_RULES_PER_SCAN:
            groups.append([])
            size = check.key_set.size_in_bytes
        groups[-1].append(check)
    return groups


def _keyed_exceptions(df: DataFrame, checks: Sequence[KeyedCheck]) -> DataFrame:
    """Failing rows of several keyed rules from one scan; their (unique) bad keys are broadcast and mark the rows."""
    rows, marks = df, []
    for i, check in enumerate(checks):
        names = [f"{RULE}_{i}_{j}" for j in range(len(check.keys))]
        mark = f"{RULE}_{i}"
        bad = check.key_set.keys.select(
            *[F.col(old).alias(new) for old, new in zip(check.key_set.key_names, names)], F.lit(True).alias(mark)
        )
        same = [key.eqNullSafe(F.col(n)) if check.null_safe else key == F.col(n) for key, n in zip(check.keys, names)]
        judged = check.in_scope(F.lit(True) if check.missing is None else ~check.missing)
        rows = rows.join(F.broadcast(bad), reduce(lambda a, b: a & b, [judged, *same]), "left").drop(*names)
        marks.append(F.when(F.col(mark), F.lit(check.rule_key).cast("long")))
    broken = rows.select("*", F.explode(F.array(*marks)).alias(RULE)).filter(F.col(RULE).isNotNull())
    return broken.select(
        F.col(RULE).alias("rule_key"),
        _by_rule({c.rule_key: (c.spec.key_columns, c.pk) for c in checks}).alias("exception_row_pk"),
        _by_rule({c.rule_key: (c.spec.column, c.value) for c in checks}).alias("exception_row_value"),
    )


def _key(check: Check) -> Column:
    return F.lit(check.rule_key).cast("long").alias("rule_key")


def _row_exceptions(df: DataFrame, checks: Sequence[RowCheck]) -> DataFrame:
    """Failing rows of many rules from one scan, filtered at the scan by their predicates.

    A row is repeated with the key of each rule it breaks; only then are its key and
    value made. All of this stays within generated code, which an array of structs
    or a filter over the array would leave.
    """
    predicates = [check.failing() for check in checks]
    failing = df.filter(reduce(lambda a, b: a | b, predicates))
    broken = F.array(*[F.when(p, F.lit(check.rule_key).cast("long")) for p, check in zip(predicates, checks)])
    rows = failing.select("*", F.explode(broken).alias(RULE)).filter(F.col(RULE).isNotNull())
    return rows.select(
        F.col(RULE).alias("rule_key"),
        _by_rule({c.rule_key: (c.spec.key_columns, c.pk) for c in checks}).alias("exception_row_pk"),
        _by_rule({c.rule_key: (c.spec.column, c.value) for c in checks}).alias("exception_row_value"),
    )


def _by_rule(choices: dict[int, tuple[object, Column]]) -> Column:
    """The column of the row's rule; rules that share a column share a branch."""
    shared: dict[object, tuple[list[int], Column]] = {}
    for rule_key, (name, column) in choices.items():
        shared.setdefault(name, ([], column))[0].append(rule_key)
    (_, result), *others = shared.values()
    for rule_keys, column in others:
        result = F.when(F.col(RULE).isin(*rule_keys), column).otherwise(result)
    return result


def check_table(
    df: DataFrame, specs: Sequence[RuleSpec], read_table: ReadTable, today: date, staging: Staging
) -> tuple[DataFrame, DataFrame]:
    """Measures per rule and exception rows of rules that are known to be sound."""
    plain, scoped = _by_scope(specs)
    counts, rows = [], []
    for part, some in [(df, plain), *((_rows_in_scope(df, condition, some, staging), some) for condition, some in scoped.items())]:
        if not some:
            continue
        checks = [build_check(spec if part is df else _unconditional(spec), part, read_table, today) for spec in some]
        _prepare(part, checks, staging, None)
        counted = raw_counts(part, checks)
        counts.append(counted if part is df else counted.withColumn("table_count", F.lit(df.count())))
        rows.append(exception_rows(part, [check for check in checks if check.stores_rows]))
    return measures(reduce(DataFrame.unionAll, counts)), reduce(DataFrame.unionAll, rows)


def _by_scope(specs: Sequence[RuleSpec]) -> tuple[list[RuleSpec], dict[str, list[RuleSpec]]]:
    """Rules to check on the table, and those on its rows in a scope that only a filter can tell: a condition with a subquery.

    A query of the rule's own filters its rows itself.
    """
    plain, scoped = [], {}
    for spec in specs:
        own = spec.check == "UnexpectedRowsExpectation" or not has_subquery(condition_of(spec))
        (plain if own else scoped.setdefault(condition_of(spec), [])).append(spec)
    return plain, scoped


def _rows_in_scope(df: DataFrame, condition: str, specs: Sequence[RuleSpec], staging: Staging) -> DataFrame:
    """The rows that a condition holds for, with the columns of some rules, staged: their counts and their rows are of the same ones."""
    wanted = {name for spec in specs for name in columns_named(spec, df)}
    rows = df.filter(F.expr(condition)).select(*[named(name) for name in df.columns if name in wanted])
    return staging.put(rows.hint("rebalance"), "scope")


def _unconditional(spec: RuleSpec) -> RuleSpec:
    return replace(spec, condition=None, arguments={k: v for k, v in spec.arguments.items() if k != "row_condition"})


def _prepare(df: DataFrame, checks: Sequence[Check], staging: Staging, failed: Callable[[Check, RuleError], None] | None) -> None:
    """Find bad keys and rows of queries. Uniqueness rules share a scan; without ``failed`` errors are raised."""
    keyed = [check for check in checks if isinstance(check, KeyedCheck) and check.packs]
    keyed = keyed if len(keyed) >= PACKED_RULES_FROM else []
    groups = [keyed[i : i + KEYED_RULES_PER_SCAN] for i in range(0, len(keyed), KEYED_RULES_PER_SCAN)]
    others = [[check] for check in checks if isinstance(check, (KeyedCheck, SqlCheck)) and check not in keyed]

    def work(some: list[Check]) -> None:
        if some[0] in keyed:
            prepare_repeated(df, some, staging)
        else:
            some[0].prepare(df, staging)

    def attempt(group: list[Check]) -> list[tuple[Check, RuleError]]:
        found = []
        if failed is None:
            work(group)
        else:
            isolate(work, group, lambda check, error: found.append((check, error)))
        return found

    for found in together(df.sparkSession, [partial(attempt, group) for group in [*groups, *others]]):
        for check, error in found:
            failed(check, error)


def evaluate_all(
    df: DataFrame, specs: Sequence[RuleSpec], read_table: ReadTable, today: date, staging: Staging
) -> list[Evaluation]:
    """Check one table: one evaluation of the whole table, and one for each scope that only a filter can tell."""
    plain, scoped = _by_scope(specs)
    whole = evaluate(df, plain, read_table, today, staging)
    if not plain:
        whole.table_count = df.count()
    results = [whole]
    for condition, some in scoped.items():
        try:
            rows = _rows_in_scope(df, condition, some, staging)
        except Exception as error:
            fault = as_rule_error(error)
            part = Evaluation(df, some, errors={spec.rule_key: fault for spec in some})
        else:
            part = evaluate(rows, [_unconditional(spec) for spec in some], read_table, today, staging)
        part.table_count = whole.table_count
        for row in part.counts.values():
            row["table_count"] = whole.table_count
        results.append(part)
    return results


def evaluate(
    df: DataFrame, specs: Sequence[RuleSpec], read_table: ReadTable, today: date, staging: Staging
) -> Evaluation:
    """Check one table. A rule that fails is reported and does not spoil the others."""
    result = Evaluation(df, specs)
    for spec in specs:
        try:
            result.checks.append(build_check(spec, df, read_table, today))
        except (TypeError, ValueError, AttributeError, LookupError, ArithmeticError) as error:
            # What a rule's arguments bring about while its check is built concerns this rule alone.
            result.errors[spec.rule_key] = RuleError("bad_arguments", f"{type(error).__name__}: {error}")
        except Exception as error:
            result.errors[spec.rule_key] = as_rule_error(error)

    def failed(check: Check, error: RuleError) -> None:
        result.checks.remove(check)
        result.errors[check.rule_key] = error

    _prepare(df, list(result.checks), staging, failed)

    def count(checks: list[Check]) -> None:
        for row in raw_counts(df, checks).collect():
            result.counts[row["rule_key"]] = row.asDict()
            result.table_count = row["table_count"]

    isolate(count, list(result.checks), failed)
    if result.errors and not result.counts:
        result.table_count = df.count()
    return result


def as_rule_error(error: Exception) -> RuleError:
    """The rule error behind an exception; other failures are raised again."""
    if isinstance(error, RuleError):
        return error
    message = rule_fault(error)
    if message is None:
        raise error
    return RuleError("analysis" if isinstance(error, AnalysisException) else "runtime", message)


def isolate(work: Callable[[list], None], checks: list, failed: Callable[[object, RuleError], None]) -> None:
    """Do fused work; when a rule breaks it, halve the rules until the broken ones stand alone."""
    if not checks:
        return
    try:
        work(checks)
    except Exception as error:
        fault = as_rule_error(error)
        if len(checks) == 1:
            failed(checks[0], fault)
            return
        middle = len(checks) // 2
        isolate(work, checks[:middle], failed)
        isolate(work, checks[middle:], failed)
