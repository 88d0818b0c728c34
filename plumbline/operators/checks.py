"""The check types: each turns a rule into Spark expressions, keys or a query.

A check sees the rows in its scope (the row condition). Of these some are missing
(they cannot be judged) and some are bad. A ``RowCheck`` tells bad rows by a
predicate on the row. A ``KeyedCheck`` tells them by membership of their key in a
derived set of bad keys. A ``SqlCheck`` takes the rows of a query.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass
from datetime import date
from decimal import Decimal, InvalidOperation
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.functions.expressions import named, row_key
from plumbline.operators.probe import KeySet, broadcast_limit, hashable, measured_sets, probe, stage_keys
from plumbline.spec import RuleError, RuleSpec
from plumbline.sources.staging import Staging

ReadTable = Callable[[str], DataFrame]

@dataclass
class Check:
    """Common part of all checks. ``value`` is null-valued when the rule's column is absent."""

    spec: RuleSpec
    scope: Column | None
    missing: Column | None
    value: Column
    counts_nulls: bool = False

    @property
    def rule_key(self) -> int:
        return self.spec.rule_key

    @property
    def mostly(self) -> float:
        return float(self.spec.arguments.get("mostly", 1.0))

    @property
    def stores_rows(self) -> bool:
        """Only the null check can be told to count without keeping rows."""
        return bool(self.spec.arguments.get("store_exceptions", True)) if self.counts_nulls else True

    @property
    def pk(self) -> Column:
        return row_key(self.spec.key_columns)

    def in_scope(self, predicate: Column) -> Column:
        return predicate if self.scope is None else self.scope & predicate


@dataclass
class RowCheck(Check):
    bad: Column = None

    def failing(self) -> Column:
        """Plain predicate of the bad rows, in a form that scans can push down."""
        return self.in_scope(self.bad)


@dataclass
class KeyedCheck(Check):
    keys: list[Column] = None
    find_bad_keys: Callable[[DataFrame, Staging | None], DataFrame] = None
    null_safe: bool = False
    key_set: KeySet | None = None
    columns: list[Column] = None
    kinds: list[T.DataType] = None

    @property
    def packs(self) -> bool:
        """Whether the check's repeated keys can be found together with those of other checks."""
        return self.columns is not None and all(_has_bytes(kind) for kind in self.kinds)

    def packed(self) -> Column:
        return packed_key(self.columns, self.kinds)

    def judges(self) -> Column:
        """Whether the check looks at a row."""
        return self.in_scope(F.lit(True) if self.missing is None else ~self.missing)

    def judged(self, df: DataFrame) -> DataFrame:
        return df.filter(self.judges())

    def prepare(self, df: DataFrame, staging: Staging) -> None:
        if self.key_set is None:
            self.key_set = stage_keys(self.find_bad_keys(self.judged(df), staging), staging, "bad-keys")

    def bad_rows(self, df: DataFrame) -> DataFrame:
        narrow = self.judged(df).select(
            self.pk.alias("exception_row_pk"),
            self.value.alias("exception_row_value"),
            *[key.alias(f"_key{i}") for i, key in enumerate(self.keys)],
        )
        names = [f"_key{i}" for i in range(len(self.keys))]
        return probe(narrow, [F.col(n) for n in names], self.key_set, "left_semi", self.null_safe).drop(*names)


# Longer texts take part in comparisons by their digest.
WIDE_KEY_BYTES = 64


def compact(key: Column, kind: T.DataType) -> Column:
    """A key that is equal for equal values only, and short: a long text is its SHA-256 digest.

    Whole texts would make the shuffle as large as the column. Each value decides for
    itself, so nothing depends on other rows. Only texts that are compared byte by byte have a digest;
    others (of another collation), and values of fixed width, stay as they are.
    """
    if not (isinstance(kind, T.BinaryType) or (isinstance(kind, T.StringType) and hashable(kind))):
        return key
    data = key.cast("binary")
    digest = F.concat(F.lit(b"\x01"), F.unhex(F.sha2(data, 256)))
    return F.when(F.octet_length(data) <= WIDE_KEY_BYTES, F.concat(F.lit(b"\x00"), data)).otherwise(digest)


def keyless(kind: T.DataType) -> bool:
    """Whether a type has no equality of its own: maps and variants, and what holds them."""
    if isinstance(kind, T.ArrayType):
        return keyless(kind.elementType)
    if isinstance(kind, T.StructType):
        return any(keyless(field.dataType) for field in kind.fields)
    return isinstance(kind, (T.MapType, T.VariantType))


def canonical(value: Column, kind: T.DataType) -> Column:
    """A value with equality for one without: a map is its entries in the order of their keys, a variant its text."""
    if not keyless(kind):
        return value
    if isinstance(kind, T.VariantType):
        return F.to_json(value)
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda x: canonical(x, kind.elementType))
    if isinstance(kind, T.MapType):
        # Keys are unique, so their order is that of the entries.
        entry = lambda x: F.struct(x["key"].alias("key"), canonical(x["value"], kind.valueType).alias("value"))
        return F.transform(F.array_sort(F.map_keys(value)), lambda k: entry(F.struct(k.alias("key"), F.get(F.map_values(value), F.array_position(F.map_keys(value), k).cast("int") - 1).alias("value"))))
    fields = [canonical(value.getField(f.name), f.dataType).alias(f.name) for f in kind.fields]
    return F.when(value.isNotNull(), F.struct(*fields))


def _has_bytes(kind: T.DataType) -> bool:
    """Whether a type's equality is that of some bytes."""
    return isinstance(kind, (T.NumericType, T.BooleanType, T.DatetimeType, T.BinaryType)) or (isinstance(kind, T.StringType) and hashable(kind))


def _bytes_of(value: Column, kind: T.DataType) -> Column:
    """Bytes that are the same for equal values only."""
    if isinstance(kind, (T.BinaryType, T.StringType)):
        return value.cast("binary")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(value).cast("string").cast("binary")  # as text, an hour of autumn comes twice
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return F.when(value == 0, F.lit(0.0).cast(kind)).otherwise(value).cast("string").cast("binary")  # 0.0 equals -0.0
    return value.cast("string").cast("binary")


def packed_key(columns: list[Column], kinds: list[T.DataType]) -> Column:
    """Key columns as one short binary value, equal for equal keys only (nulls are equal)."""
    parts = []
    for column, kind in zip(columns, kinds):
        data = _bytes_of(column, kind)
        size = F.lpad(F.octet_length(data).cast("string"), 10, "0").cast("binary")
        parts.append(F.coalesce(F.concat(size, data), F.lit(b"-")))
    return compact(F.concat(*parts), T.BinaryType())


def repeated(rows: DataFrame, keys: list[Column]) -> DataFrame:
    """Keys that occur more than once. Counts combine map-side, so a hot key is cheap."""
    counted = rows.groupBy(*[key.alias(f"_k{i}") for i, key in enumerate(keys)]).agg(F.count(F.lit(1)).alias("n"))
    return counted.filter(F.col("n") > 1)


# Spark groups by sets of at most 64 columns.
GROUPED_COLUMNS = 64


def repeated_of_all(df: DataFrame, checks: list[KeyedCheck]) -> DataFrame:
    """Repeated keys of several uniqueness rules, from one scan: ``rule`` (the check's place), ``n``, and ``_k<place>_<i>`` for the keys of each.

    A row goes into the aggregation once for each rule, with that rule's keys in their own types. Keys of rows that a rule does not
    judge are null there; where null is also a key, a flag tells them apart.
    """
    columns, sets, kept = [], [], F.lit(False)
    for i, check in enumerate(checks):
        names = key_names(i, check)
        columns += [F.when(check.judges(), key).alias(name) for key, name in zip(check.keys, names)]
        judged = F.col(names[0]).isNotNull()
        if check.null_safe:
            names, judged = [*names, f"_judged{i}"], F.col(f"_judged{i}").isNotNull()
            columns.append(F.when(check.judges(), F.lit(True)).alias(names[-1]))
        sets.append(names)
        kept |= (F.col("rule") == i) & judged
    names = [name for some in sets for name in some]
    # A bit for each column that a set lacks, the first column's highest.
    left_out = [sum(1 << (len(names) - 1 - k) for k, name in enumerate(names) if name not in some) for some in sets]
    place = F.coalesce(*[F.when(F.grouping_id() == bits, F.lit(i)) for i, bits in enumerate(left_out)])
    counted = df.select(*columns).groupingSets(sets, *names).agg(place.alias("rule"), F.count(F.lit(1)).alias("n"))
    return counted.filter((F.col("n") > 1) & kept)


def key_names(place: int, check: KeyedCheck) -> list[str]:
    return [f"_k{place}_{j}" for j in range(len(check.keys))]


def prepare_repeated(df: DataFrame, checks: list[KeyedCheck], staging: Staging) -> None:
    """Prepare uniqueness rules together. Keys of several columns are packed only where there are too many columns to group by."""
    if len(checks) == 1:
        checks[0].prepare(df, staging)
        return
    if sum(len(check.keys) + check.null_safe for check in checks) > GROUPED_COLUMNS:
        for check in checks:
            if len(check.keys) > 1:
                check.keys, check.null_safe = [check.packed()], False
    staged = staging.put(repeated_of_all(df, checks), "bad-keys")
    names = [key_names(i, check) for i, check in enumerate(checks)]
    for check, keys in zip(checks, measured_sets(staged, "rule", names)):
        check.key_set = keys


@dataclass
class SqlCheck(Check):
    query: str = ""
    staged: DataFrame | None = None
    row_count: int = 0
    missing_count: int = 0

    def rows(self, df: DataFrame) -> DataFrame:
        """Key and value of every row the query returns for the rows in scope."""
        view = f"batch_{uuid.uuid4().hex}"
        query = self.query.replace("{batch}", view).strip().rstrip(";")
        # Alone first: a text that is no query by itself must not become one inside the parentheses below.
        df.sparkSession._jsparkSession.sessionState().sqlParser().parsePlan(query)
        scoped = df if self.scope is None else df.filter(self.scope)
        scoped.createOrReplaceTempView(view)
        try:
            # As a subquery, so that a command is refused when it is parsed, before it has any effect.
            result = df.sparkSession.sql(f"SELECT * FROM (\n{query}\n)")
        finally:
            df.sparkSession.catalog.dropTempView(view)
        return result.select(
            self.pk.alias("exception_row_pk"),
            _value_column(self.spec, result).alias("exception_row_value"),
        )

    def prepare(self, df: DataFrame, staging: Staging) -> None:
        # The query may be costly, so it runs once: counts and rows come from its result.
        if self.staged is None:
            self.staged = staging.put(self.rows(df).hint("rebalance"), "sql-rows")
            self.row_count, self.missing_count = self.staged.agg(
                F.count(F.lit(1)), F.count_if(F.col("exception_row_value").isNull())
            ).first()


def has_column(df: DataFrame, name: str) -> bool:
    """Whether a table has a column of that name, by the session's rule for upper and lower case."""
    if name in df.columns:
        return True
    sensitive = df.sparkSession.conf.get("spark.sql.caseSensitive").lower() == "true"
    return not sensitive and name.lower() in map(str.lower, df.columns)


def _value_column(spec: RuleSpec, df: DataFrame) -> Column:
    if spec.column and has_column(df, spec.column):
        return named(spec.column).cast("string")
    return F.lit(None).cast("string")


def fitting_member(given: T.DataType, kind: T.DataType) -> Column:
    """A member ``_k0`` of a value set in the type of the checked column; null when it has no equal there.

    1.7 is no member for whole numbers, nor a time of day for dates: a cast that loses something is undone and
    compared. Texts are parsed, and numbers become floating point, as in a list of values.
    """
    member = F.col("_k0").try_cast(kind)
    if given == kind or isinstance(given, T.StringType) or isinstance(kind, (T.StringType, T.FloatType, T.DoubleType)):
        return member.alias("_k0")
    return F.when(member.try_cast(given) == F.col("_k0"), member).alias("_k0")


def fits(value, kind: T.DataType) -> bool:
    """Whether a number can equal one of a whole-number type; anything else is left to its literal."""
    if not isinstance(kind, T.IntegralType) or isinstance(value, bool):
        return True
    try:
        number = Decimal(str(value))
    except InvalidOperation:
        return True
    return number.is_finite() and number == number.to_integral_value() and -(2**63) <= number < 2**63


# The beginning of a subquery, once quoted texts are taken out of a condition.
_QUOTED = re.compile(r"'(?:[^'\\]|\\.|'')*'|\"(?:[^\"\\]|\\.)*\"|`[^`]*`")
_SUBQUERY = re.compile(r"\(\s*(?:select|with|from|values|table)\b", re.IGNORECASE)


def condition_of(spec: RuleSpec) -> str:
    """The rule's row condition; empty without one."""
    condition = spec.condition or spec.arguments.get("row_condition") or ""
    return condition.strip() if isinstance(condition, str) else ""


def has_subquery(condition: str) -> bool:
    return bool(_SUBQUERY.search(_QUOTED.sub("''", condition)))


def columns_named(spec: RuleSpec, df: DataFrame) -> list[str]:
    """The table's columns that a rule without a condition can look at."""
    def texts(value) -> Iterable[str]:
        return [value] if isinstance(value, str) else [v for v in value if isinstance(v, str)] if isinstance(value, list) else []

    wanted = {*spec.key_columns, spec.column or "", *(name for value in spec.arguments.values() for name in texts(value))}
    lowered = {name.lower() for name in wanted}
    return [name for name in df.columns if name.lower() in lowered]


class _Builder:
    """Reads the arguments of one rule against the table it checks."""

    def __init__(self, spec: RuleSpec, df: DataFrame, read_table: ReadTable, today: date):
        self.spec, self.df, self.read_table, self.today = spec, df, read_table, today
        condition = (spec.condition or self.argument("row_condition", str, "")).strip()
        self.scope = F.expr(condition) if condition else None

    # -- arguments ---------------------------------------------------------

    def argument(self, name: str, kinds: type | tuple, default=...):
        value = self.spec.arguments.get(name)
        if value is None:
            if default is ...:
                raise RuleError("bad_arguments", f"argument {name} is missing")
            return default
        if not isinstance(value, kinds):
            raise RuleError("bad_arguments", f"argument {name} has an unsuitable value: {value!r}")
        return value

    def texts(self, name: str) -> list[str]:
        values = self.argument(name, list)
        if not all(isinstance(value, str) for value in values):
            raise RuleError("bad_arguments", f"argument {name} holds other values than texts: {values!r}")
        return values

    def column_name(self, argument: str = "column", default: str | None = None) -> str:
        name = self.argument(argument, str, default)
        if not name:
            raise RuleError("bad_arguments", f"argument {argument} is missing")
        self.require(name)
        return name

    def require(self, name: str) -> None:
        if not has_column(self.df, name):
            raise RuleError("unknown_column", f"no column {name} in {self.spec.asset}")

    def type_of(self, name: str) -> T.DataType:
        kinds = {field.name: field.dataType for field in self.df.schema.fields}
        if name not in kinds:
            kinds = {other.lower(): kind for other, kind in kinds.items()}
        return kinds[name if name in kinds else name.lower()]

    def domain(self) -> str:
        return self.column_name(default=self.spec.column)

    def literal(self, value, kind: T.DataType) -> Column:
        """``value`` as a literal that compares with ``kind`` without casting the column."""
        if value == "today" and isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            return F.lit(self.today).cast(kind)
        if isinstance(kind, T.NumericType) and not isinstance(value, bool):
            try:
                number = Decimal(str(value))
                exact = float(number)
            except (InvalidOperation, ValueError) as error:
                raise RuleError("bad_arguments", f"{value!r} is not a number") from error
            if isinstance(kind, (T.FloatType, T.DoubleType)):
                return F.lit(exact).cast(kind)
            if not number.is_finite():
                raise RuleError("bad_arguments", f"{value!r} is not a finite number")
            if isinstance(kind, T.DecimalType):
                # Beyond the digits of a decimal all of them compare alike with a double.
                return F.lit(number if max(number.adjusted() + 1, 0) - min(number.as_tuple().exponent, 0) <= 38 else exact)
            return F.lit(int(number) if number == number.to_integral_value() and abs(number) < 2**63 else float(number))
        if isinstance(value, bool) and isinstance(kind, T.BooleanType):
            return F.lit(value)
        if isinstance(value, (list, dict)):
            raise RuleError("bad_arguments", f"{value!r} is not a single value")
        return F.lit(str(value)).cast(kind)

    # -- shapes ------------------------------------------------------------

    def row_check(self, missing: Column | None, bad: Column, **extra) -> RowCheck:
        value = _value_column(self.spec, self.df)
        return RowCheck(spec=self.spec, scope=self.scope, missing=missing, value=value, bad=bad, **extra)

    def column_check(self, bad_value: Callable[[Column], Column]) -> RowCheck:
        x = named(self.domain())
        return self.row_check(x.isNull(), bad_value(x))

    def unique_check(self, missing: Column | None, names: list[str], null_safe: bool = False) -> KeyedCheck:
        """Bad keys are those that occur more than once."""
        kinds = [self.type_of(name) for name in names]
        keys = [compact(canonical(named(name), kind), kind) for name, kind in zip(names, kinds)]
        return KeyedCheck(
            spec=self.spec,
            scope=self.scope,
            missing=missing,
            value=_value_column(self.spec, self.df),
            keys=keys,
            find_bad_keys=lambda judged, _: repeated(judged, keys),
            null_safe=null_safe,
            columns=[named(name) for name in names],
            kinds=kinds,
        )

    # -- checks ------------------------------------------------------------

    def not_null(self) -> RowCheck:
        x = named(self.domain())
        return self.row_check(None, x.isNull(), counts_nulls=True)

    def sql_rows(self) -> SqlCheck:
        return SqlCheck(
            spec=self.spec,
            scope=self.scope,
            missing=None,
            value=F.lit(None),
            query=self.argument("unexpected_rows_query", str),
        )

    def regex(self) -> RowCheck:
        pattern = self.argument("regex", str)
        return self.column_check(lambda x: ~x.cast("string").rlike(pattern))

    def not_regex(self) -> RowCheck:
        pattern = self.argument("regex", str)
        return self.column_check(lambda x: x.cast("string").rlike(pattern))

    def regex_list(self) -> RowCheck:
        patterns = self.texts("regex_list")
        match_on = self.argument("match_on", str, "any")
        if not patterns or match_on not in ("any", "all"):
            raise RuleError("bad_arguments", "regex_list needs patterns, and match_on is any or all")
        combine = (lambda a, b: a | b) if match_on == "any" else (lambda a, b: a & b)
        return self.column_check(lambda x: ~reduce(combine, [x.cast("string").rlike(p) for p in patterns]))

    def like(self) -> RowCheck:
        pattern = self.argument("like_pattern", str)
        return self.column_check(lambda x: ~x.cast("string").like(pattern))

    def between(self) -> RowCheck:
        kind = self.type_of(self.domain())
        low, high = self.spec.arguments.get("min_value"), self.spec.arguments.get("max_value")
        if low is None and high is None:
            raise RuleError("bad_arguments", "one of min_value and max_value is needed")

        def outside(x: Column) -> Column:
            limits = []
            if low is not None:
                bound = self.literal(low, kind)
                limits.append(x <= bound if self.argument("strict_min", bool, False) else x < bound)
            if high is not None:
                bound = self.literal(high, kind)
                limits.append(x >= bound if self.argument("strict_max", bool, False) else x > bound)
            return reduce(lambda a, b: a | b, limits)

        return self.column_check(outside)

    def pair_greater(self) -> RowCheck:
        a, b = named(self.column_name("column_A")), named(self.column_name("column_B"))
        ignore = self.argument("ignore_row_if", str, "both_values_are_missing")
        skips = {
            "both_values_are_missing": a.isNull() & b.isNull(),
            "either_value_is_missing": a.isNull() | b.isNull(),
            "neither": None,
        }
        if ignore not in skips:
            raise RuleError("bad_arguments", f"unknown ignore_row_if: {ignore}")
        holds = a >= b if self.argument("or_equal", bool, False) else a > b
        skipped = skips[ignore]
        # A comparison with one null is not a proof of order, so such a row is bad.
        bad = ~F.coalesce(holds, F.lit(False))
        return self.row_check(skipped, bad if skipped is None else ~skipped & bad)

    def in_set(self, negated: bool = False) -> Check:
        values = self.argument("value_set", (list, str))
        if isinstance(values, str):
            return self.in_table(values, negated)
        kind = self.type_of(self.domain())
        members = [self.literal(v, kind) for v in values if v is not None and fits(v, kind)]
        if not members:
            # Membership of an empty set is false even for nulls.
            return self.column_check(lambda x: F.lit(False) if negated else x.isNotNull())
        return self.column_check(lambda x: x.isin(*members) if negated else ~x.isin(*members))

    def in_table(self, reference: str, negated: bool) -> KeyedCheck:
        table, _, member = reference.rpartition(".")
        if not table or not member:
            raise RuleError("bad_arguments", f"value_set is neither a list nor table.column: {reference}")
        domain = self.domain()
        kind, x = self.type_of(domain), named(domain)
        try:
            members = self.read_table(table).select(named(member).alias("_k0"))
            members = members.select(fitting_member(members.schema["_k0"].dataType, kind)).dropna().distinct()
        except AnalysisException as error:
            raise RuleError("bad_value_set", str(error)) from error
        how = "left_semi" if negated else "left_anti"

        def find_bad_keys(judged: DataFrame, staging: Staging | None) -> DataFrame:
            values = judged.select(x.alias("_k0"))
            counted = [F.count(F.lit(1)).alias("n")]
            if staging is not None:
                # One copy of a reference table for all rules of the run.
                measured = staging.once(
                    ("members", reference, kind.json()),
                    lambda: stage_keys(members.withColumn("n", F.lit(1)), staging, "members"),
                )
                known = measured.keys.select("_k0")
                if measured.size_in_bytes <= broadcast_limit(judged.sparkSession):
                    # Only the bad values are left to be shuffled.
                    return values.join(F.broadcast(known), "_k0", how).groupBy("_k0").agg(*counted)
            else:
                known = members
            # Grouping first makes the values unique, so no hot value reaches the join.
            return values.groupBy("_k0").agg(*counted).join(known, "_k0", how)

        return KeyedCheck(
            spec=self.spec,
            scope=self.scope,
            missing=x.isNull(),
            value=_value_column(self.spec, self.df),
            keys=[x],
            find_bad_keys=find_bad_keys,
        )

    def unique(self) -> KeyedCheck:
        name = self.domain()
        return self.unique_check(named(name).isNull(), [name])

    def compound_unique(self) -> KeyedCheck:
        names = self.texts("column_list")
        for name in names:
            self.require(name)
        if len(names) < 2:
            raise RuleError("bad_arguments", "column_list needs two or more columns")
        columns = [named(name) for name in names]
        ignore = self.argument("ignore_row_if", str, "all_values_are_missing")
        skips = {
            "all_values_are_missing": reduce(lambda a, b: a & b, [c.isNull() for c in columns]),
            "any_value_is_missing": reduce(lambda a, b: a | b, [c.isNull() for c in columns]),
            "never": None,
        }
        if ignore not in skips:
            raise RuleError("bad_arguments", f"unknown ignore_row_if: {ignore}")
        return self.unique_check(skips[ignore], names, null_safe=ignore != "any_value_is_missing")


# The check names that rules may use.
CHECKS: dict[str, Callable[[_Builder], Check]] = {
    "ExpectColumnValuesToNotBeNull": _Builder.not_null,
    "UnexpectedRowsExpectation": _Builder.sql_rows,
    "ExpectColumnValuesToMatchRegex": _Builder.regex,
    "ExpectColumnValuesToNotMatchRegex": _Builder.not_regex,
    "ExpectColumnValuesToMatchLikePattern": _Builder.like,
    "ExpectColumnValuesToBeBetween": _Builder.between,
    "ExpectColumnPairValuesAToBeGreaterThanB": _Builder.pair_greater,
    "ExpectColumnValuesToBeInSet": _Builder.in_set,
    "ExpectColumnValuesToNotBeInSet": lambda builder: builder.in_set(negated=True),
    "ExpectColumnValuesToBeUnique": _Builder.unique,
    "ExpectCompoundColumnsToBeUnique": _Builder.compound_unique,
    "ExpectColumnValuesToMatchRegexList": _Builder.regex_list,
}


def build_check(spec: RuleSpec, df: DataFrame, read_table: ReadTable, today: date) -> Check:
    """The check of a rule, analysed on its own so that it cannot spoil others."""
    if spec.check not in CHECKS:
        raise RuleError("unknown_check", f"no such check: {spec.check}")
    if not spec.key_columns:
        raise RuleError("bad_key", "the rule names no key columns")
    mostly = spec.arguments.get("mostly", 1.0)
    if isinstance(mostly, bool) or not isinstance(mostly, (int, float)) or not 0 <= mostly <= 1:
        raise RuleError("bad_arguments", f"mostly is not a share between 0 and 1: {mostly!r}")
    check = CHECKS[spec.check](_Builder(spec, df, read_table, today))
    if isinstance(check, SqlCheck):
        check.rows(df)
    else:
        unknown = [name for name in spec.key_columns if not has_column(df, name)]
        if unknown:
            raise RuleError("bad_key", f"no key columns {unknown} in {spec.asset}")
        predicates = [p for p in (check.scope, check.missing, getattr(check, "bad", None)) if p is not None]
        df.filter(reduce(lambda a, b: a & b, predicates, F.lit(True))).select(check.pk, check.value)
        if isinstance(check, KeyedCheck):
            check.find_bad_keys(check.judged(df), None)
    return check
