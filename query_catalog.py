"""Every operator as a query over the given tables, with its equivalent in SQL.

Rules, rule sources and ledgers that the tables do not hold are derived from them
with Spark, so the work of each query grows with its tables.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace
from datetime import date, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.operators import ledger as L
from plumbline.operators.align import align_to_schema
from plumbline.operators.checks import build_check
from plumbline.operators.evaluate import check_table, raw_counts
from plumbline.operators.numbering import number_rows
from plumbline.operators.upsert import COALESCE, OVERWRITE, upserted
from plumbline.plans import rulebook as R
from plumbline.spec import RuleSpec
from plumbline.plans.run import RunResult, run_rules
from plumbline.plans.workflow import run_stored_rules, run_workflow
from plumbline.schemas import DQ_RULE, DQ_RULE_TYPE
from plumbline.sources import catalog
from plumbline.sources.staging import Staging
from plumbline.sources.store import Store

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

TODAY = date(2001, 1, 1)
FIRST_RUN, SECOND_RUN = "2001-01-01 06:00:00", "2001-01-02 06:00:00"


def query(name: str, sql: str):
    """Register a query together with the SQL that must give the same rows."""

    def register(function: Query) -> Query:
        QUERIES[name] = function
        ORACLES[name] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rule(check: str, arguments: dict, keys: str, column: str | None, rule_key: int = 1, **more) -> RuleSpec:
    return RuleSpec(rule_key, check, arguments, tuple(keys.split(",")), column, **more)


def failing(df: DataFrame, specs: list[RuleSpec], lookups: dict[str, DataFrame] | None = None) -> DataFrame:
    """Exception rows as they are shown: rule, key and value."""
    _, rows = check_table(df, specs, (lookups or {}).__getitem__, TODAY, Staging(df.sparkSession))
    return rows.withColumn("exception_row_value", F.coalesce("exception_row_value", F.lit("None")))


def measured(df: DataFrame, specs: list[RuleSpec], lookups: dict[str, DataFrame] | None = None) -> DataFrame:
    rows, _ = check_table(df, specs, (lookups or {}).__getitem__, TODAY, Staging(df.sparkSession))
    return rounded(rows)


def rounded(rows: DataFrame) -> DataFrame:
    percents = [name for name in rows.columns if "percent" in name]
    return rows.withColumns({name: F.round(F.col(name).cast("double"), 4) for name in percents})


def labelled_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")


def shipped_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey)


# -- checks -----------------------------------------------------------------


def check_query(name: str, source: str | Query, spec: RuleSpec, key: str, value: str, relation: str, where: str):
    """Register the exception rows of one rule."""
    sql = f"""
        SELECT CAST({spec.rule_key} AS BIGINT) AS rule_key, {key} AS exception_row_pk,
               COALESCE(CAST({value} AS VARCHAR), 'None') AS exception_row_value
        FROM {relation} WHERE {where}"""

    @query(name, sql)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = source(spark, sf_dir) if callable(source) else table(spark, sf_dir, source)
        return failing(df, [spec])


def text(column: str) -> str:
    return f"CAST({column} AS VARCHAR)"


LINE_KEY = "CAST(l_orderkey AS VARCHAR) || '_' || CAST(l_linenumber AS VARCHAR)"
LINE_KEYS = "l_orderkey,l_linenumber"
DOCUMENTS_LABELS = "documents LEFT JOIN labels USING (doc_id)"

check_query(
    "chk_not_null",
    labelled_documents,
    rule("ExpectColumnValuesToNotBeNull", {"column": "quality"}, "doc_id", "quality"),
    text("doc_id"), "quality", DOCUMENTS_LABELS, "quality IS NULL",
)
check_query(
    "chk_between",
    "part",
    rule("ExpectColumnValuesToBeBetween", {"column": "p_size", "min_value": 5, "max_value": 45}, "p_partkey", "p_size"),
    text("p_partkey"), "p_size", "part", "p_size NOT BETWEEN 5 AND 45",
)
check_query(
    "chk_between_strict",
    "lineitem",
    rule(
        "ExpectColumnValuesToBeBetween",
        {"column": "l_discount", "min_value": 0, "max_value": 0.1, "strict_min": True, "strict_max": True},
        LINE_KEYS, "l_discount",
    ),
    LINE_KEY, "l_discount", "lineitem", "l_discount <= 0 OR l_discount >= 0.1::DOUBLE",
)
check_query(
    "chk_between_today",
    "orders",
    rule("ExpectColumnValuesToBeBetween", {"column": "o_orderdate", "max_value": "today"}, "o_orderkey", "o_orderstatus"),
    text("o_orderkey"), "o_orderstatus", "orders", "o_orderdate > DATE '2001-01-01'",
)
check_query(
    "chk_regex",
    "pages",
    rule("ExpectColumnValuesToMatchRegex", {"column": "url", "regex": r"^https?://[a-z]+\."}, "page_id", "url"),
    text("page_id"), "url", "pages", r"NOT regexp_matches(url, '^https?://[a-z]+\.')",
)
check_query(
    "chk_not_regex",
    "pages",
    rule("ExpectColumnValuesToNotMatchRegex", {"column": "url", "regex": "#"}, "page_id", "url"),
    text("page_id"), "url", "pages", "regexp_matches(url, '#')",
)
for _match_on, _join in (("any", "OR"), ("all", "AND")):
    check_query(
        f"chk_regex_list_{_match_on}",
        "documents",
        rule(
            "ExpectColumnValuesToMatchRegexList",
            {"column": "source", "regex_list": ["^src[0-9]$", "^src1[0-5]$"], "match_on": _match_on},
            "doc_id", "source",
        ),
        text("doc_id"), "source", "documents",
        f"NOT (regexp_matches(source, '^src[0-9]$') {_join} regexp_matches(source, '^src1[0-5]$'))",
    )
check_query(
    "chk_like",
    "pages",
    rule("ExpectColumnValuesToMatchLikePattern", {"column": "url", "like_pattern": "https://%"}, "page_id", "url"),
    text("page_id"), "url", "pages", "url NOT LIKE 'https://%'",
)
for _name, _or_equal, _operator in (("chk_pair_gt", False, "<="), ("chk_pair_ge", True, "<")):
    check_query(
        _name,
        shipped_orders,
        rule(
            "ExpectColumnPairValuesAToBeGreaterThanB",
            {"column_A": "l_shipdate", "column_B": "o_orderdate", "or_equal": _or_equal},
            LINE_KEYS, "l_shipdate",
        ),
        LINE_KEY, "l_shipdate", "lineitem JOIN orders ON l_orderkey = o_orderkey",
        f"l_shipdate {_operator} o_orderdate",
    )
for _name, _ignore, _where in (
    ("chk_pair_one_null", "both_values_are_missing",
     "NOT (quality IS NULL AND toxic IS NULL) AND NOT COALESCE(toxic > quality, FALSE)"),
    ("chk_pair_skip_nulls", "either_value_is_missing", "quality IS NOT NULL AND toxic IS NOT NULL AND toxic <= quality"),
    ("chk_pair_keep_nulls", "neither", "NOT COALESCE(toxic > quality, FALSE)"),
):
    check_query(
        _name,
        # The toxic flags of other languages are blanked, so that rows with one, two and no nulls occur.
        lambda spark, sf_dir: labelled_documents(spark, sf_dir).withColumn("toxic", F.expr("IF(lang = 'en', toxic, NULL)")),
        rule(
            "ExpectColumnPairValuesAToBeGreaterThanB",
            {"column_A": "toxic", "column_B": "quality", "ignore_row_if": _ignore},
            "doc_id", "toxic",
        ),
        text("doc_id"), "toxic",
        f"(SELECT doc_id, quality, CASE WHEN lang = 'en' THEN toxic END AS toxic FROM {DOCUMENTS_LABELS})",
        _where,
    )
check_query(
    "chk_in_set",
    "customer",
    rule(
        "ExpectColumnValuesToBeInSet", {"column": "c_mktsegment", "value_set": ["BUILDING", "MACHINERY", None]},
        "c_custkey", "c_mktsegment",
    ),
    text("c_custkey"), "c_mktsegment", "customer", "c_mktsegment NOT IN ('BUILDING', 'MACHINERY')",
)
check_query(
    "chk_not_in_set",
    "orders",
    rule(
        "ExpectColumnValuesToNotBeInSet", {"column": "o_orderpriority", "value_set": ["5-LOW"]},
        "o_orderkey", "o_orderpriority",
    ),
    text("o_orderkey"), "o_orderpriority", "orders", "o_orderpriority IN ('5-LOW')",
)
check_query(
    "chk_row_condition",
    "customer",
    rule(
        "ExpectColumnValuesToBeInSet", {"column": "c_mktsegment", "value_set": ["BUILDING", "MACHINERY"]},
        "c_custkey", "c_mktsegment", condition="c_nationkey < 10",
    ),
    text("c_custkey"), "c_mktsegment", "customer",
    "c_nationkey < 10 AND c_mktsegment NOT IN ('BUILDING', 'MACHINERY')",
)
check_query(
    "chk_unique",
    "documents",
    rule("ExpectColumnValuesToBeUnique", {"column": "text"}, "doc_id", "source"),
    text("doc_id"), "source", "(SELECT *, count(*) OVER (PARTITION BY text) AS n FROM documents)", "n > 1",
)
LETTERS = "'abcdefghijklmnopqrstuvwxyz', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ'"
check_query(
    "chk_unique_collated",
    # Whole texts, every other one spelled in capitals, of a collation that takes no notice.
    lambda spark, sf_dir: table(spark, sf_dir, "documents").withColumn(
        "text", F.expr(f"collate(IF(doc_id % 2 = 0, translate(text, {LETTERS}), text), 'UTF8_LCASE')")
    ),
    rule("ExpectColumnValuesToBeUnique", {"column": "text"}, "doc_id", "source"),
    text("doc_id"), "source", "(SELECT *, count(*) OVER (PARTITION BY lower(text)) AS n FROM documents)", "n > 1",
)
check_query(
    "chk_between_float",
    lambda spark, sf_dir: table(spark, sf_dir, "lineitem").withColumn("l_discount", F.col("l_discount").cast("float")),
    rule("ExpectColumnValuesToBeBetween", {"column": "l_discount", "min_value": 0.03, "max_value": 0.1}, LINE_KEYS, "l_returnflag"),
    LINE_KEY, "l_returnflag", "lineitem", "l_discount::FLOAT < 0.03::FLOAT OR l_discount::FLOAT > 0.1::FLOAT",
)
check_query(
    "chk_unique_scoped",
    "customer",
    rule("ExpectColumnValuesToBeUnique", {"column": "c_acctbal"}, "c_custkey", "c_acctbal", condition="c_acctbal > 0"),
    text("c_custkey"), "c_acctbal",
    "(SELECT *, count(*) OVER (PARTITION BY c_acctbal) AS n FROM customer WHERE c_acctbal > 0)", "n > 1",
)
check_query(
    "chk_compound_unique",
    "lineitem",
    rule(
        "ExpectCompoundColumnsToBeUnique", {"column_list": ["l_orderkey", "l_linenumber"]}, LINE_KEYS, "l_returnflag",
    ),
    LINE_KEY, "l_returnflag",
    "(SELECT *, count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS n FROM lineitem)", "n > 1",
)
for _name, _ignore, _where in (
    ("chk_compound_all_null", "all_values_are_missing", "NOT (quality IS NULL AND toxic IS NULL)"),
    ("chk_compound_any_null", "any_value_is_missing", "quality IS NOT NULL AND toxic IS NOT NULL"),
    ("chk_compound_never", "never", "TRUE"),
):
    check_query(
        _name,
        lambda spark, sf_dir: labelled_documents(spark, sf_dir).withColumn("toxic", F.expr("IF(lang = 'en', toxic, NULL)")),
        rule(
            "ExpectCompoundColumnsToBeUnique",
            {"column_list": ["quality", "toxic", "source"][: 2 if _ignore != "any_value_is_missing" else 3],
             "ignore_row_if": _ignore},
            "doc_id", "quality",
        ),
        text("doc_id"), "quality",
        f"""(SELECT *, count(*) OVER (PARTITION BY quality, toxic{', source' if _ignore == 'any_value_is_missing' else ''}) AS n
             FROM (SELECT doc_id, source, quality, CASE WHEN lang = 'en' THEN toxic END AS toxic FROM {DOCUMENTS_LABELS})
             WHERE {_where})""",
        "n > 1",
    )
check_query(
    "chk_sql_rows",
    "lineitem",
    rule(
        "UnexpectedRowsExpectation",
        {"unexpected_rows_query": "SELECT * FROM {batch} WHERE l_extendedprice / l_quantity > 2000"},
        LINE_KEYS, "l_returnflag",
    ),
    LINE_KEY, "l_returnflag", "lineitem", "l_extendedprice / l_quantity > 2000",
)
check_query(
    "chk_sql_agg",
    "events",
    rule(
        "UnexpectedRowsExpectation",
        {"unexpected_rows_query": "SELECT user_id, count(*) AS errors FROM {batch} WHERE event_type = 'error' "
                                  "GROUP BY user_id HAVING count(*) > 20"},
        "user_id", "errors",
    ),
    text("user_id"), "errors",
    "(SELECT user_id, count(*) AS errors FROM events WHERE event_type = 'error' GROUP BY user_id)", "errors > 20",
)
NEGATIVE_CUSTOMERS_ORDERS = (
    "SELECT b.* FROM {batch} b JOIN negative_customers c ON b.o_custkey = c.c_custkey WHERE b.o_totalprice > 400000"
)


@query(
    "chk_sql_join",
    f"""SELECT CAST(1 AS BIGINT) AS rule_key, {text('o_orderkey')} AS exception_row_pk, o_orderstatus AS exception_row_value
        FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_acctbal < 0 AND o_totalprice > 400000""",
)
def chk_sql_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    table(spark, sf_dir, "customer").filter("c_acctbal < 0").createOrReplaceTempView("negative_customers")
    spec = rule(
        "UnexpectedRowsExpectation", {"unexpected_rows_query": NEGATIVE_CUSTOMERS_ORDERS}, "o_orderkey", "o_orderstatus"
    )
    return failing(table(spark, sf_dir, "orders"), [spec])


def _solvent_customers(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {"crm.solvent": table(spark, sf_dir, "customer").filter("c_acctbal >= 0")}


for _name, _check, _exists in (
    ("chk_in_set_table", "ExpectColumnValuesToBeInSet", "NOT EXISTS"),
    ("chk_not_in_set_table", "ExpectColumnValuesToNotBeInSet", "EXISTS"),
):

    @query(
        _name,
        f"""SELECT CAST(1 AS BIGINT) AS rule_key, {text('o_orderkey')} AS exception_row_pk,
                   {text('o_custkey')} AS exception_row_value
            FROM orders WHERE {_exists} (SELECT 1 FROM customer WHERE c_custkey = o_custkey AND c_acctbal >= 0)""",
    )
    def chk_in_table(spark: SparkSession, sf_dir: str, check: str = _check) -> DataFrame:
        spec = rule(check, {"column": "o_custkey", "value_set": "crm.solvent.c_custkey"}, "o_orderkey", "o_custkey")
        return failing(table(spark, sf_dir, "orders"), [spec], _solvent_customers(spark, sf_dir))


@query(
    "chk_in_set_table_types",
    f"""SELECT CAST(1 AS BIGINT) AS rule_key, {text('o_orderkey')} AS exception_row_pk, {text('o_custkey')} AS exception_row_value
        FROM orders WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey % 3 <> 0 AND c_custkey = o_custkey)
        UNION ALL
        SELECT CAST(2 AS BIGINT), {text('o_orderkey')}, o_orderstatus FROM orders
        WHERE CAST(o_orderdate AS DATE) NOT IN (
            SELECT CAST(o_orderdate AS DATE) FROM orders WHERE o_orderkey % 5 = 0 AND o_orderdate = date_trunc('day', o_orderdate))""",
)
def chk_in_set_table_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole numbers among fractions, dates among points of time."""
    orders = table(spark, sf_dir, "orders").withColumn("o_day", F.to_date("o_orderdate"))
    code = "c_custkey + IF(c_custkey % 3 = 0, 0.5D, 0D) AS code"
    moment = "o_orderdate + make_interval(0, 0, 0, 0, CAST(IF(o_orderkey % 5 = 0, 0, 10) AS INT)) AS moment"
    lookups = {
        "crm.codes": table(spark, sf_dir, "customer").selectExpr(code),
        "crm.moments": orders.where("o_orderkey % 5 = 0 OR o_orderdate = date_trunc('day', o_orderdate)").selectExpr(moment),
    }
    check = "ExpectColumnValuesToBeInSet"
    specs = [
        rule(check, {"column": "o_custkey", "value_set": "crm.codes.code"}, "o_orderkey", "o_custkey"),
        rule(check, {"column": "o_day", "value_set": "crm.moments.moment"}, "o_orderkey", "o_orderstatus", rule_key=2),
    ]
    return failing(orders, specs, lookups)


_BUSY_CUSTOMERS = "SELECT o_custkey FROM orders WHERE o_totalprice > 200000"


@query(
    "chk_row_condition_subquery",
    f"""SELECT CAST(1 AS BIGINT) AS rule_key, {text('c_custkey')} AS exception_row_pk, {text('c_acctbal')} AS exception_row_value FROM customer
        WHERE c_custkey IN ({_BUSY_CUSTOMERS}) AND c_acctbal > 5000
        UNION ALL
        SELECT CAST(2 AS BIGINT), {text('c_custkey')}, c_mktsegment FROM customer
        WHERE c_custkey IN ({_BUSY_CUSTOMERS}) AND c_mktsegment NOT IN ('BUILDING', 'MACHINERY')
        UNION ALL
        SELECT CAST(3 AS BIGINT), {text('c_custkey')}, {text('c_nationkey')} FROM customer c
        WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)
          AND (SELECT count(*) FROM customer d WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = d.c_custkey)
               AND d.c_nationkey = c.c_nationkey AND d.c_mktsegment = c.c_mktsegment) > 1
        UNION ALL
        SELECT CAST(4 AS BIGINT), {text('c_custkey')}, {text('c_acctbal')} FROM customer WHERE c_acctbal < -500""",
)
def chk_row_condition_subquery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row conditions with IN and EXISTS, shared by rules of several kinds, and a rule without one."""
    view = f"orders_{uuid.uuid4().hex}"
    table(spark, sf_dir, "orders").createOrReplaceTempView(view)
    busy = _BUSY_CUSTOMERS.replace("orders", view)
    within = "ExpectColumnValuesToBeBetween"
    specs = [
        rule(within, {"column": "c_acctbal", "max_value": 5000}, "c_custkey", "c_acctbal", 1, condition=f"c_custkey IN ({busy})"),
        rule("ExpectColumnValuesToBeInSet", {"column": "c_mktsegment", "value_set": ["BUILDING", "MACHINERY"]}, "c_custkey", "c_mktsegment", 2, condition=f"c_custkey IN ({busy})"),
        rule("ExpectCompoundColumnsToBeUnique", {"column_list": ["c_nationkey", "c_mktsegment"]}, "c_custkey", "c_nationkey", 3,
             condition=f"NOT EXISTS (SELECT 1 FROM {view} WHERE o_custkey = c_custkey)"),
        rule(within, {"column": "c_acctbal", "min_value": -500}, "c_custkey", "c_acctbal", 4),
    ]
    try:
        return failing(table(spark, sf_dir, "customer"), specs)
    finally:
        spark.catalog.dropTempView(view)


@query(
    "chk_unique_many",
    f"""SELECT CAST(1 AS BIGINT) AS rule_key, {LINE_KEY} AS exception_row_pk, {text('l_partkey')} AS exception_row_value
        FROM (SELECT *, count(*) OVER (PARTITION BY l_partkey, l_suppkey) AS n FROM lineitem) WHERE n > 1
        UNION ALL
        SELECT CAST(2 AS BIGINT), {LINE_KEY}, {text('l_orderkey')}
        FROM (SELECT *, count(*) OVER (PARTITION BY l_orderkey) AS n FROM lineitem WHERE l_linenumber < 3) WHERE n > 1
        UNION ALL
        SELECT CAST(3 AS BIGINT), {LINE_KEY}, {text('l_extendedprice')}
        FROM (SELECT *, count(*) OVER (PARTITION BY l_extendedprice) AS n FROM lineitem) WHERE n > 1
        UNION ALL
        SELECT CAST(4 AS BIGINT), {LINE_KEY}, {text('l_linenumber')}
        FROM (SELECT *, count(*) OVER (PARTITION BY l_orderkey, l_linenumber, l_partkey) AS n FROM lineitem) WHERE n > 1""",
)
def chk_unique_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several uniqueness rules of one table, whose repeated keys are found in one pass."""
    one, several = "ExpectColumnValuesToBeUnique", "ExpectCompoundColumnsToBeUnique"
    specs = [
        rule(several, {"column_list": ["l_partkey", "l_suppkey"]}, LINE_KEYS, "l_partkey", 1),
        rule(one, {"column": "l_orderkey"}, LINE_KEYS, "l_orderkey", 2, condition="l_linenumber < 3"),
        rule(one, {"column": "l_extendedprice"}, LINE_KEYS, "l_extendedprice", 3),
        rule(several, {"column_list": ["l_orderkey", "l_linenumber", "l_partkey"]}, LINE_KEYS, "l_linenumber", 4),
    ]
    return failing(table(spark, sf_dir, "lineitem"), specs)


# -- metrics ----------------------------------------------------------------


def metrics_sql(key: int, kind: str, relation: str, scope: str, missing: str, bad: str, mostly: float = 1.0) -> str:
    """Measures of one rule, from predicates over the rows of a relation."""
    counts = f"""
        SELECT count(*) FILTER ({scope}) AS s, count(*) FILTER (({scope}) AND ({missing})) AS m,
               count(*) FILTER (({scope}) AND ({bad})) AS b, greatest(count(*), 1) AS t
        FROM {relation}"""

    def percent(part: str, whole: str) -> str:
        return f"CASE WHEN {whole} > 0 THEN {part} * 100.0::DOUBLE / {whole} ELSE 0.0::DOUBLE END"

    present = "(s - m)"
    columns = {
        "column": [
            f"{present} = 0 OR ({present} - b)::DOUBLE / greatest({present}, 1) >= {mostly}::DOUBLE",
            "s", percent("b", present), "'0'", "m", percent("m", "s"), percent("b", "s"), percent("b", present),
        ],
        "not_null": [
            f"s = 0 OR (s - b)::DOUBLE / greatest(s, 1) >= {mostly}::DOUBLE",
            "s", percent("b", "s"), "'0'", "b", percent("b", "s"), percent("b", "s"), "0.0::DOUBLE",
        ],
        "sql_rows": [
            "b = 0", "t", percent("b", "t"), "CAST(b AS VARCHAR)", "m", percent("m", "t"),
            f"100.0 - {percent('b', 't')}", f"100.0 - {percent('m', 't')}",
        ],
    }[kind]
    success, elements, share, observed, missed, missed_share, total_share, present_share = columns
    return f"""
        SELECT CAST({key} AS BIGINT) AS rule_key, ({success}) AS success_flag, {elements} AS element_count,
               b AS exception_count, round({share}, 4) AS exception_percent, {observed} AS observed_value,
               {missed} AS missing_count, round({missed_share}, 4) AS missing_percent,
               round({total_share}, 4) AS exception_percent_total,
               round({present_share}, 4) AS exception_percent_nonmissing
        FROM ({counts})"""


@query(
    "chk_not_null_nostore",
    f"""SELECT *, CAST(0 AS BIGINT) AS stored_rows
        FROM ({metrics_sql(1, 'not_null', DOCUMENTS_LABELS, 'TRUE', 'FALSE', 'quality IS NULL')})""",
)
def chk_not_null_nostore(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = rule("ExpectColumnValuesToNotBeNull", {"column": "quality", "store_exceptions": False}, "doc_id", "quality")
    rows, exceptions = check_table(
        labelled_documents(spark, sf_dir), [spec], lambda name: None, TODAY, Staging(spark)
    )
    stored = exceptions.groupBy("rule_key").agg(F.count(F.lit(1)).alias("stored_rows"))
    return rounded(rows).join(stored, "rule_key", "left").fillna(0, ["stored_rows"])


# Rules over lineitem that one scan answers: (rule key, check, arguments, column, SQL of a bad row).
_LINE_CONDITION = "l_quantity > 25"


def line_rules() -> list[tuple[RuleSpec, str, str]]:
    between, in_set = "ExpectColumnValuesToBeBetween", "ExpectColumnValuesToBeInSet"
    shapes = []
    for low in range(1, 6):
        shapes.append((between, {"column": "l_quantity", "min_value": low}, "l_quantity", f"l_quantity < {low}"))
        shapes.append((
            between, {"column": "l_extendedprice", "max_value": 20000 * low}, "l_extendedprice",
            f"l_extendedprice > {20000 * low}",
        ))
    for flag in "ANR":
        shapes.append((in_set, {"column": "l_returnflag", "value_set": [flag]}, "l_returnflag", f"l_returnflag <> '{flag}'"))
    shapes += [
        ("ExpectColumnValuesToMatchRegex", {"column": "l_returnflag", "regex": "^[AN]$"}, "l_returnflag",
         "NOT regexp_matches(l_returnflag, '^[AN]$')"),
        ("ExpectColumnValuesToNotMatchRegex", {"column": "l_linestatus", "regex": "O"}, "l_linestatus",
         "regexp_matches(l_linestatus, 'O')"),
        ("ExpectColumnValuesToMatchLikePattern", {"column": "l_linestatus", "like_pattern": "F%"}, "l_linestatus",
         "l_linestatus NOT LIKE 'F%'"),
        ("ExpectColumnPairValuesAToBeGreaterThanB", {"column_A": "l_extendedprice", "column_B": "l_quantity"},
         "l_quantity", "l_extendedprice <= l_quantity"),
        (between, {"column": "l_shipdate", "min_value": "1996-01-01", "mostly": 0.5}, "l_shipdate",
         "l_shipdate < TIMESTAMP '1996-01-01'"),
        (between, {"column": "l_tax", "max_value": 0.06}, "l_tax", "l_tax > 0.06::DOUBLE"),
        (between, {"column": "l_discount", "min_value": 0.02, "max_value": 0.09}, "l_discount",
         "l_discount < 0.02::DOUBLE OR l_discount > 0.09::DOUBLE"),
    ]
    rules = []
    for key, (check, arguments, column, bad) in enumerate(shapes, 1):
        condition = _LINE_CONDITION if key % 4 == 0 else None
        rules.append((rule(check, arguments, LINE_KEYS, column, key, condition=condition), condition or "TRUE", bad))
    return rules


@query(
    "rule_metrics",
    " UNION ALL ".join(
        metrics_sql(spec.rule_key, "column", "lineitem", scope, "FALSE", bad, spec.arguments.get("mostly", 1.0))
        for spec, scope, bad in line_rules()
    ),
)
def rule_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return measured(table(spark, sf_dir, "lineitem"), [spec for spec, _, _ in line_rules()])


@query(
    "exception_rows",
    " UNION ALL ".join(
        f"""SELECT CAST({spec.rule_key} AS BIGINT) AS rule_key, {LINE_KEY} AS exception_row_pk,
                   CAST({spec.column} AS VARCHAR) AS exception_row_value
            FROM lineitem WHERE ({scope}) AND ({bad})"""
        for spec, scope, bad in line_rules()
    ),
)
def exception_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return failing(table(spark, sf_dir, "lineitem"), [spec for spec, _, _ in line_rules()])


@query(
    "sql_rows_metrics",
    metrics_sql(1, "sql_rows", f"(SELECT * FROM {DOCUMENTS_LABELS})", "TRUE",
                "(quality IS NULL OR toxic = 1) AND quality IS NULL", "quality IS NULL OR toxic = 1")
    + " UNION ALL "
    + metrics_sql(2, "sql_rows", f"(SELECT * FROM {DOCUMENTS_LABELS})", "TRUE", "FALSE", "FALSE"),
)
def sql_rows_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    check = "UnexpectedRowsExpectation"
    specs = [
        rule(check, {"unexpected_rows_query": "SELECT * FROM {batch} WHERE quality IS NULL OR toxic = 1"}, "doc_id", "quality"),
        rule(check, {"unexpected_rows_query": "SELECT * FROM {batch} WHERE doc_id < 0"}, "doc_id", "quality", 2),
    ]
    return measured(labelled_documents(spark, sf_dir), specs)


COUNTED = {"customer": "c_custkey", "orders": "o_orderkey", "lineitem": "l_orderkey", "documents": "doc_id"}


@query(
    "asset_count",
    " UNION ALL ".join(f"SELECT '{name}' AS asset, count(*) AS element_count FROM {name}" for name in COUNTED),
)
def asset_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = None
    for name, key in COUNTED.items():
        df = table(spark, sf_dir, name)
        check = build_check(rule("ExpectColumnValuesToNotBeNull", {"column": key}, key, key), df, lambda n: None, TODAY)
        row = raw_counts(df, [check]).select(F.lit(name).alias("asset"), F.col("table_count").alias("element_count"))
        counts = row if counts is None else counts.unionAll(row)
    return counts


def order_rules() -> list[RuleSpec]:
    """One rule of each kind over orders."""
    key = "o_orderkey"
    return [
        rule("ExpectColumnValuesToNotBeNull", {"column": "o_custkey"}, key, "o_custkey", 1),
        rule("ExpectColumnValuesToBeBetween", {"column": "o_totalprice", "min_value": 2000, "max_value": 450000, "mostly": 0.8},
             key, "o_totalprice", 2),
        rule("ExpectColumnValuesToBeUnique", {"column": "o_custkey"}, key, "o_custkey", 3, condition="o_orderstatus = 'P'"),
        rule("ExpectColumnValuesToBeInSet", {"column": "o_custkey", "value_set": "crm.solvent.c_custkey"},
             key, "o_custkey", 4),
        rule("UnexpectedRowsExpectation",
             {"unexpected_rows_query": "SELECT * FROM {batch} WHERE o_orderpriority LIKE '1-%' AND o_orderstatus = 'F'"},
             key, "o_orderpriority", 5),
        rule("ExpectCompoundColumnsToBeUnique", {"column_list": ["o_custkey", "o_orderdate"]}, key, "o_custkey", 6),
    ]


ORDERS_JUDGED = """
    (SELECT *, count(*) OVER (PARTITION BY o_custkey, o_orderstatus) AS n_customer_status,
            count(*) OVER (PARTITION BY o_custkey, o_orderdate) AS n_customer_date,
            EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey AND c_acctbal >= 0) AS solvent
     FROM orders)"""
ORDER_RULES_SQL = [
    (1, "not_null", "TRUE", "o_custkey IS NULL", 1.0),
    (2, "column", "TRUE", "o_totalprice < 2000 OR o_totalprice > 450000", 0.8),
    (3, "column", "o_orderstatus = 'P'", "n_customer_status > 1", 1.0),
    (4, "column", "TRUE", "NOT solvent", 1.0),
    (5, "sql_rows", "TRUE", "o_orderpriority LIKE '1-%' AND o_orderstatus = 'F'", 1.0),
    (6, "column", "TRUE", "n_customer_date > 1", 1.0),
]


@query(
    "run_asset",
    " UNION ALL ".join(
        metrics_sql(key, kind, ORDERS_JUDGED, scope, "FALSE", bad, mostly)
        for key, kind, scope, bad, mostly in ORDER_RULES_SQL
    ),
)
def run_asset(spark: SparkSession, sf_dir: str) -> DataFrame:
    return measured(table(spark, sf_dir, "orders"), order_rules(), _solvent_customers(spark, sf_dir))


@query(
    "run_asset_exceptions",
    " UNION ALL ".join(
        f"""SELECT CAST({spec.rule_key} AS BIGINT) AS rule_key, {text('o_orderkey')} AS exception_row_pk,
                   {text(spec.column)} AS exception_row_value
            FROM {ORDERS_JUDGED} WHERE ({scope}) AND ({bad})"""
        for spec, (_, _, scope, bad, _) in zip(order_rules(), ORDER_RULES_SQL)
    ),
)
def run_asset_exceptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return failing(table(spark, sf_dir, "orders"), order_rules(), _solvent_customers(spark, sf_dir))


# -- rules ------------------------------------------------------------------

# Rule rows derived from parts and suppliers, as a rule source holds them.
PART_SOURCE = """
    p_size <> 7 AS current_flag,
    CASE WHEN p_size <> 11 THEN CAST(p_partkey AS INT) END AS rule_no,
    p_type AS table_name,
    CASE WHEN p_size % 10 <> 0 THEN p_name END AS "column",
    p_brand AS data_domain,
    CASE WHEN p_size = 13 THEN NULL WHEN p_size = 14 THEN '2023-01-12'
         ELSE lpad(CAST(p_size % 28 + 1 AS STRING), 2, '0') || '/02/2023' END AS created_at_date,
    '03/04/2023' AS modified_at_date,
    lpad(CAST(p_size % 28 + 1 AS STRING), 2, '0') || '/01/2000' AS start_date,
    CASE WHEN p_size % 9 = 0 THEN 'never' ELSE '31/12/' || CAST(1999 + p_size AS STRING) END AS expiry_date
"""
SUPPLIER_SOURCE = """
    'supplier' AS table_name, 's_acctbal' AS "column", '01/01/2020' AS start_date, '31/12/2030' AS expiry_date,
    CAST(s_suppkey AS INT) AS rule_no, CAST(s_nationkey AS STRING) AS data_domain, s_nationkey <> 3 AS current_flag,
    '05/06/2021' AS created_at_date, '07/08/2021' AS modified_at_date
"""


def derived(df: DataFrame, columns: str) -> DataFrame:
    view = f"derived_{id(df)}"
    df.createOrReplaceTempView(view)
    result = df.sparkSession.sql(f"SELECT {columns.replace(chr(34), '`')} FROM {view}")
    df.sparkSession.catalog.dropTempView(view)
    return result


def duck(columns: str) -> str:
    return columns.replace("STRING", "VARCHAR")


@query(
    "rule_ingest",
    f"""
    WITH sources AS (
        SELECT {duck(PART_SOURCE)} FROM part UNION ALL BY NAME SELECT {duck(SUPPLIER_SOURCE)} FROM supplier)
    SELECT concat_ws('~', table_name, "column", CAST(rule_no AS VARCHAR), data_domain) AS integration_id, rule_no,
           CAST(try_strptime(created_at_date, '%d/%m/%Y') AS VARCHAR) AS created_at_ts,
           CAST(try_strptime(modified_at_date, '%d/%m/%Y') AS VARCHAR) AS modified_at_ts,
           CAST(CAST(try_strptime(start_date, '%d/%m/%Y') AS DATE) AS VARCHAR) AS start_date,
           CAST(CAST(try_strptime(expiry_date, '%d/%m/%Y') AS DATE) AS VARCHAR) AS expiry_date
    FROM sources WHERE current_flag AND rule_no IS NOT NULL AND created_at_date IS NOT NULL""",
)
def rule_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    sources = [
        derived(table(spark, sf_dir, "part"), PART_SOURCE),
        derived(table(spark, sf_dir, "supplier"), SUPPLIER_SOURCE),
    ]
    names = ["created_at_ts", "modified_at_ts", "start_date", "expiry_date"]
    return R.ingest_rules(sources).select(
        "integration_id", "rule_no", *[F.col(name).cast("string").alias(name) for name in names]
    )


@query(
    "rule_ingest_text",
    """
    WITH sources AS (
        SELECT p_type AS table_name, p_name AS "column", p_brand AS data_domain, p_size,
               CASE WHEN p_size % 10 = 0 THEN 'rule_no' WHEN p_size % 10 = 1 THEN CAST(p_partkey AS VARCHAR) || '.x'
                    ELSE CAST(p_partkey AS VARCHAR) END AS rule_no,
               CASE WHEN p_size % 4 = 0 THEN 'high' ELSE CAST(p_size / 100 AS VARCHAR) END AS threshold
        FROM part WHERE p_size <> 7), marked AS (
        SELECT *, concat_ws(',', CASE WHEN TRY_CAST(rule_no AS INT) IS NULL THEN 'rule_no' END,
                            CASE WHEN TRY_CAST(threshold AS DOUBLE) IS NULL THEN 'threshold' END) AS names FROM sources)
    SELECT concat_ws('~', table_name, "column", rule_no, data_domain) AS rule, NULL AS message FROM marked WHERE names = ''
    UNION ALL
    SELECT NULL, 'source row ' || concat_ws(', ', table_name, "column", rule_no) || ' has unsuitable values of ' || names
    FROM marked WHERE names <> ''""",
)
def rule_ingest_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A source of texts only, with leaked headers and words for numbers."""
    source = table(spark, sf_dir, "part").selectExpr(
        "CAST(p_size <> 7 AS STRING) AS current_flag", "p_type AS table_name", "p_name AS column", "p_brand AS data_domain",
        "CASE WHEN p_size % 10 = 0 THEN 'rule_no' WHEN p_size % 10 = 1 THEN p_partkey || '.x' ELSE CAST(p_partkey AS STRING) END AS rule_no",
        "IF(p_size % 4 = 0, 'high', CAST(p_size / 100 AS STRING)) AS threshold",
        "'01/02/2023' AS created_at_date", "'01/02/2023' AS modified_at_date", "'01/01/2000' AS start_date", "'never' AS expiry_date",
    )
    rows = R.ingest_rules([source])
    stored = align_to_schema(R.fit_rules(rows), DQ_RULE, lenient=True)
    rejected = R.unfit_rules(rows).select(F.lit(None).cast("string").alias("rule"), "message")
    return stored.select(F.col("integration_id").alias("rule"), F.lit(None).cast("string").alias("message")).unionAll(rejected)


@query(
    "rule_args",
    r"""
    SELECT p_partkey AS rule_key,
           CASE WHEN p_partkey % 2 = 0 THEN 'ExpectColumnValuesToBeInSet' ELSE 'ExpectColumnPairValuesAToBeGreaterThanB' END
               AS check_name,
           'p_partkey|p_name' AS key_columns, p_partkey % 6 <> 4 AS readable,
           CASE p_partkey % 6 WHEN 0 THEN 'p_size' WHEN 1 THEN 'p_size' WHEN 4 THEN NULL ELSE 'p_name' END AS domain,
           CASE p_partkey % 6 WHEN 2 THEN '^\d+\\-' || p_size WHEN 3 THEN '^\w"' || p_size WHEN 5 THEN '' END AS pattern,
           CASE WHEN p_partkey % 6 < 2 THEN CAST(p_size AS VARCHAR) END AS min_value
    FROM part""",
)
def rule_args(spark: SparkSession, sf_dir: str) -> DataFrame:
    size, shape = F.col("p_size").cast("string"), F.col("p_partkey") % 6
    texts = [
        F.concat(F.lit('{"column": "p_size", "min_value": '), size, F.lit("}")),
        F.concat(F.lit('"{""column"": ""p_size"", ""min_value"": '), size, F.lit('}"')),
        F.concat(F.lit('{"column": "p_name", "pattern": "^\\d+\\\\\\\\-'), size, F.lit('"}')),
        F.concat(F.lit('{"column": "p_name", "pattern": "^\\\\w\\"'), size, F.lit('"}')),
        F.concat(F.lit("{column = "), size),
        F.lit('{"column": "p_name", "pattern": ""}'),
    ]
    arguments = F.lit(None)
    for number, value in enumerate(texts):
        arguments = F.when(shape == number, value).otherwise(arguments)
    rules = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("rule_key"),
        F.when(F.col("p_partkey") % 2 == 0, "expect_column_values_to_be_in_set")
        .otherwise("ExpectColumnPairValuesAToBeGreaterThanB")
        .alias("gx_expectation"),
        arguments.alias("gx_arguments"),
        F.lit(" p_partkey , p_name").alias("table_key"),
    )
    parsed = R.parse_rules(rules)
    return parsed.select(
        "rule_key",
        "check_name",
        F.array_join("key_columns", "|").alias("key_columns"),
        F.col("arguments_json").isNotNull().alias("readable"),
        F.get_json_object("arguments_json", "$.column").alias("domain"),
        F.get_json_object("arguments_json", "$.pattern").alias("pattern"),
        F.get_json_object("arguments_json", "$.min_value").alias("min_value"),
    )


RULE_TYPE_SOURCE = """
    CAST(p_partkey AS INT) AS rule_type_key, p_name AS rule_type_name, p_brand AS dq_dimension,
    p_type AS gx_expectation, 'size ' || CAST(p_size AS STRING) AS gx_description,
    TIMESTAMP '2020-01-01 00:00:00' AS created_at_ts, TIMESTAMP '2020-01-02 00:00:00' AS modified_at_ts,
    p_size > 20 AS current_flag
"""


@query(
    "rule_type_load",
    """
    WITH stored AS (
        SELECT p_partkey AS k, CAST(p_partkey AS VARCHAR) || '~OLD' AS i, 'OLD' AS e, 'old' AS d FROM part WHERE p_size < 30),
    incoming AS (
        SELECT p_partkey AS k, CAST(p_partkey AS VARCHAR) || '~' || p_type AS i, p_type AS e,
               'size ' || CAST(p_size AS VARCHAR) AS d FROM part WHERE p_size > 20)
    SELECT CAST(coalesce(n.k, o.k) AS INT) AS rule_type_key, coalesce(n.i, o.i) AS integration_id,
           coalesce(n.e, o.e) AS gx_expectation, coalesce(n.d, o.d) AS gx_description
    FROM stored o FULL JOIN incoming n ON o.k = n.k""",
)
def rule_type_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    incoming = R.ingest_rule_types(derived(part, RULE_TYPE_SOURCE))
    stored = align_to_schema(
        part.filter("p_size < 30").select(
            F.expr("p_partkey || '~OLD'").alias("integration_id"),
            F.col("p_partkey").alias("rule_type_key"),
            F.lit("OLD").alias("gx_expectation"),
            F.lit("old").alias("gx_description"),
        ),
        DQ_RULE_TYPE,
    )
    merged = upserted(stored, incoming, "rule_type_key", OVERWRITE)
    return merged.select("rule_type_key", "integration_id", "gx_expectation", "gx_description")


@query(
    "rule_resolve",
    """
    SELECT p_partkey AS rule_key, p_size % 30 AS rule_type_key, n_name AS gx_expectation
    FROM part LEFT JOIN nation ON p_size % 30 = n_nationkey""",
)
def rule_resolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("rule_key"), (F.col("p_size") % 30).alias("rule_type_key")
    )
    types = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("rule_type_key"), F.col("n_name").alias("gx_expectation")
    )
    return R.resolve_rules(rules, types).select("rule_key", "rule_type_key", "gx_expectation")


RULE_STATE = """
    p_partkey AS rule_key, 'main' AS "catalog", 'shop' AS "schema", p_brand AS table_name,
    CASE WHEN p_partkey % 97 = 0 THEN 'integration_id' ELSE CAST(p_partkey AS STRING) END AS integration_id,
    CASE p_partkey % 13 WHEN 0 THEN 'N' WHEN 1 THEN NULL WHEN 2 THEN 'y' ELSE 'Y' END AS rule_enabled,
    CASE WHEN p_size % 17 = 0 THEN NULL WHEN p_size % 5 = 0 THEN DATE '2001-01-01'
         WHEN p_size % 7 = 0 THEN DATE '2001-01-02' ELSE DATE '1999-01-01' END AS start_date,
    CASE WHEN p_size % 19 = 0 THEN NULL WHEN p_size % 3 = 0 THEN DATE '2001-01-01'
         WHEN p_size % 4 = 0 THEN DATE '2000-12-31' ELSE DATE '2009-01-01' END AS expiry_date
"""
CHOSEN_BRANDS = [f"Brand#{number}" for number in range(1, 21)]


@query(
    "rule_active",
    f"""
    SELECT rule_key,
           CASE WHEN integration_id = 'integration_id' THEN 'header'
                WHEN table_name NOT IN ({', '.join(f"'{b}'" for b in CHOSEN_BRANDS)}) THEN 'not_selected'
                WHEN coalesce(rule_enabled, '') <> 'Y' THEN 'disabled'
                WHEN start_date IS NULL OR expiry_date IS NULL THEN 'no_dates'
                WHEN start_date > DATE '2001-01-01' THEN 'not_started'
                WHEN expiry_date < DATE '2001-01-01' THEN 'expired' ELSE 'active' END AS status
    FROM (SELECT {duck(RULE_STATE)} FROM part)""",
)
def rule_active(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = derived(table(spark, sf_dir, "part"), RULE_STATE)
    chosen = [f"main-shop-{brand}" for brand in CHOSEN_BRANDS]
    return R.with_status(rules, TODAY, chosen).select("rule_key", "status")


@query(
    "rule_keys",
    """
    WITH stored AS (SELECT 'r' || CAST(p_partkey AS VARCHAR) AS id, p_partkey * 2 + 1 AS k FROM part WHERE p_size < 30),
    incoming AS (SELECT 'r' || CAST(p_partkey AS VARCHAR) AS id FROM part WHERE p_size > 20),
    new AS (SELECT id FROM incoming WHERE id NOT IN (SELECT id FROM stored))
    SELECT id AS integration_id, k AS rule_key FROM stored JOIN incoming USING (id)
    UNION ALL
    SELECT id, (SELECT max(k) FROM stored) + row_number() OVER (ORDER BY id) FROM new""",
)
def rule_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = table(spark, sf_dir, "part").select(
        "p_partkey", "p_size", F.concat(F.lit("r"), F.col("p_partkey").cast("string")).alias("integration_id")
    )
    stored = ids.filter("p_size < 30").select("integration_id", (F.col("p_partkey") * 2 + 1).alias("rule_key"))
    incoming = align_to_schema(ids.filter("p_size > 20").select("integration_id"), DQ_RULE)
    return R.assign_rule_keys(incoming, stored, Staging(spark)).select("integration_id", "rule_key")


# -- schema, upsert, keys ---------------------------------------------------


@query(
    "align_schema",
    """
    SELECT c_name, CAST(c_custkey AS VARCHAR) AS c_custkey, CAST(c_nationkey AS BIGINT) AS c_nationkey,
           CAST(NULL AS VARCHAR) AS c_comment, CAST(NULL AS INT) AS c_rating
    FROM customer""",
)
def align_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = T.StructType(
        [
            T.StructField("c_name", T.StringType()),
            T.StructField("c_custkey", T.StringType()),
            T.StructField("c_comment", T.StringType()),
            T.StructField("c_nationkey", T.LongType()),
            T.StructField("c_rating", T.IntegerType()),
        ]
    )
    return align_to_schema(table(spark, sf_dir, "customer"), schema)


SUPPLIER_OLD = "s_suppkey, s_name, s_nationkey, s_acctbal"
SUPPLIER_NEW = """
    s_suppkey + 5 AS s_suppkey, CASE WHEN s_suppkey % 4 <> 0 THEN 'new ' || s_name END AS s_name,
    CASE WHEN s_suppkey % 5 <> 0 THEN s_nationkey + 1 END AS s_nationkey
"""


def upsert_sql(name: str, nation: str) -> str:
    return f"""
        WITH o AS (SELECT {SUPPLIER_OLD} FROM supplier),
             n AS (SELECT {SUPPLIER_NEW}, TRUE AS matched FROM supplier WHERE s_acctbal > 0)
        SELECT coalesce(n.s_suppkey, o.s_suppkey) AS s_suppkey, {name} AS s_name, {nation} AS s_nationkey, o.s_acctbal
        FROM o FULL JOIN n ON o.s_suppkey = n.s_suppkey"""


def upsert_query(mode: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        supplier = table(spark, sf_dir, "supplier")
        newer = derived(supplier.filter("s_acctbal > 0"), SUPPLIER_NEW)
        return upserted(supplier, newer, "s_suppkey", mode)

    return run


query("upsert_overwrite", upsert_sql(
    "CASE WHEN n.matched THEN n.s_name ELSE o.s_name END",
    "CASE WHEN n.matched THEN n.s_nationkey ELSE o.s_nationkey END",
))(upsert_query(OVERWRITE))
query("upsert_coalesce", upsert_sql(
    "coalesce(n.s_name, o.s_name)", "coalesce(n.s_nationkey, o.s_nationkey)",
))(upsert_query(COALESCE))


@query(
    "surrogate_keys",
    """
    SELECT CAST(101 AS BIGINT) AS first_key, 100 + count(*) AS last_key, count(*) AS key_count, count(*) AS distinct_keys
    FROM lineitem WHERE l_discount <= 0 OR l_discount >= 0.1::DOUBLE""",
)
def surrogate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = QUERIES["chk_between_strict"](spark, sf_dir)
    return number_rows(rows, "exception_key", Staging(spark), start=100).agg(
        F.min("exception_key").alias("first_key"),
        F.max("exception_key").alias("last_key"),
        F.count(F.lit(1)).alias("key_count"),
        F.countDistinct("exception_key").alias("distinct_keys"),
    )


@query(
    "validation_keys",
    """
    SELECT p_brand AS asset, p_partkey AS rule_key, 1000 + row_number() OVER (ORDER BY p_brand, p_partkey) AS validation_key
    FROM part""",
)
def validation_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = table(spark, sf_dir, "part").select(F.col("p_brand").alias("asset"), F.col("p_partkey").alias("rule_key"))
    return number_rows(rules, "validation_key", Staging(spark), [F.col("asset"), F.col("rule_key")], start=1000)


# -- ledger -----------------------------------------------------------------


def past_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A ledger with several runs, rules and states, derived from orders."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("exception_key"),
        (F.col("o_orderkey") % 5).cast("int").alias("execution_key"),
        (F.col("o_custkey") % 10).alias("rule_key"),
        F.col("o_orderkey").cast("string").alias("exception_row_pk"),
        (F.col("o_orderstatus") == "F").alias("fixed_exception_flag"),
    )


PAST_VALIDATIONS_SQL = """
    SELECT o_orderkey AS validation_key, CAST(o_orderkey // 1000 AS INT) AS execution_key, o_custkey % 50 AS rule_key,
           o_orderstatus = 'O' AS success_flag, CASE WHEN o_orderpriority = '5-LOW' THEN 0 ELSE 10 END AS element_count
    FROM orders"""


def past_validations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("validation_key"),
        F.floor(F.col("o_orderkey") / 1000).cast("int").alias("execution_key"),
        (F.col("o_custkey") % 50).alias("rule_key"),
        (F.col("o_orderstatus") == "O").alias("success_flag"),
        F.when(F.col("o_orderpriority") == "5-LOW", 0).otherwise(10).alias("element_count"),
    )


@query(
    "ledger_prior_open",
    """
    SELECT o_orderkey AS exception_key, CAST(o_orderkey % 5 AS INT) AS execution_key, o_custkey % 10 AS rule_key
    FROM orders
    WHERE o_orderstatus <> 'F' AND ((o_orderkey % 5 = 3 AND o_custkey % 10 IN (1, 2)) OR (o_orderkey % 5 = 2 AND o_custkey % 10 = 5))""",
)
def ledger_prior_open(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = L.prior_open(past_ledger(spark, sf_dir), {1: 3, 2: 3, 5: 2})
    return rows.select("exception_key", "execution_key", "rule_key")


@query("ledger_max_key", "SELECT coalesce(max(o_orderkey), 0) AS max_exception_key FROM orders")
def ledger_max_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.max_exception_key(past_ledger(spark, sf_dir))


@query(
    "last_run",
    f"SELECT validation_key, execution_key FROM ({PAST_VALIDATIONS_SQL}) ORDER BY validation_key DESC LIMIT 1",
)
def last_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.last_run(past_validations(spark, sf_dir))


@query(
    "ledger_last_evaluated",
    f"""
    SELECT rule_key, max(execution_key) AS execution_key FROM ({PAST_VALIDATIONS_SQL})
    WHERE rule_key < 20 AND execution_key < 4 AND NOT (NOT success_flag AND element_count = 0) GROUP BY rule_key""",
)
def ledger_last_evaluated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.last_evaluated(past_validations(spark, sf_dir), range(20), 4)


def balance_rule(low: float, high: float) -> RuleSpec:
    arguments = {"column": "c_acctbal", "min_value": low, "max_value": high}
    return rule("ExpectColumnValuesToBeBetween", arguments, "c_custkey", "c_acctbal", 1, table="customer")


def segment_rule() -> RuleSpec:
    arguments = {"column": "c_mktsegment", "value_set": ["BUILDING", "MACHINERY"]}
    return rule(
        "ExpectColumnValuesToBeInSet", arguments, "c_nationkey,c_mktsegment", "c_mktsegment", 2,
        table="customer", condition="c_nationkey < 10",
    )


def customer_run(spark: SparkSession, sf_dir: str, specs: list[RuleSpec], run_ts: str, **options) -> RunResult:
    return run_rules(
        spark, specs, lambda spec: table(spark, sf_dir, spec.table), lambda name: None,
        today=TODAY, run_ts=F.lit(run_ts).cast("timestamp"), **options,
    )


def two_runs(spark: SparkSession, sf_dir: str) -> RunResult:
    """A second run after bounds changed: some exceptions are fixed, some new, some known.

    The second rule's row keys are far from unique.
    """
    first = customer_run(spark, sf_dir, [balance_rule(500, 9000), segment_rule()], FIRST_RUN)
    stored = first.staging.put(first.exceptions, "ledger")
    return customer_run(
        spark, sf_dir, [balance_rule(0, 8500), segment_rule()], SECOND_RUN,
        ledger=stored, execution_key=2, last_validation_key=2, last_exception_key=stored.count(),
    )


CUSTOMER_BAD = """
    current_rows AS (
        SELECT 1 AS r, CAST(c_custkey AS VARCHAR) AS pk, CAST(c_acctbal AS VARCHAR) AS v FROM customer
        WHERE c_acctbal < 0 OR c_acctbal > 8500
        UNION ALL
        SELECT 2, CAST(c_nationkey AS VARCHAR) || '_' || c_mktsegment, c_mktsegment FROM customer
        WHERE c_nationkey < 10 AND c_mktsegment NOT IN ('BUILDING', 'MACHINERY')),
    previous_rows AS (
        SELECT 1 AS r, CAST(c_custkey AS VARCHAR) AS pk, CAST(c_acctbal AS VARCHAR) AS v FROM customer
        WHERE c_acctbal < 500 OR c_acctbal > 9000
        UNION ALL
        SELECT r, pk, v FROM current_rows WHERE r = 2)"""
LEDGER_COLUMNS = [
    "rule_key", "validation_key", "execution_key", "exception_row_pk", "exception_row_value", "new_exception_flag",
    "fixed_exception_flag", "row_delete_flag", "integration_id", "created_at_ts", "modified_at_ts",
]


def ledger_sql(kinds: str) -> str:
    first, second = "'2001-01-01 06:00:00'", "'2001-01-02 06:00:00'"

    def rows(relation: str, where: str, run: int, new: str, fixed: str, created: str, modified: str) -> str:
        return f"""
            SELECT CAST(r AS BIGINT) AS rule_key, CAST(r + 2 AS BIGINT) AS validation_key, {run} AS execution_key,
                   pk AS exception_row_pk, v AS exception_row_value, {new} AS new_exception_flag,
                   {fixed} AS fixed_exception_flag, FALSE AS row_delete_flag, pk || '~' || {modified} AS integration_id,
                   {created} AS created_at_ts, {modified} AS modified_at_ts
            FROM {relation} x WHERE {where}"""

    in_previous = "EXISTS (SELECT 1 FROM previous_rows p WHERE p.r = x.r AND p.pk = x.pk)"
    in_current = "EXISTS (SELECT 1 FROM current_rows c WHERE c.r = x.r AND c.pk = x.pk)"
    parts = {
        "known": rows("current_rows", in_previous, 2, "FALSE", "FALSE", first, second),
        "new": rows("current_rows", f"NOT {in_previous}", 2, "TRUE", "FALSE", second, second),
        "fixed": rows("previous_rows", f"NOT {in_current}", 1, "FALSE", "TRUE", first, first),
    }
    return f"WITH {CUSTOMER_BAD} " + " UNION ALL ".join(parts[kind] for kind in kinds.split())


def ledger_rows(result: RunResult) -> DataFrame:
    times = ["created_at_ts", "modified_at_ts"]
    return result.exceptions.select(LEDGER_COLUMNS).withColumns({name: F.col(name).cast("string") for name in times})


@query("ledger_classify", ledger_sql("known new fixed"))
def ledger_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger_rows(two_runs(spark, sf_dir))


@query("ledger_known", ledger_sql("known"))
def ledger_known(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger_rows(two_runs(spark, sf_dir)).filter("NOT new_exception_flag AND NOT fixed_exception_flag")


@query("ledger_new", ledger_sql("new"))
def ledger_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger_rows(two_runs(spark, sf_dir)).filter("new_exception_flag")


@query("ledger_fixed", ledger_sql("fixed"))
def ledger_fixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger_rows(two_runs(spark, sf_dir)).filter("fixed_exception_flag")


@query(
    "ledger_counts",
    f"""
    WITH {CUSTOMER_BAD}, marked AS (
        SELECT r, EXISTS (SELECT 1 FROM previous_rows p WHERE p.r = x.r AND p.pk = x.pk) AS known FROM current_rows x),
    gone AS (SELECT r FROM previous_rows x WHERE NOT EXISTS (SELECT 1 FROM current_rows c WHERE c.r = x.r AND c.pk = x.pk))
    SELECT CAST(r AS BIGINT) AS rule_key, count(*) FILTER (known) AS known_exception_count,
           count(*) FILTER (NOT known) AS new_exception_count,
           (SELECT count(*) FROM gone WHERE gone.r = marked.r) AS fixed_exception_count
    FROM marked GROUP BY r""",
)
def ledger_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ["rule_key", "known_exception_count", "new_exception_count", "fixed_exception_count"]
    return two_runs(spark, sf_dir).validations.select(names)


@query(
    "ledger_first_run",
    f"""
    WITH {CUSTOMER_BAD}
    SELECT CAST(r AS BIGINT) AS rule_key, CAST(r AS BIGINT) AS validation_key, 1 AS execution_key, pk AS exception_row_pk,
           v AS exception_row_value, TRUE AS new_exception_flag, FALSE AS fixed_exception_flag, FALSE AS row_delete_flag,
           pk || '~2001-01-02 06:00:00' AS integration_id, '2001-01-02 06:00:00' AS created_at_ts,
           '2001-01-02 06:00:00' AS modified_at_ts
    FROM current_rows""",
)
def ledger_first_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger_rows(customer_run(spark, sf_dir, [balance_rule(0, 8500), segment_rule()], SECOND_RUN))


def validations_sql() -> str:
    measures = " UNION ALL ".join(
        metrics_sql(key, kind, ORDERS_JUDGED, scope, "FALSE", bad, mostly)
        for key, kind, scope, bad, mostly in ORDER_RULES_SQL
    )
    bad_rows = " UNION ALL ".join(
        f"SELECT {key} AS r, o_orderkey AS pk FROM {ORDERS_JUDGED} WHERE ({scope}) AND ({bad})"
        for key, _, scope, bad, _ in ORDER_RULES_SQL
    )
    return f"""
        WITH measures AS ({measures}), bad_rows AS ({bad_rows}),
        prior AS (SELECT o_custkey % 8 AS r, o_orderkey AS pk FROM orders WHERE o_orderpriority < '3' AND o_orderstatus <> 'F'),
        failed AS (SELECT b.r, b.pk, EXISTS (SELECT 1 FROM prior p WHERE p.r = b.r AND p.pk = b.pk) AS known
                   FROM bad_rows b JOIN measures m ON b.r = m.rule_key WHERE NOT m.success_flag),
        gone AS (SELECT r FROM prior p WHERE NOT EXISTS (SELECT 1 FROM bad_rows b WHERE b.r = p.r AND b.pk = p.pk)),
        total AS (SELECT count(*)::DOUBLE AS t FROM orders),
        counts AS (
            SELECT rule_key, (SELECT count(*) FROM failed f WHERE f.r = m.rule_key AND known) AS known,
                   (SELECT count(*) FROM failed f WHERE f.r = m.rule_key AND NOT known) AS new,
                   (SELECT count(*) FROM gone g WHERE g.r = m.rule_key) AS fixed
            FROM measures m)
        SELECT m.*, CAST(m.rule_key AS VARCHAR) || '~4' AS integration_id, m.rule_key + 40 AS validation_key, 4 AS execution_key,
               known AS known_exception_count, new AS new_exception_count, fixed AS fixed_exception_count,
               round(known / t, 4) AS known_exception_percent, round(new / t, 4) AS new_exception_percent,
               round(fixed / t, 4) AS fixed_exception_percent
        FROM measures m JOIN counts USING (rule_key), total"""


@query("validation_rows", validations_sql())
def validation_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    ledger = orders.filter("o_orderpriority < '3'").select(
        F.lit(3).alias("execution_key"),
        (F.col("o_custkey") % 8).alias("rule_key"),
        F.col("o_orderkey").alias("exception_key"),
        F.lit(0).cast("long").alias("validation_key"),
        F.col("o_orderkey").cast("string").alias("exception_row_pk"),
        F.col("o_orderpriority").alias("exception_row_value"),
        (F.col("o_orderstatus") == "F").alias("fixed_exception_flag"),
        F.lit(True).alias("new_exception_flag"),
        F.lit(False).alias("row_delete_flag"),
        F.col("o_orderdate").alias("created_at_ts"),
        F.col("o_orderdate").alias("modified_at_ts"),
    )
    result = run_rules(
        spark, order_rules(), lambda spec: orders, _solvent_customers(spark, sf_dir).__getitem__,
        today=TODAY, run_ts=F.lit(SECOND_RUN).cast("timestamp"), execution_key=4, last_validation_key=40, ledger=ledger,
    )
    return rounded(result.validations.drop("created_at_ts", "modified_at_ts"))


def _asset_validation(rule: int, key: int, relation: str, bad: str, scope: str = "TRUE") -> str:
    return f"""
        SELECT CAST({rule} AS BIGINT) AS rule_key, CAST({key} AS BIGINT) AS validation_key, count(*) FILTER ({scope}) AS element_count,
               count(*) FILTER ({scope} AND {bad}) AS exception_count, count(*) FILTER ({scope} AND {bad}) AS new_exception_count,
               count(*) FILTER ({scope} AND {bad}) = 0 AS success_flag, count(*) AS table_rows FROM {relation}"""


@query(
    "validation_rows_assets",
    f"""SELECT rule_key, validation_key, element_count, exception_count, new_exception_count, success_flag,
               round(CAST(new_exception_count AS DOUBLE) / table_rows, 4) AS new_exception_percent FROM (
        {_asset_validation(1, 1, "customer", "(c_acctbal < 0 OR c_acctbal > 8500)")} UNION ALL
        {_asset_validation(5, 2, "customer", "c_mktsegment NOT IN ('BUILDING', 'MACHINERY')", "c_nationkey < 10")} UNION ALL
        {_asset_validation(3, 3, "lineitem", "l_discount > 0.05::DOUBLE")} UNION ALL
        {_asset_validation(2, 4, "orders", "o_totalprice < 2000")} UNION ALL
        {_asset_validation(4, 5, "part", "p_size > 60")})""",
)
def validation_rows_assets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One run over four tables: validations are numbered by table, then rule; one table passes."""
    within = "ExpectColumnValuesToBeBetween"
    specs = [
        balance_rule(0, 8500), replace(segment_rule(), rule_key=5),
        rule(within, {"column": "o_totalprice", "min_value": 2000}, "o_orderkey", "o_totalprice", 2, table="orders"),
        rule(within, {"column": "l_discount", "max_value": 0.05}, LINE_KEYS, "l_discount", 3, table="lineitem"),
        rule(within, {"column": "p_size", "max_value": 60}, "p_partkey", "p_size", 4, table="part"),
    ]
    rows = customer_run(spark, sf_dir, specs, FIRST_RUN).validations
    return rows.select(
        "rule_key", "validation_key", "element_count", "exception_count", "new_exception_count", "success_flag",
        F.round(F.col("new_exception_percent").cast("double"), 4).alias("new_exception_percent"),
    )


# -- catalog and store --------------------------------------------------------


def in_database(spark: SparkSession, work: Callable[[Store], DataFrame]) -> DataFrame:
    """The rows that ``work`` reads from a store in a database of its own, which is dropped behind it."""
    store = Store(spark, f"plumbline_{uuid.uuid4().hex}")
    store.create()
    try:
        return Staging(spark).put(work(store), "result")
    finally:
        spark.sql(f"DROP DATABASE {store.schema} CASCADE")


@query(
    "catalog_rule_tables",
    "SELECT c_custkey, c_name FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE n_regionkey % 2 = 0",
)
def catalog_rule_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers of every other region, each region's a table, found by a part of its name and read by its name."""

    def work(store: Store) -> DataFrame:
        nations = table(spark, sf_dir, "nation").withColumnRenamed("n_nationkey", "c_nationkey")
        customers = table(spark, sf_dir, "customer").join(nations, "c_nationkey")
        for region in range(5):
            kind = "rules" if region % 2 == 0 else "notes"
            customers.filter(F.col("n_regionkey") == region).write.saveAsTable(f"{store.schema}.{kind}_of_{region}")
        found = [store.table(name) for name in catalog.rule_tables(spark, store.schema, "rules_of")]
        return reduce(DataFrame.unionByName, found).select("c_custkey", "c_name")

    return in_database(spark, work)


@query(
    "store_append",
    """SELECT o_orderkey AS exception_key, CAST(o_orderkey % 3 + 1 AS INT) AS execution_key, CAST(o_custkey AS VARCHAR) AS exception_row_pk,
              CAST(NULL AS VARCHAR) AS exception_row_value FROM orders WHERE o_orderkey % 3 > 0""",
)
def store_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of three runs: of the first the ledger is emptied, those of the other two stay."""

    def work(store: Store) -> DataFrame:
        orders = table(spark, sf_dir, "orders")
        for run in range(3):
            rows = orders.filter(F.col("o_orderkey") % 3 == run).selectExpr(
                "o_orderkey AS exception_key", f"{run + 1}L AS execution_key", "o_custkey AS exception_row_pk"
            )
            store.append(rows, store.exceptions)
            if run == 0:
                store.reset_ledger()
        return store.table(store.exceptions).select("exception_key", "execution_key", "exception_row_pk", "exception_row_value")

    return in_database(spark, work)


def store_upsert(mode: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        def work(store: Store) -> DataFrame:
            staging = Staging(spark)
            fields = "CAST(s_suppkey AS STRING) AS integration_id, s_suppkey AS rule_key, s_name AS it_steward, CAST(s_nationkey AS INT) AS rule_no"
            supplier = table(spark, sf_dir, "supplier")
            store.upsert(derived(supplier, fields), store.rules, "integration_id", DQ_RULE, staging, mode)
            newer = derived(derived(supplier.filter("s_acctbal > 0"), SUPPLIER_NEW), fields)
            store.upsert(newer, store.rules, "integration_id", DQ_RULE, staging, mode)
            return store.table(store.rules).selectExpr("integration_id", "it_steward AS s_name", "rule_no AS s_nationkey")

        return in_database(spark, work)

    return run


for _mode, _name, _nation in (
    (OVERWRITE, "CASE WHEN n.matched THEN n.s_name ELSE o.s_name END", "CASE WHEN n.matched THEN n.s_nationkey ELSE o.s_nationkey END"),
    (COALESCE, "coalesce(n.s_name, o.s_name)", "coalesce(n.s_nationkey, o.s_nationkey)"),
):
    query(
        f"store_upsert_{_mode}",
        f"SELECT CAST(s_suppkey AS VARCHAR) AS integration_id, s_name, CAST(s_nationkey AS INT) AS s_nationkey FROM ({upsert_sql(_name, _nation)})",
    )(store_upsert(_mode))


@query(
    "workflow_two_runs",
    """
    SELECT CAST(c_custkey AS VARCHAR) AS exception_row_pk,
           CASE WHEN c_acctbal BETWEEN 0 AND 9000 THEN 'new' WHEN c_acctbal + 600 BETWEEN 0 AND 9000 THEN 'fixed' ELSE 'known' END AS kind
    FROM customer WHERE c_acctbal NOT BETWEEN 0 AND 9000 OR c_acctbal + 600 NOT BETWEEN 0 AND 9000""",
)
def workflow_two_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules from catalog tables, run over customers, and again over customers with other balances."""
    return in_database(spark, lambda store: balance_runs(spark, sf_dir, store, [(1, 0), (2, 600)]))


@query(
    "workflow_broken_run",
    """
    SELECT CAST(run AS INT) AS execution_key, CAST(c_custkey AS VARCHAR) AS exception_row_pk, kind FROM (
        SELECT 1 AS run, c_custkey, 'new' AS kind FROM customer WHERE c_acctbal NOT BETWEEN 0 AND 9000
        UNION ALL
        SELECT CASE WHEN c_acctbal + 600 BETWEEN 0 AND 9000 THEN 1 ELSE 3 END, c_custkey,
               CASE WHEN c_acctbal BETWEEN 0 AND 9000 THEN 'new' WHEN c_acctbal + 600 BETWEEN 0 AND 9000 THEN 'fixed' ELSE 'known' END
        FROM customer WHERE c_acctbal NOT BETWEEN 0 AND 9000 OR c_acctbal + 600 NOT BETWEEN 0 AND 9000)""",
)
def workflow_broken_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger after three runs, the second of which broke off with its exceptions stored: nobody sees them, and the third is compared with the first."""

    def work(store: Store) -> DataFrame:
        balance_runs(spark, sf_dir, store, [(1, 0), (2, -900), (3, 600)], broken=2)
        rows = store.committed(store.exceptions)
        return rows.select("execution_key", "exception_row_pk", kind_of_row().alias("kind"))

    return in_database(spark, work)


def kind_of_row() -> Column:
    return F.when(F.col("fixed_exception_flag"), "fixed").when(F.col("new_exception_flag"), "new").otherwise("known")


class BrokenOff(Exception):
    """Stands for whatever ends a run from outside."""


class BreakingStore(Store):
    """A store that loses its cluster when validations are to be stored."""

    def append(self, df: DataFrame, name: str) -> None:
        if name == self.validations:
            raise BrokenOff
        super().append(df, name)


def balance_runs(spark: SparkSession, sf_dir: str, store: Store, days: list[tuple[int, float]], broken: int | None = None) -> DataFrame:
    """Runs of one rule over customers whose balances move from day to day; returns the rows of the last."""
    spark.sql(
        "SELECT 1 AS rule_type_key, 'range' AS rule_type_name, 'validity' AS dq_dimension, 'ExpectColumnValuesToBeBetween' AS gx_expectation, "
        "'' AS gx_description, current_timestamp() AS created_at_ts, current_timestamp() AS modified_at_ts, true AS current_flag"
    ).write.saveAsTable(f"{store.schema}.bronze_types")
    spark.sql(
        f"""SELECT 1 AS rule_no, 'customers' AS table_name, 'c_acctbal' AS column, 'crm' AS data_domain, 1 AS rule_type_key, 'main' AS catalog,
        '{store.schema}' AS schema, 'c_custkey' AS table_key, '{{"column": "c_acctbal", "min_value": 0, "max_value": 9000}}' AS gx_arguments,
        'Y' AS rule_enabled, true AS current_flag, '01/01/2000' AS created_at_date, '01/01/2000' AS modified_at_date,
        '01/01/2000' AS start_date, '31/12/2009' AS expiry_date"""
    ).write.saveAsTable(f"{store.schema}.bronze_rules")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    for day, moved in days:
        balances = customers.withColumn("c_acctbal", F.col("c_acctbal") + moved)
        balances.write.mode("overwrite").saveAsTable(f"{store.schema}.customers")
        if day == broken:
            try:
                run_stored_rules(BreakingStore(spark, store.schema), today=TODAY, run_ts=datetime(2001, 1, day))
            except BrokenOff:
                continue
        result, _ = run_workflow(
            spark, [f"{store.schema}.bronze_rules"], f"{store.schema}.bronze_types", schema=store.schema,
            today=TODAY, run_ts=datetime(2001, 1, day),
        )
    return result.exceptions.select("exception_row_pk", kind_of_row().alias("kind"))
