"""What the plans must look like, whatever the data."""

import os

import pytest
from helpers import BETWEEN, IN_SET, REGEX, TODAY, UNIQUE, build, rule, run
from plumbline.operators.evaluate import COUNTERS_PER_SCAN, check_table, exception_rows, raw_counts
from plumbline.sources.staging import Staging
from pyspark.sql import functions as F
from query_catalog import line_rules

LINEITEM = "/root/testdata/sf0.001/lineitem.parquet"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def lines(spark):
    return spark.read.parquet(LINEITEM)


def test_rules_of_a_table_share_a_scan_of_their_columns(lines):
    checks = [build(lines, spec) for spec, _, _ in line_rules()]
    assert len(checks) == 20
    counted = plan(raw_counts(lines, checks))
    assert counted.count("FileScan") == 1 and "l_partkey" not in counted
    failing = plan(exception_rows(lines, checks))
    assert failing.count("FileScan") == 1 and "Exchange" not in failing


def test_many_rules_need_one_scan_per_group(lines):
    rules = [rule(BETWEEN, {"column": "l_tax", "max_value": i}, "l_tax", ("l_orderkey",), i) for i in range(1, 101)]
    checks = [build(lines, spec) for spec in rules]
    assert plan(raw_counts(lines, checks)).count("FileScan") == -(-100 // COUNTERS_PER_SCAN)
    assert plan(exception_rows(lines, checks)).count("FileScan") == 1
    assert raw_counts(lines, checks).count() == 100


def test_predicates_reach_the_scan(lines):
    spec = rule(
        BETWEEN, {"column": "l_linenumber", "min_value": 2, "max_value": 5}, "l_linenumber", ("l_orderkey",),
        condition="l_quantity > 25",
    )
    pushed = plan(exception_rows(lines, [build(lines, spec)]))
    assert "GreaterThan(l_quantity,25.0)" in pushed
    assert "Or(LessThan(l_linenumber,2),GreaterThan(l_linenumber,5))" in pushed
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int,l_quantity:double>" in pushed


def test_no_single_task_over_exceptions(spark, lines):
    specs = [
        rule(BETWEEN, {"column": "l_tax", "max_value": 0.01}, "l_tax", ("l_orderkey",), 1, table="l"),
        rule(UNIQUE, {"column": "l_orderkey"}, "l_tax", ("l_orderkey",), 2, table="l"),
    ]
    first = run(spark, specs, {"l": lines})
    ledger = first.staging.put(first.exceptions, "ledger")
    result = run(spark, specs, {"l": lines}, ledger=ledger, execution_key=2)
    text = plan(result.exceptions)
    # The only unpartitioned window numbers files: below it are counts per file.
    for piece in text.split("Window [")[1:]:
        below = piece.splitlines()[1:5]
        assert any("_numbering_file" in line for line in below)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_regex_and_sets_stay_in_generated_code(lines):
    specs = [
        rule(REGEX, {"column": "l_returnflag", "regex": "^A"}, "l_returnflag", ("l_orderkey",), 1),
        rule(IN_SET, {"column": "l_linestatus", "value_set": ["F"]}, "l_linestatus", ("l_orderkey",), 2),
    ]
    failing = exception_rows(lines, [build(lines, spec) for spec in specs])
    steps = [line for line in plan(failing).splitlines() if line.strip(" :+-")]
    assert all("*(" in line for line in steps if "FileScan" not in line and "ColumnarToRow" not in line)


def test_keyed_rules_of_a_table_share_a_scan(spark):
    df = spark.range(200).select("id", *[(F.col("id") % (50 + k)).alias(f"c{k}") for k in range(8)]).cache()
    codes = spark.range(0, 60, 2).select(F.col("id").alias("code"))
    specs = [rule(UNIQUE, {"column": f"c{k}"}, f"c{k}", rule_key=k + 1, condition="id < 150") for k in range(6)]
    specs += [rule(IN_SET, {"column": f"c{k}", "value_set": "ref.code"}, f"c{k}", rule_key=k + 1) for k in (6, 7)]
    staging, read = Staging(spark), []
    _, rows = check_table(df, specs, lambda name: read.append(name) or codes, TODAY, staging)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("InMemoryTableScan") == 1 and "SortMergeJoin" not in plan
    assert sum("members" in path for path in os.listdir(staging.path.removeprefix("file:"))) == 1
    apart = {(r.rule_key, r.exception_row_pk) for spec in specs for r in check_table(df, [spec], lambda _: codes, TODAY, Staging(spark))[1].collect()}
    assert {(r.rule_key, r.exception_row_pk) for r in rows.collect()} == apart and len(apart) > 500
    df.unpersist()
