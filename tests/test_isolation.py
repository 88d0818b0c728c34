"""One rule never ends a run, conditions with subqueries, and uniqueness of many rules in one pass."""

import os

import pytest
from helpers import BETWEEN, COMPOUND, IN_SET, NOT_IN_SET, NOT_NULL, SQL, TODAY, UNIQUE, bad_ids, build, check_one, kinds, ledger_of, rule, run
from plumbline.operators.checks import has_subquery, packed_key, repeated_of_all
from plumbline.operators.evaluate import check_table, evaluate_all
from plumbline.sources.staging import Staging
from pyspark.sql import functions as F


@pytest.fixture(scope="module")
def table(spark):
    """``bad_key`` and ``bad_text`` fail when they are read, which counting the rules below never does."""
    df = spark.range(1, 41).withColumns({f"c{k}": (F.col("id") * (k + 3)) % 17 for k in range(8)})
    broken = F.when(F.col("id") == 5, F.raise_error(F.lit("no such row"))).otherwise(F.col("id"))
    return df.withColumns({"bad_key": broken, "bad_text": (F.lit(1) / (F.col("id") - 9)).cast("string")})


def rules_of(breaking):
    specs = [rule(BETWEEN, {"column": f"c{k}", "max_value": 12}, f"c{k}", rule_key=k + 1) for k in range(6)]
    specs += [rule(UNIQUE, {"column": f"c{k}"}, f"c{k}", rule_key=k + 1) for k in (6, 7)]
    if breaking:
        specs += [rule(BETWEEN, {"column": "c0", "max_value": 12}, "c0", ("bad_key",), 9), rule(UNIQUE, {"column": "c1"}, "bad_text", rule_key=10)]
    return specs


def test_rules_that_fail_when_their_rows_are_made(spark, table):
    sound = run(spark, rules_of(False), {"t": table})
    result = run(spark, rules_of(True), {"t": table})
    errors = {row["rule_key"]: row for row in result.errors.collect()}
    assert {key: row["reason"] for key, row in errors.items()} == {9: "runtime", 10: "runtime"}
    assert "no such row" in errors[9]["message"] and "DIVIDE_BY_ZERO" in errors[10]["message"]
    assert kinds(result) == kinds(sound) and len(kinds(result)) > 40
    keys = sorted(row["exception_key"] for row in result.exceptions.collect())
    assert keys == list(range(1, len(keys) + 1))
    validations = {row["rule_key"]: row for row in result.validations.collect()}
    assert len(validations) == 10
    for key in (9, 10):
        assert not validations[key]["success_flag"] and validations[key]["element_count"] == validations[key]["exception_count"] == 0


def test_such_a_rule_changes_nothing_in_the_ledger(spark, table):
    fine = table.withColumn("bad_key", F.col("id"))
    specs = [rule(BETWEEN, {"column": "c0", "max_value": 12}, "c0", ("bad_key",), 1), rule(BETWEEN, {"column": "c1", "max_value": 12}, "c1", rule_key=2)]
    first = run(spark, specs, {"t": fine})
    second = run(spark, specs, {"t": table}, ledger=ledger_of(first), execution_key=2)
    assert {key for key, _ in kinds(first)} == {1, 2}
    assert {kind for (key, _), kind in kinds(second).items() if key == 2} == {"known"}
    assert not [key for key, _ in kinds(second) if key == 1]
    # A rule that passes as a whole is looked at again, and breaks there.
    loose = [rule(BETWEEN, {"column": "c0", "max_value": 12, "mostly": 0.1}, "c0", ("bad_key",), 1), specs[1]]
    third = run(spark, loose, {"t": table}, ledger=ledger_of(first), execution_key=2)
    assert [row["rule_key"] for row in third.errors.collect()] == [1]
    assert not [key for key, _ in kinds(third) if key == 1]


def test_two_tables_one_of_which_breaks(spark, table):
    specs = [rule(BETWEEN, {"column": "c0", "max_value": 12}, "c0", ("bad_key",), 1, table="a"), rule(BETWEEN, {"column": "c0", "max_value": 12}, "c0", rule_key=2, table="b")]
    result = run(spark, specs, {"a": table, "b": table})
    assert [row["rule_key"] for row in result.errors.collect()] == [1]
    assert {key for key, _ in kinds(result)} == {2}


# --- conditions with subqueries -----------------------------------------------------------------


@pytest.mark.parametrize("condition, found", [
    ("id IN (SELECT 1)", True), ("EXISTS ( select 1 from t)", True), ("x = (WITH a AS (SELECT 1) SELECT * FROM a)", True),
    ("id IN (VALUES (1), (2))", True), ("id IN (1, 2)", False), ("name = '(select 1)'", False), ("`(select x)` = 1", False),
    ("a = 'it''s' AND (selected = 1)", False), ("", False),
])
def test_conditions_with_subqueries_are_told_apart(condition, found):
    assert has_subquery(condition) is found


@pytest.fixture(scope="module")
def odd(spark):
    spark.createDataFrame([(k,) for k in range(1, 41, 2)], "k long").createOrReplaceTempView("odd_numbers")
    yield "odd_numbers"
    spark.catalog.dropTempView("odd_numbers")


@pytest.mark.parametrize("condition", [
    "id IN (SELECT k FROM odd_numbers)", "EXISTS (SELECT 1 FROM odd_numbers WHERE k = id)", "id NOT IN (SELECT k + 1 FROM odd_numbers)",
    "id % 2 = (SELECT max(k % 2) FROM odd_numbers)", "id IN (SELECT k FROM odd_numbers) AND c0 >= 0",
])
def test_rows_in_a_scope_of_a_subquery(spark, table, odd, condition):
    plain = "id % 2 = 1"
    specs = [
        rule(BETWEEN, {"column": "c0", "max_value": 9}, "c0", rule_key=1), rule(UNIQUE, {"column": "c1"}, "c1", rule_key=2),
        rule(COMPOUND, {"column_list": ["c2", "c3"]}, None, rule_key=3), rule(IN_SET, {"column": "c4", "value_set": [1, 2, 3]}, "c4", rule_key=4),
        rule(SQL, {"unexpected_rows_query": "SELECT * FROM {batch} WHERE c5 > 10"}, "c5", rule_key=5),
    ]
    good = table.drop("bad_key", "bad_text")
    answers = []
    for scope in (condition, plain):
        scoped = [rule(s.check, s.arguments, s.column, rule_key=s.rule_key, condition=scope) for s in specs]
        measures, rows = check_table(good, scoped, {}.__getitem__, TODAY, Staging(spark))
        result = run(spark, [*scoped, rule(NOT_NULL, {"column": "c0"}, "c0", rule_key=6)], {"t": good})
        assert result.errors.isEmpty()
        validations = sorted(map(str, result.validations.drop("created_at_ts", "modified_at_ts").collect()))
        answers.append((sorted(map(tuple, rows.collect()), key=str), sorted(map(str, measures.collect())), kinds(result), validations))
    assert answers[0] == answers[1] and answers[0][0]


def test_a_broken_subquery_concerns_its_rules_alone(spark, table):
    specs = [rule(BETWEEN, {"column": "c0", "max_value": 9}, "c0", rule_key=k, condition="id IN (SELECT k FROM nowhere)") for k in (1, 2)]
    specs.append(rule(BETWEEN, {"column": "c1", "max_value": 9}, "c1", rule_key=3))
    parts = evaluate_all(table, specs, {}.__getitem__, TODAY, Staging(spark))
    assert [sorted(part.errors) for part in parts] == [[], [1, 2]] and [part.table_count for part in parts] == [40, 40]
    only = evaluate_all(table, specs[:2], {}.__getitem__, TODAY, Staging(spark))
    assert only[0].table_count == 40 and sorted(only[1].errors) == [1, 2]


# --- values without equality --------------------------------------------------------------------


def test_uniqueness_of_maps_and_variants(spark):
    df = spark.sql("""
        SELECT * FROM VALUES
          (1, map('a', 1, 'b', 2), parse_json('{"x": 1, "y": [2]}'), named_struct('m', map(1, 'p'))),
          (2, map('b', 2, 'a', 1), parse_json('{"y": [2], "x": 1}'), named_struct('m', map(1, 'q'))),
          (3, map('a', 1), parse_json('{"x": 1}'), named_struct('m', map(1, 'p'))),
          (4, map('a', 1, 'b', CAST(NULL AS INT)), parse_json('[1]'), NULL),
          (5, CAST(NULL AS MAP<STRING, INT>), NULL, named_struct('m', CAST(NULL AS MAP<INT, STRING>))),
          (6, CAST(NULL AS MAP<STRING, INT>), NULL, named_struct('m', CAST(NULL AS MAP<INT, STRING>)))
        AS t(id, m, v, s)""")
    assert bad_ids(df, rule(UNIQUE, {"column": "m"}, "id")) == [1, 2]
    assert bad_ids(df, rule(UNIQUE, {"column": "v"}, "id")) == [1, 2]
    assert bad_ids(df, rule(UNIQUE, {"column": "s"}, "id")) == [1, 3, 5, 6]
    assert bad_ids(df, rule(COMPOUND, {"column_list": ["m", "s"], "ignore_row_if": "never"}, "id")) == [5, 6]
    specs = [rule(UNIQUE, {"column": "m"}, "m", rule_key=1), rule(IN_SET, {"column": "m", "value_set": ["a"]}, "m", rule_key=2), rule(UNIQUE, {"column": "id"}, "id", rule_key=3)]
    result = run(spark, specs, {"t": df})
    assert {key for key, _ in kinds(result)} == {1} and [row["rule_key"] for row in result.errors.collect()] == [2]


# --- many uniqueness rules ----------------------------------------------------------------------


def test_ten_uniqueness_rules_need_one_scan_to_find_bad_keys(spark):
    lines = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    names = ["l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_returnflag", "l_shipdate"]
    specs = [rule(UNIQUE, {"column": name}, name, ("l_orderkey",), k) for k, name in enumerate(names, 1)]
    specs += [rule(COMPOUND, {"column_list": ["l_orderkey", "l_linenumber"]}, None, ("l_orderkey",), 9)]
    specs += [rule(COMPOUND, {"column_list": ["l_orderkey", "l_partkey", "l_shipdate"]}, None, ("l_orderkey",), 10, condition="l_quantity > 10")]
    plan = repeated_of_all(lines, [build(lines, spec) for spec in specs])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Exchange") == 1
    staging = Staging(spark)
    measures, rows = check_table(lines, specs, {}.__getitem__, TODAY, staging)
    assert sum("bad-keys" in path for path in os.listdir(staging.path.removeprefix("file:"))) == 1
    found = {row["rule_key"]: row["exception_count"] for row in measures.collect()}
    for spec in specs:
        alone, exceptions = check_one(lines, spec)
        assert found[spec.rule_key] == alone["exception_count"] == len(exceptions)
    assert {row["rule_key"]: row["count"] for row in rows.groupBy("rule_key").count().collect()} == {k: n for k, n in found.items() if n}


def test_packed_keys_are_equal_for_equal_keys_only(spark):
    df = spark.sql("""
        SELECT id, d, s, b, t, n FROM VALUES
          (1, 0.0D, 'ab', X'00', TIMESTAMP'2024-10-27 00:30:00Z', 1.50BD), (2, -0.0D, 'ab', X'00', TIMESTAMP'2024-10-27 00:30:00Z', 1.5BD),
          (3, double('NaN'), 'a', X'62', TIMESTAMP'2024-10-27 01:30:00Z', 1.51BD), (4, double('NaN'), 'a', X'62', TIMESTAMP'2024-10-27 01:30:00Z', 1.51BD),
          (5, 1e300D, repeat('x', 99), X'', NULL, NULL), (6, 1e-300D, repeat('x', 98), NULL, NULL, NULL), (7, 1e300D, repeat('x', 99), X'', NULL, NULL)
        AS q(id, d, s, b, t, n)""")
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Europe/Amsterdam")  # both times read 02:30 there
        for names in (["d"], ["s"], ["b"], ["t"], ["n"], ["d", "s", "b", "t", "n"], ["s", "b"]):
            packed = packed_key([F.col(name) for name in names], [df.schema[name].dataType for name in names])
            apart = {tuple(sorted(r[-1])) for r in df.groupBy(*names).agg(F.collect_list("id")).collect()}
            assert {tuple(sorted(r[-1])) for r in df.groupBy(packed).agg(F.collect_list("id")).collect()} == apart, names
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    specs = [rule(UNIQUE, {"column": c}, "id", rule_key=k) for k, c in enumerate("dsbtn", 1)]
    specs.append(rule(COMPOUND, {"column_list": ["b", "t"], "ignore_row_if": "never"}, "id", rule_key=6))
    _, rows = check_table(df, specs, {}.__getitem__, TODAY, Staging(spark))
    got = {}
    for row in rows.collect():
        got.setdefault(row["rule_key"], []).append(int(row["exception_row_pk"]))
    for spec in specs:
        assert sorted(got.get(spec.rule_key, [])) == bad_ids(df, spec)


# --- exact sets and names -----------------------------------------------------------------------


def test_whole_numbers_are_not_rounded_in_sets(spark):
    big = 9007199254740993
    df = spark.createDataFrame([(1, big - 1), (2, big), (3, 1), (4, None)], "id int, x long")
    for values, bad in [([1.5, big], [1, 3]), ([1.5], [1, 2, 3]), (["1.5", str(big), 1.0], [1]), ([1e30, 1], [1, 2])]:
        assert bad_ids(df, rule(IN_SET, {"column": "x", "value_set": values})) == bad
        assert bad_ids(df, rule(NOT_IN_SET, {"column": "x", "value_set": values})) == [k for k in (1, 2, 3) if k not in bad]
    decimals = df.select("id", F.col("x").cast("decimal(38, 2)").alias("x"))
    assert bad_ids(decimals, rule(BETWEEN, {"column": "x", "max_value": 1e50})) == []
    assert bad_ids(decimals, rule(BETWEEN, {"column": "x", "min_value": 1e50})) == [1, 2, 3]


def test_column_names_in_another_case(spark):
    df = spark.createDataFrame([(1, 5, 5), (2, 50, 5), (3, 50, None)], "ID int, X int, y int")
    for spec in (rule(BETWEEN, {"column": "x", "max_value": 9}, "x", ("id",)), rule(UNIQUE, {"column": "x"}, "x", ("Id",))):
        assert bad_ids(df, spec) == [2, 3]
    assert check_one(df, rule(COMPOUND, {"column_list": ["x", "Y"]}, "Y", ("id",), condition="id IN (SELECT 2)"))[0]["success_flag"]
    try:
        spark.conf.set("spark.sql.caseSensitive", "true")
        result = run(spark, [rule(BETWEEN, {"column": "x", "max_value": 9}, "x", ("ID",))], {"t": df})
        assert [row["reason"] for row in result.errors.collect()] == ["unknown_column"]
    finally:
        spark.conf.set("spark.sql.caseSensitive", "false")


def test_a_query_cannot_break_out_of_its_parentheses(spark):
    df = spark.createDataFrame([(1, 5)], "id int, x int")
    result = run(spark, [rule(SQL, {"unexpected_rows_query": "SELECT * FROM {batch}) t WHERE id IN (SELECT 1"}, "x")], {"t": df})
    assert [row["rule_key"] for row in result.errors.collect()] == [1]
