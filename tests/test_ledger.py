"""Histories of exceptions over several runs."""

from datetime import datetime

from helpers import BETWEEN, IN_SET, NOT_NULL, REGEX, kinds, ledger_of, rule, run
from pyspark.sql import functions as F


def table(spark, values):
    return spark.createDataFrame(list(values.items()), "id int, x int")


def between(low, high, **more):
    return rule(BETWEEN, {"column": "x", "min_value": low, "max_value": high, **more.pop("arguments", {})}, **more)


def counts(result, rule_key=1):
    row = result.validations.filter(F.col("rule_key") == rule_key).first()
    return tuple(row[f"{kind}_exception_count"] for kind in ("known", "new", "fixed"))


def test_new_known_fixed_reopened(spark):
    spec = between(0, 10)
    runs, ledger = [], None
    histories = [{1: 99, 2: 99, 3: 5}, {1: 99, 2: 5, 3: 99}, {1: 5, 2: 5, 3: 5}, {1: 99, 2: 5, 3: 5}]
    for number, values in enumerate(histories, 1):
        result = run(
            spark, [spec], {"t": table(spark, values)}, ledger=ledger, execution_key=number,
            run_ts=datetime(2024, 1, number), last_validation_key=number * 10,
            last_exception_key=ledger.count() if ledger else 0,
        )
        stored = ledger_of(result)
        ledger = stored if ledger is None else ledger.unionByName(stored)
        runs.append(result)
    assert [kinds(r) for r in runs] == [
        {(1, "1"): "new", (1, "2"): "new"},
        {(1, "1"): "known", (1, "2"): "fixed", (1, "3"): "new"},
        # All gone: everything open is fixed, though nothing fails any more.
        {(1, "1"): "fixed", (1, "3"): "fixed"},
        {(1, "1"): "new"},
    ]
    assert [counts(r) for r in runs] == [(0, 2, 0), (1, 1, 1), (0, 0, 2), (0, 1, 0)]
    keys = [row["exception_key"] for row in ledger.collect()]
    assert sorted(keys) == list(range(1, len(keys) + 1))
    known = runs[1].exceptions.filter("exception_row_pk = '1'").first()
    assert (known["created_at_ts"], known["modified_at_ts"]) == (datetime(2024, 1, 1), datetime(2024, 1, 2))
    assert (known["validation_key"], known["execution_key"]) == (21, 2)
    fixed = runs[1].exceptions.filter("exception_row_pk = '2'").first()
    assert (fixed["validation_key"], fixed["execution_key"], fixed["exception_row_value"]) == (21, 1, "99")
    assert (fixed["modified_at_ts"], fixed["new_exception_flag"]) == (datetime(2024, 1, 1), False)
    assert fixed["integration_id"] == "2~2024-01-01 00:00:00"


def test_previous_is_the_run_before_unless_given(spark):
    bad = table(spark, {1: 99})
    first = ledger_of(run(spark, [between(0, 10)], {"t": bad}))
    assert kinds(run(spark, [between(0, 10)], {"t": bad}, ledger=first, execution_key=3)) == {(1, "1"): "new"}
    again = run(spark, [between(0, 10)], {"t": bad}, ledger=first, execution_key=3, previous={1: 1})
    assert kinds(again) == {(1, "1"): "known"}


def test_repeated_row_keys_do_not_multiply(spark):
    df = spark.createDataFrame([(1, 99)] * 3 + [(2, 99)] * 2, "id int, x int")
    first = ledger_of(run(spark, [between(0, 10)], {"t": df}))
    second = run(spark, [between(0, 10)], {"t": df.filter("id = 1")}, ledger=first, execution_key=2)
    assert counts(second) == (3, 0, 2)
    flags = second.exceptions.groupBy("exception_row_pk", "fixed_exception_flag").count()
    assert {tuple(row) for row in flags.collect()} == {("1", False, 3), ("2", True, 2)}


def test_broken_and_unstored_rules_fix_nothing(spark):
    df = table(spark, {1: 99, 2: None})
    specs = [between(0, 10), rule(NOT_NULL, {"column": "x"}, rule_key=2)]
    first = ledger_of(run(spark, specs, {"t": df}))
    broken = [
        between(0, 10, condition="1 / (id - 1) > 0"),
        rule(NOT_NULL, {"column": "x", "store_exceptions": False}, rule_key=2),
    ]
    second = run(spark, broken, {"t": df}, ledger=first, execution_key=2)
    assert second.exceptions.count() == 0
    assert counts(second, 1) == counts(second, 2) == (0, 0, 0)
    rows = {row["rule_key"]: row for row in second.validations.collect()}
    assert (rows[1]["success_flag"], rows[1]["element_count"]) == (False, 0)
    assert (rows[2]["success_flag"], rows[2]["exception_count"]) == (False, 1)


def test_tolerated_rows_are_neither_exceptions_nor_fixed(spark):
    values = {i: 5 for i in range(8)} | {8: 99, 9: 99}
    first = ledger_of(run(spark, [between(0, 10)], {"t": table(spark, values)}))
    lenient = between(0, 10, arguments={"mostly": 0.5})
    second = run(spark, [lenient], {"t": table(spark, values | {9: 5})}, ledger=first, execution_key=2)
    assert kinds(second) == {(1, "9"): "fixed"}
    assert counts(second) == (0, 0, 1)
    assert second.validations.first()["success_flag"]


def test_one_broken_rule_does_not_spoil_the_others(spark):
    tables = {"t": spark.createDataFrame([(1, 5, "a"), (2, 50, "b")], "id int, x int, s string")}
    specs = [
        between(0, 10),
        rule(REGEX, {"column": "s", "regex": "("}, "s", rule_key=2),
        between(0, 10, rule_key=3, condition="cast(s AS int) > 0"),
        rule(IN_SET, {"column": "s", "value_set": ["a"]}, "s", rule_key=4),
        rule(IN_SET, {"column": "nope", "value_set": ["a"]}, "s", rule_key=5),
        between(0, 10, rule_key=6, condition="x >> > 1"),
        rule("NoSuchCheck", {}, rule_key=7),
        rule(BETWEEN, {"column": "x", "min_value": 1}, rule_key=8, table="missing"),
    ]

    def read(spec):
        return tables[spec.table] if spec.table in tables else spark.read.table("no_such_table")

    from helpers import RUN_TS, TODAY
    from plumbline import run_rules

    result = run_rules(spark, specs, read, tables.__getitem__, today=TODAY, run_ts=RUN_TS)
    assert kinds(result) == {(1, "2"): "new", (4, "2"): "new"}
    reasons = {row["rule_key"]: row["reason"] for row in result.errors.collect()}
    assert reasons == {
        2: "runtime", 3: "runtime", 5: "unknown_column", 6: "analysis", 7: "unknown_check", 8: "asset",
    }
    rows = {row["rule_key"]: row["validation_key"] for row in result.validations.collect()}
    # Rules that were never run have no validation, and leave no gap in the keys.
    assert rows == {1: 1, 2: 2, 3: 3, 4: 4, 5: 5, 6: 6}
