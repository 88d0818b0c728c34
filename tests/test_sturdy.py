"""Values of unlike types, unsuitable arguments, bad source rows, and runs that broke off."""

from datetime import date, datetime

import pytest
from helpers import BETWEEN, COMPOUND, IN_SET, NOT_IN_SET, PAIR, REGEX, SQL, TODAY, bad_ids, rule
from plumbline.operators.checks import CHECKS
from plumbline.operators.evaluate import evaluate
from plumbline.plans.workflow import run_stored_rules, update_rules
from plumbline.sources.staging import Staging
from plumbline.sources.store import Store
from pyspark.sql import functions as F
from test_workflow import BRONZE_RULES, BRONZE_TYPES, save_people, save_rules, save_types, schema  # noqa: F401
from plumbline.plans.workflow import update_rule_types


@pytest.mark.parametrize("kind, values, members, member_kind", [
    ("int", ["1", "2", "3"], ["1.7", "2.0"], "double"),
    ("int", ["1", "2", "3"], ["1.7", "2.0", "3"], "decimal(5,1)"),
    ("int", ["1", "2"], ["5000000000", "2"], "long"),
    ("float", ["0.1", "0.05", "0.2"], ["0.1", "0.05"], "double"),
    ("decimal(6,2)", ["1.23", "2.50"], ["1.234", "2.5"], "double"),
    ("int", ["1", "2"], ["1", "x"], "string"),
])
def test_list_and_table_of_members_agree(spark, kind, values, members, member_kind):
    df = spark.createDataFrame([(k, v) for k, v in enumerate(values)], "id int, x string").withColumn("x", F.col("x").cast(kind))
    table = spark.createDataFrame([(m,) for m in members], "m string").select(F.col("m").try_cast(member_kind).alias("m"))
    listed = [r.m if isinstance(r.m, (int, float, str)) else float(r.m) for r in table.collect() if r.m is not None]
    if member_kind == "string":
        listed = [m for m in listed if m.isdigit()]
    for check in (IN_SET, NOT_IN_SET):
        by_list = bad_ids(df, rule(check, {"column": "x", "value_set": listed}))
        assert by_list == bad_ids(df, rule(check, {"column": "x", "value_set": "ref.m"}), {"ref": table})


def test_times_are_no_members_of_dates(spark):
    df = spark.createDataFrame([(1, date(2024, 1, 1)), (2, date(2024, 1, 2))], "id int, x date")
    moments = spark.createDataFrame([(datetime(2024, 1, 1, 10),), (datetime(2024, 1, 2),)], "m timestamp")
    assert bad_ids(df, rule(IN_SET, {"column": "x", "value_set": "ref.m"}), {"ref": moments}) == [1]


def test_float_columns_meet_float_bounds(spark):
    df = spark.createDataFrame([(1, 0.1), (2, 0.05), (3, 0.3)], "id int, x double").withColumn("x", F.col("x").cast("float"))
    assert bad_ids(df, rule(BETWEEN, {"column": "x", "max_value": 0.1})) == [3]
    assert bad_ids(df, rule(IN_SET, {"column": "x", "value_set": [0.1, 0.05]})) == [3]


ARGUMENTS = {  # fixed values: the arguments of all checks
    "column", "column_A", "column_B", "column_list", "regex", "regex_list", "match_on", "like_pattern", "min_value", "max_value",
    "strict_min", "strict_max", "or_equal", "ignore_row_if", "value_set", "unexpected_rows_query", "row_condition", "mostly", "store_exceptions",
}
SOUND = {
    "column": "x", "column_A": "x", "column_B": "id", "column_list": ["x", "id"], "regex": "a", "regex_list": ["a"], "like_pattern": "a",
    "min_value": 0, "value_set": [1], "unexpected_rows_query": "SELECT * FROM {batch}",
}


def test_no_argument_ends_a_run(spark):
    df = spark.createDataFrame([(1, 2.5)], "id int, x double")
    specs = []
    for check in CHECKS:
        for name in sorted(ARGUMENTS):
            for value in (None, True, 5, -1.5, "sNaN", "", "zz'", [], [[1], {"a": 2}], [None], {"a": [1]}):
                specs.append(rule(check, SOUND | {name: value}, rule_key=len(specs) + 1))
    found = evaluate(df, specs[::7], {}.__getitem__, TODAY, Staging(spark))
    assert len(found.errors) + len(found.counts) >= len(specs[::7]) and found.errors


@pytest.mark.parametrize("command", [
    "CREATE TABLE made_by_rule AS SELECT 1 AS id", "DROP TABLE IF EXISTS nothing", "SET a.b = c", "INSERT INTO t VALUES (1)", "SELECT 1; DROP TABLE t",
])
def test_commands_in_sql_rules_are_refused(spark, command):
    df = spark.createDataFrame([(1, 2.5)], "id int, x double")
    found = evaluate(df, [rule(SQL, {"unexpected_rows_query": command})], {}.__getitem__, TODAY, Staging(spark))
    assert set(found.errors) == {1} and not spark.catalog.tableExists("made_by_rule")
    sound = rule(SQL, {"unexpected_rows_query": "WITH w AS (SELECT * FROM {batch}) SELECT * FROM w -- all ;\n;"})
    assert bad_ids(df, sound) == [1]


def test_one_bad_source_row_is_reported(spark, schema):  # noqa: F811
    store = Store(spark, schema)
    store.create()
    save_rules(spark, schema, BRONZE_RULES)
    texts = spark.table(f"{schema}.bronze_rules_hr").select("*").select([F.col(c).cast("string") for c in spark.table(f"{schema}.bronze_rules_hr").columns])
    header = spark.createDataFrame([tuple(c if c != "current_flag" else "true" for c in texts.columns)], texts.schema)
    texts.union(header).write.saveAsTable(f"{schema}.bronze_text")
    rejected = update_rules(store, [f"{schema}.bronze_text"], Staging(spark))
    assert [(r.rule_key, r.reason) for r in rejected.collect()] == [(None, "bad_source_row")]
    assert sorted(r.rule_no for r in store.table(store.rules).collect()) == [1, 2, 3]


class Broken(Exception):
    pass


@pytest.mark.parametrize("previous", ["last_run", "last_evaluated"])
@pytest.mark.parametrize("second", [[(1, "a", 500), (2, "b", 7), (4, "d", -1)], [(1, "a", 20), (2, "b", 7)]])
def test_a_run_that_broke_off_is_not_repeated(spark, schema, previous, second, monkeypatch):  # noqa: F811
    """Its exceptions are stored, its validations are not; with some new rows, or with fixed rows only."""
    store = Store(spark, schema)
    store.create()
    save_types(spark, schema, BRONZE_TYPES)
    save_rules(spark, schema, BRONZE_RULES)
    update_rule_types(store, f"{schema}.bronze_types", Staging(spark))
    update_rules(store, [f"{schema}.bronze_rules_hr"], Staging(spark))
    options = {"today": date(2024, 5, 1), "previous": previous}

    def go(day, people):
        save_people(spark, schema, people)
        return run_stored_rules(store, run_ts=datetime(2024, 5, day), **options)

    go(1, [(1, "a", 500), (2, "b", 7), (3, "c", -5)])
    append = store.append
    monkeypatch.setattr(store, "append", lambda df, name: append(df, name) if name == store.exceptions else (_ for _ in ()).throw(Broken))
    with pytest.raises(Broken):
        go(2, second)
    monkeypatch.setattr(store, "append", append)
    before = store.table(store.exceptions).count()
    go(3, second)
    added = store.table(store.exceptions).filter(F.col("modified_at_ts") >= datetime(2024, 5, 3))
    assert added.filter("new_exception_flag OR fixed_exception_flag").count() == 0
    assert store.table(store.exceptions).count() - before == sum(age > 120 or age < 0 for *_, age in second)
    keys = [r[0] for r in store.table(store.exceptions).select("exception_key").collect()]
    assert len(set(keys)) == len(keys)
