"""The workflow over catalog tables, and the store's sinks."""

from datetime import date, datetime
from types import SimpleNamespace

import pytest
from plumbline import run_workflow
from plumbline.operators.upsert import COALESCE, OVERWRITE, merge_statement
from plumbline.plans.workflow import run_stored_rules, update_rule_types, update_rules
from plumbline.schemas import DQ_RULE
from plumbline.sources import catalog
from plumbline.sources.staging import Staging, staging_root
from plumbline.sources.store import Store, create_statement, insert_statement
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

BRONZE_TYPES = [
    (1, "not null", "completeness", "ExpectColumnValuesToNotBeNull", True),
    (2, "range", "validity", "expect_column_values_to_be_between", True),
    (3, "old", "validity", "Gone", False),
]
RULE_COLUMNS = (
    "rule_no int, table_name string, column string, data_domain string, rule_type_key int, table_key string, "
    "gx_arguments string, gx_conditions string, rule_enabled string, current_flag boolean"
)
BRONZE_RULES = [
    (1, "people", "age", "hr", 2, "id", '{"column": "age", "min_value": 0, "max_value": 120}', None, "Y", True),
    (2, "people", "name", "hr", 1, "id", '{"column": "name"}', "age >= 0", "Y", True),
    (3, "people", "name", "hr", 1, "id", '{"column": "name"}', None, "N", True),
    (4, "people", "name", "hr", 1, "id", '{"column": "name"}', None, "Y", False),
]


@pytest.fixture
def schema(spark, request):
    name = f"dq_{abs(hash(request.node.name)) % 10**8}"
    spark.sql(f"CREATE DATABASE {name}")
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def save_types(spark, schema, rows):
    types = spark.createDataFrame(
        rows, "rule_type_key int, rule_type_name string, dq_dimension string, gx_expectation string, current_flag boolean"
    ).withColumns({
        "gx_description": F.lit("text"), "created_at_ts": F.current_timestamp(), "modified_at_ts": F.current_timestamp(),
    })
    types.write.mode("overwrite").saveAsTable(f"{schema}.bronze_types")


def save_rules(spark, schema, rows, name="bronze_rules_hr"):
    rules = spark.createDataFrame(rows, RULE_COLUMNS).withColumns({
        "catalog": F.lit("main"), "schema": F.lit(schema),
        "created_at_date": F.lit("01/02/2024"), "modified_at_date": F.lit("01/02/2024"),
        "start_date": F.lit("01/01/2024"), "expiry_date": F.lit("31/12/2024"), "threshold": F.lit(0.5),
    })
    rules.write.mode("overwrite").saveAsTable(f"{schema}.{name}")


def save_people(spark, schema, rows):
    spark.createDataFrame(rows, "id int, name string, age int").write.mode("overwrite").saveAsTable(f"{schema}.people")


def test_three_runs_over_catalog_tables(spark, schema):
    save_types(spark, schema, BRONZE_TYPES)
    save_rules(spark, schema, BRONZE_RULES)
    save_people(spark, schema, [(1, "a", 30), (2, None, 300), (3, None, -5), (4, "d", 121)])
    store = Store(spark, schema)
    tables = catalog.rule_tables(spark, schema, "bronze_rules")
    assert tables == [f"{schema}.bronze_rules_hr"]
    result, selection = run_workflow(
        spark, tables, f"{schema}.bronze_types", schema=schema,
        today=date(2024, 6, 1), run_ts=datetime(2024, 6, 1),
    )
    assert [(s.rule_key, s.check) for s in selection.specs] == [
        (1, "ExpectColumnValuesToBeBetween"), (2, "ExpectColumnValuesToNotBeNull"),
    ]
    assert [row["reason"] for row in selection.skipped.collect()] == ["disabled"]
    # Rule 3 of the source became rule key 3; the outdated source row is no rule.
    assert store.table(store.rules).count() == 3 and store.table(store.rule_types).count() == 2

    save_people(spark, schema, [(1, None, 30), (2, "b", 300), (3, "c", 5), (4, "d", 121)])
    # A changed rule keeps its key; a new one gets the next.
    changed = [(2, "people", "name", "hr", 1, "id", '{"column": "name"}', "age >= 1", "Y", True),
               (9, "people", "id", "hr", 2, "id", '{"column": "id", "max_value": 3}', None, "Y", True)]
    save_rules(spark, schema, changed)
    staging = Staging(spark)
    update_rules(store, tables, staging)
    assert {r["integration_id"]: r["rule_key"] for r in store.table(store.rules).collect()} == {
        "people~age~1~hr": 1, "people~name~2~hr": 2, "people~name~3~hr": 3, "people~id~9~hr": 4,
    }
    run_stored_rules(store, today=date(2024, 6, 2), run_ts=datetime(2024, 6, 2))
    run_stored_rules(store, today=date(2024, 6, 3), run_ts=datetime(2024, 6, 3), assets=[f"main-{schema}-people"])
    run_stored_rules(store, today=date(2024, 6, 3), run_ts=datetime(2024, 6, 3), assets=["main-x-other"])

    rows = store.table(store.exceptions).orderBy("exception_key").collect()
    assert [row["exception_key"] for row in rows] == list(range(1, len(rows) + 1))
    found = sorted(
        (r["execution_key"], r["rule_key"], r["exception_row_pk"], r["new_exception_flag"], r["fixed_exception_flag"])
        for r in rows
    )
    assert found == sorted([
        (1, 1, "2", True, False), (1, 1, "3", True, False), (1, 1, "4", True, False), (1, 2, "2", True, False),
        (2, 1, "2", False, False), (1, 1, "3", False, True), (2, 1, "4", False, False),
        (2, 2, "1", True, False), (1, 2, "2", False, True), (2, 4, "4", True, False),
        (3, 1, "2", False, False), (3, 1, "4", False, False), (3, 2, "1", False, False), (3, 4, "4", False, False),
    ])
    validations = store.table(store.validations)
    keys = [tuple(r) for r in validations.select("validation_key", "rule_key", "execution_key").orderBy("validation_key").collect()]
    assert keys == [(1, 1, 1), (2, 2, 1), (3, 1, 2), (4, 2, 2), (5, 4, 2), (6, 1, 3), (7, 2, 3), (8, 4, 3)]
    assert {r["integration_id"] for r in validations.filter("execution_key = 1").collect()} == {"1~1", "2~1"}
    plan = store.table(store.exceptions).filter("execution_key = 2")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(execution_key" in plan


def test_a_run_that_broke_off_is_not_repeated(spark, schema):
    save_types(spark, schema, BRONZE_TYPES)
    save_rules(spark, schema, BRONZE_RULES)
    save_people(spark, schema, [(1, "a", 300)])
    store, staging = Store(spark, schema), Staging(spark)
    store.create()
    update_rule_types(store, f"{schema}.bronze_types", staging)
    update_rules(store, [f"{schema}.bronze_rules_hr"], staging)
    append, store.append = store.append, lambda df, name: append(df, name) if name == store.exceptions else None
    run_stored_rules(store, today=date(2024, 6, 1), run_ts=datetime(2024, 6, 1))
    store.append = append
    result, _ = run_stored_rules(store, today=date(2024, 6, 2), run_ts=datetime(2024, 6, 2))
    assert result.execution_key == 2
    rows = store.table(store.exceptions).orderBy("exception_key").collect()
    assert [(r["exception_key"], r["execution_key"], r["new_exception_flag"]) for r in rows] == [(1, 1, True), (2, 2, False)]
    assert rows[1]["validation_key"] > rows[0]["validation_key"]


def test_rule_types_source(spark, schema):
    store, staging = Store(spark, schema), Staging(spark)
    store.create()
    assert not update_rule_types(store, f"{schema}.no_such_table", staging)
    save_types(spark, schema, BRONZE_TYPES[2:])
    with pytest.raises(ValueError):
        update_rule_types(store, f"{schema}.bronze_types", staging)
    save_types(spark, schema, BRONZE_TYPES)
    assert update_rule_types(store, f"{schema}.bronze_types", staging)
    ids = {row["integration_id"] for row in store.table(store.rule_types).collect()}
    assert ids == {"1~ExpectColumnValuesToNotBeNull", "2~expect_column_values_to_be_between"}
    update_rules(store, [], staging)


@pytest.mark.parametrize("mode, steward", [(OVERWRITE, None), (COALESCE, "old")])
def test_upsert_modes(spark, schema, mode, steward):
    store, staging = Store(spark, schema), Staging(spark)
    store.create()

    def rows(*pairs):
        return spark.createDataFrame(list(pairs), "integration_id string, rule_key long, it_steward string")

    store.upsert(rows(("a", 1, "old"), ("b", 2, "kept")), store.rules, "integration_id", DQ_RULE, staging, mode)
    store.upsert(rows(("a", 1, None), ("c", 3, "new")), store.rules, "integration_id", DQ_RULE, staging, mode)
    found = {row["integration_id"]: row["it_steward"] for row in store.table(store.rules).collect()}
    assert found == {"a": steward, "b": "kept", "c": "new"}
    with pytest.raises(ValueError):
        store.upsert(rows(("d", 4, "x"), ("d", 5, "y")), store.rules, "integration_id", DQ_RULE, staging, mode)


def test_reset_and_unknown_kinds(spark, schema):
    store = Store(spark, schema)
    store.create()
    store.create()
    row = spark.sql("SELECT 1 AS exception_key, 1 AS execution_key")
    store.append(row, store.exceptions)
    assert store.table(store.exceptions).first()["exception_key"] == 1
    store.reset_ledger()
    assert store.table(store.exceptions).isEmpty()
    store.reset_ledger(drop=True)
    assert not spark.catalog.tableExists(store.exceptions)
    with pytest.raises(ValueError):
        Store(spark, schema, "csv")
    with pytest.raises(ValueError):
        run_stored_rules(store, previous="sometime")
    assert catalog.asset_table(catalog.HIVE, "c", "s", "t") == "s.t"
    assert catalog.asset_table(catalog.DELTA, "c", "s", "t") == "c.s.t"
    with pytest.raises(ValueError):
        catalog.asset_table("Kafka", "c", "s", "t")


def test_merge_statement_names_every_column():
    assert merge_statement("s.t", "v", "k", ["k", "a"]) == (
        "MERGE INTO s.t AS target USING v AS source ON target.`k` = source.`k` "
        "WHEN MATCHED THEN UPDATE SET target.`k` = source.`k`, target.`a` = source.`a` "
        "WHEN NOT MATCHED THEN INSERT (`k`, `a`) VALUES (source.`k`, source.`a`)"
    )


def test_generated_keys_are_never_written(spark):
    """The texts of statements for tables that number their rows themselves (such tables cannot be made here)."""
    store = Store(spark, "s", "delta")
    assert store.written("s.dq_rule", ["rule_key", "a"]) == ["a"] and store.written("s.dq_validations", ["validation_key"]) == ["validation_key"]
    assert insert_statement("s.dq_exceptions", "v", store.written("s.dq_exceptions", ["exception_key", "a", "b"])) == (
        "INSERT INTO s.dq_exceptions (`a`, `b`) SELECT `a`, `b` FROM v"
    )
    small = StructType([StructField("rule_key", LongType()), StructField("a", StringType())])
    assert create_statement("s.dq_rule", small, "delta", None, store.identity("s.dq_rule")) == (
        "CREATE TABLE IF NOT EXISTS s.dq_rule (`rule_key` bigint GENERATED ALWAYS AS IDENTITY (START WITH 1 INCREMENT BY 1), `a` string) USING delta"
    )
    assert Store(spark, "s").identity("s.dq_rule") is None and Store(spark, "s", "delta", generated_keys=False).identity("s.dq_rule") is None


def test_appended_rows_keep_the_contract_of_their_table(spark, schema):
    store = Store(spark, schema, enforce=True)
    store.create()
    given = (
        "SELECT 1L AS exception_key, 1L AS validation_key, 2L AS rule_key, 3 AS execution_key, '7' AS exception_row_pk, 'x' AS exception_row_value, "
        "false AS fixed_exception_flag, true AS new_exception_flag, false AS row_delete_flag, CAST(NULL AS TIMESTAMP) AS created_at_ts, "
        "TIMESTAMP'2024-01-01' AS modified_at_ts"
    )
    store.append(spark.sql(given), store.exceptions)
    row = store.table(store.exceptions).first()
    assert row["integration_id"] == "7~2024-01-01 00:00:00" and row["created_at_ts"].year >= 2024
    for column in ("rule_key", "exception_row_pk", "row_delete_flag"):
        with pytest.raises(Exception, match=f"dq_exceptions.{column} must not be null"):
            store.append(spark.sql(given).withColumn(column, F.lit(None)), store.exceptions)
    with pytest.raises(Exception, match="dq_validations.validation_key must not be null"):
        store.append(spark.sql("SELECT 1L AS rule_key"), store.validations)
    assert store.table(store.exceptions).count() == 1 and store.table(store.validations).isEmpty()
    text = create_statement("s.dq_rule", DQ_RULE, "delta", None, "rule_key")
    assert "`rule_no` int NOT NULL" in text and "`it_steward` string," in text and "IDENTITY (START WITH 1 INCREMENT BY 1)," in text


def test_staging_needs_a_shared_folder_and_can_be_cleared(spark, tmp_path):
    staging = Staging(spark)
    assert staging.path.startswith(spark.conf.get("spark.checkpoint.dir"))
    staged = staging.put(spark.range(3), "numbers")
    assert staged.count() == 3
    staging.clear()
    with pytest.raises(Exception):
        spark.read.parquet(staging.path).count()


def test_command_line(spark, schema, capsys):
    from plumbline.__main__ import main

    save_types(spark, schema, BRONZE_TYPES)
    broken = (5, "people", "name", "hr", 1, "id", "{", None, "Y", True)
    rules = spark.createDataFrame(BRONZE_RULES + [broken], RULE_COLUMNS)
    save_rules(spark, schema, rules.collect())
    save_people(spark, schema, [(1, "a", 300)])
    late = spark.table(f"{schema}.bronze_rules_hr").withColumn("expiry_date", F.lit("31/12/9999"))
    late.write.saveAsTable(f"{schema}.bronze_rules_late")
    main(["--schema", schema, "--rules-like", "rules_late", "--rule-types", f"{schema}.bronze_types"])
    lines = capsys.readouterr().out.splitlines()
    assert lines[0] == "run 1: 2 rules"
    assert lines[1].startswith("rule ") and "(bad_arguments)" in lines[1]
    assert Store(spark, schema).table(f"{schema}.dq_exceptions").count() == 1
    main(["--schema", schema])  # the stored rules, without sources
    assert capsys.readouterr().out.splitlines()[0] == "run 2: 2 rules"
    assert Store(spark, schema).table(f"{schema}.dq_exceptions").count() == 2


def test_a_cluster_without_a_shared_folder_is_refused(tmp_path):
    def session(master, folder):
        context = SimpleNamespace(master=master, getCheckpointDir=lambda: folder)
        return SimpleNamespace(conf=SimpleNamespace(get=lambda name, default: default), sparkContext=context)

    with pytest.raises(ValueError):
        staging_root(session("yarn", None))
    assert staging_root(session("yarn", "hdfs:/shared/")) == "hdfs:/shared"
