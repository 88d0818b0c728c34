"""Rule ingest, argument repair, activation."""

import json
from datetime import date, datetime

import pytest
from plumbline.functions import expressions as X
from plumbline.operators.align import align_to_schema
from plumbline.plans import rulebook as R
from plumbline.plans.workflow import select_rules
from plumbline.schemas import DQ_RULE
from pyspark.sql import functions as F

TEXTS = [
    ('{"column": "a"}', {"column": "a"}),
    ('  {"column": "a"}\n', {"column": "a"}),
    ('"{""column"": ""a"", ""min_value"": 1}"', {"column": "a", "min_value": 1}),
    ('{""column"": ""a""}', {"column": "a"}),
    (r'{"regex": "^\d{4}$"}', {"regex": r"^\d{4}$"}),
    (r'{"regex": "^\\d\w"}', {"regex": r"^\d\w"}),
    (r'{"regex": "\\\d"}', {"regex": r"\\d"}),
    (r'{"regex": "aA\"b"}', {"regex": 'aA"b'}),
    (r'{"regex": "\up"}', {"regex": r"\up"}),
    (r'"{""regex"": ""\s+""}"', {"regex": r"\s+"}),
    ('{"like_pattern": "", "regex": "é"}', {"like_pattern": "", "regex": "é"}),
    ('{"value_set": [1, "b", null], "mostly": 0.5}', {"value_set": [1, "b", None], "mostly": 0.5}),
    ("{column: a}", None),
    ('["a"]', None),
    ('"', None),
    ("", None),
    (None, None),
]


def test_arguments_are_repaired_only_where_needed(spark):
    df = spark.createDataFrame([(i, text) for i, (text, _) in enumerate(TEXTS)], "i int, t string")
    found = {row["i"]: row["j"] for row in df.select("i", X.arguments_json(F.col("t")).alias("j")).collect()}
    parsed = [None if found[i] is None else json.loads(found[i]) for i in range(len(TEXTS))]
    assert parsed == [expected for _, expected in TEXTS]


def test_names_and_keys(spark):
    df = spark.createDataFrame(
        [("expect_column_pair_values_a_to_be_greater_than_b", " a ,b,, c\t"), ("UnexpectedRowsExpectation", None)],
        "n string, k string",
    )
    rows = df.select(X.check_name(F.col("n")).alias("n"), X.key_columns(F.col("k")).alias("k")).collect()
    assert rows[0]["n"] == "ExpectColumnPairValuesAToBeGreaterThanB" and rows[0]["k"] == ["a", "b", "c"]
    assert rows[1]["n"] == "UnexpectedRowsExpectation" and rows[1]["k"] is None


def test_ingest_unites_sources_by_name(spark):
    columns = "table_name, column, rule_no, data_domain, current_flag, created_at_date, modified_at_date, start_date, expiry_date"
    names = columns.split(", ")
    first = spark.createDataFrame(
        [
            ("t", "c", 1, "d", True, "12/01/2023", "13/01/2023", "01/01/2023", "31/12/2023"),
            ("t", None, 2, "d", True, "12/01/2023", None, "2023-01-01", "bad"),
            ("t", "c", 3, "d", False, "12/01/2023", None, None, None),
            ("t", "c", None, "d", True, "12/01/2023", None, None, None),
            ("t", "c", 5, "d", True, None, None, None, None),
            ("t", "c", 6, "d", None, "12/01/2023", None, None, None),
        ],
        "table_name string, column string, rule_no int, data_domain string, current_flag boolean, "
        "created_at_date string, modified_at_date string, start_date string, expiry_date string",
    )
    second = first.filter("rule_no = 1").withColumn("data_domain", F.lit("e")).select(*reversed(names))
    rows = {row["integration_id"]: row for row in R.ingest_rules([first, second]).collect()}
    assert set(rows) == {"t~c~1~d", "t~2~d", "t~c~1~e"}
    row = rows["t~c~1~d"]
    assert (row["created_at_ts"], row["modified_at_ts"]) == (datetime(2023, 1, 12), datetime(2023, 1, 13))
    assert (row["start_date"], row["expiry_date"]) == (date(2023, 1, 1), date(2023, 12, 31))
    assert rows["t~2~d"]["start_date"] is None and rows["t~2~d"]["expiry_date"] is None
    assert "created_at_date" not in row.asDict()


def stored_rules(spark, rows):
    """Stored rules from (key, enabled, start, expiry, arguments, type)."""
    df = spark.createDataFrame(
        rows,
        "rule_key long, rule_enabled string, start_date string, expiry_date string, gx_arguments string, gx_expectation string",
    )
    return df.select(
        "*", F.col("rule_key").cast("string").alias("integration_id"), F.lit("m").alias("catalog"),
        F.lit("s").alias("schema"), F.lit("t").alias("table_name"), F.lit("c").alias("column"),
        F.lit("id").alias("table_key"), F.lit(None).cast("string").alias("gx_conditions"), F.lit(1).alias("rule_type_key"),
    ).withColumns({name: F.to_date(name) for name in ("start_date", "expiry_date")})


def test_selection_keeps_skipped_and_broken_rules_apart(spark):
    ok, null_check = '{"column": "c"}', "expect_column_values_to_not_be_null"
    rules = stored_rules(
        spark,
        [
            (1, "Y", "2024-01-01", "2024-01-01", ok, null_check),
            (2, "N", "2024-01-01", "2024-01-01", ok, null_check),
            (3, "Y", "2024-01-02", "2024-02-01", ok, null_check),
            (4, "Y", "2023-01-01", "2023-12-31", ok, null_check),
            (5, "Y", None, "2024-02-01", ok, null_check),
            (6, "Y", "2024-01-01", "2024-01-01", "nonsense", null_check),
            (7, "Y", "2024-01-01", "2024-01-01", ok, None),
            (8, None, "2024-01-01", "2024-01-01", ok, null_check),
        ],
    )
    selection = select_rules(rules, date(2024, 1, 1))
    assert [(s.rule_key, s.check, s.asset) for s in selection.specs] == [(1, "ExpectColumnValuesToNotBeNull", "m-s-t")]
    skipped = {row["rule_key"]: row["reason"] for row in selection.skipped.collect()}
    assert skipped == {2: "disabled", 3: "not_started", 4: "expired", 5: "no_dates", 8: "disabled"}
    errors = {row["rule_key"]: row["reason"] for row in selection.errors.collect()}
    assert errors == {6: "bad_arguments", 7: "unknown_check"}
    assert select_rules(rules, date(2024, 1, 1), ["m-s-other"]).specs == []


@pytest.mark.parametrize("schema", [DQ_RULE])
def test_align_adds_casts_orders_and_drops(spark, schema):
    df = spark.createDataFrame([("7", "x", 1)], "rule_key string, extra string, threshold int")
    aligned = align_to_schema(df, schema)
    assert [(f.name, f.dataType) for f in aligned.schema] == [(f.name, f.dataType) for f in schema]
    assert aligned.first()["rule_key"] == 7 and aligned.first()["threshold"] == 1.0
