"""Each check on a small table, nulls and edges included."""

import itertools

import pytest
from helpers import (
    BETWEEN, COMPOUND, IN_SET, LIKE, NOT_IN_SET, NOT_NULL, PAIR, REGEX, SQL, UNIQUE, bad_ids, build, check_one, rule,
)
from plumbline.spec import RuleError
from pyspark.sql import functions as F

ROWS = [
    (1, 5, 2.5, "apple", "2024-01-01"),
    (2, None, 0.5, "a", "2024-05-01"),
    (3, 5, None, None, "2024-05-02"),
    (4, 9, 2.5, "b_c", None),
    (5, 0, -1.0, "12", "2023-01-01"),
    (6, None, None, "apple", "2030-01-01"),
]


@pytest.fixture(scope="module")
def df(spark):
    rows = spark.createDataFrame(ROWS, "id int, x int, y double, s string, d string")
    return rows.withColumn("d", F.to_date("d"))


@pytest.mark.parametrize(
    "check, arguments, column, bad",
    [
        (NOT_NULL, {"column": "x"}, "x", [2, 6]),
        (BETWEEN, {"column": "x", "min_value": 1, "max_value": 5}, "x", [4, 5]),
        (BETWEEN, {"column": "x", "min_value": 0, "strict_min": True}, "x", [5]),
        (BETWEEN, {"column": "x", "max_value": 8.5}, "x", [4]),
        (BETWEEN, {"column": "x", "min_value": 0.5}, "x", [5]),
        (BETWEEN, {"column": "x", "max_value": 3_000_000_000}, "x", []),
        (BETWEEN, {"column": "x", "max_value": "5"}, "x", [4]),
        (BETWEEN, {"column": "y", "min_value": 0, "max_value": 2.5, "strict_max": True}, "y", [1, 4, 5]),
        (BETWEEN, {"column": "d", "max_value": "today"}, "d", [3, 6]),
        (BETWEEN, {"column": "d", "min_value": "2024-01-01", "max_value": "2024-05-01"}, "d", [3, 5, 6]),
        (BETWEEN, {"column": "s", "min_value": "a", "max_value": "b"}, "s", [4, 5]),
        (REGEX, {"column": "s", "regex": r"\d+|_"}, "s", [1, 2, 6]),
        ("ExpectColumnValuesToNotMatchRegex", {"column": "s", "regex": r"\d"}, "s", [5]),
        ("ExpectColumnValuesToMatchRegexList", {"column": "s", "regex_list": ["^a", "e$"]}, "s", [4, 5]),
        ("ExpectColumnValuesToMatchRegexList", {"column": "s", "regex_list": ["^a", "e$"], "match_on": "all"}, "s", [2, 4, 5]),
        (LIKE, {"column": "s", "like_pattern": "%p%"}, "s", [2, 4, 5]),
        (LIKE, {"column": "s", "like_pattern": r"_\_%"}, "s", [1, 2, 5, 6]),
        (IN_SET, {"column": "x", "value_set": [5, None]}, "x", [4, 5]),
        (IN_SET, {"column": "x", "value_set": ["5", "9"]}, "x", [5]),
        (IN_SET, {"column": "s", "value_set": ["apple", 12]}, "s", [2, 4]),
        (IN_SET, {"column": "x", "value_set": []}, "x", [1, 3, 4, 5]),
        (NOT_IN_SET, {"column": "x", "value_set": [5, None]}, "x", [1, 3]),
        (IN_SET, {"column": "d", "value_set": ["2024-01-01", "2030-01-01"]}, "d", [2, 3, 5]),
        (UNIQUE, {"column": "x"}, "x", [1, 3]),
        (UNIQUE, {"column": "s"}, "s", [1, 6]),
        (PAIR, {"column_A": "x", "column_B": "y"}, "x", [2, 3]),
        (PAIR, {"column_A": "x", "column_B": "y", "ignore_row_if": "neither"}, "x", [2, 3, 6]),
        (PAIR, {"column_A": "x", "column_B": "y", "ignore_row_if": "either_value_is_missing"}, "x", []),
        (COMPOUND, {"column_list": ["x", "y"]}, "x", []),
        (COMPOUND, {"column_list": ["x", "s"]}, "x", []),
    ],
)
def test_bad_rows(df, check, arguments, column, bad):
    assert bad_ids(df, rule(check, arguments, column)) == bad


@pytest.mark.parametrize("ignore, bad", [
    ("all_values_are_missing", [1, 2, 5, 6]), ("any_value_is_missing", [1, 2]), ("never", [1, 2, 3, 4, 5, 6]),
])
def test_compound_nulls_are_equal(spark, ignore, bad):
    rows = [(1, 1, "a"), (2, 1, "a"), (3, None, None), (4, None, None), (5, None, "b"), (6, None, "b"), (7, 1, None)]
    df = spark.createDataFrame(rows, "id int, x int, s string")
    spec = rule(COMPOUND, {"column_list": ["x", "s"], "ignore_row_if": ignore})
    assert bad_ids(df, spec) == bad


@pytest.mark.parametrize("limit", ["10MB", "-1"])
@pytest.mark.parametrize("check, bad", [(IN_SET, [4, 5]), (NOT_IN_SET, [1, 3])])
def test_value_set_of_a_table(spark, df, check, bad, limit):
    members = spark.createDataFrame([("5",), ("5",), ("seven",), (None,)], "code string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    try:
        assert bad_ids(df, rule(check, {"column": "x", "value_set": "ref.codes.code"}), {"ref.codes": members}) == bad
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_long_keys_are_found_by_hash_and_text(spark):
    texts = ["x" * 200 + str(i % 7) for i in range(10)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, x string")
    spec = rule(UNIQUE, {"column": "x"})
    expected = [i for i, t in enumerate(texts) if texts.count(t) > 1]
    assert bad_ids(df, spec) == expected


def test_condition_bounds_the_scope_of_uniqueness(df):
    assert bad_ids(df, rule(UNIQUE, {"column": "x"}, condition="id <> 3")) == []


def test_sql_rows_see_the_scope_only(df):
    spec = rule(SQL, {"unexpected_rows_query": "SELECT id, x FROM {batch} WHERE s RLIKE '^a{1}' OR x = 9"}, condition="id <> 1")
    measures, rows = check_one(df, spec)
    assert rows == [("2", None), ("4", "9"), ("6", None)]
    assert measures["element_count"] == 6 and measures["exception_count"] == 3
    assert measures["missing_count"] == 2 and measures["observed_value"] == "3"
    assert measures["exception_percent"] == 50 and measures["exception_percent_total"] == 50
    assert round(measures["exception_percent_nonmissing"], 3) == 66.667


def test_sql_may_join_multiply_and_aggregate(df):
    query = "SELECT x AS id, count(*) * 2 AS x FROM {batch} GROUP BY x HAVING count(*) > 1 ORDER BY 1"
    assert check_one(df, rule(SQL, {"unexpected_rows_query": query}))[1] == [("5", "4"), ("None", "4")]


def test_measures_of_a_column_check(df):
    measures, _ = check_one(df, rule(BETWEEN, {"column": "x", "max_value": 5, "mostly": 0.75}))
    assert measures["success_flag"] and measures["element_count"] == 6
    assert (measures["missing_count"], measures["exception_count"]) == (2, 1)
    assert measures["exception_percent"] == 25 and measures["exception_percent_nonmissing"] == 25
    assert round(measures["exception_percent_total"], 3) == 16.667
    assert round(measures["missing_percent"], 3) == 33.333
    assert not check_one(df, rule(BETWEEN, {"column": "x", "max_value": 5, "mostly": 0.76}))[0]["success_flag"]


def test_measures_of_the_null_check(df):
    measures, rows = check_one(df, rule(NOT_NULL, {"column": "x", "store_exceptions": False}))
    assert rows == []
    assert (measures["missing_count"], measures["exception_count"], measures["exception_percent_nonmissing"]) == (2, 2, 0)
    assert measures["exception_percent"] == measures["missing_percent"] == measures["exception_percent_total"]


def test_nothing_in_scope_succeeds(df):
    measures, rows = check_one(df, rule(BETWEEN, {"column": "x", "max_value": 5}, condition="id > 100"))
    assert measures["success_flag"] and measures["element_count"] == 0 and rows == []


def test_key_parts_and_absent_values(df):
    spec = rule(BETWEEN, {"column": "x", "max_value": 5}, column="elsewhere", keys=("s", "d"))
    assert check_one(df, spec)[1] == [("b_c_None", None)]


@pytest.mark.parametrize(
    "spec, reason",
    [
        (rule("NoSuchCheck", {}), "unknown_check"),
        (rule(BETWEEN, {"column": "nope", "min_value": 1}), "unknown_column"),
        (rule(BETWEEN, {"column": "x"}), "bad_arguments"),
        (rule(BETWEEN, {"column": "x", "min_value": "many"}), "bad_arguments"),
        (rule(BETWEEN, {"column": "x", "min_value": 1, "mostly": 2}), "bad_arguments"),
        (rule(REGEX, {"column": "s"}), "bad_arguments"),
        (rule(IN_SET, {"column": "x", "value_set": "table"}), "bad_arguments"),
        (rule(COMPOUND, {"column_list": ["x"]}), "bad_arguments"),
        (rule(PAIR, {"column_A": "x", "column_B": "y", "ignore_row_if": "maybe"}), "bad_arguments"),
        (rule(NOT_NULL, {"column": "x"}, keys=("nope",)), "bad_key"),
        (rule(NOT_NULL, {"column": "x"}, keys=()), "bad_key"),
    ],
)
def test_rules_that_cannot_be_checked(df, spec, reason):
    with pytest.raises(RuleError) as raised:
        build(df, spec)
    assert raised.value.reason == reason


def test_row_checks_equal_brute_force(spark):
    """All pairs of small values, against the definitions in plain Python."""
    values = [None, -1, 0, 1, 2]
    rows = [(i, a, b) for i, (a, b) in enumerate(itertools.product(values, values))]
    df = spark.createDataFrame(rows, "id int, x int, y int")
    greater = [i for i, a, b in rows if not (a is None and b is None) and not (None not in (a, b) and a > b)]
    assert bad_ids(df, rule(PAIR, {"column_A": "x", "column_B": "y"})) == greater
    pairs = [(a, b) for _, a, b in rows]
    assert len(set(pairs)) == len(pairs)
    twice = df.unionAll(df.filter("x = 1").selectExpr("id + 100", "x", "y"))
    ids = sorted(i + offset for i, a, _ in rows if a == 1 for offset in (0, 100))
    assert bad_ids(twice, rule(COMPOUND, {"column_list": ["x", "y"], "ignore_row_if": "never"})) == ids
