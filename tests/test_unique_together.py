"""Uniqueness rules whose repeated keys are found together."""

from itertools import combinations

import pytest
from helpers import COMPOUND, TODAY, UNIQUE, rule
from plumbline.operators.checks import build_check, prepare_repeated
from plumbline.operators.evaluate import check_table
from plumbline.sources.staging import Staging
from pyspark.sql import types as T

ROWS = [(1, 1, "a", 1.5, None), (2, 1, "a", 1.5, None), (3, 2, None, 0.0, 7), (4, 2, None, -0.0, 7), (5, None, None, None, None), (6, None, None, None, None), (7, 3, "b", 2.5, 8)]


@pytest.fixture
def table(spark):
    return spark.createDataFrame(ROWS, "id int, a int, s string, d double, b long")


def broken(df, specs):
    _, rows = check_table(df, specs, {}.__getitem__, TODAY, Staging(df.sparkSession))
    return sorted((r.rule_key, int(r.exception_row_pk)) for r in rows.collect())


def test_keys_keep_the_types_of_their_columns(spark, table):
    specs = [rule(UNIQUE, {"column": c}, "id", rule_key=k) for k, c in enumerate("adb", 1)]
    specs.append(rule(COMPOUND, {"column_list": ["a", "b"], "ignore_row_if": "never"}, "id", rule_key=4))
    checks = [build_check(spec, table, {}.__getitem__, TODAY) for spec in specs]
    prepare_repeated(table, checks, Staging(spark))
    kinds = [[field.dataType for field in check.key_set.keys.select(*check.key_set.key_names).schema] for check in checks]
    assert kinds == [[T.IntegerType()], [T.DoubleType()], [T.LongType()], [T.IntegerType(), T.LongType()]]
    assert [(check.key_set.key_count, check.key_set.row_count) for check in checks] == [(2, 4), (2, 4), (1, 2), (3, 6)]
    assert all(check.key_set.size_in_bytes == check.key_set.key_count * 16 * (1 + len(k)) for check, k in zip(checks, kinds))


def expected(names, ignored, ids):
    """Ids of rows whose keys come twice among those that a rule judges."""
    keys = {row[0]: tuple(row["iasdb".index(name)] for name in names) for row in ROWS if row[0] in ids}
    skipped = {"never": lambda key: False, "all_values_are_missing": lambda key: set(key) == {None}, "any_value_is_missing": lambda key: None in key}
    judged = {i: key for i, key in keys.items() if not skipped[ignored](key)}
    return [i for i, key in judged.items() if list(judged.values()).count(key) > 1]


@pytest.mark.parametrize("limit, several", [("10m", 1), ("-1", 2)])
def test_rules_together_find_all_repeated_keys(spark, table, limit, several):
    """Few rules, and with 20 rules more columns than Spark groups by."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    lists = [list(names) for size in (2, 3, 4) for names in combinations("asdb", size)][-8:] * several
    specs, want = [rule(UNIQUE, {"column": "s"}, "id", rule_key=1)], [(1, 1), (1, 2)]
    for k, names in enumerate(lists, 2):
        ignored, few = ("never", "all_values_are_missing", "any_value_is_missing")[k % 3], k % 4 == 0
        specs.append(rule(COMPOUND, {"column_list": names, "ignore_row_if": ignored}, "id", rule_key=k, condition="id < 6" if few else None))
        want += [(k, i) for i in expected(names, ignored, range(6) if few else range(10))]
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        assert broken(table, specs) == sorted(want)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
