"""Random tables, rules and histories against plain Python."""

import random
from collections import Counter

import pytest
from helpers import BETWEEN, COMPOUND, IN_SET, NOT_NULL, PAIR, UNIQUE, ledger_of, rule, run
from pyspark.sql import functions as F

SCHEMA = "a int, b int, x int, y int, s string"


def random_rows(rng, size):
    def maybe(value):
        return None if rng.random() < 0.15 else value

    # The row key (a, b) repeats, and a third of the rows share one.
    rows = []
    for _ in range(size):
        key = (1, 1) if rng.random() < 1 / 3 else (maybe(rng.randrange(9)), rng.randrange(9))
        rows.append((*key, maybe(rng.randrange(12)), maybe(rng.randrange(12)), maybe(rng.choice("pqrs"))))
    return rows


def rules(rng):
    keys, low = ("a", "b"), rng.randrange(6)
    specs = [
        rule(NOT_NULL, {"column": "x"}, "x", keys, 1),
        rule(BETWEEN, {"column": "x", "min_value": low, "max_value": 9}, "x", keys, 2, condition="y > 2"),
        rule(IN_SET, {"column": "s", "value_set": ["p", "q"]}, "s", keys, 3),
        rule(PAIR, {"column_A": "x", "column_B": "y"}, "y", keys, 4),
        rule(UNIQUE, {"column": "x"}, "x", keys, 5, condition="s = 'r'"),
        rule(COMPOUND, {"column_list": ["x", "y"]}, "x", keys, 6),
        rule(BETWEEN, {"column": "y", "max_value": 10, "mostly": 0.5}, "y", keys, 7),
    ]

    def bad(rows):
        scoped = Counter(x for _, _, x, _, s in rows if s == "r")
        pairs = Counter((x, y) for _, _, x, y, _ in rows)
        tests = {
            1: (lambda x, y, s: x is None, 2),
            2: (lambda x, y, s: y is not None and y > 2 and x is not None and not low <= x <= 9, 2),
            3: (lambda x, y, s: s is not None and s not in "pq", 4),
            4: (lambda x, y, s: (x, y) != (None, None) and (x is None or y is None or x <= y), 3),
            5: (lambda x, y, s: s == "r" and x is not None and scoped[x] > 1, 2),
            6: (lambda x, y, s: (x, y) != (None, None) and pairs[x, y] > 1, 2),
        }
        return Counter(
            (key, f"{row[0]}_{row[1]}", str(row[value]))
            for key, (test, value) in tests.items() for row in rows if test(*row[2:])
        )

    return specs, bad


@pytest.mark.parametrize("seed, limit", [(1, "10MB"), (2, "-1")])
def test_two_runs(spark, seed, limit):
    rng = random.Random(seed)
    specs, bad = rules(rng)
    before, after = random_rows(rng, 60), random_rows(rng, 60)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    try:
        first = run(spark, specs, {"t": spark.createDataFrame(before, SCHEMA)})
        ledger = ledger_of(first)
        second = run(
            spark, specs, {"t": spark.createDataFrame(after, SCHEMA)}, ledger=ledger, execution_key=2,
            last_validation_key=7, last_exception_key=ledger.count(),
        )
        found = [row.asDict() for row in second.exceptions.collect()]
        validations = {row["rule_key"]: row for row in second.validations.collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")

    old, new = bad(before), bad(after)
    rows = ledger.collect()
    assert Counter((r["rule_key"], r["exception_row_pk"], r["exception_row_value"]) for r in rows) == old
    old_keys, new_keys = {key[:2] for key in old}, {key[:2] for key in new}
    kinds = {"known": Counter(), "new": Counter(), "fixed": Counter()}
    for row in found:
        kind = "fixed" if row["fixed_exception_flag"] else "new" if row["new_exception_flag"] else "known"
        kinds[kind][row["rule_key"], row["exception_row_pk"], row["exception_row_value"]] += 1
    assert kinds["known"] == Counter({k: n for k, n in new.items() if k[:2] in old_keys})
    assert kinds["new"] == Counter({k: n for k, n in new.items() if k[:2] not in old_keys})
    assert kinds["fixed"] == Counter({k: n for k, n in old.items() if k[:2] not in new_keys})

    for rule_key in range(1, 7):
        for kind, rows_of_kind in kinds.items():
            total = sum(n for key, n in rows_of_kind.items() if key[0] == rule_key)
            assert validations[rule_key][f"{kind}_exception_count"] == total
    assert validations[7]["success_flag"]
    numbers = sorted(row["exception_key"] for row in found)
    start = sum(old.values())
    assert numbers == list(range(start + 1, start + len(found) + 1))
    assert second.validations.agg(F.min("validation_key"), F.max("validation_key")).first()[:] == (8, 14)
