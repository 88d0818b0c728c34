"""Runs that break off between any two writes, and where the next one begins."""

from datetime import date, datetime

import pytest
from plumbline.operators import ledger as L
from plumbline.operators.runs import COMMITTED, STARTED, History, RunEntry, history
from plumbline.plans.workflow import run_stored_rules, update_rule_types, update_rules
from plumbline.sources.staging import Staging
from plumbline.sources.store import Store
from pyspark.sql import functions as F
from test_workflow import BRONZE_RULES, BRONZE_TYPES, save_people, save_rules, save_types, schema  # noqa: F401

PEOPLE = [[(1, "a", 300), (2, None, 30)], [(1, "a", 300), (2, "b", 30), (3, "c", -1)], [(1, "a", 30), (2, None, 30), (3, "c", -1)]]


class Lost(Exception):
    pass


@pytest.fixture
def store(spark, schema):  # noqa: F811
    save_types(spark, schema, BRONZE_TYPES)
    save_rules(spark, schema, BRONZE_RULES)
    store, staging = Store(spark, schema), Staging(spark)
    store.create()
    update_rule_types(store, f"{schema}.bronze_types", staging)
    update_rules(store, [f"{schema}.bronze_rules_hr"], staging)
    return store


def run_day(store, day, **options):
    save_people(store.spark, store.schema, PEOPLE[day])
    return run_stored_rules(store, today=date(2024, 6, 1), run_ts=datetime(2024, 6, 1 + day), **options)


def broken_day(store, day, write, after):
    """A run that ends before, or right after, one of its writes."""
    append, calls = store.append, []

    def failing(df, name):
        calls.append(name)
        if len(calls) - 1 == write and not after:
            raise Lost
        append(df, name)
        if len(calls) - 1 == write:
            raise Lost

    store.append = failing
    with pytest.raises(Lost):
        run_day(store, day)
    del store.append
    assert len(calls) == write + 1


def seen(store):
    """What readers of committed rows see, without keys."""
    rows = store.committed(store.exceptions).select("rule_key", "exception_row_pk", "new_exception_flag", "fixed_exception_flag", F.day("created_at_ts")).collect()
    checked = store.committed(store.validations).select("rule_key", "exception_count", "new_exception_count", "known_exception_count", "fixed_exception_count").collect()
    return sorted(map(tuple, rows)), sorted(map(tuple, checked))


WRITES = [(write, after) for write in range(4) for after in (False, True)]


@pytest.mark.parametrize("write, after", WRITES)
def test_a_run_may_break_off_between_any_two_writes(store, write, after):
    run_day(store, 0)
    first = seen(store)
    broken_day(store, 1, write, after)
    committed = write == 3 and after
    assert (seen(store) == first) is not committed
    result, _ = run_day(store, 2)
    kinds = {(r["rule_key"], r["exception_row_pk"]): "fixed" if r["fixed_exception_flag"] else "new" if r["new_exception_flag"] else "known" for r in result.exceptions.collect()}
    if committed:
        assert kinds == {(1, "1"): "fixed", (1, "3"): "known", (2, "2"): "new"}
    else:
        assert kinds == {(1, "1"): "fixed", (1, "3"): "new", (2, "2"): "known"}
    everything = store.table(store.exceptions).select("exception_key").collect()
    assert len({row[0] for row in everything}) == len(everything)
    keys = [row[0] for row in store.table(store.validations).select("validation_key").collect()]
    assert len(set(keys)) == len(keys)
    assert result.execution_key == (2 if (write, after) == (0, False) else 3)
    if write != 2:
        return
    # The same with what counts as previous told by validations.
    again, _ = run_day(store, 2, previous="last_evaluated")
    assert {(r["rule_key"], r["exception_row_pk"], r["new_exception_flag"]) for r in again.exceptions.collect()} == {(1, "3", False), (2, "2", False)}


def test_two_broken_runs_and_the_first(store):
    broken_day(store, 0, 2, False)
    broken_day(store, 1, 1, True)
    assert seen(store) == ([], [])
    result, _ = run_day(store, 2)
    assert result.execution_key == 3 and result.exceptions.filter("new_exception_flag").count() == 2
    found = history(store.table(store.runs))
    assert found.committed_execution_key == 3 and len(found.broken) == 2
    assert [row["validation_key"] > found.broken[-1][1] for row in result.validations.collect()] == [True, True]


def test_the_starting_point_needs_no_history(store, monkeypatch):
    first, _ = run_day(store, 0)
    stored = store.table(store.exceptions).count()
    assert history(store.table(store.runs)) == History(2, 1, stored, 1)
    assert store.table(store.runs).count() == 2
    for name in ("starting_point", "last_run", "max_exception_key"):
        monkeypatch.setattr(L, name, None)
    run_day(store, 1)
    keys = sorted(row[0] for row in store.table(store.exceptions).select("exception_key").collect())
    assert keys == list(range(1, len(keys) + 1)) and len(keys) > stored
    assert history(store.table(store.runs)).last_exception_key == len(keys)


def test_a_ledger_from_before_the_run_table(store, spark):
    run_day(store, 0)
    before = seen(store)
    spark.sql(f"TRUNCATE TABLE {store.runs}")
    assert seen(store) == before and history(store.table(store.runs)) is None
    broken_day(store, 1, 2, False)
    assert seen(store) == before
    result, _ = run_day(store, 2)
    assert {(r["rule_key"], r["exception_row_pk"], r["new_exception_flag"], r["fixed_exception_flag"]) for r in result.exceptions.collect()} == {
        (1, "1", False, True), (1, "3", True, False), (2, "2", False, False)}
    assert result.execution_key == 3


def test_entries(spark):
    entry = RunEntry(4, 3, 10, 12, 99)
    rows = entry.logged(spark, STARTED)
    assert history(rows) == History(12, 4, 99, 3, ((10, 12),))
    assert history(rows.union(entry.logged(spark, COMMITTED))) == History(12, 4, 99, 4)
    assert history(rows.limit(0)) is None
    keys = spark.range(8, 15).select(F.col("id").alias("validation_key"))
    assert [row[0] for row in history(rows).committed(keys).orderBy("validation_key").collect()] == [8, 9, 10, 13, 14]
