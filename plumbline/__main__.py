"""Command line: update the rules from their sources, run them, save the results."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from plumbline.plans.workflow import run_workflow
from plumbline.sources import catalog
from plumbline.sources.store import FORMATS


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="plumbline", description=__doc__)
    parser.add_argument("--schema", default="dqops", help="schema of the rule and ledger tables")
    parser.add_argument("--rules-like", help="part of the names of the rule source tables; without it the stored rules are run")
    parser.add_argument("--rule-types", help="source table of the rule types; without it the stored types are used")
    parser.add_argument("--format", choices=FORMATS, default="parquet", help="format of the tables created")
    parser.add_argument("--source", choices=[catalog.HIVE, catalog.DELTA], default=catalog.HIVE, help="kind of the checked tables")
    parser.add_argument("--asset", action="append", help="check only this catalog-schema-table; may be repeated")
    parser.add_argument("--previous", choices=["last_run", "last_evaluated"], default="last_run")
    options = parser.parse_args(arguments)

    spark = SparkSession.builder.appName("plumbline").getOrCreate()
    result, selection = run_workflow(
        spark,
        catalog.rule_tables(spark, options.schema, options.rules_like) if options.rules_like else [],
        options.rule_types,
        schema=options.schema,
        table_format=options.format,
        source=options.source,
        assets=options.asset,
        previous=options.previous,
    )
    print(f"run {result.execution_key}: {len(selection.specs)} rules")
    for errors in (selection.errors, result.errors):
        for row in errors.toLocalIterator():
            print(f"rule {row['rule_key']} not checked ({row['reason']}): {row['message'].splitlines()[0]}")


if __name__ == "__main__":
    main()
