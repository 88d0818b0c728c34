"""Tables by name: rule tables, assets and value sets."""

from __future__ import annotations

from pyspark.sql import SparkSession

# The kinds of source. Hive names have two parts, Delta names three.
HIVE, DELTA = "Hive", "DeltaTable"


def rule_tables(spark: SparkSession, schema: str, pattern: str) -> list[str]:
    """Names of the tables in ``schema`` that contain ``pattern``."""
    found = [t.name for t in spark.catalog.listTables(schema) if not t.isTemporary and pattern in t.name]
    return [f"{schema}.{name}" for name in sorted(found)]


def asset_table(source: str, catalog: str | None, schema: str, table: str) -> str:
    if source == HIVE:
        return f"{schema}.{table}"
    if source == DELTA:
        return f"{catalog}.{schema}.{table}"
    raise ValueError(f"unsupported data source: {source}")
