"""Rules: ingest from sources, resolve against rule types, choose the active ones."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from plumbline.functions import expressions as X
from plumbline.operators.align import align_to_schema, misfits
from plumbline.operators.numbering import number_rows
from plumbline.schemas import BRONZE_RULE_TYPE, DQ_RULE, DQ_RULE_TYPE
from plumbline.sources.staging import Staging


def admitted(source: DataFrame) -> DataFrame:
    """Current source rows that are rules: numbered and dated."""
    current = F.col("current_flag").try_cast("boolean")
    return source.filter(current & F.col("rule_no").isNotNull() & F.col("created_at_date").isNotNull())


# Fields that sources do not give, or that are made anew from what they give.
_NOT_FROM_SOURCES = ("rule_key", "integration_id", "created_at_ts", "modified_at_ts", "start_date", "expiry_date")


def _from_sources() -> StructType:
    return StructType([field for field in DQ_RULE.fields if field.name not in _NOT_FROM_SOURCES])


def unfit_rules(incoming: DataFrame) -> DataFrame:
    """Ingested rows that the rule table cannot hold (leaked headers, texts for numbers), as rule errors without a key."""
    names = misfits(incoming, _from_sources())
    told = [F.coalesce(F.col(c).cast("string"), F.lit("None")) for c in ("table_name", "column", "rule_no")]
    message = F.concat(F.lit("source row "), F.concat_ws(", ", *told), F.lit(" has unsuitable values of "), names)
    return incoming.filter(names != "").select(
        F.lit(None).cast("long").alias("rule_key"), F.lit("bad_source_row").alias("reason"), message.alias("message")
    )


def fit_rules(incoming: DataFrame) -> DataFrame:
    """The other ingested rows."""
    return incoming.filter(misfits(incoming, _from_sources()) == "")


def ingest_rules(sources: Sequence[DataFrame]) -> DataFrame:
    """Rule rows of all sources, united by name, with business key and typed dates."""
    rows = reduce(DataFrame.unionByName, [admitted(source) for source in sources])
    return rows.withColumns(
        {
            "integration_id": X.rule_integration_id(),
            "created_at_ts": X.source_timestamp("created_at_date"),
            "modified_at_ts": X.source_timestamp("modified_at_date"),
            "start_date": X.source_date("start_date"),
            "expiry_date": X.source_date("expiry_date"),
        }
    ).drop("created_at_date", "modified_at_date")


def ingest_rule_types(source: DataFrame) -> DataFrame:
    """Current rule types with the id of the stored table."""
    current = source.filter("current_flag").select(BRONZE_RULE_TYPE.fieldNames())
    return current.withColumn("integration_id", X.generated_id(F.col("rule_type_key"), F.col("gx_expectation"))).select(
        DQ_RULE_TYPE.fieldNames()
    )


def assign_rule_keys(incoming: DataFrame, stored: DataFrame, staging: Staging) -> DataFrame:
    """Known rules keep their ``rule_key``; new ones get the next dense numbers."""
    held = stored.select("integration_id", "rule_key")
    last = stored.agg(F.coalesce(F.max("rule_key"), F.lit(0))).first()[0]
    rules = incoming.drop("rule_key")
    new = rules.join(held, "integration_id", "left_anti")
    numbered = number_rows(new, "rule_key", staging, [F.col("integration_id")], start=last)
    known = rules.join(held, "integration_id")
    return align_to_schema(known.unionByName(numbered), DQ_RULE, lenient=True)


def resolve_rules(rules: DataFrame, rule_types: DataFrame) -> DataFrame:
    """Rules with the check name of their type, in rule order."""
    # The rule-type table has one row per kind of check, so Catalyst sees its size
    # in the table statistics and broadcasts it without a hint.
    names = rule_types.select("rule_type_key", "gx_expectation")
    return rules.join(names, "rule_type_key", "left").orderBy("rule_key")


def parse_rules(rules: DataFrame) -> DataFrame:
    """Add what the checks need: check name, arguments as valid JSON, key columns."""
    return rules.withColumns(
        {
            "check_name": X.check_name(F.trim("gx_expectation", F.lit(X.WHITESPACE))),
            "arguments_json": X.arguments_json(F.col("gx_arguments")),
            "key_columns": X.key_columns(F.col("table_key")),
        }
    )


def asset_name() -> Column:
    return F.concat_ws("-", "catalog", "schema", "table_name")


def with_status(rules: DataFrame, today: Column | date, assets: Iterable[str] | None = None) -> DataFrame:
    """Mark each rule ``active``, or with the reason why it is skipped."""
    day = today if isinstance(today, Column) else F.lit(today)
    status = F.when(F.col("integration_id") == "integration_id", "header")
    if assets is not None:
        status = status.when(~asset_name().isin(*assets), "not_selected")
    status = (
        status.when(F.col("rule_enabled").isNull() | (F.col("rule_enabled") != "Y"), "disabled")
        .when(F.col("start_date").isNull() | F.col("expiry_date").isNull(), "no_dates")
        .when(day < F.col("start_date"), "not_started")
        .when(day > F.col("expiry_date"), "expired")
        .otherwise("active")
    )
    return rules.withColumn("status", status)


def active_rules(rules: DataFrame, today: Column | date, assets: Iterable[str] | None = None) -> DataFrame:
    return with_status(rules, today, assets).filter(F.col("status") == "active").drop("status")
