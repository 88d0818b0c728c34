"""Schemas of the rule, rule-type, validation and exception tables.

Field names, types and order are fixed values: they are the contract with
existing rule and ledger tables. Only row counts are wider here (long), since a
table may hold more rows than an int can count; a store whose tables have int
counts still works, as rows are fitted to the stored table when appended.
"""

from pyspark.sql import types as T


def _schema(*fields: tuple[str, T.DataType], nullable: tuple[str, ...] = ()) -> T.StructType:
    return T.StructType([T.StructField(name, kind, name in nullable) for name, kind in fields])


_STRING, _LONG, _INT = T.StringType(), T.LongType(), T.IntegerType()
_FLOAT, _BOOL, _DATE, _TS = T.FloatType(), T.BooleanType(), T.DateType(), T.TimestampType()

DQ_RULE = _schema(
    ("integration_id", _STRING),
    ("rule_key", _LONG),
    ("rule_no", _INT),
    ("rule_description", _STRING),
    ("system_evaluated", _STRING),
    ("rule_priority", _STRING),
    ("start_date", _DATE),
    ("expiry_date", _DATE),
    ("rule_enabled", _STRING),
    ("data_domain", _STRING),
    ("data_product", _STRING),
    ("data_owner", _STRING),
    ("business_steward", _STRING),
    ("it_steward", _STRING),
    ("threshold", _FLOAT),
    ("weight", _FLOAT),
    ("rule_type_key", _INT),
    ("catalog", _STRING),
    ("schema", _STRING),
    ("table_name", _STRING),
    ("column", _STRING),
    ("table_key", _STRING),
    ("gx_arguments", _STRING),
    ("gx_conditions", _STRING),
    ("created_at_ts", _TS),
    ("modified_at_ts", _TS),
    nullable=("it_steward", "gx_conditions"),
)

BRONZE_RULE_TYPE = _schema(
    ("rule_type_key", _INT),
    ("rule_type_name", _STRING),
    ("dq_dimension", _STRING),
    ("gx_expectation", _STRING),
    ("gx_description", _STRING),
    ("created_at_ts", _TS),
    ("modified_at_ts", _TS),
)

DQ_RULE_TYPE = T.StructType([T.StructField("integration_id", _STRING, False), *BRONZE_RULE_TYPE.fields])

DQ_VALIDATIONS = _schema(
    ("validation_key", _LONG),
    ("rule_key", _LONG),
    ("execution_key", _INT),
    ("success_flag", _BOOL),
    ("element_count", _LONG),
    ("exception_count", _LONG),
    ("known_exception_count", _LONG),
    ("new_exception_count", _LONG),
    ("fixed_exception_count", _LONG),
    ("exception_percent", _FLOAT),
    ("known_exception_percent", _FLOAT),
    ("new_exception_percent", _FLOAT),
    ("fixed_exception_percent", _FLOAT),
    ("observed_value", _STRING),
    ("missing_count", _LONG),
    ("missing_percent", _FLOAT),
    ("exception_percent_total", _FLOAT),
    ("exception_percent_nonmissing", _FLOAT),
    ("created_at_ts", _TS),
    ("modified_at_ts", _TS),
    nullable=("observed_value",),
)

DQ_EXCEPTIONS = _schema(
    ("validation_key", _LONG),
    ("rule_key", _LONG),
    ("execution_key", _INT),
    ("exception_row_pk", _STRING),
    ("exception_row_value", _STRING),
    ("fixed_exception_flag", _BOOL),
    ("new_exception_flag", _BOOL),
    ("row_delete_flag", _BOOL),
    ("created_at_ts", _TS),
    ("modified_at_ts", _TS),
)

DEFAULT = "default"  # in a field's metadata: the expression that fills a missing value


def _stored(schema: T.StructType, integration_id: str, *keys: T.StructField) -> T.StructType:
    """A stored table also holds generated key columns, and times that are filled in where they are missing."""
    now = {"created_at_ts": "current_timestamp()", "modified_at_ts": "current_timestamp()"}
    fields = [T.StructField(f.name, f.dataType, f.nullable, {DEFAULT: now[f.name]} if f.name in now else {}) for f in schema.fields]
    return T.StructType([T.StructField("integration_id", _STRING, True, {DEFAULT: integration_id}), *keys, *fields])


DQ_VALIDATIONS_TABLE = _stored(DQ_VALIDATIONS, "concat(rule_key, '~', execution_key)")
DQ_EXCEPTIONS_TABLE = _stored(DQ_EXCEPTIONS, "concat(exception_row_pk, '~', modified_at_ts)", T.StructField("exception_key", _LONG))

# Two rows per run: when it starts to store its results, and when all are stored.
DQ_RUNS = _schema(
    ("execution_key", _INT),
    ("previous_execution_key", _INT),
    ("first_validation_key", _LONG),
    ("last_validation_key", _LONG),
    ("last_exception_key", _LONG),
    ("state", _STRING),
    ("logged_at_ts", _TS),
)

RULE_ERRORS = "rule_key long, reason string, message string"
