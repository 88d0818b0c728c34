"""Column expressions shared by rules, checks and the ledger."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# How a null key part or a null value is rendered, the key
# separators, and the date format of the rule sources.
NULL_TEXT = "None"
ROW_KEY_SEPARATOR = "_"
ID_SEPARATOR = "~"
SOURCE_DATE_FORMAT = "dd/MM/yyyy"
WHITESPACE = " \t\r\n"


def quoted(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"


def named(column: str) -> Column:
    """A column by its exact name, dots and blanks included."""
    return F.col(quoted(column))


def row_key(columns: Sequence[str]) -> Column:
    """Visible key of a row: its key columns as text, nulls spelled out."""
    parts = [f"coalesce(cast({quoted(c)} AS string), '{NULL_TEXT}')" for c in columns]
    return F.expr(f"concat_ws('{ROW_KEY_SEPARATOR}', {', '.join(parts)})")


def generated_id(*parts: Column) -> Column:
    """Id column of a ledger table; null when a part is null."""
    pieces = [parts[0].cast("string")]
    for part in parts[1:]:
        pieces += [F.lit(ID_SEPARATOR), part.cast("string")]
    return F.concat(*pieces)


def rule_integration_id() -> Column:
    """Business key of a rule; null parts are left out."""
    return F.concat_ws(
        ID_SEPARATOR,
        F.col("table_name"),
        F.col("column"),
        F.col("rule_no").cast("string"),
        F.col("data_domain"),
    )


def source_date(column: str) -> Column:
    return F.try_to_date(F.col(column), SOURCE_DATE_FORMAT)


def source_timestamp(column: str) -> Column:
    return F.try_to_timestamp(F.col(column), F.lit(SOURCE_DATE_FORMAT))


def check_name(name: Column) -> Column:
    """Check names come as CamelCase or as snake_case; give the CamelCase form."""
    camel = F.replace(F.initcap(F.replace(name, F.lit("_"), F.lit(" "))), F.lit(" "), F.lit(""))
    return F.when(F.contains(name, F.lit("_")), camel).otherwise(name)


def key_columns(table_key: Column) -> Column:
    """The comma-separated key list as an array of names."""
    parts = F.transform(F.split(table_key, ","), lambda part: F.trim(part, F.lit(WHITESPACE)))
    return F.filter(parts, lambda part: part != "")


def _is_json_object(text: Column) -> Column:
    return F.coalesce(F.schema_of_variant(F.try_parse_json(text)).startswith("OBJECT"), F.lit(False))


def arguments_json(text: Column) -> Column:
    """Rule arguments as valid JSON object text, or null when beyond repair.

    Rule sources export the JSON in several ways, so the text is tried as it is,
    then without outer quotes, then with doubled quotes undone, then each of these
    with stray backslashes (as in an unescaped regex) escaped.
    """
    plain = F.trim(text, F.lit(WHITESPACE))
    quoted = plain.startswith('"') & plain.endswith('"') & (F.length(plain) >= 2)
    inner = F.when(quoted, F.substring(plain, F.lit(2), F.length(plain) - 2)).otherwise(plain)
    single = F.replace(inner, F.lit('""'), F.lit('"'))

    def escaped(column: Column) -> Column:
        stray = r'(?<!\\)((?:\\\\)*)\\(?!["\\/bfnrt]|u[0-9a-fA-F]{4})'
        return F.regexp_replace(column, stray, r"$1\\\\")

    attempts = [plain, inner, single, escaped(inner), escaped(single)]
    return F.coalesce(*[F.when(_is_json_object(attempt), attempt) for attempt in attempts])
