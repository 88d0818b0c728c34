"""Fit a DataFrame to a target schema."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from plumbline.functions.expressions import named


def align_to_schema(df: DataFrame, schema: StructType, lenient: bool = False) -> DataFrame:
    """Select the schema's fields in order: missing ones as typed nulls, others cast.

    A value that cannot be cast ends the query, or is null if ``lenient``.
    """
    present = {field.name: field.dataType for field in df.schema.fields}

    def fitted(field):
        if field.name not in present:
            return F.lit(None).cast(field.dataType).alias(field.name)
        if present[field.name] != field.dataType:
            column = named(field.name)
            return (column.try_cast if lenient else column.cast)(field.dataType).alias(field.name)
        return named(field.name)

    return df.select([fitted(field) for field in schema.fields])


def misfits(df: DataFrame, schema: StructType) -> Column:
    """Names of the fields of a row whose values cannot be cast to the schema's types, joined by commas."""
    given = {field.name: field.dataType for field in df.schema.fields}
    failing = [
        F.when(named(field.name).isNotNull() & named(field.name).try_cast(field.dataType).isNull(), field.name)
        for field in schema.fields
        if given.get(field.name, field.dataType) != field.dataType
    ]
    return F.concat_ws(",", *failing) if failing else F.lit("")
