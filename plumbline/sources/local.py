"""Rule-sized rows that the driver holds, as a DataFrame."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

# The column types that rule-sized rows use.
_ARROW = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(), "boolean": pa.bool_()}


def local_rows(spark: SparkSession, rows: Sequence[tuple], columns: str) -> DataFrame:
    """Rows with the columns of a DDL text such as ``"rule_key long, reason string"``.

    Arrow data becomes a local relation of known size, which joins as a broadcast
    and, when empty, lets Catalyst drop the work that depends on it.
    """
    fields = [column.split() for column in columns.split(",")]
    arrays = [pa.array([row[i] for row in rows], _ARROW[kind]) for i, (_, kind) in enumerate(fields)]
    return spark.createDataFrame(pa.table(arrays, names=[name for name, _ in fields]))
