"""Dense row numbers without a single-task window over the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.operators.probe import broadcast_limit
from plumbline.sources.staging import Staging

_OFFSET_BYTES = 48


def number_staged_rows(staged: DataFrame, name: str, start: int = 0) -> DataFrame:
    """Number the rows of a staged table ``start + 1, start + 2, ...``.

    A row's number is its position in its file plus the rows of all earlier files,
    so it depends on the files alone: recomputed tasks give the same numbers, and
    no row is shuffled or sorted. The window runs over one row per file.
    """
    file, position = "_numbering_file", "_numbering_position"
    rows = staged.select("*", F.col("_metadata.file_path").alias(file), F.col("_metadata.row_index").alias(position))
    # part-<task>-<id>-c<nnn>: the order in which a sorted table was written.
    task = F.regexp_extract(file, r"part-(\d+)-", 1).cast("long")
    chunk = F.regexp_extract(file, r"-c(\d+)[^/]*$", 1).cast("long")
    earlier = Window.orderBy(task, chunk, file).rowsBetween(Window.unboundedPreceding, -1)
    per_file = staged.groupBy(F.col("_metadata.file_path").alias(file)).agg(F.count(F.lit(1)).alias("_rows"))
    offsets = per_file.select(file, F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_offset"))
    # One row per file, measured where they are counted: a number reaches the driver, no path. Beyond the
    # limit the rows are shuffled by file, which is even.
    size = per_file.agg(F.coalesce(F.sum(F.octet_length(file) + _OFFSET_BYTES), F.lit(0))).first()[0]
    if size <= broadcast_limit(staged.sparkSession):
        offsets = F.broadcast(offsets)
    numbered = rows.join(offsets, file)
    number = F.lit(start).cast("long") + F.col("_offset") + F.col(position) + 1
    return numbered.select(*staged.columns, number.alias(name))


def number_rows(
    df: DataFrame, name: str, staging: Staging, order_by: list[Column] | None = None, start: int = 0
) -> DataFrame:
    """Stage ``df``, in the given order if any, and number its rows densely."""
    ordered = df.orderBy(*order_by) if order_by else df
    return number_staged_rows(staging.put(ordered, "numbered"), name, start)
