"""The persisted tables: rules, rule types, exceptions and validations."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from plumbline.functions.expressions import quoted
from plumbline.operators import runs, upsert
from plumbline.operators.align import align_to_schema
from plumbline.schemas import DEFAULT, DQ_EXCEPTIONS_TABLE, DQ_RULE, DQ_RULE_TYPE, DQ_RUNS, DQ_VALIDATIONS_TABLE
from plumbline.sources.staging import Staging

FORMATS = ("parquet", "hive", "delta")

# The keys that Delta tables number themselves. They refuse other values for them.
IDENTITY = {"dq_rule": "rule_key", "dq_exceptions": "exception_key"}


def complete_rows(rows: DataFrame, schema: StructType, table: str) -> DataFrame:
    """Rows as a table's contract wants them: missing values have their defaults, and a null where none may be ends the job, naming the column.

    Defaults may refer to other columns, and see those columns' defaults. Both happen in the projection that the append makes anyway.
    """
    defaults = {f.name: f.metadata[DEFAULT] for f in schema.fields if DEFAULT in f.metadata}
    for name in sorted(defaults, key=lambda n: any(other in defaults[n] for other in defaults)):
        kind = schema[name].dataType
        rows = rows.withColumn(name, F.coalesce(F.col(name), F.expr(defaults[name]).cast(kind)))
    refused = {
        f.name: F.coalesce(F.col(f.name), F.raise_error(F.lit(f"{table}.{f.name} must not be null")).cast(f.dataType)) for f in schema.fields if not f.nullable
    }
    return rows.withColumns(refused)


def create_statement(name: str, schema: StructType, table_format: str, partition: str | None = None, identity: str | None = None) -> str:
    numbered = " GENERATED ALWAYS AS IDENTITY (START WITH 1 INCREMENT BY 1)"
    # Only Delta tables hold to it themselves; for others the store does when it appends.
    must = lambda field: " NOT NULL" if table_format == "delta" and not field.nullable and field.name != identity else ""
    columns = ", ".join(
        f"`{field.name}` {field.dataType.simpleString()}{numbered if field.name == identity else ''}{must(field)}" for field in schema.fields
    )
    partitioned = f" PARTITIONED BY ({partition})" if partition else ""
    return f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING {table_format}{partitioned}"


def insert_statement(target: str, source: str, columns: Sequence[str]) -> str:
    names = ", ".join(quoted(c) for c in columns)
    return f"INSERT INTO {target} ({names}) SELECT {names} FROM {source}"


class Store:
    """Tables of one schema in one format.

    Both ledger tables are partitioned by run, so that looking up the previous run
    reads one partition whatever the length of the history. With ``generated_keys`` (default for
    Delta) the tables number rules and exceptions themselves, so these columns are never written.
    With ``enforce`` appended exceptions, validations and runs must keep the contract of their table: see ``complete_rows``.
    """

    def __init__(
        self, spark: SparkSession, schema: str = "dqops", table_format: str = "parquet", generated_keys: bool | None = None, enforce: bool = False
    ):
        if table_format not in FORMATS:
            raise ValueError(f"unsupported table format: {table_format}")
        self.generated_keys = table_format == "delta" if generated_keys is None else generated_keys
        if table_format == "hive":
            # Appends name the run's partition in the rows.
            spark.conf.set("hive.exec.dynamic.partition.mode", "nonstrict")
        self.spark, self.schema, self.format, self.enforce = spark, schema, table_format, enforce
        self.rules = f"{schema}.dq_rule"
        self.rule_types = f"{schema}.dq_rule_type"
        self.exceptions = f"{schema}.dq_exceptions"
        self.validations = f"{schema}.dq_validations"
        self.runs = f"{schema}.dq_runs"

    def create(self) -> None:
        """Create the tables that do not exist yet."""
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.schema}")
        self._create(self.rules, DQ_RULE)
        self._create(self.rule_types, DQ_RULE_TYPE)
        self._create(self.exceptions, DQ_EXCEPTIONS_TABLE, "execution_key")
        self._create(self.validations, DQ_VALIDATIONS_TABLE, "execution_key")
        self._create(self.runs, DQ_RUNS)

    def _create(self, name: str, schema: StructType, partition: str | None = None) -> None:
        self.spark.sql(create_statement(name, schema, self.format, partition, self.identity(name)))

    def identity(self, name: str) -> str | None:
        """The column that the table numbers itself."""
        return IDENTITY.get(name.rpartition(".")[2]) if self.generated_keys else None

    def written(self, name: str, columns: Sequence[str]) -> list[str]:
        return [column for column in columns if column != self.identity(name)]

    def reset_ledger(self, drop: bool = False) -> None:
        """Empty, or drop, the exceptions table."""
        self.spark.sql(f"{'DROP TABLE IF EXISTS' if drop else 'TRUNCATE TABLE'} {self.exceptions}")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.table(name)

    def committed(self, name: str) -> DataFrame:
        """The exceptions or validations of runs that were stored as a whole."""
        found = runs.history(self.table(self.runs))
        return self.table(name) if found is None else found.committed(self.table(name))

    def log_run(self, entry: runs.RunEntry, state: str) -> None:
        self.append(entry.logged(self.spark, state), self.runs)

    def append(self, df: DataFrame, name: str) -> None:
        """Append rows, fitted to the stored table's schema."""
        rows = align_to_schema(df, self.table(name).schema)
        contract = {self.exceptions: DQ_EXCEPTIONS_TABLE, self.validations: DQ_VALIDATIONS_TABLE, self.runs: DQ_RUNS}.get(name)
        if self.enforce and contract is not None:
            rows = complete_rows(rows, contract, name).select(rows.columns)
        if self.identity(name) is None:
            rows.write.insertInto(name)
        else:
            self._with_view(rows, lambda view: insert_statement(name, view, self.written(name, rows.columns)))

    def _with_view(self, rows: DataFrame, statement: Callable[[str], str]) -> None:
        view = f"rows_{uuid.uuid4().hex}"
        rows.createOrReplaceTempView(view)
        try:
            self.spark.sql(statement(view))
        finally:
            self.spark.catalog.dropTempView(view)

    def upsert(
        self, source: DataFrame, name: str, key: str, schema: StructType, staging: Staging, mode: str | None = None
    ) -> None:
        """Update the rows of a table by key and add those it lacks.

        Unless a mode is given, nulls of the source keep the old values in Hive tables
        and replace them in others.
        """
        mode = mode or (upsert.COALESCE if self.format == "hive" else upsert.OVERWRITE)
        rows = staging.put(align_to_schema(source, schema), "upsert-source")
        if not upsert.repeated_keys(rows, key).isEmpty():
            names = [row[0] for row in upsert.repeated_keys(rows, key).limit(20).collect()]
            raise ValueError(f"rows for {name} repeat values of {key}: {names}")
        if self.format == "delta" and mode == upsert.OVERWRITE:
            columns = self.written(name, rows.columns)
            self._with_view(rows, lambda view: upsert.merge_statement(name, view, key, columns))
            return
        # A table cannot be overwritten while it is read, so the result is staged. The
        # staged copy also survives a failure of the overwrite.
        merged = staging.put(upsert.upserted(self.table(name), rows, key, mode), "upsert-merged")
        merged.select(self.table(name).columns).write.insertInto(name, overwrite=True)
