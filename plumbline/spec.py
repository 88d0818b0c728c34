"""A rule as the checks see it, and what can be wrong with one."""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import Row


class RuleError(Exception):
    """A rule that cannot be checked as it is written."""

    def __init__(self, reason: str, message: str):
        super().__init__(message)
        self.reason = reason
        self.message = message


@dataclass(frozen=True)
class RuleSpec:
    """What one check needs to know of its rule."""

    rule_key: int
    check: str
    arguments: dict = field(default_factory=dict)
    key_columns: tuple[str, ...] = ()
    column: str | None = None
    condition: str | None = None
    catalog: str | None = None
    schema: str | None = None
    table: str | None = None

    @property
    def asset(self) -> str:
        return "-".join(part for part in (self.catalog, self.schema, self.table) if part is not None)

    @classmethod
    def from_row(cls, row: Row) -> RuleSpec:
        if row["arguments_json"] is None:
            raise RuleError("bad_arguments", f"not a JSON object: {row['gx_arguments']}")
        try:
            arguments = json.loads(row["arguments_json"])
        except json.JSONDecodeError as error:
            raise RuleError("bad_arguments", str(error)) from error
        if not row["check_name"]:
            raise RuleError("unknown_check", f"rule type {row['rule_type_key']} names no check")
        return cls(
            rule_key=row["rule_key"],
            check=row["check_name"],
            arguments=arguments,
            key_columns=tuple(row["key_columns"] or ()),
            column=row["column"],
            condition=row["gx_conditions"],
            catalog=row["catalog"],
            schema=row["schema"],
            table=row["table_name"],
        )
