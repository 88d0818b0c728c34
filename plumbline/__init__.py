"""Table-driven data-quality rules, checked by Spark.

Rules are rows of a table; a run checks them against their target tables and
yields one validation row per rule and one exception row per failing data row.
"""

from plumbline.spec import RuleSpec
from plumbline.plans.run import RunResult, run_rules
from plumbline.plans.workflow import run_workflow

__all__ = ["RuleSpec", "RunResult", "run_rules", "run_workflow"]
