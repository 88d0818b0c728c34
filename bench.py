"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR is the data (default /root/testdata/sf0.1), BENCH_CPUS the local cores.
Each query runs to completion (all rows made, none kept) twice; the second run is timed, so
that the numbers tell the work and not the first compilation of generated code.
"""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
CPUS = os.environ.get("BENCH_CPUS", "8")
HEADLINE = [
    "rule_metrics",
    "exception_rows",
    "chk_between_strict",
    "chk_unique",
    "chk_compound_unique",
    "chk_in_set_table",
    "chk_pair_gt",
    "chk_sql_rows",
    "run_asset",
    "ledger_classify",
    "validation_rows",
    "surrogate_keys",
]


def finish(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    import query_catalog as catalog

    def separate_scans(metrics: bool) -> None:
        """The rules of rule_metrics and exception_rows, one scan each, for comparison."""
        lines = catalog.table(spark, SF_DIR, "lineitem")
        for spec, _, _ in catalog.line_rules():
            finish(catalog.measured(lines, [spec]) if metrics else catalog.failing(lines, [spec]))

    work = {name: lambda name=name: finish(catalog.QUERIES[name](spark, SF_DIR)) for name in HEADLINE}
    work["rule_metrics_separate_scans"] = lambda: separate_scans(True)
    work["exception_rows_separate_scans"] = lambda: separate_scans(False)

    seconds = {}
    for name, run in work.items():
        run()
        start = time.perf_counter()
        run()
        seconds[name] = round(time.perf_counter() - start, 3)
    total = round(sum(seconds[name] for name in HEADLINE), 3)
    print(json.dumps({
        "metric": "headline_total", "value": total, "unit": "sec", "queries": seconds,
        "sf": os.path.basename(SF_DIR).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
