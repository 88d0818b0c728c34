"""Independent Spark jobs side by side, so that the tail of one leaves no idle cluster."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

AT_ONCE = 4


def together(spark: SparkSession, work: Iterable[Callable[[], Any]], at_once: int = AT_ONCE) -> list:
    """Results of the calls in their order; an error of any of them is raised.

    The threads only submit jobs, and keep the caller's job group, properties and tags.
    """
    calls = [inheritable_thread_target(spark)(call) for call in work]
    if len(calls) < 2:
        return [call() for call in calls]
    with ThreadPoolExecutor(max(1, min(at_once, len(calls)))) as pool:
        return [future.result() for future in [pool.submit(call) for call in calls]]
