"""Repeated timing of queries."""

from __future__ import annotations

import statistics
import time
from collections.abc import Callable

from pyspark.sql import DataFrame


def mark(queries: dict[str, Callable[[], DataFrame]], iterations: int = 5, warmup: int = 1) -> list[dict]:
    """Time each query ``iterations`` times into a sink that discards the rows; planning counts.

    Gives name, median, shortest and longest time in seconds, in the order of ``queries``.
    """
    results = []
    for name, build in queries.items():
        seconds = []
        for _ in range(warmup + iterations):
            start = time.perf_counter()
            build().write.format("noop").mode("overwrite").save()
            seconds.append(time.perf_counter() - start)
        counted = seconds[warmup:]
        results.append(
            {"name": name, "median": statistics.median(counted), "min": min(counted), "max": max(counted)}
        )
    return results
