"""Independent writes side by side, so that one's last tasks do not idle the cluster."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession


def write_together(spark: SparkSession, writes: Iterable[Callable[[], None]]) -> None:
    """Run all writes; if some fail, the first error is raised once all have ended."""
    jobs = [inheritable_thread_target(spark)(w) for w in writes]
    with ThreadPoolExecutor(max_workers=len(jobs)) as pool:
        for running in [pool.submit(job) for job in jobs]:
            running.result()
