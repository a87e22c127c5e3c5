"""Independent Spark jobs side by side, so that the short tail of one job does
not leave the executors idle."""

from __future__ import annotations

from collections.abc import Callable, Hashable
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

Name = TypeVar("Name", bound=Hashable)
Result = TypeVar("Result")


def in_parallel(
    spark: SparkSession, tasks: dict[Name, Callable[[], Result]], threads: int
) -> dict[Name, Result]:
    """Runs the tasks and returns their results by name. The first error raises
    once the running tasks have ended; those not yet started are dropped."""
    inherit = inheritable_thread_target(spark)
    with ThreadPoolExecutor(max_workers=threads) as pool:
        running = {n: pool.submit(inherit(task)) for n, task in tasks.items()}
        try:
            return {name: future.result() for name, future in running.items()}
        except BaseException:
            pool.shutdown(cancel_futures=True)
            raise
