"""Small helpers over whole DataFrames."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

#: Independent jobs that run side by side.
JOBS = 4
_Result = TypeVar("_Result")


def side_by_side(spark: SparkSession, calls: list[Callable[[], _Result]]) -> list[_Result]:
    """The results of calls that run Spark jobs of their own: while one has its last tasks, others use the idle cores."""
    with ThreadPoolExecutor(JOBS) as pool:
        return [f.result() for f in [pool.submit(inheritable_thread_target(spark)(call)) for call in calls]]


def stack(frames: list[DataFrame]) -> DataFrame:
    """The rows of all frames, matched by column name."""
    return reduce(DataFrame.unionByName, frames)
