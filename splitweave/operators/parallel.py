"""Independent jobs of several tables, submitted together."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

JOBS_AT_ONCE = 4


def failure(e: Exception) -> str:
    """The status of a table whose step raised an error; the other tables go on."""
    return "failed: " + (str(e).strip().splitlines() or [type(e).__name__])[0]


def at_once(spark: SparkSession, work: Callable[[str], object], names: Iterable[str]) -> dict[str, object]:
    """``{name: work(name)}``. One table's last tasks then do not leave the cluster idle; Spark does the scheduling."""
    names = list(names)
    with ThreadPoolExecutor(JOBS_AT_ONCE) as pool:
        jobs = {n: pool.submit(inheritable_thread_target(spark)(work), n) for n in names}
        return {n: j.result() for n, j in jobs.items()}
