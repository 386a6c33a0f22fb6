"""Session settings the jobs are written for."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

Result = TypeVar("Result")
#: Tables that are made side by side.
AT_ONCE = 4

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot key even where that costs another shuffle afterwards.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.parquet.compression.codec": "snappy",
}


def build_session(app_name: str = "ledgerloom", master: str | None = None, **extra: str) -> SparkSession:
    """Session with the settings above; ``extra`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = SETTINGS | {key.replace("__", "."): value for key, value in extra.items()}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def at_once(spark: SparkSession, steps: Iterable[Callable[[], Result]], n: int = AT_ONCE) -> list[Result]:
    """Run steps that do not need each other side by side, their results in order.

    The last tasks of one table, or a table of few files, leave cores idle that another can
    use.  The first error is raised; steps not begun by then are left out.
    """
    with ThreadPoolExecutor(n) as pool:
        begun = [pool.submit(inheritable_thread_target(spark)(step)) for step in steps]
        try:
            return [step.result() for step in begun]
        except BaseException:
            pool.shutdown(cancel_futures=True)
            raise


def session_aside(spark: SparkSession) -> SparkSession:
    """A session of the same settings, for counts observed on the way of the rows.

    A session that has observed any cannot be serialised, and fitted models hold theirs.
    """
    aside = spark.newSession()
    for name, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(name):
            aside.conf.set(name, value)
    return aside
