"""Several different Spark actions at the same time."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping
from concurrent.futures import FIRST_EXCEPTION, Future, ThreadPoolExecutor, wait
from typing import TypeVar

from pyspark.sql import SparkSession
from pyspark.util import inheritable_thread_target

Result = TypeVar("Result")

AT_ONCE = 4
_POOL = "spark.scheduler.pool"
_PATIENCE = 0.2


class Cancelled(RuntimeError):
    """An action that was not run, or was stopped, because another one failed."""


def run_together(
    spark: SparkSession,
    actions: Mapping[str, Callable[[], Result]],
    *,
    at_once: int = AT_ONCE,
    tag: str | None = None,
) -> dict[str, Result]:
    """Results of ``actions`` by name, at most ``at_once`` of which run at a time.

    Each runs in a thread of its own and in a scheduler pool of its name, so that where
    ``spark.scheduler.mode`` is FAIR a short one need not wait for the stages of a long
    one. All carry ``tag``: ``spark.sparkContext.cancelJobsWithTag(tag)`` stops them as a
    group. The first error cancels the jobs of the others, keeps those that wait from
    starting, and is raised once no thread is left running. ``at_once`` bounds what the
    driver plans at a time; results stay with the actions, which should be small.
    """
    if at_once < 1:
        raise ValueError(f"{at_once} actions at once")
    context = spark.sparkContext
    tag = tag or f"together-{uuid.uuid4().hex}"
    failed: BaseException | None = None

    def run(name: str, action: Callable[[], Result]) -> Result:
        nonlocal failed
        if failed is not None:
            raise Cancelled(f"{name} was not started")
        context.setLocalProperty(_POOL, name)
        context.addJobTag(tag)
        try:
            return action()
        except BaseException as error:
            failed = failed or error
            raise
        finally:
            context.removeJobTag(tag)
            context.setLocalProperty(_POOL, None)

    with ThreadPoolExecutor(max_workers=at_once, thread_name_prefix="extract") as threads:
        running: dict[str, Future] = {
            name: threads.submit(inheritable_thread_target(spark)(run), name, action)
            for name, action in actions.items()
        }
        done, left = wait(running.values(), return_when=FIRST_EXCEPTION)
        if any(future.exception() is not None for future in done):
            for future in left:
                future.cancel()
            while left:  # an action may start one job after another
                context.cancelJobsWithTag(tag)
                left = wait(left, timeout=_PATIENCE).not_done
    errors = [f.exception() for f in running.values() if not f.cancelled() and f.exception() is not None]
    if errors:
        raise failed or errors[0]
    return {name: future.result() for name, future in running.items()}
