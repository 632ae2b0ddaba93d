"""Actions that run at the same time: results, bounds, errors, cancelling."""

import threading
import time

import pytest
from pyspark.sql import functions as F

from millrace.operators.concurrent import Cancelled, run_together


def slow(spark, rows=4):
    """Takes hours if nobody stops it."""
    return spark.range(10**13).select(F.sum(F.hash("id"))).collect()


def test_results_come_by_name(spark):
    actions = {f"a{i}": lambda i=i: spark.range(i).count() for i in range(7)}
    assert run_together(spark, actions, at_once=3) == {f"a{i}": i for i in range(7)}
    assert run_together(spark, {}) == {}


def test_number_at_once_is_bounded(spark):
    lock, now, most, pools = threading.Lock(), 0, 0, {}

    def action(name):
        nonlocal now, most
        with lock:
            now, most = now + 1, max(most, now + 1)
        pools[name] = spark.sparkContext.getLocalProperty("spark.scheduler.pool")
        time.sleep(0.1)
        with lock:
            now -= 1
        return spark.range(10).count()

    run_together(spark, {f"a{i}": lambda i=i: action(f"a{i}") for i in range(6)}, at_once=2)
    assert most == 2
    assert pools == {f"a{i}": f"a{i}" for i in range(6)}
    with pytest.raises(ValueError):
        run_together(spark, {}, at_once=0)


def test_first_error_stops_the_others(spark):
    started = []

    def bad():
        time.sleep(1)
        raise KeyError("broken")

    def several():
        while True:  # one job after another
            slow(spark)

    before = time.perf_counter()
    with pytest.raises(KeyError, match="broken"):
        run_together(
            spark,
            {"bad": bad, "slow": lambda: slow(spark), "several": several, "late": lambda: started.append(1)},
            at_once=3,
        )
    assert time.perf_counter() - before < 30
    assert not started
    assert spark.range(5).count() == 5


def test_cancelled_as_a_group(spark):
    def cancel():
        time.sleep(1.5)
        spark.sparkContext.cancelJobsWithTag("extracts-of-today")

    thread = threading.Thread(target=cancel)
    thread.start()
    with pytest.raises(Exception, match="(?i)cancel"):
        run_together(spark, {"a": lambda: slow(spark), "b": lambda: slow(spark)}, tag="extracts-of-today")
    thread.join()
    assert issubclass(Cancelled, RuntimeError)
