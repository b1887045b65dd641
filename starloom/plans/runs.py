"""Writes that depend on each other, run as concurrent Spark jobs."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import FIRST_COMPLETED, Future, ThreadPoolExecutor, wait
from dataclasses import dataclass
from graphlib import TopologicalSorter
from typing import Any
from uuid import uuid4

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession


@dataclass(frozen=True)
class Step:
    """Something to be done once the steps named in ``after`` are done.

    ``run`` gets the results of those by name and returns its own.
    """

    run: Callable[[Mapping[str, Any]], Any]
    after: Sequence[str] = ()


def run_steps(spark: SparkSession, steps: Mapping[str, Step], at_once: int = 8) -> dict[str, Any]:
    """Results of all steps by name; steps that do not wait for each other run at the same time.

    Small jobs leave most of a cluster idle, so independent writes overlap: each step has a thread
    with the local properties of the caller and a fair-scheduler pool of its own, so that no write
    waits for the last task of another. ``at_once`` bounds how many are under way. When a step
    fails, no other is started, the jobs of those under way are cancelled and, once they have
    ended, its exception is raised. A name in ``after`` that is no step, and steps that wait for
    each other in a circle, are refused before anything runs.
    """
    unknown = {name for step in steps.values() for name in step.after} - set(steps)
    if unknown:
        raise ValueError(f"steps wait for {', '.join(sorted(unknown))}, which are not among them")
    order = TopologicalSorter({name: step.after for name, step in steps.items()})
    order.prepare()
    tag, results, failure = f"steps-{uuid4().hex}", {}, None

    def run(name: str) -> Any:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"{tag}-{name}")
        spark.sparkContext.addJobTag(tag)
        return steps[name].run({before: results[before] for before in steps[name].after})

    with ThreadPoolExecutor(max(1, at_once), thread_name_prefix="steps") as threads:
        under_way: dict[Future, str] = {}
        while failure is None and order.is_active():
            for name in order.get_ready():
                # Made anew for each step: a thread of the pool keeps what an earlier step has set.
                under_way[threads.submit(inheritable_thread_target(spark)(run), name)] = name
            done, _ = wait(under_way, return_when=FIRST_COMPLETED)
            for future in done:
                name = under_way.pop(future)
                if future.exception() is not None:
                    failure = failure or future.exception()
                else:
                    results[name] = future.result()
                    order.done(name)
        if failure is not None:
            for future in under_way:
                future.cancel()
            # A step may be about to submit its next job when those it has are cancelled.
            while under_way and wait(under_way, timeout=0.2).not_done:
                spark.sparkContext.cancelJobsWithTag(tag)
    if failure is not None:
        raise failure
    return results
