"""Counting rows while they pass, without a second scan."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark import InheritableThread, SparkContext
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tablegate.spec import quote_name


def observe_rows(df: DataFrame, observation: Observation, **extra: Column) -> DataFrame:
    """Collect ``rows`` and ``<column>_nulls`` (plus any extra aggregates) as ``df`` is read."""
    metrics = [F.count(F.lit(1)).alias("rows")]
    for name in df.columns:
        metrics.append(F.count_if(F.col(quote_name(name)).isNull()).alias(f"{name}_nulls"))
    metrics.extend(column.alias(name) for name, column in extra.items())
    return df.observe(observation, *metrics)


def observe_success(df: DataFrame, observation: Observation, ok: Column) -> DataFrame:
    """Collect ``attempts``, ``successes`` and their ratio ``ok_ratio``.

    The ratio is null when there were no attempts.
    """
    return df.observe(
        observation,
        F.count(F.lit(1)).alias("attempts"),
        F.count_if(ok).alias("successes"),
        F.avg(F.when(ok, 1.0).otherwise(0.0)).alias("ok_ratio"),
    )


def drain(df: DataFrame) -> None:
    """Read every row and keep none: the full decode happens, nothing is stored."""
    df.write.format("noop").mode("overwrite").save()


def read_metrics(df: DataFrame, observation: Observation) -> dict[str, object]:
    """Run ``df`` to the end and return what ``observation`` collected on the way."""
    drain(df)
    return observation.get


@dataclass(frozen=True)
class Progress:
    """How far a running read has come: tasks of the stages begun so far, and what ended tasks have read."""

    tasks: int
    tasks_done: int
    rows_read: int
    bytes_read: int


def drain_watched(df: DataFrame, on_progress: Callable[[Progress], None], every: float = 1.0) -> Progress:
    """Read every row, calling ``on_progress`` from time to time until the read ends; returns the last state.

    The numbers come from Spark's own record of running stages, so nothing is
    added to the plan. An error of the read is raised here.
    """
    context = df.sparkSession.sparkContext
    group = f"tablegate-{uuid.uuid4().hex}"
    failed: list[BaseException] = []

    def read() -> None:
        context.setJobGroup(group, "watched read")
        try:
            drain(df)
        except BaseException as error:  # noqa: BLE001
            failed.append(error)

    worker = InheritableThread(target=read, session=df.sparkSession)
    worker.start()
    while worker.is_alive():
        worker.join(every)
        on_progress(progress_of(context, group))
    if failed:
        raise failed[0]
    context._jsc.sc().listenerBus().waitUntilEmpty()
    return progress_of(context, group)


def progress_of(context: SparkContext, group: str) -> Progress:
    """State of all stages that a job group has begun."""
    tracker, store = context.statusTracker(), context._jsc.sc().statusStore()
    tasks = done = rows = size = 0
    jobs = (tracker.getJobInfo(job) for job in tracker.getJobIdsForGroup(group))
    for stage in sorted({stage for job in jobs if job is not None for stage in job.stageIds}):
        known = tracker.getStageInfo(stage)
        if known is None:
            continue
        tasks, done = tasks + known.numTasks, done + known.numCompletedTasks
        seen = store.lastStageAttempt(stage)
        rows, size = rows + seen.inputRecords(), size + seen.inputBytes()
    return Progress(tasks, done, rows, size)
