"""Counters gathered while a table is written, instead of by scans of their own.

Metrics are observed on the frames of the plan that writes the table and are
there when the write is done.  A metric below a shuffle may take in a task twice
when its stage is run again after an executor is lost, so the jobs of the write
are watched: ``action`` reports whether any of their tasks failed or ran in
a second attempt, and the caller then counts anew.  Metrics must not be observed
between a shuffle and a range partitioning, whose sampling job runs that part twice.
"""
from __future__ import annotations

import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession

GROUP = "spark.jobGroup.id"


def observe(df: DataFrame, metrics: dict[str, Column]) -> tuple[DataFrame, Observation]:
    seen = Observation(f"tidewell-{uuid.uuid4().hex}")
    return df.observe(seen, *[c.alias(k) for k, c in metrics.items()]), seen


def counters(*seen: Observation) -> dict[str, int] | None:
    """The metrics of finished writes; None where the optimiser proved an
    observed frame empty and dropped its metrics with it."""
    out: dict[str, int] = {}
    for one in seen:
        try:
            out |= one.get
        except Py4JJavaError:
            return None
    return out


def undisturbed(spark: SparkSession, action: Callable[[], None]) -> bool:
    """Run ``action`` in a job group of its own; whether each of its tasks ran once."""
    sc = spark.sparkContext
    before, group = sc.getLocalProperty(GROUP), f"tidewell-{uuid.uuid4().hex}"
    sc.setLocalProperty(GROUP, group)
    try:
        action()
    finally:
        sc.setLocalProperty(GROUP, before)
    tracker = sc.statusTracker()
    for job in tracker.getJobIdsForGroup(group):
        info = tracker.getJobInfo(job)
        for stage in info.stageIds if info else [None]:
            seen = tracker.getStageInfo(stage) if stage is not None else None
            if seen is None and stage is not None and info.status == "SUCCEEDED":
                continue                       # skipped: its output was there
            if seen is None or seen.numFailedTasks or seen.currentAttemptId:
                return False
    return True
