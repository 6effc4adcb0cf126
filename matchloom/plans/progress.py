"""Signs of life of long statements: how far their jobs are, every few seconds."""

from __future__ import annotations

import threading
import time
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import SparkSession

EVERY = 15.0


@dataclass
class Watched:
    label: str
    seconds: float = 0.0
    signs: int = 0


def stages_of(spark: SparkSession, group: str) -> list[str]:
    """Where the unfinished stages of a job group stand."""
    tracker, out = spark.sparkContext.statusTracker(), []
    for job in tracker.getJobIdsForGroup(group):
        info = tracker.getJobInfo(job)
        for stage in info.stageIds if info else []:
            at = tracker.getStageInfo(stage)
            if at and at.numCompletedTasks < at.numTasks:
                out.append(f"stage {stage}: {at.numCompletedTasks} of {at.numTasks} tasks")
    return out


@contextmanager
def watched(spark: SparkSession, label: str, report: Callable[[str], None] = print, every: float = EVERY) -> Iterator[Watched]:
    """Runs the block as one job group; tells ``report`` its label and progress every few seconds, and its time at the end.

    The group's jobs are those that this thread starts. An error is told and goes on to the caller.
    """
    group, end, told = f"{label}-{uuid.uuid4().hex}", threading.Event(), Watched(label)
    spark.sparkContext.setJobGroup(group, label)
    begun = time.monotonic()

    def signs() -> None:
        while not end.wait(every):
            told.signs += 1
            report(f"{label}: {time.monotonic() - begun:.0f} s, {', '.join(stages_of(spark, group)) or 'nothing started'}")

    thread = threading.Thread(target=signs, daemon=True)
    thread.start()
    try:
        yield told
    except BaseException:
        report(f"{label}: failed after {time.monotonic() - begun:.0f} s")
        raise
    else:
        told.seconds = time.monotonic() - begun
        report(f"{label}: done in {told.seconds / 60:.2f} minutes")
    finally:
        end.set()
        thread.join()
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        spark.sparkContext.setLocalProperty("spark.job.description", None)
