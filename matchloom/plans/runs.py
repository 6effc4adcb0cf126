"""Stages kept as tables, so that a run that broke off goes on where it stopped."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterable
from dataclasses import asdict, is_dataclass
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from matchloom.operators.measures import Measures
from matchloom.sources.publish import file_system, published
from matchloom.sources.tables import exists, write_json


def listed(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """(path, length, time of change) of a file or of every file below a folder, in order."""
    at, fs = file_system(spark, path)
    found, out = fs.listFiles(at, True), []
    while found.hasNext():
        f = found.next()
        out.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return sorted(out)


class RunStore:
    """Tables of one run in ``folder``, under a key of its configuration and of the files it reads.

    A stage's rows are written beside their place and moved there when whole; then its manifest is,
    with what was measured on the way. A stage with a manifest is read, not built, by whatever
    session asks next. Another configuration or changed input makes another key, so nothing stale is read.
    """

    def __init__(self, spark: SparkSession, folder: str, config: Any = None, inputs: Iterable[str] = ()):
        told = asdict(config) if is_dataclass(config) else config
        files = [f for path in inputs for f in listed(spark, path)]
        key = hashlib.sha256(json.dumps([told, files], sort_keys=True, default=str).encode()).hexdigest()[:16]
        self.spark, self.base, self.order = spark, f"{folder.rstrip('/')}/{key}", []

    def _manifest(self, stage: str) -> str:
        return f"{self.base}/manifests/{stage}.json"

    def done(self, stage: str) -> dict | None:
        """The stage's manifest, if it is complete."""
        path = self._manifest(stage)
        if not exists(self.spark, path):
            return None
        at, fs = file_system(self.spark, path)
        stream = fs.open(at)
        try:
            return json.loads(bytes(stream.readAllBytes()))
        finally:
            stream.close()

    def table(self, stage: str, build: Callable[[], DataFrame], measures: Measures | None = None) -> DataFrame:
        """The table of ``stage``: read if it is complete, else built, measured and written."""
        self.order.append(stage)
        path = f"{self.base}/{stage}"
        if self.done(stage) is None:
            measures = measures or Measures()
            with published(self.spark, path) as side:
                measures.on(build()).write.parquet(side)
            with published(self.spark, self._manifest(stage)) as side:
                write_json(self.spark, {"stage": stage, "measures": measures.result()}, side)
        return self.spark.read.parquet(path)

    def summary(self) -> dict[str, dict[str, int]]:
        """What was measured of each stage asked for, in order."""
        return {stage: self.done(stage)["measures"] for stage in dict.fromkeys(self.order)}
