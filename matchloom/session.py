"""Sessions, and the package's own code on the executors."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
import zipfile
from functools import cache
from pathlib import Path

from pyspark.sql import SparkSession

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give this package's code to the Python workers, once for each application.

    Spark's file server hands the archive out, so executors need no copy and no path of their own.
    """
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    root = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="code-")) / f"{root.name}.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
    context.addPyFile(str(archive))
    _SHIPPED.add(context.applicationId)


@cache
def _own_folder() -> str:
    folder = tempfile.mkdtemp(prefix="tables-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return "file://" + folder


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below spark.checkpoint.dir. Where that is unset, on one machine, one that goes when the process ends."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = _own_folder()
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def local_session(cores: str = "*", memory: str = "8g", partitions: int = 8) -> SparkSession:
    """A session on one machine, for tests and measurements."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("matchloom")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
