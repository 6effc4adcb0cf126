"""What the operators share: text expressions, scratch tables and prefix sums."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator, Sequence
from functools import cache

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from matchloom.session import ship

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SPACE = "[\\x20\\x09-\\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def unused(df: DataFrame, *stems: str) -> list[str]:
    """A name for each of ``stems`` that no column of df has, whatever its case."""
    taken, out = {c.lower() for c in df.columns}, []
    for stem in stems:
        while stem.lower() in taken:
            stem += "_"
        taken.add(stem.lower())
        out.append(stem)
    return out


def quoted(*names: str) -> list[Column]:
    """Columns by their exact names, whatever signs these hold."""
    return [F.col("`" + n.replace("`", "``") + "`") for n in names]


def set_aside(df: DataFrame, *names: str) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """df with its columns of ``names`` under unused names, and what gives them their names back."""
    clash = [c for c in df.columns if c.lower() in names]
    away = dict(zip(clash, unused(df, *[f"{c}_given" for c in clash])))
    back = {v: k for k, v in away.items()}
    return df.withColumnsRenamed(away), lambda out: out.withColumnsRenamed(back)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is evaluated once however often ``body`` names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z and nothing else."""
    return F.translate(text, UPPER, LOWER)


def words(text: Column) -> Column:
    """Lower-cased runs of anything but ASCII white space; none for null."""
    parts = F.split(ascii_lower(F.coalesce(text, F.lit(""))), SPACE)
    return F.filter(parts, lambda w: w != "")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


@cache
def _own_folder() -> str:
    folder = tempfile.mkdtemp(prefix="matchloom-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return "file://" + folder


class Scratch:
    """Tables written to the folder that the whole cluster shares.

    ``spark.checkpoint.dir`` names the folder. Where it is unset, a session on one machine (tests)
    gets a temporary folder, and any other session an error. A written table cuts lineage and
    outlives executors.
    """

    def __init__(self, spark: SparkSession, name: str):
        ship(spark)
        base = spark.conf.get("spark.checkpoint.dir", None)
        if not base:
            if not spark.sparkContext.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
            base = _own_folder()
        self.spark, self.base = spark, f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
        self.cataloged: dict[str, str] = {}

    def path(self, name: str) -> str:
        return f"{self.base}/{name}"

    def save(self, df: DataFrame, name: str, **options: str) -> DataFrame:
        df.write.options(**options).parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def save_by(self, df: DataFrame, key: str, name: str) -> DataFrame:
        """A table in as many buckets of ``key`` as a shuffle has partitions: joins by the key don't move it again.

        Spark keeps buckets for tables of the catalog only; ``drop`` takes the entry away with the files.
        """
        table_name, count = f"{name}_{uuid.uuid4().hex}", partitions(self.spark)
        self.cataloged[name] = table_name
        df.repartition(count, key).write.bucketBy(count, key).sortBy(key).option("path", self.path(name)).saveAsTable(table_name)
        return self.spark.table(table_name)

    def drop(self, *names: str) -> None:
        """Delete tables that no later plan reads."""
        jvm = self.spark.sparkContext._jvm
        for name in names:
            if name in self.cataloged:
                self.spark.sql(f"DROP TABLE IF EXISTS {self.cataloged.pop(name)}")
            path = jvm.org.apache.hadoop.fs.Path(self.path(name))
            path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def cut_points(df: DataFrame, key: str, count: int) -> tuple[list[int], int | None]:
    """At most ``count`` - 1 keys of ``df`` that cut it into ranges of like size, and the least key.

    Every cut is a key that occurs. The list's length depends on ``count`` alone.
    """
    probs = [i / count for i in range(1, count)] or [0.5]
    cuts, least = df.agg(F.percentile_approx(key, probs, 10_000), F.min(key)).first()
    return sorted({c for c in cuts or [] if c > least}) if count > 1 else [], least


def range_of(key: Column, cuts: Sequence[int]) -> Column:
    """How many of the sorted ``cuts`` are not above ``key``; two short scans, not one long one."""
    if not cuts:
        return F.lit(0)
    width = max(1, int(len(cuts) ** 0.5))
    rows = [list(cuts[i : i + width]) for i in range(0, len(cuts), width)]
    heads, fine = F.lit([r[0] for r in rows]), F.array(*[F.lit(r) for r in rows])
    below = lambda a: F.size(F.filter(a, lambda c: c <= key))
    return let(below(heads), lambda n: F.when(n == 0, 0).otherwise((n - 1) * width + below(F.get(fine, n - 1))))


def groups(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """Whole groups of rows with like keys out of batches sorted by them; one group is held at a time."""
    held: list[pd.DataFrame] = []
    for batch in batches:
        if batch.empty:
            continue
        change = (batch[keys] != batch[keys].shift()).any(axis=1).to_numpy().nonzero()[0]
        starts = [*change, len(batch)]
        for a, b in zip(starts, starts[1:]):
            part = batch.iloc[a:b]
            if held and tuple(held[0].iloc[0][keys]) != tuple(part.iloc[0][keys]):
                yield pd.concat(held) if len(held) > 1 else held[0]
                held = []
            held.append(part)
    if held:
        yield pd.concat(held) if len(held) > 1 else held[0]
