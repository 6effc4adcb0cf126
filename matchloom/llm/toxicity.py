"""Severity of toxic text by cumulative-link ordinal regression.

The model has one weight for each sparse feature, shared by all grades, and one threshold for each
step from a grade to the next: P(grade > k) = sigmoid(score - threshold_k). A document's score is the sum of
the weights of its features: its distinct words and their beginnings, so that inflected and
compound forms of a known word count too. The expected severity is the sum of P(grade > k) over the thresholds.

Weights are not negative and thresholds are at least ``FLOOR``, so a text without known words is clean.

It is fitted on a bounded sample of labelled rows (``SAMPLE`` of each label at most, by the hash of
their ids) by proximal gradient steps, which set the weights of uninformative features to zero.
Labels say 0 or 1. The grades 1 and 2 of the labelled toxic rows are told apart by how many
different words they have that only toxic rows have, up to or above the median.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, IntegerType, StructField, StructType

from matchloom.llm.common import Scratch, quoted
from matchloom.session import ship


GRADES, AT_ONCE = 3, 200_000
SAMPLE, LEAST_ROWS, STEPS, PENALTY, SCREEN, RATIO, REJECT, FLOOR = 4000, 4, 600, 1e-4, 1e-2, 3.0, 0.5, 1.0
BEGINNINGS = (4, 5, 6)
WORD = re.compile(r"[^\W\d_]+")


def features(word: str) -> list[str]:
    return [f"={word}", *[word[:k] for k in BEGINNINGS if len(word) > k]]


def distinct_words(text: str | None) -> set[str]:
    return set(WORD.findall((text or "").lower()))


@dataclass(frozen=True)
class Severity:
    """Thresholds in ascending order and the weights that are not zero."""

    thresholds: tuple[float, ...]
    weights: dict[str, float]

    def chances(self, scores: np.ndarray) -> np.ndarray:
        """P(grade > k), a row for each score."""
        return 1 / (1 + np.exp(np.clip(np.asarray(self.thresholds)[None, :] - scores[:, None], -500, 500)))


def train(names: list[str], cols: np.ndarray, starts: np.ndarray, grade: np.ndarray, grades: int) -> Severity:
    """Fit to rows of a sparse matrix: row k has the features ``cols[starts[k] : starts[k + 1]]`` and the grade ``grade[k]``.

    Grades go from 0 to grades - 1. Without two different ones the model says grade 0 for all.
    """
    if len(np.unique(grade)) < 2:
        return Severity(tuple([500.0] * (grades - 1)), {})
    rows = len(grade)
    # rows of a rare grade weigh more, so that clean and toxic rows count alike
    weigh = np.where(grade > 0, 0.5 / max(1, (grade > 0).sum()), 0.5 / max(1, (grade == 0).sum()))
    x = np.ones(len(cols))
    row_of = np.repeat(np.arange(rows), np.diff(starts))
    above = (grade[:, None] > np.arange(grades - 1)[None, :]).astype(float)
    weigh = weigh[:, None]
    w, t = np.zeros(len(names)), np.full(grades - 1, FLOOR)
    z, s, momentum = w.copy(), t.copy(), 1.0
    v = np.ones(len(names))
    for _ in range(20):  # the steepest direction
        size = np.linalg.norm(v)
        v = v / (size or 1.0)
        v = np.bincount(cols, weights=x * (np.bincount(row_of, weights=x * v[cols], minlength=rows) * weigh[:, 0])[row_of], minlength=len(names))
    rate = 4.0 / ((1.1 * np.linalg.norm(v) + 1.0) * (grades - 1))
    for _ in range(STEPS):
        score = np.bincount(row_of, weights=x * z[cols], minlength=rows)
        p = 1 / (1 + np.exp(np.clip(s[None, :] - score[:, None], -500, 500)))
        slope = (p - above) * weigh
        pull = np.bincount(cols, weights=x * slope.sum(axis=1)[row_of], minlength=len(names))
        new = z - rate * pull
        new = np.maximum(new - rate * PENALTY, 0)  # words can only add to the severity
        new_t = np.maximum.accumulate(np.maximum(s + rate * slope.sum(axis=0), FLOOR))
        ahead = (1 + np.sqrt(1 + 4 * momentum * momentum)) / 2
        z = new + (momentum - 1) / ahead * (new - w)
        s = np.maximum.accumulate(new_t + (momentum - 1) / ahead * (new_t - t))
        w, t, momentum = new, new_t, ahead
    kept = np.flatnonzero(w)
    return Severity(tuple(float(v) for v in t), {names[k]: float(w[k]) for k in kept})


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, label: str = "toxic") -> Severity:
    """The model from labelled documents: at most ``sample`` of either label, the least by the hash of their ids.

    labels needs doc_id and ``label`` (0, 1; rows with a null are ignored; an id with both counts
    as 1). Ids without a document and documents without text are no use and are left out; repeated
    rows of a document count once each. Without labels of both kinds the model rejects nothing.
    Features are counted and screened where the texts are; the driver gets the screened ones alone.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "toxicity")
    known = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull()).select("doc_id", F.col(label).cast("int").alias("label"))
    known = known.groupBy("doc_id").agg(F.max("label").alias("label")).withColumn("turn", F.xxhash64("doc_id"))
    chosen = [known.where(F.col("label") == v).orderBy("turn", "doc_id").limit(sample) for v in (0, 1)]
    some = F.broadcast(chosen[0].unionByName(chosen[1]))  # 2 * sample rows at most
    rows = scratch.save(docs.select("doc_id", "text").where("text is not null").join(some, "doc_id").select("label", "text"), "sample")
    sums = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(sums) < 2:
        return train([], np.zeros(0, int), np.zeros(1, int), np.zeros(0, int), GRADES)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = ({}, {})

        def held() -> pa.RecordBatch:
            found = list(seen[0].keys() | seen[1].keys())
            out = pa.RecordBatch.from_arrays([pa.array(found, pa.string()), *[pa.array([s.get(f, 0) for f in found], pa.int64()) for s in seen]], names=["feature", "clean", "toxic"])
            seen[0].clear()
            seen[1].clear()
            return out

        for batch in batches:
            for y, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for f in {f for w in distinct_words(text) for f in features(w)}:
                    seen[y][f] = seen[y].get(f, 0) + 1
                if len(seen[0]) + len(seen[1]) > AT_ONCE:
                    yield held()
        yield held()

    counts = rows.mapInArrow(count, "feature string, clean long, toxic long").groupBy("feature").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    least = min(LEAST_ROWS, max(1, sum(sums.values()) // 8))
    # features that toxic rows do not have by far more often than clean ones are left out
    share = (F.col("toxic") + F.col("clean") >= least) & (0.5 * F.col("toxic") / sums[1] > SCREEN + RATIO * 0.5 * F.col("clean") / sums[0])
    telling = F.col("feature").startswith("=") & (F.col("toxic") >= LEAST_ROWS) & (F.col("clean") == 0)
    kept = counts.select("feature", share.alias("share"), telling.alias("telling")).where("share or telling").collect()  # words of the sample's toxic rows at most
    names = sorted(r["feature"] for r in kept if r["share"])
    shared = spark.sparkContext.broadcast(({f: k for k, f in enumerate(names)}, {r["feature"] for r in kept if r["telling"]}))
    del kept

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, tells = shared.value
        for batch in batches:
            out = []
            for text in batch.column(1).to_pylist():
                found = {f for w in distinct_words(text) for f in features(w)}
                out.append((sorted(index[f] for f in found if f in index), sum(f in tells for f in found)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([o[0] for o in out], pa.list_(pa.int32())), pa.array([o[1] for o in out], pa.int32())], names=["label", "cols", "known"])

    found = rows.mapInArrow(look_up, "label int, cols array<int>, known int").toArrow()
    shared.destroy()
    scratch.drop("sample")
    lists, label_of, known_of = found.column("cols").combine_chunks(), found.column("label").to_numpy(), found.column("known").to_numpy()
    middle = float(np.median(known_of[label_of == 1]))
    grade = np.where(label_of == 0, 0, np.where(known_of > middle, 2, 1))
    sizes = lists.value_lengths().to_numpy()
    starts, cols = np.concatenate([[0], np.cumsum(sizes)]), lists.flatten().to_numpy()
    # rows in an order of their own, so that the sums do not depend on how the rows arrived
    order = sorted(range(len(grade)), key=lambda k: (int(grade[k]), cols[starts[k] : starts[k + 1]].tobytes()))
    cols = np.concatenate([cols[starts[k] : starts[k + 1]] for k in order])
    return train(names, cols, np.concatenate([[0], np.cumsum(sizes[order])]), grade[order], GRADES)


def score(docs: DataFrame, model: Severity, reject: float = REJECT) -> DataFrame:
    """docs with severity (0 to the number of thresholds), p_toxic, grade and toxic.

    p_toxic: the chance of any grade above 0; grade: how many thresholds are more likely passed
    than not; toxic: p_toxic >= ``reject``. Every row stays; null and empty texts have no words and
    get what the thresholds alone say, which is clean. Columns of those four names are replaced.
    """
    ship(docs.sparkSession)
    names = [c for c in docs.columns if c.lower() not in ("severity", "p_toxic", "grade", "toxic")]
    shared = docs.sparkSession.sparkContext.broadcast(model)  # as large as the sample's vocabulary at most
    at = names.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, cache = shared.value, {}
        weights = m.weights

        def total(words: set[str]) -> float:
            found = set()
            for w in words:
                hits = cache.get(w)
                if hits is None:
                    hits = cache[w] = tuple(f for f in features(w) if f in weights)
                found.update(hits)
            return sum(weights[f] for f in sorted(found))

        for batch in batches:
            scores = []
            for text in batch.column(at).to_pylist():
                if len(cache) > 100_000:
                    cache.clear()
                scores.append(total(distinct_words(text)))
            p = m.chances(np.array(scores, float))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(names)], pa.array(p.sum(axis=1)), pa.array(p[:, 0]), pa.array((p >= 0.5).sum(axis=1).astype(np.int32)), pa.array(p[:, 0] >= reject)],
                names=[*names, "severity", "p_toxic", "grade", "toxic"],
            )

    return docs.select(*quoted(*names)).mapInArrow(run, StructType([*[f for f in docs.schema if f.name in names], *[StructField(n, t()) for n, t in (("severity", DoubleType), ("p_toxic", DoubleType), ("grade", IntegerType), ("toxic", BooleanType))]]))
