"""Whitening of embeddings by the principal components of their distinct whole-numbered vectors.

An entry c becomes the whole number x = floor(64 * c) + 1000000. The fit list is each distinct x
vector once: n of them, with sums S in each dimension. Sums are exact, so the centred entry
(n*x - S) / n is rounded once, and the covariance is that of exactly centred rows: the Gramian of a
RowMatrix over n. Its eigenvectors are found on the driver (a matrix as large as the vectors are
long, squared), broadcast, and applied to every row in its task.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector
from pyspark.mllib.linalg.distributed import RowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchloom.llm.common import Scratch
from matchloom.session import ship

COMPONENTS, SCALE, SHIFT = 16, 64, 1_000_000
#: Entries saturate here, where doubles stop holding every whole number.
LIMIT = 2.0**53
#: A direction with less than this share of the greatest variance has none: what is left there is rounding.
LEAST_SHARE = 1e-11
LOW_BITS = 20
#: Numbers that a task works on at a time.
AT_ONCE = 1 << 20


@dataclass(frozen=True)
class Whitening:
    """``quotient`` and ``rest`` are S divided by n; ``axes`` has a unit eigenvector in each column."""

    n: int
    quotient: np.ndarray
    rest: np.ndarray
    axes: np.ndarray
    variances: np.ndarray
    explained: np.ndarray
    identity_error: float = 0.0

    @property
    def length(self) -> int:
        return len(self.quotient)


def is_finite(vector: Column) -> Column:
    """Whether a vector is there and has only finite entries."""
    fine = F.forall(vector, lambda c: F.coalesce(~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf")), F.lit(False)))
    return F.coalesce(vector.isNotNull() & fine, F.lit(False))


def whole_numbers(vector: Column) -> Column:
    near = lambda c: F.greatest(F.least(c.cast("double") * SCALE, F.lit(LIMIT)), F.lit(-LIMIT))
    return F.transform(vector, lambda c: F.floor(near(c)) + SHIFT)


def _means(fit: DataFrame) -> tuple[int, np.ndarray, np.ndarray]:
    """n, and S // n and S % n of each dimension: exact, from sums of high and of low bits."""
    high, low = F.shiftright("x", LOW_BITS), F.col("x").bitwiseAND(F.lit((1 << LOW_BITS) - 1))
    sums = fit.select(F.posexplode("x").alias("pos", "x")).groupBy("pos").agg(F.count("*").alias("n"), F.sum(high).alias("high"), F.sum(low).alias("low")).orderBy("pos").collect()
    both = [divmod((r["high"] << LOW_BITS) + r["low"], r["n"]) for r in sums]
    return sums[0]["n"], np.array([b[0] for b in both], np.int64), np.array([b[1] for b in both], np.int64)


def _gramian(rows: DataFrame, column: Column) -> np.ndarray:
    """Sums of products of an array column's entries, made of vectors where the rows are."""
    vectors = MLUtils.convertVectorColumnsFromML(rows.select(array_to_vector(column).alias("v")), "v")
    return RowMatrix(vectors).computeGramianMatrix().toArray()


def _centred(n: int, quotient: np.ndarray, rest: np.ndarray) -> Column:
    """(n*x - S) / n of the entries of x, rounded once where the numerator fits a long."""
    q, r = F.lit(quotient.tolist()), F.lit(rest.tolist())

    def one(x: Column, i: Column) -> Column:
        off, left = x - F.get(q, i), F.get(r, i)
        exact = F.try_subtract(F.try_multiply(off, F.lit(n).cast("long")), left)
        return F.coalesce(exact.cast("double") / n, off.cast("double") - left.cast("double") / n)

    return F.transform("x", one)


def components_of(covariance: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Unit eigenvectors as columns, their eigenvalues falling, and their shares of the trace.

    The greatest entry of each vector is positive. Directions without variance are left out.
    """
    values, vectors = np.linalg.eigh((covariance + covariance.T) / 2)
    values, vectors = values[::-1], vectors[:, ::-1]
    keep = np.flatnonzero(values > max(LEAST_SHARE * values[0], 0.0))[:count]
    values, vectors = values[keep], vectors[:, keep]
    signs = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(len(keep))])
    return vectors * signs, values, values / np.trace(covariance)


def fit_whitening(df: DataFrame, scratch: Scratch, vector: str = "embedding", count: int = COMPONENTS) -> Whitening | None:
    """The whitening by all distinct vectors of df; None if no vector can be used.

    Null vectors and those with null or non-finite entries are not used. The vectors' length is that
    of most distinct ones (the greater one of like many); others are not used. Repeated rows count once.
    """
    given = df.where(is_finite(F.col(vector)) & (F.size(vector) > 0)).select(whole_numbers(F.col(vector)).alias("x"))
    fit = scratch.save(given.distinct(), "fit")
    most = fit.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    if most is None:
        return None
    fit = fit.where(F.size("x") == most["d"])
    n, quotient, rest = _means(fit)
    axes, variances, explained = components_of(_gramian(fit, _centred(n, quotient, rest)) / n, count)
    model = Whitening(n, quotient, rest, axes, variances, explained)
    if not len(variances):
        return model
    # the covariance of what the fit list becomes, measured as it comes out
    white = scratch.save(_project(fit.select(F.lit("").alias("key"), "x"), model).select("whitened"), "white")
    means = [r["mean"] for r in white.select(F.posexplode("whitened").alias("pos", "w")).groupBy("pos").agg(F.avg("w").alias("mean")).orderBy("pos").collect()]
    off = _gramian(white, F.transform("whitened", lambda w, i: w - F.get(F.lit(means), i))) / n - np.eye(len(means))
    scratch.drop("white", "fit")
    return Whitening(n, quotient, rest, axes, variances, explained, float(np.abs(off).max()))


def squares(numerators: np.ndarray) -> list[int]:
    """Exact sums of squares of each row."""
    if (np.square(numerators.astype(float)).sum(axis=1) < 2.0**62).all():
        return [int(v) for v in np.square(numerators).sum(axis=1)]
    return [sum(v * v for v in row) for row in numerators.tolist()]


def _project(rows: DataFrame, model: Whitening) -> DataFrame:
    """(key, deviation as digits, whitened) of rows (key string, x)."""
    ship(rows.sparkSession)
    shared = rows.sparkSession.sparkContext.broadcast(model)  # COMPONENTS + 2 numbers for each dimension

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = shared.value
        step = max(1, AT_ONCE // m.length)
        for batch in batches:
            for at in range(0, len(batch), step):
                part = batch.iloc[at : at + step]
                off = np.stack(part["x"].to_numpy()).astype(np.int64) - m.quotient
                if np.abs(off).max() < 2.0**62 / m.n:
                    top = off * m.n - m.rest
                    centred = top / m.n
                else:  # beyond long: Python's whole numbers
                    top = off.astype(object) * m.n - m.rest.astype(object)
                    centred = (top / m.n).astype(float)
                white = centred @ m.axes / np.sqrt(m.variances)
                yield pd.DataFrame({"key": part["key"].to_numpy(), "deviation_digits": [str(v) for v in squares(top)], "whitened": list(white)})

    return rows.mapInPandas(run, "key string, deviation_digits string, whitened array<double>")


def whiten(df: DataFrame, model: Whitening | None, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(``key``, deviation, deviation_digits, whitened) of every row of df that has a usable vector.

    deviation is the sum over dimensions of (n*x - S)^2, null where that does not fit a long;
    deviation_digits always has it. whitened has a number for each component. Rows whose vector is
    null, holds null or non-finite entries, or has another length than the model's are dropped; a
    null key stays null, and repeated rows stay. df may have any other columns. Entries beyond
    2^53 / 64 count as that. Without a model (no usable vector) there are no rows.
    """
    if model is None:
        empty = df.limit(0).select(F.col(key), F.lit(0).cast("long").alias("deviation"), F.lit("").alias("deviation_digits"), F.array(F.lit(0.0)).alias("whitened"))
        return empty
    kind = df.schema[key].dataType
    use = df.where(is_finite(F.col(vector)) & (F.size(vector) == model.length)).select(F.col(key).cast("string").alias("key"), whole_numbers(F.col(vector)).alias("x"))
    out = _project(use, model)
    return out.select(F.col("key").cast(kind).alias(key), F.expr("try_cast(deviation_digits AS BIGINT)").alias("deviation"), "deviation_digits", "whitened")


def whitened_components(df: DataFrame, scratch: Scratch) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) of each usable row and component."""
    model = fit_whitening(df, scratch)
    rows = whiten(df, model).select("vec_id", "deviation", F.posexplode("whitened").alias("pos", "whitened"))
    shares = F.lit([float(v) for v in model.explained] if model is not None and len(model.explained) else [0.0])
    return rows.select(
        "vec_id", (F.col("pos") + 1).alias("component"), F.lit(model.n if model else 0).cast("long").alias("n"), "deviation", "whitened",
        F.get(shares, F.col("pos")).alias("explained"), F.lit(model.identity_error if model else 0.0).alias("identity_error"),
    )
