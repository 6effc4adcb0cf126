"""Near-duplicate vectors by lattice hashing.

In each of ``TABLES`` tables two random projections to 8 dimensions are decoded to the nearest
points of the E8 lattice, which name the cell a vector is stored in. A vector also probes the cells
that it nearly fell into. Crowded cells are compared in blocks.

Most vectors that meet do so by chance. Ids and ``BITS`` signs of random projections of the centred
vector travel first; only vectors whose signs leave a partner possible follow into the block, where
their cosine is verified in double precision. The number of signs that may differ follows from the
distance that the limit allows, so it holds for any centre; it costs about one link in ten thousand,
and none where ``margin`` is None.
A pair may meet in several cells; it counts in the first of them, which either task finds out from
the two vectors alone, so links are counted without a list of pairs. What leaves a block is a count
and one link to a root for each vector.

Equal vectors are one from the start, with their number.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchloom.llm.common import Scratch, let
from matchloom.llm.components import connected_components

TABLES, HALVES, SCALE, PROBES, BLOCK, LIMIT = 8, 2, 2.2, 8, 1024, 0.9
#: signs of a vector, and by how many deviations more of them may differ than the angle lets expect
BITS, MARGIN = 64, 4.2
#: numbers in all centres that are taken to the tasks, and lengths of vectors that have one; others use the origin
CENTRE_SIZE, CENTRES = 1 << 20, 64
#: pairs that are counted at a time in a task
PAIRS = 1 << 18
TASK = ["tab", "cell", "b0", "b1"]


def e8_points(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Doubled coordinates of the nearest E8 point of each row, and of the runner-up of the other coset or parity.

    E8 is D8 (integers with an even sum) and D8 moved by one half in all coordinates.
    """

    def d8(y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        near = np.rint(y)
        off = y - near
        rows = np.arange(len(y))
        by_margin = np.argsort(-np.abs(off), axis=1)
        toward = np.where(off >= 0, 1.0, -1.0)

        def moved(base: np.ndarray, k: int) -> np.ndarray:
            out = base.copy()
            out[rows, by_margin[:, k]] += toward[rows, by_margin[:, k]]
            return out

        odd = near.sum(axis=1) % 2 != 0
        first = np.where(odd[:, None], moved(near, 0), near)
        second = np.where(odd[:, None], moved(near, 1), moved(moved(near, 0), 1))
        return first, ((y - first) ** 2).sum(axis=1), second, ((y - second) ** 2).sum(axis=1)

    a = d8(x)
    b = d8(x - 0.5)
    points = np.stack([2 * a[0], 2 * a[2], 2 * b[0] + 1, 2 * b[2] + 1], axis=1)
    order = np.argsort(np.stack([a[1], a[3], b[1], b[3]], axis=1), axis=1, kind="stable")
    return np.take_along_axis(points, order[:, :, None], axis=1).astype(np.int64), order


@lru_cache(maxsize=64)
def _projection(seed: tuple[int, ...], dim: int, width: int) -> np.ndarray:
    return np.random.default_rng([*seed, dim]).standard_normal((dim, width))


def cells(unit: np.ndarray, table: int) -> np.ndarray:
    """Cell names (n, 1 + PROBES): the vector's own cell, then those that it probes, nearest first."""
    names = []
    for half in range(HALVES):
        points, _ = e8_points(unit @ _projection((table, half), unit.shape[1], 8) / SCALE)
        factors = np.random.default_rng([8, half]).integers(1, 1 << 62, 8, dtype=np.int64) | 1
        with np.errstate(over="ignore"):
            names.append((points * factors).sum(axis=2))
    first, second = names
    pairs = [(i, j) for i in range(4) for j in range(4)]
    pairs.sort(key=lambda p: (p[0] + p[1], max(p)))
    with np.errstate(over="ignore"):
        return np.stack([first[:, i] * np.int64(0x1E3779B97F4A7C15) + second[:, j] for i, j in pairs[: 1 + PROBES]], axis=1)


def unit_rows(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.sqrt((vectors * vectors).sum(axis=1))[:, None]


def signs(unit: np.ndarray, centre: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Signs of the centred rows, packed, and the rows' distances from the centre."""
    moved = unit if centre is None else unit - centre
    above = moved @ _projection((BITS,), unit.shape[1], BITS) >= 0
    return np.packbits(above, axis=1).view(np.int64).ravel(), np.sqrt((moved * moved).sum(axis=1))


@lru_cache(maxsize=8)
def _widest(margin: float) -> np.ndarray:
    """For each number of differing signs the cosine of the least angle (seen from the centre) that it speaks for."""
    share = np.linspace(0, 1, 20_001)
    most = BITS * share + margin * np.sqrt(BITS * share * (1 - share)) + 0.5
    at = np.searchsorted(np.maximum.accumulate(most), np.arange(BITS + 1))
    return np.cos(math.pi * share[np.minimum(at, len(share) - 1)])


def may_link(x: np.ndarray, y: np.ndarray, rx: np.ndarray, ry: np.ndarray, limit: float, margin: float | None = MARGIN) -> np.ndarray:
    """Whether signs x, y at distances rx, ry from the centre may belong to vectors with a cosine of ``limit``; always so without a margin."""
    if margin is None:
        return np.ones(len(x), bool)
    differ = np.bitwise_count((x ^ y).view(np.uint64))
    apart = 2 * (1 - limit) + 1e-3  # squared distance of unit vectors, and what single precision may add
    return rx * rx + ry * ry - apart <= 2 * rx * ry * _widest(margin)[differ]


def centres(vectors: DataFrame) -> dict[int, np.ndarray]:
    """A centre of the vectors of each length, for the ``CENTRES`` most frequent lengths within ``CENTRE_SIZE``."""
    dim, kept, room = F.size("vector"), [], CENTRE_SIZE
    for d, _ in vectors.groupBy(dim.alias("d")).count().orderBy(F.desc("count"), "d").limit(CENTRES).collect():
        if d <= room:
            kept.append(d)
            room -= d
    if not kept:
        return {}
    at = vectors.select(dim.alias("d"), F.posexplode("vector").alias("i", "x")).where(F.col("d").isin(kept))
    means = at.groupBy("d", "i").agg(F.avg("x").alias("mean"), F.avg(F.col("x") * F.col("x")).alias("square")).toPandas().sort_values(["d", "i"])
    # rounded, so that the order of sums doesn't show
    return {int(d): np.round(g["mean"].to_numpy() / math.sqrt(g["square"].sum()), 4) for d, g in means.groupby("d")}


def deal(vectors: DataFrame, centre: dict[int, np.ndarray]) -> DataFrame:
    """(tab, cell, probe, node, bits, radius): each vector in its own cell (probe 0) and in those it probes; the vector stays behind.

    ``tab`` names the table and the length, so that vectors of several lengths never meet.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = pa.compute.list_value_length(batch.column(1)).to_numpy()
            for dim in np.unique(lengths):
                rows = np.flatnonzero(lengths == dim)
                for a in range(0, len(rows), 1000):
                    part = batch.take(pa.array(rows[a : a + 1000]))
                    unit = unit_rows(np.asarray(part.column(1).flatten()).reshape(part.num_rows, -1))
                    node, (bits, radius) = part.column(0).to_numpy(), signs(unit, centre.get(int(dim)))
                    for t in range(TABLES):
                        c = cells(unit, t)
                        n = c.shape[1]
                        probe = np.tile(np.arange(n) > 0, len(c)).astype(np.int32)
                        tab = np.full(c.size, t + TABLES * int(dim), np.int32)
                        columns = [tab, c.ravel(), probe, np.repeat(node, n), np.repeat(bits, n), np.repeat(radius.astype(np.float32), n)]
                        yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=["tab", "cell", "probe", "node", "bits", "radius"])

    return vectors.select("node", "vector").mapInArrow(run, "tab int, cell long, probe int, node long, bits long, radius float")


def possible(dealt: DataFrame, limit: float, margin: float | None = MARGIN) -> DataFrame:
    """Rows of ``dealt`` (tasks, probe, node, side, signs) that may link with another row of their task, one of them living there."""

    def flagged(rows: pa.Table) -> pa.Table:
        col = {c: rows.column(c).to_numpy() for c in [*TASK, "probe", "node", "side", "bits", "radius"]}
        radius = col["radius"].astype(float)
        starts = np.flatnonzero(_changes(col))
        end = np.repeat(np.append(starts[1:], len(radius)), np.diff(np.append(starts, len(radius))))
        hit = np.zeros(len(radius), bool)
        i, s = np.arange(len(radius)), 1
        while True:  # each row with the s-th after it
            i = i[i + s < end[i]]
            if not len(i):
                return rows.filter(pa.array(hit))
            j = i + s
            near = may_link(col["bits"][i], col["bits"][j], radius[i], radius[j], limit, margin)
            x, y = i[near], j[near]
            fine = ((col["probe"][x] == 0) | (col["probe"][y] == 0)) & (col["node"][x] != col["node"][y])
            fine &= (col["b0"][x] == col["b1"][x]) | (col["side"][x] != col["side"][y])
            hit[x[fine]] = True
            hit[y[fine]] = True
            s += 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _whole_tasks(batches):
            yield from flagged(rows).select(kept).to_batches()

    kept = [*TASK, "probe", "node", "side"]
    return dealt.mapInArrow(run, "tab int, cell long, b0 int, b1 int, probe int, node long, side int")


def _changes(rows: pa.Table | dict[str, np.ndarray]) -> np.ndarray:
    """Whether a row is the first of its task."""
    col = {c: np.asarray(rows[c]) for c in TASK}
    new = np.ones(len(col["tab"]), bool)
    new[1:] = np.logical_or.reduce([x[1:] != x[:-1] for x in col.values()])
    return new


def _whole_tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Sorted rows as tables that cut no task."""
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = pa.Table.from_batches([batch])
        held = rows if held is None else pa.concat_tables([held, rows]).combine_chunks()
        last = int(np.flatnonzero(_changes(held))[-1])
        if last:  # the last task may go on in the next batch
            yield held.slice(0, last)
            held = held.slice(last)
    if held is not None:
        yield held


def links(vectors: DataFrame, scratch: Scratch, limit: float = LIMIT, margin: float | None = MARGIN) -> DataFrame:
    """(node, n, root): links of ``node`` counted in some block, and a vector that it is linked with there.

    Cells are dealt out by ids and signs; only where these leave a link possible do the vectors follow.
    """
    key = ["tab", "cell"]
    dealt = scratch.save(deal(vectors, centres(vectors)), "cells")
    counts = dealt.groupBy(*key).agg(F.sum((F.col("probe") == 0).cast("int")).alias("own"), F.count("*").alias("n")).where("own > 0 and n > 1")
    blocks = counts.select(*key, F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    placed = dealt.join(blocks, key).withColumn("mine", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    # every pair of blocks once: block k is the first of (k, j) and the second of (j, k)
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    paired = placed.withColumn("other", other).select(*key, "probe", "node", "bits", "radius", F.least("mine", "other").alias("b0"), F.greatest("mine", "other").alias("b1"), (F.col("mine") > F.col("other")).cast("int").alias("side"))
    ordered = lambda df: df.repartition(*TASK).sortWithinPartitions(*TASK, "node", "probe")
    near = scratch.save(possible(ordered(paired), limit, margin), "possible")
    scratch.drop("cells")
    dealt_out = ordered(near.join(vectors.select("node", "copies", "vector"), "node"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _whole_tasks(batches):
            yield from _verified(rows, limit)

    return dealt_out.mapInArrow(run, "node long, n long, root long")


def _verified(rows: pa.Table, limit: float) -> Iterator[pa.RecordBatch]:
    """(node, n, root) of the rows with links in their tasks; the pairs of some tasks are held at a time."""
    starts = np.append(np.flatnonzero(_changes(rows)), rows.num_rows)
    col = {c: np.asarray(rows[c]) for c in ["tab", "b0", "b1", "probe", "node", "side", "copies"]}
    vectors, found, held = rows["vector"], [], 0
    a = 0
    while a < len(starts) - 1:
        b = a + 1  # tasks whose vectors have one length
        while b < len(starts) - 1 and col["tab"][starts[b]] // TABLES == col["tab"][starts[a]] // TABLES:
            b += 1
        first = starts[a]
        flat = np.asarray(vectors.slice(first, starts[b] - first).combine_chunks().flatten())
        unit = unit_rows(flat.reshape(starts[b] - first, -1))
        here = {c: x[first : starts[b]] for c, x in col.items()}
        for k in range(a, b):
            lo, hi = starts[k] - first, starts[k + 1] - first
            if hi - lo > 1:
                i, j = _near_pairs(unit, here, lo, hi, limit)
                found.append((i, j))
                held += len(i)
            if found and (held > PAIRS or k == b - 1):
                i, j = (np.concatenate(x) for x in zip(*found))
                found, held = [], 0
                out = _counted(unit, here, i, j)
                if out is not None:
                    yield out
        a = b


def _near_pairs(unit: np.ndarray, col: dict[str, np.ndarray], lo: int, hi: int, limit: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows lo to hi, which are one task, that are near enough and may be counted there."""
    probe, node, side = (col[c][lo:hi] for c in ("probe", "node", "side"))
    near = np.triu(unit[lo:hi] @ unit[lo:hi].T >= limit, 1)
    near &= (probe[:, None] == 0) | (probe[None, :] == 0)  # one of them lives here
    near &= node[:, None] != node[None, :]
    if col["b0"][lo] != col["b1"][lo]:
        near &= side[:, None] != side[None, :]
    i, j = near.nonzero()
    return i + lo, j + lo


def _counted(unit: np.ndarray, col: dict[str, np.ndarray], i: np.ndarray, j: np.ndarray) -> pa.RecordBatch | None:
    """Links of each row among the pairs (i, j) that meet here first, and the least node in reach within a task."""
    table, probe, node, copies = col["tab"] % TABLES, col["probe"], col["node"], col["copies"]
    first = np.ones(len(i), bool)
    for t in np.unique(table[i]):
        at = np.flatnonzero(table[i] == t)
        for k in range(0, len(at), PAIRS):
            part = at[k : k + PAIRS]
            first[part] = ~_met_before(unit, i[part], j[part], int(t), probe)
    i, j = i[first], j[first]
    if not len(i):
        return None
    n = np.bincount(i, weights=copies[j], minlength=len(node)) + np.bincount(j, weights=copies[i], minlength=len(node))
    root = node.copy()
    while True:
        before = root.copy()
        np.minimum.at(root, i, root[j])
        np.minimum.at(root, j, root[i])
        if (root == before).all():
            break
    hit = n > 0
    return pa.RecordBatch.from_arrays([pa.array(x) for x in (node[hit], n[hit].astype(np.int64), root[hit])], names=["node", "n", "root"])


def _met_before(unit: np.ndarray, i: np.ndarray, j: np.ndarray, table: int, probe: np.ndarray) -> np.ndarray:
    """Whether a pair meets in an earlier table, or in a cell of this table that comes before this one."""
    met = np.zeros(len(i), bool)
    at = np.zeros(len(unit), np.int64)
    for t in range(table + 1):
        open_ = np.flatnonzero(~met)
        if not len(open_):
            break
        x, y = i[open_], j[open_]
        used = np.unique(np.concatenate([x, y]))
        at[used] = np.arange(len(used))
        a, b = at[x], at[y]
        c = cells(unit[used], t)
        own = c[:, 0]
        same = own[a] == own[b]
        a_probes_b = (c[a, 1:] == own[b][:, None]).any(axis=1)
        if t < table:
            met[open_] = same | a_probes_b | (c[b, 1:] == own[a][:, None]).any(axis=1)
        else:
            here = (probe[x] == 0) & (probe[y] == 0)  # they live together: this is the first
            # else the cell of the later row is probed by the earlier one first
            met[open_] = ~here & (same | ((probe[x] == 0) & a_probes_b))
    return met


def near_vectors(vectors: DataFrame, scratch: Scratch, limit: float = LIMIT, vector: str = "embedding", margin: float | None = MARGIN) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row of vectors; needs vec_id and ``vector``.

    n_links: other rows with a cosine of at least ``limit``, equal vectors included; component_id:
    the least vec_id reachable by links, the row itself included; kept: vec_id = component_id. A
    vector that is null, empty, zero or has null or non-finite components links with nothing. All
    vectors of one length are compared among themselves. Repeated ids are rows of their own; a
    null vec_id counts as the least and is given back as null. An empty table gives an empty result.
    ``margin``: by how many deviations more signs than expected may differ in a pair whose cosine is looked
    at; None looks at every pair that meets in a cell, so that signs lose nothing.
    """
    least = -(1 << 63)
    v = F.transform(vector, lambda x: x.cast("double"))
    fine = v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    # one number scales all of a vector, so that squares neither overflow nor vanish
    top = F.array_max(F.transform(v, F.abs))
    rows = vectors.select(F.coalesce(F.col("vec_id").cast("long"), F.lit(least)).alias("vec_id"), F.when(fine, let(top, lambda t: F.transform(v, lambda x: x / t + 0.0))).alias("vector"))
    rows = rows.withColumn("mark", F.when(F.col("vector").isNotNull(), F.xxhash64("vector")))
    rows = scratch.save(rows, "rows")
    same = rows.where("vector is not null").groupBy("mark", "vector").agg(F.min("vec_id").alias("node"), F.count("*").alias("copies"))
    same = scratch.save(same, "distinct")
    named = lambda c: F.nullif(F.col(c), F.lit(least))
    found = links(same, scratch, limit, margin)
    found = scratch.save(found, "links")
    scratch.drop("possible")
    joined = connected_components(found.select(F.col("node").alias("a"), F.col("root").alias("b")), scratch, "cc")
    sums = found.groupBy("node").agg(F.sum("n").alias("n"))
    known = same.join(sums, "node", "left").join(joined, "node", "left").select("mark", "vector", F.col("node").alias("first"), "copies", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("component", "node").alias("component"))
    out = rows.join(known, ["mark", "vector"], "left")
    component = F.coalesce("component", "vec_id")
    return out.select(
        named("vec_id").alias("vec_id"), F.coalesce(F.col("n") + F.col("copies") - 1, F.lit(0)).cast("long").alias("n_links"),
        F.nullif(component, F.lit(least)).alias("component_id"), (F.col("vec_id") == component).alias("kept"),
    )
