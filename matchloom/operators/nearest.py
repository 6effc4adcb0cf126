"""The k nearest of sparse vectors, block by block, with what no block member can exceed.

A block's bound for a query is the product of the query's weights with the block's greatest weight
of each n-gram. The query meets the block only if that reaches the similarity of its k-th nearest so far.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from matchloom.session import ship

NEAR = "source1_entity_id string, candidate_entity_id string, similarity double, rank int"
DIGITS, ROWS = 9, 1024
_BUCKET, _GROUP, _BLOCK, _ID, _GRAMS, _WEIGHTS = [0, 1], 2, 3, 4, 5, 6


@dataclass
class Vectors:
    """Sparse rows: entry e of row ``row[e]`` has n-gram ``grams[e]`` and weight ``weights[e]``."""

    ids: list[str]
    row: np.ndarray
    grams: pa.Array
    weights: np.ndarray


def _vectors(parts: list[pa.RecordBatch]) -> Vectors:
    ids, lists, weights = ([p.column(c) for p in parts] for c in (_ID, _GRAMS, _WEIGHTS))
    sizes = np.concatenate([x.value_lengths().to_numpy(zero_copy_only=False) for x in lists])
    grams = pa.concat_arrays([x.flatten() for x in lists])
    return Vectors([i for x in ids for i in x.to_pylist()], np.repeat(np.arange(len(sizes)), sizes), grams, np.concatenate([x.flatten().to_numpy() for x in weights]))


def grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Vectors, Iterator[Vectors]]]:
    """Each group's queries, and its corpus blocks one at a time, from rows sorted by bucket, group and block."""

    def runs() -> Iterator[tuple[tuple, Vectors]]:
        held, at = [], None
        for batch in batches:
            keys = list(zip(*(batch.column(c).to_pylist() for c in (*_BUCKET, _GROUP, _BLOCK))))
            starts = [k for k in range(len(keys)) if k == 0 or keys[k] != keys[k - 1]]
            for a, b in zip(starts, [*starts[1:], len(keys)]):
                if held and keys[a] != at:
                    yield at, _vectors(held)
                    held = []
                at = keys[a]
                held.append(batch.slice(a, b - a))
        if held:
            yield at, _vectors(held)

    class Ahead:
        found = runs()
        run = next(found, None)

    def blocks(group: tuple) -> Iterator[Vectors]:
        while Ahead.run is not None and Ahead.run[0][:3] == group:
            yield Ahead.run[1]
            Ahead.run = next(Ahead.found, None)

    while Ahead.run is not None:
        (*group, block), asked = Ahead.run
        if block >= 0:  # a corpus that nobody asks
            Ahead.run = next(Ahead.found, None)
            continue
        Ahead.run = next(Ahead.found, None)
        rest = blocks(tuple(group))
        yield asked, rest
        for _ in rest:
            pass


class Best:
    """The nearest k of each query so far, nearest first: similarities fall, equal ones by id."""

    def __init__(self, queries: int, k: int):
        self.k = k
        self.found: list[list[tuple[float, str]]] = [[] for _ in range(queries)]
        self.least = np.full(queries, -1.0)

    def add(self, query: int, similarities: np.ndarray, ids: list[str], columns: np.ndarray) -> None:
        merged = sorted([*self.found[query], *((-similarities[c], ids[c]) for c in columns.tolist())])[: self.k]
        self.found[query] = merged
        if len(merged) == self.k:
            self.least[query] = -merged[-1][0]


def _products(q: Vectors, mine: np.ndarray, entries: np.ndarray, gram_of: np.ndarray, block: Vectors, of_block: np.ndarray) -> np.ndarray:
    """Products of the queries ``mine`` with each row of a block, n-gram by n-gram."""
    place = np.full(len(q.ids), -1)
    place[mine] = np.arange(len(mine))
    out = np.zeros((len(mine), len(block.ids)))
    entries = entries[place[q.row[entries]] >= 0]
    theirs = np.flatnonzero(of_block >= 0)
    theirs = theirs[np.argsort(of_block[theirs], kind="stable")]
    shared, starts = np.unique(of_block[theirs], return_index=True)
    ends = np.r_[starts[1:], len(theirs)]
    lows, highs = np.searchsorted(gram_of[entries], shared), np.searchsorted(gram_of[entries], shared, side="right")
    for a, b, low, high in zip(starts.tolist(), ends.tolist(), lows.tolist(), highs.tolist()):
        if low < high:
            e, t = entries[low:high], theirs[a:b]
            out[place[q.row[e]][:, None], block.row[t]] += np.outer(q.weights[e], block.weights[t])
    return out


def search(q: Vectors, blocks: Iterator[Vectors], k: int, zeros: bool) -> pa.RecordBatch:
    """The k nearest rows of all blocks to each query. ``zeros``: also rows of similarity 0, unless no row of any block has an n-gram."""
    vocabulary = pc.unique(q.grams)
    gram_of = pc.index_in(q.grams, vocabulary).to_numpy(zero_copy_only=False).astype(np.int64)
    by_gram = np.argsort(gram_of, kind="stable")
    best, any_gram = Best(len(q.ids), k), False
    for block in blocks:
        any_gram |= len(block.grams) > 0
        of_block = pc.fill_null(pc.index_in(block.grams, vocabulary), -1).to_numpy(zero_copy_only=False).astype(np.int64)
        top = np.zeros(len(vocabulary) + 1)
        np.maximum.at(top, of_block, block.weights)
        top[-1] = 0.0  # n-grams that no query has
        bound = np.bincount(q.row, weights=q.weights * top[gram_of], minlength=len(q.ids))
        open_ = np.flatnonzero((np.round(bound, DIGITS) >= best.least) & (zeros | (bound > 0)))
        order = np.argsort(np.array(block.ids, object), kind="stable")
        ids = [block.ids[c] for c in order]
        for at in range(0, len(open_), ROWS):
            mine = open_[at : at + ROWS]
            found = np.round(_products(q, mine, by_gram, gram_of, block, of_block), DIGITS)[:, order]
            if not zeros:
                found[found <= 0] = -2.0
            reach = found >= np.maximum(best.least[mine], -1.0)[:, None]
            for j in np.flatnonzero(reach.any(axis=1)).tolist():
                columns = np.flatnonzero(reach[j])
                if len(columns) > k:
                    columns = columns[np.argsort(-found[j, columns], kind="stable")[:k]]
                best.add(int(mine[j]), found[j], ids, columns)
    rows = [(q.ids[i], c, float(-s), r + 1) for i, near in enumerate(best.found) for r, (s, c) in enumerate(near)] if any_gram else []
    kinds = [pa.string(), pa.string(), pa.float64(), pa.int32()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 4, kinds)], names=["source1_entity_id", "candidate_entity_id", "similarity", "rank"])


DENSE = "source1_entity_id long, candidate_entity_id long, similarity double"
#: queries that meet a batch at once; rounded cosines are whole numbers of PLACES, below all of them is none
AT_ONCE, PLACES, NONE = 256, 1_000_000, -(1 << 62)


def _matrix(lists: pa.Array, wide: int | None = None) -> np.ndarray:
    """Vectors of ``wide`` entries, by default as many as the longest has, as rows of doubles; all others are NaN, as is a null entry."""
    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    wide = int(sizes.max(initial=0)) if wide is None else wide
    out = np.full((len(sizes), wide), np.nan)
    flat = lists.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    out[sizes == wide] = flat[np.repeat(sizes == wide, sizes)].reshape(-1, wide)
    return out


def dense_top_k(queries: DataFrame, corpus: DataFrame, k: int) -> DataFrame:
    """(source1_entity_id, candidate_entity_id, similarity, rank): the k rows of ``corpus`` (id, v) with the greatest cosine to each of ``queries``.

    Cosines are rounded to six digits, equal ones go by id, missing ones come last. All queries are
    sent to each task, which holds them, a batch of the corpus and its k nearest of each query so far.
    """
    spark = corpus.sparkSession
    ship(spark)
    table = queries.where("id is not null").toArrow().combine_chunks()
    lists = table.column("v").combine_chunks() if len(table) else pa.array([], pa.list_(pa.float64()))
    sent = spark.sparkContext.broadcast((table.column("id").to_numpy().astype(np.int64), _matrix(lists if isinstance(lists, pa.Array) else pa.concat_arrays(lists.chunks))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, vectors = sent.value
        norms = np.einsum("ij,ij->i", vectors, vectors)
        best, near = np.full((len(ids), k), NONE), np.zeros((len(ids), k), np.int64)
        for batch in batches:
            own, rows = batch.column(0).to_numpy(zero_copy_only=False), _matrix(batch.column(1), vectors.shape[1])
            order = np.argsort(own, kind="stable")
            own, rows = own[order], rows[order]
            squares = np.einsum("ij,ij->i", rows, rows)
            for a in range(0, len(ids), AT_ONCE):
                part = slice(a, a + AT_ONCE)
                with np.errstate(all="ignore"):
                    cosine = vectors[part] @ rows.T / np.sqrt(np.outer(norms[part], squares))
                    whole = np.copysign(np.floor(np.abs(cosine) * PLACES + 0.5), cosine)
                whole = np.where(np.isfinite(whole), whole, -2 * PLACES).astype(np.int64)
                whole[ids[part][:, None] == own] = 2 * -PLACES - 1  # not itself
                key = whole * (len(own) + 1) - np.arange(len(own))  # of equal ones the lesser id first
                top = np.argpartition(-key, k - 1, axis=1)[:, :k] if len(own) > k else np.broadcast_to(np.arange(len(own)), whole.shape)
                found, names = np.take_along_axis(whole, top, axis=1), own[top]
                found = np.where(found < -2 * PLACES, NONE, found)
                both, all_names = np.hstack([best[part], found]), np.hstack([near[part], names])
                pick = np.lexsort((all_names, -both), axis=-1)[:, :k]
                best[part], near[part] = np.take_along_axis(both, pick, axis=1), np.take_along_axis(all_names, pick, axis=1)
        q, c = np.nonzero(best > NONE)
        values = best[q, c]
        cosines = pa.array(values / PLACES, pa.float64(), mask=values <= -2 * PLACES)
        yield pa.RecordBatch.from_arrays([pa.array(ids[q]), pa.array(near[q, c]), cosines], names=["source1_entity_id", "candidate_entity_id", "similarity"])

    corpus = corpus.where("id is not null").select("id", "v")
    tasks = spark.sparkContext.defaultParallelism
    if corpus.rdd.getNumPartitions() < tasks:
        corpus = corpus.repartition(tasks)
    turn = F.row_number().over(Window.partitionBy("source1_entity_id").orderBy(F.desc("similarity"), "candidate_entity_id"))
    return corpus.mapInArrow(run, DENSE).withColumn("rank", turn).where(F.col("rank") <= k)
