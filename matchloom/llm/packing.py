"""Best-fit packing by a configuration linear program.

Only the histogram of piece lengths (at most ``CAPACITY`` numbers) comes to the driver. A
configuration is a multiset of lengths that fits one sequence; the program covers the histogram by
as few as it can. Multiplicative weights price the lengths, those least covered so far highest; they
start from the lengths themselves and from the dual prices, of a family of them, with the best bound. A
knapsack dynamic program over all rooms gives the highest price that a sequence can hold, and with
it the best configuration around each length. Configurations near that price are taken, rounded
down, and at most ``SHARE`` of a length's demand in a round, so that all lengths run out together.
What rounding leaves over is put in best-fit order of decreasing length. Later rounds have less
to choose from, so the plan keeps as many of them as make it shortest; where even the first one does not
pay, which happens where every length has a few pieces, all is left over. The prices also tell a
bound that no packing can beat. The plan, runs of like sequences, is as long as the histogram is
wide; pieces find their places in it by their rank among those of their length.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from matchloom.llm.common import Scratch
from matchloom.llm.tokenizing import END, tokenizer, vocabulary

CAPACITY, SLICES = 4096, 1024
#: rounds at most, the step of the weights, the share of a length covered in a round, how near the best price
ROUNDS, STEP, SHARE, NEAR = 60, 0.02, 0.1, 1e-3


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, text: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): each document's ids with the end id, cut at ``capacity``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tokenizer(path)
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
        for batch in batches:
            for a, ids, ends in t.batches(batch.column(1)):
                body = memoryview(np.insert(ids, ends, END).astype("<u4", copy=False)).cast("B")
                rows, begin = [], 0
                for key, end in zip(batch.column(0).slice(a, len(ends)).to_pylist(), (ends + np.arange(1, len(ends) + 1)).tolist()):
                    for k, b in enumerate(range(begin, end, capacity)):
                        stop = min(b + capacity, end)
                        rows.append((key, k, b - begin, stop - b, crc32(body[4 * b : 4 * stop])))
                    begin = end
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long")


def knapsack(price: np.ndarray, capacity: int) -> np.ndarray:
    """For every room from 0 to ``capacity`` the highest price that fits.

    price: one for each length from 0; lengths with price 0 are not used.
    """
    best = np.zeros(capacity + 1)
    for length in np.flatnonzero(price[: capacity + 1] > 0).tolist():
        size, worth = length, price[length]
        while size <= capacity:  # one, two, four ... more copies make any number
            np.maximum(best[size:], best[:-size] + worth, out=best[size:])
            size, worth = 2 * size, 2 * worth
    return best


def dual_prices(demand: np.ndarray, capacity: int) -> tuple[np.ndarray, float]:
    """The prices of a family of functions under which no sequence can hold more than 1, with the best bound, and that bound.

    The family mixes the length itself with how many more than kths of a sequence it takes, and with
    a step that counts long pieces as whole sequences and short ones as nothing.
    """
    part = np.arange(capacity + 1) / capacity
    steps = [np.minimum(1.0, np.floor(np.arange(capacity + 1) * k / (capacity + 1)) / (k - 1)) for k in (2, 3)]
    steps += [np.where(part > 1 - low, 1.0, np.where(part >= low, part, 0.0)) for low in (0.1, 0.2, 0.3, 0.4)]
    found = []
    for price in [part, *[(1 - t) * part + t * u for u in steps for t in (0.5, 1.0)]]:
        price = np.where(demand > 0, price, 0.0)
        most = knapsack(price, capacity)[capacity]
        if most > 0:
            found.append((float(demand @ price) / most * (1 - 1e-9), price / most))
    bound, price = max(found, key=lambda f: f[0])
    return price, bound


def _longest_best(room: int, price: np.ndarray, best: np.ndarray, held: np.ndarray) -> int:
    """The length within ``room`` that leaves the most to its price and the room beside it, the longest of equal ones; 0 for none."""
    worth = np.where(held[1 : room + 1] > 0, best[room - 1 :: -1][:room] + price[1 : room + 1], -1.0)
    one = room - int(worth[::-1].argmax())
    return one if worth[one - 1] >= 0 else 0


def configuration(length: int, price: np.ndarray, best: np.ndarray, there: np.ndarray, known: dict[int, int] | None = None) -> dict[int, int]:
    """The best sequence with ``length`` that lengths with pieces ``there`` give, by the prices of rooms; longer lengths first.

    ``known`` keeps the best length of each room between calls with the same prices and pieces that only get
    fewer: as long as it is there, no other need be looked for.
    """
    counts, room = {length: 1}, len(best) - 1 - length
    held, known = there.copy(), {} if known is None else known
    held[length] -= 1
    while room > 0:
        one = known.get(room)
        if one is None or one and there[one] <= 0:
            one = known[room] = _longest_best(room, price, best, there)
        if one and held[one] <= 0:
            one = _longest_best(room, price, best, held)
        if not one:
            break
        counts[one] = counts.get(one, 0) + 1
        held[one] -= 1
        room -= one
    return counts


def program(histogram: np.ndarray, capacity: int = CAPACITY, start: np.ndarray | None = None) -> tuple[list[list[tuple[dict[int, int], int]]], int]:
    """For each round, configurations with the number of sequences of each, within the histogram; and a bound for any packing.

    start: the prices that the weights multiply; the lengths by default.
    """
    demand = histogram.astype(np.int64)
    left, lengths, rounds = demand.copy(), np.arange(len(demand)), []
    start = lengths if start is None else start
    bound = int(-(-(demand * lengths).sum() // capacity))
    for _ in range(ROUNDS):
        open_ = left > 0
        price = np.where(open_, start * np.exp(STEP * left / np.maximum(demand, 1)), 0.0)
        if not price.any():
            break
        best = knapsack(price, capacity)
        bound = max(bound, int(np.ceil((demand * price).sum() / best[capacity] * (1 - 1e-9))))
        quota = np.minimum(left, np.ceil(SHARE * demand).astype(np.int64))
        found, known = [], {}
        # no sequence with a length holds more than its price and the best of the room that it leaves
        near = price + best[::-1] >= (1 - NEAR) * best[capacity] * (1 - 1e-9)
        for length in np.flatnonzero(open_ & near)[::-1].tolist():
            while quota[length]:
                counts = configuration(length, price, best, quota, known)
                if sum(c * price[k] for k, c in counts.items()) < (1 - NEAR) * best[capacity]:
                    break
                n = min(int(quota[k]) // c for k, c in counts.items())
                found.append((counts, n))
                for k, c in counts.items():
                    quota[k] -= n * c
                    left[k] -= n * c
        if not found:
            break
        rounds.append(found)
    return rounds, bound


def plan(histogram: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, int, int]:
    """Runs (length, first rank, ranks, first sequence, offset), the number of sequences, and a bound for any packing.

    Piece ``first rank + k`` of its length goes to sequence ``first sequence + k`` at ``offset``.
    """
    if not histogram.any():
        return np.zeros((0, 5), np.int64), 0, 0
    duals, bound = dual_prices(histogram, capacity)
    bound, best = int(np.ceil(bound)), None
    # short pieces that cost nothing are put in the rooms that are left
    for start in (None, duals):
        if best is not None and best[1] <= bound:
            break
        rounds, told = program(histogram, capacity, start)
        bound, keep = max(bound, told), len(rounds)
        while best is None or best[1] > bound:
            laid = _lay(histogram, [c for found in rounds[:keep] for c in found], capacity)
            if best is None or laid[1] < best[1]:
                best = laid
            if not keep:
                break
            keep //= 2
    return *best, bound


def _lay(histogram: np.ndarray, chosen: list[tuple[dict[int, int], int]], capacity: int) -> tuple[np.ndarray, int]:
    """The chosen configurations, and the rest in best-fit order of decreasing length."""
    left = histogram.astype(np.int64).copy()
    used = np.zeros_like(left)
    runs: list[tuple[int, int, int, int, int]] = []
    open_bins: dict[int, list[tuple[int, int]]] = {}  # room: [(first sequence, sequences)]
    rooms: list[int] = []  # keys of open_bins, in order
    sequences = 0

    def put(length: int, n: int, first: int, room: int) -> None:
        runs.append((length, int(used[length]), n, first, capacity - room))
        used[length] += n
        left[length] -= n

    def leave(room: int, first: int, n: int) -> None:
        if room not in open_bins:
            open_bins[room] = []
            insort(rooms, room)
        open_bins[room].append((first, n))

    for counts, n in chosen:
        room = capacity
        for length, c in counts.items():
            for _ in range(c):
                put(length, n, sequences, room)
                room -= length
        if room:
            leave(room, sequences, n)
        sequences += n
    for length in range(capacity, 0, -1):
        while left[length]:
            at = bisect_left(rooms, length)
            room = rooms[at] if at < len(rooms) else capacity
            if room == capacity:
                k = int(left[length])
                first, per = sequences, capacity // length
                many = k if per == 1 else -(-k // per)
                sequences += many
                bins = (first, many)
            else:
                bins = open_bins[room].pop()
                if not open_bins[room]:
                    del open_bins[room], rooms[at]
            first, many = bins
            k = min(many, int(left[length]))
            put(length, k, first, room)
            if k < many:
                leave(room, first + k, many - k)
            leave(room - length, first, k)
    kept = np.array(runs, np.int64).reshape(-1, 5)
    return kept, sequences - sum(n for _, n in open_bins.get(capacity, []))


def pack(docs: DataFrame, scratch: Scratch, path: str | None = None, capacity: int = CAPACITY, text: str = "text") -> DataFrame:
    """Every piece of every document of docs with sequence_id and offset.

    Null texts count as empty and are the end id alone. Rows with the same doc_id, or a null one,
    are packed each on its own. Other columns are ignored. An empty table gives an empty result.
    """
    cut = scratch.save(pieces(docs, path or vocabulary(), capacity, text), "pieces")
    counts = cut.groupBy("length").agg(F.count("*").alias("n")).collect()  # at most ``capacity`` rows
    histogram = np.zeros(capacity + 1, np.int64)
    for length, n in counts:
        histogram[length] = n
    runs, *_ = plan(histogram, capacity)
    # ranks of like pieces: counts of small slices, summed up, and the rank within a slice
    sliced = cut.withColumn("slice", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(SLICES)))
    sums = sliced.groupBy("length", "slice").agg(F.count("*").alias("n"))
    ahead = Window.partitionBy("length").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    base = sums.select("length", "slice", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("base"))
    inside = Window.partitionBy("length", "slice").orderBy("doc_id", "piece", "ids_crc32")
    ranked = sliced.withColumn("turn", F.row_number().over(inside) - 1).join(base, ["length", "slice"]).select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("base") + F.col("turn")).alias("rank"))
    runs = runs[np.lexsort((runs[:, 1], runs[:, 0]))]
    step = int(histogram.max(initial=0)) + 1
    shared = docs.sparkSession.sparkContext.broadcast((runs[:, 0] * step + runs[:, 1], runs))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, table = shared.value
        for batch in batches:
            length, rank = batch.column(3).to_numpy(), batch.column(5).to_numpy()
            run = table[np.searchsorted(keys, length * step + rank, side="right") - 1] if len(table) else np.zeros((0, 5), np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(run[:, 3] + rank - run[:, 1]), pa.array(run[:, 4])], names=[*batch.schema.names[:5], "sequence_id", "offset"])

    return ranked.mapInArrow(place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
