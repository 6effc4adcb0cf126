"""N-gram Jaccard join by prefix trees.

A document is the set of its distinct 5-word shingles, as 64-bit hashes. All sets are put in one
global order, common shingles last, by the logarithm of how many sets
have a shingle. Two sets that are
alike enough share one of their rarest shingles (the prefix), so sets are led together by these.
Sets that meet are verified in tries: the sets that meet one center are laid out in the opposite
order, common shingles first, as a trie, whose shared branches are compared with the center once; a
branch is left as soon as the lengths that remain can't reach the overlap that is needed.

Only shingles that several sets have can lead sets together or count for an overlap. They are found
by sending packed shingles to buckets of hashes, once, which answer each batch of sets. (A shingle's
bucket and 40 low bits name it, 43 bits or more.) A set with fewer than 0.8 of its shingles
among them links with nothing; of all other sets, the shared shingles are all that is kept. The
shingles of crowded cells (a table of 2^19 counters over all documents tells) are not sent: they
count as shared and come last, in the order of their cells, so no bucket exceeds its share.

Links serve to find components. First every prefix shingle leads its sets to one center only, then
the links' components are found, and from then on only sets of different components that share a
prefix shingle meet, with more and more centers until every such pair has been verified. A group of
near copies thus costs a star, not all its pairs, and no link between two components is lost.
Equal sets are one from the start.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from matchloom.llm.common import Scratch, groups
from matchloom.llm.components import connected_components

SHINGLE, COUNTERS, BLOCK, FAN = 5, 1 << 19, 4096, 128
#: shingles that a task packs at once, and that a bucket is made for; how crowded a cell may be, against the mean
AT_ONCE, IN_BUCKET, CROWDED, CALM = 1 << 20, 2_000_000, 4, 256
#: centers of a shingle in the rounds after the first: so many, and as many times more in each
MORE = 64
#: centers of a shingle that are sent as one list
LIST = 512
LEAST = -(1 << 63)
#: what a text with words matches
HAS_WORDS = "[^\\x20\\x09-\\x0D]"
#: any odd number; a shingle is hashed as a number with its bytes as digits
MULTIPLIER, WORDS_AT_ONCE = 0x9E3779B97F4A7C15, 100_000
_POWERS: tuple[np.ndarray, np.ndarray] = (np.zeros(0, np.uint64), np.zeros(0, np.uint64))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The powers of a fixed odd number and of its inverse, modulo 2^64, for n places at least."""
    global _POWERS
    if len(_POWERS[0]) < n:
        size = max(n, 1 << 16)
        _POWERS = tuple(np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size - 1, x, np.uint64)])) for x in (MULTIPLIER, pow(MULTIPLIER, -1, 1 << 64)))
    return _POWERS


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str | None) -> np.ndarray:
    """Sorted distinct hashes of the 5-word shingles; of the whole sequence if it is shorter; none without words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    if len(words) <= WORDS_AT_ONCE:
        return np.unique(_shingles(words))
    parts = [_shingles(words[a : a + WORDS_AT_ONCE + SHINGLE - 1]) for a in range(0, len(words) - SHINGLE + 1, WORDS_AT_ONCE)]
    return np.unique(np.concatenate(parts))


def _shingles(words: list[bytes]) -> np.ndarray:
    line = b" ".join(words)
    n = min(SHINGLE, len(words))
    power, inverse = _powers(len(line) + 1)
    digits = np.frombuffer(line, np.uint8)
    gaps = np.flatnonzero(digits == 32)
    sums = np.zeros(len(line) + 1, np.uint64)
    np.cumsum(digits * power[: len(line)], out=sums[1:])
    start = np.concatenate([[0], gaps + 1])[: len(words) - n + 1]
    end = np.concatenate([gaps, [len(line)]])[n - 1 :]
    return _mix((sums[end] - sums[start]) * inverse[start] + (end - start).astype(np.uint64))


def set_id(s: np.ndarray) -> int:
    """64 bits for the set's identity, as a signed number."""
    return xxhash.xxh3_64_intdigest(s.tobytes()) - (1 << 63)


def least_overlap(n: np.ndarray | int, m: np.ndarray | int) -> np.ndarray | int:
    """Least intersection with 100 * intersection >= 80 * union."""
    return -(-4 * (n + m) // 9)


def cell_of(tokens: np.ndarray) -> np.ndarray:
    return (tokens >> np.uint64(45)).astype(np.int64)


def profile(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, n, node) for documents, and (block, task, counts) for the counters of a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        counts, task = np.zeros(COUNTERS, np.int64), TaskContext.get().partitionId()
        names = ["doc_id", "n", "node", "block", "task", "counts"]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]
        for batch in batches:
            sizes, nodes, waiting, held = [], [], [], 0
            for text in batch.column(1).to_pylist():
                s = shingle_set(text)
                sizes.append(len(s))
                nodes.append(set_id(s))
                waiting.append(cell_of(s))
                held += len(s)
                if held > AT_ONCE:
                    counts += np.bincount(np.concatenate(waiting), minlength=COUNTERS)
                    waiting, held = [], 0
            if held:
                counts += np.bincount(np.concatenate(waiting), minlength=COUNTERS)
            none = [None] * len(sizes)
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, k) for c, k in zip([sizes, nodes, none, none, none], kinds[1:])]], names=names)
        if counts.any():
            blocks = range(COUNTERS // BLOCK)
            none = [None] * len(blocks)
            body = [_packed(counts[b * BLOCK : (b + 1) * BLOCK]) for b in blocks]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip([none, none, none, list(blocks), [task] * len(blocks), body], kinds)], names=names)

    return docs.mapInArrow(run, "doc_id long, n long, node long, block int, task int, counts binary")


def _packed(counts: np.ndarray) -> bytes:
    """Byte planes, low bytes first, compressed: a table of few shingles takes little room."""
    return zlib.compress(counts.astype("<i8").view(np.uint8).reshape(-1, 8).T.tobytes(), 1)


def _unpacked(body: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(zlib.decompress(body), np.uint8).reshape(8, -1).T).view("<i8").ravel()


def counters(profiles: DataFrame) -> np.ndarray:
    """The sum of all tasks' counters: ``COUNTERS`` numbers, whatever the corpus."""

    def add(rows: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(BLOCK, "<i8")
        for body in rows["counts"]:
            total += _unpacked(body)
        return pd.DataFrame({"block": [rows["block"].iloc[0]], "task": [rows["task"].iloc[0] // FAN], "counts": [_packed(total)]})

    parts = profiles.where("block is not null").select("block", "task", "counts")
    kind = "block int, task int, counts binary"
    parts = parts.groupBy("block", F.expr(f"task div {FAN}")).applyInPandas(lambda k, g: add(g), kind)
    rows = parts.groupBy("block").applyInPandas(add, kind).collect()
    out = np.zeros(COUNTERS, np.int64)
    for r in rows:
        out[r["block"] * BLOCK : (r["block"] + 1) * BLOCK] = _unpacked(r["counts"])
    return out


#: low bytes of a shingle that are sent; its bucket tells the rest, all but some bits
BYTES = 5
#: a shingle's place in the order: some times the logarithm of how many have it, crowded cells last
STEPS, LAST = 8, 128
SENT = "bucket int, batch long, sets binary, tokens binary"


def _numbered(of: np.ndarray) -> bytes:
    """Ascending small numbers as steps of one byte, or as two bytes each where a step is larger."""
    steps = np.diff(of, prepend=0)
    return steps.astype(np.uint8).tobytes() if steps.max(initial=0) < 256 else of.astype("<u2").tobytes()


def _numbers(body: bytes, n: int) -> np.ndarray:
    return np.cumsum(np.frombuffer(body, np.uint8).astype(np.int64)) if len(body) == n else np.frombuffer(body, "<u2").astype(np.int64)


def _low(tokens: np.ndarray) -> bytes:
    return np.ascontiguousarray(tokens.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :BYTES]).tobytes()


def _whole(body: bytes, bucket: int = 0) -> np.ndarray:
    wide = np.zeros((len(body) // BYTES, 8), np.uint8)
    wide[:, :BYTES] = np.frombuffer(body, np.uint8).reshape(-1, BYTES)
    return wide.view("<u8").ravel() | (np.uint64(bucket & 0x7FFFFF) << np.uint64(8 * BYTES))


def dealt(docs: DataFrame, crowded, buckets: int) -> DataFrame:
    """Shingles by bucket of their high bits, a batch of sets at a time: (bucket, batch, which set, low bytes).

    Bucket -1 has the batch's sets: their identities and sizes. Bucket -2 has the shingles of crowded
    cells, as a whole; they stay with their batch.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        full, seen, turn = crowded.value > 0, set(), TaskContext.get().partitionId() << 32

        def pack(nodes: list[int], sets: list[np.ndarray]) -> pa.RecordBatch:
            tokens, sizes = np.concatenate(sets), np.array([len(s) for s in sets], "<i8")
            of = np.repeat(np.arange(len(sets)), sizes)
            rows = [(-1, turn, np.array(nodes, "<i8").tobytes(), sizes.tobytes())]
            last = full[cell_of(tokens)]
            if last.any():
                rows.append((-2, turn, of[last].astype("<u2").tobytes(), tokens[last].astype("<u8").tobytes()))
                of, tokens = of[~last], tokens[~last]
            bucket = ((tokens >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int32)
            order = np.argsort(bucket, kind="stable")
            bucket, of, tokens = bucket[order], of[order], tokens[order]
            cuts = [0, *(np.flatnonzero(np.diff(bucket)) + 1).tolist(), len(bucket)]
            rows += [(int(bucket[a]), turn, _numbered(of[a:b]), _low(tokens[a:b])) for a, b in zip(cuts, cuts[1:]) if a < b]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), (pa.int32(), pa.int64(), pa.binary(), pa.binary()))], names=["bucket", "batch", "sets", "tokens"])

        nodes, sets, held = [], [], 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                s = shingle_set(text)
                i = set_id(s)
                if not len(s) or i in seen:  # a task's copies need not be sent
                    continue
                if len(seen) > 1 << 20:
                    seen.clear()
                seen.add(i)
                nodes.append(i)
                sets.append(s)
                held += len(s)
                if held > AT_ONCE or len(sets) == 1 << 16:
                    yield pack(nodes, sets)
                    nodes, sets, held, turn = [], [], 0, turn + 1
        if sets:
            yield pack(nodes, sets)

    return docs.mapInArrow(run, SENT)


def shared(sent: DataFrame, crowded) -> DataFrame:
    """What of whole buckets several sets have goes back to its batch: (batch, bucket, sets, places, tokens)."""
    names = ["batch", "bucket", "sets", "places", "tokens"]
    kinds = (pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary())

    def out(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    def several(bucket: int, parts: list[tuple[int, np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        tokens = np.concatenate([p[2] for p in parts])
        ordered = np.sort(tokens)
        twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
        if not len(twice):
            return
        many = np.searchsorted(ordered, twice, "right") - np.searchsorted(ordered, twice)
        place = np.minimum(STEPS * np.log2(many), LAST - 1).astype(np.uint8)
        rows = []
        for batch, of, token in parts:
            at = np.minimum(np.searchsorted(twice, token), len(twice) - 1)
            pick = np.flatnonzero(twice[at] == token)
            if len(pick):
                rows.append((batch, bucket, _numbered(of[pick]), place[at[pick]].tobytes(), _low(token[pick])))
        if rows:
            yield out(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = crowded.value
        held, parts = None, []
        for arrow in batches:
            for bucket, batch, sets, body in zip(*[c.to_pylist() for c in arrow.columns]):
                if bucket == -1:
                    yield out([(batch, bucket, sets, b"", body)])
                    continue
                if bucket == -2:
                    place = LAST + np.minimum(STEPS / 2 * np.log2(np.maximum(cells[cell_of(np.frombuffer(body, "<u8"))], 1)), LAST - 1)
                    yield out([(batch, bucket, sets, place.astype(np.uint8).tobytes(), body)])
                    continue
                if bucket != held and parts:
                    yield from several(held, parts)
                    parts = []
                held = bucket
                parts.append((batch, _numbers(sets, len(body) // BYTES), _whole(body)))
        if parts:
            yield from several(held, parts)

    return sent.mapInArrow(run, "batch long, bucket int, sets binary, places binary, tokens binary")


def laid_out(found: DataFrame) -> DataFrame:
    """(node, n, tokens, at) of sets with 0.8 of their shingles shared, out of whole batches.

    tokens: the shared ones from the rarest on; ``at`` is the first one's place in the whole set.
    """

    def of_batch(rows: list[tuple]) -> pa.RecordBatch | None:
        nodes = sizes = None
        of, place, token = [], [], []
        for _, bucket, sets, places, body in rows:
            if bucket == -1:
                nodes, sizes = np.frombuffer(sets, "<i8"), np.frombuffer(body, "<i8")
                continue
            place.append(np.frombuffer(places, np.uint8))
            of.append(np.frombuffer(sets, "<u2").astype(np.int64) if bucket == -2 else _numbers(sets, len(places)))
            token.append(np.frombuffer(body, "<u8") if bucket == -2 else _whole(body, bucket))
        if nodes is None or not of:
            return None
        of, place, token = np.concatenate(of), np.concatenate(place), np.concatenate(token)
        many = np.bincount(of, minlength=len(nodes))
        near = 5 * many >= 4 * sizes
        pick = near[of]
        of, place, token = of[pick], place[pick], token[pick]
        order = np.lexsort((token, place, of))
        which = np.flatnonzero(near & (many > 0))
        lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(many[which])]), pa.int32()), pa.array(token[order].view(np.int64)))
        return pa.RecordBatch.from_arrays([pa.array(nodes[which]), pa.array(sizes[which]), lists, pa.array((sizes - many)[which])], names=["node", "n", "tokens", "at"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for arrow in batches:
            for row in zip(*[c.to_pylist() for c in arrow.columns]):
                if rows and rows[0][0] != row[0]:
                    out = of_batch(rows)
                    if out is not None:
                        yield out
                    rows = []
                rows.append(row)
        out = of_batch(rows) if rows else None
        if out is not None:
            yield out

    return found.mapInArrow(run, "node long, n long, tokens array<long>, at long")


def trie_links(center: np.ndarray, sets: list[np.ndarray], n: int | None = None, sizes: list[int] | None = None) -> np.ndarray:
    """Which of ``sets`` link with ``center``; all are in one order, common shingles first.

    ``n`` and ``sizes`` are those of the whole sets, where shingles that no other set has are left out.
    The sorted sets and the lengths that neighbours share are the trie in depth-first order: what
    a set shares with the one before it has been compared already. ``dead`` is the depth at which
    the branch was left; sets that share it that far are left with it.
    """
    links = np.zeros(len(sets), bool)
    by_value = np.sort(center)
    most = len(center)
    n = most if n is None else n
    order = sorted(range(len(sets)), key=lambda i: sets[i][:64].tolist())
    last, hits, dead = np.zeros(0, np.int64), np.zeros(1, np.int64), None
    for i in order:
        s = sets[i]
        m = len(s)
        need = least_overlap(n, m if sizes is None else sizes[i])
        k = min(len(last), m)
        differ = np.flatnonzero(last[:k] != s[:k])
        shared = int(differ[0]) if len(differ) else k
        if dead is not None and shared >= dead[0] and dead[1] + min(most - dead[1], m - dead[0]) < need:
            continue  # last stays: the next set is compared with the branch that was left
        shared = min(shared, len(hits) - 1)
        new, depth, dead = [hits[: shared + 1]], shared, None
        got = int(hits[shared])
        while depth < m:
            part = s[depth : depth + 128]
            at = np.searchsorted(by_value, part)
            inside = by_value[np.minimum(at, most - 1)] == part
            new.append(got + np.cumsum(inside))
            got += int(inside.sum())
            depth += len(part)
            if got + min(most - got, m - depth) < need:
                dead = (depth, got)
                break
        hits, last = np.concatenate(new), s
        links[i] = dead is None and got >= need
    return links


def verify(lists: DataFrame, sets: DataFrame) -> DataFrame:
    """pairs (center, node) that link, of ``lists`` (node, part, centers); no pair has a row before it has been verified.

    Sets whose lists begin with the same center are verified in blocks, which hold each center once.
    """
    lists = lists.select("node", "centers", F.xxhash64("part", F.array_min("centers")).alias("block"))
    fans = lists.groupBy("block").agg(F.ceil(F.count("*") / FAN).cast("int").alias("fan"))
    members = lists.join(fans, "block").select("block", F.pmod(F.xxhash64("node"), F.col("fan")).cast("int").alias("salt"), "node", "centers")
    heads = members.groupBy("block", "salt").agg(F.array_distinct(F.flatten(F.collect_list("centers"))).alias("centers"))
    heads = heads.select("block", "salt", F.explode("centers").alias("node"), F.lit(None).cast("array<long>").alias("centers"))
    both = heads.unionByName(members).join(sets.hint("merge"), "node").select("block", "salt", "node", "n", "tokens", "centers")
    both = both.repartition("block", "salt").sortWithinPartitions("block", "salt")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for g in groups(batches, ["block", "salt"]):
            tokens, n, nodes = [np.asarray(t)[::-1] for t in g["tokens"]], g["n"].tolist(), g["node"].tolist()
            at, asked = {}, {}
            for i, centers in enumerate(g["centers"]):
                if centers is None:
                    at[nodes[i]] = i
                else:
                    for c in centers.tolist():
                        asked.setdefault(c, []).append(i)
            found = []
            for c, rows in asked.items():
                links = trie_links(tokens[at[c]], [tokens[i] for i in rows], n[at[c]], [n[i] for i in rows])
                found += [(c, nodes[rows[k]]) for k in np.flatnonzero(links)]
            yield pd.DataFrame(found, columns=["center", "node"]).astype("int64")

    return both.mapInPandas(run, "center long, node long")


def _meets(x: Column, y: Column) -> Column:
    """The least overlap of the two sets, given by ``n`` and ``at``, is within reach if this shared shingle is their first."""
    return F.least(x["n"] - x["at"], y["n"] - y["at"]) >= -F.floor(-4 * (x["n"] + y["n"]) / 9)


def _lists(lost: DataFrame, cap: int) -> DataFrame:
    """(node, part, centers): the first ``cap`` sets of each shingle that a later one of it, in another component, may link with.

    Centers travel as lists of ``LIST`` or so, so that a set has a row for each list and not for each center.
    """
    parts = F.pow(F.lit(2), F.ceil(F.log2(F.greatest(F.least("many", F.lit(cap)) / LIST, F.lit(1))))).cast("int")
    lost = lost.withColumn("parts", parts)
    of = F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")
    heads = lost.where(F.col("turn") <= cap).groupBy("token", of.alias("k")).agg(F.collect_list(F.struct("node", "n", "at", "component", "turn")).alias("heads"))
    rows = lost.select("token", "parts", F.struct("node", "n", "at", "component", "turn").alias("y"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("k"))
    y = F.col("y")
    near = F.filter("heads", lambda x: (x["turn"] < y["turn"]) & (x["component"] != y["component"]) & _meets(x, y))
    # arrays of like values take few bytes in a shuffle, so that they look small enough to be broadcast when they are not
    met = rows.join(heads.hint("merge"), ["token", "k"]).select("y.node", (F.col("parts") + F.col("k")).alias("part"), F.transform(near, lambda x: x["node"]).alias("centers")).where(F.size("centers") > 0)
    return met.groupBy("node", "part").agg(F.array_distinct(F.flatten(F.collect_list("centers"))).alias("centers"))


def links(docs: DataFrame, common: np.ndarray, scratch: Scratch) -> DataFrame:
    """(node, component) of the sets that link with others: spanning links of all components, found in rounds."""
    spark = docs.sparkSession
    total = int(common.sum())
    crowded = np.where(common > CROWDED * total / COUNTERS + CALM, common, 0)
    shared_cells = spark.sparkContext.broadcast(np.minimum(crowded, np.iinfo(np.int32).max).astype(np.int32))
    count = max(8, -(-total // IN_BUCKET))
    sent = dealt(docs.select("text"), shared_cells, count).withColumn("to", F.when(F.col("bucket") < 0, F.pmod(F.xxhash64("batch"), F.lit(count))).otherwise(F.col("bucket")).cast("int"))
    sent = sent.repartitionById(count, F.col("to")).drop("to").sortWithinPartitions("bucket")
    back = shared(sent, shared_cells).repartition(F.col("batch")).sortWithinPartitions("batch")
    sets = scratch.save_by(laid_out(back).dropDuplicates(["node"]), "node", "sets")  # copies of other tasks count once
    # prefix shingles: the other set has 0.8 of this one's shingles at least
    first = F.slice("tokens", 1, (F.col("n") - F.ceil(4 * F.col("n") / 5) + 1 - F.col("at")).cast("int"))
    posts = scratch.save(sets.select("node", "n", F.posexplode(first).alias("k", "token"), "at").select("token", "node", "n", (F.col("at") + F.col("k")).alias("at")), "posts-0")
    # min and max tell one set from several, without gathering a shingle's sets
    several = posts.groupBy("token").agg(F.min("node").alias("center"), F.max("node").alias("other")).where("center <> other").select("token", "center")
    posts = scratch.save(posts.join(several, "token"), "posts")
    scratch.drop("posts-0")
    own = F.struct("n", "at")
    heads = posts.where("node = center").select("token", "center", own.alias("x"))
    star = posts.where("node <> center").select("token", "node", own.alias("y")).join(heads, "token").where(_meets(F.col("x"), F.col("y")))
    star = scratch.save(star.groupBy("node", F.lit(1).alias("part")).agg(F.collect_set("center").alias("centers")), "pairs-0")
    posts = posts.drop("center")
    joined, cap, step, longest = None, MORE, 0, None
    while True:
        linked = scratch.save(verify(star, sets), f"links-{step}")
        if joined is None:
            joined = connected_components(linked.select(F.col("center").alias("a"), F.col("node").alias("b")), scratch, f"cc-{step}")
        else:  # the new links join whole components
            name = lambda c: linked.join(joined.withColumnRenamed("node", c), c, "left").withColumn(c, F.coalesce("component", c)).drop("component")  # noqa: B023, E731
            linked = name("center")
            ends = linked.join(joined.withColumnRenamed("component", "to"), "node", "left").select(F.col("center").alias("a"), F.coalesce("to", "node").alias("b"))
            moved = connected_components(ends, scratch, f"cc-{step}")
            old = joined.join(moved.select(F.col("node").alias("component"), F.col("component").alias("to")), "component", "left").select("node", F.coalesce("to", "component").alias("component"))
            joined = old.unionByName(moved.join(joined, "node", "left_anti").select("node", "component"))
        joined = scratch.save(joined, f"joined-{step}")
        step += 1
        if longest is not None and longest <= cap // MORE:
            break  # every set of every shingle has been a center
        weight = joined.groupBy("component").agg(F.count("*").alias("size"))
        known = joined.join(weight, "component")
        lost = posts.join(known, "node", "left").withColumn("component", F.coalesce("component", "node")).withColumn("size", F.coalesce("size", F.lit(1)))
        split = lost.groupBy("token").agg(F.min("component").alias("a"), F.max("component").alias("b"), F.count("*").alias("many")).where("a < b")
        # the next centers: the first ``cap`` sets that a shingle leads to, those of large components first
        turn = F.row_number().over(Window.partitionBy("token").orderBy(F.desc("size"), "component", "node"))
        seen = Observation()
        lost = scratch.save(lost.join(split.select("token", "many"), "token").withColumn("turn", turn).observe(seen, F.max("many").alias("longest")), f"lost-{step}")
        longest = seen.get["longest"] or 0
        if not longest:
            break
        star = scratch.save(_lists(lost, cap), f"pairs-{step}")
        # a shingle whose sets are all joined is done with, and so is a set that has met all others of its shingle
        posts = lost.where(F.col("turn") > cap).select("token", "node", "n", "at")
        cap *= MORE
    scratch.drop("sets", "posts", *[f"{t}-{k}" for k in range(step) for t in ("pairs", "links", "lost")], *[f"{t}-{step}" for t in ("pairs", "lost")])
    return joined


def components(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of docs; needs doc_id and text.

    component_id: the least doc_id reachable by links, the document itself included. Documents
    without words (null, empty and blank texts) link with nothing. Rows with the same doc_id are
    each a row of the result. A null doc_id counts as the least, so a component with one has the
    component_id null. Other columns are ignored. An empty table gives an empty result.
    """
    docs = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LEAST)).alias("doc_id"), "text")
    profiles = scratch.save(profile(docs), "profiles")
    people = profiles.where("block is null").select("doc_id", "n", "node")
    joined = links(docs, counters(profiles), scratch)
    nodes = people.where("n > 0").groupBy("node").agg(F.min("doc_id").alias("first"))
    joined = nodes.join(joined, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = joined.groupBy("component").agg(F.min("first").alias("component_id"))
    named = scratch.save(joined.join(least, "component").select("node", "component_id"), "named")
    rows = people.join(named, "node", "left")
    given = lambda c: F.nullif(c, F.lit(LEAST))
    own = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return rows.select(given(F.col("doc_id")).alias("doc_id"), F.col("n").alias("n_shingles"), given(own).alias("component_id"))
