"""Candidates from equal keys, with a cap on the rows that a key may have on either side."""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from matchloom.config import STRATEGIES, Config
from matchloom.functions.columns import unused
from matchloom.session import shared_folder, ship


def parts(df: DataFrame) -> int:
    """Tasks for joins whose rows multiply: given as a number, so that few bytes of input don't become few tasks."""
    spark = df.sparkSession
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * spark.sparkContext.defaultParallelism)


def small_blocks(side: DataFrame, key: str, cap: int) -> DataFrame:
    """Keys of up to ``cap`` rows; one aggregation, combined before its shuffle."""
    return side.where(F.col(key) != "").groupBy(F.col(key).alias("key")).agg(F.count("*").alias("n")).where(F.col("n") <= cap).select("key")


def exact_block(s1: DataFrame, sx: DataFrame, pair: str, key: str, strategy: str, cap: int = 1000) -> DataFrame:
    """(source1_entity_id, candidate_entity_id, source_pair, strategy) of rows with equal keys.

    The keys that are small enough on both sides are known before any row is joined, so a join's
    output has at most cap * cap rows a key.
    """
    keys = small_blocks(s1, key, cap).join(small_blocks(sx, key, cap), "key")
    left = s1.select(F.col("entity_id").alias("source1_entity_id"), F.col(key).alias("key")).join(keys, "key", "left_semi")
    right = sx.select(F.col("entity_id").alias("candidate_entity_id"), F.col(key).alias("key")).join(keys, "key", "left_semi")
    n = parts(s1)
    return left.repartition(n, "key").join(right.repartition(n, "key").hint("merge"), "key").select("source1_entity_id", "candidate_entity_id", F.lit(pair).alias("source_pair"), F.lit(strategy).alias("strategy"))


def exact_block_semi(s1: DataFrame, sx: DataFrame, pair: str, key: str, strategy: str, cap: int = 1000) -> DataFrame:
    """The earlier form, a semi-join on each side; the result is the same."""
    left = s1.select(F.col("entity_id").alias("source1_entity_id"), F.col(key).alias("key")).join(small_blocks(s1, key, cap), "key", "left_semi")
    right = sx.select(F.col("entity_id").alias("candidate_entity_id"), F.col(key).alias("key")).join(small_blocks(sx, key, cap), "key", "left_semi")
    return left.join(right, "key").select("source1_entity_id", "candidate_entity_id", F.lit(pair).alias("source_pair"), F.lit(strategy).alias("strategy"))


def _stacked(side: DataFrame, name: str) -> DataFrame:
    """(``name``, strategy, key), a row for each key that is not empty."""
    keys = F.explode(F.array(*[F.struct(F.lit(s).alias("strategy"), F.col(k).alias("key")) for s, k in STRATEGIES.items()])).alias("k")
    return side.select(F.col("entity_id").alias(name), keys).select(name, "k.strategy", "k.key").where("key <> ''")


@dataclass
class Blocks:
    """Both sides of every strategy and pair, without the keys that are too frequent on either side.

    ``left`` (source1_entity_id, strategy, key) and ``right`` (candidate_entity_id, source_pair,
    strategy, key) hold a row for each key of a row; ``keys`` has the rows of either side of each
    (source_pair, strategy, key) as ``n1`` and ``nx``, both at least 1.
    """

    left: DataFrame
    right: DataFrame
    keys: DataFrame


def blocks(s1: DataFrame, others: dict[str, DataFrame], config: Config = Config()) -> Blocks:
    """Keys of all strategies stand below each other, so that one aggregation of either side serves them all."""
    left = _stacked(s1, "source1_entity_id")
    right = reduce(DataFrame.unionByName, [_stacked(sx, "candidate_entity_id").withColumn("source_pair", F.lit(pair)) for pair, sx in others.items()])
    small = lambda side, n, *by: side.groupBy(*by).agg(F.count("*").alias(n)).where(F.col(n) <= config.block_cap)
    keys = small(left, "n1", "strategy", "key").join(small(right, "nx", "source_pair", "strategy", "key"), ["strategy", "key"])
    kept = left.join(keys.select("strategy", "key"), ["strategy", "key"], "left_semi")
    return Blocks(kept, right.join(keys, ["source_pair", "strategy", "key"], "left_semi"), keys)


def _met(left: DataFrame, right: DataFrame) -> DataFrame:
    n = parts(left)
    # keys repeat, so that shuffled rows look small enough to be broadcast when they are not
    return left.repartition(n, "strategy", "key").join(right.repartition(n, "strategy", "key").hint("merge"), ["strategy", "key"])


def all_exact_blocks(s1: DataFrame, others: dict[str, DataFrame], config: Config = Config()) -> DataFrame:
    """Every strategy on every pair, as one table and by one join, whatever the number of strategies and pairs."""
    b = blocks(s1, others, config)
    return _met(b.left, b.right).select("source1_entity_id", "candidate_entity_id", "source_pair", "strategy")


_ALL_BUT_LAST = range(len(STRATEGIES) - 1)
CODES, SETS = [f"c{j}" for j in range(len(STRATEGIES))], [f"s{j}" for j in range(len(STRATEGIES))]
#: keys of blocks that are sent to all tasks; more are met by a merge
FEW_KEYS = 100_000


class Coded:
    """Both sides of every strategy and pair by codes instead of keys, written below ``spark.checkpoint.dir``.

    ``keys`` has (code, j, key, n0, n1, ...): the keys that are frequent enough but not too frequent in
    source 1 and another source, with their rows in each. ``ids`` has a row for each id of source 1
    (side 0) and each id of the others: its code of each strategy, null for none, as c0, c1 ... A code
    that is too frequent in a source is missing on its rows, so two ids with one code are a pair that
    its strategy finds. ``several`` ids have more than one key of a strategy or are in two sources.
    """

    def __init__(self, s1: DataFrame, others: dict[str, DataFrame], config: Config = Config()):
        self.spark, self.pairs, self.n = s1.sparkSession, list(others), parts(s1)
        folder = self.folder = shared_folder(self.spark, "blocks")
        keys = F.explode(F.array(*[F.struct(F.lit(j).cast("tinyint").alias("j"), F.col(k).alias("key")) for j, k in enumerate(STRATEGIES.values())])).alias("k")
        sided = [side.select(F.lit(i).cast("tinyint").alias("side"), "entity_id", keys) for i, side in enumerate([s1, *others.values()])]
        rows = reduce(DataFrame.unionByName, sided).select("side", "entity_id", "k.j", "k.key").where("key <> ''")
        within = [F.col(f"n{i}").between(1, config.block_cap) for i in range(len(sided))]
        counts = rows.groupBy("j", "key").agg(*[F.count_if(F.col("side") == i).alias(f"n{i}") for i in range(len(sided))])
        self.within = within
        self.keys, told = self._saved(counts.where(within[0] & reduce(Column.__or__, within[1:])).select(F.monotonically_increasing_id().alias("code"), "*"), f"{folder}/keys", F.lit(True))
        self.few = told <= FEW_KEYS
        known = F.broadcast(self.keys) if self.few else self.keys
        met = rows.join(known if self.few else known.hint("merge"), ["j", "key"])
        kept = reduce(Column.__or__, [(F.col("side") == i) & w for i, w in enumerate(within)])
        #: (side, entity_id, j, code) of every row of either side
        self.met = met.where(kept).select("side", "entity_id", "j", "code")
        of = lambda j: F.when(F.col("j") == j, F.col("code"))
        every = range(len(STRATEGIES))
        differ = [F.min("side") != F.max("side"), *[F.coalesce(F.min(of(j)) != F.max(of(j)), F.lit(False)) for j in every]]
        ids = self.met.groupBy((F.col("side") > 0).alias("other"), "entity_id").agg(F.max("side").alias("side"), reduce(Column.__or__, differ).alias("several"), *[F.max(of(j)).alias(f"c{j}") for j in every])
        self.ids, self.several = self._saved(ids, f"{folder}/ids", F.col("several"))

    def _saved(self, df: DataFrame, path: str, what: Column) -> tuple[DataFrame, int]:
        """df, written and read again, and how many of its rows are ``what``."""
        seen = Observation()
        df.observe(seen, F.count_if(what).alias("n")).write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path), seen.get["n"] or 0

    def named(self, df: DataFrame) -> DataFrame:
        """df with source_pair and strategy for side and j, the latter if it has one."""
        name = lambda names, at: F.element_at(F.lit(names), at.cast("int"))
        told = {"source_pair": name(self.pairs, F.col("side"))}
        if "j" in df.columns:
            told["strategy"] = name(list(STRATEGIES), F.col("j") + 1)
        return df.withColumns(told).drop("side", "j")

    def sizes(self) -> DataFrame:
        """(source_pair, strategy, candidate_rows) of all pairs found, from the sizes of blocks."""
        each = F.explode(F.array(*[F.struct(F.lit(i).alias("side"), F.when(self.within[i], F.col("n0") * F.col(f"n{i}")).alias("n")) for i in range(1, len(self.within))])).alias("p")
        return self.named(self.keys.select("j", each).select("j", "p.side", "p.n").where("n is not null").groupBy("side", "j").agg(F.sum("n").alias("candidate_rows")))

    def _single(self, other: bool, name: str, prefix: str) -> DataFrame:
        """(``name``, side of others, j, code, the codes of earlier strategies) of ids with one code a strategy at most."""
        none = F.lit(None).cast("long")
        rows = [F.struct(F.lit(j).cast("tinyint").alias("j"), F.col(f"c{j}").alias("code"), *[(F.col(f"c{i}") if i < j else none).alias(f"{prefix}{i}") for i in _ALL_BUT_LAST]) for j in range(len(STRATEGIES))]
        ids = self.ids.where((F.col("other") == other) & ~F.col("several"))
        own = [F.col("entity_id").alias(name), *["side"] * other]
        return ids.select(*own, F.explode(F.array(*rows)).alias("r")).select(name, *["side"] * other, *[f"r.{c}" for c in (["code"] if other else ["j", "code"])], *[f"r.{prefix}{i}" for i in _ALL_BUT_LAST]).where("code is not null")

    def left(self) -> DataFrame:
        return self._single(False, "source1_entity_id", "l")

    def right(self) -> DataFrame:
        return self._single(True, "candidate_entity_id", "r")

    def join(self, left: DataFrame, right: DataFrame) -> DataFrame:
        # codes repeat, so that shuffled rows look small enough to be broadcast when they are not
        return left.repartition(self.n, "code").join(right.repartition(self.n, "code").hint("merge"), "code")

    def first_pairs(self) -> DataFrame:
        """Each pair of ids with one code a strategy, by the first strategy that finds it, which the codes of both tell."""
        return self.join(self.left(), self.right()).where(~_before([F.col(f"l{i}") for i in _ALL_BUT_LAST], [F.col(f"r{i}") for i in _ALL_BUT_LAST]))

    def rest(self) -> DataFrame:
        """(source1_entity_id, candidate_entity_id, side, j) of all other ids; a pair may stand several times."""
        own = ["source1_entity_id", "candidate_entity_id", "side", "j"]
        lefts, rights = (self.met.where(w).withColumnRenamed("entity_id", n) for w, n in (("side = 0", "source1_entity_id"), ("side > 0", "candidate_entity_id")))
        lefts, rights = lefts.drop("side"), rights.drop("j")
        if not self.several:
            return self.spark.createDataFrame([], self.join(lefts, rights).select(*own).schema)
        of = lambda rows, name, other: rows.join(self.ids.where((F.col("other") == other) & F.col("several")).select(F.col("entity_id").alias("again")), F.col(name).eqNullSafe(F.col("again")), "left_semi")
        again = self.join(of(lefts, "source1_entity_id", False), rights).select(*own)
        return again.unionByName(self.join(self.left().select("source1_entity_id", "j", "code"), of(rights, "candidate_entity_id", True)).select(*own))

    def _sets(self) -> DataFrame:
        """(side, entity_id, sign, s0, s1 ...): every id with one code a strategy at most, once for each set of its codes; -1 for a code out of the set.

        The ids that share a code with another one are those that share a set of one code, less those of two,
        and so on: ``sign`` is 1 for odd sets and -1 for even ones. So pairs are counted by as many rows as
        ids have sets, 127 at most, whatever the size of blocks. A block that lies in another one finds no pair
        more, and its code is left out first, unless there are many keys.
        """
        rows = self.ids.where(~F.col("several")).select("side", "entity_id", *CODES)
        if self.few:
            many = {r["j"]: r["count"] for r in self.keys.groupBy("j").count().collect()}  # a row for each strategy
            order = sorted(range(len(CODES)), key=lambda j: many.get(j, 0))
            each = F.explode(F.array(*[F.struct(F.lit(at).alias("at"), F.col(CODES[j]).alias("code")) for at, j in enumerate(order)])).alias("b")
            within = [(F.first("at") > at) & (F.count(CODES[j]) == F.count("*")) & (F.min(CODES[j]) == F.max(CODES[j])) for at, j in enumerate(order)]
            blocks = rows.select(each, *CODES).select("b.*", *CODES).where("code is not null").groupBy("code").agg(F.coalesce(reduce(Column.__or__, within), F.lit(False)).alias("within"))
            inner, told = self._saved(blocks.where("within").select("code"), f"{self.folder}/within-{uuid.uuid4().hex}", F.lit(True))
            for c in CODES if told else []:
                rows = rows.join(F.broadcast(inner.select(F.col("code").alias("inner"))), F.col(c) == F.col("inner"), "left").withColumn(c, F.when(F.col("inner").isNull(), F.col(c))).drop("inner")
        for c, s in zip(CODES, SETS):
            none = F.lit(-1).cast("long")
            rows = rows.withColumn(s, F.explode(F.when(F.col(c).isNull(), F.array(none)).otherwise(F.array(none, F.col(c))))).drop(c)
        size = reduce(Column.__add__, [(F.col(s) >= 0).cast("int") for s in SETS])
        return rows.where(size > 0).withColumn("sign", F.when(size % 2 == 1, 1).otherwise(-1))

    def unique_sizes(self) -> DataFrame:
        """(source_pair, candidate_rows) of the distinct pairs, which are not made but for those of ids with several codes."""
        sides = range(1, len(self.pairs) + 1)
        met = self._sets().groupBy(*SETS).agg(F.first("sign").alias("sign"), *[F.count_if(F.col("side") == i).alias(f"m{i}") for i in range(len(self.pairs) + 1)])
        each = F.explode(F.array(*[F.struct(F.lit(i).cast("tinyint").alias("side"), (F.col("sign") * F.col("m0") * F.col(f"m{i}")).alias("n")) for i in sides])).alias("p")
        sums = met.select(each).select("p.*").groupBy("side").agg(F.sum("n").alias("n"))
        again = self.rest().select("source1_entity_id", "candidate_entity_id", "side").distinct().groupBy("side").agg(F.count("*").alias("n"))
        return self.named(sums.unionByName(again).groupBy("side").agg(F.sum("n").alias("candidate_rows")).where("candidate_rows > 0"))

    def unique_counts(self) -> DataFrame:
        """(source1_entity_id, n): distinct pairs of ids with one code a strategy, by the id of source 1; they are not made."""
        sets = self._sets()
        others = sets.where("side > 0").groupBy(*SETS).agg(F.count("*").alias("n"))
        met = sets.where("side = 0").repartition(self.n, *SETS).join(others.hint("merge"), SETS)
        return met.groupBy(F.col("entity_id").alias("source1_entity_id")).agg(F.sum(F.col("sign") * F.col("n")).alias("n"))


def _before(mine: list[Column], theirs: list[Column]) -> Column:
    """Whether two ids meet under an earlier strategy as well."""
    return F.coalesce(reduce(Column.__or__, [a == b for a, b in zip(mine, theirs)]), F.lit(False))


def unique_exact_blocks(s1: DataFrame, others: dict[str, DataFrame], config: Config = Config(), with_strategy: bool = False) -> DataFrame:
    """(source1_entity_id, candidate_entity_id, source_pair), the distinct candidates of all strategies; ``with_strategy``: of each.

    A pair is given by the first strategy that finds it, which the keys of both rows tell: pairs are
    not shuffled to find copies. Only those of ids with several rows are.
    """
    b = Coded(s1, others, config)
    own = ["source1_entity_id", "candidate_entity_id", "side", *["j"] * with_strategy]
    first = b.join(b.left(), b.right()) if with_strategy else b.first_pairs()
    return b.named(first.select(*own).unionByName(b.rest().select(*own).distinct()))


#: pairs of a range of ids, more or less, for all of which one task has the blocks; candidates of a batch of lists
RANGE_PAIRS, BATCH_IDS = 32_000_000, 1_000_000
_APART = "\0"


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([zlib.compress(t.encode(), 6) for t in batch.column(1).to_pylist()], pa.binary())], names=["code", "ids"])


def _of_range(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The lists of a range's ids, from its blocks, which come first, and from rows of each id with the codes of its blocks."""
    codes, texts, known = [], [], None
    for batch in batches:
        blocks = int(np.searchsorted(batch.column(0).to_numpy(), 1))
        codes += batch.column(1)[:blocks].to_pylist()
        texts += [zlib.decompress(x).decode() for x in batch.column(2)[:blocks].to_pylist()]
        if blocks < len(batch):
            known = known or _Known(codes, texts)
            yield from known.lists(batch.slice(blocks))


class _Known:
    """Blocks by code; their ids are numbered in the order of their bytes."""

    def __init__(self, codes: list[int], texts: list[str]):
        split = pc.split_pattern(pa.array(texts, pa.large_string()), _APART)
        texts.clear()
        coded = split.flatten().dictionary_encode()
        order = pc.sort_indices(coded.dictionary)
        number = np.empty(len(order), np.int32)
        number[order.to_numpy()] = np.arange(len(order), dtype=np.int32)
        self.ids, self.flat = coded.dictionary.take(order), number[coded.indices.to_numpy()]
        ends = split.offsets.to_numpy()
        self.at = {c: (int(a), int(b)) for c, a, b in zip(codes, ends[:-1], ends[1:])}

    def _batch(self, ids: list[str], lists: list[np.ndarray], more: list[str | None]) -> pa.RecordBatch:
        ends = np.cumsum([0, *map(len, lists)])
        joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), self.ids.take(pa.array(np.concatenate(lists))).cast(pa.string())), ",")
        if any(m is not None for m in more):
            of = lambda found, m: sorted({*self.ids.take(pa.array(found)).to_pylist(), *m.split(_APART)}, key=str.encode)
            whole = [t if m is None else ",".join(of(found, m)) for t, found, m in zip(joined.to_pylist(), lists, more)]
            joined = pa.array(whole, pa.string())
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), joined], names=["source1_entity_id", "candidate_entity_ids"])

    def lists(self, rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        ids, lists, more, n = [], [], [], 0
        for i, codes, m in zip(*(rows.column(c).to_pylist() for c in (3, 4, 5))):
            blocks = [self.flat[slice(*self.at[c])] for c in codes if c in self.at]
            found = np.sort(np.concatenate(blocks)) if blocks else self.flat[:0]
            if len(blocks) > 1:
                found = found[np.r_[True, found[1:] != found[:-1]]]
            ids.append(i), lists.append(found), more.append(m)
            n += len(found)
            if n >= BATCH_IDS:
                yield self._batch(ids, lists, more)
                ids, lists, more, n = [], [], [], 0
        if ids:
            yield self._batch(ids, lists, more)


def exact_lists(s1: DataFrame, others: dict[str, DataFrame], config: Config = Config()) -> DataFrame:
    """(source1_entity_id, candidate_entity_ids): the candidates of all strategies, sorted and joined by commas, '' for none; in the order of ids.

    Lists are not shuffled. Ids of source 1 are dealt in ranges, and each range's task gets every block that
    its ids have codes of, once, packed. It makes the lists of its ids in their order.
    """
    b = Coded(s1, others, config)
    ship(b.spark)
    own, n, codes = "source1_entity_id", b.n, F.array_compact(F.array(*CODES))
    rows = [s1.select(F.col("entity_id").alias(own)), b.ids.where(~F.col("other") & ~F.col("several")).select(F.col("entity_id").alias(own), *CODES)]
    again = [b.rest().select(own, "candidate_entity_id").distinct().groupBy(own).agg(F.array_join(F.collect_list("candidate_entity_id"), _APART).alias("more"))] if b.several else []
    every = reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), [*rows, *again])
    every = every if again else every.withColumn("more", F.lit(None).cast("string"))
    asked = every.groupBy(own).agg(*[F.max(c).alias(c) for c in CODES], F.max("more").alias("more")).select(own, codes.alias("codes"), "more")
    pairs = b.sizes().agg(F.coalesce(F.sum("candidate_rows"), F.lit(0))).first()[0]
    ranges = max(2 * b.spark.sparkContext.defaultParallelism, -(-pairs // RANGE_PAIRS))
    asked, _ = b._saved(asked.repartitionByRange(ranges, own).withColumn("range", F.spark_partition_id()), f"{b.folder}/asked", F.lit(True))
    ids = b.ids.where(F.col("other") & ~F.col("several")).select("entity_id", F.explode(codes).alias("code"))
    blocks = ids.groupBy("code").agg(F.array_join(F.array_sort(F.collect_list("entity_id")), _APART).alias("ids")).mapInArrow(_packed, "code long, ids binary")
    wanted = asked.select("range", F.explode("codes").alias("code")).distinct()
    sent = wanted.repartition(n, "code").join(blocks.repartition(n, "code").hint("merge"), "code").select("range", F.lit(0).alias("kind"), "code", "ids")
    both = sent.unionByName(asked.withColumn("kind", F.lit(1)), allowMissingColumns=True)
    dealt = both.repartitionById(ranges, F.col("range")).sortWithinPartitions("kind", own)
    return dealt.select("kind", "code", "ids", own, "codes", "more").mapInArrow(_of_range, f"{own} string, candidate_entity_ids string")


def exact_counts(s1: DataFrame, others: dict[str, DataFrame], config: Config = Config(), by_pair: bool = False) -> DataFrame:
    """(source1_entity_id, candidate_count): distinct candidate ids of each id of s1, 0 included; ``by_pair``: once for each source_pair.

    Pairs are made for ids with several rows only; the others' are counted by the sets of codes that they share.
    """
    b = Coded(s1, others, config)
    number = lambda df: df.groupBy("source1_entity_id").agg(F.count("*").alias("n"))
    again = b.rest().select("source1_entity_id", "candidate_entity_id", *["side"] * by_pair).distinct()
    none = s1.select(F.col("entity_id").alias("source1_entity_id"), F.lit(0).cast("long").alias("n"))
    every = b.unique_counts().unionByName(number(again)).unionByName(none)
    return every.groupBy("source1_entity_id").agg(F.sum("n").alias("candidate_count"))


def exact_audit(s1: DataFrame, others: dict[str, DataFrame], config: Config = Config()) -> DataFrame:
    """What ``strategy_audit`` tells of all exact blocks, from the sizes of blocks and the ids in them; no pair is made."""
    b, by = blocks(s1, others, config), ["source_pair", "strategy"]
    rows = b.keys.groupBy(*by).agg(F.sum(F.col("n1") * F.col("nx")).alias("candidate_rows"))
    ids = lambda side, name, told: side.groupBy(*by).agg(F.countDistinct(name).alias(told))
    asked = ids(b.left.join(b.keys.select(*by, "key").hint("merge"), ["strategy", "key"]), "source1_entity_id", "source1_with_candidates")
    return rows.join(asked, by).join(ids(b.right, "candidate_entity_id", "unique_candidates"), by)


def exact_recall(truth: DataFrame, s1: DataFrame, others: dict[str, DataFrame], config: Config = Config()) -> tuple[DataFrame, DataFrame]:
    """Recall of every strategy with candidates and of their union, of typed pairs of the truth by all exact blocks.

    Each pair of the truth is held against the keys of its two ids; candidates are not made.
    """
    b = blocks(s1, others, config)
    end = "\0"  # of the strategy's name
    keys = F.collect_set(F.concat("strategy", F.lit(end), "key"))
    known = truth.where("source_pair <> 'unknown'").join(b.left.groupBy("source1_entity_id").agg(keys.alias("lk")), "source1_entity_id", "left")
    held = known.join(b.right.groupBy("candidate_entity_id", "source_pair").agg(keys.alias("rk")), ["candidate_entity_id", "source_pair"], "left")
    by = F.coalesce(F.transform(F.array_intersect("lk", "rk"), lambda k: F.substring_index(k, end, 1)), F.array().cast("array<string>"))
    told = held.select("source_pair", by.alias("by")).groupBy("source_pair")
    return _recall(told.agg(F.count("*").alias("gt_pairs"), F.count_if(F.size("by") > 0).alias("union"), *[F.count_if(F.array_contains("by", s)).alias(s) for s in STRATEGIES]), b)


def _recall(told: DataFrame, b: Blocks) -> tuple[DataFrame, DataFrame]:
    hits = F.create_map(*[x for s in STRATEGIES for x in (F.lit(s), F.col(s))])
    out = lambda df, n: df.select("strategy", "source_pair", "gt_pairs", n.alias("recovered_pairs"), (n / F.col("gt_pairs")).alias("recall"))
    each = told.crossJoin(b.keys.select("strategy").distinct())  # two rows, seven rows
    return out(each, hits[F.col("strategy")]), out(told.withColumn("strategy", F.lit("ALL_UNION")), F.col("union"))


def _keys_of(side: DataFrame, name: str, *by: str) -> DataFrame:
    """(``name``, ``by``, k0, k1 ..., all): the key of each strategy; ids with several keys of one strategy have all of theirs in ``all``, others null."""
    of = lambda s: F.when(F.col("strategy") == s, F.col("key"))
    several = F.coalesce(reduce(Column.__or__, [F.min(of(s)) != F.max(of(s)) for s in STRATEGIES]), F.lit(False))
    return side.groupBy(name, *by).agg(*[F.max(of(s)).alias(f"k{j}") for j, s in enumerate(STRATEGIES)], F.when(several, F.array(*[F.collect_set(of(s)) for s in STRATEGIES])).alias("all"))


def exact_recall_of_classes(askers: DataFrame, members: DataFrame, s1: DataFrame, others: dict[str, DataFrame], config: Config = Config()) -> tuple[DataFrame, DataFrame]:
    """What ``exact_recall`` tells where the truth is given by classes, as long as the ids and not as their pairs.

    askers: (source1_entity_id, class), members: (candidate_entity_id, source_pair, class); the truth's pairs are
    those of an asker and a member of its class. They are made, compared and counted in the class's task.
    """
    b = blocks(s1, others, config)
    names = [f"k{j}" for j in range(len(STRATEGIES))]
    side = lambda rows, keys, on, p: rows.join(keys.hint("merge"), on, "left").withColumnsRenamed({c: f"{p}{c}" for c in [*names, "all"]})
    left = side(askers, _keys_of(b.left, "source1_entity_id"), ["source1_entity_id"], "l")
    right = side(members, _keys_of(b.right, "candidate_entity_id", "source_pair"), ["candidate_entity_id", "source_pair"], "r")
    n = parts(s1)
    met = left.repartition(n, "class").join(right.repartition(n, "class").hint("merge"), "class")
    every = lambda p, j: F.coalesce(F.col(f"{p}all")[j], F.array_compact(F.array(f"{p}k{j}")))
    alone = F.col("lall").isNull() & F.col("rall").isNull()
    hit = lambda j: F.coalesce(F.when(alone, F.col(f"lk{j}") == F.col(f"rk{j}")).otherwise(F.arrays_overlap(every("l", j), every("r", j))), F.lit(False))
    found = met.select("source_pair", *[hit(j).alias(s) for j, s in enumerate(STRATEGIES)]).groupBy("source_pair")
    some = reduce(Column.__or__, [F.col(s) for s in STRATEGIES])
    return _recall(found.agg(F.count("*").alias("gt_pairs"), F.count_if(some).alias("union"), *[F.count_if(F.col(s)).alias(s) for s in STRATEGIES]), b)


def distinct_candidates(found: DataFrame, with_strategy: bool = False) -> DataFrame:
    keys = ["source1_entity_id", "candidate_entity_id", "source_pair", *["strategy"] * with_strategy]
    return found.select(*keys).dropDuplicates(keys)


def unresolved(s1: DataFrame, unique: DataFrame, config: Config = Config()) -> DataFrame:
    """Rows of s1 with a roman name and fewer candidates than the gate, over all pairs together."""
    n = F.count("*") if config.mode == "v2" else F.countDistinct("candidate_entity_id")
    return below_gate(s1, unique.groupBy("source1_entity_id").agg(n.alias("candidate_count")), config)


def below_gate(s1: DataFrame, counts: DataFrame, config: Config = Config()) -> DataFrame:
    """Rows of s1 with a roman name and fewer candidates than the gate by (source1_entity_id, candidate_count)."""
    told = unused(s1, "candidates")
    counts = counts.select(F.col("source1_entity_id").alias("entity_id"), F.col("candidate_count").alias(told))
    return s1.where(F.col("roman_name_key_base") != "").join(counts, "entity_id", "left").where(F.coalesce(told, F.lit(0)) < config.tfidf_gate).drop(told)
