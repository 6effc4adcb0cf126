"""Mixing sources to target weights by weighted fair queueing.

Every source's documents are shuffled; a document's virtual finish time is the source's tokens up
to and with it, divided by the source's target. A source that is wanted more often than it is
large goes round again, up to ``REPEATS`` times. The whole queue is then sorted by finish time
over ranges and cut where the total budget is used up.

Both running sums are built from sums of small slices, so neither a hot source nor the whole
queue has to pass through one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchloom.llm.common import Scratch, quoted, unused

WEIGHTS, REPEATS, SLICES = (5, 2, 1), 3, 4096


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")).cast("long"), F.lit(0).cast("long"))


def targets(sizes: DataFrame, repeats: int = REPEATS, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """(source_key, source_size, target) from (source_key, source_size), one row a source.

    Sources in the order of their keys weigh ``weights`` in turn and share the sum of all sizes. A
    target stops at ``repeats`` times its source's size; the excess goes to the others by weight
    until none is above. This is a water level: in the order of size / weight the capped sources
    come first, and each row sees what is left for itself and those after it.
    """
    turn = (F.row_number().over(Window.orderBy("source_key")) - 1) % len(weights)
    rows = sizes.withColumn("w", F.get(F.lit(list(weights)), turn).cast("double")).withColumn("cap", F.col("source_size") * repeats)
    before = Window.orderBy((F.col("cap") / F.col("w")).asc(), "source_key").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = F.sum("source_size").over(whole) - F.coalesce(F.sum("cap").over(before), F.lit(0))
    rows = rows.withColumn("level", left / (F.sum("w").over(whole) - F.coalesce(F.sum("w").over(before), F.lit(0.0))))
    open_at = F.when(F.col("cap") > F.col("level") * F.col("w"), F.struct((F.col("cap") / F.col("w")).alias("r"), "source_key", "level"))
    rows = rows.withColumn("level", F.min(open_at).over(whole)["level"])
    share = F.least(F.col("cap").cast("double"), F.coalesce(F.col("level") * F.col("w"), F.col("cap").cast("double")))
    return rows.select("source_key", "source_size", share.alias("target"))


def mix(docs: DataFrame, size: Column, scratch: Scratch, seed: str = "mix", repeats: int = REPEATS) -> DataFrame:
    """docs with size, source_size, target and rounds, how often the mix takes the document (0 to ``repeats``).

    docs needs doc_id and source; other columns stay, whatever their names, but for columns of the
    four names above, which are replaced. Documents of size 0 (null or blank texts) are taken 0
    times. A null source is a source of its own, the last. Repeated rows (same id, source and size)
    are taken alike and each counts. The order depends on doc_id and ``seed`` alone, so reruns
    agree. An empty table gives an empty result.
    """
    keep = [c for c in docs.columns if c.lower() not in ("size", "source_size", "target", "rounds")]
    names = unused(docs, "source_key", "turn_key", "words_in")
    docs = docs.select(
        *quoted(*keep),
        F.coalesce(F.concat(F.lit("s"), "source"), F.lit("t")).alias(names[0]),
        F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")))).alias(names[1]),
        size.alias(names[2]),
    )
    key = ["source_key", "turn_key", "size"]
    plan = docs.select(*[F.col(n).alias(k) for n, k in zip(names, key)]).groupBy(*key).agg(F.count("*").alias("copies"))
    plan = plan.withColumn("mass", F.col("size") * F.col("copies")).withColumn("slice", F.conv(F.substring("turn_key", 1, 3), 16, 10).cast("int"))
    plan = scratch.save(plan, "plan")  # the texts are read here and once more at the end
    per_slice = plan.groupBy("source_key", "slice").agg(F.sum("mass").alias("part"))
    goal = scratch.save(targets(per_slice.groupBy("source_key").agg(F.sum("part").alias("source_size")), repeats), "goal")
    ahead = Window.partitionBy("source_key").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    heads = per_slice.withColumn("ahead", F.coalesce(F.sum("part").over(ahead), F.lit(0))).drop("part").join(goal, "source_key")
    inside = Window.partitionBy("source_key", "slice").orderBy("turn_key", "size").rowsBetween(Window.unboundedPreceding, 0)
    lined = scratch.save(plan.withColumn("cum", F.sum("mass").over(inside)).join(heads, ["source_key", "slice"]), "lined")
    queue = lined.where("size > 0").withColumn("round", F.explode(F.lit(list(range(repeats)))))
    queue = queue.withColumn("finish", (F.col("ahead") + F.col("cum") + F.col("round") * F.col("source_size")) / F.col("target"))
    # ranges of finish time: fine up to 4, by its logarithm beyond that
    wide = 4 * SLICES + F.floor(F.log2(F.greatest("finish", F.lit(4.0))) * 64)
    queue = queue.withColumn("range", F.when(F.col("finish") < 4, F.floor(F.col("finish") * SLICES)).otherwise(wide).cast("long"))
    sums = queue.groupBy("range").agg(F.sum("mass").alias("part"))
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)  # as many rows as there are ranges
    sums = sums.select("range", F.coalesce(F.sum("part").over(before), F.lit(0)).alias("before"))
    sums = sums.crossJoin(F.broadcast(goal.agg(F.sum("source_size").alias("budget"))))  # one row
    turn = Window.partitionBy("range").orderBy("finish", "turn_key", "source_key", "size").rowsBetween(Window.unboundedPreceding, 0)
    taken = queue.join(sums, "range").withColumn("used", F.col("before") + F.sum("mass").over(turn)).where("used <= budget")
    rounds = taken.groupBy(*key).agg(F.count("*").cast("int").alias("rounds"))
    told = scratch.save(lined.select(*key, "source_size", "target").join(rounds, key, "left"), "told")
    told = told.select(*[F.col(k).alias(n) for n, k in zip(names, key)], F.struct("source_size", "target", F.coalesce("rounds", F.lit(0)).alias("rounds")).alias("told"))
    answer, = unused(docs, "told")
    out = docs.join(told.withColumnRenamed("told", answer), names)
    return out.select(*quoted(*keep), F.col(names[2]).alias("size"), *[F.col(f"{answer}.{c}").alias(c) for c in ("source_size", "target", "rounds")])


def repeated(mixed: DataFrame) -> DataFrame:
    """The mix itself: each document as often as it is taken."""
    turn, = unused(mixed, "turn")
    return mixed.withColumn(turn, F.explode(F.when(F.col("rounds") > 0, F.sequence(F.lit(1), F.col("rounds"))).otherwise(F.array().cast("array<int>")))).drop(turn)
