"""Candidates of all strategies without a shuffle of pairs, held against the distinct rows of the join."""

import re

import pytest
from pyspark.sql import functions as F

from matchloom.config import STRATEGIES, Config
from matchloom.operators import blocking, evaluate, tfidf
from matchloom.plans import queries as plans

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def made(spark):
    """Keys with frequent values, ids on several rows with other keys, and an id that both other sources have."""
    names = list(STRATEGIES.values())
    row = lambda i, k: (f"{i}", *["" if (k + j) % 5 == 0 else f"v{(k * (j + 1)) % (3 + j)}" for j in range(len(names))])
    side = lambda ids: spark.createDataFrame([row(i, k) for k, i in enumerate(ids)], ", ".join(f"`{c}` string" for c in ["entity_id", *names]))
    return side([f"a{k}" for k in range(12)] + ["a1", "a2", "a2"]), {"s1_s2": side([f"b{k}" for k in range(9)] + ["b1", "x"]), "s1_s3": side([f"c{k}" for k in range(11)] + ["x", "x", "c3"])}


@pytest.mark.parametrize("cap", [3, 1000])
def test_pairs_are_given_once(spark, made, cap):
    config, plain = Config(block_cap=cap), lambda df: sorted(tuple(r) for r in df.collect())
    found = blocking.all_exact_blocks(*made, config)
    unique = blocking.distinct_candidates(found)
    assert plain(blocking.unique_exact_blocks(*made, config)) == plain(unique)
    assert plain(blocking.unique_exact_blocks(*made, config, with_strategy=True)) == plain(blocking.distinct_candidates(found, with_strategy=True))
    assert plain(blocking.exact_counts(*made, config)) == plain(evaluate.count_distribution(made[0], unique))
    assert plain(evaluate.coverage_of_counts(blocking.exact_counts(*made, config, by_pair=True))) == plain(evaluate.coverage(made[0], unique))
    assert plain(blocking.exact_audit(*made, config)) == plain(evaluate.strategy_audit(found))
    lists = {r[0]: r[1].split(",") if r[1] else [] for r in blocking.exact_lists(*made, config).collect()}
    assert {k: sorted(set(v)) for k, v in lists.items()} == {r[0]: r[1].split(",") if r[1] else [] for r in evaluate.candidate_lists(made[0], unique).collect()}
    assert all(v == sorted(set(v)) for v in lists.values())


@pytest.mark.parametrize("cap", [4, 1000])
def test_recall_without_candidates(spark, made, cap):
    config, plain = Config(block_cap=cap), lambda df: sorted(tuple(r) for r in df.collect())
    truth = spark.createDataFrame([(f"a{k}", f"{s}{k * m % 9}", p) for k in range(12) for m in (1, 2) for s, p in (("b", "s1_s2"), ("c", "s1_s3"), ("x", "unknown"))], "source1_entity_id string, candidate_entity_id string, source_pair string")
    found = blocking.all_exact_blocks(*made, config)
    each, union = blocking.exact_recall(truth, *made, config)
    assert plain(each) == plain(evaluate.recall_by_strategy(truth, found).select(*each.columns))
    assert plain(union) == plain(evaluate.recall_union(truth, found).select(*union.columns))


@pytest.mark.parametrize("cap", [4, 1000])
def test_recall_of_classes(spark, made, cap):
    """Classes of ids tell what their pairs tell, also of ids with several rows."""
    config, plain = Config(block_cap=cap), lambda df: sorted(tuple(r) for r in df.collect())
    askers = spark.createDataFrame([(f"a{k}", f"{k % 4}") for k in range(12)] + [("nobody", "1")], "source1_entity_id string, class string")
    members = spark.createDataFrame([(f"{s}{k}", p, f"{k % 4}") for k in range(9) for s, p in (("b", "s1_s2"), ("c", "s1_s3"))] + [("x", "s1_s3", "2")], "candidate_entity_id string, source_pair string, class string")
    truth = askers.join(members, "class").drop("class")
    for got, want in zip(blocking.exact_recall_of_classes(askers, members, *made, config), blocking.exact_recall(truth, *made, config)):
        assert plain(got) == plain(want)


@pytest.mark.parametrize("name", ["candidates_dedup", "candidates_dedup_v1", "count_distribution", "unresolved_s1", "recall_union"])
def test_pairs_stay_in_their_task(spark, name):
    """Where ids stand on one row each, no pair is sent anywhere to find its copies."""
    found = plans.QUERIES[name](spark, SF)
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString()
    final = plan[: plan.index("Initial Plan")]
    pair = r"Exchange hashpartitioning\((source1_entity_id#\d+, candidate_entity_id#\d+|candidate_entity_id#\d+, source1_entity_id#\d+)"
    sent = [line for line in final.splitlines() if re.search(pair, line)]
    assert not sent, sent


def test_blocks_are_not_joined_in_few_tasks(spark):
    """The rows of blocks are few bytes, their pairs many: the join keeps its number of tasks."""
    for name in ("block_house_city", "candidates_dedup"):
        met = plans.QUERIES[name](spark, SF)
        met.collect()
        assert "REPARTITION_BY_NUM" in met._jdf.queryExecution().executedPlan().toString(), name


def test_sizes_of_coded_blocks(spark, made, monkeypatch):
    """Codes tell as many pairs as keys do, also where keys are merged; no key is in a shuffle after that."""
    monkeypatch.setattr(blocking, "FEW_KEYS", 0)
    config, plain = Config(block_cap=3), lambda df: sorted(tuple(r) for r in df.collect())
    found = blocking.all_exact_blocks(*made, config)
    unique = blocking.distinct_candidates(found)
    coded = blocking.Coded(*made, config)
    assert plain(coded.sizes().select("source_pair", "strategy", "candidate_rows")) == plain(found.groupBy("source_pair", "strategy").count())
    assert plain(coded.unique_sizes().select("source_pair", "candidate_rows")) == plain(unique.groupBy("source_pair").count())
    plan = plans.QUERIES["candidates_dedup"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"Exchange hashpartitioning\([^)]*key", plan) and plan.count("FileScan") == 2


def test_lengths_are_not_broadcast(spark):
    """Weights come from one pass over an entity's n-grams; no table as long as the corpus goes through the driver."""
    _, others = plans.sides(spark, SF)
    counts = tfidf.term_counts(others["s1_s2"], Config())
    plan = tfidf.weights(counts, counts.groupBy(*tfidf.BUCKET, "gram").agg(F.lit(1.0).alias("idf")), Config())._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 1 and "Window" in plan


def _made_by_joins(df):
    """The most rows that a join of the plan, which has run, made."""

    def walk(node):
        name = node.getClass().getSimpleName()
        if "AdaptiveSparkPlan" in name:
            return walk(node.executedPlan())
        if "QueryStage" in name:
            return walk(node.plan())
        own = node.metrics().apply("numOutputRows").value() if "Join" in name else 0
        children = node.children()
        return max([own, *[walk(children.apply(k)) for k in range(children.size())]])

    return walk(df._jdf.queryExecution().executedPlan())


@pytest.mark.parametrize("few", [0, 100_000])
def test_counts_make_no_pairs(spark, monkeypatch, few):
    """Blocks of n rows on either side have n * n pairs, which overlap; they are counted by rows that grow with n."""
    monkeypatch.setattr(blocking, "FEW_KEYS", few)
    names = list(STRATEGIES.values())
    side = lambda s, n: spark.range(n).select(F.concat(F.lit(s), "id").alias("entity_id"), *[F.when(F.lit(j < 4), F.concat(F.lit(f"k{j}-"), F.col("id") % (1 + j))).otherwise("").alias(c) for j, c in enumerate(names)])
    s1, others = side("a", 300), {"s1_s2": side("b", 250), "s1_s3": side("c", 200)}
    counts = blocking.exact_counts(s1, others)
    assert {r[1] for r in counts.collect()} == {450} and _made_by_joins(counts) <= 16 * 750
    sizes = blocking.Coded(s1, others).unique_sizes()
    assert {(r["source_pair"], r["candidate_rows"]) for r in sizes.collect()} == {("s1_s2", 300 * 250), ("s1_s3", 300 * 200)} and _made_by_joins(sizes) <= 16 * 750


@pytest.mark.parametrize("pairs", [5, 1_000_000])
def test_lists_are_made_in_order_where_they_end_up(spark, made, monkeypatch, pairs):
    """Ids are dealt in ranges and blocks sent to them; no list is shuffled after it is made, and none is sorted."""
    monkeypatch.setattr(blocking, "RANGE_PAIRS", pairs)
    lists = blocking.exact_lists(*made)
    want = evaluate.candidate_lists(made[0], blocking.distinct_candidates(blocking.all_exact_blocks(*made))).collect()
    assert [tuple(r) for r in lists.collect()] == sorted(map(tuple, want))
    plan = lists._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"Exchange|Sort", plan[: plan.index("_of_range")])


def test_lists_from_blocks(monkeypatch):
    """Batches end where they are long enough; ids of several blocks stand once, and go by their bytes with those of other rows."""
    import pyarrow as pa

    monkeypatch.setattr(blocking, "BATCH_IDS", 3)
    known = blocking._Known([7, 9], ["10\0009\000é", "10\000z"])
    rows = [("a", [7, 9], None), ("b", [], None), ("c", [9], "zz\00010\000b"), ("d", [8], "y")]
    asked = pa.RecordBatch.from_arrays([pa.nulls(4), pa.nulls(4), pa.nulls(4), *[pa.array(c) for c in zip(*rows)]], names=list("abcdef"))
    batches = [b.to_pylist() for b in known.lists(asked)]
    assert [len(b) for b in batches] == [1, 3]
    assert [tuple(r.values()) for b in batches for r in b] == [("a", "10,9,z,é"), ("b", ""), ("c", "10,b,z,zz"), ("d", "y")]
