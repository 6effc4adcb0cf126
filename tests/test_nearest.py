import math
import random
from collections import Counter

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from matchloom.config import Config
from matchloom.operators import nearest, tfidf


def keyed(spark, rows):
    return spark.createDataFrame(rows, "entity_id string, country_key string, tfidf_prefix2 string, roman_name_key_base string")


def brute(queries, corpus, config):
    """All pairs of a bucket by hand."""
    grams = lambda t: Counter(t[i : i + n] for n in config.ngrams for i in range(len(t) - n + 1))
    out = []
    for bucket in {q[1:3] for q in queries}:
        c = [(r[0], grams(r[3])) for r in corpus if r[1:3] == bucket and r[3]]
        if not any(g for _, g in c):
            continue
        df = Counter(g for _, x in c for g in x)
        idf = {g: math.log((1 + len(c)) / (1 + n)) + 1 for g, n in df.items()}

        def unit(x):
            w = {g: (1 + math.log(n) if config.sublinear_tf else n) * idf[g] for g, n in x.items() if g in idf}
            norm = math.sqrt(sum(v * v for v in w.values()))
            return {g: v / norm for g, v in w.items()}

        c = [(i, unit(x)) for i, x in c]
        for q in queries:
            if q[1:3] == bucket and q[3]:
                w = unit(grams(q[3]))
                near = sorted((-round(sum(v * x.get(g, 0) for g, v in w.items()), 9), i) for i, x in c)
                near = [(s, i) for s, i in near if config.keep_zero_similarity or s < 0][: config.tfidf_top_k]
                out += [(q[0], i, round(-s, 6), r + 1) for r, (s, i) in enumerate(near)]
    return sorted(out)


@pytest.mark.parametrize("mode", ["v1", "v2"])
def test_blocks_give_what_all_pairs_give(spark, monkeypatch, mode):
    monkeypatch.setattr(tfidf, "GROUP", 40)
    monkeypatch.setattr(tfidf, "BLOCK", 16)
    monkeypatch.setattr(nearest, "ROWS", 7)
    rng = random.Random(1)
    name = lambda: " ".join(rng.choice(["acme", "acorn", "ac", "tools", "tool", "of", "world", "é clair", "zzz"]) for _ in range(rng.randrange(1, 4)))
    rows = lambda side, n: [(f"{side}{k}", rng.choice(["us", "us", "de"]), rng.choice(["ac", "to"]), rng.choice([name(), name(), "ab", ""])) for k in range(n)]
    queries, corpus = rows("q", 250), rows("c", 300) + [(f"n{k}", "fr", "ac", "ab") for k in range(3)]
    queries += [("alone", "it", "xx", "nobody here"), ("nothing", "fr", "ac", "acme")]
    config = Config(mode=mode, tfidf_top_k=5)
    found = tfidf.top_k(keyed(spark, queries), keyed(spark, corpus), "s1_s2", config).collect()
    got = sorted((r.source1_entity_id, r.candidate_entity_id, round(r.similarity, 6), r["rank"]) for r in found)
    assert got == brute(queries, corpus, config)
    assert any(s == 0 for _, _, s, _ in got) == (mode == "v2")
    assert tfidf.top_k(keyed(spark, queries).limit(0), keyed(spark, corpus), "s1_s2", config).collect() == []
    assert tfidf.top_k(keyed(spark, queries), keyed(spark, corpus).limit(0), "s1_s2", config).collect() == []


def test_each_name_is_searched_once(spark, monkeypatch, tmp_path):
    """Copies of names are neither asked for nor sent more than k times, and get what all pairs give."""
    plain = nearest.search

    def counted(q, blocks, k, zeros):
        def told():
            for b in blocks:
                (tmp_path / f"given-{id(b)}-{random.random()}").write_text(str(len(b.ids)))
                yield b

        (tmp_path / f"asked-{random.random()}").write_text(str(len(q.ids)))
        return plain(q, told(), k, zeros)

    monkeypatch.setattr(tfidf, "search", counted)
    names = ["acme tools", "acme tool", "acorn"]
    queries = [(f"q{k}", "us", "ac", names[k % 3]) for k in range(60)]
    corpus = [(f"c{k}", "us", "ac", names[k % 2]) for k in range(90)]
    config = Config(tfidf_top_k=4)
    found = tfidf.top_k(keyed(spark, queries), keyed(spark, corpus), "s1_s2", config).collect()
    assert sorted((r.source1_entity_id, r.candidate_entity_id, round(r.similarity, 6), r["rank"]) for r in found) == brute(queries, corpus, config)
    total = lambda kind: sum(int(f.read_text()) for f in tmp_path.glob(f"{kind}-*"))
    assert total("asked") == 3 and total("given") == 8


def test_blocks_out_of_reach_are_skipped(monkeypatch):
    import numpy as np
    import pyarrow as pa

    met = []
    plain = nearest._products
    monkeypatch.setattr(nearest, "_products", lambda q, mine, *rest: met.append(len(mine)) or plain(q, mine, *rest))
    vectors = lambda ids, grams: nearest.Vectors(ids, np.arange(len(ids)), pa.array(grams), np.ones(len(ids)))
    blocks = [vectors(["a", "b"], ["x", "x"]), vectors(["c", "d"], ["y", "y"]), vectors(["e"], ["x"])]
    out = nearest.search(vectors(["q"], ["x"]), iter(blocks), 2, False).to_pylist()
    assert [r["candidate_entity_id"] for r in out] == ["a", "b"] and met == [1, 1]  # the second block has no n-gram of the query


@pytest.mark.parametrize("limit", [1, 2, 3, 7, 20, 33, 34, 50, 1000])
def test_most_frequent_ngrams_without_ranking_buckets(spark, limit):
    rng = random.Random(limit)
    rows = {(b, "p", "".join(rng.choice("abc") for _ in range(rng.choice([3, 3, 4])))): rng.choice([1, 1, 1, 2, 2, 5]) for b in "xyz" for _ in range(40)}
    found = spark.createDataFrame([(*k, 1, n) for k, n in rows.items()], "country_key string, tfidf_prefix2 string, gram string, df long, all_tf long")
    turn = F.row_number().over(Window.partitionBy(*tfidf.BUCKET).orderBy(F.desc("all_tf"), "gram"))
    want = sorted(map(tuple, found.withColumn("turn", turn).where(F.col("turn") <= limit).drop("turn").collect()))
    assert sorted(map(tuple, tfidf.most_frequent(found, limit).collect())) == want


def test_dense_neighbours_in_blocks(spark):
    """Equal cosines go by id, odd vectors come last and spoil no others, and no row is made for a pair."""
    vectors = [(i, [float(i % 7), 1.0, float(i % 3)]) for i in range(300)] + [(900, [0.0, 0.0, 0.0]), (901, None), (902, [1.0, None, 2.0]), (903, [1.0, 2.0, 3.0, 4.0][:2])]
    corpus = spark.createDataFrame(vectors, "id long, v array<float>").repartition(3)
    found = nearest.dense_top_k(corpus.where("id % 100 = 0"), corpus, 15)
    got = {}
    for r in found.orderBy("source1_entity_id", "rank").collect():
        got.setdefault(r[0], []).append((r[1], r[2]))
    norm = lambda v: sum(x * x for x in v) ** 0.5
    for q in (0, 100, 200):
        cosine = [(i, round(sum(x * y for x, y in zip(vectors[q][1], v)) / (norm(vectors[q][1]) * norm(v)), 6)) for i, v in vectors[:300] if i != q]
        assert got[q] == sorted(cosine, key=lambda x: (-x[1], x[0]))[:15]
    assert got[900] == [(i, None) for i in range(15)]
    assert "Join" not in found._jdf.queryExecution().optimizedPlan().toString()


def test_no_bucket_is_too_large(spark):
    """A bucket of more rows than the earlier scripts search; the names are few, so it is soon done."""
    names = F.element_at(F.lit(["acme tools", "acme tool"]), (F.col("id") % 2 + 1).cast("int"))
    corpus = spark.range(120_002).select(F.format_string("c%06d", "id").alias("entity_id"), F.lit("us").alias("country_key"), F.lit("ac").alias("tfidf_prefix2"), names.alias("roman_name_key_base"))
    found = tfidf.top_k(keyed(spark, [("q", "us", "ac", "acme tools")]), corpus, "s1_s2", Config(tfidf_top_k=3)).orderBy("rank").collect()
    assert [(r.candidate_entity_id, round(r.similarity, 6)) for r in found] == [("c000000", 1.0), ("c000002", 1.0), ("c000004", 1.0)]


def test_weights_are_made_once_for_a_name(spark):
    """Entities with one name, several rows or none of it get what each gets alone; rows as many as n-grams are sent to no driver."""
    rows = [(f"{k}", "us", "ac", ["acme tools", "acme tool", "acorn", "ab", "aaaaaa"][k % 5]) for k in range(60)]
    rows += [("0", "us", "ac", "acorn"), ("1", "us", "ac", "acme tool"), ("0", "de", "ac", "acme"), ("x", "us", "ac", ""), ("y", None, "ac", "acme")]
    corpus, config = keyed(spark, rows), Config()
    counts = tfidf.term_counts(corpus, config)
    plain = lambda df: sorted((r.country_key, r.entity_id, r.gram, round(r.weight, 9)) for r in df.collect())
    found = plain(tfidf.entity_weights(corpus, config))
    assert found and found == plain(tfidf.weights(counts, tfidf.inverse_frequencies(corpus, counts, config), config))


def test_weights_go_to_no_driver(spark):
    from matchloom.plans import queries as plans

    plan = plans.tfidf_weights(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    sent = [line for line in plan.splitlines() if "BroadcastHashJoin" in line]
    assert not any("gram#" in line or "names#" in line or "entity_id#" in line for line in sent)
