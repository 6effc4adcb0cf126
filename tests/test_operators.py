import io
import math
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from matchloom.config import Config
from matchloom.operators import blocking, evaluate, features, tfidf
from matchloom.plans import queries as plans
from matchloom.plans import stages
from matchloom.sources import tables
from matchloom.streaming.batches import batches, stream_tsv

SF = "/root/testdata/sf0.001"


def test_composite_keys(spark):
    row = spark.createDataFrame([("12", "")], "house string, place string")
    assert row.select(features.composite_key(F.col("house"), F.col("place"))).first()[0] == ""
    assert row.select(features.composite_key(F.col("house"), F.col("place"), True)).first()[0] == "12"
    prefixes = spark.createDataFrame([("x acme",), ("a b",)], "n string").select(features.prefix_bucket(F.col("n"))).collect()
    assert [r[0] for r in prefixes] == ["ac", ""]


def test_block_cap_and_empty_keys(spark):
    rows = lambda *keys: spark.createDataFrame([(str(i), k) for i, k in enumerate(keys)], "entity_id string, k string")
    a, b = rows("x", "x", "y", ""), rows("x", "y", "y", "y", "")
    for block in (blocking.exact_block, blocking.exact_block_semi):
        found = block(a, b, "s1_s2", "k", "s", 2).select("source1_entity_id", "candidate_entity_id").collect()
        assert sorted(map(tuple, found)) == [("0", "0"), ("1", "0")]


def keyed(spark, rows):
    return spark.createDataFrame(rows, "entity_id string, country_key string, tfidf_prefix2 string, roman_name_key_base string")


def test_tfidf_modes(spark):
    q = keyed(spark, [("q", "us", "ac", "acme corp")])
    c = keyed(spark, [("1", "us", "ac", "acme corp"), ("2", "us", "ac", "zzzz"), ("3", "us", "zz", "acme corp"), ("4", "us", "ac", "")])
    new = tfidf.top_k(q, c, "s1_s2", Config()).orderBy("rank").collect()
    assert [(r.candidate_entity_id, round(r.similarity, 6)) for r in new] == [("1", 1.0), ("2", 0.0)]
    old = tfidf.top_k(q, c, "s1_s2", Config(mode="v1")).collect()
    assert [r.candidate_entity_id for r in old] == ["1"]
    assert tfidf.top_k(q, c, "s1_s2", Config(tfidf_bucket_cap=1)).isEmpty()
    assert tfidf.top_k(q, keyed(spark, [("1", "us", "ac", "ab")]), "s1_s2").isEmpty()  # no n-gram at all


def test_tfidf_keeps_most_frequent_ngrams(spark):
    c = keyed(spark, [("1", "us", "ab", "abc"), ("2", "us", "ab", "abc"), ("3", "us", "ab", "xyz")])
    counts = tfidf.term_counts(c, Config())
    kept = tfidf.inverse_frequencies(c, counts, Config(tfidf_features=1)).collect()
    assert [r.gram for r in kept] == ["abc"]


def test_recall_bounds(spark):
    found, truth = plans.exact(spark, SF), plans.typed(spark, SF)
    each, union = evaluate.recall_by_strategy(truth, found).collect(), evaluate.recall_union(truth, found).collect()
    best = {r.source_pair: r.recall for r in union}
    assert each and all(0 <= r.recall <= best[r.source_pair] <= 1 for r in each)


def test_gating_in_turn(spark):
    s1, others = plans.sides(spark, SF)
    config = Config(tfidf_top_k=3, tfidf_gate=2)
    found = stages.block_features(s1, others, config).found
    per = found.where("strategy = 'tfidf_char_topk'").groupBy("source1_entity_id", "source_pair").count().collect()
    assert per and max(r["count"] for r in per) <= 3
    # who got enough from the first pair isn't searched in the second
    filled = {r.source1_entity_id for r in per if r.source_pair == "s1_s2" and r["count"] >= 2}
    assert not filled & {r.source1_entity_id for r in per if r.source_pair == "s1_s3"}


def test_truth(spark):
    t = spark.createDataFrame([("a", " x, y ,,z"), ("b", None)], "source1_entity_id string, matched_entity_ids string")
    ids = lambda *v: spark.createDataFrame([(x,) for x in v], "entity_id string")
    pairs = evaluate.typed_truth(evaluate.expand_truth(t), ids("x"), ids("x", "y")).collect()
    assert sorted((r.candidate_entity_id, r.source_pair) for r in pairs) == [("x", "s1_s2"), ("y", "s1_s3"), ("z", "unknown")]
    with pytest.raises(ValueError):
        evaluate.require_truth(evaluate.expand_truth(t.where("source1_entity_id = 'b'")))


def test_candidate_file(spark, tmp_path):
    s1, others = plans.sides(spark, SF)
    unique = blocking.distinct_candidates(plans.exact(spark, SF))
    path = str(tmp_path / "pairs")
    told = evaluate.write_candidate_pairs(s1, unique, path)
    assert told["rows"] == s1.count() and 0 < told["rows_with_candidates"] < told["rows"]
    evaluate.verify_candidate_file(spark, path, told["rows"])
    evaluate.validate_candidate_ids(spark, path, *others.values())
    with pytest.raises(ValueError):
        evaluate.verify_candidate_file(spark, path, told["rows"] + 1)
    with pytest.raises(ValueError):
        evaluate.validate_candidate_ids(spark, path, others["s1_s2"], others["s1_s2"])


def test_tsv(spark, tmp_path):
    p = tmp_path / "x.tsv"
    p.write_bytes('﻿a\tb\tc\n1\t"two\nlines ""q"""\tNA\nshort\n'.encode())
    df = tables.read_tsv(spark, str(p))
    assert tables.read_header(spark, str(p)) == ["a", "b", "c"]
    assert [tuple(r) for r in df.collect()] == [("1", 'two\nlines "q"', "NA"), ("short", None, None)]
    assert tables.read_tsv(spark, str(p), na_literals=True).first().c is None
    p.write_text("a\tb\n1\t2\t3\n")
    with pytest.raises(Exception, match="too many fields"):
        tables.read_tsv(spark, str(p)).collect()
    assert [tuple(r) for r in tables.read_tsv(spark, str(p), strict=False).collect()] == [("1", "2")]
    p.write_text("")
    with pytest.raises(ValueError):
        tables.read_header(spark, str(p))
    out = str(tmp_path / "out")
    tables.write_tsv(df, out, single=True)
    assert sorted(map(str, tables.read_tsv(spark, out).select("a", "b").collect())) == sorted(map(str, df.select("a", F.coalesce("b", F.lit("")).alias("b")).collect()))


def test_files_and_registry(spark, tmp_path):
    a = tmp_path / "a.txt"
    a.write_text("12345")
    assert tables.copy_first(spark, [str(tmp_path / "no"), str(a)], str(tmp_path / "b.txt")) == str(a)
    assert tables.total_size(spark, str(tmp_path)) == 10
    tables.write_json(spark, {"é": [1]}, str(tmp_path / "s.json"))
    assert '"é"' in (tmp_path / "s.json").read_text()
    assert tables.delete(spark, str(tmp_path / "b.txt")) and not tables.exists(spark, str(tmp_path / "b.txt"))
    r = tables.Registry(train={"one": str(a)}, test={"two": str(tmp_path / "no")})
    assert r.found(spark) == {"one": str(a)}
    with pytest.raises(FileNotFoundError):
        r.found(spark, strict=True)
    with pytest.raises(FileNotFoundError):
        tables.Registry(train={"one": str(a)}, test={"two": "/no"}, process_train=False).found(spark)
    assert tables.parse_s3_uri("s3://b/c/d") == ("b", "c/d")
    with pytest.raises(ValueError):
        tables.parse_s3_uri("/b/c")


def test_columns(spark):
    df = spark.range(1).toDF(" Entity_ID ")
    assert tables.find_column(df.columns, ["id", "entity_id"], "id") == " Entity_ID "
    assert tables.find_optional_column(df.columns, ["x"]) is None
    with pytest.raises(KeyError):
        tables.find_column(df.columns, ["x"], "x")
    with pytest.raises(ValueError):
        tables.require_columns(df, ["y"])


def test_batches(spark):
    df = spark.range(25).select(F.col("id"), F.when(F.col("id") > 4, "x").alias("c")).orderBy("id")
    assert [len(b) for b in batches(df, 10)] == [10, 10, 5]
    out = io.StringIO()
    assert stream_tsv(df, out, 10) == {"rows": 25, "rows_with_candidates": 20}
    assert out.getvalue().startswith("id\tc\n0\t\n")


def records(spark, prefix, rows):
    made = [(f"{prefix}{i}", n, a, "India", n, n, a, a) for i, (n, a) in enumerate(rows)]
    return spark.createDataFrame(made, ", ".join(f"{c} string" for c in stages.RAW))


def test_whole_pipeline(spark):
    s1 = records(spark, "a", [("राम मार्केटिंग Pvt/Ltd", "12 Main Street, Pune, MH 411001"), ("Acme Inc", "1 Hill Road, Pune, India"), (None, None)])
    s2 = records(spark, "b", [("Acme Incorporated", "1 Hill Road, Pune"), ("Other Co", "9 Elm Ave, Delhi")])
    s3 = records(spark, "c", [("rAma mArkeTiMga private limited", "12 Main Street, Pune, MH 411001")])
    made = [stages.normalize(stages.romanize(s)).persist() for s in (s1, s2, s3)]
    assert len(made[0].columns) == 8 + 6 + 27
    one, two, three = (features.feature_table(m).persist() for m in made)
    exact = blocking.all_exact_blocks(one, {"s1_s2": two, "s1_s3": three}).persist()
    result = stages.Blocking(one, exact, blocking.distinct_candidates(exact))
    found = {(r.source1_entity_id, r.candidate_entity_id) for r in result.unique.collect()}
    assert {("a1", "b0"), ("a0", "c0")} <= found and not any(a == "a2" for a, _ in found)
    truth = spark.createDataFrame([("a1", "b0"), ("a0", "c0")], "source1_entity_id string, matched_entity_ids string")
    told = stages.evaluate(result, truth, made[1], made[2])
    assert {r.recall for r in told["recall"].where("strategy = 'ALL_UNION'").collect()} == {1.0}
    assert told["coverage"].first().entities == 3


def test_earlier_rules(spark):
    s1, others = plans.sides(spark, SF, Config(mode="v1"))
    found = blocking.all_exact_blocks(s1, others, Config(mode="v1", block_cap=5))
    assert "strategy" in blocking.distinct_candidates(found, with_strategy=True).columns


def test_knn_meets_every_label(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    vectors = {r.vec_id: [float(x) for x in r.embedding] for r in rows}
    labels = {r.vec_id: r.label for r in rows}
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    norm = {k: dot(v, v) ** 0.5 for k, v in vectors.items()}
    out = {}
    for r in plans.knn_cosine_embeddings(spark, SF).orderBy("source1_entity_id", "rank").collect():
        out.setdefault(r.source1_entity_id, []).append((r.candidate_entity_id, r.similarity))
    assert set(out) == {k for k in vectors if k % 100 == 0}
    for q, near in out.items():
        all_ = {k: dot(vectors[q], v) / (norm[q] * norm[k]) for k, v in vectors.items() if k != q}
        assert len({k for k, _ in near}) == 15 and q not in dict(near)
        assert all(abs(all_[k] - sim) < 2e-6 for k, sim in near)
        assert all(abs(a - b) < 2e-6 for a, b in zip(sorted(all_.values(), reverse=True), [sim for _, sim in near]))
    assert any(labels[k] != labels[q] for q, near in out.items() for k, _ in near)


def brute_tfidf(queries, corpus, sublinear):
    """The weights of the corpus, and similarities by query of all candidates of its bucket."""
    grams = lambda t: Counter(t[i : i + n] for n in (3, 4, 5) for i in range(len(t) - n + 1))
    buckets = defaultdict(list)
    for r in corpus:
        if r.roman_name_key_base:
            buckets[r.country_key, r.tfidf_prefix2].append((r.entity_id, grams(r.roman_name_key_base)))
    weights, sims = {}, {}
    for bucket, rows in buckets.items():
        df = Counter(g for _, counts in rows for g in counts)
        idf = {g: math.log((1 + len(rows)) / (1 + n)) + 1 for g, n in df.items()}

        def vector(counts):
            raw = {g: ((1 + math.log(n)) if sublinear else n) * idf[g] for g, n in counts.items() if g in idf}
            norm = math.sqrt(sum(x * x for x in raw.values()))
            return {g: x / norm for g, x in raw.items()}

        vectors = {k: vector(counts) for k, counts in rows}
        weights |= {(k, g): w for k, v in vectors.items() for g, w in v.items()}
        for r in queries:
            if r.roman_name_key_base and idf and (r.country_key, r.tfidf_prefix2) == bucket:
                q = vector(grams(r.roman_name_key_base))
                sims[r.entity_id] = {k: sum(w * v.get(g, 0) for g, w in q.items()) for k, v in vectors.items()}
    return weights, sims


def test_text_search_of_both_pairs(spark):
    sf = "/root/testdata/sf0.01"
    s1, others = plans.sides(spark, sf)
    s1, others = s1.collect(), {pair: sx.collect() for pair, sx in others.items()}
    for mode in ("v1", "v2"):
        out = defaultdict(list)
        for r in plans.QUERIES[f"tfidf_topk_{mode}"](spark, sf).orderBy("rank").collect():
            out[r.source_pair, r.source1_entity_id].append((r.candidate_entity_id, r.similarity))
        expected = {}
        for pair, sx in others.items():
            for q, sims in brute_tfidf(s1, sx, mode == "v2")[1].items():
                if kept := {k: x for k, x in sims.items() if mode == "v2" or x > 0}:
                    expected[pair, q] = kept
        assert set(out) == set(expected) and max(map(len, out.values())) == 15
        for key, near in out.items():
            best = sorted(expected[key].values(), reverse=True)[:15]
            assert len(near) == len(best) == len(dict(near)) and all(abs(a - b) < 1e-8 for a, (_, b) in zip(best, near))
            assert all(abs(expected[key][k] - x) < 1e-8 for k, x in near)
    weights = {(r.entity_id, r.gram): r.weight for r in plans.tfidf_weights(spark, sf).collect()}
    known = {k: w for sx in others.values() for k, w in brute_tfidf([], sx, True)[0].items()}
    assert set(weights) == set(known) and all(abs(w - known[k]) < 1e-6 for k, w in weights.items())


def test_earlier_rules_resolve_aliases(spark):
    from matchloom.operators import features

    base = {"entity_id": "1", "business_name": "Acme", "business_name_roman": "acme", "business_name_phonetic": "AKM", "country_normalized": "US"}
    for c, others in features.ALIASES.items():
        for alias in others:
            row = {k: v for k, v in base.items() if k == "entity_id" or k not in others} | {alias.upper(): "Seen"}
            out = features.feature_table(spark.createDataFrame([tuple(row.values())], list(row)), Config(mode="v1")).first()
            assert out[next(k for k, v in features.BASE_KEYS.items() if v == c)] == "seen"
    for missing in list(base)[1:]:
        row = {k: v for k, v in base.items() if k != missing}
        with pytest.raises(KeyError):
            features.feature_table(spark.createDataFrame([tuple(row.values())], list(row)), Config(mode="v1"))


def test_scripts_with_and_without_indic_text(spark):
    from matchloom.functions.scripts import detect_script

    cases = {"": "Empty", "Acme": "Latin", "123": "Other", "Привет": "Other", "Acme Привет": "Latin", "राम": "Devanagari", "राम A": "Devanagari", "राम Ltd": "Mixed", "aक": "Latin", " \x1c ": "Empty", "ª": "Other"}
    rows = spark.createDataFrame(list(cases.items()), "text string, script string")
    assert all(r.script == r.got for r in rows.select("script", detect_script(F.col("text")).alias("got")).collect())
