import hashlib
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from matchloom.llm import conversations, language, whitening
from matchloom.llm.common import Scratch

ROLES = ["system", "user", "assistant", "tool", " ", ""]
TEXTS = ["Yes.", "No?", "cut off", "and more", "", " \t", "Yes.", "Sure! ", "x"]


def brute_repair(rows):
    """All scripts of edits, cheapest and least first, by plain dynamic programming over every node."""
    seen, faults = set(), []
    for _, role, text in rows:
        if not text.strip(conversations.SPACES):
            faults.append("b")
        elif (role, text) in seen:
            faults.append("d")
        else:
            faults.append("" if text.rstrip(conversations.SPACES)[-1] in ".!?" else "t")
        seen.add((role, text))
    step = {".": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}

    def inserted(best):
        for _ in range(4):
            for st, (c, a, made) in list(best.items()):
                for x in "ua":
                    if x in step[st]:
                        t = step[st][x]
                        best[t] = min(best.get(t, (9e9, "", [])), (c + 3, a + "I", made + [{"u": "user:", "a": "assistant:"}[x]]))
        return best

    best = inserted({".": (0, "", [])})
    for (_, role, text), f in zip(rows, faults):
        new = {}

        def put(st, c, a, made):
            new[st] = min(new.get(st, (9e9, "", [])), (c, a, made))

        for st, (c, a, made) in best.items():
            put(st, c + 4, a + "D", made)
            if f in ("b", "d"):
                continue
            more = 3 if f == "t" else 0
            if role[:1] in step[st]:
                put(step[st][role[:1]], c + more, a + "K", made + [f"{role}:{text}"])
            for x, full in (("u", "user"), ("a", "assistant")):
                if x in step[st]:
                    put(step[st][x], c + more + 3, a + "R", made + [f"{full}:{text}"])
        best = inserted(new)
    c, a, made = min(v for k, v in best.items() if k in ".a")
    turns = [t for t, _, _ in rows if t is not None]
    pairs = [x[1][:1] + y[1][:1] for x, y in zip(rows, rows[1:])]
    return {
        "gaps": max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, "blank": faults.count("b"), "duplicate": faults.count("d"), "truncated": faults.count("t"),
        "illegal": sum(p not in ("su", "ua", "au") for p in pairs), "cost": c, "audit": a, "repaired_sha256": hashlib.sha256("\n".join(made).encode()).hexdigest(),
    }


@pytest.mark.parametrize("block", [1, 2, 3, 256])
def test_repair_equals_brute_force(monkeypatch, block):
    monkeypatch.setattr(conversations, "BLOCK", block)
    rng = random.Random(block)
    for k in range(400):
        rows = [(rng.choice([None, 0, 1, 2, 3, 5, 9]), rng.choice(ROLES), rng.choice(TEXTS) + (str(i) if rng.random() < 0.3 else "")) for i in range(rng.randrange(1, 14))]
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        held = conversations.Repair()
        for r in rows:
            held.add(*r)
        assert held.result() == brute_repair(rows), rows


def test_repair_of_very_long_conversation():
    held, n = conversations.Repair(), 20_000
    for k in range(n):
        held.add(k, "user" if k % 2 == 0 else "assistant", f"turn {k}.")
        if k % 1000 == 7:
            held.add(k, "user", "")
    got = held.result()
    assert got["cost"] == 4 * 20 and got["audit"].count("K") == n and got["audit"].count("D") == 20


def brute_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        told = [" " if v is None else str(v) for v in (conv, turn)]
        draw = zlib.crc32(":".join(told).encode()) % 20
        role, text = (" " if v is None else v for v in (role, text))
        if draw:
            text = {1: "", 2: text.translate({ord(c): None for c in ".!?"})}.get(draw, text)
            out += [(conv, turn, "user" if draw == 4 else role, text)] * (2 if draw == 3 else 1)
    return out


def test_repair_of_damaged_conversations(spark):
    rng = random.Random(3)
    rows = [(c, t, rng.choice(["user", "assistant", "system", None]), rng.choice([*TEXTS, None, "long " * 20_000])) for c in [None, *range(40)] for t in [None, *range(rng.randrange(6))]]
    rows += rng.sample(rows, 30)  # repeated rows
    rows += [(c, 0, "user", "Hi.") for c in range(100, 200)]  # some of which lose their only row
    df = spark.createDataFrame([(*r, "extra", 1) for r in rows], "conv_id long, turn long, role string, text string, draw string, key int")
    got = {r.conv_id: r.asDict() for r in conversations.repair_damaged(df).collect()}
    want = {}
    for conv, turn, role, text in brute_damage(rows):
        want.setdefault(conv, []).append((turn, role, text))
    empty = {"gaps": 0, "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0, "cost": 0, "audit": "", "repaired_sha256": hashlib.sha256(b"").hexdigest()}
    assert set(got) == {r[0] for r in rows} and any(c not in want for c in got)
    for c, r in got.items():
        mine = sorted(want.get(c, []), key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        assert r == {"conv_id": c} | (brute_repair(mine) if mine else empty)
    assert conversations.repair_damaged(df.limit(0)).collect() == []


SOUNDS = {"aa": "tion ent ing the and or".split(), "bb": "schen ung der die heit und".split(), "cc": "çao ñez los que ío una".split()}


def say(rng, lang, n):
    return " ".join("".join(rng.choice(SOUNDS[lang]) for _ in range(rng.randrange(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def spoken(spark):
    rng = random.Random(5)
    rows = [(k, say(rng, lang, rng.randrange(3, 60)), lang) for k in range(400) for lang in [rng.choice(sorted(SOUNDS))]]
    rows += [(None, say(rng, "aa", 9), "bb"), (1001, None, "aa"), (1002, "", "bb"), (1003, "12 34 .. !!", "cc"), (1004, say(rng, "aa", 20), None), (1005, "ЖЖЖ ЩЩ", "aa"), (1006, "x" * 300_000, "bb")]
    rows += [(1007, say(rng, "aa", 60) + " " + say(rng, "cc", 40), "aa"), (5, rows[5][1], rows[5][2])]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_language_of_held_out_texts(spark, spoken):
    model = language.learn(spoken, Scratch(spark, "t"))
    assert model.names == ("aa", "bb", "cc")
    out = language.predict(spoken.withColumn("score", F.lit("clash")), model).withColumn("out", language.is_held_out(F.col("doc_id"))).collect()
    assert len(out) == spoken.count()
    assert all(r.out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in out if r.doc_id is not None)
    fair = [r for r in out if r.out and r.doc_id < 400]
    assert len(fair) > 80 and sum(r.lang_pred == r.lang for r in fair) >= 0.98 * len(fair)
    by_id = {r.doc_id: r for r in out}
    assert all(by_id[k].lang_pred == "und" and by_id[k].score == 0 and by_id[k].languages == [] for k in (1001, 1002, 1003))
    assert by_id[1005].lang_pred in model.names and by_id[1006].lang_pred in model.names and by_id[1004].lang_pred == "aa"
    mixed = by_id[1007]
    assert [m.lang for m in mixed.languages] == ["aa", "cc"] and mixed.lang_pred == "aa" and abs(mixed.languages[0].share - 0.6) < 0.05
    assert all(0 <= r.score <= 1 for r in out)
    none = language.predict(spoken, language.learn(spoken.limit(0), Scratch(spark, "t"))).collect()
    assert {r.lang_pred for r in none} == {"und"}
    assert language.predict(spoken.limit(0), model).collect() == []


def test_language_sample_is_bounded(spark, spoken):
    few = language.learn(spoken, Scratch(spark, "t"), sample=3, features=50)
    assert len(few.index) == 50 and few.logs.shape == (50, 3)


def test_language_set_is_that_of_greatest_penalised_likelihood():
    rng = np.random.default_rng(2)
    docs, many, rows, counts, doc = 60, 3, [], [], []
    for d in range(docs):
        of = rng.choice(many, size=rng.integers(1, 3), replace=False)
        for _ in range(rng.integers(4, 60)):
            r = rng.normal(-8, 1.5, many)
            r[rng.choice(of)] += 5
            rows.append(r)
            counts.append(rng.integers(1, 4))
            doc.append(d)
    rows, counts, doc = np.array(rows), np.array(counts, float), np.array(doc)
    share, score = language.infer(rows, counts, doc, docs)
    for d in range(docs):
        mine, n = rows[doc == d], counts[doc == d]
        best = (-math.inf, None)
        for bits in range(1, 1 << many):
            allowed = np.array([[bool(bits >> k & 1) for k in range(many)]])
            p, c = np.exp(mine) * allowed, np.full(many, 1 / allowed.sum()) * allowed[0]
            for _ in range(400):
                joint = p * c
                c = (joint / joint.sum(axis=1, keepdims=True) * n[:, None]).sum(axis=0) / n.sum()
            value = (n * np.log((p * c).sum(axis=1))).sum() - language.PENALTY * math.log(n.sum() + 1) * (allowed.sum() - 1)
            best = max(best, (value, bits))
        assert sum(1 << k for k in range(many) if share[d, k] > 0) == best[1]
        assert abs(share[d].sum() - 1) < 1e-6 and 0 < score[d] <= 1
    # a document counts the same alone as among others
    alone, _ = language.infer(rows[doc == 7], counts[doc == 7], np.zeros((doc == 7).sum(), int), 1)
    assert np.allclose(alone[0], share[7], atol=1e-2)


def test_whitening(spark):
    rng = np.random.default_rng(1)
    base = rng.normal(0, 1, (300, 6)) @ rng.normal(0, 1, (6, 20)) + rng.normal(0, 0.3, (300, 20))
    vectors = [v.tolist() for v in base] + [base[0].tolist()] * 40
    rows = [(k, v) for k, v in enumerate(vectors)] + [(None, vectors[3]), (7, vectors[7])]
    odd = [(900, None), (901, [None] * 20), (902, [float("nan")] * 20), (903, [float("inf")] * 20), (904, [1.0] * 5), (905, [])]
    df = spark.createDataFrame([(*r, "mine", 5) for r in rows + odd], "vec_id long, embedding array<double>, x string, key int")
    got = whitening.whitened_components(df, Scratch(spark, "t")).toPandas()
    x = np.floor(64 * np.array([v for _, v in rows])).astype(np.int64) + 1_000_000
    u = np.unique(x, axis=0)
    n, s = len(u), u.sum(axis=0)
    values, vectors_ = np.linalg.eigh((u - s / n).T @ (u - s / n) / n)
    values, vectors_ = values[::-1][:16], vectors_[:, ::-1][:, :16]
    assert len(got) == 16 * len(rows) and set(got["n"]) == {n} and sorted(set(got["component"])) == list(range(1, 17))
    assert got["identity_error"].max() < 1e-9 and got["identity_error"].nunique() == 1
    total = np.square(u - s / n).sum() / n
    white = (x - s / n) @ vectors_ / np.sqrt(values)
    for k in range(16):
        part = got[got["component"] == k + 1]
        assert np.allclose(part["explained"], values[k] / total, rtol=1e-9)
        by_id = dict(zip(part["vec_id"].fillna(-1), part["whitened"]))
        sign = np.sign(by_id[0] * white[0, k])
        assert all(abs(sign * by_id[-1 if i is None else i] - white[j, k]) < 1e-6 for j, (i, _) in enumerate(rows))
    deviation = {-1 if i is None else i: sum((n * int(c) - int(t)) ** 2 for c, t in zip(x[j], s)) for j, (i, _) in enumerate(rows)}
    assert dict(zip(got["vec_id"].fillna(-1), got["deviation"])) == deviation


def test_whitening_at_its_edges(spark):
    run = lambda rows: whitening.whitened_components(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), Scratch(spark, "t")).collect()
    assert run([(1, None), (2, [])]) == []
    assert run([(1, [0.5, 0.5]), (2, [0.5, 0.5])]) == []  # no direction has variance
    flat = run([(k, [float(k), 2.0 * k, 3.0]) for k in range(10)])
    assert {r.component for r in flat} == {1} and abs(flat[0].explained - 1) < 1e-9
    huge = run([(1, [1e300, 0.0]), (2, [-1e300, 1.0]), (3, [0.0, 2.0])])
    assert {r.vec_id for r in huge} == {1, 2, 3} and all(r.deviation is None for r in huge if r.vec_id < 3)
    model = whitening.Whitening(3, np.array([0]), np.array([1]), np.ones((1, 1)), np.ones(1), np.ones(1))
    far = whitening.whiten(spark.createDataFrame([(1, [2.0**46])], "vec_id long, embedding array<double>"), model).collect()[0]
    assert far.deviation is None and int(far.deviation_digits) == (3 * (64 * 2**46 + 1_000_000) - 1) ** 2
