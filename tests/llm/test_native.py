import hashlib
import random
import time

import pytest
from pyspark.sql import functions as F

from matchloom.llm import fingerprints, licenses, line_dedup, mixing
from matchloom.llm.common import Scratch

TEXTS = [
    (1, "The cat sat on the mat and the dog lay by the door of the house", "a"),
    (2, "", "b"),
    (3, None, None),
    (4, "one two", "a"),
    (4, "one two", "a"),
    (None, "Ünï cödé words in this text are not many at all", "b"),
    (7, "All Rights Reserved. Licensed under CC-BY, the GNU General Public License", "c"),
    (8, " ".join(f"word{i}" for i in range(30_000)), "c"),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(*r, "extra") for r in TEXTS], "doc_id long, text string, source string, size string")


def sets(text):
    w = (text or "").lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def test_fingerprints_against_exact_likeness(spark, docs):
    rows = fingerprints.edited_pairs(docs).collect()
    assert len(rows) == len(TEXTS)
    ordered = sorted(TEXTS, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    by_sha = {}
    r_text = lambda r: next(t or "" for i, t, _ in TEXTS if i == r.doc_id)
    for k, (doc_id, text, _) in enumerate(ordered):
        text, after = text or "", ordered[(k + 1) % len(ordered)][1] or ""
        part = len(text) // 4
        edited = text[: len(text) - part] + after[:part]
        a, b, c = sets(text), sets(edited), sets(after)
        near = lambda x, y: len(x & y) / len(x | y) if x | y else 1.0
        by_sha[doc_id, hashlib.sha256(edited.encode()).hexdigest()] = (len(text), near(a, b), near(a, c))
    for r in rows:
        n, edited, after = by_sha[r.doc_id, r.edited_sha256]
        # a few shingles fill all bins, so the spread is that of as many draws as there are shingles
        few = 4 * (0.25 / min(fingerprints.BINS, max(1, len(sets(r_text(r)))))) ** 0.5
        assert r.n_chars == n and abs(r.near_edited - edited) < few and abs(r.near_next - after) < few
    assert fingerprints.edited_pairs(docs.limit(0)).collect() == []
    alone = fingerprints.edited_pairs(docs.where("doc_id = 1")).first()
    assert alone.near_next == 1.0
    same = {r.fingerprint for r in rows if r.doc_id == 4}
    assert len(same) == 1 and len(same.pop()) == 2 * fingerprints.BINS


def test_likeness_is_unbiased(spark):
    words = [f"w{i}" for i in range(400)]
    rows = [(i, " ".join(words), " ".join(words[: 4 * i] + [f"x{i}_{k}" for k in range(400 - 4 * i)])) for i in range(0, 100, 4)]
    df = spark.createDataFrame(rows, "i int, a string, b string")
    df = fingerprints.with_signature(fingerprints.with_signature(df, "a", "sa"), "b", "sb")
    got = df.select("a", "b", fingerprints.likeness(F.col("sa"), F.col("sb")).alias("j")).collect()
    off = [r.j - len(sets(r.a) & sets(r.b)) / len(sets(r.a) | sets(r.b)) for r in got]
    assert abs(sum(off) / len(off)) < 0.02 and max(map(abs, off)) < 0.12


def test_line_dedup(spark):
    passage = "\n".join(f"a repeated line number {k} of the passage" for k in range(40))
    own = lambda k: "\n".join(f"line {i} of {k} alone" for i in range(10))
    rows = [(1, own(1) + "\n" + passage + "\n" + own(11), 0), (2, own(2) + "\n" + passage, 0), (3, own(3), 0), (4, None, 0), (5, "", 0), (6, passage + "\n" + passage, 0), (7, "\n\n\n\n\n\n", 0), (8, "\n\n\n\n\n\n", 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_removed int")
    out = {r.doc_id: r for r in line_dedup.dedup_lines(df, Scratch(spark, "t")).collect()}
    given = {r[0]: r[1] for r in rows}
    assert all(out[k].text == given[k] and out[k].n_removed == 0 for k in (1, 3, 4, 5, 7, 8))
    assert own(2) in out[2].text or out[2].text.startswith("line 0 of 2")
    assert 20 <= out[2].n_removed <= 40 and len(out[2].text.split("\n")) == 50 - out[2].n_removed
    assert out[6].n_removed >= 50
    assert line_dedup.dedup_lines(df.limit(0), Scratch(spark, "t")).collect() == []


def brute_lines(texts):
    """Texts by id without the lines of runs of two or more, or of over 50 words, that came before."""
    seen, out = {}, {}
    for k in sorted(texts):
        lines = texts[k].split("\n")
        full = [i for i, line in enumerate(lines) if line.strip(" \t\r\n")]
        spans = list(zip(full, full[1:])) + [(i, i) for i in full if len(lines[i].split()) > 50]
        gone = set()
        for a, b in spans:
            first = seen.setdefault(tuple(lines[a : b + 1]), (k, b))
            if first[0] < k or first[1] < a:
                gone |= set(range(a, b + 1))
        out[k] = ("\n".join(line for i, line in enumerate(lines) if i not in gone), len(gone))
    return out


def test_line_dedup_to_the_edges(spark):
    own = lambda k: "\n".join(f"line {i} of {k} alone" for i in range(3))
    texts, whole = {}, {}
    for k in range(60):
        n = 2 + k % 5
        passage = "\n".join(f"passage {k} has line {i}" for i in range(n)) if k % 6 else f"passage {k} " + " ".join(f"word{i}" for i in range(50))
        texts[2 * k], texts[2 * k + 1] = f"{own(2 * k)}\n{passage}\n{own(2000 + k)}", f"{own(2 * k + 1)}\n{passage}\n{own(1000 + k)}"
        whole[2 * k + 1] = f"{own(2 * k + 1)}\n{own(1000 + k)}"
    texts |= {500: "one\nwith a neighbour\n\nand another", 501: "one\nelse\n\nwith a neighbour\n\nand another\n\nend", 502: "again\nagain\nagain\nagain\nagain", 503: "one"}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    out = {r.doc_id: (r.text, r.n_removed) for r in line_dedup.dedup_lines(df, Scratch(spark, "t")).collect()}
    assert all(out[k][0] == text for k, text in whole.items()) and all(out[k][0] == texts[k] for k in range(0, 120, 2))
    assert out[501] == ("one\nelse\n\n\nend", 3) and out[502][0] == "again\nagain" and out[503][0] == "one"
    assert out == brute_lines(texts)


def brute_mix(docs, weights=(5, 2, 1)):
    sizes = {}
    for _, text, source in docs:
        sizes[source] = sizes.get(source, 0) + len((text or "").split())
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[k % 3] for k, s in enumerate(names)}
    total, capped = sum(sizes.values()), set()
    while True:
        free = [s for s in names if s not in capped]
        rest = total - sum(3 * sizes[s] for s in capped)
        share = {s: rest * w[s] / sum(w[f] for f in free) for s in free}
        above = {s for s in free if share[s] > 3 * sizes[s]}
        if not above:
            return sizes, share | {s: 3.0 * sizes[s] for s in capped}
        capped |= above


def test_mixing(spark, docs):
    more = TEXTS + [(100 + k, "some words here " * (k % 7), "abcd"[k % 4] if k % 9 else None) for k in range(300)]
    df = spark.createDataFrame(more, "doc_id long, text string, source string")
    out = mixing.mix(df, mixing.word_count(F.col("text")), Scratch(spark, "t")).collect()
    sizes, goal = brute_mix(more)
    assert len(out) == len(more)
    for r in out:
        assert r.size == len((r.text or "").split()) and r.source_size == sizes[r.source] and 0 <= r.rounds <= 3
        assert r.target == pytest.approx(goal[r.source])
    taken = sum(r.size * r.rounds for r in out)
    assert taken <= sum(sizes.values())
    again = mixing.mix(df.orderBy(F.desc("doc_id")), mixing.word_count(F.col("text")), Scratch(spark, "t")).collect()
    key = lambda rows: sorted((r.doc_id or 0, r.size, r.rounds) for r in rows)
    assert key(out) == key(again)
    assert mixing.mix(df.limit(0), F.lit(1), Scratch(spark, "t")).collect() == []
    blank = mixing.mix(df.where("doc_id = 2"), mixing.word_count(F.col("text")), Scratch(spark, "t")).collect()
    assert [(r.size, r.rounds, r.target) for r in blank] == [(0, 0, 0.0)]
    assert mixing.repeated(mixing.mix(df, mixing.word_count(F.col("text")), Scratch(spark, "t"))).count() == sum(r.rounds for r in out)


def test_taken_words_come_near_their_target(spark):
    rng = random.Random(5)
    rows = [(k, "w " * rng.randrange(1, 60), rng.choice("aaaabcd") if k % 11 else None) for k in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = mixing.mix(df, mixing.word_count(F.col("text")), Scratch(spark, "t")).collect()
    taken = {}
    for r in out:
        taken[r.source, r.target] = taken.get((r.source, r.target), 0) + r.size * r.rounds
    assert len(taken) == 5
    for (_, target), words in taken.items():
        assert abs(words - target) <= 0.01 * target + 120
    assert all(r.rounds <= 3 for r in out)


def test_lines_of_one_id_with_two_texts(spark):
    rows = [(1, "a b c\nd e f\ng"), (2, "x\ny\nz"), (2, "q\na b c\nd e f\nr"), (2, "u v\nw w\nmid\nu v\nw w"), (2, "q\na b c\nd e f\nr")]
    got = sorted((r.doc_id, r.text, r.n_removed) for r in line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"), Scratch(spark, "t")).collect())
    assert got == [(1, "a b c\nd e f\ng", 0), (2, "q\nr", 2), (2, "q\nr", 2), (2, "u v\nw w\nmid", 2), (2, "x\ny\nz", 0)]


def test_texts_of_very_many_lines(spark):
    n = 160_000
    text = "\n".join(f"line {k}" for k in range(n))
    rows = [(1, text), (2, text), (3, "\n".join(["same here", "and here"] * 50_000)), (4, "own\n" + text + "\nend")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    begun = time.monotonic()
    got = {r.doc_id: (r.text, r.n_removed) for r in line_dedup.dedup_lines(df, Scratch(spark, "t")).collect()}
    assert time.monotonic() - begun < 90
    assert got[1] == (text, 0) and got[2] == ("", n) and got[4] == ("own\nend", n)
    assert got[3] == ("same here\nand here", 99_998)


def test_license_scan(spark, docs):
    out = {(r.doc_id, (r.text or "")[:3]): r for r in licenses.scan(docs.withColumn("score", F.lit("clash"))).collect()}
    r = out[7, "All"]
    assert (r.n_base, r.first_word, r.last_word, r.base_labels) == (3, 0, 9, "cc-by,gpl,reserved") and r.score == 1.0
    assert out[2, ""].n_words == 0 and out[2, ""].first_word is None and out[3, ""].labels == ""
    assert out[8, "wor"].n_words == 30_000
    edge = spark.createDataFrame([(1, "BY cc by"), (2, "license public general"), (3, "apache license"), (4, "cc by cc by"), (5, "Key K cc by")], "doc_id long, text string")
    got = {r.doc_id: r for r in licenses.scan(edge).collect()}
    assert [got[k].n_base for k in range(1, 6)] == [1, 0, 0, 2, 1]
    assert got[3].labels == "apache" and 0 < got[3].score < 1 and got[5].n_words == 4
    assert licenses.scan(edge.limit(0)).collect() == []


CLASH = "doc marks lines found gone left lost _doc _parts source_key turn_key words_in told turn _turn key all_words _words hashes shingles minima row given".split()
REPLACED = "n_removed size source_size target rounds severity p_toxic grade toxic places score labels".split()


def test_columns_of_any_name_come_back(spark, tmp_path):
    from matchloom.llm import stages

    texts = ["one line here\nand one more\nlast", "one line here\nand one more\nown", None, "", "some words here again"]
    rows = [(k, t, f"s{k % 2}" if k else None, *[f"{c}{k}" for c in CLASH]) for k, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, " + ", ".join(f"`{c}` string" for c in CLASH))
    for out in (
        line_dedup.dedup_lines(docs, Scratch(spark, "t")), mixing.mix(docs, mixing.word_count(F.col("text")), Scratch(spark, "t")),
        licenses.scan(docs), fingerprints.fingerprint(docs),
    ):
        got = sorted(tuple(r) for r in out.select("doc_id", *CLASH).collect())
        assert got == sorted((r[0], *r[3:]) for r in rows)
    # a stage gives back the columns of its documents, also those that its operator would replace
    more = docs.select("*", *[F.concat(F.lit(c), F.col("doc_id")).alias(c) for c in REPLACED])
    spark.createDataFrame([(1, 0), (4, 1)], "doc_id long, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    for stage in (stages.toxicity, stages.line_dedup, stages.ngram_join, stages.mixing):
        out = stage(spark, more, str(tmp_path))
        assert out.columns == more.columns
        for r in out.collect():
            assert all(r[c] == f"{c}{r.doc_id}" for c in CLASH + REPLACED)


def test_join_stage_keeps_one_row_of_a_group(spark):
    from matchloom.llm import stages

    long = " ".join(f"word{k}" for k in range(60))
    rows = [(5, long, "a"), (5, long, "b"), (None, long + " more", "c"), (5, "another text under the same id", "d"), (7, None, "e"), (7, None, "e"), (8, " ", "f")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = sorted((r.source for r in stages.ngram_join(spark, docs, "").collect()))
    assert got == ["c", "d", "e", "e", "f"]
    assert stages.ngram_join(spark, docs.limit(0), "").collect() == []
