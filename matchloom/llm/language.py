"""Languages of texts as mixtures, by expectation-maximisation over n-gram likelihoods.

A language's model is the smoothed frequency of character n-grams in its labelled texts. A word's
log-likelihood in a language is the mean, over n-gram sizes, of sums over its n-grams. A
document is a mixture: each of its words is of one language, chosen by proportions that
expectation-maximisation finds. The set of languages is the one of greatest likelihood less
``PENALTY`` * ln(words + 1) for each language beyond the first, built by adding languages one at a
time. No mixture can beat the best language of each single word, so a document whose best language
comes within one penalty of that bound is of that language alone, exactly.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StringType, StructField, StructType

from matchloom.llm.common import Scratch, quoted
from matchloom.session import ship

#: Labelled rows of each language that are learned from, the least by a hash of id and text.
SAMPLE = 2000
#: Most frequent n-grams that the model keeps.
FEATURES = 40_000
SMOOTHING, PENALTY, ROUNDS, CLOSE = 0.5, 2.0, 40, 1e-4
SIZES = (1, 2, 3)
AT_ONCE, WORDS_AT_ONCE, WORDS_HELD, LONGEST = 200_000, 200_000, 300_000, 64
UNKNOWN = "und"
WORD = re.compile(r"[^\W\d_]+")


def grams(word: str) -> list[str]:
    """Letters, pairs and triples of a word between marks; a mark alone is none."""
    m = f" {word} "
    return [*word, *map("".join, zip(m, m[1:])), *map("".join, zip(m, m[1:], m[2:]))]


def words_of(text: str | None) -> Counter:
    """Lower-cased runs of letters and how often each stands in the text; very long ones in pieces."""
    found = Counter(WORD.findall((text or "").lower()))
    for w in [w for w in found if len(w) > LONGEST]:
        k = found.pop(w)
        for i in range(0, len(w), LONGEST):
            found[w[i : i + LONGEST]] += k
    return found


@dataclass(frozen=True)
class Languages:
    """Names in order, and each known n-gram's row of ``logs``: its log frequency in each language."""

    names: tuple[str, ...]
    index: dict[str, int]
    logs: np.ndarray

    def likelihoods(self, words: list[str]) -> np.ndarray:
        """A row of log-likelihoods of each word; n-grams that no language has say nothing."""
        found = [grams(w) for w in words]
        at = np.fromiter(map(self.index.get, chain.from_iterable(found), repeat(len(self.logs))), np.int64)
        starts = np.cumsum([0, *map(len, found)])[:-1]
        logs = np.vstack([self.logs, np.zeros(len(self.names))])
        return np.add.reduceat(logs[at], starts, axis=0) / len(SIZES)


def is_held_out(doc_id: Column) -> Column:
    """Whether the crc32 of the id as text leaves 1 when divided by 3; a null id does not."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def learn(docs: DataFrame, scratch: Scratch, sample: int = SAMPLE, features: int = FEATURES) -> Languages:
    """The model of the rows of docs (doc_id, text, lang) that are not held out and have a language and a text.

    Equal rows are learned from once. Ids that are null are not learned from. n-grams are counted where the texts are; the driver gets
    the ``features`` most frequent ones (ties: the lesser n-gram).
    """
    fine = F.col("doc_id").isNotNull() & ~is_held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").isNotNull()
    known = docs.where(fine).select("lang", "text", F.xxhash64("doc_id", "text").alias("h"))
    # at first about twice as many as wanted by hash alone, so that no language's rows all meet in one task
    sizes = known.groupBy("lang").agg(F.count("*").alias("of"))  # a row for each language
    near = F.col("h") / 2.0**64 + 0.5 < (2.0 * sample + 100) / F.col("of")
    some = known.join(F.broadcast(sizes), "lang").where(near).groupBy("lang", "h").agg(F.first("text").alias("text"))
    turn = F.row_number().over(Window.partitionBy("lang").orderBy("h"))
    rows = scratch.save(some, "some").withColumn("turn", turn).where(F.col("turn") <= sample).select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, Counter] = {}

        def held() -> Iterator[pa.RecordBatch]:
            # n-grams of each distinct word once
            for lang, found in seen.items():
                told: Counter = Counter()
                for word, k in found.items():
                    for g in grams(word):
                        told[g] += k
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(told), pa.string()), pa.array(list(told), pa.string()), pa.array(list(told.values()), pa.int64())], names=["lang", "gram", "n"])
            seen.clear()

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                seen.setdefault(lang, Counter()).update(words_of(text.as_py()))
                if sum(map(len, seen.values())) > AT_ONCE:
                    yield from held()
        yield from held()

    counts = scratch.save(rows.mapInArrow(count, "lang string, gram string, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")), "grams")
    best = counts.groupBy("gram").agg(F.sum("n").alias("all"), F.collect_list(F.struct("lang", "n")).alias("of")).orderBy(F.desc("all"), "gram").limit(features)
    table = best.select("gram", "of").collect()
    names = tuple(sorted(r["lang"] for r in counts.select("lang").distinct().collect()))
    scratch.drop("some", "grams")
    place, n = {name: k for k, name in enumerate(names)}, np.zeros((len(table), len(names)))
    for k, r in enumerate(table):
        for lang, c in r["of"]:
            n[k, place[lang]] = c
    sizes = np.array([len(r["gram"]) for r in table], int)
    logs = np.zeros_like(n)
    for size in SIZES:  # frequencies among the n-grams of one size
        mine = sizes == size
        smooth = n[mine] + SMOOTHING
        logs[mine] = np.log(smooth / smooth.sum(axis=0)) if mine.any() else 0
    return Languages(names, {r["gram"]: k for k, r in enumerate(table)}, logs)


def mix(rows: np.ndarray, counts: np.ndarray, doc: np.ndarray, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Proportions and log-likelihood of each document, all at once.

    Row k of ``rows`` has the log-likelihoods of a word that document ``doc[k]`` has ``counts[k]``
    times (doc ascending from 0, each with a row); ``allowed`` says which languages a document may have.
    """
    starts = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])
    top = np.where(allowed[doc], rows, -np.inf).max(axis=1, keepdims=True)
    p = np.where(allowed[doc], np.exp(np.minimum(rows - top, 0)), 0)
    total = np.add.reduceat(counts, starts)
    share = allowed / allowed.sum(axis=1, keepdims=True)
    for _ in range(ROUNDS):
        joint = p * share[doc]
        new = np.add.reduceat(joint * (counts / joint.sum(axis=1))[:, None], starts, axis=0) / total[:, None]
        moved = np.abs(new - share).max()
        share = new
        if moved < CLOSE:
            break
    like = np.add.reduceat(counts * (np.log((p * share[doc]).sum(axis=1)) + top[:, 0]), starts)
    return share, like


def infer(rows: np.ndarray, counts: np.ndarray, doc: np.ndarray, docs: int) -> tuple[np.ndarray, np.ndarray]:
    """(proportions, score) of documents with words: a row of proportions each, zero outside the chosen set."""
    starts = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])
    many = rows.shape[1]
    total = np.add.reduceat(counts, starts)
    penalty = PENALTY * np.log(total + 1)
    single = np.add.reduceat(counts[:, None] * rows, starts, axis=0)
    bound = np.add.reduceat(counts * rows.max(axis=1), starts)
    chosen = np.zeros((docs, many), bool)
    chosen[np.arange(docs), single.argmax(axis=1)] = True
    value = single.max(axis=1)
    share = chosen.astype(float)
    # how sure the one language is against each other one alone
    apart = np.exp(np.clip(single - value[:, None], -500, 0))
    score = 1 / apart.sum(axis=1)
    open_ = np.flatnonzero(bound - value > penalty)
    if len(open_) and many > 1:  # all languages together are as likely as any mixture
        inside = np.isin(doc, open_)
        _, like = mix(rows[inside], counts[inside], np.searchsorted(open_, doc[inside]), np.ones((len(open_), many), bool))
        bound[open_] = np.minimum(bound[open_], like)
        open_ = open_[bound[open_] - value[open_] > penalty[open_]]
    size = 1
    while len(open_) and size < many:
        inside = np.isin(doc, open_)
        part, n, d = rows[inside], counts[inside], np.searchsorted(open_, doc[inside])
        best, best_share, best_set = value[open_].copy(), share[open_].copy(), chosen[open_].copy()
        for lang in range(many):
            wider = chosen[open_].copy()
            wider[:, lang] = True
            got, like = mix(part, n, d, wider)
            like = like - penalty[open_] * size
            better = (like > best) & ~chosen[open_, lang]
            best[better], best_share[better], best_set[better] = like[better], got[better], wider[better]
        grew = best > value[open_]
        value[open_], share[open_], chosen[open_] = best, best_share, best_set
        score[open_[grew]] = best_share[grew].max(axis=1)
        size += 1
        open_ = open_[grew]
        open_ = open_[bound[open_] - value[open_] > penalty[open_]]
    return share, score


def predict(docs: DataFrame, model: Languages) -> DataFrame:
    """docs with lang_pred, score (0 to 1) and languages (name and proportion, falling).

    lang_pred is the language of the greatest proportion (ties: the lesser name); score that
    proportion or, of a single language, how likely it is against each other one alone. A text that
    is null or has no letter is ``und`` with score 0, and so is every text if nothing was learned.
    Texts are read whole. Every row stays; columns of those three names are replaced.
    """
    ship(docs.sparkSession)
    made = ("lang_pred", "score", "languages")
    names = [c for c in docs.columns if c.lower() not in made]
    shared = docs.sparkSession.sparkContext.broadcast(model)  # FEATURES rows of a number for each language
    at = names.index("text")
    mixed = pa.list_(pa.struct([("lang", pa.string()), ("share", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, place = shared.value, {}
        known = np.zeros((0, len(m.names)))

        def some(texts: list[Counter]) -> list[tuple[str, float, list[dict]]]:
            nonlocal known
            full = [k for k, t in enumerate(texts) if t and m.names]
            out: list = [(UNKNOWN, 0.0, [])] * len(texts)
            if not full:
                return out
            if len(place) > WORDS_HELD:
                place.clear()
                known = known[:0]
            new = list({w for k in full for w in texts[k] if w not in place})
            if new:
                place.update(zip(new, range(len(place), len(place) + len(new))))
                known = np.concatenate([known, m.likelihoods(new)])
            rows = known[[place[w] for k in full for w in texts[k]]]
            counts = np.array([n for k in full for n in texts[k].values()], float)
            doc = np.repeat(np.arange(len(full)), [len(texts[k]) for k in full])
            share, score = infer(rows, counts, doc, len(full))
            best = share.argmax(axis=1)
            for d, k in enumerate(full):
                order = sorted(np.flatnonzero(share[d]), key=lambda j: (-share[d, j], j))
                out[k] = (m.names[best[d]], min(1.0, float(score[d])), [{"lang": m.names[j], "share": float(share[d, j])} for j in order])
            return out

        for batch in batches:
            done, held, size = [], [], 0
            for text in batch.column(at):
                held.append(words_of(text.as_py()))
                size += len(held[-1])
                if size > WORDS_AT_ONCE:
                    done += some(held)
                    held, size = [], 0
            done += some(held)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(names)], pa.array([d[0] for d in done], pa.string()), pa.array([d[1] for d in done], pa.float64()), pa.array([d[2] for d in done], mixed)], names=[*names, *made]
            )

    pair = StructType([StructField("lang", StringType()), StructField("share", DoubleType())])
    more = [StructField("lang_pred", StringType()), StructField("score", DoubleType()), StructField("languages", ArrayType(pair))]
    schema = StructType([*[f for f in docs.schema if f.name in names], *more])
    return docs.select(*quoted(*names)).mapInArrow(run, schema)
