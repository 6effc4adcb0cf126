"""The pipeline's stages: each takes (spark, docs, sf_dir) and returns the documents it keeps."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from matchloom.llm import line_dedup as lines
from matchloom.llm import mixing as mixes
from matchloom.llm import ngram_join as join
from matchloom.llm import packing
from matchloom.llm import toxicity as tox
from matchloom.llm.common import Scratch, quoted, set_aside, table, unused


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without those that the severity model rejects.

    The model is fitted on the rows of docs that the table labels names. Rows with a null or empty
    text are clean. Repeated rows stay or go together. All columns stay as they are.
    """
    model = tox.fit(docs, table(spark, sf_dir, "labels"))
    given, back = set_aside(docs, "severity", "p_toxic", "grade", "toxic")
    return back(tox.score(given, model).where("not toxic").drop("severity", "p_toxic", "grade", "toxic")).select(*quoted(*docs.columns))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that an earlier one has; n_chars is that of what is left.

    Every row stays. A null text stays null, with n_chars as it was. A column n_removed stays as it is.
    """
    given, back = set_aside(docs, "n_removed")
    out = back(lines.dedup_lines(given, Scratch(spark, "lines")).drop("n_removed"))
    if "n_chars" in docs.columns:
        n = F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.char_length("text"))
        out = out.withColumn("n_chars", n.cast(docs.schema["n_chars"].dataType))
    return out.select(*quoted(*docs.columns))


def ngram_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: that of the least id, a null id first.

    Rows of one id and text are one document, of which one row stays (the least by a hash of all
    its columns); rows of one id with different texts are judged each by its text. Rows without words all stay.
    """
    key, other, turn = unused(docs, "key", "other", "turn")
    worded = F.coalesce(F.regexp_like(F.col("text"), F.lit(join.HAS_WORDS)), F.lit(False))
    mine = docs.where(worded).withColumn(key, F.xxhash64("doc_id", "text")).withColumn(other, F.xxhash64("text", "doc_id"))
    scratch = Scratch(spark, "join")
    groups = scratch.save(join.components(mine.select(F.col(key).alias("doc_id"), "text"), scratch).distinct(), "groups")
    ids = mine.select(F.col(key).alias("key"), "doc_id").distinct().join(groups.withColumnRenamed("doc_id", "key"), "key")
    best = ids.groupBy("component_id").agg(F.min(F.struct(F.col("doc_id").isNotNull().alias("named"), "doc_id", "key")).alias("best"))
    keep = scratch.save(best.select(F.col("best.key").alias(key)), "keep")
    # equal rows have equal hashes, so which of them stays does not matter; documents that share a key by chance differ in the other hash
    one = F.row_number().over(Window.partitionBy(key, other).orderBy(F.xxhash64(*quoted(*docs.columns))))
    kept = mine.join(keep, key, "left_semi").withColumn(turn, one).where(F.col(turn) == 1)
    return kept.select(*quoted(*docs.columns)).unionByName(docs.where(~worded))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: every row as often as its source's target takes it; rows without words are not taken.

    Rows are taken by doc_id, source and size; a null source is a source of its own, the last.
    """
    given, back = set_aside(docs, "size", "source_size", "target", "rounds")
    mixed = mixes.mix(given, mixes.word_count(F.col("text")), Scratch(spark, "mix"))
    return back(mixes.repeated(mixed).drop("size", "source_size", "target", "rounds")).select(*quoted(*docs.columns))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every row with its place in a sequence; null texts count as empty, other columns are left out."""
    return packing.pack(docs, Scratch(spark, "packing"))
