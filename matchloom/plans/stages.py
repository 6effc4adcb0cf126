"""The stages: romanize, normalize and structure, block, evaluate."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchloom.config import STRATEGIES, Config
from matchloom.functions.addresses import normalize_address, with_address
from matchloom.functions.names import normalize_name, structure
from matchloom.functions.phonetic import phonetic
from matchloom.functions.scripts import detect_script, transliterate
from matchloom.functions.unicode import roman_search
from matchloom.operators import evaluate as ev
from matchloom.operators.blocking import all_exact_blocks, distinct_candidates, exact_counts, unique_exact_blocks
from matchloom.operators.features import feature_table
from matchloom.operators.measures import Measures
from matchloom.operators.tfidf import gated_top_k
from matchloom.plans.runs import RunStore
from matchloom.session import shared_folder
from matchloom.sources.tables import require_columns

RAW = ["entity_id", "business_name", "business_address", "country", "business_name_original", "business_name_basic", "business_address_original", "business_address_basic"]


def romanize(records: DataFrame, name: str = "business_name_basic", address: str = "business_address_basic") -> DataFrame:
    """records with script, roman and search form of name and address; other columns pass through."""
    require_columns(records, RAW, "records")
    made = {}
    for label, column in (("business_name", name), ("business_address", address)):
        made |= {f"{label}_script": detect_script(F.col(column)), f"{label}_roman": transliterate(F.col(column))}
    out = records.withColumns(made)
    return out.withColumns({f"{label}_roman_search": roman_search(F.col(f"{label}_roman")) for label in ("business_name", "business_address")})


def normalize(records: DataFrame) -> DataFrame:
    """records with normal forms, name structure, sounds and address parts; one narrow stage."""
    require_columns(records, ["entity_id", "country", "business_name_original", "business_address_original", "business_name_roman", "business_address_roman"], "records")
    out = records.withColumns(
        {f"business_name_normalized_{k}": normalize_name(F.col(f"business_name_{k}")) for k in ("original", "roman")}
        | {f"business_address_normalized_{k}": normalize_address(F.col(f"business_address_{k}")) for k in ("original", "roman")}
    )
    out = out.withColumns({k: c for kind in ("original", "roman") for k, c in structure(F.col(f"business_name_normalized_{kind}"), f"business_name_{kind}").items()})
    out = out.withColumn("business_name_roman_phonetic", phonetic(F.col("business_name_normalized_roman")))
    return with_address(out, "business_address_normalized_roman", "country")


@dataclass
class Blocking:
    s1: DataFrame
    found: DataFrame
    unique: DataFrame
    store: RunStore | None = None


def block(s1: DataFrame, s2: DataFrame, s3: DataFrame, config: Config = Config(), store: RunStore | None = None) -> Blocking:
    """Candidates of all strategies from structured records."""
    one, others = feature_table(s1, config), {"s1_s2": feature_table(s2, config), "s1_s3": feature_table(s3, config)}
    return block_features(one, others, config, store)


def gated_features(s1: DataFrame, others: dict[str, DataFrame], config: Config = Config(), store: RunStore | None = None, stored: bool = True) -> tuple[DataFrame, dict[str, DataFrame], DataFrame, DataFrame]:
    """(s1, others, exact, found): keys as stages of ``store``, candidates of equal keys, and those with text candidates.

    ``stored``: exact candidates are a stage, too. They are many times as long as the keys, so a caller
    that reads them once is better off without.
    """
    store = store or RunStore(s1.sparkSession, shared_folder(s1.sparkSession, "block"), config)
    given = s1
    s1 = store.table("keys_s1", lambda: given)
    others = {pair: store.table(f"keys_{pair}", lambda sx=sx: sx) for pair, sx in others.items()}
    build = lambda: all_exact_blocks(s1, others, config)
    exact = store.table("exact", build, Measures(values={"strategy": STRATEGIES})) if stored else build()
    # the earlier rules count a candidate of two pairs once
    found = gated_top_k(s1, others, exact, config, store.table, exact_counts(s1, others, config, by_pair=config.mode == "v2"))
    return s1, others, exact, found


def block_features(s1: DataFrame, others: dict[str, DataFrame], config: Config = Config(), store: RunStore | None = None) -> Blocking:
    """Keys and candidates are each read by many joins, so they are stages of ``store``; without one, of a store of this run alone."""
    store = store or RunStore(s1.sparkSession, shared_folder(s1.sparkSession, "block"), config)
    s1, others, exact, found = gated_features(s1, others, config, store)
    text = reduce(DataFrame.unionByName, [store.table(f"text_{pair}", lambda: exact) for pair in others])
    unique = store.table("unique", lambda: _unique(s1, others, exact, text, config), Measures(values={"source_pair": others}))
    return Blocking(s1, found, unique, store)


def _unique(s1: DataFrame, others: dict[str, DataFrame], exact: DataFrame, text: DataFrame, config: Config) -> DataFrame:
    """Distinct candidates. Text candidates are few; only they, and exact ones of the same rows, are looked through for copies."""
    first = unique_exact_blocks(s1, others, config, with_strategy=config.mode == "v1")
    texts = distinct_candidates(text, with_strategy=config.mode == "v1")
    near = exact.join(text.select("source1_entity_id").distinct(), "source1_entity_id", "left_semi")
    return first.unionByName(texts.join(near, first.columns, "left_anti"))


def evaluate(result: Blocking, truth: DataFrame, s2: DataFrame, s3: DataFrame) -> dict[str, DataFrame]:
    """Audit, distribution, coverage and recall."""
    typed = ev.typed_truth(ev.require_truth(ev.expand_truth(truth)), s2, s3)
    return {
        "audit": ev.strategy_audit(result.found),
        "distribution": ev.count_distribution(result.s1, result.unique),
        "coverage": ev.coverage(result.s1, result.unique),
        "recall": ev.recall_by_strategy(typed, result.found).unionByName(ev.recall_union(typed, result.found)),
    }
