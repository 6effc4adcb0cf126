"""Parameters of the matching pipeline. ``mode`` v2 is the default; v1 is the earlier set of rules."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Config:
    mode: str = "v2"
    block_cap: int = 1000  #: rows of one side that a blocking key may have
    tfidf_top_k: int = 15
    tfidf_features: int = 50_000  #: most frequent n-grams that a bucket keeps
    tfidf_bucket_cap: int | None = None  #: rows of a bucket, beyond which it is skipped; None: none is
    tfidf_gate: int = 30  #: only entities with fewer candidates are searched by text
    ngrams: tuple[int, ...] = (3, 4, 5)
    na_literals: bool = True  #: read NA, null, nan and the like as missing, in the text stages

    @property
    def sublinear_tf(self) -> bool:
        return self.mode == "v2"

    @property
    def keep_zero_similarity(self) -> bool:
        return self.mode == "v2"


# fixed values: literals that mean missing
NA_LITERALS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]
SEPARATOR = "¦"
PAIRS = ("s1_s2", "s1_s3")
#: strategy and the key it joins on, in order
STRATEGIES = {
    "exact_name": "name_key_base",
    "name_country": "name_country_key",
    "name_postal": "name_postal_key",
    "house_locality": "house_locality_key",
    "house_city": "house_city_key",
    "phonetic_name": "phonetic_key_base",
    "roman_exact_name": "roman_name_key_base",
}
TFIDF = "tfidf_char_topk"
