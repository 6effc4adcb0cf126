"""Blocking keys of records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchloom.config import SEPARATOR, Config
from matchloom.sources.tables import find_column, find_optional_column, require_columns

#: key and the column it is made from
BASE_KEYS = {
    "name_key_base": "business_name_normalized_original",
    "roman_name_key_base": "business_name_normalized_roman",
    "phonetic_key_base": "business_name_roman_phonetic",
    "country_key": "country",
    "postal_key": "address_postal_code",
    "house_key": "address_house_number",
    "locality_key": "address_locality",
    "city_key": "address_city",
    "state_key": "address_state_region",
    "address_key_base": "business_address_normalized_original",
    "roman_address_key_base": "business_address_normalized_roman",
}
#: composite key and its two parts
COMPOSITE_KEYS = {
    "name_country_key": ("name_key_base", "country_key"),
    "name_postal_key": ("name_key_base", "postal_key"),
    "house_locality_key": ("house_key", "locality_key"),
    "house_city_key": ("house_key", "city_key"),
}
# fixed values: other names that the earlier rules accept; the first that is there wins
ALIASES = {
    "business_name_normalized_original": ["business_name_normalized_original", "business_name_normalized", "business_name_norm", "business_name_basic", "business_name_original", "business_name"],
    "business_name_normalized_roman": ["business_name_normalized_roman", "business_name_roman_search", "business_name_roman"],
    "business_name_roman_phonetic": ["business_name_roman_phonetic", "business_name_phonetic"],
    "country": ["country", "country_normalized"],
    "address_postal_code": ["address_postal_code", "business_address_postal_code", "postal_code"],
    "address_house_number": ["address_house_number", "business_address_house_number", "house_number"],
    "address_locality": ["address_locality", "business_address_locality", "locality"],
    "address_city": ["address_city", "business_address_city", "city"],
    "address_state_region": ["address_state_region", "business_address_state_region", "state_region", "state", "province"],
}
#: columns that the earlier rules can't do without
NEEDED = ("business_name_normalized_original", "business_name_normalized_roman", "business_name_roman_phonetic", "country")


def key(column: Column) -> Column:
    """Trimmed and in lower case; '' where missing, and '' never matches anything."""
    return F.lower(F.trim(F.coalesce(column, F.lit(""))))


def composite_key(a: Column, b: Column, one_sided: bool = False) -> Column:
    """Both parts, or '' where one is ''; ``one_sided`` keeps the other part instead."""
    if one_sided:
        return F.concat_ws(SEPARATOR, F.nullif(a, F.lit("")), F.nullif(b, F.lit("")))
    return F.when((a != "") & (b != ""), F.concat(a, F.lit(SEPARATOR), b)).otherwise("")


def prefix_bucket(roman: Column) -> Column:
    """The first two of [a-z0-9] that stand side by side."""
    return F.regexp_extract(roman, "([a-z0-9]{2})", 1)


def feature_table(records: DataFrame, config: Config = Config()) -> DataFrame:
    """entity_id and all keys of structured records. The earlier rules look for aliases.

    They let columns of addresses be absent; a name, its Roman form, its sounds and the country have
    to be there under some name (KeyError).
    """
    if config.mode == "v2":
        require_columns(records, ["entity_id", *BASE_KEYS.values()], "records")
        sources = BASE_KEYS
    else:
        find = lambda c: find_column(records.columns, ALIASES[c], c) if c in NEEDED else find_optional_column(records.columns, ALIASES[c])
        sources = {k: find(c) for k, c in BASE_KEYS.items() if "address_key" not in k}
    made = records.select(F.col("entity_id").cast("string").alias("entity_id"), *[(key(F.col(c)) if c else F.lit("")).alias(k) for k, c in sources.items()])
    return with_composites(made, config)


def with_composites(keys: DataFrame, config: Config = Config()) -> DataFrame:
    made = {k: composite_key(F.col(a), F.col(b), config.mode == "v1") for k, (a, b) in COMPOSITE_KEYS.items()}
    return keys.withColumns(made | {"tfidf_prefix2": prefix_bucket(F.col("roman_name_key_base"))})
