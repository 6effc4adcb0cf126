"""Addresses: normal form and parts, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchloom.functions.columns import set_aside
from matchloom.functions.names import chain, char_length, token_count, token_string
from matchloom.functions.unicode import clean

# fixed values: patterns, in the order in which they apply
ADDRESS_PATTERNS = [
    (r"(?U)\s*&\s*", " and "),
    (r"(?U)\s*;\s*", ", "),
    (r",+", ","),
    (r"[.!?:\"'`~^|\\()\[\]{}<>_=+]+", " "),
    (r"(?U)\s*/\s*", "/"),
    (r"(?U)\s*-\s*", "-"),
    (r"(?U)\s*#\s*", "#"),
    (r"(?U)\s+", " "),
    (r"(?U)\s*,\s*", ", "),
    (r"(?U)(,\s*){2,}", ", "),
]
# fixed values: words of a unit, a number, and what stands around them
UNIT = r"(?:#\s*|no\.?\s*|h\.?\s*no\.?\s*|house\s*|plot\s*|flat\s*|unit\s*|apt\.?\s*|apartment\s*|shop\s*|door\s*)?"
NUMBER = r"[a-z]?\d+[a-z]?"
HOUSE = rf"(?iuU)^\s*{UNIT}({NUMBER}(?:[-/]{NUMBER})*)\b"
HOUSE_ONLY = rf"(?iuU)^\s*{UNIT}({NUMBER}(?:[-/]{NUMBER})*)\b$"
NUMBERS = rf"(?iuU)\b({NUMBER}(?:[-/]{NUMBER})?)\b"
PREFIX = rf"(?iuU)^\s*(?:#|no\.?|h\.?\s*no\.?|house|plot|flat|unit|apt\.?|apartment|shop|door)?\s*{NUMBER}(?:[-/]{NUMBER})?\s*"
#: later patterns win over earlier ones, so only these two can decide
POSTAL_LETTERS = r"(?iuU)\b([a-z]\d[a-z][ -]?\d[a-z]\d)\b"
POSTAL_DIGITS = r"(?U)\b(\d{4,6})\b"
# fixed values: words that name a street
STREET_WORDS = (
    "street", "st", "road", "rd", "avenue", "ave", "boulevard", "blvd", "drive", "dr", "lane", "ln", "court", "ct",
    "place", "pl", "parkway", "pkwy", "highway", "hwy", "terrace", "ter", "way", "square", "sq",
)


def normalize_clean_address(text: Column) -> Column:
    return F.btrim(chain(text, ADDRESS_PATTERNS), F.lit(" ,"))


def normalize_address(text: Column) -> Column:
    return normalize_clean_address(clean(text))


def _all(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(1))


def house_number(address: Column) -> Column:
    return F.regexp_extract(address, HOUSE, 1)


def numeric_tokens(address: Column) -> Column:
    return F.array_join(F.array_distinct(_all(address, NUMBERS)), "|")


def postal_code(address: Column, house: Column) -> Column:
    last = lambda pattern: F.try_element_at(F.filter(_all(address, pattern), lambda m: m != house), F.lit(-1))
    return F.coalesce(last(POSTAL_LETTERS), last(POSTAL_DIGITS), F.lit(""))


def address_parts(address: Column) -> Column:
    return F.filter(F.transform(F.split(address, ","), lambda p: F.btrim(p)), lambda p: p != "")


def has_street_type(part: Column) -> Column:
    return F.arrays_overlap(_all(F.lower(part), "([a-z]+)"), F.lit(list(STREET_WORDS)))


def is_house_only(part: Column) -> Column:
    return F.coalesce(F.btrim(part).rlike(HOUSE_ONLY), F.lit(False))


def remove_house_prefix(part: Column, house: Column) -> Column:
    return F.when(house == "", F.btrim(part)).otherwise(F.btrim(F.regexp_replace(part, PREFIX, ""), F.lit(" ,-#")))


#: columns that the rules use on their way
STEPS = ["_a", "_house", "_postal", "_p", "_n", "_last", "_first", "_only", "_code", "_before", "_short", "_named", "_city_at", "_state_at", "_street_at"]
PARTS = ["house_number", "postal_code", "street", "locality", "city", "state_region", "numeric_tokens", "tokens", "token_count", "char_length"]


def with_address(df: DataFrame, address: str, country: str, prefix: str = "address_") -> DataFrame:
    """df with the ten parts of a normalized address, as ``prefix`` and their names.

    The rules look at segments between commas: postal code and country are taken out first, then
    state and city are found from the end, the street by its type word or its number, and the
    locality between them. Missing addresses have empty parts. Columns of the parts' names are
    replaced; all others stay, whatever their names.
    """
    df, back = set_aside(df, STEPS)
    address, country = (next(c for c in df.columns if back.get(c, c) == name) for name in (address, country))
    keep = [c for c in df.columns if c not in {prefix + p for p in PARTS}]
    a, house, postal, p, n = (F.col(c) for c in ("_a", "_house", "_postal", "_p", "_n"))
    place = F.btrim(F.coalesce(F.col(country), F.lit("")))
    df = df.select(*keep, F.coalesce(F.col(address), F.lit("")).alias("_a"))
    df = df.withColumn("_house", house_number(a)).withColumn("_p", address_parts(a))
    df = df.withColumn("_postal", postal_code(a, house))
    at_home = (place != "") & (F.size(p) > 1) & (F.lower(F.try_element_at(p, F.lit(-1))) == F.lower(place))
    df = df.withColumn("_p", F.when(at_home, F.slice(p, F.lit(1), F.size(p) - 1)).otherwise(p))
    without = F.filter(F.transform(p, lambda x: F.btrim(F.replace(x, postal, F.lit("")), F.lit(" ,"))), lambda x: x != "")
    df = df.withColumn("_p", F.when(postal == "", p).otherwise(without)).withColumn("_n", F.size(p))
    last = F.try_element_at(p, F.lit(-1))
    df = df.withColumn("_last", last).withColumn("_first", F.get(p, F.lit(0))).withColumn("_only", is_house_only(F.get(p, F.lit(0))))
    last, first, only = F.col("_last"), F.col("_first"), F.col("_only")
    code = F.regexp_extract(last, r"(?iuU)\b([a-z]{2,3})$", 1)
    before = F.btrim(F.expr("substring(_last, 1, char_length(_last) - char_length(_code))"))
    df = df.withColumn("_code", F.when(n >= 2, code).otherwise("")).withColumn("_before", before)
    short = (F.col("_code") != "") & (F.size(F.split(last, "(?U)\\s+")) >= 2) & (F.col("_before") != "")
    named = ~F.col("_short") & (n >= 3) & ~last.rlike("(?U)\\d") & (F.char_length(last) <= 50)
    df = df.withColumn("_short", F.coalesce(short, F.lit(False))).withColumn("_named", F.coalesce(named, F.lit(False)))
    city_at = F.when(F.col("_short"), n - 1).when(F.col("_named"), F.when((n >= 5) & only, n - 3).otherwise(n - 2)).when(n == 2, F.lit(1))
    state_at = F.when(F.col("_short") | F.col("_named"), n - 1)
    typed = F.array_position(F.transform(p, has_street_type), F.lit(True)) - 1
    street_at = F.when(typed >= 0, typed).when((n >= 1) & (house != "") & ~only, 0).when((n >= 3) & ~only, 0).cast("int")
    df = df.withColumn("_city_at", city_at).withColumn("_state_at", state_at).withColumn("_street_at", street_at)
    start = F.coalesce(F.col("_street_at") + 1, F.when(only, 1).otherwise(0))
    between = F.filter(p, lambda x, i: (i >= start) & (i < F.col("_city_at")) & ~i.eqNullSafe(F.col("_street_at")) & ~i.eqNullSafe(F.col("_state_at")))
    rest = F.filter(p, lambda x, i: i >= F.when(only, 1).otherwise(0))
    made = {
        "house_number": house,
        "postal_code": postal,
        "street": F.coalesce(F.btrim(remove_house_prefix(F.get(p, F.col("_street_at")), house)), F.lit("")),
        "locality": F.btrim(F.array_join(F.when(F.col("_city_at").isNotNull(), between).otherwise(rest), ", "), F.lit(" ,")),
        "city": F.coalesce(F.btrim(F.when(F.col("_short"), F.col("_before")).otherwise(F.get(p, F.col("_city_at")))), F.lit("")),
        "state_region": F.coalesce(F.btrim(F.when(F.col("_short"), F.col("_code")).when(F.col("_named"), last)), F.lit("")),
        "numeric_tokens": numeric_tokens(a),
        "tokens": token_string(a),
        "token_count": token_count(a),
        "char_length": char_length(a),
    }
    return df.select(*keep, *[c.alias(prefix + k) for k, c in made.items()]).withColumnsRenamed(back)
