"""Unicode normal forms, which Spark has no function for, and what builds on them."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from matchloom.session import ship


def _ready() -> None:
    if session := SparkSession.getActiveSession():
        ship(session)


def of_distinct(values: pa.Array, change: Callable[[str], object], kind: pa.DataType) -> pa.Array:
    """``change`` of each different string of a batch, put back where it stood; missing stays missing."""
    coded = values.dictionary_encode()
    return pa.array([change(v) for v in coded.dictionary.to_pylist()], kind).take(coded.indices)


def _arrow(change: Callable[[str], str]):
    def run(values: pa.Array) -> pa.Array:
        return of_distinct(values, change, pa.string())

    return F.arrow_udf(run, StringType())


@lru_cache(1)
def _nfkc():
    return _arrow(lambda v: unicodedata.normalize("NFKC", v))


@lru_cache(1)
def _folded():
    return _arrow(lambda v: "".join(c for c in unicodedata.normalize("NFKD", v) if not unicodedata.combining(c)))


def _unless_ascii(text: Column, udf) -> Column:
    """``udf`` of texts that are not plain ASCII; of others no byte leaves the JVM, and they stay as they are."""
    _ready()
    return F.coalesce(udf(F.when(F.octet_length(text) != F.char_length(text), text)), text)


def nfkc(text: Column) -> Column:
    return _unless_ascii(text, _nfkc())


def strip_accents(text: Column) -> Column:
    """NFKD without combining marks."""
    return _unless_ascii(text, _folded())


def clean(text: Column) -> Column:
    """NFKC, without control and format characters, in lower case; missing becomes ''."""
    return F.lower(F.regexp_replace(F.coalesce(nfkc(text), F.lit("")), "[\\p{Cc}\\p{Cf}]", ""))


def roman_search(text: Column) -> Column:
    """Lower case without diacritics, white space collapsed; missing stays missing."""
    return F.trim(F.regexp_replace(strip_accents(F.lower(text)), "(?U)[\\s\\x1c-\\x1f]+", " "))
