"""Metaphone codes, from the published rules for English spelling."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from matchloom.functions.unicode import _ready, of_distinct

VOWELS = frozenset("AEIOU")
FRONT = frozenset("EIY")
#: letters that always have the same sound
PLAIN = {"F": "F", "J": "J", "L": "L", "M": "M", "N": "N", "R": "R", "Q": "K", "V": "F", "Z": "S"}
#: openings in which the first letter is silent
SILENT = ("AE", "GN", "KN", "PN", "WR")


@lru_cache(200_000)
def metaphone(word: str) -> str:
    """The code of one word of ASCII letters; '' for none."""
    w = word.upper()
    if w.startswith(SILENT):
        w = w[1:]
    elif w.startswith("X"):
        w = "S" + w[1:]
    elif w.startswith("WH"):
        w = "W" + w[2:]
    out: list[str] = []
    n = len(w)
    at = lambda i: w[i] if 0 <= i < n else ""
    i = 0
    while i < n:
        c, before, after = w[i], at(i - 1), at(i + 1)
        step = 1
        if c == before and c != "C":
            i += 1
            continue
        if c in VOWELS:
            if i == 0:
                out.append(c)
        elif c in PLAIN:
            out.append(PLAIN[c])
        elif c == "B":
            if not (before == "M" and i == n - 1):
                out.append("B")
        elif c == "C":
            if after in FRONT and after:
                if after == "I" and at(i + 2) == "A":
                    out.append("X")
                elif before != "S":
                    out.append("S")
            elif after == "H":
                out.append("K" if before == "S" or i == 0 and at(i + 2) not in VOWELS else "X")
                step = 2
            else:
                out.append("K")
        elif c == "D":
            if after == "G" and at(i + 2) in FRONT and at(i + 2):
                out.append("J")
                step = 2
            else:
                out.append("T")
        elif c == "G":
            silent_gh = after == "H" and i + 2 < n and at(i + 2) not in VOWELS
            silent_gn = after == "N" and (i + 2 == n or w[i + 2 :] == "ED")
            if not silent_gh and not silent_gn:
                out.append("J" if after in FRONT and after and before != "G" else "K")
            if after == "H":
                step = 2
        elif c == "H":
            if after in VOWELS and after and before not in frozenset("CGPST"):
                out.append("H")
        elif c == "K":
            if before != "C":
                out.append("K")
        elif c == "P":
            out.append("F" if after == "H" else "P")
            step = 2 if after == "H" else 1
        elif c == "S":
            if after == "H":
                out.append("X")
                step = 2
            else:
                out.append("X" if after == "I" and at(i + 2) in ("O", "A") and at(i + 2) else "S")
        elif c == "T":
            if after == "I" and at(i + 2) in ("O", "A") and at(i + 2):
                out.append("X")
            elif after == "H":
                out.append("0")
                step = 2
            elif w[i + 1 : i + 3] != "CH":
                out.append("T")
        elif c in "WY":
            if after in VOWELS and after:
                out.append(c)
        elif c == "X":
            out.append("KS")
        i += step
    return "".join(out)


@lru_cache(1)
def _codes():
    def run(words: pa.Array) -> pa.Array:
        found = of_distinct(words.flatten(), metaphone, pa.string())
        sizes = words.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), found)

    return F.arrow_udf(run, ArrayType(StringType()))


def phonetic(text: Column) -> Column:
    """Codes of the runs of a-z, joined by |; words without a code are skipped, missing becomes ''."""
    _ready()
    words = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit("([a-z]+)"), F.lit(1))
    return F.array_join(F.filter(_codes()(words), lambda c: c != ""), "|")
