"""Scripts of texts, and Indic scripts in Roman letters."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from matchloom.functions.unicode import _ready

#: blocks of 128 code points that are laid out alike, from Devanagari on
INDIC = {name: 0x900 + 0x80 * k for k, name in enumerate(["Devanagari", "Bengali", "Gurmukhi", "Gujarati", "Oriya", "Tamil", "Telugu", "Kannada", "Malayalam", "Sinhala"])}
#: Sinhala is told apart, but it is laid out in its own way and stays as it is
ROMANIZED = frozenset(INDIC) - {"Sinhala"}
#: of the Latin script, but with names that don't say so
UNNAMED = "ªº"
PATTERNS = {name: f"[\\x{{{start:04X}}}-\\x{{{start + 0x7F:04X}}}]" for name, start in INDIC.items()} | {"Latin": f"[\\p{{IsLatin}}&&[^{UNNAMED}\\p{{M}}]]"}


def detect_script(text: Column) -> Column:
    """Empty, Other, the dominant script, or Mixed.

    A second script of up to two characters doesn't count, nor one of up to five beside nine tenths.
    Characters are counted only where a text has Indic ones at all; else Latin ones tell all.
    """
    # as the variable of a lambda, a text that has to be made is made once
    return F.get(F.transform(F.array(text), lambda t: _script(t)), F.lit(0))


def _script(text: Column, dominant: Callable[[Column], Column] | None = None) -> Column:
    indic = F.regexp_like(text, F.lit(f"[\\x{{{min(INDIC.values()):04X}}}-\\x{{{max(INDIC.values()) + 0x7F:04X}}}]"))
    empty = text.isNull() | ~F.regexp_like(text, F.lit("(?U)[^\\s\\x1c-\\x1f]"))
    return F.when(empty, "Empty").when(indic, (dominant or _dominant)(text)).when(F.regexp_like(text, F.lit(PATTERNS["Latin"])), "Latin").otherwise("Other")


def _count(text: Column, pattern: str) -> Column:
    """Characters that match; whole runs go at once, and no list of matches is made."""
    return F.char_length(text) - F.char_length(F.regexp_replace(text, F.lit(f"{pattern}+"), F.lit("")))


def _dominant(text: Column) -> Column:
    # the scripts' own characters are few, so the text is not gone through for each script
    own = F.regexp_replace(text, F.lit(f"[^\\x{{{min(INDIC.values()):04X}}}-\\x{{{max(INDIC.values()) + 0x7F:04X}}}]+"), F.lit(""))
    counts = F.get(F.transform(F.array(own), lambda x: F.array(*[_count(x, p) for s, p in PATTERNS.items() if s != "Latin"])), F.lit(0))
    found = F.array_append(counts, _count(text, PATTERNS["Latin"]))
    firsts = {s: F.regexp_instr(text, F.lit(f"({p})"), 0) for s, p in PATTERNS.items()}
    ordered = [*INDIC, "Latin"]
    told = lambda ns: F.array(*[F.struct((-F.get(ns, F.lit(j))).alias("n"), F.when(F.get(ns, F.lit(j)) > 0, firsts[s]).alias("first"), F.lit(s).alias("script")) for j, s in enumerate(ordered)])
    seen = F.filter(F.get(F.transform(F.array(found), told), F.lit(0)), lambda x: x["n"] < 0)
    return F.get(F.transform(F.array(F.sort_array(seen)), _first_of), F.lit(0))


def _first_of(ranked: Column) -> Column:
    first, second = F.get(ranked, F.lit(0)), F.get(ranked, F.lit(1))
    total = F.aggregate(ranked, F.lit(0), lambda a, x: a - x["n"])
    return (
        F.when(F.size(ranked) == 0, "Other")
        .when(F.size(ranked) == 1, first["script"])
        .when(-second["n"] <= 2, first["script"])
        .when((-first["n"] / total >= 0.9) & (-second["n"] <= 5), first["script"])
        .otherwise("Mixed")
    )


def _dominant_flat(text: Column) -> Column:
    """The same without nested lambdas, which Spark can't take out of the argument of a Python function."""
    seen = F.filter(
        F.array(*[F.struct((-F.regexp_count(text, F.lit(p))).alias("n"), F.regexp_instr(text, F.lit(f"({p})"), 0).alias("first"), F.lit(s).alias("script")) for s, p in PATTERNS.items()]),
        lambda x: x["n"] < 0,
    )
    return _first_of(F.sort_array(seen))


def char_script(ch: str) -> str | None:
    """Indic blocks first, then no script for marks, then Latin by the character's name."""
    code = ord(ch)
    if 0x900 <= code < 0xE00:
        return list(INDIC)[(code - 0x900) // 0x80]
    if unicodedata.category(ch)[0] == "M":
        return None
    return "Latin" if "LATIN" in unicodedata.name(ch, "") else None


# fixed values: Harvard-Kyoto letters by place in the block
CONSONANTS = dict(zip(range(0x15, 0x3A), "k kh g gh G c ch j jh J T Th D Dh N t th d dh n n p ph b bh m y r r l L L v z S s h".split()))
VOWELS = dict(zip(range(0x05, 0x15), "a A i I u U R lR e e e ai o o o au".split()))
SIGNS = dict(zip(range(0x3E, 0x4D), "A i I u U R RR e e e ai o o o au".split()))
OTHERS = {0x01: "~", 0x02: "M", 0x03: "H", 0x3C: "", 0x3D: "'", 0x50: "OM", 0x60: "RR", 0x61: "lRR", 0x64: "|", 0x65: "||"} | {0x66 + d: str(d) for d in range(10)}
NUKTA = dict(zip(range(0x58, 0x60), "q kh g z D Dh f y".split()))
VIRAMA = 0x4D


def harvard_kyoto(text: str, script: str) -> str:
    """Letters of ``script`` in Harvard-Kyoto; anything else as it is. A consonant has an a of its own."""
    start, out, waiting = INDIC[script], [], False
    for ch in text:
        place = ord(ch) - start
        if ch in "।॥":
            place = 0x64 + (ch == "॥")
        if waiting and not (place in SIGNS or place == VIRAMA or place == 0x3C):
            out.append("a")
            waiting = False
        if place in CONSONANTS or place in NUKTA:
            out.append(CONSONANTS.get(place) or NUKTA[place])
            waiting = True
        elif place in SIGNS:
            out.append(SIGNS[place])
            waiting = False
        elif place == VIRAMA:
            waiting = False
        elif place == 0x3C and waiting:
            continue
        elif place in VOWELS:
            out.append(VOWELS[place])
        elif place in OTHERS:
            out.append(OTHERS[place])
        else:
            out.append(ch)
    return "".join([*out, "a"] if waiting else out)


def romanize(text: str | None, script: str | None) -> str | None:
    if text is None or script not in ROMANIZED and script != "Mixed":
        return text
    if script != "Mixed":
        return harvard_kyoto(text, script)
    runs: list[tuple[str | None, str]] = []
    for ch in text:
        of = char_script(ch)
        if runs and runs[-1][0] == of:
            runs[-1] = (of, runs[-1][1] + ch)
        else:
            runs.append((of, ch))
    return "".join(harvard_kyoto(run, of) if of in ROMANIZED else run for of, run in runs)


@lru_cache(1)
def _romanized():
    def run(texts: pa.Array, scripts: pa.Array) -> pa.Array:
        # each different text once; its script follows from it
        coded = texts.dictionary_encode()
        script_of = dict(zip(coded.indices.to_pylist(), scripts.to_pylist()))
        made = [romanize(v, script_of[k]) for k, v in enumerate(coded.dictionary.to_pylist())]
        return pa.array(made, pa.string()).take(coded.indices)

    return F.arrow_udf(run, StringType())


def transliterate(text: Column, script: Column | None = None) -> Column:
    """Texts in an Indic script as a whole, the Indic runs of mixed ones; all others unchanged, and never sent to Python.

    script: what ``detect_script`` gave for the text, if it is there already.
    """
    _ready()
    script = _script(text, _dominant_flat) if script is None else script
    indic = script.isin(*sorted(ROMANIZED), "Mixed")
    return F.coalesce(_romanized()(F.when(indic, text), F.when(indic, script)), text)
