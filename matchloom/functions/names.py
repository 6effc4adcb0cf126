"""Business names: normal form and structure."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from matchloom.functions.unicode import clean

# fixed values: legal forms and what they are written as
LEGAL_FORMS = {
    "pvt": "private",
    "private": "private",
    "ltd": "limited",
    "limited": "limited",
    "corp": "corporation",
    "corporation": "corporation",
    "inc": "incorporated",
    "incorporated": "incorporated",
    "co": "company",
    "company": "company",
    "llc": "limited liability company",
    "llp": "limited liability partnership",
    "plc": "public limited company",
}
# fixed values: patterns, in the order in which they apply
NAME_PATTERNS = [
    (r"(?U)\bpvt\s*[/&-]\s*ltd\b", " private limited "),
    (r"(?U)\bprivate\s*[/&-]\s*limited\b", " private limited "),
    (r"(?U)\bl\s*\.\s*l\s*\.\s*c\s*\.?\b", " llc "),
    (r"(?U)\bl\s*\.\s*l\s*\.\s*p\s*\.?\b", " llp "),
    (r"(?U)\s*&\s*", " and "),
    (r"(?U)\s*\+\s*", " and "),
    (r"(?U)(?<=\w)\s*/\s*(?=\w)", " and "),
    (r"[.,;:!?\"'`~^|\\()\[\]{}<>_=]+", " "),
    (r"-+", " "),
]
EDGES = ".,;:!?\"'`~^|\\()[]{}<>_=+-"


def chain(text: Column, patterns: list[tuple[str, str]]) -> Column:
    for pattern, to in patterns:
        text = F.regexp_replace(text, pattern, to)
    return text


def tokens(text: Column) -> Column:
    """Parts between white space, none of them empty."""
    return F.filter(F.split(text, "(?U)\\s+"), lambda t: t != "")


def normalize_clean_name(text: Column) -> Column:
    """``normalize_name`` of text that ``clean`` has been through."""
    forms = F.create_map(*[F.lit(x) for pair in LEGAL_FORMS.items() for x in pair])
    parts = F.filter(F.transform(tokens(chain(text, NAME_PATTERNS)), lambda t: F.btrim(t, F.lit(EDGES))), lambda t: t != "")
    return F.array_join(F.transform(parts, lambda t: F.coalesce(F.try_element_at(forms, t), t)), " ")


def normalize_name(text: Column) -> Column:
    return normalize_clean_name(clean(text))


def token_string(text: Column) -> Column:
    return F.array_join(tokens(F.coalesce(text, F.lit(""))), "|")


def compact(text: Column) -> Column:
    """Letters and digits only; vowel signs are marks and go."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), "[^\\p{L}\\p{N}]", "")


def first_token(text: Column) -> Column:
    return F.coalesce(F.get(tokens(text), F.lit(0)), F.lit(""))


def last_token(text: Column) -> Column:
    return F.coalesce(F.try_element_at(tokens(text), F.lit(-1)), F.lit(""))


def token_count(text: Column) -> Column:
    return F.size(tokens(F.coalesce(text, F.lit(""))))


def char_length(text: Column) -> Column:
    """Code points but for U+0020."""
    return F.char_length(F.replace(F.coalesce(text, F.lit("")), F.lit(" "), F.lit("")))


def structure(text: Column, prefix: str) -> dict[str, Column]:
    made = {"tokens": token_string, "compact": compact, "first_token": first_token, "last_token": last_token, "token_count": token_count, "char_length": char_length}
    return {f"{prefix}_{k}": f(text) for k, f in made.items()}
