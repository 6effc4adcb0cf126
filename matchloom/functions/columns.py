"""Names of helper columns that no caller's column has."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame


def unused(df: DataFrame, stem: str) -> str:
    """``stem``, longer if a column of df is called that, whatever its case."""
    taken = {c.lower() for c in df.columns}
    while stem.lower() in taken:
        stem += "_"
    return stem


def set_aside(df: DataFrame, names: Iterable[str]) -> tuple[DataFrame, dict[str, str]]:
    """df with its columns of ``names`` under unused names, and what gives them their own back."""
    wanted = {n.lower() for n in names}
    back: dict[str, str] = {}
    for c in [c for c in df.columns if c.lower() in wanted]:
        other = unused(df, f"{c}_given")
        df, back = df.withColumnRenamed(c, other), back | {other: c}
    return df, back
