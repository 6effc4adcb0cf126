"""Results in batches, for sinks that take rows one batch at a time.

There are no unbounded sources here: a batch is a bounded part of a finished query, and the driver
holds one at a time.
"""

from __future__ import annotations

import csv
from collections.abc import Iterator
from itertools import islice
from typing import TextIO

from pyspark.sql import DataFrame, Row

BATCH = 10_000


def batches(df: DataFrame, size: int = BATCH) -> Iterator[list[Row]]:
    rows = df.toLocalIterator(prefetchPartitions=True)
    while batch := list(islice(rows, size)):
        yield batch


def stream_tsv(df: DataFrame, out: TextIO, size: int = BATCH) -> dict[str, int]:
    """Write df to an open file as tab-separated text, in its order; how many rows, and with a non-empty last column."""
    writer = csv.writer(out, delimiter="\t", quoting=csv.QUOTE_MINIMAL, lineterminator="\n")
    writer.writerow(df.columns)
    told = {"rows": 0, "rows_with_candidates": 0}
    for batch in batches(df, size):
        writer.writerows([["" if v is None else v for v in r] for r in batch])
        told["rows"] += len(batch)
        told["rows_with_candidates"] += sum(bool(r[-1]) for r in batch)
    return told
