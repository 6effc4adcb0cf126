"""Token ids in Parquet list columns, for selective reads.

A folder of files in ascending doc_id order, one range of ids a file. A row holds a document's
ids, the last of them the end id, and its place in its file's stream. Ids are delta or dictionary
encoded and compressed, row groups and pages have a fixed size, and the page indexes let a reader
of some documents, or of the metadata columns alone, leave the rest of the bytes unread. A second
small table has each file's first place in the whole stream.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from matchloom.llm.common import partitions
from matchloom.llm.tokenizing import END, tokenizer, vocabulary
from matchloom.session import ship

#: Parquet settings: row groups of 32 MB, pages of 64 KB with their own statistics
LAYOUT = {
    "parquet.block.size": str(32 << 20), "parquet.page.size": str(64 << 10), "parquet.page.row.count.limit": "2000",
    "parquet.writer.version": "v2", "parquet.enable.dictionary": "true", "parquet.dictionary.page.size": str(2 << 20),
    "parquet.enable.dictionary#doc_id": "false", "compression": "zstd", "parquet.page.write-checksum.enabled": "true",
}
SCHEMA = "file int, doc_id long, local_start long, n_tokens long, tokens array<int>"


def encode_sorted(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """(file, doc_id, local_start, n_tokens, tokens), partitioned by ranges of doc_id and sorted in each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        file, place, t = TaskContext.get().partitionId(), 0, tokenizer(path)
        for batch in batches:
            for a, ids, ends in t.batches(batch.column(1)):
                ids = np.insert(ids, ends, END)
                ends = ends + np.arange(1, len(ends) + 1)
                starts = np.concatenate([[0], ends[:-1]])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(ends), file, np.int32)), batch.column(0).slice(a, len(ends)), pa.array(place + starts), pa.array(ends - starts), pa.ListArray.from_arrays(pa.array(np.append(starts, ends[-1]).astype(np.int32)), pa.array(ids.astype(np.int32)))],
                    names=["file", "doc_id", "local_start", "n_tokens", "tokens"],
                )
                place += int(ends[-1])

    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("text"))
    dealt = docs.repartitionByRange(partitions(docs.sparkSession), F.col("doc_id").asc_nulls_first(), F.xxhash64("text")).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))
    return dealt.mapInArrow(run, SCHEMA)


def write_tokens(docs: DataFrame, folder: str, path: str | None = None, text: str = "text") -> None:
    """Write docs' ids below ``folder``. Null texts count as empty and have the end id alone.

    Other columns are ignored. Rows with a null doc_id come first, rows with the same doc_id in a
    fixed order of their texts. An empty table gives empty files. A text is encoded as a whole.
    """
    spark = docs.sparkSession
    ship(spark)
    encode_sorted(docs, path or vocabulary(), text).write.options(**LAYOUT).parquet(f"{folder}/tokens")
    rows = spark.read.schema(SCHEMA).parquet(f"{folder}/tokens")
    sums = rows.groupBy("file").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    sums.select("file", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")).write.parquet(f"{folder}/files")


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, tokens); start counts the ids of all documents before it."""
    rows = spark.read.schema(SCHEMA).parquet(f"{folder}/tokens")
    files = spark.read.schema("file int, base long").parquet(f"{folder}/files")  # one row a file
    return rows.join(files, "file").select("doc_id", (F.col("base") + F.col("local_start")).alias("start"), "n_tokens", "tokens")


def with_crc(rows: DataFrame, column: str = "tokens", out: str = "ids_crc32") -> DataFrame:
    """rows without ``column`` but with the CRC-32 of its ids as little-endian unsigned 32-bit integers."""
    ship(rows.sparkSession)
    names = [c for c in rows.columns if c not in (column, out)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(len(names))
            offsets, values = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False).astype("<u4", copy=False)
            crc = [zlib.crc32(values[a:b].tobytes()) for a, b in zip(offsets, offsets[1:])]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(names)], pa.array(crc, pa.int64())], names=[*names, out])

    kinds = dict(rows.dtypes)
    return rows.select(*names, column).mapInArrow(run, ", ".join(f"{c} {kinds[c]}" for c in names) + f", {out} long")
