"""Document fingerprints: one-permutation MinHash with optimal densification and packed low bits.

A text's 5-word shingles are hashed once. The top bits of a hash choose one of ``BINS`` bins and
the least hash in a bin stands for it. An empty bin takes the value of another bin, found by a
probing order that depends on the bin alone, until a filled one turns up. Of every bin ``BITS``
low bits are kept; the likeness of two fingerprints is corrected for bits that agree by chance.

Everything is a column expression: a row never leaves its task for its fingerprint.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchloom.llm.common import SPACE, cut_points, let, partitions, range_of, unused

BINS, BITS, SHINGLE, PROBES = 256, 8, 5, 8
SHIFT = 64 - (BINS - 1).bit_length()
LOW = (1 << SHIFT) - 1
BY_CHANCE = 2.0**-BITS


BLANKS = " \t\n\x0b\x0c\r"
#: PROBE_ORDER[t][i]: the bin that an empty bin i looks at in its t-th try
PROBE_ORDER = [[int(b) for b in np.random.default_rng(1000 + t).integers(0, BINS, BINS)] for t in range(PROBES)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def with_signature(df: DataFrame, text: str, out: str) -> DataFrame:
    """df with ``out``: array<int> of BINS values of BITS bits; empty for a text without words or null.

    A text of fewer than 5 words has one shingle, the whole sequence. The steps are columns of
    their own, used more than once each, so that splitting and sorting run as generated code.
    """
    none = F.array().cast("array<bigint>")
    h, s, m = unused(df, "hashes", "shingles", "minima")
    clean = F.btrim(F.lower(F.coalesce(F.col(text), F.lit(""))), F.lit(BLANKS))
    hashes = F.transform(F.split(clean, SPACE), lambda w: F.xxhash64(w))
    several = F.transform(F.sequence(F.lit(0), F.size(h) - SHINGLE), lambda i: F.xxhash64(*[F.get(F.col(h), i + k) for k in range(SHINGLE)]))
    shingles = F.when(F.size(h) >= SHINGLE, several).when(F.size(h) > 0, F.array(F.xxhash64(h))).otherwise(none)
    # one stand-in at the top of every bin's range: where it comes first, the bin is empty
    top = F.lit([_signed((b << SHIFT) | LOW) for b in range(BINS)])
    bin_of = lambda x: F.shiftrightunsigned(x, SHIFT)

    def firsts(s: Column) -> Column:
        m = F.filter(s, lambda x, i: (i == 0) | (bin_of(x) != bin_of(F.get(s, i - 1))))
        return F.transform(m, lambda x: F.when(x.bitwiseAND(F.lit(LOW)) != F.lit(LOW), x))

    def dense(m: Column, filled: Column) -> Column:
        def value(x: Column, i: Column) -> Column:
            probes = [F.get(m, F.get(F.lit(order), i)) for order in PROBE_ORDER]
            # the probing order goes on as a ranking of all filled bins, so it always ends
            rest = F.array_min(F.transform(filled, lambda y: F.struct(F.xxhash64(i, bin_of(y)).alias("r"), y.alias("y"))))["y"]
            return F.coalesce(x, *probes, rest).bitwiseAND(F.lit((1 << BITS) - 1)).cast("int")

        return F.transform(m, value)

    df = df.withColumn(h, F.when(clean == "", none).otherwise(hashes))
    df = df.withColumn(s, F.when(F.size(h) > 0, F.sort_array(F.concat(shingles, top))).otherwise(none))
    df = df.withColumn(m, F.when(F.size(s) > 0, let(F.col(s), firsts)).otherwise(none))
    filled = F.filter(F.col(m), lambda x: x.isNotNull())
    df = df.withColumn(out, let(F.col(m), lambda m: let(filled, lambda f: dense(m, f))))
    return df.drop(h, s, m)


def packed(sig: Column) -> Column:
    """The signature's bytes in hex, as one string; equal texts have equal strings."""
    digits = F.lit([f"{b:02x}" for b in range(1 << BITS)])
    return F.array_join(F.transform(sig, lambda b: F.get(digits, b)), "")


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard similarity of the shingle sets. Two empty signatures: 1; one empty: 0."""
    same = F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda t: t)) / F.lit(float(BINS))
    fixed = F.least(F.lit(1.0), F.greatest(F.lit(0.0), (same - BY_CHANCE) / (1 - BY_CHANCE)))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), 1.0).when((F.size(a) == 0) | (F.size(b) == 0), 0.0).otherwise(fixed)


def fingerprint(docs: DataFrame, text: str = "text", out: str = "fingerprint") -> DataFrame:
    """docs with one more column, the fingerprint of ``text``. A null text counts as empty ('')."""
    return with_signature(docs, text, out).withColumn(out, packed(F.col(out)))


def with_neighbour(docs: DataFrame, build) -> DataFrame:
    """One row per document, beside the next document's in ascending doc_id, the first after the last.

    build(docs, window) adds columns that may use ``F.lead`` over the window. The ids are cut into
    ranges at ids that occur; each cut row is also sent to the range before it, and the first row
    to the last range, so that no range has to see another one and none is larger than its share.
    Rows with a null doc_id come before all others. Repeated ids follow each other by their text.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    key = F.coalesce("doc_id", F.lit(-(1 << 63)))
    docs = docs.withColumn("key", key)
    cuts, least = cut_points(docs, "key", 4 * partitions(docs.sparkSession))
    at = range_of(F.col("key"), cuts)
    none = F.lit(None).cast("struct<range:int,guard:int>")
    places = F.array(
        F.struct(at.alias("range"), F.lit(0).alias("guard")),
        F.when(F.col("key").isin(cuts), F.struct((at - 1).alias("range"), F.lit(1).alias("guard"))).otherwise(none) if cuts else none,
        F.when(F.col("key") == F.lit(least), F.struct(F.lit(len(cuts)).alias("range"), F.lit(2).alias("guard"))).otherwise(none) if least is not None else none,
    )
    dealt = docs.select("doc_id", "key", "text", F.inline(F.filter(places, lambda p: p.isNotNull())))
    window = Window.partitionBy("range").orderBy("guard", "key", "text")
    return build(dealt, window).where("guard = 0")


def edited_pairs(docs: DataFrame) -> DataFrame:
    """Each document's fingerprint against that of its edited text and that of the next document.

    The edited text has the last floor(n_chars / 4) code points replaced by the first as many (or
    all there are) of the next document. Null texts count as empty; other columns are ignored.
    An empty table gives an empty result; a single document is its own neighbour.
    """

    def build(dealt: DataFrame, window: Window) -> DataFrame:
        n = F.char_length("text").cast("long")
        part = F.floor(F.col("n_chars") / 4).cast("int")
        rows = dealt.withColumn("n_chars", n).withColumn("after", F.lead("text").over(window))
        edited = F.concat(F.substring("text", F.lit(1), F.col("n_chars").cast("int") - part), F.substring("after", F.lit(1), part))
        rows = rows.select("doc_id", "key", "range", "guard", "text", "n_chars", edited.alias("edited"))
        rows = with_signature(rows, "text", "sig")
        rows = with_signature(rows.withColumn("edited", F.when(F.col("guard") == 0, F.col("edited"))), "edited", "edited_sig")
        slim = rows.select("doc_id", "key", "range", "guard", "text", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "sig", "edited_sig")
        return slim.withColumn("next_sig", F.lead("sig").over(window))

    rows = with_neighbour(docs, build)
    return rows.select(
        "doc_id", "n_chars", "edited_sha256", packed(F.col("sig")).alias("fingerprint"), packed(F.col("edited_sig")).alias("edited_fingerprint"),
        likeness(F.col("sig"), F.col("edited_sig")).alias("near_edited"), likeness(F.col("sig"), F.col("next_sig")).alias("near_next"),
    )
