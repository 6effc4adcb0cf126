"""Line dedup by content-defined chunks of lines, cut to the edges of repeated passages.

Every line with words is hashed, and a rolling hash of two neighbours runs over the line hashes. A
boundary stands between two neighbours whose rolling hash occurs nowhere before, in no earlier
document and at no earlier place of the same text; it depends on these two lines alone, so it does
not shift with what is put before them. A chunk between boundaries that has two lines or more is
covered by windows of two lines that each stood somewhere before: a repeated passage, from its first
line to its last, or several that overlap (after "A B" and "B C", all of "A B C" goes).
(Boundaries at hashes of a fixed remainder would leave the ends of most passages, and short passages
as a whole.)
A line of more than ``LONG`` words is a chunk by itself.

Rolling hashes are counted over the corpus; the texts of those that repeat are then compared by
their bytes before anything goes. Places are those of the texts as given, so every line that goes
has a copy at an earlier place. Shorter lines that repeat alone stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchloom.llm.common import Scratch, let, quoted, unused

LONG = 50
MANY_WORDS = "^[\\x20\\x09-\\x0D]*+(?:[^\\x20\\x09-\\x0D]++[\\x20\\x09-\\x0D]++){%d}[^\\x20\\x09-\\x0D]" % LONG


def windows(lines: Column) -> Column:
    """array of (mark, begin, end): rolling hashes of neighbouring lines with words, and of long lines, with their places.

    Blank lines between two neighbours belong to the window. A mark is that of all its lines' hashes.
    """

    return let(lines, _windows)


def _windows(lines: Column) -> Column:
    def spans(kept: Column, hashes: Column) -> Column:
        def window(begin: Column, end: Column) -> Column:
            return F.struct(F.xxhash64(F.slice(hashes, begin + 1, end - begin + 1)).alias("mark"), begin.alias("begin"), end.alias("end"))

        last = F.size(kept) - 1
        pairs = F.transform(F.slice(kept, 1, F.greatest(last, F.lit(0))), lambda i, k: window(i, F.get(kept, k + 1)))
        # a line of n words has 2n - 1 characters at least
        large = F.filter(kept, lambda i: (F.octet_length(F.get(lines, i)) > 2 * LONG) & F.regexp_like(F.get(lines, i), F.lit(MANY_WORDS)))
        return F.concat(pairs, F.transform(large, lambda i: window(i, i)))

    full = F.filter(F.sequence(F.lit(0), F.size(lines) - 1), lambda i: F.btrim(F.get(lines, i), F.lit(" \t\r\n")) != "")
    return let(full, lambda kept: let(F.transform(lines, lambda x: F.xxhash64(x)), lambda hashes: spans(kept, hashes)))


def repeated(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """(doc, made, spans): the windows of each text that have a copy at an earlier place, byte for byte.

    docs: (doc, made, text), made being a hash of the text, so that texts under one doc are told
    apart. An earlier place is one in a lesser doc, or one that ends before in the same text.
    """
    lines = F.split("text", "\n")
    marked = scratch.save(docs.select("doc", "made", F.inline(windows(lines))), "marks")
    several = scratch.save(marked.groupBy("mark").agg(F.count("*").alias("n")).where("n > 1").select("mark"), "several")
    # written first on both sides, so that a mark of very many places is dealt to several tasks
    places = scratch.save(marked.join(several, "mark"), "places")
    wanted = places.groupBy("doc", "made").agg(F.collect_set(F.struct("mark", "begin", "end")).alias("at"))
    body = lambda x, w: F.array_join(F.slice(x, w["begin"] + 1, w["end"] - w["begin"] + 1), "\n")
    shown = let(lines, lambda x: F.transform("at", lambda w: F.struct(w["mark"].alias("mark"), body(x, w).alias("body"))))
    # merged at every size: what is few rows of a small corpus is no broadcast for a large one
    bodies = docs.join(wanted.hint("merge"), ["doc", "made"]).select("doc", F.inline(shown))
    # grouping by the body beside its mark is the comparison of bytes; equal ones meet in each task first
    same = bodies.groupBy("mark", "body").agg(F.min("doc").alias("first"))
    # a mark that two different bodies share (never seen) names no body, so nothing is removed by it
    sure = scratch.save(same.groupBy("mark").agg(F.count("*").alias("n"), F.min("first").alias("first")).where("n = 1").select("mark", "first"), "sure")
    # all of a text's places meet in one task, which both groupings below share
    met = places.join(sure, "mark").repartition("doc", "made")
    own = met.groupBy("doc", "made", "mark", "first").agg(F.collect_set(F.struct("begin", "end")).alias("at"), F.min_by("end", "begin").alias("own"))
    gone = F.when(F.col("doc") > F.col("first"), F.col("at")).otherwise(F.filter("at", lambda w: w["begin"] > F.col("own")))
    lost = own.select("doc", "made", gone.alias("gone")).where(F.size("gone") > 0).groupBy("doc", "made").agg(F.flatten(F.collect_list("gone")).alias("spans"))
    out = scratch.save(lost, "lost")
    scratch.drop("marks", "several", "places", "sure")
    return out


def dedup_lines(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """docs with repeated passages cut out of ``text``, and n_removed, the lines removed.

    Only ``text`` changes; every row stays, also one whose text becomes ''. Other columns stay,
    whatever their names, but for one named n_removed, which is replaced. Null texts stay null with
    0 removed. Rows are told apart by doc_id: repeated rows with the same doc_id and text keep or
    lose the same lines; a null doc_id counts as the least. Blank lines go only between lines of a
    passage. An empty table gives an empty result. The cost of a text grows with its lines, not with their square.
    """
    keep = [c for c in docs.columns if c != "n_removed"]
    id_, made, spans, lines, left = unused(docs, "doc", "made", "spans", "lines", "left")
    doc, hashed = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))), F.xxhash64("text")
    lost = repeated(docs.select(doc.alias("doc"), hashed.alias("made"), "text"), scratch).withColumnsRenamed({"doc": id_, "made": made, "spans": spans})
    rows = docs.select(*quoted(*keep), doc.alias(id_), hashed.alias(made)).join(lost.hint("merge"), [id_, made], "left")
    rows = rows.withColumn(lines, F.when(F.col(spans).isNotNull(), F.split("text", "\n")))
    gone = F.array_distinct(F.flatten(F.transform(spans, lambda w: F.sequence(w["begin"], w["end"]))))
    stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), gone)
    rows = rows.withColumn(left, F.when(F.col(lines).isNotNull(), F.transform(stay, lambda i: F.get(lines, i))))
    text = F.when(F.col(left).isNotNull(), F.array_join(left, "\n")).otherwise(F.col("text"))
    removed = F.when(F.col(left).isNotNull(), F.size(lines) - F.size(left)).otherwise(0).cast("long")
    return rows.select(*[(text.alias("text") if c == "text" else quoted(c)[0]) for c in keep], removed.alias("n_removed"))
