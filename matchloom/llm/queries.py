"""The operators' queries with production parameters, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchloom.llm import conversations, fingerprints, html_extract, language, lattice, licenses, line_dedup, mixing, ngram_join, packing, token_io, toxicity, whitening
from matchloom.llm.common import Scratch, table


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited_pairs(table(spark, sf_dir, "documents"))


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.dedup_lines(docs, Scratch(spark, "op3"))


def op4_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice.near_vectors(table(spark, sf_dir, "embeddings"), Scratch(spark, "op4"))


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), Scratch(spark, "op5"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", mixing.word_count(F.col("text")).alias("words"))
    mixed = mixing.mix(docs, F.col("words"), Scratch(spark, "op6"))
    return mixed.select("doc_id", "size", "source_size", F.round("target", 6).alias("target"), (F.col("size") * F.col("rounds")).alias("taken"))


def op7_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return licenses.scan(docs).drop("text", "places")


def op8_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = Scratch(spark, "op8").base
    token_io.write_tokens(table(spark, sf_dir, "documents").select("doc_id", "text"), folder)
    return token_io.with_crc(token_io.read_tokens(spark, folder))


def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.components(table(spark, sf_dir, "documents"), Scratch(spark, "op9"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels"))).drop("text")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repair_damaged(table(spark, sf_dir, "conversations"))


def op12_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language.learn(docs.select("doc_id", "text", "lang"), Scratch(spark, "op12"))
    found = language.predict(docs.select("doc_id", "text"), model)
    return found.select("doc_id", language.is_held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "languages")


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened_components(table(spark, sf_dir, "embeddings"), Scratch(spark, "op13"))


LINE_DEDUP = """
WITH lines AS (SELECT doc_id, string_split(text, chr(10)) AS parts, unnest(range(1, len(parts) + 1)) AS i, parts[i] AS line FROM documents WHERE text IS NOT NULL),
filled AS (SELECT *, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS j FROM lines WHERE trim(line, ' ' || chr(9) || chr(10) || chr(13)) <> ''),
spans AS (
  SELECT doc_id, i AS a, j AS b, array_to_string(parts[i:j], chr(10)) AS body FROM filled WHERE j IS NOT NULL
  UNION ALL SELECT doc_id, i, i, line FROM filled WHERE len(regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+')) > 50),
firsts AS (SELECT *, min(doc_id) OVER (PARTITION BY body) AS first_doc, min(b) OVER (PARTITION BY body, doc_id) AS first_end FROM spans),
gone AS (SELECT DISTINCT doc_id, unnest(range(a, b + 1)) AS i FROM firsts WHERE first_doc < doc_id OR first_end < a),
kept AS (SELECT l.doc_id, coalesce(string_agg(line, chr(10) ORDER BY l.i) FILTER (g.i IS NULL), '') AS text, count(g.i) AS n_removed FROM lines l LEFT JOIN gone g ON g.doc_id = l.doc_id AND g.i = l.i GROUP BY 1)
SELECT d.doc_id, kept.text, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed FROM documents d LEFT JOIN kept USING (doc_id)"""

MIXING = """
WITH sized AS (SELECT doc_id, coalesce('s' || source, 't') AS s, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size, md5('mix:' || coalesce(doc_id::VARCHAR, 'null')) AS k FROM documents),
sources AS (SELECT s, CAST(sum(size) AS BIGINT) AS source_size, CAST([5, 2, 1][(row_number() OVER (ORDER BY s) - 1) % 3 + 1] AS DOUBLE) AS w FROM sized GROUP BY s),
level AS (SELECT *, source_size * 3 AS cap, source_size * 3 / w AS r FROM sources),
water AS (SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER b, 0)) / (sum(w) OVER () - coalesce(sum(w) OVER b, 0)) AS l FROM level WINDOW b AS (ORDER BY r, s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
goal AS (SELECT s, source_size, least(CAST(cap AS DOUBLE), coalesce((SELECT arg_min(l, (r, s)) FROM water WHERE cap > l * w) * w, CAST(cap AS DOUBLE))) AS target FROM water),
lined AS (SELECT z.*, sum(size) OVER (PARTITION BY s ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum FROM sized z WHERE size > 0),
turns AS (SELECT l.doc_id, l.s, l.k, l.size, (CAST(cum AS BIGINT) + i * source_size) / target AS f FROM lined l JOIN goal USING (s), (SELECT unnest([0, 1, 2]) AS i)),
used AS (SELECT *, sum(size) OVER (ORDER BY f, k, s ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS used FROM turns),
taken AS (SELECT doc_id, CAST(sum(size) AS BIGINT) AS taken FROM used WHERE used <= (SELECT sum(source_size) FROM goal) GROUP BY doc_id)
SELECT z.doc_id, z.size, g.source_size, round(g.target, 6) AS target, coalesce(t.taken, 0) AS taken FROM sized z JOIN goal g USING (s) LEFT JOIN taken t USING (doc_id)"""

# a conversation's turns one after the other, with the best (cost, script, turns made) of each state
REPAIR = """
WITH RECURSIVE bits AS (SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS tab),
keyed AS (SELECT *, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k FROM conversations),
drawn AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
  xor(list_reduce(list_prepend(4294967295, list_transform(string_split(k, ''), lambda c: CAST(ascii(c) AS BIGINT))), lambda c, b: xor(c // 256, tab[xor(c, b) % 256 + 1])), 4294967295) % 20 AS draw FROM keyed, bits),
hurt AS (SELECT conv_id, turn, CASE draw WHEN 4 THEN 'user' ELSE role END AS role, CASE draw WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
  unnest(CASE draw WHEN 3 THEN [0, 1] ELSE [0] END) AS copy FROM drawn WHERE draw <> 0),
lined AS (SELECT *, row_number() OVER w AS i, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS nth, lag(left(role, 1)) OVER w || left(role, 1) AS pair
  FROM hurt WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy)),
faults AS (SELECT *, CASE WHEN NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') THEN 'b' WHEN nth > 1 THEN 'd' WHEN NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*$') THEN 't' ELSE '' END AS fault FROM lined),
steps AS (SELECT unnest(['.s', '.u', 'su', 'au', 'ua']) AS pair),
nexts AS (SELECT unnest(['.', 's', 'a', 'u']) AS st, unnest(['u', 'u', 'u', 'a']) AS nx),
edits AS (
  SELECT st, NULL AS c, st AS t, 4 AS cost, 'D' AS edit, '' AS put FROM nexts
  UNION ALL SELECT pair[1], pair[2], pair[2], 0, 'K', '' FROM steps
  UNION ALL SELECT st, NULL, nx, 3, 'R', '' FROM nexts
  UNION ALL SELECT st, pair[2], pair[2], 3, 'IK', nx FROM nexts JOIN steps ON pair[1] = nx
  UNION ALL SELECT a.st, NULL, b.nx, 6, 'IR', a.nx FROM nexts a JOIN nexts b ON b.st = a.nx),
dp AS (
  SELECT DISTINCT coalesce(conv_id::VARCHAR, 'null') AS conv, CAST(0 AS BIGINT) AS i, '.' AS st, {'c': 0, 'a': '', 'r': CAST([] AS VARCHAR[])} AS best FROM conversations
  UNION ALL
  SELECT conv, d.i + 1, e.t, min({'c': best.c + e.cost + CASE WHEN fault = 't' AND edit <> 'D' THEN 3 ELSE 0 END, 'a': best.a || edit,
    'r': list_concat(best.r, CASE put WHEN 'u' THEN ['user:'] WHEN 'a' THEN ['assistant:'] ELSE [] END,
      CASE right(edit, 1) WHEN 'D' THEN [] WHEN 'K' THEN [role || ':' || text] ELSE [CASE e.t WHEN 'u' THEN 'user:' ELSE 'assistant:' END || text] END)})
  FROM dp d JOIN faults f ON coalesce(f.conv_id::VARCHAR, 'null') = conv AND f.i = d.i + 1 JOIN edits e ON e.st = d.st AND (e.c IS NULL OR e.c = left(role, 1)) AND (edit = 'D' OR fault NOT IN ('b', 'd'))
  GROUP BY conv, d.i, e.t),
ends AS (SELECT conv, min({'c': best.c + CASE st WHEN 'u' THEN 3 WHEN 's' THEN 6 ELSE 0 END, 'a': best.a || CASE st WHEN 'u' THEN 'I' WHEN 's' THEN 'II' ELSE '' END,
    'r': list_concat(best.r, CASE st WHEN 'u' THEN ['assistant:'] WHEN 's' THEN ['user:', 'assistant:'] ELSE [] END)}) AS best
  FROM dp d WHERE i = (SELECT count(*) FROM hurt h WHERE coalesce(h.conv_id::VARCHAR, 'null') = d.conv) GROUP BY conv),
told AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated,
  count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal FROM faults GROUP BY conv_id)
SELECT c.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank, CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate, CAST(coalesce(truncated, 0) AS BIGINT) AS truncated,
  CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, CAST(best.c AS BIGINT) AS cost, best.a AS audit, sha256(array_to_string(best.r, chr(10))) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN told ON told.conv_id IS NOT DISTINCT FROM c.conv_id JOIN ends ON ends.conv = coalesce(c.conv_id::VARCHAR, 'null')"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_fingerprints": op1_fingerprints,
    "op2_html_extraction": op2_html_extraction,
    "op3_line_dedup": op3_line_dedup,
    "op4_embedding_near_dedup": op4_embedding_near_dedup,
    "op5_best_fit_packing": op5_best_fit_packing,
    "op6_mixing": op6_mixing,
    "op7_license_scans": op7_license_scans,
    "op8_token_output": op8_token_output,
    "op9_ngram_join": op9_ngram_join,
    "op10_toxicity": op10_toxicity,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_language_id": op12_language_id,
    "op13_embedding_whitening": op13_embedding_whitening,
}
ORACLES: dict[str, str] = {"op3_line_dedup": LINE_DEDUP, "op6_mixing": MIXING, "op7_license_scans": licenses.oracle(), "op11_conversation_repair": REPAIR}
