"""Queries of the training-data problems, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shotlake.llm import canon, leaks, lines, neighbours, runs, spans, tokens, truncation
from shotlake.sources.tables import table


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return neighbours.near_pairs(table(spark, d, "milvus_entity"), "frame_id", "embedding").select(F.col("a").alias("frame_id_a"), F.col("b").alias("frame_id_b"))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return truncation.truncated(table(spark, d, "frame_doc"), "_id", "batch", "caption").select(F.col("id").alias("frame_id"))


def p2_share(spark: SparkSession, d: str) -> DataFrame:
    return truncation.truncation_share(table(spark, d, "frame_doc"), "_id", "batch", "caption")


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    t = runs.repeated_runs(table(spark, d, "frame_doc"), "video_id", "_id", "timestamp_ms", "ocr_text")
    return t.select(F.col("group").alias("video_id"), F.col("first").alias("first_frame_id"), F.col("n").alias("n_frames"), F.col("duration").alias("duration_ms"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return lines.repeated_lines(table(spark, d, "frame_doc"), "_id", "video_id", "shot_id", "ocr_text").select(F.col("id").alias("frame_id"), "line_no")


def p5_clean(spark: SparkSession, d: str) -> DataFrame:
    return lines.without_repeated(table(spark, d, "frame_doc"), "_id", "video_id", "shot_id", "ocr_text").withColumnRenamed("id", "frame_id")


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    frames, es = table(spark, d, "frame_doc"), table(spark, d, "es_doc")
    return canon.changed_cells(frames, "_id", "ocr_text").unionByName(canon.changed_cells(frames, "_id", "caption")).unionByName(canon.changed_cells(es, "frame_id", "transcript"))


def p6_texts(spark: SparkSession, d: str) -> DataFrame:
    frames, es = table(spark, d, "frame_doc"), table(spark, d, "es_doc")
    return canon.consistent_texts(frames, "_id", ["ocr_text", "caption"]).unionByName(canon.consistent_texts(es, "frame_id", ["transcript"]))


def p7_ids(spark: SparkSession, d: str) -> DataFrame:
    return tokens.token_ids(table(spark, d, "documents"), "doc_id", "text")


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    hits = leaks.leaks(table(spark, d, "documents"), "doc_id", "text", table(spark, d, "eval_items"), "item_id", "text")
    return hits.where("distance = 0").select("doc_id", "item_id")


def p8_near(spark: SparkSession, d: str) -> DataFrame:
    """Leaks at a word put in, left out or replaced, too: doc_id, item_id, distance."""
    return leaks.leaks(table(spark, d, "documents"), "doc_id", "text", table(spark, d, "eval_items"), "item_id", "text")


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return spans.shared_pairs(table(spark, d, "documents"), "doc_id", "text")


def p9_shared(spark: SparkSession, d: str) -> DataFrame:
    return spans.shared_share(table(spark, d, "documents"), "doc_id", "text")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (p1_found, p2_found, p2_share, p3_found, p5_found, p5_clean, p6_found, p6_texts, p7_ids, p8_found, p8_near, p9_found, p9_shared)}


def oracle_sql() -> dict[str, str]:
    return {"p1_found": P1_FOUND, "p6_found": P6_FOUND, "p8_found": P8_FOUND, "p9_found": P9_FOUND, "p9_shared": P9_SHARED}


P1_FOUND = """
WITH v AS (SELECT DISTINCT ON (frame_id) frame_id, CAST(embedding AS DOUBLE[1152]) AS e FROM milvus_entity
           WHERE len(embedding) = 1152 AND list_aggregate(list_transform(embedding, lambda x: CASE WHEN x IS NULL OR isnan(x) OR isinf(x) THEN 1 ELSE 0 END), 'sum') = 0
             AND list_aggregate(list_transform(embedding, lambda x: abs(x)), 'max') > 0),
s AS (SELECT a.frame_id AS a, b.frame_id AS b, array_cosine_similarity(a.e, b.e) AS c FROM v a JOIN v b ON a.frame_id <> b.frame_id),
t AS (SELECT a, b, c, nth_value(c, 5) OVER (PARTITION BY a ORDER BY c DESC ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS k FROM s)
SELECT DISTINCT least(a, b) AS frame_id_a, greatest(a, b) AS frame_id_b FROM t WHERE c >= 0.8 AND (k IS NULL OR c >= k - 0.00001)
"""

_WINDOWS = """WITH g AS (SELECT doc_id, text, unnest(range(1, length(text) - 98)) AS p FROM documents WHERE length(text) >= 100),
h AS (SELECT doc_id, p, substring(text, p, 100) AS s FROM g)"""

P9_FOUND = f"""{_WINDOWS}, d AS (SELECT DISTINCT s, doc_id FROM h), m AS (SELECT s FROM d GROUP BY s HAVING count(*) > 1), e AS (SELECT d.* FROM d JOIN m USING (s))
SELECT DISTINCT a.doc_id AS doc_id_a, b.doc_id AS doc_id_b FROM e a JOIN e b ON a.s = b.s AND a.doc_id < b.doc_id"""

P9_SHARED = f"""{_WINDOWS}, m AS (SELECT s FROM h GROUP BY s HAVING count(DISTINCT doc_id) > 1),
e AS (SELECT doc_id, p, lead(p) OVER (PARTITION BY doc_id ORDER BY p) AS nx FROM h JOIN m USING (s)), c AS (SELECT doc_id, CAST(sum(least(100, coalesce(nx - p, 100))) AS BIGINT) AS n_shared FROM e GROUP BY doc_id)
SELECT t.doc_id, length(text) AS n_chars, coalesce(n_shared, 0) AS n_shared, CASE WHEN length(text) = 0 THEN 0 ELSE coalesce(n_shared, 0) / length(text) END AS share FROM documents t LEFT JOIN c ON t.doc_id = c.doc_id WHERE text IS NOT NULL"""

# A cell is not in consistent form if composing changes it, or if it holds a character that always goes, or a look-alike in a word with a Latin letter.
_ALIKE = "".join(canon.LOOKALIKES)
_EMOJI = "[\\x{1F000}-\\x{1FAFF}\\x{2600}-\\x{27BF}]"
P6_FOUND = f"""WITH c AS (SELECT 'ocr_text' AS field, _id AS frame_id, ocr_text AS t FROM frame_doc UNION ALL SELECT 'caption', _id, caption FROM frame_doc UNION ALL SELECT 'transcript', frame_id, transcript FROM es_doc),
j AS (SELECT *, regexp_replace(regexp_replace(t, '({_EMOJI})\\x{{200D}}({_EMOJI})', '\\1\\2', 'g'), '({_EMOJI})\\x{{200D}}({_EMOJI})', '\\1\\2', 'g') AS joined FROM c WHERE t IS NOT NULL)
SELECT DISTINCT field, frame_id FROM j WHERE nfc_normalize(t) <> t OR regexp_matches(t, '[{"".join(canon.FOREIGN)}]') OR regexp_matches(t, '[\\x{{FF01}}-\\x{{FFEE}}]')
 OR regexp_matches(replace(replace(joined, ' ', ''), chr(10), ''), '[\\p{{Cf}}\\p{{Cc}}\\p{{Z}}]')
 OR regexp_matches(t, '\\p{{Latin}}[\\p{{L}}\\p{{M}}]*[{_ALIKE}]|[{_ALIKE}][\\p{{L}}\\p{{M}}]*\\p{{Latin}}')"""

# Words with look-alikes always replaced: alike on both sides, and no item has a word wholly in another script.
_WIDE, _NARROW = "".join(map(chr, range(0xFF01, 0xFF5F))), "".join(map(chr, range(0x21, 0x7F))).replace("'", "''")
_SWAP = {**canon.LOOKALIKES, **canon.FOREIGN, "đ": "d", "Đ": "D"}


def _folded_sql(t: str) -> str:
    t = f"regexp_replace(translate({t}, '{_WIDE}', '{_NARROW}'), '[\\p{{Cf}}\\x{{00}}-\\x{{08}}\\x{{0E}}-\\x{{1B}}\\x{{7F}}-\\x{{84}}\\x{{86}}-\\x{{9F}}]', '', 'g')"
    t = f"translate(translate({t}, '{"".join(_SWAP)}', '{"".join(_SWAP.values())}'), 'đĐ', 'dD')"
    return f"regexp_extract_all(lower(regexp_replace(strip_accents(nfc_normalize({t})), '\\p{{M}}', '', 'g')), '[\\p{{L}}\\p{{Nd}}]+')"


P8_FOUND = f"""WITH i AS (SELECT item_id, {_folded_sql("text")} AS w FROM eval_items WHERE text IS NOT NULL), d AS (SELECT doc_id, {_folded_sql("text")} AS w FROM documents WHERE text IS NOT NULL),
s AS (SELECT item_id, w, least(10, len(w)) AS n FROM i WHERE len(w) > 0), a AS (SELECT DISTINCT item_id, n, array_to_string(w[k : k + n - 1], ' ') AS g FROM (SELECT item_id, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM s)),
b AS (SELECT DISTINCT doc_id, n, array_to_string(w[k : k + n - 1], ' ') AS g FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM d, (SELECT DISTINCT n FROM a)))
SELECT DISTINCT doc_id, item_id FROM a JOIN b ON a.n = b.n AND a.g = b.g"""
