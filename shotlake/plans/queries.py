"""Queries over the project's tables, by operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shotlake.operators import dyadic
from shotlake.plans import core_queries, operator_queries  # noqa: F401 - the second adds its queries to the first's
from shotlake.sources.tables import table


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    both = None
    for origin in ("shot", "seg"):
        t = table(spark, d, f"{origin}_doc").select(F.lit(origin).alias("origin"), "video_id", "start_ms", "end_ms")
        both = t if both is None else both.unionByName(t)
    return dyadic.periods_and_gaps(both, ["origin", "video_id"], "start_ms", "end_ms", 600_000)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"p4_found": p4_found} | core_queries.QUERIES


def oracle_sql() -> dict[str, str]:
    return {"p4_found": P4_FOUND} | core_queries.SQL


P4_FOUND = """
WITH i AS (SELECT 'shot' AS origin, video_id, start_ms, end_ms FROM shot_doc UNION ALL SELECT 'seg', video_id, start_ms, end_ms FROM seg_doc),
v AS (SELECT DISTINCT * FROM i WHERE end_ms > start_ms),
m AS (SELECT *, max(end_ms) OVER (PARTITION BY origin, video_id ORDER BY start_ms, end_ms ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM v),
g AS (SELECT *, sum(CASE WHEN before IS NULL OR start_ms > before THEN 1 ELSE 0 END) OVER (PARTITION BY origin, video_id ORDER BY start_ms, end_ms) AS n FROM m),
p AS (SELECT origin, video_id, min(start_ms) AS start_ms, max(end_ms) AS end_ms FROM g GROUP BY origin, video_id, n),
l AS (SELECT *, lead(start_ms) OVER (PARTITION BY origin, video_id ORDER BY start_ms) AS nx FROM p)
SELECT origin, video_id, 'period' AS kind, start_ms, end_ms FROM l
UNION ALL SELECT origin, video_id, 'gap', end_ms, nx FROM l WHERE nx - end_ms <= 600000
"""
