"""Checks of artifacts and identifiers: rows that break a rule, with the rule's name."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shotlake.functions import columns as C


def vector_faults(df: DataFrame, key: str, vector: str, dim: int, tolerance: float = 1e-4) -> DataFrame:
    """key, fault of vectors with the wrong shape, a value that isn't finite, a length off 1, or a key that isn't unique."""
    finite = ~F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    fault = F.when(F.col(vector).isNull() | (F.size(vector) != dim), "shape").when(~finite, "not finite").when(F.abs(C.norm(F.col(vector)) - 1) > tolerance, "norm")
    bad = df.select(key, fault.alias("fault")).where("fault is not null")
    return bad.unionByName(duplicates(df, [key]).select(key, F.lit("duplicate").alias("fault")))


def duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def keyframe_faults(df: DataFrame) -> DataFrame:
    """keyframe_id, fault: duplicates, ids of another video, ids that can't be file names."""
    fault = F.when(F.col("keyframe_id").rlike("[/\\\\]|^\\.*$"), "path").when(~F.coalesce(F.col("keyframe_id").startswith(F.col("video_id")) & ~F.substring("keyframe_id", F.length("video_id") + 1, F.lit(1)).rlike("[\\p{L}\\p{N}]"), F.lit(False)), "video")
    bad = df.select("keyframe_id", fault.alias("fault")).where("fault is not null")
    return bad.unionByName(duplicates(df, ["keyframe_id"]).select("keyframe_id", F.lit("duplicate").alias("fault")))


def not_blank(lap_var: Column, mean: Column, least_var: float = 15, dark: float = 15, bright: float = 240) -> Column:
    """False for flat frames that are black or white."""
    return ~((lap_var < least_var) & ((mean < dark) | (mean > bright)))


def unless_blurred(lap_var: Column, texts: Column, least: float = 50) -> Column:
    """The texts, none for a blurred frame; the row stays."""
    return F.when(lap_var < least, F.array().cast("array<string>")).otherwise(texts)


def refuse_existing(df: DataFrame, path: str, overwrite: bool = False) -> None:
    """Writes a table; an existing one is an error unless it may be overwritten."""
    df.write.mode("overwrite" if overwrite else "errorifexists").parquet(path)


def readable(df: DataFrame, status: str = "decoded") -> DataFrame:
    """Frames or videos that the decoder could read."""
    return df.where(F.coalesce(F.col(status), F.lit(False)))


def has_text(df: DataFrame, text: str) -> DataFrame:
    return df.where(F.length(text) > 0)


def label_fits(label: Column, longest: int, charset: str | None = None) -> Column:
    """False for labels that are too long as given, or empty once the character set (if any) is applied."""
    left = label if charset is None else C.adapt_charset(label, charset)
    return (F.length(label) <= longest) & (F.length(F.trim(left)) > 0)
