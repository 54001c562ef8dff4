"""Upserts, sparse updates and resumable work, as set algebra on keyed tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def replace_rows(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """New rows replace old ones of their key as a whole."""
    return old.join(new.select(*keys), keys, "left_anti").unionByName(new)


def insert_absent(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Old rows stay; new ones come in where their key is new."""
    return old.unionByName(new.join(old.select(*keys), keys, "left_anti"))


def enrich_rows(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """New values that are not null go over old ones ('' does, null doesn't); new keys come in."""
    cols = [c for c in old.columns if c not in keys]
    n = new.select(*keys, *[F.col(c).alias(f"__{c}") for c in cols if c in new.columns])
    t = old.join(n, keys, "full")
    return t.select(*keys, *[F.coalesce(F.col(f"__{c}"), F.col(c)).alias(c) if c in new.columns else F.col(c) for c in cols])


def set_status(status: DataFrame, videos: DataFrame, step: str, state: str) -> DataFrame:
    """status(video_id, steps map<string, struct<status, updated_at>>) with the step's entry set for each of videos."""
    v = videos.select("video_id").distinct().withColumn("__new", F.lit(True))
    entry = F.create_map(F.lit(step), F.struct(F.lit(state).alias("status"), F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ssXXX").alias("updated_at")))
    t = status.join(v, "video_id", "full")
    rest = F.map_filter("steps", lambda k, _v: k != step)
    steps = F.when(F.col("__new"), F.coalesce(F.map_concat(rest, entry), entry)).otherwise(F.col("steps"))
    return t.select("video_id", steps.alias("steps"))


def not_done(work: DataFrame, status: DataFrame, step: str) -> DataFrame:
    """Work whose step isn't done."""
    return work.join(status.where(F.col("steps")[step]["status"] == "done").select("video_id"), "video_id", "left_anti")


def mark_synced(frames: DataFrame, written: DataFrame, store: str) -> DataFrame:
    """frames with synced.<store> true where the sink has the frame."""
    w = written.select(F.col("frame_id").alias("__w")).distinct()
    t = frames.join(w, F.col("_id") == F.col("__w"), "left")
    return t.withColumn("synced", F.when(F.col("__w").isNotNull(), F.col("synced").withField(store, F.lit(True))).otherwise(F.col("synced"))).drop("__w")


def purge(tables: dict[str, DataFrame], videos: DataFrame) -> dict[str, DataFrame]:
    """Each table without the rows of the videos."""
    return {name: t.join(videos.select("video_id"), "video_id", "left_anti") for name, t in tables.items()}


def merged_shards(shards: list[DataFrame], expected: DataFrame, key: str, force: bool = False) -> DataFrame:
    """All shards as one table; refused while an expected key is missing, unless forced."""
    out = shards[0]
    for s in shards[1:]:
        out = out.unionByName(s)
    if not force:
        missing = expected.join(out.select(key), key, "left_anti").limit(5).collect()
        if missing:
            raise ValueError(f"shards are incomplete, e.g. {[r[key] for r in missing]} missing")
    return out
