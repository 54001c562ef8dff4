"""Writers. Spark's commit protocol takes the place of temporary files and done markers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def by_video(df: DataFrame, path: str, fmt: str = "json") -> None:
    """One folder a video; folders of videos that are not in df stay (delete by video, then insert)."""
    w = df.repartition("video_id").write.mode("overwrite").partitionBy("video_id").format(fmt)
    w.option("partitionOverwriteMode", "dynamic").save(path)


def append_lines(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


def keyframes(shots: DataFrame, path: str) -> None:
    """Flat keyframe rows of shots(video_id, shot_id, keyframes array<struct>) in order."""
    t = shots.select("video_id", "shot_id", F.posexplode("keyframes").alias("pos", "k")).select("video_id", "shot_id", "pos", "k.*")
    by_video(t.sortWithinPartitions("video_id", "shot_id", "pos"), path, "json")


def vectors(df: DataFrame, path: str) -> None:
    by_video(df, path, "parquet")


def table(df: DataFrame, name: str, key: str = "video_id", buckets: int = 64, batch: str | None = None) -> None:
    """A managed table clustered by key, so that joins on it need no shuffle."""
    w = df.write.mode("overwrite").bucketBy(buckets, key).sortBy(key)
    (w.partitionBy(batch) if batch else w).saveAsTable(name)


def summary_csv(stats: DataFrame, path: str) -> None:
    """Rows of statistics (one a video or group: few), rounded to three places, appended as one file with a header."""
    cols = [F.round(c, 3).alias(c) if t == "double" else F.col(c) for c, t in stats.dtypes]
    stats.select(*cols).coalesce(1).write.mode("append").option("header", True).csv(path)


def samples(frames: DataFrame, path: str, n: int = 20) -> None:
    """The first n frames by id with their texts, as markdown lines."""
    t = frames.orderBy("frame_id").limit(n)
    t.select(F.format_string("## %s\n\n%s\n", F.col("frame_id"), F.coalesce("text", F.lit("")))).write.mode("overwrite").text(path)


def create_stores(spark: SparkSession, schemas: dict[str, str], database: str) -> None:
    """Tables that don't exist are made; others stay."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for name, schema in schemas.items():
        spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{name} ({schema}) USING parquet")


def drop_stores(spark: SparkSession, names: list[str], database: str) -> None:
    for name in names:
        spark.sql(f"DROP TABLE IF EXISTS {database}.{name}")
