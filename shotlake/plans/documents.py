"""Rows of the stores, built from shots, frames, speech and vectors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shotlake.functions import columns as C


def shot_docs(shots: DataFrame) -> DataFrame:
    """Bounds in ms: rounded half to even, the end exclusive."""
    fps = F.col("fps")
    return shots.select(F.col("shot_id").alias("_id"), "video_id", "shot_id", "start_frame", "end_frame", "fps", C.frame_ms_rounded(F.col("start_frame"), fps).alias("start_ms"), C.frame_ms_rounded(F.col("end_frame") + 1, fps).alias("end_ms"), F.coalesce("transcript", F.lit("")).alias("transcript"))


def segment_docs(segments: DataFrame) -> DataFrame:
    return segments.select(F.col("seg_id").alias("_id"), "video_id", "seg_id", "start_ms", "end_ms", "text")


def frame_docs(keyframes: DataFrame, batch: str) -> DataFrame:
    none = lambda *names: F.struct(*[F.lit(False).alias(n) for n in names])
    return keyframes.select(
        F.col("keyframe_id").alias("_id"), "video_id", "shot_id", "frame_idx", "timestamp_ms", "image_path", F.lit(batch).alias("batch"),
        F.create_map().cast("map<string,double>").alias("objects"), *[F.lit(None).cast("string").alias(c) for c in ("ocr_text", "ocr_api", "caption")],
        none("beit3", "siglip2").alias("embeddings"), none("elastic", "milvus").alias("synced"),
    )


def text_docs(frames: DataFrame, shots: DataFrame) -> DataFrame:
    """Rows of the text index: frames with the transcript of their shot and their tags."""
    from shotlake.operators.joins import frame_transcripts

    t = frame_transcripts(frames, shots)
    return t.select(F.col("_id").alias("frame_id"), "video_id", "shot_id", "frame_idx", "timestamp_ms", "ocr_text", "ocr_api", "caption", "transcript", F.sort_array(F.coalesce(F.map_keys("objects"), F.array())).alias("object_tags"))


def vector_entities(frames: DataFrame, vectors: DataFrame) -> DataFrame:
    """Rows of the vector table, in which every vector must have its frame: vectors(keyframe_id, embedding)."""
    v = vectors.select(F.col("keyframe_id").alias("_id"), "embedding")
    t = v.join(frames.select("_id", "video_id", "frame_idx", "shot_id", "timestamp_ms"), "_id", "left")
    known = F.when(F.col("video_id").isNotNull(), F.col("_id")).otherwise(F.raise_error(F.concat(F.lit("vector without frame: "), F.col("_id"))))
    return t.select(known.alias("frame_id"), "video_id", F.col("frame_idx").cast("bigint").alias("frame_idx"), "shot_id", "timestamp_ms", "embedding")


def video_docs(videos: DataFrame, fps: DataFrame, batch: str) -> DataFrame:
    return videos.join(fps, "video_id", "left").select(F.col("video_id").alias("_id"), F.coalesce("fps", F.lit(30.0)).alias("fps"), F.lit(batch).alias("batch"), "media_info")
