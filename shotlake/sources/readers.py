"""Scans of files: videos, images, JSON lines, vectors."""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shotlake.functions import columns as C
from shotlake.sources.tables import missing

# Endings of video and image files.
VIDEO_ENDINGS = ("mp4", "avi", "mov", "mkv")
IMAGE_ENDINGS = ("jpg", "jpeg", "png", "webp", "bmp")

SHOTS = "video_id string, shot_id string, start_frame int, end_frame int, fps double"
SEGMENTS = "video_id string, seg_id string, start_ms bigint, end_ms bigint, text string, confidence double"
KEYFRAMES = "video_id string, shot_id string, keyframe_id string, frame_idx int, timestamp_ms bigint, image_path string, pts_ms bigint"
TRANSCRIPTS = "video_id string, shot_id string, text string"
OCR_RECORDS = "frame_id string, texts array<struct<text: string, confidence: double, box: array<int>>>"
RESPONSES = "frame_id string, path string, text string, finish string, model string"
DETECTIONS = "frame_id string, objects array<struct<label: string, confidence: double>>"


def files(spark: SparkSession, folder: str, endings: tuple[str, ...], recursive: bool = False) -> DataFrame:
    """path, name, stem, parent, length of files with an ending in either case; their contents aren't read."""
    both = ",".join(x for e in endings for x in (e, e.upper()))
    r = spark.read.format("binaryFile").option("pathGlobFilter", f"*.{{{both}}}").option("recursiveFileLookup", str(recursive).lower())
    t = r.load(folder).select("path", "length").withColumn("name", F.element_at(F.split("path", "/"), -1))
    return t.withColumn("stem", F.regexp_replace("name", "\\.[^.]*$", "")).withColumn("parent", F.element_at(F.split("path", "/"), -2))


def videos(spark: SparkSession, folder: str) -> DataFrame:
    """name of the videos in a folder, in order."""
    return files(spark, folder, VIDEO_ENDINGS).select("name", "path").orderBy("name")


def discover_videos(spark: SparkSession, folder: str, allow: list[str] | None = None) -> DataFrame:
    """video_id, path: subfolders where the folder holds metadata.json, else the videos below it; of an allow-list if given."""
    try:
        spark.read.text(f"{folder}/metadata.json").limit(1).count()
        t = files(spark, folder, IMAGE_ENDINGS, True).select(F.col("parent").alias("video_id"), F.regexp_replace("path", "/[^/]*$", "").alias("path")).distinct()
    except AnalysisException as e:
        if not missing(e):
            raise
        t = files(spark, folder, ("mp4", "mov"), True).select(F.col("stem").alias("video_id"), "path")
    return t.where(F.col("video_id").isin(allow)) if allow else t


def images(spark: SparkSession, folder: str) -> DataFrame:
    """frame_id, path of images below a folder: the stem, after the parent's name unless it begins with it."""
    t = files(spark, folder, IMAGE_ENDINGS, True)
    return t.select(F.when(F.startswith("stem", "parent"), F.col("stem")).otherwise(F.concat_ws("_", "parent", "stem")).alias("frame_id"), "path").orderBy("frame_id")


def dataset(spark: SparkSession, folder: str) -> DataFrame:
    """video_id, keyframe_id, path of valid video folders, in natural order; an error if there is none."""
    t = files(spark, folder, IMAGE_ENDINGS, True).where(C.is_video_name(F.col("parent")))
    t = t.select(F.col("parent").alias("video_id"), F.col("stem").alias("keyframe_id"), "path")
    if t.isEmpty():
        raise ValueError(f"no video folder in {folder}")
    return t.orderBy(C.natural_key(F.col("video_id")), C.natural_key(F.col("keyframe_id")))


def json_lines(spark: SparkSession, path: str | list[str], schema: str) -> DataFrame:
    """One JSON object a line; lines that aren't are dropped."""
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)


def with_place(spark: SparkSession, path: str | list[str], schema: str) -> DataFrame:
    """``json_lines`` with ``pos`` = (file, offset of its block, line in the block): the order of lines in files, the same at every run."""
    t = spark.read.schema(schema + ", __bad string").option("columnNameOfCorruptRecord", "__bad").json(path)
    order = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("line"))
    return t.select("*", order.alias("pos")).where("__bad is null").drop("__bad")


def json_array(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("multiLine", True).json(path)


def shots(spark: SparkSession, folder: str, video: str) -> DataFrame:
    """Shots of a video from the first of its four possible files; ids that are missing or numbers become S%04d."""
    for name in (f"{video}/shots.json", f"{video}/shot.jsonl", f"{video}.json", f"{video}.jsonl"):
        try:
            t = spark.read.schema(SHOTS).option("multiLine", name.endswith(".json")).json(f"{folder}/{name}")
        except AnalysisException as e:
            if missing(e):  # the next file is tried
                continue
            raise
        return normalise_shots(t, video)
    raise FileNotFoundError(f"no shots of {video} in {folder}")


def normalise_shots(t: DataFrame, video: str) -> DataFrame:
    from pyspark.sql import Window

    no = F.row_number().over(Window.partitionBy("video_id").orderBy("start_frame", "end_frame"))
    t = t.withColumn("video_id", F.coalesce("video_id", F.lit(video)))
    given = F.when(F.col("shot_id").rlike("^\\d+$"), F.format_string("S%04d", F.col("shot_id").try_cast("int"))).otherwise(F.col("shot_id"))
    return t.withColumn("shot_id", F.coalesce(given, F.format_string("S%04d", no))).withColumn("fps", F.coalesce("fps", F.lit(25.0)))


def sparse_frames(frames: DataFrame, metadata: DataFrame, start: int, end: int) -> DataFrame:
    """Images of a sparse folder in a range of frame ids: frames(video_id, name, path), metadata(video_id, name, id, fps)."""
    return frames.join(metadata, ["video_id", "name"]).where(F.col("id").between(start, end)).orderBy("id")


def vectors(spark: SparkSession, folder: str) -> DataFrame:
    """keyframe_id, embedding of <video>.npy matrices with their <video>_ids.json; a length that differs is an error."""
    ids = spark.read.option("wholetext", True).text(f"{folder}/*_ids.json").select(F.regexp_extract(F.input_file_name(), "([^/]+)_ids\\.json$", 1).alias("video"), F.from_json("value", "array<string>").alias("ids"))
    npy = spark.read.format("binaryFile").option("pathGlobFilter", "*.npy").load(folder).select(F.regexp_extract("path", "([^/]+)\\.npy$", 1).alias("video"), "content")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for video, content, names in zip(b["video"], b["content"], b["ids"]):
                m = np.load(io.BytesIO(content)).astype(np.float32)
                if len(m) != len(names):
                    raise ValueError(f"{video}: {len(m)} vectors, {len(names)} ids")
                yield pd.DataFrame({"keyframe_id": list(names), "embedding": list(m)})

    return npy.join(ids, "video").mapInPandas(run, "keyframe_id string, embedding array<float>")


def truth_images(spark: SparkSession, root: str, video: str) -> DataFrame:
    """Ground-truth images of a video, directly below the root or one folder deeper; the direct one goes first."""
    t = files(spark, root, IMAGE_ENDINGS, True).where(F.col("parent") == video).withColumn("depth", F.size(F.split("path", "/")))
    least = t.agg(F.min("depth").alias("least"))
    return t.join(F.broadcast(least), F.col("depth") == F.col("least")).select("name", "path")


def job_list(frames: DataFrame, done: DataFrame | None = None, bad: DataFrame | None = None, only: DataFrame | None = None) -> DataFrame:
    """Frames of completed folders (``only``), without done and bad ones."""
    t = frames if only is None else frames.join(only.select("video_id"), "video_id", "left_semi")
    for d in (done, bad):
        if d is not None:
            t = t.join(d.select("frame_id"), "frame_id", "left_anti")
    return t
