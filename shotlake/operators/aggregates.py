"""Aggregations of frames, detections, recognised text and quality figures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CONFIDENT = 0.5


def max_confidence(detections: DataFrame, least: float = CONFIDENT) -> DataFrame:
    """frame_id, objects: the highest confidence of each label; detections(frame_id, objects array<label, confidence>).

    Frames without a confident label are dropped.
    """
    t = detections.select("frame_id", F.explode(F.filter("objects", lambda x: x["confidence"] >= least)).alias("o"))
    t = t.groupBy("frame_id", "o.label").agg(F.max("o.confidence").alias("c"))
    return t.groupBy("frame_id").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("label", "c")))).alias("objects"))


def confident_text(records: DataFrame, least: float = CONFIDENT) -> DataFrame:
    """frame_id, text: the confident lines of a record in their order; records(frame_id, texts array<text, confidence, box>)."""
    keep = F.filter("texts", lambda x: x["confidence"] >= least)
    return records.select("frame_id", F.array_join(F.transform(keep, lambda x: x["text"]), " ").alias("text"))


def derive_fps(keyframes: DataFrame, pos: str, default: float = 30.0) -> DataFrame:
    """video_id, fps: from the first keyframe (by ``pos``) with an index and a time above 0."""
    good = (F.col("frame_idx") > 0) & (F.col("timestamp_ms") > 0)
    fps = F.min_by(F.when(good, F.col("frame_idx") / (F.col("timestamp_ms") / 1000)), F.when(good, F.col(pos)))
    return keyframes.groupBy("video_id").agg(F.coalesce(fps, F.lit(default)).alias("fps"))


def keyframe_stats(keyframes: DataFrame) -> DataFrame:
    """video_id, n_keyframes, n_shots, per_shot, and bytes where keyframes have their files' length."""
    size = [F.sum("length").alias("bytes")] if "length" in keyframes.columns else []
    t = keyframes.groupBy("video_id").agg(F.count("*").alias("n_keyframes"), F.count_distinct("shot_id").alias("n_shots"), *size)
    return t.withColumn("per_shot", F.try_divide(F.col("n_keyframes"), F.col("n_shots")))


def diversity(vectors: DataFrame, group: str, vector: str) -> DataFrame:
    """group, n, diversity = max(0, 1 - mean cosine of all pairs), 1 for fewer than two vectors.

    From the sum of the unit vectors, dimension by dimension: no pairs are formed.
    """
    t = vectors.where(F.col(vector).isNotNull()).select(group, F.posexplode(vector).alias("d", "x"))
    t = t.groupBy(group, "d").agg(F.sum(F.col("x").cast("double")).alias("s"), F.sum(F.col("x").cast("double") ** 2).alias("q"), F.count("*").alias("n"))
    t = t.groupBy(group).agg(F.sum(F.col("s") ** 2).alias("ss"), F.sum("q").alias("q"), F.max("n").alias("n"))
    mean = (F.col("ss") - F.col("q")) / (F.col("n") * (F.col("n") - 1))
    return t.select(group, "n", F.when(F.col("n") <= 1, F.lit(1.0)).otherwise(F.greatest(F.lit(0.0), 1 - mean)).alias("diversity"))


def coverage(shots: DataFrame, keyframes: DataFrame, seconds: float = 2.0) -> DataFrame:
    """shot_id, coverage: share of a shot's frames within half a window of ``seconds`` of a keyframe.

    The windows are merged as intervals in order, so no frame is counted out.
    """
    k = keyframes.select("shot_id", "frame_idx").distinct().join(shots.select("shot_id", "start_frame", "end_frame", "fps"), "shot_id")
    half = F.floor(F.floor(F.lit(seconds) * F.col("fps")) / 2)
    total = F.col("end_frame") - F.col("start_frame")
    k = k.select("shot_id", F.greatest(F.lit(0), F.col("frame_idx") - F.col("start_frame") - half).alias("a"), F.least(total, F.col("frame_idx") - F.col("start_frame") + half).alias("z")).where("a <= z")
    w = Window.partitionBy("shot_id").orderBy("a", "z").rowsBetween(Window.unboundedPreceding, -1)
    k = k.withColumn("seen", F.coalesce(F.max("z").over(w), F.lit(-1))).select("shot_id", F.greatest(F.lit(0), F.col("z") - F.greatest("a", F.col("seen") + 1) + 1).alias("n"))
    c = k.groupBy("shot_id").agg(F.sum("n").alias("n"))
    t = shots.select("shot_id", (total + 1).alias("total")).join(c, "shot_id", "left")
    return t.select("shot_id", F.coalesce(F.try_divide(F.col("n"), F.col("total")), F.lit(0.0)).alias("coverage"))


def match_quality(matches: DataFrame, predicted: DataFrame, truth: DataFrame, group: str) -> DataFrame:
    """group, tp, fp, fn, precision, recall, f1, mean_sim of one-to-one matches(group, sim)."""
    n = lambda df, c: df.groupBy(group).agg(F.count("*").alias(c))
    t = n(predicted, "n_pred").join(n(truth, "n_true"), group, "full").join(matches.groupBy(group).agg(F.count("*").alias("tp"), F.avg("sim").alias("mean_sim")), group, "left")
    t = t.fillna(0, ["n_pred", "n_true", "tp"]).fillna(0.0, ["mean_sim"])
    ratio = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    t = t.withColumns({"fp": F.col("n_pred") - F.col("tp"), "fn": F.col("n_true") - F.col("tp"), "precision": ratio(F.col("tp"), F.col("n_pred")), "recall": ratio(F.col("tp"), F.col("n_true"))})
    t = t.withColumn("f1", ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")))
    return t.select(group, "tp", "fp", "fn", "precision", "recall", "f1", "mean_sim")


def recogniser_scores(results: DataFrame) -> DataFrame:
    """n, accuracy, mean of 1 - normalised edit distance, mean confidence of results(pred, truth, confidence, loss, weight)."""
    from shotlake.functions.columns import normalised_edit_distance

    ned = 1 - normalised_edit_distance(F.col("pred"), F.col("truth"))
    return results.agg(F.count("*").alias("n"), F.avg((F.col("pred") == F.col("truth")).cast("double")).alias("accuracy"), F.avg(ned).alias("ned"), F.avg("confidence").alias("confidence"), F.try_divide(F.sum(F.col("loss") * F.col("weight")), F.sum("weight")).alias("loss"))


def colour_histogram(pixels: DataFrame, group: str) -> DataFrame:
    """group, bin, weight: 512 bins of three bits a channel, at unit length; pixels(group, r, g, b)."""
    b = F.shiftright("r", 5) * 64 + F.shiftright("g", 5) * 8 + F.shiftright("b", 5)
    t = pixels.groupBy(group, b.alias("bin")).agg(F.count("*").alias("n"))
    total = F.sqrt(F.sum(F.col("n") * F.col("n")).over(Window.partitionBy(group)))
    return t.select(group, "bin", (F.col("n") / total).alias("weight"))


def line_confidence(words: DataFrame) -> DataFrame:
    """frame_id, line, confidence: mean of a line's words, four places, half to even."""
    return words.groupBy("frame_id", "line").agg(F.bround(F.avg("confidence"), 4).alias("confidence"))


def sequence_confidence(p: Column) -> Column:
    """Product of an array of probabilities."""
    return F.aggregate(p, F.lit(1.0), lambda a, x: a * x)


def group_count(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n"))


def done_videos(status: DataFrame, step: str, first: int = 5) -> DataFrame:
    """The first videos, by name, whose step is done."""
    return status.where(F.col("steps")[step]["status"] == "done").select("video_id").orderBy("video_id").limit(first)
