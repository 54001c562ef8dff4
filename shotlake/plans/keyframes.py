"""Keyframes of a video from its frames' figures.

Candidates are chosen by window functions in the JVM: steep changes, peaks, anchors in gaps, changes of
text. What depends on earlier choices (semantic and diversity filters, whose outcome of one window is the
history of the next) is one fold a video. The frames' figures are columns of the input: jpeg_size,
brightness, lap_var, sign, embedding.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shotlake.functions import columns as C
from shotlake.operators import checks, joins, selection, sequence


@dataclass(frozen=True)
class Settings:
    """Defaults of the parameters."""

    ratio: float = 0.05
    similarity: float = 0.90
    redundancy: float = 0.88
    gap: int = 5
    most: int = 300
    window: int = 1200
    percentile: float = 0.9
    transitions: bool = True
    veto: bool = True
    text: bool = False
    text_stride: int = 25
    text_gap: int = 50
    floor: int = 1
    sharpen: bool = False


def _in_shots(frames: DataFrame, shots: DataFrame) -> DataFrame:
    """frames with the columns of each shot that they are in.

    Shots are found by the frame's number alone, in buckets of frames; what a frame carries is joined afterwards.
    """
    at = frames.select("video_id", "frame_idx", F.col("frame_idx").alias("__i"))
    at = joins.interval_pairs(at, shots, "video_id", ("frame_idx", "__i"), ("start_frame", "end_frame"), widths=(1000, 100_000, 1 << 62)).drop("__i")
    return frames.drop("shot_id").join(at, ["video_id", "frame_idx"])


def candidates(frames: DataFrame, shots: DataFrame, s: Settings = Settings()) -> DataFrame:
    """Candidate frames with window, score, text_protected and first, frame order kept by frame_idx."""
    sh = shots.select("video_id", "shot_id", "start_frame", "end_frame", "fps")
    f = _in_shots(frames, sh)
    f = f.withColumn("win", sequence.window_no(F.col("frame_idx"), F.col("start_frame"), s.window))
    g = ["video_id", "shot_id", "win"]
    f = sequence.moving_mean(sequence.steepness(f, g, "frame_idx", "jpeg_size"), g, "frame_idx", "steepness", 3, "score")
    key = [*g, "frame_idx"]
    chosen = sequence.ratio_top(f, g, "frame_idx", "score", s.ratio).select(*key)
    if s.transitions:
        p = sequence.prominent_peaks(f.withColumn("score", F.col("steepness")), g, "frame_idx", "score", s.percentile)
        chosen = chosen.union(selection.select_peaks(p.select(*key, "score", "protected"), g, s.gap).select(*key))
    marked = chosen.distinct()
    if s.text:
        t = sequence.text_changes(f, g, "frame_idx", "sign", s.text_stride)
        t = selection.select_spaced(t.select(*key), g, "frame_idx", s.text_gap)
        marked = marked.withColumn("text", F.lit(False)).union(t.withColumn("text", F.lit(True))).groupBy(*key).agg(F.max("text").alias("text_protected"))
    else:
        marked = marked.withColumn("text_protected", F.lit(False))
    f = f.join(marked, key, "left").withColumn("chosen", F.col("text_protected").isNotNull()).withColumn("window_start", F.col("start_frame") + F.col("win") * s.window)
    light = f.select(*key, "chosen", "window_start")
    filled = selection.select_filled(light, g, s.most).select(*key)
    f = f.join(filled, key, "left_semi")
    w = Window.partitionBy(*g)
    first = (F.col("win") == 0) & (F.col("frame_idx") == F.col("start_frame"))
    if s.veto:
        f = f.withColumn("ok", checks.not_blank(F.col("lap_var"), F.col("brightness"))).withColumn("any", F.max("ok").over(w)).withColumn("least", F.min("frame_idx").over(w))
        f = f.where(F.col("ok") | first | (~F.col("any") & (F.col("frame_idx") == F.col("least"))))
    return f.select(*key, "start_frame", "fps", "score", F.coalesce("text_protected", F.lit(False)).alias("text_protected"), first.alias("first"), "embedding")


def _fold(s: Settings):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        keep_all: list[int] = []
        sem = selection.SemanticFilter(s.similarity, s.gap, most=s.most)
        pdf = pdf.sort_values(["start_frame", "win", "frame_idx"], kind="stable").reset_index(drop=True)
        for _, shot in pdf.groupby(["start_frame", "shot_id"], sort=True):
            kept_shot: list[int] = []
            for _, win in shot.groupby("win", sort=True):
                at, v = win.index.to_numpy(), np.stack(win["embedding"]).astype(np.float32)
                frames = win["frame_idx"].to_numpy()
                text = set(frames[win["text_protected"].to_numpy(bool)].tolist())
                kept, forced = sem.window(frames, v, text)
                bypass = [i for i in kept if i in forced or int(frames[i]) in text]
                rest = np.array([i for i in kept if i not in set(bypass)], int)
                if len(rest):
                    rest = rest[selection.diversity_nms(frames[rest], v[rest], win["score"].to_numpy(float)[rest], s.redundancy, s.gap, s.floor)]
                final = sorted([*bypass, *rest.tolist()])
                sem.commit([int(frames[i]) for i in final], [v[i] for i in final])
                kept_shot += at[final].tolist()
            if not kept_shot and shot["first"].any():  # a shot keeps its first frame at least
                i = int(shot.index[shot["first"]][0])
                kept_shot = [i]
                sem.commit([int(pdf["frame_idx"][i])], [np.asarray(pdf["embedding"][i], np.float32)])
            keep_all += kept_shot
        return pdf.loc[sorted(keep_all), ["video_id", "shot_id", "frame_idx", "fps", "score"]]

    return run


def extract(frames: DataFrame, shots: DataFrame, s: Settings = Settings()) -> DataFrame:
    """video_id, shot_id, keyframe_id, frame_idx, timestamp_ms, score; with ``sharpen`` the sharpest alike frame nearby stands for each (column thumb)."""
    c = candidates(frames, shots, s)
    t = c.groupBy("video_id").applyInPandas(_fold(s), "video_id string, shot_id string, frame_idx int, fps double, score double")
    if s.sharpen:
        best = selection.sharpest(_in_shots(frames, shots), t.select("shot_id", "frame_idx"))
        t = t.join(best, ["shot_id", "frame_idx"], "left").withColumn("frame_idx", F.coalesce("sharp_idx", "frame_idx").cast("int")).drop("sharp_idx")
        t = t.groupBy("video_id", "shot_id", "frame_idx").agg(F.max("fps").alias("fps"), F.max("score").alias("score"))
    t = sequence.number_keyframes(t)
    return t.select("video_id", "shot_id", "keyframe_id", "frame_idx", C.keyframe_ms(F.col("frame_idx"), F.col("fps")).alias("timestamp_ms"), "score")
