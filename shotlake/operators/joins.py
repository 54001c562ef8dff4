"""Joins by interval, by order and by key."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shotlake.functions import columns as C

TOLERANCE_MS = 500
#: Widths of the buckets of the interval join (ms). A row takes the finest of which it touches at most COPIES.
WIDTHS, COPIES = (60_000, 3_600_000, 1 << 62), 64


def interval_pairs(left: DataFrame, right: DataFrame, key: str, left_bounds: tuple[str, str], right_bounds: tuple[str, str], tolerance: int = 0, widths: tuple[int, ...] = WIDTHS) -> DataFrame:
    """Rows of both sides whose closed intervals overlap within ``tolerance``, under one key.

    A row takes the width of buckets of which it touches few, so a broken end doesn't flood the join. For each pair of widths both
    sides are copied to the buckets, of the wider one, that they touch and joined on key and bucket; a pair is
    kept in the first bucket that both touch, so a key with very many rows is spread over its buckets
    and no pair comes twice. Intervals with a null bound or a reversed one join nothing.
    """
    (ls, le), (rs, re_) = left_bounds, right_bounds
    lo, hi = F.col(ls) - tolerance, F.col(le) + tolerance

    def width(a: Column, z: Column) -> Column:
        w = F.lit(len(widths) - 1)
        for n in range(len(widths) - 2, -1, -1):
            w = F.when(F.floor(z / widths[n]) - F.floor(a / widths[n]) < COPIES, n).otherwise(w)
        return w

    def copied(t: DataFrame, a: Column, z: Column, own: str, name: str) -> DataFrame:
        # Own width and all wider ones: of a pair the wider of both sides' widths holds.
        wide = F.filter(F.array(*[F.struct(F.lit(n).alias("w"), F.lit(b).cast("long").alias("ms")) for n, b in enumerate(widths)]), lambda x: x["w"] >= F.col(own))
        t = t.withColumn(own, width(a, z)).withColumn(f"{name}x", F.explode(wide))
        first, last = F.floor(a / F.col(f"{name}x.ms")), F.floor(z / F.col(f"{name}x.ms"))
        return t.withColumn(f"{name}lo", first).withColumn(f"{name}b", F.explode(F.sequence(first, last))).withColumn(f"{name}w", F.col(f"{name}x.w")).drop(f"{name}x")

    a = copied(left.where(F.col(ls) <= F.col(le)), lo, hi, "__own", "__l")
    b = right.where(F.col(rs) <= F.col(re_)).withColumnRenamed(key, "__key")
    b = copied(b, F.col(rs), F.col(re_), "__theirs", "__r")
    on = (F.col(key) == F.col("__key")) & (F.col("__lw") == F.col("__rw")) & (F.col("__lb") == F.col("__rb")) & (F.col("__lb") == F.greatest("__llo", "__rlo"))
    on &= (F.col("__lw") == F.greatest("__own", "__theirs")) & (F.col(rs) <= hi) & (F.col(re_) >= lo)
    return a.join(b, on).drop("__own", "__theirs", "__key", *[f"__{s}{c}" for s in "lr" for c in ("lo", "b", "w")])


def shot_transcripts(shots: DataFrame, segments: DataFrame, tolerance: int = TOLERANCE_MS) -> DataFrame:
    """video_id, shot_id, text: speech that overlaps each shot, in order of time.

    Closed overlap of truncated bounds; only a shot without any overlap takes segments within
    ``tolerance``. Shots left without text are dropped.
    """
    s = shots.select("video_id", "shot_id", C.frame_ms_truncated(F.col("start_frame"), F.col("fps")).alias("a"), C.frame_ms_truncated(F.col("end_frame"), F.col("fps")).alias("z"))
    g = segments.select("video_id", F.col("start_ms").alias("s"), F.col("end_ms").alias("e"), "seg_id", F.col("text").alias("t")).where(F.length(F.trim("t")) > 0)
    p = interval_pairs(s, g, "video_id", ("a", "z"), ("s", "e"), tolerance)
    p = p.withColumn("exact", (F.col("s") <= F.col("z")) & (F.col("e") >= F.col("a")))
    ordered = lambda flag: F.array_join(F.sort_array(F.collect_list(F.when(flag, F.struct("s", "seg_id", "t"))))["t"], " ")
    t = p.groupBy("video_id", "shot_id").agg(F.max("exact").alias("any"), ordered(F.col("exact")).alias("x"), ordered(F.lit(True)).alias("y"))
    return t.select("video_id", "shot_id", F.when(F.col("any"), F.col("x")).otherwise(F.col("y")).alias("text"))


def asof_shot(frames: DataFrame, shots: DataFrame, span: int = 100_000) -> DataFrame:
    """frames with shot_id: the shot of the video that starts last at or before frame_idx, '' unless it reaches the frame.

    An earlier shot that also covers the frame isn't looked for. Both sides are laid in one order and
    the last start is carried on; a video is split into stretches of ``span`` frames, and the last shot of
    the stretches before is carried into each, so a very long video is spread over tasks.
    """
    cols = [c for c in frames.columns if c != "shot_id"]
    f = frames.select(F.struct(*cols).alias("row"), F.col("video_id").alias("v"), F.col("frame_idx").cast("long").alias("at"), F.lit(None).cast("struct<start:long,end:long,id:string>").alias("shot"), F.lit(1).alias("side"))
    s = shots.groupBy("video_id", "start_frame").agg(F.max(F.struct("end_frame", "shot_id")).alias("m"))
    s = s.select(F.lit(None).cast(f.schema["row"].dataType).alias("row"), F.col("video_id").alias("v"), F.col("start_frame").cast("long").alias("at"), F.struct(F.col("start_frame").cast("long").alias("start"), F.col("m.end_frame").cast("long").alias("end"), F.col("m.shot_id").alias("id")).alias("shot"), F.lit(0).alias("side"))
    t = f.unionByName(s).withColumn("part", F.floor(F.col("at") / span))
    lasts = t.groupBy("v", "part").agg(F.max(F.when(F.col("shot").isNotNull(), F.struct("at", "shot"))).alias("m"))
    before = lasts.select(F.col("v").alias("bv"), F.col("part").alias("bp"), F.last("m.shot", True).over(Window.partitionBy("v").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)).alias("carried"))
    w = Window.partitionBy("v", "part").orderBy("at", "side").rowsBetween(Window.unboundedPreceding, 0)
    t = t.withColumn("own", F.last("shot", True).over(w)).where("row is not null")
    t = t.join(before, F.col("v").eqNullSafe(F.col("bv")) & F.col("part").eqNullSafe(F.col("bp")), "left").withColumn("found", F.coalesce("own", "carried"))
    shot = F.when(F.col("found.end") >= F.col("at"), F.col("found.id")).otherwise("")
    return t.select("row.*", F.coalesce(shot, F.lit("")).alias("shot_id"))


def last_wins(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row of each key in the given order."""
    return df.groupBy(*keys).agg(F.max_by(F.struct(*[c for c in df.columns if c not in keys]), F.struct(*order)).alias("x")).select(*keys, "x.*")


def enrich(frames: DataFrame, objects: DataFrame, ocr: DataFrame, ocr_api: DataFrame, captions: DataFrame) -> DataFrame:
    """frames (frame_id, video_id, ...) with objects, ocr_text, ocr_api and caption.

    objects(frame_id, objects); ocr, ocr_api, captions(frame_id, text), one row a key. Recognised text is
    looked up by frame, and where the frame is absent (an empty text is present) by video.
    """
    own = ocr.select("frame_id", F.col("text").alias("own_text"), F.lit(True).alias("own"))
    video = ocr.select(F.col("frame_id").alias("video_id"), F.col("text").alias("video_text"))
    t = frames.join(objects, "frame_id", "left").join(own, "frame_id", "left").join(video, "video_id", "left")
    t = t.withColumn("ocr_text", F.when(F.col("own"), F.col("own_text")).otherwise(F.col("video_text"))).drop("own", "own_text", "video_text")
    t = t.join(ocr_api.select("frame_id", F.col("text").alias("ocr_api")), "frame_id", "left")
    return t.join(captions.where(F.length("text") > 0).select("frame_id", F.col("text").alias("caption")), "frame_id", "left")


def frame_transcripts(frames: DataFrame, shots: DataFrame) -> DataFrame:
    """frames with the transcript of their shot, '' if none."""
    s = shots.groupBy(F.col("shot_id").alias("sid")).agg(F.max("transcript").alias("transcript"))
    return frames.join(s, F.col("shot_id") == F.col("sid"), "left").withColumn("transcript", F.coalesce("transcript", F.lit(""))).drop("sid")


def hydrate(frames: DataFrame, ids: list[str], root: str = "") -> DataFrame:
    """The frames of ids in the order asked for; unknown ids are skipped, repeated ones repeated."""
    spark = frames.sparkSession
    asked = spark.createDataFrame([(i, k) for k, i in enumerate(ids)], "frame_id string, pos int")
    t = frames.join(F.broadcast(asked) if len(ids) <= 65_536 else asked, "frame_id")
    if root:
        t = t.withColumn("image_path", C.absolute_path(F.col("image_path"), root))
    return t.orderBy("pos")


def half_open(df: DataFrame, start: str, end: str, lo: int, hi: int) -> DataFrame:
    """Rows whose interval meets [lo, hi), in order of start."""
    return df.where((F.col(start) < hi) & (F.col(end) > lo)).orderBy(start)


def pts_of_frames(frames: DataFrame, packets: DataFrame) -> DataFrame:
    """frames with pts_ms: the frame_idx-th of the video's packet times (seconds) in order of time."""
    p = packets.groupBy("video_id").agg(F.array_sort(F.collect_list("pts")).alias("all"))
    t = frames.join(p, "video_id", "left")
    return t.withColumn("pts_ms", F.bround(F.get("all", F.col("frame_idx").cast("int")) * 1000, 0).cast("bigint")).drop("all")


def similar_within(df: DataFrame, group: str, key: str, vector: str, least: float) -> DataFrame:
    """a, b, sim: pairs inside a group (a shot, a window: bounded) with cosine of unit vectors at least ``least``, by blocks of matrix products."""
    kinds = dict(df.dtypes)

    def run(t: pd.DataFrame) -> pd.DataFrame:
        t = t.sort_values("k", kind="stable")
        keys, m = t["k"].to_numpy(), np.stack(t["v"]).astype(np.float64)
        parts = []
        for a in range(0, len(m), 1024):
            s = m[a : a + 1024] @ m[a:].T
            i, j = np.nonzero(s >= least)
            ok = keys[a + i] < keys[a + j]
            parts.append(pd.DataFrame({"g": t["g"].iloc[0], "a": keys[a + i[ok]], "b": keys[a + j[ok]], "sim": s[i[ok], j[ok]]}))
        return pd.concat(parts)

    t = df.where(F.col(group).isNotNull() & F.col(vector).isNotNull()).select(F.col(group).alias("g"), F.col(key).alias("k"), F.col(vector).alias("v"))
    t = t.groupBy("g").applyInPandas(run, f"g {kinds[group]}, a {kinds[key]}, b {kinds[key]}, sim double")
    return t.withColumnRenamed("g", group)


def band_pairs(df: DataFrame, group: str, pos: str, value: list[str], radius: int) -> DataFrame:
    """i, j of rows of a group at most ``radius`` apart, with both sides' values; an equi-join on buckets of the radius."""
    width = radius + 1
    a = df.select(F.col(group).alias("g"), F.col(pos).alias("i"), *[F.col(v).alias(f"{v}_i") for v in value])
    a = a.withColumn("near", F.explode(F.sequence(F.floor(F.col("i") / width) - 1, F.floor(F.col("i") / width) + 1)))
    b = df.select(F.col(group).alias("g2"), F.col(pos).alias("j"), *[F.col(v).alias(f"{v}_j") for v in value]).withColumn("b", F.floor(F.col("j") / width))
    t = a.join(b, (F.col("g") == F.col("g2")) & (F.col("near") == F.col("b")) & (F.abs(F.col("i") - F.col("j")) <= radius))
    return t.drop("near", "b", "g2").withColumnRenamed("g", group)


def only(df: DataFrame, keys: DataFrame, on: str | list[str]) -> DataFrame:
    """Rows whose key is listed."""
    return df.join(keys.select(on), on, "left_semi")


def without(df: DataFrame, keys: DataFrame, on: str | list[str]) -> DataFrame:
    """Rows whose key isn't listed (done, skipped or bad work)."""
    return df.join(keys.select(on), on, "left_anti")


def in_filter(col: Column, values: list | None, empty_means_none: bool) -> Column:
    """Conjunct of a search filter. None doesn't filter; an empty list matches nothing or, where said, doesn't filter."""
    if values is None or not values and not empty_means_none:
        return F.lit(True)
    return col.isin(values) if values else F.lit(False)
