"""Operators on ordered frames: islands, windows, scores and peaks. Window functions, all in the JVM."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shotlake.plans.lineage import cut


def scenes(predictions: DataFrame, group: str, pos: str, p: str, threshold: float = 0.5) -> DataFrame:
    """group, start_pos, end_pos: runs of frames below the threshold, each ended by the boundary after it.

    A last run without one ends at the last frame; a group of boundaries alone is one scene.
    """
    t = predictions.select(F.col(group).alias("g"), F.col(pos).alias("i"), (F.col(p) > threshold).cast("int").alias("cut"))
    w = Window.partitionBy("g").orderBy("i")
    t = t.withColumn("island", F.sum(F.when((F.lag("cut", 1, 1).over(w) == 1) & (F.col("cut") == 0), 1).otherwise(0)).over(w)).withColumn("next", F.lead("i").over(w))
    runs = t.where("cut = 0").groupBy("g", "island").agg(F.min("i").alias("start_pos"), F.max_by(F.coalesce("next", "i"), "i").alias("end_pos")).select("g", "start_pos", "end_pos")
    full = t.groupBy("g").agg(F.min("cut").alias("least"), F.min("i").alias("start_pos"), F.max("i").alias("end_pos")).where("least = 1").select("g", "start_pos", "end_pos")
    return runs.unionByName(full).withColumnRenamed("g", group)


def model_windows(frames: DataFrame, group: str, pos: str, length: int = 100, hop: int = 50) -> DataFrame:
    """group, window, slot, pos: overlapping windows of a model, padded with copies of the first and last frame.

    Slots 25 to 74 of a window are the frames that the window answers for.
    """
    n = frames.groupBy(group).agg((F.max(pos) + 1).cast("long").alias("n")).where("n > 0")
    t = n.withColumn("window", F.explode(F.sequence(F.lit(0), F.ceil(F.col("n") / hop) - 1))).withColumn("slot", F.explode(F.sequence(F.lit(0), F.lit(length - 1))))
    at = F.col("window") * hop + F.col("slot") - (length - hop) // 2
    return t.select(group, "window", "slot", F.greatest(F.lit(0), F.least(F.col("n") - 1, at)).alias("pos"))


def chunks(videos: DataFrame, total: str, size: int = 300) -> DataFrame:
    """video_id, shot_id, start_frame, end_frame: tumbling chunks of a video without shots; one at least."""
    t = videos.select("video_id", F.greatest(F.lit(1), F.col(total)).cast("long").alias("n"))
    t = t.select("video_id", "n", F.posexplode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(size).cast("long"))).alias("k", "start_frame"))
    return t.select("video_id", F.format_string("S%04d", F.col("k") + 1).alias("shot_id"), "start_frame", F.least(F.col("start_frame") + size, F.col("n")).alias("e")).withColumn("end_frame", F.col("e") - 1).drop("e")


def strided(frames: DataFrame, pos: str, start: int, end: int, stride: int = 1, readable: str | None = None) -> DataFrame:
    """Frames of an inclusive range, every ``stride``-th from its start; with ``readable``, up to the first of them that isn't."""
    t = frames.where(F.col(pos).between(start, end) & (F.pmod(F.col(pos) - start, F.lit(stride)) == 0))
    if readable is None:
        return t
    bad = t.where(~F.coalesce(F.col(readable), F.lit(False))).agg(F.min(pos).alias("__bad"))
    return t.join(F.broadcast(bad), F.col("__bad").isNull() | (F.col(pos) < F.col("__bad")), "inner").drop("__bad")


def window_no(frame: Column, start: Column, size: int = 1200) -> Column:
    return F.floor((frame - start) / size)


def steepness(df: DataFrame, group: list[str], pos: str, value: str) -> DataFrame:
    """df with steepness: relative step from the value before, 0 at a group's first frame."""
    prev = F.lag(value).over(Window.partitionBy(*group).orderBy(pos))
    return df.withColumn("steepness", F.coalesce(F.abs(F.col(value) - prev) / F.greatest(prev, F.lit(1.0)), F.lit(0.0)))


def moving_mean(df: DataFrame, group: list[str], pos: str, value: str, width: int = 3, out: str = "score") -> DataFrame:
    """Centred mean, over fewer frames at the ends."""
    return df.withColumn(out, F.avg(value).over(Window.partitionBy(*group).orderBy(pos).rowsBetween(-(width // 2), width // 2)))


def ratio_top(df: DataFrame, group: list[str], pos: str, score: str, ratio: float = 0.05) -> DataFrame:
    """The best share of a group's frames (one at least; of ties the later) and its first frame."""
    g = Window.partitionBy(*group)
    t = df.withColumn("__n", F.count("*").over(g)).withColumn("__r", F.row_number().over(g.orderBy(F.desc(score), F.desc(pos)))).withColumn("__f", F.min(pos).over(g))
    return t.where((F.col("__r") <= F.greatest(F.lit(1), F.floor(F.col("__n") * ratio))) | (F.col(pos) == F.col("__f"))).drop("__n", "__r", "__f")


def group_top(df: DataFrame, group: list[str], order: list[Column], k: int) -> DataFrame:
    """The first k rows of each group; the limit is also applied before the shuffle."""
    return df.withColumn("__r", F.row_number().over(Window.partitionBy(*group).orderBy(*order))).where(F.col("__r") <= k).drop("__r")


def prominent_peaks(df: DataFrame, group: list[str], pos: str, score: str, percentile: float = 0.9, reach: int = 3) -> DataFrame:
    """Interior frames at or above the group's percentile that are the highest within ``reach`` rows, and the first frame.

    Groups of fewer than three frames give their first frame only. Column ``protected`` marks first frames.
    """
    g, w = Window.partitionBy(*group), Window.partitionBy(*group).orderBy(pos)
    q = df.groupBy(*group).agg(F.percentile(score, percentile).alias("__q"), F.count("*").alias("__n"), F.min(pos).alias("__f"), F.max(pos).alias("__l"))
    t = df.withColumn("__m", F.max(score).over(w.rowsBetween(-reach, reach)))
    on = [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in group]
    t = t.alias("l").join(q.alias("r"), on).select("l.*", "__q", "__n", "__f", "__l")
    peak = (F.col("__n") >= 3) & (F.col(pos) > F.col("__f")) & (F.col(pos) < F.col("__l")) & (F.col(score) >= F.col("__q")) & (F.col(score) == F.col("__m"))
    return t.where(peak | (F.col(pos) == F.col("__f"))).withColumn("protected", F.col(pos) == F.col("__f")).drop("__q", "__n", "__f", "__l", "__m")


def text_changes(df: DataFrame, group: list[str], pos: str, sign: str, stride: int, distance: int = 8) -> DataFrame:
    """Every ``stride``-th row whose signature is far from the sample's before; the first sample never."""
    w = Window.partitionBy(*group).orderBy(pos)
    t = df.withColumn("__k", F.row_number().over(w) - 1).where(F.pmod("__k", F.lit(stride)) == 0)
    t = t.withColumn("__p", F.lag(sign).over(w)).withColumn("__first", F.row_number().over(w) == 1)
    far = F.col(sign).isNotNull() & (F.col("__p").isNull() | (F.bit_count(F.col(sign).bitwiseXOR(F.col("__p"))) >= distance))
    return t.where(far & ~F.col("__first")).drop("__k", "__p", "__first")


def number_keyframes(df: DataFrame, shot: str = "shot_id", pos: str = "frame_idx") -> DataFrame:
    """df with keyframe_id, numbered from 1 within the shot."""
    return df.withColumn("keyframe_id", F.format_string("%s_kf%04d", F.col(shot), F.row_number().over(Window.partitionBy(shot).orderBy(pos))))


def vad_rows(videos: DataFrame, segments: str = "segments") -> DataFrame:
    """video_id, seg_id, start_ms, end_ms, text, confidence of segments array<start, end, text> (seconds).

    Empty texts are dropped, but the number in seg_id is that of the segment.
    """
    t = videos.select("video_id", F.posexplode(segments).alias("k", "s"))
    t = t.select("video_id", F.format_string("%s_%06d", "video_id", "k").alias("seg_id"), F.bround(F.col("s.start") * 1000, 0).cast("bigint").alias("start_ms"), F.bround(F.col("s.end") * 1000, 0).cast("bigint").alias("end_ms"), F.trim("s.text").alias("text"), F.lit(0.0).alias("confidence"))
    return t.where(F.length("text") > 0)


def sliced(df: DataFrame, order: list[str], first: int, last: int | None = None, reverse: bool = False, every: int = 1, keep: tuple[int, ...] = (0,)) -> DataFrame:
    """Rows [first, last) of an order, reversed if asked, of which those whose number modulo ``every`` is in ``keep`` stay.

    Rows are put in ranges of the order; numbers are those within a range after the counts of the ranges before, so no
    task holds more than a range. The driver gets a count a range.
    """
    cols = [F.desc(c) for c in order] if reverse else [F.asc(c) for c in order]
    t = cut(df.repartitionByRange(*cols).withColumn("__range", F.spark_partition_id()))
    counts, before, at = {r["__range"]: r["count"] for r in t.groupBy("__range").count().collect()}, {}, 0
    for k in sorted(counts):
        before[k], at = at, at + counts[k]
    if not before:
        return df.withColumn("row_no", F.lit(0).cast("long")).limit(0)
    offset = F.element_at(F.create_map(*[F.lit(x) for kv in before.items() for x in kv]), F.col("__range")).cast("long")
    t = t.withColumn("row_no", F.row_number().over(Window.partitionBy("__range").orderBy(*cols)) - 1 + offset).drop("__range")
    t = t.where(F.col("row_no") >= first)
    if last is not None:
        t = t.where(F.col("row_no") < last)
    return t.where(F.pmod("row_no", F.lit(every)).isin(list(keep)))


def sampled(df: DataFrame, n: int, seed: int = 0) -> DataFrame:
    """n rows at random, the same for the same seed and rows."""
    key = F.xxhash64(F.lit(seed), *[F.col(c) for c in df.columns])
    return df.withColumn("__k", key).orderBy("__k").limit(n).drop("__k")
