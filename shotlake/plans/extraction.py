"""Extraction of keyframes video by video: what is done is left out, results, statistics and marks are written."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shotlake import models
from shotlake.operators import aggregates, joins
from shotlake.plans import keyframes
from shotlake.sources import sinks
from shotlake.sources.tables import stored


class Rules:
    """The extractor of ``plans.keyframes``."""

    name = "rules"

    def __init__(self, settings: keyframes.Settings = keyframes.Settings()):
        self.settings = settings

    def setup(self) -> None: ...

    def extract(self, frames: DataFrame, shots: DataFrame) -> DataFrame:
        return keyframes.extract(frames, shots, self.settings)

    def teardown(self) -> None: ...


models.register_extractor(Rules())


def run(frames: DataFrame, shots: DataFrame, folder: str, name: str = "rules", overwrite: bool = False) -> DataFrame:
    """The videos of this run. Below ``folder``: keyframes by video, a summary, and the videos that are done.

    A video is marked when its keyframes are written; a run that stops is taken up again where no mark is.
    """
    spark, extractor = frames.sparkSession, models.extractor(name)
    done = stored(spark, f"{folder}/done")
    videos = frames.select("video_id").distinct()
    if done is not None and not overwrite:
        videos = joins.without(videos, done, "video_id")
    extractor.setup()
    try:
        found = extractor.extract(joins.only(frames, videos, "video_id"), joins.only(shots, videos, "video_id"))
        sinks.by_video(found, f"{folder}/keyframes", "parquet")
    finally:
        extractor.teardown()
    written = stored(spark, f"{folder}/keyframes")
    if written is not None:
        sinks.summary_csv(aggregates.keyframe_stats(joins.only(written, videos, "video_id")), f"{folder}/summary")
    names = [r[0] for r in videos.collect()]  # of this run, before the marks change what isn't done
    out = spark.createDataFrame([(v,) for v in names], "video_id string")
    out.write.mode("append").parquet(f"{folder}/done")
    return out.select(F.col("video_id"))
