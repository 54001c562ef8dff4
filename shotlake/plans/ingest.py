"""One batch of artifacts into the tables of the stores; videos that are done are left out."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shotlake.functions import columns as C
from shotlake.operators import aggregates, joins, merge
from shotlake.plans import documents


@dataclass
class Artifacts:
    """Tables of a batch; keyframes(video_id, keyframe_id, frame_idx, timestamp_ms, image_path, pos), transcripts(shot_id, text, pos).

    ``pos`` is a row's place in the file (``readers.with_place``); of several rows of a shot the last one counts (without
    ``pos`` the greatest text).
    """

    keyframes: DataFrame
    shots: DataFrame
    segments: DataFrame
    transcripts: DataFrame
    detections: DataFrame
    ocr: DataFrame
    ocr_api: DataFrame
    captions: DataFrame
    vectors: DataFrame
    media_info: DataFrame


def ingest(a: Artifacts, status: DataFrame, batch: str) -> dict[str, DataFrame]:
    """Rows for each store and the new status; shots of frames are looked up again from the frames' indices."""
    kf = merge.not_done(a.keyframes, status, "frames")
    fps = aggregates.derive_fps(kf, "pos")
    shots = joins.only(a.shots, fps, "video_id").drop("fps").join(fps, "video_id")
    place = F.col("pos" if "pos" in a.transcripts.columns else "text").alias("pos")
    said = joins.last_wins(a.transcripts.select("shot_id", F.col("text").alias("transcript"), place), ["shot_id"], ["pos"]).drop("pos")
    shot_docs = documents.shot_docs(shots.join(said, "shot_id", "left"))
    frames = documents.frame_docs(joins.asof_shot(kf, shots), batch)
    ocr = a.ocr.select("frame_id", C.underscores_to_spaces(F.col("text")).alias("text"))
    found = joins.enrich(frames.select(F.col("_id").alias("frame_id"), "video_id"), aggregates.max_confidence(a.detections), ocr, a.ocr_api, a.captions)
    frames = merge.enrich_rows(frames, found.withColumnRenamed("frame_id", "_id").drop("video_id"), ["_id"])
    entities = documents.vector_entities(frames, joins.only(a.vectors, kf, "keyframe_id"))
    frames = merge.mark_synced(merge.mark_synced(frames, entities, "milvus"), frames.select(F.col("_id").alias("frame_id")), "elastic")
    return {
        "video_doc": documents.video_docs(joins.only(a.media_info, fps, "video_id"), fps, batch),
        "shot_doc": shot_docs,
        "seg_doc": documents.segment_docs(joins.only(a.segments, fps, "video_id")),
        "frame_doc": frames,
        "es_doc": documents.text_docs(frames, shot_docs),
        "milvus_entity": entities,
        "ingest_status": merge.set_status(status, fps, "frames", "done"),
    }
