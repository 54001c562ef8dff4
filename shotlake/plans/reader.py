"""The read side: searches and look-ups over the stores' tables of one folder."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shotlake.operators import joins, search, vectors
from shotlake.plans.lineage import scratch
from shotlake.sources.tables import table

TABLES = ("shot_doc", "seg_doc", "frame_doc", "es_doc", "milvus_entity")


#: Fields of the index: column, accents folded?
FIELDS = {"ocr_text": ("ocr_text", True), "ocr_api": ("ocr_api", True), "exact": ("ocr_text", False), "caption": ("caption", True), "transcript": ("transcript", True), "content_all": ("content_all", True)}

_standing: dict[tuple, str] = {}


class Reader:
    """Tables are read when first used; repeated rows of a frame count once.

    Text is searched in an index: that in the folder ``index``, or one of the fields searched, that the first such search of a session
    over these files builds in the session's shared folder and the later ones use.
    """

    def __init__(self, spark: SparkSession, folder: str, root: str = "", index: str | None = None):
        self.spark, self.folder, self.root, self.index = spark, folder, root, index
        self.docs = table(spark, folder, "es_doc").dropDuplicates(["frame_id"])

    def text_index(self, *fields: str) -> search.TextIndex:
        """The index of all fields in the folder ``index``, or a standing one of those named."""
        path = self.index
        if path is None:
            key = (self.spark.sparkContext.applicationId, fields, *sorted(table(self.spark, self.folder, "es_doc").inputFiles()))
            if key not in _standing:
                path = scratch(self.spark)
                self._indexed(self.docs, fields).write(path)
                _standing[key] = path
            path = _standing[key]
        return search.TextIndex.read(self.docs, "frame_id", path)

    def ready(self) -> bool:
        """All tables can be read; an error names one that can't."""
        for name in TABLES:
            table(self.spark, self.folder, name).limit(1).count()
        return True

    def _text(self, query: str, names: list[str], accented: str | None, k: int, video_ids, frame_ids, min_score=None) -> DataFrame:
        return search.hits(self.text_index(*names, *([accented] if accented else [])).search(query, names, accented), self.docs, "frame_id", k, video_ids, frame_ids, min_score)

    @staticmethod
    def _indexed(docs: DataFrame, fields: Sequence[str] = tuple(FIELDS)) -> search.TextIndex:
        t = docs.withColumn("content_all", F.concat_ws(" ", "ocr_text", "ocr_api", "caption", "transcript"))
        return search.TextIndex(t, "frame_id", {f: FIELDS[f] for f in fields})

    def build_index(self, path: str) -> None:
        """The postings of all searches' fields as tables."""
        self._indexed(self.docs).write(path)

    def update_index(self, path: str, docs: DataFrame) -> None:
        """New rows of some frames (columns of es_doc, one row a frame) take the place of theirs in the index."""
        self._indexed(docs).upsert(path)

    def search_vector(self, vector: Sequence[float], top_k: int = 100, video_ids: list[str] | None = None, min_score: float | None = None, probes: int | None = None) -> DataFrame:
        """The nearest frames: exact, or with ``probes`` those in so many lists of an index that the session's first such search builds."""
        e = table(self.spark, self.folder, "milvus_entity").dropDuplicates(["frame_id"])
        if probes is None:
            return search.hits(search.vector_scores(e, "frame_id", "embedding", vector), e, "frame_id", top_k, video_ids, None, min_score)
        key = (self.spark.sparkContext.applicationId, len(vector), *sorted(table(self.spark, self.folder, "milvus_entity").inputFiles()))
        if key not in _standing:
            path = scratch(self.spark)
            vectors.write(e, "embedding", len(vector), path)
            _standing[key] = path
        found = vectors.search(self.spark, _standing[key], "frame_id", "embedding", vector, probes)
        return search.hits(found, e, "frame_id", top_k, video_ids, None, min_score)

    def search_ocr(self, query: str, top_k: int = 100, video_ids: list[str] | None = None, frame_ids: list[str] | None = None) -> DataFrame:
        return self._text(query, ["ocr_text", "ocr_api"], "exact", top_k, video_ids, frame_ids)

    def search_asr(self, query: str, top_k: int = 100, video_ids: list[str] | None = None, frame_ids: list[str] | None = None, min_score: float | None = None) -> DataFrame:
        return self._text(query, ["transcript"], None, top_k, video_ids, frame_ids, min_score)

    def search_all(self, query: str, top_k: int = 100, video_ids: list[str] | None = None, frame_ids: list[str] | None = None) -> DataFrame:
        return self._text(query, ["content_all"], None, top_k, video_ids, frame_ids)

    def search_object(self, labels: list[str], top_k: int = 100, video_ids: list[str] | None = None, frame_ids: list[str] | None = None, min_score: float | None = None) -> DataFrame:
        frames = table(self.spark, self.folder, "frame_doc").dropDuplicates(["_id"]).withColumnRenamed("_id", "frame_id")
        return search.object_hits(frames, labels, top_k, video_ids, frame_ids, min_score)

    def frames(self, ids: list[str]) -> DataFrame:
        f = table(self.spark, self.folder, "frame_doc").dropDuplicates(["_id"]).withColumnRenamed("_id", "frame_id")
        return joins.hydrate(f, ids, self.root)

    def shots(self, video_id: str) -> DataFrame:
        return table(self.spark, self.folder, "shot_doc").where(F.col("video_id") == video_id).dropDuplicates(["_id"]).orderBy("start_ms")

    def transcript(self, video_id: str, lo: int | None = None, hi: int | None = None) -> DataFrame:
        t = table(self.spark, self.folder, "seg_doc").where(F.col("video_id") == video_id).dropDuplicates(["_id"])
        return joins.half_open(t, "start_ms", "end_ms", lo if lo is not None else 0, hi if hi is not None else 2**62)
