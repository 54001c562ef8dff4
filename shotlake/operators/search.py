"""Text and vector search as joins on tables of postings.

BM25 with k1 = 1.2 and b = 0.75. A query is a set of terms. Fuzzy terms are the index's terms within one
edit (a swap of neighbours is one), found by an equi-join on the words with one letter taken out, so
terms are never compared all with all; at most ``EXPANSIONS`` a query term, nearest first. A fuzzy hit
counts by 1 - 1 / length of the shorter word.

Ranking of a search: the sum over query terms, plus 5 times the (fuzzy) sum for documents with enough
terms, plus 3 times the exact sum for those with enough exact terms, plus 3 times the sum over the
accented field where the query has accents and the document all of its terms. Enough is all terms up
to two, and else three quarters, rounded down.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shotlake.functions import columns as C
from shotlake.operators.joins import in_filter
from shotlake.plans.lineage import cut

K1, B = 1.2, 0.75
EXPANSIONS = 10
_WORD = "[\\p{L}\\p{N}]+"


def words_of(text: Column, fold: bool = True) -> Column:
    """Terms of a text: runs of letters and digits, lower case, accents folded if asked."""
    t = F.lower(text)
    return F.regexp_extract_all(C.fold_accents(t) if fold else t, F.lit(f"({_WORD})"), F.lit(1))


def query_words(query: str, fold: bool = True) -> list[str]:
    q = query.lower()
    if fold:
        q = "".join(c for c in unicodedata.normalize("NFD", q.replace("đ", "d")) if unicodedata.category(c)[0] != "M")
    return list(dict.fromkeys(re.findall(r"[^\W_]+", q)))


def required(n: int) -> int:
    """Terms that must match: all up to two, three quarters (rounded down) beyond."""
    return n if n <= 2 else n * 3 // 4


def _deletions(c: Column) -> Column:
    """A word, and it without each of its letters: words within one edit (or swap) share one of these."""
    return F.array_distinct(F.concat(F.array(c), F.transform(F.sequence(F.lit(1), F.length(c)), lambda i: F.concat(F.substring(c, F.lit(1), i - 1), F.substring(c, i + 1, F.length(c))))))


class TextIndex:
    """Postings (field, doc, term, tf, dl), the number and mean length of each field's documents, and the terms by their deletions.

    Stored, an index is a folder of tables in segments: ``write`` makes the first, ``upsert`` adds one with the new rows of some
    documents and their keys, by which older rows of theirs no longer count. Postings are laid out by field and term,
    terms by deletion, so a search reads a few row groups.
    """

    def __init__(self, docs: DataFrame, key: str, fields: dict[str, tuple[str, bool]]):
        """fields: name -> (column, accents folded?)."""
        self.docs, self.key, self.spark = docs, key, docs.sparkSession
        # One row a document, and a document's terms together: counting them needs no shuffle where docs are distributed by key.
        # The terms aren't filtered on: a filter would be pushed down and tokenise again.
        parts = F.array(*[F.struct(F.lit(f).alias("field"), words_of(F.col(c), fold).alias("w")) for f, (c, fold) in fields.items()])
        t = docs.select(F.col(key).alias("doc"), F.explode(parts).alias("x")).select("doc", "x.field", "x.w", F.size("x.w").alias("dl"))
        self.postings = t.select("field", "doc", "dl", F.explode("w").alias("term")).groupBy("field", "doc", "term", "dl").agg(F.count("*").alias("tf"))
        self.lengths = t.select("field", "doc", F.when(F.col("dl") > 0, F.col("dl")).alias("dl"))
        self.stats = self._stats(self.lengths)
        self.keys = self._keys(self.postings)

    @staticmethod
    def _stats(lengths: DataFrame) -> DataFrame:
        return lengths.groupBy("field").agg(F.count("dl").alias("n_docs"), F.avg("dl").alias("avg_dl"))

    @staticmethod
    def _keys(postings: DataFrame) -> DataFrame:
        return postings.select("field", "term").distinct().select("field", "term", F.explode(_deletions(F.col("term"))).alias("k"))

    def terms(self) -> DataFrame:
        return self.postings.select("field", "term").distinct()

    def expansions(self, words: Sequence[str]) -> DataFrame:
        """field, q, term, weight: the query's words and the index's words within one edit."""
        cuts = sorted({w[:i] + w[i + 1 :] for w in words for i in range(len(w))} | set(words))
        q = self.spark.createDataFrame([(w,) for w in words], "q string")
        a = q.select("q", F.explode(_deletions(F.col("q"))).alias("k"))
        t = self.keys.where(F.col("k").isin(cuts)).join(F.broadcast(a), "k").select("field", "q", "term").distinct().where(within_one("q", "term"))
        near = F.when(F.col("q") == F.col("term"), F.lit(1.0)).otherwise(1 - 1 / F.least(F.length("q"), F.length("term")))
        t = t.withColumn("weight", near).where("weight > 0")
        w = Window.partitionBy("field", "q").orderBy(F.desc("weight"), "term")
        return t.withColumn("r", F.row_number().over(w)).where((F.col("q") == F.col("term")) | (F.col("r") <= EXPANSIONS)).drop("r")

    def _segment(self, path: str, no: int) -> None:
        mode = "overwrite" if no == 0 else "append"
        at = lambda t: t.withColumn("segment", F.lit(no)).write.mode(mode)
        at(self.postings.repartition("field", "term").sortWithinPartitions("field", "term", "doc")).partitionBy("segment", "field").parquet(f"{path}/postings")
        # What was just written is read for the rest: texts are taken apart once.
        mine = self.spark.read.parquet(f"{path}/postings").where(F.col("segment") == no).drop("segment")
        at(self._keys(mine).repartition("k").sortWithinPartitions("k")).partitionBy("segment").parquet(f"{path}/keys")
        at(mine.groupBy("field", "doc").agg(F.max("dl").alias("dl"))).partitionBy("segment").parquet(f"{path}/lengths")
        at(self.docs.select(F.col(self.key).alias("doc")).distinct()).partitionBy("segment").parquet(f"{path}/docs")
        self._write_stats(path, no, mode)

    def _write_stats(self, path: str, no: int, mode: str) -> None:
        live = self._live(self.spark.read.parquet(f"{path}/lengths"), self.spark.read.parquet(f"{path}/docs"))
        self._stats(live).withColumn("segment", F.lit(no)).coalesce(1).write.mode(mode).parquet(f"{path}/stats")

    @staticmethod
    def _live(rows: DataFrame, docs: DataFrame) -> DataFrame:
        """Rows of a document's last segment."""
        last = docs.groupBy("doc").agg(F.max("segment").alias("last")).where("last > 0")
        return rows.join(last, "doc", "left").where(F.col("last").isNull() | (F.col("segment") == F.col("last"))).drop("last")

    def write(self, path: str) -> None:
        """The index as tables of one segment."""
        self._segment(path, 0)

    def upsert(self, path: str) -> None:
        """This index's documents into a stored one: rows that it has of them no longer count."""
        last = self.spark.read.parquet(f"{path}/stats").agg(F.max("segment")).first()[0]
        self._segment(path, last + 1)

    @classmethod
    def read(cls, docs: DataFrame, key: str, path: str) -> TextIndex:
        index = cls.__new__(cls)
        index.docs, index.key, index.spark = docs, key, docs.sparkSession
        stored = {n: index.spark.read.parquet(f"{path}/{n}") for n in ("postings", "keys", "docs", "stats")}
        last = stored["stats"].agg(F.max("segment")).first()[0]
        index.stats = stored["stats"].where(F.col("segment") == last).drop("segment")
        index.postings = (index._live(stored["postings"], stored["docs"]) if last else stored["postings"]).drop("segment")
        # A term that only rows have that no longer count finds nothing.
        index.keys = stored["keys"].select("field", "term", "k").distinct() if last else stored["keys"].drop("segment")
        return index

    def _scored(self, pairs: list[tuple[str, str, str, float]]) -> DataFrame:
        """field, q, doc, s, x: each query word's best hit in each document, and its exact hit.

        pairs: (field, word, term, weight), a query's words and their few expansions; they choose what is read of the postings.
        """
        p = self.spark.createDataFrame(pairs, "field string, q string, term string, weight double")
        some = self.postings.where(F.col("field").isin(sorted({x[0] for x in pairs})) & F.col("term").isin(sorted({x[2] for x in pairs})))
        hits = some.join(F.broadcast(p), ["field", "term"])
        df = hits.groupBy("field", "q", "term").agg(F.count("*").alias("df"))
        hits = hits.join(F.broadcast(self.stats), "field").join(F.broadcast(df), ["field", "q", "term"])
        idf = F.log(1 + (F.col("n_docs") - F.col("df") + 0.5) / (F.col("df") + 0.5))
        tf = F.col("tf") / (F.col("tf") + K1 * (1 - B + B * F.col("dl") / F.col("avg_dl")))
        hits = hits.withColumn("s", idf * tf * F.col("weight"))
        return hits.groupBy("field", "doc", "q").agg(F.max("s").alias("s"), F.max(F.when(F.col("q") == F.col("term"), F.col("s"))).alias("x"))

    def bm25(self, query: str, field: str) -> DataFrame:
        """doc, score: plain OR of the query's words."""
        words = query_words(query)
        return self._scored([(field, w, w, 1.0) for w in words]).groupBy("doc").agg(F.sum("s").alias("score"))

    def search(self, query: str, fields: list[str], accented: str | None = None, fuzzy: bool = True) -> DataFrame:
        """doc, score of the ranking above; the best field counts."""
        words = query_words(query)
        if not words:
            return self.docs.select(F.col(self.key).alias("doc"), F.lit(0.0).alias("score")).limit(0)
        need = required(len(words))
        pairs = [(f, w, w, 1.0) for f in fields for w in words]
        if fuzzy:  # at most EXPANSIONS a field and word
            pairs = [tuple(r) for r in self.expansions(words).where(F.col("field").isin(fields)).select("field", "q", "term", "weight").collect()]
        t = self._scored(pairs).groupBy("field", "doc").agg(F.sum("s").alias("sum"), F.count("*").alias("hits"), F.sum("x").alias("xsum"), F.count("x").alias("xhits"))
        best = lambda v, ok: F.coalesce(F.max(F.when(ok, F.col(v))), F.lit(0.0))
        score = best("sum", F.lit(True)) + 5 * best("sum", F.col("hits") >= need) + 3 * best("xsum", F.col("xhits") >= need)
        out = t.groupBy("doc").agg(score.alias("score"))
        if accented and has_accents(query):
            aw = query_words(query, fold=False)
            plus = self._scored([(accented, w, w, 1.0) for w in aw]).groupBy("doc").agg(F.sum("s").alias("plus"), F.count("*").alias("n")).where(F.col("n") == len(aw))
            out = out.join(plus, "doc", "left").select("doc", (F.col("score") + 3 * F.coalesce("plus", F.lit(0.0))).alias("score"))
        return out


def has_accents(query: str) -> bool:
    return any(unicodedata.combining(c) for c in unicodedata.normalize("NFD", query)) or "đ" in query.lower()


def within_one(a: str, b: str) -> Column:
    """One edit at most between columns a and b, a swap of neighbours being one."""
    n = F.length(a)
    i = F.expr(f"aggregate(sequence(1, greatest(1, length({a}))), 0, (s, i) -> if(s = 0 and substring({a}, i, 1) <> substring({b}, i, 1), i, s))")
    swap = (n == F.length(b)) & (i > 0) & (F.substring(F.col(a), i, F.lit(1)) == F.substring(F.col(b), i + 1, F.lit(1))) & (F.substring(F.col(a), i + 1, F.lit(1)) == F.substring(F.col(b), i, F.lit(1))) & (F.substring(F.col(a), i + 2, n) == F.substring(F.col(b), i + 2, n))
    return (F.levenshtein(a, b, 1) >= 0) | swap


def hits(scores: DataFrame, docs: DataFrame, key: str, k: int = 100, video_ids: list[str] | None = None, frame_ids: list[str] | None = None, min_score: float | None = None) -> DataFrame:
    """The best k with the columns of a hit; filters and min_score apply before, ties (to six places) go by id."""
    d = docs.where(in_filter(F.col("video_id"), video_ids, False) & in_filter(F.col(key), frame_ids, True))
    t = scores.join(d.select(F.col(key).alias("doc"), "video_id", "shot_id", "frame_idx", "timestamp_ms"), "doc")
    if min_score is not None:
        t = t.where(F.col("score") >= min_score)
    return t.select(F.col("doc").alias("keyframe_id"), "video_id", "shot_id", "frame_idx", "timestamp_ms", "score").orderBy(F.desc(F.round("score", 6)), "keyframe_id").limit(k)


def vector_scores(entities: DataFrame, key: str, vector: str, query: Sequence[float]) -> DataFrame:
    """doc, score: exact cosine with the query vector, a matrix product a batch; entities of another length are left out, and those without a cosine."""
    q = np.array(query, np.float64)
    q /= max(np.linalg.norm(q), 1e-300)

    @F.pandas_udf("double")
    def cosine(v: pd.Series) -> pd.Series:
        m = np.stack(v.to_numpy()).astype(np.float64)
        with np.errstate(all="ignore"):
            c = m @ q / np.linalg.norm(m, axis=1)
        return pd.Series(c).where(np.isfinite(c))

    t = entities.where(F.size(vector) == len(query)).select(F.col(key).alias("doc"), cosine(F.col(vector)).alias("score"))
    return t.where("score is not null")


#: Queries that are held against all entities at a time.
QUERIES = 4096


def batch_top(queries: DataFrame, entities: DataFrame, key: str, vector: str, k: int) -> DataFrame:
    """query, doc, score, rank: the k nearest entities of each of a set of queries, by blocks of matrix products.

    A block of about ``QUERIES`` is broadcast and held against all entities; each task keeps its k best a query. Of several
    blocks each one's result is written before the next is read, so the driver holds one.
    """
    named = queries.select(F.col(key).alias("q"), F.col(vector).alias("v")).where("v is not null")
    kind = dict(queries.dtypes)[key]
    n_blocks = -(-named.count() // QUERIES)
    t = entities.select(F.col(key).alias("doc"), F.col(vector).alias("v"))
    out = None
    for block in range(n_blocks):
        rows = (named.where(F.pmod(F.xxhash64("q"), F.lit(n_blocks)) == block) if n_blocks > 1 else named).collect()
        ids, m = [r[0] for r in rows], np.array([r[1] for r in rows], np.float64)
        m /= np.maximum(np.linalg.norm(m, axis=1), 1e-300)[:, None]
        shared = queries.sparkSession.sparkContext.broadcast((ids, m))

        def run(batches, shared=shared):
            ids, m = shared.value
            names, best = np.array(ids), []
            for b in batches:
                b = b[b["v"].map(lambda v: v is not None and len(v) == m.shape[1])]
                if not len(b):
                    continue
                e = np.stack(b["v"]).astype(np.float64)
                s = m @ (e / np.maximum(np.linalg.norm(e, axis=1), 1e-300)[:, None]).T
                top = np.argpartition(-s, min(k, s.shape[1]) - 1, axis=1)[:, : min(k, s.shape[1])]
                i = np.repeat(np.arange(len(m)), top.shape[1])
                best.append(pd.DataFrame({"query": names[i], "doc": b["doc"].to_numpy()[top.ravel()], "score": s[i, top.ravel()]}))
                if len(best) > 8:
                    best = [pd.concat(best).sort_values(["query", "score"], ascending=[True, False]).groupby("query").head(k)]
            if best:
                yield pd.concat(best).sort_values(["query", "score", "doc"], ascending=[True, False, True]).groupby("query").head(k)

        hits = t.mapInPandas(run, f"query {kind}, doc {kind}, score double")
        if n_blocks > 1:
            hits = cut(hits)
            shared.destroy()
        out = hits if out is None else out.unionByName(hits)
    if out is None:
        return entities.sparkSession.createDataFrame([], f"query {kind}, doc {kind}, score double, rank int")
    w = Window.partitionBy("query").orderBy(F.desc("score"), "doc")
    return out.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def object_hits(frames: DataFrame, labels: list[str], k: int = 100, video_ids: list[str] | None = None, frame_ids: list[str] | None = None, min_score: float | None = None) -> DataFrame:
    """The first k frames by id with any of the labels, by their highest confidence; min_score applies after the limit."""
    t = frames.where(in_filter(F.col("video_id"), video_ids, False) & in_filter(F.col("frame_id"), frame_ids, True))
    t = t.where(F.arrays_overlap(F.map_keys("objects"), F.array(*[F.lit(x) for x in labels]))).orderBy("frame_id").limit(k)
    best = F.array_max(F.transform(F.array(*[F.lit(x) for x in labels]), lambda x: F.try_element_at("objects", x)))
    t = t.withColumn("score", best)
    if min_score is not None:
        t = t.where(F.col("score") >= min_score)
    return t.select(F.col("frame_id").alias("keyframe_id"), "video_id", "shot_id", "frame_idx", "timestamp_ms", "score").orderBy(F.desc("score"), "keyframe_id")
