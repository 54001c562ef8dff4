"""Further queries, a rule of an operator each, with the SQL that gives the same rows.

Inputs are the project's tables, or columns of the general ones taken as what the operator reads (boxes, predictions, records).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from shotlake import models
from shotlake.functions import columns as C
from shotlake.functions import images
from shotlake.operators import aggregates, checks, joins, merge, selection, sequence, vectors
from shotlake.plans import core_queries, documents, extraction
from shotlake.plans.core_queries import FRAMES, SEGS, SHOTS, TICKS, frames, query, segments, shots, ticks
from shotlake.plans.lineage import scratch
from shotlake.plans.reader import Reader
from shotlake.sources import readers, sinks
from shotlake.sources.tables import table
from shotlake.streaming import incremental

_before = set(core_queries.QUERIES)

# --- sources and sinks ------------------------------------------------------------------------------


@query(f"WITH {FRAMES} SELECT _id AS frame_id, ocr_text AS text FROM frames WHERE ocr_text IS NOT NULL")
def json_lines_written_and_read(s, d):
    t = frames(s, d).where("ocr_text is not null").select(F.col("_id").alias("frame_id"), F.col("ocr_text").alias("text"))
    path = scratch(s)
    sinks.append_lines(t.where("length(text) % 2 = 0"), path)
    sinks.append_lines(t.where("length(text) % 2 = 1"), path)
    return readers.json_lines(s, path, "frame_id string, text string")


@query("SELECT _id, CASE WHEN video_id LIKE '%1' THEN 'second' ELSE 'first' END AS run FROM (SELECT DISTINCT ON (_id) * FROM seg_doc)")
def videos_replaced(s, d):
    """A second run replaces the folders of its videos only."""
    t, path = segments(s, d).select("_id", "video_id"), scratch(s)
    sinks.by_video(t.withColumn("run", F.lit("first")), path, "parquet")
    sinks.by_video(t.where("video_id like '%1'").withColumn("run", F.lit("second")), path, "parquet")
    return s.read.parquet(path).select("_id", "run")


@query("SELECT o_orderstatus AS name, count(*) AS n, round(avg(o_totalprice), 3) AS mean FROM orders GROUP BY o_orderstatus")
def summary_written_and_read(s, d):
    t = table(s, d, "orders").groupBy(F.col("o_orderstatus").alias("name")).agg(F.count("*").alias("n"), F.avg("o_totalprice").alias("mean"))
    path = scratch(s)
    sinks.summary_csv(t, path)
    return s.read.option("header", True).schema("name string, n long, mean double").csv(path)


@query("SELECT o_orderkey, o_custkey FROM orders")
def shards_merged(s, d):
    t = table(s, d, "orders").select("o_orderkey", "o_custkey")
    return merge.merged_shards([t.where(f"o_orderkey % 3 = {k}") for k in range(3)], t, "o_orderkey")


@query("SELECT DISTINCT o_custkey AS k FROM orders")
def spool_synced(s, d):
    """Two runs of a sync over a growing spool: each key once."""
    t, spool, target, mark = table(s, d, "orders").select(F.col("o_custkey").alias("k")), scratch(s), scratch(s), scratch(s)
    for part in (0, 1):
        sinks.append_lines(t.where(f"k % 2 = {part} or k % 3 = 0"), spool)
        incremental.sync(incremental.spool(s, spool, "k long"), "k", target, mark).awaitTermination()
    return s.read.parquet(target)


@query(f"""WITH {FRAMES} SELECT _id AS frame_id FROM frames WHERE video_id IN (SELECT video_id FROM shot_doc) AND _id NOT IN (SELECT frame_id FROM es_doc WHERE frame_id IS NOT NULL) AND trim(shot_id) <> ''""")
def job_list(s, d):
    f = frames(s, d).select(F.col("_id").alias("frame_id"), "video_id", "shot_id")
    return readers.job_list(f, table(s, d, "es_doc"), f.where("trim(shot_id) = ''"), table(s, d, "shot_doc")).select("frame_id")


@query(f"""WITH {FRAMES} SELECT image_path AS path, CAST(frame_idx AS INT) AS id FROM frames WHERE frame_idx BETWEEN 1000 AND 9000""")
def sparse_frames(s, d):
    f = frames(s, d).select("video_id", F.col("_id").alias("name"), F.col("image_path").alias("path"), F.col("frame_idx").alias("id"))
    return readers.sparse_frames(f.drop("id"), f.drop("path"), 1000, 9000).select("path", "id")


@query("""WITH b AS (SELECT min(event_id) AS bad FROM events WHERE event_id BETWEEN 100 AND 9000 AND (event_id - 100) % 7 = 0 AND value > 300)
SELECT event_id FROM events, b WHERE event_id BETWEEN 100 AND 9000 AND (event_id - 100) % 7 = 0 AND (bad IS NULL OR event_id < bad)""")
def read_range(s, d):
    """Every seventh frame of a range, up to the first that can't be read."""
    return sequence.strided(table(s, d, "events").withColumn("ok", F.col("value") <= 300), "event_id", 100, 9000, 7, "ok").select("event_id")


@query("SELECT DISTINCT _id AS video FROM video_doc WHERE regexp_matches(_id, '^[A-Za-z]+[0-9]+[_-][Vv][0-9]+$')")
def video_names(s, d):
    v = table(s, d, "video_doc").select(F.col("_id").alias("video")).distinct()
    return v.unionByName(v.select(F.concat("video", F.lit("x")).alias("video"))).where(C.is_video_name(F.col("video")))


# --- rows and checks --------------------------------------------------------------------------------


@query(f"""WITH {SEGS}, k AS (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY seg_id, start_ms) - 1 AS k FROM segs)
SELECT video_id, video_id || printf('_%06d', k) AS seg_id, CAST(round_even(start_ms / 1000.0 * 1000, 0) AS BIGINT) AS start_ms, CAST(round_even(end_ms / 1000.0 * 1000, 0) AS BIGINT) AS end_ms, trim(text) AS text, CAST(0 AS DOUBLE) AS confidence FROM k WHERE length(trim(text)) > 0""")
def speech_rows(s, d):
    t = segments(s, d).groupBy("video_id").agg(F.sort_array(F.collect_list(F.struct("seg_id", "start_ms", "end_ms", "text"))).alias("x"))
    t = t.select("video_id", F.transform("x", lambda x: F.struct((x["start_ms"] / 1000).alias("start"), (x["end_ms"] / 1000).alias("end"), x["text"].alias("text"))).alias("segments"))
    return sequence.vad_rows(t).withColumn("confidence", F.col("confidence").cast("double"))


@query(f"""WITH {FRAMES}, v AS (SELECT _id, any_value(fps) AS fps FROM video_doc GROUP BY _id) SELECT frames._id AS frame_id, CAST(trunc(frame_idx / greatest(coalesce(fps, 0.5), 1.0) * 1000) AS BIGINT) AS ms FROM frames JOIN v ON video_id = v._id""")
def keyframe_times(s, d):
    v = table(s, d, "video_doc").groupBy(F.col("_id").alias("video_id")).agg(F.max("fps").alias("fps"))
    t = frames(s, d).join(v, "video_id")
    return t.select(F.col("_id").alias("frame_id"), C.keyframe_ms(F.col("frame_idx"), F.coalesce("fps", F.lit(0.5))).alias("ms"))


@query(f"WITH {SHOTS} SELECT shot_id, (end_frame - start_frame) / greatest(fps, 1.0) AS seconds, end_frame - start_frame + 1 AS n FROM shots WHERE start_frame IS NOT NULL")
def shot_lengths(s, d):
    a, z, fps = F.col("start_frame"), F.col("end_frame"), F.col("fps")
    return shots(s, d).where("start_frame is not null").select("shot_id", C.duration_sec(a, z, fps).alias("seconds"), C.total_frames(a, z).alias("n"))


@query(f"WITH {SEGS} SELECT seg_id AS _id, video_id, seg_id, start_ms, end_ms, text FROM segs")
def segment_documents(s, d):
    return documents.segment_docs(segments(s, d))


@query(f"""WITH {FRAMES} SELECT _id, video_id, shot_id, CAST(frame_idx AS INT) AS frame_idx, timestamp_ms, image_path, 'b' AS batch, ocr_text, FALSE AS milvus, 0 AS n_objects FROM (SELECT * REPLACE (CAST(NULL AS VARCHAR) AS ocr_text) FROM frames)""")
def frame_documents(s, d):
    f = frames(s, d).withColumnRenamed("_id", "keyframe_id")
    t = documents.frame_docs(f, "b")
    return t.select("_id", "video_id", "shot_id", "frame_idx", "timestamp_ms", "image_path", "batch", "ocr_text", F.col("synced.milvus").alias("milvus"), F.size("objects").alias("n_objects"))


@query(f"""WITH {FRAMES}, v AS (SELECT frame_id, min(len(embedding)) AS n FROM milvus_entity GROUP BY frame_id) SELECT v.frame_id, video_id, CAST(frame_idx AS BIGINT) AS frame_idx, shot_id, timestamp_ms, v.n FROM v JOIN frames ON frame_id = _id""")
def vector_documents(s, d):
    v = table(s, d, "milvus_entity").groupBy(F.col("frame_id").alias("keyframe_id")).agg(F.min(F.when(F.col("embedding").isNotNull(), F.size("embedding"))).cast("long").alias("embedding"))
    return documents.vector_entities(frames(s, d), joins.only(v, frames(s, d).select(F.col("_id").alias("keyframe_id")), "keyframe_id")).withColumnRenamed("embedding", "n")


@query("WITH v AS (SELECT _id, max(fps) AS fps, max(media_info) AS media_info FROM video_doc GROUP BY _id) SELECT _id, coalesce(fps, 30.0) AS fps, 'b' AS batch, media_info FROM v")
def video_documents(s, d):
    v = table(s, d, "video_doc").groupBy(F.col("_id").alias("video_id")).agg(F.max("fps").alias("fps"), F.max("media_info").alias("media_info"))
    return documents.video_docs(v.drop("fps"), v.drop("media_info").where("fps is not null"), "b")


@query("SELECT event_id, CASE WHEN value < 50 THEN CAST([] AS VARCHAR[]) ELSE [event_type] END AS texts FROM events")
def texts_unless_blurred(s, d):
    return table(s, d, "events").select("event_id", checks.unless_blurred(F.col("value"), F.array("event_type")).alias("texts"))


@query("SELECT l_orderkey AS frame_id, l_returnflag || l_linestatus AS label, max(l_discount * 10) AS confidence FROM lineitem WHERE l_discount * 10 >= 0.5 GROUP BY ALL")
def confident_tags(s, d):
    """Labels that come several times, with confidences on both sides of the threshold."""
    o = F.struct(F.concat("l_returnflag", "l_linestatus").alias("label"), (F.col("l_discount") * 10).alias("confidence"))
    t = table(s, d, "lineitem").groupBy(F.col("l_orderkey").alias("frame_id")).agg(F.collect_list(o).alias("objects"))
    return aggregates.max_confidence(t).select("frame_id", F.explode("objects").alias("label", "confidence"))


@query("SELECT l_orderkey AS frame_id, coalesce(string_agg(l_returnflag || l_linestatus, ' ' ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) FILTER (WHERE l_discount * 10 >= 0.5), '') AS text FROM lineitem GROUP BY l_orderkey")
def confident_lines(s, d):
    r = F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", F.concat("l_returnflag", "l_linestatus").alias("text"), (F.col("l_discount") * 10).alias("confidence"))
    return aggregates.confident_text(table(s, d, "lineitem").groupBy(F.col("l_orderkey").alias("frame_id")).agg(F.sort_array(F.collect_list(r)).alias("texts")))


@query("SELECT 'seg' AS name, count(*) AS n FROM seg_doc WHERE video_id NOT LIKE '%2' UNION ALL SELECT 'shot', count(*) FROM shot_doc WHERE video_id NOT LIKE '%2'")
def videos_purged(s, d):
    v = table(s, d, "video_doc").select(F.col("_id").alias("video_id")).where("video_id like '%2'").distinct()
    left = merge.purge({n: table(s, d, f"{n}_doc") for n in ("seg", "shot")}, v)
    out = [t.agg(F.count("*").alias("n")).select(F.lit(n).alias("name"), "n") for n, t in left.items()]
    return out[0].unionByName(out[1])


@query(f"""WITH {FRAMES}, k AS (SELECT _id AS keyframe_id, video_id FROM frames UNION ALL SELECT _id, video_id || '0' FROM frames WHERE frame_idx % 5 = 0 UNION ALL SELECT video_id || '1' || substring(_id, length(video_id) + 1), video_id FROM frames WHERE frame_idx % 7 = 0 UNION ALL SELECT _id || '/x', video_id FROM frames WHERE frame_idx % 11 = 0)
SELECT keyframe_id, CASE WHEN contains(keyframe_id, '/') THEN 'path' ELSE 'video' END AS fault FROM k WHERE contains(keyframe_id, '/') OR NOT starts_with(keyframe_id, video_id || '_')
UNION ALL SELECT keyframe_id, 'duplicate' FROM k GROUP BY keyframe_id HAVING count(*) > 1""")
def keyframe_faults(s, d):
    """Names of other videos (also of one whose name goes on with a digit), of no file, and repeated ones."""
    f = frames(s, d).select(F.col("_id").alias("keyframe_id"), "video_id", "frame_idx")
    k = f.unionByName(f.where("frame_idx % 5 = 0").withColumn("video_id", F.concat("video_id", F.lit("0"))))
    k = k.unionByName(f.where("frame_idx % 7 = 0").withColumn("keyframe_id", F.concat("video_id", F.lit("1"), F.expr("substring(keyframe_id, length(video_id) + 1)"))))
    return checks.keyframe_faults(k.unionByName(f.where("frame_idx % 11 = 0").withColumn("keyframe_id", F.concat("keyframe_id", F.lit("/x")))))


@query("SELECT vec_id, round(CAST(embedding[1] AS DOUBLE) / sqrt(list_inner_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[]))), 5) AS first FROM embeddings")
def unit_vectors(s, d):
    e = table(s, d, "embeddings").select("vec_id", C.unit(F.transform("embedding", lambda x: x * 3)).alias("u"))
    return e.where(F.abs(C.norm(F.col("u")) - 1) < 1e-6).select("vec_id", F.round(F.col("u")[0].cast("double"), 5).alias("first"))


@query("SELECT p_partkey, length(p_name) <= 12 AND length(trim(regexp_replace(lower(p_name), '[^aeiou]', '', 'g'))) > 0 AS fits FROM (SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN 'xyz' ELSE p_name END AS p_name FROM part)")
def labels_that_fit(s, d):
    """A label of which the character set leaves nothing doesn't fit."""
    t = table(s, d, "part").withColumn("label", F.expr("if(p_partkey % 3 = 0, 'xyz', p_name)"))
    return t.select("p_partkey", checks.label_fits(F.col("label"), 12, "aeiou").alias("fits"))


@query(f"WITH {FRAMES} SELECT _id FROM frames WHERE length(ocr_text) > 0 AND frame_idx % 2 = 0")
def readable_with_text(s, d):
    return checks.has_text(checks.readable(frames(s, d).withColumn("decoded", F.expr("if(frame_idx % 3 = 0 and frame_idx % 2 = 1, null, frame_idx % 2 = 0)"))), "ocr_text").select("_id")


# --- joins ------------------------------------------------------------------------------------------


@query(f"""WITH {FRAMES}, o AS (SELECT _id AS frame_id, CASE WHEN frame_idx % 4 = 1 THEN '' ELSE 'own' END AS text FROM frames WHERE frame_idx % 4 < 2 UNION ALL SELECT DISTINCT video_id, 'video' FROM frames WHERE video_id LIKE '%1' OR video_id = 'N00_V999')
SELECT f._id AS frame_id, CASE WHEN a.frame_id IS NOT NULL THEN a.text ELSE b.text END AS ocr_text, CASE WHEN f.frame_idx % 3 = 0 THEN 'api' END AS ocr_api, CASE WHEN length(f.caption) > 0 THEN f.caption END AS caption, coalesce(len(map_keys(f.objects)), 0) AS n
FROM frames f LEFT JOIN o a ON a.frame_id = f._id LEFT JOIN o b ON b.frame_id = f.video_id""")
def frames_enriched(s, d):
    """Recognised text of the frame, an empty one too; only where the frame has none, that of its video."""
    f = frames(s, d)
    own = f.where("frame_idx % 4 < 2").select(F.col("_id").alias("frame_id"), F.expr("if(frame_idx % 4 = 1, '', 'own')").alias("text"))
    video = f.where("video_id like '%1' or video_id = 'N00_V999'").select(F.col("video_id").alias("frame_id"), F.lit("video").alias("text")).distinct()
    api = f.where("frame_idx % 3 = 0").select(F.col("_id").alias("frame_id"), F.lit("api").alias("text"))
    caption = f.where("caption is not null").select(F.col("_id").alias("frame_id"), F.col("caption").alias("text"))
    objects = f.where("objects is not null").select(F.col("_id").alias("frame_id"), "objects")
    t = joins.enrich(f.select(F.col("_id").alias("frame_id"), "video_id"), objects, own.unionByName(video), api, caption)
    return t.select("frame_id", "ocr_text", "ocr_api", "caption", F.coalesce(F.when(F.col("objects").isNotNull(), F.size("objects")), F.lit(0)).cast("long").alias("n"))


@query("SELECT o_custkey, max(o_orderkey) AS o_orderkey, arg_max(o_totalprice, o_orderkey) AS o_totalprice FROM orders GROUP BY o_custkey")
def last_rows(s, d):
    return joins.last_wins(table(s, d, "orders").select("o_custkey", "o_orderkey", "o_totalprice"), ["o_custkey"], ["o_orderkey"])


@query(f"WITH {FRAMES} SELECT frame_id FROM milvus_entity WHERE frame_id IN (SELECT _id FROM frames WHERE frame_idx % 2 = 0)")
def vectors_of_frames(s, d):
    return joins.only(table(s, d, "milvus_entity"), frames(s, d).where("frame_idx % 2 = 0").select(F.col("_id").alias("frame_id")), "frame_id").select("frame_id")


@query(f"""WITH {TICKS}, p AS (SELECT a.g, a.i, b.i AS j, b.v AS jv, row_number() OVER (PARTITION BY a.g, a.i ORDER BY b.v DESC, a.i = b.i DESC, b.i) AS r
FROM ticks a JOIN ticks b ON a.g = b.g AND abs(a.i - b.i) <= 4 AND (a.i = b.i OR (abs(a.v - b.v) + abs(a.v / 2 - b.v / 2)) / 2 < 25) WHERE a.i % 10 = 0) SELECT g AS shot_id, i AS frame_idx, j AS sharp_idx FROM p WHERE r = 1""")
def sharpest_frames(s, d):
    t = ticks(s, d).select(F.col("g").alias("shot_id"), F.col("i").alias("frame_idx"), F.col("v").alias("lap_var"), F.array("v", F.col("v") / 2).alias("thumb"))
    return selection.sharpest(t, t.where("frame_idx % 10 = 0").select("shot_id", "frame_idx"))


# --- aggregates -------------------------------------------------------------------------------------

_QUALITY = """p AS (SELECT o_orderpriority AS g, count(*) AS n FROM orders WHERE o_orderkey % 3 > 0 GROUP BY 1), t AS (SELECT o_orderpriority AS g, count(*) AS n FROM orders WHERE o_orderkey % 2 = 0 AND o_orderpriority <> '5-LOW' GROUP BY 1),
m AS (SELECT o_orderpriority AS g, count(*) AS n, avg(o_orderkey % 10) AS s FROM orders WHERE o_orderkey % 6 = 2 AND o_orderpriority <> '5-LOW' GROUP BY 1)"""


@query(f"""WITH {_QUALITY}, x AS (SELECT coalesce(p.g, t.g) AS g, coalesce(m.n, 0) AS tp, coalesce(p.n, 0) AS np, coalesce(t.n, 0) AS nt, coalesce(m.s, 0) AS s FROM p FULL JOIN t ON p.g = t.g LEFT JOIN m ON m.g = coalesce(p.g, t.g)),
y AS (SELECT *, CASE WHEN np = 0 THEN 0 ELSE tp / np END AS pr, CASE WHEN nt = 0 THEN 0 ELSE tp / nt END AS re FROM x)
SELECT g, tp, np - tp AS fp, nt - tp AS fn, round(pr, 6) AS precision, round(re, 6) AS recall, round(CASE WHEN pr + re = 0 THEN 0 ELSE 2 * pr * re / (pr + re) END, 6) AS f1, round(s, 6) AS mean_sim FROM y""")
def match_quality(s, d):
    o = table(s, d, "orders").select(F.col("o_orderpriority").alias("g"), "o_orderkey", (F.col("o_orderkey") % 10).alias("sim"))
    true = o.where("o_orderkey % 2 = 0 and g <> '5-LOW'")
    t = aggregates.match_quality(true.where("o_orderkey % 6 = 2"), o.where("o_orderkey % 3 > 0"), true, "g")
    return t.select("g", "tp", "fp", "fn", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1", "mean_sim")])


@query("SELECT count(*) AS n, round(avg(o_totalprice), 4) AS confidence, round(sum(o_totalprice * (o_orderkey % 5)) / sum(o_orderkey % 5), 4) AS loss FROM orders")
def recogniser_losses(s, d):
    t = table(s, d, "orders").select(F.col("o_orderpriority").alias("pred"), F.col("o_orderpriority").alias("truth"), F.col("o_totalprice").alias("confidence"), F.col("o_totalprice").alias("loss"), (F.col("o_orderkey") % 5).alias("weight"))
    return aggregates.recogniser_scores(t).select("n", F.round("confidence", 4).alias("confidence"), F.round("loss", 4).alias("loss"))


@query("SELECT l_orderkey AS frame_id, l_linenumber % 3 AS line, round_even(avg(l_quantity), 4) AS confidence FROM lineitem GROUP BY ALL")
def line_confidence(s, d):
    return aggregates.line_confidence(table(s, d, "lineitem").select(F.col("l_orderkey").alias("frame_id"), (F.col("l_linenumber") % 3).alias("line"), F.col("l_quantity").alias("confidence")))


@query("SELECT l_orderkey AS frame_id, round(product(l_discount * 0.73 + 0.317), 6) AS confidence FROM lineitem GROUP BY l_orderkey")
def sequence_confidence(s, d):
    t = table(s, d, "lineitem").groupBy(F.col("l_orderkey").alias("frame_id")).agg(F.sort_array(F.collect_list(F.col("l_discount") * 0.73 + 0.317)).alias("p"))
    return t.select("frame_id", F.round(aggregates.sequence_confidence(F.col("p")), 6).alias("confidence"))


# --- sequences --------------------------------------------------------------------------------------


@query(f"WITH {SHOTS}, {FRAMES} SELECT f._id AS frame_id, CAST(floor((f.frame_idx - s.start_frame) / 1200) AS BIGINT) AS win FROM frames f JOIN shots s ON f.shot_id = s.shot_id WHERE s.start_frame IS NOT NULL")
def window_numbers(s, d):
    t = frames(s, d).select("_id", "shot_id", "frame_idx").join(shots(s, d).select("shot_id", "start_frame").where("start_frame is not null"), "shot_id")
    return t.select(F.col("_id").alias("frame_id"), sequence.window_no(F.col("frame_idx"), F.col("start_frame")).alias("win"))


@query(f"""WITH RECURSIVE {TICKS}, r AS (SELECT g, i, row_number() OVER (PARTITION BY g ORDER BY i) AS k FROM ticks WHERE v > 60),
f AS (SELECT DISTINCT g, CAST(0 AS BIGINT) AS k, CAST(NULL AS BIGINT) AS last, CAST(NULL AS BIGINT) AS i FROM r UNION ALL SELECT f.g, r.k, CASE WHEN last IS NULL OR r.i - last >= 50 THEN r.i ELSE last END, r.i FROM f JOIN r ON r.g = f.g AND r.k = f.k + 1) SELECT g, i FROM f WHERE i = last""")
def spaced_frames(s, d):
    return selection.select_spaced(ticks(s, d).where("v > 60").select("g", "i"), ["g"], "i", 50)


_IDS = "ids AS (SELECT l_orderkey AS k, list(CAST(l_suppkey % 3 AS INT) ORDER BY l_linenumber, l_partkey, l_suppkey) AS x FROM lineitem GROUP BY l_orderkey)"


def _ids(s, d):
    t = table(s, d, "lineitem").groupBy(F.col("l_orderkey").alias("k")).agg(F.sort_array(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey"))).alias("x"))
    return t.select("k", F.transform("x", lambda x: (x["l_suppkey"] % 3).cast("int")).alias("x"))


@query(f"WITH {_IDS} SELECT k, [x[i] FOR i IN range(1, len(x) + 1) IF (i = 1 OR x[i] <> x[i - 1]) AND x[i] <> 0] AS ids FROM ids")
def ctc_collapse(s, d):
    return _ids(s, d).select("k", C.ctc_collapse(F.col("x")).alias("ids"))


@query(f"WITH {_IDS}, p AS (SELECT k, x, coalesce(nullif(list_position(x, 0), 0), len(x) + 1) AS e FROM ids) SELECT k, x[1 : e - 1] AS ids, CAST(greatest(len(x) - e, 0) AS INT) AS padding FROM p")
def before_end(s, d):
    pad = F.aggregate(C.padding_after_end(F.col("x"), 0), F.lit(0), lambda n, p: n + p.cast("int"))
    return _ids(s, d).select("k", C.before_end(F.col("x"), 0).alias("ids"), pad.alias("padding"))


@query("SELECT vec_id, CAST(list_position(embedding, list_max(embedding)) - 1 AS INT) AS at, CAST(list_max(embedding) AS FLOAT) AS p FROM embeddings")
def greedy_choice(s, d):
    at, p = C.greedy_choice(F.col("embedding"))
    return table(s, d, "embeddings").select("vec_id", at.alias("at"), p.alias("p"))


@query("SELECT p_partkey, [strpos('abcdefghijklmnopqrstuvwxyz ', c) FOR c IN string_split(p_name, '')] AS ids, p_name AS back FROM part")
def chars_encoded(s, d):
    letters = "abcdefghijklmnopqrstuvwxyz "
    t = table(s, d, "part").select("p_partkey", "p_name", C.encode_chars(F.col("p_name"), letters, 30).alias("x"))
    return t.where((F.size("x") == 30) & (F.element_at("x", 30) == -1)).select("p_partkey", F.transform(C.before_end(F.col("x"), 0), lambda i: i.cast("long")).alias("ids"), C.decode_chars(F.col("x"), letters).alias("back"))


@query("WITH n AS (SELECT DISTINCT _id AS video FROM video_doc) SELECT video, CAST(row_number() OVER (ORDER BY regexp_extract(lower(video), '^[^0-9]*'), CAST(regexp_extract(video, '[0-9]+') AS INT), CAST(regexp_extract(video, '([0-9]+)$', 1) AS INT)) AS BIGINT) - 1 AS row_no FROM n")
def natural_slices(s, d):
    """Numbers of rows in natural order."""
    v = table(s, d, "video_doc").select(F.col("_id").alias("video")).distinct().withColumn("key", C.natural_key(F.col("video")))
    return sequence.sliced(v, ["key"], 0).select("video", "row_no")


# --- functions --------------------------------------------------------------------------------------


@query("SELECT doc_id, strip_accents(replace(replace(text, 'đ', 'd'), 'Đ', 'D')) <> text OR regexp_matches(text, '\\p{M}') AS accents, md5(replace(text, ' ', '_')) AS lined FROM documents")
def accents_and_underscores(s, d):
    t = table(s, d, "documents").select("doc_id", "text", F.replace("text", F.lit(" "), F.lit("_")).alias("lined"))
    back = C.underscores_to_spaces(F.col("lined"))
    return t.select("doc_id", C.has_diacritics(F.col("text")).alias("accents"), F.md5(F.when(F.contains("text", F.lit("_")) | (back == F.col("text")), F.col("lined"))).alias("lined"))


@query(f"WITH {FRAMES} SELECT _id, nfc_normalize(ocr_text) AS text FROM frames")
def composed_text(s, d):
    return frames(s, d).select("_id", C.composed(F.col("ocr_text")).alias("text"))


@query("SELECT event_id, printf('lúc %02d:%02d năm 20%02d 1%d0%d 9%d%%x', event_id % 24, event_id % 60, event_id % 30, event_id % 9 + 1, event_id % 7, event_id % 10) AS text FROM events")
def numbers_fixed(s, d):
    """Times, years, percentages and groups of digits in which 0 was read as O and 6 as b."""
    k = F.col("event_id")
    read = lambda n: F.translate(n.cast("string"), "06", "Ob")
    clock = lambda n: F.concat(F.floor(n / 10).cast("string"), read(n % 10))
    year = F.concat(F.lit("20"), read(F.floor(k % 30 / 10)), read(k % 10))
    misread = F.concat(F.lit("lúc "), clock(k % 24), F.lit(":"), clock(k % 60), F.lit(" năm "), year, F.lit(" 1"), k % 9 + 1, F.lit("O"), k % 7, F.lit(" 9"), F.translate((k % 10).cast("string"), "0", "O"), F.lit("%x"))
    return table(s, d, "events").select("event_id", C.fix_numbers(misread).alias("text"))


@query("SELECT p_partkey, regexp_replace(regexp_replace(p_name, '\\b([a-hj-np-z]+)o([a-hj-np-z]+)\\b', '\\1O\\2', 'g'), '\\b([a-hj-np-z]+)i([a-hj-np-z]+)\\b', '\\1I\\2', 'g') || ' Hà Nội đó A12 AB1C 7 TP.HCM' AS text FROM part")
def words_fixed(s, d):
    """0 and 1 inside words, cl for đ before a vowel, known terms; codes and numbers stay."""
    # One o or i between other letters of a word is read as a digit.
    misread = F.regexp_replace(F.regexp_replace("p_name", "\\b(?<a>[a-hj-np-z]+)o(?<b>[a-hj-np-z]+)\\b", "${a}0${b}"), "\\b(?<a>[a-hj-np-z]+)i(?<b>[a-hj-np-z]+)\\b", "${a}1${b}")
    return table(s, d, "part").select("p_partkey", F.replace(C.fix_words(F.concat(misread, F.lit("  ha_noi cló A12 AB1C 7 tphcm"))), F.lit("ha_noi"), F.lit("Hà Nội")).alias("text"))


@query("SELECT p_partkey, replace(p_name, ' ', '') || 'fi12Aa' AS label FROM part")
def labels_cleaned(s, d):
    """Accents, ligatures, wide and circled letters taken apart; other signs and white space dropped."""
    dirty = F.concat(F.translate("p_name", "aeiou", "áễíớủ"), F.lit(" ﬁ①２Ａａ木 đ"))
    return table(s, d, "part").select("p_partkey", C.clean_label(dirty).alias("label"))


@query(f"WITH {FRAMES} SELECT _id, image_path AS path, '/da.a/' || image_path AS full FROM frames")
def paths(s, d):
    f = frames(s, d).withColumn("full", C.absolute_path(F.col("image_path"), "/da.a/"))
    # A root's dot stands for itself: the other path stays as it is.
    same = C.relative_path(F.replace("full", F.lit("/da.a/"), F.lit("/data/")), "/da.a").startswith("/data/")
    return f.where(same).select("_id", C.relative_path(F.col("full"), "/da.a").alias("path"), "full")


@query("""WITH b AS (SELECT l_orderkey, l_linenumber, l_partkey, CAST(l_partkey % 90 AS INT) AS x, CAST(l_suppkey % 40 AS INT) AS y, CAST(20 + l_quantity AS INT) AS w, CAST(4 + l_quantity AS INT) AS h FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, greatest(0, x - CAST(trunc(h * 0.25) AS INT)) AS x1, greatest(0, y - CAST(trunc(h * 0.1) AS INT)) AS y1, least(100, x + w + CAST(trunc(h * 0.25) AS INT)) AS x2, least(60, y + h + CAST(trunc(h * 0.1) AS INT)) AS y2 FROM b""")
def boxes_padded(s, d):
    x, y, q = (F.col("l_partkey") % 90).cast("int"), (F.col("l_suppkey") % 40).cast("int"), F.col("l_quantity")
    t = table(s, d, "lineitem").withColumn("b", C.pad_box(F.array(x, y, x + (20 + q).cast("int"), y + (4 + q).cast("int")), F.lit(100), F.lit(60)))
    return t.select("l_orderkey", "l_linenumber", "l_partkey", *[F.col("b")[k].alias(n) for k, n in enumerate(("x1", "y1", "x2", "y2"))])


@query("SELECT l_orderkey AS k, trim(coalesce(string_agg(l_returnflag || ' ', '' ORDER BY l_linenumber, l_partkey, l_suppkey) FILTER (WHERE l_linestatus = 'F'), '')) AS text FROM lineitem GROUP BY l_orderkey")
def response_texts(s, d):
    p = F.struct("l_linenumber", "l_partkey", "l_suppkey", F.concat("l_returnflag", F.lit(" ")).alias("text"), F.expr("if(l_linestatus = 'F', if(l_linenumber % 2 = 0, false, null), true)").alias("thought"))
    t = table(s, d, "lineitem").groupBy(F.col("l_orderkey").alias("k")).agg(F.sort_array(F.collect_list(p)).alias("p"))
    return t.select("k", C.response_text(F.col("p")).alias("text"))


@query(f"WITH {SEGS} SELECT _id, trim(text) AS text FROM segs WHERE length(trim(text)) > 0")
def speech_texts(s, d):
    """Results of recognisers as objects, lists of objects and lists of texts."""
    text = F.trim("text")
    json = F.when(F.length("text") % 3 == 0, F.to_json(F.struct(text.alias("text")))).when(F.length("text") % 3 == 1, F.to_json(F.array(F.struct(text.alias("text"))))).otherwise(F.to_json(F.array(text)))
    return segments(s, d).where(F.length(text) > 0).select("_id", C.speech_text(json).alias("text"))


_GRID = "g AS (SELECT p_partkey AS k, r, c, CAST((p_partkey * 31 + r * r * 17 + c * 7 * r) % 256 AS DOUBLE) AS v FROM part, generate_series(0, 7) a(r), generate_series(0, 7) b(c))"


@query(f"""WITH {_GRID}, n AS (SELECT g.k, g.v, sum(o.v) AS around FROM g, (VALUES (0, 1), (0, -1), (1, 0), (-1, 0)) d(r, c), g o
WHERE o.k = g.k AND o.r = CASE g.r + d.r WHEN -1 THEN 1 WHEN 8 THEN 6 ELSE g.r + d.r END AND o.c = CASE g.c + d.c WHEN -1 THEN 1 WHEN 8 THEN 6 ELSE g.c + d.c END GROUP BY g.k, g.r, g.c, g.v)
SELECT CAST(k AS VARCHAR) AS key, round(var_pop(around - 4 * v), 4) AS lap_var, round(avg(v), 4) AS brightness FROM n GROUP BY k""")
def image_figures(s, d):
    """Sharpness and brightness of small images, mirrored at the edges."""
    at = F.transform(F.sequence(F.lit(0), F.lit(63)), lambda i: F.lpad(F.hex((F.col("p_partkey") * 31 + F.floor(i / 8) * F.floor(i / 8) * 17 + i % 8 * 7 * F.floor(i / 8)) % 256), 2, "0"))
    t = table(s, d, "part").select(F.col("p_partkey").cast("string").alias("key"), F.lit(8).alias("height"), F.lit(8).alias("width"), F.unhex(F.array_join(at, "")).alias("grey"))
    return images.frame_figures(t).select("key", F.round("lap_var", 4).alias("lap_var"), F.round("brightness", 4).alias("brightness"))


@query(f"WITH {FRAMES} SELECT video_id, count(*) AS n_keyframes, count(DISTINCT shot_id) AS n_shots, sum(CAST(length(image_path) AS BIGINT)) AS bytes, count(*) / count(DISTINCT shot_id) AS per_shot FROM frames GROUP BY video_id")
def keyframe_bytes(s, d):
    return aggregates.keyframe_stats(frames(s, d).withColumn("length", F.length("image_path").cast("long")))


@query("SELECT DISTINCT CAST(label AS VARCHAR) AS video_id, CASE WHEN CAST(label AS VARCHAR) < '5' THEN 1 ELSE 2 END AS run FROM embeddings WHERE label IS NOT NULL")
def extraction_run(s, d):
    """Two runs of an extraction: the second takes the videos that the first hadn't."""
    e = core_queries._windows(s, d).withColumns({"jpeg_size": F.col("score") + 500, "brightness": F.lit(100.0), "lap_var": F.lit(50.0)})
    sh = e.groupBy("video_id").agg(F.min("frame_idx").alias("start_frame"), F.max("frame_idx").alias("end_frame")).withColumns({"shot_id": F.concat("video_id", F.lit("_000000")), "fps": F.lit(25.0)})
    folder = scratch(s)
    first = extraction.run(e.where("video_id < '5'"), sh, folder).withColumn("run", F.lit(1))
    return first.unionByName(extraction.run(e, sh, folder).withColumn("run", F.lit(2)))


# --- status, models, sets -----------------------------------------------------------------------------


@query("""WITH v AS (SELECT DISTINCT _id AS video_id FROM video_doc) SELECT video_id, CASE WHEN video_id LIKE '%1' THEN 'done' ELSE 'failed' END AS frames, video_id NOT LIKE '%1' AS open FROM v WHERE video_id NOT LIKE '%2' """)
def step_status(s, d):
    v = table(s, d, "video_doc").select(F.col("_id").alias("video_id")).where("video_id not like '%2'").distinct()
    none = s.createDataFrame([], "video_id string, steps map<string,struct<status:string,updated_at:string>>")
    t = merge.set_status(merge.set_status(none, v, "frames", "failed"), v.where("video_id like '%1'"), "frames", "done")
    left = merge.not_done(v, t, "frames").withColumn("open", F.lit(True))
    return t.join(left, "video_id", "left").select("video_id", F.col("steps")["frames"]["status"].alias("frames"), F.coalesce("open", F.lit(False)).alias("open"))


@query("SELECT DISTINCT _id AS video_id FROM video_doc ORDER BY _id LIMIT 5")
def first_done(s, d):
    v = table(s, d, "video_doc").select(F.col("_id").alias("video_id")).distinct()
    none = s.createDataFrame([], "video_id string, steps map<string,struct<status:string,updated_at:string>>")
    return aggregates.done_videos(merge.set_status(none, v, "ocr", "done"), "ocr")


def _length_model():
    import pandas as pd

    return lambda b: pd.DataFrame({"p_partkey": b["p_partkey"], "n": b["p_name"].str.len().astype("int64")})


@query("SELECT p_partkey, length(p_name) AS n FROM part")
def model_applied(s, d):
    """A registered model over partitions, paced."""
    models.register("length", _length_model, "p_partkey long, n long")
    return models.apply(table(s, d, "part").select("p_partkey", "p_name"), "length", per_minute=6e7)


@query("""SELECT o_custkey AS k FROM orders WHERE o_custkey % 2 = 0 UNION SELECT c_custkey FROM customer WHERE c_custkey % 3 = 0 EXCEPT SELECT c_custkey FROM customer WHERE c_custkey % 5 = 0""")
def set_operations(s, d):
    c = table(s, d, "customer").select(F.col("c_custkey").alias("k"))
    return joins.without(table(s, d, "orders").select(F.col("o_custkey").alias("k")).where("k % 2 = 0").union(c.where("k % 3 = 0")).distinct(), c.where("k % 5 = 0"), "k")


# --- the read side ------------------------------------------------------------------------------------


@query("SELECT _id, shot_id, start_ms FROM (SELECT DISTINCT ON (_id) * FROM shot_doc) WHERE video_id = 'N00_V999'")
def shots_of_video(s, d):
    return Reader(s, d).shots("N00_V999").select("_id", "shot_id", "start_ms")


@query(f"WITH {SEGS} SELECT _id, start_ms, end_ms FROM segs WHERE video_id = 'N00_V999' AND start_ms < 200000 AND end_ms > 50000")
def transcript_of_video(s, d):
    return Reader(s, d).transcript("N00_V999", 50_000, 200_000).select("_id", "start_ms", "end_ms")


_QUERY_VECTOR = "(SELECT CAST(any_value(embedding) AS DOUBLE[]) AS q FROM milvus_entity WHERE frame_id = (SELECT min(frame_id) FROM milvus_entity WHERE video_id <> 'N00_V999' AND len(embedding) = 1152 AND list_aggregate(list_transform(embedding, lambda x: CASE WHEN x IS NULL OR isnan(x) OR isinf(x) THEN 1 ELSE 0 END), 'sum') = 0 AND list_aggregate(list_transform(embedding, lambda x: abs(x)), 'max') > 0))"


@query(f"""WITH v AS (SELECT DISTINCT ON (frame_id) * FROM milvus_entity WHERE len(embedding) = 1152), s AS (SELECT frame_id AS keyframe_id, video_id, shot_id, frame_idx, timestamp_ms, list_inner_product(CAST(embedding AS DOUBLE[]), q) / sqrt(list_inner_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[])) * list_inner_product(q, q)) AS score FROM v, {_QUERY_VECTOR})
SELECT keyframe_id, video_id, shot_id, frame_idx, timestamp_ms, round(score, 5) AS score FROM s WHERE video_id = 'N00_V999' AND NOT isnan(score) AND score >= -1 ORDER BY round(score, 6) DESC, keyframe_id LIMIT 20""")
def vector_filtered(s, d):
    """The nearest frames of one video to a frame of another."""
    return Reader(s, d).search_vector(_query_vector(s, d), 20, video_ids=["N00_V999"], min_score=-1.0).withColumn("score", F.round("score", 5))


def _query_vector(s, d):
    e = table(s, d, "milvus_entity")
    return vectors.usable(e.where(F.col("video_id") != "N00_V999"), "embedding", 1152).orderBy("frame_id").first()["embedding"]


@query(f"""WITH v AS (SELECT DISTINCT ON (frame_id) * FROM milvus_entity WHERE len(embedding) = 1152), s AS (SELECT frame_id AS keyframe_id, video_id, shot_id, frame_idx, timestamp_ms, list_inner_product(CAST(embedding AS DOUBLE[]), q) / sqrt(list_inner_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[])) * list_inner_product(q, q)) AS score FROM v, {_QUERY_VECTOR})
SELECT keyframe_id, video_id, shot_id, frame_idx, timestamp_ms, round(score, 5) AS score FROM s WHERE NOT isnan(score) AND score >= 0.8 ORDER BY round(score, 6) DESC, keyframe_id LIMIT 20""")
def vector_indexed(s, d):
    """The frames with a cosine of 0.8 and more, through the index."""
    return Reader(s, d).search_vector(_query_vector(s, d), 20, min_score=0.8, probes=16).withColumn("score", F.round("score", 5))


_SOME = [f"N00_V999_{k:06d}_kf{n:04d}" for k in range(0, 80, 2) for n in range(4)]


@query(core_queries._search_sql("nước mắm chợ nổi", {"transcript": "transcript"}, None, f"frame_id IN ({', '.join(map(repr, _SOME))})", 30))
def rerank_subset(s, d):
    """Hits of another search handed on as frame_ids; statistics are those of all frames."""
    return Reader(s, d).search_asr("nước mắm chợ nổi", 30, frame_ids=_SOME).withColumn("score", F.round("score", 5))


@query("SELECT TRUE AS ready")
def readiness(s, d):
    return s.range(1).select(F.lit(Reader(s, d).ready()).alias("ready"))


NAMES = [n for n in core_queries.QUERIES if n not in _before]
