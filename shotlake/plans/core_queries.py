"""A query for each operator over the project's tables, with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shotlake.functions import columns as C
from shotlake.operators import aggregates, checks, joins, merge, search, selection, sequence
from shotlake.plans import documents, keyframes
from shotlake.plans.reader import Reader
from shotlake.sources.tables import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def frames(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "frame_doc").dropDuplicates(["_id"])


def shots(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "shot_doc").dropDuplicates(["_id"])


def segments(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "seg_doc").dropDuplicates(["_id"])


def ticks(s: SparkSession, d: str) -> DataFrame:
    """events as frames of a video: g, i, v."""
    return table(s, d, "events").select(F.col("event_type").alias("g"), F.col("event_id").alias("i"), F.col("value").alias("v"))


FRAMES = "frames AS (SELECT DISTINCT ON (_id) * FROM frame_doc)"
SHOTS = "shots AS (SELECT DISTINCT ON (_id) * FROM shot_doc)"
SEGS = "segs AS (SELECT DISTINCT ON (_id) * FROM seg_doc)"
TICKS = "ticks AS (SELECT event_type AS g, event_id AS i, value AS v FROM events)"
ES = "es AS (SELECT DISTINCT ON (frame_id) * FROM es_doc)"


# --- joins ----------------------------------------------------------------------------------------


@query(f"""WITH {SHOTS}, {SEGS},
s AS (SELECT video_id, shot_id, CAST(trunc(start_frame / fps * 1000) AS BIGINT) AS a, CAST(trunc(end_frame / fps * 1000) AS BIGINT) AS z FROM shots),
p AS (SELECT s.video_id, s.shot_id, g.start_ms, g.seg_id, g.text, g.start_ms <= z AND g.end_ms >= a AS exact
      FROM s JOIN segs g ON s.video_id = g.video_id AND a <= z AND g.start_ms <= g.end_ms AND g.start_ms <= z + 500 AND g.end_ms >= a - 500 WHERE length(trim(g.text)) > 0),
q AS (SELECT *, bool_or(exact) OVER (PARTITION BY video_id, shot_id) AS near FROM p)
SELECT video_id, shot_id, string_agg(text, ' ' ORDER BY start_ms, seg_id, text) AS text FROM q WHERE exact OR NOT near GROUP BY video_id, shot_id""")
def shot_transcripts(s, d):
    return joins.shot_transcripts(shots(s, d), segments(s, d))


@query(f"WITH {SEGS} SELECT seg_id, start_ms, end_ms FROM segs WHERE start_ms < 60000 AND end_ms > 30000")
def half_open_lookup(s, d):
    return joins.half_open(segments(s, d), "start_ms", "end_ms", 30_000, 60_000).select("seg_id", "start_ms", "end_ms")


@query(f"""WITH {FRAMES}, s AS (SELECT video_id, start_frame, max(struct_pack(e := end_frame, i := shot_id)) AS m FROM shot_doc WHERE start_frame IS NOT NULL GROUP BY ALL)
SELECT f._id AS frame_id, CASE WHEN s.m.e >= f.frame_idx THEN s.m.i ELSE '' END AS shot_id FROM frames f ASOF LEFT JOIN s ON f.video_id = s.video_id AND f.frame_idx >= s.start_frame""")
def asof_shot_lookup(s, d):
    f = frames(s, d).select(F.col("_id").alias("frame_id"), "video_id", "frame_idx")
    return joins.asof_shot(f, shots(s, d).where("start_frame is not null")).select("frame_id", "shot_id")


@query(f"WITH {FRAMES}, {SHOTS} SELECT f._id AS frame_id, coalesce(s.transcript, '') AS transcript FROM frames f LEFT JOIN shots s ON f.shot_id = s.shot_id")
def frame_transcripts(s, d):
    t = joins.frame_transcripts(frames(s, d).select("_id", "shot_id"), shots(s, d))
    return t.select(F.col("_id").alias("frame_id"), "transcript")


IDS = ["N00_V999_000001_kf0001", "N00_V999_000000_kf0000", "unknown", "N00_V999_000001_kf0001"]


@query(f"""WITH {FRAMES}, a AS (SELECT unnest({IDS!r}) AS frame_id, unnest([0, 1, 2, 3]) AS pos)
SELECT a.frame_id, CAST(a.pos AS INT) AS pos, '/data/' || f.image_path AS image_path FROM a JOIN frames f ON f._id = a.frame_id""")
def hydrate_ids(s, d):
    f = frames(s, d).withColumnRenamed("_id", "frame_id")
    return joins.hydrate(f, IDS, "/data").select("frame_id", "pos", "image_path")


@query(f"""WITH {FRAMES} SELECT a._id AS a, b._id AS b, b.frame_idx - a.frame_idx AS step FROM frames a JOIN frames b ON a.video_id = b.video_id AND abs(a.frame_idx - b.frame_idx) <= 50""")
def band_pairs(s, d):
    t = joins.band_pairs(frames(s, d).select("video_id", "frame_idx", "_id"), "video_id", "frame_idx", ["_id"], 50)
    return t.select(F.col("_id_i").alias("a"), F.col("_id_j").alias("b"), (F.col("j") - F.col("i")).alias("step"))


@query("""SELECT a.label, a.vec_id AS a, b.vec_id AS b, round(list_inner_product(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), 5) AS sim FROM embeddings a JOIN embeddings b ON a.label = b.label AND a.vec_id < b.vec_id
WHERE list_inner_product(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])) >= 0.3""")
def similar_within(s, d):
    t = joins.similar_within(table(s, d, "embeddings"), "label", "vec_id", "embedding", 0.3)
    return t.withColumn("sim", F.round("sim", 5))


@query("""SELECT user_id AS video_id, frame_idx, CAST(round_even(pts[frame_idx + 1] * 1000, 0) AS BIGINT) AS pts_ms
FROM (SELECT user_id, list(value ORDER BY value) AS pts FROM events GROUP BY user_id), (SELECT unnest([0, 1, 5]) AS frame_idx)""")
def pts_of_frames(s, d):
    e = table(s, d, "events")
    p = e.select(F.col("user_id").alias("video_id"), F.col("value").alias("pts"))
    f = p.select("video_id").distinct().select("video_id", F.explode(F.array(F.lit(0), F.lit(1), F.lit(5))).alias("frame_idx"))
    return joins.pts_of_frames(f, p)


@query("""SELECT video_id, CAST(frame_idx AS INT) AS frame_idx, CAST(round_even(pts[frame_idx + 1] * 1000, 0) AS BIGINT) AS pts_ms
FROM (SELECT user_id AS video_id, pts, unnest(generate_series(0, len(pts))) AS frame_idx FROM (SELECT user_id, list(value ORDER BY value) AS pts FROM events GROUP BY user_id))""")
def pts_of_all_frames(s, d):
    """Every position of a group, and the one beyond its end."""
    p = table(s, d, "events").select(F.col("user_id").alias("video_id"), F.col("value").alias("pts"))
    f = p.groupBy("video_id").agg(F.count("*").cast("int").alias("n")).select("video_id", F.explode(F.sequence(F.lit(0), "n")).alias("frame_idx"))
    return joins.pts_of_frames(f, p)


# --- aggregates -----------------------------------------------------------------------------------


@query(f"""WITH {FRAMES} SELECT _id AS frame_id, unnest(map_keys(objects)) AS label, unnest(map_values(objects)) AS confidence FROM frames""")
def max_confidence_tags(s, d):
    e = frames(s, d).select(F.col("_id").alias("frame_id"), F.transform(F.map_entries("objects"), lambda x: F.struct(x["key"].alias("label"), x["value"].alias("confidence"))).alias("objects"))
    return aggregates.max_confidence(e, 0.0).select("frame_id", F.explode("objects").alias("label", "confidence"))


@query(f"""WITH {FRAMES} SELECT video_id, coalesce(arg_min(frame_idx / (timestamp_ms / 1000.0), frame_idx) FILTER (WHERE frame_idx > 0 AND timestamp_ms > 0), 30.0) AS fps FROM frames GROUP BY video_id""")
def derived_fps(s, d):
    return aggregates.derive_fps(frames(s, d), "frame_idx")


@query(f"WITH {FRAMES} SELECT video_id, count(*) AS n_keyframes, count(DISTINCT shot_id) AS n_shots, count(*) / count(DISTINCT shot_id) AS per_shot FROM frames GROUP BY video_id")
def keyframe_stats(s, d):
    return aggregates.keyframe_stats(frames(s, d))


@query("""WITH x AS (SELECT label, generate_subscripts(embedding, 1) AS k, CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings), y AS (SELECT label, k, sum(x) AS s, sum(x * x) AS q, count(*) AS n FROM x GROUP BY label, k)
SELECT label, max(n) AS n, round(greatest(0, 1 - (sum(s * s) - sum(q)) / (max(n) * (max(n) - 1))), 6) AS diversity FROM y GROUP BY label""")
def diversity_score(s, d):
    return aggregates.diversity(table(s, d, "embeddings"), "label", "embedding").withColumn("diversity", F.round("diversity", 6))


@query(f"""WITH {SHOTS}, {FRAMES}, s AS (SELECT shot_id, start_frame, end_frame, fps FROM shots WHERE start_frame <= end_frame),
k AS (SELECT DISTINCT s.shot_id, s.end_frame - s.start_frame AS last, f.frame_idx - s.start_frame AS p, CAST(floor(floor(2.0 * s.fps) / 2) AS BIGINT) AS h FROM frames f JOIN s ON f.shot_id = s.shot_id),
c AS (SELECT shot_id, count(DISTINCT x) AS n FROM (SELECT shot_id, unnest(generate_series(greatest(0, p - h), least(last, p + h))) AS x FROM k) GROUP BY shot_id)
SELECT s.shot_id, round(coalesce(c.n / (s.end_frame - s.start_frame + 1), 0), 6) AS coverage FROM s LEFT JOIN c ON s.shot_id = c.shot_id""")
def coverage_score(s, d):
    sh = shots(s, d).where("start_frame <= end_frame")
    return aggregates.coverage(sh, frames(s, d)).withColumn("coverage", F.round("coverage", 6))


@query("""WITH p AS (SELECT l_returnflag AS g, CAST((l_orderkey * 7) % 256 AS INT) AS r, CAST((l_partkey * 3) % 256 AS INT) AS gr, CAST(l_suppkey % 256 AS INT) AS b FROM lineitem),
h AS (SELECT g, (r >> 5) * 64 + (gr >> 5) * 8 + (b >> 5) AS bin, count(*) AS n FROM p GROUP BY ALL)
SELECT g, CAST(bin AS INT) AS bin, round(n / sqrt(sum(n * n) OVER (PARTITION BY g)), 6) AS weight FROM h""")
def colour_histogram(s, d):
    p = table(s, d, "lineitem").select(F.col("l_returnflag").alias("k"), (F.col("l_orderkey") * 7 % 256).cast("int").alias("r"), (F.col("l_partkey") * 3 % 256).cast("int").alias("g"), (F.col("l_suppkey") % 256).cast("int").alias("b"))
    return aggregates.colour_histogram(p, "k").select(F.col("k").alias("g"), "bin", F.round("weight", 6).alias("weight"))


@query(f"WITH {FRAMES} SELECT video_id, batch, count(*) AS n FROM frames GROUP BY video_id, batch")
def store_counts(s, d):
    return aggregates.group_count(frames(s, d), ["video_id", "batch"])


@query("""WITH p AS (SELECT c_name AS pred, n_name AS truth FROM customer JOIN nation ON c_nationkey = n_nationkey) SELECT count(*) AS n, avg(CASE WHEN pred = truth THEN 1.0 ELSE 0.0 END) AS accuracy,
round(avg(1 - levenshtein(pred, truth) / greatest(length(pred), length(truth))), 6) AS ned FROM p""")
def recogniser_scores(s, d):
    p = table(s, d, "customer").join(table(s, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    p = p.select(F.col("c_name").alias("pred"), F.col("n_name").alias("truth"), F.lit(1.0).alias("confidence"), F.lit(0.0).alias("loss"), F.lit(1.0).alias("weight"))
    return aggregates.recogniser_scores(p).select("n", "accuracy", F.round("ned", 6).alias("ned"))


# --- sequences ------------------------------------------------------------------------------------


@query(f"""WITH {TICKS}, t AS (SELECT g, i, v > 40 AS cut, lag(v > 40, 1, TRUE) OVER w AS before, lead(i) OVER w AS nx FROM ticks WINDOW w AS (PARTITION BY g ORDER BY i)),
u AS (SELECT *, sum(CASE WHEN before AND NOT cut THEN 1 ELSE 0 END) OVER (PARTITION BY g ORDER BY i) AS island FROM t)
SELECT g, min(i) AS start_pos, arg_max(coalesce(nx, i), i) AS end_pos FROM u WHERE NOT cut GROUP BY g, island""")
def islands_scenes(s, d):
    return sequence.scenes(ticks(s, d), "g", "i", "v", 40.0)


@query("""WITH n AS (SELECT _id AS video_id, greatest(1, coalesce(CAST(json_extract_string(media_info, '$.length') AS BIGINT) * 25, 0)) AS n FROM (SELECT DISTINCT ON (_id) * FROM video_doc)), s AS (SELECT video_id, n, unnest(generate_series(0, n - 1, 300)) AS a FROM n)
SELECT video_id, printf('S%04d', a // 300 + 1) AS shot_id, a AS start_frame, least(a + 300, n) - 1 AS end_frame FROM s""")
def fixed_chunks(s, d):
    v = table(s, d, "video_doc").dropDuplicates(["_id"]).select(F.col("_id").alias("video_id"), F.coalesce(F.get_json_object("media_info", "$.length").cast("long") * 25, F.lit(0)).alias("n"))
    return sequence.chunks(v, "n")


@query("""WITH n AS (SELECT user_id AS g, count(*) AS n FROM events GROUP BY user_id), w AS (SELECT g, n, unnest(generate_series(0, CAST(ceil(n / 50) AS BIGINT) - 1)) AS "window" FROM n), t AS (SELECT *, unnest(generate_series(0, 99)) AS slot FROM w)
SELECT g, "window", CAST(slot AS INT) AS slot, greatest(0, least(n - 1, "window" * 50 + slot - 25)) AS pos FROM t""")
def model_windows(s, d):
    from pyspark.sql import Window

    e = table(s, d, "events").select(F.col("user_id").alias("g"), (F.row_number().over(Window.partitionBy("user_id").orderBy("event_id")) - 1).alias("pos"))
    return sequence.model_windows(e, "g", "pos")


_STEEP = "t AS (SELECT g, i, v, coalesce(abs(v - lag(v) OVER w) / greatest(lag(v) OVER w, 1.0), 0.0) AS steepness FROM ticks WINDOW w AS (PARTITION BY g ORDER BY i))"


@query(f"WITH {TICKS}, {_STEEP} SELECT g, i, round(steepness, 6) AS steepness, round(avg(steepness) OVER (PARTITION BY g ORDER BY i ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING), 6) AS score FROM t")
def steepness_mean(s, d):
    t = sequence.moving_mean(sequence.steepness(ticks(s, d), ["g"], "i", "v"), ["g"], "i", "steepness")
    return t.select("g", "i", F.round("steepness", 6).alias("steepness"), F.round("score", 6).alias("score"))


@query(f"""WITH {TICKS}, r AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY v DESC, i DESC) AS r, count(*) OVER (PARTITION BY g) AS n, min(i) OVER (PARTITION BY g) AS f FROM ticks)
SELECT g, i, v FROM r WHERE r <= greatest(1, floor(n * 0.05)) OR i = f""")
def ratio_topk(s, d):
    return sequence.ratio_top(ticks(s, d), ["g"], "i", "v", 0.05)


@query(f"""WITH {TICKS}, r AS (SELECT *, max(v) OVER (PARTITION BY g ORDER BY i ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING) AS m, quantile_cont(v, 0.9) OVER (PARTITION BY g) AS q, min(i) OVER (PARTITION BY g) AS f, max(i) OVER (PARTITION BY g) AS l FROM ticks)
SELECT g, i, v, i = f AS protected FROM r WHERE i = f OR (i < l AND v >= q AND v = m)""")
def prominent_peaks(s, d):
    return sequence.prominent_peaks(ticks(s, d), ["g"], "i", "v").select("g", "i", "v", "protected")


@query(f"""WITH {TICKS}, k AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY i) - 1 AS k FROM ticks), t AS (SELECT g, i, CAST(v * 100 AS BIGINT) AS sign FROM k WHERE k % 5 = 0),
p AS (SELECT *, lag(sign) OVER (PARTITION BY g ORDER BY i) AS p FROM t) SELECT g, i FROM p WHERE p IS NOT NULL AND bit_count(xor(sign, p)) >= 8""")
def text_change_scan(s, d):
    t = ticks(s, d).withColumn("sign", F.round(F.col("v") * 100).cast("long"))
    return sequence.text_changes(t, ["g"], "i", "sign", 5).select("g", "i")


@query(f"WITH {FRAMES} SELECT _id AS frame_id, shot_id || printf('_kf%04d', row_number() OVER (PARTITION BY shot_id ORDER BY frame_idx, _id)) AS keyframe_id FROM frames WHERE trim(shot_id) <> ''")
def keyframe_numbers(s, d):
    f = frames(s, d).where("trim(shot_id) <> ''").select("_id", "shot_id", F.struct("frame_idx", "_id").alias("o"))
    return sequence.number_keyframes(f, "shot_id", "o").select(F.col("_id").alias("frame_id"), "keyframe_id")


@query("SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_returnflag ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber) <= 10")
def group_top(s, d):
    t = sequence.group_top(table(s, d, "lineitem"), ["l_returnflag"], [F.desc("l_extendedprice"), F.asc("l_orderkey"), F.asc("l_linenumber")], 10)
    return t.select("l_orderkey", "l_linenumber", "l_extendedprice")


@query("WITH r AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey DESC) - 1 AS row_no FROM orders) SELECT o_orderkey, row_no FROM r WHERE row_no >= 100 AND row_no < 5000 AND row_no % 7 IN (1, 3)")
def sliced_work(s, d):
    return sequence.sliced(table(s, d, "orders").select("o_orderkey"), ["o_orderkey"], 100, 5000, True, 7, (1, 3))


# --- store rows and merges --------------------------------------------------------------------------


@query(f"""WITH {SHOTS} SELECT shot_id AS _id, CAST(round_even(start_frame / fps * 1000, 0) AS BIGINT) AS start_ms, CAST(round_even((end_frame + 1) / fps * 1000, 0) AS BIGINT) AS end_ms, coalesce(transcript, '') AS transcript FROM shots""")
def shot_documents(s, d):
    return documents.shot_docs(shots(s, d)).select("_id", "start_ms", "end_ms", "transcript")


@query(f"""WITH {FRAMES}, {SHOTS} SELECT f._id AS frame_id, f.ocr_text, f.caption, coalesce(s.transcript, '') AS transcript, coalesce(list_sort(map_keys(f.objects)), []) AS object_tags FROM frames f LEFT JOIN shots s ON f.shot_id = s.shot_id""")
def text_documents(s, d):
    return documents.text_docs(frames(s, d), shots(s, d)).select("frame_id", "ocr_text", "caption", "transcript", "object_tags")


def _versions(s, d):
    c = table(s, d, "customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    old = c.where("c_custkey % 3 <> 0")
    new = c.where("c_custkey % 2 = 0").select("c_custkey", F.concat("c_name", F.lit("+")).alias("c_name"), F.when(F.col("c_custkey") % 4 == 0, F.col("c_acctbal") + 1).alias("c_acctbal"), F.lit("").alias("c_mktsegment"))
    return old, new


_OLD = "old AS (SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer WHERE c_custkey % 3 <> 0)"
_NEW = "new AS (SELECT c_custkey, c_name || '+' AS c_name, CASE WHEN c_custkey % 4 = 0 THEN c_acctbal + 1 END AS c_acctbal, '' AS c_mktsegment FROM customer WHERE c_custkey % 2 = 0)"


@query(f"WITH {_OLD}, {_NEW} SELECT * FROM new UNION ALL SELECT * FROM old WHERE c_custkey NOT IN (SELECT c_custkey FROM new)")
def merge_replace(s, d):
    return merge.replace_rows(*_versions(s, d), ["c_custkey"])


@query(f"WITH {_OLD}, {_NEW} SELECT * FROM old UNION ALL SELECT * FROM new WHERE c_custkey NOT IN (SELECT c_custkey FROM old)")
def merge_insert_absent(s, d):
    return merge.insert_absent(*_versions(s, d), ["c_custkey"])


@query(f"WITH {_OLD}, {_NEW} SELECT c_custkey, coalesce(n.c_name, o.c_name) AS c_name, coalesce(n.c_acctbal, o.c_acctbal) AS c_acctbal, coalesce(n.c_mktsegment, o.c_mktsegment) AS c_mktsegment FROM old o FULL JOIN new n USING (c_custkey)")
def merge_sparse(s, d):
    return merge.enrich_rows(*_versions(s, d), ["c_custkey"])


@query("SELECT o_orderkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 5 = 0)")
def resume_anti(s, d):
    done = table(s, d, "customer").where("c_custkey % 5 = 0").select(F.col("c_custkey").alias("o_custkey"))
    return joins.without(table(s, d, "orders"), done, "o_custkey").select("o_orderkey")


@query(f"WITH {FRAMES} SELECT _id, synced.elastic OR _id IN (SELECT frame_id FROM es_doc) AS elastic FROM frames")
def synced_flags(s, d):
    t = merge.mark_synced(frames(s, d).select("_id", "synced"), table(s, d, "es_doc"), "elastic")
    return t.select("_id", F.col("synced.elastic").alias("elastic"))


# --- checks ---------------------------------------------------------------------------------------


@query("""WITH v AS (SELECT frame_id, embedding AS e FROM milvus_entity),
f AS (SELECT frame_id, CASE WHEN e IS NULL OR len(e) <> 1152 THEN 'shape' WHEN list_sum(list_transform(e, lambda x: CASE WHEN x IS NULL OR isnan(x) OR isinf(x) THEN 1 ELSE 0 END)) > 0 THEN 'not finite'
 WHEN abs(sqrt(list_inner_product(CAST(e AS DOUBLE[]), CAST(e AS DOUBLE[]))) - 1) > 0.0001 THEN 'norm' END AS fault FROM v)
SELECT * FROM f WHERE fault IS NOT NULL UNION ALL SELECT frame_id, 'duplicate' FROM v GROUP BY frame_id HAVING count(*) > 1""")
def vector_faults(s, d):
    return checks.vector_faults(table(s, d, "milvus_entity"), "frame_id", "embedding", 1152)


@query("SELECT _id, count(*) AS n FROM frame_doc GROUP BY _id HAVING count(*) > 1")
def duplicate_ids(s, d):
    return checks.duplicates(table(s, d, "frame_doc"), ["_id"])


@query("SELECT event_id, NOT ((value < 15) AND (event_id % 256 < 15 OR event_id % 256 > 240)) AS ok FROM events")
def blank_veto(s, d):
    return table(s, d, "events").select("event_id", checks.not_blank(F.col("value"), F.col("event_id") % 256).alias("ok"))


# --- scalar functions -----------------------------------------------------------------------------


@query(f"SELECT doc_id, md5(regexp_replace(translate(text, '{C.ACCENTED}', '{C.PLAIN}'), '\\p{{M}}', '', 'g')) AS folded FROM documents")
def accent_fold(s, d):
    return table(s, d, "documents").select("doc_id", F.md5(C.fold_accents(F.col("text"))).alias("folded"))


@query("SELECT o_orderkey, bit_count(xor(o_orderkey, o_custkey)) AS distance FROM orders")
def hamming_distance(s, d):
    return table(s, d, "orders").select("o_orderkey", C.hamming(F.col("o_orderkey"), F.col("o_custkey")).alias("distance"))


@query("SELECT p_partkey, regexp_replace(lower(p_name), '[^a-z ]', '', 'g') AS label, CASE WHEN greatest(length(p_name), length(p_type)) = 0 THEN 0 ELSE round(levenshtein(p_name, p_type) / greatest(length(p_name), length(p_type)), 6) END AS ned FROM part")
def label_functions(s, d):
    t = table(s, d, "part")
    return t.select("p_partkey", C.adapt_charset(F.col("p_name"), "abcdefghijklmnopqrstuvwxyz ").alias("label"), F.round(C.normalised_edit_distance(F.col("p_name"), F.col("p_type")), 6).alias("ned"))


@query()
def recognised_clean(s, d):
    return frames(s, d).select("_id", C.clean_recognised(F.col("ocr_text")).alias("text"))


@query("SELECT _id, CAST(row_number() OVER (ORDER BY regexp_extract(video_id, '^\\D*'), CAST(regexp_extract(video_id, '^[^0-9]*([0-9]+)', 1) AS INT), CAST(regexp_extract(video_id, '([0-9]+)$', 1) AS INT), _id) AS INT) AS pos FROM (SELECT DISTINCT _id, _id AS video_id FROM video_doc)")
def natural_order(s, d):
    from pyspark.sql import Window

    v = table(s, d, "video_doc").select("_id").distinct()
    return v.select("_id", F.row_number().over(Window.orderBy(C.natural_key(F.col("_id")), "_id")).alias("pos"))


# --- search ---------------------------------------------------------------------------------------

_HIT = "frame_id AS keyframe_id, video_id, shot_id, frame_idx, timestamp_ms"
_QUERY = "nước mắm chợ nổi"


def _terms(field: str, fold: bool = True) -> str:
    text = f"regexp_replace(strip_accents(replace(replace(lower({field}), 'đ', 'd'), 'Đ', 'D')), '\\p{{M}}', '', 'g')" if fold else f"lower({field})"
    return f"regexp_extract_all({text}, '[\\p{{L}}\\p{{N}}]+')"


# One edit at most, counted in characters (the distance functions of SQL count bytes): equal, a letter more or less, another, or two swapped.
_WITHIN_ONE = """(q = term OR (length(term) = length(q) + 1 AND list_contains(list_transform(range(1, length(term) + 1), lambda i: substring(term, 1, i - 1) || substring(term, i + 1)), q))
 OR (length(q) = length(term) + 1 AND list_contains(list_transform(range(1, length(q) + 1), lambda i: substring(q, 1, i - 1) || substring(q, i + 1)), term))
 OR (length(q) = length(term) AND (list_contains(list_transform(range(1, length(q) + 1), lambda i: substring(q, 1, i - 1) || substring(q, i + 1) = substring(term, 1, i - 1) || substring(term, i + 1)), TRUE)
  OR list_contains(list_transform(range(1, length(q)), lambda i: substring(q, 1, i - 1) || substring(q, i + 1, 1) || substring(q, i, 1) || substring(q, i + 2)), term))))"""


def _bm25_sql(field: str, words: list[str]) -> str:
    return f"""WITH {ES}, t AS (SELECT frame_id, {_terms(field)} AS w FROM es WHERE {field} IS NOT NULL), u AS (SELECT frame_id, w, len(w) AS dl FROM t WHERE len(w) > 0),
st AS (SELECT count(*) AS n, avg(dl) AS avg_dl FROM u), q AS (SELECT unnest({words!r}) AS q),
p AS (SELECT frame_id, q, dl, len(list_filter(w, lambda x: x = q)) AS tf FROM u, q WHERE list_contains(w, q)), df AS (SELECT q, count(*) AS df FROM p GROUP BY q)
SELECT frame_id AS doc, round(sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf / (tf + 1.2 * (0.25 + 0.75 * dl / avg_dl))), 6) AS score FROM p JOIN df USING (q), st GROUP BY frame_id"""


def _captions(s, d):
    """An index that isn't stored."""
    return search.TextIndex(table(s, d, "es_doc").dropDuplicates(["frame_id"]), "frame_id", {"caption": ("caption", True)})


@query(_bm25_sql("caption", search.query_words(_QUERY)))
def bm25_or(s, d):
    return _captions(s, d).bm25(_QUERY, "caption").withColumn("score", F.round("score", 6))


@query(f"""WITH {ES}, t AS (SELECT DISTINCT unnest({_terms('caption')}) AS term FROM es WHERE caption IS NOT NULL), q AS (SELECT unnest({search.query_words(_QUERY)!r}) AS q),
x AS (SELECT q, term, CASE WHEN q = term THEN 1.0 ELSE 1 - 1 / least(length(q), length(term)) END AS weight FROM t, q WHERE {_WITHIN_ONE}),
r AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY weight DESC, term) AS r FROM x WHERE weight > 0) SELECT q, term, round(weight, 6) AS weight FROM r WHERE r <= 10 OR q = term""")
def fuzzy_terms(s, d):
    t = _captions(s, d).expansions(search.query_words(_QUERY))
    return t.select("q", "term", F.round("weight", 6).alias("weight"))


def _search_sql(query: str, fields: dict[str, str], accented: str | None, where: str, k: int, min_score: float = 0) -> str:
    """The ranking of a search in SQL; fields: name -> text expression."""
    words = search.query_words(query)
    need = search.required(len(words))
    parts = " UNION ALL ".join(f"SELECT '{f}' AS field, frame_id, {_terms(e)} AS w FROM es WHERE {e} IS NOT NULL" for f, e in fields.items())
    plus, join = "0", ""
    if accented:
        aw = search.query_words(query, fold=False)
        plus, join = "3 * coalesce(plus, 0)", "LEFT JOIN ap USING (frame_id)"
        extra = f""", au AS (SELECT frame_id, w, len(w) AS dl FROM (SELECT frame_id, {_terms(accented, False)} AS w FROM es WHERE {accented} IS NOT NULL) WHERE len(w) > 0),
ast AS (SELECT count(*) AS n, avg(dl) AS avg_dl FROM au), aq AS (SELECT unnest({aw!r}) AS q), app AS (SELECT frame_id, q, dl, len(list_filter(w, lambda x: x = q)) AS tf FROM au, aq WHERE list_contains(w, q)),
adf AS (SELECT q, count(*) AS df FROM app GROUP BY q), ap AS (SELECT frame_id, sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf / (tf + 1.2 * (0.25 + 0.75 * dl / avg_dl))) AS plus FROM app JOIN adf USING (q), ast GROUP BY frame_id HAVING count(*) = {len(aw)})"""
    else:
        extra = ""
    return f"""WITH {ES}, u AS (SELECT field, frame_id, w, len(w) AS dl FROM ({parts}) WHERE len(w) > 0), st AS (SELECT field, count(*) AS n, avg(dl) AS avg_dl FROM u GROUP BY field),
po AS (SELECT field, frame_id, dl, term, count(*) AS tf FROM (SELECT field, frame_id, dl, unnest(w) AS term FROM u) GROUP BY ALL), q AS (SELECT unnest({words!r}) AS q),
x AS (SELECT field, q, term, CASE WHEN q = term THEN 1.0 ELSE 1 - 1 / least(length(q), length(term)) END AS weight FROM (SELECT DISTINCT field, term FROM po), q WHERE {_WITHIN_ONE}),
r AS (SELECT *, row_number() OVER (PARTITION BY field, q ORDER BY weight DESC, term) AS r FROM x WHERE weight > 0), e AS (SELECT * FROM r WHERE r <= 10 OR q = term),
df AS (SELECT field, term, count(*) AS df FROM po GROUP BY field, term),
h AS (SELECT po.field, frame_id, q, max(s) AS s, max(CASE WHEN q = term THEN s END) AS x FROM (SELECT po.field, frame_id, q, po.term, weight * ln(1 + (n - df + 0.5) / (df + 0.5)) * tf / (tf + 1.2 * (0.25 + 0.75 * dl / avg_dl)) AS s
   FROM po JOIN e ON po.field = e.field AND po.term = e.term JOIN df ON po.field = df.field AND po.term = df.term JOIN st ON po.field = st.field) po GROUP BY po.field, frame_id, q),
g AS (SELECT field, frame_id, sum(s) AS s, count(*) AS hits, sum(x) AS xs, count(x) AS xh FROM h GROUP BY field, frame_id),
b AS (SELECT frame_id, coalesce(max(s), 0) + 5 * coalesce(max(CASE WHEN hits >= {need} THEN s END), 0) + 3 * coalesce(max(CASE WHEN xh >= {need} THEN xs END), 0) AS score FROM g GROUP BY frame_id){extra},
z AS (SELECT frame_id, score + {plus} AS score FROM b {join})
SELECT {_HIT}, round(z.score, 5) AS score FROM z JOIN es USING (frame_id) WHERE z.score >= {min_score} AND ({where}) ORDER BY round(z.score, 6) DESC, keyframe_id LIMIT {k}"""


def _rounded(t: DataFrame) -> DataFrame:
    return t.withColumn("score", F.round("score", 5))


@query(_search_sql("bản tin 24 giờ", {"ocr_text": "ocr_text", "ocr_api": "ocr_api", "exact": "NULL::VARCHAR"}, "ocr_text", "TRUE", 50))
def search_ocr(s, d):
    return _rounded(Reader(s, d).search_ocr("bản tin 24 giờ", 50))


@query(_search_sql("chụp anh trạm bơm", {"transcript": "transcript"}, None, "TRUE", 50, 1.0))
def search_asr(s, d):
    return _rounded(Reader(s, d).search_asr("chụp anh trạm bơm", 50, min_score=1.0))


@query(_search_sql("máy quay lia ngang", {"content_all": "concat_ws(' ', ocr_text, ocr_api, caption, transcript)"}, None, "video_id = 'N00_V999'", 50))
def search_all(s, d):
    return _rounded(Reader(s, d).search_all("máy quay lia ngang", 50, video_ids=["N00_V999"]))


@query(_search_sql("máy quay lia ngang", {"content_all": "concat_ws(' ', ocr_text, ocr_api, caption, transcript)"}, None, "TRUE", 50))
def search_all_videos(s, d):
    return _rounded(Reader(s, d).search_all("máy quay lia ngang", 50))


@query(f"""WITH {FRAMES}, t AS (SELECT _id AS frame_id, video_id, shot_id, frame_idx, timestamp_ms, objects FROM frames WHERE list_has_any(map_keys(objects), ['loom', 'pump', 'none']) ORDER BY _id LIMIT 100)
SELECT {_HIT}, list_max(list_transform(['loom', 'pump'], lambda x: objects[x])) AS score FROM t WHERE score >= 0.6""")
def search_object(s, d):
    return Reader(s, d).search_object(["loom", "pump", "none"], min_score=0.6)


_SIM = "list_inner_product(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])) / sqrt(list_inner_product(CAST(a.embedding AS DOUBLE[]), CAST(a.embedding AS DOUBLE[])) * list_inner_product(CAST(b.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])))"


@query(f"SELECT a.vec_id AS doc, round({_SIM}, 5) AS score FROM embeddings a, (SELECT embedding FROM embeddings WHERE vec_id = 1) b ORDER BY {_SIM} DESC, doc LIMIT 20")
def vector_topk(s, d):
    e = table(s, d, "embeddings")
    q = e.where("vec_id = 1").first()["embedding"]
    return search.vector_scores(e, "vec_id", "embedding", q).orderBy(F.desc("score"), "doc").limit(20).withColumn("score", F.round("score", 5))


@query(f"SELECT a.vec_id AS doc, round({_SIM}, 5) AS score FROM embeddings a, (SELECT embedding FROM embeddings WHERE vec_id = 1) b WHERE {_SIM} >= 0.2")
def vector_range(s, d):
    e = table(s, d, "embeddings")
    q = e.where("vec_id = 1").first()["embedding"]
    return search.vector_scores(e, "vec_id", "embedding", q).where("score >= 0.2").withColumn("score", F.round("score", 5))


@query(f"""WITH x AS (SELECT a.vec_id AS query, b.vec_id AS doc, {_SIM} AS score FROM embeddings a, embeddings b WHERE a.vec_id % 50 = 0), r AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, doc) AS r FROM x)
SELECT query, doc, round(score, 5) AS score, CAST(r AS INT) AS rank FROM r WHERE r <= 10""")
def batch_knn(s, d):
    e = table(s, d, "embeddings")
    return search.batch_top(e.where("vec_id % 50 = 0"), e, "vec_id", "embedding", 10).withColumn("score", F.round("score", 5))


# --- greedy folds -----------------------------------------------------------------------------------
# In SQL, a recursion over the rows of a group in their order, that carries what was kept.


def _windows(s, d):
    """embeddings as candidates: video = label, frame_idx, score."""
    e = table(s, d, "embeddings").where("label is not null")
    return e.select(F.col("label").cast("string").alias("video_id"), F.col("vec_id").cast("int").alias("frame_idx"), "embedding", (F.col("vec_id") * 7919 % 1000).cast("double").alias("score"))


_WINDOWS = """w AS (SELECT CAST(label AS VARCHAR) AS video_id, CAST(vec_id AS INT) AS frame_idx, CAST(embedding AS DOUBLE[]) AS e, CAST(vec_id * 7919 % 1000 AS DOUBLE) AS score FROM embeddings WHERE label IS NOT NULL)"""


@query(f"""WITH RECURSIVE {TICKS}, r AS (SELECT g, i, v, row_number() OVER (PARTITION BY g ORDER BY v DESC, i) AS k FROM ticks),
f AS (SELECT DISTINCT g, CAST(0 AS BIGINT) AS k, CAST([] AS BIGINT[]) AS kept FROM r
      UNION ALL SELECT f.g, r.k, CASE WHEN len(list_filter(kept, lambda x: abs(x - r.i) < 5)) = 0 THEN list_append(kept, r.i) ELSE kept END FROM f JOIN r ON r.g = f.g AND r.k = f.k + 1),
u AS (SELECT g, unnest(arg_max(kept, k)) AS i FROM f GROUP BY g)
SELECT g, i AS frame_idx, v AS score, FALSE AS protected FROM u JOIN ticks USING (g, i)""")
def peak_nms(s, d):
    t = ticks(s, d).select("g", F.col("i").alias("frame_idx"), F.col("v").alias("score"), F.lit(False).alias("protected"))
    return selection.select_peaks(t, ["g"])


@query(f"""WITH RECURSIVE {TICKS}, r AS (SELECT g, i, v > 200 AS c, row_number() OVER (PARTITION BY g ORDER BY i) AS k FROM ticks),
f AS (SELECT DISTINCT g, CAST(0 AS BIGINT) AS k, CAST(-1 AS BIGINT) AS last, CAST(NULL AS BIGINT) AS i, FALSE AS c FROM r
      UNION ALL SELECT f.g, r.k, CASE WHEN r.c OR r.i - last >= 300 THEN r.i ELSE last END, r.i, r.c FROM f JOIN r ON r.g = f.g AND r.k = f.k + 1)
SELECT g, i AS frame_idx, c AS chosen, 0 AS window_start FROM f WHERE i = last""")
def gap_fill(s, d):
    t = ticks(s, d).select("g", F.col("i").alias("frame_idx"), (F.col("v") > 200).alias("chosen"), F.lit(0).alias("window_start"))
    return selection.select_filled(t, ["g"], 300)


@query(f"""WITH RECURSIVE {_WINDOWS}, r AS (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY frame_idx) AS k FROM w),
f AS (SELECT DISTINCT video_id, CAST(0 AS BIGINT) AS k, CAST([] AS STRUCT(f INT, e DOUBLE[], forced BOOLEAN)[]) AS kept, CAST(NULL AS INT) AS last, CAST(NULL AS STRUCT(s DOUBLE, f INT, e DOUBLE[])) AS rival FROM r
 UNION ALL SELECT video_id, k, CASE WHEN NOT near AND take THEN list_append(kept, struct_pack(f := f, e := e, forced := FALSE)) ELSE kept END, CASE WHEN NOT near AND take THEN f ELSE last END,
   CASE WHEN near THEN rival WHEN take THEN NULL WHEN rival IS NULL OR sim <= rival.s THEN struct_pack(s := sim, f := f, e := e) ELSE rival END
 FROM (SELECT *, last IS NOT NULL AND f - last < 5 AS near, sim IS NULL OR sim < CASE WHEN f - last > 150 THEN least(0.99, 0.3 + least(0.05, 0.005 * (f - last - 150))) ELSE 0.3 END AS take
  FROM (SELECT *, list_max(list_transform(kept, lambda x: list_inner_product(x.e, e))) AS sim
   FROM (SELECT video_id, k, f, e, CASE WHEN due THEN list_append(kept, struct_pack(f := rival.f, e := rival.e, forced := TRUE)) ELSE kept END AS kept, CASE WHEN due THEN rival.f ELSE last END AS last, CASE WHEN due THEN NULL ELSE rival END AS rival
    FROM (SELECT f.video_id, r.k, r.frame_idx AS f, r.e, kept, last, rival, rival IS NOT NULL AND last IS NOT NULL AND r.frame_idx - last >= 300 AS due FROM f JOIN r ON r.video_id = f.video_id AND r.k = f.k + 1))))),
u AS (SELECT video_id, unnest(arg_max(kept, k)) AS x FROM f GROUP BY video_id) SELECT video_id, frame_idx, score, x.forced AS forced FROM u JOIN w USING (video_id) WHERE frame_idx = x.f""")
def semantic_filter(s, d):
    return selection.select_semantic(_windows(s, d), ["video_id"], threshold=0.3).drop("embedding")


@query(f"""WITH RECURSIVE {_WINDOWS}, r AS (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY score DESC, frame_idx DESC) AS k FROM w),
f AS (SELECT DISTINCT video_id, CAST(0 AS BIGINT) AS k, CAST([] AS STRUCT(f INT, e DOUBLE[])[]) AS kept FROM r
      UNION ALL SELECT f.video_id, r.k, CASE WHEN len(list_filter(kept, lambda x: abs(x.f - r.frame_idx) < 5 OR list_inner_product(x.e, r.e) >= 0.3)) = 0 THEN list_append(kept, struct_pack(f := r.frame_idx, e := r.e)) ELSE kept END
      FROM f JOIN r ON r.video_id = f.video_id AND r.k = f.k + 1),
u AS (SELECT video_id, unnest(arg_max(kept, k)) AS x FROM f GROUP BY video_id) SELECT video_id, frame_idx, score FROM u JOIN w USING (video_id) WHERE frame_idx = x.f""")
def diversity_nms(s, d):
    return selection.select_diverse(_windows(s, d), ["video_id"], 0.3).drop("embedding")


@query("""WITH RECURSIVE p AS (SELECT a.label, a.vec_id AS pred, b.vec_id AS truth, list_inner_product(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])) AS sim FROM embeddings a JOIN embeddings b ON a.label = b.label AND a.vec_id % 2 = 0 AND b.vec_id % 2 = 1),
r AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY sim DESC, pred, truth) AS k FROM p WHERE sim >= 0.3),
f AS (SELECT DISTINCT label, CAST(0 AS BIGINT) AS k, CAST([] AS BIGINT[]) AS preds, CAST([] AS BIGINT[]) AS truths, CAST(NULL AS BIGINT) AS pred, CAST(NULL AS BIGINT) AS truth, CAST(NULL AS DOUBLE) AS sim, FALSE AS new FROM r
      UNION ALL SELECT label, k, CASE WHEN new THEN list_append(preds, pred) ELSE preds END, CASE WHEN new THEN list_append(truths, truth) ELSE truths END, pred, truth, sim, new
      FROM (SELECT f.label, r.k, preds, truths, r.pred, r.truth, r.sim, NOT list_contains(preds, r.pred) AND NOT list_contains(truths, r.truth) AS new FROM f JOIN r ON r.label = f.label AND r.k = f.k + 1))
SELECT label, pred, truth, round(sim, 5) AS sim FROM f WHERE new""")
def greedy_match(s, d):
    e = table(s, d, "embeddings")
    return selection.match(e.where("vec_id % 2 = 0"), e.where("vec_id % 2 = 1"), "label", "vec_id", "embedding", 0.3).withColumn("sim", F.round("sim", 5))


@query()
def keyframe_extraction(s, d):
    e = _windows(s, d).withColumns({"jpeg_size": F.col("score") + 500, "brightness": F.lit(100.0), "lap_var": F.lit(50.0), "sign": F.xxhash64("frame_idx")})
    sh = e.groupBy("video_id").agg(F.min("frame_idx").alias("start_frame"), F.max("frame_idx").alias("end_frame")).withColumns({"shot_id": F.concat("video_id", F.lit("_000000")), "fps": F.lit(25.0)})
    return keyframes.extract(e, sh, keyframes.Settings(similarity=0.3, redundancy=0.3, text=True))


_MAXED = ("l_partkey", "l_suppkey", "l_returnflag", "l_discount", "l_extendedprice", "l_quantity")
_ITEMS = f"items AS (SELECT l_orderkey, l_linenumber, {', '.join(f'max({c}) AS {c}' for c in _MAXED)} FROM lineitem GROUP BY ALL)"


def _items(s, d):
    """lineitem with one row a line number."""
    return table(s, d, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(*[F.max(c).alias(c) for c in _MAXED])


def _words(s, d, height):
    w = _items(s, d).select(F.col("l_orderkey").cast("string").alias("frame_id"), F.col("l_linenumber").alias("box_id"), F.col("l_returnflag").alias("text"), F.col("l_discount").alias("confidence"), (F.col("l_partkey") % 900).cast("double").alias("x1"), (F.col("l_suppkey") % 40).cast("double").alias("y1"), "l_quantity")
    return w.withColumns({"x2": F.col("x1") + 30, "y2": F.col("y1") + height}).drop("l_quantity")


def _lines_sql(height: str) -> str:
    return f"""WITH RECURSIVE {_ITEMS}, b AS (SELECT CAST(l_orderkey AS VARCHAR) AS frame_id, l_linenumber AS box_id, l_returnflag AS t, l_discount AS c, CAST(l_partkey % 900 AS DOUBLE) AS x1, CAST(l_suppkey % 40 AS DOUBLE) AS y1, CAST({height} AS DOUBLE) AS h FROM items),
r AS (SELECT *, y1 + h / 2 AS cy, row_number() OVER (PARTITION BY frame_id ORDER BY y1 + h / 2, box_id) AS k FROM b),
f AS (SELECT DISTINCT frame_id, CAST(0 AS BIGINT) AS k, CAST([] AS STRUCT(y DOUBLE, h DOUBLE)[]) AS heads, CAST(NULL AS BIGINT) AS n, CAST(NULL AS BIGINT) AS box_id FROM r
 UNION ALL SELECT frame_id, k, CASE WHEN line IS NULL THEN list_append(heads, struct_pack(y := cy, h := h)) ELSE heads END, coalesce(line, len(heads) + 1), box_id
 FROM (SELECT f.frame_id, r.k, heads, r.cy, r.h, CAST(r.box_id AS BIGINT) AS box_id, CAST(list_position(list_transform(heads, lambda x: abs(r.cy - x.y) < 0.5 * least(r.h, x.h)), TRUE) AS BIGINT) AS line FROM f JOIN r ON r.frame_id = f.frame_id AND r.k = f.k + 1)),
m AS (SELECT frame_id, arg_max(heads, k) AS heads FROM f GROUP BY frame_id), l AS (SELECT b.*, f.n, m.heads[f.n].h AS hh FROM f JOIN b ON b.frame_id = f.frame_id AND b.box_id = f.box_id JOIN m ON m.frame_id = f.frame_id),
g AS (SELECT *, CASE WHEN x1 - lag(x1 + 30) OVER v > 1.5 * hh OR lag(x1) OVER v IS NULL THEN 1 ELSE 0 END AS new FROM l WINDOW v AS (PARTITION BY frame_id, n ORDER BY x1, box_id)),
z AS (SELECT *, sum(new) OVER (PARTITION BY frame_id ORDER BY n, x1, box_id) - 1 AS line FROM g)
SELECT frame_id, CAST(line AS BIGINT) AS line, string_agg(t, ' ' ORDER BY x1, box_id) AS text, round_even(avg(c), 4) AS confidence, min(x1) AS x1, min(y1) AS y1, max(x1 + 30) AS x2, max(y1 + h) AS y2 FROM z GROUP BY frame_id, line"""


@query(_lines_sql("12"))
def word_lines(s, d):
    return selection.lines_of_words(_words(s, d, F.lit(12)))


@query(_lines_sql("8 + 11 * (l_quantity % 3)"))
def word_lines_of_heights(s, d):
    """A line splits by its own height, that of its first word."""
    return selection.lines_of_words(_words(s, d, 8 + 11 * (F.col("l_quantity") % 3)))


def _boxes_sql(width: str, height: str) -> str:
    return f"""WITH RECURSIVE {_ITEMS}, b AS (SELECT CAST(l_orderkey AS VARCHAR) AS frame_id, l_linenumber AS box_id, CAST(l_partkey % 90 AS DOUBLE) AS x1, CAST(l_suppkey % 40 AS DOUBLE) AS y1, l_extendedprice AS score, CAST({width} AS DOUBLE) AS w, CAST({height} AS DOUBLE) AS h FROM items),
r AS (SELECT *, row_number() OVER (PARTITION BY frame_id ORDER BY score DESC, box_id) AS k FROM b),
f AS (SELECT DISTINCT frame_id, CAST(0 AS BIGINT) AS k, CAST([] AS STRUCT(id BIGINT, x DOUBLE, y DOUBLE, w DOUBLE, h DOUBLE)[]) AS kept FROM r
 UNION ALL SELECT f.frame_id, r.k, CASE WHEN len(list_filter(kept, lambda q: greatest(0, least(q.x + q.w, r.x1 + r.w) - greatest(q.x, r.x1)) * greatest(0, least(q.y + q.h, r.y1 + r.h) - greatest(q.y, r.y1)) > 0.5 * least(q.w * q.h, r.w * r.h))) = 0
   THEN list_append(kept, struct_pack(id := CAST(r.box_id AS BIGINT), x := r.x1, y := r.y1, w := r.w, h := r.h)) ELSE kept END FROM f JOIN r ON r.frame_id = f.frame_id AND r.k = f.k + 1),
u AS (SELECT frame_id, unnest(arg_max(kept, k)).id AS box_id FROM f GROUP BY frame_id) SELECT b.frame_id, b.box_id, x1, y1, score, x1 + w AS x2, y1 + h AS y2 FROM b JOIN u ON b.frame_id = u.frame_id AND b.box_id = u.box_id"""


@query(_boxes_sql("30", "12"))
def box_nms(s, d):
    w = _items(s, d).select(F.col("l_orderkey").cast("string").alias("frame_id"), F.col("l_linenumber").alias("box_id"), (F.col("l_partkey") % 90).cast("double").alias("x1"), (F.col("l_suppkey") % 40).cast("double").alias("y1"), F.col("l_extendedprice").alias("score"))
    return selection.select_boxes(w.withColumns({"x2": F.col("x1") + 30, "y2": F.col("y1") + 12}))


@query(_boxes_sql("10 + 8 * (l_quantity % 7)", "5 + 4 * (l_quantity % 5)"))
def box_nms_of_sizes(s, d):
    """Boxes of different areas: the smaller one's counts."""
    w = _items(s, d).select(F.col("l_orderkey").cast("string").alias("frame_id"), F.col("l_linenumber").alias("box_id"), (F.col("l_partkey") % 90).cast("double").alias("x1"), (F.col("l_suppkey") % 40).cast("double").alias("y1"), F.col("l_extendedprice").alias("score"), "l_quantity")
    return selection.select_boxes(w.withColumns({"x2": F.col("x1") + 10 + 8 * (F.col("l_quantity") % 7), "y2": F.col("y1") + 5 + 4 * (F.col("l_quantity") % 5)}).drop("l_quantity"))
