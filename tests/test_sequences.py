import time

import numpy as np

from shotlake.functions import columns as C
from shotlake.operators import aggregates, checks, merge, search, selection, sequence
from pyspark.sql import functions as F


def angle(*degrees):
    r = np.radians(degrees)
    return np.stack([np.cos(r), np.sin(r)], axis=1).astype(np.float32)


def test_scenes(spark):
    cases = {"a": "001100", "b": "11", "c": "1001", "d": "0", "e": "01010"}
    rows = [(g, i, float(x)) for g, s in cases.items() for i, x in enumerate(s)]
    t = sequence.scenes(spark.createDataFrame(rows, "g string, i int, p double"), "g", "i", "p")
    got = {g: sorted((r.start_pos, r.end_pos) for r in t.collect() if r.g == g) for g in cases}
    assert got == {"a": [(0, 2), (4, 5)], "b": [(0, 1)], "c": [(1, 3)], "d": [(0, 0)], "e": [(0, 1), (2, 3), (4, 4)]}


def test_steepness_mean_and_top(spark):
    df = spark.createDataFrame([("g", i, float(v)) for i, v in enumerate((100, 110, 99, 99, 198))], "g string, i int, v double")
    t = sequence.moving_mean(sequence.steepness(df, ["g"], "i", "v"), ["g"], "i", "steepness")
    r = t.orderBy("i").collect()
    assert [round(x.steepness, 4) for x in r] == [0, 0.1, 0.1, 0, 1]
    assert [round(x.score, 4) for x in r] == [0.05, 0.0667, 0.0667, 0.3667, 0.5]
    assert sorted(x.i for x in sequence.ratio_top(t, ["g"], "i", "score", 0.2).collect()) == [0, 4]


def test_gap_fill(spark):
    df = spark.createDataFrame([("g", i, i in (0, 10), 0) for i in range(21)], "g string, frame_idx int, chosen boolean, window_start int")
    assert sorted(r.frame_idx for r in selection.select_filled(df, ["g"], 4).collect()) == [0, 4, 8, 10, 14, 18]


def test_peak_suppression(spark):
    rng = np.random.default_rng(5)
    for gap in (0, 1, 5, 50):
        for n in (0, 1, 7, 300):
            frames, scores = rng.integers(0, 2 * n + 1, n).astype(np.int32), rng.integers(0, 9, n).astype(float)
            order, kept = np.argsort(-scores, kind="stable"), []
            for i in order.tolist():
                kept += [i] * all(abs(int(frames[i]) - int(frames[k])) >= gap for k in kept)
            assert np.nonzero(selection.spaced(frames, order, gap))[0].tolist() == sorted(kept)
    rows = [("g", 9, 1.0, False), ("g", 5, 2.0, False), ("g", 0, 2.0, False), ("g", 3, 0.5, True), ("h", 4, 1.0, False), ("h", None, 9.0, False)]
    t = selection.select_peaks(spark.createDataFrame(rows, "g string, frame_idx bigint, score double, protected boolean"), ["g"])
    assert sorted((r.g, r.frame_idx) for r in t.collect()) == [("g", 0), ("g", 3), ("g", 5), ("h", 4)]


def test_peak_suppression_takes_linear_time():
    def seconds(n: int, times: int) -> float:
        scores, took = np.random.default_rng(n).random(n), []
        for _ in range(times):
            began = time.thread_time()
            kept = selection.peak_nms(np.arange(n) * 2, scores, np.zeros(n, bool))
            took.append(time.thread_time() - began)
        assert n / 5 < kept.sum() < n / 2
        return min(took)

    assert seconds(160_000, 2) < 24 * seconds(20_000, 2)


def test_semantic_filter():
    f = selection.SemanticFilter(0.90)
    assert f.window(np.array([0, 3, 10, 20, 30]), angle(0, 90, 10, 60, 62)) == ([0, 3], set())
    frames = np.array([0, 100, 200, 310])
    kept, forced = selection.SemanticFilter(0.90).window(frames, angle(0, 5, 10, 0))
    assert frames[kept].tolist() == [0, 200] and {int(frames[i]) for i in forced} == {200}
    frames = np.array([0, 100, 155, 310])
    assert frames[selection.SemanticFilter(0.90).window(frames, angle(0, 5, 24, 0))[0]].tolist() == [0, 155]


def test_semantic_filter_forgets_the_oldest():
    f = selection.SemanticFilter(0.90, history=2)
    f.commit([0, 10], list(angle(0, 90)))
    # The first vector is out once another is kept, so a frame like it counts as new.
    assert f.window(np.array([20, 30, 40]), angle(1, 180, 2)) == ([1, 2], set())


def test_lines_split_by_the_lines_own_height():
    # Heights 10 and 30 on one line: the gap of 25 is more than one and a half times the first word's height.
    assert selection.group_lines(np.array([[0, 10, 10, 20], [35, 0, 60, 30]], float)).tolist() == [0, 1]


def test_diversity_nms(spark):
    m = selection.diversity_nms(np.array([0, 3, 20, 40]), angle(0, 90, 10, 60), np.array([0.1, 0.5, 0.9, 0.2]))
    assert m.tolist() == [False, True, True, True]
    rows = [("g", f, [float(x) for x in v], s) for f, v, s in zip((0, 3, 20, 40), angle(0, 90, 10, 60), (0.1, 0.5, 0.9, 0.2))]
    t = selection.select_diverse(spark.createDataFrame(rows, "g string, frame_idx int, embedding array<float>, score double"), ["g"])
    assert sorted(r.frame_idx for r in t.collect()) == [3, 20, 40]


def test_greedy_match_and_boxes():
    assert [(a, b) for a, b, _ in selection.greedy_match(np.array([[0.9, 0.95], [0.86, 0.94]]))] == [(0, 1), (1, 0)]
    boxes = np.array([[0, 0, 10, 10], [1, 1, 9, 9], [20, 0, 30, 10]], float)
    assert selection.box_nms(boxes, np.array([0.9, 0.8, 0.7])).tolist() == [True, False, True]
    assert selection.group_lines(np.array([[0, 0, 10, 10], [12, 1, 20, 11], [60, 0, 70, 10], [0, 30, 5, 40]], float)).tolist() == [0, 0, 1, 2]


def test_word_lines(spark):
    rows = [("f", 0, "b", 0.5, 12.0, 0.0, 20.0, 10.0), ("f", 1, "a", 0.7, 0.0, 1.0, 10.0, 11.0), ("f", 2, "z", 0.1, 0.0, 50.0, 9.0, 60.0)]
    t = selection.lines_of_words(spark.createDataFrame(rows, "frame_id string, box_id int, text string, confidence double, x1 double, y1 double, x2 double, y2 double"))
    assert [(r.text, r.confidence) for r in t.orderBy("line").collect()] == [("a b", 0.6), ("z", 0.1)]


def test_coverage(spark):
    shots = spark.createDataFrame([("s", 0, 99, 10.0), ("t", 0, 9, 10.0)], "shot_id string, start_frame int, end_frame int, fps double")
    k = spark.createDataFrame([("s", 0), ("s", 50), ("s", 50)], "shot_id string, frame_idx int")
    assert {r.shot_id: round(r.coverage, 4) for r in aggregates.coverage(shots, k, 1.0).collect()} == {"s": 0.17, "t": 0.0}


def test_tags(spark):
    d = spark.createDataFrame([("f", [("car", 0.4), ("car", 0.9), ("dog", 0.5)]), ("g", [("cat", 0.1)])], "frame_id string, objects array<struct<label:string,confidence:double>>")
    assert [(r.frame_id, r.objects) for r in aggregates.max_confidence(d).collect()] == [("f", {"car": 0.9, "dog": 0.5})]


def test_min_match():
    assert [search.required(n) for n in (1, 2, 3, 4, 5, 8)] == [1, 2, 2, 3, 3, 6]


def test_within_one_edit(spark):
    rows = [("abc", "abcd", True), ("abc", "axc", True), ("ab", "ba", True), ("abc", "xyz", False), ("abcd", "acbd", True), ("abcd", "badc", False), ("a", "a", True)]
    df = spark.createDataFrame(rows, "a string, b string, want boolean")
    assert df.where(search.within_one("a", "b") != F.col("want")).count() == 0


def test_natural_order_and_ctc(spark):
    df = spark.createDataFrame([("img10",), ("img2",), ("img1",)], "x string")
    assert [r.x for r in df.orderBy(C.natural_key(F.col("x"))).collect()] == ["img1", "img2", "img10"]
    df = spark.createDataFrame([([1, 1, 2, 2, 0, 1, 1],)], "x array<int>")
    assert df.select(C.ctc_collapse(F.col("x"))).first()[0] == [1, 2, 1]


def test_recognised_text(spark):
    cases = {"1O:3O": "10:30", "nam 2O24": "nam 2024", "TH0NG H1NH": "THONG HINH", "cluoc Cla": "đuoc Đa", "a||b  c": "a b c", "VTV1 tphcm": "VTV1 TP.HCM", "1O5": "105", "1O.O": "10:0", " x ": "x", "8h3b": "8:36", "": "", "9O%x": "90%x", "9O% x": "9O% x"}
    df = spark.createDataFrame([*cases.items(), (None, "")], "a string, b string")
    assert [r for r in df.select("a", "b", C.clean_recognised(F.col("a")).alias("c")).collect() if r.c != r.b] == []


def test_composed_and_label_cleanup(spark):
    df = spark.createDataFrame([("Ha\u0300 No\u0323\u0302i", "Hà Nội", "HaNoi"), ("\ufb01\uff21\u00bd", "\ufb01\uff21\u00bd", "fiA12"), (None, None, None), ("", "", ""), ("\u212b", "\u00c5", "A"), ("đ x", "đ x", "x")], "x string, composed string, label string")
    got = df.select("*", C.composed(F.col("x")).alias("c"), C.clean_label(F.col("x")).alias("l")).collect()
    assert [r for r in got if r.c != r.composed or r.l != r.label] == []


def test_keyframes_of_longer_video_names(spark):
    df = spark.createDataFrame([("L01_V0010_kf1", "L01_V001"), ("L01_V001_kf1", "L01_V001"), ("x", None)], "keyframe_id string, video_id string")
    assert {(r.keyframe_id, r.fault) for r in checks.keyframe_faults(df).collect()} == {("L01_V0010_kf1", "video"), ("x", "video")}


def test_labels(spark):
    df = spark.createDataFrame([("cab",)], "x string")
    ids = df.select(C.encode_chars(F.col("x"), "abc", 6).alias("i"))
    assert ids.first()[0] == [3, 1, 2, 0, -1, -1]
    assert ids.select(C.decode_chars(F.col("i"), "abc")).first()[0] == "cab"


def test_upserts(spark):
    old = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "k int, p string, q string")
    new = spark.createDataFrame([(2, None, ""), (3, "c", None)], "k int, p string, q string")
    rows = lambda t: sorted(map(tuple, t.collect()))
    assert rows(merge.replace_rows(old, new, ["k"])) == [(1, "a", "x"), (2, None, ""), (3, "c", None)]
    assert rows(merge.insert_absent(old, new, ["k"])) == [(1, "a", "x"), (2, "b", "y"), (3, "c", None)]
    assert rows(merge.enrich_rows(old, new, ["k"])) == [(1, "a", "x"), (2, "b", ""), (3, "c", None)]


def test_status(spark):
    s = spark.createDataFrame([], "video_id string, steps map<string,struct<status:string,updated_at:string>>")
    s = merge.set_status(s, spark.createDataFrame([("v",)], "video_id string"), "frames", "done")
    work = spark.createDataFrame([("v",), ("w",)], "video_id string")
    assert [r.video_id for r in merge.not_done(work, s, "frames").collect()] == ["w"]


def test_vector_faults(spark):
    rows = [("a", [1.0, 0.0]), ("b", [float("nan"), 0.0]), ("c", [0.98, 0.0]), ("d", [1.0]), ("e", [1.0, 0.0]), ("e", [1.0, 0.0]), ("n", None)]
    t = checks.vector_faults(spark.createDataFrame(rows, "k string, v array<float>"), "k", "v", 2)
    assert {(r.k, r.fault) for r in t.collect()} == {("b", "not finite"), ("c", "norm"), ("d", "shape"), ("e", "duplicate"), ("n", "shape")}


def test_speech_results(spark):
    cases = {'"a b"': "a b", '{"text": "x"}': "x", '[{"text": "x"}, {"text": "y"}]': "x y", '["p", "q"]': "p q", '[["p"], [{"text": "r"}]]': "p r", "plain": "plain"}
    df = spark.createDataFrame(list(cases.items()), "a string, b string")
    assert [tuple(r) for r in df.select("a", "b", C.speech_text(F.col("a")).alias("c")).collect() if r.b != r.c] == []


def test_sample_is_stable(spark):
    a, b = (sorted(r.id for r in sequence.sampled(spark.range(100), 7, 3).collect()) for _ in range(2))
    assert a == b and len(a) == 7
