import random

import pytest

from shotlake.operators import joins
from shotlake.operators.dyadic import periods, periods_and_gaps


def merged(rows):
    out = []
    for k in sorted({r[0] for r in rows}, key=str):
        cur = None
        for _, s, e in sorted(r for r in rows if r[0] == k and r[1] is not None and r[2] is not None and r[1] < r[2]):
            if cur and s <= cur[2]:
                cur = (k, cur[1], max(cur[2], e))
            else:
                if cur:
                    out.append(cur)
                cur = (k, s, e)
        if cur:
            out.append(cur)
    return out


@pytest.mark.parametrize("seed", range(3))
def test_periods_against_sweep(spark, seed):
    rnd = random.Random(seed)
    sizes = [1, 2, 7, 1000, 65536] + ([2**21, 2**23 + 5, 2**41] if seed else [])
    rows = [(rnd.choice("abc"), s, s + rnd.choice(sizes)) for s in [rnd.randrange(-(2 ** (12 + 15 * seed)), 2 ** (12 + 15 * seed)) for _ in range(600)]]
    df = spark.createDataFrame(rows * 2, "k string, s long, e long")
    assert sorted(map(tuple, periods(df, ["k"], "s", "e").collect())) == sorted(merged(rows))


def test_periods_nulls_touching_and_names(spark):
    rows = [("a", 0, 10, 1), ("a", 10, 20, 2), ("a", 30, 30, 3), ("a", 40, 35, 4), ("a", None, 5, 5), ("a", 50, None, 6), (None, 1, 2, 7), ("a", 700, 701, 8)]
    df = spark.createDataFrame(rows, "tile string, s long, idx long, level int").withColumnRenamed("idx", "e")
    got = sorted(map(tuple, periods_and_gaps(df, ["tile"], "s", "e", 600).collect()), key=str)
    assert got == sorted([("a", "period", 0, 20), ("a", "period", 700, 701), (None, "period", 1, 2)], key=str)
    got = {tuple(r) for r in periods_and_gaps(df, ["tile"], "s", "e", None).collect()}
    assert ("a", "gap", 20, 700) in got


@pytest.mark.parametrize("seed", range(2))
def test_gaps_within_and_between_tiles(spark, seed):
    rnd = random.Random(seed)
    sizes = [1, 1000, 2**19, 2**20, 2**21 + 3] + ([2**41] if seed else [])
    rows = [(rnd.choice(("a", None)), s, s + rnd.choice(sizes)) for s in [rnd.randrange(-(2**20), 2 ** (26 + 17 * seed)) for _ in range(60)]]
    # Borders of tiles: touching from both sides, and a gap that begins or ends at one.
    rows += [("b", 5, 2**20), ("b", 2**20, 2**20 + 9), ("b", 2**20 + 12, 2**21), ("b", 2**21 + 1, 2**21 + 2), ("b", 2**23, 2**23 + 1)]
    df = spark.createDataFrame(rows, "k string, s long, e long")
    want = [(k, "period", s, e) for k, s, e in merged(rows)]
    want += [(k, "gap", e, s2) for (k, _, e), (k2, s2, _) in zip(merged(rows), merged(rows)[1:]) if k == k2]
    assert sorted(map(tuple, periods_and_gaps(df, ["k"], "s", "e", None).collect()), key=str) == sorted(want, key=str)


def test_periods_of_empty_table(spark):
    df = spark.createDataFrame([], "k string, s long, e long")
    assert periods_and_gaps(df, ["k"], "s", "e", 5).collect() == []


def test_transcripts_fall_back_only_without_overlap(spark):
    shots = spark.createDataFrame([("v", "A", 0, 49, 25.0), ("v", "B", 50, 99, 25.0), ("v", "C", 200, 249, 25.0), ("v", "D", 300, 349, 25.0)], "video_id string, shot_id string, start_frame int, end_frame int, fps double")
    segs = spark.createDataFrame([("v", "1", 0, 1000, "a"), ("v", "2", 1500, 2100, "b"), ("v", "3", 10300, 11000, "c"), ("v", "4", 0, 1, " ")], "video_id string, seg_id string, start_ms long, end_ms long, text string")
    got = {r.shot_id: r.text for r in joins.shot_transcripts(shots, segs).collect()}
    assert got == {"A": "a b", "B": "b", "C": "c"}


def test_asof_takes_the_last_start_only(spark):
    shots = spark.createDataFrame([("v", "s1", 0, 9), ("v", "s2", 12, 20), ("w", "big", 0, 100), ("w", "in", 10, 20)], "video_id string, shot_id string, start_frame int, end_frame int")
    f = spark.createDataFrame([("v", i) for i in (5, 9, 10, 12, 21, -1)] + [("w", 50), ("x", 1)], "video_id string, frame_idx int")
    for span in (7, 100_000):
        got = {(r.video_id, r.frame_idx): r.shot_id for r in joins.asof_shot(f, shots, span).collect()}
        assert got == {("v", 5): "s1", ("v", 9): "s1", ("v", 10): "", ("v", 12): "s2", ("v", 21): "", ("v", -1): "", ("w", 50): "", ("x", 1): ""}


def test_text_falls_back_by_presence(spark):
    f = spark.createDataFrame([("f1", "v"), ("f2", "v"), ("f3", "u")], "frame_id string, video_id string")
    ocr = spark.createDataFrame([("f1", ""), ("v", "whole")], "frame_id string, text string")
    none = spark.createDataFrame([], "frame_id string, text string")
    objects = spark.createDataFrame([], "frame_id string, objects map<string,double>")
    got = {r.frame_id: r.ocr_text for r in joins.enrich(f, objects, ocr, none, none).collect()}
    assert got == {"f1": "", "f2": "whole", "f3": None}




def test_half_open(spark):
    df = spark.createDataFrame([(100, 200)], "a long, b long")
    assert [joins.half_open(df, "a", "b", *x).count() for x in ((200, 300), (199, 300), (0, 100))] == [0, 1, 0]
