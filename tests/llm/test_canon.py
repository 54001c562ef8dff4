import unicodedata

import pytest
from pyspark.sql import functions as F

from shotlake.llm import canon

CASES = {
    "νideο Uуên": "video Uyên", "ΚΑΦΕ ВОКЗАЛ": "ΚΑΦΕ ВОКЗАЛ", "ΗỒ": "HỒ", "Ｐｈíａ，": "Phía,", "a‍b \U0001f468‍\U0001f469": "ab \U0001f468‍\U0001f469",
    "ðồng Ð/BÓ": "đồng Đ/BÓ", "tre​о": "treo", "30℃ №25 ½ m² a™ Noël ③…": "30℃ №25 ½ m² a™ Noël ③…", "x y　z\tq": "x y z q", "a\r\nb\rc": "a\nb\nc",
    "nhất": "nhất", "ậ": "ậ", "мир tһôn": "мир thôn", "": "", "​": "", "plain\nline": "plain\nline", "а́b": "áb",
}


@pytest.mark.parametrize("text", CASES)
def test_cases(text):
    assert canon.canonical(text) == CASES[text]
    assert canon.canonical(CASES[text]) == CASES[text]


def test_stable_characters_do_not_change():
    for a, b in canon.STABLE:
        for o in range(a, b + 1):
            assert canon._segment.__wrapped__(chr(o)) == chr(o)


def test_segments_equal_the_whole():
    words = [*CASES, "bình thường", "ệ", "㎡", "ﬁ", "가"]
    for a in words:
        for b in words:
            t = f"{a} {b}\n{a}"
            s = canon.canonical(t)
            assert canon.canonical(s) == s and unicodedata.is_normalized("NFC", s)


def test_long_segment():
    t = "ａ" * 100_000 + " x"
    assert canon.canonical(t) == "a" * 100_000 + " x"


def test_columns(spark):
    rows = [(str(i), t) for i, t in enumerate(CASES)] + [("n", None)]
    df = spark.createDataFrame(rows * 2, "field string, text string")
    got = {r.field: r.c for r in df.select("field", canon.canonical_col(F.col("text")).alias("c")).collect()}
    assert got == {k: canon.canonical(t) for k, t in rows}
    low = {r.field: r.c for r in df.select("field", canon.folded_col(F.col("text")).alias("c")).collect()}
    assert low == {k: canon.folded(t) for k, t in rows}
    found = canon.changed_cells(df, "field", "text").collect()
    assert sorted(r.frame_id for r in found) == sorted(k for k, t in rows if t is not None and canon.canonical(t) != t)
    assert {r.field for r in found} == {"text"}


def test_empty_table(spark):
    df = spark.createDataFrame([], "k string, t string")
    assert canon.changed_cells(df, "k", "t").count() == 0
    assert canon.consistent_texts(df, "k", ["t"]).count() == 0


def test_consistent_texts(spark):
    df = spark.createDataFrame([("a", "ｘ"), ("b", "y"), ("c", None), ("a", "ｘ")], "k string, t string")
    assert {tuple(r) for r in canon.consistent_texts(df, "k", ["t"]).collect()} == {("t", "a", "x", True), ("t", "b", "y", False)}
