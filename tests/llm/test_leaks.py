import random
import re
import unicodedata

import numpy as np

from shotlake.llm import leaks
from shotlake.llm.canon import canonical


def fold(s):
    s = canonical(s).casefold()
    s = "".join(c for c in unicodedata.normalize("NFD", s) if unicodedata.category(c)[0] != "M").replace("đ", "d")
    return re.findall(r"[^\W_]+", s)


def brute(docs, items, n=10):
    out = set()
    for i, t in items:
        w = fold(t or "")
        k = min(n, len(w))
        grams = {tuple(w[a : a + k]) for a in range(len(w) - k + 1)} if k else set()
        for j, d in docs:
            x = fold(d or "")
            if any(tuple(x[a : a + k]) in grams for a in range(len(x) - k + 1)):
                out.add((j, i))
    return out


def test_found_against_brute_force(spark):
    rnd = random.Random(4)
    words = "một hai ba bốn năm sáu bảy đồng Đước rừng straße ﬁne νideo x1".split()
    items = [(k, " ".join(rnd.choice(words) for _ in range(rnd.choice((3, 8, 10, 14, 25))))) for k in range(40)] + [(90, ""), (91, None), (92, "..."), (5, None)]
    docs = []
    for k in range(150):
        body = [rnd.choice(words) for _ in range(rnd.randrange(60))]
        if k % 3 == 0:
            w = items[rnd.randrange(40)][1].split()
            a = rnd.randrange(max(1, len(w) - 9))
            part = w[a : a + rnd.choice((9, 10, 12))]
            if k % 2:
                part = [unicodedata.normalize("NFD", x).upper() for x in part]
            body[len(body) // 2 : len(body) // 2] = part
        docs.append((k, ", ".join(body) if k % 5 else "  ".join(body)))
    docs += [(900, None), (901, ""), (902, " "), (903, "một " * 30_000)]
    d = spark.createDataFrame(docs * 2, "item_id long, distance string")
    i = spark.createDataFrame(items * 2, "doc_id long, text string")
    got = {tuple(r)[:2] for r in leaks.leaks(d, "item_id", "distance", i, "doc_id", "text").where("distance = 0").collect()}
    want = brute(docs, items[:-1])
    assert got == want and len(want) > 20
    assert leaks.leaks(d.limit(0), "item_id", "distance", i, "doc_id", "text").count() == 0
    assert leaks.leaks(d, "item_id", "distance", i.limit(0), "doc_id", "text").count() == 0


def test_blocks_of_items(spark, monkeypatch):
    d = spark.createDataFrame([(1, "a b c d")], "k long, t string")
    i = spark.createDataFrame([(n, t) for n, t in enumerate(("a b", "b c", "x y"))], "k long, t string")
    monkeypatch.setattr(leaks, "BLOCK_CHARS", 3)
    assert {tuple(r) for r in leaks.leaks(d, "k", "t", i, "k", "t", edits=0).collect()} == {(1, 0, 0), (1, 1, 0)}


def test_other_types_of_keys(spark):
    d = spark.createDataFrame([("x", "một hai ba")], "k string, t string")
    i = spark.createDataFrame([(7, "hai ba")], "k int, t string")
    assert [tuple(r) for r in leaks.leaks(d, "k", "t", i, "k", "t").collect()] == [("x", 7, 0)]


def test_recall_of_one_edit():
    rng = np.random.default_rng(1)
    win = rng.integers(0, 1 << 63, (2000, 10), dtype=np.uint64)
    other = win.copy()
    other[np.arange(2000), rng.integers(0, 10, 2000)] = rng.integers(0, 1 << 63, 2000, dtype=np.uint64)
    hit = np.zeros(2000, bool)
    for r in range(leaks.REPETITIONS):
        hit |= leaks.embed(win, r) == leaks.embed(other, r)
    assert hit.mean() > 0.95
    assert (leaks.edit_distance(win, other) == 1).all()


def test_recall_of_near_leaks_against_brute_force(spark):
    """One word replaced, left out or put in, at any place: at least 0.9 of those that brute force finds, of each kind."""
    rnd = random.Random(11)
    vocabulary = ["".join(rnd.choice("abcdeghiklmnopqrstuvxy") for _ in range(5)) for _ in range(400)]
    items = [(k, [rnd.choice(vocabulary) for _ in range(rnd.choice((6, 10, 14)))]) for k in range(240)]
    docs, kinds = [], {}
    for k, w in items:
        n = min(10, len(w))
        for kind in "rdi":
            at = rnd.randrange(1, n - 1)
            part = w[:n]
            part = part[:at] + {"r": ["zzz"], "d": [], "i": ["zzz", part[at]]}[kind] + part[at + 1 :]
            doc = 1000 * "rdi".index(kind) + k
            kinds[doc, k] = kind
            docs.append((doc, " ".join([*(rnd.choice(vocabulary) for _ in range(20)), "yyy", *part, "yyy", *(rnd.choice(vocabulary) for _ in range(20))])))
    d = spark.createDataFrame(docs, "k long, t string")
    i = spark.createDataFrame([(k, " ".join(w)) for k, w in items], "k long, t string")
    got = {(r.doc_id, r.item_id): r.distance for r in leaks.leaks(d, "k", "t", i, "k", "t").collect()}
    for kind in "rdi":
        want = {p for p, x in kinds.items() if x == kind}
        assert len(want & set(got)) >= 0.9 * len(want), kind
    assert all(got[p] == 1 for p in kinds if p in got)
