import random

import numpy as np

from shotlake.llm import spans
from shotlake.llm.fm import FMIndex


def brute(docs, n):
    seen = {}
    for k, t in docs:
        for i in range(len(t or "") - n + 1):
            seen.setdefault(t[i : i + n], set()).add(k)
    pairs, cover = set(), {}
    for s in seen.values():
        pairs |= {(a, b) for a in s for b in s if a < b}
    for k, t in docs:
        if t is not None:
            end = n_shared = 0
            for i in range(len(t) - n + 1):
                if len(seen[t[i : i + n]]) > 1:
                    n_shared += i + n - max(i, end)
                    end = i + n
            cover[k] = (len(t), n_shared)
    return pairs, cover


def corpus(seed):
    rnd = random.Random(seed)
    letters = "abcdefghij kố\U0001f600"
    text = lambda n: "".join(rnd.choice(letters) for _ in range(n))
    pieces = [text(rnd.choice((90, 99, 100, 101, 130, 260))) for _ in range(12)]
    docs = [(k, text(rnd.randrange(150)) + "".join(rnd.choice(pieces)[rnd.choice((0, 0, 3)) :] + text(rnd.randrange(80)) for _ in range(rnd.randrange(3)))) for k in range(70)]
    docs += [(100, None), (101, ""), (102, "x" * 99), (103, "x" * 150), (104, "x" * 400), (105, "ab" * 300), (106, docs[3][1]), (107, docs[3][1]), (108, "x" * 20_000)]
    return docs


def test_pairs_and_shares_against_brute_force(spark):
    docs = corpus(1)
    pairs, cover = brute(docs, 100)
    df = spark.createDataFrame(docs + docs[:5], "sid long, doc string")
    assert {tuple(r) for r in spans.shared_pairs(df, "sid", "doc").collect()} == pairs and len(pairs) > 20
    assert {r[0]: (r[1], r[2]) for r in spans.shared_share(df, "sid", "doc").collect()} == cover


def test_hot_anchors_and_many_copies(spark, monkeypatch):
    monkeypatch.setattr(spans, "BLOCK", 3)
    monkeypatch.setattr(spans, "SHARD", 500)
    docs = [(k, f"{k:03d}" * 9 + "chung một đoạn dài " * 8 + f"{k:04d}" * 9) for k in range(25)]
    df = spark.createDataFrame(docs, "k long, t string")
    pairs, _ = brute(docs, 100)
    assert {tuple(r) for r in spans.shared_pairs(df, "k", "t").collect()} == pairs
    monkeypatch.setattr(spans, "MANY_COPIES", 4)
    same = spark.createDataFrame([(k, docs[0][1]) for k in range(9)] + [(50, docs[1][1])], "k long, t string")
    assert {tuple(r) for r in spans.shared_pairs(same, "k", "t").collect()} == {(0, k) for k in range(1, 9)} | {(0, 50)}


def test_empty(spark):
    df = spark.createDataFrame([], "k long, t string")
    assert spans.shared_pairs(df, "k", "t").count() == 0 and spans.shared_share(df, "k", "t").count() == 0


def test_every_window_has_one_owner():
    rnd = random.Random(2)
    for text in ("".join(rnd.choice("ab") for _ in range(700)), "a" * 500, "abc" * 200):
        cp = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        h, t, s, n, p = spans.anchors(cp, np.zeros(len(cp), int), np.array([0, len(cp)]), 100)
        windows = sorted(x for a, b in zip(s.tolist(), n.tolist()) for x in range(a, a + b))
        assert windows == list(range(len(text) - 99))
        assert ((p >= s + n - 1) & (p <= s + 100 - spans.GRAM)).all()


def test_backward_search():
    rnd = random.Random(3)
    strings = ["".join(rnd.choice("abcd") for _ in range(60)) for _ in range(40)]
    ix = FMIndex([np.frombuffer(s.encode("utf-32-le"), np.uint32) for s in strings])
    text = ix.codes(np.frombuffer("".join(strings).encode("utf-32-le"), np.uint32))
    for n in (1, 3, 6):
        q, lo, hi = ix.window(text, 60 * np.arange(40) + 5, n)
        iv, who = ix.strings_at(lo, hi)
        for k, a in enumerate(q.tolist()):
            assert sorted(who[iv == k].tolist()) == sorted(i for i, s in enumerate(strings) for x in range(len(s) - n + 1) if s[x : x + n] == strings[a][5 : 5 + n])
        count = {i: sum(s[a : a + n] == strings[i][5 : 5 + n] for s in strings for a in range(len(s) - n + 1)) for i in range(40)}
        assert {int(a): int(c) for a, c in zip(q, hi - lo)} == {i: c for i, c in count.items() if c > 1}


def test_index_is_compressed_and_knows_no_foreign_signs():
    rnd = random.Random(4)
    strings = ["".join(rnd.choice("abcdefgh") for _ in range(500)) for _ in range(60)]
    ix = FMIndex([np.frombuffer(s.encode("utf-32-le"), np.uint32) for s in strings])
    held = sum(a.nbytes for a in (*ix.words, *ix.before, *ix.kept, ix.positions, ix.count, ix.base))
    assert held < 2 * ix.n  # of 4 bytes a code point and 8 a suffix
    text = ix.codes(np.frombuffer(("xyz" + strings[3][:40]).encode("utf-32-le"), np.uint32))
    assert (text[:3] == -1).all() and ix.window(text, np.array([1]), 30)[0].size == 0


def test_many_holders_of_one_passage(spark, monkeypatch):
    monkeypatch.setattr(spans, "HOLDERS", 4)
    docs = [(k, f"{k:03d}" * 9 + "chung một đoạn dài " * 8 + ("x" * 30 if k % 2 else f"{k:04d}" * 9)) for k in range(30)]
    df = spark.createDataFrame(docs, "k long, t string")
    assert {tuple(r) for r in spans.shared_pairs(df, "k", "t").collect()} == brute(docs, 100)[0]


def test_anchors_of_two_documents_over_batches():
    import pyarrow as pa

    rows = [(1, "a"), (1, "a"), (1, "b"), (2, "a"), (2, "a"), (3, "a"), (3, "b"), (3, "c"), (3, "c"), (4, "z")]
    for n in (1, 2, 3, 10):
        parts = [rows[i : i + n] for i in range(0, len(rows), n)]
        batches = [pa.RecordBatch.from_arrays([pa.array([r[0] for r in p]), pa.array([r[1] for r in p]), pa.array([0] * len(p))], names=["fp", "doc", "span"]) for p in parts]
        got = [(r["fp"], r["doc"]) for b in spans._of_two_documents(iter(batches)) for r in b.to_pylist()]
        assert got == [r for r in rows if r[0] in (1, 3)]
