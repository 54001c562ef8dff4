import random

import numpy as np
import pytest

from shotlake.llm import truncation


def sentence(rnd):
    thing = lambda: rnd.choice(["bảng gỗ", "tấm rèm", "cánh cổng", "máy cày", "giàn mướp", "bể cá"]) + " " + rnd.choice(["ba chân", "có quai", "mới", "kẻ sọc", "trắng ngà"])
    t = f"{rnd.choice(['Toàn cảnh', 'Cận cảnh'])}, một {rnd.choice(['đầu bếp', 'cậu bé', 'ngư dân'])} mặc áo màu {rnd.choice(['đỏ', 'nâu'])} rửa {thing()} cạnh {thing()} ở nhà ga {rnd.choice(['Cát', 'Sậy', 'Phù'])} {rnd.choice(['buổi trưa', 'ban đêm', 'lúc chiều muộn'])}"
    for _ in range(rnd.randrange(3)):
        t += f". Phía sau là {thing()} và {thing()}, bên phải có {rnd.randrange(2, 30)} {thing()}"
    return t


def table(n=3000, seed=1):
    rnd = random.Random(seed)
    rows, cut = [], set()
    for i in range(n):
        t, src = sentence(rnd) + ("." if rnd.random() < 0.93 else ""), rnd.choice("ab")
        if src == "a" and len(t) > 150:
            t = t[:150]
            cut.add(f"f{i}")
        elif rnd.random() < 0.04:
            t = t[: rnd.randrange(20, len(t) - 3)] + rnd.choice(("", "…", "..."))
            cut.add(f"f{i}")
        rows.append((f"f{i}", src, t))
    return rows, cut


def test_found_and_shares(spark):
    rows, cut = table()
    df = spark.createDataFrame(rows + rows[:30] + [("n", "a", None), ("e", "b", ""), ("w", None, " \n"), ("s", None, "Một câu trọn vẹn.")], "src string, text string, canon string")
    got = {r.id for r in truncation.truncated(df, "src", "text", "canon").collect()}
    seen = {k for k, _, t in rows if k in cut and not t.endswith((".", "!")) or t.endswith("...")}
    assert len(got & seen) >= 0.95 * len(seen) and len(got & cut) >= 0.95 * len(got)
    share = {r.source: r for r in truncation.truncation_share(df, "src", "text", "canon").collect()}
    assert sum(r.n_truncated for r in share.values()) == len(got) and share[""].n_texts == 1 and share[""].share == 0


def test_limits_of_empty_and_closed(spark):
    df = spark.createDataFrame([("a", "x", "Xong.")], "k string, s string, t string")
    assert truncation.truncated(df, "k", "s", "t").count() == 0
    assert truncation.truncated(df.limit(0), "k", "s", "t").count() == 0
    assert truncation.truncation_share(df.limit(0), "k", "s", "t").count() == 0
    assert truncation.truncated(spark.createDataFrame([("a", "x", "chưa xo" * 5000)], "k string, s string, t string"), "k", "s", "t").count() <= 1


def test_censored_fit():
    rng = np.random.default_rng(0)
    x = np.exp(rng.normal(5, 0.4, 20_000)).astype(int) + 1
    length = np.arange(1, x.max() + 1)
    full = np.bincount(x, minlength=len(length) + 1)[1:].astype(float)
    exact = np.where(length < 160, full, 0)
    censored = np.where(length == 160, full[length >= 160].sum(), 0)
    mu, sd = truncation.fit_censored(length, exact, censored)
    assert mu == pytest.approx(5, abs=0.03) and sd == pytest.approx(0.4, abs=0.03)


def test_words_are_counted_in_all_closed_texts(spark, monkeypatch):
    # Far more texts than the sample; every name ends 20 of them, so that the sample holds it twice at most.
    monkeypatch.setattr(truncation, "TRAIN", 60)
    monkeypatch.setattr(truncation, "FRAME", 2)
    seen = {}

    class Spy(truncation.Endings):
        def __init__(self, made, frame, level, rng):
            seen.update(made=made, frame=frame, level=level)
            super().__init__(made, frame, level, rng)

    monkeypatch.setattr(truncation, "Endings", Spy)
    rnd = random.Random(4)
    name = lambda i: "".join(chr(97 + int(c)) for c in f"{i % 50:02d}") + "ville"
    rows = [(f"c{i:04d}", "a", f"{'Một' if i % 2 else 'Hai'} người ở {name(i)}.") for i in range(1000)]
    rows += [(f"o{i:04d}", "a", f"Một người ở {name(i)}") for i in range(50)]
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "k string, s string, t string")
    closed = spark.createDataFrame([(t,) for k, _, t in rows if k[0] == "c"], "canon string")
    counts = {r.word: r.n for r in truncation.word_counts(closed).collect()}
    assert counts == {"": 1000, "một": 500, "hai": 500, "người": 1000, "ở": 1000} | {name(i): 20 for i in range(50)}
    truncation.truncated(df, "k", "s", "t").collect()
    assert seen["frame"] == {"người", "ở"} and sum(y == 0 for _, y in seen["made"]) <= 60
    assert {seen["level"][truncation.last_word(x)] for x, y in seen["made"] if y == 0} == {2}


def test_limits_from_the_fit(monkeypatch):
    rng = np.random.default_rng(2)
    x = np.exp(rng.normal(5, 0.3, 20_000)).astype(int)
    closed = rng.random(20_000) < 0.95
    length = np.arange(1, 700)
    n = lambda v: np.bincount(v, minlength=700)[1:].astype(float)
    # As they are; kept to 180; kept to 180 by cutting at a blank.
    assert truncation.find_limits(length, n(x[closed]), n(x[~closed]), True) == []
    low = x <= 180
    at = truncation.find_limits(length, n(x[closed & low]), n(np.r_[x[~closed & low], np.full((~low).sum(), 180)]), True)
    assert [v for v, p in at if p > 0.9] == [180]
    blanks = 180 - rng.integers(0, 6, (~low).sum())
    at = truncation.find_limits(length, n(x[closed & low]), n(np.r_[x[~closed & low], blanks]), True)
    assert {175, 176, 177, 178, 179, 180} <= {v for v, _ in at} <= set(range(171, 185))
    # Another fit, other limits.
    for mu, sd in ((0.0, 0.05), (20.0, 5.0), (5.0, 1.0)):
        monkeypatch.setattr(truncation, "fit_mixture", lambda length, exact, censored, parts, mu=mu, sd=sd: (np.full(parts, 1 / parts), np.full(parts, mu), np.full(parts, sd)))
        other = truncation.find_limits(length, n(x[closed & low]), n(np.r_[x[~closed & low], blanks]), True)
        assert {v for v, _ in other} != {v for v, _ in at}
