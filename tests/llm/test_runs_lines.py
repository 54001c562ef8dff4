import random

from shotlake.llm import lines, runs
from shotlake.llm.canon import canonical


def distance(a, b):
    p = list(range(len(b) + 1))
    for i, x in enumerate(a):
        c = [i + 1]
        for j, y in enumerate(b):
            c.append(min(p[j + 1] + 1, c[j] + 1, p[j] + (x != y)))
        p = c
    return p[-1]


def same(a, b):
    return distance(a, b) <= max(len(a), len(b)) // 10


def noisy(t, rnd):
    t = list(t)
    for _ in range(rnd.randrange(4)):
        i = rnd.randrange(len(t))
        t[i : i + 1] = rnd.choice(["", "x", t[i] + "y", t[i].upper()])
    return "".join(t)


def test_runs_against_brute_force(spark):
    rnd = random.Random(5)
    base = ["Bản tin 24 giờ lịch thủy buổi sáng", "Nhấn theo dõi để xem thêm", "ngắn", ""]
    rows, cur = [], base[0]
    for v in ("v", "w", None):
        for i in range(150):
            if rnd.random() < 0.15:
                cur = rnd.choice(base)
            rows.append((v, f"{v}{i:04d}", rnd.choice((7, 3000)) + i * 9000 + (700_000 * (i // 40)), noisy(cur, rnd) if cur else rnd.choice((None, " ", ""))))
    df = spark.createDataFrame(rows + rows[:20] + [("v", "nt", None, "x")], "ptr string, id string, pts long, grp string")
    got = {tuple(r) for r in runs.repeated_runs(df, "ptr", "id", "pts", "grp").collect()}
    want = set()
    for v in ("v", "w", None):
        l = sorted((r for r in rows if r[0] == v), key=lambda r: r[2])
        run = []
        for r in [*l, None]:
            t = " ".join(canonical(r[3]).casefold().split()) if r and r[3] else None
            if run and t and run[-1][1] and same(run[-1][1], t):
                run.append((r, t))
                continue
            if len(run) > 1:
                want.add((v, run[0][0][1], len(run), run[-1][0][2] - run[0][0][2]))
            run = [(r, t)]
    assert got == want and len(want) > 20


def test_long_run(spark):
    df = spark.createDataFrame([("v", f"{i:05d}", i * 500_000, "như nhau") for i in range(1000)], "v string, k string, t long, x string")
    assert [tuple(r) for r in runs.repeated_runs(df, "v", "k", "t", "x").collect()] == [("v", "00000", 1000, 999 * 500_000)]
    assert runs.repeated_runs(df.limit(0), "v", "k", "t", "x").count() == 0


def letters(x):
    return "".join(c for c in canonical(x).casefold() if c.isalpha())


def test_lines_against_brute_force(spark):
    rnd = random.Random(6)
    notices = ["Chương trình có dán nhãn, khán giả cân nhắc", "Bản tin 24 giờ – Lịch Thủy", "QDP5", "2024 – 2025"]
    rows = []
    for v in ("v", "w", None):
        for i in range(60):
            t = [noisy(n, rnd) for n in notices if rnd.random() < (0.5 if v == "v" else 0.15)] + ["".join(rnd.choice("abcdefgh ") for _ in range(25)), ""]
            rnd.shuffle(t)
            rows.append((f"{v}{i}", v, rnd.choice([f"s{i // 3}", " ", None]), "\n".join(t)))
    rows += [("n", "v", "s", None), ("e", "v", "s", "")]
    df = spark.createDataFrame(rows + rows[:9], "line_no string, src string, units string, letters string")
    got = {tuple(r) for r in lines.repeated_lines(df, "line_no", "src", "units", "letters").collect()}
    want = set()
    for v in ("v", "w", None):
        occ = [(k, n, letters(x), u) for k, s, u, t in rows if s == v and t for n, x in enumerate(t.split("\n"), 1) if letters(x)]
        by = {}
        for _, _, l, u in occ:
            by.setdefault(l, set()).update({u} if u and u.strip() else ())
        cases = {l for l in by if len(set().union(*[by[m] for m in by if same(l, m)])) >= 8}
        want |= {(k, n) for k, n, l, _ in occ if l in cases}
    assert len(want) > 30 and len(got & want) >= 0.98 * len(want) and not got - want
    clean = {r.id: (r.text, r.n_removed) for r in lines.without_repeated(df, "line_no", "src", "units", "letters").collect()}
    for k, _, _, t in rows:
        gone = {n for i, n in got if i == k}
        assert clean[k] == (None if t is None else "\n".join(x for n, x in enumerate(t.split("\n"), 1) if n not in gone) if t else "", len(gone))


def test_no_line_at_the_allowed_distance_is_missed(spark):
    rnd = random.Random(8)
    rows = []
    for i in range(600):
        # A line that eight shots hold, and one of a ninth shot with as many letters replaced, left out and put in, spread, as are allowed.
        n = rnd.choice((10, 11, 19, 20, 29, 30, 45, 70)) if i >= 300 else 10
        heavy = [rnd.choice("abcdefghijklmnoprstuvy") for _ in range(n)]
        light = list(heavy)
        k = n // 10
        for j in range(k):
            at = int((j + 0.5) * n / k) - j
            light[at : at + 1] = rnd.choice((["w"], ["w"], [light[at], "w"], [])) if k > 1 else ["w"]
        light = "".join(light)
        rows += [(f"h{i}_{u}", f"v{i}", f"s{u}", "".join(heavy)) for u in range(8)]
        if same("".join(heavy), light):
            rows.append((f"l{i}", f"v{i}", "s9", light))
    df = spark.createDataFrame(rows, "k string, v string, u string, t string")
    got = {r.id for r in lines.repeated_lines(df, "k", "v", "u", "t").collect()}
    assert got == {r[0] for r in rows} and sum(r[0][0] == "l" for r in rows) > 500


def test_empty(spark):
    df = spark.createDataFrame([], "k string, v string, u string, t string")
    assert lines.repeated_lines(df, "k", "v", "u", "t").count() == 0 and lines.without_repeated(df, "k", "v", "u", "t").count() == 0
