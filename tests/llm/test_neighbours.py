import numpy as np
import pytest

from shotlake.llm import neighbours


def brute(rows, dim, k, least):
    seen = {i: np.array(v, np.float64) for i, v in rows if v is not None and len(v) == dim and None not in v}
    seen = {i: v / np.linalg.norm(v) for i, v in seen.items() if np.isfinite(v).all() and v.any()}
    ids, x = list(seen), np.stack(list(seen.values()))
    s = x @ x.T
    np.fill_diagonal(s, -2)
    kth = np.where((s > -2).sum(1) >= k, -np.partition(-s, min(k, len(s)) - 1, axis=1)[:, min(k, len(s)) - 1], -1)
    a, b = np.nonzero((s >= least) & (s >= kth[:, None] - 1e-5))
    return {(min(ids[i], ids[j]), max(ids[i], ids[j])) for i, j in zip(a, b)}


def rows(n=1500, dim=48, seed=0):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(n // 8, dim))
    x = base[rng.integers(0, len(base), n)] + 0.35 * rng.normal(size=(n, dim))
    out = [(f"f{i:05d}", [float(v) for v in np.float32(r)]) for i, r in enumerate(x)]
    out += [(f"c{i}", out[i % 3][1]) for i in range(20)]
    out += [("null", None), ("short", [1.0] * 5), ("zero", [0.0] * dim), ("nan", [float("nan")] + [1.0] * (dim - 1)), ("hole", [None] + [1.0] * (dim - 1)), ("long", [2 * v for v in out[7][1]])]
    return out


@pytest.fixture(scope="module")
def table(spark):
    r = rows()
    return r, spark.createDataFrame(r + r[:50], "a string, cos array<float>")


def test_recall_and_precision(table):
    r, df = table
    want = brute(r, 48, 5, 0.8)
    got = {(x[0], x[1]) for x in neighbours.near_pairs(df, "a", "cos", 48).collect()}
    assert len(want & got) >= 0.97 * len(want) and len(want & got) >= 0.99 * len(got)


def test_hot_lists_are_spread(table, monkeypatch):
    r, df = table
    monkeypatch.setattr(neighbours, "HOT", 10)
    monkeypatch.setattr(neighbours, "CROWDED", 0)
    want = brute(r, 48, 5, 0.8)
    got = {(x[0], x[1]) for x in neighbours.near_pairs(df, "a", "cos", 48).collect()}
    assert len(want & got) >= 0.97 * len(want)


def test_many_copies(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "MANY_COPIES", 5)
    df = spark.createDataFrame([(f"x{i}", [1.0, 0.0]) for i in range(9)] + [("y", [1.0, 0.1])], "k string, v array<float>")
    got = {(x[0], x[1]) for x in neighbours.near_pairs(df, "k", "v", 2).collect()}
    assert got == {("x0", f"x{i}") for i in range(1, 9)} | {("x0", "y")}


def test_few_rows_and_none(spark):
    df = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [1.0, 0.1]), ("c", [-1.0, 0.0])], "k string, v array<float>")
    assert {(x[0], x[1]) for x in neighbours.near_pairs(df, "k", "v", 2).collect()} == {("a", "b")}
    assert neighbours.near_pairs(df.limit(0), "k", "v", 2).count() == 0
    assert neighbours.near_pairs(df, "k", "v", 3).count() == 0


def test_packing_loses_nothing():
    import zstandard

    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal(size=(3, 300)), rng.integers(-5, 5, (3, 300)) * 0.1, np.zeros((1, 300))]).astype(np.float32)
    packed = neighbours._pack(x, zstandard.ZstdCompressor(level=3))
    assert (neighbours._unpack(packed, 300, zstandard.ZstdDecompressor()) == x).all() and len(packed[3]) < len(packed[0]) / 3


def test_crowded_cells_are_split():
    rng = np.random.default_rng(5)
    x = neighbours._unit(np.concatenate([rng.normal(size=(600, 16)), 3 + 0.5 * rng.normal(size=(1400, 16))]).astype(np.float32))[0]
    quant = neighbours.Quantizer(x, 20, 10**7)
    i, unit = quant.units(x)
    assert set(i.tolist()) == set(range(2000)) and unit.max() < len(quant.blocks)
    one = neighbours.Quantizer(np.tile(x[:1], (2000, 1)), 20, 10**7)
    assert one.blocks.sum() > len(one.cells.centres)  # what can't be split has blocks of queries
