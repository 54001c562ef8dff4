"""Problem 1: the most similar vectors of every vector.

Inverted file of coarse centroids with product-quantised residuals, asymmetric distance tables, and
exact reranking.

1. The coarse quantiser has two levels: cells, and each cell's lists. With
   ``sqrt(rows / LIST)`` cells, and a list for ``LIST`` members of a cell, lists grow with the rows, without a ceiling.
   A cell is a group of neighbouring directions (``ROUTES`` in all, four a cell where that is more),
   because groups of fine directions seldom part neighbours. They and the codebooks of residuals are fitted in one task on a bounded sample (``TRAIN`` rows, six a direction where that is more,
   ``MOST_TRAIN`` at most); a cell's lists are fitted where its vectors meet. Every row is indexed.
2. Nearness to a cell is the cosine after the sample's mean is taken off; with the mean on, the cells near it
   would draw most of the collection; likewise for lists in a cell. A vector is sent, packed, to the cell of the direction nearest to it and to those of directions nearly as near
   (``SPREAD``, at most ``PROBES``). Vectors that are equal and lie in one task are sent once
   (as far as ``SENT`` keys are remembered), so a vector with a great many copies adds one row a task.
3. In a cell every vector joins its list as a code of its residual (``PARTS`` half bytes), with a scale and a shift that make the
   asymmetric estimate unbiased, and is a query against the ``LISTS`` lists nearest to it: its table of dot products
   with the codebooks gives estimates for the members, and those near ``least`` and not far below its ``k``-th best are
   reranked by their exact cosine. A cell is worked on in blocks of queries against blocks of a list's members,
   so memory doesn't grow with the square of it.
   Of such a block of which more than ``DENSE`` would be reranked all exact products are formed at once: the same rows come
   out, at less cost. Vectors of a cell of more than ``WHOLE`` rows stay packed until they are needed.
4. A cell expected to hold ``CROWDED`` times the usual rows, and ``HOT`` at least, is split by directions of its own into cells of
   the usual size, of which a vector goes to the ``LISTS`` nearest. What can't be split is spread by blocks of queries.
5. Candidates of a query from its cells meet, copies of a vector count as often as they occur, and
   those not below the ``k``-th best (within ``TIE``) and ``least`` stay.

A usable vector has ``dim`` finite numbers that are not all zero; others take no part. A key delivered
twice counts once. Copies of one vector are near each other; classes of more than ``MANY_COPIES``
give one pair a copy, with the class's least key, and are represented by it in pairs with others.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Rows that directions and codebooks are fitted on: TRAIN, or six a direction, MOST_TRAIN at most.
TRAIN, MOST_TRAIN = 6000, 65_536
#: Members that a list should have, on average.
LIST = 100
#: Parts of a residual, and centroids of a part: two places of a code go in a byte.
PARTS, CODES = 64, 16
#: Directions that the cells are groups of.
ROUTES = 1000
#: Directions of a vector at most, and how much less near than the first they may be, in units of 1 / sqrt(dim):
#: so much the nearness to a direction scatters between two vectors of one neighbourhood.
PROBES, SPREAD = 5, 1.3
#: Lists of its cell that a query looks into, and queries that are worked on together.
LISTS, BLOCK = 4, 2048
#: Estimates may fall short of the exact cosine by so much.
SLACK = 0.12
TIE = 1e-5
#: Share of the pairs of a list and its queries that need reranking from which the whole block is multiplied out.
DENSE = 0.1
#: Rows of a cell, and times the usual number of rows, beyond which it is split.
HOT, CROWDED = 20_000, 8
#: Vectors that are unpacked at a time, keys of vectors that a task remembers.
WHOLE, SENT = 8192, 2_000_000
MANY_COPIES = 1000


def _unit(flat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of unit length; whether each row is usable."""
    with np.errstate(all="ignore"):
        norm = np.sqrt(np.einsum("ij,ij->i", flat, flat, dtype=np.float64))
        ok = np.isfinite(norm) & (norm > 0)
        return (flat / np.where(ok, norm, 1)[:, None]).astype(np.float32), ok


def _matrix(col: pa.ListArray, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows, matrix) of the lists of the right length without nulls in them."""
    size = np.nan_to_num(col.value_lengths().to_numpy(zero_copy_only=False), nan=-1)
    rows = np.nonzero(size == dim)[0]
    if not len(rows):
        return rows, np.zeros((0, dim), np.float32)
    flat = col.take(pa.array(rows)).flatten()
    return rows, flat.to_numpy(zero_copy_only=False).astype(np.float32).reshape(len(rows), dim)


def _means(x: np.ndarray, near: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number, mean) of the clusters that have members."""
    order = np.argsort(near, kind="stable")
    at = np.nonzero(np.r_[True, np.diff(near[order]) > 0])[0]
    return near[order][at], np.add.reduceat(x[order], at, axis=0) / np.diff(np.r_[at, len(x)])[:, None]


def _kmeans(x: np.ndarray, k: int, rounds: int, rng: np.random.Generator, unit: bool = False) -> np.ndarray:
    """Centroids; with ``unit`` they and nearness are those of directions."""
    c = x[rng.choice(len(x), k, replace=len(x) < k)].copy()
    for _ in range(rounds):
        d = x @ c.T
        if not unit:
            d -= 0.5 * (c * c).sum(1)
        got, mean = _means(x, d.argmax(1))
        c[got] = _unit(mean)[0] if unit else mean
        empty = np.setdiff1d(np.arange(k), got)
        c[empty] = x[rng.integers(0, len(x), len(empty))]
    return c


def _pack(x: np.ndarray, z: zstandard.ZstdCompressor) -> list[bytes]:
    """Each row, without loss: up to 256 different values as a dictionary and a byte a place, others as they are."""
    above = x - x.min(1, keepdims=True)
    with np.errstate(all="ignore"):
        level = np.rint(above / np.where(above > 0, above, np.inf).min(1, keepdims=True))
    # Values on a grid have few levels; whether a level stands for one value is seen by looking it up.
    fits = np.isfinite(level).all(1) & (level.max(1, initial=0) < 256)
    level = np.where(fits[:, None], level, 0).astype(np.uint8)
    kinds = np.zeros((len(x), 256), np.float32)
    kinds[np.arange(len(x))[:, None], level] = x
    fits &= (np.take_along_axis(kinds, level.astype(np.int64), 1) == x).all(1)
    size = level.max(1, initial=0).astype(int) + 1
    return [n.to_bytes(2, "little") + k[:n].tobytes() + z.compress(v.tobytes()) if ok else bytes(2) + z.compress(row.tobytes()) for ok, n, k, v, row in zip(fits.tolist(), size.tolist(), kinds, level, x)]


def _unpack(packed: list[bytes], dim: int, z: zstandard.ZstdDecompressor) -> np.ndarray:
    out = np.empty((len(packed), dim), np.float32)
    for row, p in zip(out, packed):
        n = int.from_bytes(p[:2], "little")
        body = z.decompress(p[2 + 4 * n :])
        row[:] = np.frombuffer(p, np.float32, n, 2)[np.frombuffer(body, np.uint8)] if n else np.frombuffer(body, np.float32)
    return out


def _first(v: np.ndarray, n: int) -> np.ndarray:
    """Columns of the n highest values of each row, highest first."""
    n = min(n, v.shape[1])
    top = np.argpartition(-v, n - 1, axis=1)[:, :n] if n < v.shape[1] else np.tile(np.arange(n), (len(v), 1))
    return np.take_along_axis(top, np.argsort(-np.take_along_axis(v, top, 1), axis=1, kind="stable"), 1)


class Directions:
    """n directions from the mean of a sample, in groups. Nearness is the cosine after the mean is taken off."""

    def __init__(self, sample: np.ndarray, n: int, groups: int, rng: np.random.Generator):
        self.mean = sample.mean(0) if len(sample) > 1 else np.zeros_like(sample[0])
        to = _kmeans(_unit(sample - self.mean)[0], n, 3, rng, unit=True)
        self.centres = _kmeans(to, min(groups, n), 6, rng, unit=True)
        group = (to @ self.centres.T).argmax(1)
        self.to, self.group = to, group

    def nearest(self, x: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """The n nearest directions of each row, nearest first, and their cosines."""
        d = _unit(x - self.mean)[0] @ self.to.T
        top = _first(d, n)
        return top, np.take_along_axis(d, top, 1)


def _runs(keys: np.ndarray, values: np.ndarray) -> tuple[list[int], list[np.ndarray]]:
    """Different sorted keys, and the values of each."""
    kinds, first = np.unique(keys, return_index=True)
    return kinds.tolist(), np.split(values, first[1:])


class Quantizer:
    """Directions of cells, of parts of crowded ones, and codebooks of the residuals' parts."""

    def __init__(self, sample: np.ndarray, cells: int, rows: int, seed: int = 1):
        rng = np.random.default_rng(seed)
        routes = int(min(max(1, rows // LIST), max(ROUTES, 4 * cells), max(1, len(sample) // 6)))
        self.cells = Directions(sample, routes, cells, rng)
        cells = len(self.cells.centres)
        cell = self.cells.group[self.cells.nearest(sample, 1)[0][:, 0]]
        usual = max(HOT, CROWDED * rows / cells)
        self.inner: dict[int, Directions] = {}
        #: Units that vectors are brought together in, beginning at first[cell]; blocks of queries that each is spread over.
        self.first, blocks, res = np.zeros(cells, np.int64), [], []
        for c in range(cells):
            mine = sample[cell == c]
            self.first[c] = len(blocks)
            expected = len(mine) / len(sample) * rows
            blocks.append(1)
            if expected > usual:
                n = int(np.clip(-(-expected * cells // rows), 1, max(1, len(mine) // 6)))
                self.inner[c] = Directions(mine, n, 1, rng)
                at = self.inner[c].nearest(mine, 1)[0][:, 0]
                blocks[-1:] = np.clip(np.ceil(LISTS * np.bincount(at, minlength=n) / len(mine) * expected / usual), 1, 4096).astype(int).tolist()
            if len(mine):
                at = Directions(mine, max(1, len(mine) // 12), 1, rng).nearest(mine, 1)[0][:, 0]
                got, mean = _means(mine, at)
                res.append(mine - mean[np.searchsorted(got, at)])
        self.blocks = np.array(blocks)
        self.parts = min(PARTS, sample.shape[1])
        self.width = -(-sample.shape[1] // self.parts)
        parts = self._split(np.concatenate(res))
        self.books = np.stack([_kmeans(parts[:, m], CODES, 4, rng) for m in range(self.parts)])

    def _split(self, x: np.ndarray) -> np.ndarray:
        pad = self.parts * self.width - x.shape[1]
        return (np.pad(x, ((0, 0), (0, pad))) if pad else x).reshape(len(x), self.parts, self.width)

    def units(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, unit) for each unit that a vector is sent to."""
        top, v = self.cells.nearest(x, PROBES)
        cell = np.where(v[:, :1] - v <= SPREAD / np.sqrt(x.shape[1]), self.cells.group[top], -1)
        for k in range(1, cell.shape[1]):
            cell[(cell[:, :k] == cell[:, k : k + 1]).any(axis=1), k] = -1
        i, k = np.nonzero(cell >= 0)
        cell = cell[i, k]
        split = np.isin(cell, list(self.inner))
        out = [(i[~split], self.first[cell[~split]])]
        for c in np.unique(cell[split]).tolist():
            rows = i[cell == c]
            at = self.inner[c].nearest(x[rows], LISTS)[0]
            out.append((np.repeat(rows, at.shape[1]), self.first[c] + at.ravel()))
        return tuple(np.concatenate(z) for z in zip(*out))

    def encode(self, x: np.ndarray, m: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Codes of the residuals of x to m, with the scale and shift of estimates.

        With x = m + r and the decoded residual d, q . x = q . m + m . r + (q - m) . r, and
        (q - m) . r is estimated without bias by scale (q - m) . d, scale = r . r / r . d. So the estimate is
        q . m + scale (q . d) + shift. A residual that its code hardly resembles gets an estimate that always reranks.
        """
        r = x - m
        res, mid = self._split(r), self._split(m)
        codes = np.empty((len(x), self.parts), np.uint8)
        rd, md = np.zeros(len(x), np.float32), np.zeros(len(x), np.float32)
        for k in range(self.parts):
            b = self.books[k]
            codes[:, k] = (res[:, k] @ b.T - 0.5 * (b * b).sum(1)).argmax(1)
            d = b[codes[:, k]]
            rd += np.einsum("ij,ij->i", res[:, k], d)
            md += np.einsum("ij,ij->i", mid[:, k], d)
        rr = np.einsum("ij,ij->i", r, r)
        like = rd > 0.1 * rr
        scale = np.where(like, rr / np.maximum(rd, 1e-12), 0).astype(np.float32)
        return codes, scale, np.where(like | (rr < 1e-12), np.einsum("ij,ij->i", m, r) - scale * md, 3).astype(np.float32)

    def tables(self, q: np.ndarray) -> np.ndarray:
        """(parts, queries, CODES): dot products of the queries' parts with the codebooks."""
        return np.matmul(self._split(q).transpose(1, 0, 2), self.books.transpose(0, 2, 1))


def _index(quant: Quantizer, dim: int):
    """frame vectors -> rows of units."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        z = zstandard.ZstdCompressor(level=1)
        sent: set[tuple[int, int]] = set()
        for whole in batches:
            for part in range(0, whole.num_rows, 1000):
                b = whole.slice(part, 1000)
                rows, x = _matrix(b.column(2), dim)
                x, ok = _unit(x)
                ha, hb = b.column(0).to_numpy()[rows], b.column(1).to_numpy()[rows]
                for i, key in enumerate(zip(ha.tolist(), hb.tolist())):
                    if ok[i]:
                        if key in sent:
                            ok[i] = False
                        elif len(sent) < SENT:
                            sent.add(key)
                x, ha, hb = x[ok], ha[ok], hb[ok]
                if not len(x):
                    continue
                packed = _pack(x, z)
                i, unit = quant.units(x)
                n = quant.blocks[unit]
                rep = np.repeat(np.arange(len(i)), n)
                blk = np.arange(len(rep)) - np.repeat(np.cumsum(n) - n, n)
                i, unit, n = i[rep], unit[rep], n[rep]
                own = (hb[i].view(np.uint64) % n.astype(np.uint64)).astype(np.int64) == blk
                cols = [pa.array(unit * 4096 + blk), pa.array(ha[i]), pa.array(hb[i]), pa.array(own), pa.array([packed[a] for a in i.tolist()], pa.binary())]
                yield pa.RecordBatch.from_arrays(cols, names=["unit", "ha", "hb", "own", "vec"])

    return run


_UNIT_SCHEMA = "unit bigint, ha bigint, hb bigint, own boolean, vec binary"


def _search(quant: Quantizer, dim: int, k: int, least: float):
    """Rows sorted by unit -> (ha, hb, oa, ob, cos): candidates of the units' own rows."""

    def pairs(rows: pa.Table, z: zstandard.ZstdDecompressor) -> Iterator[pa.RecordBatch]:
        ha, hb = rows["ha"].to_numpy(), rows["hb"].to_numpy()
        keep = np.nonzero(np.r_[True, (ha[1:] != ha[:-1]) | (hb[1:] != hb[:-1])])[0]  # copies stand side by side
        if len(keep) < 2:
            return
        vec = rows["vec"].combine_chunks().take(pa.array(keep))
        ha, hb, own = ha[keep], hb[keep], rows["own"].to_numpy(zero_copy_only=False)[keep]
        del rows
        whole = _unpack(vec.to_pylist(), dim, z) if len(keep) <= WHOLE else None

        def of(at: np.ndarray) -> np.ndarray:
            return whole[at] if whole is not None else _unpack(vec.take(pa.array(at)).to_pylist(), dim, z)

        # The unit's lists, and every member's code in its list.
        rng = np.random.default_rng(len(keep))
        n = -(-len(keep) // LIST)
        lists = Directions(of(np.sort(rng.permutation(len(keep))[: 16 * n])), n, 1, rng)
        chunks = [np.arange(a, min(a + BLOCK, len(keep))) for a in range(0, len(keep), BLOCK)]
        place, centroids = np.empty(len(keep), np.int64), np.zeros((n, dim), np.float32)
        for at in chunks:
            x = of(at)
            place[at] = lists.nearest(x, 1)[0][:, 0]
            got, mean = _means(x, place[at])
            centroids[got] += mean * np.bincount(place[at], minlength=n)[got, None]
        centroids /= np.maximum(np.bincount(place, minlength=n), 1)[:, None]
        codes, (scale, shift) = np.empty((quant.parts, len(keep)), np.uint8), np.empty((2, len(keep)), np.float32)
        for at in chunks:
            c, scale[at], shift[at] = quant.encode(of(at), centroids[place[at]])
            codes[:, at] = c.T
        mine, by_list = np.nonzero(own)[0], np.argsort(place, kind="stable")
        mine = mine[np.argsort(place[mine], kind="stable")]
        starts = np.searchsorted(place[by_list], np.arange(n + 1))

        def still(got: list[tuple], best: np.ndarray) -> tuple[np.ndarray, ...]:
            i, j, cos = (np.concatenate(v) for v in zip(*got))
            ok = cos >= best.min(1)[i] - TIE
            return i[ok], j[ok], cos[ok]

        def block(q, qi, w, m, lut, middle, best) -> np.ndarray:
            """Exact cosines of queries w and members m, -1 for pairs that the estimates rule out."""
            c = codes[:, m]
            est = lut[0][w].take(c[0], axis=1)
            for p in range(1, quant.parts):
                est += lut[p][w].take(c[p], axis=1)
            est *= scale[m]
            est += shift[m]
            est += middle[w][:, None]
            self_ = qi[w][:, None] == m
            est[self_] = -1
            floor = np.maximum(least, best[w].min(1)) - SLACK
            if len(m) > k:
                floor = np.maximum(floor, np.minimum(-np.partition(-est, k - 1, axis=1)[:, k - 1], 1) - 2 * SLACK)
            near = est >= floor[:, None]
            if near.sum() > DENSE * near.size:
                exact = q[w] @ of(m).T
                exact[self_] = -1
                return exact
            exact = np.full(est.shape, -1.0, np.float32)
            i, j = np.nonzero(near)
            for x in range(0, len(i), 2048):
                s = slice(x, x + 2048)
                exact[i[s], j[s]] = np.einsum("ij,ij->i", q[w[i[s]]], of(m[j[s]]), dtype=np.float64)
            return exact

        for a in range(0, len(mine), BLOCK):
            qi = mine[a : a + BLOCK]
            q = of(qi)
            lut = quant.tables(q)
            middles = q @ centroids.T
            # The queries of each list that is looked into.
            to = lists.nearest(q, LISTS)[0]
            asks = np.argsort(to, axis=None, kind="stable")
            work = [(no, w // to.shape[1]) for no, w in zip(*_runs(to.ravel()[asks], asks))]
            got: list[tuple] = []
            held = 0
            best = np.full((len(qi), k), -1.0, np.float32)  # exact, of the members so far
            for no, who in work:
                members = by_list[starts[no] : starts[no + 1]]
                for x in range(0, len(who), 512):
                    w = who[x : x + 512]
                    for b in range(0, len(members), 2048):
                        m = members[b : b + 2048]
                        cos = block(q, qi, w, m, lut, middles[:, no], best)
                        best[w] = -np.partition(-np.concatenate([best[w], cos], axis=1), k - 1, axis=1)[:, :k]
                        i, j = np.nonzero(cos >= np.maximum(least, best[w].min(1) - TIE)[:, None])
                        got.append((w[i], m[j], cos[i, j]))
                        held += len(i)
                if held > 500_000:  # what has fallen behind since goes
                    got = [still(got, best)]
                    held = len(got[0][0])
            if not got:
                continue
            i, j, cos = still(got, best)
            i, cos = qi[i], cos.astype(np.float64)
            if len(i):
                cols = [pa.array(v) for v in (ha[i], hb[i], ha[j], hb[j], cos)]
                yield pa.RecordBatch.from_arrays(cols, names=["ha", "hb", "oa", "ob", "cos"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        rest: list[pa.RecordBatch] = []
        for b in batches:
            if not b.num_rows:
                continue
            lists = b.column(0).to_numpy()
            cut = np.r_[0, np.nonzero(lists[1:] != lists[:-1])[0] + 1, len(lists)]
            for x, y in zip(cut[:-1].tolist(), cut[1:].tolist()):
                if rest and rest[-1].column(0)[0].as_py() != int(lists[x]):
                    yield from pairs(pa.Table.from_batches(rest), unpack)
                    rest = []
                rest.append(b.slice(x, y - x))
        if rest:
            yield from pairs(pa.Table.from_batches(rest), unpack)

    return run


def _hashed(df: DataFrame, key: str, vector: str, dim: int) -> DataFrame:
    t = df.select(F.col(key).alias("id"), F.col(vector).alias("v")).where(F.col("id").isNotNull() & (F.size("v") == dim))
    return t.select("id", F.xxhash64("v").alias("ha"), F.xxhash64(F.lit(17), "v").alias("hb"), "v")


def _fit(df: DataFrame, vector: str, dim: int, rows: int) -> Quantizer | None:
    """Fitted in one task, from a bounded sample; the driver gets the model only."""
    t = df.select(F.col(vector).alias("v")).where(F.size("v") == dim)
    cells = max(1, round((rows / LIST) ** 0.5))
    most = min(MOST_TRAIN, max(TRAIN, 6 * 4 * cells))
    if rows > most:
        t = t.sample(False, min(1.0, 1.05 * most / rows), 5)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [_unit(_matrix(b.column(0), dim)[1]) for b in batches]
        x = np.concatenate([v[ok] for v, ok in parts]) if parts else np.zeros((0, dim), np.float32)
        del parts
        if len(x):
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(Quantizer(x, cells, rows))], pa.binary())], names=["model"])

    got = t.limit(most).coalesce(1).mapInArrow(run, "model binary").collect()
    return pickle.loads(got[0][0]) if got else None


def near_classes(df: DataFrame, key: str, vector: str, dim: int, k: int, least: float) -> tuple[DataFrame, DataFrame]:
    """(classes, near): id, ha, hb of the usable rows, copies under one (ha, hb); and the near classes of each class.

    near: ha, hb, oa, ob, cos; a class itself is not among them. Copies count in the k.
    """
    spark = df.sparkSession
    rows = df.count()
    quant = _fit(df, vector, dim, rows)
    t = _hashed(df, key, vector, dim)
    kind = dict(t.dtypes)["id"]
    if quant is None:
        return spark.createDataFrame([], f"id {kind}, ha bigint, hb bigint"), spark.createDataFrame([], "ha bigint, hb bigint, oa bigint, ob bigint, cos double")
    lists = t.select("ha", "hb", "v").mapInArrow(_index(quant, dim), _UNIT_SCHEMA)
    lists = lists.repartition("unit").sortWithinPartitions("unit", "ha", "hb")
    near = lists.mapInArrow(_search(quant, dim, k, least), "ha bigint, hb bigint, oa bigint, ob bigint, cos double")
    good = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    some = F.exists("v", lambda x: x != 0)
    classes = t.where(~good & some).select("id", "ha", "hb").distinct()
    return classes, near


def near_pairs(df: DataFrame, key: str, vector: str, dim: int = 1152, k: int = 5, least: float = 0.8) -> DataFrame:
    """a, b, cos (smaller key first): pairs where one is among the k most similar of the other, ties within TIE."""
    classes, near = near_classes(df, key, vector, dim, k, least)
    sizes = classes.groupBy("ha", "hb").agg(F.count("*").alias("n"), F.min("id").alias("least"))
    own = sizes.select(F.col("ha").alias("sa"), F.col("hb").alias("sb"), "n")
    near = near.join(own.select(F.col("sa").alias("oa"), F.col("sb").alias("ob"), F.col("n").alias("times")), ["oa", "ob"])
    near = near.repartition("ha", "hb").groupBy("ha", "hb", "oa", "ob").agg(F.max("cos").alias("cos"), F.max("times").alias("times"))
    near = near.join(sizes.select("ha", "hb", (F.col("n") - 1).alias("copies")), ["ha", "hb"])
    w = Window.partitionBy("ha", "hb").orderBy(F.desc("cos"), "oa", "ob")
    # Others that are more similar, or listed before: the k-th best is the first at which the count reaches k.
    near = near.withColumn("upto", F.sum("times").over(w) + F.col("copies"))
    kth = F.max(F.when(F.col("upto") >= k, F.col("cos"))).over(Window.partitionBy("ha", "hb"))
    near = near.withColumn("kth", F.when(F.col("copies") >= k, F.lit(1.0)).otherwise(kth))
    near = near.where(F.col("kth").isNull() | (F.col("cos") >= F.col("kth") - TIE))
    # One row a pair of classes, then the members of both.
    first = F.struct("ha", "hb") < F.struct("oa", "ob")
    pick = lambda x, y: F.when(first, F.col(x)).otherwise(F.col(y))
    near = near.select(pick("ha", "oa").alias("pa"), pick("hb", "ob").alias("pb"), pick("oa", "ha").alias("qa"), pick("ob", "hb").alias("qb"), "cos")
    near = near.groupBy("pa", "pb", "qa", "qb").agg(F.max("cos").alias("cos"))
    m = classes.join(sizes, ["ha", "hb"]).withColumn("id", F.col("id"))
    speak = m.where((F.col("n") <= MANY_COPIES) | (F.col("id") == F.col("least")))
    p = near.join(speak.select(F.col("ha").alias("pa"), F.col("hb").alias("pb"), F.col("id").alias("x")), ["pa", "pb"])
    p = p.join(speak.select(F.col("ha").alias("qa"), F.col("hb").alias("qb"), F.col("id").alias("y")), ["qa", "qb"]).select("x", "y", "cos")
    several = m.where("n > 1")
    small = several.where(F.col("n") <= MANY_COPIES).select("ha", "hb", "id")
    twins = small.select("ha", "hb", F.col("id").alias("x")).join(small.select("ha", "hb", F.col("id").alias("y")), ["ha", "hb"]).where("x < y")
    stars = several.where((F.col("n") > MANY_COPIES) & (F.col("id") != F.col("least"))).select(F.col("least").alias("x"), F.col("id").alias("y"))
    p = p.unionByName(twins.select("x", "y").unionByName(stars).withColumn("cos", F.lit(1.0)))
    return p.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"), "cos")
