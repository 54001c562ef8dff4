"""Problem 8: evaluation items whose passages stand in training documents.

Words are the longest runs of letters and digits of a text's consistent form, case-folded, accents
and marks dropped, đ taken as d. An item leaks into a document that holds ``n_words`` consecutive
words of it, or all its words in a row if it has fewer.

A leak at distance d holds a stretch that d edits of words (put in, left out, replaced) turn into such a window;
d is at most ``edits``, and a fifth of the window's words, so that four fifths are alike.

Every item-sized window of words, and in documents those of up to ``edits`` words less or more, is embedded by the CGK random walk:
at step j the current word is written and a random bit of (j, word) says whether to step on, which maps
edit distance between windows to Hamming distance between their embeddings. Each repetition has its own walk
and samples some positions of the embedding; windows that agree there are candidates, and an exact
edit distance over words decides. At distance 0 every repetition finds every window; the others' recall was measured
(tests/llm/test_leaks.py).

The items are the stated query set. Their index is built for blocks of ``BLOCK_CHARS`` code points, broadcast, and every
block is held against the whole corpus in one narrow pass: no shuffle but that of the few hits. Of several blocks
each one's hits are written before the next is read, so the driver holds one. A window
with more than ``edits`` words, or more than twice as many pairs of neighbouring words, that no item
has can't be within that distance and is not embedded.

Null or empty texts and items, and items without words, give no row. Repeated rows of a document or
item count once. Columns other than the named ones are ignored.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from shotlake.llm.canon import STABLE, canonical
from shotlake.plans.lineage import cut

#: Code points of item text in one block of the query set.
BLOCK_CHARS = 20_000_000
#: Code points of documents that are worked on at a time in a task.
CHUNK = 1_000_000
REPETITIONS, SAMPLED = 12, 4

_SEP, _DROP, _MULTI, _UNSTABLE, _UNKNOWN = 0, -1, -2, -3, -9
_lut = np.full(0x110000, _UNKNOWN, np.int32)


def _fold_char(c: str) -> int:
    if not any(a <= ord(c) <= b for a, b in STABLE):
        return _UNSTABLE
    return _plain(c)


def _plain(c: str) -> int:
    f = [x for x in unicodedata.normalize("NFD", c.casefold()) if unicodedata.category(x)[0] != "M"]
    if not f:
        return _DROP
    if len(f) > 1:
        return _MULTI
    x = "d" if f[0] == "đ" else f[0]
    return ord(x) if unicodedata.category(x)[0] == "L" or unicodedata.category(x) == "Nd" else _SEP




def _codes(joined: str, lut: np.ndarray, rule) -> np.ndarray:
    cp = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    codes = lut[cp]
    if (codes == _UNKNOWN).any():
        for o in np.unique(cp[codes == _UNKNOWN]).tolist():
            lut[o] = rule(chr(o))
        codes = lut[cp]
    return codes


_lut_plain = np.full(0x110000, _UNKNOWN, np.int32)


def _expand(t: str) -> str:
    """Characters that fold to several, spelled out."""
    return "".join("".join(x for x in unicodedata.normalize("NFD", c.casefold())) if _plain(c) == _MULTI else c for c in t)


def words(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text number) of every word of the texts, in order."""
    codes = _codes("\n".join(texts), _lut, _fold_char)
    off = np.cumsum([0, *(len(t) + 1 for t in texts)])
    if (codes == _UNSTABLE).any():
        texts = list(texts)
        for i in np.unique(np.searchsorted(off, np.nonzero(codes == _UNSTABLE)[0], side="right") - 1).tolist():
            texts[i] = canonical(texts[i])
        codes = _codes("\n".join(texts), _lut_plain, _plain)
        off = np.cumsum([0, *(len(t) + 1 for t in texts)])
    if (codes == _MULTI).any():
        texts = list(texts)
        for i in np.unique(np.searchsorted(off, np.nonzero(codes == _MULTI)[0], side="right") - 1).tolist():
            texts[i] = _expand(texts[i])
        codes = _codes("\n".join(texts), _lut_plain, _plain)
        off = np.cumsum([0, *(len(t) + 1 for t in texts)])
    if (codes == _DROP).any():
        keep = codes != _DROP
        off = np.r_[0, np.cumsum(keep)][np.minimum(off, len(codes))]
        codes = codes[keep]
    letter = codes > 0
    at = np.nonzero(letter & ~np.r_[False, letter[:-1]])[0]
    if not len(at):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    c = codes[letter].astype(np.uint64)
    first = np.r_[0, np.cumsum(letter)][at]
    size = np.diff(np.r_[first, len(c)])
    pos = np.arange(len(c)) - np.repeat(first, size)
    powers = np.cumprod(np.full(int(size.max()), 0x9E3779B97F4A7C15, np.uint64))
    c *= np.uint64(0xD6E8FEB86659FD93)
    c ^= c >> np.uint64(31)
    h = np.add.reduceat(c * powers[pos], first)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    return h, np.searchsorted(off, at, side="right") - 1


def embed(win: np.ndarray, repetition: int, size: int | None = None) -> np.ndarray:
    """LSH keys of windows (n, w) of word hashes: the CGK walk for windows of about ``size`` (w) words, sampled at some positions."""
    size = size or win.shape[1]
    n, w = win.shape
    rng = np.random.default_rng([811, repetition])
    odd = rng.integers(0, 1 << 63, 3 * size, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    # Beyond 2 size steps most walks are at the end.
    sample = set(rng.choice(2 * size, min(SAMPLED, 2 * size), replace=False).tolist())
    padded = np.concatenate([win, np.zeros((n, 1), np.uint64)], axis=1)
    i, rows, key = np.zeros(n, np.int64), np.arange(n), np.full(n, repetition, np.uint64)
    for j in range(max(sample) + 1):
        x = padded[rows, i]
        if j in sample:
            key = (key ^ x) * np.uint64(0x100000001B3)
            key ^= key >> np.uint64(33)
        i = np.minimum(i + (x * odd[j] >> np.uint64(63)).astype(np.int64), w)
    return key


def edit_distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row-wise edit distance of (n, v) and (n, w) word hashes."""
    n, v, w = len(a), a.shape[1], b.shape[1]
    prev = np.tile(np.arange(w + 1), (n, 1))
    for i in range(v):
        cur = np.empty_like(prev)
        cur[:, 0] = i + 1
        for j in range(w):
            cur[:, j + 1] = np.minimum(np.minimum(prev[:, j + 1], cur[:, j]) + 1, prev[:, j] + (a[:, i] != b[:, j]))
        prev = cur
    return prev[:, w]


def _pairs(h: np.ndarray) -> np.ndarray:
    return (h[:-1] * np.uint64(0x9E3779B97F4A7C15) ^ h[1:]) * np.uint64(0xD6E8FEB86659FD93)


class _Set:
    """Membership of 64-bit hashes, by a bit table and then exactly."""

    def __init__(self, h: np.ndarray):
        self.all, self.bits = np.unique(h), np.zeros(1 << 18, bool)
        self.bits[(self.all >> np.uint64(46)).astype(np.int64)] = True

    def has(self, h: np.ndarray) -> np.ndarray:
        known = self.bits[(h >> np.uint64(46)).astype(np.int64)]
        some = np.nonzero(known)[0]
        if len(some):
            known[some] = self.all[np.minimum(np.searchsorted(self.all, h[some]), len(self.all) - 1)] == h[some]
        return known


class ItemIndex:
    """LSH tables of the windows of a block of items, by window size."""

    def __init__(self, ids: list, texts: list[str], n_words: int, edits: int):
        self.edits, self.tables = edits, []
        h, owner = words(texts)
        self.ids = ids
        self.words, self.pairs = _Set(h), _Set(_pairs(h)[owner[1:] == owner[:-1]])
        count = np.bincount(owner, minlength=len(ids))
        first = np.r_[0, np.cumsum(count)]
        for w in sorted({min(n_words, c) for c in count.tolist() if c}):
            starts = [np.arange(first[k], first[k + 1] - w + 1) for k in range(len(ids)) if min(n_words, count[k]) == w]
            at = np.concatenate(starts)
            win = h[at[:, None] + np.arange(w)]
            most = min(edits, w // 5)
            reps = []
            for r in range(REPETITIONS if most else 1):
                key = embed(win, r, w)
                order = np.argsort(key, kind="stable")
                reps.append((key[order], order))
            self.tables.append((w, most, win, owner[at], reps))

    def search(self, h: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text number, item number, distance) of the windows near an item's."""
        if not len(h):
            return (np.zeros(0, np.int64),) * 3
        total = np.r_[0, np.cumsum(self.words.has(h))]
        pairs = np.r_[0, np.cumsum(self.pairs.has(_pairs(h)))]
        out: list[tuple] = []
        for w, most, items, owner, reps in self.tables:
            for size in range(w - most, w + most + 1):
                if len(h) < size:
                    continue
                n = len(h) - size + 1
                ok = (total[size:] - total[:n] >= size - most) & (pairs[size - 1 :] - pairs[:n] >= size - 1 - 2 * most)
                at = np.nonzero(ok & (doc[size - 1 :] == doc[:n]))[0]
                for a in range(0, len(at), 50_000):
                    part = at[a : a + 50_000]
                    win = h[part[:, None] + np.arange(size)]
                    for r, (keys, order) in enumerate(reps):
                        key = embed(win, r, w)
                        lo, hi = np.searchsorted(keys, key), np.searchsorted(keys, key, side="right")
                        hit = np.nonzero(hi > lo)[0]
                        for b in range(0, len(hit), 5000):
                            some = hit[b : b + 5000]
                            count = (hi - lo)[some]
                            ends = np.cumsum(count)
                            k = order[np.arange(ends[-1]) + np.repeat(lo[some] - (ends - count), count)]
                            p = np.repeat(some, count)
                            d = (win[p] != items[k]).any(axis=1).astype(np.int64) if size == w else np.ones(len(p), np.int64)
                            if most and d.any():
                                d[d > 0] = edit_distance(win[p[d > 0]], items[k[d > 0]])
                            ok = d <= most
                            if ok.any():
                                out.append(np.unique(np.stack([doc[part[p[ok]]], owner[k[ok]], d[ok]]), axis=1))
        if not out:
            return (np.zeros(0, np.int64),) * 3
        return tuple(np.unique(np.concatenate(out, axis=1), axis=1))


def leaks(docs: DataFrame, doc_key: str, doc_text: str, items: DataFrame, item_key: str, item_text: str, n_words: int = 10, edits: int = 1) -> DataFrame:
    """doc_id, item_id, distance: documents with a window of an item; distance is the least one, in words."""
    named = items.select(F.col(item_key).alias("id"), F.col(item_text).alias("t")).where("t is not null and id is not null")
    chars = named.agg(F.sum(F.length("t"))).first()[0] or 0
    n_blocks = int(chars // BLOCK_CHARS) + 1
    d_type, i_type = dict(docs.dtypes)[doc_key], dict(items.dtypes)[item_key]
    texts = docs.select(F.col(doc_key).alias("doc_id"), F.col(doc_text).alias("t")).where("t is not null and t <> ''")
    found = None
    for block in range(n_blocks):
        mine = named.where(F.pmod(F.xxhash64("id"), F.lit(n_blocks)) == block) if n_blocks > 1 else named
        rows = mine.distinct().collect()
        index = docs.sparkSession.sparkContext.broadcast(ItemIndex([r[0] for r in rows], [r[1] for r in rows], n_words, edits))
        hits = texts.mapInArrow(_search(index, to_arrow_type(items.schema[item_key].dataType)), f"doc_id {d_type}, item_id {i_type}, distance int")
        if n_blocks > 1:
            hits = cut(hits)
            index.destroy()
        found = hits if found is None else found.unionByName(hits)
    return found.groupBy("doc_id", "item_id").agg(F.min("distance").alias("distance"))


def _search(shared, id_type: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for b in batches:
            keys, texts = b.column(0), b.column(1).to_pylist()
            size = np.cumsum([len(t) for t in texts])
            start = 0
            while start < len(texts):
                done = size[start - 1] if start else 0
                end = max(start + 1, int(np.searchsorted(size, done + CHUNK)))
                doc, item, d = index.search(*words(texts[start:end]))
                if len(doc):
                    ids = pa.array([index.ids[i] for i in item.tolist()], id_type)
                    yield pa.RecordBatch.from_arrays([keys.take(pa.array(doc + start)), ids, pa.array(d.astype(np.int32))], names=["doc_id", "item_id", "distance"])
                start = end

    return run
