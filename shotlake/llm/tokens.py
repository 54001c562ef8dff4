"""Problem 7: token ids of every text of a corpus by a public byte-level BPE.

Content-defined chunk reuse. Texts are cut where a rolling hash of the last ``WINDOW`` bytes says so, at any
character, into chunks of about ``CHUNK`` bytes, so equal passages of different documents are cut alike. Equal chunks
are encoded once in a task (a bounded cache spans its batches), and a document's ids are gathered from its chunks' ids.

Joins. A chunk's ids near its ends aren't those of the whole text. The tokenizer's pre-tokens never hold white
space after another character, so at a blank that follows something else (a proven place) both sides' ids are
as in the whole text. The stretch from a chunk's last proven place to the next one's first is encoded anew in one piece, and
its ids take the place of both chunks' there; where a chunk has no proven place, the stretch goes on
over it, chunk by chunk, until both its ends are proven, which makes the ids agree with those of the whole text. A cut
that is itself a proven place needs no repair. Results
therefore equal the tokenizer's own for the whole text, at any cut.

A new chunk, and a stretch between chunks, is itself put together from the pieces between its proven places;
they are mostly words, and each different one is given to the tokenizer once in a task.

The operator is one narrow pass: no shuffle, nothing broadcast but the vocabulary file's path.
Null and empty texts give an empty list; texts are taken as stored; the strings of special tokens
are ordinary text. Every row of the input gives one row.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOKENIZERS = "/opt/tokenizers"
WINDOW = 16
#: Bytes of a chunk, on average, a power of two.
CHUNK = 512
#: Bytes of chunks, pieces and ids that a task's cache may hold.
CACHE_BYTES = 128 << 20

_loaded: dict[str, object] = {}


def _tokenizer(path: str):
    if path not in _loaded:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        t = Tokenizer.from_file(path)
        t.encode_special_tokens = True
        _loaded[path] = t
    return _loaded[path]


def proven(data: np.ndarray) -> np.ndarray:
    """Is each place of ``data`` (UTF-8) proven: before a blank, tab or line end (ASCII) that follows a byte that
    isn't one of them and isn't the last byte of another white-space character? The first place isn't."""
    n = len(data)
    space = np.zeros(256, bool)
    space[[9, 10, 11, 12, 13, 32]] = True
    blank = space[data]
    ok = np.zeros(n, bool)
    # Only characters that begin with these bytes hold white space other than ASCII's.
    odd = (data == 0xC2) | (data == 0xE1) | (data == 0xE2) | (data == 0xE3)
    safe = ~blank
    if n > 2:
        safe[1:] &= ~odd[:-1]
        safe[2:] &= ~odd[:-2]
        safe &= (data < 0x1C) | (data > 0x1F)
        # Vietnamese letters begin with E1 BA and E1 BB; no white space does.
        letter = (data[:-2] == 0xE1) & ((data[1:-1] == 0xBA) | (data[1:-1] == 0xBB))
        safe[2:] |= letter
    ok[1:] = blank[1:] & safe[:-1]
    return ok


def cuts(data: np.ndarray) -> np.ndarray:
    """Places of ``data`` (UTF-8) before which the rolling hash cuts: any that a character begins at."""
    if len(data) <= WINDOW:
        return np.zeros(0, np.int64)
    h, n, power = data.astype(np.uint64), 1, 0x100000001B3
    while n < WINDOW:  # of n bytes from each place on, then of 2 n
        h = h[:-n] * np.uint64(power) + h[n:]
        n, power = n * 2, power * power % (1 << 64)
    h ^= h >> np.uint64(29)
    chosen = h[:-1] * np.uint64(0x9E3779B97F4A7C15) < np.uint64((1 << 64) // CHUNK)
    at = np.nonzero(chosen)[0] + WINDOW
    return at[data[at] & 0xC0 != 0x80]


def _ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions starts[i], ..., starts[i] + lengths[i] - 1 for each i."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - lengths), lengths)


class _Pool:
    """Ids of byte strings, one after the other; what was once put in is found by its bytes."""

    def __init__(self):
        self.keys: dict[bytes, int] = {}
        self.flat, self.used, self.size = np.zeros(1 << 16, np.int32), 0, 0
        self.at: list[int] = []
        self.len: list[int] = []

    def put(self, key: bytes, ids) -> None:
        while self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros(len(self.flat), np.int32)])
        self.flat[self.used : self.used + len(ids)] = ids
        self.keys[key] = len(self.at)
        self.at.append(self.used)
        self.len.append(len(ids))
        self.used += len(ids)
        self.size += len(key) + 4 * len(ids) + 150


def _spans(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.DictionaryArray:
    """The stretches of data that lie one after the other without holes, or not, coded by their bytes."""
    if len(start) and not (start[1:] == end[:-1]).all():
        size = end - start
        data = data[_ragged(start, size)]
        bounds = np.r_[0, np.cumsum(size)]
    else:
        bounds = np.r_[start, end[-1:]] if len(start) else np.zeros(1)
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))]).dictionary_encode()


class Encoder:
    """Encodes batches; keeps the ids of the chunks and pieces seen, up to ``CACHE_BYTES``."""

    def __init__(self, path: str):
        self.path = path
        self.pieces, self.chunks = _Pool(), _Pool()
        #: Of each chunk: bytes and ids before its first and last proven place, -1 without one.
        self.marks: list[tuple[int, int, int, int]] = []
        #: Chunks met, chunks encoded, joins repaired.
        self.met = self.coded = self.repaired = 0

    def _pieced(self, data: np.ndarray, ok: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets of stretch i) of stretches, each put together from the pieces between its proven places."""
        inner = np.nonzero(ok)[0]
        lo, hi = np.searchsorted(inner, start, side="right"), np.searchsorted(inner, end)
        n = hi - lo + 1
        a = np.empty(int(n.sum()), np.int64)
        heads = np.cumsum(n) - n
        rest = np.ones(len(a), bool)
        rest[heads] = False
        a[heads], a[rest] = start, inner[_ragged(lo, hi - lo)]
        b = np.empty(len(a), np.int64)
        b[:-1] = a[1:]
        b[heads + n - 1] = end
        coded = _spans(data, a, b)
        uniq = coded.dictionary.to_pylist()
        new = [p for p in uniq if p not in self.pieces.keys]
        for p, e in zip(new, _tokenizer(self.path).encode_batch_fast([p.decode() for p in new], add_special_tokens=False)):
            self.pieces.put(p, e.ids)
        slot = np.fromiter((self.pieces.keys[p] for p in uniq), np.int64, len(uniq))[coded.indices.to_numpy()]
        at, ln = np.array(self.pieces.at, np.int64)[slot], np.array(self.pieces.len, np.int64)[slot]
        ids = self.pieces.flat[_ragged(at, ln)]
        return ids, np.r_[0, np.cumsum(ln)][np.r_[heads, len(a)]], a, np.r_[0, np.cumsum(ln)]

    def _chunked(self, data: np.ndarray, ok: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Numbers of the chunks in the pool; new ones are encoded."""
        coded = _spans(data, start, end)
        uniq = coded.dictionary.to_pylist()
        idx = coded.indices.to_numpy()
        new = np.array([k for k, c in enumerate(uniq) if c not in self.chunks.keys], np.int64)
        if len(new):
            first = np.full(len(uniq), -1)
            first[idx[::-1]] = np.arange(len(idx))[::-1]
            some = np.sort(first[new])
            s, e = start[some], end[some]
            ids, off, piece, upto = self._pieced(data, ok, s, e)
            head = np.searchsorted(piece, s)
            tail = np.r_[head[1:], len(piece)] - 1
            for k, i in enumerate(some.tolist()):
                self.chunks.put(uniq[idx[i]], ids[off[k] : off[k + 1]])
                a, z = head[k] + 1, tail[k]
                self.marks.append((int(piece[a] - s[k]), int(upto[a] - off[k]), int(piece[z] - s[k]), int(upto[z] - off[k])) if z >= a else (-1, 0, -1, 0))
            self.coded += len(some)
        self.met += len(idx)
        return np.fromiter((self.chunks.keys[c] for c in uniq), np.int64, len(uniq))[idx]

    def encode(self, texts: pa.Array) -> pa.Array:
        if self.pieces.size + self.chunks.size > CACHE_BYTES:
            self.__init__(self.path)
        texts = pc.fill_null(texts, "").cast(pa.large_binary())
        off = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[: off[-1]]
        if off[-1] == off[0]:
            return pa.array([[]] * len(texts), pa.list_(pa.int32()))
        data, off = data[off[0] :], off - off[0]
        texts_at = np.unique(off[:-1][off[:-1] < off[1:]])
        ok = proven(data)
        ok[texts_at] = True  # where a text begins, both sides are its own
        start = np.unique(np.concatenate([texts_at, cuts(data)]))
        end = np.r_[start[1:], len(data)]
        no = self._chunked(data, ok & ~np.isin(np.arange(len(data)), texts_at), start, end)
        marks = np.array(self.marks, np.int64).reshape(-1, 4)[no]
        at, ln = np.array(self.chunks.at, np.int64)[no], np.array(self.chunks.len, np.int64)[no]
        # Of each chunk what stays: from its first proven place (its start, where that is one) to its last (its end).
        sound_from, sound_to = ok[start], np.r_[ok[start[1:]], True]
        none = marks[:, 0] < 0
        head = np.where(sound_from, 0, marks[:, 1])
        tail = np.where(sound_to, ln, marks[:, 3])
        left = np.where(sound_from, start, start + marks[:, 0])
        right = np.where(sound_to, end, start + marks[:, 2])
        # A chunk without a proven place, and not sound at both ends, gives nothing from its unsound end on.
        lost = none & ~(sound_from & sound_to)
        right, tail = np.where(lost, np.where(sound_from, start, end), right), np.where(lost, 0, tail)
        left, head = np.where(lost, right, left), np.where(lost, 0, head)
        # Stretches to be encoded anew: from where a chunk stops being sound to where a later one is sound again.
        kept = ~lost | sound_from | sound_to
        k = np.nonzero(kept)[0]
        a, b = right[k][:-1], left[k][1:]
        gap = np.nonzero(b > a)[0]
        self.repaired += len(gap)
        ids, cut_at, _, _ = self._pieced(data, ok, a[gap], b[gap]) if len(gap) else (np.zeros(0, np.int32), np.zeros(1, np.int64), None, None)
        # Chunk, stretch, chunk, ...
        pool = np.concatenate([self.chunks.flat[: self.chunks.used], ids])
        where = np.zeros((len(k), 2), np.int64)
        size = np.zeros((len(k), 2), np.int64)
        where[:, 0], size[:, 0] = at[k] + head[k], tail[k] - head[k]
        where[gap, 1], size[gap, 1] = self.chunks.used + cut_at[:-1], np.diff(cut_at)
        out = pool[_ragged(where.ravel(), size.ravel())]
        total = np.r_[0, np.cumsum(size.ravel())]
        # A text begins with a sound chunk.
        ends = total[2 * np.searchsorted(k, np.searchsorted(start, off))]
        return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(out))


def token_ids(df: DataFrame, key: str, text: str, vocabulary: str = f"{TOKENIZERS}/byte_bpe_50k.json", out: str = "ids") -> DataFrame:
    """key, ids (array of int): the ids of every row's text, in the tokenizer's order, without special tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = Encoder(vocabulary)
        for b in batches:
            for i in range(0, b.num_rows, 1000):  # so many texts at a time bound the memory
                part = b.slice(i, 1000)
                yield pa.RecordBatch.from_arrays([part.column(0), enc.encode(part.column(1))], names=[key, out])

    t = df.select(F.col(key), F.col(text).cast("string").alias("__text"))
    return t.mapInArrow(run, f"`{key}` {dict(df.dtypes)[key]}, `{out}` array<int>")
