"""Problem 9: long exact stretches that documents share.

Two documents are a pair if their texts, as stored, have a stretch of at least ``length`` code points
in common.

1. One pass over the texts. Every window of ``length`` code points is owned by the least of the
   hashed ``GRAM``-grams in it (an anchor); equal windows have equal owners at the same offset. An
   anchor, with the run of windows that it owns, is one row: about one for 29 code points.
2. Anchors are brought together by hash. Those of one document only are dropped: no window that they
   own can be shared. This loses nothing; it decides what is indexed, not what is found.
3. The windows of each remaining anchor, a snippet of at most ``2 * length - GRAM`` code points and the
   one before, are cut out of the texts. Where all snippets of an anchor are equal, the window one to
   the left is shared too, so the anchor before it finds the same documents: only snippets of anchors
   with different ones, or at the start of a text, stay. Equal snippets are held once, and in the index
   twice if several documents have them, so that each shares its windows with another.
4. Per shard of anchors a compressed FM-index of the snippets is built, and the documents' snippets are streamed through
   it by backward search in lockstep. From the anchor leftwards, the matching statistics drop where a
   partner is lost; windows beginning there decide, and the suffix intervals of those of the full
   length give the partners. All rows come from these intervals, those of equal snippets too.

A shard holds a bounded number of code points; an anchor with more snippets than that is worked on in
pairs of blocks, so a hot anchor is spread over tasks. A snippet's documents meet in blocks of about ``HOLDERS``, and pairs
of blocks are spread before they are written out as pairs of documents. Texts that are exact copies of more than
``MANY_COPIES`` documents are represented by the least document, with one link from it to each copy.
Null texts and texts shorter than ``length`` give no row, a document isn't its own partner, and a
document delivered twice counts once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shotlake.llm.fm import FMIndex, code_points
from shotlake.operators.dyadic import periods
from shotlake.plans.lineage import cut, release

GRAM = 48
#: Code points of text that are hashed at a time, and of snippets in one index.
CHUNK, SHARD = 1_000_000, 300_000
#: Snippets of one anchor in one block.
BLOCK = 2000
#: Documents of one snippet in one block.
HOLDERS = 1000
MANY_COPIES = 1000

_MIX = np.uint64(0xD6E8FEB86659FD93)


def _slide(a: np.ndarray, w: int, op) -> np.ndarray:
    """op over every w neighbours."""
    r, n = a, 1
    while n * 2 <= w:
        r, n = op(r[:-n], r[n:]), n * 2
    m = len(a) - w + 1
    return op(r[:m], r[w - n : w - n + m])


def _gram_hash(cp: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k code points from each place on."""
    h = (cp.astype(np.uint64) + np.uint64(1)) * _MIX
    h ^= h >> np.uint64(32)
    power, size, out, have = 0x9E3779B97F4A7C15, 1, None, 0
    while True:
        if k & size:
            m = len(cp) - have - size + 1
            out = h[:m] if out is None else out[:m] * np.uint64(power) + h[have : have + m]
            have += size
        if size * 2 > k:
            break
        h = h[:-size] * np.uint64(power) + h[size:]
        power, size = power * power % (1 << 64), size * 2
    out = out ^ (out >> np.uint64(31))
    out *= _MIX
    return out ^ (out >> np.uint64(29))


def anchors(cp: np.ndarray, text: np.ndarray, first: np.ndarray, length: int, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """(hash, text number, first window, windows, anchor) of the texts laid end to end in ``cp``.

    text: the number of the text at each place; first: where each text begins.
    Of equal hashes in a window the leftmost is its owner.
    """
    if len(cp) < length:
        return (np.zeros(0, np.int64),) * 5
    h = _gram_hash(cp, gram)
    w = length - gram + 1
    m = len(cp) - length + 1
    least = _slide(h, w, np.minimum)[:m]
    whole = text[:m] == text[length - 1 : length - 1 + m]
    # The owner of a window: the next place, from its start on, where the hash is the least.
    start = np.nonzero(whole)[0]
    if not len(start):
        return (np.zeros(0, np.int64),) * 5
    # Where the least hash changes from one window to the next, or its owner goes out, a new run begins.
    val = least[start]
    brk = np.r_[True, (val[1:] != val[:-1]) | (start[1:] != start[:-1] + 1)]
    run = np.nonzero(brk)[0]
    out_s, out_n, out_p = [], [], []
    s0, v = start[run], val[run]
    n0 = np.diff(np.r_[run, len(start)])
    while len(s0):  # mostly once; again where equal hashes follow one another
        p = np.full(len(s0), -1)
        todo = np.arange(len(s0))
        for k in range(w):
            hit = h[s0[todo] + k] == v[todo]
            p[todo[hit]] = s0[todo[hit]] + k
            todo = todo[~hit]
            if not len(todo):
                break
        n = np.minimum(n0, p - s0 + 1)
        out_s.append(s0)
        out_n.append(n)
        out_p.append(p)
        more = n < n0
        s0, n0, v = (s0 + n)[more], (n0 - n)[more], v[more]
    s, n, p = np.concatenate(out_s), np.concatenate(out_n), np.concatenate(out_p)
    t = text[s]
    return h[p].view(np.int64), t, s - first[t], n, p - first[t]


def _find_anchors(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys, texts = b.column(0), b.column(1).to_pylist()
            size = np.array([len(t) for t in texts], np.int64)
            total = np.cumsum(size)
            start = 0
            while start < len(texts):
                done = total[start - 1] if start else 0
                end = max(start + 1, int(np.searchsorted(total, done + CHUNK)))
                cp = np.frombuffer("".join(texts[start:end]).encode("utf-32-le", "surrogatepass"), np.uint32)
                first = np.r_[0, np.cumsum(size[start:end])]
                h, t, s, n, p = anchors(cp, np.repeat(np.arange(end - start), size[start:end]), first, length)
                if len(h):
                    span = (s << 32) | (n << 16) | (p - s)
                    yield pa.RecordBatch.from_arrays([pa.array(h), keys.take(pa.array(t + start)), pa.array(span)], names=["fp", "doc", "span"])
                start = end

    return run


def _of_two_documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by anchor and document those of anchors that several documents have.

    The rows go by in order; only those of an anchor's first document are held until a second one is seen.
    """
    rest: pa.Table | None = None
    known: int | None = None
    for b in batches:
        if not b.num_rows:
            continue
        t = pa.Table.from_batches([b])
        t = (t if rest is None else pa.concat_tables([rest, t])).combine_chunks()
        fp, doc = t.column(0).to_numpy(), t.column(1).combine_chunks()
        new = np.r_[True, fp[1:] != fp[:-1]]
        other = np.r_[False, pc.not_equal(doc.slice(1), doc.slice(0, len(doc) - 1)).to_numpy(zero_copy_only=False)]
        group = np.cumsum(new) - 1
        two = np.bincount(group, other & ~new) > 0
        two[0] |= fp[0] == known
        known = int(fp[-1]) if two[-1] else None
        rest = None if two[-1] else t.slice(int(np.nonzero(new)[0][-1]))
        if two.any():
            yield from t.filter(pa.array(two[group])).to_batches()


def _cut_snippets(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            docs, texts, fps, spans = b.column(0), b.column(1).to_pylist(), b.column(2), b.column(3)
            fp, span = fps.flatten(), spans.flatten().to_numpy()
            row = np.repeat(np.arange(len(texts)), np.diff(spans.offsets.to_numpy()))
            s, n, p = span >> 32, span >> 16 & 0xFFFF, span & 0xFFFF
            lead = np.minimum(s, 1)
            snip = [texts[r][a:z] for r, a, z in zip(row.tolist(), (s - lead).tolist(), (s + n - 1 + length).tolist())]
            names = ["fp", "doc", "start", "lead", "anchor", "snip"]
            yield pa.RecordBatch.from_arrays([fp, docs.take(pa.array(row)), pa.array(s - lead), pa.array(lead.astype(np.int32)), pa.array((p + lead).astype(np.int32)), pa.array(snip, pa.string())], names=names)

    return run


def _others(index: FMIndex, entry: np.ndarray, a: np.ndarray, at: np.ndarray, size: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, ...]:
    """(a, b, at, size) for the snippets b in each suffix interval of a's stretches; a itself where it is there twice."""
    iv, e = index.strings_at(lo, hi)
    a, b = a[iv], entry[e]
    twice = np.bincount(entry, minlength=int(entry.max()) + 1) > 1
    keep = (a != b) | twice[a]
    return a[keep], b[keep], at[iv][keep], size[iv][keep]


def _search(length: int, every: bool):
    """Over rows sorted by shard: pairs of snippets (a, b) that share a window; or (a, b, at, size) of the shared stretches of a.

    A snippet of several documents is its own partner.
    """

    def flush(rows: list[tuple]) -> pa.RecordBatch | None:
        entry = np.array([k for k, r in enumerate(rows) for _ in range(2 if r[5] else 1)])
        if len(entry) < 2 or not any(r[4] for r in rows):
            return None
        ids, snips, leads, anch, queries, _ = zip(*rows)
        points = [code_points(x) for x in snips]
        index = FMIndex([points[k] for k in entry])
        size, lead, p = np.array([len(x) for x in points]), np.array(leads, np.int64), np.array(anch, np.int64)
        first = np.r_[0, np.cumsum(size)]
        text = index.codes(np.concatenate(points))
        mine = np.nonzero(np.array(queries))[0]
        if every:
            # Snippets that others have as a whole, and every window of those that none has.
            q, _, lo, hi, whole = index.walk(text, first[mine + 1], first[mine] + lead[mine])
            q, lo, hi = q[whole], lo[whole], hi[whole]
            found = [_others(index, entry, mine[q], lead[mine[q]], size[mine[q]] - lead[mine[q]], lo, hi)]
            rest = np.setdiff1d(mine, mine[q])
            n = size[rest] - length - lead[rest] + 1
            s = np.repeat(rest, n)
            at = np.arange(len(s)) - np.repeat(np.cumsum(n) - n, n) + lead[s]
        else:
            q, start, _, _, _ = index.walk(text, first[mine] + p[mine] + GRAM, first[mine] + lead[mine])
            s, at, found = mine[q], start - first[mine[q]], []
            fits = at + length <= size[s]
            s, at = s[fits], at[fits]
        q, lo, hi = index.window(text, first[s] + at, length)
        found.append(_others(index, entry, s[q], at[q], np.full(len(q), length), lo, hi))
        a, b, at, n = (np.concatenate(x) for x in zip(*found))
        if not len(a):
            return None
        if not every:
            at, n = np.zeros_like(at), np.zeros_like(n)
        a, b, at, n = np.unique(np.stack([a, b, at, n]), axis=1)
        take = pa.array(ids, pa.binary())
        return pa.RecordBatch.from_arrays([take.take(pa.array(a)), take.take(pa.array(b)), pa.array(at.astype(np.int32)), pa.array(n.astype(np.int32))], names=["a", "b", "at", "size"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        chars, last = 0, None
        for b in batches:
            c = [b.column(i).to_pylist() for i in range(7)]
            for work, sid, snip, lead, anchor, query, several in zip(*c):
                if work != last and chars >= SHARD:
                    if (r := flush(rows)) is not None:
                        yield r
                    rows, chars = [], 0
                last = work
                rows.append((sid, snip, lead, anchor, query, several))
                chars += len(snip)
        if (r := flush(rows)) is not None:
            yield r

    return run


def _members(docs: DataFrame, length: int) -> DataFrame:
    """fp, doc, start, lead, anchor, snip, sid of the snippets of anchors that more than one document has; rows may come twice."""
    kind = dict(docs.dtypes)["doc"]
    schema = f"fp bigint, doc {kind}, span bigint"
    found = docs.mapInArrow(_find_anchors(length), schema).repartition("fp").sortWithinPartitions("fp", "doc")
    both = found.mapInArrow(_of_two_documents, schema)
    mine = both.groupBy("doc").agg(F.collect_set(F.struct("fp", "span")).alias("x")).select("doc", F.col("x.fp").alias("fp"), F.col("x.span").alias("span"))
    t = docs.join(mine, "doc").select("doc", "text", "fp", "span")
    t = t.mapInArrow(_cut_snippets(length), f"fp bigint, doc {kind}, start bigint, lead int, anchor int, snip string")
    return t.withColumn("sid", F.unhex(F.md5(F.concat_ws("|", "fp", "lead", "anchor", "snip"))))


def _kinds(members: DataFrame) -> DataFrame:
    """fp, sid, snip, lead, anchor, several (documents have it), n (places), k (different snippets of the anchor)."""
    kinds = members.groupBy("fp", "sid", "snip", "lead", "anchor").agg((F.min("doc") < F.max("doc")).alias("several"), F.count("*").alias("n"))
    return kinds.join(members.groupBy("fp", "sid").agg(F.lit(1).alias("one")).groupBy("fp").agg(F.count("*").alias("k")), "fp")


def _index_work(kinds: DataFrame) -> DataFrame:
    """work, sid, snip, lead, anchor, query, several: what each shard indexes (all) and searches (query)."""
    t = kinds.withColumn("blocks", F.ceil(F.col("k") / BLOCK).cast("int"))
    t = t.withColumn("block", F.pmod(F.xxhash64("sid"), F.col("blocks")).cast("int"))
    # Block i is searched in the index of the blocks i and j, for each j; one block, the usual case, stays one row.
    t = t.withColumn("j", F.explode(F.expr("if(blocks = 1, array(0), sequence(0, blocks - 1))")))
    own = t.select("fp", F.col("block").alias("i"), F.col("j"), "sid", "snip", "lead", "anchor", F.lit(True).alias("query"), "several")
    theirs = t.where("blocks > 1 and j <> block").select("fp", F.col("j").alias("i"), F.col("block").alias("j"), "sid", "snip", "lead", "anchor", F.lit(False).alias("query"), "several")
    every = own.unionByName(theirs).withColumn("work", F.xxhash64("fp", "i", "j"))
    return every.select("work", "sid", "snip", "lead", "anchor", "query", "several").repartition("work").sortWithinPartitions("work")


def _prepare(docs: DataFrame, key: str, text: str, length: int) -> DataFrame:
    t = docs.select(F.col(key).alias("doc"), F.col(text).alias("text"))
    return t.where(F.col("doc").isNotNull() & (F.length("text") >= length))


def _copies(t: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """The documents without the copies of texts that more than MANY_COPIES documents have, and (least document, copy)."""
    h = t.select("doc", F.md5("text").alias("h"), F.xxhash64("text").alias("g"))
    big = h.groupBy("h", "g").agg(F.count_distinct("doc").alias("n"), F.min("doc").alias("least")).where(F.col("n") > MANY_COPIES)
    if big.isEmpty():
        return t, None
    links = h.join(big, ["h", "g"]).where("doc <> least").select("least", "doc").distinct()
    return t.join(links, "doc", "left_anti"), links


def shared_pairs(docs: DataFrame, key: str, text: str, length: int = 100) -> DataFrame:
    """doc_id_a, doc_id_b (the smaller first): documents with a stretch of ``length`` code points in common."""
    t, links = _copies(_prepare(docs, key, text, length))
    members = cut(_members(t, length))
    release(docs.sparkSession)  # the shuffled anchors and texts
    # Anchors with different snippets, or with one at the start of a text that several documents have.
    kinds = _kinds(members).where("k > 1 or (lead = 0 and several)")
    found = _index_work(kinds).mapInArrow(_search(length, False), "a binary, b binary, at int, size int").select("a", "b")
    pairs = found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    m = members.select("sid", "doc").join(kinds.select("sid", F.ceil(F.col("n") / HOLDERS).alias("blocks")), "sid")
    m = m.groupBy("sid", F.pmod(F.xxhash64("doc"), F.col("blocks")).alias("block")).agg(F.collect_set("doc").alias("docs"))
    p = pairs.join(m.select(F.col("sid").alias("a"), F.col("block").alias("i"), F.col("docs").alias("da")), "a").join(m.select(F.col("sid").alias("b"), F.col("block").alias("j"), F.col("docs").alias("db")), "b")
    p = p.where("a <> b or i <= j").repartition("a", "b", "i", "j").select(F.explode("da").alias("da"), "db").select("da", F.explode("db").alias("db"))
    p = p.where("da <> db").select(F.least("da", "db").alias("doc_id_a"), F.greatest("da", "db").alias("doc_id_b"))
    if links is not None:
        p = p.unionByName(links.select(F.col("least").alias("doc_id_a"), F.col("doc").alias("doc_id_b")))
    return p.distinct()


def shared_share(docs: DataFrame, key: str, text: str, length: int = 100) -> DataFrame:
    """doc_id, n_chars, n_shared, share: how much of every document lies in stretches shared with others.

    Every document with a text gives a row, 0 where nothing is shared.
    """
    t, links = _copies(_prepare(docs, key, text, length))
    members = cut(_members(t, length))
    release(docs.sparkSession)  # the shuffled anchors and texts
    kinds = _kinds(members).where("k > 1 or several")
    found = _index_work(kinds).mapInArrow(_search(length, True), "a binary, b binary, at int, size int")
    one = members.groupBy("sid").agg(F.min("doc").alias("lo"), F.max("doc").alias("hi"))
    hits = found.join(one.select(F.col("sid").alias("b"), "lo", "hi"), "b").groupBy("a", "at", "size").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    hits = hits.join(members.select(F.col("sid").alias("a"), "doc", "start"), "a").where("doc <> lo or doc <> hi")
    every = hits.select("doc", (F.col("start") + F.col("at")).alias("s"), (F.col("start") + F.col("at") + F.col("size")).alias("e")).distinct()
    cover = periods(every, ["doc"], "s", "e").groupBy("doc").agg(F.sum(F.col("end_ms") - F.col("start_ms")).alias("n_shared"))
    n = docs.select(F.col(key).alias("doc"), F.length(text).alias("n_chars")).where("n_chars is not null and doc is not null").distinct()
    out = n.join(cover, "doc", "left")
    if links is not None:
        full = links.select("doc").unionByName(links.select(F.col("least").alias("doc"))).distinct().withColumn("all", F.lit(True))
        out = out.join(full, "doc", "left").withColumn("n_shared", F.expr("if(all, n_chars, n_shared)"))
    out = out.withColumn("n_shared", F.coalesce("n_shared", F.lit(0)).cast("bigint")).withColumn("n_chars", F.col("n_chars").cast("bigint"))
    return out.select(F.col("doc").alias("doc_id"), "n_chars", "n_shared", F.expr("if(n_chars = 0, 0d, n_shared / n_chars)").alias("share"))
