"""Problem 5: lines that stand in documents all over one source.

A line's letters are what remains of its consistent form, case-folded, when all but letters (numbers,
dates, signs and blanks among them) are masked out. Two lines of one source (a video) are the same if
the edit distance of their letters is at most a tenth of the longer, rounded down. A line is repeated
if documents (frames) of at least ``least`` different units (shots) of its source hold the same line.

Different letters of a source meet by MinHash: a line's keys are the first of its grams of ``GRAM``
letters in an order by how rare a gram is and then by hash, so many that no pair is missed. An edit changes
GRAM grams at most, so of two lines within k edits each has at most GRAM * k grams that the other hasn't, and
the first gram of both is among the first GRAM * k + 1 of each (a gram's second occurrence counts as another gram; within
k, a tenth of the longer, common grams remain). Any order does for that; with rare grams first, a gram that
stands in very many lines of a source is hardly ever a key, so a key's lines stay few at any size. How often
grams stand is counted over all lines in a table of ``COUNTERS`` sums, of which the driver gets the powers of two. Lines that meet in a key, and whose sets of letter pairs k edits can turn into
each other, are compared exactly. How often a line stands matters only up to ``least``, so a line carries at
most that many units, chosen before the shuffle, and a line that alone reaches it needs no partner. The keys
of a line are spread by hash: a hot source is split over its keys.

Null and empty texts have no lines. A line without a letter is no case. Blank and null units don't
count, but their lines may be cases. Documents without a source form one. A document delivered twice
counts once; of different copies the least (source, unit, text) holds.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shotlake.llm.canon import folded_col
from shotlake.llm.runs import alike
from shotlake.plans.lineage import cut

GRAM = 4
#: Sums of the counts of grams, by hash.
COUNTERS = 1 << 18


def _hashed(cp: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n letters from each place on."""
    h = np.zeros(len(cp), np.uint64)
    for k in range(n):
        h[: len(cp) - k] = h[: len(cp) - k] * np.uint64(0x9E3779B97F4A7C15) + cp[k:] + np.uint64(1)
    return _mixed(h)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


def _inside(size: np.ndarray, n: int) -> np.ndarray:
    """Places of the joined lines at which n letters of one line begin."""
    ok = np.ones(size.sum(), bool)
    for k in range(1, n):
        ok[np.cumsum(size) - k] = False
    return ok


def _rank(line: np.ndarray) -> np.ndarray:
    """Place of each row in its run of equal ``line``."""
    starts = np.flatnonzero(np.r_[True, line[1:] != line[:-1]])
    return np.arange(len(line)) - np.repeat(starts, np.diff(np.r_[starts, len(line)]))


def _counter(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(46)).astype(np.int64)


def _grams(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    cp = np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    size = np.array([len(x) for x in lines])
    grams = _inside(size, GRAM)
    return _hashed(cp, GRAM)[grams], np.repeat(np.arange(len(lines)), size)[grams]


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each task, the counters that are not 0."""
    n = np.zeros(COUNTERS, np.int64)
    for b in batches:
        for at in range(0, b.num_rows, 5000):
            n += np.bincount(_counter(_grams(b.column(0).slice(at, 5000).to_pylist())[0]), minlength=COUNTERS)
    at = np.nonzero(n)[0]
    yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(n[at])], names=["at", "n"])


def gram_levels(lines: DataFrame) -> np.ndarray:
    """How common the grams of lines(letters) are, as a power of two by counter."""
    t = lines.mapInArrow(_counts, "at int, n bigint").groupBy("at").agg(F.floor(F.log2(F.sum("n"))).cast("int").alias("level")).toPandas()
    out = np.zeros(COUNTERS, np.uint8)
    out[t["at"]] = t["level"]
    return out


def line_keys(lines: list[str], levels: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys of all lines, how many each has, and the set of each line's letter pairs in 64 bits; every line has GRAM letters or more."""
    cp = np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    size = np.array([len(x) for x in lines])
    pairs = _inside(size, 2)
    bits = np.uint64(1) << (_hashed(cp, 2)[pairs] >> np.uint64(58))
    bag = np.bitwise_or.reduceat(bits, np.r_[0, np.cumsum(size - 1)[:-1]])
    h, no = _grams(lines)
    order = np.lexsort((h, no))
    h, no = h[order], no[order]
    level = levels[_counter(h)]
    again = _rank(np.cumsum(np.r_[True, (h[1:] != h[:-1]) | (no[1:] != no[:-1])]))
    h = _mixed(h + again.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.lexsort((h, level, no))
    h, no = h[order], no[order]
    # The longer of two lines within a tenth of it is at most a ninth longer than this one.
    h, no = (x[_rank(no) <= GRAM * (size[no] // 9)] for x in (h, no))
    return h.view(np.int64), np.bincount(no, minlength=len(lines)), bag.view(np.int64)


def _keys(levels: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 5000):
                part = b.slice(at, 5000)
                keys, n, bag = line_keys(part.column(1).to_pylist(), levels)
                offsets = pa.array(np.r_[0, np.cumsum(n)].astype(np.int32))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(bag), pa.ListArray.from_arrays(offsets, pa.array(keys))], names=[*part.schema.names, "bag", "keys"])

    return run


def _lines(df: DataFrame, key: str, source: str, unit: str, text: str) -> DataFrame:
    t = df.select(F.col(key).alias("id"), F.col(source).alias("src"), F.col(unit).alias("unit"), F.col(text).alias("text")).where(F.col("id").isNotNull())
    t = t.groupBy("id").agg(F.min(F.struct("src", "unit", "text")).alias("x")).select("id", "x.*").where(F.length("text") > 0)
    t = t.select("id", "src", F.when(F.trim("unit") != "", F.col("unit")).alias("unit"), F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
    t = t.select("id", "src", "unit", (F.col("pos") + 1).alias("line_no"), "line", F.regexp_replace(folded_col(F.col("line")), "[^\\p{L}]", "").alias("letters"))
    return t


def _cases(lines: DataFrame, least: int) -> DataFrame:
    """src, letters of the lines that units enough hold."""
    t = lines.where("letters <> ''").select("src", "letters", "unit").distinct()
    w = Window.partitionBy("src", "letters").orderBy(F.col("unit").asc_nulls_last())
    # At most ``least`` units a line: whether a union reaches ``least`` depends on no more.
    t = t.withColumn("r", F.row_number().over(w)).where(F.col("r") <= least)
    t = t.groupBy("src", "letters").agg(F.collect_set("unit").alias("units")).withColumn("line", F.xxhash64("src", "letters"))
    t = cut(t)
    own = t.where(F.size("units") >= least).select("src", "letters")
    # Below nine letters nothing but the same letters is the same: the longer of a pair has ten at least.
    near = t.where("length(letters) >= 9").select("line", "letters", F.xxhash64("src").alias("h"), (F.size("units") < least).alias("light"))
    near = near.mapInArrow(_keys(gram_levels(near.select("letters"))), "line bigint, letters string, h bigint, light boolean, bag bigint, keys array<bigint>")
    near = near.select("line", F.length("letters").alias("n"), "light", "bag", "h", F.explode("keys").alias("k"))
    # One exchange of keys serves both sides; the letters come in by line, for candidates only.
    near = near.select(F.xxhash64("k", "h").alias("k"), "line", "n", "light", "bag").repartition("k")
    two = near.select("k", F.col("line").alias("l2"), F.col("n").alias("n2"), F.col("bag").alias("b2"))
    # Only lines that don't reach ``least`` alone look for partners. An edit changes four of the letter pairs at most.
    most = "floor(greatest(n, n2) / 10)"
    p = near.join(two, "k").where(f"light and line <> l2 and abs(n - n2) <= {most} and bit_count(bag ^ b2) <= 4 * {most}").select("line", "l2").distinct()
    a = t.select("line", "src", "letters", "units")
    b = t.select(F.col("line").alias("l2"), F.col("src").alias("s2"), F.col("letters").alias("t2"), F.col("units").alias("u2"))
    p = p.join(a, "line").join(b, "l2").where(F.col("src").eqNullSafe(F.col("s2")) & (F.col("letters") != F.col("t2"))).where(alike("letters", "t2"))
    p = p.groupBy("src", "letters").agg(F.array_union(F.first("units"), F.array_distinct(F.flatten(F.collect_set("u2")))).alias("all"))
    return own.unionByName(p.where(F.size("all") >= least).select("src", "letters"))


def repeated_lines(df: DataFrame, key: str, source: str, unit: str, text: str, least: int = 8) -> DataFrame:
    """id, line_no of the lines that are repeated within their source; lines are counted from 1."""
    lines = _lines(df, key, source, unit, text)
    c = _cases(lines, least).select(F.col("src").alias("s"), F.col("letters").alias("l"))
    return lines.join(c, F.col("src").eqNullSafe(F.col("s")) & (F.col("letters") == F.col("l")), "left_semi").select("id", "line_no")


def without_repeated(df: DataFrame, key: str, source: str, unit: str, text: str, least: int = 8) -> DataFrame:
    """id, text, n_removed: each document's text without the repeated lines; the rest stays as stored.

    A document without text gives null, one all of whose lines go gives the empty text.
    """
    lines = _lines(df, key, source, unit, text)
    c = _cases(lines, least).select(F.col("src").alias("s"), F.col("letters").alias("l"), F.lit(True).alias("gone"))
    t = lines.join(c, F.col("src").eqNullSafe(F.col("s")) & (F.col("letters") == F.col("l")), "left").withColumn("gone", F.coalesce("gone", F.lit(False)))
    t = t.groupBy("id").agg(F.sort_array(F.collect_list(F.when(~F.col("gone"), F.struct("line_no", "line")))).alias("x"), F.count_if("gone").alias("n_removed"))
    t = t.select("id", F.array_join("x.line", "\n").alias("text"), "n_removed")
    every = df.select(F.col(key).alias("id"), F.col(text).alias("stored")).where(F.col("id").isNotNull()).groupBy("id").agg(F.min("stored").alias("stored"))
    return every.join(t, "id", "left").select("id", F.when(F.length("stored") > 0, F.coalesce("text", F.lit(""))).otherwise(F.col("stored")).alias("text"), F.coalesce("n_removed", F.lit(0)).cast("bigint").alias("n_removed"))
