"""Problem 4: continuous periods of intervals and the gaps between them, by dyadic blocks.

An integer interval [start, end) is the disjoint union of at most two canonical blocks a level,
a block (level, index) being [index * 2^level, (index + 1) * 2^level). Two blocks are nested or
disjoint, so a union of intervals needs no order:

1. every interval is exploded into its canonical blocks, in the JVM, by a closed form a level;
2. blocks are gathered by tile (a block of level ``TILE`` above the round's base level). A tile holds
   less than 2^(TILE+1) different blocks, however many intervals an entity has, so a hot entity is
   spread over its tiles and repeated intervals fall together;
3. in a tile, blocks below a present ancestor go, sibling pairs become their parent, level by level,
   and adjacent blocks are joined to stretches;
4. tiles below a block of a higher round go (an equi-join on the tile's ancestors);
5. stretches that end at a border of their tile are joined where they touch: at most two a tile, and those of
   higher rounds; all others are periods already. The gaps inside a tile are found in the tile, those
   between tiles from each tile's first and last period, so no task holds all periods of an entity.

Null bounds and ``end <= start`` are ignored. Null keys form a group of their own. Repeated rows
change nothing. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

TILE = 20

# lo and hi: first block and first block after, of a level, that lie in [s, e).
_BLOCKS = """
flatten(transform(
  transform(sequence(0, least(62, cast(floor(log2(cast(__e as double) - cast(__s as double))) as int) + 1)),
    l -> struct(l as l, shiftright(__s, l) + if((__s & (shiftleft(1L, l) - 1L)) != 0L, 1L, 0L) as lo, shiftright(__e, l) as hi)),
  x -> filter(array(
    if((x.lo & 1L) = 1L and x.lo < x.hi, struct(x.l as level, x.lo as idx), null),
    if((x.hi & 1L) = 1L and x.lo + (x.lo & 1L) < x.hi, struct(x.l as level, x.hi - 1L as idx), null)), y -> y is not null)))
"""


def blocks(df: DataFrame, keys: list[str], start: str, end: str) -> DataFrame:
    """keys, level, idx: the canonical blocks of every interval with start < end."""
    t = df.where(F.col(start) < F.col(end)).select(*keys, F.col(start).cast("bigint").alias("__s"), F.col(end).cast("bigint").alias("__e"))
    return t.select(*keys, F.explode(F.expr(_BLOCKS)).alias("b")).select(*keys, "b.level", "b.idx")


def _reduce(level: np.ndarray, off: np.ndarray, g: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Stretches (g, start, end) of the blocks of tiles g; off counts blocks of the level from the tile's start."""
    sets: list[np.ndarray] = []
    for lv in range(TILE):
        m = level == lv
        sets.append(np.unique((g[m] << (TILE - lv)) | off[m]))
    for lv in range(TILE - 1):  # drop what lies below a block that is there
        for up in range(lv + 1, TILE):
            if len(sets[lv]) and len(sets[up]):
                parent = sets[lv] >> (up - lv)
                at = np.minimum(np.searchsorted(sets[up], parent), len(sets[up]) - 1)
                sets[lv] = sets[lv][sets[up][at] != parent]
    sets.append(np.empty(0, np.int64))
    for lv in range(TILE):  # two siblings become their parent
        a = sets[lv]
        if len(a) > 1:
            left = np.nonzero((a[:-1] & 1 == 0) & (a[1:] == a[:-1] + 1))[0]
            if len(left):
                keep = np.ones(len(a), bool)
                keep[left] = keep[left + 1] = False
                sets[lv], sets[lv + 1] = a[keep], np.union1d(sets[lv + 1], a[left] >> 1)
    start = np.concatenate([a << lv for lv, a in enumerate(sets)])
    end = start + np.concatenate([np.full(len(a), 1 << lv, np.int64) for lv, a in enumerate(sets)])
    order = np.argsort(start, kind="stable")
    start, end = start[order], end[order]
    if not len(start):
        return start, start, start
    first = np.r_[True, (start[1:] != end[:-1]) | (start[1:] >> TILE != start[:-1] >> TILE)]
    at = np.nonzero(first)[0]
    last = np.r_[at[1:] - 1, len(start) - 1]
    tile = start[at] >> TILE
    return tile, start[at] - (tile << TILE), end[last] - (tile << TILE)


def _tiles(base: int, keys: int):
    """Over batches sorted by tile: keys, tile, start, end of the stretches in each tile."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.Table | None = None

        def out(t: pa.Table) -> pa.RecordBatch:
            h, tile = t["h"].to_numpy(), t["tile"].to_numpy()
            new = np.r_[True, (h[1:] != h[:-1]) | (tile[1:] != tile[:-1])]
            level = t["level"].to_numpy() - base
            off = t["idx"].to_numpy() - (tile << (TILE - level))
            at, s, e = _reduce(level, off, np.cumsum(new) - 1)
            row = pa.array(np.nonzero(new)[0][at])
            tile = tile[row.to_numpy()] << TILE
            cols = [t.column(i).combine_chunks().take(row) for i in range(keys)]
            arrays = [*cols, t["tile"].combine_chunks().take(row), pa.array((tile + s) << base), pa.array((tile + e) << base)]
            return pa.RecordBatch.from_arrays(arrays, names=[*t.column_names[:keys], "tile", "s", "e"])

        for b in batches:
            if not b.num_rows:
                continue
            t = pa.Table.from_batches([b]) if rest is None else pa.concat_tables([rest, pa.Table.from_batches([b])])
            h, tile = t["h"].to_numpy(), t["tile"].to_numpy()
            cut = np.nonzero((h[1:] != h[:-1]) | (tile[1:] != tile[:-1]))[0]
            n = int(cut[-1]) + 1 if len(cut) else 0
            rest = t.slice(n)
            if n:
                yield out(t.slice(0, n))
        if rest is not None and rest.num_rows:
            yield out(rest)

    return run


def periods(df: DataFrame, keys: list[str], start: str, end: str) -> DataFrame:
    """keys, start_ms, end_ms: the longest stretches that the intervals of a key cover, touching ones joined."""
    span = df.where(F.col(start) < F.col(end)).agg(F.max(F.col(end).cast("double") - F.col(start).cast("double"))).first()[0]
    named = [f"k{i}" for i in range(len(keys))]  # columns of the input may be called as ours
    src = df.select(*[F.col(k).alias(n) for k, n in zip(keys, named)], F.col(start).alias("__a"), F.col(end).alias("__b"))
    every = blocks(src, named, "__a", "__b")
    types = dict(src.dtypes)
    schema = ", ".join([*[f"{n} {types[n]}" for n in named], "tile bigint", "s bigint", "e bigint"])
    found = None
    for base in range(0, 63, TILE):
        if base and (span is None or span < 2.0**base):
            break
        t = every.where((F.col("level") >= base) & (F.col("level") < base + TILE)) if span is not None and span >= 2.0**TILE else every
        t = t.withColumn("tile", F.expr(f"shiftright(idx, {base + TILE} - level)"))
        t = t.select(*named, "level", "idx", "tile", F.xxhash64(*named, "tile").alias("h")).distinct()
        t = t.repartition("h").sortWithinPartitions("h", "tile")
        part = t.mapInArrow(_tiles(base, len(named)), schema)
        if span is not None and span >= 2.0 ** (base + TILE):  # blocks of higher rounds may cover whole tiles
            top = int(np.floor(np.log2(span))) + 1
            above = every.where(F.col("level") >= base + TILE).distinct()
            up = part.select(*named, "tile").distinct().withColumn("level", F.explode(F.sequence(F.lit(base + TILE), F.lit(top))))
            up = up.withColumn("idx", F.expr(f"shiftright(tile, level - {base + TILE})"))
            same = [up[c].eqNullSafe(above[c]) for c in [*named, "level", "idx"]]
            hidden = up.join(above, same, "left_semi").select(*[F.col(n).alias(f"h{n}") for n in named], F.col("tile").alias("htile")).distinct()
            part = part.join(hidden, [*[F.col(n).eqNullSafe(F.col(f"h{n}")) for n in named], F.col("tile") == F.col("htile")], "left_anti")
        part = part.select(*named, "s", "e")
        found = part if found is None else found.unionByName(part)
    # What ends at no border of a tile of the first round touches nothing else and stays with its tile (of no number: the others).
    border = (F.col("s").bitwiseAND(F.lit((1 << TILE) - 1)) == 0) | (F.col("e").bitwiseAND(F.lit((1 << TILE) - 1)) == 0)
    t = found.withColumn("part", F.when(~border, F.shiftright("s", TILE)))
    w = Window.partitionBy(*named, "part").orderBy("s")
    t = t.withColumn("new", F.when(F.col("part").isNull() & (F.lag("e").over(w) == F.col("s")), 0).otherwise(1))
    t = t.withColumn("run", F.sum("new").over(w)).groupBy(*named, "part", "run").agg(F.min("s").alias("start_ms"), F.max("e").alias("end_ms"))
    return t.select(*[F.col(n).alias(k) for n, k in zip(named, keys)], "start_ms", "end_ms")


def periods_and_gaps(df: DataFrame, keys: list[str], start: str, end: str, longest_gap: int | None) -> DataFrame:
    """keys, kind ('period' or 'gap'), start_ms, end_ms. Gaps longer than ``longest_gap`` are not listed."""
    named = [f"k{i}" for i in range(len(keys))]
    t = periods(df, keys, start, end).select(*[F.col(k).alias(n) for k, n in zip(keys, named)], F.col("start_ms").alias("s"), F.col("end_ms").alias("e"))
    t = t.withColumn("tile", F.shiftright("s", TILE))
    w = Window.partitionBy(*named, "tile").orderBy("s")
    t = t.withColumn("next", F.lead("s").over(w)).withColumn("edge", F.col("next").isNull() | F.lag("s").over(w).isNull())
    # The first and last periods of the tiles are few; after a tile's last comes the first of the next that has any.
    t = t.withColumn("tile", F.when(~F.col("edge"), F.col("tile")))
    t = t.withColumn("next", F.coalesce("next", F.when(F.col("edge"), F.lead("s").over(Window.partitionBy(*named, "tile").orderBy("s")))))
    gap = F.col("next").isNotNull()
    if longest_gap is not None:
        gap &= F.col("next") - F.col("e") <= longest_gap
    kinds = F.array(
        F.struct(F.lit("period").alias("kind"), F.col("s").alias("a"), F.col("e").alias("b")),
        F.when(gap, F.struct(F.lit("gap").alias("kind"), F.col("e").alias("a"), F.col("next").alias("b"))),
    )
    t = t.select(*named, F.explode(kinds).alias("x")).where(F.col("x").isNotNull())
    return t.select(*[F.col(n).alias(k) for n, k in zip(named, keys)], "x.kind", F.col("x.a").alias("start_ms"), F.col("x.b").alias("end_ms"))
