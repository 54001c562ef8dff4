"""Problem 3: runs of consecutive events that are the same or nearly so.

The events of a group (the keyframes of a video) are ordered by time. Neighbours are alike if the edit
distance of their texts is at most a tenth of the longer one's length, rounded down. A run in which
every event is like the one before becomes one row with its count and duration.

An event's predecessor is found within buckets of time and, for a bucket's first event, from the last
event of the bucket before, so no task holds a whole group. Runs are then found by pointer doubling:
an event that is like its predecessor points to it, and self-joins replace each pointer by its
target's pointer until all point to the start of their run; n events in a row take log2(n) joins. Events that
point to their run's start are left out of the next join, and the pointers of the others all differ, so
a run of any length is spread over tasks. Lineage is cut after each join by the checkpoint folder.

Texts are compared in consistent form, case-folded, white space collapsed and trimmed. An event with a
null or blank text is like no other. Events without a time take no part; events without a group
form one. An event delivered twice counts once; of different copies of one event the least
(group, time, text) holds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shotlake.llm.canon import folded_col
from shotlake.plans.lineage import cut

#: Length of a bucket in the unit of the time column.
BUCKET = 600_000


def collapsed(col: Column) -> Column:
    """Folded text with white space collapsed; null if nothing is left."""
    t = F.trim(F.regexp_replace(folded_col(col), "[ \\n]+", " "))
    return F.when(t != "", t)


def alike(a: str, b: str) -> Column:
    """Is the edit distance of columns a and b at most a tenth of the longer, rounded down? False if one is null."""
    most = F.floor(F.greatest(F.length(a), F.length(b)) / 10).cast("int")
    near = (F.abs(F.length(a) - F.length(b)) <= most) & (F.expr(f"levenshtein({a}, {b}, cast(floor(greatest(length({a}), length({b})) / 10) as int))") >= 0)
    return F.coalesce((F.col(a) == F.col(b)) | near, F.lit(False))


def _with_previous(t: DataFrame) -> DataFrame:
    """t(id, grp, ts, text) with pid, pts, ptext of the event before, in its group."""
    # One exchange, and one folding of the texts before it, serves the window and the buckets' last events.
    t = t.withColumn("bucket", F.floor(F.col("ts") / BUCKET)).repartition("grp", "bucket")
    lasts = t.groupBy("grp", "bucket").agg(F.max(F.struct("ts", "id", "text")).alias("last"))
    w = Window.partitionBy("grp").orderBy("bucket")
    before = lasts.select(F.col("grp").alias("g"), F.col("bucket").alias("b"), F.lag("last").over(w).alias("carried"))
    own = F.lag(F.struct("ts", "id", "text")).over(Window.partitionBy("grp", "bucket").orderBy("ts", "id"))
    t = t.withColumn("own", own).join(before, F.col("grp").eqNullSafe(F.col("g")) & (F.col("bucket") == F.col("b")), "left")
    t = t.withColumn("prev", F.coalesce("own", "carried"))
    return t.select("id", "grp", "ts", "text", F.col("prev.id").alias("pid"), F.col("prev.ts").alias("pts"), F.col("prev.text").alias("ptext"))


def doubled(links: DataFrame) -> DataFrame:
    """links(id, ptr, pts, ...) with every ptr (and pts) moved on to the end of its chain of pointers.

    A link whose target has no link is settled and takes no part in later joins, so a run's start isn't joined
    by all its members: the unsettled pointers of a round all differ.
    """
    to = links.select(F.col("id").alias("tid"), F.lit(True).alias("on"))
    t = cut(links.join(to, F.col("ptr") == F.col("tid"), "left").select(*links.columns, F.coalesce("on", F.lit(False)).alias("moving")))
    settled, moving = t.where("not moving"), t.where("moving")
    while not moving.isEmpty():
        to = settled.unionByName(moving).select(F.col("id").alias("tid"), F.col("ptr").alias("tptr"), F.col("pts").alias("tpts"), F.col("moving").alias("tmoving"))
        t = moving.join(to, F.col("ptr") == F.col("tid"))
        t = cut(t.withColumns({"ptr": F.col("tptr"), "pts": F.col("tpts"), "moving": F.col("tmoving")}).select(*moving.columns))
        settled, moving = settled.unionByName(t.where("not moving")), t.where("moving")
    return settled.drop("moving")


def repeated_runs(df: DataFrame, group: str, key: str, time: str, text: str) -> DataFrame:
    """group, first (key of the run's first event), n, duration: the longest runs of two or more events."""
    t = df.select(F.col(key).alias("id"), F.col(group).alias("grp"), F.col(time).cast("bigint").alias("ts"), F.col(text).alias("text"))
    t = t.where(F.col("ts").isNotNull() & F.col("id").isNotNull())
    t = t.groupBy("id").agg(F.min(F.struct("grp", "ts", "text")).alias("x")).select("id", "x.grp", "x.ts", collapsed(F.col("x.text")).alias("text"))
    links = _with_previous(t).where(alike("text", "ptext")).select("id", "grp", "ts", F.col("pid").alias("ptr"), "pts")
    runs = doubled(links).groupBy("grp", "ptr", "pts").agg((F.count("*") + 1).alias("n"), F.max("ts").alias("until"))
    return runs.select(F.col("grp").alias("group"), F.col("ptr").alias("first"), "n", (F.col("until") - F.col("pts")).alias("duration"))
