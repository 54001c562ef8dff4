"""New files of a spool folder, each record once, into a table: the resumable form of the batch jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from shotlake.operators import merge
from shotlake.sources.tables import stored


def spool(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """JSON lines of a folder as they come; lines that aren't complete are dropped."""
    return spark.readStream.schema(schema).option("mode", "DROPMALFORMED").json(folder)


def sync(records: DataFrame, key: str, target: str, checkpoint: str) -> StreamingQuery:
    """Everything new is appended once per key; where a run stops, the next goes on from the checkpoint."""

    def write(batch: DataFrame, _no: int) -> None:
        spark = batch.sparkSession
        new = batch.where(F.col(key).isNotNull()).dropDuplicates([key])
        have = stored(spark, target)
        if have is not None:
            new = new.join(have.select(key), key, "left_anti")
        new.write.mode("append").parquet(target)

    return records.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def upsert(records: DataFrame, keys: list[str], read, write, checkpoint: str) -> StreamingQuery:
    """The last record of a key replaces its row; ``read`` and ``write`` give and take the target's rows."""

    def apply(batch: DataFrame, no: int) -> None:
        t = batch.withColumn("__o", F.monotonically_increasing_id())
        last = t.groupBy(*keys).agg(F.max_by(F.struct(*[c for c in batch.columns if c not in keys]), "__o").alias("x")).select(*keys, "x.*")
        write(merge.replace_rows(read(), last.select(*batch.columns), keys), no)

    return records.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(events: DataFrame, time: str, key: str, width: str = "10 minutes", late: str = "5 minutes") -> DataFrame:
    """Events a window and key; a window closes when the watermark has passed it."""
    return events.withWatermark(time, late).groupBy(F.window(time, width).alias("w"), key).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), key, "n")
