"""Cutting the lineage of iterative plans in a way that survives the loss of executors."""

from __future__ import annotations

import atexit
import gc
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder that the session names in ``spark.checkpoint.dir``, or that the context has.

    Only where neither is set (tests on a local master) a temporary one is made, that goes with the process.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not sc.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            folder = tempfile.mkdtemp(prefix="shotlake-")
            atexit.register(shutil.rmtree, folder, ignore_errors=True)
        sc.setCheckpointDir(folder)
    return sc.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read from there.

    With ``spark.cleaner.referenceTracking.cleanCheckpoints`` the files go when nothing refers to them any more.
    """
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def release(spark: SparkSession) -> None:
    """Lets the driver notice which shuffle files and checkpoints nothing refers to any more, so that executors drop them.

    Of use after a cut, when what comes before it took much room on disk.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def scratch(spark: SparkSession) -> str:
    """A new path below the shared folder."""
    return f"{shared_folder(spark)}/{uuid.uuid4().hex}"
