"""Parquet tables of a data folder."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def missing(error: AnalysisException) -> bool:
    return error.getCondition() == "PATH_NOT_FOUND"


def stored(spark: SparkSession, path: str) -> DataFrame | None:
    """A parquet table, None if there is none. Any other error stays one."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if missing(e):
            return None
        raise
