"""A standing index for searches of single vectors: an inverted file of coarse centroids, as a table laid out by list.

A search reads the lists of the ``probes`` nearest centroids and takes exact cosines there; what other lists hold is missed, so
``probes`` trades reading for recall. Centroids are fitted in one task on a bounded sample (``TRAIN`` vectors a list,
``MOST_TRAIN`` at most); every usable vector is in one list. Vectors of another length, with a value that isn't finite or
all zero are in none.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shotlake.operators.search import vector_scores

TRAIN, MOST_TRAIN = 16, 65_536


def _unit(vectors: pd.Series) -> np.ndarray:
    x = np.stack(vectors.to_numpy()).astype(np.float32)
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-30)


def _centroids(x: np.ndarray, n: int, rounds: int = 5, seed: int = 1) -> np.ndarray:
    """Directions that part unit vectors into n lists."""
    rng = np.random.default_rng(seed)
    c = x[rng.permutation(len(x))[:n]]
    for _ in range(rounds):
        of = (x @ c.T).argmax(1)
        total = np.zeros_like(c)
        np.add.at(total, of, x)
        size = np.linalg.norm(total, axis=1, keepdims=True)
        c = np.where(size > 0, total / np.maximum(size, 1e-30), c)
    return c


def usable(entities: DataFrame, vector: str, dim: int) -> DataFrame:
    wrong = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return entities.where((F.size(vector) == dim) & ~wrong & F.exists(vector, lambda x: x != 0))


def write(entities: DataFrame, vector: str, dim: int, path: str) -> None:
    """The index: about ``2 sqrt(rows)`` lists, as far as the sample allows; other columns go with the vectors."""
    t = usable(entities, vector, dim)
    rows = t.count()
    lists = int(min(max(1, round(2 * rows**0.5)), MOST_TRAIN // TRAIN))
    sample = t.select(F.col(vector).alias("v"))
    if rows > lists * TRAIN:
        sample = sample.sample(False, min(1.0, 1.05 * lists * TRAIN / rows), 3).limit(lists * TRAIN)

    def fit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts = [_unit(b["v"]) for b in batches if len(b)]
        if parts:
            c = _centroids(np.concatenate(parts), lists)
            yield pd.DataFrame({"list": np.arange(len(c)), "centroid": list(c)})

    spark = entities.sparkSession
    sample.coalesce(1).mapInPandas(fit, "list int, centroid array<float>").write.mode("overwrite").parquet(f"{path}/centroids")
    c = _read(spark, path)

    @F.pandas_udf("int")
    def nearest(v: pd.Series) -> pd.Series:
        return pd.Series((_unit(v) @ c.T).argmax(1).astype(np.int32))

    t = t.withColumn("list", nearest(F.col(vector)) if len(c) else F.lit(0))
    t.repartitionByRange("list").sortWithinPartitions("list").write.mode("overwrite").parquet(f"{path}/lists")


def _read(spark: SparkSession, path: str) -> np.ndarray:
    """The centroids: ``MOST_TRAIN / TRAIN`` at most."""
    rows = spark.read.parquet(f"{path}/centroids").orderBy("list").collect()
    return np.array([r["centroid"] for r in rows], np.float32)


def near_lists(spark: SparkSession, path: str, query: Sequence[float], probes: int) -> list[int]:
    c = _read(spark, path)
    return np.argsort(-(c @ np.array(query, np.float32)), kind="stable")[:probes].tolist() if len(c) else []


def search(spark: SparkSession, path: str, key: str, vector: str, query: Sequence[float], probes: int = 16) -> DataFrame:
    """doc, score of the vectors in the ``probes`` nearest lists; only their row groups are read."""
    some = spark.read.parquet(f"{path}/lists").where(F.col("list").isin(near_lists(spark, path, query, probes)))
    return vector_scores(some, key, vector, query)
