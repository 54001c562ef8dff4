"""Places for models: batch functions over partitions, chosen by name.

Weights are not part of the engine. A model is a factory that is called once a partition and gives a
function from a pandas frame to a pandas frame.
"""

from __future__ import annotations

import time
import zlib
from collections.abc import Callable, Iterator
from typing import Protocol

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

Batch = Callable[[pd.DataFrame], pd.DataFrame]


class Extractor(Protocol):
    """Keyframe extraction plug-in: set up, frames and shots to keyframes, torn down."""

    name: str

    def setup(self) -> None: ...

    def extract(self, frames: DataFrame, shots: DataFrame) -> DataFrame: ...

    def teardown(self) -> None: ...


_models: dict[str, tuple[Callable[[], Batch], str]] = {}
_extractors: dict[str, Extractor] = {}


def register(name: str, factory: Callable[[], Batch], schema: str) -> None:
    """A model by name and the schema of its results (shot boundaries, speech, text, captions, vectors)."""
    _models[name] = (factory, schema)


def register_extractor(extractor: Extractor) -> None:
    _extractors[extractor.name] = extractor


def extractor(name: str) -> Extractor:
    return _extractors[name]


class Refused(Exception):
    """Raised by a model whose service refuses a call for now; the call is made again after ``seconds``."""

    def __init__(self, seconds: float):
        super().__init__(seconds)
        self.seconds = seconds


def paced(model: Batch, rows: pd.DataFrame, bucket: TokenBucket | None, tries: int = 5) -> pd.DataFrame:
    """One call, when it is due, and again after each refusal."""
    for left in range(tries - 1, -1, -1):
        if bucket:
            bucket.take(len(rows))
        try:
            return model(rows)
        except Refused as e:
            if not left:
                raise
            if bucket:
                bucket.pause(e.seconds)
            else:
                time.sleep(e.seconds)
    raise AssertionError


def apply(df: DataFrame, name: str, per_minute: float | None = None) -> DataFrame:
    """The model over every partition; with ``per_minute`` at most so many rows a minute, shared by the tasks that run at once."""
    factory, schema = _models[name]
    share = per_minute / max(1, df.sparkSession.sparkContext.defaultParallelism) if per_minute else None

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model, bucket = factory(), TokenBucket(share) if share else None
        for b in batches:
            yield paced(model, b, bucket)

    return df.mapInPandas(run, schema)


class TokenBucket:
    """Paces calls: ``take(n)`` waits until n calls are due."""

    def __init__(self, per_minute: float, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep):
        self.rate, self.clock, self.sleep = per_minute / 60, clock, sleep
        self.due = clock()

    def take(self, n: int = 1) -> None:
        now = self.clock()
        if self.due > now:
            self.sleep(self.due - now)
        self.due = max(self.due, now) + n / self.rate

    def pause(self, seconds: float) -> None:
        """After a refusal: nothing for a while."""
        self.due = max(self.due, self.clock() + seconds)


def stand_in_encoder(dim: int = 64) -> Callable[[], Batch]:
    """Unit vectors that depend on the key alone, for tests."""

    def factory() -> Batch:
        def encode(b: pd.DataFrame) -> pd.DataFrame:
            v = np.stack([np.random.default_rng(zlib.crc32(str(k).encode())).normal(size=dim) for k in b.iloc[:, 0]]) if len(b) else np.zeros((0, dim))
            v /= np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)
            return pd.DataFrame({"keyframe_id": b.iloc[:, 0], "embedding": list(v.astype(np.float32))})

        return encode

    return factory
