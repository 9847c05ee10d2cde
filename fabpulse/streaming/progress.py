"""What micro-batches did, told by Spark while they run."""

from __future__ import annotations

import threading
from collections import defaultdict
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQueryListener
from pyspark.sql.streaming.listener import (
    QueryIdleEvent, QueryProgressEvent, QueryStartedEvent, QueryTerminatedEvent,
)

KEPT = 1000  # micro-batches per stream, the latest


@dataclass(frozen=True)
class MicroBatch:
    number: int
    rows: int
    milliseconds: int


class Progress(StreamingQueryListener):
    """The latest micro-batches of every stream, and why a stream ended, if it failed."""

    def __init__(self) -> None:
        self._lock = threading.Lock()
        self._batches: dict[str, list[MicroBatch]] = defaultdict(list)
        self.failures: dict[str, str] = {}

    def batches(self, stream: str) -> list[MicroBatch]:
        with self._lock:
            return list(self._batches[stream])

    def onQueryStarted(self, event: QueryStartedEvent) -> None:  # noqa: N802 - named by Spark
        pass

    def onQueryProgress(self, event: QueryProgressEvent) -> None:  # noqa: N802
        told = event.progress
        batch = MicroBatch(told.batchId, told.numInputRows, told.batchDuration)
        with self._lock:
            kept = self._batches[str(told.id)]
            kept.append(batch)
            del kept[:-KEPT]

    def onQueryIdle(self, event: QueryIdleEvent) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event: QueryTerminatedEvent) -> None:  # noqa: N802
        if event.exception:
            with self._lock:
                self.failures[str(event.id)] = event.exception


@contextmanager
def watching(spark: SparkSession) -> Iterator[Progress]:
    """Follow the streams of a session for as long as the block runs."""
    progress = Progress()
    spark.streams.addListener(progress)
    try:
        yield progress
    finally:
        spark.streams.removeListener(progress)
