"""What the micro-batches of streaming queries report while they run."""

from __future__ import annotations

import threading
from collections import defaultdict

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener


class BatchCounts(StreamingQueryListener):
    """Collects the observed metrics and the late rows of every micro-batch.

    Used as a context, it listens to the session; ``wait`` returns when a query has ended and all its
    batches have been reported. A batch that did nothing reports nothing. What is kept is one row of
    numbers per batch of the run.
    """

    def __init__(self, spark: SparkSession):
        self._spark = spark
        self._progress: dict[str, list[tuple[int, dict[str, dict], int]]] = defaultdict(list)
        self._ended: dict[str, threading.Event] = defaultdict(threading.Event)

    def __enter__(self) -> BatchCounts:
        self._spark.streams.addListener(self)
        return self

    def __exit__(self, *failure) -> None:
        self._spark.streams.removeListener(self)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        observed = {name: row.asDict() for name, row in p.observedMetrics.items()}
        late = sum(s.numRowsDroppedByWatermark for s in p.stateOperators)
        self._progress[str(p.runId)].append((p.batchId, observed, late))

    def onQueryTerminated(self, event) -> None:
        self._ended[str(event.runId)].set()

    def wait(self, query: StreamingQuery, seconds: float = 60) -> None:
        query.awaitTermination()
        # Reports come after the batches, in order, and the end comes last.
        if not self._ended[str(query.runId)].wait(seconds):
            raise TimeoutError("the reports of the stream did not arrive")

    def observed(self, query: StreamingQuery, name: str) -> list[tuple[int, dict]]:
        """(batch, metrics) of the observation ``name``, one entry per batch."""
        found = {b: seen[name] for b, seen, _ in self._progress[str(query.runId)] if name in seen}
        return sorted(found.items())

    def late(self, query: StreamingQuery) -> int:
        """Rows that were older than the watermark."""
        return sum(late for _, _, late in self._progress[str(query.runId)])
