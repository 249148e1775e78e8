"""What a live job does, batch by batch, and its orderly stop.

``BatchLog`` listens to all queries of a session and keeps, for each of the last
``keep`` batches of each query, the rows it read, the rows it dropped as late,
how long it took, and its lag: how far its watermark, or else its newest event,
was behind the clock. ``stop`` ends a live query between two batches.
"""

from __future__ import annotations

import datetime as dt
import threading
import time
from collections import deque
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

KEEP = 1000


@dataclass(frozen=True)
class Batch:
    batch_id: int
    rows: int
    late_rows: int
    seconds: float
    lag_seconds: float | None


def _time(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text.replace("Z", "+00:00"))


def batch_of_progress(progress) -> Batch:
    """The figures of one batch. Without event times in the query there is no lag."""
    newest = (progress.eventTime or {}).get("max") or (progress.eventTime or {}).get("watermark")
    lag = (_time(progress.timestamp) - _time(newest)).total_seconds() if newest else None
    return Batch(progress.batchId, progress.numInputRows,
                 sum(op.numRowsDroppedByWatermark for op in progress.stateOperators),
                 (progress.batchDuration or 0) / 1000, lag)


class BatchLog(StreamingQueryListener):
    """``batches[id]``: a query's last batches; ``ended[id]``: None, or why it failed."""

    def __init__(self, keep: int = KEEP):
        self.keep = keep
        self.batches: dict[str, deque[Batch]] = {}
        self.ended: dict[str, str | None] = {}
        self._lock = threading.Lock()

    def attach(self, spark: SparkSession) -> BatchLog:
        spark.streams.addListener(self)
        return self

    def detach(self, spark: SparkSession) -> None:
        spark.streams.removeListener(self)

    def onQueryStarted(self, event) -> None:
        with self._lock:
            self.batches.setdefault(str(event.id), deque(maxlen=self.keep))
            self.ended.pop(str(event.id), None)

    def onQueryProgress(self, event) -> None:
        p = event.progress
        with self._lock:
            own = self.batches.setdefault(str(p.id), deque(maxlen=self.keep))
            # An idle query reports its last batch again.
            if not own or own[-1].batch_id != p.batchId or p.numInputRows:
                own.append(batch_of_progress(p))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self._lock:
            self.ended[str(event.id)] = event.exception

    def of(self, query: StreamingQuery) -> list[Batch]:
        with self._lock:
            return list(self.batches.get(str(query.id), ()))

    def late_rows(self, query: StreamingQuery) -> int:
        return sum(b.late_rows for b in self.of(query))


def stop(query: StreamingQuery, timeout_s: float = 60, drain: bool = True) -> None:
    """Stop a live query between two batches, with ``drain`` once it has read all there is.

    A batch that is under way ends first; past ``timeout_s`` the query is stopped
    as it is, which loses nothing: the next start runs that batch again.
    """
    until = time.monotonic() + timeout_s
    while query.isActive and time.monotonic() < until:
        status = query.status
        if not status["isTriggerActive"] and not (drain and status["isDataAvailable"]):
            break
        time.sleep(0.05)
    query.stop()
    query.awaitTermination(max(1, int(until - time.monotonic()) + 1))
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
