"""A limit on rejects: a feed that turns bad stops its job instead of filling the rejects.

Jobs observe how many lines of a batch there were and how many were rejected. The listener adds these up, and stops the job when the share
of rejects is above a limit, over the newest `lines` lines or more. The batch that tipped the balance is committed, with its rejects stored;
a job that is started again goes on after it, with the count begun anew.
"""

from __future__ import annotations

import threading
from collections import deque
from dataclasses import dataclass, field

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener


@dataclass
class _Window:
    """Counts of the newest batches: as few as hold `lines` lines."""

    lines: int
    batches: deque = field(default_factory=deque)

    def add(self, lines: int, rejected: int) -> None:
        self.batches.append((lines, rejected))
        while sum(n for n, _ in self.batches) - self.batches[0][0] >= self.lines:
            self.batches.popleft()

    def share(self) -> float | None:
        """The share of rejects; null while there are too few lines to judge."""
        total = sum(n for n, _ in self.batches)
        return sum(r for _, r in self.batches) / total if total >= max(self.lines, 1) else None


class RejectLimit(StreamingQueryListener):
    """Stops jobs whose share of rejected lines is above `share`; `stopped` holds the reason by query id.

    metric: the name under which a job observes `lines` and `rejected`. Add it with `spark.streams.addListener`.
    """

    def __init__(self, spark: SparkSession, share: float, lines: int = 1000, metric: str = "lines"):
        self.spark, self.limit, self.lines, self.metric = spark, share, lines, metric
        self.windows: dict[str, _Window] = {}
        self.stopped: dict[str, str] = {}

    def onQueryStarted(self, event) -> None:
        self.windows[str(event.id)] = _Window(self.lines)

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        counts, id = progress.observedMetrics.get(self.metric), str(progress.id)
        if counts is None or not counts.lines:
            return
        window = self.windows.setdefault(id, _Window(self.lines))
        window.add(counts.lines, counts.rejected)
        share = window.share()
        if share is not None and share > self.limit and id not in self.stopped:
            self.stopped[id] = f"{share:.1%} of the newest lines rejected, limit {self.limit:.1%}, after batch {progress.batchId}"
            # Not from this thread: stopping waits for the query, which may wait for its listeners.
            threading.Thread(target=self._stop, args=(id,), daemon=True).start()

    def _stop(self, id: str) -> None:
        query = self.spark.streams.get(id)
        if query is not None:
            query.stop()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.windows.pop(str(event.id), None)

    def check(self, query: StreamingQuery) -> None:
        """Raise if the query was stopped for its rejects."""
        if str(query.id) in self.stopped:
            raise RuntimeError(self.stopped[str(query.id)])
