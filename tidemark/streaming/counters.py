"""Counters that ride on streams: aggregates observed by the pass that writes a batch."""

from __future__ import annotations

import threading
from collections import defaultdict

from pyspark.sql import Column, DataFrame
from pyspark.sql.streaming import StreamingQueryListener


def counting(stream: DataFrame, name: str, **counts: Column) -> DataFrame:
    """stream, whose batches say the named aggregates over their rows to the listeners of the session."""
    return stream.observe(name, *[c.alias(n) for n, c in counts.items()])


class Counters(StreamingQueryListener):
    """Sums over batches of what streams observe, by observation and name; cycles has the value of each batch.

    spark.streams.addListener(Counters()); numbers only are summed, other values stay in the cycles.
    """

    def __init__(self) -> None:
        self.totals: dict[str, dict[str, float]] = defaultdict(lambda: defaultdict(int))
        self.cycles: dict[str, list[tuple[int, dict]]] = defaultdict(list)
        self._seen: set[tuple[str, str, int]] = set()
        self._lock = threading.Lock()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        with self._lock:
            for name, row in progress.observedMetrics.items():
                once = (name, str(progress.runId), progress.batchId)
                if once in self._seen:  # a batch may report more than once while it is idle
                    continue
                self._seen.add(once)
                values = row.asDict()
                self.cycles[name].append((progress.batchId, values))
                for key, value in values.items():
                    if isinstance(value, (int, float)) and not isinstance(value, bool):
                        self.totals[name][key] += value

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass
