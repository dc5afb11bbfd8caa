"""Streaming query listener that accumulates observed metrics per query.

``lastProgress`` only covers the last micro-batch; this listener adds up the
``observedMetrics`` of every batch (expectation counters) and keeps one
progress row per batch for the refresh ledger.
"""

from __future__ import annotations

import threading
import time
from collections import defaultdict

from pyspark.sql.streaming import StreamingQueryListener


class MetricsListener(StreamingQueryListener):
    def __init__(self):
        self._lock = threading.Lock()
        self.totals: dict[str, dict[str, int]] = defaultdict(lambda: defaultdict(int))
        self.batches: list[dict] = []

    def onQueryStarted(self, event):  # noqa: N802 - Spark's callback names
        pass

    def onQueryProgress(self, event):  # noqa: N802
        p = event.progress
        with self._lock:
            self.batches.append({"name": p.name, "batch_id": p.batchId,
                                 "rows": p.numInputRows, "timestamp": p.timestamp,
                                 "observed": {k: v.asDict() for k, v in (p.observedMetrics or {}).items()}})
            for obs_name, row in (p.observedMetrics or {}).items():
                for k, v in row.asDict().items():
                    if isinstance(v, (int, float)):
                        self.totals[obs_name][k] += v

    def onQueryIdle(self, event):  # noqa: N802
        pass

    def onQueryTerminated(self, event):  # noqa: N802
        pass

    def batch_count(self, query_name: str) -> int:
        with self._lock:
            return sum(1 for b in self.batches if b["name"] == query_name)

    def batches_of(self, query_name: str) -> list[dict]:
        with self._lock:
            return [dict(b) for b in self.batches if b["name"] == query_name]

    def metrics(self, obs_name: str) -> dict[str, int]:
        with self._lock:
            return dict(self.totals.get(obs_name, {}))


_LISTENERS: dict[int, MetricsListener] = {}


def metrics_listener(spark) -> MetricsListener:
    """One listener per session, registered on first use."""
    key = id(spark)
    if key not in _LISTENERS:
        lst = MetricsListener()
        spark.streams.addListener(lst)
        _LISTENERS[key] = lst
    return _LISTENERS[key]


def run_batches(spark, query, listener: MetricsListener) -> list[dict]:
    """Per-batch rows and observed metrics of a finished query run.

    ``recentProgress`` is complete and synchronous while a run has fewer
    batches than Spark keeps (``spark.sql.streaming.numRecentProgressUpdates``);
    longer runs are read from the listener, waiting for its asynchronous
    events of the batches that carried data.
    """
    keep = int(spark.conf.get("spark.sql.streaming.numRecentProgressUpdates", "100"))
    progress = query.recentProgress
    if len(progress) < keep - 1:                # Spark drops one before it adds one
        return [{"batch_id": p["batchId"], "rows": int(p["numInputRows"]),
                 "observed": {k: (v.asDict() if hasattr(v, "asDict") else dict(v))
                              for k, v in (p["observedMetrics"] or {}).items()}}
                for p in progress]
    expected = {p["batchId"] for p in progress if p["numInputRows"] > 0}
    for _ in range(600):
        if expected <= {b["batch_id"] for b in listener.batches_of(query.name)}:
            break
        time.sleep(0.05)
    else:
        raise TimeoutError(f"batches of {query.name} not reported; its rows are stored, its counts are not known")
    return [{"batch_id": b["batch_id"], "rows": int(b["rows"]), "observed": b["observed"]}
            for b in listener.batches_of(query.name)]
