"""Counters of a running job: observed while rows pass, so that they cost no second scan."""

from __future__ import annotations

import threading
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener


def counters(**conditions: Column) -> dict[str, Column]:
    """n, and the number of rows under each condition; a null condition does not count."""
    return {"n": F.count(F.lit(1)), **{name: F.count_if(F.coalesce(c, F.lit(False))) for name, c in conditions.items()}}


def counted(df: DataFrame, name: str, metrics: Mapping[str, Column]) -> tuple[DataFrame, Observation]:
    """IN4: df, and an observation that holds the metrics once an action over df has ended. The metrics are aggregates that
    tasks keep while rows pass; observation.get waits for the action. A plan that stops early (a limit behind it) counts
    what has passed."""
    observation = Observation(name)
    return df.observe(observation, *[c.alias(k) for k, c in metrics.items()]), observation


class Progress(StreamingQueryListener):
    """IN4: the metrics of streams by name, batch by batch, and their sums so far.

    A stream's frame names them with observe(name, ...). Register with spark.streams.addListener; batches come in as they
    end. A batch that is reported again after a restart replaces its earlier report.
    """

    def __init__(self) -> None:
        self._lock = threading.Lock()
        self._batches: dict[str, dict[int, dict[str, object]]] = {}

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        with self._lock:
            for name, row in event.progress.observedMetrics.items():
                self._batches.setdefault(name, {})[event.progress.batchId] = row.asDict()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def batches(self, name: str) -> dict[int, dict[str, object]]:
        with self._lock:
            return dict(self._batches.get(name, {}))

    def totals(self, name: str) -> dict[str, float]:
        """Sums of the metrics over all batches, for counters."""
        out: dict[str, float] = {}
        for row in self.batches(name).values():
            for k, v in row.items():
                out[k] = out.get(k, 0) + (v or 0)
        return out
