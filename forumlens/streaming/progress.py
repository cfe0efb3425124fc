"""Row counts of streams as their micro-batches report them."""

from __future__ import annotations

import threading
from collections import Counter
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

WAIT_SECONDS = 60


def counted(stream: DataFrame, name: str) -> DataFrame:
    """``stream`` with its rows counted under ``name`` as they pass."""
    return stream.observe(name, F.count(F.lit(1)).alias("rows"))


class RowCounts(StreamingQueryListener):
    """Sums what ``counted`` observed in every micro-batch, by name; ``inputs`` has the rows read by each query's run.

    Events come after the fact and in order, so ``settled`` waits for the end of every query that started.
    """

    def __init__(self) -> None:
        self.rows: Counter[str] = Counter()
        self.inputs: Counter[str] = Counter()
        self._open = 0
        self._changed = threading.Condition()

    def onQueryStarted(self, event) -> None:
        with self._changed:
            self._open += 1

    def onQueryProgress(self, event) -> None:
        with self._changed:
            self.inputs[str(event.progress.runId)] += event.progress.numInputRows
            for name, row in event.progress.observedMetrics.items():
                self.rows[name] += row["rows"]

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self._changed:
            self._open -= 1
            self._changed.notify_all()

    def settled(self) -> bool:
        with self._changed:
            return self._changed.wait_for(lambda: not self._open, WAIT_SECONDS)


@contextmanager
def row_counts(spark: SparkSession) -> Iterator[RowCounts]:
    """Counts of the streams that run inside; complete after the block, which waits for their last events."""
    listener = RowCounts()
    spark.streams.addListener(listener)
    try:
        yield listener
        if not listener.settled():
            raise TimeoutError("a stream inside the block has not ended")
    finally:
        spark.streams.removeListener(listener)
