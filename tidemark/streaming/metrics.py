"""What running streams report: a listener whose progress events become rows for the monitoring operators."""

from __future__ import annotations

import threading
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

_SCHEMA = "timestamp long, queue string, kind string, batch long, size long, seconds double, state_rows long, state_bytes long, message string"


class QueryMetrics(StreamingQueryListener):
    """Rows of progress, ends and failures of all streams of a session, one an event.

    A row has the stream's name as ``queue``, the rows of a batch as ``size``
    and what its state holds; ``kind`` is progress, ended or failed. They suit
    ``queue_peaks`` and ``failure_counts``. :meth:`flush` appends what has come
    in since to a folder of JSON lines, so that the driver holds few events.
    """

    def __init__(self, spark: SparkSession):
        self._spark, self._lock = spark, threading.Lock()
        self._rows: list[tuple] = []
        self._names: dict[str, str] = {}
        spark.streams.addListener(self)

    def onQueryStarted(self, event) -> None:
        self._names[str(event.id)] = event.name or str(event.id)

    def onQueryProgress(self, event) -> None:
        p = event.progress
        at = int(datetime.fromisoformat(p.timestamp.replace("Z", "+00:00")).timestamp() * 1000)
        held, size = sum(s.numRowsTotal for s in p.stateOperators), sum(s.memoryUsedBytes for s in p.stateOperators)
        self._add((at, p.name or str(p.id), "progress", p.batchId, p.numInputRows, p.batchDuration / 1000, held, size, None))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        failed = event.exception is not None
        now = int(datetime.now().timestamp() * 1000)
        self._add((now, self._names.pop(str(event.id), str(event.id)), "failed" if failed else "ended", None, 0, None, None, None, event.exception[:4000] if failed else None))

    def _add(self, row: tuple) -> None:
        with self._lock:
            self._rows.append(row)

    def rows(self) -> DataFrame:
        """The events that are not flushed yet."""
        with self._lock:
            return self._spark.createDataFrame(list(self._rows), _SCHEMA)

    def flush(self, path: str) -> int:
        """Appends the events to the folder and forgets them; returns how many."""
        with self._lock:
            rows, self._rows = self._rows, []
        if rows:
            self._spark.createDataFrame(rows, _SCHEMA).coalesce(1).write.mode("append").json(path)
        return len(rows)

    def stop(self) -> None:
        self._spark.streams.removeListener(self)


def stored_metrics(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(_SCHEMA).json(path)


def state_peaks(metrics: DataFrame) -> DataFrame:
    """(queue, peak_size, peak_state_rows, batches, failures) of every stream."""
    of = lambda kind: F.count_if(F.col("kind") == kind)
    return metrics.groupBy("queue").agg(F.max("size").alias("peak_size"), F.max("state_rows").alias("peak_state_rows"), of("progress").alias("batches"), of("failed").alias("failures"))
