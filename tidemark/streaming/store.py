"""A streaming sink: segments by query and batch, rejects aside, first row of a key kept, days finalised by compaction."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.monitoring import with_retries
from tidemark.operators.ordering import dedup_first
from tidemark.operators.quality import utc_day
from tidemark.registry import SPECS, complete, conform
from tidemark.sources import parse, storage


class StoreSink:
    """Writes one dataset of a stream below ``root``, for ``foreachBatch``.

    A segment is named by its query's id, which a checkpoint keeps, and its
    batch's number: a batch that is run again after a failure overwrites its
    own segment, and no other query's. Rows whose key an earlier batch or the
    final files of the same days hold are dropped; with ``look_up=False`` that
    is left to a bounded memory ahead of the sink
    (:func:`tidemark.streaming.stateful.recent_keys`) and to compaction, and no
    stored row is read. Late rows are taken and merged into their day when it is
    finalised again. Incomplete rows go to ``_rejects``.

    With ``parser``, one of :mod:`tidemark.sources.parse`, batches are payloads:
    each is parsed once and gives a row or, with its text and the reason, a
    reject. ``counted`` is what the last batch's observation says of both.
    """

    def __init__(self, name: str, root: str, arrival: tuple[str, ...] = ("received_at",), look_up: bool = True, parser: Callable[..., DataFrame] | None = None, fields: Sequence[str] = ()):
        if not SPECS[name].writable:
            raise ValueError(f"{name} is read-only")
        self.name, self.root, self.spec = name, root, SPECS[name]
        self._order = [c for c in arrival if any(f.name == c for f in self.spec.schema)] or [self.spec.time]
        self.failures = 0
        self._look_up, self._parser, self._fields = look_up, parser, fields
        self.counted: dict[str, int] = {}

    def __call__(self, batch: DataFrame, number: int) -> None:
        spark, spec = batch.sparkSession, self.spec
        segment = f"{spark.sparkContext.getLocalProperty('sql.streaming.queryId') or 'direct'}-{number}"
        kept = parsed = None
        if self._parser is not None:
            seen = Observation()
            parsed = parse.count_reasons(self._parser(batch, rejects=True), seen, self._fields).persist()
            batch, kept = parse.split(parsed)
        rows = conform(batch, spec).withColumn("date", utc_day(F.col(spec.time))).persist()
        try:
            good, bad = complete(rows, spec)
            fresh = dedup_first(storage._keyed(good, self.name), spec.key, self._order)
            if self._look_up and (days := [r.date for r in good.select("date").distinct().collect()]):  # the days of one batch
                fresh = self._unknown(spark, fresh, days, segment)
            parts = storage.partition_columns(self.name)
            columns = [*spec.schema.names, "date"]
            fresh.select(*columns).repartition(*parts).write.mode("overwrite").partitionBy(*parts).parquet(f"{self.root}/_segments/{spec.directory}/batch={segment}")
            (bad if kept is None else kept).write.mode("overwrite").parquet(f"{self.root}/_rejects/{spec.directory}/batch={segment}")
            if kept is not None:
                self.counted = seen.get
        finally:
            rows.unpersist()
            if parsed is not None:
                parsed.unpersist()

    def _unknown(self, spark: SparkSession, fresh: DataFrame, days: list[date], segment: str) -> DataFrame:
        """Rows whose key is not stored yet; only the partitions of their days are read, the batch's own segment aside."""
        held = []
        if storage._children(spark, f"{self.root}/{self.spec.directory}"):
            held.append(spark.read.parquet(f"{self.root}/{self.spec.directory}"))
        if (recent := storage.segments(spark, self.name, self.root)) is not None:
            held.append(recent.where(F.col("batch") != segment).drop("batch"))
        for table in held:
            known = storage._keyed(table.where(F.col("date").isin(days)), self.name).select(*[F.col(k).alias(f"_{k}") for k in self.spec.key])
            same = F.lit(True)
            for k in self.spec.key:
                same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
            fresh = fresh.join(known, same, "left_anti")
        return fresh

    def finalize(self, spark: SparkSession, before: date | None = None, sleep: Callable[[float], None] = time.sleep) -> int:
        """Compacts every partition that has segments, of days before ``before`` if given; retried, counted if it fails. Returns the rows."""
        recent = storage.segments(spark, self.name, self.root)
        if recent is None:
            return 0
        wanted = recent if before is None else recent.where(F.col("date") < F.lit(before))
        try:
            return with_retries(lambda: storage.compact(spark, self.name, self.root, wanted, tuple(self._order)), sleep)
        except Exception:
            self.failures += 1
            raise

    def start(self, stream: DataFrame, checkpoint: str, seconds: float | None = None) -> StreamingQuery:
        """Starts the stream after recovery; ``seconds`` is the age at which a segment is written, without it all there is is taken and the query ends."""
        storage.recover(stream.sparkSession, self.root)
        writer = stream.writeStream.foreachBatch(self).option("checkpointLocation", checkpoint)
        return (writer.trigger(availableNow=True) if seconds is None else writer.trigger(processingTime=f"{seconds} seconds")).start()

    def close(self, query: StreamingQuery) -> int:
        """Takes in what has arrived, stops, finalises all days; raises if a compaction failed."""
        spark = query.sparkSession if hasattr(query, "sparkSession") else SparkSession.active()
        if query.isActive:
            query.processAllAvailable()
            query.stop()
        rows = self.finalize(spark)
        if self.failures:
            raise RuntimeError(f"{self.failures} compactions failed")
        return rows
