"""Metrics of batches and queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener


def observed(events: DataFrame, name: str = "events") -> tuple[DataFrame, Observation]:
    """events with counts taken while they pass."""
    seen = Observation(name)
    return events.observe(seen, F.count("*").alias("processed"), F.count_if(F.col("op") == "DDL").alias("schema_changes"), F.max("ts").alias("last_ts")), seen


def lag_seconds(last: Column, now: Column) -> Column:
    return (F.unix_micros(now.cast("timestamp")) - F.unix_micros(last.cast("timestamp"))) / F.lit(1e6)


class Progress(StreamingQueryListener):
    """Totals over all batches of the queries of a session."""

    def __init__(self) -> None:
        self.batches = self.rows = self.failures = 0
        self.rows_per_second = 0.0

    def onQueryStarted(self, event) -> None:
        """Nothing to count yet."""

    def onQueryProgress(self, event) -> None:
        self.batches += 1
        self.rows += event.progress.numInputRows
        self.rows_per_second = event.progress.processedRowsPerSecond or 0.0

    def onQueryIdle(self, event) -> None:
        """An idle trigger is no batch."""

    def onQueryTerminated(self, event) -> None:
        self.failures += event.exception is not None
