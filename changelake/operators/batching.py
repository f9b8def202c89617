"""Groups, batches, order and segments of a change log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .order import running_sum


def by_table_and_kind(log: DataFrame, table: str, op: str, position: str) -> DataFrame:
    return log.groupBy(table, op).agg(F.count("*").alias("n"), F.min(position).alias("first_position"), F.max(position).alias("last_position"))


def count_batches(log: DataFrame, table: str, order: list[str], size: int, part: Column) -> DataFrame:
    """Adds batch_no: batches of `size` rows of a table, in order. part: as in running_sum, such as the minute of the first order column."""
    return running_sum(log, [table], order, part, F.lit(1), "__n").withColumn("batch_no", F.floor((F.col("__n") - 1) / size).cast("bigint")).drop("__n")


def time_batches(log: DataFrame, ts: str, every: str) -> DataFrame:
    """Rows for each tumbling window of the time."""
    return log.groupBy(F.window(F.col(ts).cast("timestamp"), every).alias("w")).agg(F.count("*").alias("n")).select(F.col("w.start").cast("timestamp_ntz").alias("batch_start"), "n")


def fifo(log: DataFrame, table: str, order: list[str], part: Column) -> DataFrame:
    """Adds seq: the place of a row among its table's rows."""
    return running_sum(log, [table], order, part, F.lit(1), "seq")


def segments(log: DataFrame, table: str, order: list[str], is_ddl: Column, part: Column) -> DataFrame:
    """Adds segment: the number of schema changes of the table up to and with the row."""
    return running_sum(log, [table], order, part, is_ddl, "segment")


def buffered(log: DataFrame, table: str) -> DataFrame:
    """Rows of each table that wait, and of all."""
    return log.groupBy(table).agg(F.count("*").alias("n")).withColumn("total", F.sum("n").over(Window.partitionBy(F.lit(0))).cast("bigint"))


def handoff(batches: DataFrame, batch: Column, workers: int) -> DataFrame:
    """Adds worker: batches go round to the workers in turn."""
    return batches.withColumn("worker", F.pmod(batch, F.lit(workers)).cast("int"))


def backoff_seconds(n: Column, cap: float = 30.0) -> Column:
    """Exponential delay before retry n."""
    return F.least(F.pow(F.lit(2.0), n.cast("double")), F.lit(cap))


def linear_delay_seconds(attempt: Column, base: float, cap: float = 300.0) -> Column:
    return F.least(attempt.cast("double") * F.lit(base), F.lit(cap))
