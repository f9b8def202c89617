"""Checkpoints and snapshot progress: append-only tables, read by newest version."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from ..model import CHECKPOINT, PROGRESS
from .merge import latest
from .order import minute, running_sum


def newest(df: DataFrame, created: str, n: int = 100, tie: str | None = None) -> DataFrame:
    """The n newest rows; 100 where n isn't positive."""
    return df.orderBy(F.desc(created), *([F.desc(tie)] if tie else [])).limit(n if n > 0 else 100)


def by_id(df: DataFrame, id_col: str, value) -> DataFrame:
    return df.where(F.col(id_col) == F.lit(value)).limit(1)


def retained(df: DataFrame, created: str, keep: str, now: Column | None = None) -> DataFrame:
    """Rows younger than the interval, counted from `now` or the newest row; the newest always stays."""
    last = df.agg(F.max(created).alias("__last"))  # one row
    return df.crossJoin(F.broadcast(last)).where((F.col(created) >= (F.col("__last") if now is None else now) - F.expr(f"INTERVAL {keep}")) | (F.col(created) == F.col("__last"))).drop("__last")


def trigger(log: DataFrame, order: list[str], ts: str, events: int = 1000, seconds: int = 30) -> DataFrame:
    """Rows at which a checkpoint falls due: each `events`-th one, or the first in a new span of `seconds`."""
    span = minute(ts, seconds)
    numbered = running_sum(log, [], order, span, F.lit(1), "event_no").withColumn("__span", span)
    first = numbered.groupBy("__span").agg(F.min("event_no").alias("__first"))  # in its span
    due = numbered.join(first, "__span").where((F.col("event_no") % events == 0) | ((F.col("event_no") == F.col("__first")) & (F.col("event_no") > 1)))
    return due.drop("__span", "__first")


class StateStore:
    """Tables `checkpoints` and `progress` in a shared folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _read(self, name: str, schema: str) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(f"{self.root}/{name}")
        except AnalysisException as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
            return self.spark.createDataFrame([], schema)

    def save_checkpoint(self, file: str, offset: int, gtid: str | None = None, last_event=None) -> str:
        ident = str(uuid.uuid4())
        row = self.spark.createDataFrame([(ident, file, offset, gtid, last_event)], "id string, position_file string, position_offset bigint, position_gtid string, last_event_timestamp timestamp")
        row.withColumn("created_at", F.current_timestamp()).coalesce(1).write.mode("append").parquet(f"{self.root}/checkpoints")
        return ident

    def checkpoints(self) -> DataFrame:
        return self._read("checkpoints", CHECKPOINT)

    def latest_checkpoint(self):
        return newest(self.checkpoints(), "created_at", 1, "position_offset").first()

    def save_progress(self, **row) -> None:
        names = [f.split()[0] for f in PROGRESS.split(", ")]
        df = self.spark.createDataFrame([tuple(row.get(n) for n in names)], PROGRESS)
        df.withColumns({"created_at": F.coalesce("created_at", F.current_timestamp()), "updated_at": F.current_timestamp()}).coalesce(1).write.mode("append").parquet(f"{self.root}/progress")

    def progress(self) -> DataFrame:
        """Newest version of each snapshot."""
        return latest(self._read("progress", PROGRESS), ["id"], ["updated_at"])

    def latest_progress(self):
        return newest(self.progress(), "created_at", 1, "id").first()

    def list_progress(self, n: int = 100) -> DataFrame:
        """The n newest snapshots, each in its newest version."""
        return newest(self.progress(), "created_at", n, "id")

    def has_completed_snapshot(self) -> bool:
        return not self.progress().where("status = 'COMPLETED'").isEmpty()

    def expire(self, keep: str) -> DataFrame:
        """What remains of the checkpoints after retention; written anew by compaction."""
        return retained(self.checkpoints(), "created_at", keep, F.current_timestamp())
