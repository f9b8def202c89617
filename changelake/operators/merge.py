"""Current state of an append-only change log: the newest version of each key, less soft deletes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..model import DELETED, DELETE, INSERT, VERSION


def version_ns(ts: Column) -> Column:
    """Nanoseconds since the epoch."""
    return F.unix_micros(ts.cast("timestamp")) * F.lit(1000)


def latest(log: DataFrame, keys: list[str], version: list[str]) -> DataFrame:
    """The row of each key that is last by the version columns. Catalyst plans a WindowGroupLimit before the exchange, so each task sends one row of a key."""
    newest = Window.partitionBy(*keys).orderBy(*[F.col(v).desc_nulls_last() for v in version])
    return log.withColumn("__rn", F.row_number().over(newest)).where("__rn = 1").drop("__rn")


def current(log: DataFrame, keys: list[str], version: list[str], deleted: Column | None = None) -> DataFrame:
    """latest() without rows that are deleted. Deletes are dropped after the choice, never before."""
    gone = F.col(DELETED) == 1 if deleted is None else deleted
    return latest(log, keys, version).where(~F.coalesce(gone, F.lit(False)))


def soft_deletes(events: DataFrame) -> DataFrame:
    """Adds _is_deleted; a delete without new values keeps the old ones."""
    gone = F.col("op") == DELETE
    data = F.coalesce("data", F.when(gone, F.coalesce("old_data", F.create_map().cast("map<string,string>"))))
    return events.withColumn("data", data).withColumn(DELETED, gone.cast("smallint"))


def key_change_tombstones(events: DataFrame, keys: list[str]) -> DataFrame:
    """events with a delete of the old key before each update that changes the key, at the same position."""
    moved = F.lit(False)
    for k in keys:
        moved = moved | ~F.col("old_data")[k].eqNullSafe(F.col("data")[k])
    gone = events.where((F.col("op") == "UPDATE") & F.col("old_data").isNotNull() & moved)
    gone = gone.withColumns({"op": F.lit(DELETE), "data": F.lit(None).cast(events.schema["data"].dataType), "id": F.concat("id", F.lit(":old"))})
    return events.unionByName(gone)


def snapshot_and_changes(snapshot: DataFrame, changes: DataFrame, keys: list[str], version: list[str]) -> DataFrame:
    """Current state where any change beats the snapshot's row; columns that one side lacks are NULL."""
    base = snapshot.withColumns({"__class": F.lit(0), "op": F.lit(INSERT)})
    both = base.unionByName(changes.withColumn("__class", F.lit(1)), allowMissingColumns=True)
    return current(both, keys, ["__class", *version], F.col("op") == DELETE).drop("__class")


def project(events: DataFrame, columns: dict[str, str], *, ts: str = "ts") -> DataFrame:
    """Typed target columns from the data map, by name; NULL where a row lacks one; others are dropped; version and delete flag filled in."""
    from ..functions.types import convert

    out = [convert(F.col("data")[c], kind).alias(c) for c, kind in columns.items() if c not in (VERSION, DELETED)]
    version = F.coalesce(F.col("data")[VERSION].try_cast("bigint"), version_ns(F.col(ts))).alias(VERSION)
    gone = F.coalesce(F.col("data")[DELETED].try_cast("smallint"), F.col(DELETED) if DELETED in events.columns else F.lit(None), F.lit(0)).cast("smallint").alias(DELETED)
    return events.select(*out, version, gone)
