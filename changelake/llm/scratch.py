"""Folders for intermediate tables that every executor can see."""

from __future__ import annotations

import atexit
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..shared import shared_dir

#: While a table is written: shuffle files go as soon as the write that made them is done.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class Scratch:
    """Intermediate Parquet tables of one query. Written tables cut lineage and survive the loss of executors.

    The tables that a query's result still reads can't go before that is read; all go with the session (or with close()).
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
        self.n = 0
        _ROOTS.append((spark, self.root))

    def table(self, df: DataFrame, name: str = "t", by: str | None = None) -> DataFrame:
        """Writes df, in folders by the column `by` if given, and reads it back."""
        path = f"{self.root}/{self.n:03d}-{name}"
        self.n += 1
        before = self.spark.conf.get(_CLEANUP, None)
        self.spark.conf.set(_CLEANUP, "true")
        try:
            (df.write.partitionBy(by) if by else df.write).parquet(path)
        finally:
            self.spark.conf.unset(_CLEANUP) if before is None else self.spark.conf.set(_CLEANUP, before)
        out = self.spark.read.schema(df.schema).parquet(path)
        out.scratch_path = path
        return out

    def drop(self, df: DataFrame) -> None:
        """Deletes a table that table() gave and that nothing reads any more."""
        _delete(self.spark, df.scratch_path)

    def delete(self, name: str) -> None:
        """Deletes a folder beside the tables."""
        _delete(self.spark, f"{self.root}/{name}")

    def close(self) -> None:
        """Deletes all tables."""
        _delete(self.spark, self.root)


def _delete(spark: SparkSession, name: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


_ROOTS: list[tuple[SparkSession, str]] = []


@atexit.register
def _leave() -> None:
    """Scratch of sessions that still run when the program ends."""
    for spark, root in _ROOTS:
        try:
            if spark.sparkContext._jsc is not None:
                _delete(spark, root)
        except Exception:  # the session has ended: its scratch stays for whoever keeps the shared folder
            continue


#: Rows of keys that are broadcast at most.
FEW = 500_000


def among(df: DataFrame, keys: DataFrame, *cols: str) -> DataFrame:
    """The rows of df whose key is in the table `keys` (written, one row a key): broadcast where those are FEW at most, joined by shuffle beyond."""
    keys = keys.select(*cols)
    return df.join(F.broadcast(keys) if keys.count() <= FEW else keys, list(cols), "left_semi")


#: A key with more rows than this, and than the HOT_KEYS-th part of all rows, is hot; so there are at most HOT_KEYS hot keys.
HOT_ROWS = 500
HOT_KEYS = 100_000


def attach(rows: DataFrame, keyed: DataFrame, keys: list[str], n: int, how: str = "inner", times: str = "times") -> DataFrame:
    """rows (written, n of them) joined with keyed (written, one row a key, `times`: how many rows have it), without `times`.

    The hot keys' rows never leave their tasks: those few keys are broadcast. how: inner or left_semi.
    """
    limit = max(HOT_ROWS, n // HOT_KEYS)
    hot = keyed.where(F.col(times) > limit).drop(times)
    if hot.isEmpty():
        return rows.join(keyed.drop(times), keys, how)
    cold = rows.join(F.broadcast(hot.select(*keys)), keys, "left_anti").join(keyed.where(F.col(times) <= limit).drop(times), keys, how)
    return rows.join(F.broadcast(hot), keys, how).unionByName(cold)
