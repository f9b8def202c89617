"""Initial snapshots: plan, pages, resume and status."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.tablefilter import TableFilter
from ..model import COMPLETED, DELETED, FAILED, IN_PROGRESS, PENDING, SCHEMA_ONLY, VERSION
from .order import running_sum

FINISHED = (COMPLETED, SCHEMA_ONLY)


def plan(tables: list[tuple[str, str, int]], tables_filter: TableFilter, skip_data: bool = False, chunk_size: int = 10_000) -> list[dict]:
    """One row for each table: every table gets its schema, filtered ones their rows too."""
    return [{"database": d, "table": t, "status": PENDING, "total_rows": n, "processed_rows": 0, "chunk_size": chunk_size, "data_load_enabled": not skip_data and tables_filter.accepts(d, t), "error": None} for d, t, n in tables]


def keyset_page(df: DataFrame, keys: list[str], after: tuple | None, n: int) -> DataFrame:
    """The n rows behind the whole key `after`, in key order; composite keys compare as tuples."""
    if after is not None:
        behind, equal = F.lit(False), F.lit(True)
        for k, v in zip(keys, after, strict=True):
            behind = behind | (equal & (F.col(k) > F.lit(v)))
            equal = equal & (F.col(k) == F.lit(v))
        df = df.where(behind)
    return df.orderBy(*keys).limit(n)


def offset_page(df: DataFrame, order: list[str], offset: int, n: int) -> DataFrame:
    return df.orderBy(*order).offset(offset).limit(n)


#: Ranges of key values that chunk_plan counts.
RANGES = 1 << 16


def chunk_plan(df: DataFrame, key: str, size: int) -> DataFrame:
    """chunk_index, start_key, end_key, n of ranges of `size` keys of a numeric key, without one task seeing all rows.

    Keys are counted in ranges of their values, counts are summed up over the ranges, and only rank within a range is a window. The range is
    reckoned in floating point, which never falls as keys grow, over any width of keys.
    """
    ends = df.agg(F.min(key).cast("double").alias("low"), F.max(key).cast("double").alias("high"))  # one row
    width = F.greatest(F.col("high") - F.col("low"), F.lit(1.0))
    part = F.least(F.floor((F.col("k").cast("double") - F.col("low")) / width * F.lit(float(RANGES))).cast("int"), F.lit(RANGES - 1))
    keyed = df.select(F.col(key).alias("k")).where("k is not null").join(F.broadcast(ends)).select("k", part.alias("part"))
    placed = running_sum(keyed, [], ["k"], F.col("part"), F.lit(1), "rn").withColumn("chunk_index", F.floor((F.col("rn") - 1) / size).cast("bigint"))
    return placed.groupBy("chunk_index").agg(F.min("k").alias("start_key"), F.max("k").alias("end_key"), F.count("*").alias("n"))


def load(df: DataFrame, version: int = 0) -> DataFrame:
    """Rows of a snapshot as change-log rows. Version 0 is older than any change."""
    return df.withColumns({VERSION: F.lit(version).cast("bigint"), DELETED: F.lit(0).cast("smallint")})


def resume(planned: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """What is still to do; what was under way starts again."""
    left = planned.join(done.select(*keys).distinct(), keys, "left_anti")
    if "status" in left.columns:
        left = left.withColumn("status", F.when(F.col("status") == IN_PROGRESS, PENDING).otherwise(F.col("status")))
    return left


def resumable(progress: DataFrame, now: Column, hours: int = 24) -> DataFrame:
    return progress.where(F.col("status").isin(PENDING, IN_PROGRESS) & (F.col("created_at") > now - F.expr(f"INTERVAL {hours} HOURS")))


def roll_up(tables: DataFrame, status: str = "status") -> DataFrame:
    """Totals by status."""
    return tables.agg(F.count("*").alias("total_tables"), F.count_if(F.col(status) == COMPLETED).alias("completed_tables"), F.count_if(F.col(status) == SCHEMA_ONLY).alias("schema_only_tables"), F.count_if(F.col(status) == FAILED).alias("failed_tables"))


def final_status(failed: int) -> str:
    return FAILED if failed else COMPLETED


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """table_name, row_count of each table; counts come from file footers where the format has them."""
    out = None
    for name, df in tables.items():
        one = df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        out = one if out is None else out.unionByName(one)
    return out
