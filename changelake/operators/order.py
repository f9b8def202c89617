"""Order of log positions, and running numbers over a log without one task that sees a whole key."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Type of a place in the order of events: log files by prefix and number, then offset, ordinal, and part (a tombstone of an old key comes
#: before the new row).
SEQ = "struct<prefix: string, number: decimal(38,0), offset: bigint, ordinal: int, part: int>"


def file_key(name: str) -> tuple[str, int, str]:
    """Log files in order: log.9 before log.10."""
    m = re.search(r"[0-9]+$", name)
    return (name[: m.start()], int(m[0]), name) if m else (name, -1, name)


def sequence(file: Column, offset: Column, ordinal: Column, part: Column) -> Column:
    number = F.coalesce(F.regexp_extract(file, "([0-9]{1,38})$", 1).try_cast("decimal(38,0)"), F.lit(-1).cast("decimal(38,0)"))
    return F.struct(F.regexp_replace(file, "[0-9]+$", "").alias("prefix"), number.alias("number"), offset.alias("offset"), ordinal.cast("int").alias("ordinal"), part.cast("int").alias("part"))


def running_sum(log: DataFrame, keys: list[str], order: list[str], part: Column, value: Column, out: str) -> DataFrame:
    """Adds the sum of `value` over a key's rows up to and with each row.

    part: a coarse value that never falls in the order, such as the minute. Sums within a part are windows; the parts' totals, of which there
    are few, are summed up by key. So a task sees a key's rows of one part, and a key may hold all rows of the log.
    """
    log = log.withColumns({"__part": part, "__value": value.cast("bigint")})
    totals = log.groupBy(*keys, "__part").agg(F.sum("__value").alias("__total"))
    upto = Window.partitionBy(*keys).orderBy("__part").rowsBetween(Window.unboundedPreceding, 0)
    before = totals.select(*keys, "__part", (F.sum("__total").over(upto) - F.col("__total")).alias("__before"))
    within = Window.partitionBy(*keys, "__part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    rows = log.withColumn("__within", F.sum("__value").over(within))
    on = [F.col(f"r.{c}").eqNullSafe(F.col(f"b.{c}")) for c in [*keys, "__part"]]
    joined = rows.alias("r").join(before.alias("b"), on)
    return joined.select("r.*", (F.col("r.__within") + F.col("b.__before")).alias(out)).drop("__part", "__value", "__within")


def minute(ts: str, seconds: int = 60) -> Column:
    """A part for running_sum: the minute, or another span, of a time."""
    return F.floor(F.unix_micros(F.col(ts).cast("timestamp")) / F.lit(seconds * 1_000_000)).cast("bigint")
