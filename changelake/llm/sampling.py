"""Bounded samples for fitting models, and the folds of the queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Hashes lie in [0, SPACE).
SPACE = 1 << 62


def place(*by: str) -> Column:
    """A row's place in the sampling order: a 62-bit hash of the columns `by`."""
    return F.shiftrightunsigned(F.xxhash64(*by), 2)


def threshold(bound: int, n: int) -> int:
    """Rows of `n` with places below this are about twice `bound`, whatever n is; all, where there are no more than that."""
    return SPACE if n <= 2 * bound else max(1, SPACE * 2 * bound // n)


def bounded_sample(df: DataFrame, by: list[str], bound: int, n: int | None = None) -> DataFrame:
    """The `bound` rows with the least places, in that order (all rows, where there are no more), whatever the partitioning.

    n: the number of rows, where it is known; it need not be exact. A filter on the place first leaves about twice as many rows as are
    wanted; an ordered limit, which is exact however often a row repeats, takes the rest off. `by` should hold the id and the content, so
    that rows that repeat an id, or have none, are spread.
    """
    picked = df.withColumn("__place", place(*by))
    limit = threshold(bound, df.count() if n is None else n)
    if limit < SPACE:
        picked = picked.where(F.col("__place") < F.lit(limit))
    return picked.orderBy("__place", *by).limit(bound).drop("__place")


def bounded_sample_by(df: DataFrame, key: str, by: list[str], bound: int, counts: dict[str, int]) -> DataFrame:
    """Likewise `bound` rows of each value of `key`; counts: about how many rows each value has. Other values are left out."""
    if not counts:
        return df.limit(0)
    limits = F.create_map(*[F.lit(x) for value, n in counts.items() for x in (value, threshold(bound, n))])
    picked = df.withColumn("__place", place(*by)).where(F.col("__place") < F.element_at(limits, F.col(key)))
    order = Window.partitionBy(key).orderBy("__place", *by)
    return picked.withColumn("__rank", F.row_number().over(order)).where(F.col("__rank") <= bound).drop("__place", "__rank")


def fold(id_col: str, n: int) -> Column:
    """crc32 of the id as text, modulo n; -1 for a null id, which is in no fold."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % n, F.lit(-1).cast("long"))
