"""Raw log records to events: one row for each changed row, in log order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..model import DDL, DELETE, INSERT, UPDATE

#: Statements that only open or close a transaction.
TRANSACTION = ("BEGIN", "COMMIT", "ROLLBACK")
ROW_EVENTS = {"WRITE_ROWS": INSERT, "UPDATE_ROWS": UPDATE, "DELETE_ROWS": DELETE}


def is_transaction_control(sql: Column) -> Column:
    up = F.upper(F.trim(sql))
    return up.isin(*TRANSACTION) | up.startswith("SAVEPOINT ")


#: Why a row can't be decoded.
UNNAMED = "row values without column names; full row metadata is needed"


def is_named(names: Column, values: Column) -> Column:
    """Whether there are names, and at least as many as values."""
    return F.coalesce((F.size(names) > 0) & (F.size(values) <= F.size(names)), F.lit(False))


def row_map(names: Column, values: Column) -> Column:
    """Column names to values; fewer values than names give a partial map; NULL where values aren't named."""
    return F.when(is_named(names, values), F.map_from_arrays(F.slice(names, F.lit(1), F.size(values)), values))


def decode(raw: DataFrame, on_bad_row: str = "dead") -> DataFrame:
    """Events (model.EVENT and `problem`) of raw records (model.RAW).

    A row that can't be decoded is an event without data, whose `problem` says why, for the dead letters; with on_bad_row "fail" it ends the
    query.

    UPDATE records hold pairs of before and after images; a row without its pair is dropped. Records of other types, and transaction
    control, are dropped. Ids are made from the position, so that a replay gives the same ones.
    """
    op = F.lit(None).cast("string")
    for prefix, kind in ROW_EVENTS.items():
        op = F.when(F.col("event_type").startswith(prefix), kind).otherwise(op)
    op = F.when((F.col("event_type") == "QUERY") & ~F.coalesce(is_transaction_control(F.col("sql")), F.lit(True)), DDL).otherwise(op)
    raw = raw.withColumn("op", op).where("op is not null")
    none = F.lit(None).cast("array<string>")
    single = F.transform(F.col("rows"), lambda r: F.struct(F.when(F.col("op") == DELETE, r).otherwise(none).alias("old"), F.when(F.col("op") == INSERT, r).otherwise(none).alias("new")))
    pairs = F.when(F.size("rows") >= 2, F.transform(F.sequence(F.lit(1), F.floor(F.size("rows") / 2).cast("int")), lambda i: F.struct(F.element_at("rows", i * 2 - 1).alias("old"), F.element_at("rows", i * 2).alias("new")))).otherwise(F.filter(F.transform("rows", lambda r: F.struct(r.alias("old"), r.alias("new"))), lambda _: F.lit(False)))
    images = F.when(F.col("op") == UPDATE, pairs).when(F.col("op") == DDL, F.array(F.struct(none.alias("old"), none.alias("new")))).otherwise(single)
    each = raw.select("*", F.posexplode(images).alias("ordinal", "image"))
    data = F.when(F.col("image.new").isNotNull(), row_map(F.col("column_names"), F.col("image.new")))
    old = F.when(F.col("image.old").isNotNull(), row_map(F.col("column_names"), F.col("image.old")))
    problem = F.lit(None).cast("string")
    for image in ("image.old", "image.new"):
        problem = F.when(F.col(image).isNotNull() & ~is_named(F.col("column_names"), F.col(image)), UNNAMED).otherwise(problem)
    if on_bad_row == "fail":
        problem = F.when(problem.isNotNull(), F.raise_error(problem).cast("string"))
    ident = F.sha2(F.concat_ws(":", "log_file", F.col("log_pos").cast("string"), F.col("ordinal").cast("string")), 256)
    position = F.struct(F.col("log_file").alias("file"), F.col("log_pos").alias("offset"), F.col("gtid").alias("gtid"))
    return each.select(ident.alias("id"), "op", "database", F.when(F.col("op") != DDL, F.col("table")).alias("table"), F.timestamp_seconds("timestamp").alias("ts"), position.alias("position"), "ordinal", data.alias("data"), old.alias("old_data"), F.when(F.col("op") == DDL, F.col("sql")).alias("sql"), problem.alias("problem"))


def before_images(log: DataFrame, key: str, order: list[str], value: str, op: str = "op") -> DataFrame:
    """Adds old_<value> to updates: the value that the key's row before had."""
    from pyspark.sql import Window

    prior = F.lag(value).over(Window.partitionBy(key).orderBy(*order))
    return log.withColumn(f"old_{value}", F.when(F.col(op) == UPDATE, prior))
