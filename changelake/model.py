"""Schemas of events, checkpoints and snapshot progress, and the kinds of change."""

from __future__ import annotations

from pyspark.sql import types as T

INSERT, UPDATE, DELETE, DDL = "INSERT", "UPDATE", "DELETE", "DDL"
KINDS = (INSERT, UPDATE, DELETE, DDL)

#: Columns that the engine adds to every target table.
VERSION, DELETED = "_version", "_is_deleted"

POSITION = T.StructType([T.StructField("file", T.StringType()), T.StructField("offset", T.LongType()), T.StructField("gtid", T.StringType())])

EVENT = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("op", T.StringType()),
        T.StructField("database", T.StringType()),
        T.StructField("table", T.StringType()),
        T.StructField("ts", T.TimestampType()),
        T.StructField("position", POSITION),
        T.StructField("ordinal", T.IntegerType()),
        T.StructField("data", T.MapType(T.StringType(), T.StringType())),
        T.StructField("old_data", T.MapType(T.StringType(), T.StringType())),
        T.StructField("sql", T.StringType()),
    ]
)

#: A raw log record, before rows are decoded. UPDATE rows alternate before and after images.
RAW = T.StructType(
    [
        T.StructField("event_type", T.StringType()),
        T.StructField("timestamp", T.LongType()),
        T.StructField("log_file", T.StringType()),
        T.StructField("log_pos", T.LongType()),
        T.StructField("gtid", T.StringType()),
        T.StructField("database", T.StringType()),
        T.StructField("table", T.StringType()),
        T.StructField("column_names", T.ArrayType(T.StringType())),
        T.StructField("rows", T.ArrayType(T.ArrayType(T.StringType()))),
        T.StructField("sql", T.StringType()),
    ]
)

CHECKPOINT = "id string, position_file string, position_offset bigint, position_gtid string, last_event_timestamp timestamp, created_at timestamp"
PROGRESS = "id string, status string, start_time timestamp, end_time timestamp, total_tables int, completed_tables int, failed_tables int, tables_json string, error_message string, created_at timestamp, updated_at timestamp"
TABLE_PROGRESS = "map<string, struct<database: string, table: string, status: string, total_rows: bigint, processed_rows: bigint, chunk_size: int, data_load_enabled: boolean, error: string>>"

PENDING, IN_PROGRESS, COMPLETED, SCHEMA_ONLY, FAILED = "PENDING", "IN_PROGRESS", "COMPLETED", "SCHEMA_ONLY", "FAILED"
