"""Catalog of queries: each applies one operator to the star-schema tables, with the same query in SQL beside it.

In `cdc`, rows of `events` are a change log: signup is an INSERT, error a DELETE, all else an UPDATE of the user; the table is named after the
event type, the key is user_id and the version is (ts, event_id). Numbers that are summed are decimals first, so that results do not depend on
the order of rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import identifiers
from .functions import types as kinds
from .functions.tablefilter import TableFilter
from .model import DELETE, INSERT, UPDATE
from .operators import batching, decode, merge, snapshot, state
from .operators.order import minute
from .plans import registry
from .plans.ddl import parse
from .shared import shared_dir
from .sources import discovery

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}

CDC = """WITH cdc AS (SELECT event_id, ts, user_id, event_type, value, props,
    CASE event_type WHEN 'signup' THEN 'INSERT' WHEN 'error' THEN 'DELETE' ELSE 'UPDATE' END AS op, 'shop.' || event_type AS tbl FROM events)
"""


def query(sql: str | None = None, cdc: bool = False):
    def add(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = (CDC if cdc else "") + sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return discovery.read_table(spark, sf_dir, name)


def cdc(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.col("event_type")
    op = F.when(t == "signup", INSERT).when(t == "error", DELETE).otherwise(UPDATE)
    return table(spark, sf_dir, "events").withColumns({"op": op, "tbl": F.concat(F.lit("shop."), t)})


STATE = ["user_id", "event_id", "ts", "event_type", "value"]
VERSION = ["ts", "event_id"]
LATEST = "SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM cdc"


# Merge


@query(f"SELECT user_id, event_id, ts, event_type, value FROM ({LATEST}) WHERE rn = 1 AND op <> 'DELETE'", cdc=True)
def current_state(spark, sf_dir):
    return merge.current(cdc(spark, sf_dir), ["user_id"], VERSION, F.col("op") == DELETE).select(*STATE)


@query(f"SELECT user_id, event_id, ts, value, CAST(op = 'DELETE' AS INTEGER) AS is_deleted FROM ({LATEST}) WHERE rn = 1", cdc=True)
def latest_with_tombstones(spark, sf_dir):
    return merge.latest(cdc(spark, sf_dir), ["user_id"], VERSION).select("user_id", "event_id", "ts", "value", (F.col("op") == DELETE).cast("int").alias("is_deleted"))


@query("SELECT user_id, event_id, CAST(date_trunc('day', ts) AS TIMESTAMP) AS version_day FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY date_trunc('day', ts) DESC, event_id DESC) AS rn FROM cdc) WHERE rn = 1", cdc=True)
def version_tiebreak(spark, sf_dir):
    log = cdc(spark, sf_dir).withColumn("version_day", F.date_trunc("day", "ts").cast("timestamp_ntz"))
    return merge.latest(log, ["user_id"], ["version_day", "event_id"]).select("user_id", "event_id", "version_day")


@query(f"SELECT user_id, event_id, ts, event_type, value FROM ({LATEST}) WHERE rn = 1 AND op <> 'DELETE'", cdc=True)
def dedup_replay(spark, sf_dir):
    log = cdc(spark, sf_dir)
    return merge.current(log.unionByName(log), ["user_id"], VERSION, F.col("op") == DELETE).select(*STATE)


@query(
    """, moved AS (SELECT *, user_id % 100 AS new_key, (user_id + event_id) % 100 AS old_key FROM cdc WHERE op = 'UPDATE')
SELECT event_id, 'UPDATE' AS op, new_key AS key FROM moved UNION ALL SELECT event_id, 'DELETE' AS op, old_key AS key FROM moved WHERE old_key <> new_key""",
    cdc=True,
)
def pk_change_tombstone(spark, sf_dir):
    log = cdc(spark, sf_dir).where(F.col("op") == UPDATE)
    key = lambda c: F.create_map(F.lit("id"), c.cast("string"))
    events = log.select(F.col("event_id").cast("string").alias("id"), "event_id", "op", key(F.col("user_id") % 100).alias("data"), key((F.col("user_id") + F.col("event_id")) % 100).alias("old_data"))
    out = merge.key_change_tombstones(events, ["id"])
    return out.select("event_id", "op", F.coalesce("data", "old_data")["id"].cast("bigint").alias("key"))


@query(
    """, both_sides AS (
    SELECT c_custkey AS k, 0 AS cls, NULL::TIMESTAMP AS ts, NULL::BIGINT AS event_id, 'INSERT' AS op, c_name, c_acctbal, NULL::VARCHAR AS event_type FROM customer
    UNION ALL SELECT user_id, 1, ts, event_id, op, NULL, NULL, event_type FROM cdc)
SELECT k, c_name, c_acctbal, event_id, event_type FROM (
    SELECT *, row_number() OVER (PARTITION BY k ORDER BY cls DESC, ts DESC NULLS LAST, event_id DESC NULLS LAST) AS rn FROM both_sides) WHERE rn = 1 AND op <> 'DELETE'""",
    cdc=True,
)
def snapshot_union_cdc(spark, sf_dir):
    base = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), "c_name", "c_acctbal")
    changes = cdc(spark, sf_dir).select(F.col("user_id").alias("k"), "ts", "event_id", "op", "event_type")
    return merge.snapshot_and_changes(base, changes, ["k"], VERSION).select("k", "c_name", "c_acctbal", "event_id", "event_type")


@query("SELECT event_id, epoch_us(ts) * 1000 AS version_ns FROM events")
def version_ns(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", merge.version_ns(F.col("ts")).alias("version_ns"))


@query(
    """SELECT event_id, CASE WHEN event_id % 3 = 0 THEN NULL ELSE CAST(user_id AS INTEGER) END AS user_id, event_type, NULL::DATE AS created, epoch_us(ts) * 1000 AS version,
CAST(event_id % 5 = 0 AS SMALLINT) AS is_deleted FROM events"""
)
def project_fill(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    pairs = F.create_map(F.lit("event_id"), F.col("event_id").cast("string"), F.lit("event_type"), F.col("event_type"), F.lit("dropped"), F.lit("x"))
    data = F.when(F.col("event_id") % 3 == 0, pairs).otherwise(F.map_concat(pairs, F.create_map(F.lit("user_id"), F.col("user_id").cast("string"))))
    log = e.select("ts", data.alias("data"), (F.col("event_id") % 5 == 0).cast("smallint").alias("_is_deleted"))
    out = merge.project(log, {"event_id": "bigint", "user_id": "int", "event_type": "string", "created": "date"})
    return out.withColumnsRenamed({"_version": "version", "_is_deleted": "is_deleted"})


# Decoding


@query(
    """, raw AS (SELECT event_id, user_id, op, list_transform(range(event_id % 3 + 1), lambda i: user_id + i) AS ids FROM cdc),
each AS (SELECT event_id, op, unnest(ids) AS id, generate_subscripts(ids, 1) AS i, len(ids) AS n FROM raw)
SELECT event_id, op, CAST(i - 1 AS INTEGER) AS ordinal, CASE WHEN op = 'DELETE' THEN NULL ELSE id END AS new_id, CASE WHEN op = 'DELETE' THEN id END AS old_id FROM each WHERE op <> 'UPDATE'
UNION ALL SELECT a.event_id, a.op, CAST((a.i - 1) // 2 AS INTEGER), b.id, a.id FROM each a JOIN each b ON a.event_id = b.event_id AND b.i = a.i + 1 WHERE a.op = 'UPDATE' AND a.i % 2 = 1""",
    cdc=True,
)
def decode_rows(spark, sf_dir):
    log = cdc(spark, sf_dir)
    kind = F.when(F.col("op") == INSERT, "WRITE_ROWS_V2").when(F.col("op") == DELETE, "DELETE_ROWS").otherwise("UPDATE_ROWS")
    rows = F.transform(F.sequence(F.lit(0), (F.col("event_id") % 3).cast("int")), lambda i: F.array((F.col("user_id") + i).cast("string")))
    raw = log.select(
        kind.alias("event_type"), F.unix_seconds(F.col("ts").cast("timestamp")).alias("timestamp"), F.lit("log.1").alias("log_file"), F.col("event_id").alias("log_pos"), F.lit(None).cast("string").alias("gtid"), F.lit("shop").alias("database"), F.col("event_type").alias("table"), F.array(F.lit("id")).alias("column_names"), rows.alias("rows"), F.lit(None).cast("string").alias("sql")
    )
    return decode.decode(raw).select(F.col("position.offset").alias("event_id"), "op", "ordinal", F.col("data")["id"].cast("bigint").alias("new_id"), F.col("old_data")["id"].cast("bigint").alias("old_id"))


@query("SELECT event_id, op, value, CASE WHEN op = 'UPDATE' THEN lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id) END AS old_value FROM cdc", cdc=True)
def decode_before_after(spark, sf_dir):
    return decode.before_images(cdc(spark, sf_dir), "user_id", VERSION, "value").select("event_id", "op", "value", "old_value")


@query(
    """SELECT p_partkey, stmt FROM (SELECT p_partkey, CASE p_partkey % 6 WHEN 0 THEN ' begin ' WHEN 1 THEN 'COMMIT' WHEN 2 THEN 'Rollback' WHEN 3 THEN 'savepoint ' || p_brand WHEN 4 THEN 'SAVEPOINTS' ELSE 'ALTER TABLE ' || p_type END AS stmt FROM part)
WHERE NOT (upper(trim(stmt)) IN ('BEGIN', 'COMMIT', 'ROLLBACK') OR starts_with(upper(trim(stmt)), 'SAVEPOINT '))"""
)
def txn_control_filter(spark, sf_dir):
    k = F.col("p_partkey") % 6
    text = F.when(k == 0, " begin ").when(k == 1, "COMMIT").when(k == 2, "Rollback").when(k == 3, F.concat(F.lit("savepoint "), "p_brand")).when(k == 4, "SAVEPOINTS").otherwise(F.concat(F.lit("ALTER TABLE "), "p_type"))
    return table(spark, sf_dir, "part").select("p_partkey", text.alias("stmt")).where(~decode.is_transaction_control(F.col("stmt")))


# Filters and names

FILTER = TableFilter(include_tables=["shop.signup", "purchase"], include_patterns=["^shop\\.(view|cl)", "err"], exclude_tables=["shop.view"], exclude_patterns=["click$"])


@query(
    """SELECT event_id, tbl, op FROM cdc WHERE op = 'DELETE' OR (NOT (tbl IN ('shop.view') OR event_type IN ('shop.view') OR regexp_matches(tbl, 'click$') OR regexp_matches(event_type, 'click$'))
AND (tbl IN ('shop.signup', 'purchase') OR event_type IN ('shop.signup', 'purchase') OR regexp_matches(tbl, '^shop\\.(view|cl)') OR regexp_matches(event_type, '^shop\\.(view|cl)') OR regexp_matches(tbl, 'err') OR regexp_matches(event_type, 'err')))""",
    cdc=True,
)
def table_filter(spark, sf_dir):
    log = cdc(spark, sf_dir)
    bypass = F.when(F.col("op") == DELETE, "DDL").otherwise(F.col("op"))  # deletes stand for schema changes, which pass
    return log.where(FILTER.events(bypass, F.lit("shop"), F.col("event_type"))).select("event_id", "tbl", "op")


@query(
    """SELECT p_partkey, name, regexp_full_match(name, '[a-zA-Z_][a-zA-Z0-9_]*') AND length(name) BETWEEN 1 AND 255 AS valid
FROM (SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN replace(p_name, ' ', '_') WHEN p_partkey % 7 = 0 THEN repeat('a', 256) ELSE p_name || '1' END AS name FROM part)"""
)
def identifier_valid(spark, sf_dir):
    name = F.when(F.col("p_partkey") % 2 == 0, F.replace("p_name", F.lit(" "), F.lit("_"))).when(F.col("p_partkey") % 7 == 0, F.repeat(F.lit("a"), 256)).otherwise(F.concat("p_name", F.lit("1")))
    return table(spark, sf_dir, "part").select("p_partkey", name.alias("name")).withColumn("valid", identifiers.is_valid_column(F.col("name")))


@query("SELECT c_custkey, '`' || replace(replace(c_name, '0', '`'), '`', '``') || '`' AS quoted FROM customer")
def identifier_escape(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", identifiers.quote_column(F.replace("c_name", F.lit("0"), F.lit("`"))).alias("quoted"))


# Types and values

TYPE_TEXTS = ["TINYINT(1)", "tinyint(4)", "TINYINT UNSIGNED", "smallint", "SMALLINT(5) UNSIGNED", "MEDIUMINT", "int(11)", "INTEGER", "INT UNSIGNED", "BIGINT", "bigint(20) unsigned", "FLOAT", "double", "DECIMAL(10,2)", "DECIMAL(10, 2)", "decimal", "DECIMAL(65,4)", "NUMERIC(5)", "CHAR(3)", "varchar(255)", "TEXT", "TINYTEXT", "LONGTEXT", "DATE", "DATETIME(6)", "timestamp", "TIME", "YEAR(4)", "JSON", "ENUM('a', 'b c', 'D')", "SET('x','y')", "BINARY(16)", "VARBINARY(10)", "BLOB", "POINT", "BIT(1)", "BOOL", "UNKNOWN_TYPE"]


@query(
    f"""WITH t(source_type) AS (VALUES {", ".join("('" + t.replace("'", "''") + "')" for t in TYPE_TEXTS)}),
u AS (SELECT source_type, regexp_extract(upper(source_type), '^([A-Z]+)', 1) AS n, regexp_matches(upper(source_type), '\\bUNSIGNED\\b') AS un, regexp_extract(source_type, '^[A-Za-z]+\\s*\\(\\s*([^)]*)\\)', 1) AS args FROM t),
v AS (SELECT *, coalesce(try_cast(trim(split_part(args, ',', 1)) AS INTEGER), 18) AS p, CASE WHEN args = '' THEN 4 ELSE coalesce(try_cast(trim(split_part(args, ',', 2)) AS INTEGER), 0) END AS s FROM u)
SELECT source_type, CASE
WHEN n = 'TINYINT' AND trim(args) = '1' THEN 'smallint' WHEN n = 'TINYINT' THEN CASE WHEN un THEN 'smallint' ELSE 'tinyint' END
WHEN n = 'SMALLINT' THEN CASE WHEN un THEN 'int' ELSE 'smallint' END WHEN n IN ('MEDIUMINT') THEN 'int' WHEN n IN ('INT', 'INTEGER') THEN CASE WHEN un THEN 'bigint' ELSE 'int' END
WHEN n = 'BIGINT' THEN CASE WHEN un THEN 'decimal(20,0)' ELSE 'bigint' END
WHEN n IN ('DECIMAL', 'NUMERIC', 'DEC') THEN CASE WHEN p > 38 THEN 'string' ELSE 'decimal(' || p || ',' || s || ')' END
WHEN n = 'FLOAT' THEN 'float' WHEN n IN ('DOUBLE', 'REAL') THEN 'double' WHEN n IN ('BOOL', 'BOOLEAN') THEN 'smallint' WHEN n = 'BIT' THEN 'decimal(20,0)' WHEN n = 'DATE' THEN 'date'
WHEN n IN ('DATETIME', 'TIMESTAMP') THEN 'timestamp_ntz' WHEN n = 'YEAR' THEN 'int' WHEN n = 'SET' THEN 'array<string>'
WHEN n IN ('BINARY', 'VARBINARY', 'TINYBLOB', 'BLOB', 'MEDIUMBLOB', 'LONGBLOB', 'GEOMETRY', 'POINT', 'LINESTRING', 'POLYGON') THEN 'binary' ELSE 'string' END AS target_type FROM v"""
)
def type_mapping(spark, sf_dir):
    return spark.createDataFrame([(t,) for t in TYPE_TEXTS], "source_type string").withColumn("target_type", kinds.type_column(F.col("source_type")))


DEFAULTS = [("", "string", True), ("NULL", "int", True), ("NULL", "int", False), ("12", "int", True), ("abc", "bigint", True), ("1.5", "double", True), ("x", "float", True), ("it's", "string", True), ("CURRENT_TIMESTAMP", "string", True), ("CURDATE()", "date", True), ("0000-00-00", "date", True), ("2024-01-02", "date", True), ("CURRENT_TIMESTAMP(3)", "timestamp_ntz", True), ("now()", "timestamp_ntz", True), ("0000-00-00 00:00:00", "timestamp_ntz", True), ("3.20", "decimal(10,2)", True), ("(uuid())", "string", True)]
_DEFAULT_RESULTS = [None, "NULL", None, "12", "0", "1.5", "0.0", "'it\\'s'", "''", "current_date()", "DATE'1970-01-01'", "DATE'2024-01-02'", "localtimestamp()", "localtimestamp()", "TIMESTAMP_NTZ'1970-01-01 00:00:00'", "3.20", "'(uuid())'"]


def _literal(v: str | bool | None) -> str:
    return "NULL" if v is None else str(v).lower() if isinstance(v, bool) else "'" + v.replace("'", "''") + "'"


@query("SELECT * FROM (VALUES " + ", ".join(f"({_literal(a)}, {_literal(b)}, {_literal(c)}, {_literal(r)})" for (a, b, c), r in zip(DEFAULTS, _DEFAULT_RESULTS, strict=True)) + ") t(default_text, kind, nullable, default_sql)")
def default_translation(spark, sf_dir):
    rows = [(a, b, c, kinds.default_value(a, b, c)) for a, b, c in DEFAULTS]
    return spark.createDataFrame(rows, "default_text string, kind string, nullable boolean, default_sql string")


@query(
    """SELECT event_id, CASE WHEN event_id % 5 IN (0, 1) THEN TIMESTAMP '1970-01-01 00:00:00' WHEN event_id % 5 = 2 THEN NULL ELSE date_trunc('millisecond', ts) END AS converted FROM events"""
)
def datetime_convert(spark, sf_dir):
    k, text = F.col("event_id") % 5, F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    v = F.when(k == 0, "").when(k == 1, "0000-00-00 00:00:00").when(k == 2, "not a date").when(k == 3, F.replace(text, F.lit(" "), F.lit("T"))).otherwise(text)
    return table(spark, sf_dir, "events").select("event_id", kinds.to_datetime(v).alias("converted"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN DATE '1970-01-01' WHEN o_orderkey % 4 = 1 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS converted FROM orders")
def date_convert(spark, sf_dir):
    k, text = F.col("o_orderkey") % 4, F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    v = F.when(k == 0, "0000-00-00").when(k == 1, "2024-02-30").when(k == 2, text).otherwise(F.substring(text, 1, 10))
    return table(spark, sf_dir, "orders").select("o_orderkey", kinds.to_date(v).alias("converted"))


@query("SELECT l_returnflag, CAST(sum(CASE WHEN l_linenumber = 1 THEN NULL ELSE CAST(CAST(l_partkey AS VARCHAR) || '.25' AS DECIMAL(18,2)) END) AS DOUBLE) AS total, count(*) AS n FROM lineitem GROUP BY l_returnflag")
def decimal_convert(spark, sf_dir):
    text = F.when(F.col("l_linenumber") == 1, "n/a").otherwise(F.concat(F.col("l_partkey").cast("string"), F.lit(".25")))
    lines = table(spark, sf_dir, "lineitem").select("l_returnflag", kinds.convert(text, "decimal(18,2)").alias("v"))
    return lines.groupBy("l_returnflag").agg(F.sum("v").cast("double").alias("total"), F.count("*").alias("n"))


@query("SELECT s_suppkey, CAST(s_suppkey AS VARCHAR) || ':' || CAST(s_nationkey AS VARCHAR) AS text FROM supplier")
def string_convert(spark, sf_dir):
    return table(spark, sf_dir, "supplier").select("s_suppkey", kinds.convert(F.concat_ws(":", F.col("s_suppkey").cast("string"), F.col("s_nationkey").cast("string")), "string").alias("text"))


@query("SELECT event_id, CASE WHEN user_id * 100 BETWEEN -32768 AND 32767 THEN CAST(user_id * 100 AS SMALLINT) END AS small FROM events")
def integer_overflow(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", kinds.convert((F.col("user_id") * 100).cast("string"), "smallint").alias("small"))


# Groups, batches, order


@query("SELECT tbl, op, count(*) AS n, min(event_id) AS first_position, max(event_id) AS last_position FROM cdc GROUP BY tbl, op", cdc=True)
def upsert_counts(spark, sf_dir):
    return batching.by_table_and_kind(cdc(spark, sf_dir), "tbl", "op", "event_id")


@query("SELECT tbl, CAST(floor((rn - 1) / 500) AS BIGINT) AS batch_no, count(*) AS n FROM (SELECT tbl, row_number() OVER (PARTITION BY tbl ORDER BY ts, event_id) AS rn FROM cdc) GROUP BY ALL", cdc=True)
def count_batches(spark, sf_dir):
    return batching.count_batches(cdc(spark, sf_dir), "tbl", VERSION, 500, minute("ts", 3600)).groupBy("tbl", "batch_no").agg(F.count("*").alias("n"))


@query("SELECT time_bucket(INTERVAL '1 hour', ts) AS batch_start, count(*) AS n FROM events GROUP BY 1")
def time_batches(spark, sf_dir):
    return batching.time_batches(table(spark, sf_dir, "events"), "ts", "1 hour")


@query("SELECT event_id, tbl, row_number() OVER (PARTITION BY tbl ORDER BY ts, event_id) AS seq FROM cdc", cdc=True)
def fifo_order(spark, sf_dir):
    return batching.fifo(cdc(spark, sf_dir), "tbl", VERSION, minute("ts", 3600)).select("event_id", "tbl", "seq")


@query(
    """SELECT user_id, segment, count(*) AS n, min(event_id) AS first_id FROM (SELECT user_id, event_id, CAST(sum(CAST(event_type = 'signup' AS BIGINT)) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS segment FROM cdc) GROUP BY ALL""",
    cdc=True,
)
def ddl_segments(spark, sf_dir):
    return batching.segments(cdc(spark, sf_dir), "user_id", VERSION, F.col("event_type") == "signup", minute("ts", 3600)).groupBy("user_id", "segment").agg(F.count("*").alias("n"), F.min("event_id").alias("first_id"))


@query("SELECT CAST(i AS BIGINT) AS n, least(pow(2.0, i), 30.0) AS backoff, least(i * 2.5, 300.0)::DOUBLE AS linear FROM range(200) t(i)")
def retry_backoff(spark, sf_dir):
    return spark.range(200).select(F.col("id").alias("n"), batching.backoff_seconds(F.col("id")).alias("backoff"), batching.linear_delay_seconds(F.col("id"), 2.5).alias("linear"))


# Snapshots


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderkey > 1000 ORDER BY o_orderkey LIMIT 500")
def keyset_page(spark, sf_dir):
    return snapshot.keyset_page(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice"), ["o_orderkey"], (1000,), 500)


@query("SELECT conv_id, turn, role FROM conversations WHERE conv_id > 20 OR (conv_id = 20 AND turn > 1) ORDER BY conv_id, turn LIMIT 300")
def keyset_page_composite(spark, sf_dir):
    return snapshot.keyset_page(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role"), ["conv_id", "turn"], (20, 1), 300)


@query("SELECT s_suppkey, s_name FROM supplier ORDER BY s_suppkey LIMIT 40 OFFSET 30")
def offset_page(spark, sf_dir):
    return snapshot.offset_page(table(spark, sf_dir, "supplier").select("s_suppkey", "s_name"), ["s_suppkey"], 30, 40)


@query("SELECT chunk_index, min(o_orderkey) AS start_key, max(o_orderkey) AS end_key, count(*) AS n FROM (SELECT o_orderkey, CAST(floor((row_number() OVER (ORDER BY o_orderkey) - 1) / 1000) AS BIGINT) AS chunk_index FROM orders) GROUP BY chunk_index")
def chunk_plan(spark, sf_dir):
    return snapshot.chunk_plan(table(spark, sf_dir, "orders"), "o_orderkey", 1000)


TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


@query(" UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in TABLES))
def table_row_count(spark, sf_dir):
    return snapshot.row_counts({t: table(spark, sf_dir, t) for t in TABLES})


@query("SELECT c_custkey, c_name FROM customer c WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_orderstatus = 'F')")
def resume_plan(spark, sf_dir):
    done = table(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("c_custkey"))
    return snapshot.resume(table(spark, sf_dir, "customer").select("c_custkey", "c_name"), done, ["c_custkey"])


STATUS = "CASE o_orderstatus WHEN 'F' THEN 'COMPLETED' WHEN 'O' THEN 'SCHEMA_ONLY' WHEN 'P' THEN 'FAILED' END"


@query(f"SELECT count(*) AS total_tables, count(*) FILTER (s = 'COMPLETED') AS completed_tables, count(*) FILTER (s = 'SCHEMA_ONLY') AS schema_only_tables, count(*) FILTER (s = 'FAILED') AS failed_tables FROM (SELECT {STATUS} AS s FROM orders)")
def progress_rollup(spark, sf_dir):
    return snapshot.roll_up(table(spark, sf_dir, "orders").select(F.expr(STATUS).alias("status")))


@query("SELECT o_orderkey FROM orders WHERE o_orderstatus IN ('O', 'P') AND o_orderdate > (SELECT max(o_orderdate) FROM orders) - INTERVAL 720 HOUR")
def resumable_snapshots(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    orders = orders.join(F.broadcast(orders.agg(F.max("o_orderdate").alias("now"))))  # one row
    status = F.when(F.col("o_orderstatus") == "O", "PENDING").when(F.col("o_orderstatus") == "P", "IN_PROGRESS").otherwise("COMPLETED")
    return snapshot.resumable(orders.select("o_orderkey", status.alias("status"), F.col("o_orderdate").alias("created_at"), "now"), F.col("now"), 720).select("o_orderkey")


@query("SELECT name, difference FROM (SELECT coalesce(a.name, b.name) AS name, CASE WHEN b.t IS NULL THEN 'extra' WHEN a.t IS NULL THEN 'missing' WHEN a.t <> b.t THEN 'type' END AS difference FROM (SELECT p_brand AS name, CAST(max(p_size) % 3 AS VARCHAR) AS t FROM part GROUP BY 1) a FULL JOIN (SELECT p_type AS name, CAST(min(p_size) % 3 AS VARCHAR) AS t FROM part GROUP BY 1 UNION ALL SELECT p_brand, CAST(min(p_size) % 3 AS VARCHAR) FROM part GROUP BY 1) b ON a.name = b.name) WHERE difference IS NOT NULL")
def schema_diff(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    one = lambda c, f, n: part.groupBy(F.col(c).alias("name")).agg((f("p_size") % 3).cast("string").alias(n))
    return registry.differences(one("p_brand", F.max, "ours"), one("p_type", F.min, "theirs").unionByName(one("p_brand", F.min, "theirs")))


# State


@query("SELECT event_id, ts FROM events ORDER BY ts DESC, event_id DESC LIMIT 1")
def checkpoint_latest(spark, sf_dir):
    return state.newest(table(spark, sf_dir, "events").select("event_id", "ts"), "ts", 1, "event_id")


@query("SELECT event_id, ts FROM events ORDER BY ts DESC, event_id DESC LIMIT 100")
def checkpoint_list(spark, sf_dir):
    return state.newest(table(spark, sf_dir, "events").select("event_id", "ts"), "ts", 0, "event_id")


@query("SELECT event_id, event_no FROM (SELECT event_id, row_number() OVER w AS event_no, epoch_us(ts) // 30000000 AS span, lag(epoch_us(ts) // 30000000) OVER w AS prior FROM events WINDOW w AS (ORDER BY ts, event_id)) WHERE event_no % 1000 = 0 OR span <> prior")
def checkpoint_trigger(spark, sf_dir):
    return state.trigger(table(spark, sf_dir, "events"), VERSION, "ts").select("event_id", "event_no")


@query("SELECT event_id, ts FROM events WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 168 HOUR")
def checkpoint_retention(spark, sf_dir):
    return state.retained(table(spark, sf_dir, "events").select("event_id", "ts"), "ts", "168 HOURS")


@query("SELECT c_custkey, c_name FROM customer WHERE c_custkey = 42 LIMIT 1")
def state_by_id(spark, sf_dir):
    return state.by_id(table(spark, sf_dir, "customer").select("c_custkey", "c_name"), "c_custkey", 42)


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS position, event_type AS file FROM events")
def json_position(spark, sf_dir):
    k = F.get_json_object("props", "$.k")
    local = F.when(F.col("event_id") % 2 == 0, F.to_json(F.struct(F.col("event_type").alias("binary_log_file"), k.cast("bigint").alias("binary_log_position"))))
    channels = F.to_json(F.array(F.struct(F.lit("other").alias("channel_name"), F.lit("x").alias("relay_master_log_file"), F.lit(0).cast("bigint").alias("exec_master_log_position")), F.struct(F.lit("").alias("channel_name"), F.col("event_type").alias("relay_master_log_file"), k.cast("bigint").alias("exec_master_log_position"))))
    return table(spark, sf_dir, "events").select("event_id", discovery.log_position(local, channels).alias("p")).select("event_id", F.col("p.offset").alias("position"), F.col("p.file").alias("file"))


@query(f"SELECT o_orderkey, {STATUS} AS status, o_custkey AS total_rows FROM orders")
def progress_json(spark, sf_dir):
    row = F.struct(F.lit("shop").alias("database"), F.lit("orders").alias("table"), F.expr(STATUS).alias("status"), F.col("o_custkey").alias("total_rows"))
    text = F.to_json(F.create_map(F.lit("shop.orders"), row))
    from .model import TABLE_PROGRESS

    back = F.from_json("text", TABLE_PROGRESS)["shop.orders"]
    return table(spark, sf_dir, "orders").select("o_orderkey", text.alias("text")).select("o_orderkey", back["status"].alias("status"), back["total_rows"].alias("total_rows"))


# Metrics


@query("SELECT event_type, max(ts) AS last_ts, CAST((SELECT epoch_us(max(ts)) FROM events) - epoch_us(max(ts)) AS DOUBLE) / 1000000 AS lag_seconds FROM events GROUP BY event_type")
def lag_metrics(spark, sf_dir):
    from .streaming.metrics import lag_seconds

    e = table(spark, sf_dir, "events")
    last = e.groupBy("event_type").agg(F.max("ts").alias("last_ts"))
    return last.crossJoin(F.broadcast(e.agg(F.max("ts").alias("now")))).select("event_type", "last_ts", lag_seconds(F.col("last_ts"), F.col("now")).cast("double").alias("lag_seconds"))


@query("SELECT op, count(*) AS processed, CAST(count(*) AS DOUBLE) / CAST((SELECT epoch_us(max(ts)) - epoch_us(min(ts)) FROM events) AS DOUBLE) AS rate_per_us FROM cdc GROUP BY op", cdc=True)
def rate_metrics(spark, sf_dir):
    log = cdc(spark, sf_dir)
    span = log.agg((F.unix_micros(F.max("ts").cast("timestamp")) - F.unix_micros(F.min("ts").cast("timestamp"))).alias("us"))
    return log.groupBy("op").agg(F.count("*").alias("processed")).crossJoin(F.broadcast(span)).select("op", "processed", (F.col("processed").cast("double") / F.col("us").cast("double")).alias("rate_per_us"))


@query("SELECT CAST(floor(value / 10) AS BIGINT) AS bucket, count(*) AS n FROM events WHERE value IS NOT NULL GROUP BY 1")
def duration_histogram(spark, sf_dir):
    return table(spark, sf_dir, "events").where("value is not null").groupBy(F.floor(F.col("value") / 10).alias("bucket")).agg(F.count("*").alias("n"))


# Streams and schema changes


@query(f"SELECT user_id, event_id, date_trunc('millisecond', ts) AS ts, event_type, value FROM ({LATEST}) WHERE rn = 1 AND op <> 'DELETE'", cdc=True)
def stream_apply(spark, sf_dir):
    """events through a micro-batch stream into a change log, then its current state; times are kept to the millisecond."""
    from .streaming.sink import ChangeLog

    work = _work_dir(spark)
    log = ChangeLog(spark, f"{work}/out")
    r = log.registry()
    r.apply(parse("CREATE TABLE users (user_id BIGINT PRIMARY KEY, event_id BIGINT, ts DATETIME(6), event_type VARCHAR(20), value DOUBLE)"))
    log.files.write("registry/-1.json", r.to_json())

    def to_events(batch: DataFrame, n: int) -> None:
        t = F.col("event_type")
        cols = {c: F.col(c).cast("string") for c in STATE} | {"value": F.col("value").cast("string"), "ts": F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")}
        data = F.create_map(*[x for c, v in cols.items() for x in (F.lit(c), v)])
        op = F.when(t == "signup", INSERT).when(t == "error", DELETE).otherwise(UPDATE)
        gone = op == DELETE
        none = F.lit(None).cast("map<string,string>")
        position = F.struct(F.lit("log.1").alias("file"), F.col("event_id").alias("offset"), F.lit(None).cast("string").alias("gtid"))
        log.apply(batch.select(F.col("event_id").cast("string").alias("id"), op.alias("op"), F.lit("shop").alias("database"), F.lit("users").alias("table"), F.col("ts").cast("timestamp").alias("ts"), position.alias("position"), F.lit(0).alias("ordinal"), F.when(~gone, data).otherwise(none).alias("data"), F.when(gone, data).otherwise(none).alias("old_data"), F.lit(None).cast("string").alias("sql")), n)

    events = table(spark, sf_dir, "events")
    stream = discovery.table_stream(spark, sf_dir, "events", events.schema)
    q = stream.writeStream.foreachBatch(to_events).option("checkpointLocation", f"{work}/checkpoint").trigger(availableNow=True).start()
    q.awaitTermination()
    out = log.current("users")
    return out.select("user_id", "event_id", "ts", "event_type", "value")


def _work_dir(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}"


def _change_log(spark: SparkSession, sf_dir: str, before: str, after: list[str]):
    """A log of the customers: `before` creates the table c, all rows come in one batch, then the statements of `after` in another."""
    from .streaming.sink import ChangeLog

    log = ChangeLog(spark, f"{_work_dir(spark)}/out")
    rows = table(spark, sf_dir, "customer")
    null = F.lit(None).cast("map<string,string>")

    def events(op, data, sql, offset):
        position = F.struct(F.lit("log.1").alias("file"), offset.cast("bigint").alias("offset"), F.lit(None).cast("string").alias("gtid"))
        return [F.concat(F.lit("e"), offset.cast("string")).alias("id"), F.lit(op).alias("op"), F.lit("shop").alias("database"), F.lit("c" if op == INSERT else None).cast("string").alias("table"), F.timestamp_seconds(F.lit(1_700_000_000)).alias("ts"), position.alias("position"), F.lit(0).alias("ordinal"), data.alias("data"), null.alias("old_data"), F.lit(sql).cast("string").alias("sql")]

    inserts = rows.select(*events(INSERT, F.create_map(F.lit("k"), F.col("c_custkey").cast("string"), F.lit("name"), F.col("c_name")), None, F.col("c_custkey") + 10))
    log.apply(inserts.unionByName(spark.range(1).select(*events("DDL", null, before, F.lit(0)))), 0)
    changes = None
    for i, text in enumerate(after):
        one = spark.range(1).select(*events("DDL", null, text, F.lit(10**12 + i)))
        changes = one if changes is None else changes.unionByName(one)
    more = rows.where("c_custkey % 10 = 0").select(*events(INSERT, F.create_map(F.lit("k"), (-F.col("c_custkey") - 1).cast("string"), F.lit("n"), F.lit("5")), None, F.col("c_custkey") + 10**13))
    log.apply(changes.unionByName(more), 1)
    return log.current("c")


@query("SELECT CAST(-c_custkey - 1 AS BIGINT) AS k, CAST(5 AS INTEGER) AS n FROM customer WHERE c_custkey % 10 = 0")
def recreated_table(spark, sf_dir):
    """DROP and CREATE: no row of the old table shows."""
    return _change_log(spark, sf_dir, "CREATE TABLE c (k BIGINT PRIMARY KEY, name TEXT)", ["DROP TABLE c", "CREATE TABLE c (k BIGINT PRIMARY KEY, n INT)"])


@query("SELECT c_custkey AS k, c_name AS name, CAST(7 AS INTEGER) AS n FROM customer UNION ALL SELECT -c_custkey - 1, NULL, CAST(5 AS INTEGER) FROM customer WHERE c_custkey % 10 = 0")
def added_default(spark, sf_dir):
    """ADD COLUMN with a default, which older rows then have."""
    return _change_log(spark, sf_dir, "CREATE TABLE c (k BIGINT PRIMARY KEY, name TEXT)", ["ALTER TABLE c ADD COLUMN n INT NOT NULL DEFAULT 7"])


@query("SELECT event_type, count(*) AS n, CAST(sum(count(*)) OVER () AS BIGINT) AS total FROM events GROUP BY 1")
def buffer_sizes(spark, sf_dir):
    return batching.buffered(table(spark, sf_dir, "events").select("event_type"), "event_type")


@query("SELECT CAST(floor(o_orderkey / 500) AS BIGINT) AS batch, CAST(floor(o_orderkey / 500) AS BIGINT) % 4 AS worker, count(*) AS n FROM orders GROUP BY 1, 2")
def batch_handoff(spark, sf_dir):
    batches = table(spark, sf_dir, "orders").groupBy(F.floor(F.col("o_orderkey") / 500).cast("bigint").alias("batch")).agg(F.count("*").alias("n"))
    return batching.handoff(batches, F.col("batch"), 4).withColumn("worker", F.col("worker").cast("bigint"))


@query("SELECT o_custkey, o_orderkey, o_orderdate FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) WHERE rn = 1 ORDER BY o_orderdate DESC, o_custkey DESC LIMIT 20")
def snapshot_list(spark, sf_dir):
    """The newest version of each snapshot (here: the newest order of each customer), then the 20 newest."""
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    return state.newest(merge.latest(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"]), "o_orderdate", 20, "o_custkey")


DDL_TEXTS = [
    "CREATE TABLE t (id INT PRIMARY KEY, name VARCHAR(20)) ENGINE=InnoDB",
    "CREATE TABLE IF NOT EXISTS `shop`.`orders` (\n  a INT NOT NULL,\n  b BIGINT UNSIGNED,\n  key_name VARCHAR(10) default 'x, y',\n  index_no INT COMMENT 'a, b',\n  PRIMARY KEY (a, b),\n  KEY idx (key_name)\n)",
    "ALTER TABLE t ADD COLUMN c DECIMAL(10, 2) DEFAULT 1.5 AFTER id, DROP COLUMN name",
    "ALTER TABLE t ADD COLUMN (x INT, y INT), CHANGE x z BIGINT, MODIFY y TEXT",
    "ALTER TABLE t DROP INDEX i, ADD FULLTEXT INDEX f (name), RENAME COLUMN a TO b",
    "ALTER TABLE t DROP PRIMARY KEY",
    "DROP TABLE IF EXISTS t /* generated */",
    "TRUNCATE TABLE t",
    "CREATE INDEX i ON t (a)",
    "CREATE TABLE u LIKE t",
    "ALTER TABLE t ADD COLUMN e ENUM('a', 'b c', 'D') NOT NULL",
]


@query()
def ddl_audit(spark, sf_dir):
    """What each statement does to the registry."""
    rows = []
    for i, text in enumerate(DDL_TEXTS):
        s = parse(text)
        columns = [f"{c.name} {c.target_type}" for c in s.columns]
        operations = [f"{o.action} {o.name or ''}{'>' + (o.new_name or '') if o.new_name else ''} {o.column.name + ' ' + o.column.target_type if o.column else ''}".strip() for o in s.operations]
        rows.append((i, s.kind, s.table, columns, s.primary_key, operations, s.warnings, s.destructive))
    return spark.createDataFrame(rows, "ddl_id int, kind string, table_name string, columns array<string>, primary_key array<string>, operations array<string>, warnings array<string>, is_destructive boolean")
