"""Tables of a Parquet folder: names, columns and row counts; and the positions that databases report as JSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root.rstrip('/')}/{name}.parquet")


def table_stream(spark: SparkSession, root: str, name: str, schema: StructType) -> DataFrame:
    """A table as a stream of its files, whether it is one file or a folder."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/{name}.parquet")
    stream = spark.readStream.schema(schema)
    if path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(path).isDirectory():
        return stream.parquet(path.toString())
    return stream.option("pathGlobFilter", path.getName()).parquet(root)


def discover(spark: SparkSession, root: str) -> list[str]:
    """Names of the tables <name>.parquet in a folder of any file system."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(root)
    listed = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(path)
    return sorted(n[: -len(".parquet")] for n in (s.getPath().getName() for s in listed) if n.endswith(".parquet"))


def columns(spark: SparkSession, root: str, name: str) -> list[tuple[str, str, bool, int]]:
    """name, type, nullable, ordinal, from the file footers."""
    return [(f.name, f.dataType.simpleString(), f.nullable, i) for i, f in enumerate(read_table(spark, root, name).schema.fields, 1)]


def log_position(local: Column, replication: Column) -> Column:
    """struct<file, offset, gtid> from the status JSON of a server: its own, or the unnamed channel of its replication array."""
    own = F.from_json(local, "binary_log_file string, binary_log_position bigint, gtid_executed string")
    channels = F.from_json(replication, "array<struct<channel_name: string, relay_master_log_file: string, exec_master_log_position: bigint>>")
    first = F.try_element_at(F.filter(channels, lambda c: c["channel_name"] == ""), F.lit(1))
    return F.struct(F.coalesce(own["binary_log_file"], first["relay_master_log_file"]).alias("file"), F.coalesce(own["binary_log_position"], first["exec_master_log_position"]).alias("offset"), own["gtid_executed"].alias("gtid"))


def jdbc_options(url: str, user: str, password: str, tls: str = "disabled") -> dict[str, str]:
    """Options for spark.read.jdbc; modes: disabled, preferred, required, verify_ca, verify_identity."""
    modes = {"disabled": "DISABLED", "preferred": "PREFERRED", "required": "REQUIRED", "verify_ca": "VERIFY_CA", "verify_identity": "VERIFY_IDENTITY"}
    if tls not in modes:
        raise ValueError(f"unknown TLS mode {tls!r}")
    return {"url": url, "user": user, "password": password, "sslMode": modes[tls]}
