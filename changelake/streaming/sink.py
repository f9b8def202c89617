"""Applies micro-batches of events to an append-only change log, exactly once, with schema changes in their place.

Layout under a root: log/table=T/batch=N/segment=K/*.parquet (columns by id), dead/batch=N (rows that can't be applied, with the reason),
registry/N.json (schemas after batch N), commits/N.json (what batch N wrote). A batch that is replayed starts from the registry of the batch
before and overwrites its own folders; readers see committed batches only. Events are cut at schema changes: each piece is typed with the
schema that holds at its position. Files belong to the table as it was created: after DROP and CREATE, those of the old one are not read.
Rows that are older than a column have the default with which it was added. A commit that compacts names the files that it replaces.
"""

from __future__ import annotations

import json
import re
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from ..functions.tablefilter import TableFilter
from ..functions.types import convert
from ..model import DDL, DELETED, VERSION
from ..operators.decode import decode
from ..operators.merge import current, key_change_tombstones, latest, soft_deletes, version_ns
from ..operators.order import SEQ, sequence
from ..plans.ddl import parse
from ..plans.registry import Registry, SchemaError, Table, physical, view
from .retry import with_retries

#: Snapshot rows have versions below those of all changes, which aren't negative.
FIRST_LOADS = 1 << 40


def seq() -> Column:
    """Order of events, older first. Rows of one position keep their order, a tombstone of an old key comes before the new row."""
    return sequence(F.col("position.file"), F.col("position.offset"), F.coalesce("ordinal", F.lit(0)), ~F.col("id").endswith(":old"))


class Files:
    """Small files in any file system that Spark reaches."""

    def __init__(self, spark: SparkSession, root: str):
        self.jvm, self.root = spark.sparkContext._jvm, root.rstrip("/")
        self.conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.fs = self._path("").getFileSystem(self.conf)

    def _path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def names(self, folder: str) -> list[str]:
        path = self._path(folder)
        return sorted(s.getPath().getName() for s in self.fs.listStatus(path)) if self.fs.exists(path) else []

    def write(self, name: str, text: str) -> None:
        """Written aside and moved, so that readers see all of it or nothing."""
        new, path = self._path(name + ".tmp"), self._path(name)
        out = self.fs.create(new, True)
        out.write(bytearray(text.encode()))
        out.close()
        self.fs.delete(path, False)
        if not self.fs.rename(new, path):
            raise OSError(f"could not move {name} into place")

    def read(self, name: str) -> str:
        stream = self.fs.open(self._path(name))
        try:
            return bytes(self.jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
        finally:
            stream.close()

    def delete(self, name: str) -> None:
        self.fs.delete(self._path(name), True)


class ChangeLog:
    """on_bad_row: "dead" writes rows that can't be decoded to the dead letters, "fail" ends the query. writers: tables written at a time."""

    def __init__(self, spark: SparkSession, root: str, tables: TableFilter | None = None, allow_destructive: bool = True, pk_change_tombstone: bool = True, on_bad_row: str = "dead", retries: int = 3, retry_base: float = 1.0, writers: int = 4):
        self.spark, self.root = spark, root.rstrip("/")
        self.files = Files(spark, root)
        self.tables, self.allow_destructive, self.tombstones = tables or TableFilter(), allow_destructive, pk_change_tombstone
        self.on_bad_row, self.retries, self.retry_base, self.writers = on_bad_row, retries, retry_base, writers

    # state

    def _numbered(self, folder: str) -> list[int]:
        return sorted(int(m[1]) for n in self.files.names(folder) if (m := re.fullmatch(r"(-?\d+)\.json", n)))

    def registry(self, before: int | None = None) -> Registry:
        """Schemas after the last batch, or after the last one before a batch."""
        known = [n for n in self._numbered("registry") if before is None or n < before]
        return Registry.from_json(self.files.read(f"registry/{known[-1]}.json"), self.allow_destructive) if known else Registry(self.allow_destructive)

    def commits(self) -> dict[int, dict]:
        return {n: json.loads(self.files.read(f"commits/{n}.json")) for n in self._numbered("commits")}

    # writing

    def apply_raw(self, raw: DataFrame, batch_id: int) -> None:
        self.apply(decode(raw, self.on_bad_row), batch_id)

    def apply(self, events: DataFrame, batch_id: int) -> None:
        """Writes one batch of events (model.EVENT, and `problem`, if there is one). Errors that may pass are tried again; call it again
        with the same number after a failure."""
        with_retries(lambda: self._apply(events, batch_id), self.retries, self.retry_base)

    def _apply(self, events: DataFrame, batch_id: int) -> None:
        registry = self.registry(before=batch_id)
        if "problem" not in events.columns:
            events = events.withColumn("problem", F.lit(None).cast("string"))
        events = events.where(self.tables.events(F.col("op"), F.col("database"), F.col("table"))).withColumn("_seq", seq()).persist(StorageLevel.DISK_ONLY)
        try:
            # Schema changes are few; they are all that the driver sees of a batch.
            changes = events.where(F.col("op") == DDL).select("_seq", "sql", "database", "ts").orderBy("_seq").collect()
            self.files.delete(f"dead/batch={batch_id}")
            wrote, warnings, low = [], [], None
            for k in range(len(changes) + 1):
                high = changes[k]["_seq"] if k < len(changes) else None
                piece = events.where(F.col("op") != DDL)
                for bound, behind in ((low, True), (high, False)):
                    if bound is not None:
                        at = F.struct(*[F.lit(bound[f.name]).cast(f.dataType).alias(f.name) for f in events.schema["_seq"].dataType.fields])
                        piece = piece.where(F.col("_seq") > at if behind else F.col("_seq") < at)
                wrote += self._segment(piece, registry, batch_id, k)
                if high is not None:
                    try:
                        warnings += registry.apply(parse(changes[k]["sql"]), changes[k]["ts"])
                    except SchemaError as e:
                        warnings.append(str(e))
                    low = high
            self.files.write(f"registry/{batch_id}.json", registry.to_json())
            self.files.write(f"commits/{batch_id}.json", json.dumps({"wrote": wrote, "warnings": warnings}))
        finally:
            events.unpersist()

    def _segment(self, piece: DataFrame, registry: Registry, batch_id: int, k: int) -> list[dict]:
        """The tables of one piece, a few at a time: their jobs share the cluster."""
        counts = {r["table"]: (r["n"], r["bad"]) for r in piece.groupBy("table").agg(F.count("*").alias("n"), F.count("problem").alias("bad")).collect()}  # one row for each table
        lost = [n for n in counts if not registry.has(n)]
        if lost:
            self._bury(piece.where(F.col("table").isin(lost)), batch_id, F.lit("no such table"))
        if any(bad for n, (_, bad) in counts.items() if n not in lost):
            self._bury(piece.where(F.col("problem").isNotNull() & ~F.col("table").isin(lost)), batch_id, F.col("problem"))
        known = sorted(n for n in counts if n not in lost)
        piece = piece.where("problem is null").drop("problem")
        with ThreadPoolExecutor(max(1, self.writers)) as pool:
            return list(pool.map(lambda name: self._table(piece.where(F.col("table") == name), registry.get(name), batch_id, k, counts[name][0]), known))

    def _table(self, own: DataFrame, table: Table, batch_id: int, k: int, n: int) -> dict:
        if self.tombstones and table.keys:
            own = key_change_tombstones(own.drop("_seq"), table.keys).withColumn("_seq", seq())
        rows = soft_deletes(own)
        values = {f: convert(F.col("data")[f.name], f.type) if f.default in (None, "NULL") else F.when(F.map_contains_key("data", F.lit(f.name)), convert(F.col("data")[f.name], f.type)).otherwise(F.expr(f.default).cast(f.type)) for f in map(_Hashable, table.fields)}
        bad = F.lit(False)
        for f, v in values.items():
            bad = bad | (F.col("data")[f.name].isNotNull() & v.isNull())
        self._bury(rows.where(bad), batch_id, F.lit("value can't be converted"))
        cols = [v.alias(physical(f.column_id)) for f, v in values.items()]
        good = rows.where(~bad).select(*cols, version_ns(F.col("ts")).alias(VERSION), F.col(DELETED), "_seq", F.lit(batch_id).cast("bigint").alias("_batch"))
        path = f"log/table={table.name}/batch={batch_id}/segment={k}"
        good.write.mode("overwrite").parquet(f"{self.root}/{path}")
        return {"table": table.name, "path": path, "schema_version": table.version, "rows": n}

    def _bury(self, rows: DataFrame, batch_id: int, reason: Column) -> None:
        if not rows.isEmpty():
            rows.select("id", "op", "database", "table", "ts", "position", "data", "old_data", reason.alias("reason")).write.mode("append").parquet(f"{self.root}/dead/batch={batch_id}")

    def load_snapshot(self, name: str, df: DataFrame) -> None:
        """A table's first rows, older than any change: batch -1, under columns of the registered schema."""
        table = self.registry().get(name)
        cols = [(F.col(f.name).try_cast(f.type) if f.name in df.columns else F.lit(None).cast(f.type)).alias(physical(f.column_id)) for f in table.fields]
        known = self.commits().get(-1, {"wrote": [], "warnings": []})
        loads = known["loads"] = known.get("loads", 0) + 1  # a later load is another folder, since the earlier one may be compacted, and newer
        path = f"log/table={name}/batch=-1/segment={loads}"
        df.select(*cols, F.lit(loads - FIRST_LOADS).cast("bigint").alias(VERSION), F.lit(0).cast("smallint").alias(DELETED), F.lit(None).cast(SEQ).alias("_seq"), F.lit(-1).cast("bigint").alias("_batch")).write.mode("overwrite").parquet(f"{self.root}/{path}")
        known["wrote"] = [w for w in known["wrote"] if w["table"] != name] + [{"table": name, "path": path, "schema_version": table.version}]
        self.files.write("commits/-1.json", json.dumps(known))

    # reading

    def _paths(self, table: Table) -> list[str]:
        """Committed files of the table as it was last created, less those that a compaction replaced."""
        commits = self.commits()
        gone = {p for c in commits.values() for p in c.get("replaced", {}).get(table.name, ())}
        return [w["path"] for _, c in sorted(commits.items()) for w in c["wrote"] if w["table"] == table.name and w["schema_version"] >= table.created and w["path"] not in gone]

    def log(self, name: str, table: Table | None = None) -> DataFrame:
        """All committed rows of a table under its present schema."""
        table = table or self.registry().get(name)
        paths = self._paths(table)
        if not paths:
            empty = ", ".join([*(f"`{c}` {t}" for c, t in table.columns.items()), f"{VERSION} bigint", f"{DELETED} smallint"])
            return self.spark.createDataFrame([], empty).withColumn("_seq", F.lit(None).cast(SEQ))
        files = [self.spark.read.parquet(f"{self.root}/{p}") for p in paths]
        # Types of a column may differ between files, so each schema is read and cast by itself.
        shapes: dict[str, list[str]] = {}
        for p, f in zip(paths, files, strict=True):
            shapes.setdefault(f.schema.simpleString(), []).append(p)
        out = None
        for own in shapes.values():
            part = view(self.spark.read.parquet(*[f"{self.root}/{p}" for p in own]), table)
            out = part if out is None else out.unionByName(part)
        return out

    def current(self, name: str) -> DataFrame:
        """Live rows of a table. A table without keys keeps every row."""
        table = self.registry().get(name)
        log = self.log(name, table)
        rows = current(log, table.keys, [VERSION, "_seq"]) if table.keys else log.where(F.col(DELETED) == 0)
        return rows.select(*table.columns)

    def dead(self) -> DataFrame | None:
        return self.spark.read.option("basePath", f"{self.root}/dead").parquet(f"{self.root}/dead") if self.files.names("dead") else None

    def compact(self, name: str) -> None:
        """Replaces a table's files by its newest versions (deletes included, since older changes may still be replayed)."""
        commits = self.commits()
        if not commits:
            return
        table = self.registry().get(name)
        last = max(commits)
        old = self._paths(table)
        rows = self.log(name, table)
        rows = latest(rows, table.keys, [VERSION, "_seq"]) if table.keys else rows
        done = commits[last]
        replaced = done.setdefault("replaced", {}).setdefault(name, [])
        path = f"log/table={name}/compact={last}-{len(replaced)}"
        rows.select(*[F.col(f.name).alias(physical(f.column_id)) for f in table.fields], VERSION, DELETED, "_seq", F.lit(last).cast("bigint").alias("_batch")).write.mode("overwrite").parquet(f"{self.root}/{path}")
        replaced += old
        done["wrote"].append({"table": name, "path": path, "schema_version": table.version})
        self.files.write(f"commits/{last}.json", json.dumps(done))

    def vacuum(self) -> list[str]:
        """Deletes the files that compactions replaced, and those of dropped tables; returns them. Not while a reader may still use them."""
        commits, registry, gone = self.commits(), self.registry(), []
        for c in commits.values():
            for w in c["wrote"]:
                replaced = any(w["path"] in d.get("replaced", {}).get(w["table"], ()) for d in commits.values())
                if replaced or not registry.has(w["table"]) or w["schema_version"] < registry.get(w["table"]).created:
                    self.files.delete(w["path"])
                    gone.append(w["path"])
        return gone

    def start(self, raw_stream: DataFrame, checkpoint: str, available_now: bool = False, every: str = "2 seconds"):
        """Starts the query; progress is Spark's own checkpoint."""
        writer = raw_stream.writeStream.foreachBatch(self.apply_raw).option("checkpointLocation", checkpoint)
        return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=every)).start()


class _Hashable:
    """A field as a dictionary key."""

    def __init__(self, f):
        self.column_id, self.name, self.type, self.default = f.column_id, f.name, f.type, f.default
