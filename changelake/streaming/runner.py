"""From a configuration to a running engine: initial snapshot (resumable, several tables at a time, within a time limit), then the stream."""

from __future__ import annotations

import json
import threading
import time
import uuid
from collections.abc import Callable
from concurrent.futures import FIRST_EXCEPTION, ThreadPoolExecutor, wait
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Config
from ..model import COMPLETED, FAILED, IN_PROGRESS, PENDING, SCHEMA_ONLY
from ..operators import snapshot
from ..operators.order import sequence
from ..operators.state import StateStore
from ..plans.ddl import Column, Statement
from ..sources import discovery
from ..sources.change_log import json_stream
from .metrics import Progress
from .retry import with_retries
from .sink import ChangeLog


class SnapshotTimeout(TimeoutError):
    """The snapshot took longer than it may; what is done stays done."""


@dataclass
class TableState:
    """A table's way: PENDING, IN_PROGRESS, then COMPLETED, SCHEMA_ONLY or FAILED."""

    database: str
    table: str
    status: str = PENDING
    total_rows: int = 0
    processed_rows: int = 0
    chunk_size: int = 10_000
    data_load_enabled: bool = True
    error: str | None = None


class Source:
    """Tables <name>.parquet in a folder; a database's tables can stand in by the same methods (see discovery.jdbc_options)."""

    def __init__(self, spark: SparkSession, root: str, database: str = "source"):
        self.spark, self.root, self.database = spark, root, database

    def tables(self) -> list[str]:
        return discovery.discover(self.spark, self.root)

    def read(self, name: str) -> DataFrame:
        return discovery.read_table(self.spark, self.root, name)

    def keys(self, name: str) -> list[str]:
        """Key columns by ordinal; a folder of files knows none."""
        return []


class SnapshotManager:
    """Brings the tables of a source into a change log, each once."""

    def __init__(self, source: Source, log: ChangeLog, store: StateStore, config: Config, clock: Callable[[], float] = time.monotonic):
        self.source, self.log, self.store, self.config, self.clock = source, log, store, config, clock
        self.lock = threading.Lock()

    def plan(self) -> tuple[str, dict[str, TableState]]:
        """A snapshot's id and its tables: those of one that was left less than a day ago, or of a new one."""
        last = snapshot.resumable(self.store.progress(), F.current_timestamp()).orderBy(F.desc("created_at"), F.desc("id")).first()
        if last is not None:
            states = {n: TableState(**s) for n, s in json.loads(last["tables_json"]).items()}
            for s in states.values():
                s.status = PENDING if s.status == IN_PROGRESS else s.status
            return last["id"], states
        opts = self.config.snapshot
        rows = snapshot.plan([(self.source.database, t, 0) for t in self.source.tables()], self.config.filter, opts.skip_data_load, opts.chunk_size)
        return str(uuid.uuid4()), {r["table"]: TableState(**r) for r in rows}

    def save(self, ident: str, states: dict[str, TableState], status: str, error: str | None = None) -> None:
        done = sum(s.status in snapshot.FINISHED for s in states.values())
        failed = sum(s.status == FAILED for s in states.values())
        text = json.dumps({n: asdict(s) for n, s in states.items()}, sort_keys=True)
        self.store.save_progress(id=ident, status=status, total_tables=len(states), completed_tables=done, failed_tables=failed, tables_json=text, error_message=error)

    def run(self, force: bool = False) -> dict[str, TableState]:
        """The snapshot, unless one was completed. The first table that fails ends it; finished tables aren't loaded again."""
        if not force and self.store.has_completed_snapshot():
            return {}
        ident, states = self.plan()
        self.save(ident, states, IN_PROGRESS)
        opts, began = self.config.snapshot, self.clock()
        stop = threading.Event()
        todo = [s for s in states.values() if s.status not in snapshot.FINISHED]
        error: BaseException | None = None
        with ThreadPoolExecutor(opts.parallel_tables) as pool:
            jobs = [pool.submit(self._table, s, ident, states, stop) for s in todo]
            ended, open_ = wait(jobs, timeout=max(0.0, opts.timeout_seconds - (self.clock() - began)), return_when=FIRST_EXCEPTION)
            error = next((j.exception() for j in ended if j.exception() is not None), None)
            if error is None and open_:
                error = SnapshotTimeout(f"snapshot not done after {opts.timeout_seconds} seconds")
            if error is not None:  # tables under way end by themselves; no other is begun
                stop.set()
                for j in open_:
                    j.cancel()
        if error is not None:
            # A timeout leaves the snapshot to be resumed; a failed table makes it a failed one.
            self.save(ident, states, IN_PROGRESS if isinstance(error, SnapshotTimeout) else FAILED, str(error))
            raise error
        self.save(ident, states, snapshot.final_status(sum(s.status == FAILED for s in states.values())))
        return states

    def _table(self, state: TableState, ident: str, states: dict[str, TableState], stop: threading.Event) -> None:
        if stop.is_set():
            return
        state.status = IN_PROGRESS
        try:
            df = self.source.read(state.table)
            self.ensure(state.table, df)
            if state.data_load_enabled:
                state.total_rows = df.count()
                if state.total_rows:
                    with_retries(lambda: self.log.load_snapshot(state.table, df), self.config.pipeline.max_retries, self.config.pipeline.retry_delay_seconds)
                state.processed_rows, state.status = state.total_rows, COMPLETED
            else:
                state.status = SCHEMA_ONLY
        except Exception as e:
            state.status, state.error = FAILED, str(e)
            raise
        finally:
            with self.lock:
                self.save(ident, states, IN_PROGRESS)

    def ensure(self, name: str, df: DataFrame) -> None:
        """Creates a table that the registry lacks, with the source's columns in their order and its keys."""
        with self.lock:
            registry = self.log.registry()
            if registry.has(name):
                return
            keys = self.source.keys(name)
            columns = [Column(f.name, SOURCE_TYPES.get(f.dataType.simpleString(), f.dataType.simpleString()), f.nullable and f.name not in keys, primary_key=f.name in keys) for f in df.schema.fields]
            registry.apply(Statement("CREATE", f"CREATE TABLE {name}", table=name, columns=columns, primary_key=keys))
            last = max(self.log._numbered("registry"), default=-1)
            self.log.files.write(f"registry/{last}.json", registry.to_json())


#: Spark's types by the names that the type mapping knows.
SOURCE_TYPES = {"string": "TEXT", "tinyint": "TINYINT", "boolean": "BOOL", "timestamp": "DATETIME(6)", "timestamp_ntz": "DATETIME(6)", "binary": "BLOB"}


class Runner:
    """An engine over one configuration: start() takes the snapshot, then runs the stream; stop() lets the batch under way end."""

    def __init__(self, spark: SparkSession, config: Config, source: Source | None = None):
        self.spark, self.config = spark, config.validate()
        self.log = ChangeLog(spark, config.target_path, config.filter, config.allow_destructive_ddl, retries=config.pipeline.max_retries, retry_base=config.pipeline.retry_delay_seconds)
        self.store = StateStore(spark, f"{config.target_path.rstrip('/')}/state")
        self.source, self.metrics, self.query = source, Progress(), None

    def start(self, stream: DataFrame | None = None, force_snapshot: bool = False, available_now: bool = False):
        self.spark.streams.addListener(self.metrics)
        if self.source is not None and self.config.snapshot.enabled:
            SnapshotManager(self.source, self.log, self.store, self.config).run(force_snapshot)
        if stream is None:
            stream = json_stream(self.spark, self.config.source_path, self.config.pipeline.max_files_per_trigger)
        checkpoint = f"{self.config.target_path.rstrip('/')}/checkpoint"
        writer = stream.writeStream.foreachBatch(self._batch).option("checkpointLocation", checkpoint)
        self.query = (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=self.config.pipeline.batch_timeout)).start()
        return self.query

    def _batch(self, raw: DataFrame, batch_id: int) -> None:
        """A batch into the log, then a checkpoint of the last position in it, which the log then holds for sure."""
        self.log.apply_raw(raw, batch_id)
        at = sequence(F.col("log_file"), F.col("log_pos"), F.lit(0), F.lit(0))
        last = raw.where("log_pos > 0").agg(F.max_by(F.struct("log_file", "log_pos", "gtid", F.timestamp_seconds("timestamp").alias("ts")), at).alias("last")).first()["last"]
        if last is not None:
            self.store.save_checkpoint(last["log_file"], last["log_pos"], last["gtid"], last["ts"])

    def stop(self, seconds: int = 30) -> None:
        """Ends the stream after what is there is done, or after so many seconds."""
        if self.query is not None:
            if self.query.isActive:
                done = threading.Thread(target=self.query.processAllAvailable, daemon=True)
                done.start()
                done.join(seconds)
            self.query.stop()
        self.spark.streams.removeListener(self.metrics)

    def exposition(self) -> str:
        """Counters and gauges as lines of text that a scraper reads."""
        m = self.metrics
        values = {"batches_total": m.batches, "rows_total": m.rows, "failures_total": m.failures, "rows_per_second": m.rows_per_second}
        return "".join(f"# TYPE changelake_{n} {'counter' if n.endswith('_total') else 'gauge'}\nchangelake_{n} {v}\n" for n, v in values.items())


def ordered_columns(columns: list[str], order: list[str] | None) -> list[str]:
    """Columns in the table's order; by name where that isn't known."""
    return [c for c in order if c in columns] if order else sorted(columns)

