"""Snapshot, restart in the middle of it, then the stream, from one configuration."""

import json

import pytest

from changelake.config import load
from changelake.model import COMPLETED, FAILED, SCHEMA_ONLY
from changelake.operators.state import StateStore
from changelake.streaming.runner import Runner, SnapshotManager, SnapshotTimeout, Source, ordered_columns
from changelake.streaming.sink import ChangeLog
from tests.test_stream import record


class Fragile(Source):
    """A source with keys; reading a table fails as long as its name is in `broken`."""

    broken: set = set()
    reads: list = []

    def read(self, name):
        self.reads.append(name)
        if name in self.broken:
            raise ValueError(f"can't read {name}")
        return super().read(name)

    def keys(self, name):
        return ["id"]


@pytest.fixture
def setup(spark, tmp_path):
    for name, rows in (("users", [(1, "Ann"), (2, "Bob")]), ("items", [(5, "pen")]), ("secret", [(9, "x")]), ("empty", [])):
        spark.createDataFrame(rows, "id int, name string").write.parquet(f"{tmp_path}/tables/{name}.parquet")
    (tmp_path / "in").mkdir()
    config = {"source_path": str(tmp_path / "in"), "target_path": f"file://{tmp_path}/out", "filter": {"exclude_tables": ["secret"]}, "snapshot": {"parallel_tables": 1}, "pipeline": {"retry_delay_seconds": 0}}
    source = Fragile(spark, f"file://{tmp_path}/tables", "shop")
    source.reads, source.broken = [], set()
    return tmp_path, load(json.dumps(config), {}), source


def test_restart_in_mid_snapshot_then_stream(spark, setup):
    path, config, source = setup
    source.broken = {"users"}
    with pytest.raises(ValueError, match="can't read users"):
        Runner(spark, config, source).start()
    store = StateStore(spark, f"{config.target_path}/state")
    assert store.latest_progress()["status"] == FAILED and not store.has_completed_snapshot()
    # A failed snapshot isn't resumed; one that was cut short is.
    store.save_progress(id="cut", status="IN_PROGRESS", total_tables=4, tables_json=json.dumps({n: {"database": "shop", "table": n, "status": s, "data_load_enabled": n != "secret"} for n, s in (("items", "COMPLETED"), ("users", "IN_PROGRESS"), ("secret", "PENDING"), ("empty", "PENDING"))}))
    source.broken, source.reads = set(), []
    runner = Runner(spark, config, source)
    (path / "in" / "0.json").write_text("".join(json.dumps(r) + "\n" for r in [record(1, "UPDATE_ROWS", "users", ("id", "name"), [["1", "Ann"], ["1", "Anna"]]), record(2, "WRITE_ROWS", "users", ("id", "name"), [["3", "Cid"]])]))
    runner.start(available_now=True).awaitTermination()
    assert sorted(source.reads) == ["empty", "secret", "users"]
    assert {tuple(r) for r in runner.log.current("users").collect()} == {(1, "Anna"), (2, "Bob"), (3, "Cid")}
    assert runner.log.current("secret").count() == runner.log.current("empty").count() == 0
    done = runner.store.latest_progress()
    states = {n: s["status"] for n, s in json.loads(done["tables_json"]).items()}
    assert done["status"] == COMPLETED and states == {"items": COMPLETED, "users": COMPLETED, "secret": SCHEMA_ONLY, "empty": COMPLETED}
    assert runner.store.latest_checkpoint()["position_offset"] == 2
    runner.stop()
    # Started again: no second snapshot, and the stream goes on.
    source.reads = []
    again = Runner(spark, config, source)
    (path / "in" / "1.json").write_text(json.dumps(record(3, "DELETE_ROWS", "users", ("id", "name"), [["2", "Bob"]])) + "\n")
    again.start(available_now=True).awaitTermination()
    assert source.reads == [] and {r["id"] for r in again.log.current("users").collect()} == {1, 3}
    again.stop()
    assert "changelake_rows_total" in again.exposition()


def test_snapshot_in_parallel_and_in_time(spark, setup):
    path, config, source = setup
    config.snapshot.parallel_tables = 3
    log, store = ChangeLog(spark, config.target_path), StateStore(spark, f"{config.target_path}/state")
    config.snapshot.timeout_seconds = 0
    with pytest.raises(SnapshotTimeout):
        SnapshotManager(source, log, store, config).run()
    first = store.latest_progress()
    assert first["status"] == "IN_PROGRESS"
    config.snapshot.timeout_seconds = 600
    states = SnapshotManager(source, log, store, config).run()
    assert store.latest_progress()["id"] == first["id"] and {s.status for s in states.values()} == {COMPLETED, SCHEMA_ONLY}
    assert log.registry().get("users").keys == ["id"] and log.current("users").count() == 2
    assert SnapshotManager(source, log, store, config).run() == {}
    assert store.list_progress().count() == 1


def test_column_order():
    assert ordered_columns(["b", "a", "c"], None) == ["a", "b", "c"] and ordered_columns(["b", "a"], ["b", "x", "a"]) == ["b", "a"]
