"""Change logs end to end: schema changes between rows, restarts, replays, dead letters, compaction, random histories."""

import json
import random

import pytest

from changelake.model import RAW
from changelake.plans.ddl import parse
from changelake.sources.change_log import ChangeLogSource, json_stream
from changelake.streaming.retry import with_retries
from changelake.streaming.sink import ChangeLog


def record(pos, kind, table=None, names=(), rows=None, sql=None, ts=1_700_000_000):
    return {"event_type": kind, "timestamp": ts, "log_file": "log.1", "log_pos": pos, "gtid": None, "database": "shop", "table": table, "column_names": list(names), "rows": rows, "sql": sql}


HISTORY = [
    record(1, "QUERY", sql="CREATE TABLE users (\n id INT,\n name VARCHAR(20),\n PRIMARY KEY (id)\n)"),
    record(2, "WRITE_ROWS_V2", "users", ("id", "name"), [["1", "Alice"], ["2", "Bob"], ["x", "bad"]]),
    record(3, "UPDATE_ROWS_V2", "users", ("id", "name"), [["1", "Alice"], ["1", "Alicia"], ["2", "Bob"], ["3", "Rob"]]),
    record(4, "QUERY", sql="BEGIN"),
    record(5, "QUERY", sql="ALTER TABLE users ADD COLUMN n BIGINT, CHANGE name full_name TEXT"),
    record(6, "WRITE_ROWS_V2", "users", ("id", "full_name", "n"), [["7", "Zed", "12"]]),
    record(7, "DELETE_ROWS_V2", "users", ("id", "full_name", "n"), [["3", "Rob", None]]),
    record(8, "WRITE_ROWS_V2", "nowhere", ("id",), [["1"]]),
]
WANT = {(1, "Alicia", None), (7, "Zed", 12)}


def live(log):
    return {tuple(r) for r in log.current("users").collect()}


@pytest.mark.parametrize("cuts", [[8], [1, 3, 8], [1, 2, 3, 4, 5, 6, 7, 8]])
def test_any_cut_gives_the_same(spark, tmp_path, cuts):
    log, at = ChangeLog(spark, f"file://{tmp_path}"), 0
    for n, to in enumerate(cuts):
        batch = spark.createDataFrame([tuple(r[f.name] for f in RAW.fields) for r in HISTORY[at:to]], RAW)
        log.apply_raw(batch, n)
        log.apply_raw(batch, n)  # a replay changes nothing
        at = to
    assert live(log) == WANT
    assert {r["reason"] for r in log.dead().collect()} == {"value can't be converted", "no such table"}
    log.compact("users")
    assert live(log) == WANT


@pytest.mark.parametrize("source", ["json", "changelog"])
def test_restart(spark, tmp_path, source):
    spark.dataSource.register(ChangeLogSource)
    folder = tmp_path / "in"
    folder.mkdir()
    log = ChangeLog(spark, f"file://{tmp_path}/out")
    for k, part in enumerate((HISTORY[:3], HISTORY[3:])):
        (folder / f"{k}.json").write_text("".join(json.dumps(r) + "\n" for r in part))
        stream = json_stream(spark, str(folder)) if source == "json" else spark.readStream.format("changelog").option("path", str(folder)).load()
        log.start(stream, f"{tmp_path}/checkpoint", available_now=True).awaitTermination()
    assert live(log) == WANT and len(log.commits()) >= 2


def test_random_history_equals_replay(spark, tmp_path):
    rng, state, rows = random.Random(3), {}, []
    for pos in range(2, 120):
        k = str(rng.randint(1, 12))
        if k not in state:
            state[k] = str(pos)
            rows.append(record(pos, "WRITE_ROWS_V2", "t", ("id", "v"), [[k, str(pos)]]))
        elif rng.random() < 0.3:
            rows.append(record(pos, "DELETE_ROWS_V2", "t", ("id", "v"), [[k, state.pop(k)]]))
        else:
            new = str(rng.randint(1, 12))
            new = new if new not in state else k
            old = state.pop(k)
            state[new] = str(pos)
            rows.append(record(pos, "UPDATE_ROWS_V2", "t", ("id", "v"), [[k, old], [new, str(pos)]]))
    log = ChangeLog(spark, f"file://{tmp_path}")
    rows = [record(1, "QUERY", sql="CREATE TABLE t (id INT PRIMARY KEY, v INT)"), *rows]
    for n, at in enumerate(range(0, len(rows), 40)):
        part = rows[at : at + 40]
        rng.shuffle(part)
        log.apply_raw(spark.createDataFrame([tuple(r[f.name] for f in RAW.fields) for r in part], RAW), n)
    assert {(str(r["id"]), str(r["v"])) for r in log.current("t").collect()} == set(state.items())


def test_snapshot_is_older_than_changes(spark, tmp_path):
    log = ChangeLog(spark, f"file://{tmp_path}")
    r = log.registry()
    r.apply(parse("CREATE TABLE users (id INT PRIMARY KEY, name TEXT)"))
    log.files.write("registry/-1.json", r.to_json())
    log.load_snapshot("users", spark.createDataFrame([(1, "old"), (2, "kept")], "id int, name string"))
    log.apply_raw(spark.createDataFrame([tuple(record(1, "UPDATE_ROWS", "users", ("id", "name"), [["1", "old"], ["1", "new"]], ts=1)[f.name] for f in RAW.fields)], RAW), 0)
    assert live(log) == {(1, "new"), (2, "kept")}


def test_retries():
    seen = []

    def fails():
        seen.append(1)
        if len(seen) < 3:
            raise OSError("connection reset by peer")
        return "done"

    waits = []
    assert with_retries(fails, 3, 2.0, sleep=waits.append) == "done" and waits == [2.0, 4.0]
    with pytest.raises(ValueError, match="syntax"):
        with_retries(lambda: (_ for _ in ()).throw(ValueError("syntax error")), 5, sleep=waits.append)


def test_state(spark, tmp_path):
    from changelake.operators.state import StateStore

    s = StateStore(spark, f"file://{tmp_path}")
    assert s.latest_checkpoint() is None and not s.has_completed_snapshot()
    s.save_checkpoint("log.1", 5)
    s.save_checkpoint("log.1", 9)
    assert s.latest_checkpoint()["position_offset"] == 9 and s.expire("0 HOURS").count() == 1
    s.save_progress(id="a", status="IN_PROGRESS", total_tables=2)
    s.save_progress(id="a", status="COMPLETED", total_tables=2)
    assert s.has_completed_snapshot() and s.progress().count() == 1


def frame(spark, rows):
    return spark.createDataFrame([tuple(r[f.name] for f in RAW.fields) for r in rows], RAW)


def test_recreated_table_has_none_of_the_old_rows(spark, tmp_path):
    log = ChangeLog(spark, f"file://{tmp_path}")
    log.apply_raw(frame(spark, [record(1, "QUERY", sql="CREATE TABLE t (a INT PRIMARY KEY, b INT)"), record(2, "WRITE_ROWS", "t", ("a", "b"), [["1", "2"]])]), 0)
    log.apply_raw(frame(spark, [record(3, "QUERY", sql="DROP TABLE t"), record(4, "QUERY", sql="CREATE TABLE t (x INT PRIMARY KEY, y TEXT)"), record(5, "WRITE_ROWS", "t", ("x", "y"), [["7", "seven"]])]), 1)
    assert [tuple(r) for r in log.current("t").collect()] == [(7, "seven")]
    log.compact("t")
    assert [tuple(r) for r in log.current("t").collect()] == [(7, "seven")]
    assert len(log.vacuum()) == 2 and [tuple(r) for r in log.current("t").collect()] == [(7, "seven")]


def test_added_column_has_its_default_in_older_rows(spark, tmp_path):
    log = ChangeLog(spark, f"file://{tmp_path}")
    log.apply_raw(frame(spark, [record(1, "QUERY", sql="CREATE TABLE t (id INT PRIMARY KEY)"), record(2, "WRITE_ROWS", "t", ("id",), [["1"]])]), 0)
    log.apply_raw(frame(spark, [record(3, "QUERY", sql="ALTER TABLE t ADD COLUMN n INT NOT NULL DEFAULT 7, ADD COLUMN s TEXT, ADD COLUMN at DATETIME DEFAULT CURRENT_TIMESTAMP"), record(4, "WRITE_ROWS", "t", ("id", "n", "s"), [["2", "8", "x"]])]), 1)
    got = {r["id"]: r for r in log.current("t").collect()}
    assert (got[1]["n"], got[1]["s"], got[2]["n"], got[2]["s"]) == (7, None, 8, "x")
    assert str(got[1]["at"]) == "2023-11-14 22:13:20"  # when the column was added
    log.apply_raw(frame(spark, [record(5, "QUERY", sql="ALTER TABLE t MODIFY n INT NOT NULL DEFAULT 9")]), 2)
    log.compact("t")
    assert {(r["id"], r["n"]) for r in log.current("t").collect()} == {(1, 7), (2, 8)}


def test_snapshot_after_compaction(spark, tmp_path):
    log = ChangeLog(spark, f"file://{tmp_path}")
    log.apply_raw(frame(spark, [record(1, "QUERY", sql="CREATE TABLE users (id INT PRIMARY KEY, name TEXT)"), record(2, "WRITE_ROWS", "users", ("id", "name"), [["1", "changed"]])]), 0)
    log.load_snapshot("users", spark.createDataFrame([(1, "old"), (2, "first")], "id int, name string"))
    log.compact("users")
    log.compact("users")
    log.load_snapshot("users", spark.createDataFrame([(1, "old"), (2, "second"), (3, "new")], "id int, name string"))
    assert live(log) == {(1, "changed"), (2, "second"), (3, "new")}
    log.compact("users")
    log.vacuum()
    assert live(log) == {(1, "changed"), (2, "second"), (3, "new")}


@pytest.mark.parametrize("source", ["batch", "changelog"])
def test_log_files_go_by_number(spark, tmp_path, source):
    rows = [record(9, "QUERY", sql="CREATE TABLE t (id INT PRIMARY KEY, v INT)") | {"log_file": "log.9"}, record(12, "WRITE_ROWS", "t", ("id", "v"), [["1", "1"]]) | {"log_file": "log.9"}, record(4, "UPDATE_ROWS", "t", ("id", "v"), [["1", "1"], ["1", "2"]]) | {"log_file": "log.10"}]
    log = ChangeLog(spark, f"file://{tmp_path}/out")
    if source == "batch":
        log.apply_raw(frame(spark, rows[::-1]), 0)
    else:
        spark.dataSource.register(ChangeLogSource)
        (tmp_path / "in").mkdir()
        for name in ("log.9", "log.10"):
            (tmp_path / "in" / name).write_text("".join(json.dumps(r) + "\n" for r in rows if r["log_file"] == name))
        log.start(spark.readStream.format("changelog").option("path", str(tmp_path / "in")).load(), f"{tmp_path}/checkpoint", available_now=True).awaitTermination()
    assert [tuple(r) for r in log.current("t").collect()] == [(1, 2)] and log.dead() is None


def test_source_splits_a_file_between_lines(tmp_path, monkeypatch):
    from changelake.sources import change_log

    monkeypatch.setattr(change_log, "SPLIT", 97)
    (tmp_path / "log.1").write_text("".join(json.dumps({"event_type": "X" * (i % 50), "log_pos": i}) + "\n" for i in range(200)))
    reader = ChangeLogSource({"path": str(tmp_path)}).streamReader(RAW)
    parts = reader.partitions(reader.initialOffset(), reader.latestOffset())
    assert len(parts) > 50 and [r[3] for p in parts for r in reader.read(p)] == list(range(200))


def test_rows_that_cannot_be_decoded(spark, tmp_path):
    rows = [record(1, "QUERY", sql="CREATE TABLE t (id INT PRIMARY KEY, v INT)"), record(2, "WRITE_ROWS", "t", (), [["1", "1"]]), record(3, "WRITE_ROWS", "t", ("id", "v"), [["2", "2"], ["3", "3", "4"]])]
    log = ChangeLog(spark, f"file://{tmp_path}/a")
    log.apply_raw(frame(spark, rows), 0)
    assert [tuple(r) for r in log.current("t").collect()] == [(2, 2)]
    assert log.dead().where("reason like '%without column names%'").count() == 2
    with pytest.raises(Exception, match="without column names"):
        ChangeLog(spark, f"file://{tmp_path}/b", on_bad_row="fail").apply_raw(frame(spark, rows), 0)


def test_running_sums_equal_one_window(spark):
    from pyspark.sql import functions as F

    from changelake.operators import order

    rng = random.Random(4)
    rows = [(None if i % 9 == 0 else "ab"[i % 7 > 1], rng.randint(0, 5000), i, rng.randint(0, 3)) for i in range(800)]
    df = spark.createDataFrame(rows, "k string, t int, id int, v int")
    got = {r["id"]: r["s"] for r in order.running_sum(df, ["k"], ["t", "id"], F.floor(F.col("t") / 100), F.col("v"), "s").collect()}
    assert got == {i: sum(w for k2, t2, i2, w in rows if k2 == k and (t2, i2) <= (t, i)) for k, t, i, _ in rows}


def test_chunk_plan_of_the_widest_keys(spark):
    from changelake.operators import snapshot

    keys = [-(2**63), -(2**62), -5, 0, 1, 2, 3, 2**53, 2**53 + 1, 2**62, 2**63 - 1]
    got = sorted(map(tuple, snapshot.chunk_plan(spark.createDataFrame([(k,) for k in keys], "k long"), "k", 4).collect()))
    assert got == [(0, keys[0], keys[3], 4), (1, keys[4], keys[7], 4), (2, keys[8], keys[10], 3)]
    assert snapshot.chunk_plan(spark.createDataFrame([], "k long"), "k", 4).count() == 0
