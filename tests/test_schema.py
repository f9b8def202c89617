"""Types, defaults, names, filters, statements and the registry."""

import pytest
from pyspark.sql import functions as F

from changelake.functions import identifiers, types
from changelake.functions.tablefilter import TableFilter
from changelake.plans.ddl import parse
from changelake.plans.registry import DestructiveBlocked, Registry, SchemaError, diff


def test_python_and_column_types_agree(spark):
    from changelake.catalog import TYPE_TEXTS

    df = spark.createDataFrame([(t,) for t in TYPE_TEXTS], "t string").select("t", types.type_column(F.col("t")).alias("k"))
    assert {r["t"]: r["k"] for r in df.collect()} == {t: types.map_type(t)[0] for t in TYPE_TEXTS}


VALUES = [
    ("", "timestamp_ntz", "1970-01-01 00:00:00"),
    ("0000-00-00", "date", "1970-01-01"),
    ("0000-00-00 00:00:00", "timestamp_ntz", "1970-01-01 00:00:00"),
    ("2024-01-01 10:00:00", "timestamp_ntz", "2024-01-01 10:00:00"),
    ("2024-01-01 10:00:00.123456", "timestamp_ntz", "2024-01-01 10:00:00.123"),
    ("2024-01-01T10:00:00", "timestamp_ntz", "2024-01-01 10:00:00"),
    ("2024-01-01 10:00:00", "date", "2024-01-01"),
    ("not a date", "timestamp_ntz", None),
    ("2024-02-30", "date", None),
    (None, "int", None),
    ("300", "tinyint", None),
    ("12.3456789", "decimal(10,2)", "12.35"),
    ("a,b", "array<string>", "[a, b]"),
]


@pytest.mark.parametrize(("text", "kind", "want"), VALUES)
def test_convert(spark, text, kind, want):
    got = spark.createDataFrame([(text,)], "v string").select(types.convert(F.col("v"), kind).cast("string")).first()[0]
    assert got == want


def test_identifiers():
    assert identifiers.is_valid("a_1") and not identifiers.is_valid("1a") and not identifiers.is_valid("") and not identifiers.is_valid("a" * 256) and not identifiers.is_valid("a\n")
    assert identifiers.quote("a`b") == "`a``b`"


def test_filter_order():
    f = TableFilter(include_patterns=["^production_db\\."], include_tables=["analytics_db.x"], exclude_patterns=["_temp$"], exclude_tables=["sessions"])
    assert f.accepts("production_db", "users") and f.accepts("analytics_db", "x")
    assert not f.accepts("production_db", "orders_temp") and not f.accepts("production_db", "sessions") and not f.accepts("other", "t")
    assert TableFilter().accepts("any", "thing")


def test_parse_details():
    s = parse("create table `a``b`.t (\n id int unsigned not null auto_increment, `key` varchar(3) default 'it''s, ok' comment 'x, y',\n e enum('a', 'b c'), unique key u (id), constraint c foreign key (id) references o (id)\n, primary key using btree (id)) engine=x")
    assert (s.kind, s.database, s.table, s.primary_key) == ("CREATE", "a`b", "t", ["id"])
    assert [(c.name, c.target_type, c.nullable, c.default) for c in s.columns] == [("id", "bigint", False, None), ("key", "string", True, "it's, ok"), ("e", "string", True, None)]
    assert parse("").kind == "UNSUPPORTED" and parse("CREATE TABLE").kind == "UNSUPPORTED"


def test_registry():
    r = Registry()
    r.apply(parse("CREATE TABLE t (id INT PRIMARY KEY, a TEXT, b INT)"))
    r.apply(parse("ALTER TABLE t CHANGE a z BIGINT, DROP COLUMN b, ADD COLUMN b DATE FIRST"))
    t = r.get("t")
    assert list(t.columns) == ["b", "id", "z"] and t.columns["z"] == "bigint" and t.version == 2
    assert {f.name: f.column_id for f in t.fields} == {"b": 4, "id": 1, "z": 2}
    with pytest.raises(SchemaError):
        r.apply(parse("ALTER TABLE t ADD COLUMN q INT, DROP COLUMN nope"))
    assert "q" not in r.get("t").columns  # whole or not at all
    again = Registry.from_json(r.to_json())
    assert again.get("t") == t and again.at("t", 1).columns == {"id": "int", "a": "string", "b": "int"}
    again.allow_destructive = False
    with pytest.raises(DestructiveBlocked):
        again.apply(parse("DROP TABLE t"))
    r.apply(parse("DROP TABLE IF EXISTS t"))
    assert not r.has("t") and r.apply(parse("DROP TABLE IF EXISTS t")) == []


def test_diff(spark):
    got = {tuple(r) for r in diff(spark, {"a": "int", "b": "int", "c": "int"}, {"b": "bigint", "c": "int", "d": "int"}).collect()}
    assert got == {("a", "extra"), ("b", "type"), ("d", "missing")}
