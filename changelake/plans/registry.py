"""Versioned schemas of target tables. Columns keep their id through renames and type changes, so that old files stay readable."""

from __future__ import annotations

import copy
import json
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.types import convert
from ..model import DELETED, VERSION
from .ddl import Column, Operation, Statement


class SchemaError(ValueError):
    """A schema change that doesn't fit the table."""


class DestructiveBlocked(SchemaError):
    """A change that loses data, while those are not allowed."""


@dataclass
class Field:
    column_id: int
    name: str
    type: str
    nullable: bool = True
    default: str | None = None
    primary_key: bool = False
    #: What rows read that are older than the column: its default when it was added.
    initial: str | None = None


@dataclass
class Table:
    name: str
    fields: list[Field] = field(default_factory=list)
    next_id: int = 1
    version: int = 1
    dropped: bool = False
    #: The version with which the table was created, anew after a drop. Files of older versions are those of another table.
    created: int = 1

    @property
    def keys(self) -> list[str]:
        return [f.name for f in self.fields if f.primary_key]

    @property
    def columns(self) -> dict[str, str]:
        return {f.name: f.type for f in self.fields}

    def find(self, name: str) -> Field:
        for f in self.fields:
            if f.name == name:
                return f
        raise SchemaError(f"{self.name} has no column {name}")


class Registry:
    """Tables by name, with every version; kept as one JSON file that is replaced as a whole."""

    def __init__(self, allow_destructive: bool = True):
        self.tables: dict[str, Table] = {}
        self.history: dict[str, list[Table]] = {}
        self.allow_destructive = allow_destructive

    def get(self, name: str) -> Table:
        if name not in self.tables or self.tables[name].dropped:
            raise SchemaError(f"no table {name}")
        return self.tables[name]

    def has(self, name: str) -> bool:
        return name in self.tables and not self.tables[name].dropped

    def names(self) -> list[str]:
        return sorted(n for n, t in self.tables.items() if not t.dropped)

    def at(self, name: str, version: int) -> Table:
        return next(t for t in self.history[name] if t.version == version)

    def apply(self, s: Statement, at: datetime | None = None) -> list[str]:
        """Applies a statement whole or not at all; returns its warnings. at: when it ran, which is what a default of the present time means
        for the rows that are there."""
        if s.kind == "UNSUPPORTED" or s.table is None:
            return s.warnings
        if s.destructive and not self.allow_destructive:
            raise DestructiveBlocked(f"blocked: {s.sql}")
        warnings = list(s.warnings)
        if s.kind == "CREATE":
            if self.has(s.table):
                if not s.if_exists:
                    raise SchemaError(f"table {s.table} exists")
                return warnings
            old = self.tables.get(s.table)
            version = old.version + 1 if old else 1
            table = Table(s.table, next_id=old.next_id if old else 1, version=version, created=version)
            for c in s.columns:
                self._add(table, c, None)
            if not table.keys:
                warnings.append(f"{s.table} has no primary key: rows are appended, none replaces another")
        elif s.kind == "DROP":
            if not self.has(s.table):
                if not s.if_exists:
                    raise SchemaError(f"no table {s.table}")
                return warnings
            table = copy.deepcopy(self.tables[s.table])
            table.dropped, table.version = True, table.version + 1
        else:
            table = copy.deepcopy(self.get(s.table))
            table.version += 1
            for o in s.operations:
                warnings += self._alter(table, o, at)
        self.tables[s.table] = table
        self.history.setdefault(s.table, []).append(copy.deepcopy(table))
        return warnings

    def _add(self, table: Table, c: Column, after: str | None) -> None:
        if any(f.name == c.name for f in table.fields):
            raise SchemaError(f"{table.name} has a column {c.name}")
        at = 0 if after == "" else [f.name for f in table.fields].index(after) + 1 if after else len(table.fields)
        table.fields.insert(at, Field(table.next_id, c.name, c.target_type, c.nullable, c.target_default, c.primary_key))
        table.next_id += 1

    def _alter(self, table: Table, o: Operation, at: datetime | None = None) -> list[str]:
        if o.action == "ADD":
            if o.after:
                table.find(o.after)
            self._add(table, o.column, o.after)
            added = table.find(o.column.name)
            added.initial = _at(added.default, at)
            return []
        if o.action == "DROP":
            table.fields.remove(table.find(o.name))
            return [f"column {o.name} of {table.name} is dropped"]
        if o.action == "RENAME":
            own = table.find(o.name)
            if any(f.name == o.new_name for f in table.fields):
                raise SchemaError(f"{table.name} has a column {o.new_name}")
            own.name = o.new_name
            return []
        own = table.find(o.name if o.action == "CHANGE" else o.column.name)
        if o.column.name != own.name and any(f.name == o.column.name for f in table.fields):
            raise SchemaError(f"{table.name} has a column {o.column.name}")
        lossy = own.type != o.column.target_type and o.column.target_type != "string"
        own.name, own.type, own.nullable, own.default = o.column.name, o.column.target_type, o.column.nullable and not own.primary_key, o.column.target_default
        return [f"values of {own.name} that aren't {own.type} become NULL"] if lossy else []

    def to_json(self) -> str:
        return json.dumps({n: [vars(t) | {"fields": [vars(f) for f in t.fields]} for t in ts] for n, ts in self.history.items()}, sort_keys=True)

    @classmethod
    def from_json(cls, text: str, allow_destructive: bool = True) -> Registry:
        out = cls(allow_destructive)
        for name, versions in json.loads(text).items():
            out.history[name] = [Table(**(t | {"fields": [Field(**f) for f in t["fields"]]})) for t in versions]
            out.tables[name] = copy.deepcopy(out.history[name][-1])
        return out

    def save(self, spark: SparkSession, path: str) -> None:
        """Writes a new file beside the old one and moves it into place."""
        jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        target, new = jvm.org.apache.hadoop.fs.Path(path), jvm.org.apache.hadoop.fs.Path(path + ".new")
        fs = target.getFileSystem(conf)
        out = fs.create(new, True)
        out.write(bytearray(self.to_json().encode()))
        out.close()
        if fs.exists(target):
            fs.delete(target, False)
        if not fs.rename(new, target):
            raise OSError(f"could not move the registry to {path}")

    @classmethod
    def load(cls, spark: SparkSession, path: str, allow_destructive: bool = True) -> Registry:
        """The registry at path; the new file, if a save was cut short between deleting and moving; an empty one, if there is none."""
        jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        for p in (path, path + ".new"):
            where = jvm.org.apache.hadoop.fs.Path(p)
            fs = where.getFileSystem(conf)
            if fs.exists(where):
                return cls.from_json(spark.sparkContext.wholeTextFiles(p).values().first(), allow_destructive)
        return cls(allow_destructive)


def _at(default: str | None, at: datetime | None) -> str | None:
    """A default as a constant, where it is the present time and that is known."""
    if at is None or default is None:
        return default
    return {"localtimestamp()": f"TIMESTAMP_NTZ'{at:%Y-%m-%d %H:%M:%S}'", "current_date()": f"DATE'{at:%Y-%m-%d}'"}.get(default, default)


def physical(field_id: int) -> str:
    """Name of a column in change-log files."""
    return f"c{field_id}"


def view(log: DataFrame, table: Table) -> DataFrame:
    """Change-log files with the names and types of a schema version. A column that a file lacks has the default with which it was added;
    values that can't be cast are NULL."""
    have = {f.name: f.dataType.simpleString() for f in log.schema.fields}
    cols = []
    for f in table.fields:
        p = physical(f.column_id)
        if p not in have:
            older = F.lit(None) if f.initial is None else F.expr(f.initial)
            cols.append(older.cast(f.type).alias(f.name))
        elif have[p] == "string":
            cols.append(convert(F.col(p), f.type).alias(f.name))
        else:
            cols.append(F.col(p).try_cast(f.type).alias(f.name))
    return log.select(*cols, *[c for c in (VERSION, DELETED, "_seq", "_batch") if c in have])


def diff(spark: SparkSession, ours: dict[str, str], theirs: dict[str, str]) -> DataFrame:
    """column, kind of difference (missing, extra, type) between two column lists."""
    a = spark.createDataFrame(list(ours.items()), "name string, ours string")
    b = spark.createDataFrame(list(theirs.items()), "name string, theirs string")
    return differences(a, b)


def differences(a: DataFrame, b: DataFrame) -> DataFrame:
    kind = F.when(F.col("theirs").isNull(), "extra").when(F.col("ours").isNull(), "missing").when(F.col("ours") != F.col("theirs"), "type")
    return a.join(b, "name", "full_outer").withColumn("difference", kind).where("difference is not null").select("name", "difference")
