"""Source column types, defaults and values in Spark's terms.

`map_type` reads the whole type text, whatever its case and spacing: unsigned integers are widened, decimals beyond 38 digits stay text, and
values of enumerations keep their case. Values are converted by target type; zero dates are the epoch, and what can't be read is NULL, which
the caller may divert (see streaming.sink).
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Source type names by target.
SIGNED = {"TINYINT": "tinyint", "SMALLINT": "smallint", "MEDIUMINT": "int", "INT": "int", "INTEGER": "int", "BIGINT": "bigint"}
UNSIGNED = {"TINYINT": "smallint", "SMALLINT": "int", "MEDIUMINT": "int", "INT": "bigint", "INTEGER": "bigint", "BIGINT": "decimal(20,0)"}
PLAIN = {
    "FLOAT": "float",
    "DOUBLE": "double",
    "REAL": "double",
    "BOOL": "smallint",
    "BOOLEAN": "smallint",
    "BIT": "decimal(20,0)",
    "DATE": "date",
    "DATETIME": "timestamp_ntz",
    "TIMESTAMP": "timestamp_ntz",
    "TIME": "string",
    "YEAR": "int",
    "JSON": "string",
    "ENUM": "string",
    "SET": "array<string>",
    "CHAR": "string",
    "VARCHAR": "string",
    "TINYTEXT": "string",
    "TEXT": "string",
    "MEDIUMTEXT": "string",
    "LONGTEXT": "string",
    "BINARY": "binary",
    "VARBINARY": "binary",
    "TINYBLOB": "binary",
    "BLOB": "binary",
    "MEDIUMBLOB": "binary",
    "LONGBLOB": "binary",
    "GEOMETRY": "binary",
    "POINT": "binary",
    "LINESTRING": "binary",
    "POLYGON": "binary",
}
BARE_DECIMAL = (18, 4)
ZERO_DATES = ("", "0000-00-00", "0000-00-00 00:00:00")

_HEAD = re.compile(r"\s*([A-Za-z]+)\s*(?:\(\s*([^)]*)\))?(.*)", re.DOTALL)


def map_type(text: str) -> tuple[str, str | None]:
    """Spark type of a source type, and a warning or None."""
    m = _HEAD.match(text)
    if not m:
        return "string", f"unknown type {text!r}"
    name, args, rest = m[1].upper(), [a.strip() for a in (m[2] or "").split(",") if a.strip()], m[3].upper()
    if name == "TINYINT" and args == ["1"]:
        return "smallint", None
    if name in SIGNED:
        return (UNSIGNED if "UNSIGNED" in rest.split() else SIGNED)[name], None
    if name in ("DECIMAL", "NUMERIC", "DEC"):
        p, s = (int(args[0]), int(args[1]) if len(args) > 1 else 0) if args else BARE_DECIMAL
        return (f"decimal({p},{s})", None) if p <= 38 else ("string", f"{p} digits are kept as text")
    if name in PLAIN:
        return PLAIN[name], None
    return "string", f"unknown type {text!r}"


def type_column(text: Column) -> Column:
    """map_type as a column."""
    up = F.upper(F.trim(text))
    name = F.regexp_extract(up, "^([A-Z]+)", 1)
    unsigned = up.rlike(r"\bUNSIGNED\b")
    args = F.regexp_extract(up, r"^[A-Z]+\s*\(\s*([^)]*)\)", 1)
    p = F.coalesce(F.trim(F.try_element_at(F.split(args, ","), F.lit(1))).try_cast("int"), F.lit(BARE_DECIMAL[0]))
    s = F.when(args == "", F.lit(BARE_DECIMAL[1])).otherwise(F.coalesce(F.trim(F.try_element_at(F.split(args, ","), F.lit(2))).try_cast("int"), F.lit(0)))
    out = F.when((name == "TINYINT") & (F.trim(args) == "1"), "smallint")
    for k in SIGNED:
        out = out.when(name == k, F.when(unsigned, UNSIGNED[k]).otherwise(SIGNED[k]))
    out = out.when(name.isin("DECIMAL", "NUMERIC", "DEC"), F.when(p > 38, "string").otherwise(F.concat(F.lit("decimal("), p.cast("string"), F.lit(","), s.cast("string"), F.lit(")"))))
    for k, v in PLAIN.items():
        out = out.when(name == k, v)
    return out.otherwise("string")


def to_datetime(v: Column) -> Column:
    """Text as timestamp_ntz cut to milliseconds; zero dates are the epoch; a blank or T between date and time."""
    fine = v.rlike(r"^\d{4}-\d{2}-\d{2}[ T]\d{2}:\d{2}:\d{2}(\.\d+)?$")
    parsed = F.date_trunc("millisecond", F.when(fine, v).try_cast("timestamp_ntz")).cast("timestamp_ntz")
    return F.when(F.trim(v).isin(*ZERO_DATES), F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")).otherwise(parsed)


def to_date(v: Column) -> Column:
    """Text as date: a date, or a date and time whose date is kept; zero dates are the epoch."""
    fine = v.rlike(r"^\d{4}-\d{2}-\d{2}([ T]\d{2}:\d{2}:\d{2}(\.\d+)?)?$")
    return F.when(F.trim(v).isin(*ZERO_DATES), F.lit("1970-01-01").cast("date")).otherwise(F.when(fine, F.substring(v, 1, 10)).try_cast("date"))


def convert(v: Column, kind: str) -> Column:
    """A text value as the target type; NULL where it can't be."""
    if kind == "string":
        return v
    if kind == "timestamp_ntz":
        return to_datetime(v)
    if kind == "date":
        return to_date(v)
    if kind == "binary":
        return F.encode(v, "UTF-8")
    if kind == "array<string>":
        return F.when(v == "", F.array().cast("array<string>")).otherwise(F.split(v, ","))
    return F.trim(v).try_cast(kind)


def default_value(text: str | None, kind: str, nullable: bool) -> str | None:
    """A column default as a SQL expression of the target, or None: no default."""
    if text is None or text == "":
        return None
    up = text.strip().upper()
    if up == "NULL":
        return "NULL" if nullable else None
    if kind in ("tinyint", "smallint", "int", "bigint"):
        return up if re.fullmatch(r"[+-]?\d+", up) else "0"
    if kind in ("float", "double"):
        try:
            return str(float(up))
        except ValueError:
            return "0.0"
    if kind.startswith("decimal"):
        return up if re.fullmatch(r"[+-]?\d+(\.\d+)?", up) else None
    if kind == "date":
        if up in ("CURRENT_DATE", "CURRENT_DATE()", "CURDATE()"):
            return "current_date()"
        return "DATE'1970-01-01'" if text in ZERO_DATES else f"DATE'{text}'" if re.fullmatch(r"\d{4}-\d{2}-\d{2}", text) else None
    if kind == "timestamp_ntz":
        if up.startswith(("CURRENT_TIMESTAMP", "NOW(", "LOCALTIME")):
            return "localtimestamp()"
        return "TIMESTAMP_NTZ'1970-01-01 00:00:00'" if text in ZERO_DATES else f"TIMESTAMP_NTZ'{text}'" if re.fullmatch(r"\d{4}-\d{2}-\d{2}[ T]\d{2}:\d{2}:\d{2}(\.\d+)?", text) else None
    if kind == "string":
        return "''" if up.startswith("CURRENT_TIMESTAMP") else "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return None
