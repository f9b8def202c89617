"""Identifier validation and quoting, as Python predicates and as columns."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What a name may be, and how long.
PATTERN = "^[a-zA-Z_][a-zA-Z0-9_]*$"
LONGEST = 255
_VALID = re.compile(PATTERN.rstrip("$") + r"\Z")


def is_valid(name: str) -> bool:
    return 1 <= len(name) <= LONGEST and bool(_VALID.match(name))


def require_valid(name: str) -> str:
    if not is_valid(name):
        raise ValueError(f"not an identifier: {name!r}")
    return name


def quote(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def is_valid_column(name: Column) -> Column:
    return name.rlike(PATTERN) & F.length(name).between(1, LONGEST)


def quote_column(name: Column) -> Column:
    return F.concat(F.lit("`"), F.replace(name, F.lit("`"), F.lit("``")), F.lit("`"))
