"""Which tables are replicated.

Excluded names, then excluded patterns reject; where anything is included, included names, then included patterns accept and all else is
rejected; otherwise everything is accepted. A rule meets `database.table` or the bare table name. Patterns aren't anchored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..model import DDL


@dataclass(frozen=True)
class TableFilter:
    include_tables: list[str] = field(default_factory=list)
    include_patterns: list[str] = field(default_factory=list)
    exclude_tables: list[str] = field(default_factory=list)
    exclude_patterns: list[str] = field(default_factory=list)

    def __post_init__(self) -> None:
        for p in [*self.include_patterns, *self.exclude_patterns]:
            re.compile(p)

    def accepts(self, database: str, table: str) -> bool:
        names = (f"{database}.{table}", table)

        def meets(tables: list[str], patterns: list[str]) -> bool:
            return any(n in tables for n in names) or any(re.search(p, n) for p in patterns for n in names)

        if meets(self.exclude_tables, self.exclude_patterns):
            return False
        return not (self.include_tables or self.include_patterns) or meets(self.include_tables, self.include_patterns)

    def column(self, database: Column, table: Column) -> Column:
        """The same as a predicate on columns; Catalyst evaluates it in generated code."""
        full = F.concat_ws(".", database, table)

        def meets(tables: list[str], patterns: list[str]) -> Column:
            out = F.lit(False)
            if tables:
                out = out | full.isin(*tables) | table.isin(*tables)
            for p in patterns:
                out = out | full.rlike(p) | table.rlike(p)
            return out

        keep = ~meets(self.exclude_tables, self.exclude_patterns)
        if self.include_tables or self.include_patterns:
            keep = keep & meets(self.include_tables, self.include_patterns)
        return keep

    def events(self, op: Column, database: Column, table: Column) -> Column:
        """For events: schema changes pass whatever their table."""
        return (op == DDL) | self.column(database, table)
