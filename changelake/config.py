"""Configuration: a YAML text with environment references, defaults and validation."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass, field

from .functions.tablefilter import TableFilter

class ConfigError(ValueError):
    pass


def expand(text: str, env: Mapping[str, str] | None = None) -> str:
    """Replaces ${V}, $V (unset: empty), ${V:-default} (unset or empty: default) and ${V:?message} (unset or empty: an error, the first one)."""
    env = os.environ if env is None else env
    out, at = [], 0
    while (dollar := text.find("$", at)) >= 0:
        out.append(text[at:dollar])
        value, at = _reference(text, dollar, env)
        out.append(value)
    return "".join(out) + text[at:]


def _name_end(text: str, at: int) -> int:
    """Behind the name that begins at `at`; `at` itself, where none does."""
    end = at
    while end < len(text) and text[end].isascii() and (text[end].isalpha() or text[end] == "_" or (end > at and text[end].isdigit())):
        end += 1
    return end


def _reference(text: str, dollar: int, env: Mapping[str, str]) -> tuple[str, int]:
    """What stands for the reference at a dollar sign, and where the text goes on. What is no reference stands for itself."""
    braced = text.startswith("{", dollar + 1)
    begin = dollar + 1 + braced
    end = _name_end(text, begin)
    if end == begin:
        return "$", dollar + 1
    name = text[begin:end]
    value = env.get(name, "")
    if not braced:
        return value, end
    close = text.find("}", end)
    rest = text[end:close]
    if close < 0 or rest and not rest.startswith((":-", ":?")):
        return "$", dollar + 1
    if rest and not value:
        if rest[1] == "?":
            raise ConfigError(f"required environment variable {name} is not set" + (f": {rest[2:]}" if rest[2:] else ""))
        value = rest[2:]
    return value, close + 1


@dataclass
class Pipeline:
    batch_size: int = 500
    batch_timeout: str = "2 seconds"
    max_retries: int = 3
    retry_delay_seconds: float = 1.0
    max_files_per_trigger: int = 16


@dataclass
class Snapshot:
    enabled: bool = True
    chunk_size: int = 10_000
    parallel_tables: int = 2
    timeout_seconds: int = 3600
    skip_data_load: bool = False
    lock_strategy: str = "auto"


@dataclass
class State:
    checkpoint_interval: str = "30 seconds"
    retention: str = "168 HOURS"


@dataclass
class Config:
    source_path: str = ""
    target_path: str = ""
    filter: TableFilter = field(default_factory=TableFilter)
    pipeline: Pipeline = field(default_factory=Pipeline)
    snapshot: Snapshot = field(default_factory=Snapshot)
    state: State = field(default_factory=State)
    allow_destructive_ddl: bool = True
    preserve_nullable: bool = True

    def validate(self) -> Config:
        def between(name: str, value: float, low: float, high: float) -> None:
            if not low <= value <= high:
                raise ConfigError(f"{name} must be between {low} and {high}, not {value}")

        for name in ("source_path", "target_path"):
            if not getattr(self, name):
                raise ConfigError(f"{name} is required")
        between("pipeline.batch_size", self.pipeline.batch_size, 1, 100_000)
        between("pipeline.max_retries", self.pipeline.max_retries, 0, 100)
        between("pipeline.retry_delay_seconds", self.pipeline.retry_delay_seconds, 0, 300)
        between("snapshot.chunk_size", self.snapshot.chunk_size, 1, 10_000_000)
        between("snapshot.parallel_tables", self.snapshot.parallel_tables, 1, 100)
        if self.snapshot.lock_strategy not in ("none", "no_lock", "flush_tables", "backup_locks", "auto"):
            raise ConfigError(f"unknown lock strategy {self.snapshot.lock_strategy!r}")
        return self


def _build(kind: type, values: dict, path: str = ""):
    known = kind.__dataclass_fields__
    for k in values:
        if k not in known:
            raise ConfigError(f"unknown key {path}{k}")
    nested = {"filter": TableFilter, "pipeline": Pipeline, "snapshot": Snapshot, "state": State}
    return kind(**{k: _build(nested[k], v or {}, f"{path}{k}.") if k in nested and kind is Config else v for k, v in values.items()})


def load(text: str, env: Mapping[str, str] | None = None) -> Config:
    """Config of a YAML text. Where PyYAML is missing, the text must be JSON, which is YAML too."""
    text = expand(text, env)
    try:
        import yaml

        values = yaml.safe_load(text)
    except ImportError:
        import json

        values = json.loads(text)
    return _build(Config, values or {}).validate()
