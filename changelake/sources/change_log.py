"""Streams of raw log records: a folder of JSON files, and a data source whose offsets are (file, position)."""

from __future__ import annotations

import json
import os
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from ..model import RAW
from ..operators.order import file_key

#: Bytes of a log file that one task reads.
SPLIT = 64 << 20


def json_stream(spark: SparkSession, path: str, max_files: int = 16) -> DataFrame:
    """Raw records (model.RAW) of JSON-lines files that appear in a folder."""
    return spark.readStream.schema(RAW).option("maxFilesPerTrigger", max_files).json(path)


class _Part(InputPartition):
    def __init__(self, file: str, start: int, end: int):
        self.file, self.start, self.end = file, start, end


def _whole_lines(path: str, step: int = 1 << 16) -> int:
    """Bytes up to the end of the last whole line; a line that is still being written waits for the next batch."""
    at = os.path.getsize(path)
    with open(path, "rb") as f:
        while at:
            low = max(0, at - step)
            f.seek(low)
            end = f.read(at - low).rfind(b"\n")
            if end >= 0:
                return low + end + 1
            at = low
    return 0


class _Reader(DataSourceStreamReader):
    """Each file holds one record a line; a position is a byte offset, so that a restart goes on within a file."""

    def __init__(self, options: dict):
        self.path = options["path"]
        self.latest_only = str(options.get("startingoffsets", options.get("startingOffsets", "earliest"))) == "latest"
        self.fail_on_loss = str(options.get("failondataloss", options.get("failOnDataLoss", "true"))).lower() == "true"
        self.names = [f.name for f in RAW.fields]

    def _files(self) -> list[str]:
        return sorted((f for f in os.listdir(self.path) if not f.startswith((".", "_"))), key=file_key)

    def _end(self) -> dict:
        files = self._files()
        return {"file": files[-1], "offset": _whole_lines(f"{self.path}/{files[-1]}")} if files else {"file": "", "offset": 0}

    def initialOffset(self) -> dict:
        return self._end() if self.latest_only else {"file": "", "offset": 0}

    def latestOffset(self) -> dict:
        return self._end()

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        files = self._files()
        if self.fail_on_loss and start["file"] and start["file"] not in files:
            raise RuntimeError(f"log file {start['file']} is gone; set failOnDataLoss to false to go on without what it held")
        out: list[InputPartition] = []
        for f in files:
            if (not start["file"] or file_key(start["file"]) <= file_key(f)) and end["file"] and file_key(f) <= file_key(end["file"]):
                a = start["offset"] if f == start["file"] else 0
                b = end["offset"] if f == end["file"] else os.path.getsize(f"{self.path}/{f}")
                out += [_Part(f, at, min(b, at + SPLIT)) for at in range(a, b, SPLIT)]
        return out

    def read(self, partition: _Part) -> Iterator[tuple]:
        """The lines that begin in the part, one after another."""
        with open(f"{self.path}/{partition.file}", "rb") as f:
            f.seek(max(0, partition.start - 1))
            if partition.start and f.read(1) != b"\n":
                f.readline()  # begun in the part before
            while f.tell() < partition.end and (line := f.readline()):
                if line.strip():
                    row = json.loads(line)
                    row["log_file"], row["log_pos"] = row.get("log_file") or partition.file, row.get("log_pos")
                    yield tuple(row.get(n) for n in self.names)

    def commit(self, end: dict) -> None:
        """Nothing to let go of: the files belong to their writer."""


class ChangeLogSource(DataSource):
    """format("changelog"), option path: a folder that all executors see; startingOffsets: earliest or latest; failOnDataLoss."""

    @classmethod
    def name(cls) -> str:
        return "changelog"

    def schema(self):
        return RAW

    def streamReader(self, schema):
        return _Reader(self.options)
