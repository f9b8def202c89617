"""Span columns: array<struct<kind string, start int, end int, score double>> over the code points of a text, end exclusive."""

from __future__ import annotations

import bisect
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import textkit

SPANS = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("score", T.DoubleType())]))
ARROW = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))


def with_column(df: DataFrame, name: str, kind: T.DataType, make: Callable[[pa.RecordBatch], pa.Array], text_col: str) -> DataFrame:
    """df with one more column made from each batch; a column of that name is replaced. Batches are cut by bytes of text."""
    df = df.drop(name)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in textkit.pieces(batch, text_col):
                yield pa.RecordBatch.from_arrays([*part.columns, make(part)], names=[*part.schema.names, name])

    return textkit.map_arrow(df, run, T.StructType([*df.schema.fields, T.StructField(name, kind)]))


def find(df: DataFrame, text_col: str, out_col: str, finder: Callable[[str], list[tuple[str, int, int, float]]]) -> DataFrame:
    """Adds the spans that finder gives for each whole text; a null text has none."""

    def make(part: pa.RecordBatch) -> pa.Array:
        return pa.array([[dict(zip(("kind", "start", "end", "score"), s, strict=True)) for s in finder(t)] if t else [] for t in part.column(text_col).to_pylist()], type=ARROW)

    return with_column(df, out_col, SPANS, make, text_col)


def listed(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


def of_kinds(spans: Column, kinds: tuple[str, ...]) -> Column:
    return F.filter(spans, lambda s: s["kind"].isin(*kinds))


def ordered(spans: list[tuple[str, int, int, float]], kinds: tuple[str, ...], by_kind: bool) -> list[tuple[str, int, int, float]]:
    """By kind as listed, then start; or by start, then kind as listed."""
    rank = {k: i for i, k in enumerate(kinds)}
    return sorted(spans, key=lambda s: (rank[s[0]], s[1], s[2]) if by_kind else (s[1], rank[s[0]], s[2]))


def cut_out(text: str, spans: list[tuple[int, int, str]]) -> str:
    """The text with each [start, end) replaced; of overlapping spans, their union is replaced once, by the first one's text."""
    out, at = [], 0
    for start, end, new in sorted(spans):
        if start >= at:
            out += [text[at:start], new]
        at = max(at, end)
    return "".join(out) + text[at:]


def union(found: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Disjoint sorted spans that cover the same places."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(found):
        if out and a < out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def overlaps(disjoint: list[tuple[int, int]], start: int, end: int) -> bool:
    """Whether [start, end) meets one of the disjoint sorted spans."""
    i = bisect.bisect_left(disjoint, (end,))
    return i > 0 and disjoint[i - 1][1] > start
