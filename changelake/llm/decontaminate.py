"""Benchmark decontamination with a generalised suffix automaton of the normalised test items.

Texts are lower-cased (A-Z) and split into words of digits, ASCII letters and anything beyond ASCII. A window is `window` consecutive words
of an item; an item of fewer words, but not none, is one window. Document words stream through the automaton, which tracks the longest
suffix that occurs in some item; wherever that is as long as a window, the window's words are hit. A word that no item has resets the
match, so only runs of known words, found by vectorised hashing, are walked.

Items are cut into blocks of BLOCK_BYTES of text by hash of id and text, with an automaton each (one, as a rule). One pass over the
documents takes PASS_BLOCKS of them, whose words are split and hashed once; a larger benchmark takes more passes, so that what is broadcast
and held by a worker stays bounded.

Rows: each input row gives one output row; null and empty texts have no words and no hits; items whose text is null or has no words have no
windows; equal items all count; items with a null id hit as others do, and are together one item, whose id is null in the list; other columns pass through and columns named like the outputs are replaced; empty tables on either side
work.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import textkit

WINDOW = 10
BLOCK_BYTES = 1 << 20
PASS_BLOCKS = 8

HITS = T.StructType([T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()), T.StructField("starts", T.ArrayType(T.LongType())), T.StructField("ends", T.ArrayType(T.LongType())), T.StructField("items", T.ArrayType(T.StringType()))])
_HITS = pa.struct([("n_words", pa.int64()), ("n_hit", pa.int64()), ("starts", pa.list_(pa.int64())), ("ends", pa.list_(pa.int64())), ("items", pa.list_(pa.string()))])


class Automaton:
    """Suffix automaton of all items together; states are numbers, state 0 is the root."""

    def __init__(self, items: list[tuple[str | None, str]], window: int = WINDOW):
        words = textkit.Words(pa.array([t for _, t in items], pa.string()), textkit.ALNUM, lower=True)
        hashes = words.hashes()
        self.vocabulary = np.unique(hashes)
        tokens = np.searchsorted(self.vocabulary, hashes).tolist()
        self.filter = np.zeros(1 << 16, dtype=bool)
        self.filter[(self.vocabulary >> np.uint64(48)).astype(np.int64)] = True
        self.window = window
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        rows = [(name, tokens[a:b]) for (name, _), a, b in zip(items, words.first[:-1].tolist(), words.first[1:].tolist(), strict=True) if b > a]
        for _, item in rows:
            last = 0
            for w in item:
                last = self._extend(last, w)
        # Windows by the state that holds them, each with its length and items: full ones, and whole short items.
        self.windows: dict[int, list[tuple[int, set[str]]]] = {}
        self.least = min([window, *(len(item) for _, item in rows)])
        for name, item in rows:
            state, size = 0, min(window, len(item))
            for i, w in enumerate(item):
                state = self.next[state][w]
                if i + 1 >= size:
                    own = self.windows.setdefault(self._holder(state, size), [])
                    for n, names in own:
                        if n == size:
                            names.add(name)
                            break
                    else:
                        own.append((size, {name}))
        self.ends: list[list[tuple[int, frozenset[str]]] | None] = [None] * len(self.next)
        for state in sorted(range(len(self.next)), key=self.length.__getitem__):
            up = self.ends[self.link[state]] if state else None
            own = [(n, frozenset(names)) for n, names in self.windows.get(state, [])]
            self.ends[state] = [*own, *(up or [])] or None
        del self.windows

    def _holder(self, state: int, size: int) -> int:
        while self.length[self.link[state]] >= size and state:
            state = self.link[state]
        return state

    def _extend(self, last: int, w: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        if w in nxt[last]:
            q = nxt[last][w]
            if length[q] == length[last] + 1:
                return q
            return self._split(last, q, w)
        new = len(nxt)
        nxt.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p != -1 and w not in nxt[p]:
            nxt[p][w] = new
            p = link[p]
        if p != -1:
            q = nxt[p][w]
            link[new] = q if length[q] == length[p] + 1 else self._split(p, q, w)
        return new

    def _split(self, p: int, q: int, w: int) -> int:
        """A state of its own for the shorter strings of q that end a step behind p."""
        nxt, link, length = self.next, self.link, self.length
        copy = len(nxt)
        nxt.append(dict(nxt[q]))
        length.append(length[p] + 1)
        link.append(link[q])
        link[q] = copy
        while p != -1 and nxt[p].get(w) == q:
            nxt[p][w] = copy
            p = link[p]
        return copy

    def walk(self, tokens: list[int]) -> tuple[list[tuple[int, int]], set[str]]:
        """Word ranges hit in a run of known words, and the items whose windows occur."""
        state, size, spans, items = 0, 0, [], set()
        nxt, link, length, ends = self.next, self.link, self.length, self.ends
        for i, w in enumerate(tokens):
            while w not in nxt[state] and state:
                state = link[state]
                size = length[state]
            if w in nxt[state]:
                state = nxt[state][w]
                size += 1
            if ends[state]:
                most = 0
                for n, names in ends[state]:
                    if n <= size:
                        most = max(most, n)
                        items |= names
                if most:
                    spans.append((i + 1 - most, i + 1))
        return spans, items

    def find(self, words: textkit.Words, hashes: np.ndarray) -> dict[int, tuple[list[tuple[int, int]], set[str]]]:
        """Document -> word ranges (counted in the batch) and items."""
        out: dict[int, tuple[list[tuple[int, int]], set[str]]] = {}
        if not len(self.vocabulary) or not len(hashes):
            return out
        at = np.flatnonzero(self.filter[(hashes >> np.uint64(48)).astype(np.int64)])
        token = np.minimum(np.searchsorted(self.vocabulary, hashes[at]), len(self.vocabulary) - 1)
        known = self.vocabulary[token] == hashes[at]
        at, token = at[known], token[known]
        if not len(at):
            return out
        doc = np.searchsorted(words.first, at, side="right") - 1
        new = np.ones(len(at), dtype=bool)
        new[1:] = (at[1:] != at[:-1] + 1) | (doc[1:] != doc[:-1])
        begin = np.flatnonzero(new)
        end = np.append(begin[1:], len(at))
        for a, b in zip(begin[end - begin >= self.least].tolist(), end[end - begin >= self.least].tolist(), strict=True):
            spans, items = self.walk(token[a:b].tolist())
            if spans:
                own = out.setdefault(int(doc[a]), ([], set()))
                own[0].extend((int(at[a]) + x, int(at[a]) + y) for x, y in spans)
                own[1].update(items)
        return out


def _merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def blocks(items: DataFrame, id_col: str, text_col: str, block_bytes: int) -> Iterator[list[tuple[str | None, str]]]:
    """The items in blocks of about block_bytes, collected one after another."""
    items = items.where(F.col(text_col).isNotNull()).select(F.col(id_col).cast("string").alias("item"), F.col(text_col).alias("text"))
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-int(total) // block_bytes))
    for k in range(n):
        yield [(r[0], r[1]) for r in items.where(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == k).collect()]


def _names(found: set[str | None]) -> list[str | None]:
    return sorted(found, key=lambda x: (x is None, x or ""))


def find_leaks(df: DataFrame, items: DataFrame, text_col: str = "text", out_col: str = "leaks", item_id: str = "item_id", item_text: str = "text", window: int = WINDOW, block_bytes: int = BLOCK_BYTES, pass_blocks: int = PASS_BLOCKS) -> DataFrame:
    """Adds out_col: n_words, n_hit, the byte ranges [starts, ends) of hit passages in the text, and the ids of items with windows there."""
    out = df.drop(out_col)
    fields = out.schema.fields
    held = [df.sparkSession.sparkContext.broadcast(Automaton(block, window)) for block in blocks(items, item_id, item_text, block_bytes)]
    for first in range(0, len(held), pass_blocks):

        def run(batches: Iterator[pa.RecordBatch], shared=held[first : first + pass_blocks], again: bool = first > 0) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in textkit.pieces(batch, text_col):
                    words = textkit.Words(part.column(text_col), textkit.ALNUM, lower=True)
                    hashes = words.hashes()
                    found = [x.value.find(words, hashes) for x in shared]
                    prior = part.column(out_col) if again else None
                    rows = []
                    for i, n in enumerate(words.count.tolist()):
                        names: set[str | None] = set()
                        ranges = []
                        base = int(words.offs[i])
                        for own in found:
                            if i in own:
                                ranges += [(int(words.start[a]), int(words.end[b - 1])) for a, b in own[i][0]]
                                names |= own[i][1]
                        if prior is not None and (old := prior[i].as_py())["n_hit"]:
                            ranges += [(a + base, b + base) for a, b in zip(old["starts"], old["ends"], strict=True)]
                            names |= set(old["items"])
                        ranges = _merge(ranges)
                        hit = sum(int(np.searchsorted(words.start, b) - np.searchsorted(words.start, a)) for a, b in ranges)
                        rows.append({"n_words": n, "n_hit": hit, "starts": [a - base for a, _ in ranges], "ends": [b - base for _, b in ranges], "items": _names(names)})
                    cols = [c for c, name in zip(part.columns, part.schema.names, strict=True) if name != out_col]
                    yield pa.RecordBatch.from_arrays([*cols, pa.array(rows, _HITS)], names=[*(x for x in part.schema.names if x != out_col), out_col])

        out = textkit.map_arrow(out, run, T.StructType([*fields, T.StructField(out_col, HITS)]))
    return out


def decontaminate(df: DataFrame, items: DataFrame, text_col: str = "text", max_coverage: float = 0.5, min_words: int = 1, **options) -> DataFrame:
    """Removes hit passages where a document has min_words hit words or more, and whole documents of which more than max_coverage is hit.

    White space beside a passage stays. Columns and their order stay.
    """
    found = find_leaks(df, items, text_col, "__leaks", **options)
    kept = found.where(F.col("__leaks.n_hit") <= max_coverage * F.col("__leaks.n_words"))
    # Byte ranges: cut on the text's UTF-8 bytes, from the back of one passage to the front of the next.
    raw, s, e = F.encode(F.col(text_col), "UTF-8"), F.col("__leaks.starts"), F.col("__leaks.ends")
    froms, tos = F.concat(F.array(F.lit(0).cast("long")), e), F.concat(s, F.array(F.octet_length(text_col).cast("long")))
    cut = F.array_join(F.transform(F.arrays_zip(froms.alias("a"), tos.alias("b")), lambda r: F.decode(F.substring(raw, (r["a"] + 1).cast("int"), (r["b"] - r["a"]).cast("int")), "UTF-8")), "")
    new = F.when((F.col("__leaks.n_hit") >= min_words) & (F.col("__leaks.n_hit") > 0), cut).otherwise(F.col(text_col))
    return kept.select(*[new.alias(c) if c == text_col else F.col(f"`{c}`") for c in df.columns])


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = find_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text"))
    x = F.col("leaks")
    return found.select("doc_id", x["n_words"].alias("n_words"), x["n_hit"].alias("n_hit"), F.size(x["items"]).cast("long").alias("n_items"), F.sha2(F.concat_ws(",", F.array_sort(x["items"])), 256).alias("items_sha256"), (x["n_hit"] > 0).alias("contaminated"))
