"""Incremental substring deduplication with a log-structured fingerprint index.

A window is `window` consecutive words (split at ASCII white space) of one document; a word is removed where a window that covers it also
starts in an earlier document: one of an earlier batch, or one of the same batch with a smaller id.

The index is a set of sorted immutable runs, tables bucketed and sorted by hash, one of each kind for each batch:

* documents: fingerprint of the word sequence -> first document. An exact copy needs no windows; it goes as a whole.
* anchors: the least hash of `anchor` words within each window (a winnowing sample, about one for thirteen windows) -> first row, and
  whether several have it. Equal windows have equal anchors, so windows matter only where their anchor is shared.
* windows: two independent 64-bit hashes of the windows with shared anchors -> first document.

A batch is merge-joined with every run on the hash (buckets meet without a shuffle of the run). Anchors that only now turn out to be shared
have their first row's windows added from the earlier texts, once in the anchor's life; where no anchor is new in that way, no earlier text
is read, and else only those between the least and the greatest id that is wanted. Hits are verified by the second hash over the same 50
words, so that two different windows pass with a chance of 2**-128. Then the batch's own runs are written, and once there are `fan` runs they
are compacted into one. A key costs one row in an index, however often it occurs; counts are summed before they are shuffled, and the rows of
hot keys (a passage or a text that a good part of all documents shares) stay in their tasks, to which those few keys are broadcast.

Rows are told apart by id and a hash of the text, ids give the order: one output row for each input row, also where an id repeats; rows that
repeat an id do not count as earlier than each other. Null and empty texts have no words; rows with a null id are returned whole and never
indexed; other columns are not read; empty tables stay empty.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import textkit
from .scratch import Scratch, among, attach

WINDOW = 50
ANCHOR = 25
FAN = 2
BATCHES = 3
_SEED = 0x2545F4914F6CDD1D


def _anchor_values(h: np.ndarray, window: int, anchor: int) -> np.ndarray:
    """For each window of words from a word on, the least hash of `anchor` words in it."""
    return textkit.sliding_min(textkit.grams(h, anchor), window - anchor + 1)


def _sums(x: np.ndarray, first: np.ndarray) -> np.ndarray:
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(x, dtype=np.uint64)])
    return (total[first[1:]] - total[first[:-1]]).view(np.int64)


def _sha(words: textkit.Words, doc: int, keep: np.ndarray | None = None) -> tuple[str, bytes]:
    a, b = int(words.first[doc]), int(words.first[doc + 1])
    if keep is None:
        kept = bytes(words.raw[words.offs[doc] : words.offs[doc + 1]]).split()
    else:
        raw, s, e = words.raw, words.start, words.end
        kept = [bytes(raw[s[i] : e[i]]) for i in (np.flatnonzero(keep) + a).tolist()] if b > a else []
    text = b" ".join(kept)
    return hashlib.sha256(text).hexdigest(), text


def _base(docs: DataFrame, window: int, anchor: int, keep_text: bool) -> DataFrame:
    """doc_id, row, n_words, f1 and f2 (of the word sequence), whole (digest with all words kept), anchors (distinct but for repeats far apart)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in textkit.pieces(batch, "text"):
                words = textkit.Words(part.column("text"))
                h, first = words.hashes(), words.first
                place = (np.arange(len(h)) - np.repeat(first[:-1], words.count)).astype(np.uint64)
                with np.errstate(over="ignore"):
                    f1 = _sums(textkit.mix(h + place * np.uint64(0x9E3779B97F4A7C15)), first)
                    f2 = _sums(textkit.mix(words.hashes(_SEED) ^ textkit.mix(place + np.uint64(77))), first)
                least = _anchor_values(h, window, anchor)
                at = np.flatnonzero(textkit.starts(first, window)) if len(least) else np.zeros(0, np.int64)
                doc = np.searchsorted(first, at, side="right") - 1
                value = least[at] if len(at) else np.zeros(0, np.uint64)
                new = np.ones(len(at), dtype=bool)
                new[1:] = (value[1:] != value[:-1]) | (doc[1:] != doc[:-1])
                counts = np.bincount(doc[new], minlength=len(words.count))
                done = [_sha(words, i) for i in range(len(words.count))]
                cols = [part.column("doc_id"), part.column("row"), pa.array(words.count.astype(np.int64)), pa.array(f1), pa.array(f2), pa.array([x for x, _ in done], pa.string()), textkit.long_lists(value[new], counts)]
                yield pa.RecordBatch.from_arrays(cols + [pa.array([t.decode() for _, t in done], pa.string())] * keep_text, names=["doc_id", "row", "n_words", "f1", "f2", "whole", "anchors"] + ["kept"] * keep_text)

    return textkit.map_arrow(docs, run, "doc_id long, row long, n_words long, f1 long, f2 long, whole string, anchors array<long>" + ", kept string" * keep_text)


def _windows(texts: DataFrame, window: int, anchor: int) -> DataFrame:
    """h1, h2, doc, row, at (number of its first word) of the windows of (doc_id, row, text, wanted) whose anchor is wanted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in textkit.pieces(batch, "text"):
                words = textkit.Words(part.column("text"))
                h = words.hashes()
                least, h1, h2 = _anchor_values(h, window, anchor), textkit.grams(h, window), textkit.grams(words.hashes(_SEED), window)
                rows = []
                for i, (a, n) in enumerate(zip(words.first[:-1].tolist(), words.count.tolist(), strict=True)):
                    if n >= window:
                        wanted = np.array(part.column("wanted")[i].values.to_numpy(zero_copy_only=False), dtype=np.int64).view(np.uint64)
                        own = np.flatnonzero(np.isin(least[a : a + n - window + 1], wanted))
                        rows.append((i, a, own))
                at = np.concatenate([own for _, _, own in rows] or [np.zeros(0, np.int64)])
                from_ = np.concatenate([own + a for _, a, own in rows] or [np.zeros(0, np.int64)])
                doc = np.repeat(np.array([i for i, _, _ in rows], np.int64), [len(own) for _, _, own in rows])
                own = [part.column(c).take(pa.array(doc)) for c in ("doc_id", "row")]
                yield pa.RecordBatch.from_arrays([pa.array(h1[from_].view(np.int64)), pa.array(h2[from_].view(np.int64)), *own, pa.array(at.astype(np.int32))], names=["h1", "h2", "doc", "row", "at"])

    return textkit.map_arrow(texts, run, "h1 long, h2 long, doc long, row long, at int")


def _cut(texts: DataFrame, window: int, keep_text: bool) -> DataFrame:
    """doc_id, row, n_words, n_removed, kept_sha256 of (doc_id, row, text, hits)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in textkit.pieces(batch, "text"):
                words = textkit.Words(part.column("text"))
                removed, done = [], []
                for i, n in enumerate(words.count.tolist()):
                    steps = np.zeros(n + 1, np.int64)
                    hits = np.array(part.column("hits")[i].values.to_numpy(zero_copy_only=False), np.int64)
                    np.add.at(steps, hits, 1)
                    np.add.at(steps, hits + window, -1)
                    keep = np.cumsum(steps)[:n] == 0
                    removed.append(int(n - keep.sum()))
                    done.append(_sha(words, i, keep))
                cols = [part.column("doc_id"), part.column("row"), pa.array(words.count.astype(np.int64)), pa.array(removed, pa.int64()), pa.array([x for x, _ in done], pa.string())]
                yield pa.RecordBatch.from_arrays(cols + [pa.array([t.decode() for _, t in done], pa.string())] * keep_text, names=["doc_id", "row", "n_words", "n_removed", "kept_sha256"] + ["kept"] * keep_text)

    return textkit.map_arrow(texts, run, "doc_id long, row long, n_words long, n_removed long, kept_sha256 string" + ", kept string" * keep_text)


class FingerprintIndex:
    """Runs of one corpus. Batches are ingested in order; each ingest returns what is left of its documents."""

    KEYS = {"documents": ["f1", "f2", "n_words"], "anchors": ["anchor"], "windows": ["h1", "h2"]}
    FIRST = {"documents": "bigint", "anchors": "struct<doc: bigint, row: bigint>", "windows": "bigint"}

    def __init__(self, spark: SparkSession, window: int = WINDOW, anchor: int = ANCHOR, fan: int = FAN, keep_text: bool = False):
        self.spark, self.window, self.anchor, self.fan, self.keep_text = spark, window, anchor, fan, keep_text
        self.scratch = Scratch(spark, "fingerprints")
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.name = f"fingerprints_{uuid.uuid4().hex}"
        self.runs: dict[str, list[str]] = {kind: [] for kind in self.KEYS}
        self.made = 0

    def _write(self, kind: str, df: DataFrame) -> str:
        """A run: key columns, first, several; one row for a key, bucketed and sorted by it, in the shared folder."""
        self.made += 1
        name = f"{self.name}_{kind}_{self.made}"
        df.write.format("parquet").option("path", f"{self.scratch.root}/{name}").bucketBy(self.buckets, *self.KEYS[kind]).sortBy(*self.KEYS[kind]).saveAsTable(name)
        return name

    def _forget(self, name: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        self.scratch.delete(name)

    def _joined(self, kind: str, own: DataFrame) -> DataFrame:
        """own (keys, lo, several, times) with first, several and old (the first of a run, if any), by merge joins with each run."""
        keys = self.KEYS[kind]
        out = own.withColumns({"old": F.lit(None).cast(self.FIRST[kind]), "was": F.lit(False)})
        for name in self.runs[kind]:
            run = self.spark.table(name).select(*keys, F.col("first").alias("__f"), F.col("several").alias("__s"))
            out = out.join(run, keys, "left").withColumns({"old": F.least("old", "__f"), "was": F.col("was") | F.coalesce("__s", F.lit(False))}).drop("__f", "__s")
        return out.select(*keys, F.coalesce("old", "lo").alias("first"), (F.col("several") | F.col("old").isNotNull()).alias("several"), "old", "was", "times")

    def _compact(self) -> None:
        for kind, names in self.runs.items():
            if len(names) >= self.fan:
                # Outer merge joins, in which buckets meet. (A grouped union of bucketed scans keeps some keys twice in Spark 4.1.)
                whole = self.spark.table(names[0]).select(*self.KEYS[kind], "first", "several")
                for n in names[1:]:
                    more = self.spark.table(n).select(*self.KEYS[kind], F.col("first").alias("__f"), F.col("several").alias("__s"))
                    either = F.coalesce("several", F.lit(False)) | F.coalesce("__s", F.lit(False))
                    whole = whole.join(more, self.KEYS[kind], "full").select(*self.KEYS[kind], F.least("first", "__f").alias("first"), either.alias("several"))
                self.runs[kind] = [self._write(kind, whole), *names]
                for n in names:
                    self._forget(n)
                self.runs[kind] = self.runs[kind][:1]

    def _add(self, kind: str, own: DataFrame) -> DataFrame:
        """Writes own as a run, joined with those before it, and returns it."""
        name = self._write(kind, self._joined(kind, own))
        self.runs[kind].append(name)
        return self.spark.table(name)

    def _earlier(self, history: DataFrame, wanted: DataFrame) -> DataFrame:
        """The rows of history whose id is wanted; ids outside their range are skipped by the scan."""
        low, high = wanted.agg(F.min("doc"), F.max("doc")).first()
        rows = history.select("doc_id", "text").where(F.col("doc_id").between(low, high))
        ids = self.scratch.table(wanted.select(F.col("doc").alias("doc_id")).distinct(), "ids")
        return among(rows, ids, "doc_id").withColumn("row", F.xxhash64("text"))

    def ingest(self, batch: DataFrame, history: DataFrame | None = None) -> DataFrame:
        """doc_id, n_words, n_removed, kept_sha256 (and kept) for each row of batch (doc_id, text). history: the documents ingested before."""
        keep, window = self.scratch.table, self.window
        self._compact()
        batch = batch.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("row"), "text")
        base = keep(_base(batch, window, self.anchor, self.keep_text), "base")
        known = base.where(F.col("doc_id").isNotNull() & (F.col("n_words") >= window))
        n = base.count()
        docs = self._add("documents", known.groupBy("f1", "f2", "n_words").agg(F.min("doc_id").alias("lo"), F.lit(False).alias("several"), F.count("*").alias("times")))
        firsts = attach(known, docs.select(*self.KEYS["documents"], F.col("first").alias("__first"), "times"), self.KEYS["documents"], n).withColumn("copy", F.col("__first") != F.col("doc_id"))
        others = base.where(F.col("doc_id").isNull() | (F.col("n_words") < window)).withColumns({"__first": F.col("doc_id"), "copy": F.lit(False)})
        state = keep(firsts.unionByName(others).drop("__first", "f1", "f2"), "state")
        self.scratch.drop(base)
        each = state.where(F.col("doc_id").isNotNull() & (F.col("n_words") >= window) & ~F.col("copy")).select(F.col("doc_id").alias("doc"), "row", F.explode("anchors").alias("anchor"))
        one = F.struct("doc", "row")
        own = each.groupBy("anchor").agg(F.min(one).alias("lo"), (F.min(one) < F.max(one)).alias("several"), F.count("*").alias("times"))
        shared = self._add("anchors", own).where("several")
        wanted = keep(attach(each, shared.select("anchor", "times"), ["anchor"], each.count(), "left_semi"), "wanted")
        texts = batch
        if history is not None:
            old = keep(shared.where("old is not null and not was").select("old.doc", "old.row", "anchor"), "old")
            if not old.isEmpty():
                texts = texts.unionByName(self._earlier(history, old))
                wanted = wanted.unionByName(old)
        wanted = wanted.groupBy(F.col("doc").alias("doc_id"), "row").agg(F.collect_set("anchor").alias("wanted"))
        texts = keep(texts.join(wanted, ["doc_id", "row"]).select("doc_id", "row", "text", "wanted"), "texts")
        found = keep(_windows(texts, window, self.anchor), "windows")
        first = self._add("windows", found.groupBy("h1", "h2").agg(F.min("doc").alias("lo"), (F.min("doc") < F.max("doc")).alias("several"), F.count("*").alias("times")))
        # Only windows of several documents can be hits, and only in others than the first.
        hits = attach(found, first.where("several").select("h1", "h2", "first", "times"), ["h1", "h2"], found.count()).where("first <> doc")
        hits = hits.groupBy(F.col("doc").alias("doc_id"), "row").agg(F.collect_set("at").alias("hits"))
        if history is not None:
            hits = hits.join(state.select("doc_id", "row").distinct(), ["doc_id", "row"], "left_semi")
        cut = keep(_cut(texts.select("doc_id", "row", "text").join(hits, ["doc_id", "row"]).select("doc_id", "row", "text", "hits"), window, self.keep_text), "cut")
        for done in (wanted, found, texts):
            if hasattr(done, "scratch_path"):
                self.scratch.drop(done)
        whole = state.where("not copy").join(cut.select("doc_id", "row").distinct(), ["doc_id", "row"], "left_anti")
        text = ["kept"] * self.keep_text
        nothing = {"n_removed": F.col("n_words"), "kept_sha256": F.sha2(F.lit(""), 256)} | {c: F.lit("") for c in text}
        cols = ["doc_id", "n_words", "n_removed", "kept_sha256", *text]
        gone = state.where("copy").withColumns(nothing).select(*cols)
        left = whole.withColumns({"n_removed": F.lit(0).cast("long"), "kept_sha256": F.col("whole")}).select(*cols)
        out = keep(left.unionByName(gone).unionByName(cut.select(*cols)), "left")
        self.scratch.drop(state)
        self.scratch.drop(cut)
        return out

    def close(self) -> None:
        """Drops the runs; what ingest returned stays."""
        for names in self.runs.values():
            for n in names:
                self._forget(n)
        self.runs = {kind: [] for kind in self.KEYS}


def dedup(docs: DataFrame, batches: int = BATCHES, window: int = WINDOW, anchor: int = ANCHOR, keep_text: bool = False) -> DataFrame:
    """A whole table, ingested in batches of ascending doc_id. From the second on, a batch's range of ids is as wide as all before it together,
    so that what is read of earlier texts adds up to less than the table, however many batches there are. They don't change the result."""
    docs = docs.select("doc_id", "text")
    low, high = docs.agg(F.min("doc_id"), F.max("doc_id")).first()
    index = FingerprintIndex(docs.sparkSession, window, anchor, keep_text=keep_text)
    try:
        if low is None:
            return index.ingest(docs)
        cuts = [low, *(low + ((high - low + 1) >> (batches - 1 - k)) for k in range(batches))]
        out = None
        for k in range(batches):
            if cuts[k] < cuts[k + 1]:
                own = docs.where((F.col("doc_id") >= cuts[k]) & (F.col("doc_id") < cuts[k + 1]))
                if out is None:
                    own = own.unionByName(docs.where("doc_id is null"))
                done = index.ingest(own, docs.where(F.col("doc_id") < cuts[k]) if out is not None else None)
                out = done if out is None else out.unionByName(done)
        return out
    finally:
        index.close()


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup(spark.read.parquet(f"{sf_dir}/documents.parquet")).select("doc_id", "n_words", "n_removed", "kept_sha256")
