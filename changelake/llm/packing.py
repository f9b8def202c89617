"""Best-fit packing: the plan is made from a histogram of lengths, and pieces take planned slots by joining on their rank within a length.

1. Every document becomes token ids and an end mark, and is cut into pieces of `capacity` tokens (only longer ones are cut).
2. Pieces are counted by length: at most `capacity` rows, whatever the corpus.
3. The driver packs these counts, longest first, each length into the open sequences with the least room that still holds it. Equal
   sequences are one group with a count, so the work depends on the number of lengths and not of documents.
4. A piece's rank among those of its length is its salt's offset (counts by length and salt, summed up) plus its number within the salt;
   the plan's rank ranges then give sequence and offset. There is a salt for each SALT_ROWS pieces of the table, so that a length that most
   pieces have is spread over as many tasks as its share asks for.

Rows: each input row gives its pieces; a null text is an empty one, whose only token is the end mark; repeated rows and ids are packed
each by itself (equal rows take neighbouring ranks); an empty table gives an empty plan and no rows; other columns are not read.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import textkit
from .scratch import FEW, Scratch

CAPACITY = 4096
#: Pieces for each salt; the pieces of one length and salt are ranked in one task.
SALT_ROWS = 200_000
LEAST_SALTS = 16
#: Words whose ids a Python worker remembers; beyond that it starts afresh.
CACHE_WORDS = 2_000_000

#: ASCII marks that, behind a letter or digit, are always tokens of their own.
_MARKS = ".,;:!?|%&*$#()"
_SPLIT = np.ones(256, dtype=bool)
_SPLIT[[10, 32]] = False


#: How the vocabulary that Ids knows normalises and splits texts.
_NORMALIZER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]}
_SPLITTER = {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True}


def splits_at_words(path: str) -> bool:
    """Whether a tokenizer file normalises and splits as Ids takes for granted, with special tokens that hold no white space only."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    pre = spec.get("pre_tokenizer") or {}
    first = (pre.get("pretokenizers") or [{}])[0]
    marked = all(t["special"] and not t["normalized"] and not any(t[x] for x in ("lstrip", "rstrip", "single_word")) and t["content"].startswith("<|") and not any(c.isspace() for c in t["content"]) for t in spec["added_tokens"])
    return spec.get("normalizer") == _NORMALIZER and first == _SPLITTER and spec.get("post_processor") is None and marked


class WholeTexts:
    """Token ids of texts, each encoded as a whole: for any tokenizer file."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.encode = Tokenizer.from_file(path).encode_batch

    def of(self, col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        rows = [e.ids for e in self.encode([t or "" for t in col.to_pylist()], add_special_tokens=False)]
        return np.array([x for r in rows for x in r], np.uint32), np.concatenate([[0], np.cumsum([len(r) for r in rows], dtype=np.int64)]).astype(np.int64)


class Ids:
    """Token ids of texts by way of their words, of which each is encoded once.

    The vocabulary drops white space and no token or normalisation crosses a space or line feed, so a text's ids are those of its words;
    nor does one cross from a letter or digit to the marks behind it, and ASCII capitals count as small letters, so that most new words
    need no encoding of their own either. Words are known by a 64-bit hash: sorted arrays of hashes, each at least twice as long as the next,
    and where each one's ids are.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        self.encode = tokenizer.encode
        self.kind = np.uint16 if max(tokenizer.get_vocab().values()) < 1 << 16 else np.uint32
        self._reset()

    def _reset(self) -> None:
        self.levels: list[list[np.ndarray]] = []  # hashes, starts, sizes
        self.pool, self.used = np.zeros(1 << 16, self.kind), 0

    def _find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and sizes of the ids of hashes; start -1: unknown."""
        start, size = np.full(len(h), -1, np.int64), np.zeros(len(h), np.int64)
        for keys, starts, sizes in self.levels:
            at = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
            same = keys[at] == h
            start[same], size[same] = starts[at[same]], sizes[at[same]]
        return start, size

    def _keep(self, keys: np.ndarray, rows: list[list[int]]) -> None:
        size = np.array([len(r) for r in rows], np.int32)
        start = self.used + np.cumsum(size, dtype=np.int64) - size
        flat = np.array([x for r in rows for x in r], self.kind)
        if self.used + len(flat) > len(self.pool):
            self.pool = np.concatenate([self.pool[: self.used], np.zeros(max(len(flat), self.used // 4), self.kind)])
        self.pool[self.used : self.used + len(flat)] = flat
        self.used += len(flat)
        level = [keys, start, size]
        while self.levels and len(self.levels[-1][0]) < 2 * len(level[0]):
            old = self.levels.pop()
            order = np.argsort(np.concatenate([old[0], level[0]]), kind="stable")
            for i in range(3):  # one column after another, each freed before the next
                level[i] = np.concatenate([old[i], level[i]])[order]
                old[i] = None
        self.levels.append(level)

    def _learn(self, words: list[str], hashes: np.ndarray) -> None:
        halves = []
        for w in words:
            core = w.rstrip(_MARKS)
            head, tail = (core, w[len(core) :]) if core != w and core and core[-1].lower().isalnum() else (w, "")
            halves.append((head.lower() if head.isascii() else head, tail))
        parts = sorted({x for pair in halves for x in pair if x})
        own = textkit.Words(pa.array(parts, pa.string()), _SPLIT).hashes()
        start, size = self._find(own)
        ids = {x: self.pool[k : k + n].tolist() if k >= 0 else self.encode(x, add_special_tokens=False).ids for x, k, n in zip(parts, start.tolist(), size.tolist(), strict=True)}
        ids[""] = []
        new = start < 0
        keys = np.concatenate([hashes, own[new]])
        rows = [ids[a] + ids[b] for a, b in halves] + [ids[x] for x, n in zip(parts, new.tolist(), strict=True) if n]
        keys, first = np.unique(keys, return_index=True)
        self._keep(keys, [rows[k] for k in first.tolist()])

    def of(self, col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts one behind the other, and len + 1 offsets."""
        words = textkit.Words(col, _SPLIT)
        known, first, inverse = np.unique(words.hashes(), return_index=True, return_inverse=True)
        start, size = self._find(known)
        if (start < 0).any():
            if sum(len(keys) for keys, _, _ in self.levels) > CACHE_WORDS:
                self._reset()
                start[:] = -1
            unknown = start < 0
            new = first[unknown]
            self._learn([words.raw[a:b].tobytes().decode() for a, b in zip(words.start[new].tolist(), words.end[new].tolist(), strict=True)], known[unknown])
            start, size = self._find(known)
        start, size = start[inverse], size[inverse]
        behind = np.concatenate([np.zeros(1, np.int64), np.cumsum(size)])
        return self.pool[np.repeat(start - behind[:-1], size) + np.arange(behind[-1])], behind[words.first]


def _ids(path: str) -> Ids | WholeTexts:
    return Ids(path) if splits_at_words(path) else WholeTexts(path)


def pieces(df: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, end: int = 1, keep_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 and, on request, ids (array<int>), for each piece of each row."""
    fields = [T.StructField("doc_id", df.schema[id_col].dataType), T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()), T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType())]
    schema = T.StructType(fields + [T.StructField("ids", T.ArrayType(T.IntegerType()))] * keep_ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, last = textkit.held(f"ids of {tokenizer}", lambda: _ids(tokenizer)), np.array([end], np.uint32)
        for batch in batches:
            for part in textkit.pieces(batch, "text"):
                take, piece, start, length, crc, kept = [], [], [], [], [], []
                flat, behind = ids.of(part.column(1))
                for i, (a, b) in enumerate(zip(behind[:-1].tolist(), behind[1:].tolist(), strict=True)):
                    got = np.concatenate([flat[a:b], last])
                    for k, at in enumerate(range(0, len(got), capacity)):
                        own = got[at : at + capacity]
                        take.append(i)
                        piece.append(k)
                        start.append(at)
                        length.append(len(own))
                        crc.append(zlib.crc32(own.astype("<u4", copy=False)))
                        if keep_ids:
                            kept.append(own.view(np.int32))
                cols = [part.column(0).take(pa.array(take, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
                yield pa.RecordBatch.from_arrays(cols + [pa.array(kept, pa.list_(pa.int32()))] * keep_ids, names=schema.names)

    return textkit.map_arrow(df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), run, schema, holds=f"ids of {tokenizer}")


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Best fit over counts, longest first: rows (length, first rank, ranks, ranks in a sequence, first sequence, first offset).

    The pieces of this length with ranks from the first one on fill consecutive sequences, so many in each, at the offset and behind it.
    """
    open_by_room: dict[int, list[tuple[int, int]]] = {}
    rows, next_sequence = [], 0

    def place(length: int, rank: int, many: int, room: int, first: int, sequences: int) -> int:
        """Puts up to `many` pieces into these sequences, fully where they last; returns how many."""
        each = room // length
        full, rest = divmod(min(many, each * sequences), each)
        for per, n, at in ((each, full, first), (rest, 1 if rest else 0, first + full)):
            if n:
                rows.append((length, rank, per * n, per, at, capacity - room))
                rank += per * n
                if room - per * length:
                    open_by_room.setdefault(room - per * length, []).append((at, n))
        used = full + bool(rest)
        if used < sequences and room < capacity:
            open_by_room.setdefault(room, []).append((first + used, sequences - used))
        return full * each + rest

    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        while left:
            room = min((r for r in open_by_room if r >= length), default=None)
            if room is None:
                sequences = -(-left // (capacity // length))
                done = place(length, rank, left, capacity, next_sequence, sequences)
                next_sequence += sequences
            else:
                groups = open_by_room[room]
                first, n = groups.pop()
                if not groups:
                    del open_by_room[room]
                done = place(length, rank, left, room, first, n)
            left -= done
            rank += done
    return rows


def pack(cut: DataFrame, scratch: Scratch, capacity: int = CAPACITY, salt_rows: int = SALT_ROWS) -> DataFrame:
    """Adds sequence_id and offset to pieces (doc_id, piece, length, ...)."""
    spark = cut.sparkSession
    cut = scratch.table(cut, "pieces")
    salts = max(LEAST_SALTS, -(-cut.count() // salt_rows))
    salted = cut.withColumn("__salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(salts)).cast("int"))
    counts = scratch.table(salted.groupBy("length", "__salt").agg(F.count("*").alias("n")), "counts")
    histogram = {int(r[0]): int(r[1]) for r in counts.groupBy("length").agg(F.sum("n")).collect()}  # at most `capacity` rows
    rows = plan(histogram, capacity)
    slots = spark.createDataFrame(rows, "length long, rank0 long, ranks long, each long, sequence0 long, offset0 long")
    slots = F.broadcast(slots) if len(rows) <= FEW else slots
    before = counts.withColumn("__before", F.sum("n").over(Window.partitionBy("length").orderBy("__salt")) - F.col("n")).select("length", "__salt", "__before")
    # Partitioned like the ranks, so that beyond the size of a broadcast, this join moves no piece again.
    before = F.broadcast(before) if salts * len(histogram) <= FEW else before
    own = F.row_number().over(Window.partitionBy("length", "__salt").orderBy("doc_id", "piece"))
    ranked = salted.withColumn("__own", own).join(before, ["length", "__salt"]).withColumn("__rank", F.col("__own") - 1 + F.col("__before"))
    slot = F.col("__rank") - F.col("rank0")
    taken = ranked.join(slots, (ranked["length"] == slots["length"]) & (F.col("__rank") >= F.col("rank0")) & (F.col("__rank") < F.col("rank0") + F.col("ranks"))).drop(slots["length"])
    return taken.withColumns({"sequence_id": F.col("sequence0") + F.floor(slot / F.col("each")), "offset": F.col("offset0") + slot % F.col("each") * F.col("length")}).select(*cut.columns, "sequence_id", "offset")


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences themselves, from pieces with ids: sequence_id, ids (array<int>); a group holds at most `capacity` tokens."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"))


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op10_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    out = pack(pieces(docs, vocabulary()), Scratch(spark, "op10"))
    return out.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
