"""Language identification by prediction by partial matching.

Each language has a byte context tree of orders 0 to MAX_ORDER with frozen counts. A byte's probability in a context is count / (total +
distinct), and distinct / (total + distinct) is the escape to the next shorter context (method C, no exclusions); a context that a language
has not seen is skipped at no cost; below order 0 all 256 bytes are equally likely. A text's code length is the exact sum of -log2 over its
bytes, contexts starting afresh with each text; the language with the shortest code is predicted, and the score is its posterior under
equal priors. No context is pruned.

The trees are compiled into hash tables, two for each order from 2 on: (context, byte) -> code lengths in all languages, escapes included,
for whatever any language has seen, and context -> escapes, for the other bytes. Orders 0 and 1 are arrays. Most bytes of a text are found by
one lookup in the longest order.

Trees are learned from SAMPLE_DOCS labelled documents of each language at most, the least by a hash of id and text; that bounds the tables.

Beside the languages stands a background model, the order-0 statistics of all languages together (8 bits a byte at most). Contexts that do
not fit a text cost escapes: a text that the best tree codes much longer than the background is in none of the languages. `told` asks for that.

Rows: each input row gives one output row; a null text, or one without a letter, is `und` with score 0; so is everything where no labelled
row exists; ties go to the first language by name; null labels are not learned, nor are rows with a null id in the query, which no fold
holds out; other columns pass through and columns named like the outputs are replaced; an empty table stays empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import textkit
from .sampling import bounded_sample_by, fold

#: At most 6: a context and its byte are one 56-bit key.
MAX_ORDER = 3
SAMPLE_DOCS = 250
UNDETERMINED = "und"

_U = np.uint64
_EMPTY = _U(0xFFFFFFFFFFFFFFFF)


class Table:
    """Hash table from distinct keys to their numbers in the order given; open addressing over arrays."""

    def __init__(self, keys: np.ndarray):
        bits = max(4, int(2 * len(keys)).bit_length())
        self.shift, self.mask = _U(64 - bits), (1 << bits) - 1
        self.keys, self.rows = np.full(1 << bits, _EMPTY), np.zeros(1 << bits, np.int32)
        left, slot = np.arange(len(keys)), self._slots(keys)
        while len(left):
            free = np.flatnonzero(self.keys[slot] == _EMPTY)
            _, first = np.unique(slot[free], return_index=True)
            take = free[first]
            self.keys[slot[take]], self.rows[slot[take]] = keys[left[take]], left[take]
            stay = np.ones(len(left), dtype=bool)
            stay[take] = False
            left, slot = left[stay], (slot[stay] + 1) & self.mask

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((keys * _U(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Numbers of keys; -1: not there."""
        slot = self._slots(keys)
        have = self.keys.take(slot)
        out = np.where(have == keys, self.rows.take(slot), -1)
        left = np.flatnonzero((have != keys) & (have != _EMPTY))
        while len(left):
            at = (slot[left] + 1) & self.mask
            slot[left] = at
            have, own = self.keys[at], keys[left]
            same = have == own
            out[left[same]] = self.rows[at[same]]
            left = left[~same & (have != _EMPTY)]
        return out


def _windows(data: np.ndarray, n: int, order: int) -> np.ndarray:
    """For each byte, it and the `order` bytes before it as one number, the byte itself lowest."""
    out = data[:n].astype(np.uint64)
    for j in range(1, order + 1):
        out[j:] |= data[: n - j].astype(np.uint64) << _U(8 * j)
    return out


def _places(offs: np.ndarray, n: int, most: int) -> np.ndarray:
    """How many bytes of its text are before each byte, `most` at most."""
    out = np.full(n, most, dtype=np.int8)
    for i in range(most):
        at = offs[:-1] + i
        out[at[at < offs[1:]]] = i
    return out


def _low(keys: np.ndarray, size: int) -> np.ndarray:
    return keys & _U((1 << (8 * size)) - 1)


class Model:
    """Compiled context trees of all languages."""

    def __init__(self, texts: dict[str, list[str]], max_order: int = MAX_ORDER):
        if not 1 <= max_order <= 6:
            raise ValueError("max_order is 1 to 6")
        self.languages, self.order = sorted(texts), max_order
        if not self.languages:
            return
        raws = [textkit.as_bytes(pa.array(texts[x], pa.string())) for x in self.languages]
        rows = [(_windows(data, int(offs[-1]), max_order), _places(offs, int(offs[-1]), max_order)) for data, offs in raws]
        self.entries: list[Table | None] = []
        self.costs: list[np.ndarray] = []
        self.contexts: list[Table | None] = []
        self.escapes: list[np.ndarray] = []
        shorter, shorter_cost = np.zeros(0, np.uint64), np.zeros((0, len(self.languages)))
        for k in range(max_order + 1):
            counted = [np.unique(_low(w[place >= k], k + 1), return_counts=True) for w, place in rows]
            keys = np.unique(np.concatenate([x for x, _ in counted]))
            contexts, of_key = np.unique(keys >> _U(8), return_inverse=True)
            escape = np.zeros((len(contexts), len(self.languages)))
            cost = shorter_cost[np.searchsorted(shorter, _low(keys, k))] if k else np.full((len(keys), len(self.languages)), 8.0)
            for j, (own, n) in enumerate(counted):
                at = np.searchsorted(keys, own)
                total = np.bincount(of_key[at], weights=n, minlength=len(contexts))
                kinds = np.bincount(of_key[at], minlength=len(contexts))
                seen = kinds > 0
                escape[seen, j] = -np.log2(kinds[seen] / (total[seen] + kinds[seen]))
                cost[:, j] += escape[of_key, j]
                cost[at, j] = -np.log2(n / (total + kinds)[of_key[at]])
            shorter, shorter_cost = keys, cost
            self._compile(k, keys, cost, contexts, escape)
        pooled = np.zeros(256)
        for data, offs in raws:
            pooled += np.bincount(data[: offs[-1]], minlength=256)
        self.background = np.minimum(8.0, -np.log2((pooled + 0.5) / (pooled.sum() + 128))).astype(np.float32)

    def _compile(self, k: int, keys: np.ndarray, cost: np.ndarray, contexts: np.ndarray, escape: np.ndarray) -> None:
        langs = len(self.languages)
        if k == 0:
            self.zero = np.repeat(escape + 8.0 if len(escape) else np.full((1, langs), 8.0), 256, axis=0)
            self.zero[keys.astype(np.int64)] = cost
        elif k == 1:
            whole = np.broadcast_to(self.zero, (256, 256, langs)).copy()
            whole[contexts.astype(np.int64)] += escape[:, None]
            whole = whole.reshape(-1, langs)
            whole[keys.astype(np.int64)] = cost
            self.one = whole.astype(np.float32)
        if k < 2:
            self.entries.append(None)
            self.contexts.append(None)
        else:
            self.entries.append(Table(keys))
            self.contexts.append(Table(contexts))
        self.costs.append(cost.astype(np.float32))
        self.escapes.append(escape.astype(np.float32))

    def code_lengths(self, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bits of each text under each language, and under the background; data as textkit.as_bytes gives it."""
        n, docs = int(offs[-1]), len(offs) - 1
        out, plain = np.zeros((docs, len(self.languages))), np.zeros(docs)
        if not n or not self.languages:
            return out, plain
        window, place = _windows(data, n, self.order), _places(offs, n, self.order)
        bits = np.zeros((n, len(self.languages)), dtype=np.float32)
        left = np.arange(n)
        for k in range(self.order, 1, -1):
            ready = place[left] >= k
            at = left[ready]
            entry = self.entries[k].find(_low(window[at], k + 1))
            hit = entry >= 0
            bits[at[hit]] += self.costs[k].take(entry[hit], axis=0)
            missed = at[~hit]
            context = self.contexts[k].find(_low(window[missed], k + 1) >> _U(8))
            known = context >= 0
            bits[missed[known]] += self.escapes[k].take(context[known], axis=0)
            left = np.concatenate([left[~ready], missed])
        behind = place[left] > 0
        bits[left[behind]] += self.one.take(_low(window[left[behind]], 2).astype(np.int64), axis=0)
        bits[left[~behind]] += self.zero.take(data[left[~behind]], axis=0).astype(np.float32)
        full = np.flatnonzero(offs[1:] > offs[:-1])
        out[full] = np.add.reduceat(bits, offs[:-1][full], axis=0, dtype=np.float64)
        plain[full] = np.add.reduceat(self.background.take(data[:n]), offs[:-1][full], dtype=np.float64)
        return out, plain

    def predict(self, col: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
        """For each text the language, its posterior, and how many bits a byte it saves against the background (0 without a letter)."""
        data, offs = textkit.as_bytes(col)
        if not self.languages:
            return [UNDETERMINED] * len(col), np.zeros(len(col)), np.zeros(len(col))
        bits, plain = self.code_lengths(data, offs)
        letters = _has_letter(col, data, offs)
        best, least = bits.argmin(axis=1), bits.min(axis=1)
        with np.errstate(under="ignore"):
            score = 1 / np.exp2(np.maximum(least[:, None] - bits, -1000)).sum(axis=1)
        saved = (plain - least) / np.maximum(1, np.diff(offs))
        return [self.languages[b] if ok else UNDETERMINED for b, ok in zip(best, letters, strict=True)], np.where(letters, score, 0.0), np.where(letters, saved, 0.0)


_ASCII_LETTER = np.zeros(256, dtype=bool)
_ASCII_LETTER[0x41:0x5B] = _ASCII_LETTER[0x61:0x7B] = True


def _has_letter(col: pa.Array, data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(_ASCII_LETTER[data[: offs[-1]]])])
    out = sums[offs[1:]] > sums[offs[:-1]]
    for i in np.flatnonzero(~out & (offs[1:] > offs[:-1])).tolist():
        out[i] = any(c.isalpha() for c in col[i].as_py())
    return out


def train(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample_docs: int = SAMPLE_DOCS, max_order: int = MAX_ORDER) -> Model:
    """A model of the languages among the rows, from sample_docs rows of each at most."""
    many = {r[0]: r[1] for r in labelled.where(F.col(lang_col).isNotNull()).groupBy(lang_col).count().collect()}  # one row for each language
    rows = labelled.select(id_col, text_col, lang_col).where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    texts: dict[str, list[str]] = {}
    for lang, text in bounded_sample_by(rows, lang_col, [id_col, text_col], sample_docs, many).select(lang_col, text_col).collect():
        texts.setdefault(lang, []).append(text)
    return Model({k: v for k, v in texts.items() if any(v)}, max_order)


def identify(df: DataFrame, model: Model, text_col: str = "text", lang_col: str = "lang_pred", score_col: str = "score", saved_col: str | None = None) -> DataFrame:
    """Adds lang_col and score_col for every whole text; and in saved_col, if given, the bits a byte saved against the background model."""
    names = [lang_col, score_col, *([saved_col] if saved_col else [])]
    df = df.drop(*names)
    shared = df.sparkSession.sparkContext.broadcast(model)  # bounded by the sampled documents
    chunk = max(1 << 16, (1 << 20) // max(4, len(model.languages)))  # a byte takes four bytes for each language

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for part in textkit.pieces(batch, text_col, chunk):
                lang, score, saved = model.predict(part.column(text_col))
                made = [pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(saved, pa.float64())]
                yield pa.RecordBatch.from_arrays([*part.columns, *made[: len(names)]], names=[*part.schema.names, *names])

    kinds = (T.StringType(), T.DoubleType(), T.DoubleType())
    return textkit.map_arrow(df, run, T.StructType([*df.schema.fields, *(T.StructField(x, k) for x, k in zip(names, kinds))]))


def told(lang: str, score: str, saved: str, min_score: float, min_saved: float):
    """Whether a language could be told: it is sure enough, and its tree saves enough against the background."""
    return (F.col(lang) != UNDETERMINED) & (F.col(score) >= min_score) & (F.col(saved) >= min_saved)


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    part = fold("doc_id", 4)
    out = identify(docs.select("doc_id", "text"), train(docs.where((part != 2) & (part >= 0))))
    return out.select("doc_id", (part == 2).alias("held_out"), "lang_pred", "score")
