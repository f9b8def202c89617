"""Toxicity by weak supervision.

Voters (lexicon words and stems found by greedy cover of the labelled toxic rows, fixed seed lexicons by category, text patterns, and one for the
absence of any lexicon word) vote toxic, clean or not at all on a sample. A generative label model estimates by expectation maximisation
the class prior and how often each voter votes and is right, anchored by the given labels, which are one more, noisy voter; voters that fire together more than
their class explains are one group, whose joint votes are modelled. Its posteriors are the soft labels of a linear classifier on the
presence of hashed words and stems, which scores every whole text.

The sample is bounded: SAMPLE_LABELLED labelled rows and SAMPLE_UNLABELLED others at most, the least by a hash of id and text.

Rows: each input row gives one output row; a null or empty text scores like a text without any known unit; where no label can be learned the
score is 0; labels that are null are not learned, nor are rows with a null id, which no fold holds out; of labels that contradict each other for one id, toxic counts; other columns pass through, and one named like the output is replaced; repeated rows are
each scored; an empty table stays empty.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import textkit
from .sampling import bounded_sample, fold, place

#: Rows that are learned from: labelled ones, and others.
SAMPLE_LABELLED = 4000
SAMPLE_UNLABELLED = 1000
#: Size of the model: voters that are mined, and units with a weight of their own, whose presence must tell the classes apart by so many
#: standard deviations.
LEXICON_VOTERS = 80
FEATURES = 300
CLEAR = 6.0
PREFIXES = (3, 4, 5, 6)
#: How often a given label is taken to be right.
LABELS_RIGHT = 0.97

#: Seed words by category.
SEEDS = {
    "insult": {"idiot", "moron", "stupid", "loser", "fool", "imbecile", "dumb", "idiota", "imbécil", "estúpido", "idiote", "crétin", "dummkopf", "trottel"},
    "contempt": {"pathetic", "worthless", "disgusting", "trash", "scum", "vermin", "clown", "basura", "asqueroso", "ordure", "abschaum", "ekelhaft", "wertlos"},
    "threat": {"kill", "die", "destroy", "hang", "matar", "morir", "tuer", "crever", "sterben", "umbringen"},
    "profanity": {"damn", "crap", "bastard", "mierda", "merde", "scheiße", "scheisse"},
}
_ADDRESS = {"you", "your", "ihr", "du", "tu", "vous", "usted", "vosotros"}
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_LOWER = {c: c + 32 for c in range(0x41, 0x5B)}

ABSTAIN, TOXIC, CLEAN = 0, 1, 2


def units(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(document, key) of each distinct unit of each text.

    Units are words (digits, ASCII letters in lower case, anything beyond ASCII) and their first PREFIXES bytes, each once, and once more
    for two or more, and three or more, occurrences in the text; so a family of words with one stem is a unit even if each is rare.
    """
    words = textkit.Words(col, textkit.ALNUM, lower=True)
    if not len(words.start):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    doc, size = words.doc_of(), words.end - words.start
    view = np.ndarray((len(words.data) - 7,), dtype="<u8", buffer=words.data, strides=(1,))[words.start]
    docs, keys = [doc], [words.hashes()]
    for k in PREFIXES:
        long = size > k
        docs.append(doc[long])
        keys.append(textkit.mix((view[long] & np.uint64((1 << (8 * k)) - 1)) ^ np.uint64(k << 56)))
    doc, key = np.concatenate(docs), np.concatenate(keys)
    order = np.lexsort((key, doc))
    doc, key = doc[order], key[order]
    new = np.flatnonzero(np.concatenate(([True], (doc[1:] != doc[:-1]) | (key[1:] != key[:-1]))))
    many = np.diff(np.append(new, len(doc)))
    docs, keys = [doc[new]], [key[new]]
    for n in (2, 3):
        more = new[many >= n]
        docs.append(doc[more])
        keys.append(textkit.mix(key[more] + np.uint64(n)))
    return np.concatenate(docs), np.concatenate(keys)


def word_keys(words: list[str]) -> np.ndarray:
    return textkit.Words(pa.array(words, pa.string()), textkit.ALNUM, lower=True).hashes() if words else np.zeros(0, np.uint64)


class Incidence:
    """Units of sample texts, those that fewer than two labelled toxic rows have left out (seed words always stay)."""

    def __init__(self, texts: list[str], gold: np.ndarray, step: int = 256):
        keep = [np.unique(word_keys([w for s in SEEDS.values() for w in sorted(s)]))]
        own = [units(pa.array([t], pa.string()))[1] for t, y in zip(texts, gold.tolist(), strict=True) if y == 1]
        key, n = np.unique(np.concatenate(own or [np.zeros(0, np.uint64)]), return_counts=True)
        self.keys = np.unique(np.concatenate([*keep, key[n >= 2]]))
        docs, cols = [], []
        for at in range(0, len(texts), step):
            doc, key = units(pa.array(texts[at : at + step], pa.string()))
            col = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            same = self.keys[col] == key
            docs.append(doc[same] + at)
            cols.append(col[same])
        doc, col = np.concatenate(docs), np.concatenate(cols)
        order = np.argsort(col, kind="stable")
        self.doc, self.first = doc[order], np.searchsorted(col[order], np.arange(len(self.keys) + 1))
        self.n = len(texts)

    def rows(self, col: int) -> np.ndarray:
        return self.doc[self.first[col] : self.first[col + 1]]

    def sums(self, weight: np.ndarray) -> np.ndarray:
        """For each unit, the weight of the texts that have it."""
        total = np.concatenate(([0.0], np.cumsum(weight[self.doc])))
        return total[self.first[1:]] - total[self.first[:-1]]


def mine_lexicon(x: Incidence, gold: np.ndarray, most: int = LEXICON_VOTERS, purity: float = 0.75) -> list[int]:
    """Units by greedy cover: each next one is in the most labelled toxic rows not covered yet, among units that are rarely elsewhere."""
    positives = int((gold == 1).sum())
    pos, neg = x.sums((gold == 1).astype(float)), x.sums((gold == 0).astype(float))
    pure = np.flatnonzero((pos >= 2) & (pos / (pos + neg + 0.5) >= purity))
    purest = pos / (pos + neg + 1)
    left, out = (gold == 1).astype(float), []
    total = np.zeros(len(x.keys))
    while len(out) < most and left.any():
        total[pure] = x.sums(left)[pure]
        best = int(np.lexsort((x.keys, -purest, -(total * purest)))[0])
        if total[best] < max(2, 0.004 * positives):
            break
        out.append(best)
        left[x.rows(best)] = 0
    return out


def votes(texts: list[str], x: Incidence, lexicon: list[int]) -> np.ndarray:
    """One row for each text, one column for each voter: lexicon units, seed categories, patterns, absence."""
    out = np.zeros((len(texts), len(lexicon) + len(SEEDS) + 4), dtype=np.int8)
    for j, unit in enumerate(lexicon):
        out[x.rows(unit), j] = TOXIC
    for j, seeds in enumerate(SEEDS.values(), len(lexicon)):
        for unit in np.searchsorted(x.keys, word_keys(sorted(seeds))).tolist():
            out[x.rows(unit), j] = TOXIC
    found = (out != ABSTAIN).any(axis=1)
    for i, t in enumerate(texts):
        letters = sum(c.isalpha() for c in t)
        addressed = found[i] and bool(_ADDRESS & set(_WORD.findall(t.translate(_LOWER))))
        shouted = letters > 40 and sum(c.isupper() for c in t) > 0.5 * letters
        out[i, -4:] = [TOXIC if addressed else ABSTAIN, TOXIC if shouted else ABSTAIN, TOXIC if "!!!" in t or "???" in t else ABSTAIN, ABSTAIN if found[i] else CLEAN]
    return out


class LabelModel:
    """P(votes | class) as a product over groups of voters, with the given labels as one more, noisy voter."""

    def __init__(self, v: np.ndarray, gold: np.ndarray, rounds: int = 25, link: float = 0.35, most: int = 4):
        """v: votes; gold: 1, 0 or -1 (unknown)."""
        v = np.concatenate([v, np.select([gold == 1, gold == 0], [TOXIC, CLEAN], ABSTAIN)[:, None].astype(np.int8)], axis=1)
        toxic, clean = (v == TOXIC).sum(1), (v == CLEAN).sum(1)
        q = np.where(gold >= 0, gold, np.clip((toxic + 0.1) / (toxic + clean + 0.2), 0.05, 0.95)).astype(float)
        self.groups = self._group(v, q, link, most)
        codes = [sum(v[:, j].astype(np.int64) * 3**i for i, j in enumerate(g)) for g in self.groups]
        for _ in range(rounds):
            self.prior = float(np.clip(q.mean(), 1e-4, 1 - 1e-4))
            log = np.full(len(v), np.log(self.prior / (1 - self.prior)))
            for g, c in zip(self.groups, codes, strict=True):
                k = 3 ** len(g)
                p1 = np.bincount(c, weights=q, minlength=k) + 0.1
                p0 = np.bincount(c, weights=1 - q, minlength=k) + 0.1
                if g == [v.shape[1] - 1]:  # the labels anchor the classes: how often they are right isn't learned
                    p1[[TOXIC, CLEAN]] = p1[[TOXIC, CLEAN]].sum() * np.array([LABELS_RIGHT, 1 - LABELS_RIGHT])
                    p0[[TOXIC, CLEAN]] = p0[[TOXIC, CLEAN]].sum() * np.array([1 - LABELS_RIGHT, LABELS_RIGHT])
                log += np.log(p1 / p1.sum() / (p0 / p0.sum()))[c]
            q = 1 / (1 + np.exp(-np.clip(log, -30, 30)))
        self.posterior = q
        said = v != ABSTAIN
        right = np.where(v == TOXIC, q[:, None], 1 - q[:, None])
        self.accuracies = (right * said).sum(0) / np.maximum(1e-9, said.sum(0))

    @staticmethod
    def _group(v: np.ndarray, q: np.ndarray, link: float, most: int) -> list[list[int]]:
        """Voters that are correlated within the classes, in groups of `most` at most; the labels stay alone."""
        n, m = v.shape
        fires = (v != ABSTAIN).astype(float)
        strength = np.zeros((m, m))
        for weight in (q, 1 - q):
            total = weight.sum()
            if total < 1:
                continue
            mean = weight @ fires / total
            cov = (fires * weight[:, None]).T @ fires / total - np.outer(mean, mean)
            spread = np.sqrt(np.maximum(1e-6, mean * (1 - mean)))
            strength = np.maximum(strength, np.abs(cov / np.outer(spread, spread)) * (total / n > 0.01))
        group = {j: [j] for j in range(m)}
        pairs = sorted(((strength[i, j], i, j) for i in range(m - 1) for j in range(i + 1, m - 1) if strength[i, j] > link), reverse=True)
        for _, i, j in pairs:
            a, b = group[i], group[j]
            if a is not b and len(a) + len(b) <= most:
                a.extend(b)
                for k in b:
                    group[k] = a
        return [list(g) for g in {id(g): g for g in group.values()}.values()]


class Classifier:
    """Logistic regression on the presence of units."""

    def __init__(self, keys: np.ndarray, weights: np.ndarray, bias: float):
        order = np.argsort(keys)
        self.keys, self.weights, self.bias = keys[order], weights[order], bias

    def score(self, col: pa.Array) -> np.ndarray:
        out = np.full(len(col), self.bias)
        if len(self.keys):
            doc, key = units(col)
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            same = self.keys[at] == key
            out += np.bincount(doc[same], weights=self.weights[at[same]], minlength=len(col))
        return np.where(out <= -500, 0.0, 1 / (1 + np.exp(-np.clip(out, -500, 500))))


def fit_linear(x: Incidence, soft: np.ndarray, always: list[int], l2: float = 1e-3, rounds: int = 400) -> Classifier:
    """Soft-label logistic regression; features: the units `always` and those whose presence tells the classes apart most clearly."""
    n1, n0 = max(1e-9, soft.sum()), max(1e-9, (1 - soft).sum())
    c1, c0 = x.sums(soft), x.sums(1 - soft)
    share = np.clip((c1 + c0) / (n1 + n0), 1e-9, 1 - 1e-9)
    z = np.abs(c1 / n1 - c0 / n0) / np.sqrt(share * (1 - share) * (1 / n1 + 1 / n0))
    clear = np.argsort(-z, kind="stable")[:FEATURES]
    cols = np.union1d(clear[z[clear] >= CLEAR], np.array(always, dtype=np.int64)).astype(np.int64)
    m = np.zeros((x.n, len(cols)), dtype=np.float32)
    for i, c in enumerate(cols.tolist()):
        m[x.rows(c), i] = 1
    w, b = np.zeros(len(cols)), 0.0
    each = np.where(soft > 0.5, 0.5 / n1, 0.5 / n0) * 2  # both classes weigh as much as the other
    m1, v1, mb, vb = np.zeros_like(w), np.zeros_like(w), 0.0, 0.0
    for t in range(1, rounds + 1):  # Adam
        p = 1 / (1 + np.exp(-np.clip(m @ w + b, -30, 30)))
        g = each * (p - soft)
        gw, gb = m.T @ g + l2 * w, float(g.sum())
        m1, v1, mb, vb = 0.9 * m1 + 0.1 * gw, 0.999 * v1 + 0.001 * gw**2, 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb**2
        rate = 0.1 / (1 - 0.9**t)
        w -= rate * m1 / (np.sqrt(v1 / (1 - 0.999**t)) + 1e-8)
        b -= rate * mb / (np.sqrt(vb / (1 - 0.999**t)) + 1e-8)
    return Classifier(x.keys[cols], w, b)


def learn(texts: list[str], gold: np.ndarray) -> tuple[Classifier, LabelModel | None]:
    """From sample texts with labels 1, 0 or -1 (unknown)."""
    if not (gold == 1).any() or not (gold == 0).any():
        return Classifier(np.zeros(0, np.uint64), np.zeros(0), 1000.0 if (gold == 1).any() else -1000.0), None
    x = Incidence(texts, gold)
    lexicon = mine_lexicon(x, gold)
    model = LabelModel(votes(texts, x, lexicon), gold)
    return fit_linear(x, model.posterior, lexicon), model


def train(docs: DataFrame, labels: DataFrame, sample_labelled: int = SAMPLE_LABELLED, sample_unlabelled: int = SAMPLE_UNLABELLED) -> Classifier:
    """docs (doc_id, text), labels (doc_id, toxic): rows that may be learned from."""
    labels = labels.where("doc_id is not null and toxic in (0, 1)").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    held = F.broadcast(bounded_sample(labels, ["doc_id"], sample_labelled))  # bounded by sample_labelled
    # An id may repeat without bound: of its rows, too, only the least by hash are collected.
    rows = docs.where("text is not null").join(held, "doc_id").orderBy(place("doc_id", "text"), "text").limit(sample_labelled).select("text", "toxic").collect()
    more = docs.select("doc_id", "text").where("doc_id is not null and text is not null").join(held.select("doc_id"), "doc_id", "left_anti")
    more = bounded_sample(more, ["doc_id", "text"], sample_unlabelled, docs.count()).select("text", F.lit(-1).alias("toxic")).collect()
    rows = sorted((r[0], int(r[1])) for r in [*rows, *more])
    return learn([t for t, _ in rows], np.array([y for _, y in rows]))[0]


def score(df: DataFrame, classifier: Classifier, text_col: str = "text", out_col: str = "score") -> DataFrame:
    """Adds out_col for every whole text."""
    df = df.drop(out_col)
    shared = df.sparkSession.sparkContext.broadcast(classifier)  # bounded by FEATURES and LEXICON_VOTERS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in textkit.pieces(batch, text_col):
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(shared.value.score(part.column(text_col)))], names=[*part.schema.names, out_col])

    return textkit.map_arrow(df, run, T.StructType([*df.schema.fields, T.StructField(out_col, T.DoubleType())]))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    held = fold("doc_id", 5) == 0
    learned = fold("doc_id", 5) > 0
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic").where(learned)
    out = score(docs, train(docs.where(learned), labels))
    return out.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
