"""Secret scans: two character Markov models, of random strings and of ordinary identifiers, compared by log-likelihood ratio.

Three base kinds are always reported: assign (a key name, = or :, and a value of 6+ characters), access (AKIA..., 20+) and hex (24+).
The method adds kind markov: other runs of 20+ token characters that hold a digit and both a letter, whose log-likelihood ratio per
character is over `threshold`. Added spans never overlap base spans.

Both models are order-2 character models with Laplace smoothing. They are trained from labelled samples: random strings are the values of
base matches, ordinary identifiers are the other words, all of them, of a sample of SAMPLE_DOCS documents at most, the least by a hash of id and
text (all, where there are fewer); generated random strings and identifiers made of the words stand beside them, so that a corpus without secrets trains too.

Rows: each input row gives one output row; a null or empty text has no spans; other columns pass through, and one named like the output
column is replaced; an empty table stays empty; repeated rows are each scored.
"""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import spans
from .sampling import bounded_sample

BASE = ("assign", "access", "hex")
KINDS = (*BASE, "markov")
SAMPLE_DOCS = 1000

_ASSIGN = re.compile(r"""(?:password|passwd|secret|token|api_?key)["']? *[:=] *["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
_ACCESS = re.compile("AKIA[A-Z0-9]+")
# A run of hex digits matches whole or not at all, so runs of 24+ are the matches of 24+ characters.
_HEX = re.compile("(?<![0-9a-f])[0-9a-f]{24,}")
# A run matches whole or not at all; = before it ends a name, and one or two behind it are padding where nothing follows them.
_TOKEN = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}+(?:={1,2}(?![A-Za-z0-9+/_=-]))?")
_WORD = re.compile(r"[A-Za-z_]{3,}")
_RANDOM_ALPHABETS = ("0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_")
_PLAIN = ("get", "set", "user", "name", "value", "index", "count", "list", "map", "config", "default", "request", "response", "handler", "table", "column", "version", "number", "string", "buffer", "session", "update", "delete", "create")
_ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
_CODE = {c: i for i, c in enumerate(_ALPHABET)}
_N = len(_ALPHABET) + 1


class Markov:
    """Order-2 character model over the token alphabet; anything else is one symbol. A string starts in a context of its own."""

    def __init__(self, strings: list[str]):
        pairs: Counter = Counter()
        totals: Counter = Counter()
        for s in strings:
            a = b = _N
            for c in s:
                k = _CODE.get(c, _N - 1)
                pairs[a, b, k] += 1
                totals[a, b] += 1
                a, b = b, k
        self.pairs, self.totals = pairs, totals
        ones: Counter = Counter()
        for (_, _, k), n in pairs.items():
            ones[k] += n
        total = sum(ones.values())
        self.ones = [(ones[k] + 1) / (total + _N) for k in range(_N)]

    def log_p(self, s: str) -> float:
        """Bits have no base here: natural log of the string's probability; unseen contexts fall back on single characters."""
        out, a, b = 0.0, _N, _N
        for c in s:
            k = _CODE.get(c, _N - 1)
            out += math.log((self.pairs.get((a, b, k), 0) + 8 * self.ones[k]) / (self.totals.get((a, b), 0) + 8))
            a, b = b, k
        return out


class Scanner:
    """Both models and the threshold."""

    def __init__(self, secrets: list[str], identifiers: list[str], threshold: float = 0.5):
        self.random, self.plain, self.threshold = Markov(secrets), Markov(identifiers), threshold

    def ratio(self, s: str) -> float:
        """Log-likelihood ratio per character; over 0: likelier a random string."""
        return (self.random.log_p(s) - self.plain.log_p(s)) / max(1, len(s))

    def find(self, text: str) -> list[tuple[str, int, int, float]]:
        """Spans of one text by start, then kind as listed."""
        base = base_spans(text)
        out = [(k, a, b, 1.0) for k, a, b in base]
        taken = spans.union([(a, b) for _, a, b in base])
        for m in _TOKEN.finditer(text):
            s = m[0]
            if not (any("0" <= c <= "9" for c in s) and any(c.isalpha() for c in s)):
                continue
            if spans.overlaps(taken, m.start(), m.end()):
                continue
            if (r := self.ratio(s)) > self.threshold:
                out.append(("markov", m.start(), m.end(), 1 / (1 + math.exp(-min(50.0, r * len(s))))))
        return spans.ordered(out, KINDS, by_kind=False)


def base_spans(text: str) -> list[tuple[str, int, int]]:
    out = [("assign", m.start(), m.end()) for m in _ASSIGN.finditer(text) if m.end() - m.start(1) >= 6]
    if "AKIA" in text:
        out += [("access", m.start(), m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    return out + [("hex", m.start(), m.end()) for m in _HEX.finditer(text)]


def labelled_samples(texts: list[str]) -> tuple[list[str], list[str]]:
    """Random strings and identifiers of the sample, with the generated ones."""
    import random

    rng = random.Random(7)
    secrets, words = [], set()
    for t in texts:
        found = base_spans(t)
        secrets += [m[1] for m in _ASSIGN.finditer(t) if len(m[1]) >= 16 and any(c.isdigit() for c in m[1])] + [t[a:b] for k, a, b in found if k != "assign"]
        words.update(_WORD.findall(spans.cut_out(t, [(a, b, " ") for _, a, b in found])))
    words = [*_PLAIN, *sorted(words)]
    rng.shuffle(words)
    secrets = sorted(set(secrets)) + ["".join(rng.choice(a) for _ in range(rng.randint(20, 48))) for a in _RANDOM_ALPHABETS for _ in range(1500)]
    made = []
    for _ in range(8000):
        part = [rng.choice(words) for _ in range(rng.randint(2, 4))]
        made.append(rng.choice((lambda p: "_".join(p).lower(), lambda p: p[0].lower() + "".join(x.title() for x in p[1:]), lambda p: "-".join(p).lower(), lambda p: "_".join(p).upper(), lambda p: "/".join(p)))(part) + rng.choice(("", "", str(rng.randint(0, 99)), f"_{rng.randint(1990, 2030)}", f"_v{rng.randint(1, 9)}")))
    return secrets, words + made


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample_docs: int = SAMPLE_DOCS, threshold: float = 0.5) -> Scanner:
    texts = docs.select(id_col, text_col)
    sample = bounded_sample(texts.where(F.col(text_col).isNotNull()), [id_col, text_col], sample_docs, texts.count()).select(text_col)
    return Scanner(*labelled_samples([r[0] for r in sample.collect()]), threshold)


def scan(df: DataFrame, scanner: Scanner, text_col: str = "text", out_col: str = "secrets") -> DataFrame:
    """Adds the spans of every whole text as out_col."""
    return spans.find(df, text_col, out_col, scanner.find)


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = scan(docs, train(docs)).select("doc_id", "secrets")
    counts = [F.size(spans.of_kinds(F.col("secrets"), (k,))).cast("long").alias(f"n_{k}") for k in BASE]
    return found.select("doc_id", *counts, F.sha2(spans.listed(spans.of_kinds(F.col("secrets"), BASE)), 256).alias("base_sha256"), spans.listed(F.col("secrets")).alias("spans"))
