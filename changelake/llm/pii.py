"""PII: regular expressions propose spans, checksum validators confirm them, nearby context words adjust the score.

Four base kinds are always reported (score 0.6 and up): email, ip, card, phone. On top of these the method proposes weaker patterns,
which need a checksum or context words to reach `threshold`: iban (mod-97), bare_card (13 to 15 digits, Luhn, context), bare_phone (no
leading plus, context) and national_id (ddd-dd-dddd, context). Added spans never overlap base spans.

Every proposal is found in time linear in the text, however long its runs of digits or letters are.

Rows: each input row gives one output row; a null or empty text has no spans; other columns pass through, and one named like the output
column is replaced; an empty table stays empty; repeated rows are each scored.
"""

from __future__ import annotations

import bisect
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import spans

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "iban", "bare_card", "bare_phone", "national_id")

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DIGIT = re.compile("[0-9]")
# A run of digits either matches from its first digit or not at all, so looking back keeps matches the same and time linear.
_IP = re.compile(r"(?<![0-9])([0-9]+)\.([0-9]+)\.([0-9]+)\.([0-9]+)")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
_BARE_PHONE = re.compile(r"(?<![0-9A-Za-z+.-])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9A-Za-z-])")
_NATIONAL = re.compile(r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])")
_IBAN_LEAST = 15
#: Characters of an IBAN by country, in the registry.
_IBAN_SIZE = {c: n for n, cs in {15: "NO", 16: "BE", 18: "DK FI FO GL NL", 19: "MK SI", 20: "AT BA EE KZ LT LU XK", 21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU", 31: "MT SC", 32: "LC"}.items() for c in cs.split()}
_WORD = re.compile(r"\w+")

#: Words that raise the score of a kind when they stand within WINDOW characters before a span, and words that lower any score.
CONTEXT = {
    "email": {"email", "mail", "contact", "correo", "courriel"},
    "ip": {"ip", "address", "host", "server", "addr"},
    "card": {"card", "credit", "visa", "mastercard", "karte", "tarjeta", "carte"},
    "phone": {"phone", "tel", "call", "mobile", "fax", "telefon", "telefono", "téléphone"},
    "iban": {"iban", "account", "bank", "konto", "cuenta", "compte"},
    "bare_card": {"card", "credit", "visa", "amex", "mastercard", "karte", "tarjeta", "carte"},
    "bare_phone": {"phone", "tel", "call", "mobile", "fax", "telefon", "telefono", "téléphone"},
    "national_id": {"ssn", "social", "security", "insurance"},
}
AGAINST = {"version", "isbn", "serial", "order", "invoice", "sku"}
WINDOW = 48
PRIOR = {"email": 0.8, "ip": 0.6, "card": 0.8, "phone": 0.7, "iban": 0.8, "bare_card": 0.3, "bare_phone": 0.3, "national_id": 0.3}


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def mod97(iban: str) -> bool:
    s = iban.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


def _ibans(text: str) -> list[tuple[int, int]]:
    """Leftmost IBANs. A proposal may run on into the words behind a number, so each of its word ends is tried: first the one at the
    country's length, then from the last one back."""
    out, m = [], _IBAN.search(text)
    while m:
        a, at = m.start(), m.start() + 1
        ends = [b for b in range(m.end(), a, -1) if b == m.end() or text[b] == " "]
        size = {b: b - a - text.count(" ", a, b) for b in ends}
        for b in sorted(ends, key=lambda b, size=size, own=_IBAN_SIZE.get(text[a : a + 2]): size[b] != own):
            if size[b] >= _IBAN_LEAST and mod97(text[a:b]):
                out.append((a, b))
                at = b
                break
        m = _IBAN.search(text, at)
    return out


def _emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches of local@domain. Only the run of local characters before an @ and what stands behind it decide."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        before = text[done:at]
        run = len(before) - len(before.rstrip(_LOCAL))
        if run and (m := _DOMAIN.match(text, at + 1)):
            out.append((at - run, m.end()))
            done = m.end()
        else:
            done = at + 1
        at = text.find("@", max(at + 1, done))
    return out


def _octets(parts: tuple[str, ...]) -> bool:
    return all(len(p := x.lstrip("0")) <= 3 and int(p or 0) <= 255 for x in parts)


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def _score(kind: str, text: str, start: int) -> float:
    near = {w.lower() for w in _WORD.findall(text[max(0, start - WINDOW) : start])}
    return max(0.0, min(1.0, PRIOR[kind] + 0.2 * bool(near & CONTEXT[kind]) + 0.2 * (kind[:4] in ("bare", "nati")) * bool(near & CONTEXT[kind]) - 0.2 * bool(near & AGAINST)))


def find_pii(text: str, threshold: float = 0.6) -> list[tuple[str, int, int, float]]:
    """Spans of one text, by kind as listed, then start. Base spans stay whatever their score."""
    base = [("email", *x) for x in _emails(text)] if "@" in text else []
    more: list[tuple[str, int, int]] = []
    if _DIGIT.search(text):
        if "." in text:
            base += [("ip", m.start(), m.end()) for m in _IP.finditer(text) if _octets(m.groups())]
        base += [("card", m.start(), m.end()) for m in _CARD.finditer(text) if m.end() - m.start() >= 16 and 16 <= len(d := _digits(m[0])) <= 19 and luhn(d)]
        if "+" in text:
            base += [("phone", m.start(), m.end()) for m in _PHONE.finditer(text) if 8 <= len(_digits(m[0])) <= 15]
        more = [("iban", *x) for x in _ibans(text)]
        more += [("bare_card", m.start(), m.end()) for m in _CARD.finditer(text) if 13 <= m.end() - m.start() <= 29 and 13 <= len(d := _digits(m[0])) <= 15 and luhn(d)]
        more += [("bare_phone", m.start(), m.end()) for m in _BARE_PHONE.finditer(text)]
        more += [("national_id", m.start(), m.end()) for m in _NATIONAL.finditer(text)]
    out = [(k, a, b, max(0.6, _score(k, text, a))) for k, a, b in base]
    taken = spans.union([(a, b) for _, a, b, _ in out])
    for k, a, b in more:
        if (score := _score(k, text, a)) >= threshold and not spans.overlaps(taken, a, b):
            out.append((k, a, b, score))
            bisect.insort(taken, (a, b))
    return spans.ordered(out, KINDS, by_kind=True)


def detect(df: DataFrame, text_col: str = "text", out_col: str = "pii", threshold: float = 0.6) -> DataFrame:
    """Adds the spans of every whole text as out_col."""
    return spans.find(df, text_col, out_col, lambda t: find_pii(t, threshold))


def redact(df: DataFrame, text_col: str = "text", threshold: float = 0.6) -> DataFrame:
    """Replaces each span of the text by its kind in angle brackets; null texts stay null. Columns and their order stay."""
    import pyarrow as pa

    def make(part: pa.RecordBatch) -> pa.Array:
        return pa.array([spans.cut_out(t, [(a, b, f"<{k.upper()}>") for k, a, b, _ in found]) if t and (found := find_pii(t, threshold)) else t for t in part.column(text_col).to_pylist()], type=pa.string())

    return spans.with_column(df, "__new_text", df.schema[text_col].dataType, make, text_col).select(*[F.col("__new_text").alias(c) if c == text_col else F.col(f"`{c}`") for c in df.columns])


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = detect(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")).select("doc_id", "pii")
    base = spans.of_kinds(F.col("pii"), BASE)
    counts = [F.size(spans.of_kinds(F.col("pii"), (k,))).cast("long").alias(f"n_{k}") for k in BASE]
    return found.select("doc_id", *counts, F.sha2(spans.listed(base), 256).alias("base_sha256"), spans.listed(F.col("pii")).alias("spans"))
