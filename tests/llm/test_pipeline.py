"""The pipeline against a brute-force version, and its odd rows."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

import corpus_pipeline
from changelake.llm import language_id, packing, pii
from tests.llm.test_rest import best_fit
from tests.llm.test_sequences import ALNUM, LOWER, groups_brute
from tests.llm.test_texts import PII, digits

FIELDS = "doc_id long, text string, lang string, source string, n_chars long"
ENGLISH = "the and of to in that was his with for had you not be her on at by which have or from this him but all she they were my".split()
GERMAN = "der die und das ist nicht ein zu den mit sich auf für von dem wird als auch es an werden aus er hat dass sie nach über größe".split()


def counts(texts, order):
    out = {}
    for t in texts:
        b = t.encode()
        for i in range(len(b)):
            for k in range(min(order, i) + 1):
                out.setdefault(b[i - k : i], Counter())[b[i]] += 1
    return out


def bits(seen, text, order):
    """Code length of a text by method C."""
    out, b = 0.0, text.encode()
    for i in range(len(b)):
        for k in range(min(order, i), -1, -1):
            if c := seen.get(b[i - k : i]):
                total = sum(c.values()) + len(c)
                if b[i] in c:
                    out -= np.log2(c[b[i]] / total)
                    break
                out -= np.log2(len(c) / total)
        else:
            out += 8
    return out


def in_language(rows):
    texts = defaultdict(list)
    for _, t, lang in rows:
        if t is not None and lang is not None:
            texts[lang].append(t)
    trees = [counts(texts[x], language_id.MAX_ORDER) for x in sorted(texts)]
    letters = Counter(c for own in texts.values() for t in own for c in t.encode())
    total = sum(letters.values())
    for row in rows:
        t = row[1] or ""
        if not any(c.isalpha() for c in t):
            continue
        cost = [bits(x, t, language_id.MAX_ORDER) for x in trees]
        least = min(cost)
        plain = sum(min(8.0, -np.log2((letters[c] + 0.5) / (total + 128))) for c in t.encode())
        sure = 1 / sum(2.0 ** max(-1000.0, least - x) for x in cost)
        if sure >= corpus_pipeline.MIN_LANGUAGE_SCORE and (plain - least) / len(t.encode()) >= corpus_pipeline.MIN_SAVED_BITS:
            yield row


def without_leaks(text, items, window=10):
    """Each occurrence of a window's words goes, from its first letter to its last; None: more than half of the words are hit."""
    low = text.translate(LOWER)
    words = [(m[0], m.start(), m.end()) for m in ALNUM.finditer(low)]
    hit, gone = set(), [False] * len(text)
    for item in items:
        own = ALNUM.findall((item or "").translate(LOWER))
        n = min(window, len(own))
        for g in {tuple(own[k : k + n]) for k in range(len(own) - n + 1)} if n else ():
            for k in range(len(words) - n + 1):
                if tuple(w for w, _, _ in words[k : k + n]) == g:
                    hit.update(range(k, k + n))
                    gone[words[k][1] : words[k + n - 1][2]] = [True] * (words[k + n - 1][2] - words[k][1])
    return None if 2 * len(hit) > len(words) else "".join(c for c, x in zip(text, gone, strict=True) if not x)


def redacted(text):
    """Texts here hold personal data of the base kinds only, whose spans don't meet."""
    keep = {"email": lambda s: True, "ip": lambda s: all(int(x) <= 255 for x in s.split(".")), "card": lambda s: 16 <= digits(s) <= 19 and pii.luhn("".join(c for c in s if c.isdigit())), "phone": lambda s: 8 <= digits(s) <= 15}
    found = sorted((m.start(), m.end(), k) for k, p in PII.items() for m in re.finditer(p, text) if keep[k](m[0]))
    for a, b, k in reversed(found):
        text = text[:a] + f"<{k.upper()}>" + text[b:]
    return text


@pytest.fixture(scope="module")
def tables():
    rng = random.Random(21)

    def prose(words, n):
        return " ".join(rng.choice(words) + rng.choice(("", "", "", ",", ".")) for _ in range(n))

    items = [prose(ENGLISH, 25), prose(GERMAN, 14), "one short item", None, ""]
    rows = [(prose(x, rng.randint(20, 90)), lang) for x, lang in ((ENGLISH, "en"), (GERMAN, "de")) for _ in range(20)]
    base = [t for t, _ in rows]
    rows += [(base[i], None) for i in (0, 3, 3, 25)]
    for i in range(5, 15):
        words = base[i].split()
        words[rng.randrange(len(words))] = "changed"
        rows.append((" ".join(words), "en"))
    rows += [(f"{prose(ENGLISH, 60)} {items[0]} {prose(ENGLISH, 20)}", "en"), (f"{prose(GERMAN, 30)}; {items[1].upper()}: {prose(GERMAN, 30)}", "de"), (items[0], "en"), (f"{prose(ENGLISH, 9)} one short item {prose(ENGLISH, 9)}", "en")]
    data = ("a.b@example.org", "10.20.30.40", "4111 1111 1111 1111", "+1 (555) 555-0100", "300.1.1.1", "4111 1111 1111 1112")
    rows += [(f"{prose(ENGLISH, 20)} {x} {prose(ENGLISH, 20)}", "en") for x in data]
    rows += [(prose(ENGLISH, 9000), "en"), (None, None), ("", "en"), (" \n", None), ("1234 5678", None), ("Привет мир, это русский текст для проверки", None), ("qxzj#vk@wq!!zxkj qqzj vvkk", None)]
    rng.shuffle(rows)
    return [(i, t, lang) for i, (t, lang) in enumerate(rows, 100)], list(enumerate(items))


def test_pipeline_equals_brute_force(spark, tables, tmp_path):
    from tokenizers import Tokenizer

    rows, items = tables
    spark.createDataFrame([(i, t, lang, None, None) for i, t, lang in rows], FIELDS).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    left = [(i, t) for i, t, _ in in_language(rows)]
    told = len(left)
    alone = {i for i, _, c in groups_brute(left) if i == c}
    left = [(i, t) for i, t in left if i in alone]
    clean = [(i, new) for i, t in left if (new := without_leaks(t, [t for _, t in items])) is not None]
    assert len(rows) - 7 <= told < len(rows) - 4 and len(left) <= told - 10 and len(clean) < len(left)
    assert sum(redacted(t) != t for _, t in clean) >= 4
    tokenizer, want = Tokenizer.from_file(packing.vocabulary()), set()
    for i, t in clean:
        ids = [*tokenizer.encode(redacted(t), add_special_tokens=False).ids, 1]
        for piece, at in enumerate(range(0, len(ids), 4096)):
            part = ids[at : at + 4096]
            want.add((i, piece, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    assert any(piece for _, piece, *_ in want)
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert len(got) == len(want) and {(r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got} == want
    sequences = defaultdict(dict)
    for r in got:
        sequences[r["sequence_id"]][r["offset"]] = r["length"]
    for slots in sequences.values():
        assert sorted(slots) == np.cumsum([0, *(slots[x] for x in sorted(slots))])[:-1].tolist() and sum(slots.values()) <= 4096
    assert sum(map(len, sequences.values())) == len(got) and len(sequences) <= len(best_fit(sorted((r["length"] for r in got), reverse=True), 4096))


def test_near_duplicate_stage_repeated_ids(spark):
    """Rows of one id are told apart by their texts; of the same id and text, one stays; null ids have no group."""
    a, b, c, d = (" ".join(f"{x}{i}" for i in range(30)) for x in "abcd")
    rows = [(1, a), (5, a), (5, b), (5, b), (7, c), (7, c), (8, c), (9, d + " one"), (9, d + " two"), (None, a), (None, a), (10, ""), (10, ""), (11, None)]
    docs = spark.createDataFrame([(i, t, "en", "s", None) for i, t in rows], FIELDS)
    for n in (1, 4):
        out = corpus_pipeline.near_duplicate_stage(spark, docs.repartition(n), "")
        assert out.columns == docs.columns
        got = [(r["doc_id"], r["text"]) for r in out.collect()]
        ninth = [t for i, t in got if i == 9]
        assert len(ninth) == 1 and ninth[0].startswith(d)
        assert Counter(x for x in got if x[0] != 9) == Counter([(1, a), (5, b), (8, c), (None, a), (None, a), (10, ""), (11, None)])
