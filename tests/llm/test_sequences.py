"""Operators on word sequences against brute force: substring deduplication, n-gram join, decontamination."""

import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from changelake.llm import decontaminate, ngram_join, substring_dedup, textkit
from changelake.llm.graph import components
from changelake.llm.scratch import Scratch

SPACE = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def test_words_and_hashes():
    texts = ["a b  c\td", None, "", " x ", "héllo wörld " + "z" * 40, "a b c d e f", "zz" * 20]
    w = textkit.Words(pa.array(texts))
    got = [[bytes(w.raw[s:e]).decode() for s, e in zip(w.start[a:b], w.end[a:b], strict=True)] for a, b in zip(w.first[:-1], w.first[1:], strict=True)]
    assert got == [SPACE.findall(t or "") for t in texts]
    h, flat = w.hashes(), [x for g in got for x in g]
    assert len(set(h.tolist())) == len(set(flat)) and h[w.first[0]] == h[w.first[5]]
    for n in (1, 2, 3, 5, 7):
        g, ok = textkit.grams(h, n), textkit.starts(w.first, n)
        seen = defaultdict(set)
        for i in np.flatnonzero(ok):
            seen[tuple(flat[i : i + n])].add(int(g[i]))
        assert all(len(v) == 1 for v in seen.values()) and len({x for v in seen.values() for x in v}) == len(seen)
        assert ok.sum() == sum(max(0, len(x) - n + 1) for x in got)
    x = np.random.default_rng(1).integers(0, 99, 50)
    assert textkit.sliding_min(x, 26).tolist() == [x[i : i + 26].min() for i in range(25)]
    batch = pa.RecordBatch.from_arrays([pa.array(["ab", None, "c" * 9, "", "d"])], ["t"])
    assert [p.num_rows for p in textkit.pieces(batch, "t", 4)] == [2, 1, 2]


def dedup_brute(rows, window):
    words = [(i, SPACE.findall(t or "")) for i, t in rows]
    first = {}
    for i, w in sorted(words, key=lambda x: x[0]):
        for k in range(len(w) - window + 1):
            first.setdefault(tuple(w[k : k + window]), i)
    out = set()
    for i, w in words:
        gone = {j for k in range(len(w) - window + 1) if first[tuple(w[k : k + window])] < i for j in range(k, k + window)}
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.add((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest(), kept))
    return out


@pytest.mark.parametrize(("batches", "window", "anchor"), [(1, 50, 25), (4, 50, 25), (3, 12, 5)])
def test_substring_dedup(docs, corpus, batches, window, anchor):
    got = substring_dedup.dedup(docs, batches, window, anchor, keep_text=True)
    assert {tuple(r) for r in got.collect()} == dedup_brute(corpus, window) and got.count() == len(corpus)


def test_substring_dedup_odd_rows(spark, empty):
    text = " ".join(map(str, range(60)))
    rows = [(None, text), (1, text), (1, text), (2, text + " more"), (3, None)]
    got = substring_dedup.dedup(spark.createDataFrame(rows, "doc_id long, text string"), 2).collect()
    assert sorted((str(r["doc_id"]), r["n_words"], r["n_removed"]) for r in got) == [("1", 60, 0), ("1", 60, 0), ("2", 61, 60), ("3", 0, 0), ("None", 60, 0)]
    assert substring_dedup.dedup(empty).count() == 0


@pytest.mark.parametrize("batches", [1, 3])
def test_substring_dedup_repeated_ids(spark, corpus, batches):
    """Rows of one id share windows with others, with each other, and repeat as they are."""
    rng = random.Random(2)
    rows = [(i // 3, t) for i, t in corpus] + [(i // 3, t) for i, t in corpus[:40]] + [(rng.choice(corpus)[0], t) for _, t in corpus if t][:30]
    words = [f"w{i}" for i in range(200)]
    t1, t2, t3 = " ".join(words[:60]), " ".join(words[:50] + ["x"] * 30), " ".join(f"y{i}" for i in range(80))
    rows += [(1001, t1), (1005, t1), (1005, t2), (1007, t2 + " and more"), (1007, t3)]
    want = sorted(dedup_rows(rows, 50), key=str)
    got = substring_dedup.dedup(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), batches)
    got = sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in got.collect()), key=str)
    assert got == want
    assert sorted(r[2] for r in got if r[0] > 1000) == [0, 0, 50, 60, 80]


def dedup_rows(rows, window):
    words = [(i, SPACE.findall(t or "")) for i, t in rows]
    first = {}
    for i, w in words:
        for k in range(len(w) - window + 1):
            g = tuple(w[k : k + window])
            first[g] = min(first.get(g, i), i)
    for i, w in words:
        gone = {j for k in range(len(w) - window + 1) if first[tuple(w[k : k + window])] < i for j in range(k, k + window)}
        yield i, len(w), len(gone), hashlib.sha256(" ".join(x for k, x in enumerate(w) if k not in gone).encode()).hexdigest()


def test_attach_keeps_hot_keys_whole(spark, monkeypatch):
    from changelake.llm import scratch as module

    monkeypatch.setattr(module, "HOT_ROWS", 10)
    rows = spark.range(1000).selectExpr("if(id < 400, 0, id % 300) as k", "id")
    keyed = rows.groupBy("k").agg({"*": "count"}).withColumnRenamed("count(1)", "times").selectExpr("k", "k * 2 as v", "times")
    got = {tuple(r) for r in module.attach(rows, keyed, ["k"], 1000).select("id", "k", "v").collect()}
    assert got == {(i, k, 2 * k) for i in range(1000) for k in [0 if i < 400 else i % 300]}
    some = keyed.where("k % 2 = 0").drop("v")
    assert module.attach(rows, some, ["k"], 1000, "left_semi").count() == sum((0 if i < 400 else i % 300) % 2 == 0 for i in range(1000))


def shingles(t, k=5):
    w = SPACE.findall((t or "").translate(LOWER))
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])


def groups_brute(rows, percent=80):
    sets = {i: shingles(t) for i, t in rows}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = [i for i in sorted(sets) if sets[i]]
    for n, i in enumerate(ids):
        for j in ids[n + 1 :]:
            both = len(sets[i] & sets[j])
            if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    return {(i, len(sets[i]), find(i)) for i in sets}


@pytest.mark.parametrize("heavy", [1, 2, 32])
def test_ngram_join(docs, corpus, heavy, monkeypatch):
    """With low limits, nearly all lists are long, and every path is taken."""
    monkeypatch.setattr(ngram_join, "BLOCK", heavy)
    got = ngram_join.near_duplicates(docs, heavy=heavy)
    assert {tuple(r) for r in got.collect()} == groups_brute(corpus)


@pytest.mark.parametrize("seed", [1, 2])
def test_ngram_join_near_the_threshold(spark, seed):
    """Many documents of one long passage and some words of their own, whose similarities lie around the threshold."""
    rng = random.Random(seed)
    passage = [f"p{i}" for i in range(60)]
    rows = [(i, " ".join(passage[: rng.randint(50, 60)] + [f"w{rng.randint(0, 30)}" for _ in range(rng.randint(0, 14))])) for i in range(90)]
    got = ngram_join.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), heavy=3)
    assert {tuple(r) for r in got.collect()} == groups_brute(rows)


@pytest.mark.parametrize("heavy", [2, 32])
def test_ngram_join_contained_pairs(spark, heavy):
    """Sets of 120 to 320 shingles and their parts, at exactly 0.8 or just below it, with a decoy of smaller id that shares a long passage."""
    rng = random.Random(5)
    rows = []
    for i, n in enumerate([*range(120, 321, 10), *range(130, 161, 5)]):
        words = [f"v{rng.getrandbits(40)}" for _ in range(n + 4)]
        part = words[: n * 4 // 5 + 4 - i % 4 // 3]
        decoy = words[: n * 3 // 5] + [f"d{rng.getrandbits(40)}" for _ in range(n // 2)]
        rows += [(i, " ".join(decoy)), (1000 + 2 * i, " ".join((words, part)[i % 2])), (1001 + 2 * i, " ".join((part, words)[i % 2]))]
    want = groups_brute(rows)
    assert sum(i > 1000 and c == i - 1 for i, _, c in want) > 15
    got = ngram_join.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), heavy=heavy)
    assert {tuple(r) for r in got.collect()} == want


def test_ngram_join_odd_rows(spark, empty):
    rows = [(None, "a b c d e f"), (1, "a b c d e f"), (1, "a b c d e f"), (2, "A B C D E F"), (4, None)]
    got = ngram_join.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(map(str, map(tuple, got))) == ["(1, 2, 1)", "(1, 2, 1)", "(2, 2, 1)", "(4, 0, 4)", "(None, 2, None)"]
    assert ngram_join.near_duplicates(empty).count() == 0


def test_components(spark):
    edges = [(i, i + 1) for i in range(10, 40)] + [(5, 3), (3, 5), (7, 7), (50, 60), (60, 55)]
    got = {tuple(r) for r in components(spark.createDataFrame(edges, "a long, b long"), Scratch(spark, "t")).collect()}
    assert got == {(i, 10) for i in range(10, 41)} | {(3, 3), (5, 3), (50, 50), (55, 50), (60, 50)}


ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def leaks_brute(rows, items, window=10):
    grams = defaultdict(set)
    for i, t in items:
        w = ALNUM.findall((t or "").translate(LOWER))
        n = min(window, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            grams[tuple(w[k : k + n])].add(None if i is None else str(i))
    sizes = {len(g) for g in grams}
    for i, t in rows:
        w = ALNUM.findall((t or "").translate(LOWER))
        hit, names = set(), set()
        for n in sizes:
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in grams:
                    hit.update(range(k, k + n))
                    names |= grams[tuple(w[k : k + n])]
        yield i, len(w), len(hit), sorted(names, key=lambda x: (x is None, x or ""))


@pytest.mark.parametrize(("block_bytes", "pass_blocks"), [(1 << 20, 8), (200, 8), (200, 2)])
def test_decontaminate(spark, docs, corpus, block_bytes, pass_blocks):
    long = [t for _, t in corpus if t and len(t.split()) > 40]
    items = [(1, " ".join(long[0].split()[5:30])), (2, long[1].upper()), (3, "the of"), (4, None), (5, "..."), (6, " ".join(long[0].split()[10:35])), (7, " ".join(long[2].split()[:10])), (8, "the of"), (9, "zzz"), (None, " ".join(long[3].split()[:12])), (None, " ".join(long[0].split()[3:9] + ["q"] * 4))]
    found = decontaminate.find_leaks(docs, spark.createDataFrame(items, "item_id long, text string"), block_bytes=block_bytes, pass_blocks=pass_blocks)
    got = {r["doc_id"]: (r["leaks"]["n_words"], r["leaks"]["n_hit"], r["leaks"]["items"]) for r in found.collect()}
    assert got == {a: (b, c, d) for a, b, c, d in leaks_brute(corpus, items)}
    assert sum(c > 0 for _, c, _ in got.values()) > 3


def test_decontaminate_cuts(spark, docs):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    rows = [(1, f"before éé {item}, after it there are many more words than were cut out of it here"), (2, item), (3, "clean"), (4, None), (5, "")]
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    df = spark.createDataFrame([(a, b, "z") for a, b in rows], "doc_id long, text string, starts string")
    got = decontaminate.decontaminate(df, items)
    assert got.columns == df.columns
    assert {r["doc_id"]: r["text"] for r in got.collect()} == {1: "before éé , after it there are many more words than were cut out of it here", 3: "clean", 4: None, 5: ""}
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.decontaminate(df, none).count() == 5
    assert decontaminate.decontaminate(df.limit(0), items).count() == 0
