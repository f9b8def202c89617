"""Packing, nearest neighbours, the pipeline and the queries."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from changelake.llm import ann, packing, queries
from changelake.llm.scratch import Scratch
from tests.conftest import SF


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(packing.vocabulary())


def test_ids_equal_whole_encoding(tokenizer):
    ids, rng = packing.Ids(packing.vocabulary()), random.Random(3)
    pool = "aAbéÉñßΣςİſ019.,'’sStTrReEdD!?%$#-_()| \n\t\x1c\x85 ́　中ⅣK☃\U0001f600<>|"
    for _ in range(100):
        texts = ["".join(rng.choice(pool) for _ in range(rng.randint(0, 30))) for _ in range(30)] + [None, ""]
        flat, at = ids.of(pa.array(texts, pa.string()))
        assert [flat[a:b].tolist() for a, b in zip(at[:-1], at[1:], strict=True)] == [tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]


def test_other_vocabularies_encode_whole_texts(tmp_path):
    import json

    path = packing.vocabulary()
    assert packing.splits_at_words(path)
    spec = json.load(open(path))
    spec["normalizer"] = {"type": "NFC"}
    other = tmp_path / "other.json"
    other.write_text(json.dumps(spec))
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(str(other))
    texts = ["The CAT sat", "a  b\n\nC", None, ""]
    flat, at = packing._ids(str(other)).of(pa.array(texts, pa.string()))
    assert not packing.splits_at_words(str(other))
    assert [flat[a:b].tolist() for a, b in zip(at[:-1], at[1:], strict=True)] == [whole.encode(t or "", add_special_tokens=False).ids for t in texts]


def test_pack_salts_grow_with_the_table(spark):
    """One length holds all rows: with a salt for each 50 rows, ranks still fill their sequences without gaps."""
    rows = spark.range(3000).selectExpr("id as doc_id", "0 as piece", "if(id % 100 = 0, 3, 7) as length", "id as ids_crc32").selectExpr("doc_id", "piece", "cast(length as long) as length", "ids_crc32")
    got = packing.pack(rows, Scratch(spark, "t"), capacity=16, salt_rows=50).collect()
    used = defaultdict(dict)
    for r in got:
        used[r["sequence_id"]][r["offset"]] = r["length"]
    assert len(got) == 3000 and sum(map(len, used.values())) == 3000
    for slots in used.values():
        at = 0
        for offset in sorted(slots):
            assert offset == at
            at += slots[offset]
        assert at <= 16


def best_fit(lengths, capacity):
    rooms = []
    for x in lengths:
        fits = [i for i, r in enumerate(rooms) if r >= x]
        if fits:
            i = min(fits, key=rooms.__getitem__)
            rooms[i] -= x
        else:
            rooms.append(capacity - x)
    return rooms


def test_plan_places_everything():
    rng = random.Random(4)
    for capacity in (5, 16, 64):
        for _ in range(60):
            h = {rng.randint(1, capacity): rng.randint(1, 50) for _ in range(rng.randint(0, 12))}
            used = defaultdict(list)
            for length, rank0, ranks, each, sequence0, offset0 in packing.plan(h, capacity):
                for r in range(rank0, rank0 + ranks):
                    slot = r - rank0
                    used[sequence0 + slot // each].append((offset0 + slot % each * length, length))
            assert sum(len(v) for v in used.values()) == sum(h.values())
            for slots in used.values():
                at = 0
                for offset, length in sorted(slots):
                    assert offset == at
                    at += length
                assert at <= capacity
            assert len(used) == len(best_fit(sorted((x for a, b in h.items() for x in [a] * b), reverse=True), capacity))


def test_pack_frame(spark, docs, corpus, tokenizer, empty):
    rows = docs.select("doc_id", "text")
    cut = packing.pieces(rows, packing.vocabulary(), capacity=64, keep_ids=True)
    got = packing.pack(cut, Scratch(spark, "t"), capacity=64).collect()
    own, sequences = defaultdict(dict), defaultdict(dict)
    for r in got:
        assert r["length"] == len(r["ids"]) and r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
        own[r["doc_id"]][r["piece"]] = (r["start"], r["ids"])
        sequences[r["sequence_id"]][r["offset"]] = r["length"]
    for i, t in corpus:
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1]
        assert [x for k in sorted(own[i]) for x in own[i][k][1]] == ids
        assert [own[i][k][0] for k in sorted(own[i])] == list(range(0, len(ids), 64))
    for slots in sequences.values():
        at = 0
        for offset in sorted(slots):
            assert offset == at
            at += slots[offset]
        assert at <= 64
    assert len(sequences) <= 1.02 * sum(r["length"] for r in got) / 64 + 2
    whole = packing.sequences(spark.createDataFrame(got)).collect()
    assert sum(len(r["ids"]) for r in whole) == sum(r["length"] for r in got)
    assert packing.pack(packing.pieces(empty, packing.vocabulary()), Scratch(spark, "t")).count() == 0
    twice = spark.createDataFrame([(None, "a"), (None, "a"), (1, None)], "doc_id long, text string")
    assert packing.pack(packing.pieces(twice, packing.vocabulary()), Scratch(spark, "t")).select("sequence_id", "offset").distinct().count() == 3


def nearest_brute(rows, asked, k):
    ids, x = np.array([i for i, _ in rows]), np.array([v for _, v in rows], float)
    out = {}
    for i, v in rows:
        if asked(i):
            score = x @ np.array(v)
            order = [j for j in np.lexsort((ids, -score)) if ids[j] != i][:k]
            out[i] = [int(ids[j]) for j in order]
    return out


def test_nearest_recall(spark):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(20, 32))
    rows = [(int(i), (centres[i % 20] + 0.7 * rng.normal(size=32)).tolist()) for i in range(3000)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    got = defaultdict(list)
    for r in ann.Index(df).search(F.col("vec_id") % 20 == 0, 20, block=64).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append(r["vec_id"])
    want = nearest_brute([(i, np.array(v, np.float32).tolist()) for i, v in rows], lambda i: i % 20 == 0, 20)
    assert set(got) == set(want)
    assert np.mean([len(set(got[q]) & set(want[q])) / 20 for q in want]) >= 0.9


def test_nearest_recall_as_shipped(spark, tmp_path):
    """100,000 vectors without structure, the hardest kind; the settings of the query."""
    import pyarrow.parquet as pq

    x = np.random.default_rng(8).normal(size=(100_000, 48)).astype(np.float32)
    x[70_000:70_100] = x[0]  # equal vectors, over batches and tasks
    ids = np.arange(len(x))
    for k in range(3):
        pq.write_table(pa.table({"vec_id": ids[k::3], "embedding": pa.FixedSizeListArray.from_arrays(pa.array(x[k::3].ravel()), 48).cast(pa.list_(pa.float32()))}), tmp_path / f"{k}.parquet")
    got = defaultdict(list)
    for r in ann.Index(spark.read.parquet(str(tmp_path))).search(F.col("vec_id") % 2000 == 0, 20).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["vec_id"], r["score"]))
    assert set(got) == set(range(0, 100_000, 2000))
    wide, hits = x.astype(float), []
    for i, rows in got.items():
        score = (wide * wide[i]).sum(axis=1)
        want = [j for j in np.lexsort((ids, -score))[:21] if j != i][:20]
        assert all(s == score[j] for j, s in rows) and [j for j, _ in rows] == sorted((j for j, _ in rows), key=lambda j: (-score[j], j))
        hits.append(len(set(want) & {j for j, _ in rows}) / 20)
    assert np.mean(hits) >= 0.9, np.mean(hits)
    assert [j for j, _ in got[0]] == list(range(70_000, 70_020))


def test_nearest_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (20, [0.0, 2.0]), (3, [1.0, 1.0]), (2, [1.0, 1.0]), (4, None), (5, [0.0, 0.0]), (6, [nan, 1.0]), (7, [inf, 1.0]), (8, [None, 1.0]), (9, [1.0]), (None, [1.0, 1.0]), (40, None)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = [tuple(r) for r in ann.Index(df).search(F.col("vec_id") % 20 == 0, 20).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 2, 1.0), (0, 2, 3, 1.0), (0, 3, 20, 0.0), (20, 1, 2, 2.0), (20, 2, 3, 2.0), (20, 3, 0, 0.0)]
    for none in (df.limit(0), df.where("vec_id = 4")):
        assert ann.Index(none).search(F.col("vec_id") % 20 == 0, 20).count() == 0


def test_quantiser_weighs_parallel_error():
    x = np.random.default_rng(5).normal(size=(1500, 16))

    def parallel(threshold):
        q = ann.Quantiser(x, threshold=threshold)
        codes = q.encode(x)
        back = q.centres[np.arange(q.groups), codes].reshape(len(x), -1)[:, :16]
        r, u = x - back, x / np.linalg.norm(x, axis=1, keepdims=True)
        return ((r * u).sum(1) ** 2).mean(), (r**2).sum(1).mean()

    (along, total), (plain_along, plain_total) = parallel(0.5), parallel(0.0)
    assert along < plain_along and total > plain_total * 0.98


def test_queries_run(spark):
    for name, f in queries.QUERIES.items():
        df = f(spark, SF)
        assert df.count() > 0, name


def test_pipeline_stages(spark):
    import corpus_pipeline as p

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame([(10**6, None, None, None, None), (None, "A clean sentence of the corpus, and no id.", "en", "s", 1), (10**6 + 1, "", "en", "s", 0)], docs.schema)
    docs = docs.unionByName(odd)
    before = {r["doc_id"]: r["text"] for r in docs.collect()}
    for name, stage in p.STAGES[:-1]:
        after = stage(spark, docs, SF)
        assert after.columns == docs.columns and after.dtypes == docs.dtypes, name
        rows = after.collect()
        assert len(rows) <= len(before) and {r["doc_id"] for r in rows} <= set(before)
        if name in ("language", "near_duplicates"):
            assert all(r["text"] == before[r["doc_id"]] for r in rows)
        docs = spark.createDataFrame(rows, docs.schema)
        before = {r["doc_id"]: r["text"] for r in rows}
        assert stage(spark, docs.limit(0), SF).count() == 0, name
    assert len(before) > 100
    packed = p.packing_stage(spark, docs, SF)
    assert {r["doc_id"] for r in packed.select("doc_id").collect()} == set(before)
    assert p.run(spark, SF).count() > 0
