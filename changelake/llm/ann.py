"""Approximate search for the largest inner product with score-aware (anisotropic) quantisation.

A quantiser of groups of WIDTH coordinates with 16 centres each is fitted on SAMPLE vectors at most, the least by a hash of id and vector. Its
loss weighs the residual's part along the vector `eta` times as much as the rest, since that part moves the scores of the queries that matter;
codes are chosen by coordinate descent under that loss, centres by weighted least squares. Every row is encoded and indexed (4 bits a
group). A search adds up table entries for all rows, two 4-bit codes at a time, and reranks the best with exact inner products, summed in
double precision in one order for every row, so that equal vectors have equal scores.

The number of rows that are reranked for a query, `depth`, depends on the table alone: DEPTH times the square root of its rows. A task takes
its rows in batches and keeps the `depth` best approximate scores that it has met, so that, however rows are dealt to tasks and batches, at
least the `depth` best of the whole table are reranked.

Queries come in blocks of about BLOCK; each is collected, broadcast, held against all rows, and its result written, before the next. Partial
results hold `k` rows for each query and task, and are merged by rank.

Rows: vectors that are null, zero, of another length than most (ties: the shorter), or hold null or non-finite components take no part, nor
do null ids; a query never meets rows of its own id; rows that repeat an id are candidates each, and one query (the least vector);
ties in score go to smaller ids; other columns are not read; empty tables give no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import textkit
from .sampling import bounded_sample, place
from .scratch import Scratch

WIDTH = 2
SAMPLE = 4000
BLOCK = 4096
DEPTH = 2.0
THRESHOLD = 0.2
CENTRES = 16


class Quantiser:
    """Centres (groups, 16, width), fitted under the anisotropic loss."""

    def __init__(self, x: np.ndarray, width: int = WIDTH, threshold: float = THRESHOLD, rounds: int = 6):
        n, self.dim = x.shape
        self.width, self.groups = width, -(-self.dim // width)
        self.groups += self.groups % 2  # two codes make a byte
        self.eta = max(1.0, (self.dim - 1) * threshold**2 / (1 - threshold**2))
        parts, unit = self._split(x), self._split(x / np.linalg.norm(x, axis=1, keepdims=True))
        rng = np.random.default_rng(5)
        pick = rng.choice(n, CENTRES, replace=n < CENTRES)
        self.centres = parts[pick].transpose(1, 0, 2).copy()
        for _ in range(4):  # plain k-means to start from
            for m in range(self.groups):
                code = ((parts[:, m, None] - self.centres[m]) ** 2).sum(-1).argmin(1)
                for c in range(CENTRES):
                    if (own := code == c).any():
                        self.centres[m, c] = parts[own, m].mean(0)
        codes = None
        for _ in range(rounds):
            codes = self.encode(x, codes)
            self._centre(parts, unit, codes)

    def _split(self, x: np.ndarray) -> np.ndarray:
        out = np.zeros((len(x), self.groups * self.width))
        out[:, : self.dim] = x
        return out.reshape(len(x), self.groups, self.width)

    def _along(self, parts: np.ndarray, unit: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """Each group's share of the residual's component along the vector."""
        left = parts - self.centres[np.arange(self.groups), codes]
        return (left * unit).sum(-1)

    def encode(self, x: np.ndarray, codes: np.ndarray | None = None, sweeps: int = 2) -> np.ndarray:
        parts, unit = self._split(x), self._split(x / np.linalg.norm(x, axis=1, keepdims=True))
        if codes is None:
            codes = np.stack([((parts[:, m, None] - self.centres[m]) ** 2).sum(-1).argmin(1) for m in range(self.groups)], axis=1)
        else:
            codes = codes.copy()
        along = self._along(parts, unit, codes)
        total = along.sum(1)
        for _ in range(sweeps):
            for m in range(self.groups):
                left = parts[:, m, None] - self.centres[m]
                own = (left * unit[:, m, None]).sum(-1)
                loss = (left**2).sum(-1) + (self.eta - 1) * ((total - along[:, m])[:, None] + own) ** 2
                best = loss.argmin(1)
                new = own[np.arange(len(x)), best]
                total += new - along[:, m]
                along[:, m], codes[:, m] = new, best
        return codes

    def _centre(self, parts: np.ndarray, unit: np.ndarray, codes: np.ndarray) -> None:
        along = self._along(parts, unit, codes)
        total, w, eye = along.sum(1), self.eta - 1, np.eye(self.width)
        for m in range(self.groups):
            u, rest = unit[:, m], total - along[:, m]
            for c in range(CENTRES):
                own = codes[:, m] == c
                if own.any():
                    a = own.sum() * eye + w * u[own].T @ u[own]
                    b = (parts[own, m] + w * (rest[own] + (parts[own, m] * u[own]).sum(-1))[:, None] * u[own]).sum(0)
                    self.centres[m, c] = np.linalg.solve(a, b)
            now = ((parts[:, m] - self.centres[m, codes[:, m]]) * u).sum(-1)
            total, along[:, m] = rest + now, now

    def pack(self, codes: np.ndarray) -> np.ndarray:
        return (codes[:, 0::2] | codes[:, 1::2] << 4).astype(np.uint8)

    def tables(self, queries: np.ndarray) -> np.ndarray:
        """(queries, groups / 2, 256): what a byte of code adds to a query's score."""
        t = np.einsum("qmw,mcw->qmc", self._split(queries), self.centres).astype(np.float32)
        return (t[:, 1::2, :, None] + t[:, 0::2, None, :]).reshape(len(queries), self.groups // 2, 256)


def usable(vector: Column, dim: int) -> Column:
    fine = F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    return (F.size(vector) == dim) & fine & F.exists(vector, lambda v: v != 0)


def _matrix(col: pa.Array, dim: int) -> np.ndarray:
    return np.asarray(col.flatten(), dtype=np.float64).reshape(-1, dim)


class Index:
    """Codes and vectors of every usable row, in a shared folder."""

    def __init__(self, vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", width: int = WIDTH, sample: int = SAMPLE):
        spark = vectors.sparkSession
        self.scratch, self.spark = Scratch(spark, "ann"), spark
        rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector")).where("vec_id is not null and vector is not null")
        sizes = rows.groupBy(F.size("vector").alias("d")).count().where("d > 0").orderBy(F.desc("count"), "d").first()
        self.dim = int(sizes[0]) if sizes else 0
        if not self.dim:
            self.rows = None
            return
        rows = rows.where(usable(F.col("vector"), self.dim))
        held = bounded_sample(rows, ["vec_id", "vector"], sample, int(sizes[1])).select("vector").collect()
        if not held:  # most rows of this length can't be used
            held = rows.orderBy(place("vec_id", "vector"), "vec_id").limit(sample).select("vector").collect()
        held = np.array([r[0] for r in held])
        if not len(held):
            self.rows = None
            return
        self.quantiser = Quantiser(held, width)
        shared, dim = spark.sparkContext.broadcast(self.quantiser), self.dim

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    q = shared.value
                    code = q.pack(q.encode(_matrix(batch.column("vector"), dim)))
                    yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([c.tobytes() for c in code], pa.binary())], names=["vec_id", "vector", "code"])

        self.rows = self.scratch.table(textkit.map_arrow(rows, run, "vec_id long, vector array<double>, code binary"), "index")

    def search(self, queries: Column, k: int, block: int = BLOCK, depth: float = DEPTH) -> DataFrame:
        """query_id, rank, vec_id, score: the k nearest found for each indexed row for which the condition `queries` on vec_id holds."""
        if self.rows is None:
            return self.spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
        most = max(k + 1, math.ceil(depth * math.sqrt(self.rows.count())))
        asked = self.rows.where(queries).select("vec_id", "vector")
        n = max(1, -(-asked.count() // block))
        asked = self.scratch.table(asked.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(n))), "queries", by="block")
        found = None
        for i in range(n):
            own = sorted((r[0], r[1]) for r in asked.where(F.col("block") == i).select("vec_id", "vector").collect())
            own = [x for j, x in enumerate(own) if not j or x[0] != own[j - 1][0]]
            if own:
                part = self.scratch.table(self._held_against(own, k, most), "found")
                found = part if found is None else found.unionByName(part)
        if found is None:
            return self.spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
        rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
        return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

    def _held_against(self, own: list, k: int, depth: int) -> DataFrame:
        ids, vectors = np.array([x for x, _ in own], dtype=np.int64), np.array([v for _, v in own]).reshape(len(own), self.dim)
        shared, dim = self.spark.sparkContext.broadcast((self.quantiser, ids, vectors)), self.dim

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            q, ids, vectors = shared.value
            kept: list[list[tuple[np.ndarray, np.ndarray]]] = [[] for _ in ids]
            heads = [np.zeros(0, np.float32) for _ in ids]  # each query's best approximate scores so far
            for batch in batches:
                if not batch.num_rows:
                    continue
                vec_id, x = np.asarray(batch.column("vec_id")), _matrix(batch.column("vector"), dim)
                code = np.frombuffer(b"".join(batch.column("code").to_pylist()), np.uint8).reshape(len(vec_id), -1).T.copy()
                for at in range(0, len(ids), 128):
                    table = q.tables(vectors[at : at + 128])
                    for i in range(len(table)):
                        scan = table[i, 0].take(code[0])
                        for p in range(1, len(code)):
                            scan += table[i, p].take(code[p])
                        best = np.flatnonzero(scan >= _least(np.concatenate([heads[at + i], scan]), depth))  # ties all stay
                        heads[at + i] = _best(np.concatenate([heads[at + i], scan[best]]), depth)
                        best = best[vec_id[best] != ids[at + i]]
                        exact = (x[best] * vectors[at + i]).sum(axis=1)
                        top = np.lexsort((vec_id[best], -exact))[:k]
                        rows = kept[at + i]
                        rows.append((vec_id[best][top], exact[top]))
                        if len(rows) > 8:
                            rows[:] = [_merged(rows, k)]
            for at in range(0, len(ids), 512):
                rows = [_merged(r, k) for r in kept[at : at + 512]]
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(ids[at : at + 512], [len(a) for a, _ in rows])), pa.array(np.concatenate([a for a, _ in rows])), pa.array(np.concatenate([b for _, b in rows]))], names=["query_id", "vec_id", "score"])

        return textkit.map_arrow(self.rows, run, "query_id long, vec_id long, score double")


def _least(scores: np.ndarray, n: int) -> float:
    """The n-th largest; where there are fewer, less than any."""
    return np.partition(scores, len(scores) - n)[len(scores) - n] if len(scores) >= n else -np.inf


def _best(scores: np.ndarray, n: int) -> np.ndarray:
    return np.partition(scores, len(scores) - n)[len(scores) - n :] if len(scores) > n else scores


def _merged(rows: list[tuple[np.ndarray, np.ndarray]], k: int) -> tuple[np.ndarray, np.ndarray]:
    if not rows:
        return np.zeros(0, np.int64), np.zeros(0)
    ids, scores = np.concatenate([a for a, _ in rows]), np.concatenate([b for _, b in rows])
    top = np.lexsort((ids, -scores))[:k]
    return ids[top], scores[top]


def op6_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return Index(vectors).search(F.col("vec_id") % 20 == 0, 20)
