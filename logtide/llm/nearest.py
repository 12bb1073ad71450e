"""Approximate nearest neighbours by multi-index hashing.

A rotation learned on a bounded sample (principal axes, then alternating between signs and the orthogonal rotation that
fits them best; several rotations, if there are fewer axes than bits) turns each vector into ``BITS`` bits. Codes are split
into ``PARTS`` substrings, each with an index from its value to the vectors that have it. If two codes differ in at most r
bits, some substring differs in at most r / PARTS of its own; so probing all substring values within that distance retrieves
every code within the radius, which are then reranked by their original vectors. The radius is learned on the sample: the
one within which nearly all true neighbours lie.

Every row is indexed, in the task that reads it, some MB at a time. Queries go to the tasks in blocks of at most ``BLOCK``
bytes, one block after the other, and only the nearest of each index are shuffled. A query with fewer than k vectors within
the radius is compared with all vectors in a second pass, so that no list is short.

Vectors that are null, zero or hold null or non-finite components take no part. A query meets vectors of its own length;
each length has its own codes. Repeated ids are vectors of their own, but one query; a query never finds its own id.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from logtide.llm.blocks import ranges
from logtide.llm.samples import bounded
from logtide.scratch import Scratch

BITS, PARTS = 256, 16
TRAIN_ROWS = 8_000
#: Bytes of queries that are sent to the tasks at a time, and of vectors that one index holds.
BLOCK, INDEX = 16 << 20, 16 << 20
#: Share of the sample's true neighbours that the radius holds.
WITHIN = 0.99


@dataclass
class Codes:
    mean: np.ndarray
    axes: np.ndarray  # dimensions x BITS
    radius: int

    def of(self, x: np.ndarray) -> np.ndarray:
        """Substrings (rows x PARTS) of 16 bits each."""
        bits = ((x - self.mean) @ self.axes > 0).reshape(len(x), PARTS, BITS // PARTS)
        return (bits @ (1 << np.arange(BITS // PARTS, dtype=np.int64))).astype(np.uint16)


def distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hamming distance of codes, the last axis being substrings."""
    words = (a ^ b).view(np.uint64)  # four substrings each
    return np.bitwise_count(words).sum(-1, dtype=np.int64)


def learn(sample: np.ndarray, k: int, rounds: int = 25, seed: int = 3) -> Codes:
    n, d = sample.shape
    rng = np.random.default_rng(seed)
    mean = sample.mean(0) if n else np.zeros(d)
    x = sample - mean
    # BITS directions: the principal axes, repeated under other rotations if there are fewer of them
    values, vectors = np.linalg.eigh(x.T @ x) if n else (np.ones(d), np.eye(d))
    top = vectors[:, np.argsort(-values)[: min(d, BITS)]]
    axes = []
    while sum(a.shape[1] for a in axes) < BITS:
        p = x @ top
        turn = np.linalg.qr(rng.normal(size=(top.shape[1],) * 2))[0]
        for _ in range(rounds):
            u, _, v = np.linalg.svd(np.where(p @ turn > 0, 1.0, -1.0).T @ p)
            turn = (u @ v).T
        axes.append(top @ turn)
    codes = Codes(mean, np.concatenate(axes, 1)[:, :BITS], BITS)
    if n > 2 * k:
        code, gaps = codes.of(sample), []
        for q in range(0, n, max(1, n // 400)):
            far = ((sample - sample[q]) ** 2).sum(1)
            far[q] = np.inf
            gaps.append(distance(code[np.argpartition(far, k)[:k]], code[q]))
        codes.radius = int(np.ceil(np.quantile(np.concatenate(gaps), WITHIN)))
    return codes


class Index:
    """Substring indexes of the codes of some vectors."""

    def __init__(self, code: np.ndarray):
        self.code = code
        self.tables = []
        for j in range(PARTS):
            order = np.argsort(code[:, j], kind="stable")
            values, start = np.unique(code[order, j], return_index=True)
            self.tables.append((values, np.append(start, len(order)), order))

    def probe(self, code: np.ndarray, radius: int) -> np.ndarray:
        """Rows of every indexed code within the radius of one code."""
        hit = np.zeros(len(self.code), bool)
        for j, (values, start, order) in enumerate(self.tables):
            near = np.flatnonzero(np.bitwise_count(values ^ code[j]) <= radius // PARTS)
            hit[order[ranges(start[near], start[near + 1] - start[near])]] = True
        rows = np.flatnonzero(hit)
        return rows[distance(self.code[rows], code) <= radius]


def matrix(column: pa.Array, dimension: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(rows that take part, their vectors)."""
    lists = column.cast(pa.list_(pa.float64()))
    sizes = np.diff(lists.offsets.to_numpy())
    sizes[lists.is_null().to_numpy(zero_copy_only=False)] = -1
    fit = np.flatnonzero(sizes == dimension) if dimension else np.zeros(0, np.int64)
    if not len(fit):
        return fit, np.zeros((0, dimension or 0))
    flat = lists.take(pa.array(fit)).flatten()
    x = flat.to_numpy(zero_copy_only=False).reshape(len(fit), dimension)
    good = np.isfinite(x).all(1) & (x != 0).any(1)
    return fit[good], x[good]


def usable(vectors: DataFrame) -> DataFrame:
    """Rows whose vector is neither null nor zero nor holds null or non-finite components."""
    finite = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    return vectors.where(F.col("vec_id").isNotNull() & F.coalesce(finite & F.exists("embedding", lambda v: v != 0), F.lit(False)))


FOUND = "query_id bigint, vec_id bigint, score double"


class Chunk:
    """Some vectors with their index."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, codes: Codes, probed: bool):
        self.ids, self.x = ids, x
        self.index = Index(codes.of(x)) if probed else None

    def nearest(self, query_ids: np.ndarray, queries: np.ndarray, query_codes: np.ndarray, radius: int, k: int) -> tuple[np.ndarray, ...]:
        """The k nearest for each query: of those that the index retrieves, or of all vectors without one."""
        out = []
        for q, v, c in zip(query_ids, queries, query_codes):
            rows = self.index.probe(c, radius) if self.index else np.arange(len(self.ids))
            rows = rows[self.ids[rows] != q]
            if len(rows):
                score = np.sqrt(((self.x[rows] - v) ** 2).sum(1))
                if len(rows) > k:
                    edge = np.partition(score, k - 1)[k - 1]
                    rows, score = rows[score <= edge], score[score <= edge]
                order = np.lexsort((self.ids[rows], score))[:k]
                out.append((np.full(len(order), q), self.ids[rows[order]], score[order]))
        return tuple(map(np.concatenate, zip(*out))) if out else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))


def search(vectors: DataFrame, queries: DataFrame, k: int = 10, train_rows: int = TRAIN_ROWS, block: int = BLOCK) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id`` and ``score`` (Euclidean distance) of the k nearest found of each query.

    vectors and queries: (vec_id, embedding).
    """
    spark = vectors.sparkSession
    vectors, queries = (usable(x.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))) for x in (vectors, queries))
    queries = queries.groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    out = spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    size = F.size("embedding")
    for row in queries.select(size.alias("d")).distinct().orderBy("d").collect():  # lengths of vectors
        found = search_length(vectors.where(size == row.d), queries.where(size == row.d), row.d, k, train_rows, max(1, block // (8 * row.d)))
        out = out.unionByName(found)
    return out


def search_length(vectors: DataFrame, queries: DataFrame, d: int, k: int, train_rows: int, block: int) -> DataFrame:
    """``search`` among vectors of d components."""
    spark = vectors.sparkSession
    scratch = Scratch(spark, "nearest")
    sample = bounded(vectors, train_rows, "vec_id", "embedding").toArrow()
    codes = spark.sparkContext.broadcast(learn(matrix(sample.column("embedding").combine_chunks(), d)[1], k))  # bounded by train_rows

    def searched(asked, probed: bool):
        def run(batches):
            held, size = [], 0

            def answer():
                chunk = Chunk(*map(np.concatenate, zip(*held)), codes.value, probed)
                found = chunk.nearest(*asked.value, codes.value.of(asked.value[1]), codes.value.radius, k)
                return pa.RecordBatch.from_arrays([pa.array(c) for c in found], ["query_id", "vec_id", "score"])

            for batch in batches:
                rows, x = matrix(batch.column("embedding"), d)
                held.append((batch.column("vec_id").to_numpy()[rows], x))
                size += x.nbytes
                if size > INDEX:
                    yield answer()
                    held, size = [], 0
            if size:
                yield answer()

        return vectors.mapInArrow(run, FOUND)

    order = Window.partitionBy("query_id").orderBy("score", "vec_id")

    def in_blocks(queries, probed: bool, name: str) -> DataFrame:
        """All queries against all rows, a block of queries at a time."""
        parts: list[DataFrame] = []
        held_ids, held = [], []

        def flush() -> None:
            asked = spark.sparkContext.broadcast((np.array(held_ids, np.int64), np.array(held).reshape(-1, d)))  # BLOCK bytes at most
            ranked = searched(asked, probed).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            parts.append(scratch.cut(ranked, f"{name}-{len(parts)}"))
            asked.destroy()
            held_ids.clear()
            held.clear()

        for row in queries.toLocalIterator(prefetchPartitions=False):
            held_ids.append(row.vec_id)
            held.append(row.embedding)
            if len(held) >= block:
                flush()
        if held or not parts:
            flush()
        return reduce(DataFrame.unionByName, parts)

    found = in_blocks(queries, True, "found")
    full = found.where(F.col("rank") == k).select(F.col("query_id").alias("vec_id"))
    short = scratch.cut(queries.join(full, "vec_id", "left_anti"), "short")
    out = found
    if not short.isEmpty():
        out = found.join(short.select(F.col("vec_id").alias("query_id")), "query_id", "left_anti").unionByName(in_blocks(short, False, "all"))
    return out.select("query_id", F.col("rank").cast("int"), "vec_id", "score")


def op5_nearest(spark, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return search(vectors, vectors.where("vec_id % 100 = 0"))
