"""Ordered folds: batches bounded by bytes and records, segments without a repeated key.

A batch is a maximal run, so where one ends depends on where it began: a fold along the order. It still runs in parallel
within a key: rows are dealt out by ranges of the order and checkpointed, so that they stay as they are. Where the first
batch border of a range lies depends on what the range before it leaves open, but it lies among the rows of one batch. Each
range answers for every such border what it leaves open itself; one small fold over these answers chains the ranges, and a
last pass gives each its batches.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logtide.functions.keys import BYTES_PER_RECORD, BYTES_PER_REQUEST, CHECKSUM_BYTES, RECORDS_PER_REQUEST
from logtide.scratch import gone_at_exit, shared_root


def fold_sorted(df: DataFrame, key: str, order: list[str], fields: str, step: Callable) -> DataFrame:
    """Adds columns made by a fold along each key in order.

    ``step(state, rows) -> (state, columns)`` gets consecutive rows of one key; state is None at the key's first row.
    """
    schema = T.StructType([*df.schema.fields, *T.StructType.fromDDL(fields).fields])

    def run(batches):
        of, state, begun = None, None, False
        for batch in batches:
            keys = batch.column(key)
            if not batch.num_rows:
                continue
            codes = keys.dictionary_encode(null_encoding="encode").indices.to_numpy()
            edges = np.concatenate([[0], np.flatnonzero(np.diff(codes)) + 1, [len(codes)]])
            for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
                rows = batch.slice(a, b - a)
                mine = keys[a].as_py()
                if not begun or mine != of:
                    of, state, begun = mine, None, True
                state, columns = step(state, rows)
                yield pa.RecordBatch.from_arrays([*rows.columns, *columns], names=schema.fieldNames())

    return df.repartition(key).sortWithinPartitions(key, *order).mapInArrow(run, schema)


def ranged(df: DataFrame, order: list[str]) -> DataFrame:
    """The rows sorted by ranges of the order, as partitions that stay the same however often they are read."""
    shared_root(df.sparkSession)
    gone_at_exit(df.sparkSession, df.sparkSession.sparkContext.getCheckpointDir())  # this application's own folder
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartitionByRange(parts, *order).sortWithinPartitions(*order).checkpoint()


def hop(total: np.ndarray, start: np.ndarray, limit: int, most: int) -> np.ndarray:
    """Where batches that start at these rows end; total: sums of sizes before each row, and of all."""
    end = np.searchsorted(total, total[start] + limit, side="right") - 1
    return np.minimum(np.maximum(end, start + 1), np.minimum(start + most, len(total) - 1))


class Range:
    """What a range of consecutive rows of one key leaves open, for whatever the rows before it leave open."""

    def __init__(self, sizes: np.ndarray, limit: int, most: int):
        self.limit, self.most, self.n = limit, most, len(sizes)
        self.total = np.concatenate([[0], np.cumsum(sizes)])
        # rows that may begin the first batch of the range, and where the chain from each ends: (start of its last batch, batches)
        reach = int(hop(self.total, np.array([0]), limit, most)[0]) if self.n else 0
        last, batches = np.arange(reach + 1), np.zeros(reach + 1, np.int64)
        live = np.flatnonzero(last < self.n)
        while len(live):
            at, back = np.unique(last[live], return_inverse=True)  # chains that have met go on as one
            end = hop(self.total, at, limit, most)[back]
            batches[live] += 1
            done = end >= self.n
            last[live[~done]] = end[~done]
            live = live[~done]
        self.last, self.batches = last, batches

    def answers(self) -> dict:
        head = self.total[: len(self.last) + 1]
        return {"n": self.n, "size": int(self.total[-1]), "head": head.astype("<i8").tobytes(), "last": self.last.astype("<i8").tobytes(), "before": self.total[self.last].astype("<i8").tobytes(), "batches": self.batches.astype("<i8").tobytes()}


def after(state: tuple[int, int, int], answer: dict, limit: int, most: int) -> tuple[int, int, int]:
    """The state (batch, its bytes, its records) after a range: batch is -1 before the first."""
    number, held, count = state
    head, last, before, batches = (np.frombuffer(answer[x], "<i8") for x in ("head", "last", "before", "batches"))
    border = 0
    if number >= 0:
        border = min(int(np.searchsorted(head, limit - held, side="right")) - 1, most - count)
        if border >= answer["n"]:
            return number, held + answer["size"], count + answer["n"]
        border = max(border, 0)
    return number + int(batches[border]), answer["size"] - int(before[border]), answer["n"] - int(last[border])


SUMMARY = "part int, piece int, key string, n bigint, size bigint, head binary, last binary, before binary, batches binary"


def greedy_batches(df: DataFrame, key: str | None, order: list[str], size: str, max_bytes: int, max_count: int | None = None, overhead: int = 0) -> DataFrame:
    """Adds ``batch`` (from 0 within the key, or over all rows without a key) and ``oversized``.

    A batch takes records while overhead + their sizes <= max_bytes and their number <= max_count. A record that is too
    large by itself is a batch of its own, marked as oversized.
    """
    limit = max_bytes - overhead
    most = max_count or (1 << 62)
    base = ranged(df, [*([key] if key else []), *order])
    columns = df.columns

    def pieces(batch: pa.RecordBatch):
        """(key, first row, row after the last) of runs of one key."""
        if not key:
            return [(None, 0, batch.num_rows)] if batch.num_rows else []
        keys = batch.column(key)
        codes = keys.dictionary_encode(null_encoding="encode").indices.to_numpy()
        edges = [0, *(np.flatnonzero(np.diff(codes)) + 1).tolist(), len(codes)]
        return [(keys[a].as_py(), a, b) for a, b in zip(edges[:-1], edges[1:]) if a < b]

    def named(value) -> str | None:
        return None if value is None else f"{value!r}"

    def summarise(batches):
        part = TaskContext.get().partitionId()
        of, piece, held = None, 0, []

        def row():
            # ranges between the first and the last key of a partition are nobody else's, but are as cheap to tell
            answer = Range(np.concatenate(held), limit, most).answers()
            return pa.RecordBatch.from_pylist([{"part": part, "piece": piece, "key": of, **answer}], schema=summary)

        for batch in batches:
            for value, a, b in pieces(batch):
                if held and named(value) != of:
                    if piece == 0:
                        yield row()
                    piece, held = piece + 1, []
                of = named(value)
                held.append(batch.column(size).slice(a, b - a).to_numpy(zero_copy_only=False).astype(np.int64))
        if held:
            yield row()

    summary = pa.schema([(f.split()[0], {"int": pa.int32(), "string": pa.string(), "bigint": pa.int64(), "binary": pa.binary()}[f.split()[1]]) for f in SUMMARY.split(", ")])

    def chain(batches):
        """The state in which each partition begins."""
        of, state, begun, seen = None, (-1, 0, 0), False, -1
        for batch in batches:
            out = []
            for answer in batch.to_pylist():
                if not begun or answer["key"] != of:
                    of, state, begun = answer["key"], (-1, 0, 0), True
                if answer["part"] != seen:
                    seen = answer["part"]
                    out.append((seen, of, *state))
                state = after(state, answer, limit, most)
            columns = list(zip(*out)) or [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64()))], ["part", "key", "number", "held", "records"])

    answers = base.select(*dict.fromkeys([*([key] if key else []), size])).mapInArrow(summarise, SUMMARY)
    begins = answers.repartition(1).sortWithinPartitions("part", "piece").mapInArrow(chain, "part int, key string, number bigint, held bigint, records bigint")  # one or two rows for each partition
    entry = df.sparkSession.sparkContext.broadcast({r.part: (r.key, (r.number, r.held, r.records)) for r in begins.collect()})  # one for each partition
    schema = T.StructType([*df.schema.fields, *T.StructType.fromDDL("batch bigint, oversized boolean").fields])

    def assign(batches):
        of, state = entry.value.get(TaskContext.get().partitionId(), (None, (-1, 0, 0)))
        for batch in batches:
            out = np.empty(batch.num_rows, np.int64)
            sizes = batch.column(size).to_numpy(zero_copy_only=False).astype(np.int64)
            for value, a, b in pieces(batch):
                if named(value) != of:
                    of, state = named(value), (-1, 0, 0)
                out[a:b], state = walk(sizes[a:b], state, limit, most)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out), pa.array(sizes > limit)], names=schema.fieldNames())

    return base.select(*columns).mapInArrow(assign, schema)


def walk(sizes: np.ndarray, state: tuple[int, int, int], limit: int, most: int) -> tuple[np.ndarray, tuple[int, int, int]]:
    """(batch of each row, state after them), from batch end to batch end."""
    number, held, count = state
    total = np.concatenate([[0], np.cumsum(sizes)])
    out = np.empty(len(sizes), np.int64)
    i = 0
    while i < len(sizes):
        if number < 0 or held + sizes[i] > limit or count >= most:
            number, held, count = number + 1, 0, 0
        # as far as bytes and records allow, one record at least
        j = int(np.searchsorted(total, total[i] + limit - held, side="right")) - 1
        j = max(i + 1, min(j, i + most - count, len(sizes)))
        out[i:j] = number
        held, count, i = held + int(total[j] - total[i]), count + j - i, j
    return out, (number, held, count)


def put_batches(df: DataFrame, key: str | None, order: list[str], size: str) -> DataFrame:
    """Batches of one request."""
    return greedy_batches(df, key, order, size, BYTES_PER_REQUEST, RECORDS_PER_REQUEST)


def aggregate_batches(df: DataFrame, key: str, order: list[str], size: str, max_bytes: int = BYTES_PER_RECORD) -> DataFrame:
    """Batches of one aggregated record; the size of an entry includes its own overhead."""
    return greedy_batches(df, key, order, size, max_bytes, overhead=4 + CHECKSUM_BYTES)


def locked_segments(df: DataFrame, shard: str, key: str, order: list[str], max_records: int) -> DataFrame:
    """Adds ``segment``: a checkpoint lies between two records of one key, or after max_records of them. A shard may lie in many tasks."""
    from logtide.operators import scans

    placed = scans.previous(scans.numbered(df, shard, order, "__position"), [shard, key], "__position", "__before")
    return scans.segments(placed, shard, "__position", "__before", max_records).drop("__position", "__before")


def batch_summary(df: DataFrame, key: str | None, size: str, order: str) -> DataFrame:
    """Records, bytes and first position of each batch."""
    return df.groupBy(*([key] if key else []), "batch").agg(F.count("*").alias("records"), F.sum(size).alias("bytes"), F.min(order).alias("first_position"), F.max("oversized").alias("oversized"))
