"""Records as packed arrays: some thousand of them travel as one row, so that numpy and not the row format does the work.

Records are dealt into buckets by a hash. There are so many buckets that one fits a Python worker with ease; a partition holds
several, sorted by the JVM (which spills), and Python gets one bucket after the other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logtide.llm.blocks import strings, text_arrays

#: part: the bucket.
PACKED = "kind int, part int, payload binary"
#: Records that a task gathers before it sends them on, and records of a bucket.
GATHER, BUCKET = 1 << 19, 1 << 18


def bucket_count(records: int, parts: int) -> int:
    """A multiple of the partitions, so many that a bucket holds about BUCKET records at most."""
    return parts * max(1, -(-records // (BUCKET * parts)))


def deal(packed: DataFrame, parts: int, *then: str) -> DataFrame:
    """Buckets to partitions, in order, within each by ``then`` (``kind``, if nothing else is said)."""
    return packed.repartitionById(parts, F.col("part") % parts).sortWithinPartitions("part", *(then or ("kind",)))


def buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.RecordBatch]]:
    """The rows of one bucket at a time."""
    held: list[pa.RecordBatch] = []
    of = None
    for batch in batches:
        part = batch.column("part").to_numpy()
        edges = [0, *(np.flatnonzero(part[1:] != part[:-1]) + 1).tolist(), len(part)]
        for a, b in zip(edges[:-1], edges[1:]):
            if a == b:
                continue
            if held and part[a] != of:
                yield held
                held = []
            of = part[a]
            held.append(batch.slice(a, b - a))
    if held:
        yield held


def unpack(rows: list[pa.RecordBatch], kind: int, dtype: np.dtype) -> np.ndarray:
    """The records of one kind."""
    found = []
    for batch in rows:
        own = pa.array(batch.column("kind").to_numpy() == kind)
        data, _ = text_arrays(batch.column("payload").filter(own))
        found.append(np.frombuffer(data, dtype))
    return np.concatenate(found) if found else np.zeros(0, dtype)


def records(kind: np.dtype, **columns) -> np.ndarray:
    out = np.zeros(len(next(iter(columns.values()))), kind)
    for name, values in columns.items():
        out[name] = values
    return out


class Outbox:
    """Gathers records and packs them by bucket, the key modulo the number of buckets (keys are hashes)."""

    def __init__(self, count: int):
        self.count, self.held, self.size = count, {}, 0

    def add(self, kind: int, rows: np.ndarray, key: np.ndarray) -> None:
        if len(rows):
            self.held.setdefault(kind, []).append((rows, np.ascontiguousarray(key).view(np.int64) % self.count))
            self.size += len(rows)

    def flush(self):
        for kind, found in self.held.items():
            rows, part = (np.concatenate(x) for x in zip(*found))
            order = np.argsort(part, kind="stable")
            rows, part = rows[order], part[order]
            heads = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
            at = np.append(heads, len(rows)) * rows.dtype.itemsize
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(heads), kind, np.int32)), pa.array(part[heads].astype(np.int32)), strings(rows.view(np.uint8), at, pa.binary())], ["kind", "part", "payload"])
        self.held, self.size = {}, 0

    def full(self) -> bool:
        return self.size >= GATHER
