"""Vectorised work on blocks of whole texts: Arrow string columns as flat byte arrays.

A block is a run of rows whose texts total about ``BLOCK`` bytes (one text at least), so that the temporaries of
the numpy passes stay within some tens of MB whatever the size of the Arrow batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

BLOCK = 1 << 20
U = np.uint64
_MASK = (1 << 64) - 1


def text_arrays(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    _, offs, data = column.buffers()
    offsets = np.frombuffer(offs, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def blocks(batch: pa.RecordBatch, column: str, limit: int = BLOCK) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Split a batch by the bytes of its text column: (rows, bytes, offsets)."""
    data, offsets = text_arrays(batch.column(column))
    at, n = 0, batch.num_rows
    while at < n:
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1)
        yield batch.slice(at, end - at), data[offsets[at] : offsets[end]], offsets[at : end + 1] - offsets[at]
        at = end


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


#: Masks of the first 0 to 8 bytes of a lane.
_HEADS = np.array([(1 << 8 * i) - 1 for i in range(9)], U)


def lowered(data: np.ndarray) -> np.ndarray:
    """The bytes with A-Z in lower case."""
    return _LOWER[data]


class Lanes:
    """Byte ranges as 64-bit lanes of eight bytes each; the last lane of a range is padded with zeros."""

    def __init__(self, data: np.ndarray):
        self.held = np.concatenate([data, np.zeros(8, np.uint8)])
        self.view = np.ndarray((len(data) + 1,), "<u8", self.held, strides=(1,))

    def read(self, start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(lanes, number of each within its range, first lane of each range); ranges are not empty."""
        count = (length + 7) >> 3
        first = np.cumsum(count) - count
        number = np.arange(int(count.sum())) - np.repeat(first, count)
        x = self.view[np.repeat(start, count) + 8 * number]
        rest = np.minimum(np.repeat(length, count) - 8 * number, 8).astype(U)
        x &= U(_MASK) >> (U(64) - U(8) * rest)
        return x, number, first


def range_digests(lanes: Lanes, start: np.ndarray, end: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of each byte range, the same wherever the bytes stand: the sum of its mixed lanes, mixed with its length.

    Each lane is mixed with its number before it is added, so that nothing of the bytes' arithmetic is left (a polynomial
    modulo 2**64 has the same value for some words of two letters and their complements).
    """
    length = end - start
    out = np.zeros(len(start), U)
    key = (U(seed) + np.arange(1, 5, dtype=U)) * U(0x9E3779B97F4A7C15)
    some = np.flatnonzero((length > 0) & (length <= 32))
    at, rest = start[some], length[some]
    for k in key:  # a lane of each range that is that long
        out[some] += mix(lanes.view[at] & _HEADS[np.minimum(rest, 8)] ^ k)
        longer = np.flatnonzero(rest > 8)
        some, at, rest = some[longer], at[longer] + 8, rest[longer] - 8
        if not len(some):
            break
    some = np.flatnonzero(length > 32)
    if len(some):
        x, number, first = lanes.read(start[some], length[some])
        x = mix(x ^ (U(seed) + number.astype(U) + U(1)) * U(0x9E3779B97F4A7C15))
        out[some] = np.add.reduceat(x, first)
    return mix(out + length.astype(U) * U(0xA24BAED4963EE407))


def same_bytes(a: Lanes, start: np.ndarray, length: np.ndarray, b: Lanes, other: np.ndarray, limit: int = 1 << 20) -> np.ndarray:
    """Whether the ranges of one length at ``start`` in a and at ``other`` in b hold the same bytes."""
    out = np.ones(len(start), bool)
    some = np.flatnonzero(length > 0)
    total = np.cumsum(length[some])
    at = 0
    while at < len(some):
        end = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + limit, side="right")))
        now = some[at:end]
        x, _, first = a.read(start[now], length[now])
        y, _, _ = b.read(other[now], length[now])
        out[now] = np.logical_and.reduceat(x == y, first)
        at = end
    return out


@lru_cache(maxsize=4)
def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, U(base))
    out[0] = 1
    return np.multiply.accumulate(out)


def powers(base: int, n: int) -> np.ndarray:
    return _powers(base, 1 << max(12, (max(n, 1) - 1).bit_length()))[:n]


@lru_cache(maxsize=1)
def byte_values() -> np.ndarray:
    """A fixed random 64-bit value for each byte."""
    return mix(np.arange(1, 257, dtype=U) * U(0xD6E8FEB86659FD93))


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """h[i]: polynomial hash of the first i bytes, modulo 2**64. It may choose what to compare, never decide what is equal."""
    out = np.zeros(len(data) + 1, U)
    np.cumsum(byte_values()[data] * powers(BASE, len(data)), out=out[1:])
    return out


def word_spans(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of maximal runs of word bytes within texts, and the index of each text's first word (and the total)."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    inside = is_word[data]
    before = np.empty_like(inside)
    before[0] = False
    before[1:] = inside[:-1]
    cuts = offsets[:-1][offsets[:-1] < len(data)]
    before[cuts] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.empty_like(inside)
    after[-1] = False
    after[:-1] = inside[1:]
    after[cuts[cuts > 0] - 1] = False
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Concatenation of start, start + 1, ... of each length."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    first = np.cumsum(lengths) - lengths
    return np.repeat(starts - first, lengths) + np.arange(total)


def flags(predicate: str) -> np.ndarray:
    """Table of bytes: ``space`` bytes \\x20 and \\x09-\\x0D are no words; ``alnum``: digits, letters and all non-ASCII bytes are."""
    table = np.ones(256, bool)
    if predicate == "space":
        table[[32, 9, 10, 11, 12, 13]] = False
    elif predicate == "alnum":
        table[:0x80] = False
        table[0x30:0x3A] = table[0x41:0x5B] = table[0x61:0x7B] = True
    else:
        raise ValueError(predicate)
    return table


def continuation_counts(data: np.ndarray) -> np.ndarray:
    """c[i]: UTF-8 continuation bytes among the first i; byte position minus c is the code point position."""
    out = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) == 0x80, out=out[1:])
    return out


def map_texts(df, make, fields: str, carry: tuple[str, ...] = ("doc_id",), text: str = "text"):
    """Run vectorised code over whole texts: one output row per input row, no shuffle.

    ``make()`` is called once in each task and returns ``work(data, offsets) -> list of Arrow arrays`` in the order of
    ``fields`` (a DDL string). The columns in ``carry`` come back untouched inside the struct ``row``, so that they never
    clash with ``fields``. Only the text goes to Python, once, and only ``fields`` come back; the carried columns wait in
    the JVM.
    """
    from pyspark.sql import functions as F
    from pyspark.sql import types as T
    from pyspark.sql.pandas.types import to_arrow_type

    schema = T.StructType.fromDDL(fields)
    kinds = [to_arrow_type(f.dataType) for f in schema]

    def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        work = make()
        for column in columns:
            found = [work(data, offsets) for _, data, offsets in blocks(pa.RecordBatch.from_arrays([column], ["text"]), "text")]
            whole = [pa.concat_arrays([part[i].cast(kind) for part in found]) if found else pa.array([], kind) for i, kind in enumerate(kinds)]
            yield pa.StructArray.from_arrays(whole, schema.fieldNames())

    # an expression that must not be evaluated twice, wherever its fields are used
    udf = F.arrow_udf(run, schema).asNondeterministic()
    picked = df.select(F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row"), udf(F.col(text)).alias("found"))
    return picked.select("row", "found.*")


def strings(data: np.ndarray, offsets: np.ndarray, kind: pa.DataType) -> pa.Array:
    """Arrow array over flat bytes."""
    buffers = [None, pa.py_buffer(np.ascontiguousarray(offsets, np.int64)), pa.py_buffer(np.ascontiguousarray(data))]
    large = pa.large_binary() if pa.types.is_binary(kind) else pa.large_string()
    return pa.Array.from_buffers(large, len(offsets) - 1, buffers).cast(kind)
