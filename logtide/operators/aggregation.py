"""Aggregated records: many small records packed into one, in a Protocol Buffers message with a checksum."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logtide.functions.keys import CHECKSUM_BYTES, MAGIC, is_aggregated
from logtide.functions.wire import CorruptRecord, Decoded, encoded

_MAGIC = bytes.fromhex(MAGIC)


def varint(n: int) -> bytes:
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    out.append(n)
    return bytes(out)


def read_varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        if at >= len(data) or shift > 63:
            raise CorruptRecord("a number runs past the end")
        value |= (data[at] & 0x7F) << shift
        at += 1
        if data[at - 1] < 0x80:
            return value, at
        shift += 7


def _field(number: int, body: bytes) -> bytes:
    return varint(number << 3 | 2) + varint(len(body)) + body


def encode(keys: list[str], entries: list[tuple[int, bytes]], hash_keys: list[str] = (), hash_indexes: list[int | None] | None = None) -> bytes:
    """magic, message, MD5 of the message. entries: (index into keys, data)."""
    parts = [_field(1, k.encode()) for k in keys] + [_field(2, k.encode()) for k in hash_keys]
    for i, (key, data) in enumerate(entries):
        index = hash_indexes[i] if hash_indexes else None
        parts.append(_field(3, b"\x08" + varint(key) + (b"\x10" + varint(index) if index is not None else b"") + _field(3, data)))
    message = b"".join(parts)
    return _MAGIC + message + hashlib.md5(message).digest()


def _fields(data: bytes):
    at = 0
    while at < len(data):
        tag, at = read_varint(data, at)
        kind = tag & 7
        if kind == 0:
            value, at = read_varint(data, at)
        elif kind == 2:
            size, at = read_varint(data, at)
            if at + size > len(data):
                raise CorruptRecord("a field runs past the end")
            value, at = data[at : at + size], at + size
        else:
            raise CorruptRecord(f"wire type {kind}")
        yield tag >> 3, value


def decode(data: bytes) -> tuple[list[str], list[str], list[tuple[int, int | None, bytes, list[tuple[str, str | None]]]]]:
    """(keys, explicit hash keys, entries of (key index, hash key index, data, tags))."""
    message = data[len(_MAGIC) : -CHECKSUM_BYTES]
    if data[: len(_MAGIC)] != _MAGIC or len(data) < len(_MAGIC) + CHECKSUM_BYTES or hashlib.md5(message).digest() != data[-CHECKSUM_BYTES:]:
        raise CorruptRecord("checksum")
    keys, hash_keys, entries = [], [], []

    def of(value, kind):
        if not isinstance(value, kind):
            raise CorruptRecord("wire type")
        return value

    def text(value) -> str:
        try:
            return of(value, bytes).decode()
        except UnicodeDecodeError:
            raise CorruptRecord("a key that is no text") from None

    for number, value in _fields(message):
        if number == 1:
            keys.append(text(value))
        elif number == 2:
            hash_keys.append(text(value))
        elif number == 3:
            key, hashed, body, tags = None, None, b"", []
            for n, v in _fields(of(value, bytes)):
                if n == 1:
                    key = of(v, int)
                elif n == 2:
                    hashed = of(v, int)
                elif n == 3:
                    body = of(v, bytes)
                elif n == 4:
                    tag = dict(_fields(of(v, bytes)))
                    tags.append((text(tag.get(1)), text(tag[2]) if 2 in tag else None))
            if key is None or key >= len(keys) or hashed is not None and hashed >= len(hash_keys):
                raise CorruptRecord("an entry without a key")
            entries.append((key, hashed, body, tags))
    return keys, hash_keys, entries


@F.arrow_udf(T.BinaryType())
def encode_entries(entries: pa.Array) -> pa.Array:
    """Column function: an array of (partition_key, data), in order, to an aggregated record; keys stand once for each entry's first use."""
    lengths = entries.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    each = entries.flatten()
    return encoded(lengths, each.field(0).cast(pa.string()), each.field(1))


def aggregate(batched: DataFrame, shard: str, order: str, timestamp: str | None = None) -> DataFrame:
    """One aggregated record for each (shard, batch): key, timestamp and position of its first entry, number of entries, data."""
    entry = F.struct(F.col(order).alias("at"), "partition_key", "data")
    first = [F.min_by("partition_key", order).alias("partition_key"), F.min(order).alias("first_position"), F.max(order).alias("last_position"), F.count("*").alias("aggregate_count")]
    if timestamp:
        first.append(F.min_by(timestamp, order).alias(timestamp))
    # a batch is bounded by the bytes of one record
    packed = batched.groupBy(shard, "batch").agg(*first, F.array_sort(F.collect_list(entry)).alias("entries"))
    return packed.withColumn("data", encode_entries(F.transform("entries", lambda e: F.struct(e["partition_key"], e["data"])))).drop("entries")


def deaggregate(records: DataFrame, on_corrupt: str = "fail") -> DataFrame:
    """One row for each entry of an aggregated record, others unchanged.

    records: with data, partition_key, explicit_hash_key, sub_sequence_number and aggregated; entries get their position as
    sub_sequence_number and their own keys, all else from the record. on_corrupt: ``fail`` or ``passthrough``.
    """
    if on_corrupt not in ("fail", "passthrough"):
        raise ValueError(on_corrupt)
    made = ("data", "partition_key", "explicit_hash_key", "sub_sequence_number", "aggregated")
    kept = [c for c in records.columns if c not in made]
    schema = T.StructType([*[records.schema[c] for c in kept], *T.StructType.fromDDL("data binary, partition_key string, explicit_hash_key string, sub_sequence_number bigint, aggregated boolean").fields])

    def run(batches):
        for batch in batches:
            found = Decoded(batch.column("data"))
            if on_corrupt == "fail" and found.corrupt.any():
                raise CorruptRecord("checksum or message of a record")
            plain = np.flatnonzero(~found.marked | found.corrupt)
            rows = np.concatenate([found.row, plain])
            order = np.argsort(rows, kind="stable")  # entries of a record stand in order already
            at = pa.array(order)

            def joined(entries: pa.Array, others: pa.Array) -> pa.Array:
                return pa.concat_arrays([entries, others.take(pa.array(plain))]).take(at)

            hashes = found.hashes.take(pa.array(np.where(found.hash < 0, 0, found.hash), mask=found.hash < 0)) if len(found.hashes) else pa.nulls(len(found.row), pa.string())
            given = batch.column("explicit_hash_key").cast(pa.string()) if "explicit_hash_key" in batch.schema.names else pa.nulls(batch.num_rows, pa.string())
            columns = [
                joined(found.body, batch.column("data").cast(pa.binary())), joined(found.keys.take(pa.array(found.key)), batch.column("partition_key").cast(pa.string())), joined(hashes, given),
                joined(pa.array(found.place), pa.nulls(batch.num_rows, pa.int64())), pa.array(order < len(found.row)),
            ]
            same = batch.select(kept).take(pa.array(rows[order]))
            yield pa.RecordBatch.from_arrays([*same.columns, *columns], names=schema.fieldNames())

    return records.mapInArrow(run, schema)


def needs_deaggregation(records: DataFrame) -> DataFrame:
    return records.where(is_aggregated(F.col("data")))
