"""Schemas of the record model."""

from __future__ import annotations

from pyspark.sql import types as T

S, L, B, TS = T.StringType(), T.LongType(), T.BinaryType(), T.TimestampType()


def struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields])


#: A record to produce.
PRODUCED = struct(("partition_key", S), ("data", B))
#: A consumed record. sequence_number is zero-padded, so that text order is number order; sub_sequence_number is the
#: position inside an aggregated record, null for others.
RECORD = struct(
    ("shard_id", S), ("sequence_number", S), ("approximate_arrival_timestamp", TS), ("data", B), ("partition_key", S),
    ("encryption_type", S), ("sub_sequence_number", L), ("explicit_hash_key", S), ("aggregated", T.BooleanType()),
)
#: A shard of the 128-bit hash key space, bounds as 32 hex digits; no parents, one (split) or two (merge).
SHARD = struct(("shard_id", S), ("lo", S), ("hi", S), ("parent_shard_ids", T.ArrayType(S)))
#: A lease; its checkpoint is special or a position, never both.
LEASE = struct(("lease_key", S), ("owner", S), ("counter", L), ("special", S), ("seq", S), ("sub_seq", L), ("parent_shard_ids", T.ArrayType(S)))
#: Digits of a padded sequence number.
DIGITS = 40
