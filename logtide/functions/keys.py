"""Hash keys, shard numbers, sizes, stream names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the wire format and of the service's limits.
MAGIC = "F3899AC2"
CHECKSUM_BYTES = 16
ENTRY_OVERHEAD = 3 + 3 + 2
RECORDS_PER_REQUEST = 500
BYTES_PER_REQUEST = 5 * 1024 * 1024
BYTES_PER_RECORD = 921 * 1024
RECORDS_PER_SHARD_SECOND = 1000
BYTES_PER_SHARD_SECOND = 1024 * 1024
ARN_PREFIX = "arn:aws:kinesis"


def hash_key(partition_key: Column) -> Column:
    """MD5 of the UTF-8 key as 32 lower-case hex digits: their text order is the order of unsigned 128-bit integers."""
    return F.md5(partition_key.cast("binary"))


def uniform_shard(partition_key: Column, shards: int) -> Column:
    """Number of the shard among ``shards`` equal ranges, a power of two up to 2**31: arithmetic on 8 hex digits, no join."""
    if shards & (shards - 1) or not 0 < shards <= 1 << 31:
        raise ValueError("a power of two is needed")
    head = F.conv(F.substring(hash_key(partition_key), 1, 8), 16, 10).cast("bigint")
    return F.shiftright(head, 32 - (shards.bit_length() - 1)) if shards > 1 else F.lit(0).cast("bigint")


def entry_size(partition_key: Column, data: Column) -> Column:
    """Bytes of a record in a request."""
    return (F.octet_length(partition_key) + F.octet_length(data)).cast("bigint")


def aggregated_entry_size(partition_key: Column, data: Column) -> Column:
    """Upper bound of the bytes of a record inside an aggregated record."""
    return entry_size(partition_key, data) + ENTRY_OVERHEAD


def is_aggregated(data: Column) -> Column:
    return F.coalesce(F.hex(F.substring(data, 1, 4)) == MAGIC, F.lit(False))


def checksum_holds(data: Column) -> Column:
    """The trailing 16 bytes are the MD5 of what stands between them and the magic number."""
    size = F.octet_length(data)
    body = F.substring(data, F.lit(5), size - 4 - CHECKSUM_BYTES)
    return is_aggregated(data) & (size >= 4 + CHECKSUM_BYTES) & (F.lower(F.hex(F.substring(data, size - CHECKSUM_BYTES + 1, F.lit(CHECKSUM_BYTES)))) == F.md5(body))


def stream_kind(identifier: Column) -> Column:
    return F.when(identifier.startswith(ARN_PREFIX), "arn").otherwise("name")
