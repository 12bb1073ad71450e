"""Routing records to shards by hash range."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logtide.functions.keys import hash_key
from logtide.operators import scans
from logtide.schema import SHARD

SPACE = 1 << 128
#: Shards that are broadcast; a larger shard map is joined by a shuffle on the same keys.
BROADCAST = 50_000
#: Successive maps whose instants are compared with each record's time directly.
EPOCHS = 64


def uniform_ranges(n: int, name: str = "shard-{:03d}") -> list[tuple[str, str, str]]:
    """(shard_id, lowest, highest hash key) of n equal ranges."""
    edges = [SPACE * i // n for i in range(n + 1)]
    return [(name.format(i), f"{a:032x}", f"{b - 1:032x}") for i, (a, b) in enumerate(zip(edges, edges[1:]))]


def shard_map(spark: SparkSession, n: int) -> DataFrame:
    if n < 1:
        raise ValueError("no shards in stream")
    return spark.createDataFrame([(*r, []) for r in uniform_ranges(n)], SHARD)


def predict_shards(records: DataFrame, shards: DataFrame, key: str = "partition_key", into: str = "predicted_shard", count: int | None = None) -> DataFrame:
    """Adds the shard whose range holds the key's hash; null if no range does.

    Ranges become rows for each head of hex digits that they reach, so that the join is one on equal heads with a range check,
    not a comparison of every key with every shard; heads are as long as the map is large, so that few ranges share one.
    count: how many shards there are, where that is known; else they are counted.
    """
    if count is None:
        count = shards.limit(BROADCAST + 1).count()
    digits = 2 if count <= 256 else 3 if count <= 4096 else 4
    head = lambda c: F.conv(F.substring(c, 1, digits), 16, 10).cast("int")
    ranges = shards.select(F.col("shard_id").alias(into), F.col("lo").alias("__lo"), F.col("hi").alias("__hi"), F.explode(F.sequence(head("lo"), head("hi"))).alias("__head"))
    if count <= BROADCAST:
        ranges = F.broadcast(ranges)
    hashed = records.withColumn("__hash", hash_key(F.col(key))).withColumn("__own", head("__hash"))
    on = (F.col("__own") == F.col("__head")) & F.col("__hash").between(F.col("__lo"), F.col("__hi"))
    return hashed.join(ranges, on, "left").drop("__hash", "__own", "__head", "__lo", "__hi")


def route_at(records: DataFrame, maps: DataFrame, at: str, key: str = "partition_key", into: str = "predicted_shard") -> DataFrame:
    """Adds the shard of each record by the map that was valid at its time; null before the first map, or where a map has no range.

    maps: (valid_from, shard_id, lo, hi): each map is valid until the next one. Records and ranges are merged by (map, hash) in
    sorted order, so that a record meets the one range that may hold it, however many shards a map has and however narrow they
    are. Up to EPOCHS instants are compared directly; more of them are merged by time first.
    """
    instants = maps.select("valid_from").distinct()
    few = [r[0] for r in instants.limit(EPOCHS + 1).collect()]
    hashed = records.withColumn("__hash", hash_key(F.col(key)))
    if len(few) > EPOCHS:
        timed = hashed.withColumn("__at", F.col(at))
        hashed = scans.asof(timed, instants.select(F.col("valid_from").alias("__at"), F.col("valid_from").alias("__map")), [], "__at", ["__map"]).drop("__at")
    else:
        kind = maps.schema["valid_from"].dataType
        known = F.array(*[F.lit(x).cast(kind) for x in sorted(few)]) if few else F.array().cast(f"array<{kind.simpleString()}>")
        hashed = hashed.withColumn("__map", F.array_max(F.filter(known, lambda x: x <= F.col(at))))
    ranges = maps.select(F.col("valid_from").alias("__map"), F.col("lo").alias("__hash"), F.col("hi").alias("__hi"), F.col("shard_id").alias(into))
    found = scans.asof(hashed, ranges, ["__map"], "__hash", ["__hi", into])
    return found.withColumn(into, F.when(F.col("__hash") <= F.col("__hi"), F.col(into))).drop("__hash", "__map", "__hi")


def stale_predictions(records: DataFrame, maps: DataFrame, at: str, known_at: str, key: str = "partition_key") -> DataFrame:
    """Records that a producer sends elsewhere than they belong, as its map is that of an earlier instant; adds predicted_shard and actual_shard."""
    both = route_at(route_at(records, maps, known_at, key), maps, at, key, "actual_shard")
    return both.where(~F.col("predicted_shard").eqNullSafe(F.col("actual_shard")))


def prediction_errors(records: DataFrame, old: DataFrame, new: DataFrame, key: str = "partition_key") -> DataFrame:
    """Records whose shard by an old map is neither their shard by the new one nor its parent; adds predicted_shard and actual_shard."""
    both = predict_shards(predict_shards(records, old, key), new, key, "actual_shard")
    return both.where(~F.col("predicted_shard").eqNullSafe(F.col("actual_shard")))


def child_shards(children: DataFrame) -> DataFrame:
    """Shards of detected children (shard_id, lo, hi, parents); a child has one or two parents, or it is an error."""
    n = F.coalesce(F.size("parents"), F.lit(0))
    parents = F.when(n.between(1, 2), F.col("parents")).otherwise(F.raise_error(F.concat(F.lit("unexpected number of parents: "), n.cast("string"))).cast("array<string>"))
    return children.select("shard_id", "lo", "hi", parents.alias("parent_shard_ids"))


def merge_shards(known: DataFrame, found: DataFrame) -> DataFrame:
    """The union of two shard lists; of equal ids the found one wins."""
    return found.unionByName(known.join(found, "shard_id", "left_anti"))
