import hashlib

import pytest
from pyspark.sql import functions as F

from logtide.functions import errors, keys, positions, serde
from logtide.operators import routing


def one(spark, *columns, **values):
    frame = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()]) if values else spark.range(1)
    return frame.select(*columns).first()


def test_hash_key_is_md5(spark):
    assert one(spark, keys.hash_key(F.lit("key1")))[0] == hashlib.md5(b"key1").hexdigest()


def test_uniform_shards_agree_with_ranges(spark):
    rows = spark.range(500).select(F.col("id").cast("string").alias("partition_key"))
    both = routing.predict_shards(rows, routing.shard_map(spark, 8)).withColumn("nr", keys.uniform_shard(F.col("partition_key"), 8))
    assert both.where(F.col("predicted_shard") != F.format_string("shard-%03d", "nr")).count() == 0
    assert both.where("predicted_shard is null").count() == 0


def test_routing_needs_a_covering_map(spark):
    half = routing.shard_map(spark, 2).where("shard_id = 'shard-000'")
    rows = spark.range(200).select(F.col("id").cast("string").alias("partition_key"))
    out = routing.predict_shards(rows, half)
    assert out.count() == 200 and 0 < out.where("predicted_shard is null").count() < 200
    with pytest.raises(ValueError):
        routing.shard_map(spark, 0)


def test_child_needs_one_or_two_parents(spark):
    found = spark.createDataFrame([("a", "0" * 32, "f" * 32, [])], "shard_id string, lo string, hi string, parents array<string>")
    with pytest.raises(Exception, match="unexpected number of parents"):
        routing.child_shards(found).collect()


def test_merged_shards_prefer_found_ones(spark):
    a, b = routing.shard_map(spark, 2), routing.shard_map(spark, 4)
    out = {r.shard_id: r.hi for r in routing.merge_shards(a, b).collect()}
    assert len(out) == 4 and out["shard-001"] == routing.uniform_ranges(4)[1][2]


@pytest.mark.parametrize(
    "checkpoint, initial, want",
    [
        (("SHARD_END", None), "LATEST", "invalid"), (("TRIM_HORIZON", None), "LATEST", "TRIM_HORIZON"), (("AT_TIMESTAMP", None), "AT_TIMESTAMP", "AT_TIMESTAMP"),
        (("AT_TIMESTAMP", None), "LATEST", "invalid"), ((None, "5"), "LATEST", "AT_SEQUENCE_NUMBER"), (None, "LATEST", "LATEST"),
    ],
)
def test_start_positions(spark, checkpoint, initial, want):
    row = spark.createDataFrame([((*checkpoint, 0) if checkpoint else None, initial)], "c struct<special: string, seq: string, sub_seq: bigint>, i string")
    assert row.select(positions.start_position(F.col("c"), F.col("i"), F.lit(None).cast("timestamp"))["iterator"]).first()[0] == want


def test_ascii_reads_a_mark_for_each_foreign_byte(spark):
    assert one(spark, serde.ascii_string.deserialize(serde.ascii_string.serialize(F.lit("aéz"))))[0] == "a��z"


def test_string_refuses_what_is_not_utf8(spark):
    out = one(spark, serde.string.as_try().deserialize(F.unhex(F.lit("FF41"))))[0]
    assert out.value is None and out.error == "unreadable"
    assert one(spark, serde.string.as_try().deserialize(F.lit(None).cast("binary")))[0].error is None


def test_serde_combinators(spark):
    number = serde.string.inmap(lambda c: c.try_cast("int"), lambda c: c.cast("string"))
    assert one(spark, number.deserialize(number.serialize(F.lit(12))))[0] == 12
    assert one(spark, serde.integer.or_else(serde.Serde(lambda v: v, lambda b: F.lit(-1).cast("bigint"))).deserialize(F.lit("x").cast("binary")))[0] == -1


def test_backoff_is_capped(spark):
    out = [r[0] for r in spark.range(11).select(positions.backoff(F.col("id"), 100, 1000)).collect()]
    assert out[:5] == [100, 200, 400, 800, 1000] and max(out) == 1000 and len(out) == 11


def test_recoverable(spark):
    n = F.lit(None).cast("int")
    s = F.lit(None).cast("string")
    assert one(spark, errors.is_recoverable(F.lit("SdkException"), n, F.lit("IOException")))[0]
    assert one(spark, errors.is_recoverable(F.lit("ServiceException"), F.lit(500), s))[0]
    assert not one(spark, F.coalesce(errors.is_recoverable(F.lit("ServiceException"), F.lit(400), s), F.lit(False)))[0]
