"""Checkpoints as relations."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from logtide.functions.positions import after_checkpoint
from logtide.operators import scans


def resume(records: DataFrame, checkpoints: DataFrame) -> DataFrame:
    """Records after their shard's checkpoint (shard_id, special, seq, sub_seq); shards without one are read whole."""
    held = checkpoints.select("shard_id", F.struct("special", "seq", "sub_seq").alias("__checkpoint"))
    out = records.join(held, "shard_id", "left")
    keep = F.col("__checkpoint").isNull() | after_checkpoint(F.col("sequence_number"), F.col("sub_sequence_number"), F.col("__checkpoint"))
    return out.where(keep).drop("__checkpoint")


def last_staged(records: DataFrame) -> DataFrame:
    """Per shard: the last position and the greatest sequence number seen."""
    position = F.struct("sequence_number", F.coalesce("sub_sequence_number", F.lit(0).cast("bigint")).alias("sub_sequence_number"))
    return records.groupBy("shard_id").agg(F.max(position).alias("__p"), F.count("*").alias("records")).select("shard_id", F.col("__p.sequence_number").alias("seq"), F.col("__p.sub_sequence_number").alias("sub_seq"), "records")


def batched(records: DataFrame, shard: str, position: str, every: int) -> DataFrame:
    """One checkpoint for each ``every`` records of a shard, by their number in the shard (from 1), at the last staged position."""
    group = F.floor((F.col(position) - 1) / every).cast("bigint").alias("checkpoint_nr")
    return records.groupBy(shard, group).agg(F.max(position).alias("last_position"), F.count("*").alias("records"))


def batched_or_timed(records: DataFrame, shard: str, order: list[str], time: str, every: int, interval: float) -> DataFrame:
    """Adds ``checkpoint_nr``: a checkpoint comes after ``every`` records of a shard, or before a record that arrives ``interval`` seconds or more after the first one that it is to cover.

    time: seconds, not falling along the order. Where the interval cuts follows, for each record, from the last one that is
    so much older, which a merge of the shard's times with themselves finds; a shard may lie in many tasks.
    """
    placed = scans.numbered(records, shard, order, "__position").withColumn("__limit", F.col(time) - F.lit(interval))
    older = placed.groupBy(shard, F.col(time).alias("__limit")).agg(F.max("__position").alias("__before"))
    with_older = scans.asof(placed, older, [shard], "__limit", ["__before"]).withColumn("__before", F.coalesce("__before", F.lit(-1).cast("bigint")))
    return scans.segments(with_older, shard, "__position", "__before", every).withColumnRenamed("segment", "checkpoint_nr").drop("__position", "__limit", "__before")


def numbered(records: DataFrame, shard: str, order: list[str], into: str = "position") -> DataFrame:
    """Adds the number of each record in its shard, from 1."""
    return records.withColumn(into, F.row_number().over(Window.partitionBy(shard).orderBy(*order)).cast("bigint"))


def without_redelivery(records: DataFrame) -> DataFrame:
    """Each (shard, sequence number, sub-sequence number) once: delivery is at least once."""
    return records.dropDuplicates(["shard_id", "sequence_number", "sub_sequence_number"])


def pages(records: DataFrame, shard: str, position: str, limit: int) -> DataFrame:
    """Poll pages of ``limit`` records: number of the page and how many records are left behind it."""
    page = F.floor((F.col(position) - 1) / limit).cast("bigint").alias("page")
    counted = records.groupBy(shard, page).agg(F.count("*").alias("records"), F.max(position).alias("last_position"))
    total = F.sum("records").over(Window.partitionBy(shard))
    return counted.withColumn("behind", total - F.col("last_position"))
