"""The produce path: route, aggregate, merge retries, throttle, batch, and read responses."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logtide.functions import keys
from logtide.functions.errors import entry_outcome
from logtide.operators import aggregation, batching, routing, throttle
from logtide.settings import ProducerSettings


def requests(records: DataFrame, attempt: int = 1) -> DataFrame:
    """Records (partition_key, data, position) as requests; ``records`` says how many each of them holds."""
    return records.select("partition_key", "data", "position", F.lit(attempt).alias("attempt"), F.lit(1).cast("bigint").alias("records"), keys.entry_size(F.col("partition_key"), F.col("data")).alias("payload_bytes"))


def aggregated(routed: DataFrame, max_bytes: int = keys.BYTES_PER_RECORD) -> DataFrame:
    """Requests of predicted shards packed into aggregated records, shard by shard; each stands where its last record stood."""
    sized = routed.withColumn("entry_bytes", keys.aggregated_entry_size(F.col("partition_key"), F.col("data")))
    batches = batching.aggregate_batches(sized, "predicted_shard", ["position", "attempt", "entry_bytes"], "entry_bytes", max_bytes)
    packed = aggregation.aggregate(batches, "predicted_shard", "position")
    return packed.select("partition_key", "data", F.col("last_position").alias("position"), F.lit(1).alias("attempt"), F.col("aggregate_count").cast("bigint").alias("records"), keys.entry_size(F.col("partition_key"), F.col("data")).alias("payload_bytes"), "predicted_shard")


def plan(new: DataFrame, retries: DataFrame, shards: DataFrame, settings: ProducerSettings = ProducerSettings(), factors: DataFrame | None = None, max_bytes: int = keys.BYTES_PER_REQUEST, max_records: int = keys.RECORDS_PER_REQUEST, max_record_bytes: int = keys.BYTES_PER_RECORD) -> DataFrame:
    """Requests with their predicted shard, release second and batch, as the settings say.

    New records are routed and, if asked for, aggregated by shard; retries (records, or whole aggregates) join them; each
    shard releases what its limits and its throughput factor allow; and one stream of all shards, in the order of release
    and arrival, is cut into requests of at most ``max_bytes`` and ``max_records``.
    """
    fresh, again = requests(new), requests(retries, 2)
    if settings.predict_shards:
        fresh, again = routing.predict_shards(fresh, shards), routing.predict_shards(again, shards)
        if settings.aggregate:
            fresh = aggregated(fresh, max_record_bytes)
    else:
        fresh, again = (x.withColumn("predicted_shard", F.lit(None).cast("string")) for x in (fresh, again))
    sent = fresh.unionByName(again)
    arrival = ["position", "attempt", "payload_bytes", "partition_key"]
    if settings.throttle:
        sent = throttle.release_seconds(sent, "predicted_shard", arrival, "payload_bytes", keys.RECORDS_PER_SHARD_SECOND, keys.BYTES_PER_SHARD_SECOND, factors)
    else:
        sent = sent.withColumn("release_second", F.lit(0).cast("bigint"))
    return batching.greedy_batches(sent, None, ["release_second", *arrival], "payload_bytes", max_bytes, max_records)


#: Rows of a partition of responses.
PART_ROWS = 500_000


def parts_for(spark, rows: int) -> int:
    """Partitions for so many rows: those of the session, or as many as keep each within PART_ROWS."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // PART_ROWS))


def split_responses(sent: DataFrame, responses: DataFrame) -> DataFrame:
    """Requests with the outcome of their entry (ok, retry, failed). sent and responses: by (batch, pos)."""
    return sent.join(responses.select("batch", "pos", "error_code"), ["batch", "pos"]).withColumn("outcome", entry_outcome(F.col("error_code")))


def chunk_completion(outcomes: DataFrame, chunk: str = "chunk_id", rows: int | None = None) -> DataFrame:
    """State of each produced chunk: failed with its first failure, complete when all entries are ok, pending otherwise.

    rows: how many entries there are at most, where that is known, so that tasks don't grow with them.
    """
    if rows is not None:
        outcomes = outcomes.repartition(parts_for(outcomes.sparkSession, rows), chunk)
    failed = F.max((F.col("outcome") == "failed").cast("int")) == 1
    done = F.min((F.col("outcome") == "ok").cast("int")) == 1
    return outcomes.groupBy(chunk).agg(F.count("*").alias("entries"), F.when(failed, "failed").when(done, "complete").otherwise("pending").alias("state"))


def error_codes(outcomes: DataFrame, limit: int = 10) -> DataFrame:
    """The first error codes of failed entries, in the order of their batch and place: what a log line tells of them."""
    return outcomes.where("error_code is not null").select("batch", "pos", "error_code").orderBy("batch", "pos").limit(limit)


def rerouted(outcomes: DataFrame, shards: DataFrame) -> DataFrame:
    """Entries to be sent again, routed by the current shard map: after a reshard their shard may be another one."""
    again = outcomes.where(F.col("outcome") == "retry").drop("predicted_shard")
    return routing.predict_shards(again, shards)
