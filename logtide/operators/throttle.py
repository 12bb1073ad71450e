"""Throttling by shard: how much is sent when, and how success feeds back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logtide.operators import scans
from logtide.operators.routing import BROADCAST

#: Error rate that the producer allows before it slows down.
ALLOWED_ERROR = 0.05


def throughput_factors(counts: DataFrame, shard: str = "shard_id", allowed_error: float = ALLOWED_ERROR) -> DataFrame:
    """Adds the factor after each period: r <- min(1, r * s + allowed), s the period's share of successes (1 without any attempt).

    counts: (shard, period, successes, failures). Such maps compose, so that a shard's periods may lie in many tasks.
    """
    tried = F.col("successes") + F.col("failures")
    shares = counts.select(shard, "period", F.when(tried > 0, F.col("successes") / tried).otherwise(1.0).alias("__share"))
    return scans.bounded_affine(shares, shard, ["period"], "__share", allowed_error, 1.0, "factor").select(shard, "period", "factor")


def release_times(requests: DataFrame, shard: str, order: list[str], arrival: str, size: str, records: tuple[float, float] | None, held: tuple[float, float] | None) -> DataFrame:
    """Adds ``release_time`` (seconds): when each request leaves its shard's token buckets, one of records and one of bytes.

    arrival: seconds, not falling along the order. records, held: (units a second, units that may leave at once), None: no such
    bucket. Idle time fills the buckets, up to what they hold.
    """
    counted = requests.withColumn("__one", F.lit(1))
    costs = {name: rate for name, rate in (("__one", records), (size, held)) if rate}
    return scans.token_bucket(counted, shard, order, arrival, costs, "release_time").drop("__one")


def release_seconds(requests: DataFrame, shard: str, order: list[str], size: str, max_records: int, max_bytes: int, factors: DataFrame | None = None) -> DataFrame:
    """Adds the second in which each request leaves its shard, as an admission plan: both running sums stay within their limit for each second.

    factors: (shard, factor), the throughput factors of shards (a row for each at most); costs are divided by them. The sums go
    over ranges of the order, so that a shard may lie in many tasks; up to BROADCAST factors are sent to these, as a join by a
    shuffle would bring a whole shard to one task.
    """
    summed = scans.sums_before(requests.withColumn("__one", F.lit(1)).withColumn("__size", F.coalesce(F.col(size), F.lit(0))), shard, order, {"__one": "__records", "__size": "__bytes"})
    factor = F.lit(1.0)
    if factors is not None:
        # by null-safe equality, as requests without a predicted shard have none
        held = factors.select(F.col(shard).alias("__of"), F.col("factor").alias("__factor"))
        if held.limit(BROADCAST + 1).count() <= BROADCAST:
            held = F.broadcast(held)
        summed = summed.join(held, F.col(shard).eqNullSafe(F.col("__of")), "left")
        factor = F.coalesce("__factor", F.lit(1.0))
    second = lambda x, limit: F.floor(F.col(x) / factor / F.lit(limit))
    return summed.withColumn("release_second", F.greatest(second("__records", max_records), second("__bytes", max_bytes)).cast("bigint")).drop("__one", "__size", "__records", "__bytes", "__of", "__factor")
