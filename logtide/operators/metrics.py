"""Producer metrics and worker diagnostics as mergeable relations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logtide.operators.batching import ranged


def histogram(df: DataFrame, keys: list[str], value: str, weight: str | None = None) -> DataFrame:
    """Occurrences of each value: exact, and merged by adding counts."""
    count = F.sum(weight) if weight else F.count("*")
    return df.groupBy(*keys, value).agg(count.cast("bigint").alias("n"))


def merge_histograms(parts: DataFrame, keys: list[str], value: str) -> DataFrame:
    return parts.groupBy(*keys, value).agg(F.sum("n").cast("bigint").alias("n"))


def bucket(value: Column, digits: int) -> Column:
    """The least value that has the same ``digits`` significant digits, nearly: values of equal leading bits fall together.

    Buckets are linear within each power of two, as many as 10**digits needs, so that a bucket's width is less than its value
    divided by 10**digits; there are at most 64 times as many buckets, whatever the values (whole numbers, not negative).
    """
    bits = (10**digits).bit_length() + 1
    shift = F.greatest(F.length(F.bin(value)) - bits, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", value, shift), shift)


def digit_histogram(df: DataFrame, keys: list[str], value: str, digits: int = 3, weight: str | None = None) -> DataFrame:
    """Occurrences of each bucket of values: bounded in size, and merged by adding counts (``merge_histograms``)."""
    bucketed = df.withColumn("bucket", bucket(F.col(value).cast("bigint"), digits))
    return histogram(bucketed, keys, "bucket", weight)


def histogram_quantiles(parts: DataFrame, keys: list[str], quantiles: dict[str, float], value: str = "bucket") -> DataFrame:
    """For each of the keys the number of occurrences, and the bucket at which a share of them has been seen."""
    pairs = parts.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(value, "n"))).alias("__pairs"), F.sum("n").cast("bigint").alias("n"))  # buckets are bounded

    def at(share: float) -> Column:
        seen = F.aggregate("__pairs", F.struct(F.lit(0).cast("bigint").alias("seen"), F.lit(None).cast("bigint").alias("at")), lambda acc, x: F.struct((acc["seen"] + x["n"]).alias("seen"), F.when(acc["at"].isNull() & (acc["seen"] + x["n"] >= F.ceil(F.col("n") * F.lit(share))), x[value]).otherwise(acc["at"]).alias("at")))
        return seen["at"]

    return pairs.select(*keys, "n", *(at(share).alias(name) for name, share in quantiles.items()))


#: Sums of a metrics row, and what they are made of.
SUMS = {
    "published": "published", "failures": "failed", "calls": "1", "latency_sum": "if(published > 0, latency_ms * published, 0)", "second_attempts": "if(published > 0 and attempts = 2, published, 0)",
    "payload_sum": "payload_bytes", "record_sum": "record_bytes", "prediction_errors": "cast(shard_mismatch as int)",
}


def partial_metrics(attempts: DataFrame, keys: list[str]) -> DataFrame:
    """Mergeable metrics rows: sums, the most attempts, and the latencies of successes with how often each occurred.

    attempts: (published: records of a success, 0 for a failure; failed: failures; attempts, latency_ms: of a success;
    payload_bytes, record_bytes; shard_mismatch). An aggregate counts its records.
    """
    latency = F.when(F.col("published") > 0, F.col("latency_ms"))
    sums = [F.sum(F.expr(x)).cast("bigint").alias(name) for name, x in SUMS.items()]
    per = attempts.groupBy(*keys, latency.alias("latency")).agg(*sums, F.max(F.when(F.col("published") > 0, F.col("attempts"))).alias("max_attempts"), F.count("*").alias("n"))
    return _gathered(per, keys)


def _gathered(per: DataFrame, keys: list[str]) -> DataFrame:
    """One row for each of the keys from rows for each of their latencies."""
    pair = F.when(F.col("latency").isNotNull(), F.struct("latency", "n"))
    return per.groupBy(*keys).agg(*(F.sum(name).alias(name) for name in SUMS), F.max("max_attempts").alias("max_attempts"), F.array_sort(F.collect_list(pair)).alias("latencies"))


def merge_metrics(parts: DataFrame, keys: list[str]) -> DataFrame:
    """Metrics rows of several intervals as rows of the keys: sums are added, histograms united."""
    held = parts.groupBy(*keys).agg(*(F.sum(name).alias(name) for name in SUMS), F.max("max_attempts").alias("max_attempts"))
    one = parts.select(*keys, F.explode("latencies").alias("x")).groupBy(*keys, "x.latency").agg(F.sum("x.n").alias("n"))
    lists = one.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("latency", "n"))).alias("latencies"))
    return held.join(lists, keys, "left").withColumn("latencies", F.coalesce("latencies", F.expr("filter(array(named_struct('latency', cast(null as bigint), 'n', 0L)), x -> false)").cast(lists.schema["latencies"].dataType)))


def finished_metrics(parts: DataFrame, keys: list[str], interval_ms: int) -> DataFrame:
    """Rates, means and the exact 95th percentile of metrics rows."""
    total = F.aggregate("latencies", F.lit(0).cast("bigint"), lambda acc, x: acc + x["n"])
    # the first latency at which 95 of 100 occurrences have been seen
    found = F.aggregate(
        "latencies",
        F.struct(F.lit(0).cast("bigint").alias("seen"), F.get("latencies", F.lit(0))["latency"].alias("at"), F.lit(False).alias("done")),
        lambda acc, x: F.when(acc["done"], acc).otherwise(F.struct((acc["seen"] + x["n"]).alias("seen"), x["latency"].alias("at"), ((acc["seen"] + x["n"]) * 100 >= F.col("total") * 95).alias("done"))),
    )["at"]
    out = parts.withColumn("total", total).withColumn("latency_p95", found).withColumn("latency_min", F.get("latencies", F.lit(0))["latency"])
    return out.withColumn("latency_sum", F.when(F.col("total") > 0, F.col("latency_sum"))).select(*keys, *derived(interval_ms))


def producer_metrics(attempts: DataFrame, keys: list[str], interval_ms: int) -> DataFrame:
    """Metrics of produce attempts, for each interval of the keys."""
    return finished_metrics(partial_metrics(attempts, keys), keys, interval_ms)


def derived(interval_ms: int) -> list[Column]:
    """Rates and means from sums."""
    c = F.col
    total = c("published") + c("failures")
    return [
        c("published"), c("failures"), c("calls"),
        F.when(total > 0, c("published") / total).otherwise(1.0).alias("success_rate"),
        (c("published") * 1000.0 / interval_ms if interval_ms > 0 else F.lit(None).cast("double")).alias("throughput"),
        (c("calls") * 1000.0 / interval_ms if interval_ms > 0 else F.lit(0.0)).alias("mean_calls"),
        (c("latency_sum") / c("published")).alias("mean_latency"),
        c("latency_p95"), c("latency_min"), c("second_attempts"), c("max_attempts"),
        (c("payload_sum") / c("calls")).alias("mean_payload"), (c("record_sum") / c("calls")).alias("mean_record"), c("prediction_errors"),
    ]


# Names, operations and units of the published metrics.
_FETCH = (("RecordsProcessed", "nr_records", "Count"), ("Time", "duration_ms", "Milliseconds"), ("MillisBehindLatest", "behind_ms", "Milliseconds"))


def event_metrics(events: DataFrame, worker: str) -> DataFrame:
    """Metric data of diagnostic events (event_id, ts, event_type, shard_id, nr_records, duration_ms, behind_ms).

    Polls and subscriptions give three data on the shard, a lost lease one and a renewal two on the worker, others none.
    """

    def datum(name: str, value: Column, unit: str, operation: str, shard: Column) -> Column:
        own = F.when(shard.isNull(), F.lit(worker))
        return F.struct(F.lit(name).alias("name"), value.cast("double").alias("value"), F.lit(unit).alias("unit"), F.lit(operation).alias("operation"), shard.alias("shard_id"), own.alias("worker_id"))

    none, shard = F.lit(None).cast("string"), F.col("shard_id")
    fetch = [datum(n, F.coalesce(F.col(c), F.lit(0)), u, "ProcessTask", shard) for n, c, u in _FETCH]
    lost = [datum("LostLeases", F.lit(1), "Count", "RenewAllLeases", none)]
    renewed = [datum("RenewLease.Time", F.col("duration_ms"), "Milliseconds", "RenewAllLeases", none), datum("RenewLease.Success", F.lit(1), "Count", "RenewAllLeases", none)]
    kind = F.col("event_type")
    data = F.when(kind.isin("PollComplete", "SubscribeToShardEvent"), F.array(*fetch)).when(kind == "ShardLeaseLost", F.array(*lost)).when(kind == "LeaseRenewed", F.array(*renewed))
    return events.select("event_id", "ts", F.posexplode(data).alias("nr", "datum")).select("event_id", "ts", "nr", "datum.*")


def upload_batches(data: DataFrame, order: list[str], size: int = 20) -> DataFrame:
    """Adds the number of the upload batch: at most ``size`` data each, in order.

    Rows are numbered in ranges of the order's first column, so that no task holds them all; the order's columns identify a row.
    """
    spread = ranged(data, order).withColumn("__part", F.spark_partition_id())  # partitions that stay, whatever is lost
    numbered = spread.withColumn("__nr", F.row_number().over(Window.partitionBy("__part").orderBy(*order)))
    counts = numbered.groupBy("__part").agg(F.count("*").alias("__n"))
    starts = counts.select("__part", F.coalesce(F.sum("__n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__start"))  # a row for each partition
    return numbered.join(F.broadcast(starts), "__part").withColumn("upload", F.floor((F.col("__start") + F.col("__nr") - 1) / size).cast("bigint")).drop("__part", "__nr", "__start")


def last_state(events: DataFrame, key: str, order: str, on: list[str], off: list[str]) -> DataFrame:
    """Keys whose last on or off event switched them on."""
    both = events.where(F.col("event_type").isin(*on, *off))
    return both.groupBy(key).agg(F.max_by("event_type", order).alias("event_type")).where(F.col("event_type").isin(*on)).select(key)


def gauges(events: DataFrame, key: str, order: str, period: str, on: list[str], off: list[str]) -> DataFrame:
    """Keys switched on at the end of each period in which there are events.

    A key's change of state counts once: +1 or -1 in the period where it happens; the gauge is the running sum over periods.
    """
    state = F.col("event_type").isin(*on).cast("int")
    before = F.coalesce(F.lag(state).over(Window.partitionBy(key).orderBy(order)), F.lit(0))
    changes = events.where(F.col("event_type").isin(*on, *off)).withColumn("delta", state - before)
    per = changes.groupBy(period).agg(F.sum("delta").alias("delta"))
    return per.select(period, F.sum("delta").over(Window.orderBy(period)).cast("bigint").alias("value"))
