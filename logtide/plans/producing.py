"""Queries of the produce path: routing, sizes, batches, aggregation, responses, throttling, metrics."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from logtide.functions import errors, keys, positions, serde
from logtide.operators import aggregation, batching, checkpoints, metrics, produce, routing, throttle
from logtide.plans.registry import query
from logtide.plans.relations import PRODUCED_SQL, SHARDED_SQL, SHARDS, greedy_sql, produced, shard_sql, sharded, stream, table, values_sql
from logtide.scratch import shared_root
from logtide.settings import ProducerSettings
from logtide.streaming import consume

KEY = "CAST(user_id AS VARCHAR)"


@query(f"""
SELECT s.shard_id, count(*) AS records, CAST(sum(strlen({KEY}) + strlen(coalesce(props, ''))) AS BIGINT) AS bytes
FROM events JOIN (VALUES {values_sql(SHARDS)}) s(shard_id, lo, hi) ON md5({KEY}) BETWEEN s.lo AND s.hi GROUP BY s.shard_id
""")
def shard_distribution(spark, sf_dir):
    """Records and bytes of each shard."""
    routed = routing.predict_shards(stream(spark, sf_dir), routing.shard_map(spark, SHARDS), into="shard_id")
    return routed.groupBy("shard_id").agg(F.count("*").alias("records"), F.sum(keys.entry_size(F.col("partition_key"), F.col("data"))).alias("bytes"))


@query(f"""
SELECT event_id, md5({KEY}) AS hash_key, s.shard_id AS predicted_shard, CAST(floor(CAST('0x' || substr(md5({KEY}), 1, 8) AS BIGINT) * 8 / 4294967296) AS BIGINT) AS uniform_shard
FROM events JOIN (VALUES {values_sql(5)}) s(shard_id, lo, hi) ON md5({KEY}) BETWEEN s.lo AND s.hi
""")
def shard_prediction(spark, sf_dir):
    """Shard of each record among five ranges, and by arithmetic among eight."""
    key = F.col("partition_key")
    routed = routing.predict_shards(stream(spark, sf_dir), routing.shard_map(spark, 5))
    return routed.select("event_id", keys.hash_key(key).alias("hash_key"), "predicted_shard", keys.uniform_shard(key, 8).alias("uniform_shard"))


@query(f"""
SELECT p.shard_id AS predicted_shard, a.shard_id AS actual_shard, count(*) AS records
FROM events JOIN (VALUES {values_sql(4)}) p(shard_id, lo, hi) ON md5({KEY}) BETWEEN p.lo AND p.hi JOIN (VALUES {values_sql(8)}) a(shard_id, lo, hi) ON md5({KEY}) BETWEEN a.lo AND a.hi
WHERE p.shard_id <> a.shard_id GROUP BY ALL
""")
def shard_prediction_errors(spark, sf_dir):
    """Records that an outdated map of four shards sends elsewhere than the new one of eight."""
    wrong = routing.prediction_errors(stream(spark, sf_dir), routing.shard_map(spark, 4), routing.shard_map(spark, 8))
    return wrong.groupBy("predicted_shard", "actual_shard").agg(F.count("*").alias("records"))


MAPS = {"1992-01-01": 2, "1994-06-01": 3, "1996-09-01": 7}
MAPS_SQL = " UNION ALL ".join(f"SELECT DATE '{day}' AS valid_from, 'm{n}-' || s AS shard_id, lo, hi FROM (VALUES {values_sql(n)}) v(s, lo, hi)" for day, n in MAPS.items())
UNTIL_SQL = "SELECT *, coalesce((SELECT min(valid_from) FROM maps x WHERE x.valid_from > m.valid_from), DATE '9999-01-01') AS valid_to FROM maps m"


def _maps(spark):
    rows = [(day, f"m{n}-{s}", lo, hi) for day, n in MAPS.items() for s, lo, hi in routing.uniform_ranges(n)]
    return spark.createDataFrame(rows, "valid_from string, shard_id string, lo string, hi string").withColumn("valid_from", F.col("valid_from").cast("date"))


def _shipped(spark, sf_dir):
    day = F.col("l_shipdate").cast("date")
    return table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").cast("string").alias("partition_key"), "l_linenumber", day.alias("day"), F.date_sub(day, 90).alias("known"))


@query(f"""
WITH maps AS ({MAPS_SQL}), v AS ({UNTIL_SQL})
SELECT shard_id, count(*) AS records, count(DISTINCT l_orderkey) AS keys, CAST(min(CAST(l_shipdate AS DATE)) AS VARCHAR) AS first_day, CAST(max(CAST(l_shipdate AS DATE)) AS VARCHAR) AS last_day
FROM lineitem LEFT JOIN v ON CAST(l_shipdate AS DATE) >= valid_from AND CAST(l_shipdate AS DATE) < valid_to AND md5(CAST(l_orderkey AS VARCHAR)) BETWEEN lo AND hi GROUP BY shard_id
""")
def route_by_map_of_the_time(spark, sf_dir):
    """Records routed through three successive shard maps, each by the one that was valid when it was sent."""
    routed = routing.route_at(_shipped(spark, sf_dir), _maps(spark), "day", into="shard_id")
    return routed.groupBy("shard_id").agg(F.count("*").alias("records"), F.countDistinct("partition_key").alias("keys"), F.min("day").cast("string").alias("first_day"), F.max("day").cast("string").alias("last_day"))


@query(f"""
WITH maps AS ({MAPS_SQL}), v AS ({UNTIL_SQL}), l AS (SELECT md5(CAST(l_orderkey AS VARCHAR)) AS h, CAST(l_shipdate AS DATE) AS day, CAST(l_shipdate AS DATE) - 90 AS known FROM lineitem)
SELECT p.shard_id AS predicted_shard, a.shard_id AS actual_shard, count(*) AS records
FROM l LEFT JOIN v p ON l.known >= p.valid_from AND l.known < p.valid_to AND h BETWEEN p.lo AND p.hi LEFT JOIN v a ON l.day >= a.valid_from AND l.day < a.valid_to AND h BETWEEN a.lo AND a.hi
WHERE p.shard_id IS DISTINCT FROM a.shard_id GROUP BY ALL
""")
def stale_map_errors(spark, sf_dir):
    """Records sent by the map of ninety days before, where that is another shard than the right one."""
    wrong = routing.stale_predictions(_shipped(spark, sf_dir), _maps(spark), "day", "known")
    return wrong.groupBy("predicted_shard", "actual_shard").agg(F.count("*").alias("records"))


@query(f"""
SELECT position, CAST(strlen(partition_key) + strlen(data) AS BIGINT) AS entry_bytes, CAST(strlen(partition_key) + strlen(data) + 8 AS BIGINT) AS aggregated_bytes FROM ({PRODUCED_SQL})
""")
def payload_sizes(spark, sf_dir):
    """Bytes of each record in a request and inside an aggregated record."""
    key, data = F.col("partition_key"), F.col("data")
    return produced(spark, sf_dir).select("position", keys.entry_size(key, data).alias("entry_bytes"), keys.aggregated_entry_size(key, data).alias("aggregated_bytes"))


@query("""
SELECT event_id, upper(substr(hex(encode(d)), 1, 8)) = 'F3899AC2' AS aggregated FROM (
  SELECT event_id, CASE WHEN event_id % 3 = 0 THEN '' ELSE coalesce(props, '') END AS d FROM events) WHERE event_id % 3 <> 1
UNION ALL SELECT event_id, true FROM events WHERE event_id % 3 = 1
""")
def is_aggregated(spark, sf_dir):
    """Which records begin with the magic number: every third is made to."""
    nr = F.col("event_id") % 3
    data = F.when(nr == 1, F.concat(F.unhex(F.lit(keys.MAGIC)), "data")).when(nr == 0, F.lit("").cast("binary")).otherwise(F.col("data"))
    return stream(spark, sf_dir).select("event_id", keys.is_aggregated(data).alias("aggregated"))


@query("""
SELECT event_id, event_id % 4 <> 3 AS holds FROM events
""")
def aggregate_checksum(spark, sf_dir):
    """Whether an aggregated record's checksum holds: of every fourth record a byte is changed."""
    entries = F.array(F.struct("partition_key", "data"))
    packed = stream(spark, sf_dir).select("event_id", aggregation.encode_entries(entries).alias("packed"))
    broken = F.concat(F.substring("packed", 1, 4), F.unhex(F.lit("FF")), F.substring(F.col("packed"), F.lit(6), F.octet_length("packed")))
    return packed.select("event_id", keys.checksum_holds(F.when(F.col("event_id") % 4 == 3, broken).otherwise(F.col("packed"))).alias("holds"))


@query(f"""
SELECT shard_id, event_id, partition_key, md5(data) AS data_md5, (position - 1) % 10 AS sub_sequence_number, true AS aggregated FROM ({SHARDED_SQL})
""")
def deaggregate_roundtrip(spark, sf_dir):
    """Ten records of a shard at a time, packed into one and unpacked again."""
    records = sharded(spark, sf_dir).withColumn("batch", F.floor((F.col("position") - 1) / 10))
    packed = aggregation.aggregate(records, "shard_id", "position").withColumn("explicit_hash_key", F.lit(None).cast("string"))
    out = aggregation.deaggregate(packed)
    back = records.select("shard_id", "position", "event_id")
    out = out.withColumn("position", F.col("first_position") + F.col("sub_sequence_number")).join(back, ["shard_id", "position"])
    return out.select("shard_id", "event_id", "partition_key", F.md5("data").alias("data_md5"), "sub_sequence_number", "aggregated")


DOCUMENT_ROWS = "SELECT 0 AS shard, doc_id AS ord, CAST(strlen(CAST(doc_id AS VARCHAR)) + strlen(coalesce(text, '')) AS BIGINT) AS size FROM documents"


@query(f"""
WITH RECURSIVE {greedy_sql(DOCUMENT_ROWS, 50_000, 500)}
SELECT b.batch, count(*) AS records, CAST(sum(r.size) AS BIGINT) AS bytes, min(r.ord) AS first_position, max(r.size) > 50000 AS oversized
FROM batches b JOIN rows r ON r.shard = b.shard AND r.rn BETWEEN b.st AND b.en GROUP BY b.batch
""")
def put_records_batches(spark, sf_dir):
    """Requests over the documents of all shards in one order, of at most 50 000 bytes and 500 records."""
    rows = table(spark, sf_dir, "documents").select("doc_id", keys.entry_size(F.col("doc_id").cast("string"), F.coalesce("text", F.lit(""))).alias("size"))
    out = batching.greedy_batches(rows, None, ["doc_id"], "size", 50_000, keys.RECORDS_PER_REQUEST)
    return batching.batch_summary(out, None, "size", "doc_id")


PRODUCED_ROWS = f"SELECT {shard_sql('partition_key')} AS shard, position AS ord, CAST(strlen(partition_key) + strlen(data) AS BIGINT) AS size FROM ({PRODUCED_SQL})"


@query(f"""
WITH RECURSIVE {greedy_sql(PRODUCED_ROWS.replace("strlen(data)", "strlen(data) + 8"), 20_000 - 20)}
SELECT b.shard, b.batch, count(*) AS records, CAST(sum(r.size) AS BIGINT) AS bytes, min(r.ord) AS first_position, max(r.size) > 20000 - 20 AS oversized
FROM batches b JOIN rows r ON r.shard = b.shard AND r.rn BETWEEN b.st AND b.en GROUP BY b.shard, b.batch
""")
def aggregated_batches(spark, sf_dir):
    """Aggregated records of at most 20 000 bytes."""
    rows = produced(spark, sf_dir)
    rows = routing.predict_shards(rows, routing.shard_map(spark, SHARDS), into="shard").withColumn("size", keys.aggregated_entry_size(F.col("partition_key"), F.col("data")))
    return batching.batch_summary(batching.aggregate_batches(rows.select("shard", "position", "size"), "shard", ["position", "size"], "size", 20_000), "shard", "size", "position")


FACTORS = {"shard-001": 0.5, "shard-002": 0.25}
FACTOR_SQL = " ".join(f"WHEN '{s}' THEN {f}" for s, f in FACTORS.items())
TIMED_SQL = f"""
SELECT *, CAST(greatest(floor((row_number() OVER w - 1) / factor / 1000), floor((sum(size) OVER w - size) / factor / 1048576)) AS BIGINT) AS release FROM (
  SELECT *, CASE shard WHEN 'x' THEN 1.0 {FACTOR_SQL} ELSE 1.0 END AS factor FROM (
    SELECT {shard_sql('partition_key')} AS shard, position, attempt, CAST(strlen(partition_key) + strlen(data) AS BIGINT) AS size, partition_key FROM (
      SELECT partition_key, data, position, 1 AS attempt FROM ({PRODUCED_SQL}) UNION ALL SELECT partition_key, data, position, 2 FROM ({PRODUCED_SQL}) WHERE l_returnflag = 'R')))
WINDOW w AS (PARTITION BY shard ORDER BY position, attempt, size, partition_key ROWS UNBOUNDED PRECEDING)
"""
LINE_SQL = f"SELECT 0 AS shard, row_number() OVER (ORDER BY release, position, attempt, size, partition_key) AS ord, size, shard AS of, position, release FROM ({TIMED_SQL})"


@query(f"""
WITH RECURSIVE line AS MATERIALIZED ({LINE_SQL}), {greedy_sql("SELECT shard, ord, size FROM line", 5_242_880, 500)}
SELECT b.batch, count(*) AS records, CAST(sum(r.size) AS BIGINT) AS bytes, min(l.position) AS first_position, max(l.release) AS release_second, count(DISTINCT l.of) AS shards
FROM batches b JOIN rows r ON r.rn BETWEEN b.st AND b.en JOIN line l ON l.ord = r.ord GROUP BY b.batch
""")
def produce_pipeline(spark, sf_dir):
    """New records and retries, routed, throttled by shard, and batched over all shards under the service's limits."""
    new = produced(spark, sf_dir)
    factors = spark.createDataFrame(list(FACTORS.items()), "predicted_shard string, factor double")
    planned = produce.plan(new, new.where("l_returnflag = 'R'"), routing.shard_map(spark, SHARDS), factors=factors)
    return planned.groupBy("batch").agg(F.count("*").alias("records"), F.sum("payload_bytes").alias("bytes"), F.min("position").alias("first_position"), F.max("release_second").alias("release_second"), F.countDistinct("predicted_shard").alias("shards"))


@query(f"""
SELECT {shard_sql('partition_key')} AS shard_id, partition_key, md5(data) AS data_md5, count(*) AS records, true AS within FROM ({PRODUCED_SQL}) GROUP BY ALL
""")
def produce_aggregated(spark, sf_dir):
    """The plan with aggregation: what its aggregated records hold, and whether these and their requests are within the limits."""
    new = produced(spark, sf_dir)
    planned = produce.plan(new, new.limit(0), routing.shard_map(spark, SHARDS), ProducerSettings(aggregate=True), max_record_bytes=20_000)
    fits = planned.groupBy("batch").agg(((F.sum("payload_bytes") <= keys.BYTES_PER_REQUEST) & (F.count("*") <= keys.RECORDS_PER_REQUEST)).alias("fits"))
    within = (F.octet_length("data") <= 20_000) & F.col("fits")
    sent = planned.join(fits, "batch").select("data", "partition_key", F.col("predicted_shard").alias("shard_id"), F.lit(None).cast("string").alias("explicit_hash_key"), within.alias("within"))
    return aggregation.deaggregate(sent).groupBy("shard_id", "partition_key", F.md5("data").alias("data_md5")).agg(F.count("*").alias("records"), F.min("within").alias("within"))


CODE_SQL = "CASE l_returnflag WHEN 'R' THEN CASE l_linestatus WHEN 'F' THEN 'InternalFailure' ELSE 'ProvisionedThroughputExceededException' END WHEN 'A' THEN 'ValidationException' END"


def _responses(spark, sf_dir, rows):
    flag = F.col("l_returnflag")
    code = F.when(flag == "R", F.when(F.col("l_linestatus") == "F", "InternalFailure").otherwise("ProvisionedThroughputExceededException")).when(flag == "A", "ValidationException")
    sent = produced(spark, sf_dir).select(F.col("l_orderkey").alias("batch"), F.col("l_linenumber").alias("pos"), "partition_key")
    answered = produced(spark, sf_dir).select(F.col("l_orderkey").alias("batch"), F.col("l_linenumber").alias("pos"), code.alias("error_code"))
    # a response stands at the position of its request; positions are made unique; one sort of bounded partitions serves both this and the join
    parts = produce.parts_for(spark, rows)
    first = lambda df, c: df.repartition(parts, "batch", "pos").groupBy("batch", "pos").agg(F.min(c).alias(c))
    return produce.split_responses(first(sent, "partition_key"), first(answered, "error_code"))


RESPONSES_SQL = f"""
SELECT batch, pos, partition_key, error_code, CASE WHEN error_code IS NULL THEN 'ok' WHEN error_code IN ('ProvisionedThroughputExceededException', 'InternalFailure', 'ServiceUnavailable') THEN 'retry' ELSE 'failed' END AS outcome
FROM (SELECT l_orderkey AS batch, l_linenumber AS pos, min(CAST(l_orderkey AS VARCHAR)) AS partition_key, min({CODE_SQL}) AS error_code FROM lineitem GROUP BY ALL)
"""


@query(RESPONSES_SQL)
def put_response_split(spark, sf_dir):
    """Entries of responses: done, to be retried or failed."""
    return _responses(spark, sf_dir, table(spark, sf_dir, "lineitem").count()).select("batch", "pos", "partition_key", "error_code", "outcome")


@query(f"""
SELECT batch AS chunk_id, count(*) AS entries, CASE WHEN bool_or(outcome = 'failed') THEN 'failed' WHEN bool_and(outcome = 'ok') THEN 'complete' ELSE 'pending' END AS state FROM ({RESPONSES_SQL}) GROUP BY batch
""")
def chunk_completion(spark, sf_dir):
    """State of produced chunks."""
    rows = table(spark, sf_dir, "lineitem").count()
    return produce.chunk_completion(_responses(spark, sf_dir, rows).withColumnRenamed("batch", "chunk_id"), rows=rows)


@query("""
SELECT l_orderkey, l_linenumber, name, status, cause, coalesce(name IN ('KmsThrottlingException', 'ProvisionedThroughputExceededException', 'LimitExceededException'), false) AS throttling,
  coalesce(status // 100 <> 4, false) OR coalesce(name IN ('ReadTimeoutException', 'IOException', 'ResourceInUseException'), false)
  OR coalesce(name = 'SdkException' AND cause IN ('ReadTimeoutException', 'IOException', 'ResourceInUseException'), false) AS recoverable
FROM (SELECT l_orderkey, l_linenumber, CASE l_orderkey % 6 WHEN 0 THEN 'SdkException' WHEN 1 THEN 'IOException' WHEN 2 THEN 'LimitExceededException' WHEN 3 THEN 'KmsThrottlingException' WHEN 4 THEN 'ServiceException' END AS name,
  CASE WHEN l_orderkey % 6 = 4 THEN 400 + (l_linenumber % 3) * 50 END AS status, CASE WHEN l_linenumber % 2 = 0 THEN 'ReadTimeoutException' END AS cause FROM lineitem)
""")
def error_classification(spark, sf_dir):
    """Which failures throttle and which are worth another try."""
    k, n = F.col("l_orderkey"), F.col("l_linenumber")
    name = F.when(k % 6 == 0, "SdkException").when(k % 6 == 1, "IOException").when(k % 6 == 2, "LimitExceededException").when(k % 6 == 3, "KmsThrottlingException").when(k % 6 == 4, "ServiceException")
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", name.alias("name"), F.when(k % 6 == 4, 400 + (n % 3) * 50).alias("status"), F.when(n % 2 == 0, "ReadTimeoutException").alias("cause"))
    return rows.select("*", errors.is_throttling(F.col("name")).alias("throttling"), F.coalesce(errors.is_recoverable(F.col("name"), F.col("status"), F.col("cause")), F.lit(False)).alias("recoverable"))


@query(f"""
SELECT shard_id, position, greatest((position - 1) // 100, CAST(before AS BIGINT) // 5000) AS release_second FROM (
  SELECT shard_id, position, coalesce(sum(strlen(partition_key) + strlen(data)) OVER (PARTITION BY shard_id ORDER BY position ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM ({SHARDED_SQL}))
""")
def throttle_shape(spark, sf_dir):
    """The second in which each record leaves, at 100 records and 5 000 bytes a second."""
    sized = sharded(spark, sf_dir).withColumn("size", keys.entry_size(F.col("partition_key"), F.col("data")))
    return throttle.release_seconds(sized, "shard_id", ["position"], "size", 100, 5_000).select("shard_id", "position", "release_second")


@query(f"""
WITH s AS (SELECT shard_id, event_id, strlen(partition_key) + strlen(data) AS size, epoch_us(ts) / 1000000.0 AS came FROM ({SHARDED_SQL})),
d AS (SELECT *, sum(size) OVER w / {{rate}} AS spent FROM s WINDOW w AS (PARTITION BY shard_id ORDER BY came, event_id ROWS UNBOUNDED PRECEDING)),
f AS (SELECT *, spent + max(came - (spent - size / {{rate}})) OVER (PARTITION BY shard_id ORDER BY came, event_id ROWS UNBOUNDED PRECEDING) AS full_at FROM d),
b AS (SELECT *, lag(full_at) OVER (PARTITION BY shard_id ORDER BY came, event_id) AS before FROM f)
SELECT shard_id, event_id, CAST(round((greatest(came, coalesce(before + (size - {{room}}) / {{rate}}, came)) - came) * 1000) AS BIGINT) AS waits_ms FROM b
""".format(rate="0.02", room="400.0"))
def token_bucket_release(spark, sf_dir):
    """How long each record waits at 0.02 bytes a second and a burst of 400 bytes: idle gaps of the stream fill the bucket again."""
    sized = sharded(spark, sf_dir).withColumn("size", keys.entry_size(F.col("partition_key"), F.col("data"))).withColumn("at", F.unix_micros(F.col("ts").cast("timestamp")) / 1_000_000)
    out = throttle.release_times(sized.select("shard_id", "event_id", "at", "size"), "shard_id", ["at", "event_id"], "at", "size", None, (0.02, 400.0))
    return out.select("shard_id", "event_id", F.round((F.col("release_time") - F.col("at")) * 1000).cast("bigint").alias("waits_ms"))


@query(f"""
WITH RECURSIVE counts AS MATERIALIZED (SELECT shard_id, (position - 1) // 50 AS period, count(*) FILTER (event_type <> 'error') AS ok, count(*) FILTER (event_type = 'error') AS bad FROM ({SHARDED_SQL}) GROUP BY ALL),
f(shard_id, period, factor) AS (
  SELECT shard_id, CAST(-1 AS BIGINT), CAST(1.0 AS DOUBLE) FROM (SELECT DISTINCT shard_id FROM counts)
  UNION ALL SELECT c.shard_id, c.period, least(CAST(1.0 AS DOUBLE), f.factor * (CAST(c.ok AS DOUBLE) / (c.ok + c.bad)) + CAST(0.05 AS DOUBLE)) FROM f JOIN counts c ON c.shard_id = f.shard_id AND c.period = f.period + 1)
SELECT shard_id, period, round(factor, 9) AS factor FROM f WHERE period >= 0
""")
def throttle_factor(spark, sf_dir):
    """Throughput factor after each period of 50 records."""
    bad = F.col("event_type") == "error"
    counts = sharded(spark, sf_dir).groupBy("shard_id", F.floor((F.col("position") - 1) / 50).cast("bigint").alias("period")).agg(F.count(F.when(~bad, 1)).alias("successes"), F.count(F.when(bad, 1)).alias("failures"))
    out = throttle.throughput_factors(counts)
    return out.select("shard_id", "period", F.round("factor", 9).alias("factor"))


ATTEMPTS_SQL = f"""
SELECT l_orderkey // 400 AS period, CASE WHEN l_returnflag = 'R' THEN 0 ELSE 1 + l_linenumber % 4 END AS published, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS failed,
  1 + l_linenumber % 3 AS attempts, CAST(l_quantity AS BIGINT) AS latency_ms, strlen(data) AS payload_bytes, strlen(partition_key) AS record_bytes, l_linestatus = 'F' AS shard_mismatch FROM ({PRODUCED_SQL})
"""


def _attempts(spark, sf_dir):
    failed = F.col("l_returnflag") == "R"
    return produced(spark, sf_dir).select(
        F.expr("l_orderkey div 400").alias("period"), F.when(failed, 0).otherwise(1 + F.col("l_linenumber") % 4).alias("published"), failed.cast("int").alias("failed"),
        (1 + F.col("l_linenumber") % 3).alias("attempts"), F.col("l_quantity").cast("bigint").alias("latency_ms"), F.octet_length("data").alias("payload_bytes"), F.octet_length("partition_key").alias("record_bytes"), (F.col("l_linestatus") == "F").alias("shard_mismatch"),
    )


METRICS_SQL = """
SELECT {key} CAST(sum(published) AS BIGINT) AS published, CAST(sum(failed) AS BIGINT) AS failures, count(*) AS calls,
  CASE WHEN sum(published) + sum(failed) > 0 THEN CAST(sum(published) AS DOUBLE) / (sum(published) + sum(failed)) ELSE 1.0 END AS success_rate,
  CAST(sum(published) AS DOUBLE) * 1000.0 / 30000 AS throughput, CAST(count(*) AS DOUBLE) * 1000.0 / 30000 AS mean_calls,
  CAST(sum(CASE WHEN published > 0 THEN latency_ms * published END) AS DOUBLE) / CAST(sum(published) AS DOUBLE) AS mean_latency,
  quantile_disc(CASE WHEN published > 0 THEN latency_ms END, 0.95) AS latency_p95, min(CASE WHEN published > 0 THEN latency_ms END) AS latency_min,
  CAST(sum(CASE WHEN published > 0 AND attempts = 2 THEN published ELSE 0 END) AS BIGINT) AS second_attempts, max(CASE WHEN published > 0 THEN attempts END) AS max_attempts,
  CAST(sum(payload_bytes) AS DOUBLE) / count(*) AS mean_payload, CAST(sum(record_bytes) AS DOUBLE) / count(*) AS mean_record, CAST(sum(CAST(shard_mismatch AS INT)) AS BIGINT) AS prediction_errors
FROM ({rows}) {group}
"""


@query(METRICS_SQL.format(key="period,", rows=ATTEMPTS_SQL, group="GROUP BY period"))
def producer_metrics(spark, sf_dir):
    """Metrics of produce attempts, by interval."""
    return metrics.producer_metrics(_attempts(spark, sf_dir), ["period"], 30_000)


@query(METRICS_SQL.format(key="period // 4 AS period,", rows=ATTEMPTS_SQL, group="GROUP BY period // 4"))
def producer_metrics_merge(spark, sf_dir):
    """Metrics rows of intervals, four merged into one."""
    parts = metrics.partial_metrics(_attempts(spark, sf_dir), ["period"])
    merged = metrics.merge_metrics(parts.withColumn("period", F.expr("period div 4")), ["period"])
    return metrics.finished_metrics(merged, ["period"], 30_000)


@query(f"SELECT attempts, latency_ms, CAST(sum(published) AS BIGINT) AS n FROM ({ATTEMPTS_SQL}) WHERE published > 0 GROUP BY attempts, latency_ms")
def latency_histogram(spark, sf_dir):
    """Occurrences of each latency, by attempts."""
    return metrics.histogram(_attempts(spark, sf_dir).where("published > 0"), ["attempts"], "latency_ms", "published")


@query("""
WITH v AS (SELECT l_returnflag, CAST(round(l_extendedprice * 100) AS BIGINT) AS value FROM lineitem),
b AS (SELECT l_returnflag, (value >> greatest(length(bin(value)) - 8, 0)) << greatest(length(bin(value)) - 8, 0) AS bucket FROM v),
h AS (SELECT l_returnflag, bucket, count(*) AS n FROM b GROUP BY ALL),
c AS (SELECT *, sum(n) OVER (PARTITION BY l_returnflag ORDER BY bucket) AS seen, sum(n) OVER (PARTITION BY l_returnflag) AS total FROM h)
SELECT l_returnflag, CAST(any_value(total) AS BIGINT) AS n, min(bucket) FILTER (seen >= ceil(total * CAST(0.5 AS DOUBLE))) AS p50, min(bucket) FILTER (seen >= ceil(total * CAST(0.95 AS DOUBLE))) AS p95, min(bucket) FILTER (seen >= ceil(total * CAST(0.999 AS DOUBLE))) AS p999 FROM c GROUP BY l_returnflag
""")
def digit_histogram_merge(spark, sf_dir):
    """Histograms of two significant digits of prices for each return flag and line status, merged into one for each flag, and their quantiles."""
    rows = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_linestatus", F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("value"))
    parts = metrics.digit_histogram(rows, ["l_returnflag", "l_linestatus"], "value", 2)
    return metrics.histogram_quantiles(metrics.merge_histograms(parts, ["l_returnflag"], "bucket"), ["l_returnflag"], {"p50": 0.5, "p95": 0.95, "p999": 0.999})


@query(f"""
SELECT shard_id, partition_key, md5(data) AS data_md5, count(*) AS records FROM ({SHARDED_SQL}) GROUP BY ALL
""")
def produce_roundtrip(spark, sf_dir):
    """Records written to a shard log and read back: each is there once, in the shard of its key."""
    path = f"{shared_root(spark)}/log-{uuid.uuid4().hex}"
    consume.produce(stream(spark, sf_dir).select("partition_key", "data"), path, SHARDS)
    back = checkpoints.without_redelivery(consume.read_log(spark, path))
    return back.groupBy("shard_id", "partition_key", F.md5("data").alias("data_md5")).agg(F.count("*").alias("records"))


@query("""
SELECT doc_id, text, strlen(text) AS bytes, replace(regexp_replace(regexp_replace(regexp_replace(text, '[\\x{10000}-\\x{10FFFF}]', repeat(chr(1), 4), 'g'), '[\\x{800}-\\x{FFFF}]', repeat(chr(1), 3), 'g'), '[\\x{80}-\\x{7FF}]', repeat(chr(1), 2), 'g'), chr(1), chr(65533)) AS as_ascii FROM documents
""")
def serde_string(spark, sf_dir):
    """Text written and read back as UTF-8; and as US-ASCII, where each byte of a foreign character is replaced."""
    data = serde.string.serialize(F.col("text"))
    return table(spark, sf_dir, "documents").select("doc_id", serde.string.deserialize(data).alias("text"), F.octet_length(data).cast("bigint").alias("bytes"), serde.ascii_string.deserialize(data).alias("as_ascii"))


@query("""
SELECT event_id, coalesce(TRY_CAST(CASE WHEN event_id % 2 = 0 THEN CAST(event_id AS VARCHAR) ELSE 'x' || event_id END AS BIGINT), strlen(coalesce(props, ''))) AS value FROM events
""")
def serde_or_else(spark, sf_dir):
    """Integers, or else the length of the record."""
    size = serde.Serde(lambda v: v, lambda b: F.octet_length(b).cast("bigint"))
    digits = F.when(F.col("event_id") % 2 == 0, F.col("event_id").cast("string")).otherwise(F.concat(F.lit("x"), F.col("event_id").cast("string")))
    rows = stream(spark, sf_dir).select("event_id", "data", serde.string.serialize(digits).alias("number"))
    read = F.coalesce(serde.integer.deserialize(F.col("number")), size.deserialize(F.col("data")))
    return rows.select("event_id", read.alias("value"))


@query("""
SELECT event_id, TRY_CAST(s AS DOUBLE) AS value, CASE WHEN TRY_CAST(s AS DOUBLE) IS NULL THEN 'unreadable' END AS error FROM (
  SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 'no number' ELSE CAST(event_id AS VARCHAR) || '.5' END AS s FROM events)
""")
def serde_as_try(spark, sf_dir):
    """Numbers read with their error beside them."""
    text = F.when(F.col("event_id") % 3 == 0, "no number").otherwise(F.concat(F.col("event_id").cast("string"), F.lit(".5")))
    read = serde.number.as_try().deserialize(text.cast("binary"))
    return stream(spark, sf_dir).select("event_id", read["value"].alias("value"), read["error"].alias("error"))


@query("""
SELECT attempt, CAST(least(1000.0, 100.0 * pow(2.0, attempt)) AS BIGINT) AS delay_ms, CAST(floor(least(30000.0, 500.0 * pow(1.5, attempt))) AS BIGINT) AS slow_ms FROM (SELECT unnest(range(0, 11)) AS attempt)
""")
def backoff_schedule(spark, sf_dir):
    """Delays of eleven attempts."""
    n = F.col("id")
    return spark.range(11).select(n.alias("attempt"), positions.backoff(n, 100, 1000).alias("delay_ms"), F.floor(F.least(F.lit(30000.0), F.lit(500.0) * F.pow(F.lit(1.5), n.cast("double")))).alias("slow_ms"))


@query("""
SELECT identifier, CASE WHEN starts_with(identifier, 'arn:aws:kinesis') THEN 'arn' ELSE 'name' END AS kind FROM (
  SELECT CASE WHEN s_suppkey % 2 = 0 THEN 'arn:aws:kinesis:eu-west-1:1:stream/' || s_name ELSE s_name END AS identifier FROM supplier)
""")
def stream_identifier(spark, sf_dir):
    """Names and ARNs of streams."""
    name = F.when(F.col("s_suppkey") % 2 == 0, F.concat(F.lit(keys.ARN_PREFIX + ":eu-west-1:1:stream/"), "s_name")).otherwise(F.col("s_name"))
    return table(spark, sf_dir, "supplier").select(name.alias("identifier")).withColumn("kind", keys.stream_kind(F.col("identifier")))
