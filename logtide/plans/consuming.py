"""Queries of the read path: scans, positions, checkpoints, pages, redelivery."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from logtide.functions import positions
from logtide.operators import batching, checkpoints
from logtide.plans.registry import query
from logtide.plans.relations import SHARDED_SQL, SHARDS, sharded, stream, table
from logtide.scratch import shared_root
from logtide.settings import PollingSettings
from logtide.sources import shardlog
from logtide.streaming import consume, once, staging


def _written(spark, sf_dir) -> str:
    path = f"{shared_root(spark)}/log-{uuid.uuid4().hex}"
    records = stream(spark, sf_dir).select("partition_key", "data", F.col("ts").cast("timestamp").alias("approximate_arrival_timestamp"))
    consume.produce(records, path, SHARDS)
    return path


@query(f"""
SELECT shard_id, partition_key, count(*) AS records, min(ts) AS first_ts, max(ts) AS last_ts FROM ({SHARDED_SQL}) GROUP BY ALL
""")
def scan_stream_records(spark, sf_dir):
    """A shard log read as a stream until its end."""
    path, work = _written(spark, sf_dir), f"{shared_root(spark)}/stream-{uuid.uuid4().hex}"
    out = consume.stream_log(spark, path).select("shard_id", "partition_key", "approximate_arrival_timestamp")
    out.writeStream.format("parquet").option("path", f"{work}/out").option("checkpointLocation", f"{work}/state").trigger(availableNow=True).start().awaitTermination()
    back = spark.read.schema(out.schema).parquet(f"{work}/out")
    at = F.col("approximate_arrival_timestamp").cast("timestamp_ntz")
    return back.groupBy("shard_id", "partition_key").agg(F.count("*").alias("records"), F.min(at).alias("first_ts"), F.max(at).alias("last_ts"))


@query(f"""
SELECT shard_id, partition_key, count(*) AS records, min(ts) AS first_ts FROM ({SHARDED_SQL})
WHERE ts >= (SELECT min(ts) + (max(ts) - min(ts)) * 3 / 4 FROM events) AND shard_id <> 'shard-002' GROUP BY ALL
""")
def scan_pruned(spark, sf_dir):
    """Records of three shards from an instant on, of a log written quarter by quarter: files are chosen by shard and arrival time."""
    path = f"{shared_root(spark)}/log-{uuid.uuid4().hex}"
    records = stream(spark, sf_dir).select("partition_key", "data", F.col("ts").cast("timestamp").alias("approximate_arrival_timestamp"))
    at = F.unix_micros("approximate_arrival_timestamp")
    low, high = records.agg(F.min(at), F.max(at)).first()
    edges = [low + (high - low) * n // 4 for n in range(4)]
    for n, edge in enumerate(edges):
        consume.produce(records.where((at >= edge) & (at < edges[n + 1]) if n < 3 else at >= edge), path, SHARDS)
    since = F.timestamp_micros(F.lit(low + -(-(high - low) * 3 // 4)))
    wanted = (F.col("approximate_arrival_timestamp") >= since) & F.col("shard_id").isin("shard-000", "shard-001", "shard-003")
    found = consume.read_log(spark, path, wanted, ["shard_id", "approximate_arrival_timestamp", "partition_key"])
    return found.groupBy("shard_id", "partition_key").agg(F.count("*").alias("records"), F.min("approximate_arrival_timestamp").cast("timestamp_ntz").alias("first_ts"))


@query(f"SELECT shard_id, count(*) AS records, count(DISTINCT partition_key) AS keys FROM ({SHARDED_SQL}) GROUP BY shard_id")
def consume_with(spark, sf_dir):
    """A function run for each micro-batch of a shard log; its results are kept by batch, so that a repeated batch changes nothing."""
    path, work = _written(spark, sf_dir), f"{shared_root(spark)}/consume-{uuid.uuid4().hex}"

    def process(batch, number):
        batch.groupBy("shard_id", "partition_key").agg(F.count("*").alias("n")).write.mode("overwrite").parquet(f"{work}/out/batch={number}")

    consume.consume_with(consume.stream_log(spark, path), process, f"{work}/state").awaitTermination()
    back = spark.read.parquet(f"{work}/out")
    return back.groupBy("shard_id").agg(F.sum("n").cast("bigint").alias("records"), F.countDistinct("partition_key").alias("keys"))


@query(f"""
SELECT shard_id, (position - 1) // 10 AS page, count(*) AS records, max(position) AS last_position, max(total) - max(position) AS behind
FROM (SELECT *, count(*) OVER (PARTITION BY shard_id) AS total FROM ({SHARDED_SQL})) GROUP BY ALL
""")
def poll_pages(spark, sf_dir):
    """Pages of ten records, and how many are left behind each."""
    return checkpoints.pages(sharded(spark, sf_dir), "shard_id", "position", 10)


@query(f"""
SELECT shard_id, page, CASE WHEN behind <> 0 THEN 0 ELSE 1000 END AS delay_ms FROM (
  SELECT shard_id, (position - 1) // 10 AS page, max(total) - max(position) AS behind FROM (SELECT *, count(*) OVER (PARTITION BY shard_id) AS total FROM ({SHARDED_SQL})) GROUP BY ALL)
""")
def poll_schedule(spark, sf_dir):
    """Delay after each page: none until the reader has caught up."""
    out = checkpoints.pages(sharded(spark, sf_dir), "shard_id", "position", 10)
    return out.select("shard_id", "page", positions.poll_delay(F.col("behind"), 1000).alias("delay_ms"))


@query(f"""
SELECT shard_id, position, sub, lpad(CAST(seq AS VARCHAR), 40, '0') AS sequence_number FROM (
  SELECT shard_id, position, CASE WHEN seq % 2 = 0 THEN (position - 1) % 4 END AS sub, seq FROM (SELECT *, (position - 1) // 4 AS seq FROM ({SHARDED_SQL})))
WHERE shard_id NOT IN ('shard-000', 'shard-001') OR shard_id = 'shard-000' AND CASE WHEN sub IS NOT NULL THEN seq > 6 OR seq = 6 AND sub > 1 ELSE seq > 6 END
   OR shard_id = 'shard-001'
""")
def resume_after_checkpoint(spark, sf_dir):
    """Records after each shard's checkpoint: a position inside an aggregate, a special one, none."""
    records = sharded(spark, sf_dir)
    seq = F.floor((F.col("position") - 1) / 4).cast("bigint")
    records = records.select("shard_id", "position", positions.padded(seq).alias("sequence_number"), F.when(seq % 2 == 0, (F.col("position") - 1) % 4).alias("sub_sequence_number"))
    held = spark.createDataFrame([("shard-000", None, "6".zfill(40), 1), ("shard-001", "TRIM_HORIZON", None, None)], "shard_id string, special string, seq string, sub_seq bigint")
    return checkpoints.resume(records, held).select("shard_id", "position", F.col("sub_sequence_number").alias("sub"), "sequence_number")


@query("""
SELECT lease, stored, CASE WHEN stored IN ('TRIM_HORIZON', 'LATEST') THEN stored WHEN stored = 'AT_TIMESTAMP' THEN CASE WHEN lease % 2 = 0 THEN stored ELSE 'invalid' END WHEN stored = 'SHARD_END' THEN 'invalid'
  WHEN stored IS NULL THEN initial ELSE 'AT_SEQUENCE_NUMBER' END AS iterator, CASE WHEN stored NOT IN ('TRIM_HORIZON', 'LATEST', 'AT_TIMESTAMP', 'SHARD_END') THEN stored END AS seq
FROM (SELECT c_custkey AS lease, CASE c_custkey % 6 WHEN 0 THEN 'SHARD_END' WHEN 1 THEN 'TRIM_HORIZON' WHEN 2 THEN 'LATEST' WHEN 3 THEN 'AT_TIMESTAMP' WHEN 4 THEN CAST(c_custkey AS VARCHAR) END AS stored,
  CASE WHEN c_custkey % 2 = 0 THEN 'AT_TIMESTAMP' ELSE 'LATEST' END AS initial FROM customer)
""")
def checkpoint_to_start(spark, sf_dir):
    """Where reading resumes for each stored checkpoint and initial position."""
    k = F.col("c_custkey")
    stored = F.when(k % 6 == 0, "SHARD_END").when(k % 6 == 1, "TRIM_HORIZON").when(k % 6 == 2, "LATEST").when(k % 6 == 3, "AT_TIMESTAMP").when(k % 6 == 4, k.cast("string"))
    initial = F.when(k % 2 == 0, "AT_TIMESTAMP").otherwise("LATEST")
    rows = table(spark, sf_dir, "customer").select(k.alias("lease"), stored.alias("stored"), initial.alias("initial"))
    parsed = positions.parse_checkpoint(F.col("stored"), F.lit(None).cast("bigint"))
    start = positions.start_position(parsed, F.col("initial"), F.lit("2024-01-01").cast("timestamp"))
    return rows.select("lease", "stored", start["iterator"].alias("iterator"), start["seq"].alias("seq"))


@query("""
SELECT stored, CASE WHEN special THEN stored END AS special, CASE WHEN NOT special THEN stored END AS seq, CASE WHEN NOT special THEN sub END AS sub_seq, stored AS printed FROM (
  SELECT stored, sub, stored IN ('SHARD_END', 'TRIM_HORIZON', 'LATEST', 'AT_TIMESTAMP') AS special FROM (
    SELECT CASE c_custkey % 5 WHEN 0 THEN 'SHARD_END' WHEN 1 THEN 'TRIM_HORIZON' WHEN 2 THEN 'LATEST' WHEN 3 THEN 'AT_TIMESTAMP' ELSE CAST(c_custkey AS VARCHAR) END AS stored, CAST(c_custkey % 3 AS BIGINT) AS sub FROM customer))
""")
def parse_checkpoint(spark, sf_dir):
    """Stored checkpoints, parsed and printed again."""
    k = F.col("c_custkey")
    stored = F.when(k % 5 == 0, "SHARD_END").when(k % 5 == 1, "TRIM_HORIZON").when(k % 5 == 2, "LATEST").when(k % 5 == 3, "AT_TIMESTAMP").otherwise(k.cast("string"))
    rows = table(spark, sf_dir, "customer").select(stored.alias("stored"), (k % 3).cast("bigint").alias("sub"))
    parsed = rows.withColumn("c", positions.parse_checkpoint(F.col("stored"), F.col("sub")))
    return parsed.select("stored", "c.special", "c.seq", "c.sub_seq", positions.print_checkpoint(F.col("c")).alias("printed"))


@query("SELECT event_id, ts FROM events WHERE ts >= (SELECT quantile_disc(ts, 0.5) FROM events)")
def initial_position_at_timestamp(spark, sf_dir):
    """Records from the instant at which half of them have arrived."""
    events = table(spark, sf_dir, "events").select("event_id", "ts")
    half = events.selectExpr("percentile_disc(0.5) within group (order by unix_micros(ts::timestamp)) as at")
    return events.join(F.broadcast(half), F.unix_micros(F.col("ts").cast("timestamp")) >= F.col("at")).select("event_id", "ts")


@query("""
SELECT 'shard' || (o_custkey % 3) AS shard_id, row_number() OVER (PARTITION BY o_custkey % 3 ORDER BY o_orderkey) - 1 AS sequence_number,
  'shard' || (o_custkey % 3) || '_' || (row_number() OVER (PARTITION BY o_custkey % 3 ORDER BY o_orderkey) - 1) AS partition_key, o_orderstatus AS data FROM orders
""")
def fake_shards(spark, sf_dir):
    """Lists of values as shards: numbered from 0, with keys made of shard and number."""
    rows = table(spark, sf_dir, "orders").select(F.concat(F.lit("shard"), (F.col("o_custkey") % 3).cast("string")).alias("shard_id"), "o_orderkey", F.col("o_orderstatus").alias("data"))
    nr = checkpoints.numbered(rows, "shard_id", ["o_orderkey"]).withColumn("sequence_number", F.col("position") - 1)
    return nr.select("shard_id", "sequence_number", F.concat_ws("_", "shard_id", F.col("sequence_number").cast("string")).alias("partition_key"), "data")


@query(f"SELECT shard_id, (position - 1) // 200 AS checkpoint_nr, max(position) AS last_position, count(*) AS records FROM ({SHARDED_SQL}) GROUP BY ALL")
def checkpoint_batched(spark, sf_dir):
    """A checkpoint for each 200 records."""
    return checkpoints.batched(sharded(spark, sf_dir), "shard_id", "position", 200)


@query(f"""
WITH RECURSIVE r AS MATERIALIZED (SELECT shard_id, row_number() OVER (PARTITION BY shard_id ORDER BY ts, event_id) AS rn, epoch(ts) AS came FROM ({SHARDED_SQL})),
c AS MATERIALIZED (SELECT shard_id, rn, came, least(rn + 40, rn + count(*) OVER (PARTITION BY shard_id ORDER BY came RANGE BETWEEN CURRENT ROW AND CAST(3599.9999995 AS DOUBLE) FOLLOWING) - (rn - min(rn) OVER (PARTITION BY shard_id, came))) AS nxt FROM r),
hops(shard_id, nr, st) AS (SELECT DISTINCT shard_id, CAST(0 AS BIGINT), CAST(1 AS BIGINT) FROM r UNION ALL SELECT h.shard_id, h.nr + 1, c.nxt FROM hops h JOIN c ON c.shard_id = h.shard_id AND c.rn = h.st JOIN c f ON f.shard_id = h.shard_id AND f.rn = c.nxt)
SELECT h.shard_id, h.nr AS checkpoint_nr, c.nxt - h.st AS records, CAST(floor(f.came) AS BIGINT) AS first_second FROM hops h JOIN c ON c.shard_id = h.shard_id AND c.rn = h.st JOIN r f ON f.shard_id = h.shard_id AND f.rn = h.st
""")
def checkpoint_batched_or_timed(spark, sf_dir):
    """A checkpoint for 40 records, or before a record that comes an hour or more after the first one that it would cover."""
    rows = sharded(spark, sf_dir).select("shard_id", "event_id", (F.unix_micros(F.col("ts").cast("timestamp")) / 1_000_000).alias("at"))
    out = checkpoints.batched_or_timed(rows, "shard_id", ["at", "event_id"], "at", 40, 3600.0)
    return out.groupBy("shard_id", "checkpoint_nr").agg(F.count("*").alias("records"), F.floor(F.min("at")).cast("bigint").alias("first_second"))


@query(f"SELECT shard_id, lpad(CAST(max(position) AS VARCHAR), 40, '0') AS seq, CAST(0 AS BIGINT) AS sub_seq, count(*) AS records FROM ({SHARDED_SQL}) GROUP BY shard_id")
def last_checkpoint_per_shard(spark, sf_dir):
    """The last position of each shard."""
    records = sharded(spark, sf_dir).select("shard_id", positions.padded(F.col("position")).alias("sequence_number"), F.lit(None).cast("bigint").alias("sub_sequence_number"))
    return checkpoints.last_staged(records)


@query(f"""
WITH RECURSIVE r AS MATERIALIZED (SELECT shard_id, position, lag(position) OVER (PARTITION BY shard_id, partition_key ORDER BY position) AS prev FROM ({SHARDED_SQL})),
total AS (SELECT shard_id, max(position) AS n FROM r GROUP BY shard_id),
seg(shard_id, segment, st) AS (SELECT shard_id, CAST(0 AS BIGINT), CAST(1 AS BIGINT) FROM total
  UNION ALL SELECT s.shard_id, s.segment + 1, x.nxt FROM seg s JOIN total t ON t.shard_id = s.shard_id,
    LATERAL (SELECT least(s.st + 20, coalesce(min(r.position), s.st + 20)) AS nxt FROM r WHERE r.shard_id = s.shard_id AND r.position > s.st AND r.position < s.st + 20 AND r.prev >= s.st) x WHERE x.nxt <= t.n)
SELECT s.shard_id, s.segment, s.st AS first_position, coalesce(lead(s.st) OVER (PARTITION BY s.shard_id ORDER BY s.segment) - 1, t.n) AS last_position FROM seg s JOIN total t ON t.shard_id = s.shard_id
""")
def partitioned_checkpoints(spark, sf_dir):
    """Segments between checkpoints: no key twice, 20 records at most."""
    out = batching.locked_segments(sharded(spark, sf_dir).select("shard_id", "partition_key", "position"), "shard_id", "partition_key", ["position"], 20)
    return out.groupBy("shard_id", "segment").agg(F.min("position").alias("first_position"), F.max("position").alias("last_position"))


@query("""
WITH RECURSIVE e AS MATERIALIZED (SELECT CAST(user_id AS VARCHAR) AS shard_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS rn, CASE WHEN event_id % 7 IN (0, 1, 3) THEN event_id END AS position,
  CASE event_id % 7 WHEN 0 THEN 'stage' WHEN 3 THEN 'stage' WHEN 1 THEN 'seen' WHEN 2 THEN 'checkpoint' WHEN 4 THEN 'refused' WHEN 5 THEN 'end' ELSE 'release' END AS kind FROM events),
f(shard_id, rn, event_id, kind, staged, last, greatest, ended, written) AS (
  SELECT DISTINCT shard_id, CAST(0 AS BIGINT), CAST(NULL AS BIGINT), CAST(NULL AS VARCHAR), CAST(NULL AS BIGINT), CAST(NULL AS BIGINT), CAST(NULL AS BIGINT), false, CAST(NULL AS VARCHAR) FROM e
  UNION ALL SELECT e.shard_id, e.rn, e.event_id, e.kind,
    CASE WHEN e.kind = 'stage' THEN e.position WHEN e.kind IN ('checkpoint', 'release') THEN NULL ELSE f.staged END,
    CASE WHEN e.kind IN ('checkpoint', 'release') AND f.staged IS NOT NULL THEN CASE WHEN NOT (f.ended AND f.greatest IS NOT DISTINCT FROM f.staged) THEN f.staged END ELSE f.last END,
    CASE WHEN e.kind = 'seen' THEN e.position ELSE f.greatest END, f.ended OR e.kind = 'end',
    CASE WHEN e.kind NOT IN ('checkpoint', 'release') THEN NULL
         WHEN f.staged IS NOT NULL THEN CASE WHEN f.ended AND f.greatest IS NOT DISTINCT FROM f.staged THEN 'SHARD_END' ELSE CAST(f.staged AS VARCHAR) END
         WHEN e.kind = 'release' THEN CASE WHEN f.ended AND (f.greatest IS NULL AND f.last IS NULL OR coalesce(f.last = f.greatest, false)) THEN 'SHARD_END' ELSE 'RELEASE' END END
  FROM f JOIN e ON e.shard_id = f.shard_id AND e.rn = f.rn + 1)
SELECT shard_id, event_id, kind, written FROM f WHERE written IS NOT NULL
""")
def checkpoint_staging(spark, sf_dir):
    """Checkpoints that the staging rules write, for a stream of stage, seen, end, flush and release events by user."""
    nr = F.col("event_id") % 7
    kind = F.when(nr.isin(0, 3), "stage").when(nr == 1, "seen").when(nr == 2, "checkpoint").when(nr == 4, "refused").when(nr == 5, "end").otherwise("release")
    events = stream(spark, sf_dir).select(F.col("partition_key").alias("shard_id"), "event_id", kind.alias("kind"), F.when(nr.isin(0, 1, 3), F.col("event_id")).alias("position"))
    return staging.checkpoints(events, "shard_id", ["event_id"]).where("written is not null").select("shard_id", "event_id", "kind", "written")


@query("""
SELECT k, release, CASE WHEN staged = greatest AND ended THEN 'SHARD_END' WHEN staged IS NULL AND release AND ended AND (greatest IS NULL AND last IS NULL OR last = greatest) THEN 'SHARD_END'
  WHEN staged IS NOT NULL THEN 'POSITION' WHEN release THEN 'RELEASE' ELSE 'NOTHING' END AS written
FROM (SELECT c_custkey AS k, c_custkey % 2 = 0 AS release, c_custkey % 3 = 0 AS ended, CASE WHEN c_custkey % 5 < 3 THEN c_custkey % 5 END AS staged, CASE WHEN c_custkey % 7 < 4 THEN c_custkey % 7 END AS last, CASE WHEN c_custkey % 11 < 5 THEN c_custkey % 11 END AS greatest FROM customer)
""")
def shard_end_decision(spark, sf_dir):
    """What a flush writes, by what is staged, flushed, seen and ended."""
    k = F.col("c_custkey")
    part = lambda m, n: F.when(k % m < n, k % m)
    rows = table(spark, sf_dir, "customer").select(k.alias("k"), (k % 2 == 0).alias("release"), (k % 3 == 0).alias("ended"), part(5, 3).alias("staged"), part(7, 4).alias("last"), part(11, 5).alias("greatest"))
    written = positions.shard_end_checkpoint(F.col("staged"), F.col("greatest"), F.col("last"), F.col("ended"), F.col("release"))
    return rows.select("k", "release", written.alias("written"))


@query("""
SELECT k, n_children > 0 AND next_iterator IS NULL AS polling_end, n_children > 0 AS pushed_end FROM (
  SELECT c_custkey AS k, c_custkey % 3 AS n_children, CASE WHEN c_custkey % 2 = 0 THEN 'it' || c_custkey END AS next_iterator FROM customer)
""")
def end_of_shard(spark, sf_dir):
    """Which pages end their shard, polled and pushed."""
    k = F.col("c_custkey")
    children = F.when(k % 3 == 0, F.array().cast("array<string>")).when(k % 3 == 1, F.array(F.lit("a"))).otherwise(F.array(F.lit("a"), F.lit("b")))
    rows = table(spark, sf_dir, "customer").select(k.alias("k"), children.alias("children"), F.when(k % 2 == 0, F.concat(F.lit("it"), k.cast("string"))).alias("next_iterator"))
    return rows.select("k", positions.polling_end(F.col("children"), F.col("next_iterator")).alias("polling_end"), positions.pushed_end(F.col("children")).alias("pushed_end"))


@query(f"SELECT shard_id, position, partition_key FROM ({SHARDED_SQL})")
def dedupe_redelivery(spark, sf_dir):
    """Records of which every third is delivered twice, once each."""
    records = sharded(spark, sf_dir).select("shard_id", "position", "partition_key", positions.padded(F.col("position")).alias("sequence_number"), F.lit(0).cast("bigint").alias("sub_sequence_number"))
    twice = records.unionByName(records.where("position % 3 = 0"))
    return checkpoints.without_redelivery(twice).select("shard_id", "position", "partition_key")


@query(f"SELECT shard_id, position, partition_key FROM ({SHARDED_SQL})")
def dedupe_redelivery_stream(spark, sf_dir):
    """A stream of which two fifths come again after a restart, once each: the state is a position for each shard."""
    work = f"{shared_root(spark)}/once-{uuid.uuid4().hex}"
    records = sharded(spark, sf_dir).select("shard_id", "position", "partition_key", positions.padded(F.col("position")).alias("sequence_number"), F.lit(None).cast("bigint").alias("sub_sequence_number"))
    total = records.groupBy("shard_id").agg(F.max("position").alias("total"))
    placed = records.join(F.broadcast(total), "shard_id")  # a row for each shard
    for part in (F.col("position") <= 0.7 * F.col("total"), F.col("position") > 0.3 * F.col("total")):
        placed.where(part).drop("total").write.mode("append").parquet(f"{work}/in")
        out = once.deliver_once(spark.readStream.schema(records.schema).parquet(f"{work}/in"))
        out.writeStream.format("parquet").option("path", f"{work}/out").option("checkpointLocation", f"{work}/state").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(records.schema).parquet(f"{work}/out").select("shard_id", "position", "partition_key")


CHILD_SQL = "CASE WHEN {half} THEN CASE WHEN h < '80000000000000000000000000000000' THEN 'shard-000' ELSE 'shard-001' END WHEN h < '40000000000000000000000000000000' THEN 'shard-002' WHEN h < '80000000000000000000000000000000' THEN 'shard-003' ELSE 'shard-001' END"


@query(f"""
SELECT shard_id, count(*) AS records, count(DISTINCT h) AS keys, min(event_id % 2 = 0 AND shard_id IN ('shard-002', 'shard-003')) AS early FROM (
  SELECT {CHILD_SQL.format(half='event_id % 2 = 0')} AS shard_id, h, event_id FROM (SELECT md5(CAST(user_id AS VARCHAR)) AS h, event_id FROM events)) GROUP BY shard_id
""")
def reshard_consumption(spark, sf_dir):
    """Half of the events written to two shards, the first of which is then split; the rest written; all consumed by polls.

    ``early``: whether a child's records came in a poll with those of its parent, or before.
    """
    path, work = f"{shared_root(spark)}/log-{uuid.uuid4().hex}", f"{shared_root(spark)}/reshard-{uuid.uuid4().hex}"
    rows = stream(spark, sf_dir)
    half = lambda n: rows.where(F.col("event_id") % 2 == n).select("partition_key", "data")
    consume.produce(half(0), path, 2)
    shardlog.split(consume.qualified(spark, path), "shard-000")
    consume.produce(half(1), path)

    def process(batch, number):
        batch.groupBy("shard_id", "partition_key").agg(F.count("*").alias("n")).write.mode("overwrite").parquet(f"{work}/out/batch={number}")

    consume.drain(spark, path, process, f"{work}/state", PollingSettings(batch_size=100_000_000))
    back = spark.read.parquet(f"{work}/out")
    ended = back.where("shard_id = 'shard-000'").agg(F.max("batch")).first()[0]
    child = F.col("shard_id").isin("shard-002", "shard-003")
    return back.groupBy("shard_id").agg(F.sum("n").cast("bigint").alias("records"), F.countDistinct("partition_key").alias("keys"), F.min(child & (F.col("batch") <= ended)).alias("early"))
