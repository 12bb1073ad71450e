"""Queries of lease coordination, shard assignment and worker diagnostics."""

from __future__ import annotations

from pyspark.sql import functions as F

from logtide.operators import assignment, leases as ops, metrics, routing
from logtide.plans.registry import query
from logtide.plans.relations import LEASES_SQL, LINEAGE_LEASES_SQL, LINEAGE_SQL, NOW, leases, lineage, lineage_leases, table

WORKER = "worker1"
NOW_SQL = f"TIMESTAMP '{NOW}'"


@query(f"""
WITH s AS ({LINEAGE_SQL}), l AS ({LINEAGE_LEASES_SQL}), p AS (SELECT shard_id, unnest(parent_shard_ids) AS parent FROM s)
SELECT shard_id, nr FROM s WHERE shard_id NOT IN (SELECT lease_key FROM l WHERE special = 'SHARD_END')
  AND (NOT EXISTS (SELECT 1 FROM p JOIN s x ON x.shard_id = p.parent WHERE p.shard_id = s.shard_id)
    OR NOT EXISTS (SELECT 1 FROM p WHERE p.shard_id = s.shard_id AND p.parent NOT IN (SELECT lease_key FROM l WHERE special = 'SHARD_END')))
""")
def shards_ready(spark, sf_dir):
    """Shards that may be consumed."""
    return ops.shards_ready(lineage(spark, sf_dir), lineage_leases(spark, sf_dir)).select("shard_id", "nr")


@query(f"""
WITH s AS ({LINEAGE_SQL}), l AS ({LINEAGE_LEASES_SQL})
SELECT shard_id, CASE WHEN EXISTS (SELECT 1 FROM l WHERE list_contains(s.parent_shard_ids, l.lease_key)) THEN 'TRIM_HORIZON' ELSE 'LATEST' END AS initial_checkpoint FROM s
""")
def initial_checkpoint(spark, sf_dir):
    """First checkpoint of each shard, if reading starts at the latest record."""
    return ops.initial_checkpoints(lineage(spark, sf_dir), lineage_leases(spark, sf_dir), "LATEST").select("shard_id", "initial_checkpoint")


@query(f"SELECT shard_id, CASE WHEN len(parent_shard_ids) = 2 THEN 'merge' ELSE 'split' END AS kind, array_to_string(parent_shard_ids, ',') AS parents FROM ({LINEAGE_SQL}) WHERE len(parent_shard_ids) > 0")
def child_shards(spark, sf_dir):
    """Detected children as shards."""
    found = lineage(spark, sf_dir).where(F.size("parent_shard_ids") > 0).select("shard_id", F.lit("0" * 32).alias("lo"), F.lit("f" * 32).alias("hi"), F.col("parent_shard_ids").alias("parents"))
    out = routing.child_shards(found)
    return out.select("shard_id", F.when(F.size("parent_shard_ids") == 2, "merge").otherwise("split").alias("kind"), F.array_join("parent_shard_ids", ",").alias("parents"))


@query(f"SELECT shard_id, '{WORKER}' AS owner, CAST(0 AS BIGINT) AS counter, 'TRIM_HORIZON' AS special FROM ({LINEAGE_SQL}) WHERE shard_id NOT IN (SELECT lease_key FROM ({LINEAGE_LEASES_SQL}))")
def shards_without_lease(spark, sf_dir):
    """Leases to create."""
    made = ops.new_leases(lineage(spark, sf_dir), lineage_leases(spark, sf_dir), WORKER, "TRIM_HORIZON")
    return made.select(F.col("lease_key").alias("shard_id"), "owner", "counter", "special")


def _infos(spark, sf_dir):
    table_ = leases(spark, sf_dir).where("nr % 11 <> 0")
    known = table_.withColumn("is_expired", ops.expired(F.col("last_updated"), F.lit(NOW).cast("timestamp_ntz")))
    return assignment.lease_infos(known, leases(spark, sf_dir).select(F.col("lease_key").alias("shard_id")))


INFOS_SQL = f"""
SELECT lease_key, CASE WHEN nr % 11 <> 0 THEN owner END AS owner, nr % 11 <> 0 AND last_updated < {NOW_SQL} - INTERVAL 10 SECOND AS is_expired FROM ({LEASES_SQL})
"""
TARGETS_SQL = f"""
SELECT leases, active_workers, leases // active_workers AS min_target, leases % active_workers AS optional FROM (
  SELECT count(*) AS leases, (SELECT count(DISTINCT w) FROM (SELECT owner AS w FROM ({INFOS_SQL}) WHERE NOT is_expired AND owner IS NOT NULL UNION ALL SELECT '{WORKER}')) AS active_workers FROM ({INFOS_SQL}))
"""


@query(TARGETS_SQL)
def assignment_targets(spark, sf_dir):
    """How many leases each worker should hold."""
    return assignment.targets(_infos(spark, sf_dir), WORKER)


BALANCED_SQL = f"""
WITH i AS (SELECT *, coalesce(owner = '{WORKER}', false) AS own, owner IS NULL OR is_expired AS free, md5('seed' || lease_key) AS random FROM ({INFOS_SQL})), t AS ({TARGETS_SQL}),
o AS (SELECT *, row_number() OVER (PARTITION BY owner, own, free ORDER BY random) AS nr, count(*) OVER (PARTITION BY owner, own, free) AS held FROM i),
c AS (SELECT o.*, CASE WHEN NOT own AND NOT free THEN held ELSE 0 END AS busy, CASE WHEN own THEN 0 WHEN free THEN 1 ELSE 2 END AS kind FROM o, t WHERE own OR free OR nr > min_target),
p AS (SELECT *, row_number() OVER (ORDER BY kind, busy DESC, CASE WHEN NOT own AND NOT free THEN owner END DESC NULLS LAST, random) AS place FROM c),
e AS (SELECT min(place) AS stop FROM p, t WHERE place > min_target AND NOT free)
SELECT lease_key, place FROM p, t, e WHERE place <= min_target OR place <= min_target + optional AND (stop IS NULL OR place < stop)
"""


@query(BALANCED_SQL)
def balanced_assignment(spark, sf_dir):
    """Leases that a worker should hold for its fair share."""
    return assignment.balanced(_infos(spark, sf_dir), WORKER, "seed")


@query(f"SELECT lease_key FROM ({BALANCED_SQL}) JOIN ({INFOS_SQL}) l USING (lease_key) WHERE l.owner IS DISTINCT FROM '{WORKER}'")
def leases_to_take(spark, sf_dir):
    """Desired leases of other workers, or of none."""
    infos = _infos(spark, sf_dir)
    desired = assignment.balanced(infos, WORKER, "seed").select(F.col("lease_key").alias("shard_id"))
    return ops.to_take(infos, desired, WORKER).select("lease_key")


@query(f"SELECT lease_key FROM ({LEASES_SQL}) WHERE owner = '{WORKER}' AND last_updated < {NOW_SQL} - INTERVAL 3 SECOND")
def leases_to_renew(spark, sf_dir):
    """Own leases that were not updated within the interval."""
    return ops.to_renew(leases(spark, sf_dir), WORKER, F.lit(NOW).cast("timestamp_ntz"), 3).select("lease_key")


@query(f"SELECT lease_key, owner FROM ({LEASES_SQL}) WHERE last_updated < {NOW_SQL} - INTERVAL 10 SECOND")
def expired_leases(spark, sf_dir):
    """Leases that no one has updated for ten seconds."""
    return leases(spark, sf_dir).where(ops.expired(F.col("last_updated"), F.lit(NOW).cast("timestamp_ntz"))).select("lease_key", "owner")


SEEN_SQL = f"SELECT lease_key, CASE WHEN nr % 3 = 0 THEN 'worker' || (nr % 7) ELSE owner END AS owner, counter + CASE WHEN nr % 3 <> 1 THEN 1 ELSE 0 END AS counter FROM ({LEASES_SQL})"


def _seen(spark, sf_dir):
    k = F.col("nr")
    return leases(spark, sf_dir).select("lease_key", F.when(k % 3 == 0, F.concat(F.lit("worker"), (k % 7).cast("string"))).otherwise(F.col("owner")).alias("owner"), (F.col("counter") + F.when(k % 3 != 1, 1).otherwise(0)).alias("counter"))


@query(f"""
SELECT s.lease_key, s.owner, s.counter, CASE WHEN coalesce(held, false) AND k.counter = s.counter THEN 'unchanged' WHEN coalesce(held, false) AND k.owner IS DISTINCT FROM s.owner THEN 'lost' WHEN coalesce(held, false) THEN 'updated by us'
  WHEN s.owner = '{WORKER}' THEN 'acquired' ELSE 'updated' END AS outcome
FROM ({SEEN_SQL}) s LEFT JOIN (SELECT lease_key, owner, counter, owner = '{WORKER}' AND nr % 2 = 0 AS held FROM ({LEASES_SQL}) WHERE nr % 10 <> 9) k ON k.lease_key = s.lease_key
""")
def lease_refresh_outcome(spark, sf_dir):
    """What a second look at the lease table means to a worker."""
    known = leases(spark, sf_dir).where("nr % 10 <> 9").select("lease_key", "owner", "counter", ((F.col("owner") == WORKER) & (F.col("nr") % 2 == 0)).alias("held"))
    return ops.refresh_outcome(known, _seen(spark, sf_dir), WORKER)


@query(f"""
WITH l AS (SELECT * FROM ({LEASES_SQL}) WHERE nr % 9 <> 0), c AS (SELECT lease_key, nr, counter - CASE WHEN nr % 8 = 0 THEN 1 ELSE 0 END AS expected, CASE nr % 6 WHEN 0 THEN 'create' WHEN 1 THEN 'claim' WHEN 2 THEN 'renew' WHEN 3 THEN 'checkpoint' WHEN 4 THEN 'checkpoint_release' ELSE 'release' END AS action,
  CASE WHEN nr % 4 = 1 THEN 'SHARD_END' END AS new_special, CASE WHEN nr % 4 <> 1 THEN CAST(nr AS VARCHAR) END AS new_seq, CAST(5 AS BIGINT) AS new_sub FROM ({LEASES_SQL}) WHERE nr % 10 <> 0),
b AS (SELECT coalesce(l.lease_key, c.lease_key) AS lease_key, l.owner, l.counter, l.special, l.seq, l.sub_seq, c.* EXCLUDE (lease_key), CASE WHEN action IS NULL THEN 'none' WHEN action = 'create' AND l.lease_key IS NULL THEN 'done' WHEN action <> 'create' AND l.counter = expected THEN 'done' ELSE 'conflict' END AS outcome FROM l FULL JOIN c ON c.lease_key = l.lease_key)
SELECT lease_key, CASE WHEN outcome = 'done' AND action IN ('release', 'checkpoint_release') THEN NULL WHEN outcome = 'done' AND action IN ('create', 'claim') THEN 'worker9' ELSE owner END AS owner,
  CASE WHEN outcome = 'done' AND action = 'create' THEN 0 WHEN outcome = 'done' THEN counter + 1 ELSE counter END AS counter,
  CASE WHEN outcome = 'done' AND action IN ('checkpoint', 'checkpoint_release', 'create') THEN new_special ELSE special END AS special, CASE WHEN outcome = 'done' AND action IN ('checkpoint', 'checkpoint_release', 'create') THEN new_seq ELSE seq END AS seq,
  CASE WHEN outcome = 'done' AND action IN ('checkpoint', 'checkpoint_release', 'create') THEN CASE WHEN new_special IS NOT NULL THEN 0 ELSE new_sub END ELSE sub_seq END AS sub_seq, outcome FROM b
""")
def lease_conditional_update(spark, sf_dir):
    """The lease table after one conditional change of each lease, and what became of it."""
    k = F.col("nr")
    current = leases(spark, sf_dir).where("nr % 9 <> 0")
    action = F.when(k % 6 == 0, "create").when(k % 6 == 1, "claim").when(k % 6 == 2, "renew").when(k % 6 == 3, "checkpoint").when(k % 6 == 4, "checkpoint_release").otherwise("release")
    changes = leases(spark, sf_dir).where("nr % 10 <> 0").select(
        "lease_key", action.alias("action"), (F.col("counter") - F.when(k % 8 == 0, 1).otherwise(0)).alias("expected_counter"), F.lit("worker9").alias("new_owner"),
        F.when(k % 4 == 1, "SHARD_END").alias("new_special"), F.when(k % 4 != 1, k.cast("string")).alias("new_seq"), F.lit(5).cast("bigint").alias("new_sub_seq"),
    )
    return ops.conditional_update(current, changes)


@query(f"""
SELECT lease_key, max(CASE WHEN prev IS NULL OR counter > prev THEN seen_at END) AS last_updated, max(counter) AS counter FROM (
  SELECT *, lag(counter) OVER (PARTITION BY lease_key ORDER BY seen_at) AS prev FROM (
    SELECT lease_key, counter, {NOW_SQL} AS seen_at FROM ({LEASES_SQL}) UNION ALL SELECT lease_key, counter, {NOW_SQL} + INTERVAL 5 SECOND FROM ({SEEN_SQL}))) GROUP BY lease_key
""")
def lease_last_updated(spark, sf_dir):
    """When each lease's counter last grew, over two looks."""
    now = F.lit(NOW).cast("timestamp_ntz")
    first = leases(spark, sf_dir).select("lease_key", "counter", now.alias("seen_at"))
    second = _seen(spark, sf_dir).select("lease_key", "counter", (now + F.make_dt_interval(secs=F.lit(5))).alias("seen_at"))
    return ops.last_updated(first.unionByName(second))


@query(f"""
WITH a AS (SELECT DISTINCT owner FROM ({LEASES_SQL}) WHERE owner IS NOT NULL AND owner <> 'worker2'), b AS (SELECT DISTINCT owner FROM ({SEEN_SQL}) WHERE owner IS NOT NULL AND owner <> 'worker3')
SELECT owner, 'joined' AS change FROM b WHERE owner NOT IN (SELECT owner FROM a) UNION ALL SELECT owner, 'left' FROM a WHERE owner NOT IN (SELECT owner FROM b)
""")
def worker_joins_leaves(spark, sf_dir):
    """Workers that are in one of two looks only."""
    return ops.joins_and_leaves(leases(spark, sf_dir).where("owner <> 'worker2'"), _seen(spark, sf_dir).where("owner <> 'worker3'"), "owner")


@query("SELECT DISTINCT 's' || n_nationkey AS shard_id FROM nation WHERE n_nationkey IN (SELECT s_suppkey % 40 FROM supplier)")
def manual_assignment(spark, sf_dir):
    """Assigned shards that exist."""
    assigned = table(spark, sf_dir, "supplier").select(F.concat(F.lit("s"), (F.col("s_suppkey") % 40).cast("string")).alias("shard_id"))
    return assignment.manual(assigned, lineage(spark, sf_dir))


KIND_SQL = "CASE event_type WHEN 'signup' THEN 'LeaseAcquired' WHEN 'error' THEN 'ShardLeaseLost' WHEN 'view' THEN 'LeaseReleased' WHEN 'click' THEN 'PollComplete' ELSE 'LeaseRenewed' END"
EVENTS_SQL = f"SELECT event_id, ts, {KIND_SQL} AS event_type, 'shard' || user_id AS shard_id, event_id % 100 AS nr_records, CAST(floor(abs(value)) AS BIGINT) AS duration_ms, event_id % 5000 AS behind_ms FROM events"


def _diagnostics(spark, sf_dir):
    kind = F.col("event_type")
    name = F.when(kind == "signup", "LeaseAcquired").when(kind == "error", "ShardLeaseLost").when(kind == "view", "LeaseReleased").when(kind == "click", "PollComplete").otherwise("LeaseRenewed")
    return table(spark, sf_dir, "events").select("event_id", "ts", name.alias("event_type"), F.concat(F.lit("shard"), F.col("user_id").cast("string")).alias("shard_id"), (F.col("event_id") % 100).alias("nr_records"), F.floor(F.abs("value")).cast("bigint").alias("duration_ms"), (F.col("event_id") % 5000).alias("behind_ms"))


METRICS_SQL = f"""
WITH e AS ({EVENTS_SQL})
SELECT event_id, ts, 0 AS nr, 'RecordsProcessed' AS name, CAST(nr_records AS DOUBLE) AS value, 'Count' AS unit, 'ProcessTask' AS operation, shard_id, CAST(NULL AS VARCHAR) AS worker_id FROM e WHERE event_type = 'PollComplete'
UNION ALL SELECT event_id, ts, 1, 'Time', CAST(coalesce(duration_ms, 0) AS DOUBLE), 'Milliseconds', 'ProcessTask', shard_id, NULL FROM e WHERE event_type = 'PollComplete'
UNION ALL SELECT event_id, ts, 2, 'MillisBehindLatest', CAST(behind_ms AS DOUBLE), 'Milliseconds', 'ProcessTask', shard_id, NULL FROM e WHERE event_type = 'PollComplete'
UNION ALL SELECT event_id, ts, 0, 'LostLeases', 1.0, 'Count', 'RenewAllLeases', NULL, '{WORKER}' FROM e WHERE event_type = 'ShardLeaseLost'
UNION ALL SELECT event_id, ts, 0, 'RenewLease.Time', CAST(duration_ms AS DOUBLE), 'Milliseconds', 'RenewAllLeases', NULL, '{WORKER}' FROM e WHERE event_type = 'LeaseRenewed'
UNION ALL SELECT event_id, ts, 1, 'RenewLease.Success', 1.0, 'Count', 'RenewAllLeases', NULL, '{WORKER}' FROM e WHERE event_type = 'LeaseRenewed'
"""


@query(METRICS_SQL)
def cloudwatch_metrics(spark, sf_dir):
    """Metric data of diagnostic events."""
    return metrics.event_metrics(_diagnostics(spark, sf_dir), WORKER)


@query(f"SELECT upload, count(*) AS data, min(event_id) AS first_event FROM (SELECT *, (row_number() OVER (ORDER BY event_id, nr) - 1) // 20 AS upload FROM ({METRICS_SQL})) GROUP BY upload")
def metric_batches(spark, sf_dir):
    """Uploads of at most 20 data."""
    out = metrics.upload_batches(metrics.event_metrics(_diagnostics(spark, sf_dir), WORKER).select("event_id", "nr"), ["event_id", "nr"])
    return out.groupBy("upload").agg(F.count("*").alias("data"), F.min("event_id").alias("first_event"))


ON, OFF = ["LeaseAcquired"], ["LeaseReleased", "ShardLeaseLost"]


@query(f"SELECT shard_id FROM (SELECT shard_id, arg_max(event_type, event_id) AS t FROM ({EVENTS_SQL}) WHERE event_type IN ('LeaseAcquired', 'LeaseReleased', 'ShardLeaseLost') GROUP BY shard_id) WHERE t = 'LeaseAcquired'")
def held_leases(spark, sf_dir):
    """Leases held after all events."""
    return metrics.last_state(_diagnostics(spark, sf_dir), "shard_id", "event_id", ON, OFF)


WORKERS_SQL = "SELECT event_id, CASE WHEN event_type IN ('signup', 'view') THEN 'WorkerJoined' ELSE 'WorkerLeft' END AS event_type, 'worker' || (user_id % 50) AS worker_id FROM events WHERE event_type IN ('signup', 'view', 'error')"


@query(f"SELECT worker_id FROM (SELECT worker_id, arg_max(event_type, event_id) AS t FROM ({WORKERS_SQL}) GROUP BY worker_id) WHERE t = 'WorkerJoined'")
def active_workers(spark, sf_dir):
    """Workers that are there after all events."""
    kind = F.col("event_type")
    events = table(spark, sf_dir, "events").where(kind.isin("signup", "view", "error")).select("event_id", F.when(kind.isin("signup", "view"), "WorkerJoined").otherwise("WorkerLeft").alias("event_type"), F.concat(F.lit("worker"), (F.col("user_id") % 50).cast("string")).alias("worker_id"))
    return metrics.last_state(events, "worker_id", "event_id", ["WorkerJoined"], ["WorkerLeft"])


@query(f"""
SELECT period, CAST(sum(delta) OVER (ORDER BY period) AS BIGINT) AS value FROM (
  SELECT period, sum(s - coalesce(prev, 0)) AS delta FROM (SELECT event_id // 100 AS period, s, lag(s) OVER (PARTITION BY shard_id ORDER BY event_id) AS prev FROM (
    SELECT event_id, shard_id, CASE WHEN event_type = 'LeaseAcquired' THEN 1 ELSE 0 END AS s FROM ({EVENTS_SQL}) WHERE event_type IN ('LeaseAcquired', 'LeaseReleased', 'ShardLeaseLost'))) GROUP BY period)
""")
def periodic_gauges(spark, sf_dir):
    """Held leases at the end of each period of 100 events."""
    events = _diagnostics(spark, sf_dir).where(F.col("event_type").isin(*ON, *OFF)).withColumn("period", F.expr("event_id div 100"))
    return metrics.gauges(events, "shard_id", "event_id", "period", ON, OFF)
