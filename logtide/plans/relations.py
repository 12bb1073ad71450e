"""Relations that the queries derive from the tables, and the same in SQL.

events are the consumed stream, lineitem and documents the produced ones, customer the lease table and nation the shards.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logtide.operators.routing import uniform_ranges

SHARDS = 4
NOW = "2024-01-01 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def values_sql(n: int) -> str:
    """VALUES of a uniform shard map: (shard_id, lo, hi)."""
    return ", ".join(f"('{s}', '{lo}', '{hi}')" for s, lo, hi in uniform_ranges(n))


def shard_sql(key: str, n: int = SHARDS) -> str:
    """A key's shard id among n equal ranges, n a power of two."""
    return f"printf('shard-%03d', CAST(floor(CAST('0x' || substr(md5({key}), 1, 8) AS BIGINT) * {n} / 4294967296) AS BIGINT))"


def stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as records: (event_id, ts, partition_key, data, event_type, value)."""
    return table(spark, sf_dir, "events").select("event_id", "ts", F.col("user_id").cast("string").alias("partition_key"), F.coalesce("props", F.lit("")).cast("binary").alias("data"), "event_type", "value")


def sharded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stream with its shard and position (from 1) in it."""
    from logtide.operators.checkpoints import numbered
    from logtide.operators.routing import predict_shards, shard_map

    routed = predict_shards(stream(spark, sf_dir), shard_map(spark, SHARDS), into="shard_id", count=SHARDS)
    return numbered(routed, "shard_id", ["event_id"])


SHARDED_SQL = f"""
  SELECT *, row_number() OVER (PARTITION BY shard_id ORDER BY event_id) AS position FROM (
    SELECT event_id, ts, CAST(user_id AS VARCHAR) AS partition_key, coalesce(props, '') AS data, event_type, value,
           {shard_sql("CAST(user_id AS VARCHAR)")} AS shard_id FROM events)
"""


def lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """nation as shards: ten without parents, ten split from them, the rest merged from two."""
    n = F.col("n_nationkey")
    name = lambda x: F.concat(F.lit("s"), x.cast("string"))
    parents = F.when(n < 10, F.array().cast("array<string>")).when(n < 20, F.array(name(n - 10))).otherwise(F.array(name(n - 10), name(n - 9)))
    return table(spark, sf_dir, "nation").select(name(n).alias("shard_id"), parents.alias("parent_shard_ids"), n.cast("bigint").alias("nr"))


LINEAGE_SQL = """
  SELECT 's' || n_nationkey AS shard_id, CAST(n_nationkey AS BIGINT) AS nr,
         CASE WHEN n_nationkey < 10 THEN CAST([] AS VARCHAR[]) WHEN n_nationkey < 20 THEN ['s' || (n_nationkey - 10)]
              ELSE ['s' || (n_nationkey - 10), 's' || (n_nationkey - 9)] END AS parent_shard_ids FROM nation
"""


def lineage_leases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leases of most of the lineage's shards, half of them ended."""
    nr = F.col("nr")
    shards = lineage(spark, sf_dir).where(nr % 7 != 6)
    return shards.select(F.col("shard_id").alias("lease_key"), F.when(nr % 2 == 0, "SHARD_END").alias("special"), F.when(nr % 2 != 0, nr.cast("string")).alias("seq"))


LINEAGE_LEASES_SQL = f"""
  SELECT shard_id AS lease_key, CASE WHEN nr % 2 = 0 THEN 'SHARD_END' END AS special, CASE WHEN nr % 2 <> 0 THEN CAST(nr AS VARCHAR) END AS seq
  FROM ({LINEAGE_SQL}) WHERE nr % 7 <> 6
"""


def leases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer as leases of workers; the leases of workers 5 and 6 are expired."""
    k, w = F.col("c_custkey"), F.col("c_nationkey") % 7
    owner = F.when(k % 5 != 0, F.concat(F.lit("worker"), w.cast("string")))
    age = F.when((w >= 5) & owner.isNotNull(), 20 + k % 20).otherwise(k % 10)
    return table(spark, sf_dir, "customer").select(
        F.concat(F.lit("l"), k.cast("string")).alias("lease_key"), owner.alias("owner"), (k % 13).cast("bigint").alias("counter"),
        F.when(k % 4 == 0, "SHARD_END").alias("special"), F.when(k % 4 != 0, (k * 7).cast("string")).alias("seq"), F.when(k % 4 != 0, (k % 3).cast("bigint")).alias("sub_seq"),
        (F.lit(NOW).cast("timestamp_ntz") - F.make_dt_interval(secs=age)).alias("last_updated"), k.alias("nr"),
    )


LEASES_SQL = f"""
  SELECT 'l' || c_custkey AS lease_key, CASE WHEN c_custkey % 5 <> 0 THEN 'worker' || (c_nationkey % 7) END AS owner, CAST(c_custkey % 13 AS BIGINT) AS counter,
         CASE WHEN c_custkey % 4 = 0 THEN 'SHARD_END' END AS special, CASE WHEN c_custkey % 4 <> 0 THEN CAST(c_custkey * 7 AS VARCHAR) END AS seq,
         CASE WHEN c_custkey % 4 <> 0 THEN CAST(c_custkey % 3 AS BIGINT) END AS sub_seq,
         TIMESTAMP '{NOW}' - to_seconds(CASE WHEN c_nationkey % 7 >= 5 AND c_custkey % 5 <> 0 THEN 20 + c_custkey % 20 ELSE c_custkey % 10 END) AS last_updated, c_custkey AS nr
  FROM customer
"""


def produced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem as records to produce: (partition_key, data, position)."""
    data = F.concat_ws("|", F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string"), "l_returnflag", "l_linestatus")
    return table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").cast("string").alias("partition_key"), data.cast("binary").alias("data"), (F.col("l_orderkey") * 8 + F.col("l_linenumber")).cast("bigint").alias("position"), "l_returnflag", "l_linestatus", "l_linenumber", "l_quantity", "l_orderkey")


PRODUCED_SQL = """
  SELECT CAST(l_orderkey AS VARCHAR) AS partition_key, concat_ws('|', CAST(l_partkey AS VARCHAR), CAST(l_suppkey AS VARCHAR), l_returnflag, l_linestatus) AS data,
         CAST(l_orderkey * 8 + l_linenumber AS BIGINT) AS position, l_returnflag, l_linestatus, l_linenumber, l_quantity, l_orderkey FROM lineitem
"""


def greedy_sql(rows: str, limit: int, count: int | None = None) -> str:
    """CTEs ``rows``, ``starts`` and ``batches`` (shard, batch, st, en) of greedy batches over rows (shard, ord, size).

    From each row, the last row that its batch could hold is found by a range over the running sum; the recursion hops from
    batch to batch.
    """
    most = count or 1 << 40
    return f"""
    rows AS MATERIALIZED (SELECT shard, ord, size, row_number() OVER w AS rn, sum(size) OVER w - size AS before FROM ({rows}) WINDOW w AS (PARTITION BY shard ORDER BY ord, size ROWS UNBOUNDED PRECEDING)),
    marks AS (SELECT shard, rn, CAST(before AS BIGINT) AS before, CAST(size AS BIGINT) AS size, true AS is_row FROM rows
              UNION ALL SELECT shard, max(rn) + 1, CAST(max(before + size) AS BIGINT), 0, false FROM rows GROUP BY shard),
    ends AS MATERIALIZED (SELECT shard, rn, size, is_row, greatest(rn + 1, least(rn + {most}, max(rn) OVER (PARTITION BY shard ORDER BY before RANGE BETWEEN CURRENT ROW AND {limit} FOLLOWING))) AS nxt FROM marks),
    hops(shard, batch, st) AS (SELECT DISTINCT shard, CAST(0 AS BIGINT), CAST(1 AS BIGINT) FROM rows
              UNION ALL SELECT h.shard, h.batch + 1, e.nxt FROM hops h JOIN ends e ON e.shard = h.shard AND e.rn = h.st JOIN ends f ON f.shard = e.shard AND f.rn = e.nxt AND f.is_row),
    batches AS MATERIALIZED (SELECT h.shard, h.batch, h.st, e.nxt - 1 AS en FROM hops h JOIN ends e ON e.shard = h.shard AND e.rn = h.st)"""
