"""Which shards a worker should hold."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def lease_infos(leases: DataFrame, shards: DataFrame) -> DataFrame:
    """Leases (lease_key, owner, is_expired), and shards without a lease as unowned ones."""
    missing = shards.select(F.col("shard_id").alias("lease_key")).join(leases.select("lease_key"), "lease_key", "left_anti")
    return leases.select("lease_key", "owner", "is_expired").unionByName(missing.select("lease_key", F.lit(None).cast("string").alias("owner"), F.lit(False).alias("is_expired")))


def targets(infos: DataFrame, worker: str) -> DataFrame:
    """One row: leases, active workers (this one among them), the least each should hold, and the rest."""
    active = F.collect_set(F.when(~F.col("is_expired"), F.col("owner")))
    counted = infos.agg(F.count("*").alias("leases"), F.size(F.array_union(active, F.array(F.lit(worker)))).cast("bigint").alias("active_workers"))
    return counted.select("leases", "active_workers", F.expr("leases div active_workers").alias("min_target"), (F.col("leases") % F.col("active_workers")).alias("optional"))


def shuffled(key: Column, seed: str) -> Column:
    """An order that is random for other workers and the same for each run."""
    return F.md5(F.concat(F.lit(seed), key.cast("string")).cast("binary"))


def balanced(infos: DataFrame, worker: str, seed: str = "") -> DataFrame:
    """(lease_key) of the leases that the worker should hold.

    Its own first, then free ones (unowned or expired) in random order, then what other workers hold beyond the least
    number, from the busiest one first. It takes the least number of them, and then as many optional ones as there are, as
    long as they are free. A lease that is both own and expired counts once.

    The relation is the lease table: a row for each shard, which one task sorts.
    """
    t = F.broadcast(targets(infos, worker))  # one row
    own = F.col("owner").eqNullSafe(F.lit(worker))
    free = F.col("owner").isNull() | F.col("is_expired")
    marked = infos.withColumn("own", own).withColumn("free", free).withColumn("random", shuffled(F.col("lease_key"), seed)).join(t)
    held = Window.partitionBy("owner", "own", "free").orderBy("random")
    of_owner = marked.withColumn("nr", F.row_number().over(held)).withColumn("held", F.count("*").over(Window.partitionBy("owner", "own", "free")))
    surplus = ~F.col("own") & ~F.col("free")
    choice = of_owner.where(~surplus | (F.col("nr") > F.col("min_target"))).withColumn("busy", F.when(surplus, F.col("held")).otherwise(0)).withColumn("kind", F.when(F.col("own"), 0).when(F.col("free"), 1).otherwise(2))
    line = Window.orderBy("kind", F.desc("busy"), F.desc(F.when(surplus, F.col("owner"))), "random")
    ranked = choice.withColumn("place", F.row_number().over(line))
    # optional ones: the first that isn't free ends them
    stop = F.min(F.when((F.col("place") > F.col("min_target")) & ~F.col("free"), F.col("place"))).over(Window.partitionBy(F.lit(0)))
    taken = ranked.withColumn("stop", stop).where((F.col("place") <= F.col("min_target")) | ((F.col("place") <= F.col("min_target") + F.col("optional")) & (F.col("stop").isNull() | (F.col("place") < F.col("stop")))))
    return taken.select("lease_key", F.col("place").cast("bigint").alias("place"))


def manual(assigned: DataFrame, shards: DataFrame) -> DataFrame:
    """Assigned shards that there are."""
    return assigned.select("shard_id").intersect(shards.select("shard_id"))
