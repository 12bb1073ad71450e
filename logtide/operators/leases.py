"""Decisions of lease coordination, each as one relation over leases and shards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ENDED = "SHARD_END"


def shards_ready(shards: DataFrame, leases: DataFrame) -> DataFrame:
    """Shards to consume: not ended themselves, and all parents ended or no parent listed any more.

    shards: (shard_id, parent_shard_ids); leases: (lease_key, special). A parent that is still listed must have a lease
    that is ended.
    """
    ended = leases.where(F.col("special") == ENDED).select(F.col("lease_key").alias("shard_id")).distinct()
    parents = shards.select("shard_id", F.explode("parent_shard_ids").alias("parent"))
    listed = parents.join(shards.select(F.col("shard_id").alias("parent")).distinct(), "parent")
    # with some parent listed, every parent must have ended
    open_parents = parents.join(ended.select(F.col("shard_id").alias("parent")), "parent", "left_anti")
    held_back = listed.select("shard_id").distinct().join(open_parents.select("shard_id").distinct(), "shard_id", "left_semi")
    return shards.join(ended, "shard_id", "left_anti").join(held_back, "shard_id", "left_anti")


def initial_checkpoints(shards: DataFrame, leases: DataFrame, initial: str) -> DataFrame:
    """Adds the checkpoint of a shard's first lease: the initial position, but TRIM_HORIZON for LATEST if a parent has a lease."""
    if initial != "LATEST":
        return shards.withColumn("initial_checkpoint", F.lit(initial))
    parents = shards.select("shard_id", F.explode("parent_shard_ids").alias("lease_key"))
    with_lease = parents.join(leases.select("lease_key").distinct(), "lease_key", "left_semi").select("shard_id").distinct().withColumn("__known", F.lit(True))
    out = shards.join(with_lease, "shard_id", "left")
    return out.withColumn("initial_checkpoint", F.when(F.col("__known"), "TRIM_HORIZON").otherwise("LATEST")).drop("__known")


def without_lease(shards: DataFrame, leases: DataFrame) -> DataFrame:
    return shards.join(leases.select(F.col("lease_key").alias("shard_id")), "shard_id", "left_anti")


def new_leases(shards: DataFrame, leases: DataFrame, worker: str, initial: str) -> DataFrame:
    """Leases to create: owned by the worker, counter 0, initial checkpoint, parents."""
    made = initial_checkpoints(shards, leases, initial).join(leases.select(F.col("lease_key").alias("shard_id")), "shard_id", "left_anti")
    return made.select(F.col("shard_id").alias("lease_key"), F.lit(worker).alias("owner"), F.lit(0).cast("bigint").alias("counter"), F.col("initial_checkpoint").alias("special"), "parent_shard_ids")


def to_take(leases: DataFrame, desired: DataFrame, worker: str) -> DataFrame:
    """Desired leases that others own, or no one."""
    return leases.join(desired.select(F.col("shard_id").alias("lease_key")).distinct(), "lease_key", "left_semi").where(~F.col("owner").eqNullSafe(F.lit(worker)))


def to_release(leases: DataFrame, desired: DataFrame, worker: str) -> DataFrame:
    """Own leases that are not desired; nothing releases them by itself."""
    return leases.where(F.col("owner") == worker).join(desired.select(F.col("shard_id").alias("lease_key")).distinct(), "lease_key", "left_anti")


def to_renew(leases: DataFrame, worker: str, now: Column, interval_s: int) -> DataFrame:
    return leases.where((F.col("owner") == worker) & (F.col("last_updated") < now - F.make_dt_interval(secs=F.lit(interval_s))))


def expired(last_updated: Column, now: Column, expiration_s: int = 10) -> Column:
    return last_updated < now - F.make_dt_interval(secs=F.lit(expiration_s))


def refresh_outcome(known: DataFrame, seen: DataFrame, worker: str) -> DataFrame:
    """What a fresh look at the lease table means. known: (lease_key, owner, counter, held); seen: (lease_key, owner, counter)."""
    old = known.select("lease_key", F.col("owner").alias("old_owner"), F.col("counter").alias("old_counter"), "held")
    held = F.coalesce("held", F.lit(False))
    same, moved = F.col("old_counter") == F.col("counter"), ~F.col("old_owner").eqNullSafe(F.col("owner"))
    outcome = F.when(held & same, "unchanged").when(held & moved, "lost").when(held, "updated by us").when(F.col("owner").eqNullSafe(F.lit(worker)), "acquired").otherwise("updated")
    return seen.join(old, "lease_key", "left").withColumn("outcome", outcome).drop("old_owner", "old_counter", "held")


def conditional_update(leases: DataFrame, changes: DataFrame) -> DataFrame:
    """Apply changes that find the counter they expect, and say what became of each.

    changes: (lease_key, action, expected_counter, new_owner, new_special, new_seq, new_sub_seq), one for each lease. Actions:
    create (no lease yet), claim, renew, checkpoint (special ones at sub-sequence 0), checkpoint_release, release. Each but
    create adds 1 to the counter. All leases come back, with outcome: ``none`` (no change asked), ``done`` or ``conflict``.
    """
    current = leases.select("lease_key", "owner", "counter", "special", "seq", "sub_seq").withColumn("__there", F.lit(True))
    both = current.join(changes, "lease_key", "full")
    action, there = F.col("action"), F.coalesce("__there", F.lit(False))
    done = F.when(action == "create", ~there).otherwise(there & F.col("counter").eqNullSafe(F.col("expected_counter")))
    outcome = F.when(action.isNull(), "none").when(done, "done").otherwise("conflict")
    go = F.col("outcome") == "done"
    moves = go & action.isin("checkpoint", "checkpoint_release", "create")
    owner = F.when(go & action.isin("release", "checkpoint_release"), F.lit(None)).when(go & action.isin("create", "claim"), F.col("new_owner")).otherwise(F.col("owner"))
    counter = F.when(go & (action == "create"), F.lit(0)).when(go, F.col("counter") + 1).otherwise(F.col("counter")).cast("bigint")
    sub = F.when(F.col("new_special").isNotNull(), F.lit(0).cast("bigint")).otherwise(F.col("new_sub_seq"))
    return both.withColumn("outcome", outcome).select(
        "lease_key", owner.alias("owner"), counter.alias("counter"),
        F.when(moves, F.col("new_special")).otherwise(F.col("special")).alias("special"),
        F.when(moves, F.col("new_seq")).otherwise(F.col("seq")).alias("seq"),
        F.when(moves, sub).otherwise(F.col("sub_seq")).alias("sub_seq"), "outcome",
    )


def last_updated(observations: DataFrame) -> DataFrame:
    """Per lease, when its counter last grew among observations (lease_key, counter, seen_at)."""
    w = Window.partitionBy("lease_key").orderBy("seen_at")
    before = F.lag("counter").over(w)
    grown = observations.withColumn("__grown", before.isNull() | (F.col("counter") > before))
    return grown.groupBy("lease_key").agg(F.max(F.when(F.col("__grown"), F.col("seen_at"))).alias("last_updated"), F.max("counter").alias("counter"))


def joins_and_leaves(before: DataFrame, after: DataFrame, column: str) -> DataFrame:
    """Members of one snapshot only: (column, change)."""
    old, new = (x.select(column).where(F.col(column).isNotNull()).distinct() for x in (before, after))
    joined = new.join(old, column, "left_anti").withColumn("change", F.lit("joined"))
    return joined.unionByName(old.join(new, column, "left_anti").withColumn("change", F.lit("left")))
