"""Consuming a shard log: micro-batches or single records, with the engine's checkpoints."""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from logtide.operators import checkpoints
from logtide.operators.aggregation import deaggregate
from logtide.operators.strategies import Coordinator
from logtide.operators.routing import predict_shards
from logtide.schema import RECORD
from logtide.scratch import Scratch
from logtide.settings import Backoff, CheckpointSettings, PollingSettings
from logtide.sources import shardlog


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its scheme, by the session's default file system."""
    if path.startswith("file:"):
        return path
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(at).toString()


#: Columns that unpacking makes and needs.
UNPACKED = ("data", "partition_key", "explicit_hash_key", "sub_sequence_number", "aggregated")


def read_log(spark: SparkSession, path: str, where: Column | str | None = None, columns: Iterable[str] | None = None, unpack: bool = True, **options: str) -> DataFrame:
    """All committed records, aggregated ones unpacked.

    where: a condition on stored records; comparisons of shard_id, sequence_number and approximate_arrival_timestamp choose the
    files that are opened. columns: the only ones that are read (besides those of unpacking); a condition's are among them.
    """
    shardlog.register(spark)
    reader = spark.read.format("shardlog").options(**options)
    if columns is not None:
        columns = list(columns)
        reader = reader.schema(StructType([f for f in RECORD if f.name in columns or unpack and f.name in UNPACKED]))
    records = reader.load(qualified(spark, path))
    if where is not None:
        records = records.where(where)
    records = deaggregate(records) if unpack else records
    return records if columns is None else records.select(*columns)


def read_log_from(spark: SparkSession, path: str, position: str, timestamp: str | None = None) -> DataFrame:
    """Records from an initial position: TRIM_HORIZON, LATEST (none that are there) or AT_TIMESTAMP."""
    return read_log(spark, path, startingPosition=position, **({"startingTimestamp": timestamp} if timestamp else {}))


def stream_log(spark: SparkSession, path: str, **options: str) -> DataFrame:
    shardlog.register(spark)
    return deaggregate(spark.readStream.format("shardlog").options(**options).load(qualified(spark, path)))


def consume_with(records: DataFrame, process: Callable[[DataFrame, int], None], checkpoint_dir: str, interval: str | None = None):
    """Run a function for each micro-batch; a batch is checkpointed after its function returns, so delivery is at least once.

    Without an interval the query reads what there is and stops.
    """
    writer = records.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint_dir)
    return (writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)).start()


def reached(spark: SparkSession, checkpoint_dir: str) -> dict | None:
    """The offset that a query has planned up to, from its checkpoint folder."""
    at = spark._jvm.org.apache.hadoop.fs.Path(f"{checkpoint_dir}/offsets")
    files = at.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(at):
        return None
    found = [x.getPath().getName() for x in files.listStatus(at)]
    numbers = [int(x) for x in found if x.isdigit()]
    if not numbers:
        return None
    lines = [r.value for r in spark.read.text(f"{checkpoint_dir}/offsets/{max(numbers)}").collect()]  # three lines
    return json.loads(lines[-1])


def drain(spark: SparkSession, path: str, process: Callable[[DataFrame, int], None], checkpoint_dir: str, polling: PollingSettings = PollingSettings(), stop: Callable[[], bool] = lambda: False, emit: Callable[[dict], None] | None = None, **options: str) -> int:
    """Process all there is, some records at a time, children of a reshard only after their parents; returns the batches.

    Each poll takes ``polling.batch_size`` records at most and is checkpointed; failures are tried again as
    ``polling.retry`` says. ``stop`` is asked between polls: what has been read is then processed and checkpointed.
    """
    folder = shardlog.Folder(qualified(spark, path))
    polls, failures, told = 0, 0, set()
    quiet, emit = emit is None, emit or (lambda event: None)
    emit({"event_type": "WorkerJoined", "worker_id": checkpoint_dir})
    while not stop():
        at = reached(spark, checkpoint_dir)
        shards = folder.shards()
        for s in sorted(shards.keys() - told):
            emit({"event_type": "NewShardDetected", "shard_id": s})
        told |= shards.keys()
        resume = {"resumeAt": json.dumps(at)} if at else {"resumeAt": "null"}
        records = stream_log(spark, path, maxRecordsPerBatch=str(polling.batch_size), **resume, **options)
        seen: list[dict] = []

        def watched(batch: DataFrame, number: int) -> None:
            process(batch, number)
            if quiet:
                return
            counts = batch.groupBy("shard_id").agg(F.count("*").alias("n"), F.max("sequence_number").alias("last")).collect()  # a row for each shard
            seen.extend({"shard_id": r.shard_id, "nr_records": r.n, "checkpoint": r.last} for r in counts)

        began = time.time()
        query = consume_with(records, watched, checkpoint_dir)
        try:
            query.awaitTermination()
        except Exception:
            delays = polling.retry.delays(failures + 1)
            if len(delays) <= failures:
                raise
            time.sleep(delays[failures])
            failures += 1
            continue
        failures = 0
        now = reached(spark, checkpoint_dir)
        first = (at or {"commits": 0})["commits"]
        commits = folder.commits(first)
        behind = sum(f["rows"] for c in commits[now["commits"] - first :] for f in c["files"]) - now["rows"] if now else 0
        for x in seen:
            emit({"event_type": "PollComplete", "shard_id": x["shard_id"], "nr_records": x["nr_records"], "behind_records": behind, "duration_ms": round(1000 * (time.time() - began))})
            emit({"event_type": "Checkpoint", "shard_id": x["shard_id"], "checkpoint": x["checkpoint"]})
        if now == at or now is None:
            break
        polls += 1
        for c in commits[: now["commits"] - first]:
            for s in c.get("reshard", {"end": []})["end"]:
                emit({"event_type": "ShardEnded", "shard_id": s})
        if now["commits"] >= first + len(commits):
            break
    emit({"event_type": "WorkerLeft", "worker_id": checkpoint_dir})
    return polls


def in_order(rows: Iterable[Row], process: Callable[[Row], None], settings: CheckpointSettings, retry: Backoff) -> None:
    """Process the records of one shard: one after the other, or ``parallelism`` at a time, those of one key in order."""

    def one(row: Row) -> None:
        delays = retry.delays(retry.retries or 0)
        for n in range(len(delays) + 1):
            try:
                return process(row)
            except Exception:
                if n == len(delays):
                    raise
                time.sleep(delays[n])

    if settings.parallelism <= 1:
        for row in rows:
            one(row)
        return
    # each thread has keys of its own; some rows of every thread at a time, so that a slow one holds back the others
    with ThreadPoolExecutor(settings.parallelism) as pool:

        def some(held: list[list[Row]]) -> None:
            for done in [pool.submit(lambda own: [one(r) for r in own], own) for own in held if own]:
                done.result()

        held: list[list[Row]] = [[] for _ in range(settings.parallelism)]
        for n, row in enumerate(rows, 1):
            held[hash(row.partition_key) % settings.parallelism].append(row)
            if n % settings.batch_size == 0:
                some(held)
                held = [[] for _ in range(settings.parallelism)]
        some(held)


def consume_records(spark: SparkSession, path: str, process: Callable[[Row], None], checkpoint_dir: str, settings: CheckpointSettings = CheckpointSettings(), polling: PollingSettings = PollingSettings(), retry: Backoff = Backoff(1, 60, 2.0, 0), **more) -> int:
    """Run a function for each record, on the executors: shards in parallel, each in order; at least once.

    A checkpoint comes after ``settings.batch_size`` records of all shards, and at the end of what there is.
    """

    def batch(records: DataFrame, number: int) -> None:
        rows = records.repartition("shard_id").sortWithinPartitions("shard_id", "sequence_number", "sub_sequence_number")

        def run(part: Iterable[Row]) -> None:
            in_order(part, process, settings, retry)

        rows.foreachPartition(run)

    return drain(spark, path, batch, checkpoint_dir, PollingSettings(batch_size=settings.batch_size, retry=polling.retry), **more)


def work(spark: SparkSession, path: str, coordinator: Coordinator, process: Callable[[DataFrame], None], now: datetime, polling: PollingSettings = PollingSettings()) -> int:
    """One cycle of a worker that shares a log with others; returns how many records it has processed.

    It takes its share of the shards that may be read, processes at most ``polling.batch_size`` records of each after its
    checkpoint, and stores the new checkpoints with the leases; a lease lost meanwhile stays as its new owner has it, who
    reads those records again. A shard that has ended and is read to its end is checkpointed as such, which lets its
    children begin.
    """
    folder = shardlog.Folder(qualified(spark, path))
    shards = folder.shards()
    listed = spark.createDataFrame([(k, s["parents"]) for k, s in shards.items()], "shard_id string, parent_shard_ids array<string>")
    held = coordinator.take(listed, now)
    coordinator.renew(now)
    end = folder.end()
    table = coordinator.repository.leases().where(F.col("lease_key").isin(*held, "")).collect()  # a row for each shard
    for r in table:
        if r.special == "LATEST":
            coordinator.checkpoint(r.lease_key, seq=end, now=now)
    known = [(r.lease_key, None, end, None) if r.special == "LATEST" else (r.lease_key, r.special, r.seq, r.sub_seq) for r in table if r.lease_key in coordinator.held and r.special != "SHARD_END"]
    if not known:
        return 0
    starts = spark.createDataFrame(known, "shard_id string, special string, seq string, sub_seq bigint")
    records = read_log(spark, path, shardIds=",".join(k for k, *_ in known), startAt=json.dumps({k: seq for k, _, seq, _ in known if seq}))
    after = checkpoints.resume(records, starts)
    position = F.struct("sequence_number", F.coalesce("sub_sequence_number", F.lit(0).cast("bigint")).alias("sub"))
    polled = checkpoints.numbered(after, "shard_id", ["sequence_number", "sub_sequence_number"], "__nr").where(F.col("__nr") <= polling.batch_size).drop("__nr")
    scratch = Scratch(spark, "poll")
    batch = scratch.cut(polled, "records")
    process(batch)
    read = {r.shard_id: r for r in batch.groupBy("shard_id").agg(F.max(position).alias("last"), F.count("*").alias("n")).collect()}  # a row for each shard
    for shard, r in sorted(read.items()):
        coordinator.checkpoint(shard, seq=r.last.sequence_number, sub_seq=r.last.sub, now=now)
    for shard, *_ in known:
        if shards[shard]["ended"] and (shard not in read or read[shard].n < polling.batch_size):
            coordinator.checkpoint(shard, special="SHARD_END", release=True, now=now)
    scratch.drop("records")
    return sum(r.n for r in read.values())


def produce(records: DataFrame, path: str, shards: int = 1) -> None:
    """Append records, each to the open shard of its key's hash unless it names one (shard_id)."""
    spark = records.sparkSession
    shardlog.register(spark)
    if "shard_id" not in records.columns:
        ends = shardlog.Folder(qualified(spark, path)).open_shards(shards)
        edges = [0, *(hi + 1 for hi, _ in ends)]
        ranges = spark.createDataFrame([(s, f"{lo:032x}", f"{hi:032x}") for lo, (hi, s) in zip(edges, ends)], "shard_id string, lo string, hi string")
        records = predict_shards(records, ranges, into="shard_id", count=len(ends))
    records.write.format("shardlog").option("shards", str(shards)).mode("append").save(qualified(spark, path))


def produce_stream(records: DataFrame, path: str, checkpoint_dir: str, shards: int = 1, sink_id: str = "stream"):
    spark = records.sparkSession
    shardlog.register(spark)
    return records.writeStream.format("shardlog").option("shards", str(shards)).option("sinkId", sink_id).option("checkpointLocation", checkpoint_dir).trigger(availableNow=True).start(qualified(spark, path))
