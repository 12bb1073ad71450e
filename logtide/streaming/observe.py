"""What runs beside a stream: diagnostics, metrics, futures, generated load, processors for tests."""

from __future__ import annotations

import threading
import time
from collections.abc import Callable, Iterable
from concurrent.futures import Future, ThreadPoolExecutor

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener

from logtide.operators import metrics
from logtide.settings import ProducerSettings
from logtide.streaming import consume


class Diagnostics(StreamingQueryListener):
    """Hands an event (a dict with ``event_type``) of each start, poll and end of a query to a function."""

    def __init__(self, emit: Callable[[dict], None]):
        self.emit = emit

    def onQueryStarted(self, event) -> None:
        self.emit({"event_type": "WorkerJoined", "worker_id": str(event.runId), "ts": event.timestamp})

    def onQueryProgress(self, event) -> None:
        p = event.progress
        self.emit({"event_type": "PollComplete", "worker_id": str(p.runId), "ts": p.timestamp, "nr_records": p.numInputRows, "duration_ms": p.batchDuration})

    def onQueryIdle(self, event) -> None:
        self.emit({"event_type": "PollComplete", "worker_id": str(event.runId), "ts": event.timestamp, "nr_records": 0, "duration_ms": 0})

    def onQueryTerminated(self, event) -> None:
        self.emit({"event_type": "WorkerLeft", "worker_id": str(event.runId), "error": event.exception})


class Client:
    """Consume and produce with futures."""

    def __init__(self, spark: SparkSession, path: str, shards: int = 1, collect: Callable[[dict], None] | None = None, settings: ProducerSettings = ProducerSettings()):
        self.spark, self.path, self.shards, self.collect, self.settings = spark, path, shards, collect, settings
        self.pool = ThreadPoolExecutor(4)

    def _write(self, records: DataFrame) -> int:
        # a thread of its own has no active session, where formats are looked up
        SparkSession._get_j_spark_session_class(self.spark._jvm).setActiveSession(self.spark._jsparkSession)
        began = time.time()
        n, key_bytes, data_bytes = records.agg(F.count("*"), F.sum(F.octet_length("partition_key")), F.sum(F.octet_length("data"))).first()
        delays = self.settings.backoff.delays(1 + (self.settings.backoff.retries or 0))
        attempts, failed = 0, 0
        while n:
            attempts += 1
            try:
                consume.produce(records, self.path, self.shards)
                break
            except Exception:
                failed += 1
                if attempts >= len(delays):
                    raise
                time.sleep(delays[attempts - 1])
        if self.collect:
            spent = time.time() - began
            row = [(n, failed, max(attempts, 1), round(1000 * spent), key_bytes or 0 if n else 0, data_bytes or 0 if n else 0, False)]
            made = self.spark.createDataFrame(row, "published bigint, failed bigint, attempts bigint, latency_ms bigint, record_bytes bigint, payload_bytes bigint, shard_mismatch boolean")
            self.collect(metrics.producer_metrics(made, [], max(1, round(1000 * spent))).first().asDict() | {"interval_ms": round(1000 * spent)})
        return n

    def produce(self, records: DataFrame) -> Future:
        """Write records, again after a failure as the settings say; the future has how many. The collector, if any, gets the metrics row of the write."""
        return self.pool.submit(self._write, records)

    def produce_many(self, chunks: Iterable[DataFrame]) -> list[Future]:
        """A future for each chunk, in order."""
        return [self.produce(c) for c in chunks]

    def consume_with(self, process: Callable[[DataFrame, int], None], checkpoint_dir: str) -> Future:
        query = consume.consume_with(consume.stream_log(self.spark, self.path), process, checkpoint_dir)
        return self.pool.submit(query.awaitTermination)

    def consume_records(self, process: Callable[[Row], None], checkpoint_dir: str, **more) -> Future:
        """As ``consume.consume_records``; the future has the number of polls."""

        def run() -> int:
            SparkSession._get_j_spark_session_class(self.spark._jvm).setActiveSession(self.spark._jsparkSession)
            return consume.consume_records(self.spark, self.path, process, checkpoint_dir, **more)

        return self.pool.submit(run)

    def close(self) -> None:
        self.pool.shutdown()


def load(spark: SparkSession, n: int, size: int, seed: str = "") -> DataFrame:
    """n records with keys like random ones and values of ``size`` bytes 0x01."""
    key = F.md5(F.concat(F.lit(seed), F.col("id").cast("string")).cast("binary"))
    return spark.range(n).select(key.alias("partition_key"), F.unhex(F.repeat(F.lit("01"), size)).alias("data"))


class Collector:
    """A micro-batch function that keeps what it has seen, says when ``expected`` distinct values are there, or fails on a predicate."""

    def __init__(self, column: str = "data", expected: int | None = None, fail: Callable[[bytes], bool] | None = None):
        self.column, self.expected, self.fail = column, expected, fail
        self.seen: list = []
        self.complete = threading.Event()

    def __call__(self, batch: DataFrame, number: int) -> None:
        values = [r[0] for r in batch.select(self.column).collect()]  # for tests: batches are small
        if self.fail:
            for v in values:
                if self.fail(v):
                    raise RuntimeError(f"refused {v!r}")
        self.seen += values
        if self.expected is not None and len(set(map(bytes, self.seen))) >= self.expected:
            self.complete.set()
