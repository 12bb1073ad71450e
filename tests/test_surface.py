from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from logtide.operators.strategies import Balanced, Coordinator, LeaseTable, Manual, checkpoint_plan
from logtide.settings import Backoff, CheckpointSettings, LeaseSettings, PollingSettings, ProducerSettings
from logtide.streaming import observe


def test_settings():
    with pytest.raises(ValueError):
        ProducerSettings(aggregate=True, predict_shards=False, throttle=False)
    with pytest.raises(ValueError):
        ProducerSettings(predict_shards=False)
    assert Backoff(0.1, 1, 2.0, 10).delays(99) == [0.1, 0.2, 0.4, 0.8] + [1] * 7
    assert PollingSettings().trigger(False) == {"availableNow": True} and PollingSettings(interval_s=2).trigger(True) == {"processingTime": "2 seconds"}
    with pytest.raises(ValueError):
        LeaseSettings(renew_interval_s=10)


def test_strategies(spark):
    now = F.lit("2024-01-01").cast("timestamp_ntz")
    table = spark.createDataFrame([("a", "w2"), ("b", "w2"), ("c", None)], "lease_key string, owner string").withColumn("last_updated", now)
    shards = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "shard_id string")
    got = {r.shard_id for r in Balanced(now).desired(table, shards, "w1").collect()}
    assert got == {"c", "d"}
    assert {r.shard_id for r in Manual(["a", "x"]).desired(table, shards, "w1").collect()} == {"a"}


def test_checkpoint_plans(spark):
    rows = spark.createDataFrame([("s", i, k) for i, k in enumerate("abcabd")], "shard string, at int, key string")
    count = lambda **x: [r.last_position for r in checkpoint_plan(rows, "shard", "key", ["at"], CheckpointSettings(**x)).orderBy("checkpoint_nr").collect()]
    assert count(batch_size=4) == [4, 6] and count(one_key_at_a_time=True) == [3, 6]


def test_lease_table(spark, tmp_path):
    schema = "lease_key string, action string, expected_counter long, new_owner string, new_special string, new_seq string, new_sub_seq long"
    change = lambda t, *c: {r.lease_key: r.outcome for r in t.update(spark.createDataFrame([c], schema)).collect()}
    t = LeaseTable(spark, str(tmp_path / "leases"))
    assert change(t, "a", "create", None, "w1", "TRIM_HORIZON", None, None) == {"a": "done"}
    assert change(t, "a", "create", None, "w2", "TRIM_HORIZON", None, None) == {"a": "conflict"}
    assert change(t, "a", "checkpoint", 0, None, None, "17", 3) == {"a": "done"}
    assert change(t, "a", "claim", 0, "w2", None, None, None) == {"a": "conflict"}
    again = LeaseTable(spark, str(tmp_path / "leases"))
    assert [tuple(r) for r in again.leases().collect()] == [("a", "w1", 1, None, "17", 3)]


def test_two_writers_of_a_lease_table(spark, tmp_path):
    schema = "lease_key string, action string, expected_counter long, new_owner string, new_special string, new_seq string, new_sub_seq long"
    one, other = (LeaseTable(spark, str(tmp_path / "leases")) for _ in range(2))
    one.update(spark.createDataFrame([("a", "create", None, "w0", "LATEST", None, None)], schema)).collect()

    def claim(t, worker):
        return t.update(spark.createDataFrame([("a", "claim", 0, worker, None, None, None)], schema)).collect()[0].outcome

    with ThreadPoolExecutor(2) as pool:
        outcomes = sorted(pool.map(claim, (one, other), ("w1", "w2")))
    assert outcomes == ["conflict", "done"] and [r.counter for r in one.leases().collect()] == [1]


def test_coordinators_share_and_hand_over(spark, tmp_path):
    table, events = LeaseTable(spark, str(tmp_path / "leases")), []
    shards = spark.createDataFrame([("a", []), ("b", []), ("c", ["a"])], "shard_id string, parent_shard_ids array<string>")
    now = datetime(2024, 1, 1)
    later = lambda s: now + timedelta(seconds=s)
    one, two = (Coordinator(table, w, emit=lambda e, w=w: events.append((w, e["event_type"], e.get("shard_id")))) for w in ("w1", "w2"))
    assert one.take(shards, now) == {"a", "b"}  # a child waits for its parent
    one.renew(later(4))
    assert two.take(shards, later(5)) == set() or len(two.held) == 1
    one.refresh(later(6))
    assert set(one.held) | set(two.held) == {"a", "b"} and not set(one.held) & set(two.held)
    holder = one if "a" in one.held else two
    holder.checkpoint("a", special="SHARD_END", release=True, now=later(7))
    assert ("w1" if holder is one else "w2", "ShardEnded", "a") in events
    assert "c" in one.take(shards, later(8)) | two.take(shards, later(8))
    two.refresh(later(9))
    one.release()
    assert not one.held and any(e[:2] == ("w1", "LeaseReleased") for e in events)
    three = Coordinator(table, "w3")
    three.refresh(later(10))
    assert three.take(shards, later(60)) >= {"b"} - set(two.held)  # what has expired or is free


def test_futures_and_collector(spark, tmp_path):
    got = []
    client = observe.Client(spark, str(tmp_path / "log"), 2, got.append)
    assert client.produce(observe.load(spark, 30, 14)).result() == 30 and client.produce(observe.load(spark, 0, 14)).result() == 0
    assert [g["published"] for g in got] == [30, 0] and got[0]["success_rate"] == 1.0 and got[0]["max_attempts"] == 1
    assert [f.result() for f in client.produce_many([observe.load(spark, 3, 2, "m"), observe.load(spark, 4, 2, "n")])] == [3, 4]
    seen = observe.Collector("data", expected=2)
    client.consume_with(seen, str(tmp_path / "state")).result()
    assert len(seen.seen) == 37 and set(map(bytes, seen.seen)) == {b"\1" * 14, b"\1\1"} and seen.complete.is_set()
    failing = observe.Collector(fail=lambda v: True)
    with pytest.raises(Exception, match="refused"):
        client.consume_with(failing, str(tmp_path / "other")).result()
    client.close()
