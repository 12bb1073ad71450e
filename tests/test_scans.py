"""Recurrences over ranges against loops."""

import bisect
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from logtide.operators import batching, checkpoints, metrics, routing, scans, throttle


@pytest.mark.parametrize("n, keys, most", [(3000, 1, 9), (3000, 3, 200), (500, 2, 1), (4000, 1, 100_000), (1, 1, 5), (0, 1, 5)])
def test_segments_against_a_loop(spark, n, keys, most):
    rng = random.Random(n + most)
    rows = [(None if keys > 1 and (s := rng.randrange(keys)) == 0 else f"s{keys and rng.randrange(keys)}", i, rng.choice(["a", "b", None, f"u{i}", f"u{i}", f"u{i}", f"v{i // 3}"])) for i in range(n)]
    want = {}
    state = {}
    for s, i, k in rows:
        number, seen = state.get(s, (0, set()))
        if k in seen or len(seen) >= most:
            number, seen = number + 1, set()
        seen.add(k)
        state[s] = number, seen
        want[i] = number
    out = batching.locked_segments(spark.createDataFrame(rows, "shard string, at int, key string").repartition(3), "shard", "key", ["at"], most)
    assert out.columns == ["shard", "at", "key", "segment"] and {r["at"]: r.segment for r in out.collect()} == want


def test_one_shard_lies_in_many_tasks(spark):
    rows = spark.range(5000).select(F.lit("s").alias("shard"), F.col("id").alias("at"), (F.col("id") % 50).cast("string").alias("key"))
    out = batching.locked_segments(rows, "shard", "key", ["at"], 1000)
    assert out.select(F.spark_partition_id().alias("p")).distinct().count() == 4
    assert out.where(F.col("segment") != F.floor(F.col("at") / 50)).count() == 0
    counts = rows.select("shard", F.col("at").alias("period"), (F.col("at") % 7).alias("successes"), (F.col("at") % 3).alias("failures"))
    assert throttle.throughput_factors(counts, "shard").select(F.spark_partition_id().alias("p")).distinct().count() == 4


def test_factors_against_a_loop(spark):
    rng = random.Random(4)
    rows = [(f"s{k}", p, *rng.choice([(0, 0), (9, 1), (1, 9), (0, 5), (7, 0)])) for k in range(3) for p in range(700)]
    want = {}
    for s, p, good, bad in rows:
        r = min(1.0, (want[s, p - 1] if p else 1.0) * (good / (good + bad) if good + bad else 1.0) + 0.05)
        want[s, p] = r
    out = throttle.throughput_factors(spark.createDataFrame(rows, "shard_id string, period int, successes long, failures long").repartition(5))
    assert {(r.shard_id, r.period): r.factor for r in out.collect()} == pytest.approx(want, abs=1e-12)


def test_buckets_against_a_loop(spark):
    rng = random.Random(6)
    rows, at = [], 0.0
    for i in range(2500):
        at += rng.choice([0, 0, 0.001, 0.01, 3.0 if rng.random() < 0.02 else 0])
        rows.append((f"s{rng.randrange(2)}", i, at, rng.choice([10, 200, 900, 5000 if rng.random() < 0.01 else 50])))
    rates = {"records": (100.0, 20.0), "bytes": (20_000.0, 2000.0)}
    want, state = {}, {}
    for s, i, a, size in rows:
        tokens, clock = state.get(s, ({"records": 20.0, "bytes": 2000.0}, 0.0))
        need = {"records": 1, "bytes": size}
        # the first instant, not before the request nor the one ahead, at which every bucket has what it needs, or all it can hold
        time = max(a, clock)
        for x, (rate, most) in rates.items():
            lack = min(need[x], most) - tokens[x]
            time = max(time, clock + lack / rate)
        for x, (rate, most) in rates.items():
            tokens[x] = min(most, tokens[x] + (time - clock) * rate) - need[x]
        state[s] = tokens, time
        want[i] = time
    out = throttle.release_times(spark.createDataFrame(rows, "shard string, at int, arrival double, size int").repartition(4), "shard", ["at"], "arrival", "size", *rates.values()).collect()
    assert {r["at"]: r.release_time for r in out} == pytest.approx(want, abs=1e-6)
    assert sum(r.release_time > r.arrival + 1e-9 for r in out) > 500 and sum(r.release_time <= r.arrival + 1e-9 for r in out) > 50


def test_asof_against_a_search(spark):
    rng = random.Random(7)
    right = sorted({(rng.choice([None, "a", "b"]), rng.randrange(2000)) for _ in range(300)}, key=lambda x: (x[0] or "", x[1]))
    right = [(k, on, f"{k}{on}" if on % 5 else None) for k, on in right]
    left = [(rng.choice([None, "a", "b", "c"]), rng.choice([None, *range(2000)]) if rng.random() < 0.1 else rng.randrange(2000), i) for i in range(3000)]
    out = scans.asof(spark.createDataFrame(left, "k string, on int, i int").repartition(3), spark.createDataFrame(right, "k string, on int, name string"), ["k"], "on", ["name"])
    by = {}
    for k, on, name in right:
        by.setdefault(k, []).append((on, name))
    want = {}
    for k, on, i in left:
        own = by.get(k, []) if k is not None and on is not None else []
        at = bisect.bisect_right([x[0] for x in own], on) - 1 if own else -1
        want[i] = own[at][1] if at >= 0 else None
    assert {r.i: r.name for r in out.collect()} == want and out.columns == ["k", "on", "i", "name"]
    none = scans.asof(spark.createDataFrame(left, "k string, on int, i int"), spark.createDataFrame([], "k string, on int, name string"), [], "on", ["name"])
    assert none.count() == 3000 and none.where("name is not null").count() == 0


@pytest.mark.parametrize("direct", [64, 2])
def test_records_follow_the_map_of_their_time(spark, monkeypatch, direct):
    monkeypatch.setattr(routing, "EPOCHS", direct)
    rng = random.Random(11)
    maps, known = [], []
    for day, n in ((10, 2), (20, 700), (30, 5), (40, 1)):
        edges = sorted({0, 1 << 128, *(rng.randrange(1 << 128) if n != 5 else i * 3 for i in range(n - 1))})
        own = [(day, f"m{day}-{i}", f"{a:032x}", f"{b - 1:032x}") for i, (a, b) in enumerate(zip(edges, edges[1:]))]
        known.append((day, own[1:] if n == 5 else own))  # a map with a gap
        maps += known[-1][1]
    rows = [(f"k{i}", rng.choice([None, *range(5, 50)])) for i in range(2000)]

    def plain(key, at):
        own = [m for day, m in known if at is not None and day <= at]
        h = hashlib.md5(key.encode()).hexdigest()
        return next((s for _, s, lo, hi in own[-1] if lo <= h <= hi), None) if own else None

    out = routing.route_at(spark.createDataFrame(rows, "partition_key string, at int"), spark.createDataFrame(maps, "valid_from int, shard_id string, lo string, hi string"), "at")
    assert {r.partition_key: r.predicted_shard for r in out.collect()} == {k: plain(k, at) for k, at in rows} and out.columns == ["partition_key", "at", "predicted_shard"]


def test_narrow_shards_in_large_maps(spark):
    rows = spark.range(300).select(F.col("id").cast("string").alias("partition_key"))
    for n in (1, 300, 5000):
        got = {r.partition_key: r.predicted_shard for r in routing.predict_shards(rows, routing.shard_map(spark, n)).collect()}
        assert got == {k: f"shard-{int(hashlib.md5(k.encode()).hexdigest(), 16) * n >> 128:03d}" for k in map(str, range(300))}


def test_checkpoints_by_count_or_interval(spark):
    rng = random.Random(12)
    rows, at, want, state = [], 0.0, {}, {}
    for i in range(2500):
        at += rng.choice([0, 0.125, 0.5, 40.0 if rng.random() < 0.05 else 0.25])
        s = f"s{rng.randrange(2)}"
        rows.append((s, i, at))
        number, first, count = state.get(s, (0, at, 0))
        if count == 7 or at >= first + 2.0:
            number, first, count = number + 1, at, 0
        state[s] = number, first, count + 1
        want[i] = number
    out = checkpoints.batched_or_timed(spark.createDataFrame(rows, "shard string, i int, at double").repartition(3), "shard", ["at", "i"], "at", 7, 2.0)
    assert {r.i: r.checkpoint_nr for r in out.collect()} == want


@pytest.mark.parametrize("digits", [2, 3, 5])
def test_buckets_keep_their_digits(spark, digits):
    rng = random.Random(digits)
    values = [0, 1, 99, 10**digits, 10**18] + [int(10 ** rng.uniform(0, 18)) for _ in range(3000)]
    rows = spark.createDataFrame([(i % 3, v) for i, v in enumerate(values)], "part int, value long")
    pairs = rows.select("value", metrics.bucket(F.col("value"), digits).alias("b")).collect()
    assert all(r.b <= r.value and r.value - r.b <= r.value / 10**digits and (r.value >= 10**digits or r.b == r.value) for r in pairs)
    whole = metrics.digit_histogram(rows, [], "value", digits)
    merged = metrics.merge_histograms(metrics.digit_histogram(rows, ["part"], "value", digits), [], "bucket")
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, merged.collect()))
    got = metrics.histogram_quantiles(whole, [], {"p50": 0.5, "p99": 0.99}).first()
    exact = sorted(values)
    for name, share in (("p50", 0.5), ("p99", 0.99)):
        v = exact[-(-int(len(values) * share * 1000) // 1000) - 1]
        assert abs(got[name] - v) <= v / 10**digits * 2 + 1


def test_a_stream_delivers_once_with_a_position_for_each_shard(spark, tmp_path):
    from logtide.streaming import once

    schema = "shard_id string, sequence_number string, sub_sequence_number long, n int"
    row = lambda s, i: (s, f"{i // 3:040d}", i % 3 if s == "a" else None, i)
    parts = [[row("a", i) for i in range(30)], [row("a", i) for i in range(12, 50)] + [row("b", 3 * i) for i in range(20)] * 2, [row("b", 3 * i) for i in range(5, 25)] + [row("a", 49)]]
    for rows in parts:
        spark.createDataFrame(rows, schema).repartition(3).write.mode("append").parquet(str(tmp_path / "in"))
        out = once.deliver_once(spark.readStream.schema(schema).parquet(str(tmp_path / "in")))
        q = out.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
        q.awaitTermination()
        held = [p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress if p["stateOperators"]]
    got = sorted((r.shard_id, r.n) for r in spark.read.schema(schema).parquet(str(tmp_path / "out")).collect())
    assert got == sorted([("a", i) for i in range(50)] + [("b", 3 * i) for i in range(25)]) and held[-1] == 2


def test_release_seconds_against_a_loop(spark):
    rng = random.Random(12)
    rows = [(rng.choice(["a", "b", None]), i, rng.choice([0, 10, 400, 5000])) for i in range(3000)]
    factors = {"a": 0.5, "b": 1.0}
    want, sums = {}, {}
    for s, i, size in rows:
        n, held = sums.get(s, (0, 0))
        r = factors.get(s, 1.0)
        want[i] = max(int(n / r // 50), int(held / r // 20_000))
        sums[s] = (n + 1, held + size)
    table = spark.createDataFrame(rows, "shard string, at int, size int").repartition(5)
    out = throttle.release_seconds(table, "shard", ["at"], "size", 50, 20_000, spark.createDataFrame(list(factors.items()), "shard string, factor double"))
    assert out.columns == ["shard", "at", "size", "release_second"] and {r["at"]: r.release_second for r in out.collect()} == want
    one = throttle.release_seconds(table.withColumn("shard", F.lit("s")), "shard", ["at"], "size", 50, 20_000)
    assert one.select(F.spark_partition_id().alias("p")).distinct().count() == 4
    assert throttle.release_seconds(table.limit(0), "shard", ["at"], "size", 50, 20_000).count() == 0


def test_factors_bring_no_shard_to_one_task(spark):
    table = spark.range(10).select(F.lit("s").alias("shard"), F.col("id").alias("at"), F.lit(1).alias("size"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "256k")  # as a list of factors has no known size
    try:
        out = throttle.release_seconds(table, "shard", ["at"], "size", 2, 20_000, spark.createDataFrame([("s", 0.5)], "shard string, factor double"))
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" not in plan and "hashpartitioning" not in plan
    assert [r.release_second for r in out.orderBy("at").collect()] == list(range(10))
