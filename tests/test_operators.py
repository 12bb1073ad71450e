import hashlib
import random
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from logtide.functions import wire
from logtide.operators import aggregation, assignment, batching, checkpoints, leases, metrics, produce, routing, throttle
from logtide.settings import ProducerSettings
from logtide.streaming.staging import Checkpointer


def fold(sizes, limit, most):
    out, held, count, batch = [], 0, 0, -1
    for s in sizes:
        if batch < 0 or held + s > limit or count >= most:
            batch, held, count = batch + 1, 0, 0
        held, count = held + s, count + 1
        out.append(batch)
    return out


def test_greedy_batches_against_a_loop(spark):
    rng = random.Random(1)
    rows = [(f"s{rng.randrange(3)}", i, rng.choice([1, 5, 40, 90, 130])) for i in range(3000)] + [(None, 1, 5), (None, 2, 200)]
    out = batching.greedy_batches(spark.createDataFrame(rows, "shard string, at int, size int"), "shard", ["at"], "size", 100, 7).collect()
    by = defaultdict(list)
    for r in sorted(out, key=lambda r: r["at"]):
        by[r["shard"]].append(r)
    for own in by.values():
        assert [r["batch"] for r in own] == fold([r["size"] for r in own], 100, 7)
        assert all(r["oversized"] == (r["size"] > 100) for r in own)


@pytest.mark.parametrize("n, sizes, limit, most", [(4000, (1, 5, 40, 90, 130), 100, 7), (4000, (1, 2, 3), 5000, 100_000), (300, (200,), 100, 9), (2000, (0, 1), 3, 2), (0, (1,), 1, 1)])
def test_batches_over_all_keys_against_a_loop(spark, n, sizes, limit, most):
    rng = random.Random(n + limit)
    rows = [(f"s{rng.randrange(3)}", i, rng.choice(sizes)) for i in range(n)]
    out = batching.greedy_batches(spark.createDataFrame(rows, "shard string, at int, size int").repartition(5), None, ["at"], "size", limit, most).collect()
    out.sort(key=lambda r: r["at"])
    assert [r["batch"] for r in out] == fold([r["size"] for r in out], limit, most)


def test_ranges_answer_for_every_border():
    rng = random.Random(5)
    for _ in range(300):
        sizes = [rng.choice([0, 1, 4, 9, 30]) for _ in range(rng.randint(1, 60))]
        limit, most, cut = rng.choice([20, 50, 500]), rng.choice([2, 5, 100]), rng.randint(0, 60)
        state = (-1, 0, 0)
        for part in (sizes[:cut], sizes[cut:]):
            if part:
                state = batching.after(state, batching.Range(np.array(part), limit, most).answers(), limit, most)
        assert state == batching.walk(np.array(sizes), (-1, 0, 0), limit, most)[1]


def test_plans_follow_the_settings(spark):
    rows = spark.createDataFrame([(f"k{i % 50}", bytes(900), i) for i in range(3000)], "partition_key string, data binary, position long")
    shards = routing.shard_map(spark, 4)
    plain = produce.plan(rows, rows.limit(0), shards, ProducerSettings(throttle=False, predict_shards=False)).select("predicted_shard", "release_second", "batch").distinct().collect()
    assert {(r.predicted_shard, r.release_second) for r in plain} == {(None, 0)} and len(plain) == 6
    whole = produce.plan(rows, rows.limit(0), shards, ProducerSettings(throttle=False)).groupBy("batch").agg(F.countDistinct("predicted_shard").alias("n")).collect()
    assert len(whole) == 6 and max(r.n for r in whole) == 4  # a request mixes shards
    packed = produce.plan(rows, rows.where("position < 5"), shards, ProducerSettings(aggregate=True)).collect()
    assert sum(r.records for r in packed) == 3005 and sum(r.attempt == 2 for r in packed) == 5 and len(packed) < 20
    slow = spark.createDataFrame([(r.predicted_shard, 0.1) for r in packed], "predicted_shard string, factor double").distinct()
    seconds = lambda f: produce.plan(rows, rows.limit(0), shards, factors=f).agg(F.max("release_second")).first()[0]
    assert seconds(slow) > 5 and seconds(None) == 0


def test_error_codes_and_rerouting(spark):
    rows = spark.createDataFrame([(1, i, f"k{i}", "retry" if i % 2 else "ok", "InternalFailure" if i % 2 else None, "old") for i in range(40)], "batch int, pos int, partition_key string, outcome string, error_code string, predicted_shard string")
    assert [r.pos for r in produce.error_codes(rows).collect()] == list(range(1, 20, 2))
    again = produce.rerouted(rows, routing.shard_map(spark, 8)).collect()
    assert len(again) == 20 and {r.predicted_shard for r in again} <= {f"shard-{i:03d}" for i in range(8)}


def test_a_hundred_thousand_records_stay_within_limits(spark):
    rows = spark.range(100_000).select(F.lit("s").alias("shard"), "id", (F.octet_length(F.concat(F.lit("message"), F.col("id").cast("string"))) + 36).alias("size"))
    out = batching.put_batches(rows, None, ["id"], "size").groupBy("batch").agg(F.count("*").alias("n"), F.sum("size").alias("b")).agg(F.max("n"), F.max("b"), F.count("*")).first()
    assert out[0] <= 500 and out[1] <= 5_242_880 and out[2] == 200


def test_locked_segments(spark):
    rows = spark.createDataFrame([("s", 1, "key1"), ("s", 2, "key2"), ("s", 3, "key1")], "shard string, at int, key string")
    assert [r.segment for r in batching.locked_segments(rows, "shard", "key", ["at"], 200).orderBy("at").collect()] == [0, 0, 1]


def test_locked_segments_against_a_loop(spark):
    rng = random.Random(2)
    rows = [("s", i, rng.choice("abcdefghijklmnop") if rng.random() < 0.9 else f"u{i}") for i in range(20_000)]
    want, seen, number = [], set(), 0
    for _, _, k in rows:
        if k in seen or len(seen) >= 9:
            number, seen = number + 1, set()
        seen.add(k)
        want.append(number)
    out = batching.locked_segments(spark.createDataFrame(rows, "shard string, at int, key string"), "shard", "key", ["at"], 9)
    assert [r.segment for r in out.orderBy("at").collect()] == want


def test_codec_round_trip():
    data = aggregation.encode(["key1", "ké"], [(0, b"this is the payload"), (1, b""), (0, bytes(300))], ["0", "0", "0"])
    keys, hashed, entries = aggregation.decode(data)
    assert keys == ["key1", "ké"] and hashed == ["0"] * 3 and [(k, b) for k, _, b, _ in entries] == [(0, b"this is the payload"), (1, b""), (0, bytes(300))]
    assert data[:4].hex() == "f3899ac2"
    with pytest.raises(aggregation.CorruptRecord):
        aggregation.decode(data[:-1] + bytes([data[-1] ^ 1]))


def test_codec_agrees_with_protobuf():
    descriptor_pb2 = pytest.importorskip("google.protobuf.descriptor_pb2")
    from google.protobuf import descriptor_pool, message_factory

    f = descriptor_pb2.FileDescriptorProto(name="m.proto", package="t", syntax="proto2")
    kinds = {"tag": [("key", 1, 2, 9, ""), ("value", 2, 1, 9, "")], "rec": [("k", 1, 2, 4, ""), ("h", 2, 1, 4, ""), ("data", 3, 2, 12, ""), ("tags", 4, 3, 11, ".t.tag")], "agg": [("keys", 1, 3, 9, ""), ("hashes", 2, 3, 9, ""), ("records", 3, 3, 11, ".t.rec")]}
    for name, fields in kinds.items():
        m = f.message_type.add(name=name)
        for n, i, label, kind, of in fields:
            m.field.add(name=n, number=i, label=label, type=kind, **({"type_name": of} if of else {}))
    pool = descriptor_pool.DescriptorPool()
    pool.Add(f)
    agg = message_factory.GetMessageClass(pool.FindMessageTypeByName("t.agg"))()
    agg.keys.append("a")
    agg.hashes.append("0")
    r = agg.records.add(k=0, h=0, data=b"x" * 200)
    r.tags.add(key="t")
    body = agg.SerializeToString()
    import hashlib

    keys, hashes, entries = aggregation.decode(bytes.fromhex("f3899ac2") + body + hashlib.md5(body).digest())
    assert (keys, hashes, entries) == (["a"], ["0"], [(0, 0, b"x" * 200, [("t", None)])])
    own = aggregation.encode(["a"], [(0, b"x" * 200)], ["0"])
    parsed = type(agg).FromString(own[4:-16])
    assert parsed.records[0].data == b"x" * 200 and not parsed.records[0].HasField("h")


def plain_rows(values):
    """What ``Decoded`` should find, by the codec of single records."""
    rows, corrupt = [], []
    for i, v in enumerate(values):
        if v is None or v[:4].hex() != "f3899ac2":
            continue
        try:
            keys, hashed, entries = aggregation.decode(v)
        except aggregation.CorruptRecord:
            corrupt.append(i)
            continue
        rows += [(i, n, keys[k], hashed[h] if h is not None else None, b) for n, (k, h, b, _) in enumerate(entries)]
    return rows, corrupt


def decoded_rows(values):
    d = wire.Decoded(pa.array(values, pa.binary()))
    keys, hashes = d.keys.to_pylist(), d.hashes.to_pylist()
    return [(int(r), int(n), keys[k], hashes[h] if h >= 0 else None, b) for r, n, k, h, b in zip(d.row, d.place, d.key, d.hash, d.body.to_pylist())], np.flatnonzero(d.corrupt).tolist()


def sealed(message):
    return bytes.fromhex("f3899ac2") + message + hashlib.md5(message).digest()


@pytest.mark.parametrize("seed", range(6))
def test_many_records_decode_as_single_ones(seed):
    rng = random.Random(seed)
    values = [None, b"", b"\xf3\x89", b"plain", sealed(b""), sealed(b"\x0a"), sealed(b"\x1a\x02\x08\x00"), sealed(b"\x0a\x01a\x1a\x02\x08\x05"), sealed(b"\x0a\x01a\x1a\x03\x08\x00\x1a"), sealed(b"\x0d1234"), sealed(b"\x80" * 12), sealed(b"\x08\x01"), sealed(b"\x0a\xff\xff\xff\xff\xff\xff\xff\xff\x7f")]
    for _ in range(40):
        keys = [rng.choice("abé漢") * rng.randint(0, 40) + str(i) for i in range(rng.randint(1, 30))]
        entries = [(rng.randrange(len(keys)), rng.randbytes(rng.choice([0, 1, 5, 127, 128, 300, 20_000 if rng.random() < 0.02 else 9]))) for _ in range(rng.choice([0, 1, 3, 700]))]
        hashed = ["0", "77"]
        v = aggregation.encode(keys, entries, hashed, [rng.choice([None, 0, 1]) for _ in entries])
        if rng.random() < 0.2:  # damage below an intact checksum
            m = bytearray(v[4:-16])
            m[rng.randrange(len(m))] ^= 1 << rng.randrange(8)
            v = sealed(bytes(m))
        values.append(v if rng.random() < 0.95 else v[:-1] + b"?")
    rng.shuffle(values)
    want = plain_rows(values)
    assert decoded_rows(values) == want and len(want[0]) > 1000


def test_many_records_encode_as_single_ones():
    rng = random.Random(8)
    lists = [[(rng.choice(["k", "ké", "x" * 200, "", str(rng.random())]), rng.randbytes(rng.choice([0, 1, 60, 127, 128, 17_000]))) for _ in range(rng.choice([0, 1, 2, 200]))] for _ in range(50)]
    got = wire.encoded(np.array([len(x) for x in lists]), pa.array([k for x in lists for k, _ in x], pa.string()), pa.array([b for x in lists for _, b in x], pa.binary())).to_pylist()
    for entries, value in zip(lists, got):
        table = {}
        packed = [(table.setdefault(k, len(table)), b) for k, b in entries]
        assert value == aggregation.encode(list(table), packed, ["0"] * len(packed))


def test_corrupt_records_fail_or_pass(spark):
    good = aggregation.encode(["a"], [(0, b"1"), (0, b"2")])
    rows = spark.createDataFrame([("x", good, "p", None), ("x", good[:-1] + b"!", "p", None), ("x", b"plain", "p", None), ("x", None, "p", None)], "shard_id string, data binary, partition_key string, explicit_hash_key string")
    out = aggregation.deaggregate(rows, "passthrough").collect()
    assert [(r.aggregated, r.sub_sequence_number) for r in out] == [(True, 0), (True, 1), (False, None), (False, None), (False, None)]
    with pytest.raises(Exception, match="checksum"):
        aggregation.deaggregate(rows).collect()


def shards(spark, rows):
    return spark.createDataFrame(rows, "shard_id string, parent_shard_ids array<string>")


def table(spark, rows):
    return spark.createDataFrame(rows, "lease_key string, special string")


@pytest.mark.parametrize(
    "held, listed, want",
    [
        ([], "123", {"1", "2"}), ([("1", None), ("2", None)], "123", {"1", "2"}), ([("1", "SHARD_END"), ("2", None)], "123", {"2"}),
        ([("1", "SHARD_END"), ("2", "SHARD_END")], "123", {"3"}), ([("1", "SHARD_END"), ("2", "SHARD_END"), ("3", "SHARD_END")], "123", set()), ([], "3", {"3"}), ([("3", None)], "13", {"1"}),
    ],
)
def test_shards_ready(spark, held, listed, want):
    all_shards = {"1": [], "2": [], "3": ["1", "2"]}
    out = leases.shards_ready(shards(spark, [(s, all_shards[s]) for s in listed]), table(spark, held))
    assert {r.shard_id for r in out.collect()} == want


def test_initial_checkpoints(spark):
    s = shards(spark, [("1", []), ("3", ["1", "2"])])
    out = lambda held, start: {r.shard_id: r.initial_checkpoint for r in leases.initial_checkpoints(s, table(spark, held), start).collect()}
    assert out([], "LATEST") == {"1": "LATEST", "3": "LATEST"}
    assert out([("1", None)], "LATEST")["3"] == "TRIM_HORIZON" and out([("2", "SHARD_END")], "LATEST")["3"] == "TRIM_HORIZON"
    assert set(out([("1", None)], "TRIM_HORIZON").values()) == {"TRIM_HORIZON"}


def test_balanced_assignment_properties(spark):
    rng = random.Random(4)
    for _ in range(6):
        n, workers = rng.randint(1, 80), rng.randint(1, 12)
        expired = {w for w in range(workers) if rng.random() < 0.2} - {0}
        rows = []
        for i in range(n):
            w = rng.randrange(workers)
            rows.append((f"l{i}", None, False) if rng.random() < 0.2 else (f"l{i}", f"w{w}", w in expired))
        infos = spark.createDataFrame(rows, "lease_key string, owner string, is_expired boolean")
        got = {r.lease_key for r in assignment.balanced(infos, "w0").collect()}
        active = {o for _, o, e in rows if o and not e} | {"w0"}
        least, rest = divmod(n, len(active))
        own = {k for k, o, _ in rows if o == "w0"}
        free = {k for k, o, e in rows if o != "w0" and (o is None or e)}
        assert min(least, n) <= len(got) <= least + rest
        assert own <= got or len(own) > least and len(got & own) >= least and not got - own - free
        assert free <= got or not got - own - free


def test_throttle_factor_golden(spark):
    rows = spark.createDataFrame([("a", 0, 100, 100), ("a", 1, 100, 100), ("b", 0, 0, 0)], "shard_id string, period int, successes long, failures long")
    out = {(r.shard_id, r.period): round(r.factor, 6) for r in throttle.throughput_factors(rows, allowed_error=0.1).collect()}
    assert out == {("a", 0): 0.6, ("a", 1): 0.4, ("b", 0): 1.0}


def run(*events):
    c = Checkpointer()
    return [w for w in (c.step(*(e if isinstance(e, tuple) else (e, None))) for e in events) if w]


@pytest.mark.parametrize(
    "events, want",
    [
        ([("stage", 0), ("stage", 1), "checkpoint"], ["1"]),
        ([("stage", 0), "checkpoint", "checkpoint"], ["0"]),
        ([("stage", 0), "refused", "checkpoint"], ["0"]),
        ([("stage", 0), "checkpoint", ("stage", 1), "checkpoint"], ["0", "1"]),
        ([("stage", 0), ("stage", 1), ("seen", 1), "end", "checkpoint"], ["SHARD_END"]),
        ([("stage", 1), ("seen", 1), "checkpoint", "end", "release"], ["1", "SHARD_END"]),
        ([("stage", 0), ("seen", 1), "end", "checkpoint"], ["0"]),
        (["end", "release"], ["SHARD_END"]),
        (["release"], ["RELEASE"]),
    ],
)
def test_staging_rules(events, want):
    assert run(*events) == want


def test_conditional_updates(spark):
    current = spark.createDataFrame([("a", "w1", 3, None, "7", 0), ("b", "w1", 5, None, "7", 0)], "lease_key string, owner string, counter long, special string, seq string, sub_seq long")
    changes = spark.createDataFrame([("a", "claim", 3, "w2", None, None, None), ("b", "renew", 4, None, None, None, None), ("c", "create", None, "w2", "LATEST", None, None)], "lease_key string, action string, expected_counter long, new_owner string, new_special string, new_seq string, new_sub_seq long")
    out = {r.lease_key: (r.owner, r.counter, r.outcome) for r in leases.conditional_update(current, changes).collect()}
    assert out == {"a": ("w2", 4, "done"), "b": ("w1", 5, "conflict"), "c": ("w2", 0, "done")}


def test_metrics_merge(spark):
    parts = spark.createDataFrame([(0, 5, 2), (1, 5, 3), (1, 6, 1)], "period int, latency_ms int, n int")
    assert {(r.latency_ms, r.n) for r in metrics.merge_histograms(parts, [], "latency_ms").collect()} == {(5, 5), (6, 1)}


def test_chunks(spark):
    rows = spark.createDataFrame([(1, "ok"), (1, "ok"), (2, "ok"), (2, "retry"), (3, "failed"), (3, "ok")], "chunk_id int, outcome string")
    assert {r.chunk_id: r.state for r in produce.chunk_completion(rows).collect()} == {1: "complete", 2: "pending", 3: "failed"}


def test_tasks_of_responses_do_not_grow(spark, sf_dir, monkeypatch):
    from logtide.plans import producing

    monkeypatch.setattr(produce, "PART_ROWS", 500, raising=False)
    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()
    out = producing.chunk_completion(spark, sf_dir)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count(f", {-(-rows // 500)}), REPARTITION_BY_NUM") == 3 and "ENSURE_REQUIREMENTS" not in plan
    assert out.agg(F.sum("entries")).first()[0] == spark.read.parquet(f"{sf_dir}/lineitem.parquet").select("l_orderkey", "l_linenumber").distinct().count()


def test_resume_inside_an_aggregate(spark):
    rows = spark.createDataFrame([("s", f"{1:040d}", i) for i in range(10)], "shard_id string, sequence_number string, sub_sequence_number long")
    held = spark.createDataFrame([("s", None, f"{1:040d}", 4)], "shard_id string, special string, seq string, sub_seq long")
    assert sorted(r.sub_sequence_number for r in checkpoints.resume(rows, held).collect()) == [5, 6, 7, 8, 9]
