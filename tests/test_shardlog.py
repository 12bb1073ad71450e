import hashlib
import json
import uuid
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, GreaterThan, GreaterThanOrEqual, In, LessThanOrEqual

from logtide.operators.strategies import Coordinator, LeaseTable
from logtide.settings import Backoff, CheckpointSettings, PollingSettings
from logtide.sources import shardlog
from logtide.streaming import consume, staging


def records(spark, first, n):
    return spark.range(first, first + n).select(F.concat(F.lit("key"), F.col("id").cast("string")).alias("partition_key"), F.concat(F.lit("msg"), F.col("id").cast("string")).cast("binary").alias("data"))


def test_round_trip_in_order(spark, tmp_path):
    path = str(tmp_path / "log")
    consume.produce(records(spark, 0, 50), path, 2)
    consume.produce(records(spark, 50, 50), path, 2)
    back = consume.read_log(spark, path).collect()
    assert sorted(bytes(r.data).decode() for r in back) == sorted(f"msg{i}" for i in range(100))
    assert {r.shard_id for r in back} == {"shard-000", "shard-001"}
    assert len({(r.shard_id, r.sequence_number) for r in back}) == 100
    late = [r.sequence_number for r in back if int(bytes(r.data)[3:]) >= 50 and r.shard_id == "shard-000"]
    early = [r.sequence_number for r in back if int(bytes(r.data)[3:]) < 50 and r.shard_id == "shard-000"]
    assert max(early) < min(late)
    assert consume.read_log_from(spark, path, "LATEST").count() == 0


def test_empty_log(spark, tmp_path):
    assert consume.read_log(spark, str(tmp_path / "none")).count() == 0


def test_stream_resumes_after_failure(spark, tmp_path):
    path, state, seen = str(tmp_path / "log"), str(tmp_path / "state"), []
    consume.produce(records(spark, 0, 20), path, 2)

    def process(batch, number):
        seen.append((number, batch.count()))
        if number == 1 and len([s for s in seen if s[0] == 1]) == 1:
            raise RuntimeError("stopped on purpose")

    consume.consume_with(consume.stream_log(spark, path), process, state).awaitTermination()
    consume.produce(records(spark, 20, 7), path, 2)
    try:
        consume.consume_with(consume.stream_log(spark, path), process, state).awaitTermination()
    except Exception as e:
        assert "stopped on purpose" in str(e)
    consume.consume_with(consume.stream_log(spark, path), process, state).awaitTermination()
    assert seen == [(0, 20), (1, 7), (1, 7)]


def test_a_repeated_commit_changes_nothing(tmp_path):
    log = shardlog.Folder(str(tmp_path))
    log.commit([{"shard": "a", "file": "a/1", "task": 0, "rows": 1}], "s-0")
    log.commit([{"shard": "a", "file": "a/2", "task": 0, "rows": 1}], "s-0")
    assert [c["files"][0]["file"] for c in log.commits()] == ["a/1"]


def test_writers_at_once_lose_no_commit(tmp_path):
    def write(i):
        log = shardlog.Folder(str(tmp_path))
        for k in range(10):
            log.commit([{"shard": "a", "file": f"a/{i}-{k}", "task": 0, "rows": 1}], f"{i}-{k}")

    with ThreadPoolExecutor(8) as pool:
        list(pool.map(write, range(8)))
    assert sorted(c["files"][0]["file"] for c in shardlog.Folder(str(tmp_path)).commits()) == sorted(f"a/{i}-{k}" for i in range(8) for k in range(10))


def test_polls_are_bounded_by_records(spark, tmp_path):
    path, seen, events = str(tmp_path / "log"), [], []
    consume.produce(records(spark, 0, 50), path, 2)
    consume.produce(records(spark, 50, 5), path)
    n = consume.drain(spark, path, lambda batch, number: seen.append(sorted(bytes(r.data).decode() for r in batch.collect())), str(tmp_path / "state"), PollingSettings(batch_size=20), emit=events.append)
    assert n == 3 and [len(s) for s in seen] == [20, 20, 15] and sorted(sum(seen, [])) == sorted(f"msg{i}" for i in range(55))
    kinds = [e["event_type"] for e in events]
    assert kinds[0] == "WorkerJoined" and kinds[-1] == "WorkerLeft" and {"NewShardDetected", "PollComplete", "Checkpoint"} <= set(kinds)
    assert [e["behind_records"] for e in events if e["event_type"] == "PollComplete"][-1] == 0
    consume.produce(records(spark, 55, 1), path)
    assert consume.drain(spark, path, lambda batch, number: seen.append([bytes(r.data).decode() for r in batch.collect()]), str(tmp_path / "state")) == 1 and seen[-1] == ["msg55"]


def test_children_wait_for_their_parents(spark, tmp_path):
    path, seen, events = str(tmp_path / "log"), [], []
    consume.produce(records(spark, 0, 40), path, 2)
    assert shardlog.split(path, "shard-000") == ["shard-002", "shard-003"]
    consume.produce(records(spark, 40, 40), path, 2)
    assert shardlog.merge(path, "shard-003", "shard-001") == ["shard-004"]
    consume.produce(records(spark, 80, 40), path, 2)
    for wrong in (lambda: shardlog.merge(path, "shard-002", "shard-002"), lambda: shardlog.split(path, "shard-000")):
        try:
            wrong()
        except ValueError:
            continue
        raise AssertionError
    consume.drain(spark, path, lambda batch, number: seen.append({r.shard_id for r in batch.select("shard_id").distinct().collect()}), str(tmp_path / "state"), emit=events.append)
    assert seen == [{"shard-000", "shard-001"}, {"shard-001", "shard-002", "shard-003"}, {"shard-002", "shard-004"}]
    assert [e["shard_id"] for e in events if e["event_type"] == "ShardEnded"] == ["shard-000", "shard-003", "shard-001"]
    where = {r.partition_key: r.shard_id for r in consume.read_log(spark, path).collect()}
    shards = shardlog.Folder(path).shards()
    assert all(shards[s]["lo"] <= hashlib.md5(k.encode()).hexdigest() <= shards[s]["hi"] for k, s in where.items())


def test_starting_positions(spark, tmp_path):
    path = str(tmp_path / "log")
    stamped = records(spark, 0, 10).withColumn("approximate_arrival_timestamp", F.timestamp_micros(F.substring("data", 4, 1).cast("string").cast("bigint") * 1_000_000))
    consume.produce(stamped, path)
    of = lambda **options: sorted(bytes(r.data).decode() for r in consume.read_log(spark, path, **options).collect())
    assert of(startingPosition="AT_TIMESTAMP", startingTimestamp="1970-01-01T00:00:07+00:00") == ["msg7", "msg8", "msg9"]
    first = consume.read_log(spark, path).orderBy("sequence_number").collect()
    assert len(of(startAt=json.dumps({"shard-000": first[3].sequence_number}))) == 7
    with pytest.raises(Exception, match="startingPosition"):
        of(startingPosition="SOMEWHERE")
    seen = []
    consume.consume_with(consume.stream_log(spark, path, startingPosition="AT_TIMESTAMP", startingTimestamp="1970-01-01T00:00:08"), lambda batch, n: seen.append(batch.count()), str(tmp_path / "state")).awaitTermination()
    assert seen == [2]


def test_records_one_by_one(spark, tmp_path):
    path, out = str(tmp_path / "log"), tmp_path / "out"
    out.mkdir()
    consume.produce(records(spark, 0, 60), path, 2)

    def process(row):
        n = int(bytes(row.data)[3:])
        if n == 7 and not (out / "failed").exists():
            (out / "failed").touch()
            raise RuntimeError("once")
        with open(out / row.shard_id, "a") as f:
            f.write(f"{row.sequence_number}\n")

    polls = consume.consume_records(spark, path, process, str(tmp_path / "state"), CheckpointSettings(batch_size=25), retry=Backoff(0.01, 1, 2.0, 2))
    got = {s: (out / s).read_text().split() for s in ("shard-000", "shard-001")}
    assert polls == 3 and sum(map(len, got.values())) == 60 and all(x == sorted(x) for x in got.values())
    consume.consume_records(spark, path, process, str(tmp_path / "other"), CheckpointSettings(batch_size=25, parallelism=3))
    assert sum(len((out / s).read_text().split()) for s in got) == 120


def test_workers_share_a_log_until_its_end(spark, tmp_path):
    path, seen = str(tmp_path / "log"), []
    table = LeaseTable(spark, str(tmp_path / "leases"))
    consume.produce(records(spark, 0, 40), path, 2)
    shardlog.split(path, "shard-000")
    consume.produce(records(spark, 40, 40), path)
    events: list[tuple] = []
    one, two = (Coordinator(table, w, emit=lambda e, w=w: events.append((w, e["event_type"], e.get("shard_id")))) for w in ("w1", "w2"))
    now = datetime(2024, 1, 1)

    def process(worker):
        return lambda batch: seen.extend((worker, r.shard_id, bytes(r.data).decode()) for r in batch.collect())

    for cycle in range(5):
        for worker, name in ((one, "w1"), (two, "w2")):
            now += timedelta(seconds=1)
            consume.work(spark, path, worker, process(name), now, PollingSettings(batch_size=25))
    assert sorted(x[2] for x in seen) == sorted(f"msg{i}" for i in range(80))  # each record once, by whatever worker
    assert {w for w, _, _ in seen} == {"w1", "w2"}
    last = max(i for i, x in enumerate(seen) if x[1] == "shard-000")
    assert all(i > last for i, x in enumerate(seen) if x[1] in ("shard-002", "shard-003"))
    assert [k for _, k, s in events if s == "shard-000" and k == "ShardEnded"] == ["ShardEnded"]
    # a worker that stops gives up its leases; another one goes on where it has been
    one.release()
    consume.produce(records(spark, 80, 10), path)
    now += timedelta(seconds=1)
    consume.work(spark, path, two, process("w2"), now, PollingSettings(batch_size=100))
    assert sorted(x[2] for x in seen) == sorted(f"msg{i}" for i in range(90)) and set(two.held) == {"shard-001", "shard-002", "shard-003"}


def test_streamed_staging_equals_batch(spark, tmp_path):
    rows = [("a", 1, "stage", 5), ("a", 2, "checkpoint", None), ("b", 3, "end", None), ("b", 4, "release", None), ("a", 5, "seen", 6), ("a", 6, "stage", 6), ("a", 7, "end", None), ("a", 8, "release", None)]
    schema = "shard_id string, event_id long, kind string, position long"
    events = spark.createDataFrame(rows, schema)
    want = {(r.shard_id, r.event_id, r.written) for r in staging.checkpoints(events, "shard_id", ["event_id"]).where("written is not null").collect()}
    assert want == {("a", 2, "5"), ("b", 4, "SHARD_END"), ("a", 8, "SHARD_END")}
    events.write.parquet(str(tmp_path / "in"))
    name = f"t{uuid.uuid4().hex}"
    stream = staging.stream_checkpoints(spark.readStream.schema(schema).parquet(str(tmp_path / "in")))
    stream.writeStream.format("memory").queryName(name).option("checkpointLocation", str(tmp_path / "s")).trigger(availableNow=True).start().awaitTermination()
    assert {tuple(r) for r in spark.table(name).collect()} == want


def many_commits(path, commits, files=1, rows=10):
    log = shardlog.Folder(path)
    log.open_shards(2)
    for n in range(commits):
        log.commit([{"shard": f"shard-{k % 2:03d}", "file": f"shard-{k % 2:03d}/{n}-{k}", "task": k, "rows": rows, "first": 1000 * n, "last": 1000 * n + 999} for k in range(files)], f"sink-{n}")
    return log


def test_a_log_opens_by_its_snapshot_and_tail(tmp_path):
    many_commits(str(tmp_path), 1000)
    again = shardlog.Folder(str(tmp_path))
    assert again.refresh() == 1001 and again.reads <= 1 + shardlog.SNAPSHOT
    assert len(again.names("_snapshots", ".parquet")) == 2
    assert [len(c["files"]) for c in again.commits(998)] == [1, 1, 1] and again.files(5, 7).column("commit").to_pylist() == [5, 6, 7]
    assert set(again.shards()) == {"shard-000", "shard-001"} and len(again.reshards()) == 1
    # batches that are there are known without reading the commits that made them
    assert again.commit([], "sink-3") and again.commit([], "sink-999") and again.refresh() == 1001
    assert again.commit([], "sink-1000") and again.refresh() == 1002
    whole = shardlog.BatchReader({"path": str(tmp_path)}).partitions()
    assert len(whole) == 1000 and [p.commit for p in whole] == list(range(1, 1001))


def test_reshards_survive_snapshots(tmp_path, monkeypatch):
    monkeypatch.setattr(shardlog, "SNAPSHOT", 4)
    log = many_commits(str(tmp_path), 6)
    assert shardlog.split(str(tmp_path), "shard-000") == ["shard-002", "shard-003"]
    for n in range(9):
        log.commit([{"shard": "shard-002", "file": f"shard-002/x{n}", "task": 0, "rows": 1, "first": 0, "last": 0}], f"other-{n}")
    again = shardlog.Folder(str(tmp_path))
    shards = again.shards()
    assert again.reads <= 5 and shards["shard-000"]["ended"] and not shards["shard-003"]["ended"] and shards["shard-003"]["parents"] == ["shard-000"]
    assert [n for n, _ in again.reshards()] == [0, 7] and [i for i, c in enumerate(again.commits()) if "reshard" in c] == [0, 7]
    assert shardlog.merge(str(tmp_path), "shard-003", "shard-001") == ["shard-004"]


def planned(path, **options):
    return [p for p in shardlog.BatchReader({"path": path, **options}).partitions() if p.file]


def test_only_files_that_can_match_are_planned(tmp_path):
    path = str(tmp_path)
    many_commits(path, 100, files=4)
    at = lambda commit, row=0: str(commit * 10**24 + row).zfill(40)
    assert len(planned(path)) == 400
    late = planned(path, startat=json.dumps({"shard-000": at(100), "shard-001": at(100)}), shardids="shard-000,shard-001")
    assert len(late) == 4 and {p.commit for p in late} == {100}
    assert {p.commit for p in planned(path, startat=json.dumps({"shard-000": at(100)}), shardids="shard-000")} == {100}
    since = datetime(1970, 1, 1) + timedelta(microseconds=98_500)
    assert {p.commit for p in planned(path, startingposition="AT_TIMESTAMP", startingtimestamp=since.isoformat())} == {99, 100}
    reader = shardlog.BatchReader({"path": path})
    rest = list(reader.pushFilters([GreaterThan(("sequence_number",), at(50, 3)), LessThanOrEqual(("sequence_number",), at(51, 2)), EqualTo(("shard_id",), "shard-000"), EqualTo(("partition_key",), "k")]))
    assert [f.attribute for f in rest] == [("partition_key",)]
    # task 0 of commit 50 from its fifth row, task 2 whole, and three rows of commit 51
    assert [(p.commit, p.task, p.first, p.last) for p in reader.partitions()] == [(50, 0, 4, 10), (50, 2, 0, 10), (51, 0, 0, 3)]
    reader = shardlog.BatchReader({"path": path})
    assert len(list(reader.pushFilters([GreaterThanOrEqual(("approximate_arrival_timestamp",), datetime(1970, 1, 1, tzinfo=timezone.utc) + timedelta(microseconds=97_000))]))) == 1
    assert {p.commit for p in reader.partitions()} == {98, 99, 100}
    reader = shardlog.BatchReader({"path": path})
    assert list(reader.pushFilters([In(("shard_id",), ("shard-001", "none")), EqualTo(("shard_id",), "shard-000")])) == [] and reader.partitions() == [shardlog.NOTHING]


def test_pushed_filters_give_what_plain_ones_give(spark, tmp_path):
    path = str(tmp_path / "log")
    for n in range(5):
        stamped = records(spark, 20 * n, 20).withColumn("approximate_arrival_timestamp", F.timestamp_micros(F.regexp_extract(F.col("data").cast("string"), "[0-9]+", 0).cast("bigint") * 1_000_000))
        consume.produce(stamped, path, 2)
    whole = consume.read_log(spark, path).collect()
    middle = sorted(r.sequence_number for r in whole)[50]
    instant = sorted(r.approximate_arrival_timestamp for r in whole)[70]
    key = lambda rows: sorted((r.shard_id, r.sequence_number) for r in rows)
    got = consume.read_log(spark, path, F.col("sequence_number") > middle).collect()
    assert key(got) == key(r for r in whole if r.sequence_number > middle) and got
    got = consume.read_log(spark, path, (F.col("approximate_arrival_timestamp") >= F.lit(instant)) & (F.col("shard_id") == "shard-001")).collect()
    assert key(got) == key(r for r in whole if r.approximate_arrival_timestamp >= instant and r.shard_id == "shard-001") and got
    few = consume.read_log(spark, path, columns=["shard_id", "sequence_number"], unpack=False)
    assert few.columns == ["shard_id", "sequence_number"] and key(few.collect()) == key(whole)
    assert key(consume.read_log(spark, path, F.col("sequence_number") <= middle, columns=["shard_id", "sequence_number", "data"]).collect()) == key(r for r in whole if r.sequence_number <= middle)
    assert consume.read_log(spark, path, "shard_id in ('shard-000', 'x')").count() == sum(r.shard_id == "shard-000" for r in whole)


def test_parts_skip_row_groups(spark, tmp_path):
    path = str(tmp_path / "log")
    consume.produce(records(spark, 0, 50).coalesce(1), path)
    (whole,) = planned(path)
    reader = shardlog.BatchReader({"path": path}, ["sequence_number", "data"])
    some = shardlog.Part(whole.file, whole.shard, whole.commit, whole.task, 7, 9)
    (batch,) = list(reader.read(some))
    assert batch.schema.names == ["sequence_number", "data"] and [int(x) % 10**12 for x in batch.column("sequence_number").to_pylist()] == [7, 8]


def test_files_of_failed_writers_go(spark, tmp_path):
    path = str(tmp_path / "log")
    consume.produce(records(spark, 0, 20), path, 2)
    lost = tmp_path / "log" / "shard-001" / "000000-lost.parquet"
    lost.write_bytes(b"x")
    assert shardlog.vacuum(path) == [] and lost.exists()  # it may be of a writer that is still at work
    assert shardlog.vacuum(path, 0) == ["shard-001/000000-lost.parquet"] and not lost.exists()
    assert consume.read_log(spark, path).count() == 20
