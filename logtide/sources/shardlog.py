"""A file-backed log of shards, as a data source for batch and streaming, reading and writing.

    spark.dataSource.register(ShardLog)
    records.write.format("shardlog").option("shards", 4).mode("append").save(path)
    spark.read.format("shardlog").load(path)
    spark.readStream.format("shardlog").option("startingPosition", "LATEST").load(path)

The folder must be one that the driver and all executors share; a path without a scheme is local (``consume`` resolves it by
the session's default file system). Each task writes a file for each shard under a name of its own; the driver's commit lists
the files and their rows in ``_commits/<n>.json``, by which they become visible, all at once. A commit's number is claimed by
creating that file, which only one writer can; another one takes the next number. A streaming commit carries its batch id and
is skipped if it is there already, so that a repeated batch changes nothing. Sequence numbers are made of commit, task and
row, so that they grow along each shard without any coordination.

Every ``SNAPSHOT`` commits the log's state is written as one file: a table of all files, sorted by commit, with the range of
arrival times and rows of each (the zone map), the shards, and the last batch of each streaming sink. Opening a log reads the
last snapshot's footer and the commits after it; planning reads only the table's row groups for the commits that are asked for.

Readers open only files that can hold what is asked: by shard, by sequence number (a row's number in its file follows from it)
and by arrival time, whether it comes from the options or from filters that Spark pushes down; and only the columns of the
reader's schema. ``vacuum`` deletes what failed writers have left.

Shards are ranges of the hash key space. The first writer makes ``shards`` equal ones; ``split`` and ``merge`` end shards and
begin others by a commit of their own, and later writers route by the new map. Records of children therefore always come in
later commits than those of their parents.

A stream's offset is a commit and a row in it: a reader gets one partition for each file, or part of one. With the options
``resumeAt`` (the offset that the query has reached) and ``maxRecordsPerBatch``, a batch ends after so many records, and
before a commit that ended shards, so that children are withheld until their parents have been processed.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, DataSourceStreamArrowWriter, DataSourceStreamReader, EqualTo, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual, WriterCommitMessage
from pyspark.sql.types import StructType

from logtide.schema import DIGITS, RECORD

_COMMIT, _TASK = 10**24, 10**12
_SPACE = 1 << 128
_ARROW = pa.schema([
    ("shard_id", pa.string()), ("sequence_number", pa.string()), ("approximate_arrival_timestamp", pa.timestamp("us", "UTC")), ("data", pa.binary()), ("partition_key", pa.string()),
    ("encryption_type", pa.string()), ("sub_sequence_number", pa.int64()), ("explicit_hash_key", pa.string()), ("aggregated", pa.bool_()),
])


def _plain(path: str) -> str:
    return path.removeprefix("file://") if path.startswith("file:///") else path.removeprefix("file:")


#: Commits between two snapshots, and rows of a row group of a snapshot.
SNAPSHOT, GROUP = 64, 4096
_FILES = pa.schema([("commit", pa.int64()), ("shard", pa.string()), ("file", pa.string()), ("task", pa.int64()), ("rows", pa.int64()), ("first", pa.int64()), ("last", pa.int64())])


def _sink(key: str) -> tuple[str, int] | None:
    """A streaming sink and its batch, of a commit's key."""
    name, _, batch = key.rpartition("-")
    return (name, int(batch)) if name and batch.isdigit() else None


class Folder:
    """The log's files, on any store that pyarrow knows."""

    def __init__(self, path: str):
        from pyarrow import fs

        path = _plain(path)
        self.local = "://" not in path
        self.fs, self.root = (fs.LocalFileSystem(), os.path.abspath(path)) if self.local else fs.FileSystem.from_uri(path)
        #: The last snapshot's path, what its footer says (commits, shards, reshards, sinks), and the commits after it.
        self.snapshot: str | None = None
        self.held: dict = {"commits": 0, "shards": {}, "reshards": [], "sinks": {}}
        self.tail: list[dict] = []
        #: Files of metadata that have been read.
        self.reads = 0

    def at(self, *parts: str) -> str:
        return "/".join([self.root, *parts])

    def names(self, folder: str, end: str = ".json") -> list[str]:
        from pyarrow import fs

        found = self.fs.get_file_info(fs.FileSelector(self.at(folder), allow_not_found=True))
        return sorted(x.path for x in found if x.path.endswith(end))

    def _place(self, part: str, whole: str) -> bool | None:
        """Give a finished file its name; False if the name is taken, None if the store can't tell."""
        if self.local:
            try:
                os.link(part, whole)  # fails if the name is taken
            except FileExistsError:
                return False
            finally:
                os.unlink(part)
            return True
        try:
            if self.fs.get_file_info(whole).is_file:
                return False
            self.fs.move(part, whole)  # stores with a real rename refuse a name that is taken
        except OSError:
            if not self.fs.get_file_info(whole).is_file:
                raise
        return None

    def create(self, name: str, value: dict) -> bool:
        """Create a file of JSON, whole or not at all; False if another one has made it."""
        folder = name.rpartition("/")[0]
        self.fs.create_dir(self.at(folder), recursive=True)
        part, whole = self.at(folder, f".{uuid.uuid4().hex}"), self.at(name)
        with self.fs.open_output_stream(part) as f:
            f.write(json.dumps(value | {"nonce": part}).encode())
        made = self._place(part, whole)
        return self.load(whole)["nonce"] == part if made is None else made  # of stores without a real rename, the last to write has it

    def load(self, path: str) -> dict:
        self.reads += 1
        with self.fs.open_input_stream(path) as f:
            return json.loads(f.read())

    def refresh(self) -> int:
        """The number of commits; reads the last snapshot's footer once, and each commit after it once."""
        if self.snapshot is None and not self.tail:
            for path in reversed(self.names("_snapshots", ".parquet")):
                self.reads += 1
                with self.fs.open_input_file(path) as f:
                    self.held = json.loads(pq.read_schema(f).metadata[b"log"])
                self.snapshot = path
                break
        while True:
            name = self.at(f"_commits/{self.held['commits'] + len(self.tail):012d}.json")
            if not self.fs.get_file_info(name).is_file:
                return self.held["commits"] + len(self.tail)
            self.tail.append(self.load(name))

    def files(self, low: int = 0, high: int = 1 << 62) -> pa.Table:
        """The files of the commits from ``low`` to ``high``: commit, shard, file, task, rows, first and last arrival (null where unknown)."""
        count = self.refresh()
        known = self.held["commits"]
        parts = [_FILES.empty_table()]
        if self.snapshot and low < known:
            self.reads += 1
            with self.fs.open_input_file(self.snapshot) as f:
                parts.append(pq.read_table(f, filters=[("commit", ">=", low), ("commit", "<=", high)]).replace_schema_metadata(None).cast(_FILES))
        rows = [{"commit": n, **{k: x.get(k) for k in _FILES.names[1:]}} for n in range(max(low, known), min(high + 1, count)) for x in self.tail[n - known]["files"]]
        return pa.concat_tables([*parts, pa.Table.from_pylist(rows, _FILES)])

    def commits(self, low: int = 0) -> list[dict]:
        """The commits from ``low`` on: files, and the change of shards of those that make one."""
        count = self.refresh()
        out: list[dict] = [{"files": []} for _ in range(low, count)]
        for x in self.files(low).to_pylist():
            out[x["commit"] - low]["files"].append(x)
        for n, change in self.reshards():
            if n >= low:
                out[n - low]["reshard"] = change
        return out

    def reshards(self) -> list[tuple[int, dict]]:
        """(commit, shards that end and begin)."""
        self.refresh()
        return [(n, x) for n, x in self.held["reshards"]] + [(self.held["commits"] + i, c["reshard"]) for i, c in enumerate(self.tail) if "reshard" in c]

    def done(self, key: str) -> bool:
        """Whether a commit of this key is there; of a sink, its batches count upwards."""
        sink = _sink(key)
        return any(c["key"] == key for c in self.tail) or sink is not None and self.held["sinks"].get(sink[0], -1) >= sink[1]

    def commit(self, files: list[dict], key: str, reshard: dict | None = None, after: int | None = None) -> bool:
        """Make files visible, or change the shard map; nothing happens if the key has been committed before.

        after: the number of commits that the caller has seen and relies on; with more of them, False is returned.
        """
        while True:
            count = self.refresh()
            if self.done(key):
                return True
            if after is not None and count != after:
                return False
            if self.create(f"_commits/{count:012d}.json", {"key": key, "files": files} | ({"reshard": reshard} if reshard else {})):
                if (count + 1) % SNAPSHOT == 0:
                    self.write_snapshot()
                return True

    def write_snapshot(self) -> None:
        """Write the state of all commits that are there; earlier snapshots but the last one go."""
        count = self.refresh()
        sinks = dict(self.held["sinks"])
        for c in self.tail:
            if sink := _sink(c["key"]):
                sinks[sink[0]] = max(sinks.get(sink[0], -1), sink[1])
        log = {"commits": count, "shards": self.shards(), "reshards": self.reshards(), "sinks": sinks}
        table = self.files().sort_by([("commit", "ascending"), ("shard", "ascending"), ("task", "ascending")]).replace_schema_metadata({"log": json.dumps(log)})
        self.fs.create_dir(self.at("_snapshots"), recursive=True)
        part, whole = self.at("_snapshots", f".{uuid.uuid4().hex}"), self.at(f"_snapshots/{count:012d}.parquet")
        with self.fs.open_output_stream(part) as f:
            pq.write_table(table, f, row_group_size=GROUP, compression="zstd")
        self._place(part, whole)
        for old in self.names("_snapshots", ".parquet")[:-2]:  # readers may be about to open the last but one
            self.fs.delete_file(old)

    def shards(self) -> dict[str, dict]:
        """All shards: lo and hi (32 hex digits), parents, and whether they have ended."""
        self.refresh()
        out: dict[str, dict] = {k: dict(v) for k, v in self.held["shards"].items()}
        for c in self.tail:
            change = c.get("reshard", {"end": [], "new": []})
            for s in change["end"]:
                out[s]["ended"] = True
            for s in change["new"]:
                out[s["shard_id"]] = {**s, "ended": False}
        return out

    def end(self) -> str:
        """The sequence number before which all records stand that are there."""
        return str(self.refresh() * _COMMIT).zfill(DIGITS)

    def open_shards(self, count: int) -> list[tuple[int, str]]:
        """(highest hash key, shard) of the open shards, in order; a log without shards gets ``count`` equal ones."""
        if not self.shards():
            edges = [_SPACE * i // count for i in range(count + 1)]
            new = [{"shard_id": f"shard-{i:03d}", "lo": f"{a:032x}", "hi": f"{b - 1:032x}", "parents": []} for i, (a, b) in enumerate(zip(edges, edges[1:]))]
            self.commit([], "first shards", {"end": [], "new": new}, after=self.refresh())
        return sorted((int(s["hi"], 16), k) for k, s in self.shards().items() if not s["ended"])

    def change_shards(self, make) -> list[str]:
        """Commit ``make(shards) -> (ended, [(lo, hi)])``; returns the ids of the new shards."""
        while True:
            seen = self.refresh()
            shards = self.shards()
            ended, spans = make(shards)
            if any(shards[s]["ended"] for s in ended):
                raise ValueError("a shard that has ended")
            new = [{"shard_id": f"shard-{len(shards) + i:03d}", "lo": f"{lo:032x}", "hi": f"{hi:032x}", "parents": ended} for i, (lo, hi) in enumerate(spans)]
            if self.commit([], uuid.uuid4().hex, {"end": ended, "new": new}, after=seen):
                return [s["shard_id"] for s in new]

    def orphans(self, older_s: float) -> list[str]:
        """Data files that no commit lists, last written so many seconds ago at least."""
        from datetime import datetime, timezone

        now = datetime.now(timezone.utc).timestamp()
        known = set(self.files().column("file").to_pylist())
        out = []
        for shard in self.shards():
            from pyarrow import fs

            for x in self.fs.get_file_info(fs.FileSelector(self.at(shard), allow_not_found=True)):
                name = f"{shard}/{x.base_name}"
                if x.is_file and name not in known and x.mtime is not None and now - x.mtime.timestamp() >= older_s:
                    out.append(name)
        return sorted(out)


def vacuum(path: str, older_s: float = 86_400.0) -> list[str]:
    """Delete the files of writers that failed before their commit; ``older_s`` must exceed the time that any write takes."""
    folder = Folder(path)
    found = folder.orphans(older_s)
    for name in found:
        folder.fs.delete_file(folder.at(name))
    return found


def split(path: str, shard: str) -> list[str]:
    """End a shard; two halves of its range begin."""

    def make(shards):
        lo, hi = (int(shards[shard][k], 16) for k in ("lo", "hi"))
        middle = (lo + hi) // 2
        return [shard], [(lo, middle), (middle + 1, hi)]

    return Folder(path).change_shards(make)


def merge(path: str, one: str, other: str) -> list[str]:
    """End two neighbouring shards; one of both ranges begins."""

    def make(shards):
        spans = sorted((int(shards[s]["lo"], 16), int(shards[s]["hi"], 16)) for s in (one, other))
        if spans[0][1] + 1 != spans[1][0]:
            raise ValueError("only neighbours can be merged")
        return [one, other], [(spans[0][0], spans[1][1])]

    return Folder(path).change_shards(make)


@dataclass
class Part(InputPartition):
    """Rows of a file of a commit."""

    file: str
    shard: str
    commit: int
    task: int
    first: int
    last: int

    def __init__(self, file: str, shard: str, commit: int, task: int, first: int, last: int):
        self.file, self.shard, self.commit, self.task, self.first, self.last = file, shard, commit, task, first, last


@dataclass
class Written(WriterCommitMessage):
    files: list


NOTHING = Part("", "", 0, 0, 0, 0)
POSITIONS = ("TRIM_HORIZON", "LATEST", "AT_TIMESTAMP")


def _micros(at) -> int:
    """Microseconds of an instant; without a zone it is one of UTC."""
    from datetime import timedelta, timezone

    at = at if at.tzinfo else at.replace(tzinfo=timezone.utc)
    return (at - at.fromtimestamp(0, timezone.utc)) // timedelta(microseconds=1)


class _Reading:
    def __init__(self, options: dict, columns: list[str] | None = None):
        self.folder = Folder(options["path"])
        self.columns = columns or _ARROW.names
        self.shards = set(filter(None, options.get("shardids", "").split(",")))
        self.position = options.get("startingposition", "TRIM_HORIZON").upper()
        if self.position not in POSITIONS:
            raise ValueError(f"startingPosition is one of {POSITIONS}")
        #: Least and greatest arrival and sequence number of records that are wanted, both included.
        self.times: list[int | None] = [None, None]
        self.sequences = [0, 10**DIGITS - 1]
        if self.position == "AT_TIMESTAMP":
            from datetime import datetime

            self.times[0] = _micros(datetime.fromisoformat(options["startingtimestamp"]))
        #: {shard: padded sequence number} at which a shard is begun
        self.first = {k: int(v) for k, v in json.loads(options.get("startat", "{}")).items()}

    def lowest(self) -> int:
        """The commit before which nothing is wanted."""
        low = self.sequences[0]
        if self.shards and self.shards <= self.first.keys():
            low = max(low, min(self.first[s] for s in self.shards))
        return low // _COMMIT

    def parts(self, start: tuple[int, int], end: tuple[int, int]) -> list[Part]:
        """Parts between two offsets that can hold what is wanted; only assigned shards if the option shardIds names some."""
        out = []
        begin = max(start[0], self.lowest())
        files = self.folder.files(begin, min(end[0], self.sequences[1] // _COMMIT))
        row = of = 0
        for f in files.to_pylist():
            n = f["commit"]
            row = row if n == of else 0
            of = n
            low, high = start[1] if n == start[0] else 0, end[1] if n == end[0] else 1 << 62
            a, b = max(low - row, 0), min(high - row, f["rows"])
            row += f["rows"]
            at = n * _COMMIT + f["task"] * _TASK  # the sequence number of the file's first row
            a = max(a, max(self.sequences[0], self.first.get(f["shard"], 0)) - at)
            b = min(b, self.sequences[1] + 1 - at)
            late = self.times[0] is not None and f["last"] is not None and f["last"] < self.times[0]
            early = self.times[1] is not None and f["first"] is not None and f["first"] > self.times[1]
            if a < b and not late and not early and (not self.shards or f["shard"] in self.shards):
                out.append(Part(f["file"], f["shard"], n, f["task"], a, b))
        return out

    def read(self, part: Part) -> Iterator[pa.RecordBatch]:
        if not part.file:
            return
        begin = part.commit * _COMMIT + part.task * _TASK
        schema = pa.schema([x for x in _ARROW if x.name in self.columns])
        stamp = "approximate_arrival_timestamp"
        timed = any(x is not None for x in self.times)
        with self.folder.fs.open_input_file(self.folder.at(part.file)) as f:
            file = pq.ParquetFile(f)
            stored = [x for x in schema.names if x in file.schema_arrow.names]
            # row groups that hold rows of this part
            edges = [0]
            for i in range(file.num_row_groups):
                edges.append(edges[-1] + file.metadata.row_group(i).num_rows)
            groups = [i for i in range(file.num_row_groups) if edges[i] < part.last and edges[i + 1] > part.first]
            row = edges[groups[0]] if groups else 0
            for batch in file.iter_batches(row_groups=groups, columns=list(dict.fromkeys([*stored, *([stamp] if timed else [])]))):
                a, b = max(part.first - row, 0), min(part.last - row, batch.num_rows)
                at, row = begin + row + a, row + batch.num_rows
                if a >= b:
                    continue
                batch, n = batch.slice(a, b - a), b - a
                made = {}
                if "shard_id" in schema.names:
                    made["shard_id"] = pa.array([part.shard] * n)
                if "sequence_number" in schema.names:
                    made["sequence_number"] = pa.array([str(at + i).zfill(DIGITS) for i in range(n)])
                columns = [made[x.name].cast(x.type) if x.name in made else batch.column(x.name).cast(x.type) if x.name in stored else pa.nulls(n, x.type) for x in schema]
                whole = pa.RecordBatch.from_arrays(columns, schema=schema) if columns else pa.RecordBatch.from_struct_array(pa.array([{}] * n, pa.struct([])))
                if timed:
                    kept = pa.array([True] * n)
                    arrival = batch.column(stamp).cast(pa.timestamp("us", "UTC"))
                    for bound, holds in zip(self.times, (pc.greater_equal, pc.less_equal)):
                        if bound is not None:
                            kept = pc.and_(kept, holds(arrival, pa.scalar(bound, pa.timestamp("us", "UTC"))))
                    whole = whole.filter(kept)
                if whole.num_rows:
                    yield whole


class BatchReader(_Reading, DataSourceReader):
    """The options of a stream hold here, too; LATEST reads nothing that is there."""

    def pushFilters(self, filters):
        """Comparisons of shard, sequence number and arrival time choose files and rows; those of shards and sequences need no second look."""
        for f in filters:
            value = getattr(f, "value", None)
            if f.attribute == ("shard_id",) and isinstance(f, (EqualTo, In)):
                wanted = {value} if isinstance(f, EqualTo) else set(value)
                self.shards = (self.shards & wanted if self.shards else wanted) or {""}
                continue
            side = 0 if isinstance(f, (EqualTo, GreaterThan, GreaterThanOrEqual)) else 1 if isinstance(f, (LessThan, LessThanOrEqual)) else None
            strict = isinstance(f, (GreaterThan, LessThan))
            sides = (0, 1) if isinstance(f, EqualTo) else (side,)
            if f.attribute == ("sequence_number",) and side is not None and isinstance(value, str) and len(value) == DIGITS and value.isdigit():
                for x in sides:
                    bound = int(value) + (strict if x == 0 else -strict)
                    self.sequences[x] = max(self.sequences[0], bound) if x == 0 else min(self.sequences[1], bound)
                continue
            if f.attribute == ("approximate_arrival_timestamp",) and side is not None and hasattr(value, "astimezone"):
                at = _micros(value.astimezone())  # without a zone: an instant of this process' zone
                for x in sides:
                    held = self.times[x]
                    self.times[x] = at if held is None else max(held, at) if x == 0 else min(held, at)
            yield f

    def partitions(self):
        commits = self.folder.refresh()
        return self.parts((commits if self.position == "LATEST" else 0, 0), (commits, 0)) or [NOTHING]


class StreamReader(_Reading, DataSourceStreamReader):
    """Options: startingPosition (TRIM_HORIZON, LATEST, or AT_TIMESTAMP with startingTimestamp), startAt, resumeAt, maxRecordsPerBatch."""

    def __init__(self, options: dict, columns: list[str] | None = None):
        super().__init__(options, columns)
        self.most = int(options.get("maxrecordsperbatch", 0))
        resume = json.loads(options.get("resumeat", "null"))
        self.bounded = "resumeat" in options
        self.at = self._of(resume) if resume else None

    @staticmethod
    def _of(offset: dict) -> tuple[int, int]:
        return offset["commits"], offset.get("rows", 0)

    def initialOffset(self) -> dict:
        return {"commits": self.folder.refresh() if self.position == "LATEST" else 0, "rows": 0}

    def latestOffset(self) -> dict:
        count = self.folder.refresh()
        if not self.bounded:  # nobody has said where the query stands: all there is
            return {"commits": count, "rows": 0}
        n, row = self.at if self.at is not None else self._of(self.initialOffset())
        first, commits = n, self.folder.commits(n)
        admitted = 0
        while n < count:
            if admitted and commits[n - first].get("reshard", {"end": []})["end"]:
                break
            left = sum(f["rows"] for f in commits[n - first]["files"]) - row
            if self.most and admitted + left > self.most:
                row += self.most - admitted
                break
            admitted, n, row = admitted + left, n + 1, 0
            if self.most and admitted == self.most:
                break
        self.at = (n, row)
        return {"commits": n, "rows": row}

    def partitions(self, start: dict, end: dict):
        return self.parts(self._of(start), self._of(end)) or [NOTHING]

    def commit(self, end: dict) -> None:
        pass


class _Writing:
    """Rows have partition_key and data, optionally approximate_arrival_timestamp and the other fields of a record.

    The shard comes from a column shard_id, or else from the hash of the key among the log's open shards.
    """

    #: Bytes that a task holds before it writes them.
    HELD = 16 << 20

    def __init__(self, schema: StructType, options: dict):
        if not {"partition_key", "data"} <= set(schema.names):
            raise ValueError("columns partition_key and data are needed")
        self.folder = Folder(options["path"])
        self.open = self.folder.open_shards(int(options.get("shards", 1)))
        self.fields = [x for x in _ARROW if x.name not in ("shard_id", "sequence_number")]

    def shards_of(self, keys: pa.Array) -> pa.Array:
        import bisect
        import hashlib

        codes = keys.dictionary_encode()
        edges = [edge for edge, _ in self.open]
        found = [self.open[bisect.bisect_left(edges, int(hashlib.md5(k.encode()).hexdigest(), 16))][1] for k in codes.dictionary.to_pylist()]
        return pa.array(found, pa.string()).take(codes.indices)

    def write(self, iterator):
        from datetime import datetime, timezone

        from pyspark import TaskContext

        task, now = TaskContext.get().partitionId(), datetime.now(timezone.utc)
        schema = pa.schema(self.fields)
        held: dict[str, list[pa.RecordBatch]] = {}
        writers: dict[str, tuple] = {}
        rows: dict[str, int] = {}
        zones: dict[str, tuple[int, int]] = {}  # first and last arrival of each file
        tag, size = uuid.uuid4().hex, 0

        def flush() -> None:
            for shard, parts in held.items():
                if shard not in writers:
                    self.folder.fs.create_dir(self.folder.at(shard), recursive=True)
                    name = f"{shard}/{task:06d}-{tag}.parquet"
                    stream = self.folder.fs.open_output_stream(self.folder.at(name))
                    writers[shard] = (name, stream, pq.ParquetWriter(stream, schema))
                for part in parts:
                    writers[shard][2].write_batch(part)
            held.clear()

        for batch in iterator:
            n = batch.num_rows
            columns = {}
            for x in self.fields:
                found = batch.column(x.name) if x.name in batch.schema.names else pa.nulls(n, x.type)
                if x.name == "approximate_arrival_timestamp":
                    if pa.types.is_timestamp(found.type) and found.type.tz is None:
                        found = found.cast(pa.timestamp("us")).cast(x.type)  # without a zone: UTC
                    found = pc.fill_null(found.cast(x.type), pa.scalar(now, x.type))
                elif x.name == "aggregated":
                    found = pc.fill_null(found.cast(x.type), False)
                columns[x.name] = found.cast(x.type)
            made = pa.RecordBatch.from_arrays([columns[x.name] for x in self.fields], schema=schema)
            shard = batch.column("shard_id").cast(pa.string()) if "shard_id" in batch.schema.names else pa.nulls(n, pa.string())
            if shard.null_count:
                shard = pc.coalesce(shard, self.shards_of(batch.column("partition_key").cast(pa.string())))
            codes = shard.dictionary_encode()
            for i, s in enumerate(codes.dictionary.to_pylist()):
                own = made.filter(pc.equal(codes.indices, i))
                held.setdefault(s, []).append(own)
                rows[s] = rows.get(s, 0) + own.num_rows
                span = pc.min_max(own.column("approximate_arrival_timestamp").cast(pa.int64()))
                low, high = span["min"].as_py(), span["max"].as_py()
                zones[s] = (min(zones[s][0], low), max(zones[s][1], high)) if s in zones else (low, high)
            size += made.nbytes
            if size > self.HELD:
                flush()
                size = 0
        flush()
        for _, stream, writer in writers.values():
            writer.close()
            stream.close()
        return Written([{"shard": s, "file": name, "task": task, "rows": rows[s], "first": zones[s][0], "last": zones[s][1]} for s, (name, _, _) in writers.items()])

    def _files(self, messages) -> list[dict]:
        return sorted((f for m in messages if m for f in m.files), key=lambda f: (f["shard"], f["task"]))

    def _discard(self, messages) -> None:
        for f in self._files(messages):
            self.folder.fs.delete_file(self.folder.at(f["file"]))


class BatchWriter(_Writing, DataSourceArrowWriter):
    def __init__(self, schema, options):
        super().__init__(schema, options)
        self.key = uuid.uuid4().hex

    def commit(self, messages):
        self.folder.commit(self._files(messages), self.key)

    def abort(self, messages):
        self._discard(messages)


class StreamWriter(_Writing, DataSourceStreamArrowWriter):
    def __init__(self, schema, options):
        super().__init__(schema, options)
        self.sink = options.get("sinkid", "stream")

    def commit(self, messages, batchId):
        self.folder.commit(self._files(messages), f"{self.sink}-{batchId}")

    def abort(self, messages, batchId):
        self._discard(messages)


class ShardLog(DataSource):
    @classmethod
    def name(cls) -> str:
        return "shardlog"

    def schema(self) -> StructType:
        return RECORD

    def reader(self, schema):
        return BatchReader(self.options, schema.names)

    def streamReader(self, schema):
        return StreamReader(self.options, schema.names)

    def writer(self, schema, overwrite):
        return BatchWriter(schema, self.options)

    def streamWriter(self, schema, overwrite):
        return StreamWriter(schema, self.options)


def register(spark) -> None:
    """Make the format known to a session. The source travels by value: Spark plans it in processes that don't have this package."""
    import sys

    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")  # readers take filters
    spark.dataSource.register(ShardLog)
