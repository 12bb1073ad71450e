"""Recurrences along an order, in parallel also within one key.

Rows are dealt out by ranges of (key, order) and checkpointed, so that they are the same in each pass. Each range says, in a few
numbers, what it makes of any state in which it may begin; one small fold over these chains the ranges; a last pass gives each
row its value. What a range says must be closed under composition: an affine map with a bound, a matrix of the max-plus
algebra, or the function from a segment's beginning to the next.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from logtide.operators.batching import ranged

Columns = dict[str, np.ndarray]


def runs(batch: pa.RecordBatch, key: str) -> list[tuple[object, int, int]]:
    """(key, first row, row after the last) of runs of one key."""
    codes = batch.column(key).dictionary_encode(null_encoding="encode").indices.to_numpy()
    edges = [0, *(np.flatnonzero(np.diff(codes)) + 1).tolist(), len(codes)]
    return [(batch.column(key)[a].as_py(), a, b) for a, b in zip(edges[:-1], edges[1:]) if a < b]


def numbers(batch: pa.RecordBatch, needed: list[str], a: int, b: int) -> Columns:
    return {c: batch.column(c).slice(a, b - a).to_numpy(zero_copy_only=False) for c in needed}


def scan(df: DataFrame, key: str, order: list[str], needed: list[str], fields: str, summarise: Callable[[Columns], object], advance: Callable[[object, object], object], walk: Callable[[object, Columns], tuple[list, object]]) -> DataFrame:
    """Adds columns (``fields``) made by a recurrence along each key in order.

    ``summarise(columns)`` says what consecutive rows of one key make of any state before them, ``advance(state, summary)`` is the
    state after them, and ``walk(state, columns)`` gives (values of the fields, state after). The state before a key is None.
    """
    spark = df.sparkSession
    base = ranged(df, [key, *order])

    def told(part: int, piece: int, of: object, held: list[Columns]) -> pa.RecordBatch:
        whole = {c: np.concatenate([x[c] for x in held]) for c in needed}
        return pa.RecordBatch.from_pylist([{"part": part, "piece": piece, "key": repr(of), "summary": pickle.dumps(summarise(whole))}], pa.schema([("part", pa.int32()), ("piece", pa.int32()), ("key", pa.string()), ("summary", pa.binary())]))

    def summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, piece, of, held = TaskContext.get().partitionId(), 0, None, []
        for batch in batches:
            for value, a, b in runs(batch, key):
                if held and value != of:
                    if piece == 0:  # keys between a partition's first and last are nobody else's
                        yield told(part, 0, of, held)
                    piece, held = piece + 1, []
                of = value
                held.append(numbers(batch, needed, a, b))
        if held:
            yield told(part, piece, of, held)

    def chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, state, seen = None, None, -1
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if row["key"] != of:
                    of, state = row["key"], None
                if row["part"] != seen:
                    seen = row["part"]
                    out.append((seen, of, pickle.dumps(state)))
                state = advance(state, pickle.loads(row["summary"]))
            columns = list(zip(*out)) or [[]] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.int32(), pa.string(), pa.binary()))], ["part", "key", "state"])

    answers = base.select(*dict.fromkeys([key, *needed])).mapInArrow(summaries, "part int, piece int, key string, summary binary")
    begins = answers.repartition(1).sortWithinPartitions("part", "piece").mapInArrow(chain, "part int, key string, state binary")  # one or two rows for each partition
    entry = spark.sparkContext.broadcast({r.part: (r.key, bytes(r.state)) for r in begins.collect()})  # one for each partition
    made = T.StructType.fromDDL(fields)
    schema = T.StructType([*df.schema.fields, *made.fields])
    kinds = [to_arrow_type(f.dataType) for f in made]

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        named, held = entry.value.get(TaskContext.get().partitionId(), (None, None))
        state = pickle.loads(held) if held else None
        for batch in batches:
            parts = []
            for value, a, b in runs(batch, key):
                if repr(value) != named:
                    named, state = repr(value), None
                values, state = walk(state, numbers(batch, needed, a, b))
                parts.append(values)
            if parts:
                yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(np.concatenate(c)).cast(k) for c, k in zip(zip(*parts), kinds))], names=schema.fieldNames())

    return base.mapInArrow(assign, schema)


def numbered(df: DataFrame, key: str, order: list[str], into: str) -> DataFrame:
    """Adds each row's number in its key, from 0."""

    def walk(state, columns):
        begin = state or 0
        n = len(columns[order[0]])
        return [np.arange(begin, begin + n)], begin + n

    return scan(df, key, order, order[:1], f"{into} bigint", lambda columns: len(columns[order[0]]), lambda state, n: (state or 0) + n, walk)


def sums_before(df: DataFrame, key: str, order: list[str], sums: dict[str, str]) -> DataFrame:
    """Adds running sums (column -> name) of the whole numbers of all rows of the key before each one."""
    columns = list(sums)

    def whole(held: Columns, c: str) -> np.ndarray:
        return held[c].astype(np.int64)

    def walk(state, held):
        begin = state or [0] * len(columns)
        upto = [b + np.cumsum(whole(held, c)) for b, c in zip(begin, columns)]
        return [u - whole(held, c) for u, c in zip(upto, columns)], [int(u[-1]) for u in upto]

    def advance(state, summary):
        return [a + b for a, b in zip(state or [0] * len(columns), summary)]

    fields = ", ".join(f"{into} bigint" for into in sums.values())
    return scan(df, key, order, columns, fields, lambda held: [int(whole(held, c).sum()) for c in columns], advance, walk)


def previous(df: DataFrame, keys: list[str], position: str, into: str) -> DataFrame:
    """Adds the position of the row before with the same keys, -1 for the first: a lag that no task does for a whole key."""
    base = ranged(df, [*keys, position])
    schema = T.StructType([*df.schema.fields, T.StructField(into, T.LongType())])

    def named(batch: pa.RecordBatch, i: int) -> str:
        return repr([batch.column(k)[i].as_py() for k in keys])

    def last(batches):
        found = None
        for batch in batches:
            if batch.num_rows:
                found = (named(batch, batch.num_rows - 1), batch.column(position)[batch.num_rows - 1].as_py())
        if found:
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([found[0]]), pa.array([found[1]], pa.int64())], ["part", "key", "at"])

    ends = sorted((r.part, r.key, r["at"]) for r in base.select(*keys, position).mapInArrow(last, "part int, key string, at bigint").collect())  # one for each partition
    before = {part: (key, at) for (_, key, at), (part, _, _) in zip(ends, ends[1:])}
    entry = df.sparkSession.sparkContext.broadcast(before)

    def assign(batches):
        of, at = entry.value.get(TaskContext.get().partitionId(), (None, -1))
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            same = np.ones(n - 1, bool)
            for k in keys:
                codes = batch.column(k).dictionary_encode(null_encoding="encode").indices.to_numpy()
                same &= codes[1:] == codes[:-1]
            positions = batch.column(position).to_numpy()
            out = np.full(n, -1)
            out[1:][same] = positions[:-1][same]
            if named(batch, 0) == of:
                out[0] = at
            of, at = named(batch, n - 1), int(positions[-1])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out)], names=schema.fieldNames())

    return base.mapInArrow(assign, schema)


# segments without a repeated key


def segment_ends(latest: np.ndarray, begin: int, start: np.ndarray, most: int) -> np.ndarray:
    """Where segments that start at these rows end; latest: running maximum of previous occurrences, begin: position of row 0."""
    return np.minimum(np.minimum(np.searchsorted(latest, begin + start, side="left"), start + most), len(latest))


def segments(df: DataFrame, shard: str, position: str, before: str, most: int) -> DataFrame:
    """Adds ``segment``: it ends before a row whose key occurred in it (``before``: where), or after ``most`` rows."""

    def summarise(columns):
        begin, latest = int(columns[position][0]), np.maximum.accumulate(columns[before])
        n = len(latest)
        reach = min(most, n)
        last, count = np.arange(reach + 1), np.zeros(reach + 1, np.int64)
        live = np.flatnonzero(last < n)
        while len(live):
            at, back = np.unique(last[live], return_inverse=True)  # ways that have met go on as one
            end = segment_ends(latest, begin, at, most)[back]
            count[live] += 1
            done = end >= n
            last[live[~done]] = end[~done]
            live = live[~done]
        return begin, n, latest[:most], last, count

    def advance(state, summary):
        begin, n, latest, last, count = summary
        number, start = state if state is not None else (-1, 0)
        border = 0
        if number >= 0:
            border = min(int(np.searchsorted(latest, start, side="left")), start + most - begin)
            if border >= n:
                return state
        return number + int(count[border]), begin + int(last[border])

    def walk(state, columns):
        number, start = state if state is not None else (-1, 0)
        begin, latest = int(columns[position][0]), np.maximum.accumulate(columns[before])
        out = np.empty(len(latest), np.int64)
        i = 0
        while i < len(latest):
            end = i if number < 0 else min(int(np.searchsorted(latest, start, side="left")), start + most - begin, len(latest))
            if end > i:
                out[i:end] = number
                i = end
            if i < len(latest):
                number, start = number + 1, begin + i
        return [out], (number, start)

    return scan(df, shard, [position], [position, before], "segment bigint", summarise, advance, walk)


# r <- min(most, share * r + more)


def bounded_affine(df: DataFrame, key: str, order: list[str], share: str, more: float, most: float, into: str) -> DataFrame:
    """Adds r after each row: r <- min(most, share * r + more), from ``most`` on. Shares are not negative, so that such maps compose."""

    def summarise(columns):
        bound, factor, addend = np.inf, 1.0, 0.0
        for s in columns[share].astype(float).tolist():
            bound, factor, addend = min(most, s * bound + more if s else more), s * factor, s * addend + more
        return bound, factor, addend

    def advance(state, summary):
        bound, factor, addend = summary
        return min(bound, factor * (most if state is None else state) + addend)

    def walk(state, columns):
        r = most if state is None else state
        out = np.empty(len(columns[share]))
        for i, s in enumerate(columns[share].astype(float).tolist()):
            r = out[i] = min(most, s * r + more)
        return [out], r

    return scan(df, key, order, [share], f"{into} double", summarise, advance, walk)


# token buckets


def token_bucket(df: DataFrame, key: str, order: list[str], arrival: str, costs: dict[str, tuple[float, float]], into: str) -> DataFrame:
    """Adds the second at which each row leaves: not before its arrival nor before the row ahead of it, and when every bucket has its cost.

    costs: column -> (units a second, units that a bucket holds). Buckets begin full; a cost above what a bucket holds leaves
    when the bucket is full, and leaves a debt. A bucket's state is the time at which it will be full again; with the time of the last
    departure, one row is a matrix of the max-plus algebra, and ranges of rows are products of such matrices.
    """
    names = list(costs)
    rates = np.array([costs[c][0] for c in names])
    room = np.array([costs[c][1] / costs[c][0] for c in names])
    k = len(names)

    def leave(states: list[list[float]], at: float, need: list[float]) -> None:
        """Advance states (times at which each bucket is full, and the last departure) by one row."""
        for full in states:
            time = max(at, full[k])
            for i in range(k):
                time = max(time, full[i] + min(need[i] - room_list[i], 0.0))
            for i in range(k):
                full[i] = max(full[i], time) + need[i]
            full[k] = time

    room_list = room.tolist()

    def seconds(columns) -> tuple[list[float], list[list[float]]]:
        return columns[arrival].astype(float).tolist(), (np.stack([columns[c].astype(float) for c in names], 1) / rates).tolist()

    def summarise(columns):
        # the rows applied to each unit of the state, without arrivals, and to none with them
        low = -np.inf
        arrivals, needs = seconds(columns)
        units = [[0.0 if i == j else low for i in range(k + 1)] for j in range(k + 1)]
        constant = [[low] * (k + 1)]
        for at, need in zip(arrivals, needs):
            leave(units, low, need)
            leave(constant, at, need)
        return units, constant[0]

    def advance(state, summary):
        units, constant = summary
        state = [-np.inf] * (k + 1) if state is None else state
        return [max(constant[i], *(state[j] + units[j][i] for j in range(k + 1))) for i in range(k + 1)]

    def walk(state, columns):
        states = [[-np.inf] * (k + 1) if state is None else list(state)]
        arrivals, needs = seconds(columns)
        out = np.empty(len(arrivals))
        for i, (at, need) in enumerate(zip(arrivals, needs)):
            leave(states, at, need)
            out[i] = states[0][k]
        return [out], states[0]

    return scan(df, key, order, [arrival, *names], f"{into} double", summarise, advance, walk)


# the last row of another table


def asof(left: DataFrame, right: DataFrame, by: list[str], on: str, take: list[str]) -> DataFrame:
    """Adds to each row of ``left`` the columns of the row of ``right`` with the same ``by`` and the greatest ``on`` that isn't above its own.

    Both sides are merged in ranges of (by, on): neither a key nor the whole of a side meets in one task, and each range needs
    only the last row of ``right`` before it. ``right`` has one row for each (by, on); rows of ``left`` with nulls there match none.
    """
    spark = left.sparkSession
    kept = left.columns
    extra = [right.schema[c] for c in take]
    null = lambda field: F.lit(None).cast(field.dataType).alias(field.name)
    one = left.select(*kept, *(null(f) for f in extra), F.lit(1).alias("__side"))
    other = right.select(*((F.col(c) if c in (*by, on) else null(left.schema[c])) for c in kept), *take, F.lit(0).alias("__side"))
    base = ranged(one.unionByName(other), [*by, on, "__side"])
    held = [*by, on, *take]

    def ends(batches):
        found = None
        for batch in batches:
            own = np.flatnonzero(batch.column("__side").to_numpy() == 0)
            if len(own):
                found = batch.slice(int(own[-1]), 1).to_pylist()[0]
        if found:
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([pickle.dumps(found)], pa.binary())], ["part", "row"])

    found = sorted((r.part, bytes(r.row)) for r in base.select(*held, "__side").mapInArrow(ends, "part int, row binary").collect())  # one for each partition
    shared = spark.sparkContext.broadcast(found)
    schema = T.StructType([*left.schema.fields, *extra])

    def merge(batches):
        part = TaskContext.get().partitionId()
        rows = [row for p, row in shared.value if p < part]
        last = pickle.loads(rows[-1]) if rows else None
        for batch in batches:
            if not batch.num_rows:
                continue
            head = pa.RecordBatch.from_pylist([{n: (last or {}).get(n) for n in batch.schema.names}], batch.schema)
            whole = pa.Table.from_batches([head, batch]).combine_chunks().to_batches()[0]
            is_right = whole.column("__side").to_numpy(zero_copy_only=False) != 1
            at = np.maximum.accumulate(np.where(is_right, np.arange(len(is_right)), 0))
            match = np.ones(len(at), bool)
            if last is None:
                match &= at > 0
            for k in (*by, on):
                column = whole.column(k)
                match &= column.is_valid().to_numpy(zero_copy_only=False)
                if k != on:
                    codes = column.dictionary_encode(null_encoding="encode").indices.to_numpy()
                    match &= codes == codes[at]
            own = np.flatnonzero(~is_right)
            places = pa.array(at[own], mask=~match[own])
            taken = [whole.column(c).take(places) for c in take]
            mine = batch.take(pa.array(own - 1))
            yield pa.RecordBatch.from_arrays([*(mine.column(c) for c in kept), *taken], names=schema.fieldNames())
            ends_here = np.flatnonzero(is_right[1:])
            if len(ends_here):
                last = batch.slice(int(ends_here[-1]), 1).to_pylist()[0]

    return base.mapInArrow(merge, schema)
