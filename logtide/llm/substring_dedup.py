"""Exact substring deduplication by hash-compared suffix sorting.

A byte is removed if a string of ``WIDTH`` bytes that covers it also starts anywhere else. A corpus is too large for one
suffix array, so suffixes first meet their likes:

1. Each window of WIDTH bytes names an anchor: the K bytes within it with the smallest hash, leftmost if equal. Equal
   windows name equal anchors at equal offsets. Consecutive windows with one anchor form an atom, about 1 for 65 bytes. Atoms
   are dealt out by anchor. Equal atoms (96 bits of a BLAKE2 digest of their text) form a class; a class of two or more is
   repeated whole. Each block passes on one member of a class only, so that copies and hot passages don't pile up.
2. Where one anchor has several classes, their texts overlap in part. One text of each class goes to the anchor's task,
   which builds prefix polynomial hashes over them. Windows whose hash no other window shares can't be repeated. The others
   are sorted as suffixes, anchor by anchor, by a bottom-up merge sort whose comparisons find the longest common extension
   by binary search over prefix hashes. Neighbours in that order share the longest extensions; their bytes are compared to
   rule out collisions, and extensions of WIDTH or more are repeats.
3. An anchor with more than ``HOT`` atoms (the edge of a passage that very many documents share) is not one task's: its
   classes are dealt out by class, and each window of theirs then becomes an atom of its own, known by its own digest.
4. The repeated windows meet the texts again and become removed runs.

Atoms, requests and spans travel as packed arrays, some thousand to a row, and a task holds one bucket of them at a time. Rows
are told apart by 96 bits of hashes of doc_id and text, so that repeated rows are copies of each other like any two equal
texts. Null texts are empty; texts shorter than WIDTH lose nothing. Texts longer than ``PIECE`` are read in overlapping pieces.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logtide.llm.blocks import INVERSE, U, blocks, mix, powers, prefix_hashes, ranges, strings, text_arrays
from logtide.llm.decontamination import unions
from logtide.llm.packed import PACKED, Outbox, bucket_count, buckets, deal, records, unpack
from logtide.llm.samples import most_frequent
from logtide.scratch import Scratch

WIDTH = 200
K = 48
#: Low bits of an anchor key hold the position in a piece.
PLACE = 26
PIECE = 1 << 24
#: Atoms of an anchor from which on its windows are told apart one by one, and the number of such anchors at most.
HOT, MOST = 1 << 14, 1 << 16
ATOM = np.dtype([("g", "<u8"), ("h", "<u8"), ("h2", "<u4"), ("row", "<i8"), ("check", "<u4"), ("lo", "<u4"), ("n", "<u1"), ("known", "<u1")])
REQUEST = np.dtype([("row", "<i8"), ("check", "<u4"), ("g", "<u8"), ("lo", "<u4"), ("n", "<u1"), ("known", "<u1"), ("split", "<u1")])
SPAN = np.dtype([("row", "<i8"), ("check", "<u4"), ("lo", "<u4"), ("n", "<u4")])
COUNT = np.dtype([("g", "<u8"), ("n", "<i8")])
ATOMS, REQUESTS, SPANS, COUNTS = 0, 1, 2, 3


def sliding_minimum(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` consecutive values, by minima from both ends of blocks of that width."""
    n = len(x) - width + 1
    y = np.concatenate([x, np.full(-len(x) % width, x[-1], x.dtype)]).reshape(-1, width)
    ahead = np.minimum.accumulate(y, axis=1).ravel()
    back = np.minimum.accumulate(y[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[width - 1 : width - 1 + n])


def window_digests(data: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """96 bits of a digest of each byte range."""
    raw = memoryview(np.ascontiguousarray(data))
    found = b"".join([hashlib.blake2b(raw[a:b], digest_size=12).digest() for a, b in zip(lo.tolist(), hi.tolist())])
    both = np.frombuffer(found, np.dtype([("h", "<u8"), ("h2", "<u4")]))
    return both["h"], both["h2"]


def atoms(data: np.ndarray, offsets: np.ndarray, width: int = WIDTH, k: int = K, piece: int = PIECE) -> tuple[np.ndarray, ...]:
    """(text, anchor hash, first window, windows) of all atoms of a block; one text only, if it is longer than a piece."""
    if len(data) < width:
        return tuple(np.zeros(0, t) for t in (np.int64, U, np.int64, np.int64))
    if len(data) > piece and len(offsets) == 2:
        parts = [(a, *atoms(some := data[a : a + piece + width - 1], np.array([0, len(some)]), width, k, piece + width)) for a in range(0, len(data) - width + 1, piece)]
        return tuple(np.concatenate(x) for x in zip(*((t, g, lo + a, n) for a, t, g, lo, n in parts)))
    h = prefix_hashes(data)
    m = len(data) - k + 1
    gram = (h[k:] - h[:-k]) * powers(INVERSE, m)
    order = gram ^ (gram >> U(29))
    order *= U(0xBF58476D1CE4E5B9)
    order &= ~U((1 << PLACE) - 1)
    order |= np.arange(m, dtype=U)
    anchor = (sliding_minimum(order, width - k + 1) & U((1 << PLACE) - 1)).astype(np.int64)
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[: len(anchor)]
    window = np.flatnonzero(np.arange(width, width + len(anchor)) <= offsets[text + 1])
    if not len(window):
        return atoms(data[:0], offsets[:1])
    anchor, text = anchor[window], text[window]
    heads = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])]))
    return text[heads], mix(gram[anchor[heads]]), window[heads], np.diff(np.append(heads, len(window)))


def classes(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sort atoms by anchor and class: (order, first of each class, class of each, whether a class is repeated)."""
    order = np.lexsort((a["h2"], a["h"], a["g"]))
    a = a[order]
    new = np.ones(len(a), bool)
    for field in ("g", "h", "h2"):
        new[1:] &= a[field][1:] == a[field][:-1]
    new[1:] = ~new[1:]
    first = np.flatnonzero(new)
    repeated = np.diff(np.append(first, len(a))) > 1
    if len(first):
        repeated |= np.logical_or.reduceat(a["known"].astype(bool), first)
    return order, first, np.cumsum(new) - 1, repeated


def checks(rows: pa.RecordBatch) -> np.ndarray:
    return (rows.column("row2").to_numpy().view(U) & U(0xFFFFFFFF)).astype(np.uint32)


def find_atoms(texts: DataFrame, count: int) -> DataFrame:
    """Packed atoms by anchor (one of each class and block), spans of what is repeated within a block, and frequent anchors."""

    def run(batches):
        out = Outbox(count)
        seen: list[np.ndarray] = []

        def frequent():
            g, n = np.unique(np.concatenate(seen), return_counts=True)
            often = n >= 8
            out.add(COUNTS, records(COUNT, g=g[often], n=n[often]), g[often])

        for batch in batches:
            for rows, data, offsets in blocks(batch, "text"):
                text, g, lo, n = atoms(data, offsets)
                h, h2 = window_digests(data, lo, lo + n + WIDTH - 1)
                found = records(ATOM, g=g, h=h, h2=h2, row=rows.column("row").to_numpy()[text], check=checks(rows)[text], lo=lo - offsets[text], n=n)
                order, first, _, repeated = classes(found)
                head = found[order[first]]
                head["known"] = repeated
                out.add(ATOMS, head, head["g"])
                seen.append(head["g"].copy())
                twice = order[np.repeat(repeated, np.diff(np.append(first, len(order))))]
                t, a, b = unions(text[twice], lo[twice], lo[twice] + n[twice])
                at = rows.column("row").to_numpy()[t]
                out.add(SPANS, records(SPAN, row=at, check=checks(rows)[t], lo=a - offsets[t], n=b - a), at)
                if sum(map(len, seen)) > 1_000_000:
                    frequent()
                    seen = []
                if out.full():
                    yield from out.flush()
        if seen:
            frequent()
        yield from out.flush()

    return texts.mapInArrow(run, PACKED)


def hot_anchors(found: DataFrame, parts: int, hot: int, scratch: Scratch) -> np.ndarray:
    """Anchors with more than ``hot`` atoms, the most frequent ones, at most MOST."""

    def run(batches):
        for rows in buckets(batches):
            c = unpack(rows, COUNTS, COUNT)
            g, back = np.unique(c["g"], return_inverse=True)
            n = np.bincount(back, c["n"], len(g)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(g[n > hot].view(np.int64)), pa.array(n[n > hot])], ["g", "n"])

    counted = scratch.cut(deal(found.where(F.col("kind") == COUNTS), parts).mapInArrow(run, "g bigint, n bigint"), "hot")
    return np.sort(most_frequent(counted, "n", MOST).toArrow().column("g").to_numpy().view(U))  # at most MOST


def spread(found: DataFrame, hot, count: int) -> DataFrame:
    """Atoms of hot anchors dealt out by class; everything else stays where it is."""

    def run(batches):
        out = Outbox(count)
        for batch in batches:
            own = batch.column("kind").to_numpy() == ATOMS
            yield batch.filter(pa.array(~own))
            if not own.any():
                continue
            some = batch.filter(pa.array(own))
            data, offsets = text_arrays(some.column("payload"))
            a = np.frombuffer(data, ATOM)
            away = np.isin(a["g"], hot.value)
            if not away.any():
                yield some
                continue
            ends = np.concatenate([[0], np.cumsum(~away)])[offsets // ATOM.itemsize] * ATOM.itemsize
            yield pa.RecordBatch.from_arrays([some.column("kind"), some.column("part"), strings(a[~away].view(np.uint8), ends, pa.binary())], some.schema.names)
            out.add(ATOMS, a[away], a["h"][away])
            yield from out.flush()

    return found.where(F.col("kind").isin(ATOMS, SPANS)).mapInArrow(run, PACKED) if len(hot.value) else found.where(F.col("kind").isin(ATOMS, SPANS))


def match_classes(dealt: DataFrame, hot, count: int, ask: bool = True) -> DataFrame:
    """Spans of atoms whose class is repeated, and requests for one text of each class of an anchor that has several."""

    def run(batches):
        out = Outbox(count)
        for rows in buckets(batches):
            for batch in rows:
                passed = batch.filter(pa.array(batch.column("kind").to_numpy() == SPANS))
                if passed.num_rows:
                    yield passed
            a = unpack(rows, ATOMS, ATOM)
            order, first, of, repeated = classes(a)
            a = a[order]
            twice = a[repeated[of] & (a["known"] == 0)]
            out.add(SPANS, records(SPAN, row=twice["row"], check=twice["check"], lo=twice["lo"], n=twice["n"]), twice["row"])
            if ask:
                head = a[first]
                _, back, members = np.unique(head["g"], return_inverse=True, return_counts=True)
                split = np.isin(head["g"], hot.value)
                several = (members[back] > 1) | split
                asked = head[several]
                out.add(REQUESTS, records(REQUEST, row=asked["row"], check=asked["check"], g=asked["g"], lo=asked["lo"], n=asked["n"], known=repeated[several], split=split[several]), asked["row"])
            if out.full():
                yield from out.flush()
        yield from out.flush()

    return dealt.mapInArrow(run, PACKED)


TEXTS = "kind int, part int, payload binary, g bigint, row bigint, row2 bigint, lo bigint, n int, known int, text binary"


def meet(packed: DataFrame, kind: int, texts: DataFrame, parts: int, count: int, dtype: np.dtype, work, schema: str) -> DataFrame:
    """Deal packed records and texts by row; ``work(row, data, offsets, records)`` gets each block of texts with its records.

    Within a bucket the packed records come first; only they are held, the texts stream by.
    """
    left = packed.where(F.col("kind") == kind).select("part", F.lit(0).alias("late"), "payload", *[F.lit(None).cast(t).alias(c) for c, t in (("row", "bigint"), ("row2", "bigint"), ("doc_id", "bigint"), ("text", "string"))])
    right = texts.select(F.pmod("row", F.lit(count)).cast("int").alias("part"), F.lit(1).alias("late"), F.lit(None).cast("binary").alias("payload"), "row", "row2", "doc_id", "text")

    def run(batches):
        held, waiting, of = np.zeros(0, dtype), [], None
        for batch in batches:
            part, late = batch.column("part").to_numpy(), batch.column("late").to_numpy()
            edges = np.flatnonzero(np.diff(part * 2 + late)) + 1
            for a, b in zip([0, *edges.tolist()], [*edges.tolist(), len(part)]):
                if a == b:
                    continue
                if of != part[a]:
                    held, waiting, of = np.zeros(0, dtype), [], part[a]
                some = batch.slice(a, b - a)
                if not late[a]:
                    waiting.append(np.frombuffer(text_arrays(some.column("payload"))[0], dtype))
                    continue
                if waiting:
                    held = np.concatenate(waiting)
                    held, waiting = held[np.argsort(held["row"], kind="stable")], []
                for rows, data, offsets in blocks(some, "text"):
                    yield from work(rows, data, offsets, held)

    return deal(left.unionByName(right), parts, "late").mapInArrow(run, schema)


def of_rows(rows: pa.RecordBatch, held: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index of the text, record) for each record that belongs to one of the rows; held is sorted by row."""
    row = rows.column("row").to_numpy()
    first, last = np.searchsorted(held["row"], row), np.searchsorted(held["row"], row, side="right")
    text, found = np.repeat(np.arange(len(row)), last - first), held[ranges(first, last - first)]
    own = found["check"] == checks(rows)[text]
    return text[own], found[own]


def cut_out(count: int):
    """The texts of requested classes; of split ones packed atoms, one for each window."""

    def work(rows, data, offsets, held):
        text, asked = of_rows(rows, held)
        whole = asked["split"] == 0
        out = Outbox(count)
        if not whole.all():
            t, some = text[~whole], asked[~whole]
            windows = some["n"].astype(np.int64)
            each, lo = np.repeat(np.arange(len(some)), windows), ranges(some["lo"].astype(np.int64), windows)
            at = offsets[t][each] + lo
            h, h2 = window_digests(data, at, at + WIDTH)
            out.add(ATOMS, records(ATOM, g=h, h=h, h2=h2, row=some["row"][each], check=some["check"][each], lo=lo, n=np.ones(len(lo)), known=some["known"][each]), h)
            for packed in out.flush():
                empty = [pa.nulls(packed.num_rows, k) for k in (pa.int64(),) * 4 + (pa.int32(), pa.int32(), pa.binary())]
                yield pa.RecordBatch.from_arrays([*packed.columns, *empty], [f.split()[0] for f in TEXTS.split(", ")])
        text, asked = text[whole], asked[whole]
        if not len(asked):
            return
        n = len(asked)
        lo = offsets[text] + asked["lo"]
        length = asked["n"].astype(np.int64) + WIDTH - 1
        body = strings(data[ranges(lo, length)], np.concatenate([[0], np.cumsum(length)]), pa.binary())
        row2 = rows.column("row2").to_numpy()[text]
        columns = [pa.array(asked["g"].view(np.int64)), pa.array(asked["row"]), pa.array(row2), pa.array(asked["lo"].astype(np.int64)), pa.array(asked["n"].astype(np.int32)), pa.array(asked["known"].astype(np.int32)), body]
        yield pa.RecordBatch.from_arrays([pa.array(np.full(n, REQUESTS, np.int32)), pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary()), *columns], [f.split()[0] for f in TEXTS.split(", ")])

    return work


class Suffixes:
    """Suffixes of short texts, compared by prefix hashes."""

    def __init__(self, data: np.ndarray):
        self.data = data
        self.h = prefix_hashes(data)
        self.inverse = powers(INVERSE, len(data) + 1)

    def extension(self, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Longest common extension of the suffixes at a and b, up to ``most``: binary search over prefix hashes."""
        low, high = np.zeros(len(a), np.int64), most.copy()
        ha, hb, ia, ib = self.h[a], self.h[b], self.inverse[a], self.inverse[b]
        while (low < high).any():
            middle = (low + high + 1) >> 1
            same = (self.h[a + middle] - ha) * ia == (self.h[b + middle] - hb) * ib
            low, high = np.where(same, middle, low), np.where(same, high, middle - 1)
        return low

    def below(self, a: np.ndarray, end_a: np.ndarray, b: np.ndarray, end_b: np.ndarray) -> np.ndarray:
        """Whether the suffix at a, which ends at end_a, stands before that at b; a prefix stands first."""
        n = self.extension(a, b, np.minimum(end_a - a, end_b - b))
        return (a + n == end_a) & (b + n < end_b) | (a + n < end_a) & (b + n < end_b) & (self.data[np.minimum(a + n, len(self.data) - 1)] < self.data[np.minimum(b + n, len(self.data) - 1)])

    def sort(self, at: np.ndarray, end: np.ndarray, group: np.ndarray) -> np.ndarray:
        """Order of the suffixes within each group (groups are consecutive): bottom-up merge sort, all runs of a level at once."""
        n = len(at)
        order = np.arange(n)
        heads = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
        size = np.diff(np.append(heads, n))
        first, last = np.repeat(heads, size), np.repeat(heads + size, size)
        place = np.arange(n)
        width = 1
        while width < size.max():
            live = place[last - first > width]
            run = (live - first[live]) // width
            right = run % 2 == 1
            other = first[live] + np.where(right, run - 1, run + 1) * width  # start of the run to merge with
            low, stop = np.minimum(other, last[live]), np.minimum(other + width, last[live])
            base, own = low.copy(), order[live]
            while (low < stop).any():
                middle = (low + stop) >> 1
                probe = order[np.minimum(middle, n - 1)]
                # elements of the left run go before equal ones of the right run
                x, y = np.where(right, own, probe), np.where(right, probe, own)
                lower = self.below(at[x], end[x], at[y], end[y])
                goes = np.where(right, ~lower, lower)
                active = low < stop
                low, stop = np.where(active & goes, middle + 1, low), np.where(active & ~goes, middle, stop)
            start = first[live] + (run - run % 2) * width
            within = live - (first[live] + run * width)
            merged = order.copy()
            merged[start + within + (low - base)] = own
            order = merged
            width *= 2
        return order


def repeated_windows(data: np.ndarray, offsets: np.ndarray, n: np.ndarray, group: np.ndarray, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """(text, window) of the windows of short texts that recur in another text of their group; texts stand by group."""
    start = ranges(offsets[:-1], n)
    text = np.repeat(np.arange(len(n)), n)
    s = Suffixes(data)
    hashes = mix(((s.h[start + width] - s.h[start]) * s.inverse[start]) + group[text].astype(U) * U(0x9E3779B97F4A7C15))
    order = np.argsort(hashes)
    same = hashes[order][1:] == hashes[order][:-1]
    shared = np.zeros(len(start), bool)
    shared[order[1:][same]] = shared[order[:-1][same]] = True
    proven = np.zeros(len(start), bool)
    left = shared.copy()  # windows that the sort has still to decide on
    while left.any():
        # heads of runs of undecided windows, and all windows that may equal one
        before = np.zeros(len(left), bool)
        before[1:] = left[:-1] & (text[1:] == text[:-1])
        heads = left & ~before
        picked = np.flatnonzero(np.isin(hashes, hashes[heads]))
        at, end = start[picked], offsets[text[picked] + 1]
        order = s.sort(at, end, group[text[picked]])
        at, end, picked = at[order], end[order], picked[order]
        owner = group[text[picked]]
        gain = np.zeros(len(picked), np.int64)
        if len(picked) > 1:
            most = np.where(owner[1:] == owner[:-1], np.minimum(end[1:] - at[1:], end[:-1] - at[:-1]), 0)
            common = s.extension(at[:-1], at[1:], most)
            common = verified(data, at[:-1], at[1:], common)
            gain[1:] = common
            gain[:-1] = np.maximum(gain[:-1], common)
        # an extension of width + j proves j + 1 windows
        good = np.maximum(gain - width + 1, 0)
        room = n[text[picked]] - (at - offsets[text[picked]])
        reach = ranges(picked, np.minimum(good, room))
        proven[reach] = True
        left[reach] = False
        left[np.flatnonzero(heads)] = False  # decided, one way or the other
    return text[proven], (start - offsets[text])[proven]


def verified(data: np.ndarray, a: np.ndarray, b: np.ndarray, common: np.ndarray, limit: int = 1 << 20) -> np.ndarray:
    """Shorten extensions to the bytes that are indeed equal; about ``limit`` bytes are compared at a time."""
    out = common.copy()
    ends = np.concatenate([[0], np.cumsum(common)])
    i = 0
    while i < len(common):
        j = max(i + 1, int(np.searchsorted(ends, ends[i] + limit, side="right")) - 1)
        unequal = np.flatnonzero(data[ranges(a[i:j], common[i:j])] != data[ranges(b[i:j], common[i:j])]) + ends[i]
        pair = np.searchsorted(ends, unequal, side="right") - 1
        np.minimum.at(out, pair, unequal - ends[pair])
        i = j
    return out


def compare_texts(sorted_texts: DataFrame, count: int, limit: int = 2 << 20) -> DataFrame:
    """Spans of windows that recur in another class of their anchor; texts sorted by anchor within partitions."""

    def compared(held: pa.Table, out: Outbox) -> None:
        held = held.combine_chunks()
        g, row, row2, lo, n, known = (held.column(c).to_numpy() for c in ("g", "row", "row2", "lo", "n", "known"))
        group = np.cumsum(np.concatenate([[0], np.diff(g) != 0]))
        data, offsets = text_arrays(held.column("text").cast(pa.large_binary()))
        text, window = repeated_windows(data, offsets, n.astype(np.int64), group)
        new = known[text] == 0
        t, x, y = unions(text[new], window[new], window[new] + 1)
        out.add(SPANS, records(SPAN, row=row[t], check=row2[t].view(U) & U(0xFFFFFFFF), lo=lo[t] + x, n=y - x), row[t])

    def run(batches):
        out = Outbox(count)
        held: list[pa.RecordBatch] = []
        size, last = 0, None
        for batch in batches:
            g = batch.column("g").to_numpy()
            starts = np.concatenate([[0], np.cumsum(batch.column("n").to_numpy() + WIDTH - 1)])
            heads = np.flatnonzero(np.concatenate([[last is None or g[0] != last], g[1:] != g[:-1]])) if len(g) else []
            at = 0
            for edge in heads:  # groups in turn, some MB of text at a time
                if size + starts[edge] - starts[at] > limit:
                    held.append(batch.slice(at, edge - at))
                    compared(pa.Table.from_batches(held), out)
                    held, size, at = [], 0, edge
                    if out.full():
                        yield from out.flush()
            if len(g):
                held.append(batch.slice(at))
                size += starts[-1] - starts[at]
                last = g[-1]
        if held:
            compared(pa.Table.from_batches(held), out)
        yield from out.flush()

    return sorted_texts.mapInArrow(run, PACKED)


KEPT = "doc_id bigint, kept binary, removed binary, n_removed bigint"


def strip(rows, data, offsets, held):
    """Texts without the bytes of repeated windows; ``removed``: maximal runs as pairs of 64-bit integers."""
    text, span = of_rows(rows, held)
    lo = offsets[text] + span["lo"]
    t, a, b = unions(text, lo, lo + span["n"] + WIDTH - 1)
    gone = np.zeros(len(data) + 1, np.int64)
    gone[ranges(a, b - a)] = 1
    before = np.concatenate([[0], np.cumsum(gone[:-1])])[offsets]
    runs = np.column_stack([a - offsets[t], b - offsets[t]]).astype("<i8").ravel().view(np.uint8)
    where = np.searchsorted(t, np.arange(len(offsets))) * 16
    yield pa.RecordBatch.from_arrays([rows.column("doc_id"), strings(data[gone[:-1] == 0], offsets - before, pa.binary()), strings(runs, where, pa.binary()), pa.array(np.diff(before))], ["doc_id", "kept", "removed", "n_removed"])


def dedup(docs: DataFrame, parts: int | None = None, hot: int = HOT) -> DataFrame:
    """``doc_id``, ``kept`` (the remaining bytes), ``removed`` (runs of removed bytes) and ``n_removed`` of each document."""
    spark = docs.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    scratch = Scratch(spark, "substrings")
    key = [F.col("doc_id"), F.coalesce("text", F.lit(""))]
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).withColumns({"row": F.xxhash64(*key), "row2": F.xxhash64(F.lit(1), *key)})
    size = texts.agg(F.sum(F.octet_length("text").cast("bigint"))).first()[0] or 0
    count = bucket_count(size // 50, parts)

    held = scratch.cut(find_atoms(texts.select("row", "row2", "text"), count), "atoms")
    hottest = spark.sparkContext.broadcast(hot_anchors(held, parts, hot, scratch))  # at most MOST
    found = scratch.cut(match_classes(deal(spread(held, hottest, count), parts), hottest, count), "classes")
    scratch.drop("atoms")
    scratch.settle()
    cut = meet(found, REQUESTS, texts, parts, count, REQUEST, cut_out(count), TEXTS)
    if len(hottest.value):
        cut = scratch.cut(cut, "requested")
        scratch.settle()
    several = cut.where(F.col("kind") == REQUESTS).drop("kind", "part", "payload").repartition(parts, "g").sortWithinPartitions("g")
    more = scratch.cut(compare_texts(several, count), "suffixes")
    scratch.settle()
    if len(hottest.value):
        windows = cut.where(F.col("kind") == ATOMS).select("kind", "part", "payload")
        more = more.unionByName(scratch.cut(match_classes(deal(windows, parts), hottest, count, ask=False), "windows"))
        scratch.drop("requested")
    return meet(found.unionByName(more), SPANS, texts, parts, count, SPAN, strip, KEPT)


def op10_substring_dedup(spark, sf_dir: str) -> DataFrame:
    out = dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    n_kept = F.octet_length("kept").cast("bigint")
    return out.select("doc_id", (n_kept + F.col("n_removed")).alias("n_bytes"), "n_removed", F.expr("cast(octet_length(removed) div 16 as bigint)").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
