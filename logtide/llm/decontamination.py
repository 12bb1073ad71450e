"""Benchmark decontamination by a stored positional inverted index.

``build_index`` writes the documents' postings as a table of segments of about 1 MB of text: the bytes of the segment's distinct
words, and for each word the sorted positions at which the documents have it, beside the documents' own columns. ``search``
reads that table. A test window starts from the postings of its rarest word in a segment, shifted by the word's offset in the
window, and is intersected with the offset-adjusted lists of its other words, rarest first. What is left are exact phrase
matches. A proximity search asks instead that all words of a window stand, in any order, in one stretch of words: around each
posting of the rarest word, stretches that begin with a posting of some word of the window. Words meet by hash and are compared byte by byte.

Segments hold whole documents, so no posting is shuffled, and memory is bounded by a segment. The benchmark goes to the
tasks in parts of at most ``PART`` bytes of text, at most ``PASS`` bytes in a pass over the index. A larger benchmark takes
several passes, each of which keeps only what it found; findings are then united by document.

Null and empty texts have no words and are not contaminated. An item without words has no window; one of fewer than
``window`` words is a single window. Items that share an item_id count once. With an empty benchmark nothing is hit.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logtide.llm.blocks import Lanes, blocks, flags, lowered, range_digests, ranges, same_bytes, strings, text_arrays, word_spans
from logtide.scratch import Scratch

#: Bytes of benchmark text that are searched for at a time, and that are sent to the tasks of one pass.
PART, PASS = 4 << 20, 32 << 20
WINDOW = 13


class Vocabulary:
    """Distinct lower-cased words of some texts; equal hashes are held against bytes."""

    def __init__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        self.lanes, self.seed = Lanes(lowered(data)), 0
        while True:
            hashes = range_digests(self.lanes, starts, ends, self.seed)
            self.hashes, first, self.ids = np.unique(hashes, return_index=True, return_inverse=True)
            self.starts, self.lengths = starts[first], (ends - starts)[first]
            if np.array_equal(self.lengths[self.ids], ends - starts) and same_bytes(self.lanes, starts, ends - starts, self.lanes, self.starts[self.ids]).all():
                break
            self.seed += 1  # two words of one hash

    def __len__(self) -> int:
        return len(self.hashes)

    def find(self, lanes: Lanes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The number of each word, -1 if it is not there."""
        if not len(self) or not len(starts):
            return np.full(len(starts), -1, np.int64)
        hashes = range_digests(lanes, starts, ends, self.seed)
        at = np.searchsorted(self.hashes, hashes)
        at[at == len(self)] = 0
        like = np.flatnonzero((self.hashes[at] == hashes) & (self.lengths[at] == ends - starts))
        like = like[same_bytes(lanes, starts[like], (ends - starts)[like], self.lanes, self.starts[at[like]])]
        out = np.full(len(starts), -1, np.int64)
        out[like] = at[like]
        return out


class TestWindows:
    """Windows of some benchmark items: terms (windows x positions, -1 beyond a short one), lengths and items."""

    def __init__(self, item_ids: list[str], texts: list[str], window: int):
        data, offsets = text_arrays(pa.array(texts, pa.string()))
        start, end, first = word_spans(data, offsets, flags("alnum"))
        self.item_ids = sorted(set(item_ids))
        number = {x: i for i, x in enumerate(self.item_ids)}
        counts = np.diff(first)
        n_windows = np.where(counts > 0, np.maximum(counts - window + 1, 1), 0)
        starts = ranges(first[:-1], n_windows)
        lengths = np.repeat(np.minimum(counts, window), n_windows)
        items = np.repeat(np.array([number[x] for x in item_ids], np.int64), n_windows)
        self.vocabulary = Vocabulary(data, start, end)
        ids, self.vocabulary.ids = self.vocabulary.ids, None
        grid = starts[:, None] + np.arange(window)
        inside = np.arange(window) < lengths[:, None]
        terms = np.where(inside, ids[np.minimum(grid, max(len(ids) - 1, 0))] if len(ids) else -1, -1)
        rows = np.unique(np.column_stack([terms, lengths, items]), axis=0) if len(terms) else np.zeros((0, window + 2), np.int64)
        self.terms, self.lengths, self.items = rows[:, :window], rows[:, window], rows[:, window + 1]

    def __getstate__(self) -> dict:
        v = self.vocabulary
        return self.__dict__ | {"vocabulary": (v.lanes.held[:-8], v.starts, v.starts + v.lengths)}

    def __setstate__(self, state: dict) -> None:
        self.__dict__ = state | {"vocabulary": Vocabulary(*state["vocabulary"])}


class Segment:
    """Postings of one segment of the index, by the terms of a vocabulary."""

    def __init__(self, vocabulary: Vocabulary, row: dict):
        self.first = np.frombuffer(row["first"], "<i8")
        ends = np.frombuffer(row["ends"], "<i8")
        words = Lanes(np.frombuffer(row["words"], np.uint8))
        counts, positions = np.frombuffer(row["counts"], "<i4").astype(np.int64), np.frombuffer(row["positions"], "<i4").astype(np.int64)
        term = vocabulary.find(words, ends[:-1], ends[1:])
        known = np.flatnonzero(term >= 0)
        known = known[np.argsort(term[known])]
        begins = np.cumsum(counts) - counts
        self.positions = positions[ranges(begins[known], counts[known])]
        self.df = np.zeros(len(vocabulary), np.int64)
        self.df[term[known]] = counts[known]
        self.offsets = np.concatenate([[0], np.cumsum(self.df)])
        # all lists after one another, ascending
        self.width = int(self.first[-1]) + 1
        self.lists = np.repeat(term[known] * self.width, counts[known]) + self.positions
        self.text = np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def listed(self, term: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the postings of terms at positions from ``low`` to ``high`` stand in ``lists``: the first, and how many there are."""
        begin = np.searchsorted(self.lists, term * self.width + low)
        return begin, np.searchsorted(self.lists, term * self.width + high, side="right") - begin

    def rarest(self, w: TestWindows) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(candidate windows, their positions of words by rarity, candidate window of each posting, posting of its rarest word)."""
        df = np.where(w.terms >= 0, self.df[w.terms], np.iinfo(np.int64).max)
        live = np.flatnonzero(df.min(axis=1) > 0) if len(df) else np.zeros(0, np.int64)
        order = np.argsort(df[live], axis=1, kind="stable")
        lead = w.terms[live, order[:, 0]] if len(live) else np.zeros(0, np.int64)
        which = np.repeat(np.arange(len(live)), self.df[lead])
        return live, order, which, self.positions[ranges(self.offsets[lead], self.df[lead])]

    def phrases(self, w: TestWindows) -> tuple[np.ndarray, np.ndarray]:
        """(windows, word positions) of all exact occurrences within one document."""
        live, order, which, where = self.rarest(w)
        if not len(which):
            return which, where
        start = where - order[which, 0]
        end = start + w.lengths[live][which]
        text = self.text[where]
        keep = (start >= self.first[text]) & (end <= self.first[text + 1])
        which, start = which[keep], start[keep]
        for k in range(1, order.shape[1]):
            offset = order[which, k]
            term = w.terms[live[which], offset]
            # the list of the term, shifted by its offset, holds the start
            keep = (term < 0) | (self.listed(term, start + offset, start + offset)[1] > 0)
            which, start = which[keep], start[keep]
        return live[which], start

    def near(self, w: TestWindows, span: int) -> tuple[np.ndarray, np.ndarray]:
        """(windows, word positions of the rarest word) where all words of a window stand in a stretch whose first and last are ``span`` words apart at most."""
        live, order, which, where = self.rarest(w)

        def within(which: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
            """The rows between whose positions every word of their window stands."""
            left = np.arange(len(which))
            for k in range(order.shape[1]):
                if not len(left):
                    break
                term = w.terms[live[which[left]], order[which[left], k]]
                left = left[(term < 0) | (self.listed(term, low[left], high[left])[1] > 0)]
            return left

        if not len(which):
            return which, where
        text = self.text[where]
        low, high = np.maximum(where - span, self.first[text]), np.minimum(where + span, self.first[text + 1] - 1)
        left = within(which, low, high)
        which, where, low, high = which[left], where[left], low[left], high[left]
        # such a stretch begins with a word of the window, up to ``span`` words before the rarest one
        found = np.zeros(len(which), bool)
        for k in range(order.shape[1]):
            rest = np.flatnonzero(~found)
            term = w.terms[live[which[rest]], order[which[rest], k]]
            begin, n = self.listed(term, low[rest], where[rest])
            n[term < 0] = 0
            of = np.repeat(rest, n)
            start = self.positions[ranges(begin, n)]
            found[of[within(which[of], start, np.minimum(start + span, high[of]))]] = True
        return live[which[found]], where[found]


def unions(text: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Unite overlapping or touching ranges of each text."""
    if not len(text):
        return text, start, end
    order = np.lexsort((start, text))
    text, start, end = text[order], start[order], end[order]
    width = np.int64(end.max() + 1)
    reach = np.maximum.accumulate(text * width + end)
    new = np.concatenate([[True], (text[1:] * width + start[1:] > reach[:-1]) | (text[1:] != text[:-1])])
    heads = np.flatnonzero(new)
    return text[heads], start[heads], np.maximum.reduceat(end, heads)


def test_parts(benchmark: DataFrame, window: int, part: int) -> Iterator[tuple[int, TestWindows]]:
    """(bytes, windows) of parts of the benchmark."""
    ids: list[str] = []
    texts: list[str] = []
    held = 0
    # an item id is sorted and joined as a string
    for row in benchmark.select(F.col("item_id").cast("string"), F.coalesce("text", F.lit("")), F.octet_length("text")).toLocalIterator(prefetchPartitions=False):
        ids.append(row[0] if row[0] is not None else "")
        texts.append(row[1])
        held += row[2] or 0
        if held >= part:
            yield held, TestWindows(ids, texts, window)
            ids, texts, held = [], [], 0
    yield held, TestWindows(ids, texts, window)


SEGMENT = "segment bigint, first binary, words binary, ends binary, counts binary, positions binary"


def build_index(docs: DataFrame, carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """One row for each segment: ``rows`` (the carried columns of its documents) and the postings of its words."""
    picked = docs.select(F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row"), F.col("text")) if "text" not in carry else docs.select(F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row"))
    schema = T.StructType([T.StructField("rows", T.ArrayType(picked.schema["row"].dataType)), *T.StructType.fromDDL(SEGMENT).fields])

    def run(batches):
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            held = batch if "text" in batch.schema.names else pa.RecordBatch.from_arrays([batch.column("row"), batch.column("row").field("text")], ["row", "text"])
            for rows, data, offsets in blocks(held, "text"):
                start, end, first = word_spans(data, offsets, flags("alnum"))
                v = Vocabulary(data, start, end)
                order = np.argsort(v.ids, kind="stable")
                ends = np.concatenate([[0], np.cumsum(v.lengths)])
                words = v.lanes.held[ranges(v.starts, v.lengths)]
                packed = (first.astype("<i8"), words, ends.astype("<i8"), np.bincount(v.ids, minlength=len(v)).astype("<i4"), order.astype("<i4"))
                own = pa.ListArray.from_arrays(pa.array([0, rows.num_rows], pa.int32()), rows.column("row"))
                yield pa.RecordBatch.from_arrays([own, pa.array([number]), *(pa.array([x.tobytes()], pa.binary()) for x in packed)], schema.fieldNames())
                number += 1

    return Scratch(docs.sparkSession, "postings").cut(picked.mapInArrow(run, schema), "segments")


FIELDS = "n_words bigint, n_hit bigint, hits binary, items array<string>, near_items array<string>"


def packed_runs(text: np.ndarray, start: np.ndarray, end: np.ndarray, n: int) -> tuple[np.ndarray, pa.Array]:
    """(covered positions, united runs as pairs of 64-bit integers) of each of n texts."""
    text, start, end = unions(text, start, end)
    at = np.searchsorted(text, np.arange(n + 1)) * 16
    return np.bincount(text, end - start, n).astype(np.int64), strings(np.column_stack([start, end]).astype("<i8").ravel().view(np.uint8), at, pa.binary())


def search_pass(index: DataFrame, windows: list[TestWindows], span: int | None) -> DataFrame:
    """``row``, ``segment``, ``place`` and FIELDS of each document, for some of the benchmark's windows."""
    shared = index.sparkSession.sparkContext.broadcast(windows)  # PASS bytes of text at most, or one item
    kind = index.schema["rows"].dataType.elementType
    schema = T.StructType([T.StructField("row", kind), *T.StructType.fromDDL("segment bigint, place bigint, " + FIELDS).fields])

    def run(batches):
        for batch in batches:
            rows = batch.column("rows")
            for i in range(batch.num_rows):
                own = rows[i].values
                n = len(own)
                row = {c: batch.column(c)[i].as_buffer() for c in ("first", "words", "ends", "counts", "positions")}
                runs = [np.zeros((3, 0), np.int64)]
                found: list[set[str]] = [set() for _ in range(n)]
                close: list[set[str]] = [set() for _ in range(n)]
                for w in shared.value:
                    segment = Segment(w.vocabulary, row)
                    which, start = segment.phrases(w)
                    text = segment.text[start]
                    runs.append(np.array([text, start - segment.first[text], start - segment.first[text] + w.lengths[which]]))
                    pairs = [(text, which, found)]
                    if span is not None:
                        which, where = segment.near(w, span)
                        pairs.append((segment.text[where], which, close))
                    for t, which, into in pairs:
                        for k, j in np.unique(np.column_stack([t, w.items[which]]), axis=0).tolist():
                            into[k].add(w.item_ids[j])
                covered, hits = packed_runs(*np.concatenate(runs, axis=1), n)
                n_words = np.diff(np.frombuffer(row["first"], "<i8"))
                near = pa.array([sorted(x) for x in close] if span is not None else [None] * n, pa.list_(pa.string()))
                columns = [pa.array(np.repeat(batch.column("segment")[i].as_py(), n)), pa.array(np.arange(n)), pa.array(n_words), pa.array(covered), hits, pa.array([sorted(x) for x in found], pa.list_(pa.string())), near]
                yield pa.RecordBatch.from_arrays([own, *columns], schema.fieldNames())

    return index.mapInArrow(run, schema)


def search(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, span: int | None = None, carry: tuple[str, ...] = ("doc_id",), part: int = PART, most: int = PASS) -> DataFrame:
    """``row`` (the carried columns), ``n_words``, ``n_hit``, ``hits``, ``items``, ``near_items`` and ``contaminated`` for each document.

    n_hit: hit words. hits: maximal runs of them, packed as pairs of 64-bit integers (first word, word after the last). items:
    ids of the items of which a window occurs. near_items: those of which all words of a window stand in a stretch
    whose first and last words are ``span`` words apart at most (null without ``span``). contaminated: a twentieth of the words is hit, at least one.
    """
    index = build_index(docs, carry)
    scratch = Scratch(docs.sparkSession, "hits")
    held: list[TestWindows] = []
    size, later, out = 0, [], None
    for n, windows in test_parts(benchmark, window, part):
        if held and size + n > most:
            later.append(scratch.cut(search_pass(index, held, span).where("n_hit > 0 or size(near_items) > 0").drop("row"), f"pass-{len(later)}"))
            held, size = [], 0
        held.append(windows)
        size += n
    out = search_pass(index, held, span)
    if later:
        key, fields = ["segment", "place"], ["n_words", "n_hit", "hits", "items", "near_items"]
        found = scratch.cut(out, "last")
        united = found.drop("row")
        for some in later:
            united = united.unionByName(some)
        lists = united.groupBy(*key).agg(F.first("n_words").alias("n_words"), F.collect_list("hits").alias("parts"), *(F.array_sort(F.array_distinct(F.flatten(F.collect_list(c)))).alias(c) for c in ("items", "near_items")))  # one row for each pass

        @F.arrow_udf("n_hit bigint, hits binary")
        def unite(parts: pa.Array) -> pa.Array:
            text = np.repeat(np.arange(len(parts)), [sum(len(x) // 16 for x in row) for row in parts.to_pylist()])
            pairs = np.frombuffer(b"".join(b"".join(row) for row in parts.to_pylist()), "<i8").reshape(-1, 2)
            return pa.StructArray.from_arrays([pa.array((r := packed_runs(text, pairs[:, 0], pairs[:, 1], len(parts)))[0]), r[1]], ["n_hit", "hits"])

        near = F.when(F.lit(span is not None), F.col("near_items")).alias("near_items")
        lists = lists.select(*key, "n_words", unite("parts").alias("u"), "items", near).select(*key, "n_words", "u.n_hit", "u.hits", "items", "near_items")
        out = found.select(*key, "row").join(lists, key).select("row", *fields)
    contaminated = (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))
    return out.select("row", "n_words", "n_hit", "hits", "items", "near_items", contaminated.alias("contaminated"))


def op6_decontamination(spark, sf_dir: str) -> DataFrame:
    docs, benchmark = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    return search(docs, benchmark).select(
        "row.doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ",").cast("binary"), 256).alias("items_sha256"),
        "contaminated",
    )


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that are not contaminated, with their own columns."""
    return search(docs, benchmark, carry=tuple(docs.columns)).where(~F.col("contaminated")).select("row.*")
