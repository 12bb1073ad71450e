"""N-gram Jaccard self-join with adaptive multi-match prefixes, as classes of linked documents.

A document's set is that of its distinct 5-word shingles. Documents of the same words in the same order are one member of the
join, known by a 128-bit BLAKE2 digest of them. Tokens are 64-bit hashes of shingles and have a global order: frequent ones
last (frequencies of what recurs within a task's input, summed over all tasks), by hash among equals. Two sets of a similarity
of t or more share a token among the first n - ceil(t n) + 1 of their n tokens, and l of them among the first
n - ceil(t n) + l. Each document picks its own l by estimated cost: a longer prefix has more postings to read, but a pair is
verified only if it shares as many prefix tokens as the smaller l of the two.

1. Sizes of sets, and frequencies of tokens.
2. Prefix tokens are dealt out by token. Tokens of one member only go no further; the others are posting lists. The list of a
   token with more than ``SPLIT`` expected postings is dealt out in parts.
3. Lists drop links that can't change the result. In the first two rounds each list proposes its members against the one
   with the most postings (a group of copies has an original). Verified links make classes. The last round proposes all
   pairs of a list that are in different classes and pass the length, position and multi-match filters; the parts of a
   split list meet two by two, each two in a bucket of their own. So a group of many near copies costs about one
   verification for each member, yet no link between classes is lost.
4. Proposed pairs are verified from whole texts: shingles with equal hashes are held against each other word by word, and
   words byte by byte.

Postings travel as packed arrays, and a task holds one bucket of them at a time. Null texts and texts without words have no
set and are linked with nothing; with fewer than five words the whole sequence is the only shingle. Each row is a document of
its own: rows that share a doc_id but not their text are linked only if their texts are, and may be in two classes.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logtide.llm.blocks import Lanes, U, blocks, flags, lowered, mix, range_digests, ranges, same_bytes, text_arrays, word_spans
from logtide.llm.components import components
from logtide.llm.packed import PACKED, Outbox, bucket_count, buckets, deal, records, unpack
from logtide.llm.samples import most_frequent
from logtide.scratch import Scratch

WORDS = 5
#: Similarity of 75 / 100: 100 * intersection >= 75 * union.
PERCENT = 75
#: A token that recurs so often in the distinct sets of some rows of a task counts as frequent; at most MOST of them are told apart.
FREQUENT, MOST = 8, 1 << 16
#: Postings of a part of a list that is dealt out in parts.
SPLIT = 1 << 15
#: Largest l, and the cost of a verification in postings.
LONGEST, VERIFY = 4, 8.0
MORE = 24
#: One in so many lists proposes pairs in the rounds before the last.
SOME = 4
POSTING = np.dtype([("token", "<u8"), ("set", "<i8"), ("at", "<u4")])
MEMBER = np.dtype([("set", "<i8"), ("n", "<u4"), ("l", "<u4")])
LISTED = np.dtype([("token", "<u8"), ("set", "<i8"), ("at", "<u4"), ("size", "<u4")])
PLACED = np.dtype([("token", "<u8"), ("set", "<i8"), ("class", "<i8"), ("n", "<u4"), ("l", "<u4"), ("at", "<u4"), ("degree", "<f4"), ("side", "<u1")])
PAIR = np.dtype([("a", "<i8"), ("b", "<i8"), ("need", "<u4"), ("lists", "<u4")])
POSTINGS, MEMBERS, LISTS, ACTIVE, PAIRS = 0, 1, 2, 3, 4


class Shingles:
    """The words of some texts, and their shingles: the first word and the number of words of each."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, words: int = WORDS):
        self.words = words
        self.start, self.end, self.first = word_spans(data, offsets, flags("space"))
        self.lanes = Lanes(lowered(data))
        counts = np.diff(self.first)
        self.many = np.where(counts > 0, np.maximum(counts - words + 1, 1), 0)
        self.edges = np.concatenate([[0], np.cumsum(self.many)])
        self.begin, self.length = ranges(self.first[:-1], self.many), np.repeat(np.minimum(counts, words), self.many)
        self._ids: np.ndarray | None = None

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each shingle: equal ones for equal words, hardly ever for others."""
        w = range_digests(self.lanes, self.start, self.end)
        n, padded = len(w), np.concatenate([w, np.zeros(self.words, U)])
        g = np.full(n, U(self.words))
        for k in range(self.words):
            g = (g + padded[k : k + n]) * U(0x9FB21C651E98DF25)
        h = g[self.begin]
        short = np.flatnonzero(self.length < self.words)
        if len(short):
            begin, length = self.begin[short], self.length[short]
            g = length.astype(U)
            for k in range(self.words):
                g = np.where(length > k, (g + padded[begin + k]) * U(0x9FB21C651E98DF25), g)
            h[short] = g
        return mix(h)

    def equal(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Whether the shingles x and y are the same words, byte by byte."""
        out = self.length[x] == self.length[y]
        if not out.all():
            out[out] = self.equal(x[out], y[out])
            return out
        # neighbours that match neighbours share words: one comparison for each word of such a run
        i, j, n = self.begin[x], self.begin[y], self.length[x]
        joins = np.zeros(len(x), bool)
        joins[1:] = (i[1:] == i[:-1] + 1) & (j[1:] == j[:-1] + 1) & (n[1:] == n[:-1])
        more = np.where(joins, 1, n)
        a, b = ranges(i + n - more, more), ranges(j + n - more, more)
        size = self.end[a] - self.start[a]
        good = size == self.end[b] - self.start[b]
        good[good] = same_bytes(self.lanes, self.start[a[good]], size[good], self.lanes, self.start[b[good]])
        if good.all():
            return out
        if len(x) > 1:  # hashes that deceive: one by one
            return np.concatenate([self.equal(x[k : k + 1], y[k : k + 1]) for k in range(len(x))])
        return good.all(keepdims=True)

    def sets(self, h: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """(sorted hashes, shingles) of each text, a shingle once; those of one hash are held against each other."""
        out = []
        for a, b in zip(self.edges[:-1].tolist(), self.edges[1:].tolist()):
            order = np.argsort(h[a:b], kind="stable") + a
            mine = h[order]
            same = np.flatnonzero(mine[1:] == mine[:-1]) + 1
            if len(same):
                twice = self.equal(order[same], order[same - 1])
                keep = np.ones(len(order), bool)
                keep[same[twice]] = False
                order, mine = order[keep], mine[keep]
            out.append((mine, order))
        return out

    def digests(self) -> np.ndarray:
        """128 bits (as two integers) of the words in their order; 0 without words."""
        length = self.end - self.start
        joined = self.lanes.held[ranges(self.start, length + 1)]
        ends = np.cumsum(length + 1)
        joined[ends - 1] = 32
        at = np.concatenate([[0], ends])[self.first]
        raw = memoryview(joined)
        found = b"".join(hashlib.blake2b(raw[a:b], digest_size=16).digest() if a < b else bytes(16) for a, b in zip(at[:-1].tolist(), at[1:].tolist()))
        return np.frombuffer(found, "<i8").reshape(-1, 2)


def shingles(data: np.ndarray, offsets: np.ndarray, words: int = WORDS) -> tuple[np.ndarray, np.ndarray, Shingles]:
    """(sorted hashes of the distinct shingles of each text, offsets, the shingles)."""
    s = Shingles(data, offsets, words)
    h = s.hashes()
    sets = s.sets(h)
    return np.concatenate([x for x, _ in sets]) if sets else h, np.concatenate([[0], np.cumsum([len(x) for x, _ in sets])]).astype(np.int64), s


def member_ids(digests: np.ndarray, moved: np.ndarray) -> np.ndarray:
    """64 bits for each digest; ``moved``: first halves that several digests share, whose members are known by the second."""
    out = digests[:, 0].copy()
    if len(moved):
        hit = np.isin(out, moved)
        out[hit] = mix(digests[hit, 1].astype(np.int64).view(U) ^ U(0xD1B54A32D192ED03)).view(np.int64)
    return out


def describe(texts: DataFrame) -> DataFrame:
    """kind 0: (row, row2, doc_id, n, key, key2) of each document. kind 1: (key: a frequent token, n: its count)."""
    schema = "kind int, row bigint, row2 bigint, doc_id bigint, n bigint, key bigint, key2 bigint"
    names = [f.split()[0] for f in schema.split(", ")]

    def run(batches):
        seen: set[int] = set()
        held: list[np.ndarray] = []

        def frequent():
            token, count = np.unique(np.concatenate(held), return_counts=True)
            keep = count >= FREQUENT
            token, count = pa.array(token[keep].view(np.int64)), pa.array(count[keep])
            return pa.RecordBatch.from_arrays([pa.array(np.ones(len(token), np.int32)), token, token, token, count, token, token], names)

        for batch in batches:
            for rows, data, offsets in blocks(batch, "text"):
                h, edges, s = shingles(data, offsets)
                keys = s.digests()
                n = np.diff(edges)
                yield pa.RecordBatch.from_arrays([pa.array(np.zeros(len(n), np.int32)), *(rows.column(c) for c in ("row", "row2", "doc_id")), pa.array(n), pa.array(keys[:, 0]), pa.array(keys[:, 1])], names)
                new = [i for i, k in enumerate(keys[:, 0].tolist()) if k not in seen and not seen.add(k)]
                held.append(h[ranges(edges[new], n[new])])
                if sum(map(len, held)) > 2_000_000:
                    yield frequent()
                    held, seen = [], set()
        if held:
            yield frequent()

    return texts.select("row", "row2", "doc_id", "text").mapInArrow(run, schema)


class Frequent:
    """The most frequent tokens, and into how many parts their lists are split."""

    def __init__(self, tokens: np.ndarray, counts: np.ndarray, split: int = SPLIT):
        order = np.argsort(tokens)
        self.split = split
        self.tokens, self.counts = tokens[order], counts[order].astype(np.float64)

    def of(self, tokens: np.ndarray) -> np.ndarray:
        """Counts; 1 for all other tokens."""
        out = np.ones(len(tokens))
        if len(self.tokens):
            at = np.minimum(np.searchsorted(self.tokens, tokens), len(self.tokens) - 1)
            hit = self.tokens[at] == tokens
            out[hit] = self.counts[at[hit]]
        return out

    def part(self, tokens: np.ndarray, sets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(parts of the token's list, the part of the set)."""
        parts = np.ceil(self.of(tokens) / self.split).astype(np.int64)
        return parts, (mix(np.ascontiguousarray(sets).view(U)) % parts.astype(U)).astype(np.int64)


def list_id(token: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Id of a part of a list, or of two parts that meet."""
    pair = (low.astype(U) << U(32)) | high.astype(U)
    return np.where(pair > 0, mix(token ^ mix(pair)), token)


def least(n, percent: int = PERCENT):
    """Smallest overlap of a set of n tokens with any set that it is linked with."""
    return (percent * n + 99) // 100


def overlap(a, b, percent: int = PERCENT):
    """Smallest overlap of two linked sets of these sizes."""
    return (percent * (a + b) + 99 + percent) // (100 + percent)


def needed(n, l, m, k):
    """(smallest overlap, shared prefix tokens) that sets of n and m tokens with prefixes for l and k must have to be linked.

    Linked sets share ``need`` of their first n - overlap + need and m - overlap + need tokens, for any need. The larger it
    is, the fewer sets pass that share a passage only; it may not reach beyond the prefixes, and grows with the sets by one
    in MORE, so that short sets whose last prefix tokens are frequent ones don't meet there.
    """
    both = overlap(n, m)
    return both, np.minimum(both - np.maximum(least(n) - l, least(m) - k), np.minimum(l, k) + both // MORE)


def prefix(order: np.ndarray, frequency: np.ndarray) -> tuple[int, int]:
    """(l, prefix length) of a document, from its tokens' frequencies in the global order."""
    n = len(order)
    short = n - int(least(n)) + 1
    longest = min(LONGEST, n - short + 1)
    if frequency[: short + longest - 1].max() <= 1:
        return 1, short
    others = np.cumsum(frequency[: short + longest - 1] - 1.0)
    costs = [short + k + others[short + k - 1] * (1 + VERIFY / (k + 1) ** 2) for k in range(longest)]
    best = int(np.argmin(costs))
    return best + 1, short + best


def find_postings(texts: DataFrame, frequent, moved, count: int) -> DataFrame:
    """Packed prefix postings by token, and the size and l of each member by member; a member once in each task at most."""

    def run(batches):
        seen: set[int] = set()
        out = Outbox(count)
        for batch in batches:
            for _, data, offsets in blocks(batch, "text"):
                h, edges, s = shingles(data, offsets)
                keys = member_ids(s.digests(), moved.value)
                frequency = frequent.value.of(h)
                # frequent tokens last, by hash among those of one power of two
                order = (np.log2(frequency).astype(U) << U(58)) | (h >> U(6))
                picked, sets, places, members = [], [], [], []
                for i, key in enumerate(keys.tolist()):
                    a, b = int(edges[i]), int(edges[i + 1])
                    if a == b or key in seen:
                        continue
                    seen.add(key)
                    mine = np.argsort(order[a:b], kind="stable")
                    l, length = prefix(mine, frequency[a:b][mine])
                    picked.append(h[a:b][mine[:length]])
                    sets.append((key, length))
                    places.append(np.arange(length))
                    members.append((key, b - a, l))
                if picked:
                    token = np.concatenate(picked)
                    owner = np.repeat(*(np.array(x) for x in zip(*sets)))
                    part = frequent.value.part(token, owner)[1]
                    out.add(POSTINGS, records(POSTING, token=token, set=owner, at=np.concatenate(places)), list_id(token, part, part))
                    m = np.array(members, MEMBER)
                    out.add(MEMBERS, m, m["set"])
                if len(seen) > 1 << 20:
                    seen = set()
                if out.full():
                    yield from out.flush()
        yield from out.flush()

    return texts.select("text").mapInArrow(run, PACKED)


def find_lists(dealt: DataFrame, frequent, count: int) -> DataFrame:
    """Postings of tokens that several members have, by member; what is known of the members passes through."""

    def run(batches):
        for rows in buckets(batches):
            for batch in rows:
                passed = batch.filter(pa.array(batch.column("kind").to_numpy() == MEMBERS))
                if passed.num_rows:
                    yield passed
            p = unpack(rows, POSTINGS, POSTING)
            if not len(p):
                continue
            parts, part = frequent.value.part(p["token"], p["set"])
            order = np.lexsort((p["set"], part, p["token"]))
            p, part, parts = p[order], part[order], parts[order]
            token = p["token"]
            head = np.concatenate([[True], (token[1:] != token[:-1]) | (part[1:] != part[:-1])])
            new = head | np.concatenate([[True], p["set"][1:] != p["set"][:-1]])
            p, head, parts = p[new], head[new], parts[new]
            heads = np.flatnonzero(head)
            size = np.diff(np.append(heads, len(p)))
            each = np.repeat(size, size) * parts
            p, each = p[each > 1], each[each > 1]
            out = Outbox(count)
            out.add(LISTS, records(LISTED, token=p["token"], set=p["set"], at=p["at"], size=np.minimum(each, (1 << 32) - 1)), p["set"])
            active = np.unique(p["set"])
            out.add(ACTIVE, active, active)
            yield from out.flush()

    return dealt.mapInArrow(run, PACKED)


def place(found: DataFrame, classes: DataFrame | None, frequent, parts: int, count: int, last: bool) -> DataFrame:
    """Lists with the class, size, l and degree of each member, packed by list; one in SOME lists before the last round."""
    packed = found.where(F.col("kind").isin(MEMBERS, LISTS)).select("part", "kind", "payload", F.lit(None).cast("bigint").alias("node"), F.lit(None).cast("bigint").alias("component"))
    if classes is not None:
        rows = classes.select(F.pmod("node", F.lit(count)).cast("int").alias("part"), F.lit(-1).alias("kind"), F.lit(None).cast("binary").alias("payload"), "node", "component")
        packed = packed.unionByName(rows)

    def run(batches):
        out = Outbox(count)
        for rows in buckets(batches):
            p, m = unpack(rows, LISTS, LISTED), unpack(rows, MEMBERS, MEMBER)
            if not len(p):
                continue
            m = m[np.unique(m["set"], return_index=True)[1]]
            at = np.searchsorted(m["set"], p["set"])
            degree = np.bincount(at, p["size"] - 1.0, minlength=len(m))
            label = m["set"].copy()
            for batch in rows:
                own = batch.filter(pa.array(batch.column("kind").to_numpy() == -1))
                node = own.column("node").to_numpy(zero_copy_only=False)
                where = np.minimum(np.searchsorted(m["set"], node), len(m) - 1)
                hit = m["set"][where] == node
                label[where[hit]] = own.column("component").to_numpy(zero_copy_only=False)[hit]
            if not last:
                keep = mix(p["token"] ^ U(0x5851F42D4C957F2D)) % U(SOME) == 0
                p, at = p[keep], at[keep]
            split, part = frequent.value.part(p["token"], p["set"])
            side = np.full(len(p), 2, np.uint8)
            low, high = part, part
            if last:  # each part of a list meets itself and every other part
                each = np.arange(len(p))
                again = np.repeat(each, split)
                other = ranges(np.zeros(len(p), np.int64), split)
                p, at, own = p[again], at[again], part[again]
                low, high = np.minimum(own, other), np.maximum(own, other)
                side = np.where(own == other, 2, own > other).astype(np.uint8)
            lists = list_id(p["token"], low, high + (split > 1)[again] if last else high)
            placed = records(PLACED, token=lists, set=p["set"], at=p["at"], n=m["n"][at], l=m["l"][at], degree=degree[at], side=side)
            placed["class"] = label[at]
            out.add(LISTS, placed, lists)
            if out.full():
                yield from out.flush()
        yield from out.flush()

    return deal(packed, parts).mapInArrow(run, PACKED)


def proposals(p: np.ndarray, last: bool) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of records to verify; p: records sorted by token, all lists whole."""
    heads = np.flatnonzero(np.concatenate([[True], p["token"][1:] != p["token"][:-1]]))
    size = np.diff(np.append(heads, len(p)))
    low, high = np.minimum.reduceat(p["class"], heads), np.maximum.reduceat(p["class"], heads)
    p = p[np.repeat(low < high, size)]
    if not len(p):
        return p, p
    if not last:
        # every member against the list's member of the highest degree, if in another class
        p = p[np.lexsort((p["set"], -p["degree"], p["token"]))]
        heads = np.concatenate([[True], p["token"][1:] != p["token"][:-1]])
        centre = p[np.maximum.accumulate(np.where(heads, np.arange(len(p)), 0))]
        apart = centre["class"] != p["class"]
        return centre[apart], p[apart]
    # by size within a list: partners of a record are a run of larger ones
    p = p[np.lexsort((p["set"], p["n"], p["token"]))]
    n, rest = p["n"].astype(np.int64), p["n"].astype(np.int64) - p["at"]
    ids = np.cumsum(np.concatenate([[True], p["token"][1:] != p["token"][:-1]]))
    wide = np.int64(n.max()) * 2 + 2
    # n2 with 100 n >= PERCENT n2, and overlap(n, n2) <= rest + need - 1 for the largest need that a pair may have
    by_length = 100 * n // PERCENT
    by_place = ((100 + PERCENT) * ((rest + p["l"] - 1) * MORE // (MORE - 1) + 1)) // PERCENT - n
    stop = np.searchsorted(ids * wide + n, ids * wide + np.minimum(by_length, np.clip(by_place, 0, wide - 1)), side="right")
    own = np.arange(len(p))
    count = np.maximum(stop - own - 1, 0)
    return p, (own, count)


def candidate_pairs(p: np.ndarray, last: bool, limit: int = 1 << 20):
    """(a, b, tokens that they need to share) of proposed pairs, some lists at a time."""
    p = p[np.argsort(p["token"], kind="stable")]
    if not len(p):
        return
    if not last:
        x, y = proposals(p, False)
        if len(x):
            # a pair that is worth the try shares half of what is looked at here of a prefix
            yield x["set"], y["set"], np.maximum(1, np.minimum(x["n"], y["n"]).astype(np.int64) // (8 * SOME))
        return
    p, found = proposals(p, True)
    if not len(p):
        return
    own, count = found
    total = np.concatenate([[0], np.cumsum(count)])
    i = 0
    while i < len(p):
        j = max(i + 1, int(np.searchsorted(total, total[i] + limit, side="right")) - 1)
        x = np.repeat(own[i:j], count[i:j])
        y = ranges(own[i:j] + 1, count[i:j])
        i = j
        a, b = p[x], p[y]
        n, m, l, k = (v.astype(np.int64) for v in (a["n"], b["n"], a["l"], b["l"]))
        both, need = needed(n, l, m, k)
        keep = (a["class"] != b["class"]) & (np.minimum(n - a["at"], m - b["at"]) + need - 1 >= both)
        keep &= (a["side"] != b["side"]) | (a["side"] == 2)  # two of one part meet where that part meets itself
        if keep.any():
            yield a["set"][keep], b["set"][keep], need[keep]


def counted(pairs: np.ndarray) -> np.ndarray:
    """Each pair once, its lists added up."""
    pairs = pairs[np.lexsort((pairs["b"], pairs["a"]))]
    if not len(pairs):
        return pairs
    heads = np.flatnonzero(np.concatenate([[True], (pairs["a"][1:] != pairs["a"][:-1]) | (pairs["b"][1:] != pairs["b"][:-1])]))
    out = pairs[heads]
    out["lists"] = np.add.reduceat(pairs["lists"], heads)
    return out


def propose(placed: DataFrame, last: bool, parts: int, count: int) -> DataFrame:
    """Distinct pairs (a, b) to verify, that share as many prefix tokens as they need."""

    def propose_pairs(batches):
        out = Outbox(count)
        for rows in buckets(batches):
            for a, b, need in candidate_pairs(unpack(rows, LISTS, PLACED), last):
                pairs = counted(records(PAIR, a=np.minimum(a, b), b=np.maximum(a, b), need=need, lists=np.ones(len(a))))
                out.add(PAIRS, pairs, mix(pairs["a"].view(U) ^ mix(pairs["b"].view(U))))
                if out.full():
                    yield from out.flush()
        yield from out.flush()

    def count_lists(batches):
        for rows in buckets(batches):
            pairs = counted(unpack(rows, PAIRS, PAIR))
            pairs = pairs[pairs["lists"] >= pairs["need"]]
            yield pa.RecordBatch.from_arrays([pa.array(pairs["a"]), pa.array(pairs["b"])], ["a", "b"])

    found = deal(placed, parts).mapInArrow(propose_pairs, PACKED)
    return deal(found, parts).mapInArrow(count_lists, "a bigint, b bigint")


def similar(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Whether texts 0 and 1, 2 and 3, ... are similar enough."""
    s = Shingles(data, offsets)
    sets = s.sets(s.hashes())
    out = np.zeros(len(sets) // 2, bool)
    for k in range(len(out)):
        (a, at), (b, there) = sets[2 * k], sets[2 * k + 1]
        where = np.minimum(np.searchsorted(b, a), max(len(b) - 1, 0))
        hit = b[where] == a if len(b) else np.zeros(len(a), bool)
        if 100 * int(hit.sum()) < PERCENT * (len(a) + len(b) - int(hit.sum())) or not hit.any():
            continue  # too few even if all of them are equal indeed
        x, y = at[hit], there[where[hit]]
        order = np.argsort(x)
        common = int(s.equal(x[order], y[order]).sum())
        out[k] = 100 * common >= PERCENT * (len(a) + len(b) - common)
    return out


def verify(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs whose sets are similar enough; texts: (set, text)."""
    side = lambda x: texts.select(F.col("set").alias(x), F.col("text").alias(f"text_{x}"))

    def run(batches):
        for batch in batches:
            good = np.zeros(batch.num_rows, bool)
            at = 0
            for part, data, offsets in blocks(batch, "text_a"):
                other, ends = text_arrays(part.column("text_b"))
                both = np.column_stack([np.diff(offsets), np.diff(ends)]).ravel()
                start = np.column_stack([offsets[:-1], ends[:-1] + len(data)]).ravel()
                good[at : at + part.num_rows] = similar(np.concatenate([data, other])[ranges(start, both)], np.concatenate([[0], np.cumsum(both)]))
                at += part.num_rows
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(pa.array(good)), batch.column("b").filter(pa.array(good))], ["a", "b"])

    return pairs.join(side("b"), "b").join(side("a"), "a").select("a", "b", "text_a", "text_b").mapInArrow(run, "a bigint, b bigint")


def row_keys(docs: DataFrame) -> DataFrame:
    """Adds ``\x00row`` and ``\x00row2``: 128 bits of doc_id and text."""
    key = [F.col("doc_id").cast("bigint"), F.coalesce("text", F.lit(""))]
    return docs.withColumns({"\x00row": F.xxhash64(*key), "\x00row2": F.xxhash64(F.lit(1), *key)})


def classes_of(docs: DataFrame, split: int = SPLIT) -> DataFrame:
    """``row``, ``row2``, ``doc_id``, ``n`` (size of the set), ``class`` (null without a set) and ``component`` (its smallest doc_id) for each document."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "jaccard")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    texts = row_keys(docs).select(F.col("\x00row").alias("row"), F.col("\x00row2").alias("row2"), F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    told = scratch.cut(describe(texts), "described")
    top = most_frequent(scratch.cut(told.where("kind = 1").groupBy("key").agg(F.sum("n").alias("n")), "frequent"), "n", MOST).toArrow()  # at most MOST
    shared = spark.sparkContext.broadcast
    frequent = shared(Frequent(top.column("key").to_numpy().view(U), top.column("n").to_numpy(), split))  # at most MOST tokens
    # first halves of digests that different digests share: squares of the members over 2 ** 65, some dozens at 10 ** 10
    twins = told.where("kind = 0 and n > 0").groupBy("key").agg(F.min("key2").alias("low"), F.max("key2").alias("high")).where("low <> high").select("key").limit(MOST + 1).toArrow()
    if len(twins) > MOST:
        raise ValueError("too many members of equal hashes")
    moved = shared(twins.column("key").to_numpy())
    own = F.col("key")
    if len(twins):
        second = F.udf(lambda key, key2: int(member_ids(np.array([[key, key2]]), moved.value)[0]), "bigint")
        own = F.when(F.col("key").isin(twins.column("key").to_pylist()), second("key", "key2")).otherwise(own)
    documents = told.where("kind = 0").select("row", "row2", "doc_id", "n", own.alias("set"))

    postings = documents.agg(F.sum(F.expr(f"n * {100 - PERCENT} div 100 + {LONGEST + 1}"))).first()[0] or 0
    count = bucket_count(postings, parts)
    lists = scratch.cut(find_lists(deal(find_postings(texts, frequent, moved, count), parts), frequent, count), "lists")
    scratch.settle()

    # the texts of members that share a token with another one
    def members(batches):
        for rows in buckets(batches):
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(unpack(rows, ACTIVE, np.dtype("<i8"))))], ["set"])

    active = deal(lists.where(F.col("kind") == ACTIVE), parts).mapInArrow(members, "set bigint")
    rows = documents.where("n > 0").groupBy("set").agg(F.min(F.struct("row", "row2")).alias("r")).join(active, "set").select("set", "r.row", "r.row2")
    # rows that recur are told by the key that the join has dealt them by
    found = texts.select("row", "row2", "text").join(rows, ["row", "row2"]).groupBy("row", "row2").agg(F.first("set").alias("set"), F.first("text").alias("text"))
    known = scratch.cut(found.select("set", "text"), "texts")
    scratch.settle()
    links: DataFrame | None = None
    classes: DataFrame | None = None
    for n, last in enumerate((False, False, True)):
        pairs = propose(place(lists, classes, frequent, parts, count, last), last, parts, count)
        new = scratch.cut(verify(pairs, known), f"links-{n}")
        scratch.settle()
        if new.isEmpty():
            continue
        links = new if links is None else links.unionByName(new)
        classes = components(links, scratch, f"classes-{n}")
    for name in ("lists", "texts"):
        scratch.drop(name)
    scratch.settle()
    if classes is None:
        labelled = documents.withColumn("class", F.col("set"))
    else:
        labelled = documents.join(classes.select(F.col("node").alias("set"), F.col("component").alias("of")), "set", "left").withColumn("class", F.coalesce("of", "set"))
    labelled = labelled.select("row", "row2", "doc_id", "n", F.when(F.col("n") > 0, F.col("class")).alias("class"))
    # a table of its own, so that the join by class may split a large one
    smallest = scratch.cut(labelled.where("n > 0").groupBy("class").agg(F.min("doc_id").alias("component")), "smallest")
    full = labelled.where("n > 0").join(smallest, "class").select("row", "row2", "doc_id", "n", "class", "component")
    return full.unionByName(labelled.where("n = 0").select("row", "row2", "doc_id", "n", "class", F.col("doc_id").alias("component")))


def op7_jaccard_join(spark, sf_dir: str) -> DataFrame:
    out = classes_of(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", F.col("n").cast("bigint").alias("n_shingles"), F.col("component").alias("component_id"))


def keep_one(docs: DataFrame) -> DataFrame:
    """One document of each class, with its own columns; documents without words all stay, however often they recur.

    Of a class the smallest doc_id stays (null ids last); of rows that share it the one with the smallest hash of its text,
    and of those that share their text, too, the one whose other columns are smallest.
    """
    scratch = Scratch(docs.sparkSession, "keep-one")
    found = scratch.cut(classes_of(docs).where("class is not null").select("row", "row2", "doc_id", "class"), "classes")
    scratch.settle()
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "row", "row2"))
    key = ["\x00row", "\x00row2"]
    # rows of one key: their number tells whether any has to be told from another
    kept = found.groupBy("class").agg(first.alias("f")).select("f.row", "f.row2").join(found.groupBy("row", "row2").agg(F.count("*").alias("times")), ["row", "row2"])
    kept = scratch.cut(kept.select(F.col("row").alias(key[0]), F.col("row2").alias(key[1]), F.col("times").alias("\x00times")), "kept")
    keyed = row_keys(docs)
    once = keyed.join(kept.where("`\x00times` = 1"), key, "left_semi").drop(*key)
    again = keyed.join(kept.where("`\x00times` > 1"), key, "left_semi").groupBy(*key).agg(F.min(F.struct(*[F.col(f"`{c}`") for c in docs.columns])).alias("\x00first")).select("\x00first.*")
    wordless = docs.where(~F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False)))
    return once.unionByName(again).unionByName(wordless)
