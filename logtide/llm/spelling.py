"""Spelling variants: words that differ by one inserted, deleted or replaced code point, and the more frequent form that each has.

The words of all texts are counted: runs of letters in numpy, block by block, then one aggregation. Of two words that differ by
one error, the error lies in one half of the first: the other half is in both. So words meet by halves: each is
dealt to the keys (length of the searched word, its first or its last half) under which it could be found, and searched
under its own two. A task builds, for its keys, the minimal acyclic automaton of the words and that of the reversed words. Both
number their words by a perfect hash (the sum of what the edges of a path skip), by which texts and frequencies are found. A
search walks one half exactly, forward through the first or backward through the second automaton, completes the other half
with one error, and drops what the other direction finds as well.

A key of more than ``HOT`` words (a prefix that a third of all words share) is split: the half that may hold the error is halved
again, and the words meet by three of four quarters, and so on. At the end only one code point is free, so
that the size of a key is bounded by the alphabet.

A word's form is its near word of the largest count, if that is at least twice its own. Counts double from form to
form, so that chains are short; roots are found by jumping over pointers.

Null and empty texts have no words; a null id counts as an empty one. Repeated rows count each. Ties of counts go to the
smallest word in the order of code points.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logtide.llm.blocks import blocks, lowered, ranges, strings, word_spans
from logtide.llm.packed import buckets
from logtide.scratch import Scratch

#: Code points and occurrences that a word has at least, and how many times as frequent its form is.
LENGTH, COUNT, RATIO = 5, 3, 2
#: One of so many runs loses a code point.
SLIPS = 97
#: Words of a key at most, before it is split; rows of a bucket.
HOT, ROWS = 1 << 16, 1 << 17
#: Bytes of words that a task counts at a time.
HELD = 8 << 20
#: Longest run whose checksum is made together with others, byte by byte.
TOGETHER = 64
#: Searched words whose frontiers are held at a time.
SOME = 4096
BITS = 21  # of a code point
_CRC = np.array([zlib.crc32(bytes([i])) ^ zlib.crc32(b"\0") for i in range(256)], np.uint32)


def letter_runs(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of maximal runs of A-Z, a-z and U+00C0 to U+00FF (in UTF-8 C3 and a byte more), and each text's first run."""
    low = data | 0x20
    letter = (low >= 97) & (low <= 122)
    wide = data == 0xC3
    letter |= wide
    letter[1:] |= wide[:-1]
    return word_spans(letter.view(np.uint8), offsets, np.array([False, True]))


def checksums(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, before: np.ndarray) -> np.ndarray:
    """CRC-32 of byte ranges, each going on from the checksum of what stands before it."""
    out = before.astype(np.uint32)
    length = ends - starts
    some = np.flatnonzero(length <= TOGETHER)
    state, at, rest = ~out[some], starts[some], length[some]
    order = np.argsort(-rest, kind="stable")
    state, at, rest = state[order], at[order], rest[order]
    for k in range(int(rest[0]) if len(rest) else 0):
        n = int(np.searchsorted(-rest, -k, side="left"))  # ranges longer than k
        state[:n] = _CRC[(state[:n] ^ data[at[:n] + k]) & 0xFF] ^ (state[:n] >> 8)
    out[some[order]] = ~state
    for i in np.flatnonzero(length > TOGETHER).tolist():
        out[i] = zlib.crc32(data[starts[i] : ends[i]].tobytes(), int(before[i]))
    return out


def words_of(ids: list, data: np.ndarray, offsets: np.ndarray) -> list[pa.Array]:
    """The words of texts, as binary arrays: runs in lower case, some of them with a code point less."""
    data = lowered(data)
    starts, ends, first = letter_runs(data, offsets)
    if not len(starts):
        return []
    prefix = np.array([zlib.crc32(f"{'' if i is None else i}:".encode()) for i in ids], np.uint32)
    sums = checksums(data, starts, ends, np.repeat(prefix, np.diff(first)))
    wide = np.concatenate([[0], np.cumsum(data == 0xC3)])
    points = (ends - starts) - (wide[ends] - wide[starts])
    slips = sums % SLIPS == 0
    changed = []
    for i in np.flatnonzero(slips & (points > LENGTH)).tolist():
        word = data[starts[i] : ends[i]].tobytes().decode()
        k = int(sums[i]) % len(word)
        changed.append((word[:k] + word[k + 1 :]).encode())
    kept = np.flatnonzero(~slips & (points >= LENGTH))
    size = ends[kept] - starts[kept]
    return [strings(data[ranges(starts[kept], size)], np.concatenate([[0], np.cumsum(size)]), pa.binary()), pa.array(changed, pa.binary())]


def corpus_words(docs: DataFrame, id: str = "doc_id", text: str = "text", least: int = COUNT) -> DataFrame:
    """(word, n): the words of all texts that occur ``least`` times at least."""

    def run(batches):
        held: list[pa.Array] = []
        size = 0

        def counted() -> pa.RecordBatch:
            found = pa.concat_arrays(held).value_counts()
            return pa.RecordBatch.from_arrays([found.field("values").cast(pa.string()), found.field("counts").cast(pa.int64())], ["word", "n"])

        for batch in batches:
            for rows, data, offsets in blocks(batch, "text"):
                for found in words_of(rows.column("id").to_pylist(), data, offsets):
                    held.append(found)
                    size += found.nbytes
                if size > HELD:
                    yield counted()
                    held, size = [], 0
        if held:
            yield counted()

    counted = docs.select(F.col(id).cast("string").alias("id"), F.col(text).alias("text")).mapInArrow(run, "word string, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


class Automaton:
    """The minimal acyclic automaton of sorted words; a word's number is its place among them."""

    def __init__(self, words: list[str]):
        codes = [np.frombuffer(w.encode("utf-32-le"), "<u4").astype(np.int64) for w in words]
        path = [0]  # the trie's nodes along the last word
        parent, char, ends = [np.zeros(1, np.int64)], [np.zeros(1, np.int64)], []
        size, last = 1, codes[0][:0] if codes else None
        for code in codes:
            n = min(len(code), len(last))
            differ = np.flatnonzero(code[:n] != last[:n])
            common = int(differ[0]) if len(differ) else n
            new = np.arange(size, size + len(code) - common)
            parent.append(np.concatenate([[path[common]], new[:-1]]) if len(new) else new)
            char.append(code[common:])
            path[common + 1 :] = new.tolist()
            size, last = size + len(new), code
            ends.append(path[-1])
        parent, char = np.concatenate(parent), np.concatenate(char)
        final = np.zeros(size, np.int64)
        final[ends] = 1
        depth = np.zeros(size, np.int64)
        at, live = parent.copy(), np.arange(1, size)
        while len(live):  # every node's steps to the root, all at once
            depth[live] += 1
            live = live[at[live] != 0]
            at[live] = parent[at[live]]
        count, height = final.copy(), np.zeros(size, np.int64)
        by_depth = np.argsort(-depth, kind="stable")
        edges = np.searchsorted(-depth[by_depth], -np.arange(int(depth.max(initial=0)), -1, -1), side="right")
        low = 0
        for high in edges[:-1].tolist():
            own = by_depth[low:high]
            np.add.at(count, parent[own], count[own])
            np.maximum.at(height, parent[own], height[own] + 1)
            low = high
        # children of each node in order: nodes are numbered as sorted words meet them
        child = np.argsort(parent[1:], kind="stable") + 1
        begin = np.searchsorted(parent[child], np.arange(size + 1))
        degree = np.diff(begin)
        # from the leaves up, nodes of the same ending and the same edges to the same states are one state
        state = np.full(size, -1)
        states = 0
        rank = np.argsort(height, kind="stable")
        bounds = np.searchsorted(height[rank], np.arange(int(height.max(initial=0)) + 2))
        chosen = []
        for low, high in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            own = rank[low:high]
            sign = final[own]
            for k in range(int(degree[own].max(initial=0))):
                has = degree[own] > k
                to = child[np.minimum(begin[own] + k, len(child) - 1)]
                edge = np.where(has, state[to] << BITS | char[to], -1)
                _, edge = np.unique(edge, return_inverse=True)
                _, sign = np.unique(sign * (int(edge.max()) + 1) + edge, return_inverse=True)
            _, one, sign = np.unique(sign, return_index=True, return_inverse=True)
            state[own] = states + sign
            chosen.append(own[one])
            states += len(one)
        chosen = np.concatenate(chosen)
        self.start, self.states, self.words = int(state[0]), states, len(words)
        self.final = final[chosen].astype(bool)
        self.degree = degree[chosen]
        self.first = np.cumsum(self.degree) - self.degree
        nodes = child[ranges(begin[chosen], self.degree)]
        self.char, self.to = char[nodes], state[nodes]
        owner = np.repeat(np.arange(states), self.degree)
        passed = np.cumsum(count[nodes]) - count[nodes]
        heads = np.repeat(self.first, self.degree)
        # words that a step along the edge leaves behind: the one that ends here, and those of the edges before
        self.skip = passed - (passed[heads] if len(nodes) else 0) + self.final[owner]
        self.key = owner << BITS | self.char

    def follow(self, state: np.ndarray, char: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(which of the states have such an edge, the edges)."""
        asked = state << BITS | char
        at = np.searchsorted(self.key, asked)
        there = np.flatnonzero(at < len(self.key))
        there = there[self.key[at[there]] == asked[there]]
        return there, at[there]

    def number(self, words: list[str]) -> np.ndarray:
        """The perfect hash: each word's number, -1 for others."""
        out = np.full(len(words), -1)
        for i, w in enumerate(words):
            state, passed = np.array([self.start]), 0
            for c in w:
                there, edge = self.follow(state, np.array([ord(c)]))
                if not len(there):
                    break
                state, passed = self.to[edge], passed + int(self.skip[edge[0]])
            else:
                if self.final[state[0]]:
                    out[i] = passed
        return out

    def near(self, codes: np.ndarray, offsets: np.ndarray, exact: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(searched word, number) of words that share its first ``exact`` code points and differ by one error after them."""
        size = np.diff(offsets)
        char_of = lambda q, at: codes[offsets[q] + at]
        q = np.arange(len(size))
        state, passed = np.full(len(q), self.start), np.zeros(len(q), np.int64)
        for k in range(int(exact.max(initial=0))):
            on = np.flatnonzero(exact[q] > k)
            there, edge = self.follow(state[on], char_of(q[on], k))
            keep = np.ones(len(q), bool)
            keep[np.delete(on, there)] = False
            state[on[there]], passed[on[there]] = self.to[edge], passed[on[there]] + self.skip[edge]
            q, state, passed = q[keep], state[keep], passed[keep]
        at = exact[q]
        found: list[np.ndarray] = []
        while len(q):
            inside = at < size[q]
            degree = self.degree[state]
            row, edge = np.repeat(np.arange(len(q)), degree), ranges(self.first[state], degree)
            wanted = np.where(inside, char_of(q, np.minimum(at, size[q] - 1)), -1)
            other = np.flatnonzero((self.char[edge] != wanted[row]) & inside[row])
            rest = np.flatnonzero(inside)
            tried = [
                (q[rest], state[rest], at[rest] + 1, passed[rest]),  # a code point less
                (q[row[other]], self.to[edge[other]], at[row[other]] + 1, passed[row[other]] + self.skip[edge[other]]),  # another one
                (q[row], self.to[edge], at[row], passed[row] + self.skip[edge]),  # one more
            ]
            found.append(self.finish(codes, offsets, *(np.concatenate(x) for x in zip(*tried))))
            there, edge = self.follow(state[rest], wanted[rest])
            on = rest[there]
            q, state, at, passed = q[on], self.to[edge], at[on] + 1, passed[on] + self.skip[edge]
        pairs = np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)
        return pairs // max(self.words, 1), pairs % max(self.words, 1)

    def finish(self, codes, offsets, q, state, at, passed) -> np.ndarray:
        """Searched word and number, as one, of those whose rest is there without another error."""
        size = np.diff(offsets)
        found = []
        while len(q):
            done = at == size[q]
            ended = done & self.final[state]
            found.append(q[ended] * self.words + passed[ended])
            on = np.flatnonzero(~done)
            there, edge = self.follow(state[on], codes[offsets[q[on]] + at[on]])
            on = on[there]
            q, state, at, passed = q[on], self.to[edge], at[on] + 1, passed[on] + self.skip[edge]
        return np.concatenate(found) if found else np.zeros(0, np.int64)


def region(length: int, path: str) -> tuple[int, int, list[tuple[int, int]]]:
    """(code points known in front, at the back, spans of which one must differ) for a searched word's length and a path of halvings.

    ``A``: the first half of what is left is known; ``B``: the second half is, and the first is not.
    """
    front, back, differ = 0, 0, []
    for side in path:
        free = length - front - back
        half = free // 2
        if side == "A":
            front += half
        else:
            differ.append((front, front + half))
            back += free - half
    return front, back, differ


def accepted(word: str, other: str, path: str, known: dict) -> bool:
    """Whether this path, and no other one, is to find the pair."""
    at = (len(word), path)
    if at not in known:
        known[at] = region(*at)
    front, back, differ = known[at]
    return word[:front] == other[:front] and (not back or word[-back:] == other[-back:]) and all(word[a:b] != other[a:b] for a, b in differ)


def search(rows: list[tuple[bool, str, str, int]]) -> Iterator[tuple[str, int, int, str]]:
    """(word, near words, largest count, the first of these) from a bucket's rows (searched, path, word, n)."""
    known: dict = {}
    for side in "AB":
        turn = (lambda w: w) if side == "A" else (lambda w: w[::-1])
        counts = {turn(w): n for asked, path, w, n in rows if not asked and path[-1] == side}
        asked = [(path, w) for own, path, w, _ in rows if own and path[-1] == side]
        if not counts or not asked:
            continue
        words = sorted(counts)
        automaton = Automaton(words)
        n_of = np.array([counts[w] for w in words])  # by number
        for low in range(0, len(asked), SOME):
            some = asked[low : low + SOME]
            turned = [turn(w) for _, w in some]
            codes = np.frombuffer("".join(turned).encode("utf-32-le"), "<u4").astype(np.int64)
            offsets = np.concatenate([[0], np.cumsum([len(w) for w in turned])])
            exact = np.array([region(len(w), path)[0 if side == "A" else 1] for path, w in some])
            q, number = automaton.near(codes, offsets, exact)
            best: dict[int, list] = {}
            for i, k, n in zip(q.tolist(), number.tolist(), n_of[number].tolist()):
                path, word = some[i]
                other = turn(words[k])
                if accepted(word, other, path, known):
                    held = best.setdefault(i, [0, 0, ""])
                    held[0] += 1
                    if n > held[1] or n == held[1] and other < held[2]:
                        held[1:] = n, other
            yield from ((some[i][1], *held) for i, held in best.items())


def keyed(rows: DataFrame) -> DataFrame:
    """Adds the key under which rows (asked, length, path, front, back, word) meet."""
    word, size = F.col("word"), F.char_length("word")
    known = F.substring(word, F.lit(1), F.col("front")), F.substring(word, size - F.col("back") + 1, F.col("back"))
    return rows.withColumn("key", F.xxhash64("length", "path", *known))


def halved(rows: DataFrame) -> DataFrame:
    """Both halvings of what is free in each row."""
    free = F.col("length") - F.col("front") - F.col("back")
    half = (free - F.pmod(free, F.lit(2))) / 2
    sides = [F.struct(F.lit("A").alias("side"), (F.col("front") + half).cast("int").alias("front"), F.col("back").alias("back")), F.struct(F.lit("B").alias("side"), F.col("front").alias("front"), (F.col("back") + free - half).cast("int").alias("back"))]
    out = rows.withColumn("x", F.explode(F.array(*sides)))
    return keyed(out.select("asked", "length", F.concat("path", "x.side").alias("path"), "x.front", "x.back", "word", "n"))


def neighbours(words: DataFrame, scratch: Scratch, hot: int = HOT) -> DataFrame:
    """(word, n_near, best: the largest count of a near word, negative, and the first such word) of words (word, n) that have any."""
    size = F.char_length("word")
    roles = [F.struct(F.lit(True).alias("asked"), size.alias("length"))] + [F.struct(F.lit(False).alias("asked"), (size + k).alias("length")) for k in (-1, 0, 1)]
    rows = words.select("word", "n", F.explode(F.array(*roles)).alias("x")).where("x.length > 1")
    rows = halved(rows.select("x.asked", "x.length", F.lit("").alias("path"), F.lit(0).alias("front"), F.lit(0).alias("back"), "word", "n"))
    ready = []
    while True:
        crowded = rows.where("not asked and length - front - back > 1").groupBy("length", "path", "key").agg(F.count("*").alias("rows")).where(F.col("rows") > hot).select("length", "path", "key")
        crowded = scratch.cut(crowded, f"hot-{len(ready)}")
        if not crowded.limit(1).count():
            ready.append(rows)
            break
        on = ["length", "path", "key"]
        ready.append(rows.join(crowded, on, "left_anti"))
        rows = scratch.cut(halved(rows.join(crowded, on, "left_semi")), f"halved-{len(ready)}")
    every = ready[0].select("key", "asked", "path", "word", "n")
    for more in ready[1:]:
        every = every.unionByName(more.select("key", "asked", "path", "word", "n"))
    total = words.count() * 8
    parts = int(words.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    count = parts * max(1, -(-total // (ROWS * parts)))

    def run(batches):
        for own in buckets(batches):
            found = list(search([row for b in own for row in zip(*(b.column(c).to_pylist() for c in ("asked", "path", "word", "n")))]))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*found), (pa.string(), pa.int64(), pa.int64(), pa.string()))], ["word", "near", "best_n", "best"])

    dealt = every.withColumn("part", F.pmod("key", F.lit(count)).cast("int")).repartitionById(parts, F.col("part") % parts).sortWithinPartitions("part")
    found = dealt.select("part", "asked", "path", "word", "n").mapInArrow(run, "word string, near bigint, best_n bigint, best string")
    return found.groupBy("word").agg(F.sum("near").alias("n_near"), F.min(F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("word"))).alias("best"))


def with_roots(forms: DataFrame, scratch: Scratch) -> DataFrame:
    """Adds ``root`` to (word, form, ...): the last form on the way; each round jumps twice as far."""
    jumps = scratch.cut(forms.where("form is not null").select("word", F.col("form").alias("to")), "jump-0")
    n = 0
    while True:
        further = jumps.select(F.col("word").alias("to"), F.col("to").alias("further"))
        n += 1
        # a word without a form has no row, and is where ways end
        moved = scratch.cut(jumps.join(further, "to", "left").select("word", F.coalesce("further", "to").alias("to"), F.col("further").isNotNull().alias("moved")), f"jump-{n}")
        jumps = moved.select("word", "to")
        if not moved.where("moved").limit(1).count():
            break
    return forms.join(jumps, "word", "left").withColumn("root", F.coalesce("to", "word")).drop("to")


def variants(words: DataFrame, ratio: int = RATIO, hot: int = HOT) -> DataFrame:
    """word, form, root, n, n_near and form_n of words (word, n), each once."""
    scratch = Scratch(words.sparkSession, "spelling")
    words = scratch.cut(words.select("word", "n"), "words")
    near = neighbours(words, scratch, hot)
    best = -F.col("best.n")
    chosen = F.when(best >= ratio * F.col("n"), F.struct(F.col("best.word").alias("form"), best.alias("form_n")))
    forms = words.join(near, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"), chosen["form"].alias("form"), chosen["form_n"].alias("form_n"))
    forms = scratch.cut(forms, "forms")
    return with_roots(forms, scratch).select("word", "form", "root", "n", "n_near", "form_n")


def op13_spelling_variants(spark, sf_dir: str) -> DataFrame:
    return variants(corpus_words(spark.read.parquet(f"{sf_dir}/documents.parquet")))
