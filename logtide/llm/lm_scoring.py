"""Language-model scoring: causal self-attention over subword ids, and word frequencies as a base.

Texts are read once, in blocks of whole texts: a block's distinct words become its dictionary, its texts numbers into it. All
blocks' requests for a word meet once, sorted by word: they are counted (in training texts), the word is split into subword ids,
and the answers go back to their blocks, which become the subword ids of their texts. So a word is split once for the corpus, and
texts never meet whole counts in one place. Totals come from the texts, so that the base's denominator is put in at the end.

The model has one layer. Each position's query meets the keys of at most ``2 * SPAN`` positions up to its own, in windows of
``SPAN`` queries: a window's keys reach ``SPAN`` positions further back than its queries, so that windows overlap and each
token is scored once. What attention gathers is joined to the position's own embedding in a rectified layer, and the next id
is predicted in two steps, its class and its place in the class; rare ids share one place by their frequencies. All
probabilities are those of a distribution over the whole subword vocabulary: the score is the logarithm of the probability of
the text's subword ids and of its end.

It starts from the frequencies of subword ids in all training texts, and learns by gradient steps (Adam, in numpy): in each of
``ROUNDS`` rounds, each task goes over its share of the round and its weights are averaged with those of the others, by the
tokens that each has seen. Every window of every training text is learnt: a task's first ``LEAST`` in each round, all others in one
of them. Only weights (a fixed size) go through the driver. Which texts a task holds follows the table's partitions: sums of other tasks differ in the last places, so
that scores (not bases) may, too, if the same rows are written as other partitions.

Base: the sum over tokens (lower-cased words and one end) of log10((c + 0.1) / (N + 0.1 * (V + 1))).

Null and empty texts are an end alone. A null id is never held out. Repeated rows count each. Without any training text N and V
are 0. A word of over ``LONGEST`` code points is split into subwords piece by piece.
"""

from __future__ import annotations

import base64
import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logtide.llm.blocks import blocks, flags, lowered, ranges, strings, text_arrays, word_spans
from logtide.llm.packed import buckets
from logtide.scratch import Scratch

#: Queries of a window; its keys are twice as many.
SPAN = 16
#: Widths of embeddings, of queries, keys and values, and of the rectified layer; classes, and places of a class.
WIDTH, HEAD, LAYER, CLASSES, PLACES = 32, 16, 32, 32, 32
SLOTS = CLASSES * PLACES
#: Columns of the table: query, key, value, what is added to the layer.
ROW = 3 * HEAD + LAYER
#: Rounds of training, over which a task's windows are dealt (its first ``LEAST`` are in each), windows of a step among the first and among the others, and the steps' sizes.
ROUNDS, LEAST, STEP, MANY = 3, 2048, 64, 128
RATES = (0.01, 0.006, 0.003)
#: Bytes of text in a block; positions that are scored together.
BLOCK, TOGETHER = 32 << 20, 1 << 13
LONGEST = 256
#: Addend of each count of the base; and of subword counts.
BASE_ADD, ADD = 0.1, 0.5
#: The vocabulary file has ids below; this one is its end of a text.
END, IDS = 50256, 50257
_BLANK = flags("space")


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@lru_cache(maxsize=2)
def splitter(path: str):
    """The public byte-level vocabulary at ``path``."""
    import public_tokenizers
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def held_out(doc_id) -> F.Column:
    """The CRC-32 of the id as text, modulo 10, is 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 10 == 0, F.lit(False))


# texts to numbered words


def planes(values: np.ndarray, width: int) -> bytes:
    """Integers as planes of their bytes, the lowest first: high bytes are mostly equal, and pack well."""
    return np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4)[:, :width].T).tobytes()


def from_planes(data: np.ndarray, width: int) -> np.ndarray:
    out = np.zeros((len(data) // width, 4), np.uint8)
    out[:, :width] = data.reshape(width, -1).T
    return out.view("<u4").ravel().astype(np.int64)


def words_of(data: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """(all words of some texts in lower case, number of words of each)."""
    data = lowered(data)
    starts, ends, first = word_spans(data, offsets, _BLANK)
    size = np.concatenate([[0], np.cumsum(ends - starts)])
    return strings(data[_BLANK[data]], size, pa.binary()), np.diff(first)


GATHERED = "block bigint, code int, word binary, n bigint, id bigint, held boolean, codes binary"


def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of texts: a row for each distinct word (code, word, its number in training texts), and for each text (id, held, codes)."""
    block = TaskContext.get().partitionId() << 32
    kinds = (pa.int64(), pa.int32(), pa.binary(), pa.int64(), pa.int64(), pa.bool_(), pa.binary())
    rows: list[pa.RecordBatch] = []
    words: list[pa.Array] = []
    counts: list[np.ndarray] = []
    size = 0

    def out(rows_of: int, **made) -> pa.RecordBatch:
        names = GATHERED.replace(",", "").split()[::2]
        return pa.RecordBatch.from_arrays([made[x].cast(k) if x in made else pa.nulls(rows_of, k) for x, k in zip(names, kinds)], names=names)

    def flush() -> Iterator[pa.RecordBatch]:
        found = pa.concat_arrays(words).dictionary_encode()
        code, per = found.indices.to_numpy(), np.concatenate(counts)
        held = np.concatenate([b.column("held").to_numpy(zero_copy_only=False).astype(bool) for b in rows])
        learned = np.bincount(code[np.repeat(~held, per)], minlength=len(found.dictionary))
        # frequent words get small numbers
        total = np.bincount(code, minlength=len(found.dictionary))
        order = np.argsort(-total, kind="stable")
        renamed = np.empty(len(order), np.int64)
        renamed[order] = np.arange(len(order))
        code = renamed[code]
        n = len(order)
        for a in range(0, n, 1 << 16):
            part = order[a : a + (1 << 16)]
            yield out(len(part), block=pa.array(np.full(len(part), block)), code=pa.array(np.arange(a, a + len(part))), word=found.dictionary.take(pa.array(part)), n=pa.array(learned[part]))
        width = 1 if n <= 1 << 8 else 2 if n <= 1 << 16 else 3 if n <= 1 << 24 else 4
        edges = np.concatenate([[0], np.cumsum(per)])
        packed = [bytes([width]) + planes(code[a:b], width) for a, b in zip(edges[:-1].tolist(), edges[1:].tolist())]
        at = 0
        for b in rows:
            yield out(b.num_rows, block=pa.array(np.full(b.num_rows, block)), id=b.column("id"), held=b.column("held"), codes=pa.array(packed[at : at + b.num_rows], pa.binary()))
            at += b.num_rows

    for batch in batches:
        for part, data, offsets in blocks(batch, "text"):
            found, per = words_of(data, offsets)
            rows.append(part.select(["id", "held"]))
            words.append(found)
            counts.append(per)
            size += len(data)
            if size >= BLOCK:
                yield from flush()
                rows, words, counts, size, block = [], [], [], 0, block + 1
    if rows:
        yield from flush()


def pieces(word: str, encode) -> list[int]:
    """Subword ids of a word after a blank."""
    if len(word) <= LONGEST:
        return encode(" " + word)
    return [i for k in range(0, len(word), LONGEST) for i in encode((" " if k == 0 else "") + word[k : k + LONGEST])]


KNOWN = "block bigint, code int, n bigint, payload binary"


def known_words(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    """For each block that asks for a word: how often training texts have it (n: twice that, and 1 in one of its rows), and two bytes for each subword id.

    Rows come sorted by word; those of a batch's last word wait for the next batch.
    """
    encode = splitter(path).encode_ordinary
    kept: list[pa.RecordBatch] = []

    def told(rows: pa.RecordBatch) -> pa.RecordBatch:
        word = rows.column("word")
        fresh = np.ones(len(word), bool)
        fresh[1:] = pc.not_equal(word[1:], word[:-1]).to_numpy(zero_copy_only=False)
        first, which = np.flatnonzero(fresh), np.cumsum(fresh) - 1
        total = np.add.reduceat(rows.column("n").to_numpy(), first)
        ids = pa.array([np.array(pieces(w.decode(errors="replace"), encode), "<u2").tobytes() for w in word.take(pa.array(first)).to_pylist()], pa.binary())
        return pa.RecordBatch.from_arrays([rows.column("block"), rows.column("code"), pa.array(2 * total[which] + fresh), ids.take(pa.array(which))], ["block", "code", "n", "payload"])

    for batch in batches:
        if not batch.num_rows:
            continue
        word = batch.column("word")
        last = int(np.flatnonzero(pc.not_equal(word, word[-1]).to_numpy(zero_copy_only=False))[-1:].sum() + 1) if word[0] != word[-1] else 0
        if kept and (last or kept[-1].column("word")[-1] != word[-1]):  # the word that waits is over in this batch
            yield told(joined([*kept, batch.slice(0, last)]))
            kept = []
        elif last:
            yield told(batch.slice(0, last))
        kept.append(batch.slice(last))
    if kept:
        yield told(joined(kept))


def joined(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.concat_arrays(c) for c in zip(*(b.columns for b in rows))], names=rows[0].schema.names)


def subword_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, n): occurrences of subword ids in texts."""
    total = np.zeros(IDS, np.int64)
    for batch in batches:
        total += np.bincount(text_arrays(batch.column("ids"))[0].view("<u2"), minlength=IDS)
    some = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], ["id", "n"])


ENCODED = "id bigint, held boolean, n_words bigint, n_known bigint, logs double, fresh bigint, ids binary"


def encoded(batches: Iterator[pa.RecordBatch], ends: int) -> Iterator[pa.RecordBatch]:
    """Each block's texts as subword ids, with the sum of log10(c + 0.1) over their tokens. ends: training texts; fresh, in one row: words of training texts that this block is the one to count."""
    end, end_known = float(np.log10(np.float64(ends + BASE_ADD))), int(ends > 0)
    logs = known = flat = first = size = None
    names = ["id", "held", "n_words", "n_known", "logs", "fresh", "ids"]
    for own in buckets(batches):
        dictionary: list[tuple] = []
        fresh = 0
        for batch in own:
            is_word = pc.greater_equal(batch.column("code"), 0)
            if is_word.true_count:
                found = batch.filter(is_word)
                dictionary.append((found.column("code").to_numpy(), found.column("n").to_numpy(), found.column("payload")))
            texts = batch.filter(pc.invert(is_word))
            if not texts.num_rows:
                continue
            if dictionary:
                code, n = (np.concatenate([d[i] for d in dictionary]) for i in (0, 1))
                fresh += int((n[n > 1] & 1).sum())
                n = n >> 1
                data, offsets = text_arrays(pa.concat_arrays([d[2] for d in dictionary]))
                logs, known = np.zeros(len(code)), np.zeros(len(code), np.int64)
                logs[code], known[code] = np.log10(n + BASE_ADD), n > 0
                flat = data.view("<u2")
                first, size = np.zeros(len(code), np.int64), np.zeros(len(code), np.int64)
                first[code], size[code] = offsets[:-1] // 2, np.diff(offsets) // 2
                dictionary = []
            out: list[tuple] = []
            data, offsets = text_arrays(texts.column("payload"))
            for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
                code = from_planes(data[a + 1 : b], int(data[a])) if b - a > 1 else np.zeros(0, np.int64)
                ids = flat[ranges(first[code], size[code])].tobytes() if len(code) else b""
                out.append((len(code), int(known[code].sum()) + end_known if len(code) else end_known, float(logs[code].sum()) + end if len(code) else end, fresh, ids))
                fresh = 0
            columns = [pa.array(c, k) for c, k in zip(zip(*out), (pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.binary()))]
            yield pa.RecordBatch.from_arrays([texts.column("n"), pc.equal(texts.column("code"), -2), *columns], names=names)
        logs = known = flat = first = size = None


# the model


class Model:
    """Weights by name, and where subword ids stand: ``slot`` of each id, and its share (a logarithm) of a slot that it shares."""

    def __init__(self, counts: np.ndarray, spelling: list[bytes]):
        top = np.argsort(-counts, kind="stable")[: SLOTS - 1]
        top = top[counts[top] > 0]
        top = np.array(sorted(top.tolist(), key=lambda i: spelling[i]), np.int64)  # ids that begin alike share a class
        self.slot = np.full(IDS, SLOTS - 1, np.int64)
        # evenly over the classes, but for the last place, which is that of all others
        place = np.arange(len(top)) * (SLOTS - 1) // max(len(top), 1)
        self.slot[top] = place
        rest = np.ones(IDS, bool)
        rest[top] = False
        self.share = np.zeros(IDS)
        self.share[rest] = np.log((counts[rest] + ADD) / (counts[rest] + ADD).sum())
        mass = np.bincount(self.slot, counts + np.where(rest, ADD / max(int(rest.sum()), 1), 0), minlength=SLOTS).reshape(CLASSES, PLACES)
        mass[-1, -1] += ADD
        rng = np.random.default_rng(0)
        normal = lambda *shape: (rng.standard_normal(shape) / np.sqrt(shape[-2])).astype(np.float32)
        with np.errstate(divide="ignore"):
            whole = np.maximum(np.log(mass.sum(1) / mass.sum()), -1e4)
            inner = np.maximum(np.log(mass / np.maximum(mass.sum(1, keepdims=True), 1e-300)), -1e4)
        self.w = {
            "embed": (normal(SLOTS, WIDTH) * np.float32(np.sqrt(SLOTS) * 0.3)), "query": normal(WIDTH, HEAD), "key": normal(WIDTH, HEAD), "value": normal(WIDTH, HEAD),
            "far": np.zeros(2 * SPAN, np.float32), "own": normal(WIDTH, LAYER), "seen": normal(HEAD, LAYER), "bias": np.zeros(LAYER, np.float32),
            "class": normal(LAYER, CLASSES) * np.float32(0.1), "class_bias": whole.astype(np.float32), "place": normal(CLASSES, LAYER, PLACES) * np.float32(0.1), "place_bias": inner.astype(np.float32),
        }

    def flat(self) -> np.ndarray:
        return np.concatenate([x.ravel() for x in self.w.values()])

    def load(self, flat: np.ndarray) -> Model:
        at = 0
        for name, x in self.w.items():
            self.w[name] = flat[at : at + x.size].reshape(x.shape).astype(np.float32)
            at += x.size
        return self

    def copy(self) -> Model:
        own = Model.__new__(Model)
        own.slot, own.share, own.w = self.slot, self.share, {k: x.copy() for k, x in self.w.items()}
        return own

    def projection(self) -> np.ndarray:
        """From an embedding to query (scaled), key, value and what it adds to the layer, side by side."""
        w = self.w
        return np.concatenate([w["query"] * w["query"].dtype.type(1 / np.sqrt(HEAD)), w["key"], w["value"], w["own"]], 1)

    def table(self, some: np.ndarray | slice = slice(None)) -> np.ndarray:
        """For each slot, or some: query, key, value and what the embedding adds to the layer, side by side, and a 1."""
        w = self.w
        embed = w["embed"][some]
        out = np.empty((len(embed), ROW + 1), embed.dtype)
        np.matmul(embed, self.projection(), out=out[:, :ROW])
        out[:, 3 * HEAD : ROW] += w["bias"]
        out[:, ROW] = 1
        return out

    def head(self) -> np.ndarray:
        """For each class: from the layer and a 1 to the logits of all classes and of the class' places."""
        w = self.w
        out = np.empty((CLASSES, LAYER + 1, CLASSES + PLACES), w["class"].dtype)
        out[:, :LAYER, :CLASSES], out[:, LAYER, :CLASSES] = w["class"], w["class_bias"]
        out[:, :LAYER, CLASSES:], out[:, LAYER, CLASSES:] = w["place"], w["place_bias"]
        return out


class Space:
    """Arrays by name that are used again: the pages of fresh ones cost more time than the arithmetic in them."""

    def __init__(self):
        self.held: dict[str, np.ndarray] = {}

    def __call__(self, name: str, *shape: int, kind=np.float32) -> np.ndarray:
        size, own = math.prod(shape), self.held.get(name)
        if own is None or len(own) < size or own.dtype != kind:
            own = self.held[name] = np.empty(size, kind)
        return own[:size].reshape(shape)


_DISTANCE = SPAN + np.arange(SPAN)[:, None] - np.arange(2 * SPAN)[None, :]
_BARRED = np.float32(-1e9)
#: Adds up the two parts of a row of logits.
_HALVES = np.repeat(np.eye(2, dtype=np.float32), [CLASSES, PLACES], 0)


def window_bias(far: np.ndarray) -> np.ndarray:
    """What each query of a window adds for each of its keys: by distance, and never for a key after it."""
    return np.where(_DISTANCE >= 0, far[np.maximum(_DISTANCE, 0)], _BARRED).astype(far.dtype)


def windows(values: np.ndarray, count: int) -> np.ndarray:
    """``count`` overlapping windows of 2 * SPAN rows, SPAN further each (a view)."""
    step = values.strides[0]
    return np.lib.stride_tricks.as_strided(values, (count, 2 * SPAN, *values.shape[1:]), (SPAN * step, step, *values.strides[1:]))


def layers(w: dict[str, np.ndarray], rows: np.ndarray, first: np.ndarray, space: Space) -> tuple[np.ndarray, ...]:
    """(layer of each position and a 1, attention before it is divided, its sums, what it gathers) of windows one after the other.

    rows: the table's rows of SPAN positions before the first window, then of all windows; first (windows, SPAN): the first of a
    window's keys that a query may see, ascending. Weights are relative to that of the query's own position, so that none
    overflows; those beyond e**60 count as that.
    """
    count, kind = len(first), rows.dtype
    q = rows[SPAN:, :HEAD].reshape(count, SPAN, HEAD)
    k, v = windows(rows[:, HEAD : 2 * HEAD], count), windows(rows[:, 2 * HEAD : 3 * HEAD], count)
    a = np.matmul(q, k.transpose(0, 2, 1), out=space("attention", count, SPAN, 2 * SPAN, kind=kind))
    a += window_bias(w["far"])
    split = np.flatnonzero(first[:, -1] > 0)  # windows that hold the beginning of a text
    if len(split):
        a[split] = np.where(np.arange(2 * SPAN) >= first[split][:, :, None], a[split], _BARRED)
    a -= a.reshape(count, -1)[:, SPAN :: 2 * SPAN + 1].copy()[:, :, None]
    np.minimum(a, 60, out=a)
    np.exp(a, out=a)
    total = a.reshape(-1, 2 * SPAN) @ np.ones(2 * SPAN, kind)
    o = np.matmul(a, v, out=space("gathered", count, SPAN, HEAD, kind=kind)).reshape(-1, HEAD)
    o /= total[:, None]
    z = np.matmul(o, np.concatenate([w["seen"], np.zeros((HEAD, 1), kind)], 1), out=space("layer", count * SPAN, LAYER + 1, kind=kind))
    z += rows[SPAN:, 3 * HEAD :]
    np.maximum(z, 0, out=z)
    return z, a, total, o


def logits_of(head: np.ndarray, z: np.ndarray, goal: np.ndarray, space: Space) -> tuple[np.ndarray, ...]:
    """(order of the positions by goal, runs of a class in it, layers and logits in this order, where the goals' class and place stand in them)

    of layers z; logits beyond 60 count as 60.
    """
    n, width = len(goal), CLASSES + PLACES
    goal = goal.astype(np.int16)
    order = np.argsort(goal, kind="stable")
    goal = goal[order].astype(np.int64)
    edges = np.searchsorted(goal, np.arange(0, SLOTS + 1, PLACES)).tolist()
    runs = [(c, i, j) for c, (i, j) in enumerate(zip(edges[:-1], edges[1:])) if i < j]
    z = np.take(z, order, 0, out=space("sorted", n, LAYER + 1, kind=z.dtype), mode="clip")
    p = space("logits", n, width, kind=z.dtype)
    for c, i, j in runs:
        np.matmul(z[i:j], head[c], out=p[i:j])
    np.clip(p, -60, 60, out=p)
    row = np.arange(0, n * width, width)
    return order, runs, z, p, row + goal // PLACES, row + CLASSES + goal % PLACES


class Stream:
    """Texts one after the other: inputs (the end before the first id) and targets (the end after the last)."""

    def __init__(self):
        self.held: list[np.ndarray] = []
        self.size: list[int] = []

    def add(self, ids: np.ndarray) -> None:
        self.held.append(ids)
        self.size.append(len(ids) + 1)

    def arrays(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(inputs, targets, where the text of each position begins)."""
        size = np.array(self.size)
        first = np.cumsum(size) - size
        targets = np.full(int(size.sum()), END, np.int64)
        ids = np.concatenate(self.held).astype(np.int64)
        inside = np.ones(len(targets), bool)
        inside[first + size - 1] = False
        targets[inside] = ids
        inputs = np.full(len(targets), END, np.int64)
        inside = np.ones(len(targets), bool)
        inside[first] = False
        inputs[inside] = ids
        return inputs, targets, np.repeat(first, size)


def score_stream(model: Model, table: np.ndarray, inputs: np.ndarray, targets: np.ndarray, begin: np.ndarray, space: Space | None = None) -> np.ndarray:
    """Natural logarithm of each target's probability."""
    slot, head, space = model.slot, model.head().astype(table.dtype, copy=False), space or Space()
    total = len(inputs)
    count = -(-total // SPAN)
    end = count * SPAN - total
    # SPAN positions before the first, which no query may see, and some after the last, which nobody asks for
    slots = np.concatenate([np.zeros(SPAN, np.int64), slot[inputs], np.zeros(end, np.int64)])
    begin = np.concatenate([begin, np.full(end, begin[-1] if total else 0)]).reshape(count, SPAN)
    first = begin - (np.arange(count)[:, None] - 1) * SPAN
    out = np.empty(total)
    goal = slot[targets]
    some = TOGETHER // SPAN
    for a in range(0, count, some):
        b = min(count, a + some)
        rows = np.take(table, slots[a * SPAN : (b + 1) * SPAN], 0, out=space("rows", (b - a + 1) * SPAN, ROW + 1, kind=table.dtype), mode="clip")
        z = layers(model.w, rows, first[a:b], space)[0]
        low, high = a * SPAN, min(b * SPAN, total)
        order, _, _, p, of, place = logits_of(head, z[: high - low], goal[low:high], space)
        flat = p.reshape(-1)
        found = flat[of] + flat[place]
        np.exp(p, out=p)
        found -= np.log(p @ _HALVES).sum(1)
        out[low + order] = found
    return out + model.share[targets]


def gradients(model: Model, x: np.ndarray, y: np.ndarray, first: np.ndarray, space: Space | None = None, g: dict[str, np.ndarray] | None = None) -> tuple[float, dict[str, np.ndarray]]:
    """(mean loss, gradients) of windows: slots x (n, 2 * SPAN), goals y (n, SPAN; -1: none), first (n, SPAN): the first key that each query may see.

    Queries, keys, values and own parts are looked up in the model's table, so that what comes back to them is added up by slot
    first, and goes through the weights once for each slot that the windows have. A window's first keys are mostly what the window before it asked;
    where they are not, a window without goals comes before it. g: arrays to write the gradients to.
    """
    w, space = model.w, space or Space()
    cuts = np.flatnonzero((x[1:, :SPAN] != x[:-1, SPAN:]).any(1)) + 1
    asked = x[:, SPAN:]
    if len(cuts):
        asked, y, first = np.insert(asked, cuts, x[cuts, :SPAN], 0), np.insert(y, cuts, -1, 0), np.insert(first, cuts, SPAN, 0)
    slots = np.concatenate([x[0, :SPAN], asked.ravel()])
    n, kind = len(y), w["embed"].dtype
    g = {name: np.empty_like(v) for name, v in w.items()} if g is None else g
    by_slot = np.argsort(slots.astype(np.int16), kind="stable")
    edges = np.flatnonzero(np.diff(slots[by_slot], prepend=-1))
    used = slots[by_slot[edges]]
    row_of = np.empty(SLOTS, np.int64)
    row_of[used] = np.arange(len(used))
    head, project = model.head(), model.projection()
    rows = np.take(model.table(used), row_of[slots], 0, out=space("rows", len(slots), ROW + 1, kind=kind), mode="clip")
    z, a, total, o = layers(w, rows, first, space)
    goal = y.ravel()
    real = goal >= 0
    order, runs, sorted_z, p, of, place = logits_of(head, z, np.where(real, goal, 0), space)
    each = (real[order] / max(int(real.sum()), 1)).astype(kind)
    flat = p.reshape(-1)
    loss = -float((flat[of] + flat[place]) @ each)
    np.exp(p, out=p)
    sums = p @ _HALVES.astype(kind)
    loss += float(np.log(sums).sum(1) @ each)
    both = p.reshape(-1, 2, PLACES)
    both *= (each[:, None] / sums)[:, :, None]
    flat[of] -= each
    flat[place] -= each
    back, of_head = space("back", len(goal), LAYER, kind=kind), space("of head", *head.shape, kind=kind)
    of_head.fill(0)
    for c, i, j in runs:
        np.matmul(sorted_z[i:j].T, p[i:j], out=of_head[c])
        np.matmul(p[i:j], head[c, :LAYER].T, out=back[i:j])
    whole = of_head[:, :, :CLASSES].sum(0)
    g["class"][...], g["class_bias"][...] = whole[:LAYER], whole[LAYER]
    g["place"][...], g["place_bias"][...] = of_head[:, :LAYER, CLASSES:], of_head[:, LAYER, CLASSES:]
    place_of = np.empty(len(order), np.int64)
    place_of[order] = np.arange(len(order))
    dz = np.take(back, place_of, 0, out=space("of layer", len(goal), LAYER, kind=kind), mode="clip")
    dz *= np.greater(z[:, :LAYER], 0, out=space("on", len(goal), LAYER, kind=bool))
    np.matmul(o.T, dz, out=g["seen"])
    do = np.matmul(dz, w["seen"].T, out=space("of gathered", len(goal), HEAD, kind=kind))
    do /= total[:, None]  # attention itself is left undivided
    o *= do
    inside = o @ np.ones(HEAD, kind)  # the sum of weights times their gradients
    do = do.reshape(n, SPAN, HEAD)
    q = rows[SPAN:, :HEAD].reshape(n, SPAN, HEAD)
    k, v = windows(rows[:, HEAD : 2 * HEAD], n), windows(rows[:, 2 * HEAD : 3 * HEAD], n)
    da = np.matmul(do, v.transpose(0, 2, 1), out=space("of attention", *a.shape, kind=kind))
    da -= inside.reshape(n, SPAN, 1)
    da *= a
    far = np.ones(n, kind) @ da.reshape(n, -1)
    g["far"][...] = np.bincount(np.maximum(_DISTANCE, 0).ravel(), np.where(_DISTANCE >= 0, far.reshape(SPAN, -1), 0).ravel(), minlength=2 * SPAN)
    d_keys = space("of keys", n, 2 * SPAN, 2 * HEAD, kind=kind)
    np.matmul(da.transpose(0, 2, 1), q, out=d_keys[:, :, :HEAD])
    np.matmul(a.transpose(0, 2, 1), do, out=d_keys[:, :, HEAD:])
    d_rows = space("of rows", len(slots), ROW, kind=kind)
    d_rows[:SPAN] = 0
    own = d_rows[SPAN:].reshape(n, SPAN, ROW)
    np.matmul(da, k, out=own[:, :, :HEAD])
    own[:, :, HEAD : 3 * HEAD] = d_keys[:, SPAN:]
    own[:, :, 3 * HEAD :] = dz.reshape(n, SPAN, LAYER)
    d_rows[:-SPAN].reshape(n, SPAN, ROW)[:, :, HEAD : 3 * HEAD] += d_keys[:, :SPAN]
    d_table = np.add.reduceat(np.take(d_rows, by_slot, 0, out=space("by slot", *d_rows.shape, kind=kind), mode="clip"), edges)
    g["embed"].fill(0)
    g["embed"][used] = d_table @ project.T
    of_projection = w["embed"][used].T @ d_table
    of_projection[:, :HEAD] *= kind.type(1 / np.sqrt(HEAD))
    for name, part in zip(("query", "key", "value", "own"), np.split(of_projection, np.cumsum([HEAD] * 3), 1)):
        g[name][...] = part
    g["bias"][...] = np.ones(len(used), kind) @ d_table[:, 3 * HEAD :]
    return loss, g


class Adam:
    """Steps of a model, whose weights become views of one array, as the gradients ``g`` are."""

    def __init__(self, model: Model, rate: float):
        self.rate, self.n, self.flat = rate, 0, model.flat()
        self.held, self.mean, self.square, self.some = (np.zeros_like(self.flat) for _ in range(4))
        self.g, at = {}, 0
        for name, x in model.w.items():
            model.w[name], self.g[name] = (of[at : at + x.size].reshape(x.shape) for of in (self.flat, self.held))
            at += x.size

    def step(self) -> None:
        """One step along ``g``; mean and square are kept without their factors of 0.1 and 0.01."""
        self.n += 1
        rate = self.rate * np.sqrt(1 - 0.99**self.n) / (1 - 0.9**self.n)
        g, some = self.held, self.some
        self.mean *= np.float32(0.9)
        self.mean += g
        g *= g
        self.square *= np.float32(0.99)
        self.square += g
        np.sqrt(self.square, out=some)
        some += np.float32(1e-5)
        np.divide(self.mean, some, out=some)
        some *= np.float32(rate)
        self.flat -= some


def chosen_windows(slot: np.ndarray, inputs: np.ndarray, targets: np.ndarray, begin: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The windows of these numbers as ``gradients`` takes them."""
    start = (which[:, None] - 1) * SPAN
    at = start + np.arange(2 * SPAN)
    x = np.where((at >= 0) & (at < len(inputs)), slot[inputs[np.clip(at, 0, len(inputs) - 1)]], 0)
    own = at[:, SPAN:]
    there = np.minimum(own, len(inputs) - 1)
    return x, np.where(own < len(inputs), slot[targets[there]], -1), np.maximum(begin[there] - start, 0)


def streams(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[tuple[Stream, pa.RecordBatch]]:
    """Runs of whole texts of about ``limit`` ids, with their rows."""
    for batch in batches:
        data, offsets = text_arrays(batch.column("ids"))
        at, n = 0, batch.num_rows
        while at < n:
            end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + 2 * limit, side="right")) - 1)
            stream = Stream()
            for a, b in zip(offsets[at:end].tolist(), offsets[at + 1 : end + 1].tolist()):
                stream.add(data[a:b].view("<u2"))
            yield stream, batch.slice(at, end - at)
            at = end


def train_task(batches: Iterator[pa.RecordBatch], model: Model, turn: int, rounds: int = ROUNDS) -> tuple[np.ndarray, int]:
    """(weights after this task's windows, tokens that it has learnt from).

    The task's first ``LEAST`` windows are learnt in each round, by steps of ``STEP``; of the others, each run of texts in the round
    whose turn it is, by steps of ``MANY``: after all rounds, each window of each text has been learnt.
    """
    adam, space, seen, waiting = Adam(model, RATES[turn]), Space(), 0, []

    def learn() -> int:
        x, y, first = (np.concatenate(c) for c in zip(*waiting))
        waiting.clear()
        gradients(model, x, y, first, space, adam.g)
        adam.step()
        return int((y >= 0).sum())

    before = 0  # windows so far
    for number, (stream, _) in enumerate(streams(batches, TOGETHER)):
        count = -(-sum(stream.size) // SPAN)
        size = STEP if before < LEAST else MANY
        if before < LEAST or number % rounds == turn:
            inputs, targets, begin = stream.arrays()
            for a in range(0, count, size):
                waiting.append(chosen_windows(model.slot, inputs, targets, begin, np.arange(a, min(a + size, count))))
                if sum(len(x[0]) for x in waiting) >= size:
                    seen += learn()
        before += count
    if waiting:
        seen += learn()
    return model.flat(), seen


WEIGHTS = "weights binary, tokens bigint"


def averaged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row: weights averaged by tokens."""
    total, tokens = None, 0
    for batch in batches:
        for weights, n in zip(batch.column("weights").to_pylist(), batch.column("tokens").to_pylist()):
            own = np.frombuffer(weights, "<f4").astype(float) * n
            total, tokens = own if total is None else total + own, tokens + n
    if tokens:
        yield pa.RecordBatch.from_arrays([pa.array([(total / tokens).astype("<f4").tobytes()], pa.binary()), pa.array([tokens])], ["weights", "tokens"])


def trained(texts: DataFrame, model: Model, rounds: int = ROUNDS) -> Model:
    """The model after ``rounds`` passes over encoded training texts (ids), each task by itself and then averaged."""
    spark = texts.sparkSession
    for turn in range(rounds):
        shared = spark.sparkContext.broadcast(model)  # of a fixed size

        def run(batches, shared=shared, turn=turn):
            weights, tokens = train_task(batches, shared.value.copy(), turn, rounds)
            if tokens:
                yield pa.RecordBatch.from_arrays([pa.array([weights.astype("<f4").tobytes()], pa.binary()), pa.array([tokens])], ["weights", "tokens"])

        made = texts.select("ids").mapInArrow(run, WEIGHTS)
        groups = max(1, int(int(spark.conf.get("spark.sql.shuffle.partitions")) ** 0.5))
        found = made.repartition(groups).mapInArrow(averaged, WEIGHTS).coalesce(1).mapInArrow(averaged, WEIGHTS).collect()  # one row
        if found:
            model.load(np.frombuffer(found[0].weights, "<f4"))
    return model


def scored(batches: Iterator[pa.RecordBatch], model: Model, tokens: int, distinct: int) -> Iterator[pa.RecordBatch]:
    table, space = model.table(), Space()
    whole = np.log10(tokens + BASE_ADD * (distinct + 1))
    for stream, rows in streams(batches, 4 * TOGETHER):
        found = score_stream(model, table, *stream.arrays(), space)
        size = np.array(stream.size)
        sums = np.add.reduceat(found, np.cumsum(size) - size) / np.log(10)
        words = rows.column("n_words").to_numpy() + 1
        base = rows.column("logs").to_numpy() - words * whole
        yield pa.RecordBatch.from_arrays([rows.column("id"), rows.column("held"), pa.array(words), rows.column("n_known"), pa.array(np.full(len(words), tokens)), pa.array(base), pa.array(sums)], ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])


SCORED = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"


def scores(docs: DataFrame, path: str | None = None, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of each text of (doc_id, text)."""
    spark = docs.sparkSession
    path = path or vocabulary_path()
    scratch = Scratch(spark, "lm")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("id"), held_out(F.col("doc_id")).alias("held"), "text")
    blocks_of = scratch.cut(rows.mapInArrow(gathered, GATHERED), "blocks")
    ends = blocks_of.where("word is null and not held").count()

    # one narrow row for each word (code, occurrences, subword ids) and for each text (-1, or -2 if held out, id, codes)
    asked = blocks_of.where("word is not null").select("block", "code", "word", "n").repartition("word").sortWithinPartitions("word")
    known = asked.mapInArrow(lambda batches: known_words(batches, path), KNOWN)
    coded = blocks_of.where("word is null").select("block", F.when(F.col("held"), -2).otherwise(-1).alias("code"), F.col("id").alias("n"), F.col("codes").alias("payload"))
    dealt = known.unionByName(coded).repartitionById(parts, F.pmod(F.xxhash64("block"), F.lit(parts)).cast("int")).sortWithinPartitions("block", F.col("code") < 0)
    texts = scratch.cut(dealt.withColumnRenamed("block", "part").mapInArrow(lambda batches: encoded(batches, ends), ENCODED), "texts")
    scratch.drop("blocks")
    scratch.settle()
    top = texts.agg(F.sum(F.when(~F.col("held"), F.col("n_words"))).alias("total"), F.sum("fresh").alias("distinct")).first()
    total, distinct = int(top.total or 0) + ends, int(top.distinct or 0) + (ends > 0)
    counts = np.zeros(IDS)
    for r in texts.where("not held").select("ids").mapInArrow(subword_counts, "id int, n bigint").groupBy("id").agg(F.sum("n").alias("n")).collect():  # ids of the vocabulary file
        counts[r.id] = r.n
    counts[END] += ends
    spelling = [b""] * IDS
    for token, i in splitter(path)._mergeable_ranks.items():
        spelling[i] = token
    model = trained(texts.where("not held"), Model(counts, spelling), rounds)
    shared = spark.sparkContext.broadcast(model)
    return texts.drop("fresh").mapInArrow(lambda batches: scored(batches, shared.value, total, distinct), SCORED)


def op12_lm_scores(spark, sf_dir: str) -> DataFrame:
    return scores(spark.read.parquet(f"{sf_dir}/documents.parquet"))
