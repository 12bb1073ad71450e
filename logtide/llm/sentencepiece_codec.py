"""SentencePiece BPE encoding and decoding by vectorised merge rounds.

Texts are cut where no piece can reach across: between two characters that stand side by side in no piece, such as any
character and a space after it. Each distinct word is encoded once per task; words meet by hash and are compared byte by
byte. A round works on flat symbol arrays of many words: it finds every word's smallest pair rank by a segmented minimum,
merges all leftmost non-overlapping pairs of that rank at once and compacts the arrays, until no pair is left. A word of
more than ``LONG`` symbols, for which many rounds over the whole word would be quadratic, keeps its pairs by rank instead:
a round takes the smallest rank there is, merges its pairs and looks again only at their neighbours.

Merging all pairs of one rank at once equals merging them one by one if no pair made by the merge has a smaller rank. The
vocabulary says for which pieces that could happen ("unsafe" ones); of those, only the leftmost pair is merged in a round.

Null texts are encoded as empty ones, whose ids are only the begin and end ids. Repeated rows and texts of any length are
encoded like any other; an empty table gives an empty table.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logtide.llm.blocks import Lanes, U, map_texts, range_digests, ranges, same_bytes, strings

SPACE = "▁"
NONE = np.iinfo(np.int32).max
#: Distinct words, and bytes of them, that a task remembers before it starts anew.
WORDS, WORD_BYTES = 1 << 18, 8 << 20
#: Symbols of a word from which on pairs are kept by rank.
LONG = 256


@dataclass
class Pieces:
    """Tables of a BPE model with byte fallback, an identity normaliser and a dummy prefix; read once on the driver."""

    pieces: list[str]
    scores: list[float]
    kinds: list[str]  # normal, byte or control
    bos: int
    eos: int
    symbols: dict[str, int] = field(init=False)

    @classmethod
    def load(cls, path: str) -> Pieces:
        import sentencepiece

        p = sentencepiece.SentencePieceProcessor(model_file=path)
        n = p.get_piece_size()
        kinds = ["byte" if p.is_byte(i) else "control" if p.is_control(i) or p.is_unknown(i) else "normal" for i in range(n)]
        if kinds.count("byte") != 256:
            raise ValueError("a model with byte fallback is needed")
        return cls([p.id_to_piece(i) for i in range(n)], [p.get_score(i) for i in range(n)], kinds, p.bos_id(), p.eos_id())

    def __post_init__(self) -> None:
        self.symbols = {s: i for i, (s, k) in enumerate(zip(self.pieces, self.kinds)) if k == "normal"}
        n = len(self.pieces)
        inner: set[str] = set()
        beside: set[str] = set()
        for s in [s for s in self.symbols if len(s) > 1]:
            inner.update(s)
            beside.update(s[k : k + 2] for k in range(len(s) - 1))
            if SPACE in s.lstrip(SPACE):
                raise ValueError("a piece that has a space after another character")
        for c in sorted(inner - set(self.symbols)):
            self.symbols[c] = len(self.pieces) + len(self.symbols) - sum(k == "normal" for k in self.kinds)
        self.n_symbols = n + len(inner - {s for s, k in zip(self.pieces, self.kinds) if k == "normal"})
        order = sorted((i for i, k in enumerate(self.kinds) if k == "normal"), key=lambda i: (-self.scores[i], i))
        rank = np.full(self.n_symbols, -1, np.int64)
        rank[order] = np.arange(len(order))
        left, right, merged = [], [], []
        for s, i in self.symbols.items():
            for k in range(1, len(s)):
                a, b = self.symbols.get(s[:k]), self.symbols.get(s[k:])
                if a is not None and b is not None:
                    left.append(a), right.append(b), merged.append(i)
        x, y, q = (np.array(v, np.int64) for v in (left, right, merged))
        keys = x * self.n_symbols + y
        at = np.argsort(keys)
        self.pair_keys, self.pair_to = keys[at], q[at].astype(np.int32)
        self.rank, self.of_rank = rank, np.array(order, np.int64)
        self.unsafe = np.zeros(self.n_symbols, bool)
        for part in (x, y):
            self.unsafe[part[rank[part] > rank[q]]] = True
        self.char = np.full(0x110000, -1, np.int32)
        for s, i in self.symbols.items():
            if len(s) == 1:
                self.char[ord(s)] = i
        self.char[32] = self.char[ord(SPACE)]
        #: number of each character that is part of longer pieces (0: of none), and which stand side by side in one
        self.number = np.zeros(0x110000, np.int32)
        self.number[[ord(c) for c in sorted(inner)]] = np.arange(1, len(inner) + 1)
        self.number[32] = self.number[ord(SPACE)]
        self.joins = np.zeros((len(inner) + 1,) * 2, bool)
        if beside:
            self.joins[tuple(self.number[[ord(s[k]) for s in sorted(beside)]] for k in range(2))] = True
        raw = [bytes([int(s[3:5], 16)]) if k == "byte" else b"" if k == "control" else s.replace(SPACE, " ").encode() for s, k in zip(self.pieces, self.kinds)]
        self.piece_offsets = np.concatenate([[0], np.cumsum([len(r) for r in raw])])
        self.piece_bytes = np.frombuffer(b"".join(raw), np.uint8)
        first = [i for i, k in enumerate(self.kinds) if k == "byte"]
        self.byte_ids = np.array(sorted(first, key=lambda i: int(self.pieces[i][3:5], 16)), np.int64)

    def rank_of(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Rank of the piece that two symbols make; NONE if they make none."""
        if not len(self.pair_keys):
            return np.full(len(x), NONE, np.int64)
        keys = x * self.n_symbols + y
        i = np.searchsorted(self.pair_keys, keys)
        i[i == len(self.pair_keys)] = 0
        hit = (self.pair_keys[i] == keys) & (x < self.n_symbols) & (y < self.n_symbols)
        return np.where(hit, self.rank[self.pair_to[i]], NONE)

    def pair_ranks(self, symbols: np.ndarray, words: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Rank of the piece that the symbols at ``at`` and ``at + 1`` make; NONE if they make none or a word ends there."""
        after = np.minimum(at + 1, len(symbols) - 1)
        return np.where((at + 1 < len(symbols)) & (words[at] == words[after]), self.rank_of(symbols[at], symbols[after]), NONE)

    def merge_long(self, symbols: np.ndarray) -> np.ndarray:
        """Merge rounds over one word, whose pairs are kept by rank."""
        n = len(symbols)
        after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
        ranks = np.append(self.rank_of(symbols[:-1], symbols[1:]), NONE)
        waiting: dict[int, list[np.ndarray]] = {}
        heap: list[int] = []

        def wait(at: np.ndarray) -> None:
            at = at[ranks[at] < NONE]
            order = np.argsort(ranks[at], kind="stable")
            at = at[order]
            r = ranks[at]
            cuts = np.flatnonzero(r[1:] != r[:-1]) + 1
            for some in np.split(at, cuts) if len(at) else []:
                k = int(ranks[some[0]])
                if k not in waiting:
                    waiting[k] = []
                    heapq.heappush(heap, k)
                waiting[k].append(some)

        wait(np.arange(n))
        while heap:
            r = heapq.heappop(heap)
            some = waiting.pop(r)
            here = np.unique(np.concatenate(some)) if len(some) > 1 else some[0]
            made = self.of_rank[r]
            rest = here[:0]
            if self.unsafe[made]:  # only the leftmost pair that is still there
                live = 0
                while live < len(here) and ranks[here[live]] != r:
                    live += 1
                here, rest = here[live : live + 1], here[live + 1 :]
            here = here[ranks[here] == r]
            if len(here) > 1:
                run = np.concatenate([[True], here[1:] != after[here[:-1]]])
                start = np.maximum.accumulate(np.where(run, np.arange(len(here)), 0))
                here = here[(np.arange(len(here)) - start) % 2 == 0]
            if len(here):
                gone = after[here]
                following = after[gone]
                symbols[here], after[here] = made, following
                ranks[gone] = NONE
                symbols[gone] = -1
                inside = following < n
                before[following[inside]] = here[inside]
                changed = np.unique(np.concatenate([here, before[here]]))
                changed = changed[changed >= 0]
                other = after[changed]
                ranks[changed] = np.where(other < n, self.rank_of(symbols[changed], symbols[np.minimum(other, n - 1)]), NONE)
                wait(changed)
            if len(rest):
                if r not in waiting:
                    waiting[r] = []
                    heapq.heappush(heap, r)
                waiting[r].insert(0, rest)
        return symbols[symbols >= 0]

    def merge(self, symbols: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merge rounds over flat symbols; words: non-decreasing word of each symbol."""
        done: list[tuple[np.ndarray, np.ndarray]] = []
        sizes = np.bincount(words)
        for w in np.flatnonzero(sizes > LONG).tolist():
            at = np.searchsorted(words, [w, w + 1])
            whole = self.merge_long(symbols[at[0] : at[1]].copy())
            done.append((whole, np.full(len(whole), w)))
        if done:
            short = sizes[words] <= LONG
            symbols, words = symbols[short], words[short]
        ranks = self.pair_ranks(symbols, words, np.arange(len(symbols)))
        while len(symbols):
            first = np.flatnonzero(np.concatenate([[True], words[1:] != words[:-1]]))
            lengths = np.diff(np.append(first, len(words)))
            least = np.minimum.reduceat(ranks, first)
            if (least == NONE).any():
                live = np.repeat(least < NONE, lengths)
                done.append((symbols[~live], words[~live]))
                symbols, words, ranks, lengths, least = symbols[live], words[live], ranks[live], lengths[least < NONE], least[least < NONE]
                if not len(symbols):
                    break
            goal = np.repeat(least, lengths)
            here = np.flatnonzero(ranks == goal)
            run = np.concatenate([[True], np.diff(here) != 1])
            start = here[np.maximum.accumulate(np.where(run, np.arange(len(here)), 0))]
            here = here[(here - start) % 2 == 0]
            made = self.of_rank[goal[here]]
            lone = self.unsafe[made]
            if lone.any():
                leftmost = np.concatenate([[True], words[here][1:] != words[here][:-1]])
                here, made = here[~lone | leftmost], made[~lone | leftmost]
            symbols[here] = made
            stay = np.ones(len(symbols), bool)
            stay[here + 1] = False
            symbols, words, ranks = symbols[stay], words[stay], ranks[stay]
            here = here - np.arange(len(here))  # as many symbols went before
            changed = np.concatenate([here, here[here > 0] - 1])
            ranks[changed] = self.pair_ranks(symbols, words, changed)
        if not done:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        symbols, words = (np.concatenate(x) for x in zip(*done))
        order = np.argsort(words, kind="stable")
        return symbols[order], words[order]

    def encode_words(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets) of words given as flat UTF-8 bytes."""
        points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32).astype(np.int64)
        heads = np.zeros(len(data) + 1, np.int64)
        np.cumsum((data & 0xC0) != 0x80, out=heads[1:])
        words = np.repeat(np.arange(len(offsets) - 1), np.diff(heads[offsets]))
        known = self.char[points]
        symbols, words = self.merge(np.where(known >= 0, known, self.n_symbols + points), words)
        n = len(self.pieces)
        odd = np.flatnonzero(symbols >= n)
        if len(odd):  # characters outside the vocabulary become their bytes
            extra = {i: s for s, i in self.symbols.items() if i >= n}
            spelled = [np.array(list((extra[s] if s < self.n_symbols else chr(s - self.n_symbols)).encode()), np.int64) for s in symbols[odd].tolist()]
            times = np.ones(len(symbols), np.int64)
            times[odd] = [len(s) for s in spelled]
            symbols, words = np.repeat(symbols, times), np.repeat(words, times)
            symbols[ranges((np.cumsum(times) - times)[odd], times[odd])] = self.byte_ids[np.concatenate(spelled)]
        counts = np.bincount(words, minlength=len(offsets) - 1)
        return symbols.astype(np.int32), np.concatenate([[0], np.cumsum(counts)])


class Encoder:
    """Encodes blocks of texts; keeps the words that a task has seen."""

    def __init__(self, pieces: Pieces):
        self.p = pieces
        self.forget()

    def forget(self) -> None:
        self.known, self.place = np.zeros(0, U), np.zeros(0, np.int64)
        self.ids, self.offsets = np.zeros(0, np.int32), np.zeros(1, np.int64)
        self.words, self.at = Lanes(np.zeros(0, np.uint8)), np.zeros(1, np.int64)

    def learn(self, hashes: np.ndarray, data: np.ndarray, lengths: np.ndarray) -> None:
        """Encode words that are new: flat bytes, and the length of each."""
        ids, offsets = self.p.encode_words(data, np.concatenate([[0], np.cumsum(lengths)]))
        known, place = np.concatenate([self.known, hashes]), np.concatenate([self.place, len(self.place) + np.arange(len(hashes))])
        order = np.argsort(known)
        self.known, self.place = known[order], place[order]
        self.ids, self.offsets = np.concatenate([self.ids, ids]), np.concatenate([self.offsets, self.offsets[-1] + offsets[1:]])
        self.words, self.at = Lanes(np.concatenate([self.words.held[:-8], data])), np.concatenate([self.at, self.at[-1] + np.cumsum(lengths)])

    def encode(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, number of ids of each word)."""
        lanes, lengths = Lanes(data), ends - starts
        hashes = range_digests(lanes, starts, ends)
        distinct, first, word = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.known) > WORDS or len(self.words.held) > WORD_BYTES:
            self.forget()
        at = np.minimum(np.searchsorted(self.known, distinct), max(len(self.known) - 1, 0))
        seen = self.known[at] == distinct if len(self.known) else np.zeros(len(distinct), bool)
        if not seen.all():
            new = first[~seen]
            self.learn(distinct[~seen], data[ranges(starts[new], lengths[new])], lengths[new])
            at = np.searchsorted(self.known, distinct)
        place = self.place[at][word]
        same = np.diff(self.at)[place] == lengths
        same[same] = same_bytes(lanes, starts[same], lengths[same], self.words, self.at[place[same]])
        counts = np.diff(self.offsets)[place]
        if same.all():
            return self.ids[ranges(self.offsets[place], counts)], counts
        # words that share their hash with another one
        odd = np.flatnonzero(~same)
        ids, offsets = self.p.encode_words(data[ranges(starts[odd], lengths[odd])], np.concatenate([[0], np.cumsum(lengths[odd])]))
        begin = self.offsets[place]
        begin[odd], counts[odd] = len(self.ids) + offsets[:-1], np.diff(offsets)
        return np.concatenate([self.ids, ids])[ranges(begin, counts)], counts

    def __call__(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets), with the begin and end ids."""
        n = len(offsets) - 1
        if (data == 0xE2).any() and SPACE.encode() in (whole := data.tobytes()):
            texts = [whole[a:b].replace(SPACE.encode(), b" ") for a, b in zip(offsets[:-1], offsets[1:])]
            data = np.frombuffer(b"".join(texts), np.uint8)
            offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
        sizes = np.diff(offsets)
        filled = sizes > 0
        data = np.insert(data, offsets[:-1][filled], 32)  # the dummy prefix
        offsets = np.concatenate([[0], np.cumsum(sizes + filled)])
        if not len(data):
            ids = np.tile(np.array([self.p.bos, self.p.eos], np.int32), n)
            return ids, np.arange(n + 1) * 2
        heads = np.flatnonzero((data & 0xC0) != 0x80)
        number = self.p.number[np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)]
        cut = np.zeros(len(data), bool)
        cut[heads[1:]] = ~self.p.joins[number[:-1], number[1:]]
        cut[offsets[:-1][filled]] = True
        starts = np.flatnonzero(cut)
        inner, lengths = self.encode(data, starts, np.append(starts[1:], len(data)))
        total = np.concatenate([[0], np.cumsum(lengths)])[np.searchsorted(starts, offsets)]  # ids before each text
        out = np.empty(len(inner) + 2 * n, np.int32)
        ends_at = total + 2 * np.arange(n + 1)
        edge = np.zeros(len(out), bool)
        edge[ends_at[:-1]] = edge[ends_at[1:] - 1] = True
        out[ends_at[:-1]], out[ends_at[1:] - 1] = self.p.bos, self.p.eos
        out[~edge] = inner
        return out, ends_at


def decode_ids(pieces: Pieces, ids: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of the texts: pieces joined, spaces restored, the dummy prefix dropped."""
    lengths = np.diff(pieces.piece_offsets)[ids]
    out = pieces.piece_bytes[ranges(pieces.piece_offsets[ids], lengths)]
    at = np.concatenate([[0], np.cumsum(lengths)])[offsets]
    heads = at[:-1][at[:-1] < at[1:]]
    heads = heads[out[heads] == 32]
    dropped = np.zeros(len(out) + 1, np.int64)
    dropped[heads + 1] = 1
    return np.delete(out, heads), at - np.cumsum(dropped)[at]


def encode(docs: DataFrame, model_path: str, carry: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """``row`` and ``ids``: the ids of each whole text, packed as little-endian unsigned 32-bit integers."""
    shared = docs.sparkSession.sparkContext.broadcast(Pieces.load(model_path))  # bounded by the vocabulary

    def make():
        encoder = Encoder(shared.value)

        def work(data, offsets):
            ids, at = encoder(data, offsets)
            return [strings(ids.astype("<u4").view(np.uint8), at * 4, pa.binary())]

        return work

    return map_texts(docs, make, "ids binary", carry, text)


def decode(encoded: DataFrame, model_path: str) -> DataFrame:
    """``row``, ``ids`` and ``decoded``: the text of the packed ids."""
    shared = encoded.sparkSession.sparkContext.broadcast(Pieces.load(model_path))

    def make():
        def work(data, offsets):
            ids = np.frombuffer(data.tobytes(), "<u4").astype(np.int64)
            out, at = decode_ids(shared.value, ids, offsets // 4)
            return [strings(data, offsets, pa.binary()), strings(out, at, pa.string())]

        return work

    return map_texts(encoded, make, "ids binary, decoded string", ("row",), "ids").select("row.row", "ids", "decoded")


def round_trip(docs: DataFrame, model_path: str, carry: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """``row``, ``ids`` and ``decoded`` in one pass: what ``encode`` returns, and the text that ``decode`` makes of it."""
    shared = docs.sparkSession.sparkContext.broadcast(Pieces.load(model_path))  # bounded by the vocabulary

    def make():
        encoder = Encoder(shared.value)

        def work(data, offsets):
            ids, at = encoder(data, offsets)
            out, ends = decode_ids(shared.value, ids, at)
            return [strings(ids.astype("<u4").view(np.uint8), at * 4, pa.binary()), strings(out, ends, pa.string())]

        return work

    return map_texts(docs, make, "ids binary, decoded string", carry, text)


def model_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op4_sentencepiece(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    path = model_path()
    out = round_trip(docs, path)
    return out.select(
        "row.doc_id",
        F.expr("cast(octet_length(ids) div 4 as bigint)").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
