"""Quality classifier: histogram gradient-boosted trees over document statistics.

The statistics of whole texts are computed in vectorised passes over byte blocks. Trees are grown on the driver by
histograms of quantile bins, from at most ``TRAIN_ROWS`` labelled documents (those with the smallest hash of doc_id, so
that the sample does not depend on partitioning), and flattened into arrays of feature, threshold and child, which all
documents of a block descend together.

Null and empty texts have zero statistics and get a score like any other text. Labels other than 0 and 1 are not learned
from; a document with two labels counts once for each, and of documents that share an id one is learned from. With no labels, or one class only, every score is the share
of label 1 (0.5 with no labels). A null doc_id is not held out and has no label.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logtide.llm.blocks import Lanes, flags, lowered, map_texts, range_digests, word_spans
from logtide.llm.samples import bounded

TRAIN_ROWS = 20_000
TREES, DEPTH, RATE, BINS, L2 = 60, 5, 0.15, 64, 1.0


def _table(predicate) -> np.ndarray:
    return np.array([predicate(i) for i in range(256)])


#: Byte classes; the share of each in a text is a statistic.
CLASSES = {
    "upper": _table(lambda i: 65 <= i <= 90),
    "lower": _table(lambda i: 97 <= i <= 122),
    "digit": _table(lambda i: 48 <= i <= 57),
    "blank": _table(lambda i: i in (9, 32)),
    "newline": _table(lambda i: i == 10),
    "stop": _table(lambda i: i in b".?"),
    "comma": _table(lambda i: i in b",;:"),
    "shout": _table(lambda i: i == 33),
    "symbol": _table(lambda i: i in b"#$%&*@^~+=_"),
    "bar": _table(lambda i: i in b"|<>{}[]\\/"),
    "quote": _table(lambda i: i in b"\"'()-"),
    "control": _table(lambda i: i < 32 and i not in (9, 10) or i == 127),
    "wide": _table(lambda i: i >= 128),
}
CLASS_OF = np.zeros(256, np.int64)
for _i, _t in enumerate(CLASSES.values(), 1):
    CLASS_OF[_t] = _i
NAMES = [f"share_{c}" for c in CLASSES] + ["log_bytes", "log_words", "word_length", "word_spread", "longest_word", "distinct_words", "top_word", "capitalised", "symbol_words", "log_lines", "line_length", "distinct_lines", "top_line", "mark_runs"]


def _per_text(values: np.ndarray, first: np.ndarray, reduce=np.add) -> np.ndarray:
    """Reduce values of consecutive elements by text; 0 for a text without any."""
    out = np.zeros(len(first) - 1, np.float64)
    some = first[:-1] < first[1:]
    if some.any():
        out[some] = reduce.reduceat(values, first[:-1][some])
    return out


def _repeats(hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct elements, occurrences of the most frequent one) by text."""
    n = len(first) - 1
    text = np.repeat(np.arange(n), np.diff(first))
    order = np.lexsort((hashes, text))
    h, t = hashes[order], text[order]
    if not len(h):
        return np.zeros(n), np.zeros(n)
    new = np.concatenate([[True], (h[1:] != h[:-1]) | (t[1:] != t[:-1])])
    heads = np.flatnonzero(new)
    counts = np.diff(np.append(heads, len(h)))
    groups = np.searchsorted(t[heads], np.arange(n + 1))
    return np.diff(groups).astype(np.float64), _per_text(counts, groups, np.maximum)


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of statistics for each text."""
    n = len(offsets) - 1
    size = np.diff(offsets).astype(np.float64)
    per = np.maximum(size, 1)
    text = np.repeat(np.arange(n), np.diff(offsets))
    shares = np.bincount(text * 14 + CLASS_OF[data], minlength=14 * n).reshape(n, 14)[:, 1:] / per[:, None]
    lanes = Lanes(lowered(data))
    start, end, first = word_spans(data, offsets, flags("space"))
    words, length = np.diff(first).astype(np.float64), (end - start).astype(np.float64)
    each = np.maximum(words, 1)
    mean = _per_text(length, first) / each
    distinct, top = _repeats(range_digests(lanes, start, end), first)
    marks = np.zeros(len(data) + 1, np.int64)
    np.cumsum(CLASSES["symbol"][data] | CLASSES["shout"][data] | CLASSES["bar"][data], out=marks[1:])
    dirty = marks[end] - marks[start]
    line = np.ones(256, bool)
    line[10] = False
    ls, le, lf = word_spans(data, offsets, line)
    lines, of_line = np.diff(lf).astype(np.float64), np.maximum(np.diff(lf), 1)
    line_distinct, line_top = _repeats(range_digests(lanes, ls, le), lf)
    columns = [
        np.log1p(size), np.log1p(words), mean, np.sqrt(np.maximum(_per_text(length**2, first) / each - mean**2, 0)), _per_text(length, first, np.maximum),
        distinct / each, top / each, _per_text(CLASSES["upper"][data[start]] if len(start) else np.zeros(0), first) / each, _per_text((dirty > 0).astype(float), first) / each,
        np.log1p(lines), np.log1p(_per_text((le - ls).astype(float), lf) / of_line), line_distinct / of_line, line_top / of_line, _per_text((dirty > 1).astype(float), first) / each,
    ]
    return np.column_stack([shares, *columns])


@dataclass
class Trees:
    """All trees in flat arrays; a leaf is its own child."""

    base: float
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for root in self.roots:
            at = np.full(len(x), root)
            for _ in range(self.depth):
                at = np.where(x[rows, self.feature[at]] <= self.threshold[at], self.left[at], self.right[at])
            total += self.value[at]
        return 1 / (1 + np.exp(-total))


def fit(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, rate: float = RATE, bins: int = BINS, l2: float = L2) -> Trees:
    """Logistic loss, second-order gains, level by level."""
    share = float(np.clip(y.mean(), 1e-6, 1 - 1e-6)) if len(y) else 0.5
    base = float(np.log(share / (1 - share)))
    empty = np.zeros(0, np.int64)
    if len(np.unique(y)) < 2:
        return Trees(base, empty, np.zeros(0), empty, empty, np.zeros(0), empty, 0)
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) for c in x.T]
    binned = np.column_stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T)])
    n, f = binned.shape
    flat = binned + np.arange(f) * bins
    feature, threshold, left, right, value, roots = [], [], [], [], [], []
    total = np.full(n, base)
    for _ in range(trees):
        p = 1 / (1 + np.exp(-total))
        g, hess = p - y, np.maximum(p * (1 - p), 1e-9)
        roots.append(len(feature))

        def leaf() -> int:
            k = len(feature)
            feature.append(0), threshold.append(np.inf), left.append(k), right.append(k), value.append(0.0)
            return k

        node = np.full(n, leaf())
        level = [roots[-1]]
        for d in range(depth):
            local = np.full(len(feature), -1)
            local[level] = np.arange(len(level))
            rows = np.flatnonzero(local[node] >= 0)
            slot = (local[node[rows]][:, None] * (f * bins) + flat[rows]).ravel()
            shape = (len(level), f, bins)
            gs, hs, cs = (np.bincount(slot, np.repeat(w, f), minlength=len(level) * f * bins).reshape(shape).cumsum(-1) for w in (g[rows], hess[rows], np.ones(len(rows))))
            gt, ht, ct = gs[:, :1, -1:], hs[:, :1, -1:], cs[:, :1, -1:]
            gain = gs**2 / (hs + l2) + (gt - gs) ** 2 / (ht - hs + l2) - gt**2 / (ht + l2)
            gain[(cs < 5) | (ct - cs < 5)] = 0
            best = gain.reshape(len(level), -1).argmax(1)
            following = []
            for k, parent in enumerate(level):
                j, b = divmod(int(best[k]), bins)
                if gain[k, j, b] <= 1e-7 or b >= len(edges[j]):
                    continue
                feature[parent], threshold[parent], left[parent], right[parent] = j, float(edges[j][b]), leaf(), leaf()
                own = np.flatnonzero(node == parent)
                node[own] = np.where(binned[own, j] <= b, left[parent], right[parent])
                following += [left[parent], right[parent]]
            level = following
            if not level:
                break
        sums = np.bincount(node, g, minlength=len(feature)), np.bincount(node, hess, minlength=len(feature))
        for k in np.unique(node).tolist():
            value[k] = float(-rate * sums[0][k] / (sums[1][k] + l2))
        total += np.array(value)[node]
    return Trees(base, np.array(feature), np.array(threshold), np.array(left), np.array(right), np.array(value), np.array(roots), depth)


def learnable(doc_id):
    """Labels may be learned from: the CRC-32 of the id as text, modulo 3, is not 1."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 != 1, F.lit(True))


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Trees:
    """Learn ``labels.quality`` from documents whose id is learnable."""
    usable = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & learnable(F.col("doc_id")))
    marked = bounded(usable.select("doc_id", "quality").distinct(), rows, "doc_id", "quality")
    texts = docs.select("doc_id", "text").join(F.broadcast(marked), "doc_id").withColumn("rank", F.xxhash64("text"))  # at most ``rows`` ids
    got = map_texts(texts, lambda: lambda data, offsets: [pa.array(list(statistics(data, offsets)), pa.list_(pa.float64()))], "x array<double>", ("doc_id", "quality", "rank"))
    # of documents that repeat an id, the one with the smallest hash of its text: at most ``rows`` vectors of statistics
    one = got.groupBy("row.doc_id", "row.quality").agg(F.min(F.struct("row.rank", "x")).alias("first"))
    learned = one.select("doc_id", "quality", "first.x").toArrow().to_pydict()
    order = np.lexsort((np.array(learned["quality"], float), np.array(learned["doc_id"], np.int64))) if learned["doc_id"] else []
    x = np.array([learned["x"][i] for i in order], np.float64).reshape(-1, len(NAMES))
    return fit(x, np.array([learned["quality"][i] for i in order], np.float64))


def score(docs: DataFrame, model: Trees, carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``row`` (the carried columns) and ``score`` of each whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the number of trees
    return map_texts(docs, lambda: lambda data, offsets: [pa.array(shared.value.score(statistics(data, offsets)))], "score double", carry)


def op2_quality(spark, sf_dir: str) -> DataFrame:
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    scored = score(docs, train(docs, labels))
    return scored.select("row.doc_id", (~learnable(F.col("row.doc_id"))).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the classifier accepts, with their own columns."""
    return score(docs, train(docs, labels), tuple(docs.columns)).where("score >= 0.5").select("row.*")
