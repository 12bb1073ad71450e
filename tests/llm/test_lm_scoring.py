"""Language-model scoring against plain versions."""

import math
import re
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from logtide.llm import lm_scoring as lm

from .common import documents, lower, odd_texts


def tokens(text):
    return re.findall(r"[^\x20\x09-\x0D]+", lower(text)) + [None]


def is_held(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 10 == 0


def plain_base(rows):
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score) of rows (doc_id, text)."""
    c = Counter(t for d, text in rows if not is_held(d) for t in tokens(text))
    total, distinct = sum(c.values()), len(c)
    out = []
    for d, text in rows:
        own = tokens(text)
        out.append((d, is_held(d), len(own), sum(c[t] > 0 for t in own), total, sum(math.log10((c[t] + 0.1) / (total + 0.1 * (distinct + 1))) for t in own)))
    return out


def order(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[2:]))


def small_model(seed=0):
    rng = np.random.default_rng(seed)
    counts = np.zeros(lm.IDS)
    counts[rng.choice(lm.IDS, 3000, replace=False)] = rng.zipf(1.5, 3000)
    counts[lm.END] = 50
    model = lm.Model(counts, [b"%06d" % i for i in range(lm.IDS)])
    for name, x in model.w.items():  # none of the weights stays at its start
        if not name.startswith(("class_bias", "place_bias")):
            model.w[name] = x + rng.normal(0, 0.3, x.shape).astype(np.float32)
    return model, rng


@pytest.mark.parametrize("sizes", [[0], [1, 0, 5], [40, 3, 0, 100, 17, 15, 16, 1]])
def test_scores_against_loops(sizes):
    model, rng = small_model()
    texts = [rng.choice(lm.END, n) for n in sizes]
    stream = lm.Stream()
    for ids in texts:
        stream.add(ids.astype("<u2"))
    at = 0
    got = lm.score_stream(model, model.table(), *stream.arrays())
    _, targets, _ = stream.arrays()
    for ids in texts:
        n = len(ids) + 1
        # windows lie along the stream: the plain version gets the text's place in it
        pad = at % lm.SPAN
        whole = [lm.END, *ids.tolist()]
        for t in range(n):
            first = max(0, (pad + t) // lm.SPAN * lm.SPAN - lm.SPAN - pad)
            logs = one_step(model, whole[first : t + 1])
            target = targets[at + t]
            assert got[at + t] == pytest.approx(logs[model.slot[target]] + model.share[target], abs=2e-3)
        at += n


def one_step(model, seen):
    """Logarithms of the probabilities of all slots after the ids that the last query sees."""
    w = {k: x.astype(float) for k, x in model.w.items()}
    e = w["embed"][model.slot[np.array(seen)]]
    s = np.array([(e[-1] @ w["query"]) @ (x @ w["key"]) / math.sqrt(lm.HEAD) + w["far"][len(seen) - 1 - j] for j, x in enumerate(e)])
    a = np.exp(s - s.max())
    z = np.maximum(e[-1] @ w["own"] + (a / a.sum()) @ (e @ w["value"]) @ w["seen"] + w["bias"], 0)
    soft = lambda x: x - x.max() - np.log(np.exp(x - x.max()).sum())
    whole = soft(z @ w["class"] + w["class_bias"])
    return np.concatenate([whole[c] + soft(z @ w["place"][c] + w["place_bias"][c]) for c in range(lm.CLASSES)])


def test_probabilities_add_up_to_one():
    model, rng = small_model(3)
    logs = one_step(model, [lm.END, 5, 77])
    share = np.exp(logs[model.slot] + model.share)
    assert share.sum() == pytest.approx(1, abs=1e-6)


def test_gradients_against_differences():
    model, rng = small_model(1)
    stream = lm.Stream()
    for n in (30, 0, 50, 9):
        stream.add(rng.choice(lm.END, n).astype("<u2"))
    arrays = stream.arrays()
    x, y, seen = lm.chosen_windows(model.slot, *arrays, np.arange(-(-len(arrays[0]) // lm.SPAN)))
    model.w = {k: v.astype(np.float64) for k, v in model.w.items()}
    loss, g = lm.gradients(model, x, y, seen)
    logs = lm.score_stream(lm.Model.copy(model), model.table().astype(np.float32), *arrays) - model.share[arrays[1]]
    assert loss == pytest.approx(-logs.mean(), abs=1e-3)
    for name in model.w:
        at = np.unravel_index(int(np.abs(g[name]).argmax()), g[name].shape)
        held = model.w[name][at]
        model.w[name][at] = held + 1e-5
        more = lm.gradients(model, x, y, seen)[0]
        model.w[name][at] = held - 1e-5
        less = lm.gradients(model, x, y, seen)[0]
        model.w[name][at] = held
        assert (more - less) / 2e-5 == pytest.approx(float(g[name][at]), rel=2e-3, abs=1e-5), name


def test_a_step_uses_its_arrays_again():
    model, rng = small_model(5)
    stream = lm.Stream()
    for n in (900, 0, 700, 2_000):
        stream.add(rng.choice(lm.END, n).astype("<u2"))
    some = lm.chosen_windows(model.slot, *stream.arrays(), np.r_[0:60, 90:158])  # two runs of windows
    want_loss, want = lm.gradients(model, *some)
    space, adam = lm.Space(), lm.Adam(model.copy(), 0.01)
    lm.gradients(model, *(a[:40] for a in some), space, adam.g)
    lm.gradients(model, *(a[::-1] for a in some), space, adam.g)
    tracemalloc.start()
    loss, got = lm.gradients(model, *some, space, adam.g)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 1_500_000  # with fresh arrays, these 128 windows took 5.4 MB
    assert loss == pytest.approx(want_loss) and all(np.allclose(got[k], want[k], rtol=1e-4, atol=1e-6) for k in want)


@pytest.mark.parametrize("size", [1, 2, 3, 7, 100])
def test_requests_for_a_word_meet_across_batches(size):
    rng = np.random.default_rng(size)
    rows = sorted((b"w%d" % w, b, c, int(n)) for w in range(12) for b, (c, n) in enumerate(zip(rng.integers(0, 99, 5), rng.integers(0, 3, rng.integers(1, 6)))))
    batches = (pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*[(b, c, w, n) for w, b, c, n in rows[a : a + size]]), (pa.int64(), pa.int32(), pa.binary(), pa.int64()))], ["block", "code", "word", "n"]) for a in range(0, len(rows), size))
    got = [r for b in lm.known_words(batches, lm.vocabulary_path()) for r in b.to_pylist()]
    total = Counter()
    for w, _, _, n in rows:
        total[w] += n
    encode = lm.splitter(lm.vocabulary_path()).encode_ordinary
    assert [(r["block"], r["code"], r["n"] >> 1, r["payload"]) for r in got] == [(b, c, total[w], np.array(encode(" " + w.decode()), "<u2").tobytes()) for w, b, c, _ in rows]
    assert sum(r["n"] & 1 for r in got) == len(total)


def test_words_are_shuffled_once(spark):
    docs = spark.createDataFrame([(i, f"w{i % 7} x{i}") for i in range(50)], "doc_id long, text string")
    cut, plans = lm.Scratch.cut, []
    lm.Scratch.cut = lambda self, df, name, rows=None: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or cut(self, df, name, rows)
    try:
        lm.scores(docs, rounds=0)
    finally:
        lm.Scratch.cut = cut
    assert not any("Join" in p or "Aggregate" in p for p in plans) and sum(p.count("Repartition") for p in plans) == 2


def test_every_window_is_learnt_from():
    model, rng = small_model(4)
    texts = [rng.choice(lm.END, n).astype("<u2") for n in [70_000, 0, 5, *rng.integers(0, 3_000, 60)]]
    batches = lambda: (pa.RecordBatch.from_arrays([pa.array([t.tobytes() for t in texts[a : a + 9]], pa.binary())], ["ids"]) for a in range(0, len(texts), 9))
    tokens = sum(len(t) + 1 for t in texts)
    assert tokens > 2 * lm.SPAN * lm.LEAST
    learnt = sum(lm.train_task(batches(), model.copy(), turn)[1] for turn in range(lm.ROUNDS))
    assert tokens <= learnt <= tokens + (lm.ROUNDS - 1) * (lm.SPAN * lm.LEAST + max(len(t) for t in texts) + lm.TOGETHER)


def test_codes_survive_packing():
    rng = np.random.default_rng(2)
    for width in (1, 2, 3, 4):
        values = rng.integers(0, 1 << 8 * width, 100)
        assert lm.from_planes(np.frombuffer(lm.planes(values, width), np.uint8), width).tolist() == values.tolist()


def test_base_and_shape(spark):
    docs = documents(spark, odd_texts() * 2)
    got = lm.scores(docs, rounds=1).collect()
    want = order(plain_base([(r.doc_id, r.text) for r in docs.collect()]))
    assert len(got) == len(want)
    for g, w in zip(order([tuple(r) for r in got]), want):
        assert g[:5] == w[:5] and g[5] == pytest.approx(w[5], rel=1e-9, abs=1e-9) and -1e7 < g[6] < 0


def test_many_blocks(spark):
    rows = [(i, f"w{i % 7} common x{i} " * (i % 5)) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = order([tuple(r) for r in lm.scores(docs, rounds=0).collect()])
    want = order(plain_base(rows))
    assert [g[:5] for g in got] == [w[:5] for w in want] and np.allclose([g[5] for g in got], [w[5] for w in want])


def test_learning_helps(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    bits = [r.s / r.n for rounds in (0, 3) for r in lm.scores(docs, rounds=rounds).where("held_out").selectExpr("-sum(score) / log10(2) as s", "sum(n_tokens) as n").collect()]
    assert bits[1] < bits[0] - 1.5  # bits a word of held-out texts, without and with learning


def test_without_training_texts(spark):
    docs = spark.createDataFrame([(d, "a b") for d in range(60) if is_held(d)], "doc_id long, text string")
    out = lm.scores(docs).collect()
    assert len(out) > 2 and all((r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) == (True, 3, 0, 0, 0.0) and r.score < 0 for r in out)
