"""Spelling variants against plain versions."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from logtide.llm import spelling
from logtide.llm.blocks import text_arrays
from logtide.scratch import Scratch

from .common import documents, odd_texts


def plain_words(rows):
    out = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate({i: i + 32 for i in range(65, 91)})
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1 :]
            out[run] += 1
    return {w: n for w, n in out.items() if len(w) >= 5 and n >= 3}


def one_error(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_variants(words):
    near = {w: [x for x in words if abs(len(x) - len(w)) < 2 and one_error(w, x)] for w in words}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-words[x], x), default=None)
        form[w] = best if best and words[best] >= 2 * words[w] else None
    out = set()
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, words[w], len(near[w]), words.get(form[w])))
    return out


def table(spark, words):
    return spark.createDataFrame(list(words.items()), "word string, n long")


def texts(seed):
    rng = random.Random(seed)
    base = ["house", "mouse", "garden", "gardener", "élève", "straße", "colour", "parallelism", "zzzzzz", "aaaaa"]
    out = []
    for _ in range(300):
        words = []
        for _ in range(rng.randint(5, 60)):
            w = list(rng.choice(base))
            if rng.random() < 0.4:
                k = rng.randrange(len(w))
                w[k : k + 1] = rng.choice([[], [rng.choice("aeé")], [w[k], rng.choice("xyz")]])
            words.append("".join(w).upper() if rng.random() < 0.1 else "".join(w))
        out.append(rng.choice([" ", "-", "×", "7", "漢"]).join(words))
    return out


def test_words_of_texts(spark):
    docs = documents(spark, odd_texts() + texts(1) + ["é" * 300 + "A" * 300] * 3 + ["ÀÁÂÃÄ öäüßÿ ŒŒŒŒŒ ªªªªª"] * 4)
    got = {r.word: r.n for r in spelling.corpus_words(docs).collect()}
    assert got == plain_words((r.doc_id, r.text) for r in docs.collect()) and len(got) > 100


def test_checksums_of_long_and_short_runs():
    rng = np.random.default_rng(1)
    data = rng.integers(0, 256, 5000).astype(np.uint8)
    starts = rng.integers(0, 4000, 300)
    ends = starts + np.concatenate([rng.integers(0, 80, 290), rng.integers(500, 900, 10)])
    before = rng.integers(0, 1 << 32, 300).astype(np.uint32)
    got = spelling.checksums(data, starts, ends, before)
    assert got.tolist() == [zlib.crc32(data[a:b].tobytes(), int(c)) for a, b, c in zip(starts, ends, before)]


@pytest.mark.parametrize("seed", range(4))
def test_automaton_numbers_its_words(seed):
    rng = random.Random(seed)
    words = sorted({"".join(rng.choice("abé") for _ in range(rng.randint(1, 7))) for _ in range(400)} | {"x" * 3000})
    a = spelling.Automaton(words)
    assert a.number(words).tolist() == list(range(len(words)))
    assert a.number(["", "q", "aaaaaaaaaaaa"]).tolist() == [-1, -1, -1]
    # minimal: no two states have the same ending and edges
    signs = {(bool(a.final[s]), tuple(zip(a.char[a.first[s] : a.first[s] + a.degree[s]].tolist(), a.to[a.first[s] : a.first[s] + a.degree[s]].tolist()))) for s in range(a.states)}
    assert len(signs) == a.states < sum(map(len, words))


def test_automaton_finds_one_error():
    rng = random.Random(9)
    words = sorted({"".join(rng.choice("ab") for _ in range(rng.randint(2, 8))) for _ in range(150)})
    a = spelling.Automaton(words)
    codes, offsets = text_arrays(pa.array([w.encode() for w in words]))
    q, k = a.near(codes.astype(np.int64), offsets, np.array([len(w) // 2 for w in words]))
    got = set(zip(q.tolist(), k.tolist()))
    assert len(got) == len(q)
    want = {(i, j) for i, w in enumerate(words) for j, x in enumerate(words) if one_error(w, x) and w[: len(w) // 2] == x[: len(w) // 2] and one_error(w[len(w) // 2 :], x[len(w) // 2 :])}
    assert got == want


@pytest.mark.parametrize("hot", [1 << 16, 40, 3])
def test_variants_against_all_pairs(spark, hot):
    rng = random.Random(3)
    words = plain_words((i, t) for i, t in enumerate(texts(2)))
    words |= {"".join(rng.choice("abc") for _ in range(rng.randint(5, 9))): rng.randint(3, 900) for _ in range(250)}
    words |= {"internationalprefix" + "".join(rng.choice("ab") for _ in range(6)): rng.randint(3, 9) for _ in range(60)} | {"y" * 700: 3, "y" * 701: 8, "y" * 350 + "z" + "y" * 350: 16}
    got = [tuple(r) for r in spelling.variants(table(spark, words), hot=hot).collect()]
    assert len(got) == len(words) and set(got) == plain_variants(words)


def test_hot_keys_are_split(spark):
    words = {"sameprefixeverywhere" + f"{i:05b}".translate({48: "a", 49: "b"}): 3 + i for i in range(32)}
    scratch = Scratch(spark, "test")
    near = {r.word: r.n_near for r in spelling.neighbours(scratch.cut(table(spark, words), "w"), scratch, 5).collect()}
    assert near == dict.fromkeys(words, 5) and scratch.spark.read.parquet(f"{scratch.root}/hot-0").count() > 0


def test_roots_follow_all_forms(spark):
    chain = [("a" * i, "a" * (i + 1) if i < 40 else None) for i in range(1, 41)]
    out = spelling.with_roots(spark.createDataFrame(chain, "word string, form string"), Scratch(spark, "test")).collect()
    assert {r.root for r in out} == {"a" * 40} and len(out) == 40


def test_op13(spark, tmp_path):
    docs = documents(spark, odd_texts() + texts(5))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    got = [tuple(r) for r in spelling.op13_spelling_variants(spark, str(tmp_path)).collect()]
    want = plain_variants(plain_words((r.doc_id, r.text) for r in docs.collect()))
    assert len(got) == len(want) and set(got) == want
