"""URL filters, nearest neighbours, Jaccard join, chat formatting and substring deduplication."""

import hashlib
import json
import random
import re
import time
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from logtide.llm import chat_format, jaccard_join, nearest, samples, substring_dedup, url_filters

from .common import WORD, complements, documents, lower, odd_texts, words


def test_urls(spark):
    urls = [None, "", "no scheme", "http://", "HTTP://A.Example.ORG/es/x?q#f", "http://example.org/en/12", "x://y://z/w", "http://org/", "http://org", "http://myorg/", "https://a.com/fr/1", "https://com/de/", "http://a.com?x=/de/", "http://É.com/de/\nx"] * 2
    pages = spark.createDataFrame([(i, u, "h", "p") for i, u in enumerate(urls)], "page_id long, url string, host string, path string")
    out = {r.page_id: r for r in url_filters.judge(pages, []).collect()}
    for i, u in enumerate(urls):
        m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", u or "")
        host, path = (lower(m[1]), m[2]) if m else ("", "")
        fitting = [(len(t), t, v) for t, v in url_filters.RULES for d, p in [t.split("/", 1)] if (host == d or host.endswith("." + d)) and path.startswith("/" + p)]
        best = max(fitting, default=(0, None, "allow"))
        assert (out[i].host, out[i].path, out[i].rule, out[i].verdict) == (host, path, best[1], best[2]), u


def test_mined_rules(spark):
    rng = random.Random(1)
    rows = [(i, f"http://h{rng.randrange(5)}.net/{'spam/offer' if i % 4 == 0 else 'spam' if i % 4 == 1 else 'news'}/{i}") for i in range(400)]
    pages = spark.createDataFrame([*rows, (None, None)], "page_id long, url string")
    labels = spark.createDataFrame([(i, 0 if i % 4 == 0 else 1, 0) for i in range(0, 400, 3)] + [(None, 0, 0)], "doc_id long, quality int, toxic int")
    mined = url_filters.mine(pages, labels)
    assert ["p:offer"] in mined
    out = {r.page_id: r.verdict for r in url_filters.judge(pages, mined).collect()}
    assert all(out[i] == ("block" if i % 4 == 0 else "allow") for i in range(400)) and out[None] == "allow"
    assert url_filters.mine(pages, labels.limit(0)) == [] and url_filters.judge(pages.limit(0), mined).count() == 0
    items = F.split(F.lit("a b c"), " ")
    assert [spark.range(1).select(url_filters.blocked(items, r)).first()[0] for r in ([["a", "c"]], [["a", "d"], ["e"]], [], [["c"], ["x", "y"]])] == [True, False, False, True]


def plain_rules(baskets, support, confidence):
    """All minimal rules of up to three tokens, by counting every combination; tokens of the same pages are one."""
    least = max(url_filters.LEAST, -(-len(baskets) * support // 1))
    pages = defaultdict(frozenset)
    for i, (items, _) in enumerate(baskets):
        for t in items:
            pages[t] |= {i}
    first = {}
    for t in sorted(pages):
        first.setdefault(pages[t], t)
    bad = {i for i, (_, b) in enumerate(baskets) if b}
    out = []
    for size in (1, 2, 3):
        for rule in combinations(sorted(first.values()), size):
            held = frozenset.intersection(*(pages[t] for t in rule))
            if len(held & bad) >= least and len(held & bad) >= confidence * len(held) and not any(set(r) <= set(rule) for r in out):
                out.append(list(rule))
    return sorted(out)


def test_mined_rules_against_all_combinations(spark):
    rng = random.Random(7)
    rows, baskets, labels = [], [], []
    for i in range(300):
        path = sorted(rng.sample("abcdefg", rng.randint(1, 5)))
        bad = {"a", "b"} <= set(path) or {"c", "d", "e"} <= set(path) or rng.random() < 0.1
        rows.append((i, f"http://z.net/{'/'.join(x * 2 for x in path)}"))
        labels.append((i, int(not bad), 0))
        baskets.append((["h:net", "h:z", *(f"p:{x * 2}" for x in path)], bad))
    pages, marks = spark.createDataFrame(rows, "page_id long, url string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    mined = url_filters.mine(pages, marks)
    assert mined == plain_rules(baskets, url_filters.SUPPORT, url_filters.CONFIDENCE) and ["p:aa", "p:bb"] in mined


def long_paths(spark, seed, n, names, good, worse):
    """Pages whose paths hold many of these segments, bad ones more of them; labels; baskets."""
    rng = random.Random(seed)
    rows, baskets, labels = [], [], []
    for i in range(n):
        bad = rng.random() < 0.4
        path = [x for x in names if rng.random() < (worse if bad else good)]
        rows.append((i, f"http://z.net/{'/'.join(path)}"))
        labels.append((i, int(not bad), 0))
        baskets.append((["h:net", "h:z", *(f"p:{x}" for x in path)], bad))
    return spark.createDataFrame(rows, "page_id long, url string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), baskets


def test_rules_of_long_paths_are_all_found(spark):
    names = [x * 3 for x in "abcdefghijklmn"]
    pages, labels, baskets = long_paths(spark, 11, 1000, names, 0.35, 0.65)
    mined = url_filters.mine(pages, labels)
    assert mined == plain_rules(baskets, url_filters.SUPPORT, url_filters.CONFIDENCE) and len(mined) > 100
    block = {i for i, (items, _) in enumerate(baskets) if any(set(r) <= set(items) for r in mined)}
    assert {r.page_id for r in url_filters.judge(pages, mined).collect() if r.verdict == "block"} == block


@pytest.mark.parametrize("longest", [1, 2, 4, None])
def test_rules_of_any_length(spark, longest):
    pages, labels, baskets = long_paths(spark, 12, 120, [x * 3 for x in "abcdefg"], 0.4, 0.7)
    least, pages_of = max(url_filters.LEAST, -(-len(baskets) * url_filters.SUPPORT // 1)), {}
    for i, (items, _) in enumerate(baskets):
        for t in items:
            pages_of.setdefault(t, set()).add(i)
    bad = {i for i, (_, b) in enumerate(baskets) if b}
    tokens = sorted({min(t for t in pages_of if pages_of[t] == held) for held in pages_of.values()})
    want = []
    for size in range(1, (longest or len(tokens)) + 1):
        for rule in combinations(tokens, size):
            held = set.intersection(*(pages_of[t] for t in rule))
            if len(held & bad) >= least and len(held & bad) >= url_filters.CONFIDENCE * len(held) and not any(set(r) <= set(rule) for r in want):
                want.append(list(rule))
    assert url_filters.mine(pages, labels, longest=longest) == sorted(want)


def test_rules_are_counted_over_all_labels(spark):
    # of 30 000 labelled pages, 300 are needed: tokens of 300 bad pages and of 299, which no sample tells apart
    n, size = 30_000, 300
    path = F.concat(F.lit("k"), (F.col("id") / size).cast("int").cast("string"))
    letters = F.translate(path, "0123456789", "abcdefghij")  # digits of a segment are folded
    pages = spark.range(n).select(F.col("id").alias("page_id"), F.concat(F.lit("http://z.net/"), letters).alias("url"))
    group, first = (F.col("id") / size).cast("int"), F.col("id") % size == 0
    labels = spark.range(n).select(F.col("id").alias("doc_id"), F.when((group >= 40) | (group % 2 == 1) & first, 1).otherwise(0).alias("quality"), F.lit(0).alias("toxic"))
    names = [["p:k" + "".join("abcdefghij"[int(d)] for d in str(g))] for g in range(0, 40, 2)]
    assert url_filters.mine(pages, labels) == sorted(names)


def test_sixty_tokens(spark):
    names = [x * k for k in range(3, 9) for x in "abcdefghij"]
    pages, labels, baskets = long_paths(spark, 13, 300, names, 0.45, 0.6)
    began = time.time()
    mined = url_filters.mine(pages, labels)
    assert time.time() - began < 60
    assert mined == plain_rules(baskets, url_filters.SUPPORT, url_filters.CONFIDENCE)


def test_mining_long_paths_ends(spark):
    rng = random.Random(3)
    long = "/".join("abcdefghij"[i % 10] * (2 + i // 10) for i in range(60))
    rows = [(i, f"http://a.com/{'/'.join(x for x in long.split('/') if rng.random() > 0.03)}" if i % 2 else f"http://b.com/{i}") for i in range(20)]
    pages, labels = spark.createDataFrame(rows, "page_id long, url string"), spark.createDataFrame([(i, int(i % 2 == 0), 0) for i in range(20)], "doc_id long, quality int, toxic int")
    began = time.time()
    mined = url_filters.mine(pages, labels)
    assert time.time() - began < 30 and ["h:a"] in mined
    assert {r.page_id: r.verdict for r in url_filters.judge(pages, mined).collect()} == {i: "block" if i % 2 else "allow" for i in range(20)}


def test_url_plan_has_no_python(spark, sf_dir):
    plan = url_filters.op3_url_filters(spark, sf_dir)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_nearest_recall_and_order(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(3000, 32)).astype(np.float32)
    x[50:60] = x[49]
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(9001, None), (9100, [0.0] * 32), (9200, [float("nan")] * 32), (9300, [None] * 32), (9400, [1.0]), (9500, [float("inf")] + [1.0] * 31), (None, [1.0] * 32)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    out = nearest.search(vectors, vectors.where("vec_id % 100 = 0")).collect()
    got = defaultdict(list)
    for r in sorted(out, key=lambda r: (r.query_id, r.rank)):
        got[r.query_id].append(r)
    full, hits = x.astype(np.float64), 0
    for q in range(0, 3000, 100):
        d = np.sqrt(((full - full[q]) ** 2).sum(1))
        d[q] = np.inf
        best = np.lexsort((np.arange(3000), d))[:10]
        mine = got.pop(q)
        assert [r.rank for r in mine] == list(range(1, 11)) and [(r.score, r.vec_id) for r in mine] == sorted((r.score, r.vec_id) for r in mine)
        assert np.allclose([r.score for r in mine], d[[r.vec_id for r in mine]], rtol=0, atol=1e-12)
        hits += len({r.vec_id for r in mine} & set(best.tolist()))
    assert not got and hits / 300 >= 0.9


def test_nearest_with_few_vectors(spark):
    few = spark.createDataFrame([(0, [1.0, 0.0]), (100, [1.0, 0.0]), (3, [-1.0, 0.1])], "vec_id long, embedding array<float>")
    out = [(r.query_id, r.rank, r.vec_id) for r in nearest.search(few, few.where("vec_id % 100 = 0")).orderBy("query_id", "rank").collect()]
    assert out == [(0, 1, 100), (0, 2, 3), (100, 1, 0), (100, 2, 3)]
    assert nearest.search(few.limit(0), few).count() == 0
    mixed = few.union(spark.createDataFrame([(200, [1.0, 2.0, 3.0]), (7, [1.0, 2.0, 4.0])], few.schema))
    out = sorted((r.query_id, r.rank, r.vec_id) for r in nearest.search(mixed, mixed.where("vec_id % 100 = 0"), block=16).collect())
    assert out == [(0, 1, 100), (0, 2, 3), (100, 1, 0), (100, 2, 3), (200, 1, 7)]


def test_probing_finds_every_code_within_the_radius():
    rng = np.random.default_rng(2)
    code = rng.integers(0, 1 << 16, size=(500, nearest.PARTS)).astype(np.uint16)
    code[:60] = code[7]
    code[np.arange(60), rng.integers(0, nearest.PARTS, 60)] ^= rng.integers(0, 1 << 16, 60).astype(np.uint16)
    index = nearest.Index(code)
    assert all(sum(bin(int(x) ^ int(y)).count("1") for x, y in zip(code[i], code[7])) == nearest.distance(code, code[7])[i] for i in range(90))
    for r in (0, 9, 22, 110, 130):
        assert set(index.probe(code[7], r)) == set(np.flatnonzero(nearest.distance(code, code[7]) <= r))


def classes(ids, texts):
    sets = []
    for t in texts:
        w = WORD.findall(lower(t))
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    parent = list(range(len(ids)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and 100 * (n := len(a & sets[j])) >= 75 * (len(a) + len(sets[j]) - n) and n:
                parent[find(i)] = find(j)
    least = defaultdict(lambda: 1 << 60)
    for i, d in enumerate(ids):
        least[find(i)] = min(least[find(i)], d)
    return {d: (len(sets[i]), least[find(i)]) for i, d in enumerate(ids)}


def near_copies(seed):
    rng = random.Random(seed)
    out = [None, "", " ", "a b", "A b", "a b c d", "x"] + ["line one two three four five six seven eight nine ten eleven " + words(rng, rng.randint(1, 6)) for _ in range(40)]
    for _ in range(8):
        base, rate = words(rng, rng.randint(8, 120)), rng.random() * 0.08
        out += [" ".join(w if rng.random() > rate else words(rng, 1) for w in base.split()) for _ in range(rng.randint(1, 20))] + [base, base.upper()]
    return out


def test_jaccard_join_against_all_pairs(spark):
    texts = near_copies(5)
    ids = list(range(100, 100 + len(texts)))
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in zip(ids, texts)], "doc_id long, text string, row string, class int")
    got = {r.doc_id: (r.n, r.component) for r in jaccard_join.classes_of(docs).collect()}
    assert got == classes(ids, texts)


def test_most_frequent(spark):
    rows = spark.createDataFrame([(i, n) for i, n in enumerate([1000, 900, 500, 40, 40, 40, 3, 1, 1])], "key int, n long")
    got = lambda k: sorted(r.key for r in samples.most_frequent(rows, "n", k).collect())
    assert got(3) == [0, 1, 2] and got(5) == [0, 1, 2] and got(6) == [0, 1, 2, 3, 4, 5] and got(99) == list(range(9)) and got(0) == []
    assert samples.most_frequent(rows.limit(0), "n", 5).count() == 0


def test_bounded_samples(spark):
    rows = spark.range(5000).select(F.col("id").alias("key"))
    some = [r.key for r in samples.bounded(rows, 100, "key").collect()]
    assert len(some) == 100 and some == [r.key for r in samples.bounded(rows.repartition(7), 100, "key").collect()]
    assert samples.bounded(rows.limit(30), 100, "key").count() == 30


def test_lists_in_parts(spark):
    texts = near_copies(6) + [f"{'the same passage of some ten words in each of them'} {words(random.Random(i), 4)}" for i in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.n, r.component) for r in jaccard_join.classes_of(docs, split=3).collect()}
    assert got == classes(list(range(len(texts))), texts)


@pytest.mark.parametrize("k", [10, 12])
def test_jaccard_join_tells_words_apart_that_polynomials_confuse(spark, k):
    a, b = complements(k)
    docs = spark.createDataFrame([(0, f"{a} one two three four five"), (1, f"{b} one two three four five"), (2, f"{a} one two three four five")], "doc_id long, text string")
    got = {r.doc_id: (r.n, r.component) for r in jaccard_join.classes_of(docs).collect()}
    assert got == {0: (2, 0), 1: (2, 1), 2: (2, 0)}


def test_rows_that_share_an_id_are_documents_of_their_own(spark):
    a, b = "a b c d e f", "u v w x y z"
    docs = spark.createDataFrame([(3, a), (5, a), (5, b), (9, b)], "doc_id long, text string")
    assert sorted((r.doc_id, r.component) for r in jaccard_join.classes_of(docs).collect()) == [(3, 3), (5, 3), (5, 5), (9, 5)]


def test_members_of_one_hash_are_told_apart():
    digests = np.array([[7, 1], [7, 2], [8, 3], [7, 1]])
    ids = jaccard_join.member_ids(digests, np.array([7])).tolist()
    assert ids[0] == ids[3] != ids[1] and ids[2] == 8


def test_jaccard_join_on_odd_inputs(spark):
    docs = documents(spark, odd_texts())
    got = jaccard_join.classes_of(docs).collect()
    texts = odd_texts()
    want = classes(range(len(texts)), texts)
    assert len(got) == docs.count()
    assert {r.doc_id: (r.n, r.component) for r in got if r.doc_id is not None and r.n} == {k: v for k, v in want.items() if v[0]}
    assert jaccard_join.classes_of(docs.limit(0)).count() == 0


def test_one_of_each_class_stays(spark):
    rows = [(1, "a b c d e f", "x"), (1, "a b c d e f", "x"), (2, "A b c d e f", "y"), (None, "", None), (None, "q r", None), (3, "", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row string")
    out = jaccard_join.keep_one(docs)
    assert out.columns == docs.columns
    assert sorted(map(str, out.collect())) == sorted(map(str, [docs.collect()[i] for i in (0, 3, 4, 5)]))


def test_repeated_rows(spark):
    wordless = [(1, "", "x"), (1, "", "x"), (1, None, "x"), (1, None, "x")]
    rows = [*wordless, (7, "some words", "b"), (7, "some words", "a"), (7, "some words", "a"), (8, "other", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    want = sorted(map(str, [*(r for r in docs.collect() if not r.text), *(r for r in docs.distinct().collect() if r.text and r.lang != "b")]))
    assert sorted(map(str, jaccard_join.keep_one(docs).collect())) == want
    assert jaccard_join.keep_one(docs.where("text is null or text = ''")).count() == 4


def test_prefixes_never_miss_a_pair():
    rng = random.Random(8)
    for _ in range(300):
        universe = [rng.randrange(1, 40) if rng.random() < 0.5 else 1 for _ in range(200)]
        a = sorted(rng.sample(range(200), rng.randint(1, 120)), key=lambda t: (universe[t], t))
        b = sorted(set(a) ^ set(rng.sample(range(200), rng.randint(0, 20))), key=lambda t: (universe[t], t))
        common = len(set(a) & set(b))
        if not b or 100 * common < 75 * (len(a) + len(b) - common):
            continue
        (la, pa), (lb, pb) = (jaccard_join.prefix(np.arange(len(s)), np.array([float(universe[t]) for t in s])) for s in (a, b))
        bound, need = jaccard_join.needed(len(a), la, len(b), lb)
        shared = set(a[:pa]) & set(b[:pb])
        assert sum(min(len(a) - a.index(t), len(b) - b.index(t)) + need - 1 >= bound for t in shared) >= need >= 1


LAYOUTS = [
    ({"messages": [{"role": "user", "content": "a"}, {"role": "assistant", "content": "b"}]}, [("user", "a"), ("assistant", "b")]),
    ({"id": 7, "prompt": "x", "response": "y"}, [("user", "x"), ("assistant", "y")]),
    ({"instruction": "x", "input": "", "output": "y"}, [("user", "x"), ("assistant", "y")]),
    ({"instruction": "x", "input": "z", "output": "y"}, [("user", "x\n\nz"), ("assistant", "y")]),
    ({"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": None}]}, [("user", "q"), ("assistant", "")]),
]


def test_layouts_become_turns(spark):
    rows = [(i, json.dumps(r)) for i, (r, _) in enumerate(LAYOUTS)] + [(90, "not json"), (91, None), (92, '{"what": 1}')]
    out = defaultdict(list)
    for r in chat_format.from_json(spark.createDataFrame(rows, "conv_id long, record string"), "conv_id", "record").collect():
        out[r.conv_id].append((r.role, r.text))
    assert all(out[i] == want for i, (_, want) in enumerate(LAYOUTS))
    more = [
        ({"messages": [{"role": "user", "content": "a", "name": "x"}, {"role": "assistant", "content": "b"}], "model": "m", "tags": ["t"]}, [("user", "a"), ("assistant", "b")]),
        ({"messages": [], "source": "s"}, []),
        ({"instruction": "x", "input": "z", "output": "y", "score": 3, "meta": {"a": 1}}, [("user", "x\n\nz"), ("assistant", "y")]),
        ({"prompt": "x", "response": "y", "completion": "z"}, [("user", "x"), ("assistant", "y")]),
        ({"messages": [{"role": "user"}]}, None),
        ({"messages": "text", "prompt": "p"}, None),
    ]
    values = [
        ({"instruction": "i", "input": "", "output": 0}, [("user", "i"), ("assistant", "0")]),
        ({"prompt": False, "response": ""}, [("user", "false"), ("assistant", "")]),
        ({"prompt": "p", "response": None}, [("user", "p")]),
        ({"question": 3, "answer": 1.5}, [("user", "3"), ("assistant", "1.5")]),
        ({"question": {"a": [1]}, "answer": "b"}, None),
        ({"messages": [{"role": "user", "content": 0}]}, [("user", "0")]),
        ({"messages": [{"role": "user", "content": [{"type": "text", "text": "hi"}, {"type": "image", "url": "u"}, {"type": "text", "text": "you"}]}]}, [("user", "hi\nyou")]),
        ({"messages": [{"role": "user", "content": [{"type": "text", "text": "hi"}]}, {"role": "assistant", "content": "b"}]}, [("user", "hi"), ("assistant", "b")]),
        ({"messages": [{"role": "assistant", "content": None, "tool_calls": [{"id": 1}]}]}, [("assistant", "")]),
        ({"prompt": [{"role": "user", "content": "a"}], "completion": [{"role": "assistant", "content": "b"}]}, [("user", "a"), ("assistant", "b")]),
        ({"prompt": [{"role": "system", "content": "s"}, {"role": "user", "content": "a"}], "completion": "b"}, [("system", "s"), ("user", "a"), ("assistant", "b")]),
        ({"prompt": "p", "chosen": "c", "rejected": "r"}, [("user", "p"), ("assistant", "c")]),
        ({"chosen": [{"role": "user", "content": "a"}, {"role": "assistant", "content": "b"}], "rejected": []}, [("user", "a"), ("assistant", "b")]),
        ({"prompt": [{"role": "user", "content": "a"}], "chosen": [{"role": "assistant", "content": "b"}], "rejected": []}, [("user", "a"), ("assistant", "b")]),
    ]
    for record, want in more + values:
        assert chat_format.record_turns(record, frozenset(["id"])) == want, record
    counts = chat_format.from_json(spark.createDataFrame([(i, json.dumps(r)) for i, (r, _) in enumerate(more)], "conv_id long, record string"), "conv_id", "record").groupBy(F.col("role").isNull().alias("odd")).count().collect()
    assert {r.odd: r["count"] for r in counts} == {True: 2, False: 6}
    odd = [json.dumps(r) for r, _ in values] + ["not json", None, "[]", '{"what": 1}']
    aside = {r.path: r.records for r in chat_format.set_aside(spark.createDataFrame([(x,) for x in odd], "record string"), "record").collect()}
    assert aside == {".messages[].content[].url": 1, ".messages[].tool_calls[]": 1, ".messages[].tool_calls[].id": 1, ".rejected": 1, ".rejected[]": 2}
    assert out[90] == [(None, "not json")] and out[91] == [(None, None)] and out[92] == [(None, '{"what": 1}')]
    typed = spark.createDataFrame([(1, "p", "r", 5)], "conv_id long, prompt string, response string, other int")
    assert [(r.role, r.text) for r in chat_format.canonical_turns(typed).orderBy("turn").collect()] == [("user", "p"), ("assistant", "r")]
    with pytest.raises(ValueError):
        chat_format.canonical_turns(spark.range(1))


def test_escapes_are_reversible():
    rng = random.Random(1)
    pool = [*chat_format.CONTROL, "\\", "<", "|", "s>", "a", "\n", "[", "INST]", "[\\INST]", "%0A", "%"]
    for _ in range(3000):
        text, role = ("".join(rng.choice(pool) for _ in range(rng.randint(0, n))) for n in (12, 3))
        whole, a, b = chat_format.format_turn(role, text)
        assert not any(c in chat_format.escape(text) for c in chat_format.CONTROL)
        found = chat_format.TURN.findall(whole * 2)
        assert len(found) == 2 and chat_format.unescape_role(found[1][0]) == role and chat_format.unescape(found[0][1]) == text == chat_format.unescape(whole[a:b])


def test_conversations_read_back(spark, tmp_path):
    rng = random.Random(2)
    rows = [(c, t, rng.choice(["user", "assistant", "system", None, "odd\nrole"]), rng.choice(["hé", None, "", "</s>[INST] x", "a\\b <|im_end|>\n"]), "x") for c in range(30) for t in range(rng.randint(1, 6))] + [(None, 0, "assistant", "n", "x"), (4, None, "user", "first", "x")]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted string").write.parquet(str(tmp_path / "conversations.parquet"))
    odd = "</s>[INST] ok [/INST]"
    rows += [(-1, 0, "user", odd, ""), (-1, 1, "assistant", odd, "")]
    by = defaultdict(list)
    for c, t, r, x, _ in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0)):
        by[c].append((r or "", x or ""))
    out = {r.conv_id: r for r in chat_format.op9_chat_format(spark, str(tmp_path)).collect()}
    assert set(out) == set(by)
    for c, turns in by.items():
        loss = "".join(x for r, x in turns if r == "assistant")
        assert out[c].n_turns == len(turns) and out[c].turns_sha256 == hashlib.sha256("".join(f"{r}\n{x}\n" for r, x in turns).encode()).hexdigest()
        assert out[c].loss_chars == len(loss) and out[c].loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()


def stripped(texts):
    raw = [(t or "").encode() for t in texts]
    seen = Counter(b[i : i + 200] for b in raw for i in range(len(b) - 199))
    out = []
    for b in raw:
        gone = bytearray(len(b))
        for i in range(len(b) - 199):
            if seen[b[i : i + 200]] > 1:
                gone[i : i + 200] = b"\1" * 200
        out.append((bytes(x for x, g in zip(b, gone) if not g), sum(1 for i in range(len(b)) if gone[i] and not (i and gone[i - 1]))))
    return out


@pytest.mark.parametrize("hot", [substring_dedup.HOT, 0, 20])
def test_substring_dedup_against_all_windows(spark, hot):
    rng = random.Random(5)
    word = lambda n: " ".join("".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 8))) for _ in range(n))
    base, passages = word(300), [word(60) for _ in range(4)]
    texts = [None, "", "x" * 150, "a" * 500, "ab" * 300, base, base]
    for _ in range(25):
        own = base.split(" ")
        for _ in range(rng.randint(0, 6)):
            own[rng.randrange(len(own))] = word(1)
        texts.append(" ".join(own[rng.randint(0, 50) : rng.randint(200, 300)]))
    texts += [f"{word(rng.randint(0, 50))} {rng.choice(passages)[rng.randint(0, 150):]}{word(rng.randint(0, 50))}{rng.choice(passages)}" for _ in range(25)]
    docs = spark.createDataFrame([(i, t, "r") for i, t in enumerate(texts)], "doc_id long, text string, row string")
    got = {r.doc_id: (bytes(r.kept), len(r.removed) // 16) for r in substring_dedup.dedup(docs, hot=hot).collect()}
    assert got == dict(enumerate(stripped(texts)))


@pytest.mark.parametrize("k", [8, 10, 12])
def test_substring_dedup_tells_texts_apart_that_polynomials_confuse(spark, k):
    texts = [x + y for x in complements(k) for y in ("", "c")] + [f"{'z' * 300}{x}" for x in complements(k)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (bytes(r.kept), len(r.removed) // 16) for r in substring_dedup.dedup(docs).collect()}
    assert got == dict(enumerate(stripped(texts)))


def test_atoms_of_long_texts_in_pieces():
    rng = np.random.default_rng(4)
    data = rng.integers(97, 100, 5000).astype(np.uint8)
    text, g, lo, n = substring_dedup.atoms(data, np.array([0, 5000]), piece=700)
    assert not text.any() and lo[0] == 0 and np.array_equal(lo[1:], (lo + n)[:-1]) and lo[-1] + n[-1] == 4801 and n.max() <= 153
    _, other, at, m = substring_dedup.atoms(data, np.array([0, 5000]))
    assert np.array_equal(np.repeat(g, n), np.repeat(other, m))


def test_substring_dedup_on_odd_inputs(spark):
    docs = documents(spark, odd_texts())
    assert substring_dedup.dedup(docs).count() == docs.count() and substring_dedup.dedup(docs.limit(0)).count() == 0
    same = spark.createDataFrame([(1, "q" + "z" * 199 + "y")] * 2, "doc_id long, text string")
    assert [bytes(r.kept) for r in substring_dedup.dedup(same).collect()] == [b"", b""]


def test_suffix_sort_orders_suffixes():
    rng = np.random.default_rng(3)
    data = rng.integers(97, 99, 3000).astype(np.uint8)
    at = rng.choice(2900, 400, replace=False)
    group = np.sort(rng.integers(0, 5, 400))
    s = substring_dedup.Suffixes(data)
    order = s.sort(at, np.full(400, 3000), group)
    raw = data.tobytes()
    want = sorted(range(400), key=lambda i: (group[i], raw[at[i] :]))
    assert order.tolist() == want
