"""Sharding, quality, SentencePiece, decontamination and secret scans against plain versions."""

import base64
import hashlib
import random
import re
import time
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from logtide.llm import decontamination, quality, secret_scan, sentencepiece_codec, sharding
from logtide.llm.blocks import blocks, text_arrays

from .common import complements, documents, lower, odd_texts, words


def smallest_capacity(sizes, shards):
    def runs(c):
        n, held = 1, 0
        for s in sizes:
            if held + s > c:
                n, held = n + 1, 0
            held += s
        return n

    low, high = max(sizes), sum(sizes)
    while low < high:
        middle = (low + high) // 2
        low, high = (low, middle) if runs(middle) <= shards else (middle + 1, high)
    return low


@pytest.mark.parametrize("n, hot", [(0, 0), (1, 0), (40, 0.0), (5000, 0.3)])
def test_minimax_shards(spark, n, hot):
    rng = random.Random(n)
    rows = [(7 if rng.random() < hot else rng.randrange(-(2**63), 2**63), rng.randint(1, 900)) for _ in range(n)]
    out = sharding.minimax_shards(spark.createDataFrame(rows, "key long, size long"), 16).collect()
    groups, load, spans = {}, {}, {}
    for r in out:
        groups[r.key] = groups.get(r.key, 0) + r["size"]
        load[r.shard] = load.get(r.shard, 0) + r["size"]
        spans.setdefault(r.shard, []).append(r.key)
    assert len(out) == n
    if n:
        assert max(load.values()) == smallest_capacity([groups[k] for k in sorted(groups)], 16)
        order = [(min(v), max(v)) for _, v in sorted(spans.items())]
        assert all(a[1] < b[0] for a, b in zip(order, order[1:])) and 0 <= min(load) and max(load) < 16


def test_op1(spark, tmp_path):
    docs = documents(spark, odd_texts())
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    out = sharding.op1_sharding(spark, str(tmp_path)).collect()
    given = docs.collect()
    assert len(out) == len(given)
    crc = sorted(zlib.crc32((r.text or "").encode()) for r in given)
    assert sorted(r.text_crc32 for r in out) == crc and sorted(r["size"] for r in out) == sorted(len((r.text or "").encode()) + 1 for r in given)
    shard_of = {}
    for r in out:
        assert shard_of.setdefault((r.text_crc32, r["size"]), r.shard) == r.shard
    groups = {r.key: r.n for r in docs.select(F.xxhash64(F.coalesce("text", F.lit(""))).alias("key"), (F.octet_length(F.coalesce("text", F.lit(""))) + 1).alias("n")).groupBy("key").agg(F.sum("n").alias("n")).collect()}
    load = {s: sum(r["size"] for r in out if r.shard == s) for s in set(shard_of.values())}
    assert max(load.values()) == smallest_capacity([groups[k] for k in sorted(groups)], 16)
    for s in set(shard_of.values()):
        assert sorted(r.slot for r in out if r.shard == s) == list(range(sum(r.shard == s for r in out)))


def test_blocks_cover_everything():
    texts = odd_texts()
    batch = pa.RecordBatch.from_arrays([pa.array(texts), pa.array(range(len(texts)))], ["text", "i"]).slice(3)
    got = [(r.column("i")[k].as_py(), d[o[k] : o[k + 1]].tobytes()) for r, d, o in blocks(batch, "text", 5000) for k in range(r.num_rows)]
    assert got == [(i, (t or "").encode()) for i, t in enumerate(texts)][3:]


def test_classifier_learns_and_holds_out(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    model = quality.train(docs, labels)
    out = {r.doc_id: r.score for r in quality.score(docs, model).select("row.doc_id", "score").collect()}
    held = [(out[r.doc_id], r.quality) for r in labels.collect() if zlib.crc32(str(r.doc_id).encode()) % 3 == 1]
    assert len(held) > 50 and np.mean([(s >= 0.5) == (q == 1) for s, q in held]) > 0.95
    assert all(0 <= s <= 1 for s in out.values())


def test_classifier_on_odd_inputs(spark):
    docs = documents(spark, odd_texts())
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r.score for r in quality.score(docs, quality.train(docs, none)).collect()} == {0.5}
    some = spark.createDataFrame([(i, q, None) for i in range(40) for q in ([None], [2], [i % 2], [i % 2, i % 2])[i % 4]] + [(None, 1, 0)], "doc_id long, quality int, toxic int")
    model = quality.train(docs, some)
    assert quality.score(docs, model).count() == docs.count() and quality.score(docs.limit(0), model).count() == 0
    kept = quality.keep_good(docs, some)
    assert kept.columns == docs.columns


def plain_statistics(text):
    """The statistics of one text, straight from their names."""
    raw = text.encode()
    n = max(len(raw), 1)
    kinds = {
        "upper": lambda c: 65 <= c <= 90, "lower": lambda c: 97 <= c <= 122, "digit": lambda c: 48 <= c <= 57, "blank": lambda c: c in (9, 32), "newline": lambda c: c == 10, "stop": lambda c: c in b".?",
        "comma": lambda c: c in b",;:", "shout": lambda c: c == 33, "symbol": lambda c: c in b"#$%&*@^~+=_", "bar": lambda c: c in b"|<>{}[]\\/", "quote": lambda c: c in b"\"'()-", "control": lambda c: c < 32 and c not in (9, 10) or c == 127, "wide": lambda c: c >= 128,
    }
    out = [sum(map(k, raw)) / n for k in kinds.values()]
    words, lines = re.findall(rb"[^\x20\x09-\x0D]+", raw), re.findall(rb"[^\n]+", raw)
    low = lambda xs: [x.lower() for x in xs]
    w, k = max(len(words), 1), max(len(lines), 1)
    sizes = [len(x) for x in words]
    mean = sum(sizes) / w
    odd = [sum(kinds["symbol"](c) or kinds["shout"](c) or kinds["bar"](c) for c in x) for x in words]
    out += [np.log1p(len(raw)), np.log1p(len(words)), mean, np.sqrt(max(sum(x * x for x in sizes) / w - mean**2, 0)), max(sizes, default=0), len(set(low(words))) / w, max(Counter(low(words)).values(), default=0) / w]
    out += [sum(65 <= x[0] <= 90 for x in words) / w, sum(x > 0 for x in odd) / w, np.log1p(len(lines)), np.log1p(sum(map(len, lines)) / k), len(set(low(lines))) / k, max(Counter(low(lines)).values(), default=0) / k, sum(x > 1 for x in odd) / w]
    return out


def test_statistics_against_plain_ones():
    texts = [t for t in odd_texts() if t is not None] + ["Hello, WORLD! a_b\nhello, world! a_b\n\n  x=1 {y} \x07 é\t$$", "A\nb\nA\n" * 9]
    got = quality.statistics(*text_arrays(pa.array(texts)))
    for text, row in zip(texts, got):
        assert np.allclose(row, plain_statistics(text)), (text[:60], dict(zip(quality.NAMES, zip(row, plain_statistics(text)))))


def test_boosting_lowers_the_loss_round_by_round():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 5))
    y = (x[:, 0] * x[:, 1] + 0.3 * rng.normal(size=400) > 0).astype(float)
    loss = lambda m: -np.mean(y * np.log(m.score(x)) + (1 - y) * np.log(1 - m.score(x)))
    losses = [loss(quality.fit(x, y, trees=k)) for k in (1, 3, 9, 27)]
    assert losses == sorted(losses, reverse=True) and losses[-1] < 0.3 < losses[0]
    # the first split of a single feature is the best one that bins allow
    one = quality.fit(np.arange(100.0)[:, None], (np.arange(100) >= 40).astype(float), trees=1, depth=1)
    assert 38 <= one.threshold[one.roots[0]] < 41  # bins are 100 / 64 wide


def test_documents_without_an_id_are_not_held_out(spark, tmp_path):
    spark.createDataFrame([(None, "a b"), (1, "c d")], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(None, 1, 0), (None, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    out = {r.doc_id: (r.held_out, r.score) for r in quality.op2_quality(spark, str(tmp_path)).collect()}
    assert out == {None: (False, 0.5), 1: (zlib.crc32(b"1") % 3 == 1, 0.5)}


def test_documents_that_share_an_id_bound_what_is_learned(spark):
    docs = spark.createDataFrame([(i % 6, f"text {i}") for i in range(300)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(6)], "doc_id long, quality int, toxic int")
    assert quality.train(docs, labels).base == quality.train(docs.limit(300), labels, rows=50).base


def test_trees_equal_a_plain_traversal():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(600, 4))
    m = quality.fit(x, ((x[:, 0] > 0) ^ (x[:, 1] > 0.3)).astype(float), trees=20)

    def walk(row):
        total = m.base
        for root in m.roots:
            k = root
            while m.left[k] != k:
                k = m.left[k] if row[m.feature[k]] <= m.threshold[k] else m.right[k]
            total += m.value[k]
        return 1 / (1 + np.exp(-total))

    assert np.allclose(m.score(x), [walk(r) for r in x])
    assert ((m.score(x) > 0.5) == ((x[:, 0] > 0) ^ (x[:, 1] > 0.3))).mean() > 0.95


def test_sentencepiece_equals_the_library(spark):
    import sentencepiece

    path = sentencepiece_codec.model_path()
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    rng = random.Random(3)
    alphabet = "abcdefgh  ▁\n\t .,éñ漢字🙂\x00<>0xA'ſth the ing"
    texts = odd_texts() + ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(1500)] + ["a" * k for k in range(50)] + [" " * k for k in range(50)]
    out = sentencepiece_codec.decode(sentencepiece_codec.encode(documents(spark, texts), path), path).collect()
    given = {i: t or "" for i, t in enumerate(texts)} | {None: "no id"}
    assert len(out) == len(texts) + 2
    for r in out:
        want = library.encode(given[r.row.doc_id], add_bos=True, add_eos=True)
        assert np.frombuffer(r.ids, "<u4").tolist() == want and r.decoded == library.decode(want)


def test_sentencepiece_on_words_without_spaces(spark):
    import sentencepiece

    path = sentencepiece_codec.model_path()
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    rng = random.Random(4)
    texts = [*complements(10), *complements(12), "".join(rng.choices("etaoinshr", k=1_000_000)), "the" * 20_000, "漢字かな交じり文" * 3000, "aaaab" * 9000, "".join(rng.choices("ABCdef0123456789+/", k=60_000))]
    began = time.time()
    out = sentencepiece_codec.round_trip(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), path).collect()
    assert time.time() - began < 60
    for r in out:
        want = library.encode(texts[r.row.doc_id], add_bos=True, add_eos=True)
        assert np.frombuffer(r.ids, "<u4").tolist() == want and r.decoded == library.decode(want)


def test_both_kinds_of_rounds_agree(monkeypatch):
    p = sentencepiece_codec.Pieces.load(sentencepiece_codec.model_path())
    rng = random.Random(9)
    data, offsets = text_arrays(pa.array(["".join(rng.choices("etaoinsh ing", k=rng.randint(1, 80))) for _ in range(400)]))
    one = p.encode_words(data, offsets)
    monkeypatch.setattr(sentencepiece_codec, "LONG", 0)
    other = p.encode_words(data, offsets)
    assert all(np.array_equal(a, b) for a, b in zip(one, other))


WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


@pytest.mark.parametrize("part, most", [(decontamination.PART, decontamination.PASS), (40, decontamination.PASS), (40, 300)])
def test_decontamination_against_windows(spark, part, most):
    rng = random.Random(5)
    items = {str(i): words(rng, rng.randint(0, 40), 60) for i in range(12)} | {"long, odd": "É1 b2 c3 d4 e5 f6 g7 h8 i9 j10 k11 l12 m13 n14", "none": "!!"}
    texts = [None, "", "!!!", "w1"] + [f"{words(rng, rng.randint(0, 60), 60)} {rng.choice(list(items.values()))} {words(rng, rng.randint(0, 9), 60)}".upper() for _ in range(60)] + ["x É1 b2 c3 d4 e5 f6 g7 h8 i9 j10 k11 l12 m13"]
    benchmark = spark.createDataFrame([*items.items(), (None, None), ("0", items["0"])], "item_id string, text string")
    windows = {}
    for i, t in [*items.items(), ("", "")]:
        w = WORDS.findall(lower(t))
        for k in range(max(1, len(w) - 12)) if w else []:
            windows.setdefault(tuple(w[k : k + 13]), set()).add(i)
    docs = documents(spark, texts)
    out = decontamination.search(docs, benchmark, part=part, most=most).collect()
    given = dict(enumerate(texts)) | {None: "no id"}
    for r in out:
        w = WORDS.findall(lower(given[r.row.doc_id]))
        hit, found = set(), set()
        for size in {len(k) for k in windows}:
            for k in range(len(w) - size + 1):
                if ids := windows.get(tuple(w[k : k + size])):
                    hit.update(range(k, k + size))
                    found |= ids
        assert (r.n_words, r.n_hit, set(r["items"])) == (len(w), len(hit), found)
        assert sum(b - a for a, b in np.frombuffer(r.hits, "<i8").reshape(-1, 2).tolist()) == len(hit)
        assert r.contaminated == (len(hit) > 0 and 20 * len(hit) >= len(w))
    clean = decontamination.clean(docs, benchmark)
    assert clean.columns == docs.columns and clean.count() == sum(not r.contaminated for r in out)
    assert decontamination.clean(docs, benchmark.limit(0)).count() == docs.count()


def test_proximity(spark):
    docs = documents(spark, ["c x b x a", "a b x x x x x x x c", "a b"])
    out = decontamination.search(docs, spark.createDataFrame([("i", "a b c")], "item_id string, text string"), span=4).collect()
    out = {r.row.doc_id: r for r in out}
    assert [out[i].near_items for i in range(3)] == [["i"], [], []] and all(not r["items"] for r in out.values())
    more = decontamination.search(docs, spark.createDataFrame([("i", "a b c"), ("j", "a b")], "item_id string, text string"), span=4, part=2, most=2).collect()
    assert {r.row.doc_id: (r.n_hit, r.near_items) for r in more if r.row.doc_id in (0, 1, 2)} == {0: (0, ["i", "j"]), 1: (2, ["j"]), 2: (2, ["j"])}


@pytest.mark.parametrize("span", [2, 5, 14])
def test_proximity_against_every_stretch(spark, span):
    rng = random.Random(span)
    items = {str(i): " ".join(rng.choice("abcdefgh") for _ in range(rng.randint(0, 6))) for i in range(40)}
    texts = [" ".join(rng.choice("abcdefghxyz") for _ in range(rng.randint(0, 25))) for _ in range(150)]
    benchmark = spark.createDataFrame(list(items.items()), "item_id string, text string")
    want = {}
    for d, text in enumerate(texts):
        w = text.split()
        want[d] = sorted(i for i, item in items.items() if item and any(set(item.split()) <= set(w[k : k + span + 1]) for k in range(len(w))))
    for parts in (1, 6):  # whichever words are rarest in a segment
        docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(parts)
        assert {r.row.doc_id: r.near_items for r in decontamination.search(docs, benchmark, span=span).collect()} == want


@pytest.mark.parametrize("k", [10, 12])
def test_words_that_polynomials_confuse(spark, k):
    a, b = complements(k)
    docs = spark.createDataFrame([(0, f"one {a} two"), (1, f"one {b} two")], "doc_id long, text string")
    out = decontamination.search(docs, spark.createDataFrame([(5, f"one {b} two")], "item_id long, text string")).collect()
    assert {r.row.doc_id: r.n_hit for r in out} == {0: 0, 1: 3}


ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def test_secrets_against_plain_patterns(spark, sf_dir):
    rng = random.Random(3)
    bits = ["password", " = ", "'", "SECRET", ":", "é", "abcdef0123456789", "0123456789abcdef0", "AKIA", "ABCDEFGH12345678", " ", "tok", "en", "api_key", "apikey=", "xYz123/+", "\n", "ſecret=abcdefgh"]
    texts = odd_texts() + ["".join(rng.choice(bits) for _ in range(rng.randint(0, 14))) for _ in range(800)]
    docs = documents(spark, texts)
    given = dict(enumerate(texts)) | {None: "no id"}
    out = secret_scan.scan(docs).collect()
    for r in out:
        t = given[r.row.doc_id] or ""
        want = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(t) if len(m[2]) >= 6]
        want += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", t) if len(m[0]) >= 20] + [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", t) if len(m[0]) >= 24]
        base = [(s["start"], secret_scan.KINDS.index(s["kind"]), s["end"]) for s in r.spans if s["kind"] != "markov"]
        assert base == sorted(want)
        for s in r.spans:
            if s["kind"] == "markov":
                assert not any(a <= s["start"] and s["end"] <= b for a, _, b in want)
    safe = secret_scan.redact(docs)
    assert safe.columns == docs.columns and safe.count() == docs.count()
    spans = {r.row.doc_id: r.spans for r in out}
    for r in safe.collect():
        t, want, at = given[r.doc_id], "", 0
        for s in spans[r.doc_id]:
            if s["start"] >= at:
                want += t[at : s["start"]] + "[SECRET]"
            at = max(at, s["end"])
        assert r.text == (want + t[at:] if spans[r.doc_id] else t)


def test_markov_spans_against_a_plain_model(spark):
    rng = random.Random(12)
    samples = secret_scan.labelled_samples(seed=5, count=500)
    ratios = secret_scan.train(samples)
    made = [s for s, _ in secret_scan.labelled_samples(seed=6, count=300)]
    pool = made + ["/".join(rng.choices(made, k=3)) for _ in range(60)] + ["AKIA" + "Q" * 20, "deadbeef" * 4, "token=abcdef123"]
    texts = [" ".join(rng.choice(pool) + rng.choice(["", ".", "é"]) for _ in range(rng.randint(1, 6))) for _ in range(200)]
    out = {r.row.doc_id: r.spans for r in secret_scan.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), samples).collect()}
    for i, text in enumerate(texts):
        base = [(s["start"], s["end"]) for s in out[i] if s["kind"] != "markov"]
        covered = {k for a, b in base for k in range(a, b)}
        want = []
        for m in re.finditer(r"[A-Za-z0-9+/_=-]{20,}", text):
            want += [p for p in plain_parts(text, *m.span(), ratios) if not covered >= set(range(*p))]
        assert [(s["start"], s["end"]) for s in out[i] if s["kind"] == "markov"] == sorted(want)


def plain_parts(text, low, high, ratios):
    """The random parts of text[low:high]: the best one, widened to separators, and those beside it."""
    if high - low < secret_scan.LEAST:
        return []
    c = [0, 0, *(secret_scan.ALPHABET.index(x) + 1 for x in text[low:high])]
    sums = [0.0]
    for k in range(high - low):
        sums.append(sums[-1] + float(ratios[c[k], c[k + 1], c[k + 2]]) - secret_scan.DRIFT)
    best = (secret_scan.LEVEL, None, None)
    for b in range(secret_scan.LEAST, len(sums)):
        for a in range(b - secret_scan.LEAST + 1):
            if sums[b] - sums[a] > best[0]:
                best = (sums[b] - sums[a], a, b)
    if best[1] is None:
        return []
    a, b = low + best[1], low + best[2]
    while a > low and text[a - 1] not in "/=":
        a -= 1
    while b < high and text[b] not in "/=":
        b += 1
    return plain_parts(text, low, a, ratios) + [(a, b)] + plain_parts(text, b, high, ratios)


# strings that the generator of samples has not made
ORDINARY = """
zwischenspeicherverwaltung-2024 benutzerkontoverwaltung_v2_prod 550e8400-e29b-41d4-a716-446655440000 spring-boot-starter-data-jpa-3 org/apache/commons/lang3/StringUtils
Rindfleischetikettierung2019 internationalization-i18n-support AbstractSingletonProxyFactoryBean2 com/example/project/module1/Controller node_modules/react-dom/cjs/index18
2024-01-15-release-notes-draft kubernetes-cluster-node-pool-04 test_should_return_404_when_missing arquitectura_de_software_2021 developpement-logiciel-libre-75
Hauptbahnhof_Gleis_12_Abfahrt photo_album_summer_2018_italy MAX_CONNECTION_POOL_SIZE_64 requirements_python311_linux quarterly-report-2023-q4-final
chapter-07-advanced-topics-notes windows10professional64bit user_profile_picture_512x512 straszenverkehrsordnung1998 gesundheitsversicherung_2022_plan
actualizacion_de_datos_2020 reconnaissance_vocale_version4 bluetooth-low-energy-5-adapter backup_database_production_01 javax/servlet/http/HttpServlet25
""".split()
SECRET = [
    *(base64.b64encode(hashlib.sha256(f"s{i}".encode()).digest()[: 18 + i]).decode().rstrip("=") for i in range(12)),
    *(base64.b32encode(hashlib.sha1(f"t{i}".encode()).digest()).decode() for i in range(6)),
    *("sk_live_" + base64.b64encode(hashlib.md5(f"u{i}".encode()).digest()).decode().replace("+", "x").replace("/", "y").rstrip("=") for i in range(6)),
    *("ghp_" + base64.b64encode(hashlib.sha256(f"v{i}".encode()).digest()).decode().replace("+", "A").replace("/", "b")[:36] for i in range(6)),
    *(hashlib.sha256(f"w{i}".encode()).hexdigest().upper()[:40] for i in range(5)),
]


def test_markov_models_on_strings_that_they_were_not_trained_on(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = secret_scan.train(secret_scan.labelled_samples(secret_scan.ordinary_words(docs)))

    def flagged(s):
        return "markov" in [secret_scan.KINDS[k] for k in secret_scan.find(*text_arrays(pa.array([f"x {s} y"])), model)[1]]

    wrong, missed = [s for s in ORDINARY if flagged(s)], [s for s in SECRET if not flagged(s)]
    assert len(wrong) <= 1 and len(missed) <= 1
    assert not flagged("zwischenspeicherverwaltung-2024") and not flagged("benutzerkontoverwaltung_v2_prod") and not flagged("550e8400-e29b-41d4-a716-446655440000")


@pytest.mark.parametrize("alphabet", ["abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz", secret_scan.ALPHABET[:62], secret_scan.ALPHABET[:64]], ids=["lower", "letters", "alnum", "base64"])
def test_random_strings_are_found_behind_any_path(spark, alphabet):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    words = secret_scan.ordinary_words(docs)
    model, rng = secret_scan.train(secret_scan.labelled_samples(words)), random.Random(len(alphabet))
    for path in ("", "user/profile/", "service/account/profile/", "organization/department/team/project/configuration/settings/"):
        secrets = ["".join(rng.choices(alphabet, k=32)) for _ in range(200)]
        text, kind, start, end = secret_scan.find(*text_arrays(pa.array([f"see {path}{s} there" for s in secrets])), model)
        assert len(set(text[kind == 3].tolist())) >= 190, path
        whole = {int(t) for t, k, a, b in zip(text, kind, start - np.arange(200)[text] * len(f"see {path}{secrets[0]} there"), end - start) if k == 3 and a <= 4 + len(path) and a + b >= 4 + len(path) + 32}
        assert len(whole) >= (160 if "/" in alphabet else 190), path  # a slash may cut a string
    ordinary = [s for s, y in secret_scan.labelled_samples(words, seed=77, count=3000) if y == 0 and len(s) >= 20]
    text, kind, _, _ = secret_scan.find(*text_arrays(pa.array(ordinary)), model)
    assert len(set(text[kind == 3].tolist())) <= len(ordinary) / 100
    text, kind, _, _ = secret_scan.find(*text_arrays(pa.array(["sha256-abcdefghijklmnopqrstuvwxyz0123456789", "SKU-12345678-ABCD-000123456", "550e8400-e29b-41d4-a716-446655440000"])), model)
    assert not (kind == 3).any()


def test_nothing_of_a_secret_stays_beside_a_pattern(spark):
    text = "use sk_live_0123456789abcdef01234567ZqT9xLw7KpR3vNs8YtBm2Qd6 now, or " + "0123456789abcdef" * 2 + "."
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert secret_scan.redact(docs).first().text == "use [SECRET] now, or [SECRET]."
    r = secret_scan.scan(docs).first()
    assert [s["kind"] for s in r.spans] == ["markov", "hex", "hex"]


def test_op8_digest(spark, tmp_path):
    docs = documents(spark, ["password = hunter2222 é token:abcdefgh", None])
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    r = secret_scan.op8_secrets(spark, str(tmp_path)).orderBy("doc_id").collect()
    r = next(x for x in r if x.doc_id == 0)
    assert (r.n_assign, r.n_access, r.n_hex) == (2, 0, 0) and r.base_sha256 == hashlib.sha256(b"assign:0:21,assign:24:38").hexdigest() and r.spans == "assign:0:21,assign:24:38"
