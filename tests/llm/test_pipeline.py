"""The pipeline against a plain version of each stage."""

import re

import numpy as np
import pyarrow as pa

import corpus_pipeline
from logtide.llm import quality, secret_scan, sentencepiece_codec
from logtide.llm.blocks import text_arrays

from .common import lower
from .test_corpus import classes
from .test_texts import ASSIGN, WORDS


def united(spans):
    out = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def plain(spark, sf_dir):
    import sentencepiece

    table = lambda t: spark.read.parquet(f"{sf_dir}/{t}.parquet")
    docs = [(r.doc_id, r.text) for r in table("documents").orderBy("doc_id").collect()]

    model = quality.train(table("documents"), table("labels"))

    def good(text):
        row = quality.statistics(*text_arrays(pa.array([text], pa.string())))[0]
        total = model.base
        for k in model.roots:
            while model.left[k] != k:
                k = model.left[k] if row[model.feature[k]] <= model.threshold[k] else model.right[k]
            total += model.value[k]
        return total >= 0

    docs = [d for d in docs if good(d[1])]
    of = classes([d for d, _ in docs], [t for _, t in docs])
    docs = [(d, t) for d, t in docs if of[d][1] == d or not of[d][0]]

    windows = set()
    for r in table("benchmark").collect():
        w = WORDS.findall(lower(r.text))
        windows |= {tuple(w[k : k + 13]) for k in range(max(1, len(w) - 12))} if w else set()

    def contaminated(text):
        w, hit = WORDS.findall(lower(text)), set()
        for size in {len(x) for x in windows}:
            for k in range(len(w) - size + 1):
                if tuple(w[k : k + size]) in windows:
                    hit.update(range(k, k + size))
        return hit and 20 * len(hit) >= len(w)

    docs = [d for d in docs if not contaminated(d[1])]
    words = secret_scan.ordinary_words(spark.createDataFrame(docs, "doc_id long, text string"))
    ratios = secret_scan.train(secret_scan.labelled_samples(words))

    def masked(text):
        spans = [m.span() for m in ASSIGN.finditer(text) if len(m[2]) >= 6] + [m.span() for m in re.finditer(r"AKIA[A-Z0-9]{16,}", text)] + [m.span() for m in re.finditer(r"[0-9a-f]{24,}", text)]
        base = united(spans)
        for m in re.finditer(r"[A-Za-z0-9+/_=-]{20,}", text):
            if re.search("[0-9]", m[0]) and re.search("[A-Za-z]", m[0]) and not any(a <= m.start() and m.end() <= b for a, b in base) and not re.fullmatch("[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}", m[0]):
                c = [0, 0, *(int(secret_scan.CODE[ord(x)]) for x in m[0])]
                if np.mean([ratios[c[i], c[i + 1], c[i + 2]] for i in range(len(m[0]))], dtype=np.float64) > secret_scan.RATIO:
                    spans.append(m.span())
        out, at = "", 0
        for a, b in sorted(spans):
            if a >= at:
                out += text[at:a] + "[SECRET]"
            at = max(at, b)
        return out + text[at:]

    p = sentencepiece.SentencePieceProcessor(model_file=sentencepiece_codec.model_path())
    return {d: p.encode(masked(t or ""), add_bos=True, add_eos=True) for d, t in docs}


def test_run_equals_a_plain_version(spark, sf_dir):
    want = plain(spark, sf_dir)
    out = corpus_pipeline.run(spark, sf_dir).collect()
    assert {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in out} == want
    assert all(r.restored and r.n_tokens == len(want[r.doc_id]) for r in out) and len(out) == len(want) > 50


def test_stages_keep_the_columns(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(40)
    assert len(corpus_pipeline.STAGES) == 5
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, sf_dir).columns == docs.columns, name
