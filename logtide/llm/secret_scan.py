"""Secret scans: fixed patterns, and character Markov models for strings that no pattern describes.

Two Markov models of second order (a character given the two before it) are trained on labelled samples, one on random
strings and one on ordinary identifiers. These are made of words: frequent words of about ``SAMPLE_DOCS`` documents of the
corpus itself, so that its languages and jargon count as ordinary, and some common ones; and of things that look random and are
none: UUIDs, article numbers, alphabets. A candidate is a run of 20 or more of ``A-Za-z0-9+/_=-``. In it, the part of 20 or
more characters whose log-likelihood ratio, less ``DRIFT`` for each character, is largest is a secret if that exceeds ``LEVEL``;
what is left on either side is looked at again. So a key is found behind any path, and whatever its characters are. The part
is widened to the separators around it, and adds a span of kind ``markov``, unless spans of patterns cover the whole of it.

Null texts are empty. Every text is scanned whole, in linear time; spans are code points, end exclusive.
"""

from __future__ import annotations

import random
import re
import string

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logtide.llm.blocks import continuation_counts, map_texts, ranges, word_spans
from logtide.llm.decontamination import unions
from logtide.llm.samples import bounded

# The patterns of the result's contract, on UTF-8 bytes.
ASSIGN = re.compile(rb"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
WORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
KINDS = ("assign", "access", "hex", "markov")
ALPHABET = string.ascii_letters + string.digits + "+/_=-"
DRIFT, LEVEL = 0.35, 9.0
LEAST = 20
#: Documents whose words are learned from, and how many of their most frequent words.
SAMPLE_DOCS, SAMPLE_WORDS = 2_000, 10_000
#: Words that count as ordinary whatever the corpus holds.
COMMON = """
get set user name list item index value count total page time date file path data key map node tree parse read write open close start stop first last next state
config option default class function return import export table column row query result number string object length size offset buffer stream message event handler
request response server client version build test error warning info debug public private static final http www com net content style title header image download
bericht datei einstellung benutzer verwaltung speicher konto rechnung kunde auftrag sprache schluessel zwischen ergebnis zeichen uebersicht anmeldung geschaeft verbindung
utilisateur fichier dossier recherche compte commande produit adresse langue traduction resultat connexion paiement livraison nouveau
usuario archivo carpeta busqueda cuenta pedido producto direccion idioma traduccion resultado conexion pago entrega nuevo
""".split()


def table(characters: str) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(characters.encode())] = True
    return out


HEX, TOKEN = table("0123456789abcdef"), table(ALPHABET)
#: Between the parts of a path or assignment.
SEPARATOR = table("/=")
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Symbols of the models: the alphabet, and 0 for anything else or the beginning.
CODE = np.zeros(256, np.int64)
CODE[list(ALPHABET.encode())] = np.arange(1, len(ALPHABET) + 1)
N = len(ALPHABET) + 1


def ordinary_words(docs: DataFrame, documents: int = SAMPLE_DOCS, words: int = SAMPLE_WORDS) -> list[tuple[str, int]]:
    """Frequent words (letters only, between blanks or punctuation) of a sample of the documents, with their counts."""
    texts = bounded(docs.select("doc_id", "text").where("text is not null"), documents, "doc_id", "text").select("text")
    found = F.regexp_extract_all("text", F.lit(r"""(?<![^\s"'(])([A-Za-z]{3,24})(?![^\s.,;:!?"')])"""), 1)
    counts = texts.select(F.explode(found).alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    return [(r.word, r.n) for r in counts.orderBy(F.desc("n"), "word").limit(words).collect()]  # at most ``words``


def labelled_samples(words: list[tuple[str, int]] | None = None, seed: int = 7, count: int = 6000) -> list[tuple[str, int]]:
    """Labelled strings: 1 for random ones over common alphabets, 0 for identifiers made of ordinary words.

    words: (word, count); half of the identifiers are made of them, by their counts, the rest of common words.
    """
    rng = random.Random(seed)
    known, weights = [w for w, _ in words or []], [n for _, n in words or []]
    alphabets = (ALPHABET[:62], ALPHABET[:64], string.ascii_lowercase + string.digits, string.ascii_uppercase + string.digits, "0123456789abcdef", ALPHABET[:62] + "_-", string.ascii_letters, string.ascii_lowercase, string.ascii_uppercase)
    pick = lambda characters, k: "".join(rng.choices(characters, k=k))
    ordered = string.ascii_lowercase + string.digits
    looks = (
        lambda: "-".join(pick("0123456789abcdef", k) for k in (8, 4, 4, 4, 12)),
        lambda: "-".join(pick(rng.choice((string.digits, string.digits, string.ascii_uppercase)), rng.randint(2, 9)) for _ in range(rng.randint(3, 5))),
        lambda: rng.choice(("", "sha256-", "charset=")) + rng.choice((ordered, ordered.upper(), string.ascii_uppercase + ordered, string.digits * 3)),
    )
    tails = (lambda: str(rng.randint(0, 9999)), lambda: f"v{rng.randint(1, 20)}", lambda: f"{rng.randint(1990, 2040)}-{rng.randint(1, 12):02d}-{rng.randint(1, 28):02d}", lambda: f"{rng.randint(1, 99):02d}")
    out = []
    for i in range(count):
        out.append(("".join(rng.choices(alphabets[i % len(alphabets)], k=rng.randint(20, 48))), 1))
        n = rng.randint(2, 6)
        parts = rng.choices(known, weights, k=n) if known and i % 2 else rng.choices(COMMON, k=n)
        if rng.random() < 0.4:
            parts.insert(rng.randint(1, n), rng.choice(tails)())
        style = i // 2 % 6
        joined = ("_".join(parts), "-".join(parts), "".join(p.capitalize() for p in parts), "/".join(parts), "_".join(parts).upper(), "".join(parts))[style]
        out.append((looks[i % 3]() if i % 16 == 5 else joined, 0))
    return out


def train(samples: list[tuple[str, int]], smoothing: float = 0.5) -> np.ndarray:
    """Log-likelihood ratio (random over ordinary) of a character given the two before it."""
    logs = []
    for label in (1, 0):
        single, double = np.full((N, N), smoothing), np.zeros((N, N, N))
        for text, y in samples:
            if y == label:
                code = np.concatenate([[0, 0], CODE[np.frombuffer(text.encode(), np.uint8)]])
                np.add.at(single, (code[1:-1], code[2:]), 1)
                np.add.at(double, (code[:-2], code[1:-1], code[2:]), 1)
        back = single / single.sum(-1, keepdims=True)
        weight = 4.0  # of the shorter context, so that unseen pairs fall back on it
        logs.append(np.log((double + weight * back) / (double.sum(-1, keepdims=True) + weight)))
    return (logs[0] - logs[1]).astype(np.float32)


def contains(lower: bytes, word: bytes, offsets: np.ndarray, into: set[int]) -> None:
    """Add the texts that may hold the word."""
    at = lower.find(word)
    while at >= 0:
        text = int(np.searchsorted(offsets, at, side="right")) - 1
        into.add(text)
        at = lower.find(word, int(offsets[text + 1]))


def random_parts(data: np.ndarray, start: np.ndarray, end: np.ndarray, model: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The parts of runs that the models find random, in order: of each run the best one, then the best ones beside it, and so on.

    A part's worth is a difference of running sums, so that the best one ends where the sum is furthest above its least value
    LEAST or more characters before.
    """
    found: list[tuple[np.ndarray, np.ndarray]] = []
    while True:
        keep = end - start >= LEAST
        start, end = start[keep], end[keep]
        if not len(start):
            break
        lengths = end - start
        heads = np.cumsum(lengths) - lengths
        code = CODE[data[ranges(start, lengths)]]
        one, two = np.roll(code, 1), np.roll(code, 2)
        one[heads] = two[heads] = two[heads + 1] = 0
        worth = model[two, one, code].astype(np.float64) - DRIFT
        total = np.cumsum(worth)
        # running sums before each character, and after the last one, of each run by itself
        places = ranges(heads, lengths + 1)
        run = np.repeat(np.arange(len(start)), lengths + 1)
        sums = np.concatenate([[0.0], total])[places] - np.concatenate([[0.0], total])[heads][run]
        first = np.cumsum(lengths + 1) - (lengths + 1)
        # least sum so far: each run is put below all before it, so that theirs don't count
        depth = run * (2 * float(np.abs(sums).max()) + 1)
        least = np.minimum.accumulate(sums - depth)
        at = np.arange(len(sums))
        far = at - first[run] >= LEAST
        value = np.where(far, sums - (least[np.maximum(at - LEAST, 0)] + depth), -np.inf)
        best = np.maximum.reduceat(value, first)
        chosen = np.flatnonzero(best > LEVEL)
        if not len(chosen):
            break
        # the first end of that value, and the last beginning that gives it
        is_best = np.flatnonzero(value == best[run])
        stop = is_best[np.searchsorted(is_best, first[chosen])]
        low = least[stop - LEAST]
        begins = np.flatnonzero(sums - depth == least)  # where a new least value is reached
        begin = begins[np.searchsorted(begins, stop - LEAST, side="right") - 1]
        assert np.array_equal((sums - depth)[begin], low)
        a, b = start[chosen] + begin - first[chosen], start[chosen] + stop - first[chosen]
        # whole parts between separators
        inside = start[chosen], end[chosen]
        cuts = np.flatnonzero(SEPARATOR[data])
        before = np.searchsorted(cuts, a, side="left") - 1
        after = np.searchsorted(cuts, b, side="left")
        held_a = np.where(before >= 0, cuts[np.maximum(before, 0)] + 1, 0) if len(cuts) else np.zeros(len(a), np.int64)
        held_b = np.where(after < len(cuts), cuts[np.minimum(after, len(cuts) - 1)], len(data)) if len(cuts) else np.full(len(b), len(data))
        wide_a, wide_b = np.maximum(inside[0], held_a), np.minimum(inside[1], held_b)
        found.append((wide_a, wide_b))
        start, end = np.concatenate([inside[0], wide_b]), np.concatenate([wide_a, inside[1]])
        order = np.argsort(start, kind="stable")
        start, end = start[order], end[order]
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    start, end = (np.concatenate(x) for x in zip(*found))
    order = np.argsort(start, kind="stable")
    return start[order], end[order]


def find(data: np.ndarray, offsets: np.ndarray, model: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, kind, first byte, byte after the last) of all spans of a block, by text, start and kind."""
    raw, lower = data.tobytes(), LOWER[data].tobytes()
    found: list[tuple[int, int, int, int]] = []
    for kind, (pattern, words) in enumerate(((ASSIGN, WORDS), (ACCESS, (b"akia",)))):
        texts: set[int] = set()
        for word in words:
            contains(lower, word, offsets, texts)
        for t in texts:
            a = int(offsets[t])
            for m in pattern.finditer(raw[a : int(offsets[t + 1])]):
                if (m.end(2) - m.start(2) >= 6) if kind == 0 else (m.end() - m.start() >= 20):
                    found.append((t, kind, a + m.start(), a + m.end()))
    start, end, _ = word_spans(data, offsets, HEX)
    keep = end - start >= 24
    start, end = start[keep], end[keep]
    found += zip((np.searchsorted(offsets, start, side="right") - 1).tolist(), [2] * len(start), start.tolist(), end.tolist())
    base = np.array(found, np.int64).reshape(-1, 4)

    start, end, _ = word_spans(data, offsets, TOKEN)
    start, end = random_parts(data, start, end, model)
    if len(start):
        _, low, high = unions(np.zeros(len(base), np.int64), base[:, 2], base[:, 3])
        if len(low):  # spans of patterns that cover a part whole report all of it
            over = np.maximum(np.searchsorted(low, start, side="right") - 1, 0)
            keep = ~((low[over] <= start) & (high[over] >= end))
            start, end = start[keep], end[keep]
        own = np.searchsorted(offsets, start, side="right") - 1
        base = np.concatenate([base, np.column_stack([own, np.full(len(start), 3), start, end])])
    return tuple(base[np.lexsort((base[:, 1], base[:, 2], base[:, 0]))].T)


def scan(docs: DataFrame, samples: list[tuple[str, int]] | None = None, carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``row`` (the carried columns) and ``spans``, an array of (kind, start, end), for each document.

    samples: labelled strings to train on; by default those made of the documents' own words.
    """
    shared = docs.sparkSession.sparkContext.broadcast(train(samples or labelled_samples(ordinary_words(docs))))  # N x N x N ratios

    def make():
        kinds = np.array(KINDS, object)

        def work(data, offsets):
            text, kind, start, end = find(data, offsets, shared.value)
            skipped = continuation_counts(data)
            origin = offsets[text] - skipped[offsets[text]]
            cells = [pa.array(kinds[kind], pa.string()), pa.array(start - skipped[start] - origin), pa.array(end - skipped[end] - origin)]
            values = pa.StructArray.from_arrays(cells, ["kind", "start", "end"])
            return [pa.ListArray.from_arrays(pa.array(np.searchsorted(text, np.arange(len(offsets))).astype(np.int32)), values)]

        return work

    return map_texts(docs, make, "spans array<struct<kind: string, start: bigint, end: bigint>>", carry)


def joined(spans):
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def op8_secrets(spark, sf_dir: str) -> DataFrame:
    found = scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    of = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
    base = F.filter("spans", lambda s: s["kind"] != "markov")
    return found.select("row.doc_id", of("assign"), of("access"), of("hex"), F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


def redact(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """The documents with every span's text replaced by ``mark`` (overlapping spans by one); ``n_chars`` follows, if there is one.

    Texts without spans stay as they are, nulls included.
    """
    columns = tuple(docs.columns)
    found = scan(docs, carry=columns)
    # pieces of text between the united spans: fold over (text so far, end of the last span)
    folded = F.aggregate(
        "spans",
        F.struct(F.lit("").alias("out"), F.lit(0).cast("bigint").alias("at")),
        lambda acc, s: F.when(s["start"] < acc["at"], F.struct(acc["out"].alias("out"), F.greatest(acc["at"], s["end"]).alias("at"))).otherwise(
            F.struct(F.concat(acc["out"], F.substring(F.col("row.text"), acc["at"].cast("int") + 1, (s["start"] - acc["at"]).cast("int")), F.lit(mark)).alias("out"), s["end"].alias("at"))
        ),
    )
    rest = F.substring(F.col("row.text"), folded["at"].cast("int") + 1, F.length(F.col("row.text")))
    text = F.when(F.size("spans") == 0, F.col("row.text")).otherwise(F.concat(folded["out"], rest))
    out = found.select("row", text.alias("redacted"), (F.size("spans") > 0).alias("changed"))
    made = {"text": F.col("redacted"), "n_chars": F.when(F.col("changed"), F.length("redacted").cast("bigint")).otherwise(F.col("row.n_chars")) if "n_chars" in columns else None}
    return out.select(*[made.get(c, F.col(f"row.`{c}`")).alias(c) for c in columns])
