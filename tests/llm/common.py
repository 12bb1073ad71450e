"""Inputs that every operator must survive: nulls, empty and long texts, ties, repeated rows, clashing extra columns."""

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return (text or "").translate({i: i + 32 for i in range(65, 91)})


def words(rng, n, vocabulary=300):
    return " ".join("w%d" % rng.randrange(vocabulary) for _ in range(n))


def complements(k):
    """A word of 2**k letters a and b, and the one with the letters exchanged: polynomials modulo 2**64 can't tell them apart from k = 10 on."""
    word = "".join("ab"[bin(i).count("1") % 2] for i in range(1 << k))
    return word, word.translate(str.maketrans("ab", "ba"))


def odd_texts(seed=1):
    rng = random.Random(seed)
    base = words(rng, 120)
    passage = words(rng, 70, 10**6)
    made = [None, None, "", "", " ", "\n", "a", "A b", "a b c d", "é漢🙂 ſ \x00 ▁x", "x" * 40_000, "ab " * 9_000, base, base, base.upper()]
    for _ in range(25):
        own = base.split()
        for _ in range(rng.randint(0, 9)):
            own[rng.randrange(len(own))] = words(rng, 1)
        made.append(" ".join(own))
    made += [f"{words(rng, rng.randint(0, 30), 10**6)} {passage} {words(rng, rng.randint(0, 30), 10**6)}" for _ in range(20)]
    return made


#: Extra columns that share their names with columns that operators make or use inside.
EXTRA = "row string, score int, n int, ids string, spans string, shard string, slot string, text_a string, n_chars bigint, part string"


def documents(spark, texts, first=0):
    rows = [(first + i, t, "en", "src", "r", 1, 2, "i", "s", "h", "l", "ta", len(t) if t is not None else None, "p") for i, t in enumerate(texts)]
    rows.append((None, "no id", None, None, *[None] * 10))
    rows.append(rows[0])  # a repeated row
    return spark.createDataFrame(rows, f"doc_id bigint, text string, lang string, source string, {EXTRA}")
