"""Bounded samples and lists of what is most frequent, without sending more than them to one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def bounded(df: DataFrame, rows: int, *key: str | Column) -> DataFrame:
    """At most ``rows`` rows, those with the smallest hashes of ``key``; rows of one key in the order of the key.

    Most rows of a large table are dropped by their hash before any are sorted: what is sorted is about twice the sample.
    """
    key = tuple(F.col(k) if isinstance(k, str) else k for k in key)
    n = df.count()
    hashed = F.xxhash64(*key)
    if n > 4 * rows:
        df = df.where(F.pmod(hashed, F.lit(1 << 40)) < int((1 << 40) * 2 * rows / n))
    return df.orderBy(F.pmod(hashed, F.lit(1 << 40)), *key).limit(rows)


def most_frequent(counted: DataFrame, count: str, rows: int) -> DataFrame:
    """The rows with the largest counts, at most ``rows``: all down to some count, by eighths of powers of two."""
    step = F.floor(F.log2(F.col(count).cast("double")) * 8)
    left, least = rows, None
    for r in counted.groupBy(step.alias("step")).count().orderBy(F.desc("step")).collect():  # some hundred rows
        left -= r["count"]
        if left < 0:
            break
        least = r.step
    return counted.where(step >= least) if least is not None else counted.where(F.lit(False))
