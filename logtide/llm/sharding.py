"""Sharding by a minimax contiguous partition.

Rows fall into atomic groups (equal texts), which stand in the order of their 64-bit hash. Cutting that order into ``n``
runs so that the largest run is as small as possible: binary-search the smallest capacity for which a greedy fill needs no
more than ``n`` runs, then cut there.

The driver never holds the groups. It holds the total sizes of key ranges, at first 512 equal ones, and answers the
greedy check with a lower and an upper bound of where each cut lies. Only if the bounds leave a capacity undecided are the
ranges that its cuts fall into split again by one small aggregation, so that what is sent to the driver does not grow with
the number of groups.

Null texts count as empty ones: size 1, CRC 0, one group. Repeated rows are rows of their own. Fewer groups than shards
leave the last shards empty. Slots follow doc_id within hash buckets of a shard.
"""

from __future__ import annotations

import bisect

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from logtide.scratch import Scratch

SHARDS = 16
BITS = 9
CHILDREN = 1 << BITS
#: Key ranges that are split by one aggregation at most.
SPLITS = 128
LOW, HIGH = -(1 << 63), (1 << 63) - 1


class Ranges:
    """Sizes of consecutive key ranges, finer where it matters. groups: (key, size)."""

    def __init__(self, groups: DataFrame):
        self.groups = groups
        #: (lowest key, highest key, size, whether it is one group), in order, none empty.
        self.cells: list[tuple[int, int, int, bool]] = []
        top = groups.agg(F.sum("size"), F.max("size")).first()
        self.total, self.largest = int(top[0] or 0), int(top[1] or 0)
        self.replace([(LOW, HIGH)])

    def replace(self, spans: list[tuple[int, int]]) -> None:
        """Split the spans (disjoint, in order) into CHILDREN parts each, by one aggregation."""
        key = F.col("key")
        if spans == [(LOW, HIGH)]:
            span, part = F.lit(0), F.shiftright("key", 64 - BITS)
        else:
            lows, highs = (F.array(*[F.lit(x[i]) for x in spans]) for i in (0, 1))
            steps = F.array(*[F.lit((high - low) // CHILDREN + 1) for low, high in spans])
            span = F.size(F.filter(lows, lambda x: x <= key))
            of = lambda values: F.get(values, span - 1)
            part = F.when(key <= of(highs), F.floor((key - of(lows)) / of(steps)))
        rows = self.groups.select("key", "size", span.alias("span"), part.cast("bigint").alias("part")).where("part is not null")
        found = rows.groupBy("span", "part").agg(F.min("key").alias("low"), F.max("key").alias("high"), F.sum("size").alias("size"))
        gone = {low for low, _ in spans}
        self.cells = sorted([c for c in self.cells if c[0] not in gone] + [(r.low, r.high, int(r.size), r.low == r.high) for r in found.collect()])  # CHILDREN rows a span at most
        self.edges = [0]
        for c in self.cells:
            self.edges.append(self.edges[-1] + c[2])

    def bounds(self, capacity: int, shards: int) -> tuple[int, int, set[int]]:
        """Where a greedy fill of ``shards`` runs ends, at least and at most, and the splittable cells that its cuts lie in."""
        low = high = 0
        vague: set[int] = set()
        for _ in range(shards):
            first = bisect.bisect_right(self.edges, low + capacity) - 1
            last = bisect.bisect_right(self.edges, high + capacity) - 1
            vague.update(i for i in range(first, min(last + 1, len(self.cells))) if not self.cells[i][3])
            low = self.edges[first]
            high = self.edges[-1] if last >= len(self.cells) else self.edges[last] if self.cells[last][3] else min(high + capacity, self.edges[last + 1])
        return low, high, vague

    def split(self, vague: set[int]) -> None:
        some = sorted(vague, key=lambda i: (-self.cells[i][2], i))[:SPLITS]
        self.replace(sorted(self.cells[i][:2] for i in some))

    def smallest(self, shards: int) -> int:
        """The smallest feasible capacity."""
        low, high = max(self.largest, -(-self.total // shards)), -(-self.total // shards) + self.largest
        while low < high:
            middle = (low + high) // 2
            least, most, vague = self.bounds(middle, shards)
            if least >= self.total:
                high = middle
            elif most < self.total:
                low = middle + 1
            else:
                self.split(vague)
        return low

    def cuts(self, shards: int) -> list[int]:
        """The highest key of each run but the last."""
        capacity, out, start = self.smallest(shards), [], 0
        while len(out) < shards - 1:
            i = bisect.bisect_right(self.edges, start + capacity) - 1
            if i < len(self.cells) and not self.cells[i][3]:
                self.split({i})
                continue
            out.append(HIGH if i == 0 else self.cells[i - 1][1])
            start = self.edges[i]
        return out


def minimax_shards(rows: DataFrame, shards: int = SHARDS, key: str = "key", size: str = "size") -> DataFrame:
    """Adds ``shard``: contiguous in the order of ``key`` (a 64-bit integer), groups whole, the largest shard as small as it can be."""
    groups = Scratch(rows.sparkSession, "shards").cut(rows.groupBy(F.col(key).alias("key")).agg(F.sum(size).alias("size")), "groups")
    cuts = Ranges(groups).cuts(shards)
    shard = F.lit(0)
    for cut in cuts:
        shard = shard + (F.col(key) > F.lit(cut)).cast("int")
    return rows.withColumn("shard", shard)


def slots(rows: DataFrame, order: list[str], buckets: int) -> DataFrame:
    """Adds ``slot``: 0, 1, ... within each shard. Rows are counted in hash buckets of the order's first column, so that no task holds a shard."""
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64(order[0]), F.lit(buckets)).cast("int"))
    counts = rows.groupBy("shard", "bucket").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("shard", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))  # shards x buckets rows
    own = Window.partitionBy("shard", "bucket").orderBy(*order)
    return rows.withColumn("rank", F.row_number().over(own) - 1).join(F.broadcast(starts), ["shard", "bucket"]).withColumn("slot", F.col("start") + F.col("rank")).drop("bucket", "rank", "start")


def op1_sharding(spark, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select(
        "doc_id",
        (F.octet_length(text) + 1).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("key"),
    )
    rows = Scratch(spark, "op1").cut(rows, "rows")
    buckets = max(8, int(spark.conf.get("spark.sql.shuffle.partitions")) // 2)
    out = slots(minimax_shards(rows), ["doc_id", "key"], buckets)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int"), F.col("slot").cast("bigint"), F.lit(None).cast("int").alias("grown_shard"))
