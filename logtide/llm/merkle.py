"""A Merkle manifest of a table: a root that stands for all rows, and for each row a proof that it belongs to them.

Rows are hashed in the JVM, sorted by ranges of (group, order) and checkpointed: an RDD whose partitions stay as they are.
One small row for each partition (its groups, and the rows of the first and the last) reaches the driver, which adds up where
each partition's first group stands: with that, every row knows its place in its group, and so its coordinates in the tree.

Each partition builds the aligned subtrees of up to ``2**CHUNK`` rows that lie in it whole. What is ragged at its ends, a few
nodes for each level, is shuffled by coordinate and meets in its chunk. The chunks' tops are built further, ``CHUNK`` levels a
round, up to each group's root; the groups' roots are the rows of one more such tree. Paths come down the same way by joins, and
are dealt to the partitions of the rows, which put each row's proof together chunk by chunk.

So neither a task nor the driver holds more than a chunk of nodes, whatever the number or the size of groups. Equal rows
are told apart by their place in the scan only, so that a hot one is dealt over many ranges; their digests, and so all
digests of the tree, don't depend on it.

A proof has, for each level from the row up, ``L`` or ``R`` and the digest of the sibling on that side, or ``.`` for a node
that stands alone. ``fold`` makes the root of a leaf and its proof, with nothing else.

Nulls are hashed as ``-``, so that they differ from empty values. A null group comes first, a null order value before others;
equal order values go by their digests. Repeated rows are leaves of their own. An empty table has no rows and no root.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from logtide.operators.batching import ranged
from logtide.scratch import Scratch

#: Levels of a subtree that one task builds at a time.
CHUNK = 14


def digest(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def height(n: int) -> int:
    """Levels above ``n`` nodes until one is left."""
    return max(n - 1, 0).bit_length()


def climb(first: int, nodes: list[str], ended: bool, top: int) -> list[tuple[int, list[str]]]:
    """(first index, digests) of each level that follows from consecutive nodes; ended: the last of them ends its level."""
    levels = [(first, nodes)]
    while len(levels) <= top:
        low, own = levels[-1]
        whole = own[low % 2 :]
        if not ended:
            whole = whole[: len(whole) // 2 * 2]
        if not whole:
            break
        levels.append(((low + 1) // 2, [digest("".join(whole[i : i + 2])) for i in range(0, len(whole), 2)]))
    return levels


def loose(levels: list[tuple[int, list[str]]]) -> Iterator[tuple[int, int, str]]:
    """(level, index, digest) of the nodes whose parents are not among the levels."""
    for n, (first, nodes) in enumerate(levels):
        low, above = levels[n + 1] if n + 1 < len(levels) else (0, [])
        yield from ((n, first + i, x) for i, x in enumerate(nodes) if not low <= (first + i) // 2 < low + len(above))


def step(nodes: dict[int, str], index: int) -> str:
    """What a proof says of a node's level."""
    sibling = nodes.get(index ^ 1)
    return "." if sibling is None else ("L" if index % 2 else "R") + sibling


def assemble(given: dict[tuple[int, int], str], top: int) -> tuple[str, dict[tuple[int, int], str]]:
    """(the node ``top`` levels up, the path to it of each given node): all nodes below it are given, or are below given ones."""
    levels: list[dict[int, str]] = [{} for _ in range(top + 1)]
    for (level, index), x in given.items():
        levels[level][index] = x
    for level in range(top):
        for index, x in list(levels[level].items()):
            if index % 2 == 0:
                levels[level + 1][index // 2] = digest(x + levels[level].get(index + 1, ""))
    (only,) = levels[top]
    paths = [{} for _ in range(top)] + [{only: ""}]
    for level in reversed(range(top)):
        paths[level] = {index: step(levels[level], index) + paths[level + 1][index // 2] for index in levels[level]}
    return levels[top][only], {at: paths[at[0]][at[1]] for at in given}


def fold(leaf: str, proof: str) -> str:
    """The root that a leaf and its proof make."""
    at, node = 0, leaf
    while at < len(proof):
        side = proof[at]
        if side == ".":
            node, at = digest(node), at + 1
            continue
        sibling = proof[at + 1 : at + 65]
        node, at = digest(sibling + node if side == "L" else node + sibling), at + 65
    return node


@F.arrow_udf(T.StringType())
def folded(leaf: pa.Array, proof: pa.Array) -> pa.Array:
    """Column function: ``fold``."""
    return pa.array([fold(x, p) for x, p in zip(leaf.to_pylist(), proof.to_pylist())], pa.string())


def row_digest(*fields) -> F.Column:
    """Lowercase hex SHA-256 of columns, each ``-`` if null, else its bytes, ``:`` and the value; integers in decimal."""
    texts = [c.cast("string") for c in fields]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]).cast("binary"), 256)


class Places:
    """Where each partition of the sorted rows stands: the number of its first group, that group's rows before, and the rows of its last group in all.

    found: what ``summarise`` says of each partition. ``totals``: rows of each group that lies at an end of some partition.
    """

    def __init__(self, found: list[tuple]):
        self.totals: dict[int, int] = {}
        begins: dict[int, tuple[int, int, int]] = {}
        group, rows, last = -1, 0, None
        for part, first_key, last_key, groups, first_n, last_n in sorted(found):
            if last is None or first_key != last:
                group, rows = group + 1, 0
            begins[part] = (group, rows, group + groups - 1)
            rows += first_n
            self.totals[group] = rows
            if groups > 1:
                group, rows = group + groups - 1, last_n
                self.totals[group] = rows
            last = last_key
        self.of = {part: (first, before, self.totals[end]) for part, (first, before, end) in begins.items()}


def summarise(part: int, rows: Iterator) -> Iterator[tuple]:
    """(partition, key of its first and last group, groups, rows of the first and the last); keys as digests of a bounded size."""
    first = last = None
    groups = first_n = n = 0
    for (key,) in rows:
        if not groups or key != last:
            if groups == 1:
                first_n = n
            if not groups:
                first = key
            groups, n, last = groups + 1, 0, key
        n += 1
    if groups:
        named = lambda k: "" if k is None else digest(k)
        yield part, named(first), named(last), groups, first_n if groups > 1 else n, n


def number(part: int, batches: Iterator[pa.RecordBatch], place: tuple[int, int, int] | None) -> Iterator[pa.RecordBatch]:
    """The rows with partition, group, index in the group, and whether they end it; ``place`` as ``Places`` has it."""
    group, offset, total = place or (0, 0, 0)
    held = of = None
    begun = False

    def done(rows: tuple, following: bool) -> pa.RecordBatch:
        batch, groups, index = rows
        ends = np.append(groups[1:] != groups[:-1], not following)
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(groups), part, np.int32)), pa.array(groups), pa.array(index), pa.array(ends), *(batch.column(c) for c in ("order", "leaf", "forged"))], names=["part", "gid", "idx", "ends", "order", "leaf", "forged"])

    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column("group")
        codes = keys.dictionary_encode(null_encoding="encode").indices.to_numpy()
        changes = np.concatenate([[0], (codes[1:] != codes[:-1]).astype(np.int64)])
        same = begun and keys[0].as_py() == of
        if begun and not same:
            group, offset = group + 1, 0
        if held is not None:
            yield done(held, same)
        groups = group + np.cumsum(changes)
        heads = np.flatnonzero(changes)
        index = np.arange(len(codes)) + offset
        if len(heads):
            start = np.zeros(len(codes), np.int64)
            start[heads] = heads
            start = np.maximum.accumulate(start)
            index = np.where(start > 0, np.arange(len(codes)) - start, index)
        held, of, begun = (batch, groups, index), keys[len(keys) - 1].as_py(), True
        group, offset = int(groups[-1]), int(index[-1]) + 1
    if held is not None:
        yield done(held, offset < total)


def chunks(rows: Iterator[tuple], bits: int) -> Iterator[tuple[int, int, int, bool, list]]:
    """(group, chunk, first index, whether the group ends here, rows) of runs in one chunk; rows begin with group, index and end."""
    own: list = []
    for row in rows:
        if own and (row[0] != own[0][0] or row[1] >> bits != own[0][1] >> bits):
            yield own[0][0], own[0][1] >> bits, own[0][1], own[-1][2], own
            own = []
        own.append(row)
    if own:
        yield own[0][0], own[0][1] >> bits, own[0][1], own[-1][2], own


def top_of(chunk: int, first: int, count: int, ended: bool, bits: int) -> int:
    """How many levels a chunk has; only of a group's single chunk less than ``bits``."""
    return height(first + count) if chunk == 0 and ended else bits


NODES = "part int, gid bigint, chunk bigint, level int, idx bigint, top int, digest string, whole boolean"


def built(rows: Iterator, bits: int, totals: dict[int, int]) -> Iterator[tuple]:
    """Tops of whole chunks, and the loose nodes of ragged ones. totals: rows of groups that go on in other partitions."""
    part = None

    def plain():
        nonlocal part
        for r in rows:
            part = r[0]
            yield r[1:]

    for gid, chunk, first, ended, own in chunks(plain(), bits):
        top = top_of(chunk, first, len(own), ended, bits)
        if gid in totals and chunk == 0 and totals[gid] <= 1 << bits:
            top = height(totals[gid])
        levels = climb(first, [r[3] for r in own], ended, top)
        whole = len(levels) == top + 1 and len(levels[-1][1]) == 1 and (first & ((1 << bits) - 1)) == 0 and (ended or len(own) == 1 << bits)
        for level, index, x in [(top, levels[-1][0], levels[-1][1][0])] if whole else loose(levels):
            yield part, gid, chunk, level, index, top, x, whole


MADE = "gid bigint, chunk bigint, level int, idx bigint, part int, path string, digest string"


def meet(table: pa.Table) -> pa.Table:
    """One chunk or block: its top (level -1, its number as idx), and the paths of its nodes to it."""
    rows = table.to_pylist()
    gid, chunk = rows[0]["gid"], rows[0]["chunk"]
    top, paths = assemble({(r["level"], r["idx"]): r["digest"] for r in rows}, rows[0]["top"])
    out = [{"gid": gid, "chunk": chunk, "level": -1, "idx": chunk, "part": None, "path": None, "digest": top}]
    out += [{"gid": gid, "chunk": chunk, "level": r["level"], "idx": r["idx"], "part": r["part"], "path": paths[r["level"], r["idx"]], "digest": None} for r in rows]
    return pa.Table.from_pylist(out, pa.schema([("gid", pa.int64()), ("chunk", pa.int64()), ("level", pa.int32()), ("idx", pa.int64()), ("part", pa.int32()), ("path", pa.string()), ("digest", pa.string())]))


def upwards(nodes: DataFrame, scratch: Scratch, label: str, bits: int) -> tuple[DataFrame, DataFrame]:
    """(gid, digest) of each group's root and (gid, idx, path) from its nodes (gid, idx, digest), ``bits`` levels a round."""
    roots, rounds = [], []
    while True:
        n = len(rounds)
        sizes = nodes.groupBy("gid").agg(F.max("idx").alias("last"))
        sized = nodes.join(sizes, "gid")
        roots.append(sized.where("last = 0").select("gid", "digest"))
        rest = sized.where("last > 0")
        if not nodes.where("idx > 0").limit(1).count():
            break
        # a group of more than one block is built to the block's full height, another one to its own
        levels = F.when(F.shiftright("last", bits) > 0, F.lit(bits)).otherwise(F.length(F.bin("last")))
        asked = rest.select("gid", F.shiftright("idx", bits).alias("chunk"), F.lit(0).alias("level"), "idx", F.lit(None).cast("int").alias("part"), levels.cast("int").alias("top"), "digest")
        made = scratch.cut(asked.groupBy("gid", "chunk").applyInArrow(meet, MADE), f"{label}-{n}")
        rounds.append(made.where("level = 0").select("gid", "chunk", "idx", "path"))
        nodes = made.where("level = -1").select("gid", "idx", "digest")
    found = roots[0]
    for more in roots[1:]:
        found = found.unionByName(more)
    # from the top down: a node's path is the one within its block and that of its block's top
    paths = None
    for own in reversed(rounds):
        if paths is not None:
            above = paths.select("gid", F.col("idx").alias("chunk"), F.col("path").alias("above"))
            own = own.join(above, ["gid", "chunk"], "left").withColumn("path", F.concat("path", F.coalesce("above", F.lit(""))))
        paths = own.select("gid", "idx", "path")
    return found, paths


def proofs(leaves: DataFrame, bits: int = CHUNK) -> tuple[DataFrame, str | None]:
    """``order``, ``leaf``, ``forged``, ``subroot`` (of the group) and ``proof`` of each leaf, and the root of all (None without any).

    leaves: (group string, order, leaf, forged): the digests as hex; ``forged`` is carried along.
    """
    spark = leaves.sparkSession
    scratch = Scratch(spark, "merkle")
    salted = scratch.cut(leaves.select("group", "order", "leaf", "forged", F.monotonically_increasing_id().alias("salt")), "leaves")
    base = ranged(salted, ["group", "order", "leaf", "salt"])
    found = [tuple(r) for r in base.select("group").rdd.mapPartitionsWithIndex(summarise).collect()]  # one for each partition
    if not found:
        return spark.createDataFrame([], T.StructType([leaves.schema["order"], *T.StructType.fromDDL("leaf string, forged string, subroot string, proof string").fields])), None
    places = Places(found)
    shared = spark.sparkContext.broadcast(places.of)  # one for each partition
    open_groups = spark.sparkContext.broadcast(places.totals)
    schema = T.StructType([*T.StructType.fromDDL("part int, gid bigint, idx bigint, ends boolean").fields, leaves.schema["order"], *T.StructType.fromDDL("leaf string, forged string").fields])

    def numbered(batches):
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        return number(part, batches, shared.value.get(part))

    rows = base.select("group", "order", "leaf", "forged").mapInArrow(numbered, schema)
    nodes = rows.select("part", "gid", "idx", "ends", "leaf").rdd.mapPartitions(lambda it: built(it, bits, open_groups.value))
    nodes = scratch.cut(spark.createDataFrame(nodes, NODES), "nodes")
    whole = nodes.where("whole")
    ragged = scratch.cut(nodes.where("not whole").drop("whole").groupBy("gid", "chunk").applyInArrow(meet, MADE), "ragged")
    tops = whole.select("gid", F.col("chunk").alias("idx"), "digest").unionByName(ragged.where("level = -1").select("gid", "idx", "digest"))
    subroots, in_group = upwards(tops, scratch, "group", bits)
    subroots = scratch.cut(subroots, "subroots")
    # written, so that the planner doesn't see a constant key and compare all rows with all
    one = scratch.cut(subroots.select(F.lit(0).cast("bigint").alias("gid"), F.col("gid").alias("idx"), "digest"), "one")
    root, in_all = upwards(one, scratch, "all", bits)
    top = root.first()["digest"]

    above = subroots.select("gid", F.col("digest").alias("subroot"), F.lit("").alias("over"))
    if in_all is not None:
        above = above.drop("over").join(in_all.select(F.col("idx").alias("gid"), F.col("path").alias("over")), "gid")
    anchors = whole.select("part", "gid", "chunk", "level", "idx", F.lit("").alias("path")).unionByName(ragged.where("level >= 0").select("part", "gid", "chunk", "level", "idx", "path"))
    if in_group is not None:
        anchors = anchors.join(in_group.select("gid", F.col("idx").alias("chunk"), F.col("path").alias("further")), ["gid", "chunk"], "left")
        anchors = anchors.withColumn("path", F.concat("path", F.coalesce("further", F.lit("")))).drop("further")
    anchors = anchors.join(above, "gid").select("part", "gid", "chunk", "level", "idx", F.concat("path", "over").alias("path"), "subroot")

    # leaves and their anchors meet in as many partitions as the leaves had, chunk by chunk: anchors first
    parts = base.rdd.getNumPartitions()
    null = lambda kind: F.lit(None).cast(kind)
    both = rows.select("part", "gid", F.shiftright("idx", bits).alias("chunk"), null("int").alias("level"), "idx", "ends", "order", "leaf", "forged", null("string").alias("path"), null("string").alias("subroot"))
    both = both.unionByName(anchors.select("part", "gid", "chunk", "level", "idx", null("boolean").alias("ends"), null(leaves.schema["order"].dataType).alias("order"), null("string").alias("leaf"), null("string").alias("forged"), "path", "subroot"))
    dealt = both.repartitionById(parts, F.col("part")).sortWithinPartitions("gid", "chunk", F.col("level").isNull(), "idx")
    out = T.StructType([leaves.schema["order"], *T.StructType.fromDDL("leaf string, forged string, subroot string, proof string").fields])
    kinds = [to_arrow_type(f.dataType) for f in out]

    def run(batches):
        def lines():
            for batch in batches:
                yield from zip(*(batch.column(c).to_pylist() for c in ("gid", "idx", "ends", "level", "path", "subroot", "leaf", "forged", "order")))

        held: list[tuple] = []
        for gid, chunk, _, _, own in chunks(lines_by_chunk(lines(), bits), bits):
            known = {(r[3], r[4]): (r[5], r[6]) for r in own if r[3] is not None}
            mine = [r for r in own if r[3] is None]
            first, ended = mine[0][1], mine[-1][2]
            top = min(top_of(chunk, first, len(mine), ended, bits), bits)
            levels = climb(first, [r[7] for r in mine], ended, top)
            paths: dict[int, tuple[str, str]] = {}
            for n in reversed(range(len(levels))):
                low, nodes = levels[n]
                at = {low + i: x for i, x in enumerate(nodes)}
                own_paths = {}
                for index in at:
                    over = paths.get(index // 2)
                    own_paths[index] = known[n, index] if over is None else (step(at, index) + over[0], over[1])
                paths = own_paths
            for i, r in enumerate(mine):
                proof, subroot = paths[first + i]
                held.append((r[9], r[7], r[8], subroot, proof))
                if len(held) >= 1000:
                    yield batch_of(held)
                    held = []
        if held:
            yield batch_of(held)

    def batch_of(held):
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), kinds)], names=out.fieldNames())

    return dealt.mapInArrow(run, out), top


def lines_by_chunk(lines: Iterator[tuple], bits: int) -> Iterator[tuple]:
    """Rows as ``chunks`` takes them: an anchor counts as a row of the chunk that follows it."""
    waiting: list[tuple] = []
    for gid, idx, ends, level, path, subroot, leaf, forged, order in lines:
        if level is not None:
            waiting.append((level, idx, path, subroot))
            continue
        for level_, idx_, path_, subroot_ in waiting:
            yield gid, idx, False, level_, idx_, path_, subroot_, None, None, None
        waiting = []
        yield gid, idx, ends, None, None, None, None, leaf, forged, order


def manifest(docs: DataFrame, bits: int = CHUNK) -> DataFrame:
    """doc_id, leaf, forged (the leaf of the row as tampering leaves it), subroot, proof, root.

    Tampering adds 1 to ``n_chars`` where 7 divides the CRC-32 of doc_id in decimal; a null doc_id or n_chars is left alone.
    """
    c = F.col
    rest = [c("source"), c("lang")]
    more = (c("n_chars").cast("decimal(20,0)") + 1).cast("string")
    tampered = F.crc32(c("doc_id").cast("string").cast("binary")) % 7 == 0
    leaf = row_digest(c("doc_id"), *rest, c("n_chars"), c("text"))
    forged = F.when(tampered & c("n_chars").isNotNull(), row_digest(c("doc_id"), *rest, more, c("text")))
    found, root = proofs(docs.select(c("lang").alias("group"), c("doc_id").alias("order"), leaf.alias("leaf"), forged.alias("forged")), bits)
    return found.select(c("order").alias("doc_id"), "leaf", "forged", "subroot", "proof", F.lit(root).cast("string").alias("root"))


def op11_merkle_manifest(spark, sf_dir: str) -> DataFrame:
    made = manifest(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    siblings = F.sha2(F.translate("proof", "LR.", "").cast("binary"), 256)
    made = made.withColumn("folded_root", folded(F.coalesce("forged", "leaf"), F.col("proof")))
    return made.select("doc_id", "leaf", "subroot", "root", siblings.alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))
