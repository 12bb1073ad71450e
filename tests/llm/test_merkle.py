"""The Merkle manifest against a plain one."""

import hashlib
import random
import zlib

import pytest

from logtide.llm import merkle

from .common import documents, odd_texts


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(*values):
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(nodes):
    """(root, siblings of each leaf), level by level."""
    paths, of = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, k in enumerate(of):
            paths[i].append((k % 2, nodes[k ^ 1]) if k ^ 1 < len(nodes) else None)
        nodes, of = [h(*nodes[i : i + 2]) for i in range(0, len(nodes), 2)], [k // 2 for k in of]
    return nodes[0], paths


def folded(node, path):
    for x in path:
        node = h(node) if x is None else h(x[1], node) if x[0] else h(node, x[1])
    return node


def plain(rows):
    """Rows (doc_id, source, lang, n_chars, text) to the query's rows."""
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append((r, leaf_of(*r)))
    keys = sorted(groups, key=lambda k: (k is not None, (k or "").encode()))
    made = {}
    for k in keys:
        groups[k].sort(key=lambda x: (x[0][0] is not None, x[0][0] or 0, x[1]))
        made[k] = tree([x[1] for x in groups[k]])
    root, over = tree([made[k][0] for k in keys])
    out = []
    for k, above in zip(keys, over):
        for (r, leaf), path in zip(groups[k], made[k][1]):
            path = path + above
            forged = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0 and r[3] is not None
            again = folded(leaf_of(*r[:3], r[3] + 1, r[4]) if forged else leaf, path)
            out.append((r[0], leaf, made[k][0], root, h(*(x[1] for x in path if x)), again, again == root))
    return out


def order(rows):
    return sorted(map(tuple, rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))


def query(spark, docs, path):
    docs.write.parquet(str(path / "documents.parquet"))
    return merkle.op11_merkle_manifest(spark, str(path))


@pytest.mark.parametrize("bits, sizes", [(14, [1]), (14, [5, 1, 2]), (2, [1, 4, 5, 3, 17]), (2, [70, 64, 65, 63]), (1, [33, 1, 1, 1, 1, 1, 1]), (3, [1] * 40), (3, [300, 7, 8, 9]), (14, [200, 30])])
def test_proofs_against_plain_trees(spark, bits, sizes):
    rng = random.Random(sum(sizes))
    rows = [(f"g{g:02d}" if g else None, rng.randrange(50), h(str(rng.random())), None) for g, n in enumerate(sizes) for _ in range(n)]
    rng.shuffle(rows)
    found, root = merkle.proofs(spark.createDataFrame(rows, "group string, order long, leaf string, forged string"), bits)
    groups = {}
    for g, o, leaf, _ in rows:
        groups.setdefault(g, []).append((o, leaf))
    keys = sorted(groups, key=lambda k: k or "")
    made = {k: tree([x[1] for x in sorted(groups[k])]) for k in keys}
    whole, over = tree([made[k][0] for k in keys])
    assert root == whole
    want = {}
    for k, above in zip(keys, over):
        for (_, leaf), path in zip(sorted(groups[k]), made[k][1]):
            want[leaf] = (made[k][0], "".join("." if x is None else "RL"[x[0]] + x[1] for x in path + above))
    got = found.collect()
    assert len(got) == len(rows) and {r.leaf: (r.subroot, r.proof) for r in got} == want
    assert all(merkle.fold(r.leaf, r.proof) == root for r in got)


def test_op11(spark, tmp_path):
    docs = documents(spark, odd_texts())
    got = query(spark, docs, tmp_path).collect()
    rows = [(r.doc_id, r.source, r.lang, r.n_chars, r.text) for r in docs.collect()]
    assert order(got) == order(plain(rows))
    assert {r.verified for r in got} == {True, False}


def test_a_hot_row_and_many_groups(spark, tmp_path):
    rows = [(7, "s", "en", 3, "abc")] * 400 + [(i, None, f"l{i}" if i % 3 else None, i if i % 4 else None, "") for i in range(300)] + [(2**63 - 1, "s", "", 2**63 - 1, None)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(5)
    assert order(query(spark, docs, tmp_path).collect()) == order(plain(rows))


def test_tampering_with_anything_shows(spark):
    docs = documents(spark, odd_texts()[:20])
    r = merkle.manifest(docs).where("doc_id = 3").first()
    assert merkle.fold(r.leaf, r.proof) == r.root
    for other in (r.leaf[::-1], r.subroot):
        assert merkle.fold(other, r.proof) != r.root
    assert merkle.fold(r.leaf, r.proof.replace("L", "R", 1) if "L" in r.proof else r.proof.replace("R", "L", 1)) != r.root
