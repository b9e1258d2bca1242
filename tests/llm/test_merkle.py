import random
from hashlib import sha256
from zlib import crc32

import pytest
from pyspark.sql import functions as F

from fieldbook.llm import merkle, queries
from fieldbook.llm.common import SCHEMAS


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def tree(nodes, fanout):
    """The root, and for each node its siblings by level as (before, after)."""
    proofs, owners = [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        up, up_owners = [], []
        for at in range(0, len(nodes), fanout):
            run = nodes[at : at + fanout]
            for k in range(len(run)):
                for i in owners[at + k]:
                    proofs[i].append(("".join(run[:k]), "".join(run[k + 1 :])))
            up.append(h(*run))
            up_owners.append([i for k in range(len(run)) for i in owners[at + k]])
        nodes, owners = up, up_owners
    return nodes[0], proofs


def brute(rows, fanout=3):
    """(doc_id, leaf, subroot, root, proof) of rows (doc_id, source, lang, n_chars, text)."""
    if not rows:
        return []
    sources = sorted({r[1] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    groups = [sorted([r for r in rows if r[1] == s], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r))) for s in sources]
    trees = [tree([leaf(r) for r in g], fanout) for g in groups]
    root, above = tree([t[0] for t in trees], fanout)
    return sorted(
        ((r[0], leaf(r), t[0], root, tuple(p + a)) for g, t, a in zip(groups, trees, above, strict=True) for r, p in zip(g, t[1], strict=True)), key=repr
    )


def made(frame, fanout=3):
    rows = merkle.manifest(frame, fanout=fanout).collect()
    return sorted(((r.doc_id, r.leaf, r.subroot, r.root, tuple((p.before, p.after) for p in r.proof)) for r in rows), key=repr)


ODD = [
    (1, "a", "en", 3, "x"), (2, "a", None, None, None), (2, "a", None, None, ""), (3, None, "de", 1, "line\nline"), (3, None, "de", 1, "line\nline"),
    (None, "a", "en", 3, "x"), (None, None, None, None, None), (4, "", "", 0, ""), (5, "é", "en", 9, "日本 😀"), (6, "z" * 50, "en", 1, "w " * 40_000),
    (7, "\x7f", "x", 1, "-"), (-8, "a", "en", 3, "1:x"),
]


def frame_of(spark, rows):
    """Columns named like the operator's own, one of each."""
    schema = SCHEMAS["documents"] + ", leaf string, root string, _hash long, _place string, proof int, _row double"
    return spark.createDataFrame([(r[0], r[4], r[2], r[1], r[3], "l", "r", 1, "p", 2, 0.5) for r in rows], schema)


@pytest.mark.parametrize("fanout", [2, 3, 5])
def test_odd_rows_against_a_tree_in_memory(spark, fanout):
    assert made(frame_of(spark, ODD), fanout) == brute(ODD, fanout)


@pytest.mark.parametrize("n", [0, 1, 2, 3, 4, 9, 10, 28])
def test_sizes_around_the_powers_of_the_fanout(spark, n):
    rows = [(i, "only", "en", 1, str(i)) for i in range(n)]
    assert made(frame_of(spark, rows)) == brute(rows)
    apart = [(i, f"s{i}", "en", 1, str(i)) for i in range(n)]
    assert made(frame_of(spark, apart)) == brute(apart)


def test_a_hot_source_over_many_partitions(spark):
    pick = random.Random(2)
    rows = [(pick.randrange(5_000), "hot" if i % 3 else f"s{pick.randrange(40)}", "en", i, f"text {i % 50}") for i in range(1_500)] + [(9, "hot", "en", 1, "copy")] * 400
    assert made(frame_of(spark, rows).repartition(9)) == brute(rows)


def test_proofs_hold_and_tell_changes(spark):
    docs = frame_of(spark, ODD)
    told = merkle.manifest(docs, {"other": F.when(F.col("doc_id") == 1, merkle.digest(F.lit("changed")))})
    folded = told.select("doc_id", "root", merkle.folded(F.coalesce("other", "leaf"), F.col("proof")).alias("folded")).collect()
    assert all((r.folded == r.root) == (r.doc_id != 1) for r in folded)


def test_the_query_against_brute_force(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.schema(SCHEMAS["documents"]).parquet(f"{folder}/documents.parquet").collect()
    rows = [(r.doc_id, r.source, r.lang, r.n_chars, r.text) for r in docs]
    want = {d: (own, sub, root, h(*[a + b for a, b in proof]), proof) for d, own, sub, root, proof in brute(rows)}
    by_id, changed = {r[0]: r for r in rows}, 0
    for r in queries.QUERIES["op11_merkle_manifest"](spark, folder).collect():
        own, sub, root, proof_sha256, proof = want[r.doc_id]
        assert (r.leaf, r.subroot, r.root, r.proof_sha256) == (own, sub, root, proof_sha256)
        row = by_id[r.doc_id]
        if crc32(str(r.doc_id).encode()) % 2 == 0:
            row = (*row[:4], None if row[4] is None else row[4].replace("\n", ""))
        node = leaf(row)
        for before, after in proof:
            node = h(before, node, after)
        assert (r.folded_root, r.verified) == (node, node == root)
        changed += not r.verified
    assert 0 < changed < len(rows)
