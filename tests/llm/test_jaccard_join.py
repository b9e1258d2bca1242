import random
from collections import defaultdict

import numpy as np
import pytest

from fieldbook.llm import jaccard_join as jj
from fieldbook.llm.components import components
from tests.llm.conftest import ODD, jaccard, shingles


def brute(rows):
    """(id, text) -> (group, copies, links), by comparing all pairs."""
    by_text = defaultdict(list)
    for i, text in rows:
        if i is not None:
            by_text[text or ""].append(i)
    texts = list(by_text)
    sets, parent = [shingles(t) for t in texts], list(range(len(texts)))

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    links = [len(by_text[t]) - 1 for t in texts]
    for a in range(len(texts)):
        for b in range(a):
            if sets[a] and sets[b] and jaccard(sets[a], sets[b]) >= 0.8 - 1e-12:
                links[a] += len(by_text[texts[b]])
                links[b] += len(by_text[texts[a]])
                parent[root(a)] = root(b)
    least = defaultdict(list)
    for k, t in enumerate(texts):
        least[root(k)] += by_text[t]
    found = [(i, min(least[root(k)]), len(by_text[t]), links[k]) for k, t in enumerate(texts) for i in by_text[t]]
    return sorted(found + [(None, None, 1, 0) for i, _ in rows if i is None], key=repr)


def joined(frame):
    return sorted(((r.doc_id, r.group_id, r.copies, r.n_links) for r in jj.join(frame).collect()), key=repr)


def family(seed, n, words=60, swaps=3):
    pick = random.Random(seed)
    base = [f"{seed}w{pick.randrange(500)}" for _ in range(words)]
    for _ in range(n):
        text = list(base)
        for _ in range(pick.randrange(swaps + 1)):
            text[pick.randrange(words)] = f"x{pick.randrange(10**6)}"
        yield " ".join(text)


def test_against_all_pairs(docs):
    pick = random.Random(11)
    texts = [t for seed in range(8) for t in family(seed, 12)] + ["a b c", "a  b\tc", "a b", "a b c d", "a b c d e f"] * 2
    rows = [(pick.randrange(1000), t) for t in texts] + ODD
    assert joined(docs(rows)) == brute(rows)


def test_the_table(table):
    docs = table("documents")
    assert joined(docs) == brute([(r.doc_id, r.text) for r in docs.collect()])


def test_a_group_over_many_blocks(docs, monkeypatch):
    monkeypatch.setattr(jj, "BLOCK_TEXTS", 7)
    rows = list(enumerate(family(3, 60, words=80, swaps=1)))
    assert joined(docs(rows)) == brute(rows)


def test_one_of_each_stays(docs):
    rows = [*enumerate(family(1, 10)), (1, next(family(1, 1))), *ODD]
    frame = docs(rows)
    kept = jj.one_of_each(frame)
    assert kept.columns == frame.columns
    got = sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr)
    groups = defaultdict(set)
    for row in jj.join(frame).where("doc_id is not null").collect():
        groups[row.group_id].add((row.doc_id, row.text_key))
    assert len([g for g in got if g[0] is not None]) == len(groups)
    assert len([g for g in got if g[0] is None]) == len([i for i, _ in ODD if i is None])
    assert {i for i, _ in got} - {None} == {min(members)[0] for members in groups.values()}


def test_empty_table(docs):
    assert joined(docs(ODD).limit(0)) == [] and jj.one_of_each(docs(ODD).limit(0)).count() == 0


def test_the_shortest_prefix_follows_from_the_similarity():
    depth = jj.prefix_length()
    assert 1 - (1 - 0.8**depth) ** jj.TREES >= jj.RECALL > 1 - (1 - 0.8 ** (depth + 1)) ** jj.TREES
    assert jj.prefix_length(0.99) == jj.DEEPEST and jj.prefix_length(0.1) == 1


def first_values(label, depth):
    """The first values of each tree, from a label's numbers."""
    values = label.view(np.uint64).reshape(jj.TREES, 2)
    parts = [(values[:, v // 4] >> np.uint64(48 - 16 * (v % 4))) & np.uint64(0xFFFF) for v in range(depth)]
    return list(zip(*[p.tolist() for p in parts], strict=True))


@pytest.mark.parametrize("depth", [3, 5, 8])
def test_pairs_meet_as_often_as_the_formula_says(depth):
    make, met, tried = np.random.default_rng(depth), 0, 400
    for _ in range(tried):
        common = make.integers(0, 2**63, 160, dtype=np.uint64)
        a, b = (jj.label(np.concatenate([common, make.integers(0, 2**63, 40, dtype=np.uint64)])) for _ in "ab")
        met += any(x == y for x, y in zip(first_values(a, depth), first_values(b, depth), strict=True))
    similarity = 160 / 240
    assert abs(met / tried - (1 - (1 - similarity**depth) ** jj.TREES)) < 0.08


@pytest.mark.parametrize("depth", [1, 4, 5, 8])
def test_edges_of_a_level_are_those_of_the_trie(spark, depth):
    make = np.random.default_rng(depth)
    base = make.integers(0, 2**63, 60, dtype=np.uint64)
    sets = [np.concatenate([base[: 60 - k % 20], make.integers(0, 2**63, k % 20, dtype=np.uint64)]) for k in range(40)]
    labels = [jj.label(s) for s in sets]
    nodes = defaultdict(list)
    for node, numbers in enumerate(labels):
        for tree, values in enumerate(first_values(numbers, depth)):
            nodes[tree, values].append(node)
    want = defaultdict(int)
    for members in nodes.values():
        for node in members[1:]:
            want[node, members[0]] += 1
    frame = spark.createDataFrame([(n, x.tolist()) for n, x in enumerate(labels)] + [(99, [])], "node long, labels array<long>")
    got = {(r.a, r.b): r.trees for r in jj.forest_edges(frame, depth).collect()}
    assert got == dict(want) and got


def levels(monkeypatch, spark, sets):
    frame = spark.createDataFrame([(n, jj.label(s).tolist()) for n, s in enumerate(sets)], "node long, labels array<long>")
    seen, real = [], jj.forest_edges
    monkeypatch.setattr(jj, "forest_edges", lambda classes, depth: seen.append(depth) or real(classes, depth))
    jj.candidates(frame)
    return seen


def test_prefixes_shorten_until_the_recall_is_reached(spark, monkeypatch):
    make = np.random.default_rng(5)
    random_set = lambda n: make.integers(0, 2**63, n, dtype=np.uint64)
    close = [np.concatenate([base, random_set(1)]) for base in (random_set(400) for _ in range(1_500)) for _ in "ab"]
    assert levels(monkeypatch, spark, close) == [8]  # 1,500 pairs at 0.995, all of them met in many trees
    monkeypatch.undo()
    far = [np.concatenate([base, random_set(11)]) for base in (random_set(89) for _ in range(300)) for _ in "ab"]
    assert levels(monkeypatch, spark, far) == [8, 7, 6, 5]  # 300 pairs at 0.8
    monkeypatch.undo()
    assert levels(monkeypatch, spark, close[:20]) == [8, 7, 6, 5]  # ten pairs prove nothing
    monkeypatch.undo()
    assert levels(monkeypatch, spark, []) == [8, 7, 6, 5]


def test_the_estimate_of_unseen_pairs():
    pick = np.random.default_rng(2)
    for chance in (0.168, 0.33, 0.5):
        trees = pick.binomial(jj.TREES, chance, 200_000)
        seen = trees[trees > 0]
        told = jj.unseen(len(seen), int((seen == 1).sum()), int((seen == 2).sum()))
        assert told == pytest.approx((trees == 0).sum(), rel=0.4, abs=3)


@pytest.mark.parametrize("seed", range(4))
def test_components(spark, seed):
    pick = random.Random(seed)
    n = pick.choice((5, 60))
    edges = [(pick.randrange(n), pick.randrange(n)) for _ in range(n)] + [(1000 + i, 1001 + i) for i in range(40)] + [(None, 3), (4, None), (7, 7)]
    neighbours = defaultdict(set)
    for a, b in edges:
        if a is not None and b is not None and a != b:
            neighbours[a].add(b)
            neighbours[b].add(a)
    want = {}
    for start in sorted(neighbours):
        todo = [start] if start not in want else []
        while todo:
            node = todo.pop()
            if node not in want:
                want[node] = start
                todo += neighbours[node]
    got = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert sorted(map(tuple, got)) == sorted(want.items())


def test_a_hubs_pairs_are_spread(spark):
    from pyspark.sql import functions as F

    from fieldbook.llm import components as parts

    hub = spark.range(1, 5_001).select(F.col("id").alias("a"), F.lit(0).cast("long").alias("b"))
    assert components(hub).where("component = 0").count() == 5_001
    turned = hub.select(F.col("b").alias("a"), F.col("a").alias("b"))
    spread = turned.groupBy("a", F.pmod(F.xxhash64("b"), F.lit(parts.PARTS)).alias("part")).count()
    assert spread.agg(F.max("count")).first()[0] < 200
    told = parts.with_least(turned, turned).agg(F.count("*"), F.min("m"), F.max("m")).first()
    assert tuple(told) == (5_000, 1, 1)
