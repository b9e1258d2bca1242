import random
import re
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldbook.llm import mixing as mx
from tests.llm.conftest import ODD


def test_permutations_go_through_all_and_back():
    for n in (1, 2, 3, 4, 5, 16, 17, 100, 1_000, 4_097):
        keys = mx._keys(3, "s", n)
        there = mx.permuted(np.arange(n), n, keys)
        assert sorted(there) == list(range(n)) and (mx.unpermuted(there, n, keys) == np.arange(n)).all()
    orders = {tuple(mx.permuted(np.arange(20), 20, mx._keys(3, "s", e))) for e in range(5)}
    assert len(orders) == 5


def shown(slots, last, size, n, block, source, seed):
    """Words that so many slots show, the last one cut."""
    words = 0
    for number in range(slots):
        at = int(mx.permuted(np.array([number % n]), n, mx._keys(seed, source, number // n))[0])
        length = min(block, size - at * block)
        words += min(length, last) if number == slots - 1 else length
    return words


def test_slots_show_the_words_due_exactly():
    pick = random.Random(1)
    for _ in range(300):
        block, size = pick.choice((1, 2, 7, 64)), pick.randrange(1, 300)
        n, words, seed = -(-size // block), pick.randrange(0, 3 * size + 1), pick.randrange(99)
        slots, last = mx.due(words, size, n, block, "s", seed)
        assert shown(slots, last, size, n, block, "s", seed) == words and slots <= 3 * n


def targets(sizes, weights=(5, 2, 1), repeats=3):
    """By sharing the excess over and over; ``sizes`` in order of the sources."""
    weight = [weights[i % len(weights)] for i in range(len(sizes))]
    rest, open_, out = Fraction(sum(sizes)), set(range(len(sizes))), [Fraction(0)] * len(sizes)
    while open_:
        share = {i: rest * weight[i] / sum(weight[j] for j in open_) for i in open_}
        above = {i for i in open_ if share[i] > repeats * sizes[i]}
        for i in above:
            out[i] = Fraction(repeats * sizes[i])
            rest -= out[i]
        if not above:
            for i in open_:
                out[i] = share[i]
            break
        open_ -= above
    return out


def brute(rows, mixture):
    """doc_id, size, source_size, target, taken of rows (doc_id, text, source); ids and sizes must tell the rows of a source apart."""
    sized = [(i, len(re.findall(mx.WORD, t or "")), s) for i, t, s in rows]
    names = sorted({s for _, _, s in sized}, key=lambda s: (s is None, (s or "").encode()))
    sizes = [sum(n for _, n, s in sized if s == name) for name in names]
    goals = targets(sizes, mixture.weights, mixture.repeats)
    info, taken = {}, Counter()
    for name, size, goal in zip(names, sizes, goals, strict=True):
        source, n = "~" if name is None else f"={name}", -(-size // mixture.block)
        words = int(goal + Fraction(1, 2))
        slots, last = mx.due(words, size, n, mixture.block, source, mixture.seed)
        offsets, at = [], 0
        for k, (i, own, s) in sorted(enumerate(sized), key=lambda x: (x[1][0] is not None, x[1][0] or 0, x[1][1])):
            if s == name:
                offsets.append((at, at + own, k))
                at += own
        for number in range(slots):
            b = int(mx.permuted(np.array([number % n]), n, mx._keys(mixture.seed, source, number // n))[0])
            upto = last if number == slots - 1 else mixture.block
            for low, past, k in offsets:
                taken[k] += max(0, min(past, b * mixture.block + upto) - max(low, b * mixture.block))
        info[name] = (size, float(goal))
    return sorted(((i, n, *info[s], taken[k]) for k, (i, n, s) in enumerate(sized)), key=repr)


def told(frame, mixture=mx.Mixture()):
    rows = mx.report(frame, mixture).collect()
    return sorted(((r.doc_id, r.size, r.source_size, r.target, r.taken) for r in rows), key=repr)


def same(got, want):
    assert len(got) == len(want)
    for a, b in zip(got, want, strict=True):
        assert a[:3] + a[4:] == b[:3] + b[4:] and a[3] == pytest.approx(b[3], rel=1e-12)


def frame_of(spark, rows):
    full = [(*r, "a", 1, 2, "b", 3.5, "c", 4) for r in rows]
    return spark.createDataFrame(full, "doc_id long, text string, source string, _source string, size long, rank int, shard string, first double, block string, taken long")


@pytest.mark.parametrize("mixture", [mx.Mixture(), mx.Mixture(block=3, shard=5), mx.Mixture(block=1, shard=1000, seed=4), mx.Mixture((1, 9), 2, 7, 11, 5)])
def test_against_brute_force(spark, mixture):
    pick = random.Random(mixture.block)
    rows = [(i, "w " * pick.choice((0, 1, 2, 5, 40, 300)), pick.choice(("hot", "hot", "b", "c", "d", "é", "", None))) for i in range(120)]
    rows.append((500, "one", "tiny"))
    want = brute(rows, mixture)
    same(told(frame_of(spark, rows), mixture), want)
    pick.shuffle(rows)
    same(told(frame_of(spark, rows).repartition(7), mixture), want)  # reruns agree, whatever the partitions


def test_odd_rows_repeats_and_empty_tables(spark):
    rows = [(i, t, s) for (i, t), s in zip(ODD, ("a", None, "a", "", "b", "b", "a", None, "c", "d", "a", "a"), strict=True)] + [(77, "x\x85y z q", "a")] * 3
    got, want = told(frame_of(spark, rows)), brute(rows, mx.Mixture())
    # Rows of one id and size are the same to the mix; which of them is taken more often is open.
    assert Counter(r[:3] for r in got) == Counter(r[:3] for r in want)
    assert sum(r[4] for r in got) == sum(r[4] for r in want) and all(r[4] <= 3 * r[1] for r in got)
    assert told(frame_of(spark, rows).limit(0)) == []
    assert all(r[1:] == (0, 0, 0.0, 0) for r in told(frame_of(spark, [(1, None, "a"), (2, " ", None)])))


def test_targets_by_hand(spark):
    # a may have 3 x 10 of its 5 / 8 x 160; what is over goes to b and c, 2 to 1.
    rows = [(1, "w " * 10, "a"), (2, "w " * 100, "b"), (3, "w " * 50, "c")]
    found = {r.doc_id: r.target for r in mx.report(frame_of(spark, rows)).collect()}
    assert found == pytest.approx({1: 30.0, 2: 130 * 2 / 3, 3: 130 / 3})


def test_the_mix_itself(spark):
    """Every span lies in its document, shards are full, and a source's share of a shard is near its share of the whole."""
    mixture = mx.Mixture(block=4, shard=200)
    rows = [(i, "w " * (1 + i % 37), "abc"[i % 3]) for i in range(900)]
    mixed, packed, sources = mx.mix(frame_of(spark, rows), mixture)
    sizes = {i: 1 + i % 37 for i, _, _ in rows}
    spans = mixed.collect()
    assert all(0 <= s.first_word and s.first_word + s.n_words <= sizes[s.doc_id] and s.n_words > 0 for s in spans)
    slots = mx.slots(sources, mixture)
    numbers = {}
    for s in slots.collect():
        numbers.setdefault(s._source, []).append(s.number)
    due = {r._source: r.slots for r in sources.collect()}
    assert {k: sorted(v) for k, v in numbers.items()} == {k: list(range(n)) for k, n in due.items()}
    per_shard = {r.shard: r["count"] for r in slots.groupBy("shard").count().collect()}
    assert max(per_shard.values()) <= mixture.shard and min(v for k, v in per_shard.items() if k < max(per_shard) - 2) > 0.8 * mixture.shard
    words = Counter()
    for s in spans:
        words["abc"[s.doc_id % 3]] += s.n_words
    assert words == {r._source[1:]: r.words for r in sources.collect()}


def test_sets_of_many_sources(spark, monkeypatch):
    monkeypatch.setattr(mx, "TOGETHER", 4)
    rows = [(i, "w " * (3 + i % 50), f"s{i % 23:02}") for i in range(400)]
    mixture = mx.Mixture(block=8, shard=64)
    same(told(frame_of(spark, rows), mixture), brute(rows, mixture))


def test_no_document_of_the_table_is_taken_too_often(spark, table):
    docs = table("documents")
    got = mx.report(docs).withColumnRenamed("doc_id", "id").join(docs.select(F.col("doc_id").alias("id"), "source"), "id")
    assert got.where("taken > 3 * size").count() == 0
    by_source = got.groupBy("source").agg(F.sum("taken").alias("taken"), F.max("target").alias("target"), F.sum("size").alias("size"), F.max("source_size").alias("told"))
    rows = by_source.collect()
    assert all(abs(r.taken - r.target) <= 0.5 and r.size == r.told for r in rows)
    assert sum(r.target for r in rows) == pytest.approx(sum(r.size for r in rows))
