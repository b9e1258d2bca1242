import random
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from fieldbook.llm import fingerprint as fp
from tests.llm.conftest import ODD, jaccard, shingles


@pytest.fixture(scope="module")
def texts():
    pick = random.Random(5)
    words = [f"w{i}" for i in range(400)]
    base = [" ".join(pick.choices(words, k=n)) for n in (3, 5, 9, 100, 600, 3000)]
    return base + [t + " and something more at the end" for t in base] + [t[len(t) // 3 :] for t in base] + ["", " \n "]


def test_estimates_against_the_shingle_sets(spark, texts):
    pairs = [(a, b) for a in texts for b in texts]
    frame = spark.createDataFrame(pairs, "a string, b string")
    s = frame.select("a", "b", fp.sketch(F.col("a")).alias("x"), fp.sketch(F.col("b")).alias("y"))
    got = s.select("a", "b", fp.resemblance(F.col("x"), F.col("y")).alias("r"), fp.containment(F.col("x"), F.col("y")).alias("c"),
                   fp.distinct_shingles(F.col("x")).alias("n")).collect()
    for row in got:
        a, b = shingles(row.a), shingles(row.b)
        small = len(a | b) <= fp.K
        assert abs(row.r - jaccard(a, b)) < (1e-9 if small else 0.18)
        # Of a text much smaller than the other hardly a hash falls into the other's sketch.
        if small or len(a) >= max(fp.K, len(b) / 4):
            assert abs(row.c - (len(a & b) / len(a) if a else 1.0)) < (1e-9 if small else 0.25)
        assert abs(row.n - len(a)) <= (0 if len(a) < fp.K else 0.35 * len(a))


def test_parts_merge_to_the_whole(spark):
    pick = random.Random(6)
    sets = {k: [[pick.randrange(-(2**63), 2**63) for _ in range(50)] for _ in range(200)] for k in (1, 2)}
    rows = [(k, n, sorted(set(part))) for k, parts in sets.items() for n, part in enumerate(parts)]
    frame = spark.createDataFrame(rows + [(3, 0, None)], "k int, part int, sketch array<long>")
    got = {r.k: r.sketch for r in fp.merge(frame, "k", "part", fan_in=4).collect()}
    assert got == {k: sorted({h for p in parts for h in p})[: fp.K] for k, parts in sets.items()} | {3: []}
    assert fp.merge(frame.limit(0), "k", "part").count() == 0


def expected(rows):
    rows = sorted((i, t or "") for i, t in rows if i is not None)
    for n, (i, text) in enumerate(rows):
        following, half = rows[(n + 1) % len(rows)][1], len(text) // 2
        yield i, len(text), sha256((text[: len(text) - half] + following[:half]).encode()).hexdigest()


def test_edited_texts_across_blocks_gaps_and_repeated_ids(docs):
    pick = random.Random(7)
    ids = {pick.choice((pick.randrange(-2000, 2000), pick.randrange(10**12))) for _ in range(300)}
    rows = [(i, "é" * pick.randrange(9) + f" text {i}") for i in ids] + ODD
    got = fp.report(docs(rows)).where("doc_id is not null").select("doc_id", "n_chars", "edited_sha256").collect()
    assert sorted(map(tuple, got)) == sorted(expected(rows))


def test_successors_over_many_levels(spark):
    pick = random.Random(8)
    numbers = sorted({pick.choice((pick.randrange(50), pick.randrange(-(10**9), 10**9))) for _ in range(200)})
    got = fp.successors(spark.createDataFrame([(n,) for n in numbers], "n long"), "n", wide=4).collect()
    assert sorted((r.n, r.following) for r in got) == [(n, numbers[(i + 1) % len(numbers)]) for i, n in enumerate(numbers)]


def test_equal_texts_and_rows_without_id(docs):
    rows = {(r.doc_id, r.n_chars): r for r in fp.report(docs(ODD)).collect()}
    assert fp.report(docs(ODD)).count() == len(ODD)
    assert rows[3, 1].fingerprint == rows[8, 1].fingerprint != ""
    assert rows[1, 0].fingerprint == "" and rows[1, 0].near_next == 1.0
    assert rows[None, 0].near_next is None or rows[None, 0].near_next in (0.0, 1.0)
    assert fp.report(docs(ODD).limit(0)).count() == 0


def test_no_python_in_the_plan(docs):
    plan = fp.report(docs(ODD))._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))
