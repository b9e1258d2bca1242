import itertools
import math
import random
import re

import pytest

from fieldbook.llm import decontaminate as dc
from tests.llm.conftest import ODD



def words(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def overlaps(doc, item):
    here, there = words(doc), words(item)
    width = min(dc.WINDOW, len(there))
    if len(there) < dc.SHORTEST:
        return False
    share = dc.MATCHING if len(there) >= dc.SPAN else 1
    for diagonal in range(-len(there), len(here)):
        same = [here[diagonal + j] == there[j] for j in range(len(there)) if 0 <= diagonal + j < len(here)]
        if any(sum(same[i : i + width]) >= share * width for i in range(len(same) - width + 1)):
            return True
    return False


@pytest.fixture
def items(spark):
    pick = random.Random(1)
    texts = {i: " ".join(f"Word{pick.randrange(300)}," for _ in range(n)) for i, n in enumerate((40, 40, 13, 10, 9, 3, 0))}
    texts[7], texts[8] = texts[0].upper(), None
    return texts, spark.createDataFrame([(i, t, "extra") for i, t in texts.items()], "item_id long, text string, labels string")


def found(docs, benchmark):
    return {(r.doc_id, r.item_id) for r in dc.overlaps(docs, benchmark).collect()}


def test_substituted_passages_are_found_and_clean_ones_left_alone(docs, items):
    texts, benchmark = items
    pick, rows = random.Random(2), []
    for i in range(60):
        around = [f"other{pick.randrange(300)}" for _ in range(40)]
        passage = texts[i % 5].split()
        if i % 3 == 1:
            passage = passage[: max(len(passage) // 2, 12)]
        if i % 3 == 2:  # every twelfth word replaced
            passage = [w if j % 12 != 5 else "replaced" for j, w in enumerate(passage)]
        at = pick.randrange(len(around))
        rows.append((i, " ".join(around[:at] + passage + around[at:])))
    rows += [(100 + i, " ".join(f"word{pick.randrange(300)}" for _ in range(60))) for i in range(20)]
    want = {(d, i) for d, t in rows for i, item in texts.items() if i != 7 and overlaps(t, item or "")}
    assert len(want) > 40
    assert found(docs(rows), benchmark) == want


def test_short_items_count_word_for_word(spark, docs):
    items = {n: " ".join(f"Item{n}w{j}" for j in range(n)) for n in range(13)}
    benchmark = spark.createDataFrame([(n, t) for n, t in items.items()], "item_id long, text string")
    rows, pick = [], random.Random(3)
    for n, text in items.items():
        own = text.split()
        rows += [(10 * n, text), (10 * n + 1, "before, " + text.upper() + "; after"), (10 * n + 2, " ".join(own[:-1]))]
        if n:
            hole = pick.randrange(n)
            rows += [(10 * n + 3, "x " + " ".join("other" if j == hole else w for j, w in enumerate(own))), (10 * n + 4, " ".join(reversed(own)))]
    want = {(d, n) for d, t in rows for n, item in items.items() if overlaps(t, item)}
    assert {(10 * n + 1, n) for n in range(3, 13)} <= want and not any(n < 3 or (n < 10 and d % 10 in (2, 3, 4)) for d, n in want)
    assert found(docs(rows), benchmark) == want
    row = dc.overlaps(docs([(1, "a b " + items[5] + " c")]), benchmark).first()
    assert (row.item_id, row.first_word, row.n_words, row.n_same) == (5, 2, 5, 5)


def test_short_items_against_the_twin(spark, docs):
    import duckdb

    from fieldbook.llm import oracles

    pick = random.Random(5)
    rows = [(i, " ".join(f"w{pick.randrange(6)}" for _ in range(pick.randrange(25)))) for i in range(60)]
    tests = [(i, " ".join(f"w{pick.randrange(6)}" for _ in range(i % 14))) for i in range(40)]
    documents, benchmark = (spark.createDataFrame(r, f"{n}_id long, text string").toPandas() for r, n in ((rows, "doc"), (tests, "item")))
    want = {(a, b) for a, b, *_ in duckdb.sql(oracles.DECONTAMINATION).fetchall()}
    assert want and found(docs(rows), spark.createDataFrame(benchmark)) == want and len(documents) == 60


def test_table_against_all_alignments(table):
    docs, benchmark = table("documents"), table("benchmark")
    rows, tests = [(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in benchmark.collect()]
    grams = lambda t: {tuple(w[i : i + 3]) for w in [words(t)] for i in range(len(w) - 2)}  # noqa: E731  nine of twelve alike have three in a row
    by_item = {i: (t, grams(t)) for i, t in tests}
    want = {(d, i) for d, t in rows for mine in [grams(t)] for i, (item, theirs) in by_item.items() if mine & theirs and overlaps(t, item)}
    assert found(docs, benchmark) == want


def test_seeds_in_several_blocks_give_the_same(docs, items, monkeypatch):
    texts, benchmark = items
    rows = [(i, "start " + t + " end") for i, t in texts.items() if t]
    whole = found(docs(rows), benchmark)
    monkeypatch.setattr(dc, "BROADCAST", 20)
    assert found(docs(rows), benchmark) == whole


def test_odd_rows_repeats_and_empty_tables(docs, items):
    texts, benchmark = items
    rows = [*ODD, (20, texts[0]), (20, texts[0]), (None, texts[1]), (21, "x " + texts[1] + " " + texts[1])]
    frame = docs(rows)
    got = dc.overlaps(frame, benchmark).collect()
    assert {(r.doc_id, r.item_id) for r in got} == {(20, 0), (None, 1), (21, 1)} and len(got) == 4  # the item of three words is nowhere
    kept = dc.clean(frame, benchmark)
    assert kept.columns == frame.columns and kept.count() == len(ODD)
    assert dc.overlaps(frame.limit(0), benchmark).count() == dc.overlaps(frame, benchmark.limit(0)).count() == 0
    assert dc.clean(frame, benchmark.limit(0)).count() == len(rows)


def test_place_and_size_of_an_overlap(docs, items):
    texts, benchmark = items
    row = dc.overlaps(docs([(1, "a b c " + texts[0] + " d")]), benchmark).first()
    assert (row.first_word, row.n_words, row.n_same) == (3, 40, 40)


def test_no_python_in_the_plan(docs, items):
    plan = dc.overlaps(docs(ODD), items[1])._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))


def test_every_pattern_of_replaced_words_leaves_a_mask_unharmed():
    for width in range(dc.SPAN, dc.WINDOW + 1):
        fits = [{at + p for p in mask} for mask in dc.MASKS for at in range(width - max(mask))]
        for replaced in itertools.combinations(range(width), width - math.ceil(dc.MATCHING * width)):
            assert any(fit.isdisjoint(replaced) for fit in fits), (width, replaced)


def test_every_pattern_of_replaced_words_is_found(spark, docs):
    rows, texts = [], {}
    for width in range(dc.SPAN, dc.WINDOW + 1):
        texts[width] = [f"w{width}x{j}" for j in range(width)]
        for n in range(width - math.ceil(dc.MATCHING * width) + 2):  # up to one more than an overlap allows
            rows += [(width, replaced) for replaced in itertools.combinations(range(width), n)]
    passages = [(i, " ".join("other" if j in replaced else w for j, w in enumerate(texts[width]))) for i, (width, replaced) in enumerate(rows)]
    benchmark = spark.createDataFrame([(width, " ".join(t)) for width, t in texts.items()], "item_id long, text string")
    want = {(i, width) for i, (width, replaced) in enumerate(rows) if width - len(replaced) >= dc.MATCHING * width}
    assert found(docs(passages), benchmark) == want


def test_every_fourth_word_replaced(spark, docs):
    item = [f"w{j}" for j in range(40)]
    benchmark = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    rows = [(first, " ".join("other" if j % 4 == first else w for j, w in enumerate(item))) for first in range(4)]
    assert found(docs(rows), benchmark) == {(first, 1) for first in range(4)}
