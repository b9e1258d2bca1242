"""Benchmark passages in documents by spaced seeds.

A seed is a window of words of which a fixed mask leaves some out: the hash covers the words at
the mask's positions, so a word replaced at any other position doesn't matter. Seeds of all
windows of all documents are joined with the seeds of all windows of all test items. A hit
gives a diagonal, the place in the document at which the item would start; around every
diagonal with a hit the words themselves are compared. A window of ``WINDOW`` words (or of
the whole item, if it is shorter) in which ``MATCHING`` of the words are the same is an overlap.
Wherever the words that differ lie in such a window, at least one mask fits on words that are the same
(a test goes through all patterns), so every overlap has a hit and is verified.

An item of fewer than ``SPAN`` words is too short for that: it is an overlap only where all its words stand in a row, and the hash
of all of them is its one seed. For items that short, windows of just their sizes are hashed too.

The seeds of the test items are broadcast in blocks of at most ``BROADCAST`` of them, one pass over
the documents for each block, so neither what is broadcast nor what is shuffled grows with both sides. Only hits
are shuffled. Items with the same words count as the one with the least id.

Words are runs of letters and digits, A-Z in lower case. Null and empty texts have none. Items of fewer
than ``SHORTEST`` words say too little and match nothing. Repeated documents (same id and text) are reported once. A null id is
reported as null; items without an id take part as null too. Other columns are left out.

Only built-in functions run here.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldbook.llm.common import free_names, id_and_text
from fieldbook.llm.license_scan import scan_words
from fieldbook.session import stored

# Positions that count. Three words replaced anywhere within twelve, or two within ten or eleven, still leave a mask unharmed at
# some offset. No two masks of five positions within ten words do that, and four of them would double the seeds.
MASKS = ((0, 1, 2, 6), (0, 3, 4, 6))
REACH = 7
SPAN = 10
SHORTEST = 3
WINDOW = 12
MATCHING = 0.75
BROADCAST = 500_000


def seeds(hashes: Column) -> Column:
    """array<long>: the seeds of all windows by the first mask, then by the second, from an array of word hashes."""
    starts = F.sequence(F.lit(0), F.size(hashes) - REACH)

    def masked(number: int) -> Column:
        return F.transform(starts, lambda i: F.xxhash64(F.lit(number), *[F.get(hashes, i + at) for at in MASKS[number]]))

    return F.when(F.size(hashes) >= REACH, F.concat(*map(masked, range(len(MASKS))))).otherwise(F.array().cast("array<long>"))


def exploded(texts: DataFrame, *keys: str) -> DataFrame:
    """keys, position of the window, seed."""
    hashed = texts.select(*keys, F.transform(scan_words(F.col("text")), lambda w: F.xxhash64(w)).alias("hashes"))
    each = hashed.select(*keys, (F.size("hashes") - REACH + 1).alias("windows"), F.posexplode(seeds(F.col("hashes"))).alias("at", "seed"))
    return each.select(*keys, F.expr("at % windows").alias("position"), "seed")


def phrases(texts: DataFrame, sizes: Sequence[int], *keys: str) -> DataFrame:
    """keys, position, seed of all runs of so many words."""
    def runs(size: int) -> Column:
        starts = F.when(F.size("hashes") >= size, F.sequence(F.lit(0), F.size("hashes") - size)).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.struct(
            i.cast("long").alias("position"), F.xxhash64(F.lit(-size), F.slice("hashes", i + 1, size)).alias("seed")
        ))

    hashed = texts.select(*keys, F.transform(scan_words(F.col("text")), lambda w: F.xxhash64(w)).alias("hashes"))
    return hashed.select(*keys, F.explode(F.concat(*map(runs, sizes))).alias("run")).select(*keys, "run.position", "run.seed")


def items_of(benchmark: DataFrame, id: str, text: str) -> DataFrame:
    """item_id, words, text: one row per different sequence of at least ``SHORTEST`` words."""
    items = id_and_text(benchmark, id, text).withColumn("words", scan_words(F.col("text"))).where(F.size("words") >= SHORTEST)
    return items.groupBy("words").agg(F.min("doc_id").alias("item_id"), F.first("text").alias("text"))


def hits(docs: DataFrame, items: DataFrame) -> DataFrame:
    """doc_id, text_hash, item, diagonal: each once."""
    size = F.size("words")
    short = items.where(size < SPAN)
    sizes = sorted(r.n for r in short.select(size.alias("n")).distinct().collect())  # at most SPAN - SHORTEST numbers
    seeded = exploded(items.where(size >= SPAN), "item")
    for n in sizes:
        seeded = seeded.unionByName(phrases(short.where(size == n), [n], "item"))
    known = stored(seeded.select("item", F.col("position").alias("at"), F.col("seed").alias("known")), "seeds")
    blocks = max(1, math.ceil(known.count() / BROADCAST))
    found = None
    for block in range(blocks):
        some = known.where(F.pmod(F.xxhash64("known", "item", "at"), F.lit(blocks)) == block)
        mine = exploded(docs, "doc_id", "text_hash")
        if sizes:
            mine = mine.unionByName(phrases(docs, sizes, "doc_id", "text_hash"))
        matched = mine.join(F.broadcast(some), mine["seed"] == some["known"]).select(
            "doc_id", "text_hash", "item", (F.col("position") - F.col("at")).alias("diagonal")
        )
        found = matched if found is None else found.unionByName(matched)
    return found.distinct()


def overlaps(docs: DataFrame, benchmark: DataFrame, id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """doc_id, text_hash, item_id, first_word, n_words, n_same: verified overlaps, one for each document, item and diagonal.

    ``first_word`` is where the overlap begins in the document, counted from 0, ``n_words`` how many words its
    windows span together, ``n_same`` how many of these are the item's.
    """
    items = stored(items_of(benchmark, item_id, item_text).select(F.monotonically_increasing_id().alias("item"), "*"), "items")
    texts = id_and_text(docs, id, text).withColumn("text_hash", F.xxhash64("text"))
    near = hits(texts, items.select("item", "text", "words")).join(items.select("item", F.size("words").alias("size")), "item")
    # The places to look at in each document: no more than its windows times the items that share a seed there.
    places = stored(near.groupBy("doc_id", "text_hash").agg(F.collect_list(F.struct("item", "diagonal", "size")).alias("places")), "seed-hits")
    keyed = places.withColumnsRenamed({"doc_id": "place_id", "text_hash": "place_hash"})
    split = texts.join(keyed, texts["doc_id"].eqNullSafe(keyed["place_id"]) & (texts["text_hash"] == keyed["place_hash"])).select(
        "doc_id", "text_hash", "places", scan_words(F.col("text")).alias("here")
    )
    cut = F.transform("places", lambda p: F.struct(
        p["item"].alias("item"), p["diagonal"].alias("diagonal"),
        # From the item's first word on, or from the document's first if the item begins before it.
        F.slice("here", F.greatest(p["diagonal"], F.lit(0)) + 1, p["size"] + F.least(p["diagonal"], F.lit(0))).alias("here"),
    ))
    aligned = split.select("doc_id", "text_hash", F.explode(cut).alias("p")).select("doc_id", "text_hash", "p.*").distinct()
    aligned = aligned.join(items.select("item", "item_id", F.col("words").alias("there")), "item")
    skip = F.greatest(-F.col("diagonal"), F.lit(0))
    same = F.transform("here", lambda word, i: F.when(word == F.get("there", i + skip), 1).otherwise(0))
    width = F.least(F.size("there"), F.lit(WINDOW))
    enough = F.when(F.size("there") < SPAN, F.col("width")).otherwise(F.col("width") * MATCHING)
    windows = aligned.withColumn("same", same).withColumn("width", width).where(F.size("same") >= F.col("width")).withColumn(
        "good",
        F.filter(
            F.sequence(F.lit(0), F.size("same") - F.col("width")),
            lambda i: F.aggregate(F.slice("same", i + 1, F.col("width")), F.lit(0), lambda a, b: a + b) >= enough,
        ),
    ).where(F.size("good") > 0)
    first, last = F.element_at("good", 1), F.element_at("good", -1)
    return windows.select(
        "doc_id", "text_hash", "item_id",
        (F.greatest(F.col("diagonal"), F.lit(0)) + first).alias("first_word"),
        (last - first + F.col("width")).alias("n_words"),
        F.aggregate(F.slice("same", first + 1, last - first + F.col("width")), F.lit(0), lambda a, b: a + b).alias("n_same"),
    )


def clean(docs: DataFrame, benchmark: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents, all columns, that overlap no test item."""
    own, leaked_id, leaked_hash = free_names(docs, "own_hash", "leaked_id", "leaked_hash")
    found = overlaps(docs, benchmark, id, text)
    found = found.select(F.col("doc_id").alias(leaked_id), F.col("text_hash").alias(leaked_hash)).distinct()
    hashed = docs.withColumn(own, F.xxhash64(F.coalesce(F.col(text).cast("string"), F.lit(""))))
    leaked = hashed[id].cast("long").eqNullSafe(found[leaked_id]) & (hashed[own] == found[leaked_hash])
    return hashed.join(found, leaked, "left_anti").select(*docs.columns)
