"""Mixing sources to target weights, without a shuffle of the words.

The words of a source, documents one after another by id, are packed into blocks of a fixed length. The output is made of
shards of a fixed number of slots; for every shard a multinomial draw by the sources' shares says how many slots each
source fills. A source's slots are numbered over all shards, and its n-th slot shows block ``p(n)`` of a pseudorandom
permutation of the block numbers, a new one each time all blocks were used. So a block's uses differ by one at most, and slots
and blocks are joined by (source, block), which no hot source makes a hot key.

Independent draws miss the targets by about the square root of their counts. Slots beyond a source's due are
left out, and what others are due fills shards at the end, so every source gives exactly its target, rounded to words; of
its last slot only the words due are used. All randomness comes from the seed, the source and the shard:
reruns agree, whatever the partitions.

Null texts have no words. Null sources are one source, after all others. Repeated rows are documents of their own; rows of one id
are packed by size and hash. A source without words has target 0. No rows give none. Only doc_id, text and source are read.

The driver sees the totals, and one number per thousand sources.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldbook.llm.common import once
from fieldbook.llm.ordered import AT, PLACE, before, placed, total

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
REPEATS = 3
BLOCK = 64
SHARD = 4096
SEED = 13
# Sources whose shares are drawn together, and shards whose counts are summed together.
TOGETHER = 1024
ROUNDS = 6
SLOTS_A_TASK = 200_000
SOURCE = "_source"


@dataclass(frozen=True)
class Mixture:
    """``weights`` are given to the sources in turn, by code point, the null source last."""

    weights: Sequence[int] = WEIGHTS
    repeats: int = REPEATS
    block: int = BLOCK
    shard: int = SHARD
    seed: int = SEED


def _keys(seed: int, source: str, epoch: int) -> np.ndarray:
    made = hashlib.blake2b(f"{seed}:{epoch}:{source}".encode(), digest_size=8 * ROUNDS).digest()
    return np.frombuffer(made, "<u8")


def _half(n: int) -> int:
    """Bits of half a number of the smallest even width that holds 0 .. n - 1."""
    return max(1, ((n - 1).bit_length() + 1) // 2)


def _mixed(x: np.ndarray, key: np.uint64, mask: np.uint64) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ key) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return (x ^ (x >> np.uint64(32))) & mask


def _walked(numbers: np.ndarray, n: int, step) -> np.ndarray:
    """``step`` permutes a range that n fits in; numbers outside go on until they are below n."""
    found = step(numbers.astype(np.uint64))
    while (out := found >= n).any():
        found[out] = step(found[out])
    return found.astype(np.int64)


def permuted(numbers: np.ndarray, n: int, keys: np.ndarray) -> np.ndarray:
    """A permutation of 0 .. n - 1 by a Feistel network over the two halves of a number."""
    half = np.uint64(_half(n))
    mask = np.uint64((1 << int(half)) - 1)

    def step(x):
        left, right = x >> half, x & mask
        for key in keys:
            left, right = right, left ^ _mixed(right, key, mask)
        return (left << half) | right

    return _walked(numbers, n, step)


def unpermuted(numbers: np.ndarray, n: int, keys: np.ndarray) -> np.ndarray:
    half = np.uint64(_half(n))
    mask = np.uint64((1 << int(half)) - 1)

    def step(x):
        left, right = x >> half, x & mask
        for key in keys[::-1]:
            left, right = right ^ _mixed(left, key, mask), left
        return (left << half) | right

    return _walked(numbers, n, step)


def due(words: int, size: int, n: int, block: int, source: str, seed: int) -> tuple[int, int]:
    """How many slots show ``words`` words of a source of ``size`` words in ``n`` blocks, and the words used of the last one."""
    if not words:
        return 0, 0
    epochs, rest = divmod(words, size)
    if not rest:
        return epochs * n, block
    short = block - (size - (n - 1) * block)
    at = int(unpermuted(np.array([n - 1]), n, _keys(seed, source, epochs))[0])
    slots = -(-rest // block)
    if slots <= at:
        return epochs * n + slots, rest - (slots - 1) * block
    slots = -(-(rest + short) // block)
    before_last = (slots - 1) * block - (short if slots - 1 > at else 0)
    return epochs * n + slots, rest - before_last


def packed(docs: DataFrame) -> DataFrame:
    """doc_id, size, and where the document's words lie among its source's; stored."""
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    rows = once(docs.select(
        F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("~")).alias(SOURCE), "doc_id", size.alias("size"),
        F.xxhash64("text").alias("_text"), F.monotonically_increasing_id().alias("_row"),
    ), "sizes")
    return once(placed(rows, SOURCE, ["doc_id", "size", "_text", "_row"], ["size"]).select(
        AT, SOURCE, "doc_id", "size", F.col(before("size")).alias("first"), F.col(total("size")).alias("source_size")
    ), "packed")


def targets(rows: DataFrame, mixture: Mixture = Mixture()) -> DataFrame:
    """One row per source: size, weight, target, and the slots and last words it is due; stored."""
    sizes = once(rows.groupBy(SOURCE).agg(F.max("source_size").alias("size")).withColumn("_all", F.lit("")), "sources")
    ranked = placed(sizes, "_all", [SOURCE])
    weight = F.array(*[F.lit(w).cast("long") for w in mixture.weights])[(F.col(PLACE) % len(mixture.weights)).cast("int")]
    ranked = once(ranked.select(
        SOURCE, F.col(PLACE).alias("rank"), "size", weight.alias("weight"), (F.col("size") * mixture.repeats).alias("cap")
    ), "ranked")
    words, shares = ranked.agg(F.sum("size"), F.sum("weight")).first()
    whole, rest, shares, capped = words or 0, words or 0, shares or 0, 0
    while True:
        # A share above its source's cap stays at the cap; what is over goes to the others by weight.
        above = F.lit(Decimal(rest)) * F.col("weight") > F.col("cap").cast("decimal(20,0)") * F.lit(Decimal(shares or 1))
        full, more, left = ranked.agg(
            F.sum(F.when(above, F.col("cap"))), F.count_if(above), F.sum(F.when(~above, F.col("weight")))
        ).first()
        if (more or 0) == capped:
            break
        rest, shares, capped = whole - (full or 0), left or 0, more
    target = F.when(above, F.col("cap").cast("double")).otherwise(F.lit(float(rest)) * F.col("weight") / F.lit(float(shares or 1)))
    told = ranked.withColumn("target", target).withColumn("words", F.round("target").cast("long"))
    told = told.withColumn("blocks", F.ceil(F.col("size") / mixture.block))

    def slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()
            made = [due(r["words"], r["size"], r["blocks"], mixture.block, r[SOURCE], mixture.seed) for r in rows]
            for k, name in enumerate(("slots", "last")):
                batch = batch.append_column(name, pa.array([m[k] for m in made], pa.int64()))
            yield batch

    schema = f"{SOURCE} string, rank long, size long, weight long, cap long, target double, words long, blocks long, slots long, last long"
    return once(told.mapInArrow(slots, schema), "targets")


def _rng(seed: int, *at: int) -> np.random.Generator:
    return np.random.Generator(np.random.Philox(key=[seed, len(at)], counter=[*at, *(0,) * (4 - len(at))]))


def slots(sources: DataFrame, mixture: Mixture = Mixture()) -> DataFrame:
    """shard, lot, source, number, block, upto: every slot of the mix and the block that it shows; stored.

    Slots of a shard are ordered by ``lot``; of a block the first ``upto`` words are used.
    """
    spark, seed, size = sources.sparkSession, mixture.seed, mixture.shard
    sets = sources.where("slots > 0").groupBy(F.expr(f"rank div {TOGETHER}").alias("set")).agg(
        F.sum("slots").alias("due"),
        F.sort_array(F.collect_list(F.struct("rank", SOURCE, "slots", "blocks", "last"))).alias("members"),
    )
    sets = once(sets, "sets")
    dues = {r["set"]: r["due"] for r in sets.select("set", "due").toLocalIterator()}
    numbers, shares = sorted(dues), np.array([dues[k] for k in sorted(dues)], float)
    all_slots = sum(dues.values())
    n_shards = -(-all_slots // size)

    def draw_sets(batches):
        for batch in batches:
            found = []
            for shard in batch.column("shard").to_pylist():
                drawn = _rng(seed, shard).multinomial(min(size, all_slots - shard * size), shares / shares.sum())
                found += [(shard, numbers[k], int(drawn[k])) for k in np.flatnonzero(drawn)]
            columns = zip(*found) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["shard", "set", "drawn"])

    def draw_sources(batches):
        for batch in batches:
            found = []
            for row in batch.to_pylist():
                due = np.array([m["slots"] for m in row["members"]], float)
                drawn = _rng(seed, row["shard"], row["set"] + 1).multinomial(row["drawn"], due / due.sum())
                found += [{"shard": row["shard"], **row["members"][k], "drawn": int(drawn[k])} for k in np.flatnonzero(drawn)]
            yield pa.RecordBatch.from_pylist(found, schema=drawn_schema)

    drawn_schema = pa.schema([
        ("shard", pa.int64()), (SOURCE, pa.string()), ("slots", pa.int64()), ("blocks", pa.int64()), ("last", pa.int64()), ("drawn", pa.int64())
    ])
    drawn = (
        spark.range(n_shards).withColumnRenamed("id", "shard").mapInArrow(draw_sets, "shard long, set long, drawn long")
        .join(sets.select("set", "members"), "set")
        .mapInArrow(draw_sources, f"shard long, {SOURCE} string, slots long, blocks long, last long, drawn long")
    )
    drawn = once(drawn.withColumn("_many", F.expr(f"shard div {TOGETHER}")), "drawn")
    zero = F.lit(0).cast("long")
    early = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    many = drawn.groupBy(SOURCE, "_many").agg(F.sum("drawn").alias("_drawn")).select(
        SOURCE, "_many", F.coalesce(F.sum("_drawn").over(early(Window.partitionBy(SOURCE).orderBy("_many"))), zero).alias("_early")
    )
    start = F.coalesce(F.sum("drawn").over(early(Window.partitionBy(SOURCE, "_many").orderBy("shard"))), zero)
    runs = drawn.withColumn("_start", start).join(many, [SOURCE, "_many"]).withColumn("start", F.col("_start") + F.col("_early"))
    kept = F.greatest(F.least("drawn", F.col("slots") - F.col("start")), zero)
    runs = runs.select("shard", SOURCE, "slots", "blocks", "last", "start", kept.alias("n"), zero.alias("offset"))
    # What the draws left a source due, packed into shards of its own at the end.
    reached = drawn.groupBy(SOURCE).agg(F.sum("drawn").alias("reached"))
    owed = sources.where("slots > 0").join(reached, SOURCE, "left").withColumn("reached", F.coalesce("reached", zero))
    owed = owed.where("reached < slots").select(
        F.lit("").alias("_all"), SOURCE, "slots", "blocks", "last", F.col("reached").alias("start"), (F.col("slots") - F.col("reached")).alias("n")
    )
    owed = placed(once(owed, "owed"), "_all", [SOURCE], ["n"])
    piece = F.explode(F.sequence(zero, F.col("n") - 1, F.lit(size).cast("long"))).alias("_piece")
    owed = owed.select("*", piece).select(
        F.lit(n_shards).cast("long").alias("shard"), SOURCE, "slots", "blocks", "last", (F.col("start") + F.col("_piece")).alias("start"),
        F.least(F.lit(size).cast("long"), F.col("n") - F.col("_piece")).alias("n"), (F.col(before("n")) + F.col("_piece")).alias("offset"),
    )

    def show(batches):
        for batch in batches:
            for row in batch.to_pylist():
                number = np.arange(row["start"], row["start"] + row["n"])
                epoch, at = number // row["blocks"], number % row["blocks"]
                blocks = np.empty_like(number)
                for e in np.unique(epoch):
                    here = epoch == e
                    blocks[here] = permuted(at[here], row["blocks"], _keys(seed, row[SOURCE], int(e)))
                upto = np.where(number == row["slots"] - 1, row["last"], mixture.block)
                # Numbered shards have offset 0 and at most ``size`` slots; those at the end are cut here.
                shard = row["shard"] + (row["offset"] + np.arange(row["n"])) // size
                columns = [pa.array(c, pa.int64()) for c in (shard, number, blocks, upto)]
                yield pa.RecordBatch.from_arrays([columns[0], pa.array([row[SOURCE]] * row["n"], pa.string()), *columns[1:]],
                                                 names=["shard", SOURCE, "number", "block", "upto"])

    # A short row makes many slots, so the tasks are counted by slots. Written, as Spark can't tell the size of what a task makes.
    tasks = -(-all_slots // SLOTS_A_TASK) or 1
    runs = runs.where("n > 0").unionByName(owed).repartition(tasks, "shard", SOURCE, "start")
    shown = runs.mapInArrow(show, f"shard long, {SOURCE} string, number long, block long, upto long")
    return once(shown.withColumn("lot", F.xxhash64("shard", SOURCE, "number")), "slots")


def blocks(rows: DataFrame, mixture: Mixture = Mixture()) -> DataFrame:
    """source, block, and the part of a document in it: from word ``begin`` to ``end`` of the block, from ``first_word`` of the document."""
    size, first, past = mixture.block, F.col("first"), F.col("first") + F.col("size")
    cut = rows.where("size > 0").select(
        AT, SOURCE, "doc_id", "first", "size", F.explode(F.sequence(F.expr(f"first div {size}"), F.expr(f"(first + size - 1) div {size}"))).alias("block")
    )
    low = F.col("block") * size
    return cut.select(
        AT, SOURCE, "doc_id", "block", (F.greatest(first, low) - low).alias("begin"), (F.least(past, low + size) - low).alias("end"),
        F.greatest(F.lit(0).cast("long"), low - first).alias("first_word"),
    )


def spans(rows: DataFrame, sources: DataFrame, mixture: Mixture = Mixture()) -> DataFrame:
    """The mix: per slot and document in it, which words of the document stand there.

    Sort by shard, lot and begin to read it; ``_at`` tells the rows of ``packed`` apart.
    """
    shown = slots(sources, mixture).join(blocks(rows, mixture), [SOURCE, "block"]).where("begin < upto")
    return shown.select("shard", "lot", "begin", AT, "doc_id", "first_word", (F.least("end", "upto") - F.col("begin")).alias("n_words"))


def mix(docs: DataFrame, mixture: Mixture = Mixture()) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The spans of the mix, the packed documents and the sources."""
    rows = packed(docs)
    sources = targets(rows, mixture)
    return spans(rows, sources, mixture), rows, sources


def report(docs: DataFrame, mixture: Mixture = Mixture()) -> DataFrame:
    """One row per document: its size, its source's size and target, and how many of its words the mix takes."""
    mixed, rows, sources = mix(docs, mixture)
    taken = mixed.groupBy(AT).agg(F.sum("n_words").alias("taken"))
    told = rows.join(taken, AT, "left").join(sources.select(SOURCE, "target"), SOURCE)
    return told.select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0).cast("long")).alias("taken"))
