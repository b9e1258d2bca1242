"""Bottom-k sketches of word shingles.

The sketch of a text is the ``k`` smallest different hashes of its shingles of five words; a
text of fewer words has one shingle of all its words, one without words an empty sketch.
Equal texts have equal sketches. Sketches of parts merge to the sketch of the whole, since the
smallest hashes of a union are among the smallest of its parts.

From two sketches: the k smallest hashes of their union are a uniform sample of the union's
shingles, and the share that is in both estimates the resemblance (Jaccard), exactly if no
text has more than k shingles. Containment and the number of different shingles follow from
the same sample and from how small the k-th hash is.

Only built-in functions run here. A row's work is bounded by its own text.

A null text counts as empty. Two empty sketches resemble each other fully (1.0), an empty one
and another not at all. Repeated rows each give a row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldbook.llm.common import hashed_words, id_and_text
from fieldbook.session import stored

SHINGLE = 5
K = 256
# Hashes are spread evenly over the signed 64-bit numbers.
LOWEST, SPAN = -(2.0**63), 2.0**64


def sketch(text: Column, k: int = K) -> Column:
    """array<long>, ascending."""
    return of_words(hashed_words(F.coalesce(text, F.lit(""))), k)


def of_words(hashes: Column, k: int = K) -> Column:
    """The sketch of a text given as its words' hashes, in order."""
    # As a lambda's argument the array is worked out once, not once for each place that uses it.
    return F.transform(F.array(hashes), lambda w: smallest(shingles(w), k))[0]


def shingles(words: Column) -> Column:
    count = F.greatest(F.size(words) - (SHINGLE - 1), F.lit(1))
    each = F.transform(F.sequence(F.lit(1), count), lambda i: F.xxhash64(F.slice(words, i, SHINGLE)))
    return F.when(F.size(words) > 0, each).otherwise(F.array().cast("array<long>"))


def smallest(hashes: Column, k: int = K) -> Column:
    return F.slice(F.sort_array(F.array_distinct(hashes)), 1, k)


def merged(first: Column, second: Column, k: int = K) -> Column:
    return smallest(F.concat(first, second), k)


def merge(parts: DataFrame, key: str, part: str, sketch: str = "sketch", k: int = K, fan_in: int = 64) -> DataFrame:
    """key, sketch: one sketch per key from its parts' sketches.

    ``part`` is a number that tells a key's parts apart. Parts are merged ``fan_in`` at a
    time in as many rounds as the largest part number needs, so no task holds more than
    ``fan_in`` sketches of a key however many parts there are; parts of equal number count as
    one merge. A null sketch counts as empty.
    """
    level = parts.select(key, F.abs(F.col(part).cast("long")).alias("_part"), F.coalesce(sketch, F.array().cast("array<long>")).alias("_sketch"))
    largest = level.agg(F.max("_part")).first()[0] or 0
    while True:
        level = (
            level.groupBy(key, F.expr(f"_part div {fan_in}").alias("_part"))
            .agg(F.flatten(F.collect_list("_sketch")).alias("_all"))
            .select(key, "_part", smallest(F.col("_all"), k).alias("_sketch"))
        )
        if largest < fan_in:
            return level.select(key, F.col("_sketch").alias(sketch))
        largest //= fan_in


def resemblance(first: Column, second: Column, k: int = K) -> Column:
    """Estimated Jaccard similarity of the shingle sets, 0 to 1."""
    sample = merged(first, second, k)
    both = F.size(F.array_intersect(F.array_intersect(sample, first), second))
    return F.when(F.size(sample) == 0, 1.0).otherwise(both / F.size(sample))


def containment(first: Column, second: Column, k: int = K) -> Column:
    """Estimated share of the first text's shingles that the second has too, 0 to 1; 1 if the first has none.

    Of the first sketch, only hashes up to the second's largest can be looked up there.
    """
    known = F.when(F.size(second) < k, first).otherwise(F.filter(first, lambda h: h <= F.element_at(second, -1)))
    shared = F.size(F.array_intersect(known, second)) / F.size(known)
    return F.when(F.size(first) == 0, 1.0).when(F.size(known) == 0, 0.0).otherwise(shared)


def distinct_shingles(sketch: Column, k: int = K) -> Column:
    """Estimated number of different shingles; exact below k."""
    share = (F.element_at(sketch, -1).cast("double") - LOWEST) / SPAN
    return F.when(F.size(sketch) < k, F.size(sketch).cast("double")).otherwise((k - 1) / share)


def written(sketch: Column) -> Column:
    """The sketch as text: hashes in hexadecimal, joined by dots."""
    return F.array_join(F.transform(sketch, lambda h: F.lower(F.hex(h))), ".")


# Blocks of 256 neighbouring ids.
BLOCK_BITS = 8


def following(docs: DataFrame, k: int = K) -> DataFrame:
    """doc_id, text, sketch, next_text, next_sketch: each row with the row of the next larger doc_id.

    The row with the largest id is followed by the one with the smallest. Rows without an id
    follow nothing: what is next to them is null. Rows of one id are in the order of their texts.

    Ids are cut into blocks of neighbouring numbers and windows run per block, so no
    task needs more different ids than that together, and texts are shuffled once. The last row of a
    block takes the first text of the next block that has rows; which one that is comes from
    ``successors`` over one row per block.
    """
    placed = docs.select("doc_id", "text", F.shiftright("doc_id", BLOCK_BITS).alias("block"))
    known = placed.where("doc_id is not null")
    along = Window.partitionBy("block").orderBy("doc_id", "text")
    inside = (
        known.withColumn("next_text", F.lead("text").over(along))
        .withColumn("is_last", F.lead("doc_id").over(along).isNull())
        .withColumn("is_first", F.row_number().over(along) == 1)
    )
    heads = inside.where("is_first").select(F.col("block").alias("head_block"), F.col("text").alias("head_text"))
    after = successors(stored(known.select("block").distinct(), "blocks"), "block")
    heads = heads.join(after, heads["head_block"] == after["following"]).select(F.col("block").alias("into"), "head_text")
    inside = inside.withColumn("sketch", sketch(F.col("text"), k)).withColumn("next_sketch", F.lead("sketch").over(along))
    linked = inside.join(heads, (inside["block"] == heads["into"]) & F.col("is_last"), "left")
    last = F.col("is_last")
    joined = linked.select(
        "doc_id", "text", "sketch",
        F.when(last, F.col("head_text")).otherwise(F.col("next_text")).alias("next_text"),
        F.when(last, sketch(F.col("head_text"), k)).otherwise(F.col("next_sketch")).alias("next_sketch"),
    )
    alone = placed.where("doc_id is null").select("doc_id", "text", sketch(F.col("text"), k).alias("sketch"))
    return joined.unionByName(alone, allowMissingColumns=True)


def successors(numbers: DataFrame, name: str, wide: int = 1024) -> DataFrame:
    """name, following: the next larger of these different numbers; the smallest for the largest.

    Windows run over groups of at most ``wide`` numbers: neighbours first, then groups of groups, up
    to one group of all.
    """
    low, high = numbers.agg(F.min(name), F.max(name)).first()
    low, high = low or 0, high or 0
    level, span, levels = numbers.select((F.col(name) - F.lit(low)).alias("at")), high - low, []
    while True:
        along = Window.partitionBy("up").orderBy("at")
        levels.append(level.withColumn("up", F.expr(f"at div {wide}")).withColumn("next", F.lead("at").over(along)))
        if span < wide:
            break
        level, span = level.select(F.expr(f"at div {wide}").alias("at")).distinct(), span // wide
    found = levels.pop().select("at", F.col("next").alias("following"))
    for lower in reversed(levels):
        # The last of a group goes on with the first of the next group.
        firsts = lower.groupBy("up").agg(F.min("at").alias("first"))
        onward = found.join(firsts, found["following"] == firsts["up"]).select(F.col("at").alias("group"), "first")
        found = lower.join(onward, lower["up"] == onward["group"], "left").select("at", F.coalesce("next", "first").alias("following"))
    return found.select((F.col("at") + F.lit(low)).alias(name), (F.coalesce("following", F.lit(0)) + F.lit(low)).alias("following"))


def edited(text: Column, following: Column) -> Column:
    """The text with its last half replaced by as much of the start of the next one."""
    half = F.floor(F.char_length(text) / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.char_length(text) - half), F.substring(F.coalesce(following, F.lit("")), F.lit(1), half))


def report(docs: DataFrame, id: str = "doc_id", text: str = "text", k: int = K) -> DataFrame:
    """Per document: its sketch beside those of its edited text and of the next document."""
    rows = following(id_and_text(docs, id, text), k).withColumn("edited", edited(F.col("text"), F.col("next_text")))
    rows = rows.withColumn("edited_sketch", sketch(F.col("edited"), k))
    own, other = F.col("sketch"), F.col("edited_sketch")
    return rows.select(
        "doc_id",
        F.char_length("text").cast("long").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        written(own).alias("fingerprint"),
        written(other).alias("edited_fingerprint"),
        resemblance(own, other, k).alias("near_edited"),
        resemblance(own, F.col("next_sketch"), k).alias("near_next"),
        containment(own, other, k).alias("contained_in_edited"),
        distinct_shingles(own, k).alias("n_shingles"),
    )
