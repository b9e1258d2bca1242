"""Similarity join of documents by their sets of word shingles, with a MinHash LSH forest.

1. Equal texts become one class; from here on a class counts once.
2. Each class has a MinHash signature, cut into ``TREES`` labels of ``DEEPEST`` values. The labels of one tree, sorted, are a
   prefix trie: classes that share a label's first ``d`` values lie below one node of depth ``d``, and are candidates there. Matching
   begins at the deepest level. The number of trees in which two classes meet tells how many pairs no tree has brought
   together yet (``unseen``); while the recall so estimated is below ``RECALL``, prefixes are shortened by one value and the
   next level is matched. They are never shorter than ``prefix_length``, at which pairs of just the wanted similarity meet
   with the target probability (5 values and 0.9996 with the defaults), so on few or doubtful matches the search goes down to there.
3. Classes below a node are linked to its smallest one, which joins candidates into clusters without
   ever forming pairs.
4. Within a cluster all pairs are verified exactly, from the whole shingle sets. Large clusters are cut into
   blocks and every pair of blocks is one task, so no task grows with the cluster. A task
   returns each class's number of links and the least class it hangs together with, not the pairs.
5. Classes that hang together by links form a group, named by its least id.

Shingles are ``SHINGLE`` words between ASCII white space; a text of fewer words has one shingle of all. Texts are linked if
their sets' Jaccard similarity is ``SIMILARITY`` or more, and if they are equal (also both empty).

Null texts count as empty. Repeated rows are copies of each other. A row without an id is given back
with null group and no links and links nothing. Other columns are left out.

Verifying a group takes time with the square of its different texts, as the number of links may do; it is
spread over block pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldbook.llm.common import free_names, hashed_words, id_and_text, slices
from fieldbook.llm.components import components
from fieldbook.session import split_skewed_joins, stored

SHINGLE = 5
SIMILARITY = 0.8
TREES = 20
DEEPEST = 8
RECALL = 0.9995
BLOCK_TEXTS = 512
BLOCK_SHINGLES = 1_000_000
STEP = 4096

MIX = np.random.default_rng(20240601).integers(1, 2**63, (2, TREES * DEEPEST + SHINGLE + 2), dtype=np.uint64) | np.uint64(1)


def prefix_length(similarity: float = SIMILARITY, trees: int = TREES, deepest: int = DEEPEST, target: float = RECALL) -> int:
    """From the deepest level up, the first at which a pair so similar shares a node with the target probability."""
    return next((d for d in range(deepest, 1, -1) if 1 - (1 - similarity**d) ** trees >= target), 1)


def shingle_set(words: np.ndarray) -> np.ndarray:
    """Different shingle hashes, sorted, of a text given as its words' hashes."""
    words = words.view(np.uint64)
    n = len(words)
    if not n:
        return words
    size = min(n, SHINGLE)
    hashes = np.full(n - size + 1, size, np.uint64) * MIX[1, -1]
    for i in range(size):
        hashes += words[i : n - size + 1 + i] * MIX[0, -1 - i]
        hashes ^= hashes >> np.uint64(29)
    hashes *= MIX[1, -2]
    return np.unique(hashes ^ (hashes >> np.uint64(32)))


def label(shingles: np.ndarray) -> np.ndarray:
    """For each tree its label as two numbers: 16 bits of each of the eight values, the first value's on top."""
    used = np.arange(TREES * DEEPEST)
    factor, salt = MIX[0, used], MIX[1, used]
    least = np.full(len(used), np.iinfo(np.uint64).max)
    for start in range(0, len(shingles), STEP):
        least = np.minimum(least, ((shingles[start : start + STEP, None] ^ salt) * factor).min(0))
    least *= MIX[1, -3]
    values = (least >> np.uint64(48)).reshape(TREES, 2, 4)
    numbers = values[:, :, 0] << np.uint64(48) | values[:, :, 1] << np.uint64(32) | values[:, :, 2] << np.uint64(16) | values[:, :, 3]
    return numbers.ravel().view(np.int64)


def prefix(depth: int) -> tuple[str, str]:
    """SQL for the first ``depth`` values of a label (high, low)."""
    def top(name: str, values: int) -> str:
        return "0L" if values <= 0 else name if values >= 4 else f"shiftright({name}, {64 - 16 * values})"

    return top("high", depth), top("low", depth - 4)


def text_key(text: Column) -> Column:
    """32 hexadecimal digits; equal for equal texts."""
    return F.md5(text.cast("binary"))


def lists(column: pa.Array) -> list[np.ndarray]:
    ends, values = column.offsets.to_numpy(), column.values.to_numpy(zero_copy_only=False)
    return [values[a:b] for a, b in zip(ends, ends[1:], strict=False)]


def labelled(texts: DataFrame) -> DataFrame:
    """doc_id, text_key, labels (two numbers a tree; empty without shingles), n_shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sets = [shingle_set(words) for words in lists(batch.column(2))]
            labels = [label(s) if len(s) else np.empty(0, np.int64) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(labels, pa.list_(pa.int64())), pa.array(list(map(len, sets)), pa.int64())],
                ["doc_id", "text_key", "labels", "n_shingles"],
            )

    words = texts.select("doc_id", text_key(F.col("text")).alias("text_key"), hashed_words(F.col("text")).alias("words"))
    return words.mapInArrow(run, "doc_id long, text_key string, labels array<long>, n_shingles long")


def forest_edges(classes: DataFrame, depth: int) -> DataFrame:
    """(a, b, trees): classes below a node of this depth, with the smallest class there, and in how many trees. ``classes``: node, labels."""
    high, low = prefix(depth)
    leaves = classes.where(F.size("labels") > 0).select(
        "node", F.explode(F.expr("transform(sequence(0, size(labels) - 2, 2), t -> named_struct('tree', t, 'high', labels[t], 'low', labels[t + 1]))")).alias("l")
    ).select("node", "l.*").selectExpr("node", "tree", f"{high} as high", f"{low} as low")
    place = ["tree", "high", "low"]
    nodes = leaves.groupBy(*place).agg(F.min("node").alias("b"), F.count("*").alias("n")).where("n > 1")
    met = leaves.join(nodes.drop("n"), place).select(F.col("node").alias("a"), "b").where("a <> b")
    return met.groupBy("a", "b").agg(F.count("*").alias("trees"))


def unseen(pairs: int, once: int, twice: int) -> float:
    """How many pairs share no node, judged by those that share one and two: the usual estimate of unseen kinds (squares of
    singletons over doubletons), with one more of each, so that few pairs prove nothing."""
    return (once + 1) ** 2 / (2 * (twice + 1)) if pairs else float("inf")


def candidates(classes: DataFrame) -> DataFrame:
    """(a, b): prefixes matched from the deepest level up, until the estimated recall is reached."""
    for depth in range(DEEPEST, prefix_length() - 1, -1):
        edges = stored(forest_edges(classes, depth), f"level-{depth}")
        pairs, once, twice = edges.agg(F.count("*"), F.count_if(F.col("trees") == 1), F.count_if(F.col("trees") == 2)).first()
        if pairs >= RECALL * (pairs + unseen(pairs, once, twice)):
            break
    return edges.select("a", "b")


def with_blocks(members: DataFrame) -> DataFrame:
    """Members of clusters (node, component, n_shingles, ...) with their block, repeated for each pair of blocks it is in."""
    sizes = members.groupBy("component").agg(
        F.greatest(F.ceil(F.count("*") / BLOCK_TEXTS), F.ceil(F.sum("n_shingles") / BLOCK_SHINGLES)).cast("int").alias("blocks")
    )
    dealt = members.join(sizes, "component").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    return dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "*", F.least("block", "other").alias("row"), F.greatest("block", "other").alias("column")
    ).drop("other", "blocks")


VERIFIED = "node long, links long, hook long"


def linked(sets: list[np.ndarray], others: list[np.ndarray] | None = None) -> np.ndarray:
    """Which of the sets are similar enough, among themselves or with the others: a matrix of booleans."""
    every = sets + (others or [])
    sizes = np.array(list(map(len, every)))
    owner = np.repeat(np.arange(len(every)), sizes)
    _, column, count = np.unique(np.concatenate(every), return_inverse=True, return_counts=True)
    shared = count[column] > 1
    owner, column = owner[shared], np.unique(column[shared], return_inverse=True)[1]
    n, m = len(sets), len(others) if others is not None else len(sets)
    common = np.zeros((n, m), np.float32)
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    for start in range(0, int(column[-1]) + 1 if len(column) else 0, 2048):
        low, high = np.searchsorted(column, (start, start + 2048))
        has = np.zeros((len(every), min(2048, int(column[-1]) + 1 - start)), np.float32)
        has[owner[low:high], column[low:high] - start] = 1
        common += has[:n] @ (has[n:] if others is not None else has).T
    either = sizes[:n, None] + (sizes[n:] if others is not None else sizes)[None, :] - common
    return common >= SIMILARITY * either - 1e-6


def verify(table: pa.Table) -> pa.Table:
    """Links among one pair of blocks of a cluster."""
    rows = {}
    for node, block, copies, words in zip(
        *[table.column(name).to_pylist() for name in ("node", "block", "copies")], lists(table.column("words").combine_chunks()), strict=True
    ):
        if node not in rows:  # a repeated document comes more than once
            rows[node] = (block, copies, shingle_set(words))
    nodes = np.array(sorted(rows), np.int64)
    block = np.array([rows[n][0] for n in nodes])
    copies = np.array([rows[n][1] for n in nodes], np.int64)
    sets = [rows[n][2] for n in nodes]
    first, second = int(table.column("row")[0].as_py()), int(table.column("column")[0].as_py())
    links, hook = np.zeros(len(nodes), np.int64), nodes.copy()
    if first == second:
        near = linked(sets)
        np.fill_diagonal(near, False)
        sides = [(np.arange(len(nodes)), np.arange(len(nodes)), near)]
    else:
        here, there = np.flatnonzero(block == first), np.flatnonzero(block == second)
        near = linked([sets[i] for i in here], [sets[i] for i in there]) if len(here) and len(there) else np.zeros((len(here), len(there)), bool)
        sides = [(here, there, near), (there, here, near.T)]
    for mine, others, matrix in sides:
        links[mine] += (matrix * copies[others]).sum(1)
    while True:  # the least node each hangs together with
        new = hook.copy()
        for mine, others, matrix in sides:
            if matrix.size:
                least = np.where(matrix, hook[others], np.iinfo(np.int64).max).min(1)
                new[mine] = np.minimum(new[mine], least)
        if (new == hook).all():
            break
        hook = new
    return pa.table({"node": nodes, "links": links, "hook": hook})


def join(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, text_key, group_id, copies, n_links: one row per document.

    ``group_id`` is the least id of the documents that hang together by links, ``copies`` the number of documents with
    the same text, ``n_links`` the number of other documents similar enough, copies included.
    """
    split_skewed_joins(docs.sparkSession)
    texts = id_and_text(docs, id, text)
    known = texts.where("doc_id is not null")
    rows = stored(labelled(known), "signatures")
    classes = rows.groupBy("text_key").agg(
        F.min("doc_id").alias("first_id"), F.count("*").alias("copies"), F.max("n_shingles").alias("n_shingles"), F.first("labels").alias("labels")
    )
    # Numbers written once are the same for every later reader.
    classes = stored(classes.select(F.monotonically_increasing_id().alias("node"), "*"), "classes")
    clusters = components(candidates(classes))
    members = with_blocks(classes.drop("labels").join(clusters, "node"))
    found = known.select("doc_id", text_key(F.col("text")).alias("text_key"), F.col("text"))
    sets = found.join(
        members, (found["text_key"] == members["text_key"]) & (found["doc_id"] == members["first_id"])
    ).select("component", "row", "column", "node", "block", "copies", hashed_words(F.col("text")).alias("words"))
    checked = stored(sets.groupBy("component", "row", "column").applyInArrow(verify, VERIFIED), "links")
    links = checked.groupBy("node").agg(F.sum("links").alias("links"))
    groups = components(checked.select(F.col("node").alias("a"), F.col("hook").alias("b")))
    grouped = classes.select("node", "text_key", "first_id", "copies").join(links, "node", "left").join(groups, "node", "left")
    grouped = stored(grouped.withColumn("component", F.coalesce("component", "node")), "grouped")
    named = grouped.groupBy("component").agg(F.min("first_id").alias("group_id"))
    told = grouped.join(named, "component").select(
        "text_key", "group_id", "copies", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")
    )
    per_row = rows.select("doc_id", "text_key").join(told, "text_key")
    alone = texts.where("doc_id is null").select(
        "doc_id", text_key(F.col("text")).alias("text_key"), F.lit(None).cast("long").alias("group_id"), F.lit(1).cast("long").alias("copies"),
        F.lit(0).cast("long").alias("n_links"),
    )
    return per_row.select("doc_id", "text_key", "group_id", "copies", "n_links").unionByName(alone)


def one_of_each(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents, all columns, without all but one of each group: the one with the least id (then text key) stays.

    Rows without an id stay.
    """
    told = stored(join(docs, id, text), "groups").where("doc_id is not null")
    first = told.groupBy("group_id").agg(F.min(F.struct("doc_id", "text_key")).alias("kept")).select("kept.*")
    own, kept_id, kept_key, repeated = free_names(docs, "own_key", "kept_id", "kept_key", "repeated")
    kept = told.join(first, ["doc_id", "text_key"]).groupBy("doc_id", "text_key").agg((F.count("*") > 1).alias(repeated))
    kept = kept.select(F.col("doc_id").alias(kept_id), F.col("text_key").alias(kept_key), repeated)
    keyed = docs.withColumn(own, text_key(F.coalesce(F.col(text).cast("string"), F.lit(""))))
    staying = keyed.join(kept, (keyed[id].cast("long") == kept[kept_id]) & (keyed[own] == kept[kept_key]))
    once = staying.where(~F.col(repeated)).unionByName(staying.where(F.col(repeated)).dropDuplicates([kept_id, kept_key]))
    return once.select(*docs.columns).unionByName(docs.where(F.col(id).isNull()))
