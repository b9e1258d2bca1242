"""A manifest of a dataset as a Merkle tree, with a proof for every document.

A leaf is the hash of a row. The leaves of a source, by id, form a tree of a fixed fanout; the sources' roots,
by name, form a tree above them. A level is made by a slot pivot: children are numbered, one
aggregate per parent spreads them into ``fanout`` columns, the columns' concatenation is hashed to the parent, and
the columns other than a child's own are its siblings. On the way down every parent hands its proof to its children.

Every level is a third of the one before and is written before the next one is made, so a lost executor
costs at most a level. All steps are keyed by (source, parent), so a hot source is no hot key; its
leaves are numbered by a sort over all rows. Nothing but the size of the largest source reaches the driver.

Null values are hashed as ``-``. Rows without an id come first in their source; repeated rows are leaves of
their own, in the order of their hashes. Null and empty texts, ids and sources differ. Without rows the
manifest is empty. Only the five hashed columns are read, so others may have any name.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldbook.llm.common import once
from fieldbook.llm.ordered import OF, PLACE, placed

FANOUT = 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
GROUP, HASH, PROOF, TOP, LEVEL = "_group", "_hash", "_proof", "_top", "_level"
NO_PROOF = "array<struct<before:string,after:string>>"


def digest(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def leaf(values: Mapping[str, Column]) -> Column:
    """The hash of a row: each value with its length in bytes before it, so that no two rows look the same."""
    def part(value: Column) -> Column:
        text = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return digest(F.concat(*[part(values[name]) for name in FIELDS]))


def manifest(docs: DataFrame, carry: Mapping[str, Column] | None = None, fanout: int = FANOUT) -> DataFrame:
    """doc_id, source, leaf, subroot, root and ``proof``: per level from the leaf up, what stands before and after the node.

    ``carry`` names further columns of ``docs`` to hand through.
    """
    carry = dict(carry or {})
    values = {name: F.col(name) for name in FIELDS}
    # Null comes before every name, also before the empty one.
    group = F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit(""))
    leaves = once(docs.select(
        group.alias(GROUP), leaf(values).alias(HASH), F.monotonically_increasing_id().alias("_row"), F.col("doc_id"),
        *[expr.alias(name) for name, expr in carry.items()],
    ), "leaves")
    kept = ("doc_id", *carry)
    trees = _levels(placed(leaves, GROUP, ["doc_id", HASH, "_row"]), kept, fanout)
    subroots = _tops(trees, fanout).select(F.lit("").alias(GROUP), F.col(GROUP).alias("_name"), LEVEL, F.col(TOP).alias(HASH))
    above = _levels(placed(once(subroots, "subroots"), GROUP, ["_name"]), ("_name", LEVEL), fanout)
    starts = _descend(above, _tops(above, fanout).withColumn(PROOF, F.array().cast(NO_PROOF)), ("_name", LEVEL), (TOP,), fanout)
    starts = once(starts.select(
        F.col("_name").alias(GROUP), LEVEL, PROOF, F.col(HASH).alias("_subroot"), F.col(TOP).alias("_root")
    ), "sources")
    found = _descend(trees, starts, kept, ("_subroot", "_root"), fanout)
    name = F.when(F.col(GROUP) != "", F.expr(f"substring({GROUP}, 2)"))
    return found.select(
        "doc_id", name.alias("source"), F.col(HASH).alias("leaf"), F.col("_subroot").alias("subroot"), F.col("_root").alias("root"),
        F.col(PROOF).alias("proof"), *carry,
    )


def folded(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and its siblings lead to."""
    return F.aggregate(proof, leaf, lambda node, level: digest(F.concat(level["before"], node, level["after"])))


def siblings(proof: Column) -> Column:
    """All siblings from the leaf's level up, each level from left to right."""
    return F.array_join(F.transform(proof, lambda level: F.concat(level["before"], level["after"])), "")


def _slots(fanout: int) -> list[str]:
    return [f"_slot{k}" for k in range(fanout)]


def _levels(nodes: DataFrame, kept: Sequence[str], fanout: int) -> list[DataFrame]:
    """One table per level: a row per parent with its children in ``fanout`` columns; the leaves keep their columns.

    A group whose level has one node goes no further up; a lone leaf stands for its parent.
    """
    widest, made = nodes.agg(F.max(OF)).first()[0] or 0, []
    while True:
        slot = F.pmod(PLACE, F.lit(fanout))
        children = [
            F.max(F.when(slot == k, F.struct(F.col(HASH), *(kept if not made else ())))).alias(name)
            for k, name in enumerate(_slots(fanout))
        ]
        level = nodes.groupBy(GROUP, F.expr(f"{PLACE} div {fanout}").alias(PLACE)).agg(F.max(OF).alias(OF), *children)
        both = F.concat(*[F.coalesce(F.col(f"{name}.{HASH}"), F.lit("")) for name in _slots(fanout)])
        level = level.withColumn(HASH, F.when(F.col(OF) == 1, F.col(f"_slot0.{HASH}")).otherwise(digest(both)))
        made.append(once(level, "level"))
        if fanout ** len(made) >= widest:
            return made
        nodes = made[-1].where(F.col(OF) > fanout ** len(made))


def _tops(levels: Sequence[DataFrame], fanout: int) -> DataFrame:
    """The root of each group, and the level that its children are in."""
    found = None
    for k, level in enumerate(levels):
        top = level.where(F.col(OF) <= fanout ** (k + 1)).select(GROUP, F.lit(k).alias(LEVEL), F.col(HASH).alias(TOP))
        found = top if found is None else found.unionByName(top)
    return found


def _descend(
    levels: Sequence[DataFrame], tops: DataFrame, kept: Sequence[str], passed: Sequence[str], fanout: int
) -> DataFrame:
    """The leaves with their proofs. A parent's row has all children, so it makes their siblings without a further join."""
    down = None
    names = _slots(fanout)
    for k in reversed(range(len(levels))):
        above = tops.where(F.col(LEVEL) == k).select(GROUP, F.lit(0).cast("long").alias(PLACE), PROOF, *passed)
        above = above if down is None else down.select(*above.columns).unionByName(above)
        text = [F.coalesce(F.col(f"{name}.{HASH}"), F.lit("")) for name in names]
        children = F.array(*[
            F.struct(
                (F.col(PLACE) * fanout + i).alias(PLACE), F.col(name).alias("_node"),
                F.concat(F.lit(""), *text[:i]).alias("before"), F.concat(F.lit(""), *text[i + 1 :]).alias("after"),
            )
            for i, name in enumerate(names)
        ])
        rows = levels[k].join(above, [GROUP, PLACE]).select(
            GROUP, OF, PROOF, *passed, F.explode(F.filter(children, lambda c: c["_node"].isNotNull())).alias("_child")
        )
        own = F.array(F.struct(F.col("_child.before").alias("before"), F.col("_child.after").alias("after")))
        down = rows.select(
            GROUP, F.col(f"_child.{PLACE}").alias(PLACE), F.when(F.col(OF) == 1, F.col(PROOF)).otherwise(F.concat(own, PROOF)).alias(PROOF),
            *passed, F.col(f"_child._node.{HASH}").alias(HASH), *([F.col(f"_child._node.{c}").alias(c) for c in kept] if k == 0 else []),
        )
    return down
