"""Small shared shapes: gap counts, joined name lists, rejected rows."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldbook.functions.text import pick


def coverage_gaps(rows: DataFrame, *, entity: str, order: list[str], group: str, covered: Column) -> DataFrame:
    """Entities without cover per group; groups without a gap are kept with 0.

    Each entity is judged once, by its first row, and counted in the group of that row. Rows
    are reduced to one per (entity, group) first; the window then compares the few groups of
    an entity.
    """
    position = F.struct(*[F.col(c) for c in order])
    per_group = rows.groupBy(entity, group).agg(
        F.min(position).alias("_at"), F.min_by(covered, position).alias("_covered")
    )
    is_first = F.col("_at") == F.min("_at").over(Window.partitionBy(entity))
    judged = per_group.select(group, (is_first & ~F.col("_covered")).alias("_gap"))
    return judged.groupBy(group).agg(F.count_if("_gap").alias("uncovered"))


def name_counts(df: DataFrame, key: str, name: str) -> DataFrame:
    """(key, name, times): how often each name occurs per key, NULL names skipped.

    One row per different name, however many a key has; combined on the map side.
    """
    return df.where(F.col(name).isNotNull()).groupBy(key, name).agg(F.count(F.lit(1)).alias("times"))


def names_text(counts: DataFrame, key: str, name: str, alias: str, separator: str = ",") -> DataFrame:
    """Rows of ``name_counts`` as one text per key: names ascending, each as often as it occurs.

    For publishing only: a text has to fit into one row, which ``name_counts`` need not.
    """
    entry = F.struct(
        F.col(name).alias("v"), F.expr(f"repeat(concat(`{name}`, '{separator}'), times)").alias("t")
    )
    entries = F.sort_array(F.collect_list(entry))
    text = F.array_join(F.transform(entries, lambda e: e["t"]), "")
    texts = counts.groupBy(key).agg(text.alias("_text"))
    return texts.select(key, F.expr(f"left(_text, length(_text) - {len(separator)})").alias(alias))


def joined_names(df: DataFrame, key: str, name: str, alias: str, separator: str = ",") -> DataFrame:
    """All names of a key joined in ascending order, repeats kept, NULLs skipped."""
    return names_text(name_counts(df, key, name), key, name, alias, separator)


def apply_codes(
    df: DataFrame, code: Column, mapping: Mapping[str, str], label: str,
    watch: Callable[[DataFrame, Mapping[str, Column]], DataFrame] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(rows with ``label``, rejected rows with ``reject_reason``): an unknown code never
    ends the run and never passes silently. ``watch`` sees all rows and what rejects them."""
    labelled = df.withColumn(label, pick(code.cast("string"), mapping))
    if watch is not None:
        labelled = watch(labelled, {f"unknown code for {label}": F.col(label).isNull()})
    accepted = labelled.where(F.col(label).isNotNull())
    rejected = labelled.where(F.col(label).isNull()).drop(label).withColumn(
        "reject_reason",
        F.concat(F.lit(f"unknown code for {label}: "), F.coalesce(code.cast("string"), F.lit("NULL"))),
    )
    return accepted, rejected


def reject_counts(rejected: DataFrame) -> DataFrame:
    return rejected.groupBy("reject_reason").agg(F.count(F.lit(1)).alias("rows"))
