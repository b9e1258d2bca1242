"""Places and running totals in an order, also where one group holds a third of all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldbook.llm.common import once

PLACE, OF, AT, PART = "_place", "_of", "_at", "_part"


def before(name: str) -> str:
    return f"_before_{name}"


def total(name: str) -> str:
    return f"_total_{name}"


def placed(rows: DataFrame, group: str, order: Sequence[str], sums: Sequence[str] = ()) -> DataFrame:
    """``rows`` with their place in their group (from 0, by ``order``), the group's size, and for each of
    ``sums`` the total over the rows before and over the group.

    The rows are sorted as a whole, so a hot group lies in many partitions; places inside a partition come from the
    rows' ids there, and what lies before a partition from one row per group and partition. ``_at`` is unique
    to a row. ``rows`` are evaluated twice (range bounds, then sort), so store them first. ``group`` must not be
    null; ``order`` should tell all different rows apart.
    """
    ordered = once(rows.orderBy(group, *order).withColumn(AT, F.monotonically_increasing_id()), "ordered")
    ordered = ordered.withColumn(PART, F.shiftright(AT, 33))
    parts = ordered.groupBy(group, PART).agg(
        F.min(AT).alias("_first"), F.count("*").alias("_rows"), *[F.sum(s).alias(f"_sum_{s}") for s in sums]
    )
    whole = Window.partitionBy(group)
    earlier = whole.orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    parts = parts.select(
        group, PART, (F.coalesce(F.sum("_rows").over(earlier), zero) - F.col("_first")).alias("_shift"), F.sum("_rows").over(whole).alias(OF),
        *[F.coalesce(F.sum(f"_sum_{s}").over(earlier), zero).alias(f"_sum_{s}") for s in sums],
        *[F.sum(f"_sum_{s}").over(whole).alias(total(s)) for s in sums],
    )
    here = Window.partitionBy(group, PART).orderBy(AT).rowsBetween(Window.unboundedPreceding, -1)
    return ordered.join(parts, [group, PART]).select(
        *rows.columns, AT, OF, (F.col(AT) + F.col("_shift")).alias(PLACE),
        *[(F.col(f"_sum_{s}") + F.coalesce(F.sum(s).over(here), zero)).alias(before(s)) for s in sums],
        *[total(s) for s in sums],
    )
