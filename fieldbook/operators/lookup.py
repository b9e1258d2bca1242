"""Keyed lookups: first, latest, last informative, prioritised, routed, multi-slot.

"First" and "latest" are ``min_by`` / ``max_by`` aggregates rather than windows: they
combine on the map side, so a hot key never gathers its rows in one task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_HIT = "_hit"


def _names(keys: str | Sequence[str]) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def _order(order: str | Sequence[str]) -> Column:
    return F.struct(*[F.col(c) for c in _names(order)])


def first_per_key(
    df: DataFrame, keys: str | Sequence[str], order: str | Sequence[str], values: Sequence[str]
) -> DataFrame:
    """Values of the first row per key; fields of that row may be NULL."""
    picked = F.min_by(F.struct(*values), _order(order)).alias("_v")
    return df.groupBy(*_names(keys)).agg(picked).select(*_names(keys), "_v.*")


def latest_per_key(
    df: DataFrame, keys: str | Sequence[str], order: str | Sequence[str], values: Sequence[str]
) -> DataFrame:
    picked = F.max_by(F.struct(*values), _order(order)).alias("_v")
    return df.groupBy(*_names(keys)).agg(picked).select(*_names(keys), "_v.*")


def last_informative(
    df: DataFrame, keys: str | Sequence[str], order: str | Sequence[str], value: str, blank: str
) -> DataFrame:
    """Last value other than ``blank``; ``blank`` for a key that has no other."""
    informative = F.when(F.col(value) != blank, _order(order))
    picked = F.coalesce(F.max_by(F.col(value), informative), F.lit(blank))
    return df.groupBy(*_names(keys)).agg(picked.alias(value))


def by_priority(
    sources: Sequence[DataFrame],
    keys: str | Sequence[str],
    order: str | Sequence[str],
    values: Sequence[str],
) -> DataFrame:
    """First row per key over several sources; an earlier source always wins."""
    merged = None
    for rank, source in enumerate(sources):
        ranked = source.select(*_names(keys), *_names(order), *values).withColumn(
            "_rank", F.lit(rank)
        )
        merged = ranked if merged is None else merged.unionByName(ranked)
    return first_per_key(merged, keys, ["_rank", *_names(order)], values)


def left_lookup(
    df: DataFrame,
    dim: DataFrame,
    on: str | Sequence[str],
    defaults: Mapping[str, str | None] | None = None,
) -> DataFrame:
    """Left join to a unique-key table. A hit keeps its NULLs, a miss gets the defaults."""
    defaults = defaults or {}
    joined = df.join(dim.withColumn(_HIT, F.lit(True)), on, "left")
    columns = []
    for name in joined.columns:
        if name == _HIT:
            continue
        if defaults.get(name) is not None:
            kept = F.when(F.col(_HIT).isNull(), F.lit(defaults[name])).otherwise(F.col(name))
            columns.append(kept.alias(name))
        else:
            columns.append(F.col(name))
    return joined.select(*columns)


def flag_present(df: DataFrame, keys: DataFrame, on: str, flag: str) -> DataFrame:
    """TRUE where the key occurs in ``keys``, which may repeat it any number of times."""
    known = keys.select(on).where(F.col(on).isNotNull()).distinct().withColumn(flag, F.lit(True))
    return df.join(known, on, "left").withColumn(flag, F.coalesce(flag, F.lit(False)))


def restrict_to(df: DataFrame, keys: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Rows whose key occurs in ``keys``; the key list never visits the driver.

    Keys are made distinct first: that combines on the map side, so a key repeated in a
    large share of ``keys`` does not load one task.
    """
    return df.join(keys.select(*_names(on)).distinct(), on, "left_semi")


def without_match(df: DataFrame, keys: DataFrame, on: str | Sequence[str]) -> DataFrame:
    return df.join(keys.select(*_names(on)).distinct(), on, "left_anti")


def multi_slot_lookup(
    df: DataFrame,
    dim: DataFrame,
    *,
    slots: Mapping[str, str],
    dim_key: str,
    values: Sequence[str],
    default: str = "",
    route: Column | None = None,
    dim_route: str | None = None,
    row_id: str | None = None,
) -> DataFrame:
    """Look several key columns up in one unique-key table.

    ``slots`` maps a prefix to a key column; the result has ``<prefix>_<value>`` for each
    pair. With ``route`` the key is (route, number), so a row value decides which part of
    ``dim`` is searched.

    Without ``row_id`` this is one left join per slot: no shuffle while ``dim`` is below
    Spark's broadcast threshold. With ``row_id`` (unique) the non-empty slots are unpivoted
    and joined once as narrow rows, which is the cheaper shape for a large ``dim``.
    """
    dim_cols = [dim_key, *([dim_route] if dim_route else []), *values]
    table = dim.select(*dim_cols)
    if row_id is None:
        out = df
        for prefix, column in slots.items():
            side = table.select(
                F.col(dim_key).alias("_k"),
                *([F.col(dim_route).alias("_r")] if dim_route else []),
                *[F.col(c).alias(f"{prefix}_{c}") for c in values],
            )
            on = F.col(column) == F.col("_k")
            if dim_route:
                on = on & (route == F.col("_r"))
            out = out.join(side, on, "left").drop("_k", "_r")
        return out.fillna(default, [f"{p}_{c}" for p in slots for c in values])

    legs = df.select(
        F.col(row_id).alias("_id"),
        *([route.alias("_r")] if dim_route else []),
        F.explode(
            F.array(*[
                F.struct(F.lit(p).alias("p"), F.col(c).cast("string").alias("k"))
                for p, c in slots.items()
            ])
        ).alias("_leg"),
    ).where(F.col("_leg.k").isNotNull())
    side = table.withColumn("_k", F.col(dim_key).cast("string"))
    on = F.col("_leg.k") == F.col("_k")
    if dim_route:
        on = on & (F.col("_r") == F.col(dim_route))
    hits = legs.join(side, on, "inner")
    wide = hits.groupBy("_id").agg(*[
        F.max(F.when(F.col("_leg.p") == p, F.col(c))).alias(f"{p}_{c}")
        for p in slots for c in values
    ])
    out = df.join(wide, F.col(row_id) == F.col("_id"), "left").drop("_id")
    return out.fillna(default, [f"{p}_{c}" for p in slots for c in values])
