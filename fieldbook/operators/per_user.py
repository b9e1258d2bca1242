"""Transactions per distinct user, by period and kind of user."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OVERALL = "overall"


def ratio(total: Column, users: Column) -> Column:
    exact = total.cast("decimal(18,0)") / users.cast("decimal(18,0)")
    return F.round(exact, 2).cast("decimal(18,2)")


def with_user_kind(
    tx: DataFrame, *, user: str, period: list[Column], marks_user: Column, marked: str, other: str
) -> DataFrame:
    """One row per (period, user) with its count ``n`` and the user's kind.

    A user is ``marked`` if any of their rows satisfies ``marks_user``. Rows are counted
    per (period, user) first, so the window that spreads the mark over a user's rows sees at
    most one row per period, even for the busiest user.
    """
    counts = tx.groupBy(*period, user).agg(
        F.count(F.lit(1)).alias("n"), F.max(F.coalesce(marks_user, F.lit(False))).alias("_m")
    )
    is_marked = F.max("_m").over(Window.partitionBy(user))
    return counts.withColumn("user_type", F.when(is_marked, marked).otherwise(other)).drop("_m")


def per_user(counts: DataFrame, *, user: str, period: list[str], user_type: str = "user_type") -> DataFrame:
    """Transactions ÷ distinct users for every (period, type) and overall.

    ``counts`` has one row per (period, user[, type]) with ``n``. Grouping sets over these
    rows keep a user who appears under two types from counting twice in the overall row.
    """
    by_user = (
        counts.groupingSets(
            [[*period, user_type, user], [*period, user]], *period, user_type, user
        )
        .agg(F.grouping(user_type).alias("_all"), F.sum("n").alias("n"))
    )
    label = F.when(F.col("_all") == 1, OVERALL).otherwise(F.col(user_type))
    return (
        by_user.groupBy(*period, label.alias(user_type))
        .agg(F.sum("n").alias("transactions"), F.count(F.lit(1)).alias("users"))
        .withColumn("per_user", ratio(F.col("transactions"), F.col("users")))
    )
