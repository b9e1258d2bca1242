"""Message funnels: sent, responded, used, unique customers and rates per period."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldbook import vocabulary as v
from fieldbook.functions.clock import PERIOD_NAMES, Periods
from fieldbook.functions.text import pick

MEASURES = ("sent", "responded", "used", "unique_customers")


def rate(part: Column, whole: Column) -> Column:
    """Percentage with two decimals, rounded half up; 0 when there is nothing to divide by."""
    exact = (part.cast("decimal(18,0)") * F.lit(100)) / whole.cast("decimal(18,0)")
    return F.when(whole > 0, F.round(exact, 2)).otherwise(F.lit(0)).cast("decimal(18,2)")


def funnel(
    attributed: DataFrame,
    as_of: dt.date,
    *,
    column: Sequence[str],
    unique_by: str,
    first_touch: bool = False,
    sent_on: str = "sent_on",
    id: str = "id",
    periods: Sequence[str] = PERIOD_NAMES,
) -> DataFrame:
    """One row per (column, period).

    Rows are first reduced to one per (column, customer), which turns "distinct" into a
    plain sum and keeps a busy customer from travelling row by row. With ``first_touch`` a
    customer counts once per period, in the column of their first message of that period.
    """
    column = [column] if isinstance(column, str) else list(column)
    flags = {p: e for p, e in Periods(as_of).flags(F.col(sent_on)).items() if p in periods}
    rows = attributed.select(
        *column, F.col(unique_by).alias("_customer"), "responded", "used",
        F.struct(sent_on, id).alias("_position"),
        *[e.alias(f"_in_{p}") for p, e in flags.items()],
    )
    measures = []
    for p in periods:
        inside = F.col(f"_in_{p}")
        measures += [
            F.count_if(inside).alias(f"sent_{p}"),
            F.count_if(inside & F.col("responded")).alias(f"responded_{p}"),
            F.count_if(inside & F.col("used")).alias(f"used_{p}"),
        ]
        if first_touch:
            measures.append(F.min(F.when(inside, F.col("_position"))).alias(f"first_{p}"))
    per_customer = rows.groupBy(*column, "_customer").agg(*measures)

    if first_touch:
        # At most one row per customer and column, so this window is small by design.
        # The last column is the one compared; earlier ones separate whole campaigns.
        own = Window.partitionBy(*column[:-1], "_customer")
        firsts = [
            (F.col(f"first_{p}") == F.min(f"first_{p}").over(own)).alias(f"unique_customers_{p}")
            for p in periods
        ]
    else:
        firsts = [(F.col(f"sent_{p}") > 0).alias(f"unique_customers_{p}") for p in periods]
    counted = per_customer.select(
        *column, *firsts, *[f"{m}_{p}" for m in MEASURES[:3] for p in periods]
    )
    totals = counted.groupBy(*column).agg(
        *[F.sum(f"{m}_{p}").alias(f"{m}_{p}") for m in MEASURES[:3] for p in periods],
        *[F.count_if(F.col(f"unique_customers_{p}")).alias(f"unique_customers_{p}") for p in periods],
    )
    tall = totals.select(
        *column,
        F.explode(F.array(*[
            F.struct(F.lit(p).alias("period"), *[F.col(f"{m}_{p}").alias(m) for m in MEASURES])
            for p in periods
        ])).alias("_r"),
    ).select(*column, "_r.*")
    return tall.select(
        "*",
        rate(F.col("responded"), F.col("unique_customers")).alias("response_pct"),
        rate(F.col("used"), F.col("unique_customers")).alias("conversion_pct"),
    )


def flow_channel(flow: Column, after_visit: str, otherwise: str) -> Column:
    """Which desk the message speaks for, by its flow code."""
    return F.when(flow.isin(*v.AFTER_VISIT_FLOWS), after_visit).otherwise(otherwise)


def use_kind() -> Column:
    """What the cash was spent on; a first visit is anything that is not a follow-up."""
    used_on, creation = F.col("used_on"), F.col("creation_type")
    return (
        F.when((used_on == v.APPOINTMENT) & creation.eqNullSafe(v.FOLLOW_UP), v.USE_KINDS["follow_up"])
        .when(used_on == v.APPOINTMENT, v.USE_KINDS["new"])
        .otherwise(
            F.coalesce(
                pick(used_on, {
                    v.DIAGNOSTICS: v.USE_KINDS["diagnostics"],
                    v.LOYALTY: v.USE_KINDS["loyalty"],
                    v.SURGERY: v.USE_KINDS["surgery"],
                }),
                F.lit(v.USE_KINDS["other"]),
            )
        )
    )


def use_breakdown(
    attributed: DataFrame, as_of: dt.date, *, campaign: str = "campaign", sent_on: str = "sent_on"
) -> DataFrame:
    """Uses per campaign, kind of use and period, with a grand total per campaign."""
    flags = Periods(as_of).flags(F.col(sent_on))
    rows = attributed.where(F.col("used")).select(
        campaign, use_kind().alias("use_kind"), *[e.alias(p) for p, e in flags.items()]
    )
    return (
        rows.groupingSets([[campaign, "use_kind"], [campaign]], campaign, "use_kind")
        .agg(
            F.grouping("use_kind").alias("_all"),
            *[F.count_if(F.col(p)).alias(f"{p}_n") for p in flags],
        )
        .select(
            campaign,
            F.when(F.col("_all") == 1, v.USE_KINDS["total"]).otherwise(F.col("use_kind")).alias("use_kind"),
            *[F.col(f"{p}_n").alias(p) for p in flags],
        )
    )
