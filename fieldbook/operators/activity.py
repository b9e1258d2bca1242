"""Availability sessions: the next event of an agent closes the current one."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldbook.functions.clock import elapsed_seconds, instant
from fieldbook.operators.ranges import next_rows


def with_next_row(
    df: DataFrame,
    *,
    key: str,
    ts: str,
    id: str,
    values: Sequence[str],
    suffix: str = "_lead",
) -> DataFrame:
    """``<value>_lead`` of the following row per key in (ts, id) order; a row without a key has no following row.

    The rows are sorted into ranges and walked once (``ranges``), so a hot key lies in many tasks.
    """
    found = next_rows(df, key=key, ts=ts, id=id, name="_next", values=values, keep=df.columns)
    return found.select(*df.columns, *[F.col(f"_next.{v}").alias(f"{v}{suffix}") for v in values])


def active_seconds(
    df: DataFrame,
    *,
    agent: str,
    ts: str,
    id: str,
    value: str,
    reason: str,
    active: Column,
    as_of: dt.date,
) -> DataFrame:
    """Seconds until the next event, for active rows only.

    A session is open when the next row has no *value* (or there is no next row); it then
    ends at 23:59:59 of the day before ``as_of``.
    """
    led = with_next_row(df, key=agent, ts=ts, id=id, values=[ts, reason, value])
    close = instant(dt.datetime.combine(as_of - dt.timedelta(days=1), dt.time(23, 59, 59)))
    end = F.when(F.col(f"{value}_lead").isNull(), close).otherwise(F.col(f"{ts}_lead"))
    seconds = F.when(active, elapsed_seconds(F.col(ts), end))
    return led.withColumn("total_active_sec", seconds)
