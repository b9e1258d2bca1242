"""Did a message lead to a reply or a spend before a rival campaign spoke?

For each message: the first response and the first spend strictly after it, credited
only if no message of a rival campaign lies strictly after the message and at or before
that event. Messages of the same campaign never compete with each other.

All campaigns, responses and spends are one set of rows, sorted once into ranges and walked once
(``ranges``); no row is joined with another, however hot a key or bursty a feed.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldbook.functions.clock import micros
from fieldbook.operators.ranges import MICROS, later_minima

RESULT_COLUMNS = (
    "responded", "response_id", "channel", "used", "spend_id", "used_on", "creation_type",
)


def attribute(
    messages: DataFrame,
    responses: DataFrame,
    spends: DataFrame,
    *,
    key: str,
    ts: str,
    campaign: str,
    id: str,
    campaigns: Sequence[str],
    rivals: Mapping[str, Sequence[str]] | None = None,
    horizon: dt.timedelta | None = None,
) -> DataFrame:
    """Messages plus ``RESULT_COLUMNS``; one output row per message.

    ``responses`` needs (key, ts, id, channel) and ``spends`` (key, ts, id, used_on,
    creation_type). ``rivals`` maps a campaign to the campaigns that can take its
    credit away; by default all the others, an empty list means no exclusion. With ``horizon`` an event
    counts only up to so long after the message.
    """
    found, rival, sent = _met(messages, responses, spends, key, ts, campaign, id, campaigns, rivals)
    limit = _limit(sent, horizon)
    return found.select(
        "_message.*",
        *_credit("_response", rival, limit, "responded", "response_id", ["channel"]),
        *_credit("_spend", rival, limit, "used", "spend_id", ["used_on", "creation_type"]),
    )


OPEN = ("reply_open", "spend_open")


def carry_on(
    carried: DataFrame | None,
    messages: DataFrame,
    responses: DataFrame,
    spends: DataFrame,
    *,
    until: dt.datetime,
    key: str,
    ts: str,
    campaign: str,
    id: str,
    campaigns: Sequence[str],
    rivals: Mapping[str, Sequence[str]] | None = None,
    horizon: dt.timedelta | None = None,
) -> DataFrame:
    """The next stretch of time, up to ``until``: messages plus ``RESULT_COLUMNS`` and ``OPEN``.

    ``carried`` are the rows of the stretch before that are still open (None at first). A side of a message, reply or spend, is
    closed once its first event was met, a rival spoke, or no later event can lie within ``horizon``; what is closed
    never changes. So stretches in the order of time give the answer that one run over all of them gives, and a
    run reads its own events and the open messages only. The inputs must hold every row of the stretch and none of another.
    """
    kinds = _result_types(responses, spends, id)
    fresh = {"responded": False, "used": False, **dict.fromkeys(OPEN, True)}
    rows = messages.select("*", F.struct(*[F.lit(fresh.get(c)).cast(kind).alias(c) for c, kind in kinds.items()]).alias("_before"))
    if carried is not None:
        known = F.struct(*[F.col(c).cast(kind).alias(c) for c, kind in kinds.items()]).alias("_before")
        rows = carried.select(*messages.columns, known).unionByName(rows)
    found, rival, sent = _met(rows, responses, spends, key, ts, campaign, id, campaigns, rivals)
    limit = _limit(sent, horizon)
    end = F.lit(int((until - dt.datetime(1970, 1, 1)) / dt.timedelta(microseconds=1)))
    before = F.col("_message._before")

    def side(name: str, open_name: str, flag: str, id_name: str, payload: Sequence[str]) -> list[Column]:
        was_open = before[open_name]
        now = _credit(name, rival, limit, flag, id_name, payload)
        told = [F.when(was_open, value).otherwise(before[c]).alias(c) for c, value in zip((flag, id_name, *payload), now, strict=True)]
        # A message without a key meets nothing, ever.
        still = was_open & F.col(f"{name}.us").isNull() & rival.isNull() & (limit >= end) & F.col("_message")[key].isNotNull()
        return [*told, F.coalesce(still, F.lit(False)).alias(open_name)]

    return found.select(
        *[F.col("_message")[c].alias(c) for c in messages.columns],
        *side("_response", "reply_open", "responded", "response_id", ["channel"]),
        *side("_spend", "spend_open", "used", "spend_id", ["used_on", "creation_type"]),
    ).select(*messages.columns, *RESULT_COLUMNS, *OPEN)


def _result_types(responses: DataFrame, spends: DataFrame, id: str) -> dict[str, T.DataType]:
    of = {
        "response_id": responses.schema[id], "channel": responses.schema["channel"], "spend_id": spends.schema[id],
        "used_on": spends.schema["used_on"], "creation_type": spends.schema["creation_type"],
    }
    return {c: of[c].dataType if c in of else T.BooleanType() for c in (*RESULT_COLUMNS, *OPEN)}


def _met(messages, responses, spends, key, ts, campaign, id, campaigns, rivals) -> tuple[DataFrame, Column, Column]:
    """Each message with the first response and spend after it; the time of its first rival, and its own."""
    if rivals is None:
        rivals = {c: [o for o in campaigns if o != c] for c in campaigns}
    rows = messages.select(
        F.col(key), F.col(ts).alias("_ts"), F.col(campaign).alias("_campaign"),
        F.struct(*[F.col(c) for c in messages.columns]).alias("_message"),
    )
    rows = rows.unionByName(_event_rows(responses, key, ts, "_response", id, ["channel"]), True)
    rows = rows.unionByName(
        _event_rows(spends, key, ts, "_spend", id, ["used_on", "creation_type"]), True
    )
    found = later_minima(
        rows, key=key, ts="_ts", marks=_marks(campaigns), keep=["_campaign", "_message"],
        only=F.col("_message").isNotNull(),
    )
    return found, _first_rival(campaigns, rivals), micros(F.col("_message")[ts])


def _limit(sent: Column, horizon: dt.timedelta | None) -> Column:
    """The last microsecond at which an event still counts."""
    return F.lit(2**63 - 1) if horizon is None else sent + F.lit(int(horizon / dt.timedelta(microseconds=1)))


def _event_rows(
    df: DataFrame, key: str, ts: str, name: str, id: str, payload: Sequence[str]
) -> DataFrame:
    return df.where(F.col(key).isNotNull()).select(
        F.col(key), F.col(ts).alias("_ts"), F.col(id).alias("_id"),
        F.struct(F.col(id).alias("id"), *[F.col(p) for p in payload]).alias(name),
    )


def _marks(campaigns: Sequence[str]) -> dict[str, Column]:
    """What is minimised over later rows: two payload structs and one time per campaign."""
    marks = {
        name: F.when(
            F.col(name).isNotNull(), F.struct(F.col(MICROS).alias("us"), F.col(name).alias("e"))
        )
        for name in ("_response", "_spend")
    }
    for i, name in enumerate(campaigns):
        marks[f"_c{i}"] = F.when(F.col("_campaign") == name, F.col(MICROS))
    return marks


def _first_rival(
    campaigns: Sequence[str], rivals: Mapping[str, Sequence[str]]
) -> Column:
    """Time of the first rival message after this one, NULL when there is none."""

    def step(chain: Column, name: str) -> Column:
        times = [F.col(f"_c{campaigns.index(r)}") for r in rivals.get(name, ())]
        earliest = F.least(*times) if len(times) > 1 else (times or [F.lit(None).cast("long")])[0]
        return F.when(F.col("_campaign") == name, earliest).otherwise(chain)

    return reduce(step, campaigns, F.lit(None).cast("long"))


def _credit(
    name: str, rival: Column, limit: Column, flag: str, id_name: str, payload: Sequence[str]
) -> list[Column]:
    us = F.col(f"{name}.us")
    ok = us.isNotNull() & (rival.isNull() | (us < rival)) & (us <= limit)
    return [
        F.coalesce(ok, F.lit(False)).alias(flag),
        F.when(ok, F.col(f"{name}.e.id")).alias(id_name),
        *[F.when(ok, F.col(f"{name}.e.{p}")).alias(p) for p in payload],
    ]
