"""Inbound calls: one wide row per call, and the feed of calls that dropped."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldbook import vocabulary as v
from fieldbook.functions.calls import final_status
from fieldbook.functions.clock import instant, office_hours
from fieldbook.functions.text import city_label, phone
from fieldbook.operators.documents import call_facts
from fieldbook.operators.lookup import (
    by_priority, first_per_key, last_informative, left_lookup, multi_slot_lookup, restrict_to,
)
from fieldbook.sources import schemas

LEGS = ("leg1", "leg2", "leg3")


def caller_cities(
    patient_cases: DataFrame,
    patients: DataFrame,
    customers: DataFrame,
    city: DataFrame,
    inbound: DataFrame | None = None,
    roles: v.Roles = v.ROLES,
) -> DataFrame:
    """City per caller number: the case's city, else the patient's; a known city beats none,
    and a later case beats an earlier one.

    With ``inbound`` (calls) the customers are cut down to its callers before their case
    history is joined and grouped.
    """
    known = customers.select("customer_id", phone(F.col("customer_number")).alias("customer_no"))
    if inbound is not None:
        callers = inbound.select(phone(F.col("from_no")).alias("customer_no"))
        known = restrict_to(known, callers, "customer_no")

    def named(alias: str) -> DataFrame:
        return city.select(F.col("id").alias(f"_{alias}"), F.col("city_name").alias(alias))

    # From the callers' customers to their patients to those patients' cases.
    rows = (
        known.where(F.col("customer_no").isNotNull())
        .join(
            patients.select(
                F.col("id").alias("patient_id"), "customer_id", F.col("city_id").alias("_home_city")
            ),
            "customer_id",
        )
        .join(
            patient_cases.select("case_id", "patient_id", F.col("city_id").alias("_case_city")),
            "patient_id",
        )
        .join(named("case_city"), "_case_city", "left")
        .join(named("home_city"), "_home_city", "left")
        .select(
            "customer_no", "case_id",
            city_label(
                F.col("case_city"), F.col("home_city"), missing=v.NO_CITY, short=dict(roles.city_short)
            ).alias("city"),
        )
    )
    return last_informative(rows, "customer_no", "case_id", "city", v.NO_CITY)


def agents_by_number(
    people: DataFrame, city: DataFrame, group: str, roles: v.Roles = v.ROLES
) -> DataFrame:
    """(group, agent_no, email, city) of people with a phone; first person per number.

    people: (id, email, phone, city_id).
    """
    rows = (
        people.where(F.col("phone") != "")
        .join(city.select(F.col("id").alias("city_id"), "city_name"), "city_id", "left")
        .select(
            phone(F.col("phone")).alias("agent_no"), "id", "email",
            city_label(F.col("city_name"), missing=v.NO_CITY, short=dict(roles.city_short)).alias("city"),
        )
        .where(F.col("agent_no").isNotNull())
    )
    firsts = first_per_key(rows, "agent_no", "id", ["id", "email", "city"])
    return firsts.withColumn("staff_group", F.lit(group))


def call_detail(
    calls: DataFrame,
    documents: DataFrame,
    cities: DataFrame,
    agents: DataFrame,
    *,
    route: Column | None = None,
    roles: v.Roles = v.ROLES,
) -> DataFrame:
    """One wide row per inbound call; ``sid`` is unique.

    ``agents`` has (agent_no, email, city) and, with ``route``, ``staff_group``: the
    document's staff group then decides which list a leg's number is looked up in.
    """
    inbound = calls.where(F.col("direction") == v.INBOUND)
    docs = restrict_to(documents.withColumnRenamed("call_sid", "sid"), inbound, "sid")
    facts = call_facts(docs, "sid", ["created_on", "id"], roles.staff_key)

    rows = inbound.withColumn("customer_no", phone(F.col("from_no")))
    rows = left_lookup(rows, cities, "customer_no", {"city": v.NO_CITY})
    listed = F.coalesce("listed", F.lit(False))
    unlisted = {"personnel_type": v.NOT_APPLICABLE, "agent_in_system": "", "agent_available": ""}
    rows = rows.join(facts, "sid", "left").withColumns({
        **{c: F.when(listed, F.col(c)) for c in ("no_sent", "requested")},
        **{c: F.when(listed, F.col(c)).otherwise(blank) for c, blank in unlisted.items()},
    })
    rows = rows.select(
        "*",
        *[phone(F.col(f"{leg}AgentNumber")).alias(f"{leg}_agent_number") for leg in LEGS],
        final_status(
            *[F.col(f"{leg}DetailedStatus") for leg in LEGS],
            F.col("leg_1_status"), F.col("leg_2_status"), F.col("no_sent"),
        ).alias("final_status"),
    )
    rows = multi_slot_lookup(
        rows, agents, slots={f"{leg}_agent": f"{leg}_agent_number" for leg in LEGS},
        dim_key="agent_no", values=["email", "city"], route=route,
        dim_route=None if route is None else "staff_group", row_id="sid",
    )
    ts = F.col("call_created_on")
    return rows.select(
        "sid", "call_created_on", "status", "direction", "to_no", "from_no", "exotel_no",
        F.coalesce("duration", F.lit(0)).alias("duration"), "price",
        "leg_1_status", F.coalesce("leg_1_duration", F.lit(0)).alias("leg_1_duration"),
        "leg_2_status", F.coalesce("leg_2_duration", F.lit(0)).alias("leg_2_duration"),
        "recording_url", ts.cast("date").alias("mask_date"), F.hour(ts).alias("hour"),
        F.month(ts).alias("month"), F.year(ts).alias("year"), office_hours(ts).alias("hour_tag"),
        "customer_no", "city", F.lit("").alias("menu_check"),
        F.lit("").alias("menu_transfer_status"),
        "no_sent", "personnel_type", "requested", "agent_in_system", "agent_available",
        F.coalesce(F.upper("leg1DetailedStatus"), F.lit(v.NO_DOCUMENT)).alias("leg1_detailed_status"),
        *[F.coalesce(F.upper(f"{leg}DetailedStatus"), F.lit("")).alias(f"{leg}_detailed_status")
          for leg in LEGS[1:]],
        "final_status",
        *[F.coalesce(f"{leg}_agent_number", F.lit("")).alias(f"{leg}_agent_number") for leg in LEGS],
        *[F.coalesce(f"{leg}Status", F.lit("")).alias(f"{leg}_status") for leg in LEGS],
        *[f"{leg}_agent_{c}" for leg in LEGS for c in ("email", "city")],
    )


def staff_route(roles: v.Roles = v.ROLES) -> Column:
    """Field staff when the call document says so, support otherwise."""
    return F.when(F.col("personnel_type") == roles.field_staff, roles.field_staff).otherwise(
        roles.support
    )


def published_calls(detail: DataFrame) -> DataFrame:
    return schemas.conform(detail, schemas.CALL_DETAIL)


def agents_by_priority(support: DataFrame, field: DataFrame) -> DataFrame:
    """Support numbers first; field numbers fill the gaps."""
    return by_priority([support, field], "agent_no", "id", ["email", "city"])


def recent(calls: DataFrame, as_of_ts: dt.datetime, minutes: int = 10) -> DataFrame:
    """Calls of the last ``minutes`` up to and including ``as_of_ts``."""
    ts = F.col("call_created_on")
    return calls.where(
        (ts > instant(as_of_ts - dt.timedelta(minutes=minutes))) & (ts <= instant(as_of_ts))
    )


def failed_calls(detail: DataFrame, as_of_ts: dt.datetime, minutes: int = 10) -> DataFrame:
    """Recent calls that dropped, newest first, with the agent to notify."""
    return (
        recent(detail, as_of_ts, minutes)
        .where(F.col("final_status").isin(*v.FAILED_STATUSES))
        .select("sid", "call_created_on", "final_status", F.col("leg1_agent_email").alias("notify"))
        .orderBy(F.col("call_created_on").desc(), "sid")
    )
