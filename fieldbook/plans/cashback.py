"""Cashback reports: tagged ledger, period matrices, campaign attribution and funnels."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldbook import vocabulary as v
from fieldbook.functions.clock import PERIOD_NAMES, UTC_OFFSET, Periods, to_local
from fieldbook.functions.text import counterparty, format_inr, major_units, phone
from fieldbook.operators.attribution import attribute
from fieldbook.operators.funnel import flow_channel, funnel, use_breakdown
from fieldbook.operators.ledger import (
    card_facts, counted, ledger_matrix, tag_ledger, visit_facts,
)
from fieldbook.operators.lookup import left_lookup, restrict_to
from fieldbook.operators.per_user import OVERALL, per_user, with_user_kind
from fieldbook.plans.run_report import Watch, unwatched
from fieldbook.session import stored

NUDGE, PROMO_CREDIT, ONE_TIME = "nudge", "promo_credit", "one_time"
TEST_NUDGE, HOME_PICK_NUDGE = "diagnostics_test", "home_pick"
CAMPAIGNS = (NUDGE, PROMO_CREDIT, ONE_TIME, TEST_NUDGE, HOME_PICK_NUDGE)


def tagged_ledger(
    cash_ledger: DataFrame,
    customers: DataFrame,
    appointments: DataFrame,
    card_payments: DataFrame,
    cards: DataFrame,
    payment_links: DataFrame,
    app_cases: DataFrame,
    field_staff: DataFrame,
    cashback_types: DataFrame,
    as_of: dt.date,
    *,
    roles: v.Roles = v.ROLES,
    offset: dt.timedelta = UTC_OFFSET,
    periods: Periods | None = None,
) -> DataFrame:
    """Ledger of the report range (or of ``periods``) with phone, responsible tag, payment tag and type label."""
    periods = periods or Periods(as_of)
    in_range = cash_ledger.where(periods.covers(F.col("created_on"), offset)).select(
        "id", "customer_id", "cashback_type", major_units(F.col("amount")).alias("amount"),
        "issued_entity_type", F.col("issued_entity_id").cast("string").alias("issued_entity_id"),
        "transaction_type", to_local(F.col("created_on"), offset).alias("created_on"),
    )
    rows = in_range.join(
        customers.select("customer_id", phone(F.col("customer_number")).alias("phone")),
        "customer_id",
    )
    visits = visit_facts(in_range, appointments, payment_links, app_cases, field_staff)
    active = cards.where(F.col("status") == v.ACTIVE)
    rows = tag_ledger(rows, visits, card_facts(in_range, card_payments, active, field_staff), roles)
    labels = cashback_types.where(F.col("is_active") == 1).select(
        F.col("cashback_id").alias("cashback_type"),
        F.col("cashback_type").alias("cashback_label"),
    )
    return left_lookup(rows, labels, "cashback_type", {"cashback_label": ""})


def ledger_summary(ledger: DataFrame, as_of: dt.date) -> DataFrame:
    return ledger_matrix(ledger, as_of)


def with_text(matrix: DataFrame) -> DataFrame:
    """Amounts also as they are printed, next to the numbers."""
    return matrix.withColumns({f"{p}_text": format_inr(F.col(p)) for p in PERIOD_NAMES})


def ledger_by_tag(ledger: DataFrame, as_of: dt.date) -> DataFrame:
    return ledger_matrix(ledger, as_of, by_tag=True)


def campaign_messages(
    message_log: DataFrame,
    message_tags: DataFrame,
    assets: DataFrame,
    patients: DataFrame,
    customers: DataFrame,
    one_time: DataFrame,
    ledger: DataFrame,
    as_of: dt.date,
    *,
    roles: v.Roles = v.ROLES,
    offset: dt.timedelta = UTC_OFFSET,
    periods: Periods | None = None,
) -> DataFrame:
    """Every campaign message of the report range in one shape: campaign, id, phone,
    customer, sent_on, flow, amount_tier.

    The unique customer differs by campaign: the patient for nudges, the customer for
    credits and test / home-pick nudges, the number for one-time messages.
    """
    periods = periods or Periods(as_of)
    sms = (
        message_log.where(
            periods.covers(F.col("communication_date"), offset)
            & (F.col("communication_done") == 1)
            & (F.col("communication_type") == v.SMS)
        )
        .join(assets.select(F.col("id").alias("asset_id")), "asset_id")
        .join(message_tags.select(
            F.col("id").alias("entity_tag_map_id"), "tag_id", "entity_id", "entity_type",
            "additional_details",
        ), "entity_tag_map_id")
    )
    # Only the patients that some message of the range is about.
    about = sms.where(F.col("entity_type") == v.PATIENT_ENTITY).select(F.col("entity_id").alias("id"))
    person = restrict_to(patients, about, "id").join(
        customers.select("customer_id", "customer_number"), "customer_id", "left"
    ).select(
        F.col("id").alias("entity_id"), F.lit(v.PATIENT_ENTITY).alias("entity_type"),
        F.col("id").alias("patient_id"), "customer_id", phone(F.col("customer_number")).alias("phone"),
    )
    sms = sms.join(person, ["entity_id", "entity_type"], "left").withColumn(
        "sent_on", to_local(F.col("communication_date"), offset)
    )
    none = F.lit(None).cast("string")
    # A message can belong to a nudge and to a test campaign: one row for each.
    nudge = F.when(F.col("tag_id").isin(*roles.nudge_tags), F.lit(NUDGE))
    test = F.when(F.col("asset_id").isin(*roles.home_pick_assets), HOME_PICK_NUDGE).when(
        F.col("asset_id").isin(*roles.diagnostic_assets), TEST_NUDGE
    )
    is_nudge = F.col("campaign") == NUDGE
    flow = F.get_json_object("additional_details", f"$.{roles.flow_key}")
    texts = sms.withColumn("campaign", F.explode(F.array_compact(F.array(nudge, test)))).select(
        "campaign", "id", "phone",
        F.when(is_nudge, F.col("patient_id")).otherwise(F.col("customer_id")).cast("string").alias("customer"),
        "sent_on", F.when(is_nudge, flow).alias("flow"), none.alias("amount_tier"),
    )
    credits = ledger.where(
        (F.col("transaction_type") == v.CREDITED) & (F.col("cashback_type") == v.PROMO_TYPE_CODE)
    ).select(
        F.lit(PROMO_CREDIT).alias("campaign"), "id", "phone",
        F.col("customer_id").cast("string").alias("customer"), F.col("created_on").alias("sent_on"),
        none.alias("flow"), none.alias("amount_tier"),
    )
    details = F.from_json(
        "additional_details", f"{roles.promo_done_key} string, {roles.promo_amount_key} string"
    )
    singles = (
        one_time.where(
            periods.covers(F.col("scheduled_on"), offset)
            & (F.col("communication_type") == v.SMS)
            & (F.col("status") == v.SUCCESS)
        )
        .withColumns({"details": details, "phone": phone(F.col("patient_number"))})
        .where(F.col(f"details.{roles.promo_done_key}") == "true")
        .select(
            F.lit(ONE_TIME).alias("campaign"), "id", "phone", F.col("phone").alias("customer"),
            to_local(F.col("scheduled_on"), offset).alias("sent_on"), none.alias("flow"),
            F.col(f"details.{roles.promo_amount_key}").alias("amount_tier"),
        )
    )
    return texts.unionByName(credits).unionByName(singles)


def replies(
    chat: DataFrame,
    calls: DataFrame,
    as_of: dt.date,
    *,
    roles: v.Roles = v.ROLES,
    offset: dt.timedelta = UTC_OFFSET,
    periods: Periods | None = None,
) -> DataFrame:
    """Inbound chats (stored in UTC) and inbound calls (stored in local time) as one feed."""
    periods = periods or Periods(as_of)
    inbound_chat = chat.where(
        periods.covers(F.col("created_on"), offset) & (F.col("from_id") == F.col("to_message"))
    ).select(
        "id", phone(F.col("to_message")).alias("phone"),
        to_local(F.col("created_on"), offset).alias("sent_on"),
        F.lit(roles.chat_channel).alias("channel"),
    )
    inbound_calls = calls.where(
        periods.covers(F.col("call_created_on"), dt.timedelta(0))
        & (F.col("direction") == v.INBOUND)
    ).select(
        "id",
        counterparty(F.col("direction"), F.col("from_no"), F.col("to_no")).alias("phone"),
        F.col("call_created_on").alias("sent_on"), F.lit(roles.call_channel).alias("channel"),
    )
    return inbound_chat.unionByName(inbound_calls)


def spends(ledger: DataFrame) -> DataFrame:
    """Debits that count as a use: fully paid, or without a payment to check."""
    return counted(ledger).where(F.col("transaction_type") == v.DEBITED).select(
        "id", "phone", F.col("created_on").alias("sent_on"),
        F.col("issued_entity_type").alias("used_on"), "creation_type",
    )


def attributed_messages(messages: DataFrame, reply_feed: DataFrame, spend_feed: DataFrame) -> DataFrame:
    """Messages with their credit. The messages come out of several joins and are evaluated twice
    (for the bounds of the ranges, then for the sort), so they are stored first."""
    return attribute(
        stored(messages, "messages"), reply_feed, spend_feed, key="phone", ts="sent_on",
        campaign="campaign", id="id", campaigns=CAMPAIGNS,
    )


def campaign_funnels(
    attributed: DataFrame, as_of: dt.date, roles: v.Roles = v.ROLES, watch: Watch = unwatched
) -> tuple[DataFrame, DataFrame]:
    """(funnels, rejects): all campaigns in one aggregation over (campaign, split).

    Nudges split by desk and one-time messages by amount tier; there a customer counts
    once per period, in the column of the first message. A one-time message of an unknown
    tier is rejected. One-time messages have no "yesterday" column.
    """
    split = (
        F.when(F.col("campaign") == NUDGE, flow_channel(F.col("flow"), "after_visit", "support"))
        .when(F.col("campaign") == ONE_TIME, F.col("amount_tier"))
        .otherwise("all")
    )
    rows = attributed.withColumn("split", split)
    known = (F.col("campaign") != ONE_TIME) | F.coalesce(
        F.col("amount_tier").isin(*roles.amount_tiers), F.lit(False)
    )
    rows = watch(rows, "campaign_messages", {"unknown amount tier": ~known})
    rejected = rows.where(~known).withColumn(
        "reject_reason", F.concat(F.lit("unknown amount tier: "), F.coalesce("amount_tier", F.lit("NULL")))
    )
    result = funnel(
        rows.where(known), as_of, column=["campaign", "split"], unique_by="customer", first_touch=True
    )
    shown = ~((F.col("campaign") == ONE_TIME) & (F.col("period") == "yesterday"))
    return result.where(shown), rejected


def campaign_uses(attributed: DataFrame, as_of: dt.date) -> DataFrame:
    """Kinds of use for the three cash campaigns."""
    return use_breakdown(
        attributed.where(F.col("campaign").isin(NUDGE, PROMO_CREDIT, ONE_TIME)), as_of
    )


def transactions_per_user(
    transactions: DataFrame,
    grain: str = "month",
    legacy_month: bool = False,
    roles: v.Roles = v.ROLES,
) -> DataFrame:
    """Transactions ÷ distinct users by month or week, per kind of user and overall.

    transactions: (patient_id, payment_mode, created_on, week). ``legacy_month`` merges the
    same month of different years.
    """
    if grain == "week":
        period = [F.col("week").try_cast("int").alias("week")]
    elif legacy_month:
        period = [F.month("created_on").alias("month")]
    else:
        period = [F.year("created_on").alias("year"), F.month("created_on").alias("month")]
    names = {"week": ["week"]}.get(grain, ["month"] if legacy_month else ["year", "month"])
    counts = with_user_kind(
        transactions, user="patient_id", period=period,
        marks_user=F.col("payment_mode") == roles.cash_mode, marked=roles.cash_user,
        other=roles.other_user,
    )
    return per_user(counts, user="patient_id", period=names)


def per_user_report(
    result: DataFrame, period: list[str], roles: v.Roles = v.ROLES
) -> DataFrame:
    """One row per period with a column per kind of user, in period order."""
    return (
        result.groupBy(*period)
        .pivot("user_type", [roles.cash_user, roles.other_user, OVERALL])
        .agg(F.first("per_user"))
        .orderBy(*period)
    )
