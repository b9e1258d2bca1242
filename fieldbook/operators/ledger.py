"""Cashback ledger: who earned a credit, was a debit fully paid, and the period matrix."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldbook import vocabulary as v
from fieldbook.functions.clock import Periods
from fieldbook.functions.text import MONEY
from fieldbook.operators.lookup import first_per_key, flag_present, restrict_to

TOTAL = "ALL"


def visit_facts(
    ledger: DataFrame,
    appointments: DataFrame,
    payment_links: DataFrame,
    app_cases: DataFrame,
    field_staff: DataFrame,
) -> DataFrame:
    """What the ledger needs to know about its appointments, one row per appointment.

    appointments (id, lead_id, user, consultation_fee, creation_type), payment_links
    (entity_id, entity_type, status, amount), app_cases (case_id), field_staff (email).
    Both large tables are cut down to the ledger's own appointments before any grouping.
    """
    needed = entity_ids(ledger.where(F.col("issued_entity_type").isin(v.APPOINTMENT, v.DIAGNOSTICS)))
    visits = restrict_to(appointments, needed, "id").withColumn("issued_entity_id", F.col("id").cast("string"))
    fields = ["lead_id", "user", "creation_type", "consultation_fee"]
    visits = first_per_key(visits, "issued_entity_id", fields, fields)
    visits = visits.withColumn("case_id", F.col("lead_id").cast("string"))
    from_app = restrict_to(app_cases, visits.select(F.col("lead_id").alias("case_id")), "case_id")
    visits = flag_present(visits, from_app.select(F.col("case_id").cast("string")), "case_id", "_from_app")
    visits = flag_present(
        visits.withColumnRenamed("user", "email"), field_staff, "email", "_field_user"
    )
    links = payment_links.where((F.col("entity_type") == v.APPOINTMENT) & (F.col("status") == v.PAID))
    needed = needed.withColumnRenamed("id", "entity_id")
    paid = restrict_to(links, needed, "entity_id").groupBy(
        F.col("entity_id").cast("string").alias("issued_entity_id")
    ).agg(F.sum(F.round(F.col("amount") / F.lit(100), 2).cast(MONEY)).alias("_paid"))
    fee_met = F.col("consultation_fee").cast(MONEY) == F.coalesce("_paid", F.lit(0).cast(MONEY))
    return visits.join(paid, "issued_entity_id", "left").select(
        "issued_entity_id", F.lit(True).alias("_visit"), "_from_app", "_field_user",
        F.col("creation_type").alias("_creation"), F.coalesce(fee_met, F.lit(False)).alias("_fee_met"),
    )


def entity_ids(ledger: DataFrame) -> DataFrame:
    """(id) of the things that these ledger rows name, as numbers.

    The ledger holds ids as text. Turned into numbers here, they meet the id columns of the large
    tables as they are stored, so those can be pruned; text that isn't a number's plain form meets none.
    """
    text = F.col("issued_entity_id")
    number = text.try_cast("bigint")
    return ledger.where(number.cast("string") == text).select(number.alias("id"))


def card_facts(
    ledger: DataFrame, card_payments: DataFrame, active_cards: DataFrame, field_staff: DataFrame
) -> DataFrame:
    """One row per paid card of the ledger: who collected the payment, and is the card active?

    card_payments (card_id, collected_by), active_cards (card_id). Both are cut down to the
    ledger's own cards before any grouping.
    """
    not_a_card = F.col("issued_entity_type").isin(v.APPOINTMENT, v.DIAGNOSTICS, v.SURGERY)
    needed = entity_ids(ledger.where(~F.coalesce(not_a_card, F.lit(False)))).withColumnRenamed("id", "card_id")
    cards = first_per_key(restrict_to(card_payments, needed, "card_id"), "card_id", "collected_by", ["collected_by"])
    cards = flag_present(
        cards.withColumnRenamed("collected_by", "email"), field_staff, "email", "_field_card"
    )
    cards = flag_present(cards, restrict_to(active_cards, needed, "card_id"), "card_id", "_card_active")
    return cards.select(
        F.col("card_id").cast("string").alias("issued_entity_id"), F.lit(True).alias("_card"),
        "_field_card", "_card_active",
    )


def credit_tag(roles: v.Roles) -> Column:
    """The party responsible for a credit, '' for a debit."""

    def party(is_field: Column) -> Column:
        return F.when(is_field, roles.field_staff).otherwise(v.SUPPORT_TAG)

    entity = F.col("issued_entity_type")
    return (
        F.when(F.col("transaction_type") == v.DEBITED, "")
        .when(entity.isin(v.SURGERY, v.DIAGNOSTICS), roles.field_staff)
        .when((entity == v.APPOINTMENT) & F.col("_visit").isNull(), v.NOT_APPLICABLE)
        .when((entity == v.APPOINTMENT) & F.col("_from_app"), v.CUSTOMER_APP_TAG)
        .when(entity == v.APPOINTMENT, party(F.col("_field_user")))
        .when(F.col("_card"), party(F.col("_field_card")))
        .otherwise(v.NOT_APPLICABLE)
    )


def payment_tag() -> Column:
    """Was the thing a debit was spent on paid in full? Only such debits count as uses."""
    entity = F.col("issued_entity_type")
    settled = (entity.isin(v.APPOINTMENT, v.DIAGNOSTICS) & F.col("_fee_met")) | (
        (entity == v.LOYALTY) & F.col("_card_active")
    )
    return (
        F.when(
            (F.col("transaction_type") == v.CREDITED) | (entity == v.SURGERY), v.NOT_APPLICABLE
        )
        .when(settled, v.FULL_PAYMENT)
        .otherwise(v.PARTIAL_PAYMENT)
    )


def creation_type() -> Column:
    visit_debit = (F.col("transaction_type") == v.DEBITED) & F.col("issued_entity_type").isin(
        v.APPOINTMENT, v.DIAGNOSTICS
    )
    return F.when(visit_debit & F.col("_visit"), F.col("_creation")).otherwise("")


def tag_ledger(
    ledger: DataFrame, visits: DataFrame, cards: DataFrame, roles: v.Roles = v.ROLES
) -> DataFrame:
    """Add ``tag``, ``payment_tag`` and ``creation_type``."""
    return (
        ledger.join(visits, "issued_entity_id", "left")
        .join(cards, "issued_entity_id", "left")
        .select(
            *ledger.columns, credit_tag(roles).alias("tag"), payment_tag().alias("payment_tag"),
            creation_type().alias("creation_type"),
        )
    )


def counted(ledger: DataFrame) -> DataFrame:
    """Credits, and the debits that were paid in full."""
    return ledger.where(
        (F.col("transaction_type") == v.CREDITED)
        | ((F.col("transaction_type") == v.DEBITED) & (F.col("payment_tag") != v.PARTIAL_PAYMENT))
    )


def bucket() -> Column:
    """Entity type, or the promotional bucket for credits outside the four types."""
    entity = F.col("issued_entity_type")
    return (
        F.when(entity.isin(*v.ENTITY_TYPES), entity)
        .when(
            (F.col("transaction_type") == v.CREDITED)
            & (F.col("cashback_type") == v.PROMO_TYPE_CODE),
            v.PROMO_BUCKET,
        )
        .otherwise(v.NO_BUCKET)
    )


def ledger_matrix(ledger: DataFrame, as_of: dt.date, by_tag: bool = False) -> DataFrame:
    """Given / used amounts per bucket and (overlapping) period, with ALL totals.

    ``created_on`` is local time. The periods are columns of one aggregate, so no row is
    repeated per period. With ``by_tag`` only credits to the four entity types are shown,
    per responsible party.
    """
    flags = Periods(as_of).flags(F.col("created_on"))
    rows = counted(ledger).select(
        F.when(F.col("transaction_type") == v.CREDITED, "Given").otherwise("Used").alias("direction"),
        bucket().alias("bucket"),
        *([F.col("tag")] if by_tag else []),
        F.col("amount").cast(MONEY).alias("amount"),
        *[expr.alias(name) for name, expr in flags.items()],
    )
    sums = [
        F.coalesce(F.sum(F.when(F.col(p), F.col("amount"))), F.lit(0)).cast("decimal(28,2)").alias(p)
        for p in flags
    ]
    if by_tag:
        return (
            rows.where((F.col("direction") == "Given") & F.col("bucket").isin(*v.ENTITY_TYPES))
            .groupBy("tag", "bucket")
            .agg(*sums)
        )
    return (
        rows.groupingSets([["direction", "bucket"], ["direction"]], "direction", "bucket")
        .agg(F.grouping("bucket").alias("_all"), *sums)
        .select(
            "direction",
            F.when(F.col("_all") == 1, TOTAL).otherwise(F.col("bucket")).alias("bucket"),
            *flags,
        )
    )


def running_totals(rows: DataFrame) -> DataFrame:
    """Amount and count per local day, direction and bucket (batch twin of the stream)."""
    return (
        counted(rows)
        .select(
            F.col("created_on").cast("date").alias("day"), "transaction_type",
            bucket().alias("bucket"), F.col("amount").cast(MONEY).alias("amount"),
        )
        .groupBy("day", "transaction_type", "bucket")
        .agg(F.sum("amount").alias("amount"), F.count(F.lit(1)).alias("entries"))
    )
