
import datetime as dt
from decimal import Decimal as D

import pytest
from conftest import at, tuples
from pyspark.sql import functions as F

from fieldbook import vocabulary as v
from fieldbook.functions import clock, text
from fieldbook.operators import funnel, ledger, lookup, per_user, pricing, reporting
from fieldbook.operators.activity import active_seconds
from fieldbook.probes.deployment import CITY_CODES, ROLES
from fieldbook.plans import cashback, staff


def value(spark, expr):
    return spark.range(1).select(expr.alias("x")).first().x


# D1, D7
def test_missing_values_stay_null_as_text(table):
    df = table("a:l b:t", [(5, None), (None, at("2024-01-02 03:04:05"))])
    assert tuples(df.select(*text.stringify("a", "b"))) == [("5", None), (None, "2024-01-02 03:04:05")]


def test_names_are_sorted_keep_repeats_and_skip_null(table):
    df = table("k:l n:s", [(1, "b"), (1, "a"), (1, "b"), (1, None), (2, None)])
    assert tuples(reporting.joined_names(df, "k", "n", "names")) == [(1, "a,b,b")]
    assert tuples(reporting.name_counts(df, "k", "n")) == [(1, "a", 1), (1, "b", 2)]


def test_names_of_a_very_large_key_are_counted_not_gathered(spark):
    rows = spark.range(300_000).selectExpr("0 as k", "concat('n', id % 200000) as n")
    counts = reporting.name_counts(rows.withColumnRenamed("n", "name"), "k", "name")
    assert counts.count() == 200_000 and counts.agg(F.sum("times")).first()[0] == 300_000
    assert "collect" not in counts._jdf.queryExecution().executedPlan().toString()


# D4
def test_time_slot_wraps_midnight(table):
    df = table("t:t", [(at(f"2024-01-0{d} {h}"),) for d in (1, 2) for h in ("23:55:00", "00:04:59", "00:05:01", "12:00:00")])
    kept = tuples(df.where(clock.in_time_slot(F.col("t"), dt.time(23, 55), 10)).select(F.hour("t"), F.minute("t")))
    assert kept == [(0, 4), (0, 4), (23, 55), (23, 55)]


# D5
def test_unknown_code_is_rejected_not_lost(table):
    df = table("id:l city_id:l", [(1, 2), (2, 9), (3, None)])
    good, bad = reporting.apply_codes(df, F.col("city_id"), CITY_CODES, "city")
    assert tuples(good) == [(1, 2, "BLR")]
    assert tuples(bad, "id", "reject_reason") == [
        (2, "unknown code for city: 9"), (3, "unknown code for city: NULL"),
    ]


# D6, D12, D13
CASES = "case_id:l hospital_name:s source:s lender_name:s admission_date:t case_created_on:t approved:m total_bill:m"
RATES = "key:s share_pct:s net_share_pct:s remarks:s start_date:s end_date:s"


def priced(table, cases, rates):
    return {
        (r.case_id, r.remarks): r
        for r in pricing.price_cases(table(CASES, cases), table(RATES, rates)).collect()
    }


def test_effective_period_keeps_and_drops_the_right_cases(table):
    created = at("2023-01-15 00:00:00")

    def case(i, lender, admission, hospital="H"):
        return (i, hospital, "Partner", lender, admission and at(admission), created, D(1000), D(2000))

    rates = [
        ("HPartner24HR", "10.00%", "11.80%", "On Approved amount", "2023-01-01", "2023-01-31"),
        ("HPartner24HR", "20.00%", "23.60%", "on total bill AMOUNT", "2023-02-01", "2023-02-28"),
        ("HPartnerNone", "5%", "5.9%", "Other", "2023-01-01", "2023-01-31"),
    ]
    found = priced(table, [
        case(1, "Bank", "2023-01-01 00:00:00"), case(2, "Bank", "2023-01-31 00:00:00"),
        case(3, "Bank", "2023-02-10 00:00:00"), case(4, "Bank", "2023-07-01 00:00:00"),
        case(5, "Bank", None), case(6, "Bank", "2023-01-05 00:00:00", "Elsewhere"),
        case(7, None, "2023-01-05 00:00:00"), case(8, "Own PDC", "2023-01-05 00:00:00"),
    ], rates)
    kept = {i for i, _ in found}
    assert kept == {1, 2, 3, 5, 6, 7, 8}
    assert found[1, "On Approved amount"].total_share == D("118.0000")
    assert found[1, "On Approved amount"].tax_amount == D("18.0000")
    assert found[1, "On Approved amount"].net_payable == D("882.0000")
    assert found[3, "on total bill AMOUNT"].share_amount == D("400.0000")
    assert found[1, "On Approved amount"].statement_note == v.COMMISSION_DONE
    assert found[5, "On Approved amount"].statement_note == v.ADMISSION_MISSING
    assert (5, "on total bill AMOUNT") not in found
    assert found[6, None].statement_note is None and found[6, None].net_payable is None
    assert found[7, "Other"].statement_note == v.LENDER_MISSING
    assert found[7, "Other"].share_amount is None
    assert found[8, None].category == "PDC-Own"


# D8
def test_rates_round_half_up_and_survive_zero(table):
    df = table("x:l u:l", [(1, 800), (1, 3), (5, 0), (2, 1)])
    assert tuples(df.select(funnel.rate(F.col("x"), F.col("u")))) == [
        (D("0.00"),), (D("0.13"),), (D("200.00"),), (D("33.33"),),
    ]


# D9
def test_transactions_per_user_do_not_depend_on_row_order(table):
    rows = [
        (1, "CASHBACK", at("2023-03-01 00:00:00"), "9"), (1, "CARD", at("2023-03-02 00:00:00"), "9"),
        (2, "CARD", at("2023-03-02 00:00:00"), "9"), (2, "CARD", at("2024-03-05 00:00:00"), "10"),
        (1, "CARD", at("2024-03-05 00:00:00"), "x"),
    ]
    spec = "patient_id:l payment_mode:s created_on:t week:s"
    for order in (rows, rows[::-1]):
        df = table(spec, order)
        assert tuples(cashback.transactions_per_user(df)) == [
            (2023, 3, "cash", 2, 1, D("2.00")), (2023, 3, "non-cash", 1, 1, D("1.00")),
            (2023, 3, "overall", 3, 2, D("1.50")), (2024, 3, "cash", 1, 1, D("1.00")),
            (2024, 3, "non-cash", 1, 1, D("1.00")), (2024, 3, "overall", 2, 2, D("1.00")),
        ]
    merged = tuples(cashback.transactions_per_user(table(spec, rows), legacy_month=True))
    assert merged[-1] == (3, "overall", 5, 2, D("2.50"))
    weeks = tuples(cashback.transactions_per_user(table(spec, rows), "week"), "week", "user_type", "users")
    assert (9, "overall", 2) in weeks and (None, "overall", 1) in weeks


def test_user_of_two_kinds_counts_once_overall(table):
    counts = table("m:l user_type:s u:l n:l", [(1, "a", 7, 2), (1, "b", 7, 3)])
    assert tuples(per_user.per_user(counts, user="u", period=["m"]), "user_type", "transactions", "users") == [
        ("a", 2, 1), ("b", 3, 1), ("overall", 5, 1),
    ]


# D10
def sessions(table, rows):
    df = table("id:l agent:s ts:t value:s reason:s", rows)
    active = (F.col("value") == "true") | (F.col("reason") == v.MEETING_REASON)
    out = active_seconds(
        df, agent="agent", ts="ts", id="id", value="value", reason="reason", active=active,
        as_of=dt.date(2024, 1, 3),
    )
    return {r.id: r.total_active_sec for r in out.collect()}


def test_availability_sessions(table):
    found = sessions(table, [
        (1, "a", at("2024-01-02 10:00:00"), "true", None), (2, "a", at("2024-01-02 10:00:30.5"), "false", None),
        (3, "a", at("2024-01-02 11:00:00"), "false", v.MEETING_REASON),
        (4, "a", at("2024-01-02 11:00:00"), "true", None),
        (5, "a", at("2024-01-02 23:00:00"), None, "x"),
        (6, "b", at("2024-01-01 23:59:50"), "true", None),
        (7, None, at("2024-01-02 23:59:00"), "true", None), (8, None, at("2024-01-02 23:59:30"), "true", None),
    ])
    assert found == {
        1: 30, 2: None, 3: 0,           # equal times: the id decides the order
        4: 46799,                       # next value missing: closes at 23:59:59
        5: None, 6: 86409,              # open over midnight until the end of yesterday
        7: 59, 8: 29,                   # no agent: no next row, both close at the end of yesterday
    }


# D11
@pytest.mark.parametrize("raw, parsed", [
    ("500", D("500.00")), ("1,234", D("1234.00")), ("12,34,567", D("1234567.00")), ("", None),
    (" 1,234.50", D("1234.50")), ("abc", None), (None, None),
])
def test_money_text(spark, raw, parsed):
    column = F.lit(raw).cast("string")
    assert value(spark, text.money(column)) == parsed
    assert bool(value(spark, text.unreadable(column, text.money(column)))) == (raw == "abc")


def test_percent_text(spark):
    assert value(spark, text.percent(F.lit("18.00 %"))) == D("0.180000")
    assert value(spark, text.percent(F.lit("n/a"))) is None
    assert value(spark, pricing.with_tax(text.percent(F.lit("10%")))) == D("0.118000")


@pytest.mark.parametrize("amount, shown", [
    ("0", "0"), ("999", "999"), ("1000", "1,000"), ("100000.5", "1,00,000.50"),
    ("12345678.00", "1,23,45,678"), ("-1234567.25", "-12,34,567.25"), (None, "0"),
])
def test_inr_text(spark, amount, shown):
    assert value(spark, text.format_inr(F.lit(amount).cast("decimal(18,2)"))) == shown


# D15, A7
def test_coverage_counts_first_row_and_keeps_zero_groups(table):
    facility = table("facility_id:l alias_name:s zone:s city_id:l active:i", [
        (i, f"F{i}", "N", i, 1) for i in range(1, 7)
    ] + [(7, "F1", "N", 2, 1), (8, "F8", "INS", 1, 1), (9, "F9", None, 1, 1), (10, "F10", "N", 1, 0)])
    maps = table("id:l facility_id:l is_valid:i tenant_name:s mapping_type:s", [
        (1, 1, 1, "MAIN", v.TICKET_MANAGER), (2, 1, 1, "MAIN", v.TICKET_MANAGER),
        (3, 2, 0, "MAIN", v.TICKET_MANAGER), (4, 3, 1, "OTHER", v.TICKET_MANAGER),
    ])
    city = table("id:l city_name:s", [(i, f"C{i}") for i in range(1, 7)])
    assert tuples(staff.coverage_by_city(facility, maps, city)) == [
        ("C1", 0), ("C2", 1), ("C3", 1), ("C4", 1), ("C5", 1), ("C6", 1),
    ]
    assert ("C2", "F2", "N") in tuples(staff.uncovered_facilities(facility, maps, city))


# D16
@pytest.mark.parametrize("raw, number", [
    ("+91 98-765 43210", "9876543210"), ("43210", "43210"), ("", None), ("--", None), (None, None),
])
def test_phone(spark, raw, number):
    assert value(spark, text.phone(F.lit(raw).cast("string"))) == number


# D19, A4-A6
LEDGER = "transaction_type:s issued_entity_type:s cashback_type:l amount:m created_on:t payment_tag:s tag:s"


def test_ledger_matrix(table):
    yesterday, month, last, older = (at(d) for d in (
        "2024-05-31 10:00:00", "2024-05-02 00:00:00", "2024-04-30 23:59:59", "2024-03-31 00:00:00"))
    rows = table(LEDGER, [
        ("CREDITED", v.APPOINTMENT, 6, D(10), yesterday, "NA", "CS_AGENT"),
        ("CREDITED", None, 6, D(5), month, "NA", "NA"),
        ("CREDITED", "GIFT", 1, D(3), last, "NA", "NA"),
        ("CREDITED", v.LOYALTY, 1, D(100), older, "NA", "NA"),
        ("DEBITED", v.APPOINTMENT, 1, D(7), yesterday, v.FULL_PAYMENT, ""),
        ("DEBITED", v.APPOINTMENT, 1, D(50), yesterday, v.PARTIAL_PAYMENT, ""),
        ("DEBITED", None, 6, D(2), yesterday, v.NOT_APPLICABLE, ""),
    ])
    # On the first of June the report still covers May (yesterday's month) and April.
    found = {(r.direction, r.bucket): (r.yesterday, r.month_to_date, r.last_month)
             for r in ledger.ledger_matrix(rows, dt.date(2024, 6, 1)).collect()}
    assert found["Given", "ALL"] == (10, 15, 3)
    assert found["Given", v.APPOINTMENT] == (10, 10, 0)
    assert found["Given", v.PROMO_BUCKET] == (0, 5, 0)
    assert found["Given", v.NO_BUCKET] == (0, 0, 3)
    assert found["Given", v.LOYALTY] == (0, 0, 0)
    assert found["Used", v.APPOINTMENT] == (7, 7, 0)
    assert found["Used", "ALL"] == (9, 9, 0)
    tagged = {(r.tag, r.bucket): r.yesterday for r in ledger.ledger_matrix(rows, dt.date(2024, 6, 1), True).collect()}
    assert tagged == {("CS_AGENT", v.APPOINTMENT): 10, ("NA", v.LOYALTY): 0}


def test_ledger_tags(table):
    entries = table("id:l issued_entity_id:s issued_entity_type:s transaction_type:s", [
        (1, "10", v.APPOINTMENT, "CREDITED"), (2, "11", v.APPOINTMENT, "CREDITED"),
        (3, "12", v.APPOINTMENT, "CREDITED"), (4, "99", v.APPOINTMENT, "CREDITED"),
        (5, "7", v.LOYALTY, "CREDITED"), (6, "8", None, "CREDITED"), (7, "1", v.SURGERY, "CREDITED"),
        (8, "10", v.APPOINTMENT, "DEBITED"), (9, "11", v.DIAGNOSTICS, "DEBITED"),
        (10, "99", v.APPOINTMENT, "DEBITED"), (11, "7", v.LOYALTY, "DEBITED"),
        (12, "8", v.LOYALTY, "DEBITED"), (13, "1", v.SURGERY, "DEBITED"), (14, "10", "GIFT", "DEBITED"),
        (15, "10", v.DIAGNOSTICS, "CREDITED"),
    ])
    appointments = table("id:l lead_id:l user:s consultation_fee:m creation_type:s", [
        (10, 500, "f@x", D("100.10"), "NEW"), (11, 501, "f@x", D(80), v.FOLLOW_UP), (12, 502, "s@x", None, "NEW"),
    ])
    links = table("entity_id:l entity_type:s status:s amount:l", [
        (10, v.APPOINTMENT, "PAID", 5005), (10, v.APPOINTMENT, "PAID", 5005), (10, v.APPOINTMENT, "FAILED", 1),
        (11, v.APPOINTMENT, "PAID", 7999), (11, "CASE", "PAID", 1),
    ])
    field = table("email:s", [("f@x",), ("f@x",)])
    visits = ledger.visit_facts(entries, appointments, links, table("case_id:l", [(500,)]), field)
    cards = ledger.card_facts(entries, table("card_id:l collected_by:s", [(7, "f@x"), (8, "s@x")]), table("card_id:l", [(7,)]), field)
    out = ledger.tag_ledger(entries, visits, cards)
    found = {r.id: (r.tag, r.payment_tag, r.creation_type) for r in out.collect()}
    F_, CS, full, part = v.ROLES.field_staff, v.SUPPORT_TAG, v.FULL_PAYMENT, v.PARTIAL_PAYMENT
    assert found == {
        1: (v.CUSTOMER_APP_TAG, "NA", ""), 2: (F_, "NA", ""), 3: (CS, "NA", ""), 4: ("NA", "NA", ""),
        5: (F_, "NA", ""), 6: (CS, "NA", ""), 7: (F_, "NA", ""), 8: ("", full, "NEW"),
        9: ("", part, v.FOLLOW_UP), 10: ("", part, ""), 11: ("", full, ""), 12: ("", part, ""),
        13: ("", "NA", ""), 14: ("", part, ""), 15: (F_, "NA", ""),
    }


# D20, N10, N11, N13
def test_lookup_hit_keeps_null_and_miss_gets_default(table):
    people = table("k:l", [(1,), (2,), (3,)])
    dim = lookup.first_per_key(table("k:l o:l x:s", [(1, 2, "late"), (1, 1, None), (2, 1, "b")]), "k", "o", ["x"])
    assert tuples(lookup.left_lookup(people, dim, "k", {"x": ""})) == [(1, None), (2, "b"), (3, "")]


def test_known_value_beats_blank_and_later_beats_earlier(table):
    df = table("k:l o:l c:s", [(1, 1, "X"), (1, 2, "Y"), (1, 3, v.NO_CITY), (2, 1, v.NO_CITY)])
    assert tuples(lookup.last_informative(df, "k", "o", "c", v.NO_CITY)) == [(1, "Y"), (2, v.NO_CITY)]


def test_priority_source_wins(table):
    spec = "k:l id:l e:s"
    first, second = table(spec, [(1, 9, "s1")]), table(spec, [(1, 1, "f1"), (2, 2, "f2"), (2, 1, "f3")])
    assert tuples(lookup.by_priority([first, second], "k", "id", ["e"])) == [(1, "s1"), (2, "f3")]


def test_multi_slot_shapes_agree(table):
    df = table("id:l r:s a:l b:l", [(1, "x", 5, None), (2, "y", 6, 5), (3, "x", None, None), (4, "x", 8, 8)])
    dim = table("n:l r:s e:s", [(5, "x", "five"), (6, "x", "six"), (5, "y", "cinq"), (8, "x", None)])
    options = dict(slots={"p": "a", "q": "b"}, dim_key="n", values=["e"], route=F.col("r"), dim_route="r")
    chain = tuples(lookup.multi_slot_lookup(df, dim.withColumnRenamed("r", "g"), **{**options, "dim_route": "g"}))
    once = tuples(lookup.multi_slot_lookup(df, dim.withColumnRenamed("r", "g"), **{**options, "dim_route": "g"}, row_id="id"))
    assert chain == once == [
        (1, "x", 5, None, "five", ""), (2, "y", 6, 5, "", "cinq"), (3, "x", None, None, "", ""), (4, "x", 8, 8, "", ""),
    ]


# A8-A12, F14
MESSAGES = "campaign:s split:s id:l customer:s sent_on:t responded:b used:b used_on:s creation_type:s"


def test_funnel_first_touch_and_overlapping_periods(table):
    as_of = dt.date(2024, 5, 20)
    rows = table(MESSAGES, [
        ("n", "x", 1, "c1", at("2024-05-03 09:00:00"), True, False, None, None),
        ("n", "y", 2, "c1", at("2024-05-19 09:00:00"), True, True, v.APPOINTMENT, None),
        ("n", "y", 3, "c2", at("2024-05-19 09:00:00"), False, False, None, None),
        ("n", "x", 4, "c2", at("2024-05-19 09:00:00"), False, False, None, None),
        ("n", "x", 5, "c3", at("2024-04-30 09:00:00"), False, True, v.APPOINTMENT, v.FOLLOW_UP),
        ("n", "x", 6, "c3", at("2024-04-29 09:00:00"), False, True, v.LOYALTY, ""),
        ("n", "x", 7, "c4", at("2024-05-20 09:00:00"), True, True, v.SURGERY, ""),
    ])
    found = {(r.split, r.period): r for r in funnel.funnel(
        rows, as_of, column=["campaign", "split"], unique_by="customer", first_touch=True).collect()}
    assert found["x", "month_to_date"].unique_customers == 1   # c1 first seen in x
    assert found["y", "month_to_date"].unique_customers == 1   # c2: same time, smaller id is in y
    assert found["y", "yesterday"].unique_customers == 2       # c1 counts here for yesterday
    assert found["x", "yesterday"].unique_customers == 0 and found["x", "yesterday"].conversion_pct == 0
    assert (found["x", "month_to_date"].sent, found["y", "month_to_date"].sent) == (2, 2)
    assert found["x", "last_month"].used == 2 and found["x", "last_month"].conversion_pct == D("200.00")
    assert found["y", "yesterday"].response_pct == D("50.00")
    uses = {r.use_kind: (r.yesterday, r.month_to_date, r.last_month) for r in funnel.use_breakdown(rows, as_of).collect()}
    assert uses["Appointment (New)"] == (1, 1, 0) and uses["Appointment (FollowUp)"] == (0, 0, 1)
    assert uses["Loyalty Card"] == (0, 0, 1) and uses["Grand Total"] == (1, 1, 2)


def test_unknown_tier_is_reported(table):
    spec = MESSAGES.replace("split:s", "flow:s amount_tier:s")
    row = lambda i, tier: ("one_time", None, tier, i, "c", at("2024-05-03 09:00:00"), False, False, None, None)
    shown, bad = cashback.campaign_funnels(table(spec, [row(1, "100"), row(2, "70"), row(3, None)]), dt.date(2024, 5, 20), ROLES)
    assert tuples(reporting.reject_counts(bad)) == [("unknown amount tier: 70", 1), ("unknown amount tier: NULL", 1)]
    assert {(r.split, r.period, r.sent) for r in shown.collect()} == {("100", "month_to_date", 1), ("100", "last_month", 0)}
