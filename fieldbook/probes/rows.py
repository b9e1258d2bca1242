"""Probes: sources, sinks, projections, filters, scalar functions."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldbook import vocabulary as v
from fieldbook.functions import calls, clock, text
from fieldbook.operators import lookup, pricing, reporting
from fieldbook.operators.documents import array_filled, payload
from fieldbook.plans.jobs import Inputs, run
from fieldbook.probes.deployment import CITY_CODES, CITY_SHORT, ROLES
from fieldbook.probes.registry import Tables, probe
from fieldbook.sources import readers, schemas, writers
from fieldbook.session import work_folder

AS_OF = dt.date(2000, 6, 15)
EVENT_DAY = dt.date(2024, 1, 15)
EVENT_COLUMNS = ("event_id", "user_id", "ts")

# ---- sources and sinks ---------------------------------------------------------------

LENDER = schemas.struct("lender_id:l lender_name:s additional_details:s")


@probe("S01_table_scan", "select r_regionkey, r_name from region")
def _(t: Tables):
    return readers.read_table(
        t.spark, f"{t.folder}/region.parquet", schemas.struct("r_regionkey:i r_name:s")
    )


@probe("S02_windowed_scan", """
    select event_id, ts from events
    where ts >= timestamp '2024-01-09 18:30:00' and ts < timestamp '2024-01-12 18:30:00'""")
def _(t: Tables):
    return readers.read_window(
        t.spark, f"{t.folder}/events.parquet", ts="ts",
        first=dt.date(2024, 1, 10), last=dt.date(2024, 1, 12),
    ).select("event_id", "ts")


@probe("S03_key_list_scan", """
    select l_orderkey, l_partkey, l_quantity from lineitem
    where l_orderkey in (select o_orderkey from orders where o_orderstatus = 'F')""")
def _(t: Tables):
    keys = t.orders.where(F.col("o_orderstatus") == "F").select(F.col("o_orderkey").alias("l_orderkey"))
    return lookup.restrict_to(t.lineitem, keys, "l_orderkey").select(
        "l_orderkey", "l_partkey", "l_quantity"
    )


@probe("S04_published_table_scan", """
    select o_custkey, cast(sum(cast(o_totalprice as decimal(18,2))) as double) as total
    from orders group by o_custkey""")
def _(t: Tables):
    path = work_folder(t.spark, "published")
    rows = t.orders.groupBy("o_custkey").agg(
        F.sum(F.col("o_totalprice").cast(text.MONEY)).cast(text.MONEY).alias("total")
    )
    layout = schemas.struct("o_custkey:l total:m")
    writers.publish(rows, path, layout)
    return readers.read_table(t.spark, path, layout)


@probe("S04_bucketed_join", """
    select o_orderkey, o_custkey, count(l_orderkey) as items, cast(sum(cast(l_quantity as decimal(18,2))) as double) as quantity
    from orders left join lineitem on l_orderkey = o_orderkey group by 1, 2""")
def _(t: Tables):
    """Both tables published by order key; the join and the sum need no shuffle then."""
    orders, items = work_folder(t.spark, "orders"), work_folder(t.spark, "items")
    writers.publish_bucketed(t.orders.select("o_orderkey", "o_custkey"), orders, schemas.struct("o_orderkey:l o_custkey:l"), key="o_orderkey", buckets=16)
    writers.publish_bucketed(
        t.lineitem.select("l_orderkey", F.col("l_quantity").cast(text.MONEY).alias("l_quantity")), items,
        schemas.struct("l_orderkey:l l_quantity:m"), key="l_orderkey", buckets=16,
    )
    left, right = readers.read_bucketed(t.spark, orders), readers.read_bucketed(t.spark, items)
    sums = right.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count(F.lit(1)).alias("items"), F.sum("l_quantity").alias("quantity"))
    return left.join(sums, "o_orderkey", "left").select("o_orderkey", "o_custkey", F.coalesce("items", F.lit(0)).alias("items"), "quantity")


@probe("S05_text_sheet", """
    select cast(s_suppkey as varchar) as s_suppkey, s_name,
           cast(cast(s_acctbal as decimal(18,2)) as varchar) as balance from supplier""")
def _(t: Tables):
    path = work_folder(t.spark, "sheet")
    writers.write_sheet(
        t.supplier.select(
            "s_suppkey", "s_name", F.col("s_acctbal").cast(text.MONEY).alias("Balance Due"), "s_nationkey"
        ),
        path,
    )
    return readers.read_text_sheet(
        t.spark, path, {"s_suppkey": "s_suppkey", "s_name": "s_name", "Balance Due": "balance"}
    )


@probe("S06_column_allow_list", "select p_partkey, p_brand, p_size from part")
def _(t: Tables):
    return t.part.select("p_partkey", "p_brand", "p_size")


@probe("S07_full_replace", """
    select cast(n_nationkey as bigint) as lender_id, 'Lender ' || n_name as lender_name,
           cast(null as varchar) as additional_details from nation""")
def _(t: Tables):
    path = work_folder(t.spark, "replace")
    rows = t.nation.select(
        F.col("n_nationkey").alias("lender_id"),
        F.concat(F.lit("Lender "), "n_name").alias("lender_name"),
        F.lit(None).alias("additional_details"),
    )
    for _attempt in range(2):
        writers.publish(rows, path, LENDER)
    return readers.read_table(t.spark, path, LENDER)


@probe("S08_rerun_safe_append", """
    select event_id, ts, cast(ts as date) as run_date from events
    where ts >= timestamp '2024-01-13 00:00:00' and ts < timestamp '2024-01-15 00:00:00'""")
def _(t: Tables):
    path = work_folder(t.spark, "append")
    layout = schemas.struct("event_id:l ts:t")
    for day in (13, 14, 13):
        run = dt.date(2024, 1, day)
        rows = t.events.where(clock.in_local_days(F.col("ts"), run, run, dt.timedelta(0)))
        writers.publish(rows.select("event_id", "ts"), path, layout, run_date=run)
    return t.spark.read.parquet(path)


@probe("S09_compressed_csv", "select cast(c_custkey as varchar) as c_custkey, c_name from customer")
def _(t: Tables):
    path = work_folder(t.spark, "csv")
    writers.write_csv(t.customer.select("c_custkey", "c_name"), path)
    return readers.read_text_sheet(t.spark, path, ["c_custkey", "c_name"], multi_line=False)


@probe("S10_replace_sheet", "select cast(n_nationkey as varchar) as n_nationkey, n_name from nation")
def _(t: Tables):
    path = work_folder(t.spark, "range")
    for _attempt in range(2):
        writers.write_sheet(t.nation.select("n_nationkey", "n_name"), path)
    return readers.read_text_sheet(t.spark, path, ["n_nationkey", "n_name"])


@probe("S11_declared_schema", """
    select o_orderkey as id, cast(o_totalprice as decimal(18,2))::double as amount,
           o_orderdate as created_on from orders""")
def _(t: Tables):
    rows = t.orders.select(
        F.col("o_orderdate").alias("created_on"), F.col("o_totalprice").alias("amount"),
        F.col("o_orderkey").alias("id"),
    )
    return schemas.conform(rows, schemas.struct("id:l amount:m created_on:t"))


@probe("S12_stringified", """
    select cast(o_orderkey as varchar) as o_orderkey, cast(cast(o_orderdate as date) as varchar) as day,
           case when o_orderstatus = 'P' then null else o_orderstatus end as status from orders""")
def _(t: Tables):
    rows = t.orders.select(
        "o_orderkey", F.col("o_orderdate").cast("date").alias("day"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("status"),
    )
    return rows.select(*text.stringify("o_orderkey", "day", "status"))


# ---- filters and labels --------------------------------------------------------------


@probe("F01_equality_and_in", """
    select o_orderkey from orders where o_orderstatus in ('F', 'O') and o_orderpriority <> '5-LOW'""")
def _(t: Tables):
    return t.orders.where(
        F.col("o_orderstatus").isin("F", "O") & (F.col("o_orderpriority") != "5-LOW")
    ).select("o_orderkey")


@probe("F02_non_blank", "select personnel_id, phone from personnel where trim(phone) <> ''", "personnel")
def _(t: Tables):
    return t.view("personnel").where(text.non_blank(F.col("phone"))).select("personnel_id", "phone")


@probe("F03_case_insensitive", """
    select phase_id from insurance_phase where upper(phase_type) = 'INSURANCE_DOCS_APPROVAL'""",
       "insurance_phase")
def _(t: Tables):
    return t.view("insurance_phase").where(F.upper("phase_type") == v.DOCS_PHASE).select("phase_id")


@probe("F04_local_day_window", """
    select event_id from events
    where cast(ts + interval '330 minutes' as date) between date '2024-01-05' and date '2024-01-09'""")
def _(t: Tables):
    return t.events.where(
        clock.in_local_days(F.col("ts"), dt.date(2024, 1, 5), dt.date(2024, 1, 9))
    ).select("event_id")


@probe("F05_previous_local_day", """
    select event_id from events
    where ts >= timestamp '2024-01-13 18:30:00' and ts < timestamp '2024-01-14 18:30:00'""")
def _(t: Tables):
    return t.events.where(clock.in_previous_local_day(F.col("ts"), EVENT_DAY)).select("event_id")


@probe("F06_up_to_yesterday", """
    select event_id from events where cast(ts + interval '330 minutes' as date) <= date '2024-01-14'""")
def _(t: Tables):
    return t.events.where(clock.up_to_yesterday(F.col("ts"), EVENT_DAY)).select("event_id")


@probe("F07_time_of_day_slot", """
    select event_id, 'noon' as slot from events
    where cast(ts as time) between time '12:05:00' and time '12:15:00'
    union all
    select event_id, 'midnight' as slot from events
    where cast(ts as time) >= time '23:55:00' or cast(ts as time) <= time '00:05:00'""")
def _(t: Tables):
    ts = F.col("ts")
    slot = F.when(clock.in_time_slot(ts, dt.time(12, 5), 10), "noon").when(
        clock.in_time_slot(ts, dt.time(23, 55), 10), "midnight"
    )
    return t.events.select("event_id", slot.alias("slot")).where(F.col("slot").isNotNull())


@probe("F08_json_predicate", """
    select id from one_time_message where json_extract_string(additional_details, '$.cashPromoDone') = 'true'""",
       "one_time_message")
def _(t: Tables):
    done = F.get_json_object("additional_details", "$.cashPromoDone") == "true"
    return t.view("one_time_message").where(done).select("id")


@probe("F09_direction_by_pair", """
    select id, case when from_id = to_message then 'Inbound' else 'Outbound' end as direction
    from chat_message""", "chat_message")
def _(t: Tables):
    return t.view("chat_message").select(
        "id", text.chat_direction(F.col("from_id"), F.col("to_message")).alias("direction")
    )


@probe("F10_status_set", "select event_id, event_type from events where event_type in ('error', 'purchase')")
def _(t: Tables):
    return t.events.where(F.col("event_type").isin("error", "purchase")).select("event_id", "event_type")


@probe("F11_city_label", """
    select p.id, coalesce(case coalesce(c.city_name, h.city_name) when 'Chandigarh' then 'CHD' when 'Bangalore' then 'BLR'
                          else coalesce(c.city_name, h.city_name) end, 'No City') as city
    from patient p left join patient_case k on k.patient_id = p.id
    left join city c on c.id = k.city_id left join city h on h.id = p.city_id""", "patient patient_case city")
def _(t: Tables):
    patient, case, city = t.views("patient patient_case city")
    case_city = city.select(F.col("id").alias("case_city_id"), F.col("city_name").alias("case_city"))
    home_city = city.select(F.col("id").alias("home_city_id"), F.col("city_name").alias("home_city"))
    rows = (
        patient.select("id", F.col("city_id").alias("home_city_id"))
        .join(case.select(F.col("patient_id").alias("id"), F.col("city_id").alias("case_city_id")), "id", "left")
        .join(case_city, "case_city_id", "left")
        .join(home_city, "home_city_id", "left")
    )
    label = text.city_label(F.col("case_city"), F.col("home_city"), missing=v.NO_CITY, short=CITY_SHORT)
    return rows.select("id", label.alias("city"))


CODE_SQL = "case city_id when 1 then 'CHD' when 2 then 'BLR' when 3 then 'Jaipur' when 4 then 'NCR' when 5 then 'Hyderabad' end"


@probe("F12_code_map", f"""
    select personnel_id, {CODE_SQL} as city from personnel where city_id between 1 and 5""", "personnel")
def _(t: Tables):
    rows, _rejected = reporting.apply_codes(t.view("personnel"), F.col("city_id"), CITY_CODES, "city")
    return rows.select("personnel_id", "city")


@probe("F12_code_map_rejects", """
    select 'unknown code for city: ' || cast(city_id as varchar) as reject_reason, count(*) as rows
    from personnel where city_id not between 1 and 5 group by 1""", "personnel")
def _(t: Tables):
    _rows, rejected = reporting.apply_codes(t.view("personnel"), F.col("city_id"), CITY_CODES, "city")
    return reporting.reject_counts(rejected)


@dataclass(frozen=True)
class Views(Inputs):
    """A job's inputs straight from the bound views."""

    tables_: Tables | None = None

    def table(self, name: str) -> DataFrame:
        return self.tables_.view(name)


@probe("F12_run_report", """
    select 'personnel' as "table", 'read' as measure, null::varchar as reason, count(*) as rows from personnel
    union all select 'personnel', 'rejected', 'unknown code for city', count(*) from personnel where coalesce(city_id not between 1 and 5, true)
    union all select 'personnel_detail', 'published', null, count(*) from personnel where city_id between 1 and 5
    union all select 'personnel_rejects', 'published', null, count(*) from personnel where coalesce(city_id not between 1 and 5, true)""", "personnel")
def _(t: Tables):
    out = work_folder(t.spark, "run")
    paths = run("personnel_profiles", Views(t.spark, "", roles=ROLES, tables_=t), out, dt.date(2024, 1, 15))
    return t.spark.read.parquet(paths[-1]).drop("run_date")


@probe("F13_office_hours", """
    select event_id, case when hour(ts) between 8 and 20 then 'OFFICE_HOUR' else 'OFF_HOUR' end as hour_tag from events""")
def _(t: Tables):
    return t.events.select("event_id", clock.office_hours(F.col("ts")).alias("hour_tag"))


@probe("F14_period_flags", """
    select o_orderkey, cast(o_orderdate as date) = date '2000-06-14' as yesterday,
           cast(o_orderdate as date) between date '2000-06-01' and date '2000-06-14' as month_to_date,
           cast(o_orderdate as date) between date '2000-05-01' and date '2000-05-31' as last_month
    from orders""")
def _(t: Tables):
    flags = clock.Periods(AS_OF).flags(F.col("o_orderdate"))
    return t.orders.select("o_orderkey", *[e.alias(n) for n, e in flags.items()])


@probe("F15_availability_label", """
    select personnel_id, case when is_available = 1 then 'Available' else 'UnAvailable' end as availability
    from personnel""", "personnel")
def _(t: Tables):
    label = F.when(F.col("is_available") == 1, "Available").otherwise("UnAvailable")
    return t.view("personnel").select("personnel_id", label.alias("availability"))


@probe("F16_ordered_overwrite", """
    select o_orderkey, case when o_orderpriority = '5-LOW' then 'lender_not_updated'
                            when o_orderstatus = 'P' then 'admission_date_not_updated'
                            when o_orderdate between timestamp '1996-01-01' and timestamp '1999-12-31' then 'commission_calculated'
                       end as note from orders""")
def _(t: Tables):
    lender = F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority"))
    admission = F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate"))
    note = pricing.statement_label(
        lender, admission, clock.instant(dt.datetime(1996, 1, 1)), clock.instant(dt.datetime(1999, 12, 31))
    )
    return t.orders.select("o_orderkey", note.alias("note"))


@probe("F17_published_layout", """
    select s_name as hospital, s_suppkey as hospital_id, s_nationkey as city_id from supplier""")
def _(t: Tables):
    layout = {"s_name": "hospital", "s_suppkey": "hospital_id", "s_nationkey": "city_id"}
    return t.supplier.select(*[F.col(old).alias(new) for old, new in layout.items()])


@probe("F18_constant_columns", """
    select c_custkey, 'Partner' as source, 'Dashboard' as patient_source, cast(null as varchar) as remarks, '' as menu_check
    from customer""")
def _(t: Tables):
    return t.customer.select(
        "c_custkey", F.lit(v.ROLES.case_source).alias("source"),
        F.lit(v.ROLES.patient_source).alias("patient_source"),
        F.lit(None).cast("string").alias("remarks"), F.lit("").alias("menu_check"),
    )


@probe("F19_null_default", "select sid, coalesce(duration, 0) as duration from call", "call")
def _(t: Tables):
    return t.view("call").select("sid", F.coalesce("duration", F.lit(0)).alias("duration"))


@probe("F20_history_start", """
    select o_orderkey from orders where o_orderdate + interval '330 minutes' >= timestamp '1999-10-12 00:00:00'""")
def _(t: Tables):
    return t.orders.where(
        clock.since_local(F.col("o_orderdate"), dt.datetime(1999, 10, 12))
    ).select("o_orderkey")


@probe("F21_label_by_id_set", """
    select id, case when asset_id in (255, 256) then 'Home_pick' else 'Diagnostics_test' end as nudge
    from message_log where asset_id in (251, 252, 253, 254, 255, 256, 258)""", "message_log")
def _(t: Tables):
    nudge = F.when(F.col("asset_id").isin(*ROLES.home_pick_assets), v.HOME_PICK).otherwise(v.DIAGNOSTICS_TEST)
    rows = t.view("message_log").where(F.col("asset_id").isin(*ROLES.diagnostic_assets))
    return rows.select("id", nudge.alias("nudge"))


# ---- scalar functions ----------------------------------------------------------------


@probe("C01_C03_local_time_parts", """
    select event_id, ts + interval '330 minutes' as local_ts, cast(ts + interval '330 minutes' as date) as day,
           cast(hour(ts + interval '330 minutes') as int) as hour, cast(month(ts + interval '330 minutes') as int) as month,
           cast(year(ts + interval '330 minutes') as int) as year,
           cast(year(ts) as varchar) || '-' || cast(month(ts) as varchar) as year_month
    from events""")
def _(t: Tables):
    local = clock.to_local(F.col("ts"))
    return t.events.select(
        "event_id", local.alias("local_ts"), local.cast("date").alias("day"),
        F.hour(local).alias("hour"), F.month(local).alias("month"), F.year(local).alias("year"),
        clock.year_month_label(F.col("ts")).alias("year_month"),
    )


@probe("C04_short_time_text", "select event_id, strftime(ts, '%b %d, %H:%M:%S') as seen from events")
def _(t: Tables):
    return t.events.select("event_id", clock.short_time_text(F.col("ts")).alias("seen"))


@probe("C05_elapsed_seconds", """
    select event_id, cast(floor((epoch_us(ts) - epoch_us(timestamp '2024-01-15 12:00:00.5')) / 1000000.0) as bigint) as seconds
    from events""")
def _(t: Tables):
    start = clock.instant(dt.datetime(2024, 1, 15, 12, 0, 0, 500000))
    return t.events.select("event_id", clock.elapsed_seconds(start, F.col("ts")).alias("seconds"))


ADMISSION = "$.surgeryDischargeDoneRequest.admissionDate"


@probe("C06_C18_json_text_to_time", f"""
    select phase_id, json_extract_string(additional_details, '{ADMISSION}') as admission_text,
           try_cast(json_extract_string(additional_details, '{ADMISSION}') as timestamp) as admission
    from insurance_phase""", "insurance_phase")
def _(t: Tables):
    raw = F.get_json_object("additional_details", ADMISSION)
    return t.view("insurance_phase").select(
        "phase_id", raw.alias("admission_text"), clock.parse_time(raw).alias("admission")
    )


@probe("C07_case_folding", "select c_custkey, lower(c_name) as low, upper(c_mktsegment) as high from customer")
def _(t: Tables):
    return t.customer.select(
        "c_custkey", F.lower("c_name").alias("low"), F.upper("c_mktsegment").alias("high")
    )


PHONE_SQL = "nullif(right(regexp_replace({0}, '\\D', '', 'g'), 10), '')"


@probe("C08_phone", f"select personnel_id, {PHONE_SQL.format('phone')} as number from personnel", "personnel")
def _(t: Tables):
    return t.view("personnel").select("personnel_id", text.phone(F.col("phone")).alias("number"))


@probe("C09_counterparty", f"""
    select sid, case when direction = 'inbound' then {PHONE_SQL.format('from_no')} else {PHONE_SQL.format('to_no')} end as customer_no
    from call""", "call")
def _(t: Tables):
    number = text.counterparty(F.col("direction"), F.col("from_no"), F.col("to_no"))
    return t.view("call").select("sid", number.alias("customer_no"))


@probe("C10_number_class", f"""
    select sid, case when {PHONE_SQL.format('to_no')} in ('9100000007', '9100000011') then 'IVR' else 'Non-IVR' end as class
    from call""", "call")
def _(t: Tables):
    menu = ["9100000007", "9100000011"]
    return t.view("call").select("sid", text.number_class(F.col("to_no"), menu).alias("class"))


BILL = "$.surgeryDischargeApprovalInfo.totalBillAmount"
APPROVED = "$.surgeryDischargeApprovalInfo.finalApprovedAmount"


@probe("C11_money_text", f"""
    select phase_id, cast(try_cast(replace(json_extract_string(additional_details, '{BILL}'), ',', '') as decimal(18,2)) as double) as total_bill,
           cast(try_cast(replace(json_extract_string(additional_details, '{APPROVED}'), ',', '') as decimal(18,2)) as double) as approved,
           json_extract_string(additional_details, '{APPROVED}') = 'n/a' as rejected
    from insurance_phase""", "insurance_phase")
def _(t: Tables):
    bill, approved = (F.get_json_object("additional_details", p) for p in (BILL, APPROVED))
    return t.view("insurance_phase").select(
        "phase_id", text.money(bill).alias("total_bill"), text.money(approved).alias("approved"),
        text.unreadable(approved, text.money(approved)).alias("rejected"),
    )


@probe("C12_C13_percent_with_tax", """
    select key, share_pct, cast(replace(share_pct, '%', '') as double) / 100 as share,
           round(cast(replace(share_pct, '%', '') as double) / 100 * 1.18, 6) as net_share
    from rate_agreement""", "rate_agreement")
def _(t: Tables):
    share = text.percent(F.col("share_pct"))
    return t.view("rate_agreement").select(
        "key", "share_pct", share.alias("share"), pricing.with_tax(share).alias("net_share")
    )


@probe("C14_C15_charges", """
    select o_orderkey, basis::double as basis, share::double as share, total::double as total_share,
           (total - share)::double as tax, (approved - total - 10 + 5)::double as payable
    from (select *, round(basis * 0.1, 4) as share, round(basis * 0.118, 4) as total
          from (select o_orderkey, cast(o_totalprice as decimal(18,2)) as approved,
                       case o_orderstatus when 'F' then cast(o_totalprice as decimal(18,2))
                                          when 'O' then cast(1000 as decimal(18,2)) end as basis from orders))""")
def _(t: Tables):
    approved = F.col("o_totalprice").cast(text.MONEY)
    remark = F.when(F.col("o_orderstatus") == "F", "On Approved Amount").when(
        F.col("o_orderstatus") == "O", "on total bill amount"
    )
    rows = t.orders.select(
        "o_orderkey", approved.alias("approved"),
        pricing.charge_basis(remark, approved, F.lit("1000").cast(text.MONEY)).alias("basis"),
    )
    share = (F.col("basis") * F.lit("0.1").cast(text.RATE)).cast(pricing.AMOUNT)
    total = (F.col("basis") * F.lit("0.118").cast(text.RATE)).cast(pricing.AMOUNT)
    money = lambda n: F.lit(n).cast(text.MONEY)
    return rows.select(
        "o_orderkey", "basis", share.alias("share"), total.alias("total_share"),
        (total - share).cast(pricing.AMOUNT).alias("tax"),
        pricing.net_payable(F.col("approved"), total, money(10), money(5), money(0)).alias("payable"),
    )


@probe("C16_C17_category_key", """
    select phase_id, category, 'H' || lender_name || category as key from (
      select phase_id, lender_name, case when lender_name is null then 'None' when lender_name = 'Own PDC' then 'PDC-Own'
        when lender_name = 'Hospital PDC' then 'PDC Hospital' else '24HR' end as category
      from (select s.sub_phase_id as phase_id, l.lender_name from insurance_sub_phase s
            left join insurance_lender l
              on l.lender_id = try_cast(json_extract_string(s.additional_details, '$.financeEligibilityInfo.lenderId') as bigint)))
    """, "insurance_sub_phase insurance_lender")
def _(t: Tables):
    sub, lender = t.views("insurance_sub_phase insurance_lender")
    lender_id = F.get_json_object("additional_details", "$.financeEligibilityInfo.lenderId").try_cast("bigint")
    rows = sub.select(F.col("sub_phase_id").alias("phase_id"), lender_id.alias("lender_id")).join(
        lender.select("lender_id", "lender_name"), "lender_id", "left"
    )
    category = pricing.lender_category(F.col("lender_name"))
    return rows.select(
        "phase_id", category.alias("category"),
        text.joined_key(F.lit("H"), F.col("lender_name"), category).alias("key"),
    )


@probe("C19_json_array", """
    select id, coalesce(cast(json_array_length(json_extract(insight_data, '$.insightData.agents')) > 0 as varchar), 'absent') as filled
    from call_document where insight_type = 'INBOUND_PATIENT_CALL_LIST'""", "call_document")
def _(t: Tables):
    docs = t.view("call_document").where(F.col("insight_type") == v.LIST_DOCUMENT)
    filled = array_filled(F.col("insight_data"), "$.insightData.agents").cast("string")
    return docs.select("id", F.coalesce(filled, F.lit("absent")).alias("filled"))


@probe("C20_document_fields", """
    select id, json_extract(insight_data, '$.insightData') is not null as present,
           coalesce(upper(json_extract_string(insight_data, '$.insightData.leg1DetailedStatus')), 'NO_CALL_INSIGHT') as d1,
           coalesce(json_extract_string(insight_data, '$.insightData.leg2Status'), '') as leg2
    from call_document where insight_type = 'INCOMING_EXOTEL_CALL_DETAILS'""", "call_document")
def _(t: Tables):
    docs = t.view("call_document").where(F.col("insight_type") == v.DETAIL_DOCUMENT)
    return docs.withColumn("p", payload(F.col("insight_data"))).select(
        "id", F.col("p").isNotNull().alias("present"),
        F.coalesce(F.upper("p.leg1DetailedStatus"), F.lit(v.NO_DOCUMENT)).alias("d1"),
        F.coalesce("p.leg2Status", F.lit("")).alias("leg2"),
    )


STATUS_SQL = """
    case when base = 'CANCELED' and sent then 'CUSTOMER_CANCELLED' when base = 'CANCELED' and not sent then 'NO_NUMBER_TO_DIALOUT_CANCELED'
         when base = 'BUSY' and not sent then 'NO_NUMBER_TO_DIALOUT_BUSY' else base end"""


def base_status_sql(d1: str, d2: str, d3: str, leg1: str, leg2: str) -> str:
    return f"""case when coalesce(upper({d1}), '') = 'CALL_COMPLETED' or coalesce(upper({d2}), '') = 'CALL_COMPLETED'
          or coalesce(upper({d3}), '') = 'CALL_COMPLETED' then 'CALL_COMPLETED'
        when coalesce(upper({d1}), 'NO_CALL_INSIGHT') <> 'NO_CALL_INSIGHT' then upper({d1})
        when {leg2} = 'completed' then 'CALL_COMPLETED' when {leg2} <> '' then upper({leg2})
        when {leg1} = 'completed' then 'LEG_1_COMPLETED' when {leg1} <> '' then upper({leg1}) else 'NO_CALL_INSIGHT' end"""


@probe("C21_final_status", f"""
    select sid, {STATUS_SQL} as final_status from (
      select sid, sent, {base_status_sql('d1', 'd2', 'null', 'leg_1_status', 'leg_2_status')} as base
      from (select sid, leg_1_status, leg_2_status, case id % 3 when 0 then true when 1 then false end as sent,
                   case id % 6 when 0 then 'canceled' when 1 then 'busy' when 2 then 'call_completed' end as d1,
                   case when id % 11 = 0 then 'Call_Completed' end as d2 from call))""", "call")
def _(t: Tables):
    i = F.col("id")
    sent = F.when(i % 3 == 0, F.lit(True)).when(i % 3 == 1, F.lit(False))
    d1 = F.when(i % 6 == 0, "canceled").when(i % 6 == 1, "busy").when(i % 6 == 2, "call_completed")
    d2 = F.when(i % 11 == 0, "Call_Completed")
    status = calls.final_status(
        d1, d2, F.lit(None).cast("string"), F.col("leg_1_status"), F.col("leg_2_status"), sent
    )
    return t.view("call").select("sid", status.alias("final_status"))


@probe("C22_menu_outcome", """
    select id, case id % 3
        when 0 then case when option_value = 1 then 'Call Transferred' else 'WhatsApp Flow' end
        when 1 then coalesce(case when id % 4 = 0 then 'second' end, case when id % 5 = 0 then 'first' end, 'WhatsApp Flow')
        else case when option_value in (1, 2, 3) then 'Call Transferred' else 'WhatsApp Flow' end end as outcome
    from menu_answer""", "menu_answer")
def _(t: Tables):
    i = F.col("id")
    flow = F.when(i % 3 == 0, v.SINGLE_LEVEL_FLOW).when(i % 3 == 1, v.MULTI_LEVEL_FLOW).otherwise("OTHER")
    outcome = calls.menu_outcome(
        flow, F.col("option_value"), F.when(i % 5 == 0, "first"), F.when(i % 4 == 0, "second")
    )
    return t.view("menu_answer").select("id", outcome.alias("outcome"))


@probe("C23_document_call_id", """
    select event_id, case event_id % 4 when 0 then 's' || event_id when 1 then 'n' || event_id end as call_id from events""")
def _(t: Tables):
    i = F.col("event_id")
    key = i.cast("string")
    reply = (
        F.when(i % 4 == 0, F.concat(F.lit('{"callSid":"s'), key, F.lit('"}')))
        .when(i % 4 == 1, F.concat(F.lit('{"Call":{"Sid":"n'), key, F.lit('"}}')))
        .when(i % 4 == 2, F.lit('{"callSid":null,"Call":{"Sid":"x"}}'))
        .otherwise(F.lit("{}"))
    )
    return t.events.select("event_id", calls.document_call_id(reply).alias("call_id"))


@probe("C24_existence_label", """
    select c.sid, case when d.sid is null then 'Non-IVR' else 'IVR' end as menu, coalesce(d.status, '') as status
    from call c left join (select call_sid as sid, min(id)::varchar as status from call_document
                           where insight_type = 'INBOUND_PATIENT_CALL_LIST' group by 1) d on d.sid = c.sid""",
       "call call_document")
def _(t: Tables):
    docs = t.view("call_document").where(F.col("insight_type") == v.LIST_DOCUMENT)
    known = lookup.first_per_key(
        docs.select(F.col("call_sid").alias("sid"), "id", F.col("id").cast("string").alias("status")),
        "sid", "id", ["status"],
    ).withColumn("menu", F.lit(v.MENU))
    return lookup.left_lookup(
        t.view("call").select("sid"), known, "sid", {"status": "", "menu": v.NOT_MENU}
    ).select("sid", "menu", "status")


@probe("C27_code_label", """
    select l.id, case when c.cashback_id is null then '' else c.cashback_type end as label
    from cash_ledger l left join (select * from cashback_type where is_active = 1) c on c.cashback_id = l.cashback_type""",
       "cash_ledger cashback_type")
def _(t: Tables):
    ledger, types = t.views("cash_ledger cashback_type")
    active = types.where(F.col("is_active") == 1).select(
        F.col("cashback_id").alias("cashback_type"), F.col("cashback_type").alias("label")
    )
    return lookup.left_lookup(
        ledger.select("id", "cashback_type"), active, "cashback_type", {"label": ""}
    ).select("id", "label")


@probe("C28_C29_currency", r"""
    select id, amount, case when cents = '00' then grouped else grouped || '.' || cents end as shown
    from (select id, amount, right(txt, 2) as cents,
                 case when length(whole) <= 3 then whole
                      else ltrim(reverse(regexp_replace(reverse(left(whole, length(whole) - 3)), '(\d\d)', '\1,', 'g')), ',')
                           || ',' || right(whole, 3) end as grouped
          from (select id, amount, txt, left(txt, length(txt) - 3) as whole
                from (select id, amount / 100 as amount, printf('%d.%02d', amount // 100, amount % 100) as txt
                      from cash_ledger)))""", "cash_ledger")
def _(t: Tables):
    amount = text.major_units(F.col("amount"))
    return t.view("cash_ledger").select(
        "id", amount.alias("amount"), text.format_inr(amount).alias("shown")
    )
