"""Probes: joins, aggregations, windows, sorts and set operations."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from fieldbook import vocabulary as v
from fieldbook.functions import clock, text
from fieldbook.operators import (
    attribution, documents, funnel, ledger, lookup, per_user, pricing, reporting,
)
from fieldbook.operators.activity import active_seconds, with_next_row
from fieldbook.operators.ranges import MICROS, later_minima
from fieldbook.plans import cashback
from fieldbook.plans.campaign_log import CampaignLog
from fieldbook.plans.user_log import UserLog
from fieldbook.probes.deployment import ROLES
from fieldbook.probes.registry import Tables, probe
from fieldbook.probes.rows import AS_OF
from fieldbook.session import work_folder

# ---- joins ---------------------------------------------------------------------------


@probe("N01_inner_join", """
    select o_orderkey, c_name, o_totalprice from orders join customer on c_custkey = o_custkey""")
def _(t: Tables):
    return t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey", "c_name", "o_totalprice"
    )


@probe("N02_left_join_chain", """
    select c_custkey, n_name, r_name from customer
    left join nation on n_nationkey = c_nationkey left join region on r_regionkey = n_regionkey""")
def _(t: Tables):
    return (
        t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"), "left")
        .select("c_custkey", "n_name", "r_name")
    )


@probe("N03_left_join_filtered_right", """
    select c_custkey, o_orderkey from customer
    left join orders on o_custkey = c_custkey and o_orderstatus = 'O' and o_orderpriority = '1-URGENT'""")
def _(t: Tables):
    urgent = t.orders.where((F.col("o_orderstatus") == "O") & (F.col("o_orderpriority") == "1-URGENT"))
    return t.customer.join(
        urgent.select(F.col("o_custkey").alias("c_custkey"), "o_orderkey"), "c_custkey", "left"
    ).select("c_custkey", "o_orderkey")


@probe("N04_inner_join_filtered", """
    select o_orderkey, c_custkey from orders
    join customer on c_custkey = o_custkey and c_mktsegment = 'FURNITURE' where cast(o_orderdate as date) < date '2000-06-15'""")
def _(t: Tables):
    field = t.customer.where(F.col("c_mktsegment") == "FURNITURE").select("c_custkey")
    return (
        t.orders.where(F.col("o_orderdate") < clock.instant(dt.datetime(2000, 6, 15)))
        .join(field, F.col("o_custkey") == F.col("c_custkey"))
        .select("o_orderkey", "c_custkey")
    )


@probe("N05_join_on_json_key", """
    select event_id, n_name from events
    left join nation on n_nationkey = try_cast(json_extract_string(props, '$.k') as bigint)""")
def _(t: Tables):
    key = F.get_json_object("props", "$.k").try_cast("bigint")
    nations = t.nation.select(F.col("n_nationkey").cast("long").alias("k"), "n_name")
    return t.events.withColumn("k", key).join(nations, "k", "left").select("event_id", "n_name")


@probe("N06_in_subquery", """
    select o_orderkey from orders where o_orderkey in
      (select l_orderkey from lineitem where l_returnflag in ('R', 'A') and l_quantity > 45)""")
def _(t: Tables):
    big = t.lineitem.where(F.col("l_returnflag").isin("R", "A") & (F.col("l_quantity") > 45))
    return t.orders.join(big, F.col("o_orderkey") == F.col("l_orderkey"), "left_semi").select("o_orderkey")


@probe("N07_key_list_semi_join", """
    select l_orderkey, cast(sum(cast(l_quantity as decimal(18,2))) as double) as quantity from lineitem
    where l_orderkey in (select o_orderkey from orders where o_orderpriority = '1-URGENT') group by l_orderkey""")
def _(t: Tables):
    urgent = t.orders.where(F.col("o_orderpriority") == "1-URGENT").select(
        F.col("o_orderkey").alias("l_orderkey")
    )
    return lookup.restrict_to(t.lineitem, urgent, "l_orderkey").groupBy("l_orderkey").agg(
        F.sum(F.col("l_quantity").cast(text.MONEY)).alias("quantity")
    )


@probe("N08_existence_flag", """
    select c_custkey, c_custkey in (select o_custkey from orders where o_orderpriority = '1-URGENT' and o_orderstatus = 'F') as urgent
    from customer""")
def _(t: Tables):
    urgent = t.orders.where(
        (F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderstatus") == "F")
    ).select(F.col("o_custkey").alias("c_custkey"))
    return lookup.flag_present(t.customer.select("c_custkey"), urgent, "c_custkey", "urgent")


@probe("N09_missing_match", """
    select o_orderkey from orders where not exists (select 1 from lineitem where l_orderkey = o_orderkey)""")
def _(t: Tables):
    items = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"))
    return lookup.without_match(t.orders.select("o_orderkey"), items, "o_orderkey")


@probe("N10_first_match_lookup", """
    select c.personnel_id, case when p.personnel_id is null then '' else p.permission_type end as permission_type
    from personnel c left join (select personnel_id, arg_min(permission_type, id) as permission_type
                                from personnel_permission group by 1) p on p.personnel_id = c.personnel_id""",
       "personnel personnel_permission")
def _(t: Tables):
    people, permissions = t.views("personnel personnel_permission")
    first = lookup.first_per_key(permissions, "personnel_id", "id", ["permission_type"])
    return lookup.left_lookup(
        people.select("personnel_id"), first, "personnel_id", {"permission_type": ""}
    )


@probe("N11_last_informative", """
    select user_id, coalesce(arg_max(event_type, event_id) filter (event_type not in ('view')), 'view') as event_type
    from events group by user_id""")
def _(t: Tables):
    return lookup.last_informative(t.events, "user_id", "event_id", "event_type", "view")


@probe("N12_latest_per_key", """
    select user_id, max(ts) as ts, arg_max(event_type, struct_pack(a := ts, b := event_id)) as event_type
    from events group by user_id""")
def _(t: Tables):
    return lookup.latest_per_key(t.events, "user_id", ["ts", "event_id"], ["ts", "event_type"])


@probe("N13_priority_lookup", """
    select number, arg_min(name, rank * 1000000 + id) as name from (
      select s_suppkey % 70 as number, s_name as name, s_suppkey as id, 0 as rank from supplier
      union all select c_custkey % 150 as number, c_name as name, c_custkey as id, 1 as rank from customer) group by number""")
def _(t: Tables):
    support = t.supplier.select(
        (F.col("s_suppkey") % 70).alias("number"), F.col("s_name").alias("name"), F.col("s_suppkey").alias("id")
    )
    field = t.customer.select(
        (F.col("c_custkey") % 150).alias("number"), F.col("c_name").alias("name"), F.col("c_custkey").alias("id")
    )
    return lookup.by_priority([support, field], "number", "id", ["name"])


ROUTED_DIM = """
    select 'CUSTOMER_SUPPORT' as staff_group, c_custkey as agent_no, c_name as email, c_mktsegment as city from customer
    union all select 'FIELD_STAFF' as staff_group, s_suppkey as agent_no, s_name as email, 'F' as city from supplier"""


def _routed_dim(t: Tables):
    support = t.customer.select(
        F.lit(v.ROLES.support).alias("staff_group"), F.col("c_custkey").alias("agent_no"),
        F.col("c_name").alias("email"), F.col("c_mktsegment").alias("city"),
    )
    field = t.supplier.select(
        F.lit(v.ROLES.field_staff).alias("staff_group"), F.col("s_suppkey").alias("agent_no"),
        F.col("s_name").alias("email"), F.lit("F").alias("city"),
    )
    return support.unionByName(field)


@probe("N14_routed_lookup", f"""
    select e.event_id, coalesce(d.email, '') as agent_email, coalesce(d.city, '') as agent_city
    from events e left join ({ROUTED_DIM}) d on d.agent_no = e.user_id and
      d.staff_group = case when e.event_type = 'view' then 'FIELD_STAFF' else 'CUSTOMER_SUPPORT' end""")
def _(t: Tables):
    route = F.when(F.col("event_type") == "view", v.ROLES.field_staff).otherwise(v.ROLES.support)
    rows = lookup.multi_slot_lookup(
        t.events, _routed_dim(t), slots={"agent": "user_id"}, dim_key="agent_no",
        values=["email", "city"], route=route, dim_route="staff_group",
    )
    return rows.select("event_id", "agent_email", "agent_city")


SLOT_SQL = """
    select event_id, coalesce(a.s_name, '') as leg1_s_name, coalesce(b.s_name, '') as leg2_s_name, coalesce(c.s_name, '') as leg3_s_name
    from events left join supplier a on a.s_suppkey = user_id left join supplier b on b.s_suppkey = event_id % 150
    left join supplier c on c.s_suppkey = case when event_id % 3 = 0 then null else event_id % 90 end"""


def _slots(t: Tables):
    return t.events.select(
        "event_id", F.col("user_id").alias("k1"), (F.col("event_id") % 150).alias("k2"),
        F.when(F.col("event_id") % 3 != 0, F.col("event_id") % 90).alias("k3"),
    )


SLOTS = {"leg1": "k1", "leg2": "k2", "leg3": "k3"}


@probe("N15_multi_slot_lookup", SLOT_SQL)
def _(t: Tables):
    return lookup.multi_slot_lookup(
        _slots(t), t.supplier, slots=SLOTS, dim_key="s_suppkey", values=["s_name"]
    ).drop("k1", "k2", "k3")


@probe("N15_multi_slot_lookup_large", SLOT_SQL)
def _(t: Tables):
    return lookup.multi_slot_lookup(
        _slots(t), t.supplier, slots=SLOTS, dim_key="s_suppkey", values=["s_name"], row_id="event_id"
    ).drop("k1", "k2", "k3")


@probe("N16_newest_row_chain", """
    select c_custkey, f.k as newest_f, o.k as newest_o, p.k as newest_p from customer
    left join (select o_custkey, max(o_orderkey) as k from orders where o_orderstatus = 'F' group by 1) f on f.o_custkey = c_custkey
    left join (select o_custkey, max(o_orderkey) as k from orders where o_orderstatus = 'O' group by 1) o on o.o_custkey = c_custkey
    left join (select o_custkey, max(o_orderkey) as k from orders where o_orderstatus = 'P' group by 1) p on p.o_custkey = c_custkey""")
def _(t: Tables):
    out = t.customer.select("c_custkey")
    for status in "FOP":
        newest = lookup.latest_per_key(
            t.orders.where(F.col("o_orderstatus") == status).withColumnRenamed("o_custkey", "c_custkey"),
            "c_custkey", "o_orderkey", ["o_orderkey"],
        ).withColumnRenamed("o_orderkey", f"newest_{status.lower()}")
        out = out.join(newest, "c_custkey", "left")
    return out


@probe("N17_effective_period", """
    select o_orderkey, r.agreement from orders
    left join (select n_nationkey as k, 'early' as agreement, timestamp '1995-06-01' as s, timestamp '1997-12-31' as e from nation where n_regionkey <> 2
               union all select n_nationkey as k, 'late' as agreement, timestamp '1998-01-01' as s, cast(null as timestamp) as e from nation where n_regionkey in (1, 3)
              ) r on r.k = o_custkey % 30
    where not coalesce(case when o_orderstatus = 'P' then timestamp '1996-01-01' else o_orderdate end < s
                       or case when o_orderstatus = 'P' then timestamp '1996-01-01' else o_orderdate end > e, false)""")
def _(t: Tables):
    def agreement(rows, name, start, end):
        return rows.select(
            F.col("n_nationkey").cast("long").alias("k"), F.lit(name).alias("agreement"),
            clock.instant(start).alias("start_date"),
            (clock.instant(end) if end else F.lit(None).cast("timestamp_ntz")).alias("end_date"),
        )

    early = agreement(t.nation.where(F.col("n_regionkey") != 2), "early", dt.datetime(1995, 6, 1), dt.datetime(1997, 12, 31))
    late = agreement(t.nation.where(F.col("n_regionkey").isin(1, 3)), "late", dt.datetime(1998, 1, 1), None)
    cases = t.orders.select(
        "o_orderkey", (F.col("o_custkey") % 30).alias("k"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate")).alias("admission"),
    )
    effective = F.coalesce("admission", clock.instant(dt.datetime(1996, 1, 1)))
    return pricing.in_force(cases, early.unionByName(late), key="k", on_date=effective).select(
        "o_orderkey", "agreement"
    )


def attribution_sql(campaigns: list[str], rivals: str = "all", horizon: int | None = None) -> str:
    """Next strictly later events by a forward range frame; credit needs response < rival, and with ``horizon`` within so many microseconds."""
    near = "" if horizon is None else f" and {{0}} <= us + {horizon}"
    reply, spend = (f"{e} < coalesce(rival, 9e18){near.format(e)}" for e in "rs")
    minima = ",\n".join(
        f"min(case when kind = 'm' and campaign = '{c}' then us end) over w as c{i}"
        for i, c in enumerate(campaigns)
    )
    if rivals == "all":
        rival = "case campaign " + " ".join(
            f"when '{c}' then least({', '.join(f'c{j}' for j in range(len(campaigns)) if j != i)})"
            for i, c in enumerate(campaigns)
        ) + " end"
    else:
        rival = rivals
    return f"""
        select id, campaign, coalesce({reply}, false) as responded, case when {reply} then r_id end as response_id,
               coalesce({spend}, false) as used, case when {spend} then s_id end as spend_id
        from (select *, {rival} as rival, a_r.us as r, a_r.id as r_id, a_s.us as s, a_s.id as s_id from (
          select *, min(case when kind = 'r' then struct_pack(us := us, id := id) end) over w as a_r,
                 min(case when kind = 's' then struct_pack(us := us, id := id) end) over w as a_s,
                 {minima}
          from feed window w as (partition by k order by us range between 1 following and unbounded following)))
        where kind = 'm'"""


ORDER_CAMPAIGNS = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
ORDER_FEED = """
    with feed as (select o_custkey as k, epoch_us(o_orderdate) as us, o_orderkey as id, o_orderpriority as campaign,
                         case o_orderstatus when 'O' then 'm' when 'F' then 'r' else 's' end as kind from orders)"""
EVENT_CAMPAIGNS = ["view", "signup", "error"]
EVENT_FEED = """
    with feed as (select user_id as k, epoch_us(ts) as us, event_id as id, event_type as campaign,
                         case event_type when 'click' then 'r' when 'purchase' then 's' else 'm' end as kind from events)"""
ATTRIBUTED = ("id", "campaign", "responded", "response_id", "used", "spend_id")


# A third of all rows under one key.
HOT_ORDER_FEED = ORDER_FEED.replace("select o_custkey as k", "select case when o_custkey % 3 = 0 then 0 else o_custkey end as k")


def hot(key: str) -> Column:
    return F.when(F.col(key) % 3 == 0, 0).otherwise(F.col(key))


def order_feeds(t: Tables, key: Column | None = None):
    """Messages, responses and spends."""
    rows = t.orders.select(
        (F.col("o_custkey") if key is None else key).alias("k"), F.col("o_orderdate").alias("sent_on"),
        F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("campaign"), "o_orderstatus",
    )
    messages = rows.where(F.col("o_orderstatus") == "O").drop("o_orderstatus")
    responses = rows.where(F.col("o_orderstatus") == "F").withColumn("channel", F.lit(v.ROLES.chat_channel))
    spends = rows.where(F.col("o_orderstatus") == "P").select(
        "k", "sent_on", "id",
        F.when(F.col("campaign") == "1-URGENT", v.APPOINTMENT)
        .when(F.col("campaign") == "2-HIGH", v.DIAGNOSTICS)
        .when(F.col("campaign") == "3-MEDIUM", v.SURGERY)
        .when(F.col("campaign") == "4-NOT SPECIFIED", v.LOYALTY).alias("used_on"),
        F.when(F.col("id") % 3 == 0, v.FOLLOW_UP).alias("creation_type"),
    )
    return messages, responses, spends


def attributed_orders(t: Tables, key: Column | None = None, **options):
    return attribution.attribute(
        *order_feeds(t, key), key="k", ts="sent_on", campaign="campaign", id="id",
        campaigns=ORDER_CAMPAIGNS, **options,
    )


def attributed_events(t: Tables, **options):
    rows = t.events.select(
        F.col("user_id").alias("k"), F.col("ts").alias("sent_on"), F.col("event_id").alias("id"),
        F.col("event_type").alias("campaign"),
    )
    responses = rows.where(F.col("campaign") == "click").withColumn("channel", F.lit(v.ROLES.call_channel))
    spends = rows.where(F.col("campaign") == "purchase").select(
        "k", "sent_on", "id", F.lit(v.SURGERY).alias("used_on"), F.lit("").alias("creation_type")
    )
    return attribution.attribute(
        rows.where(F.col("campaign").isin(*EVENT_CAMPAIGNS)), responses, spends, key="k",
        ts="sent_on", campaign="campaign", id="id", campaigns=EVENT_CAMPAIGNS, **options,
    )


@probe("N18_attribution_orders", ORDER_FEED + attribution_sql(ORDER_CAMPAIGNS))
def _(t: Tables):
    return attributed_orders(t).select(*ATTRIBUTED)


@probe("N18_attribution_events", EVENT_FEED + attribution_sql(EVENT_CAMPAIGNS))
def _(t: Tables):
    return attributed_events(t).select(*ATTRIBUTED)


@probe("N18_attribution_hot_keys", HOT_ORDER_FEED + attribution_sql(ORDER_CAMPAIGNS))
def _(t: Tables):
    return attributed_orders(t, hot("o_custkey")).select(*ATTRIBUTED)


MONTH = dt.timedelta(days=30)


@probe("N18_attribution_within_a_month", ORDER_FEED + attribution_sql(ORDER_CAMPAIGNS, horizon=int(MONTH / dt.timedelta(microseconds=1))))
def _(t: Tables):
    return attributed_orders(t, horizon=MONTH).select(*ATTRIBUTED)


def in_stretches(t: Tables, ends: list[dt.datetime], horizon: dt.timedelta | None):
    """The orders taken in one stretch of time after another, each reading only what is open before it."""
    log = CampaignLog(t.spark, work_folder(t.spark, "log"), ORDER_CAMPAIGNS, horizon, key="k")
    for start, until in zip([dt.datetime(1900, 1, 1), *ends], [*ends, dt.datetime(2100, 1, 1)], strict=True):
        log.advance(*order_feeds(t), start, until)
    return log.answers().select(*ATTRIBUTED)


@probe("N18_attribution_in_two_halves", ORDER_FEED + attribution_sql(ORDER_CAMPAIGNS))
def _(t: Tables):
    return in_stretches(t, [dt.datetime(1998, 4, 1)], None)


@probe("N18_attribution_year_by_year", ORDER_FEED + attribution_sql(ORDER_CAMPAIGNS, horizon=int(MONTH / dt.timedelta(microseconds=1))))
def _(t: Tables):
    return in_stretches(t, [dt.datetime(year, 1, 1) for year in (1997, 1998, 2000)], MONTH)


@probe("N19_attribution_without_rivals", EVENT_FEED + attribution_sql(EVENT_CAMPAIGNS, "cast(null as bigint)"))
def _(t: Tables):
    return attributed_events(t, rivals={}).select(*ATTRIBUTED)


@probe("N19_attribution_one_rival", EVENT_FEED + attribution_sql(
    EVENT_CAMPAIGNS, "case when campaign <> 'error' then c2 else c0 end"))
def _(t: Tables):
    rivals = {"view": ["error"], "signup": ["error"], "error": ["view"]}
    return attributed_events(t, rivals=rivals).select(*ATTRIBUTED)


# ---- aggregations --------------------------------------------------------------------


@probe("A01_sum_by_key", """
    select entity_id, sum(amount) / 100 as paid from payment_link where status = 'PAID' and entity_type = 'APPOINTMENT'
    group by entity_id""", "payment_link")
def _(t: Tables):
    links = t.view("payment_link").where((F.col("status") == v.PAID) & (F.col("entity_type") == v.APPOINTMENT))
    return links.groupBy("entity_id").agg(F.sum(text.major_units(F.col("amount"))).alias("paid"))


@probe("A02_joined_names", """
    select appointment_id, string_agg(name, ',' order by name) as names
    from diagnostic_outcome join diagnostic on id = test_id where name is not null group by appointment_id""",
       "diagnostic_outcome diagnostic")
def _(t: Tables):
    outcomes, tests = t.views("diagnostic_outcome diagnostic")
    named = outcomes.join(tests.withColumnRenamed("id", "test_id"), "test_id")
    return reporting.joined_names(named, "appointment_id", "name", "names")


@probe("A03_aggregate_then_join", """
    select o_orderkey, coalesce(q, 0) as quantity from orders
    left join (select l_orderkey, cast(sum(cast(l_quantity as decimal(18,2))) as double) as q from lineitem group by 1) on l_orderkey = o_orderkey""")
def _(t: Tables):
    sums = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.sum(F.col("l_quantity").cast(text.MONEY)).alias("q")
    )
    return t.orders.select("o_orderkey").join(sums, "o_orderkey", "left").select(
        "o_orderkey", F.coalesce("q", F.lit(0)).alias("quantity")
    )


LEDGER_BIND = """
    select id, amount / 100 as amount, cashback_type, transaction_type, issued_entity_type,
           cast(created_on + interval '330 minutes' as date) as day,
           case when id % 4 = 0 then 'Partial_Payment' else 'Full_Payment' end as payment_tag,
           case id % 3 when 0 then 'FIELD_STAFF' when 1 then 'CS_AGENT' else 'NA' end as tag from cash_ledger"""
PERIOD_SUMS = """
    cast(coalesce(sum(case when day = date '2000-06-14' then cast(amount as decimal(18,2)) end), 0) as double) as yesterday,
    cast(coalesce(sum(case when day between date '2000-06-01' and date '2000-06-14' then cast(amount as decimal(18,2)) end), 0) as double) as month_to_date,
    cast(coalesce(sum(case when day between date '2000-05-01' and date '2000-05-31' then cast(amount as decimal(18,2)) end), 0) as double) as last_month"""
BUCKET_SQL = """case when issued_entity_type in ('APPOINTMENT', 'DIAGNOSTICS_APPOINTMENT', 'PATIENT_SURGERY', 'LOYALTY_CARD') then issued_entity_type
                     when transaction_type = 'CREDITED' and cashback_type = 6 then 'PROMOTIONAL' else 'OTHER' end"""


def bound_ledger(t: Tables):
    i = F.col("id")
    return t.view("cash_ledger").select(
        "id", text.major_units(F.col("amount")).alias("amount"), "cashback_type", "transaction_type",
        "issued_entity_type", clock.to_local(F.col("created_on")).alias("created_on"),
        F.when(i % 4 == 0, v.PARTIAL_PAYMENT).otherwise(v.FULL_PAYMENT).alias("payment_tag"),
        F.when(i % 3 == 0, v.ROLES.field_staff).when(i % 3 == 1, v.SUPPORT_TAG)
        .otherwise(v.NOT_APPLICABLE).alias("tag"),
    )


@probe("A04_A06_ledger_matrix", f"""
    select direction, coalesce(bucket, 'ALL') as bucket, {PERIOD_SUMS} from (
      select *, case when transaction_type = 'CREDITED' then 'Given' else 'Used' end as direction, {BUCKET_SQL} as bucket
      from ({LEDGER_BIND}) where transaction_type = 'CREDITED' or payment_tag <> 'Partial_Payment')
    group by grouping sets ((direction, bucket), (direction))""", "cash_ledger")
def _(t: Tables):
    return ledger.ledger_matrix(bound_ledger(t), AS_OF)


@probe("A05_ledger_by_tag", f"""
    select tag, bucket, {PERIOD_SUMS} from (select *, {BUCKET_SQL} as bucket from ({LEDGER_BIND}) where transaction_type = 'CREDITED')
    where bucket not in ('PROMOTIONAL', 'OTHER') group by tag, bucket""", "cash_ledger")
def _(t: Tables):
    return ledger.ledger_matrix(bound_ledger(t), AS_OF, by_tag=True)


GAP_ROWS = """
    select f.alias_name, f.facility_id, f.zone, m.id as map_id, m.mapping_type, c.city_name from branch f
    left join (select * from branch_map where is_valid = 1 and tenant_name = 'MAIN' and mapping_type = 'TICKET_AM') m
           on m.facility_id = f.facility_id
    left join city c on c.id = f.city_id where f.active = 1 and f.zone <> 'INS'"""


@probe("A07_gaps_with_zero_groups", """
    select c_nationkey, coalesce(n, 0) as uncovered from (select distinct c_nationkey from customer)
    left join (select c_nationkey, count(*) as n from (
        select c_custkey % 400 as branch, arg_min(c_nationkey, c_custkey) as c_nationkey, arg_min(c_mktsegment, c_custkey) as s
        from customer group by 1) where s <> 'BUILDING' group by 1) using (c_nationkey)""")
def _(t: Tables):
    rows = t.customer.withColumn("branch", F.col("c_custkey") % 400)
    return reporting.coverage_gaps(
        rows, entity="branch", order=["c_custkey"], group="c_nationkey",
        covered=F.col("c_mktsegment") == "BUILDING",
    )


PERIODS_SQL = {
    "yesterday": "day = date '2000-06-14'",
    "month_to_date": "day between date '2000-06-01' and date '2000-06-14'",
    "last_month": "day between date '2000-05-01' and date '2000-05-31'",
}
PCT = "case when {u} > 0 then ((20000 * {x} + {u}) // (2 * {u})) / 100.0 else 0 end"


def funnel_sql(feed: str, split: str, customer: str, first_touch: bool, periods=PERIODS_SQL) -> str:
    """``feed`` gives id, day, responded, used and the split / customer columns."""
    arms = []
    for name, condition in periods.items():
        unique = (
            f"count(*) filter (first_row)" if first_touch else f"count(distinct {customer})"
        )
        arms.append(f"""
            select {split}, '{name}' as period, count(*) as sent, count(*) filter (responded) as responded,
                   count(*) filter (used) as used, {unique} as unique_customers
            from (select *, row_number() over (partition by {customer} order by sent_on, id) = 1 as first_row
                  from ({feed}) where {condition}) group by {split}""")
    pct_r = PCT.format(x="responded", u="unique_customers")
    pct_u = PCT.format(x="used", u="unique_customers")
    base = " union all ".join(arms)
    shape = " union all ".join(
        f"select distinct {split}, '{name}' as period from ({feed})" for name in periods
    )
    return f"""
        select {split}, period, coalesce(sent, 0) as sent, coalesce(responded, 0) as responded, coalesce(used, 0) as used,
               coalesce(unique_customers, 0) as unique_customers,
               coalesce({pct_r}, 0)::double as response_pct, coalesce({pct_u}, 0)::double as conversion_pct
        from ({shape}) left join ({base}) using ({split}, period)"""


ORDER_MESSAGES = """
    select id, us, campaign, k as customer, make_timestamp(us) as sent_on, cast(make_timestamp(us) as date) as day, responded, used
    from (select f.id, f.us, f.campaign, f.k, a.responded, a.used from feed f join (""" + attribution_sql(ORDER_CAMPAIGNS) + """) a on a.id = f.id where f.kind = 'm')"""


@probe("A08_A09_A11_funnel", ORDER_FEED + funnel_sql(ORDER_MESSAGES, "campaign", "(campaign, customer)", False))
def _(t: Tables):
    return funnel.funnel(attributed_orders(t), AS_OF, column="campaign", unique_by="k")


@probe("A10_first_touch", ORDER_FEED + funnel_sql(ORDER_MESSAGES, "campaign", "customer", True))
def _(t: Tables):
    return funnel.funnel(attributed_orders(t), AS_OF, column="campaign", unique_by="k", first_touch=True)


USER_PERIODS = {
    "yesterday": (dt.date(2024, 1, 14), dt.date(2024, 1, 14)), "month_to_date": (dt.date(2024, 1, 1), dt.date(2024, 1, 14)),
    "two_weeks": (dt.date(2024, 1, 4), dt.date(2024, 1, 17)), "later": (dt.date(2024, 1, 12), dt.date(2024, 1, 30)),
}
USER_PERIODS_SQL = "(values " + ", ".join(f"('{p}', date '{a}', date '{b}')" for p, (a, b) in USER_PERIODS.items()) + ") periods(period, a, b)"


def user_log(t: Tables) -> UserLog:
    """The events' users, taken in by three stretches of days, each read once."""
    log = UserLog(t.spark, work_folder(t.spark, "users"), ["event_type"], "user_id", "ts", "event_id")
    ends = [dt.date(2023, 12, 31), dt.date(2024, 1, 10), dt.date(2024, 1, 15), dt.date(2024, 12, 31)]
    for before, last in zip(ends, ends[1:], strict=False):
        log.add(t.events, before + dt.timedelta(days=1), last)
    return log


@probe("A09_A15_users_by_merged_sets", f"""
    select event_type, period, count(distinct user_id) as users, count(*) as rows
    from events join {USER_PERIODS_SQL} on cast(ts as date) between a and b where user_id is not null group by 1, 2""")
def _(t: Tables):
    return user_log(t).counts(USER_PERIODS)


@probe("A10_first_touch_by_merged_sets", f"""
    select event_type, period, count(*) as users from (
      select event_type, period, row_number() over (partition by period, user_id order by ts, event_id) as place
      from events join {USER_PERIODS_SQL} on cast(ts as date) between a and b where user_id is not null) where place = 1 group by 1, 2""")
def _(t: Tables):
    return user_log(t).first_touch(USER_PERIODS)


USE_SQL = """case o_orderpriority when '1-URGENT' then case when o_orderkey % 3 = 0 then 'Appointment (FollowUp)' else 'Appointment (New)' end
    when '2-HIGH' then 'Diagnostics Appointment' when '3-MEDIUM' then 'Surgery' when '4-NOT SPECIFIED' then 'Loyalty Card' else 'Other' end"""


@probe("A12_A21_use_breakdown", ORDER_FEED + f"""
    select campaign, coalesce(use_kind, 'Grand Total') as use_kind, count(*) filter (day = date '2000-06-14') as yesterday,
           count(*) filter (day between date '2000-06-01' and date '2000-06-14') as month_to_date,
           count(*) filter (day between date '2000-05-01' and date '2000-05-31') as last_month
    from (select a.campaign, cast(m.o_orderdate as date) as day, s.use_kind
          from ({attribution_sql(ORDER_CAMPAIGNS)}) a join orders m on m.o_orderkey = a.id
          join (select o_orderkey, {USE_SQL} as use_kind from orders) s on s.o_orderkey = a.spend_id where a.used)
    group by grouping sets ((campaign, use_kind), (campaign))""")
def _(t: Tables):
    return funnel.use_breakdown(attributed_orders(t), AS_OF)


@probe("A13_flow_channel", """
    select json_extract_string(additional_details, '$.cashNudgingFlow') as flow,
           case when json_extract_string(additional_details, '$.cashNudgingFlow') in ('APP_DONE', 'APP_CONFIRM_CANCEL', 'APP_CANCEL')
                then 'after_visit' else 'support' end as channel, count(*) as messages
    from message_tag group by 1, 2""", "message_tag")
def _(t: Tables):
    flow = F.get_json_object("additional_details", "$.cashNudgingFlow")
    rows = t.view("message_tag").select(flow.alias("flow"))
    return rows.groupBy(
        "flow", funnel.flow_channel(F.col("flow"), "after_visit", "support").alias("channel")
    ).agg(F.count(F.lit(1)).alias("messages"))


@probe("A14_amount_tiers", """
    select tier, count(*) as messages from (select json_extract_string(additional_details, '$.promotionalCashAmount') as tier
      from one_time_message) where tier in ('100', '300', '500', '1000') group by tier""", "one_time_message")
def _(t: Tables):
    rows, _rejected = _tiers(t)
    return rows.groupBy("tier").agg(F.count(F.lit(1)).alias("messages"))


@probe("A14_amount_tier_rejects", """
    select 'unknown code for tier: ' || tier as reject_reason, count(*) as rows from (
      select json_extract_string(additional_details, '$.promotionalCashAmount') as tier from one_time_message)
    where tier not in ('100', '300', '500', '1000') group by 1""", "one_time_message")
def _(t: Tables):
    _rows, rejected = _tiers(t)
    return reporting.reject_counts(rejected)


def _tiers(t: Tables):
    amount = F.get_json_object("additional_details", "$.promotionalCashAmount")
    rows = t.view("one_time_message").select("id", amount.alias("amount"))
    return reporting.apply_codes(rows, F.col("amount"), {a: a for a in ROLES.amount_tiers}, "tier")


def per_user_sql(period: str, group: str) -> str:
    ratio = "((200 * n + u) // (2 * u)) / 100.0"
    return f"""
        with tx as (select *, case when patient_id in (select patient_id from transaction where payment_mode = 'CASHBACK')
                                   then 'cash' else 'non-cash' end as user_type, {period} from transaction)
        select {group}, user_type, n as transactions, u as users, ({ratio})::double as per_user from (
          select {group}, coalesce(user_type, 'overall') as user_type, count(*) as n, count(distinct patient_id) as u
          from tx group by grouping sets (({group}, user_type), ({group})))"""


@probe("A15_A17_per_user_by_month", per_user_sql(
    "cast(year(created_on) as int) as year, cast(month(created_on) as int) as month", "year, month"), "transaction")
def _(t: Tables):
    counts = per_user.with_user_kind(
        t.view("transaction"), user="patient_id",
        period=[F.year("created_on").alias("year"), F.month("created_on").alias("month")],
        marks_user=F.col("payment_mode") == "CASHBACK", marked="cash", other="non-cash",
    )
    return per_user.per_user(counts, user="patient_id", period=["year", "month"])


@probe("A15_per_user_legacy_month", per_user_sql("cast(month(created_on) as int) as month", "month"), "transaction")
def _(t: Tables):
    return cashback.transactions_per_user(t.view("transaction"), "month", legacy_month=True)


@probe("A16_A17_per_user_by_week", per_user_sql("cast(week as int) as weekno", "weekno"), "transaction")
def _(t: Tables):
    return cashback.transactions_per_user(t.view("transaction"), "week").withColumnRenamed("week", "weekno")


@probe("A18_last_answer_per_level", """
    select entity_id, arg_max(case when option_value in (1, 2, 3) then 'Choose Language' else 'WhatsApp Flow' end, id) filter (ivr_question_id = 3) as first_level,
           arg_max(case when option_value = 1 then 'Call Transferred' else 'WhatsApp Flow' end, id) filter (ivr_question_id <> 3) as second_level
    from menu_answer where template_id = 3 and entity_type = 'PATIENT_CASE' group by entity_id""", "menu_answer")
def _(t: Tables):
    return documents.menu_levels(documents.case_answers(t.view("menu_answer")), "entity_id", ["created_on", "id"])


LIST_SQL = """
    select call_sid, coalesce(json_array_length((p->'$.agents')) > 0, false) as no_sent, coalesce((p->'$.agents') is not null, false) as requested,
           p->>'$.personnelType' as personnel_type, coalesce(p->>'$.agentInSystem', '') as agent_in_system,
           coalesce(p->>'$.agentAvailable', '') as agent_available
    from (select call_sid, arg_max(p, id) filter (p is not null) as p
          from (select call_sid, id, json_extract(insight_data, '$.insightData') as p from call_document
                where insight_type = 'INBOUND_PATIENT_CALL_LIST') group by call_sid)"""
DETAIL_SQL = """
    select call_sid, p from (select call_sid, arg_min(p, id) filter (p is not null) as p
      from (select call_sid, id, json_extract(insight_data, '$.insightData') as p from call_document
            where insight_type = 'INCOMING_EXOTEL_CALL_DETAILS') group by call_sid) where p is not null"""


@probe("A19_last_document", LIST_SQL, "call_document")
def _(t: Tables):
    docs = t.view("call_document").where(F.col("insight_type") == v.LIST_DOCUMENT)
    return documents.dial_list(docs, "call_sid", ["created_on", "id"])


@probe("A20_first_document", f"""
    select call_sid, p->>'$.leg1DetailedStatus' as d1, p->>'$.leg2AgentNumber' as n2 from ({DETAIL_SQL})""", "call_document")
def _(t: Tables):
    docs = t.view("call_document").where(F.col("insight_type") == v.DETAIL_DOCUMENT)
    return documents.leg_details(docs, "call_sid", ["created_on", "id"]).select(
        "call_sid", F.col("leg1DetailedStatus").alias("d1"), F.col("leg2AgentNumber").alias("n2")
    )


# ---- windows -------------------------------------------------------------------------


LEAD_SQL = """
    select event_id, lead(ts) over w as ts_lead, lead(event_type) over w as event_type_lead, lead(props) over w as props_lead
    from events window w as (partition by user_id order by ts, event_id)"""


@probe("W01_lead_three_columns", LEAD_SQL)
def _(t: Tables):
    led = with_next_row(t.events, key="user_id", ts="ts", id="event_id", values=["ts", "event_type", "props"])
    return led.select("event_id", "ts_lead", "event_type_lead", "props_lead")


@probe("W01_lead_hot_keys", LEAD_SQL.replace("partition by user_id", "partition by case when user_id % 3 = 0 then 0 else user_id end"))
def _(t: Tables):
    rows = t.events.withColumn("user_id", hot("user_id"))
    led = with_next_row(rows, key="user_id", ts="ts", id="event_id", values=["ts", "event_type", "props"])
    return led.select("event_id", "ts_lead", "event_type_lead", "props_lead")


@probe("W02_newest_row", """
    select o_custkey, o_orderkey, o_orderstatus from (
      select *, row_number() over (partition by o_custkey order by o_orderkey desc) as rn from orders) where rn = 1""")
def _(t: Tables):
    return lookup.latest_per_key(t.orders, "o_custkey", "o_orderkey", ["o_orderkey", "o_orderstatus"])


@probe("W03_time_to_next_event", """
    select event_id, case when event_type in ('view', 'signup') then
             cast(floor((epoch_us(case when nv is null then timestamp '2024-01-30 23:59:59' else nt end) - epoch_us(ts)) / 1000000.0) as bigint) end as total_active_sec
    from (select *, lead(ts) over w as nt, lead(case when event_type = 'error' then null else event_type end) over w as nv
          from events window w as (partition by user_id order by ts, event_id))""")
def _(t: Tables):
    rows = t.events.select(
        "event_id", "user_id", "ts", F.col("props").alias("reason"),
        F.when(F.col("event_type") != "error", F.col("event_type")).alias("value"),
    )
    return active_seconds(
        rows, agent="user_id", ts="ts", id="event_id", value="value", reason="reason",
        active=F.col("value").isin("view", "signup"), as_of=dt.date(2024, 1, 31),
    ).select("event_id", "total_active_sec")


@probe("W04_first_row", """
    select user_id, event_id, event_type from (
      select *, row_number() over (partition by user_id order by event_id) as rn from events) where rn = 1""")
def _(t: Tables):
    return lookup.first_per_key(t.events, "user_id", "event_id", ["event_id", "event_type"])


@probe("W05_next_strictly_later", """
    select event_id, min(case when event_type = 'purchase' then epoch_us(ts) end) over (
      partition by user_id order by epoch_us(ts) range between 1 following and unbounded following) as next_purchase from events""")
def _(t: Tables):
    spend = F.when(F.col("event_type") == "purchase", F.col(MICROS))
    return later_minima(t.events, key="user_id", ts="ts", marks={"next_purchase": spend}, keep=["event_id"])


# ---- sorts and set operations --------------------------------------------------------


@probe("O01_O03_merged_order", """
    with feed as (select id, from_no as k, call_created_on as sent_on, 'Call' as channel from ledger_call
                  union all select id, from_id, created_on + interval '330 minutes', 'WhatsApp' from chat_message)
    select id, lead(sent_on) over w as sent_on_lead, lead(channel) over w as channel_lead
    from feed window w as (partition by k order by sent_on, id)""", "ledger_call chat_message")
def _(t: Tables):
    call, chat = t.views("ledger_call chat_message")
    merged = call.select(
        "id", F.col("from_no").alias("k"), F.col("call_created_on").alias("sent_on"),
        F.lit(v.ROLES.call_channel).alias("channel"),
    ).unionByName(chat.select(
        "id", F.col("from_id").alias("k"), clock.to_local(F.col("created_on")).alias("sent_on"),
        F.lit(v.ROLES.chat_channel).alias("channel"),
    ))
    led = with_next_row(merged, key="k", ts="sent_on", id="id", values=["sent_on", "channel"])
    return led.select("id", "sent_on_lead", "channel_lead")


@probe("O02_latest_by_two_keys", """
    select email, strftime(max(created_on) + interval '330 minutes', '%b %d, %H:%M:%S') as last_seen
    from location_ping group by email""", "location_ping")
def _(t: Tables):
    latest = lookup.latest_per_key(t.view("location_ping"), "email", "created_on", ["created_on"])
    return latest.select(
        "email", clock.short_time_text(clock.to_local(F.col("created_on"))).alias("last_seen")
    )


@probe("O04_descending_alerts", """
    select event_id, ts from events where event_type = 'error' and value > 100 order by ts desc""")
def _(t: Tables):
    return t.events.where((F.col("event_type") == "error") & (F.col("value") > 100)).select(
        "event_id", "ts"
    ).orderBy(F.col("ts").desc())


@probe("O05_report_by_period", """
    select year, month, max(per_user) filter (user_type = 'cash') as cash, max(per_user) filter (user_type = 'non-cash') as "non-cash",
           max(per_user) filter (user_type = 'overall') as overall from (
    """ + per_user_sql("cast(year(created_on) as int) as year, cast(month(created_on) as int) as month", "year, month") + """)
    group by year, month order by year, month""", "transaction")
def _(t: Tables):
    result = cashback.transactions_per_user(t.view("transaction"), "month")
    return cashback.per_user_report(result, ["year", "month"])


@probe("U01_union_by_name", """
    select c_custkey as id, c_name as name, c_mktsegment as segment, cast(null as double) as balance from customer
    union all select s_suppkey, s_name, null, s_acctbal from supplier""")
def _(t: Tables):
    from fieldbook.sources.readers import stack

    return stack(
        t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment")),
        t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance")),
    )


@probe("U02_union_of_channels", """
    select id, created_on + interval '330 minutes' as sent_on, 'WhatsApp' as channel from chat_message where from_id = to_message
      and cast(created_on + interval '330 minutes' as date) between date '2000-05-01' and date '2000-06-14'
    union all select id, call_created_on, 'Call' from ledger_call where direction = 'inbound'
      and cast(call_created_on as date) between date '2000-05-01' and date '2000-06-14'""", "chat_message ledger_call")
def _(t: Tables):
    feed = cashback.replies(*t.views("chat_message ledger_call"), AS_OF)
    return feed.select("id", "sent_on", "channel")


@probe("U03_distinct", "select distinct user_id, event_type from events")
def _(t: Tables):
    return t.events.select("user_id", "event_type").distinct()
