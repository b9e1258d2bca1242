"""What the plans look like: no shuffle too many, filters pushed into the scan."""

import datetime as dt
import re

import pytest
from conftest import tuples
from pyspark.sql import functions as F

from fieldbook.functions import clock
from fieldbook.operators import ledger, ranges
from fieldbook.operators.activity import with_next_row
from fieldbook.operators.lookup import first_per_key, left_lookup, restrict_to
from fieldbook.plans import calls, commission, jobs, records
from fieldbook.probes.deployment import ROLES
from fieldbook.probes.registry import Tables
from fieldbook.probes.tables import attributed_orders
from fieldbook.session import work_folder
from fieldbook.sources import readers, writers
from fieldbook.sources.schemas import SchemaMismatch, struct

FOLDER = "/root/testdata/sf0.001"


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(plan: str) -> int:
    return len(re.findall(r"\bExchange (?:hash|range|Single|RoundRobin)", plan))


@pytest.fixture
def written(monkeypatch):
    """The frames whose walk was written, before they are."""
    seen, real = [], ranges.stored

    def stored(df, purpose):
        seen.append(df)
        return real(df, purpose)

    monkeypatch.setattr(ranges, "stored", stored)
    return seen


@pytest.fixture
def without_broadcasts(spark):
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = {name: spark.conf.get(name, None) for name in names}
    for name in names:
        spark.conf.set(name, "-1")
    yield
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_attribution_sorts_its_rows_once(spark, written, without_broadcasts):
    found = attributed_orders(Tables(spark, FOLDER))
    (walk,) = written
    # The rows by (key, time); then only the ends of the ranges, by key.
    assert exchanges(plan_of(walk)) == 1 and "rangepartitioning(_key" in plan_of(walk)
    assert exchanges(plan_of(found)) == 1 and "SortMergeJoin" not in plan_of(found)


def test_three_leads_sort_the_feed_once(spark, written, without_broadcasts):
    t = Tables(spark, FOLDER)
    led = with_next_row(t.events, key="user_id", ts="ts", id="event_id", values=["ts", "event_type", "props"])
    (walk,) = written
    assert exchanges(plan_of(walk)) == 1 and plan_of(walk).count("FileScan") == 1
    assert exchanges(plan_of(led)) == 1 and "SortMergeJoin" not in plan_of(led)


def test_day_filters_and_columns_reach_the_scan(spark):
    t = Tables(spark, FOLDER)
    plan = plan_of(t.events.where(
        clock.in_local_days(F.col("ts"), dt.date(2024, 1, 5), dt.date(2024, 1, 6))).select("event_id"))
    assert re.search(r"PushedFilters: \[[^]]*GreaterThanOrEqual\(ts,2024-01-04T18:30\), LessThan\(ts,2024-01-06T18:30\)", plan)
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in plan


SMALL_SKEW = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "65536",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "65536",
    "spark.sql.shuffle.partitions": "16",
}


@pytest.fixture
def skewed(spark):
    """Facts with a third of all rows under one key, and thresholds that fit a small test."""
    before = {k: spark.conf.get(k, None) for k in SMALL_SKEW}
    for name, value in SMALL_SKEW.items():
        spark.conf.set(name, value)
    yield spark.range(0, 400_000, 1, 16).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 5000).cast("long").alias("k"),
        "id", F.sha2(F.col("id").cast("string"), 256).alias("x"),
    )
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def final_plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return plan_of(df)


def test_hot_lookup_key_is_split(spark, skewed):
    dim = spark.range(5000).select(F.col("id").alias("k"), F.lit("d").alias("d"))
    joined = left_lookup(skewed, dim, "k", {"d": ""}).where(F.length("x") > 0)
    out = joined.groupBy(F.col("id") % 7).agg(F.count("d").alias("n"))
    assert "SortMergeJoin(skew=true)" in final_plan(out)
    assert sum(r.n for r in out.collect()) == 400_000


def test_hot_key_is_split_between_semi_join_and_aggregate(spark, skewed):
    keys = spark.range(5000).select(F.col("id").alias("k"))
    out = first_per_key(restrict_to(skewed, keys, "k"), "k", "id", ["id", "x"])
    assert "SortMergeJoin(skew=true)" in final_plan(out)
    assert out.count() == 5000


def subtree(plan: str, top: str) -> str:
    """The first node that matches, and everything below it."""
    lines = plan.splitlines()
    depth = lambda line: len(re.match(r"[\s:+\-]*", line).group())
    at = next(i for i, line in enumerate(lines) if re.search(top, line))
    end = next((i for i in range(at + 1, len(lines)) if depth(lines[i]) <= depth(lines[at])), len(lines))
    return "\n".join(lines[at:end])


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.fixture
def t(spark):
    return Tables(spark, FOLDER)


def test_outcomes_are_cut_before_they_are_counted(t):
    appointments, outcomes, tests = t.views("appointment diagnostic_outcome diagnostic")
    plan = optimized(records.recommended_test_counts(appointments, outcomes, tests))
    counting = subtree(plan, r"Aggregate \[appointment_id.*name")
    # Below the join with the names, which is below the count.
    assert "LeftSemi" in subtree(counting, r"Join (?:Inner|LeftOuter)")


def test_phase_histories_are_cut_before_their_json_is_parsed(t):
    names = "insurance_case insurance_vendor facility city patient customer_profile insurance_phase insurance_sub_phase insurance_lender"
    plan = optimized(commission.case_texts(*t.views(names)))
    assert "LeftSemi" in subtree(plan, r"from_json\(.*surgeryDischargeApprovalInfo")
    assert "LeftSemi" in subtree(plan, r"financeEligibilityInfo")


def test_a_statement_sends_only_its_small_dimensions_to_the_driver(spark):
    def rows(n, *columns):
        return spark.range(n).selectExpr(*columns)

    cases = rows(
        30, "id", "timestamp_ntz'2024-01-10' as created_on", "id as surgery_id", "id as patient_id", "id % 3 as facility_id", "id % 3 as vendor_id",
        "'F' as status", "'I' as insurance_name", """'{"tpaName":"T"}' as additional_details""", "'t' as treatment_type", "'s' as surgery_name",
        "'g' as speciality_name",
    )
    tables = [
        rows(3, "id as vendor_id", "'V' as vendor_name"), rows(3, "id as facility_id", "'H' || id as alias_name", "id as city_id"),
        rows(3, "id", "'C' || id as city_name"), rows(20, "id", "id div 2 as customer_id"),
        rows(10, "id as customer_id", "'N' || id as name", "'0' as customer_number", "'e' as email"),
        rows(40, "id div 2 as insurance_case_id", "id as phase_id",
             "case id % 2 when 0 then 'INSURANCE_DOCS_APPROVAL' else 'DISCHARGE_DOCS_APPROVAL' end as phase_type",
             """'{"surgeryDischargeApprovalInfo":{"nme":"x","totalBillAmount":"2,000","finalApprovedAmount":"1,000"}}' as additional_details"""),
        rows(20, "id * 2 as phase_id", "id as sub_phase_id", "'FINANCE_ELIGIBILITY_APPROVAL' as sub_phase_type",
             """'{"financeEligibilityInfo":{"lenderId":"1"}}' as additional_details"""),
        rows(2, "id as lender_id", "'L' || id as lender_name"),
    ]
    rates = rows(3, "'H' || id || 'Partner24HR' as key", "'9%' as share_pct", "'10%' as net_share_pct", "'On Approved Amount' as remarks",
                 "'2020-01-01' as start_date", "'' as end_date")
    found = commission.statement(commission.open_cases(cases, *tables, roles=ROLES), rates, ROLES)
    got = {(r.case_id, r.patient_name, r.lender_name, r.total_share and str(r.total_share)) for r in found.collect()}
    assert got == {(i, f"N{i // 2}", "L1", "100.0000") if i < 20 else (i, None, None, None) for i in range(30)}
    small = re.findall(r"BroadcastHashJoin \[(\w+)#", plan_of(found).split("== Initial Plan ==")[0])
    assert sorted(small) == ["city_id", "facility_id", "lender_id", "vendor_id"]


def test_callers_cities_start_from_the_callers(t):
    call, cases, patient, customer, city = t.views("call patient_case patient customer_profile city")
    plan = optimized(calls.caller_cities(cases, patient, customer, city, call))
    joins = [line for line in plan.splitlines() if "Join Inner" in line]
    inner = subtree(plan, r"Join Inner.*patient_id")
    assert len(joins) == 2 and "LeftSemi" in subtree(inner, r"Join Inner.*customer_id")


def test_cards_and_visits_are_cut_to_the_ledger(t):
    ledger_rows = t.view("cash_ledger").withColumn("issued_entity_id", F.col("issued_entity_id").cast("string"))
    payments, cards, people = t.views("card_payment card personnel")
    plan = optimized(ledger.card_facts(ledger_rows, payments, cards.select("card_id"), people.select("email")))
    assert "LeftSemi" in subtree(plan, r"Aggregate \[card_id.*min_by|Aggregate \[card_id.*collected_by")
    appts = t.view("appointment").withColumnRenamed("user_email", "user")
    plan = optimized(ledger.visit_facts(ledger_rows, appts, t.view("payment_link"), t.view("patient_case"), people.select("email")))
    assert all("LeftSemi" in subtree(plan, top) for top in (r"Aggregate \[.*_paid", r"Aggregate \[.*lead_id", r"_from_app"))


def test_bucketed_tables_join_without_a_shuffle(spark, t, without_broadcasts):
    layout, paths = struct("k:l x:s"), [work_folder(spark, name) for name in ("left", "right", "other")]
    rows = t.orders.selectExpr("o_custkey as k", "o_orderstatus as x")
    for path, buckets in zip(paths, (8, 8, 5), strict=True):
        for _ in range(2):  # the second version is the one read
            writers.publish_bucketed(rows, path, layout, key="k", buckets=buckets)
    left, right, other = (readers.read_bucketed(spark, path, layout) for path in paths)
    joined = left.join(right.groupBy("k").agg(F.count("x").alias("n")), "k").groupBy("k").agg(F.max("n").alias("n"), F.count("x").alias("m"))
    assert exchanges(plan_of(joined)) == 0 and joined.where("n <> m").count() == 0 and joined.count() == rows.select("k").distinct().count()
    assert exchanges(plan_of(restrict_to(left, right, "k"))) == 0
    assert exchanges(plan_of(first_per_key(left, "k", "x", ["x"]))) == 0
    assert exchanges(plan_of(left.join(other, "k"))) == 1  # only the table of another number of buckets is dealt anew
    assert left.count() == rows.count() == readers.read_table(spark, paths[0], layout).count()
    assert len(left.inputFiles()) <= 8


def test_a_bucketed_table_follows_its_versions(spark, table):
    path, layout = work_folder(spark, "versions"), struct("k:l x:s")
    writers.publish_bucketed(table("k:l x:s", [(1, "a"), (2, "b")]), path, layout, key="k", buckets=3)
    before = readers.read_bucketed(spark, path)
    writers.publish_bucketed(table("k:l x:s", [(3, "c")]), path, layout, key="k", buckets=4)
    assert tuples(before) == [(1, "a"), (2, "b")] and tuples(readers.read_bucketed(spark, path)) == [(3, "c")]
    plain = work_folder(spark, "plain")
    writers.publish(table("k:l x:s", [(3, "c")]), plain, layout)
    with pytest.raises(ValueError, match="no bucketed table"):
        readers.read_bucketed(spark, plain)
    with pytest.raises(SchemaMismatch):
        readers.read_bucketed(spark, path, struct("k:l y:s"))


def test_a_job_reads_bucketed_inputs_with_fewer_shuffles(spark, t, without_broadcasts):
    names = "call call_document patient_case patient customer_profile city personnel".split()
    plans, rows = [], []
    for dealt in ({}, {"call": "sid", "call_document": "call_sid", "patient_case": "patient_id"}):
        root = work_folder(spark, "inputs")
        for name in names:
            path, df = f"{root}/{name.removesuffix('_profile')}", t.view(name)
            if name in dealt:
                writers.publish_bucketed(df, path, df.schema, key=dealt[name], buckets=4)
            else:
                df.write.parquet(path)
        detail = jobs._detail(jobs.Inputs(spark, root, roles=ROLES), jobs.Inputs(spark, root).table("call"), routed=True)
        plans.append(exchanges(plan_of(detail)))
        rows.append(tuples(detail.select("sid", "city", "final_status", "leg1_agent_email", "no_sent")))
    assert rows[0] == rows[1] and rows[0]
    assert plans[1] <= plans[0] - 4, plans
