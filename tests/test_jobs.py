"""Every job from stored inputs to published outputs."""

import datetime as dt
from decimal import Decimal

import pytest
from conftest import at, tuples
from pyspark.sql import functions as F

from fieldbook import vocabulary as v
from fieldbook.plans import run_report
from fieldbook.plans.jobs import FEEDS, JOBS, RATE_COLUMNS, Inputs, run, run_campaigns, run_feed
from fieldbook.probes.deployment import ROLES
from fieldbook.probes.registry import Tables
from fieldbook.probes.reports import SHEET_LACKS
from fieldbook.probes.views import VIEWS
from fieldbook.session import work_folder
from fieldbook.sources import readers, schemas, writers

RENAMED = {"customer_profile": "customer"}
AS_OF = {
    "cashback": dt.date(2000, 6, 15), "transactions_per_user": dt.date(2000, 6, 15),
    "failed_calls": dt.datetime(2024, 1, 15, 12), "commission": dt.date(2024, 2, 1),
}
FILLED = {
    "availability": ["agent_active"], "personnel_profiles": ["personnel_detail", "personnel_rejects"],
    "audit_increment": ["customer_audit"], "snapshots": ["insurance_case", "insurance_phase", "insurance_lender"],
    "surgery_audit": ["surgery_audit"], "coverage_gaps": ["coverage_by_city", "uncovered_facilities"],
    "outcome_comments": ["outcome_comment"], "person_facilities": ["person_facility"],
    "recommended_tests": ["diagnostic_test"], "call_detail": ["call_detail"],
    "cashback": ["cash_ledger", "ledger_summary", "campaign_messages", "campaign_funnels"],
    "transactions_per_user": ["transactions_per_user_month", "transactions_per_user_week"],
}


@pytest.fixture(scope="module")
def inputs(spark):
    t, root = Tables(spark, "/root/testdata/sf0.001"), work_folder(spark, "inputs")
    for name in VIEWS:
        df = t.view(name)
        if name == "appointment":
            df = df.withColumnRenamed("user_email", "user")
        if name == "insurance_lender":
            df = df.withColumns({c: F.lit(None).cast("timestamp_ntz") for c in ("created_on", "updated_on")})
        if name == "rate_agreement":
            writers.write_sheet(df, f"{root}/{name}")
        else:
            df.write.parquet(f"{root}/{RENAMED.get(name, name)}")
    return Inputs(spark, root, roles=ROLES)


@pytest.mark.parametrize("name", JOBS)
def test_job_publishes(spark, inputs, name):
    out = work_folder(spark, f"out-{name}")
    paths = run(name, inputs, out, AS_OF.get(name, dt.date(2024, 1, 15)))
    tables = [p.rsplit("/", 1)[1] for p in paths]
    report = {(r.table, r.measure): r.rows for r in spark.read.parquet(paths[-1]).where("reason is null").collect()}
    assert tables[-1] == f"{name}_run_report" and {t for t, m in report if m == "published"} == set(tables[:-1])
    tables = tables[:-1]
    for table in FILLED.get(name, []):
        assert table in tables
        path = readers.current(spark, f"{out}/{table}")
        csv = spark.read.option("header", True).csv(path) if _is_csv(spark, path) else spark.read.parquet(path)
        assert csv.count() == report[table, "published"] > 0


def _is_csv(spark, path):
    return not spark.read.format("binaryFile").option("pathGlobFilter", "*.csv.gz").option(
        "recursiveFileLookup", True).load(path).isEmpty()


def test_campaigns_day_by_day_equal_the_whole_range(spark, inputs):
    out = work_folder(spark, "campaigns")
    run("cashback", inputs, out, dt.date(2000, 6, 15))
    whole = spark.read.option("header", True).csv(readers.current(spark, f"{out}/campaign_messages"))
    columns = ("campaign", "id", "responded", "response_id", "used", "spend_id", "used_on")
    text = [F.col(c).cast("string").alias(c) for c in columns]
    for first, as_of in ((dt.date(2000, 5, 1), dt.date(2000, 5, 20)), (dt.date(2000, 5, 20), dt.date(2000, 6, 15))):
        answers = run_campaigns(inputs, out, first, as_of)
    assert whole.count() > 0 and tuples(answers.select(*text)) == tuples(whole.select(*text))


def test_the_run_report_counts_what_was_rejected(spark, inputs):
    out = work_folder(spark, "reported")
    for day in (15, 15, 16):
        run("personnel_profiles", inputs, out, dt.date(2024, 1, day))
    rows = tuples(spark.read.parquet(f"{out}/personnel_profiles_run_report"), "run_date", "table", "measure", "reason", "rows")
    people = inputs.table("personnel").count()
    bad = spark.read.option("header", True).csv(readers.current(spark, f"{out}/personnel_rejects")).count()
    assert bad > 0 and rows == sorted([
        (dt.date(2024, 1, day), *row) for day in (15, 16) for row in [
            ("personnel", "read", None, people), ("personnel", "rejected", "unknown code for city", bad),
            ("personnel_detail", "published", None, people - bad), ("personnel_rejects", "published", None, bad)]
    ], key=repr)


def test_counting_adds_no_scan_and_an_empty_pass_counts_none(spark, inputs, monkeypatch):
    monkeypatch.setattr(run_report, "PATIENCE", 3)
    report = run_report.RunReport()
    people = inputs.table("personnel")
    watched = report.checked(people, "personnel", {"odd": F.col("personnel_id") % 2 == 1}).where("personnel_id % 2 = 0")
    plan = watched._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Exchange" not in plan
    watched.write.format("noop").mode("overwrite").save()
    odd = people.where("personnel_id % 2 = 1").count()
    report.published(people.limit(0), "nothing").join(people.limit(0), "personnel_id").write.format("noop").mode("overwrite").save()
    assert report.rows() == [("personnel", "read", None, people.count()), ("personnel", "rejected", "odd", odd), ("nothing", "published", None, 0)]


def test_a_rerun_of_a_day_does_not_duplicate(spark, inputs):
    out = work_folder(spark, "rerun")
    for _ in range(2):
        run("call_detail", inputs, out, dt.date(2024, 1, 15))
    once = spark.read.parquet(f"{out}/call_detail")
    assert once.count() == once.select("sid").distinct().count() > 0
    run("call_detail", inputs, out, dt.date(2024, 1, 16))
    assert spark.read.parquet(f"{out}/call_detail").select("run_date").distinct().count() == 2


def test_commission_with_earlier_cases(spark, inputs):
    sheet = spark.createDataFrame(
        [("7", "1,000", "2,000", "5", "0", "10", "90", "9.00%", "On Approved Amount")],
        "`Case ID` string, `Approved \n(Chargeable)` string, `Bill` string, `Discount` string, `Other` string, "
        "`TDS@1%` string, `Share` string, `Share %` string, `Remarks` string",
    )
    writers.write_sheet(sheet, f"{inputs.root}/earlier")
    names = ["case_id", "approved", "total_bill", "discount", "other_collected", "withheld", "share", "share_pct", "remarks"]
    both = Inputs(
        spark, inputs.root, roles=ROLES, earlier_cases={"earlier": dict(zip(sheet.columns, names))}, earlier_empty=SHEET_LACKS,
        multi_line=["earlier"],
    )
    out = work_folder(spark, "commission")
    run("commission", both, out, dt.date(2024, 2, 1))
    row = spark.read.option("header", True).csv(readers.current(spark, f"{out}/commission_statement")).where("case_id = '7' and tax is not null").first()
    assert (row.total_share, row.tax_amount, row.net_payable, row.tax) == ("106.2000", "16.2000", "888.8000", "18.00%")


@pytest.mark.parametrize("drift, message", [
    (lambda df: df.drop("is_active"), "missing columns"),
    (lambda df: df.withColumn("more", F.lit(1)), "unexpected columns"),
    (lambda df: df.withColumn("cashback_id", F.col("cashback_id").cast("string")), "another type"),
])
def test_a_drifted_input_ends_the_job_at_its_start(spark, inputs, drift, message):
    root = work_folder(spark, "drifted")
    drift(inputs.table("cashback_type")).write.parquet(f"{root}/cashback_type")
    with pytest.raises(schemas.SchemaMismatch, match=message):
        Inputs(spark, root).table("cashback_type")


def test_a_lost_statement_column_is_not_published_empty(spark, inputs):
    from fieldbook.plans import commission

    tables = "insurance_case insurance_vendor facility city patient customer insurance_phase insurance_sub_phase insurance_lender"
    cases = commission.open_cases(*inputs.tables(tables))
    rates = inputs.sheet("rate_agreement", RATE_COLUMNS)
    assert commission.statement(cases, rates).columns == list(commission.STATEMENT)
    with pytest.raises(schemas.SchemaMismatch, match="tpa_name"):
        commission.statement(cases.drop("tpa_name"), rates)


def test_unreadable_amounts_and_dates_are_listed(spark):
    from fieldbook.plans import commission

    texts = spark.createDataFrame(
        [(1, "n/a", "1,200", "2024-01-02"), (2, "", None, "soon"), (3, "12", "abc", "")],
        "case_id long, total_bill_text string, approved_text string, admission_text string",
    )
    got = sorted((r.id, r.column, r.value) for r in commission.case_rejects(texts).collect())
    assert got == [("1", "total_bill", "n/a"), ("2", "admission_date", "soon"), ("3", "approved", "abc")]
    rates = spark.createDataFrame([("k", "10%", "x%", "r", "2024-13-01", "")], "key string, share_pct string, net_share_pct string, remarks string, start_date string, end_date string")
    assert sorted((r.id, r.column) for r in commission.rate_rejects(rates).collect()) == [("k", "net_share"), ("k", "start_date")]


@pytest.mark.parametrize("name", FEEDS)
def test_feed_job_takes_in_what_arrives(spark, name):
    job, root = FEEDS[name], work_folder(spark, "feeds")
    schema = schemas.FEED_INPUTS[job.table]
    values = {"final_status": v.FAILED_STATUSES[0], "transaction_type": v.CREDITED, "issued_entity_type": v.LOYALTY, "payment_tag": "NA"}

    def arrive(n):
        row = tuple(
            values.get(f.name, f"{n}") if f.dataType.simpleString() == "string" else at("2024-01-01 10:00:00")
            if f.dataType.simpleString() == "timestamp_ntz" else Decimal(n) if f.dataType.simpleString().startswith("decimal") else n
            for f in schema
        )
        spark.createDataFrame([row], schema).coalesce(1).write.mode("append").parquet(f"{root}/inbox/{job.table}")
        return row

    rows = [arrive(1)]
    first = run_feed(name, Inputs(spark, root), f"{root}/out")
    assert tuples(first) == tuples(job.feed.batch_twin(spark.createDataFrame(rows, schema)))
    rows += [arrive(2), arrive(1)]
    again = run_feed(name, Inputs(spark, root), f"{root}/out", files_per_batch=1)
    assert tuples(again) == tuples(job.feed.batch_twin(spark.createDataFrame(rows, schema)))


def test_a_drifted_extract_is_not_published(spark, inputs, monkeypatch):
    monkeypatch.setitem(schemas.EXTRACTS, "uncovered_facilities", schemas.struct("city_name:s hospital_name:s zone:s more:s"))
    with pytest.raises(schemas.SchemaMismatch, match="more"):
        run("coverage_gaps", inputs, work_folder(spark, "drift"), dt.date(2024, 1, 15))
