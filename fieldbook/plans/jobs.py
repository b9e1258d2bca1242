"""Runnable jobs: stored inputs in, published tables out.

``run("availability", Inputs(spark, "/data/in"), "/data/out", as_of)`` reads what the job
needs, builds its reports and publishes them. Scheduling, credentials and mail are left to
whoever calls this.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldbook import vocabulary as v
from fieldbook.functions.clock import Periods, Stretch, in_local_days
from fieldbook.plans import calls, cashback, commission, records, staff
from fieldbook.plans.campaign_log import CampaignLog
from fieldbook.plans.run_report import RunReport, Watch, unwatched
from fieldbook.session import intermediates, split_skewed_joins, stored
from fieldbook.sources import readers, schemas, writers
from fieldbook.streaming import feeds

RATE_COLUMNS = ("key", "share_pct", "net_share_pct", "remarks", "start_date", "end_date")


@dataclass(frozen=True)
class Inputs:
    """Tables below one folder, ``<root>/<name>``; text sheets as ``<root>/<name>`` CSV.

    ``earlier_cases`` names the sheets of earlier commission cases, each with its headers
    and the column names they stand for; ``earlier_empty`` the statement columns that none of them has.
    ``multi_line`` names the sheets whose cells hold line breaks. ``watch`` counts the rows that go through checks.
    """

    spark: SparkSession
    root: str
    fmt: str = "parquet"
    roles: v.Roles = v.ROLES
    earlier_cases: Mapping[str, Mapping[str, str]] = field(default_factory=dict)
    earlier_empty: Sequence[str] = ()
    multi_line: Sequence[str] = ()
    watch: Watch = unwatched

    def table(self, name: str) -> DataFrame:
        """A declared input; one that has drifted ends the job before it starts."""
        return readers.read_table(self.spark, f"{self.root}/{name}", schemas.INPUTS[name], self.fmt)

    def tables(self, names: str) -> list[DataFrame]:
        return [self.table(n) for n in names.split()]

    def sheet(self, name: str, columns) -> DataFrame:
        broken = name in self.multi_line
        return readers.read_text_sheet(self.spark, f"{self.root}/{name}", columns, multi_line=broken)


@dataclass
class Result:
    """Tables with a declared layout, and report extracts, whose layouts ``schemas.EXTRACTS`` declares."""

    tables: dict = field(default_factory=dict)
    extracts: dict[str, DataFrame] = field(default_factory=dict)
    by_run_date: bool = False


def _availability(i: Inputs, as_of: dt.date) -> Result:
    rows = staff.availability_sessions(*i.tables("agent_activity personnel"), as_of, roles=i.roles)
    return Result({"agent_active": (rows, schemas.AGENT_ACTIVE)})


def _profiles(i: Inputs, as_of: dt.date) -> Result:
    rows, rejected = staff.personnel_profiles(
        *i.tables("personnel person_facility_map facility personnel_permission"), i.roles, i.watch
    )
    return Result(
        {"personnel_detail": (rows, schemas.PERSONNEL_DETAIL)}, {"personnel_rejects": rejected}
    )


def _audit(i: Inputs, as_of: dt.date) -> Result:
    rows = records.audit_increment(i.table("customer_audit"), as_of)
    return Result({"customer_audit": (rows, schemas.CUSTOMER_AUDIT)}, by_run_date=True)


def _snapshots(i: Inputs, as_of: dt.date) -> Result:
    layouts = {
        "insurance_case": schemas.INSURANCE_CASE,
        "insurance_phase": schemas.INSURANCE_PHASE,
        "insurance_lender": schemas.INSURANCE_LENDER,
    }
    return Result({n: (records.snapshot(i.table(n), s), s) for n, s in layouts.items()})


def _surgery_audit(i: Inputs, as_of: dt.date) -> Result:
    rows = staff.surgery_audit(*i.tables("surgery_audit personnel"))
    return Result({"surgery_audit": (rows, schemas.SURGERY_AUDIT)})


def _coverage(i: Inputs, as_of: dt.date) -> Result:
    inputs = i.tables("facility person_facility_map city")
    return Result(extracts={
        "coverage_by_city": staff.coverage_by_city(*inputs, i.roles),
        "uncovered_facilities": staff.uncovered_facilities(*inputs, i.roles),
    })


def _comments(i: Inputs, as_of: dt.date) -> Result:
    rows = records.outcome_comments(*i.tables("lead_comment appointment"))
    return Result({"outcome_comment": (rows, schemas.OUTCOME_COMMENT)})


def _person_facility(i: Inputs, as_of: dt.date) -> Result:
    rows = staff.person_facilities(*i.tables("personnel person_facility_map facility city"), i.roles)
    return Result({"person_facility": (rows, schemas.PERSON_FACILITY)})


def _attendance(i: Inputs, as_of: dt.date) -> Result:
    rows = staff.attendance_with_last_seen(
        *i.tables("attendance location_ping personnel person_facility_map facility city"), as_of,
        roles=i.roles,
    )
    return Result({"attendance": (rows, schemas.ATTENDANCE)})


def _tests(i: Inputs, as_of: dt.date) -> Result:
    tables = i.tables("appointment diagnostic_outcome diagnostic")
    rows = records.recommended_tests(*tables, i.roles)
    counts = records.recommended_test_counts(*tables, i.roles)
    return Result({"diagnostic_test": (rows, schemas.DIAGNOSTIC_TEST)}, {"diagnostic_test_count": counts})


def _commission(i: Inputs, as_of: dt.date) -> Result:
    texts = commission.case_texts(
        *i.tables(
            "insurance_case insurance_vendor facility city patient customer insurance_phase "
            "insurance_sub_phase insurance_lender"
        ),
        roles=i.roles,
    )
    rates = i.sheet("rate_agreement", RATE_COLUMNS)
    cases = i.watch(texts, "insurance_case", commission.unreadable_texts(commission.CASE_TEXTS))
    current = schemas.conform(
        commission.statement(commission.typed(cases), rates, i.roles), schemas.COMMISSION_STATEMENT
    )
    if i.earlier_cases:
        sheets = [i.sheet(name, columns) for name, columns in i.earlier_cases.items()]
        earlier = commission.earlier_statement(*sheets, empty=i.earlier_empty)
        current = schemas.conform(commission.full_statement(current, earlier), schemas.FULL_STATEMENT)
    read_rates = i.watch(rates, "rate_agreement", commission.unreadable_texts(commission.RATE_TEXTS))
    rejected = commission.case_rejects(texts).unionByName(commission.rate_rejects(read_rates))
    return Result(extracts={"commission_statement": current, "commission_rejects": rejected})


def _detail(i: Inputs, rows: DataFrame, routed: bool) -> DataFrame:
    city, people = i.tables("city personnel")
    people = people.withColumnRenamed("personnel_id", "id")
    support, field_staff = (
        calls.agents_by_number(people.where(F.col("personnel_type") == group), city, group, i.roles)
        for group in (i.roles.support, i.roles.field_staff)
    )
    agents = support.unionByName(field_staff) if routed else calls.agents_by_priority(support, field_staff)
    return calls.call_detail(
        rows, i.table("call_document"),
        calls.caller_cities(*i.tables("patient_case patient customer"), city, rows, i.roles), agents,
        route=calls.staff_route(i.roles) if routed else None, roles=i.roles,
    )


def _call_detail(i: Inputs, as_of: dt.date) -> Result:
    yesterday = as_of - dt.timedelta(days=1)
    rows = i.table("call").where(
        in_local_days(F.col("call_created_on"), yesterday, yesterday, dt.timedelta(0))
    )
    published = calls.published_calls(_detail(i, rows, routed=True))
    return Result({"call_detail": (published, schemas.CALL_DETAIL)}, by_run_date=True)


def _failed_calls(i: Inputs, as_of: dt.datetime) -> Result:
    detail = _detail(i, calls.recent(i.table("call"), as_of), routed=False)
    return Result(extracts={"failed_calls": calls.failed_calls(detail, as_of)})


def _campaign_feeds(i: Inputs, as_of: dt.date, periods: Periods | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The tagged ledger (stored), the campaigns' messages and the replies."""
    personnel, cases = i.tables("personnel patient_case")
    ledger = stored(
        cashback.tagged_ledger(
            *i.tables("cash_ledger customer appointment card_payment card payment_link"),
            cases.where(F.col("lead_source") == v.CUSTOMER_APP_SOURCE),
            personnel.where(F.col("personnel_type") == i.roles.field_staff),
            i.table("cashback_type"), as_of, roles=i.roles, periods=periods,
        ),
        "ledger",
    )
    messages = cashback.campaign_messages(
        *i.tables("message_log message_tag asset patient customer one_time_message"), ledger,
        as_of, roles=i.roles, periods=periods,
    )
    return ledger, messages, cashback.replies(*i.tables("chat_message call"), as_of, roles=i.roles, periods=periods)


def _cashback(i: Inputs, as_of: dt.date) -> Result:
    """Ledger, attribution and funnels share two stored tables, each computed once."""
    ledger, messages, replies = _campaign_feeds(i, as_of)
    attributed = stored(
        cashback.attributed_messages(messages, replies, cashback.spends(ledger)), "attributed"
    )
    funnels, rejected = cashback.campaign_funnels(attributed, as_of, i.roles, i.watch)
    return Result(extracts={
        "cash_ledger": ledger,
        "ledger_summary": cashback.with_text(cashback.ledger_summary(ledger, as_of)),
        "ledger_by_tag": cashback.with_text(cashback.ledger_by_tag(ledger, as_of)),
        "campaign_messages": attributed,
        "campaign_funnels": funnels,
        "campaign_rejects": rejected.select("id", "campaign", "reject_reason"),
        "campaign_uses": cashback.campaign_uses(attributed, as_of),
    })


def _per_user(i: Inputs, as_of: dt.date) -> Result:
    transactions = i.table("transaction")
    return Result(extracts={
        f"transactions_per_user_{grain}": cashback.per_user_report(
            cashback.transactions_per_user(transactions, grain, roles=i.roles), period, i.roles
        )
        for grain, period in {"month": ["year", "month"], "week": ["week"]}.items()
    })


JOBS: dict[str, Callable[[Inputs, dt.date], Result]] = {
    "availability": _availability,
    "personnel_profiles": _profiles,
    "audit_increment": _audit,
    "snapshots": _snapshots,
    "surgery_audit": _surgery_audit,
    "coverage_gaps": _coverage,
    "outcome_comments": _comments,
    "person_facilities": _person_facility,
    "attendance": _attendance,
    "recommended_tests": _tests,
    "commission": _commission,
    "call_detail": _call_detail,
    "failed_calls": _failed_calls,
    "cashback": _cashback,
    "transactions_per_user": _per_user,
}


@dataclass(frozen=True)
class FeedJob:
    """A feed over one input's inbox."""

    table: str
    feed: feeds.Feed


FEEDS: dict[str, FeedJob] = {
    "failed_call_counts": FeedJob("call_status", feeds.failed_call_counts()),
    "failed_call_rows": FeedJob("call_status", feeds.failed_calls()),
    "audit_rows": FeedJob("customer_audit", feeds.audit_rows()),
    "ledger_days": FeedJob("tagged_ledger", feeds.ledger_days()),
}


def run_feed(name: str, inputs: Inputs, out: str, files_per_batch: int = 1000) -> DataFrame:
    """Take in what has arrived below ``<root>/inbox/<table>``, publish what that changes, and return what is published now.

    Below ``<out>/<name>``: the stored batches in ``rows``, the feed's position in ``position`` (the two belong
    together), the answer in ``published``, laid out by its days.
    """
    job = FEEDS[name]
    schema = schemas.FEED_INPUTS[job.table]
    kept = feeds.store(inputs.spark, job.feed, f"{out}/{name}", schema)
    stream = feeds.file_stream(inputs.spark, f"{inputs.root}/inbox/{job.table}", schema, "*.parquet", files_per_batch)
    feeds.drain(stream, kept, f"{out}/{name}/position")
    kept.publish()
    kept.compact()
    return kept.published()


def run_campaigns(inputs: Inputs, out: str, first: dt.date, as_of: dt.date, horizon: dt.timedelta | None = None) -> DataFrame:
    """Take the local days ``first`` to the day before ``as_of`` into the campaigns' answers below ``<out>/campaign_answers``.

    Reads these days and the messages still open before them; returns every message with its answer so far.
    Days follow one another: ``first`` is the ``as_of`` of the run before, unless this is the first run.
    """
    split_skewed_joins(inputs.spark)
    log = CampaignLog(inputs.spark, f"{out}/campaign_answers", cashback.CAMPAIGNS, horizon)
    with intermediates(inputs.spark):
        ledger, messages, replies = _campaign_feeds(inputs, as_of, Stretch(as_of, first))
        start, until = (dt.datetime.combine(day, dt.time()) for day in (first, as_of))
        log.advance(stored(messages, "messages"), replies, cashback.spends(ledger), start, until)
    return log.answers()


def run(name: str, inputs: Inputs, out: str, as_of: dt.date) -> list[str]:
    """Run one job and publish what it produced; returns the paths written.

    ``as_of`` is the report date (for the failed-call feed: the date and time). The last path is the job's run report: per
    run date what was read, published and rejected, counted while publishing.
    """
    split_skewed_joins(inputs.spark)
    written, report = [], RunReport()
    run_date = as_of.date() if isinstance(as_of, dt.datetime) else as_of
    with intermediates(inputs.spark):
        result = JOBS[name](replace(inputs, watch=report.checked), as_of)
        for table, (df, schema) in result.tables.items():
            path = f"{out}/{table}"
            writers.publish(report.published(df, table), path, schema, run_date=as_of if result.by_run_date else None)
            written.append(path)
        for extract, df in result.extracts.items():
            path = f"{out}/{extract}"
            if extract in schemas.EXTRACTS:
                df = schemas.conform(df, schemas.EXTRACTS[extract])
            writers.write_csv(report.published(df, extract), path)
            written.append(path)
        path = f"{out}/{name}_run_report"
        writers.publish(report.frame(inputs.spark), path, schemas.RUN_REPORT, run_date=run_date)
    return [*written, path]
