"""Commission statement: cases, their newest approval phases, and what they owe."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldbook import vocabulary as v
from fieldbook.functions.clock import (
    UTC_OFFSET, parse_time, since_local, to_local, year_month_label,
)
from fieldbook.functions.text import money, percent, unreadable
from fieldbook.operators.lookup import latest_per_key, restrict_to
from fieldbook.operators.pricing import DEFAULT_TAX, price_cases, price_sheet
from fieldbook.sources.readers import stack
from fieldbook.sources.schemas import SchemaMismatch

HISTORY_START = dt.datetime(2022, 10, 12)

STATEMENT = (
    "case_created_on", "case_created_month", "case_id", "surgery_id", "hospital_name",
    "patient_name", "contact_number", "email", "city", "lender_name", "category", "source",
    "patient_source", "vendor_name", "case_status", "admission_date", "discharge_date",
    "insurance_name", "tpa_name", "treatment_type", "surgery_name", "speciality_name",
    "total_bill", "approved", "collected_by_hospital", "other_collected", "discount", "share",
    "tax", "net_share", "share_amount", "tax_amount", "total_share", "withheld", "net_payable",
    "chargeable_amount", "chargeable_on", "statement_note",
)


PHASE_DETAILS = """
    surgeryDischargeApprovalInfo struct<nme: string, totalBillAmount: string, finalApprovedAmount: string>,
    surgeryDischargeDoneRequest struct<admissionDate: string, dischargeDate: string>"""


def newest_phases(phases: DataFrame) -> DataFrame:
    """Per case: the id of its newest documents phase, and the fields of its newest discharge
    and surgery-done phases. One scan, one parse and one aggregate serve all three."""
    wanted = phases.select(
        F.col("insurance_case_id").alias("case_id"), "phase_id", F.upper("phase_type").alias("kind"),
        F.from_json("additional_details", PHASE_DETAILS).alias("d"),
    ).where(F.col("kind").isin(v.DOCS_PHASE, v.DISCHARGE_PHASE, v.SURGERY_DONE_PHASE))

    def newest(phase_type: str) -> Column:
        return F.when(F.col("kind") == phase_type, F.col("phase_id"))

    return (
        wanted.groupBy("case_id")
        .agg(
            F.max(newest(v.DOCS_PHASE)).alias("docs_phase_id"),
            F.max_by("d.surgeryDischargeApprovalInfo", newest(v.DISCHARGE_PHASE)).alias("approval"),
            F.max_by("d.surgeryDischargeDoneRequest", newest(v.SURGERY_DONE_PHASE)).alias("done"),
        )
        .select(
            "case_id", "docs_phase_id", F.col("approval.nme").alias("collected_by_hospital"),
            F.col("approval.totalBillAmount").alias("total_bill_text"),
            F.col("approval.finalApprovedAmount").alias("approved_text"),
            F.col("done.admissionDate").alias("admission_text"),
            F.col("done.dischargeDate").alias("discharge_date"),
        )
    )


def lender_per_phase(sub_phases: DataFrame, lenders: DataFrame) -> DataFrame:
    """Lender of the newest finance sub-phase per phase; the lender id sits in JSON text."""
    finance = sub_phases.where(F.upper("sub_phase_type") == v.FINANCE_SUB_PHASE)
    newest = latest_per_key(
        finance.withColumn(
            "lender_id",
            F.get_json_object("additional_details", "$.financeEligibilityInfo.lenderId").try_cast("bigint"),
        ),
        "phase_id", "sub_phase_id", ["lender_id"],
    )
    return newest.join(lenders.select("lender_id", "lender_name"), "lender_id", "left").select(
        F.col("phase_id").alias("docs_phase_id"), "lender_name"
    )


def case_texts(
    cases: DataFrame,
    vendors: DataFrame,
    facility: DataFrame,
    city: DataFrame,
    patients: DataFrame,
    customers: DataFrame,
    phases: DataFrame,
    sub_phases: DataFrame,
    lenders: DataFrame,
    *,
    start: dt.datetime = HISTORY_START,
    roles: v.Roles = v.ROLES,
    offset: dt.timedelta = UTC_OFFSET,
) -> DataFrame:
    """Cases since ``start`` with their dimensions and newest phases, amounts and dates as stored."""
    created = to_local(F.col("created_on"), offset)
    base = cases.where(since_local(F.col("created_on"), start, offset)).select(
        created.alias("case_created_on"),
        year_month_label(created).alias("case_created_month"),
        F.col("id").alias("case_id"), "surgery_id", "patient_id", "facility_id", "vendor_id",
        F.lit(roles.case_source).alias("source"),
        F.lit(roles.patient_source).alias("patient_source"),
        F.col("status").alias("case_status"), "insurance_name",
        F.get_json_object("additional_details", "$.tpaName").alias("tpa_name"),
        "treatment_type", "surgery_name", "speciality_name",
    )
    # Both histories are cut to the cases asked for before their JSON is parsed and grouped.
    own = base.select(F.col("case_id").alias("insurance_case_id"))
    # What grows with the cases is joined by shuffles: these columns are made by expressions, so their size as stored, which
    # Spark's threshold for broadcasts goes by, says little about the driver's memory. Narrow rows meet before the cases do.
    newest = newest_phases(restrict_to(phases, own.hint("merge"), "insurance_case_id"))
    docs = newest.select(F.col("docs_phase_id").alias("phase_id"))
    finance = restrict_to(sub_phases, docs.hint("merge"), "phase_id")
    people = patients.select(F.col("id").alias("patient_id"), "customer_id").join(
        customers.select(
            "customer_id", F.col("name").alias("patient_name"),
            F.col("customer_number").alias("contact_number"), "email",
        ).hint("merge"),
        "customer_id", "left",
    )
    approvals = newest.join(lender_per_phase(finance, lenders).hint("merge"), "docs_phase_id", "left")
    return (
        base.join(vendors.select("vendor_id", "vendor_name"), "vendor_id", "left")
        .join(
            facility.select("facility_id", F.col("alias_name").alias("hospital_name"), "city_id"),
            "facility_id", "left",
        )
        .join(city.select(F.col("id").alias("city_id"), F.col("city_name").alias("city")), "city_id", "left")
        .join(people.hint("merge"), "patient_id", "left")
        .join(approvals.hint("merge"), "case_id", "left")
        .drop("docs_phase_id", "vendor_id", "facility_id", "city_id", "patient_id", "customer_id")
    )


def typed(texts: DataFrame) -> DataFrame:
    """Ready for pricing. What can't be read becomes NULL; ``case_rejects`` lists it."""
    parsed = {c: read(F.col(text)) for text, (c, read) in CASE_TEXTS.items()}
    return texts.withColumns(parsed).drop(*CASE_TEXTS)


def open_cases(*tables: DataFrame, **options) -> DataFrame:
    """``case_texts``, typed for pricing."""
    return typed(case_texts(*tables, **options))


# Stored text -> the column made from it, and how.
CASE_TEXTS = {
    "total_bill_text": ("total_bill", money), "approved_text": ("approved", money),
    "admission_text": ("admission_date", parse_time),
}
RATE_TEXTS = {
    "share_pct": ("share", percent), "net_share_pct": ("net_share", percent),
    "start_date": ("start_date", parse_time), "end_date": ("end_date", parse_time),
}


def _rejects(rows: DataFrame, id: str, texts: Mapping) -> DataFrame:
    entries = [
        F.when(unreadable(F.col(text), read(F.col(text))), F.struct(F.lit(name).alias("c"), F.col(text).alias("value")))
        for text, (name, read) in texts.items()
    ]
    found = rows.select(F.col(id).cast("string").alias("id"), F.explode(F.array_compact(F.array(*entries))).alias("e"))
    return found.select(
        "id", F.col("e.c").alias("column"), F.col("e.value").alias("value"),
        F.concat(F.lit("unreadable "), F.col("e.c"), F.lit(": "), F.col("e.value")).alias("reject_reason"),
    )


def case_rejects(texts: DataFrame) -> DataFrame:
    """Amounts and dates of cases that say something but can't be read: (id, column, value, reject_reason)."""
    return _rejects(texts, "case_id", CASE_TEXTS)


def unreadable_texts(texts: Mapping) -> dict[str, Column]:
    """Reason -> whether a row's text says something that can't be read; of ``CASE_TEXTS`` or ``RATE_TEXTS``."""
    return {f"unreadable {name}": unreadable(F.col(text), read(F.col(text))) for text, (name, read) in texts.items()}


def rate_rejects(sheet: DataFrame) -> DataFrame:
    """The same of the agreements' percentages and dates, by key."""
    return _rejects(sheet, "key", RATE_TEXTS)


def _layout(priced: DataFrame, tax: str | None, empty: Sequence[str] = ()) -> DataFrame:
    """The published columns. Those in ``empty`` are published as NULL; any other that is missing
    ends the run, so a renamed or lost input column is noticed."""
    renamed = (
        priced.withColumn("tax", F.lit(tax).cast("string"))
        .withColumn("chargeable_amount", F.col("approved"))
        .withColumnRenamed("remarks", "chargeable_on")
    )
    lost = [c for c in STATEMENT if c not in renamed.columns and c not in empty]
    if lost:
        raise SchemaMismatch(f"statement columns {lost} are missing")
    return renamed.select(*[F.lit(None).cast("string").alias(c) if c in empty else F.col(c) for c in STATEMENT])


def statement(cases: DataFrame, rates: DataFrame, roles: v.Roles = v.ROLES) -> DataFrame:
    return _layout(price_cases(cases, rates, roles), None)


def earlier_statement(
    *sheets: DataFrame, tax_rate: str = DEFAULT_TAX, empty: Sequence[str] = ()
) -> DataFrame:
    """Statement rows of the earlier text sheets, whose columns may differ; ``empty`` names the
    published columns that no sheet has."""
    return _layout(price_sheet(stack(*sheets), tax_rate), v.TAX_TEXT, empty)


def full_statement(current: DataFrame, earlier: DataFrame) -> DataFrame:
    """Both statements under the published layout; dates and ids are text in the sheets."""
    as_text = ("case_created_on", "admission_date", "discharge_date", "case_id", "surgery_id")

    def texted(df: DataFrame) -> DataFrame:
        return df.select(
            *[F.col(c).cast("string").alias(c) if c in as_text else F.col(c) for c in STATEMENT]
        )

    return stack(texted(earlier), texted(current))
