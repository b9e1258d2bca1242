"""Record feeds: audit increment, table snapshots, outcome comments, recommended tests."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldbook import vocabulary as v
from fieldbook.functions.clock import UTC_OFFSET, in_previous_local_day
from fieldbook.operators.lookup import restrict_to
from fieldbook.operators.reporting import name_counts, names_text
from fieldbook.sources import schemas


def audit_increment(
    customer_audit: DataFrame, as_of: dt.date, offset: dt.timedelta = UTC_OFFSET
) -> DataFrame:
    """Audit rows of yesterday's local day; publish with ``run_date=as_of``."""
    rows = customer_audit.where(in_previous_local_day(F.col("created_on"), as_of, offset))
    return schemas.conform(rows, schemas.CUSTOMER_AUDIT)


def snapshot(table: DataFrame, schema: T.StructType) -> DataFrame:
    """Full copy in the declared layout; a drifted source fails instead of publishing."""
    return schemas.conform(table, schema)


def outcome_comments(lead_comments: DataFrame, appointments: DataFrame) -> DataFrame:
    """Comments on appointments that were done or cancelled."""
    finished = appointments.where(F.col("status").isin(*v.DONE_OR_CANCELLED)).select(
        F.col("id").alias("lead_id")
    )
    rows = lead_comments.where(
        (F.col("lead_type") == v.APPOINTMENT) & F.col("comment_type").isin(*v.OUTCOME_COMMENTS)
    ).join(finished, "lead_id", "left_semi")
    return schemas.conform(rows, schemas.OUTCOME_COMMENT)


def recommended_tests(
    appointments: DataFrame, outcomes: DataFrame, tests: DataFrame, roles: v.Roles = v.ROLES
) -> DataFrame:
    """Completed appointments with the names of the tests recommended there.

    appointments (id, lead_id, status, consultation_type, creation_type, appointment_date,
    tenant_name, additional_details), outcomes (appointment_id, test_id), tests (id, name).
    """
    done = _done(appointments, roles).select(
        "lead_id", F.col("id").alias("appointment_id"), "appointment_date", "creation_type",
        "consultation_type",
        F.get_json_object("additional_details", "$.isDiagnosticsTestRecommended").alias(
            "test_recommended"
        ),
    )
    counts = recommended_test_counts(appointments, outcomes, tests, roles)
    lists = names_text(counts, "appointment_id", "name", "test_names")
    return schemas.conform(done.join(lists, "appointment_id", "left"), schemas.DIAGNOSTIC_TEST)


def recommended_test_counts(
    appointments: DataFrame, outcomes: DataFrame, tests: DataFrame, roles: v.Roles = v.ROLES
) -> DataFrame:
    """(appointment_id, name, times): how often a completed appointment recommended a test.

    This is the shape that scales; the list as text is made from it for publishing. Outcomes
    are cut down to completed appointments before they are joined and counted.
    """
    finished = _done(appointments, roles).select(F.col("id").alias("appointment_id"))
    named = restrict_to(outcomes, finished, "appointment_id").join(
        tests.select(F.col("id").alias("test_id"), "name"), "test_id", "left"
    )
    return name_counts(named, "appointment_id", "name")


def _done(appointments: DataFrame, roles: v.Roles) -> DataFrame:
    return appointments.where(
        (F.col("consultation_type") != v.DIAGNOSTICS_CONSULTATION)
        & (F.col("status") == v.APPOINTMENT_DONE_STATUS)
        & (F.col("tenant_name") == roles.tenant)
    )
