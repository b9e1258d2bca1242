"""Staff reports: availability, profiles, facility mappings, attendance, gaps."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldbook import vocabulary as v
from fieldbook.functions.clock import UTC_OFFSET, short_time_text, to_local, up_to_yesterday
from fieldbook.functions.text import city_label, stringify
from fieldbook.operators.activity import active_seconds
from fieldbook.operators.lookup import first_per_key, latest_per_key, left_lookup
from fieldbook.operators.reporting import apply_codes, coverage_gaps
from fieldbook.plans.run_report import Watch, unwatched
from fieldbook.sources import schemas

ACTIVITY = "newAvailabilityValue string, perviousAvailabilityValue string, reason string"


def availability_sessions(
    agent_activity: DataFrame,
    personnel: DataFrame,
    as_of: dt.date,
    *,
    roles: v.Roles = v.ROLES,
    offset: dt.timedelta = UTC_OFFSET,
) -> DataFrame:
    """How long was each support agent available?"""
    support = personnel.where(F.col("personnel_type") == roles.support).select(
        "personnel_id", F.lower("email").alias("assigned_to"), "city_id"
    )
    rows = (
        agent_activity.where(up_to_yesterday(F.col("created_on"), as_of, offset))
        .join(support, "personnel_id")
        .withColumn("change", F.from_json("activity", ACTIVITY))
        .select(
            "id", "assigned_to",
            F.col("change.newAvailabilityValue").alias("new_value"),
            F.col("change.perviousAvailabilityValue").alias("previous_value"),
            F.col("change.reason").alias("reason"),
            to_local(F.col("created_on"), offset).alias("created_on"),
            "city_id",
        )
    )
    active = (F.col("new_value") == "true") | (F.col("reason") == v.MEETING_REASON)
    timed = active_seconds(
        rows, agent="assigned_to", ts="created_on", id="id", value="new_value",
        reason="reason", active=active, as_of=as_of,
    )
    return schemas.conform(timed, schemas.AGENT_ACTIVE)


def personnel_profiles(
    personnel: DataFrame,
    facility_map: DataFrame,
    facility: DataFrame,
    permissions: DataFrame,
    roles: v.Roles = v.ROLES,
    watch: Watch = unwatched,
) -> tuple[DataFrame, DataFrame]:
    """(profiles, rejects): person, city, first facility mapping and first permission.

    facility_map and permissions need an ``id`` that orders them. A person without mapping
    or permission shows ''; a person with an unknown city code is rejected.
    """
    named = facility_map.join(facility.select("facility_id", "alias_name"), "facility_id", "left")
    first_map = first_per_key(
        named.withColumnRenamed("person_id", "personnel_id"), "personnel_id", "id",
        ["alias_name", "facility_type", "mapping_type", "availability_type"],
    )
    first_permission = first_per_key(permissions, "personnel_id", "id", ["permission_type"])
    accepted, rejected = apply_codes(
        personnel, F.col("city_id"), dict(roles.city_codes), "city", lambda rows, why: watch(rows, "personnel", why)
    )
    full = left_lookup(
        accepted, first_map, "personnel_id",
        {"alias_name": "", "facility_type": "", "mapping_type": "", "availability_type": ""},
    )
    full = left_lookup(full, first_permission, "personnel_id", {"permission_type": ""})
    wanted = schemas.PERSONNEL_DETAIL.fieldNames()
    return schemas.conform(full.select(*wanted), schemas.PERSONNEL_DETAIL), rejected


def _valid_field_maps(facility_map: DataFrame, roles: v.Roles) -> DataFrame:
    return facility_map.where(
        (F.col("is_valid") == 1)
        & (F.col("tenant_name") == roles.tenant)
        & (F.col("mapping_type") == roles.field_mapping)
    )


def person_facilities(
    personnel: DataFrame, facility_map: DataFrame, facility: DataFrame, city: DataFrame,
    roles: v.Roles = v.ROLES,
) -> DataFrame:
    """Available field staff with each of their facilities and a normalised city."""
    people = personnel.where(
        (F.col("is_available") == 1)
        & (F.col("personnel_type") == roles.field_staff)
        & (F.col("has_left") == 0)
    )
    return schemas.conform(
        people.join(
            _valid_field_maps(facility_map, roles).select(
                F.col("person_id").alias("personnel_id"), "facility_id"
            ),
            "personnel_id",
        )
        .join(facility.select("facility_id", "alias_name"), "facility_id")
        .join(city.select(F.col("id").alias("city_id"), "city_name"), "city_id", "left")
        .select(
            "email", city_label(F.col("city_name"), missing="NA", short=dict(roles.city_short)).alias("city"),
            F.col("alias_name").alias("hospital"),
        ),
        schemas.PERSON_FACILITY,
    )


def attendance_with_last_seen(
    attendance: DataFrame,
    location_pings: DataFrame,
    personnel: DataFrame,
    facility_map: DataFrame,
    facility: DataFrame,
    city: DataFrame,
    as_of: dt.date,
    *,
    roles: v.Roles = v.ROLES,
    offset: dt.timedelta = UTC_OFFSET,
) -> DataFrame:
    """Logins of the day with the person's first facility and latest location time."""
    field = personnel.where(F.col("personnel_type") == roles.field_staff)
    placed = (
        field.where(F.col("has_left") == 0)
        .join(
            _valid_field_maps(facility_map, roles).select(
                F.col("person_id").alias("personnel_id"), "facility_id", F.col("id").alias("map_id")
            ),
            "personnel_id",
        )
        .join(facility.select("facility_id", "alias_name"), "facility_id")
    )
    hospital = first_per_key(placed, "email", "map_id", ["alias_name"]).withColumnRenamed(
        "alias_name", "hospital_name"
    )
    seen = latest_per_key(
        location_pings.where(F.col("date") == F.lit(as_of)).join(
            field.select("email"), "email", "left_semi"
        ),
        "email", "created_on", ["created_on"],
    ).select(
        "email",
        short_time_text(to_local(F.col("created_on"), offset)).alias("last_active_time"),
    )
    logins = (
        attendance.where(F.col("attendance_date") == F.lit(as_of))
        .join(field.select("personnel_id", "email", "city_id"), "personnel_id")
        .join(city.select(F.col("id").alias("city_id"), "city_name"), "city_id", "left")
        .select(
            "email", to_local(F.col("login_time"), offset).alias("login_time"),
            city_label(F.col("city_name"), missing="NA", short=dict(roles.city_short)).alias("city"),
        )
    )
    out = left_lookup(logins, hospital, "email", {"hospital_name": ""})
    out = left_lookup(out, seen, "email", {"last_active_time": ""})
    return schemas.conform(out, schemas.ATTENDANCE)


def _ticket_rows(
    facility: DataFrame, facility_map: DataFrame, city: DataFrame, roles: v.Roles
) -> DataFrame:
    managers = facility_map.where(
        (F.col("is_valid") == 1)
        & (F.col("tenant_name") == roles.tenant)
        & (F.col("mapping_type") == v.TICKET_MANAGER)
    ).select("facility_id", F.col("id").alias("map_id"), "mapping_type")
    return (
        facility.where((F.col("active") == 1) & (F.col("zone") != v.EXCLUDED_ZONE))
        .join(managers, "facility_id", "left")
        .join(city.select(F.col("id").alias("city_id"), "city_name"), "city_id", "left")
    )


def coverage_by_city(
    facility: DataFrame, facility_map: DataFrame, city: DataFrame, roles: v.Roles = v.ROLES
) -> DataFrame:
    """Facilities without a ticket manager per city, cities without a gap included."""
    return coverage_gaps(
        _ticket_rows(facility, facility_map, city, roles), entity="alias_name",
        order=["facility_id", "map_id"], group="city_name",
        covered=F.col("mapping_type").isNotNull(),
    )


def uncovered_facilities(
    facility: DataFrame, facility_map: DataFrame, city: DataFrame, roles: v.Roles = v.ROLES
) -> DataFrame:
    firsts = first_per_key(
        _ticket_rows(facility, facility_map, city, roles), "alias_name",
        ["facility_id", "map_id"], ["city_name", "zone", "mapping_type"],
    )
    return firsts.where(F.col("mapping_type").isNull()).select(
        "city_name", F.col("alias_name").alias("hospital_name"), "zone"
    )


def surgery_audit(audit: DataFrame, personnel: DataFrame) -> DataFrame:
    """Audit rows with the attributes of the person who owns them."""
    owners = personnel.select(
        F.col("personnel_id").alias("owner_id"), "email", "personnel_type", "is_manager"
    )
    full = audit.join(owners, "owner_id", "left")
    wanted = schemas.SURGERY_AUDIT.fieldNames()
    return schemas.conform(full.select(*stringify(*wanted)), schemas.SURGERY_AUDIT)
