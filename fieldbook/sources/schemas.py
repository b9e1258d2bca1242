"""Declared schemas and their enforcement."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

_TYPES = {
    "s": T.StringType(), "l": T.LongType(), "t": T.TimestampNTZType(), "d": T.DateType(),
    "m": T.DecimalType(18, 2), "a": T.DecimalType(18, 4), "r": T.DecimalType(18, 6), "M": T.DecimalType(28, 2), "b": T.BooleanType(), "i": T.IntegerType(), "f": T.DoubleType(),
}


def struct(spec: str) -> T.StructType:
    """``"id:l name:s created_on:t"`` → StructType."""
    return T.StructType([
        T.StructField(name, _TYPES[code])
        for name, code in (part.split(":") for part in spec.split())
    ])


def _texts(names: str) -> str:
    return " ".join(f"{n}:s" for n in names.split())


INSURANCE_CASE = struct(
    "id:l patient_id:l facility_id:l vendor_id:l status:s comments:s personnel_id:l "
    "treatment_type:s surgery_id:l surgery_name:s speciality_name:s insurance_name:s "
    "additional_details:s created_on:t updated_on:t assigned_to:s pending_phase_type:s"
)
INSURANCE_PHASE = struct(
    "phase_id:l phase_type:s insurance_case_id:l status:s reason:s assigned_to:l "
    "additional_details:s created_on:t updated_on:t"
)
INSURANCE_LENDER = struct(
    "lender_id:l lender_name:s additional_details:s created_on:t updated_on:t"
)
CUSTOMER_AUDIT = struct(
    "rev_type:s rev:s customer_id:l name:s email:s gender:s date_of_birth:s number:s "
    "secondary_number:s secondary_on_chat:s referral_code:s app_token:s tenant_name:s "
    "language:s lead_source:s location:s additional_details:s created_on:t updated_on:t "
    "customer_type:s"
)
AGENT_ACTIVE = struct(_texts(
    "id assigned_to new_value previous_value reason created_on created_on_lead reason_lead "
    "new_value_lead total_active_sec city_id"
))
PERSONNEL_DETAIL = struct(_texts(
    "personnel_id personnel_type email name phone is_available has_left created_on updated_on "
    "is_test_account additional_details city alias_name facility_type mapping_type "
    "availability_type permission_type"
))
SURGERY_AUDIT = struct(_texts(
    "case_id created_on user tenant_name treatment_type admission_date discharge_date doctor_id "
    "hospital_id owner_id package_type surgery_status follow_up_date surgery_id treatment_name "
    "promised_price discount price email lead_uniqueness_status additional_details "
    "personnel_type is_manager"
))
OUTCOME_COMMENT = struct(_texts("comment_id lead_id text lead_type user created_on comment_type"))
PERSON_FACILITY = struct(_texts("email city hospital"))
ATTENDANCE = struct(_texts("email login_time last_active_time hospital_name city"))
DIAGNOSTIC_TEST = struct(_texts(
    "lead_id appointment_id appointment_date creation_type consultation_type "
    "test_recommended test_names"
))
CALL_DETAIL = struct(
    "sid:s call_created_on:t status:s direction:s to_no:s from_no:s exotel_no:s duration:s "
    "price:s leg_1_status:s leg_1_duration:s leg_2_status:s leg_2_duration:s recording_url:s "
    "mask_date:d hour:s month:s year:s hour_tag:s customer_no:s city:s menu_check:s "
    "menu_transfer_status:s no_sent:s personnel_type:s leg1_detailed_status:s "
    "leg2_detailed_status:s leg3_detailed_status:s final_status:s leg1_agent_number:s "
    "leg2_agent_number:s leg3_agent_number:s leg1_status:s leg2_status:s leg3_status:s "
    "leg1_agent_email:s leg2_agent_email:s leg3_agent_email:s leg1_agent_city:s "
    "leg2_agent_city:s leg3_agent_city:s requested:s agent_in_system:s agent_available:s"
)


# The jobs' inputs as they are stored.
INPUTS = {
    "personnel": struct(
        "personnel_id:l personnel_type:s email:s name:s phone:s is_available:i has_left:i is_manager:s "
        "city_id:l created_on:s updated_on:s is_test_account:s additional_details:s"
    ),
    "personnel_permission": struct("id:l personnel_id:l permission_type:s"),
    "facility": struct("facility_id:l alias_name:s zone:s city_id:l active:i"),
    "person_facility_map": struct(
        "id:l person_id:l facility_id:l facility_type:s mapping_type:s availability_type:s is_valid:i tenant_name:s"
    ),
    "city": struct("id:l city_name:s"),
    "agent_activity": struct("id:l personnel_id:l created_on:t activity:s"),
    "attendance": struct("id:l personnel_id:l login_time:t attendance_date:d"),
    "location_ping": struct("id:l email:s created_on:t date:d"),
    "customer_audit": CUSTOMER_AUDIT,
    "lead_comment": struct(
        "comment_id:s lead_id:l text:s lead_type:s user:s created_on:d comment_type:s"
    ),
    "appointment": struct(
        "id:l lead_id:l user:s status:i consultation_type:s creation_type:s consultation_fee:m "
        "appointment_date:d tenant_name:s additional_details:s"
    ),
    "diagnostic_outcome": struct("appointment_id:l test_id:l"),
    "diagnostic": struct("id:l name:s"),
    "surgery_audit": struct(
        "case_id:l created_on:d user:s tenant_name:s treatment_type:s admission_date:d discharge_date:d "
        "doctor_id:l hospital_id:l owner_id:l package_type:s surgery_status:s follow_up_date:d surgery_id:i "
        "treatment_name:s promised_price:m discount:m price:m lead_uniqueness_status:s additional_details:s"
    ),
    "insurance_case": INSURANCE_CASE,
    "insurance_phase": INSURANCE_PHASE,
    "insurance_sub_phase": struct("sub_phase_id:l phase_id:l sub_phase_type:s additional_details:s"),
    "insurance_lender": INSURANCE_LENDER,
    "insurance_vendor": struct("vendor_id:l vendor_name:s"),
    "patient": struct("id:l customer_id:l city_id:l"),
    "customer": struct("customer_id:l name:s email:s customer_number:s"),
    "patient_case": struct("case_id:l patient_id:l city_id:l lead_source:s"),
    "call": struct(
        "id:l sid:s call_created_on:t status:s direction:s to_no:s from_no:s exotel_no:s duration:l price:m "
        "leg_1_status:s leg_1_duration:l leg_2_status:s leg_2_duration:l recording_url:s"
    ),
    "call_document": struct("id:l call_sid:s created_on:t insight_type:s insight_data:s"),
    "cash_ledger": struct(
        "id:l customer_id:l cashback_type:l amount:l issued_entity_type:s issued_entity_id:l "
        "transaction_type:s created_on:t"
    ),
    "cashback_type": struct("cashback_id:l cashback_type:s is_active:i"),
    "payment_link": struct("entity_id:l entity_type:s status:s amount:l"),
    "card": struct("card_id:l status:s"),
    "card_payment": struct("card_id:l collected_by:s"),
    "message_log": struct(
        "id:l entity_tag_map_id:l communication_date:t communication_done:i communication_type:s asset_id:l"
    ),
    "message_tag": struct("id:l tag_id:i entity_id:l entity_type:s additional_details:s"),
    "asset": struct("id:l"),
    "one_time_message": struct(
        "id:l scheduled_on:t patient_number:s communication_type:s status:s additional_details:s"
    ),
    "chat_message": struct("id:l from_id:s to_message:s created_on:t"),
    "transaction": struct("patient_id:l payment_mode:s created_on:t week:s"),
}


COMMISSION_STATEMENT = struct(
    "case_created_on:t case_created_month:s case_id:l surgery_id:l hospital_name:s patient_name:s "
    "contact_number:s email:s city:s lender_name:s category:s source:s patient_source:s vendor_name:s "
    "case_status:s admission_date:t discharge_date:s insurance_name:s tpa_name:s treatment_type:s "
    "surgery_name:s speciality_name:s total_bill:m approved:m collected_by_hospital:s other_collected:m "
    "discount:m share:r tax:s net_share:r share_amount:a tax_amount:a total_share:a withheld:m "
    "net_payable:a chargeable_amount:m chargeable_on:s statement_note:s"
)
# With the earlier sheets, whose dates and ids are text.
FULL_STATEMENT = T.StructType([
    T.StructField(f.name, T.StringType())
    if f.name in ("case_created_on", "admission_date", "discharge_date", "case_id", "surgery_id") else f
    for f in COMMISSION_STATEMENT
])
_MATRIX = "bucket:s yesterday:M month_to_date:M last_month:M yesterday_text:s month_to_date_text:s last_month_text:s"
# Layouts of the report extracts. Those with a column per period's kind of user take its names from ``Roles``.
EXTRACTS = {
    "uncovered_facilities": struct("city_name:s hospital_name:s zone:s"),
    "coverage_by_city": struct("city_name:s uncovered:l"),
    "diagnostic_test_count": struct("appointment_id:l name:s times:l"),
    "personnel_rejects": T.StructType([*INPUTS["personnel"], T.StructField("reject_reason", T.StringType())]),
    "commission_rejects": struct("id:s column:s value:s reject_reason:s"),
    "failed_calls": struct("sid:s call_created_on:t final_status:s notify:s"),
    "cash_ledger": struct(
        "id:l customer_id:l cashback_type:l amount:m issued_entity_type:s issued_entity_id:s "
        "transaction_type:s created_on:t phone:s tag:s payment_tag:s creation_type:s cashback_label:s"
    ),
    "ledger_summary": struct(f"direction:s {_MATRIX}"),
    "ledger_by_tag": struct(f"tag:s {_MATRIX}"),
    "campaign_messages": struct(
        "campaign:s id:l phone:s customer:s sent_on:t flow:s amount_tier:s responded:b response_id:l "
        "channel:s used:b spend_id:l used_on:s creation_type:s"
    ),
    "campaign_funnels": struct(
        "campaign:s split:s period:s sent:l responded:l used:l unique_customers:l response_pct:m conversion_pct:m"
    ),
    "campaign_rejects": struct("id:l campaign:s reject_reason:s"),
    "campaign_uses": struct("campaign:s use_kind:s yesterday:l month_to_date:l last_month:l"),
}

RUN_REPORT = struct("table:s measure:s reason:s rows:l")

# What arrives in the inboxes of the feeds.
FEED_INPUTS = {
    "call_status": struct("sid:s call_created_on:t final_status:s"),
    "customer_audit": CUSTOMER_AUDIT,
    "tagged_ledger": struct(
        "transaction_type:s issued_entity_type:s cashback_type:l amount:m created_on:t payment_tag:s"
    ),
}


class SchemaMismatch(ValueError):
    pass


def assert_stored(df: DataFrame, schema: T.StructType) -> None:
    """The stored columns and their types are those declared, in any order."""
    assert_columns(df, schema)
    have = {f.name: f.dataType for f in df.schema}
    wrong = {f.name: f"{have[f.name].simpleString()}, not {f.dataType.simpleString()}" for f in schema if have[f.name] != f.dataType}
    if wrong:
        raise SchemaMismatch(f"columns of another type: {wrong}")


def assert_columns(df: DataFrame, schema: T.StructType) -> None:
    have, want = set(df.columns), set(schema.fieldNames())
    if have != want:
        raise SchemaMismatch(
            f"missing columns {sorted(want - have)}, unexpected columns {sorted(have - want)}"
        )


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Declared columns only, in declared order and type; anything else fails at once."""
    assert_columns(df, schema)
    return df.selectExpr(
        *[f"cast(`{f.name}` as {f.dataType.simpleString()}) as `{f.name}`" for f in schema]
    )
