"""Fixed values.

Codes and labels that stored data and published reports use. They are stated here as
plain text because results depend on them literally; everything a deployment may
rename (staff roles, tenant, source labels) is a field of ``Roles``.
"""

from __future__ import annotations

from dataclasses import dataclass

# --- fixed values: ledger -------------------------------------------------------
CREDITED = "CREDITED"
DEBITED = "DEBITED"
APPOINTMENT = "APPOINTMENT"
DIAGNOSTICS = "DIAGNOSTICS_APPOINTMENT"
SURGERY = "PATIENT_SURGERY"
LOYALTY = "LOYALTY_CARD"
ENTITY_TYPES = (APPOINTMENT, DIAGNOSTICS, SURGERY, LOYALTY)
PROMO_TYPE_CODE = 6
PROMO_BUCKET = "PROMOTIONAL"
NO_BUCKET = "OTHER"
FULL_PAYMENT = "Full_Payment"
PARTIAL_PAYMENT = "Partial_Payment"
NOT_APPLICABLE = "NA"
FOLLOW_UP = "FOLLOWUP_APPOINTMENT"
PAID = "PAID"
ACTIVE = "ACTIVE"
CUSTOMER_APP_SOURCE = "Customer App"
CUSTOMER_APP_TAG = "CUSTOMER_APP"
SUPPORT_TAG = "CS_AGENT"

# --- fixed values: campaigns and funnels -----------------------------------------
SMS = "SMS"
SUCCESS = "SUCCESS"
AFTER_VISIT_FLOWS = ("APP_DONE", "APP_CONFIRM_CANCEL", "APP_CANCEL")
HOME_PICK = "Home_pick"
DIAGNOSTICS_TEST = "Diagnostics_test"
PATIENT_ENTITY = "PATIENT_PROFILE"
USE_KINDS = {
    "new": "Appointment (New)",
    "follow_up": "Appointment (FollowUp)",
    "diagnostics": "Diagnostics Appointment",
    "loyalty": "Loyalty Card",
    "surgery": "Surgery",
    "other": "Other",
    "total": "Grand Total",
}

# --- fixed values: cities ----------------------------------------------------------
NO_CITY = "No City"

# --- fixed values: calls -----------------------------------------------------------
INBOUND = "inbound"
COMPLETED = "completed"
CALL_COMPLETED = "CALL_COMPLETED"
NO_DOCUMENT = "NO_CALL_INSIGHT"
LEG_1_COMPLETED = "LEG_1_COMPLETED"
CANCELED = "CANCELED"
BUSY = "BUSY"
CUSTOMER_CANCELLED = "CUSTOMER_CANCELLED"
NO_NUMBER_CANCELED = "NO_NUMBER_TO_DIALOUT_CANCELED"
NO_NUMBER_BUSY = "NO_NUMBER_TO_DIALOUT_BUSY"
FAILED_STATUSES = (
    "FAILED_SUBSCRIBER_UNAVAILABLE",
    "FAILED_OPERATOR_ERROR",
    "FAILED_UNKNOWN_ERROR",
)
LIST_DOCUMENT = "INBOUND_PATIENT_CALL_LIST"
DETAIL_DOCUMENT = "INCOMING_EXOTEL_CALL_DETAILS"
OFFICE_HOUR = "OFFICE_HOUR"
OFF_HOUR = "OFF_HOUR"
TRANSFERRED = "Call Transferred"
CHAT_FLOW = "WhatsApp Flow"
CHOOSE_LANGUAGE = "Choose Language"
SINGLE_LEVEL_FLOW = "CX_ATTEMPT_IVR_CALL_FLOW"
MULTI_LEVEL_FLOW = "CX_MULTI_LEVEL_LANGUAGE_IVR_CALL_FLOW"
MENU = "IVR"
NOT_MENU = "Non-IVR"
LANGUAGE_QUESTION = "3"
MENU_TEMPLATE = 3
MENU_ENTITY = "PATIENT_CASE"

# --- fixed values: availability, appointments, commission --------------------------
MEETING_REASON = "Going for a meeting"
DONE_OR_CANCELLED = (3, 4)
APPOINTMENT_DONE_STATUS = 3
OUTCOME_COMMENTS = (
    "APPOINTMENT_DONE",
    "APPOINTMENT_CANCELLED",
    "APPOINTMENT_DIRECT_DONE",
)
DIAGNOSTICS_CONSULTATION = "DIAGNOSTICS"
TICKET_MANAGER = "TICKET_AM"
EXCLUDED_ZONE = "INS"
DOCS_PHASE = "INSURANCE_DOCS_APPROVAL"
DISCHARGE_PHASE = "DISCHARGE_DOCS_APPROVAL"
SURGERY_DONE_PHASE = "MARKING_SURGERY_DONE"
FINANCE_SUB_PHASE = "FINANCE_ELIGIBILITY_APPROVAL"
ON_APPROVED = "on approved amount"
ON_TOTAL_BILL = "on total bill amount"
COMMISSION_DONE = "commission_calculated"
LENDER_MISSING = "lender_not_updated"
ADMISSION_MISSING = "admission_date_not_updated"
NO_LENDER = "None"
OTHER_LENDER = "24HR"
TAX_TEXT = "18.00%"


@dataclass(frozen=True)
class Roles:
    """What a deployment chooses: names of its staff groups, tenant, channels, JSON keys and
    sources, and its mappings (codes, short names, ids, tiers), which are empty by default."""

    field_staff: str = "FIELD_STAFF"
    support: str = "CUSTOMER_SUPPORT"
    central_team: str = "CENTRAL_INSURANCE_TEAM"
    tenant: str = "MAIN"
    field_mapping: str = "FIELD"
    case_source: str = "Partner"
    patient_source: str = "Dashboard"
    chat_channel: str = "WhatsApp"
    call_channel: str = "Call"
    cash_mode: str = "CASHBACK"
    cash_user: str = "cash"
    other_user: str = "non-cash"
    staff_key: str = "personnelType"
    flow_key: str = "cashNudgingFlow"
    promo_done_key: str = "cashPromoDone"
    promo_amount_key: str = "promotionalCashAmount"
    lender_categories: tuple[tuple[str, str], ...] = (
        ("Own PDC", "PDC-Own"),
        ("Hospital PDC", "PDC Hospital"),
    )
    # City code -> city, and city -> the short name it is published under.
    city_codes: tuple[tuple[str, str], ...] = ()
    city_short: tuple[tuple[str, str], ...] = ()
    home_pick_assets: tuple[int, ...] = ()
    diagnostic_assets: tuple[int, ...] = ()
    nudge_tags: tuple[int, ...] = ()
    amount_tiers: tuple[str, ...] = ()


ROLES = Roles()
