"""Probes: the reports end to end, on inputs bound to the driver's tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from fieldbook import vocabulary as v
from fieldbook.functions.clock import Periods, micros
from fieldbook.operators.ledger import card_facts, tag_ledger, visit_facts
from fieldbook.operators.reporting import reject_counts
from fieldbook.plans import calls, cashback, commission, records, staff
from fieldbook.probes.deployment import ROLES
from fieldbook.probes.registry import Tables, probe
from fieldbook.probes.rows import AS_OF, CODE_SQL, EVENT_DAY, PHONE_SQL, STATUS_SQL, base_status_sql
from fieldbook.probes.tables import (
    BUCKET_SQL, DETAIL_SQL, GAP_ROWS, LIST_SQL, PERIOD_SUMS, attribution_sql, funnel_sql, per_user_sql,
)
from fieldbook.session import stored
from fieldbook.sources import schemas

# ---- staff ---------------------------------------------------------------------------


@probe("J01_availability_sessions", """
    with rows as (
      select a.id, lower(p.email) as assigned_to, json_extract_string(activity, '$.newAvailabilityValue') as new_value,
             json_extract_string(activity, '$.perviousAvailabilityValue') as previous_value,
             json_extract_string(activity, '$.reason') as reason, a.created_on + interval '330 minutes' as local_on, p.city_id
      from agent_activity a join personnel p on p.personnel_id = a.personnel_id and p.personnel_type = 'CUSTOMER_SUPPORT'
      where cast(a.created_on + interval '330 minutes' as date) <= date '2024-01-14'),
    led as (select *, lead(local_on) over w as on_lead, lead(reason) over w as reason_lead, lead(new_value) over w as new_value_lead
            from rows window w as (partition by assigned_to order by local_on, id))
    select id::varchar as id, assigned_to, new_value, previous_value, reason, epoch_us(local_on) as created_us,
           epoch_us(on_lead) as lead_us, reason_lead, new_value_lead, city_id::varchar as city_id,
           cast(case when new_value = 'true' or reason = 'Going for a meeting' then
             cast(floor((epoch_us(case when new_value_lead is null then timestamp '2024-01-14 23:59:59' else on_lead end) - epoch_us(local_on)) / 1000000.0) as bigint)
           end as varchar) as total_active_sec
    from led""", "agent_activity personnel")
def _(t: Tables):
    out = staff.availability_sessions(*t.views("agent_activity personnel"), EVENT_DAY)
    on, lead = (F.col(c).cast("timestamp_ntz") for c in ("created_on", "created_on_lead"))
    return out.withColumn("created_us", micros(on)).withColumn("lead_us", micros(lead)).drop(
        "created_on", "created_on_lead"
    )


@probe("J02_personnel_profiles", f"""
    select cast(p.personnel_id as varchar) as personnel_id, p.personnel_type, p.email, p.name, p.phone,
           p.is_available::varchar as is_available, p.has_left::varchar as has_left, p.created_on, p.updated_on, p.is_test_account,
           p.additional_details, {CODE_SQL} as city,
           case when m.person_id is null then '' else m.r.alias_name end as alias_name,
           case when m.person_id is null then '' else m.r.facility_type end as facility_type,
           case when m.person_id is null then '' else m.r.mapping_type end as mapping_type,
           case when m.person_id is null then '' else m.r.availability_type end as availability_type,
           coalesce(q.permission_type, '') as permission_type
    from personnel p
    left join (select person_id, arg_min(struct_pack(alias_name := f.alias_name, facility_type := a.facility_type,
                 mapping_type := a.mapping_type, availability_type := a.availability_type), a.id) as r
               from person_facility_map a left join facility f on f.facility_id = a.facility_id group by person_id) m on m.person_id = p.personnel_id
    left join (select personnel_id, arg_min(permission_type, id) as permission_type from personnel_permission group by 1) q
           on q.personnel_id = p.personnel_id
    where p.city_id between 1 and 5""", "personnel person_facility_map facility personnel_permission")
def _(t: Tables):
    return staff.personnel_profiles(
        *t.views("personnel person_facility_map facility personnel_permission"), ROLES
    )[0]


@probe("J02_personnel_rejects", """
    select 'unknown code for city: ' || cast(city_id as varchar) as reject_reason, count(*) as rows
    from personnel where city_id not between 1 and 5 group by 1""", "personnel")
def _(t: Tables):
    views = t.views("personnel person_facility_map facility personnel_permission")
    return reject_counts(staff.personnel_profiles(*views, ROLES)[1])


@probe("J03_audit_increment", """
    select * from customer_audit where created_on >= timestamp '2024-01-13 18:30:00' and created_on < timestamp '2024-01-14 18:30:00'""",
       "customer_audit")
def _(t: Tables):
    return records.audit_increment(t.view("customer_audit"), EVENT_DAY)


@probe("J04_case_snapshot", "select * from insurance_case", "insurance_case")
def _(t: Tables):
    return records.snapshot(t.view("insurance_case"), schemas.INSURANCE_CASE)


@probe("J04_phase_snapshot", "select * from insurance_phase", "insurance_phase")
def _(t: Tables):
    return records.snapshot(t.view("insurance_phase"), schemas.INSURANCE_PHASE)


@probe("J04_lender_snapshot", """
    select *, cast(null as timestamp) as created_on, cast(null as timestamp) as updated_on from insurance_lender""", "insurance_lender")
def _(t: Tables):
    none = F.lit(None).cast("timestamp_ntz")
    rows = t.view("insurance_lender").withColumn("created_on", none).withColumn("updated_on", none)
    return records.snapshot(rows, schemas.INSURANCE_LENDER)


AUDIT_SQL = ", ".join(
    f"cast(p.{c} as varchar) as {c}" if c in ("email", "personnel_type", "is_manager")
    else f'cast(a."{c}" as varchar) as "{c}"' for c in schemas.SURGERY_AUDIT.fieldNames()
)


@probe("J05_surgery_audit", f"""
    select {AUDIT_SQL} from surgery_audit a left join personnel p on p.personnel_id = a.owner_id""", "surgery_audit personnel")
def _(t: Tables):
    return staff.surgery_audit(*t.views("surgery_audit personnel"))


@probe("J06_coverage_by_city", f"""
    with rows as ({GAP_ROWS}),
    firsts as (select alias_name, (list(struct_pack(c := city_name, m := mapping_type) order by facility_id, map_id nulls first))[1] as r from rows group by 1)
    select g.city_name, count(f.r) as uncovered from (select distinct city_name from rows) g
    left join (select * from firsts where r.m is null) f on f.r.c = g.city_name group by 1""", "branch branch_map city")
def _(t: Tables):
    return staff.coverage_by_city(*t.views("branch branch_map city"))


@probe("J06_uncovered_facilities", f"""
    with rows as ({GAP_ROWS}),
    firsts as (select alias_name, (list(struct_pack(c := city_name, z := zone, m := mapping_type) order by facility_id, map_id nulls first))[1] as r from rows group by 1)
    select r.c as city_name, alias_name as hospital_name, r.z as zone from firsts where r.m is null""", "branch branch_map city")
def _(t: Tables):
    return staff.uncovered_facilities(*t.views("branch branch_map city"))


@probe("J07_outcome_comments", """
    select comment_id, lead_id::varchar as lead_id, text, lead_type, "user", created_on::varchar as created_on, comment_type
    from lead_comment where lead_type = 'APPOINTMENT' and comment_type in ('APPOINTMENT_DONE', 'APPOINTMENT_CANCELLED', 'APPOINTMENT_DIRECT_DONE')
      and lead_id in (select id from appointment where status in (3, 4))""", "lead_comment appointment")
def _(t: Tables):
    return records.outcome_comments(*t.views("lead_comment appointment"))


CITY_SQL = "coalesce(case c.city_name when 'Chandigarh' then 'CHD' when 'Bangalore' then 'BLR' else c.city_name end, 'NA')"


@probe("J08_person_facilities", f"""
    select p.email, {CITY_SQL} as city, f.alias_name as hospital
    from personnel p join person_facility_map m on m.person_id = p.personnel_id join facility f on f.facility_id = m.facility_id
    left join city c on c.id = p.city_id
    where p.is_available = 1 and m.is_valid = 1 and m.tenant_name = 'MAIN' and p.personnel_type = 'FIELD_STAFF'
      and m.mapping_type = 'FIELD' and p.has_left = 0""", "personnel person_facility_map facility city")
def _(t: Tables):
    return staff.person_facilities(*t.views("personnel person_facility_map facility city"), ROLES)


@probe("J09_attendance_last_seen", f"""
    select p.email, epoch_us(a.login_time + interval '330 minutes') as login_us, coalesce(l.seen, '') as last_active_time,
           case when h.email is null then '' else h.alias_name end as hospital_name, {CITY_SQL} as city
    from attendance a join personnel p on p.personnel_id = a.personnel_id and p.personnel_type = 'FIELD_STAFF'
    left join city c on c.id = p.city_id
    left join (select email, strftime(max(created_on) + interval '330 minutes', '%b %d, %H:%M:%S') as seen
               from location_ping where date = date '2024-01-15' group by 1) l on l.email = p.email
    left join (select p.email, arg_min(f.alias_name, m.id) as alias_name from personnel p
               join person_facility_map m on m.person_id = p.personnel_id join facility f on f.facility_id = m.facility_id
               where m.is_valid = 1 and m.tenant_name = 'MAIN' and p.personnel_type = 'FIELD_STAFF' and m.mapping_type = 'FIELD' and p.has_left = 0
               group by 1) h on h.email = p.email
    where a.attendance_date = date '2024-01-15'""",
       "attendance location_ping personnel person_facility_map facility city")
def _(t: Tables):
    out = staff.attendance_with_last_seen(
        *t.views("attendance location_ping personnel person_facility_map facility city"), EVENT_DAY,
        roles=ROLES,
    )
    login = micros(F.col("login_time").cast("timestamp_ntz"))
    return out.withColumn("login_us", login).drop("login_time")


@probe("J10_recommended_tests", """
    select lead_id::varchar as lead_id, id::varchar as appointment_id, appointment_date::varchar as appointment_date, creation_type,
           consultation_type, json_extract_string(additional_details, '$.isDiagnosticsTestRecommended') as test_recommended, n.test_names
    from appointment left join (select appointment_id, string_agg(name, ',' order by name) as test_names
      from diagnostic_outcome o left join diagnostic d on d.id = o.test_id group by 1) n on n.appointment_id = appointment.id
    where consultation_type <> 'DIAGNOSTICS' and status = 3 and tenant_name = 'MAIN'""",
       "appointment diagnostic_outcome diagnostic")
def _(t: Tables):
    return records.recommended_tests(*t.views("appointment diagnostic_outcome diagnostic"))


# ---- commission ----------------------------------------------------------------------

COMMISSION_VIEWS = (
    "insurance_case insurance_vendor facility city patient customer_profile insurance_phase "
    "insurance_sub_phase insurance_lender"
)
J11_START = dt.datetime(1997, 10, 12)


def phase_sql(kind: str) -> str:
    return f"""(select insurance_case_id as case_id, max(phase_id) as phase_id, arg_max(additional_details, phase_id) as d
                from insurance_phase where upper(phase_type) = '{kind}' group by 1)"""


CURRENT_SQL = f"""
    with base as (
      select c.id as case_id, c.created_on + interval '330 minutes' as created, c.surgery_id, f.alias_name as hospital_name,
             v.vendor_name, u.name as patient_name, u.customer_number, u.email, ct.city_name, c.status, c.insurance_name,
             json_extract_string(c.additional_details, '$.tpaName') as tpa_name, c.treatment_type, c.surgery_name, c.speciality_name,
             json_extract_string(d.d, '$.surgeryDischargeApprovalInfo.nme') as collected_by_hospital,
             json_extract_string(s.d, '$.surgeryDischargeDoneRequest.dischargeDate') as discharge_date,
             try_cast(json_extract_string(s.d, '$.surgeryDischargeDoneRequest.admissionDate') as timestamp) as admission,
             try_cast(replace(json_extract_string(d.d, '$.surgeryDischargeApprovalInfo.totalBillAmount'), ',', '') as decimal(18,2)) as bill,
             try_cast(replace(json_extract_string(d.d, '$.surgeryDischargeApprovalInfo.finalApprovedAmount'), ',', '') as decimal(18,2)) as approved,
             l.lender_name, case when l.lender_name is null then 'None' when l.lender_name = 'Own PDC' then 'PDC-Own'
                                 when l.lender_name = 'Hospital PDC' then 'PDC Hospital' else '24HR' end as category
      from insurance_case c left join insurance_vendor v on v.vendor_id = c.vendor_id
      left join facility f on f.facility_id = c.facility_id left join city ct on ct.id = f.city_id
      left join patient p on p.id = c.patient_id left join customer_profile u on u.customer_id = p.customer_id
      left join {phase_sql('INSURANCE_DOCS_APPROVAL')} i on i.case_id = c.id
      left join {phase_sql('DISCHARGE_DOCS_APPROVAL')} d on d.case_id = c.id
      left join {phase_sql('MARKING_SURGERY_DONE')} s on s.case_id = c.id
      left join (select phase_id, try_cast(json_extract_string(arg_max(additional_details, sub_phase_id), '$.financeEligibilityInfo.lenderId') as bigint) as lender_id
                 from insurance_sub_phase where upper(sub_phase_type) = 'FINANCE_ELIGIBILITY_APPROVAL' group by 1) b on b.phase_id = i.phase_id
      left join insurance_lender l on l.lender_id = b.lender_id
      where c.created_on + interval '330 minutes' >= timestamp '1997-10-12'),
    rates as (select key, cast(replace(share_pct, '%', '') as decimal(18,6)) / 100 as share, cast(replace(net_share_pct, '%', '') as decimal(18,6)) / 100 as net,
                     lower(remarks) as basis, remarks, try_cast(start_date as timestamp) as s, try_cast(end_date as timestamp) as e from rate_agreement),
    priced as (select base.*, rates.*, case basis when 'on approved amount' then approved when 'on total bill amount' then bill end as amount
               from base left join rates on rates.key = hospital_name || 'Partner' || category
               where not coalesce(coalesce(admission, created) < s or coalesce(admission, created) > e, false))
    select created as case_created_on, year(created)::varchar || '-' || month(created)::varchar as case_created_month, email, 'Partner' as source,
           'Dashboard' as patient_source, status as case_status, discharge_date, insurance_name, tpa_name, treatment_type, surgery_name, speciality_name,
           collected_by_hospital, 0::double as other_collected, 0::double as discount, 0::double as withheld, null::varchar as tax, approved::double as chargeable_amount,
           case_id, surgery_id, hospital_name, vendor_name, patient_name, customer_number as contact_number, city_name as city, lender_name, category,
           admission as admission_date, bill::double as total_bill, approved::double as approved, share::double as share, net::double as net_share,
           round(amount * share, 4)::double as share_amount, round(amount * net, 4)::double as total_share,
           round(round(amount * net, 4) - round(amount * share, 4), 4)::double as tax_amount,
           round(approved - round(amount * net, 4), 4)::double as net_payable, remarks as chargeable_on,
           case when lender_name is null then 'lender_not_updated' when admission is null then 'admission_date_not_updated'
                when admission >= s and admission <= e then 'commission_calculated' end as statement_note
    from priced"""


@probe("J11_commission_statement", CURRENT_SQL, COMMISSION_VIEWS + " rate_agreement")
def _(t: Tables):
    cases = commission.open_cases(*t.views(COMMISSION_VIEWS), start=J11_START)
    return commission.statement(cases, t.view("rate_agreement"))


REJECTS_SQL = """
    select cast(c.id as varchar) as id, 'approved' as "column", 'n/a' as value, 'unreadable approved: n/a' as reject_reason
    from insurance_case c join (select insurance_case_id, arg_max(json_extract_string(additional_details, '$.surgeryDischargeApprovalInfo.finalApprovedAmount'), phase_id) as approved
                                from insurance_phase where upper(phase_type) = 'DISCHARGE_DOCS_APPROVAL' group by 1) d on d.insurance_case_id = c.id
    where approved = 'n/a' and c.created_on + interval '330 minutes' >= timestamp '1997-10-12'"""


@probe("J11_rejects", REJECTS_SQL, COMMISSION_VIEWS)
def _(t: Tables):
    return commission.case_rejects(commission.case_texts(*t.views(COMMISSION_VIEWS), start=J11_START))


SHEET = """
    select cast(l_orderkey as string) as case_id, case when l_linenumber = 1 then '1,23,456.50' else cast(cast(l_extendedprice as decimal(18,2)) as string) end as approved,
           cast(cast(l_extendedprice * 2 as decimal(18,2)) as string) as total_bill, cast(l_linenumber as string) as discount,
           '0' as other_collected, '10' as withheld, cast(cast(l_quantity as decimal(18,2)) as string) as share,
           cast(l_suppkey % 20 as string) || '.00%' as share_pct,
           case l_returnflag when 'A' then 'On Approved Amount' when 'R' then 'On Total Bill Amount' else 'None' end as remarks
    from {lineitem}"""


SHEET_LACKS = (
    "case_created_on case_created_month surgery_id hospital_name patient_name contact_number email city lender_name category source patient_source "
    "vendor_name case_status admission_date discharge_date insurance_name tpa_name treatment_type surgery_name speciality_name "
    "collected_by_hospital statement_note"
).split()
EARLIER_SQL = f"""
    with sheet as ({SHEET.format(lineitem='lineitem').replace('as string', 'as varchar')}),
    typed as (select case_id, remarks, try_cast(replace(approved, ',', '') as decimal(18,2)) as approved, try_cast(total_bill as decimal(18,2)) as bill,
                     try_cast(discount as decimal(18,2)) as discount, try_cast(share as decimal(18,2)) as share_amount,
                     cast(replace(share_pct, '.00%', '') as bigint) as pct from sheet),
    cents as (select *, cast(100 * case remarks when 'On Approved Amount' then approved when 'On Total Bill Amount' then bill end as bigint) as basis from typed),
    summed as (select *, cast((basis * pct * 118 + 50) // 100 as decimal(18,4)) / 10000 as total_d from cents),
    fixed as (select *, cast(total_d as decimal(18,4)) as total from summed)
    select case_id, approved::double as approved, total::double as total_share, (total - share_amount)::double as tax_amount,
           (approved - total - 10 + discount + 0)::double as net_payable, '18.00%' as tax, remarks as chargeable_on from fixed"""


@probe("J11_earlier_statement", EARLIER_SQL)
def _(t: Tables):
    sheet = t.spark.sql(SHEET, lineitem=t.lineitem)
    return commission.earlier_statement(sheet, empty=SHEET_LACKS).select(
        "case_id", "approved", "total_share", "tax_amount", "net_payable", "tax", "chargeable_on"
    )


@probe("J11_full_statement", f"""
    select cast(case_id as varchar) as case_id, approved, total_share, net_payable, chargeable_on from ({CURRENT_SQL})
    union all select case_id, approved, total_share, net_payable, chargeable_on from ({EARLIER_SQL})""", COMMISSION_VIEWS + " rate_agreement")
def _(t: Tables):
    cases = commission.open_cases(*t.views(COMMISSION_VIEWS), start=J11_START)
    current = commission.statement(cases, t.view("rate_agreement"))
    earlier = commission.earlier_statement(t.spark.sql(SHEET, lineitem=t.lineitem), empty=SHEET_LACKS)
    return commission.full_statement(current, earlier).select(
        "case_id", "approved", "total_share", "net_payable", "chargeable_on"
    )


# ---- calls ---------------------------------------------------------------------------

CALL_VIEWS = "call call_document patient_case patient customer_profile city personnel"
LEG_NUMBER = "nullif(right(regexp_replace(d.p->>'$.leg{0}AgentNumber', '\\D', '', 'g'), 10), '')"
CITY_OF = "coalesce(case {0} when 'Chandigarh' then 'CHD' when 'Bangalore' then 'BLR' else {0} end, 'No City')"
CALLS_SQL = f"""
    lists as ({LIST_SQL}), details as ({DETAIL_SQL}),
    cities as (select no, coalesce(arg_max(city, case_id) filter (city <> 'No City'), 'No City') as city from (
        select {PHONE_SQL.format('u.customer_number')} as no, k.case_id, {CITY_OF.format('coalesce(c.city_name, h.city_name)')} as city
        from patient_case k join patient p on p.id = k.patient_id join customer_profile u on u.customer_id = p.customer_id
        left join city c on c.id = k.city_id left join city h on h.id = p.city_id) where no is not null group by no),
    people as (select {PHONE_SQL.format('phone')} as agent_no, p.personnel_id as id, p.email, {CITY_OF.format('c.city_name')} as city, p.personnel_type as staff_group
               from personnel p left join city c on c.id = p.city_id where phone <> '' and p.personnel_type in ('FIELD_STAFF', 'CUSTOMER_SUPPORT')),
    raw as (select k.*, d.p, {PHONE_SQL.format('k.from_no')} as customer_no, l.call_sid is not null as listed, l.no_sent, l.requested, l.personnel_type,
                   l.agent_in_system, l.agent_available,
                   {', '.join(LEG_NUMBER.format(n) + f' as n{n}' for n in (1, 2, 3))},
                   {base_status_sql(*(f"(d.p->>'$.leg{n}DetailedStatus')" for n in (1, 2, 3)), 'k.leg_1_status', 'k.leg_2_status')} as base
            from call k left join lists l on l.call_sid = k.sid left join details d on d.call_sid = k.sid where k.direction = 'inbound')"""


def _call_parts(t: Tables):
    call, docs, cases, patient, customer, city, people = t.views(CALL_VIEWS)
    people = people.withColumnRenamed("personnel_id", "id")
    groups = {
        group: calls.agents_by_number(people.where(F.col("personnel_type") == group), city, group, ROLES)
        for group in (v.ROLES.support, v.ROLES.field_staff)
    }
    return call, docs, calls.caller_cities(cases, patient, customer, city, call, ROLES), groups


@probe("J12_call_detail", f"""
    with {CALLS_SQL}, agents as (select staff_group, agent_no, arg_min(email, id) as email, arg_min(city, id) as city from people group by 1, 2)
    select sid, call_created_on, status, direction, to_no, from_no, exotel_no, price::varchar as price, leg_1_status, leg_2_status,
           coalesce(leg_2_duration, 0)::varchar as leg_2_duration, recording_url, month(call_created_on)::varchar as month, year(call_created_on)::varchar as year,
           '' as menu_check, '' as menu_transfer_status, case when listed then agent_available else '' end as agent_available,
           coalesce(upper(p->>'$.leg3DetailedStatus'), '') as leg3_detailed_status, coalesce(p->>'$.leg1Status', '') as leg1_status,
           coalesce(p->>'$.leg3Status', '') as leg3_status, coalesce(a2.city, '') as leg2_agent_city,
           coalesce(duration, 0)::varchar as duration, coalesce(leg_1_duration, 0)::varchar as leg_1_duration,
           cast(call_created_on as date) as mask_date, cast(hour(call_created_on) as varchar) as hour,
           case when hour(call_created_on) between 8 and 20 then 'OFFICE_HOUR' else 'OFF_HOUR' end as hour_tag, customer_no,
           coalesce(cities.city, 'No City') as city, no_sent::varchar as no_sent, requested::varchar as requested,
           case when listed then personnel_type else 'NA' end as personnel_type, coalesce(agent_in_system, '') as agent_in_system,
           coalesce(upper(p->>'$.leg1DetailedStatus'), 'NO_CALL_INSIGHT') as leg1_detailed_status,
           coalesce(upper(p->>'$.leg2DetailedStatus'), '') as leg2_detailed_status, {STATUS_SQL.replace('sent', 'no_sent')} as final_status,
           coalesce(n1, '') as leg1_agent_number, coalesce(n2, '') as leg2_agent_number, coalesce(n3, '') as leg3_agent_number,
           coalesce(p->>'$.leg2Status', '') as leg2_status,
           coalesce(a1.email, '') as leg1_agent_email, coalesce(a2.email, '') as leg2_agent_email, coalesce(a3.email, '') as leg3_agent_email,
           coalesce(a1.city, '') as leg1_agent_city, coalesce(a3.city, '') as leg3_agent_city
    from (select *, case when listed and personnel_type = 'FIELD_STAFF' then 'FIELD_STAFF' else 'CUSTOMER_SUPPORT' end as grp from raw) raw
    left join cities on cities.no = customer_no
    left join agents a1 on a1.agent_no = n1 and a1.staff_group = grp left join agents a2 on a2.agent_no = n2 and a2.staff_group = grp
    left join agents a3 on a3.agent_no = n3 and a3.staff_group = grp""", CALL_VIEWS)
def _(t: Tables):
    call, docs, cities, groups = _call_parts(t)
    agents = groups[v.ROLES.support].unionByName(groups[v.ROLES.field_staff])
    detail = calls.call_detail(call, docs, cities, agents, route=calls.staff_route())
    return calls.published_calls(detail)


@probe("J13_failed_calls", f"""
    with {CALLS_SQL}, agents as (
      select agent_no, (list(email order by case staff_group when 'CUSTOMER_SUPPORT' then 0 else 1 end, id))[1] as email from people group by 1)
    select sid, call_created_on, {STATUS_SQL.replace('sent', 'no_sent')} as final_status, coalesce(email, '') as notify
    from raw left join agents on agent_no = n1
    where call_created_on > timestamp '2024-01-15 06:00:00' and call_created_on <= timestamp '2024-01-15 12:00:00'
      and base in ('FAILED_SUBSCRIBER_UNAVAILABLE', 'FAILED_OPERATOR_ERROR', 'FAILED_UNKNOWN_ERROR') order by call_created_on desc, sid""", CALL_VIEWS)
def _(t: Tables):
    call, docs, cities, groups = _call_parts(t)
    agents = calls.agents_by_priority(groups[v.ROLES.support], groups[v.ROLES.field_staff])
    detail = calls.call_detail(call, docs, cities, agents)
    return calls.failed_calls(detail, dt.datetime(2024, 1, 15, 12), minutes=360)


# ---- cashback ------------------------------------------------------------------------

LEDGER_VIEWS = (
    "cash_ledger customer_profile appointment card_payment card payment_link patient_case personnel cashback_type"
)
TAGGED_SQL = f"""
    staff as (select email from personnel where personnel_type = 'FIELD_STAFF'),
    tagged as (
      select g.id, g.customer_id, g.cashback_type, g.amount / 100 as amount, g.issued_entity_type, g.transaction_type,
             g.created_on + interval '330 minutes' as created_on, cast(g.created_on + interval '330 minutes' as date) as day,
             {PHONE_SQL.format('u.customer_number')} as phone,
             case when g.transaction_type = 'DEBITED' then ''
                  when g.issued_entity_type in ('PATIENT_SURGERY', 'DIAGNOSTICS_APPOINTMENT') then 'FIELD_STAFF'
                  when g.issued_entity_type = 'APPOINTMENT' then
                    case when a.id is null then 'NA' when k.case_id is not null then 'CUSTOMER_APP'
                         when a.user_email in (select email from staff) then 'FIELD_STAFF' else 'CS_AGENT' end
                  when c.card_id is not null then case when c.collected_by in (select email from staff) then 'FIELD_STAFF' else 'CS_AGENT' end
                  else 'NA' end as tag,
             case when g.transaction_type = 'CREDITED' or g.issued_entity_type = 'PATIENT_SURGERY' then 'NA'
                  when g.issued_entity_type in ('APPOINTMENT', 'DIAGNOSTICS_APPOINTMENT') then
                    case when a.consultation_fee = coalesce(l.paid, 0) then 'Full_Payment' else 'Partial_Payment' end
                  when g.issued_entity_type = 'LOYALTY_CARD' then case when c.status = 'ACTIVE' then 'Full_Payment' else 'Partial_Payment' end
                  else 'Partial_Payment' end as payment_tag,
             case when g.transaction_type = 'DEBITED' and g.issued_entity_type in ('APPOINTMENT', 'DIAGNOSTICS_APPOINTMENT') and a.id is not null
                  then a.creation_type else '' end as creation_type,
             case when y.cashback_id is null then '' else y.cashback_type end as cashback_label
      from cash_ledger g join customer_profile u on u.customer_id = g.customer_id
      left join appointment a on a.id = g.issued_entity_id
      left join (select * from patient_case where lead_source = 'Customer App') k on k.case_id = a.lead_id
      left join (select entity_id, cast(sum(amount) as decimal(18,2)) / 100 as paid from payment_link where entity_type = 'APPOINTMENT' and status = 'PAID' group by 1) l
             on l.entity_id = g.issued_entity_id
      left join (select p.card_id, p.collected_by, c.status from card_payment p join card c on c.card_id = p.card_id) c on c.card_id = g.issued_entity_id
      left join (select * from cashback_type where is_active = 1) y on y.cashback_id = g.cashback_type
      where cast(g.created_on + interval '330 minutes' as date) between date '2000-05-01' and date '2000-06-14')"""


def tagged(t: Tables):
    ledger, customers, appts, card_payments, cards, links, cases, people, types = t.views(LEDGER_VIEWS)
    return cashback.tagged_ledger(
        ledger, customers, appts.withColumnRenamed("user_email", "user"), card_payments, cards, links,
        cases.where(F.col("lead_source") == v.CUSTOMER_APP_SOURCE),
        people.where(F.col("personnel_type") == v.ROLES.field_staff), types, AS_OF,
    )


@probe("J14_tagged_ledger", f"""
    with {TAGGED_SQL} select id, amount::double as amount, created_on, phone, tag, payment_tag, creation_type, cashback_label from tagged""", LEDGER_VIEWS)
def _(t: Tables):
    return tagged(t).select(
        "id", "amount", "created_on", "phone", "tag", "payment_tag", "creation_type", "cashback_label"
    )


COUNTED_SQL = f"""
    (select *, case when transaction_type = 'CREDITED' then 'Given' else 'Used' end as direction, {BUCKET_SQL} as bucket from tagged
     where transaction_type = 'CREDITED' or payment_tag <> 'Partial_Payment')"""


@probe("J14_ledger_summary", f"""
    with {TAGGED_SQL} select direction, coalesce(bucket, 'ALL') as bucket, {PERIOD_SUMS} from {COUNTED_SQL}
    group by grouping sets ((direction, bucket), (direction))""", LEDGER_VIEWS)
def _(t: Tables):
    return cashback.ledger_summary(tagged(t), AS_OF)


@probe("J14_ledger_by_tag", f"""
    with {TAGGED_SQL} select tag, bucket, {PERIOD_SUMS} from {COUNTED_SQL}
    where direction = 'Given' and bucket not in ('PROMOTIONAL', 'OTHER') group by tag, bucket""", LEDGER_VIEWS)
def _(t: Tables):
    return cashback.ledger_by_tag(tagged(t), AS_OF)


def facts(t: Tables):
    """Ledger of the report range with the facts its tags are made from, before any tag."""
    ledger, customers, appts, card_payments, cards, links, cases, people, _types = t.views(LEDGER_VIEWS)
    rows = (
        ledger.where(Periods(AS_OF).covers(F.col("created_on")))
        .join(customers.select("customer_id"), "customer_id", "left_semi")
        .withColumn("issued_entity_id", F.col("issued_entity_id").cast("string"))
    )
    staff_emails = people.where(F.col("personnel_type") == v.ROLES.field_staff).select("email")
    visits = visit_facts(
        rows, appts.withColumnRenamed("user_email", "user"), links,
        cases.where(F.col("lead_source") == v.CUSTOMER_APP_SOURCE), staff_emails,
    )
    active = cards.where(F.col("status") == v.ACTIVE)
    return rows, visits, card_facts(rows, card_payments, active, staff_emails)


@probe("C25_credit_tags", f"""
    with {TAGGED_SQL} select id, tag from tagged""", LEDGER_VIEWS)
def _(t: Tables):
    return tag_ledger(*facts(t)).select("id", "tag")


@probe("C26_payment_tags", f"""
    with {TAGGED_SQL} select id, payment_tag, creation_type from tagged""", LEDGER_VIEWS)
def _(t: Tables):
    return tag_ledger(*facts(t)).select("id", "payment_tag", "creation_type")


CAMPAIGN_VIEWS = LEDGER_VIEWS + (
    " message_log message_tag asset patient one_time_message chat_message ledger_call"
)
IN_RANGE = "cast({0} + interval '330 minutes' as date) between date '2000-05-01' and date '2000-06-14'"
MESSAGES_SQL = f"""
    sms as (select g.id, g.asset_id, tg.tag_id, pp.id as patient_id, pp.customer_id, {PHONE_SQL.format('u.customer_number')} as phone,
                   g.communication_date + interval '330 minutes' as sent_on, json_extract_string(tg.additional_details, '$.cashNudgingFlow') as flow
            from message_log g join asset on asset.id = g.asset_id join message_tag tg on tg.id = g.entity_tag_map_id
            left join patient pp on pp.id = tg.entity_id and tg.entity_type = 'PATIENT_PROFILE'
            left join customer_profile u on u.customer_id = pp.customer_id
            where g.communication_done = 1 and g.communication_type = 'SMS' and {IN_RANGE.format('g.communication_date')}),
    messages as (
      select 'nudge' as campaign, id, phone, patient_id::varchar as customer, sent_on,
             case when flow in ('APP_DONE', 'APP_CONFIRM_CANCEL', 'APP_CANCEL') then 'after_visit' else 'support' end as split from sms where tag_id = 275
      union all select 'promo_credit', id, phone, customer_id::varchar, created_on, 'all' from tagged where transaction_type = 'CREDITED' and cashback_type = 6
      union all select 'one_time', id, {PHONE_SQL.format('patient_number')}, {PHONE_SQL.format('patient_number')}, scheduled_on + interval '330 minutes',
             json_extract_string(additional_details, '$.promotionalCashAmount') from one_time_message
             where communication_type = 'SMS' and status = 'SUCCESS' and json_extract_string(additional_details, '$.cashPromoDone') = 'true' and {IN_RANGE.format('scheduled_on')}
      union all select case when asset_id in (255, 256) then 'home_pick' else 'diagnostics_test' end, id, phone, customer_id::varchar, sent_on, 'all'
             from sms where asset_id in (251, 252, 253, 254, 255, 256, 258)),
    happenings as (
      select phone as k, epoch_us(sent_on) as us, id, campaign, 'm' as kind, null as extra from messages
      union all select {PHONE_SQL.format('to_message')}, epoch_us(created_on + interval '330 minutes'), id, null, 'r', 'WhatsApp' from chat_message
             where from_id = to_message and {IN_RANGE.format('created_on')}
      union all select {PHONE_SQL.format('from_no')}, epoch_us(call_created_on), id, null, 'r', 'Call' from ledger_call
             where direction = 'inbound' and cast(call_created_on as date) between date '2000-05-01' and date '2000-06-14'
      union all select phone, epoch_us(created_on), id, null, 's', issued_entity_type || '/' || creation_type from tagged
             where transaction_type = 'DEBITED' and payment_tag <> 'Partial_Payment'),
    feed as (select * from happenings where k is not null)"""
ATTRIBUTION = attribution_sql(list(cashback.CAMPAIGNS))
RESULT_SQL = f"""
    {MESSAGES_SQL}, hits as ({ATTRIBUTION}),
    result as (select m.*, cast(m.sent_on as date) as day, coalesce(h.responded, false) as responded, h.response_id,
                      coalesce(h.used, false) as used, h.spend_id, r.extra as channel, s.issued_entity_type as used_on, s.creation_type
               from messages m left join hits h on h.id = m.id and h.campaign = m.campaign
               left join (select id, extra from happenings where kind = 'r') r on r.id = h.response_id
               left join tagged s on s.id = h.spend_id)"""


def attributed(t: Tables):
    ledger = stored(tagged(t), "ledger")
    names = "message_log message_tag asset patient customer_profile one_time_message"
    messages = cashback.campaign_messages(*t.views(names), ledger, AS_OF, roles=ROLES)
    feed = cashback.replies(*t.views("chat_message ledger_call"), AS_OF)
    return cashback.attributed_messages(messages, feed, cashback.spends(ledger))


@probe("J15_campaign_attribution", f"""
    with {TAGGED_SQL}, {RESULT_SQL}
    select campaign, id, phone, sent_on, responded, response_id, channel, used, spend_id, used_on, creation_type from result""", CAMPAIGN_VIEWS)
def _(t: Tables):
    return attributed(t).select(
        "campaign", "id", "phone", "sent_on", "responded", "response_id", "channel", "used", "spend_id", "used_on", "creation_type"
    )


@probe("J16_campaign_funnels", f"""
    with {TAGGED_SQL}, {RESULT_SQL}, known as (select *, struct_pack(c := campaign, s := split) as cell from result
           where campaign <> 'one_time' or split in ('100', '300', '500', '1000'))
    select cell.c as campaign, cell.s as split, * exclude (cell) from ({funnel_sql('select * from known', 'cell', '(campaign, customer)', True)})
    where not (cell.c = 'one_time' and period = 'yesterday')""", CAMPAIGN_VIEWS)
def _(t: Tables):
    return cashback.campaign_funnels(attributed(t), AS_OF, ROLES)[0]


@probe("J16_unknown_tiers", f"""
    with {TAGGED_SQL}, {RESULT_SQL} select 'unknown amount tier: ' || split as reject_reason, count(*) as rows
    from result where campaign = 'one_time' and split not in ('100', '300', '500', '1000') group by 1""", CAMPAIGN_VIEWS)
def _(t: Tables):
    return reject_counts(cashback.campaign_funnels(attributed(t), AS_OF, ROLES)[1])


@probe("J16_campaign_uses", f"""
    with {TAGGED_SQL}, {RESULT_SQL},
    kinds as (select campaign, day, case when used_on = 'APPOINTMENT' then case when creation_type = 'FOLLOWUP_APPOINTMENT' then 'Appointment (FollowUp)' else 'Appointment (New)' end
                     when used_on = 'DIAGNOSTICS_APPOINTMENT' then 'Diagnostics Appointment' when used_on = 'LOYALTY_CARD' then 'Loyalty Card'
                     when used_on = 'PATIENT_SURGERY' then 'Surgery' else 'Other' end as use_kind
              from result where used and campaign in ('nudge', 'promo_credit', 'one_time'))
    select campaign, coalesce(use_kind, 'Grand Total') as use_kind, count(*) filter (day = date '2000-06-14') as yesterday,
           count(*) filter (day between date '2000-06-01' and date '2000-06-14') as month_to_date,
           count(*) filter (day between date '2000-05-01' and date '2000-05-31') as last_month
    from kinds group by grouping sets ((campaign, use_kind), (campaign))""", CAMPAIGN_VIEWS)
def _(t: Tables):
    return cashback.campaign_uses(attributed(t), AS_OF)


@probe("J17_transactions_per_user", per_user_sql(
    "cast(year(created_on) as int) as year, cast(month(created_on) as int) as month", "year, month"), "transaction")
def _(t: Tables):
    return cashback.transactions_per_user(t.view("transaction"))
