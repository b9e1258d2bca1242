"""Bindings of the logical input tables to the driver's tables.

Plain SQL that Spark and DuckDB both read; ``{orders}`` is a table reference.
"""

EMAIL = "'User' || cast({0} as string) || '@example.org'"
PHONE = "'+91-9' || cast(100000000 + {0} as string)"


def _email(col: str) -> str:
    return EMAIL.format(col)


def _phone(col: str) -> str:
    return PHONE.format(col)


# An order date is at midnight; spread over the day, and past local midnight.
SPREAD = """(case o_orderkey % 5 when 0 then o_orderdate when 1 then o_orderdate + interval '2' hour
    when 2 then o_orderdate + interval '9' hour when 3 then o_orderdate + interval '17' hour
    else o_orderdate + interval '20' hour end)"""

VIEWS: dict[str, str] = {
    # ---- people, places -----------------------------------------------------------
    "personnel": f"""
        select c_custkey as personnel_id,
               case c_mktsegment when 'FURNITURE' then 'FIELD_STAFF'
                                 when 'HOUSEHOLD' then 'CUSTOMER_SUPPORT'
                                 when 'MACHINERY' then 'CENTRAL_INSURANCE_TEAM'
                                 else 'OTHER' end as personnel_type,
               {_email('c_custkey')} as email,
               c_name as name,
               case when c_custkey % 11 = 0 then '' else {_phone('c_custkey')} end as phone,
               cast(case when c_acctbal > 0 then 1 else 0 end as int) as is_available,
               cast(case when c_custkey % 7 = 6 then 1 else 0 end as int) as has_left,
               cast(case when c_custkey % 9 = 0 then 1 else 0 end as string) as is_manager,
               cast(c_nationkey as bigint) as city_id,
               cast(null as string) as created_on,
               cast(null as string) as updated_on,
               '0' as is_test_account,
               c_mktsegment as additional_details
        from {{customer}}""",
    "personnel_permission": """
        select event_id as id, user_id as personnel_id, event_type as permission_type from {events}""",
    "facility": """
        select s_suppkey as facility_id, s_name as alias_name,
               case when s_suppkey % 8 = 0 then 'INS' when s_suppkey % 13 = 0 then null else 'NORTH' end as zone,
               cast(s_nationkey as bigint) as city_id,
               cast(case when s_acctbal > 500 then 1 else 0 end as int) as active
        from {supplier}""",
    "branch": """
        select c_custkey as facility_id,
               'Branch ' || cast(c_custkey % 1000 as string) as alias_name,
               case when c_mktsegment = 'MACHINERY' then 'INS' else c_mktsegment end as zone,
               cast(c_nationkey as bigint) as city_id,
               cast(case when c_custkey % 10 = 0 then 0 else 1 end as int) as active
        from {customer}""",
    "branch_map": """
        select o_orderkey as id, o_custkey as person_id, o_custkey as facility_id,
               case o_orderpriority when '1-URGENT' then 'TICKET_AM' else 'FIELD' end as mapping_type,
               cast(case when o_orderstatus = 'O' then 1 else 0 end as int) as is_valid,
               case when o_orderkey % 5 = 0 then 'OTHER' else 'MAIN' end as tenant_name
        from {orders}""",
    "person_facility_map": """
        select l.id, l.person_id, l.facility_id, l.facility_type, l.mapping_type,
               l.availability_type, l.is_valid, l.tenant_name
        from (select o_orderkey as id, o_custkey as person_id, o_orderkey % 120 as facility_id,
                     o_orderpriority as facility_type,
                     case when o_orderstatus = 'P' then 'TICKET_AM' else 'FIELD' end as mapping_type,
                     case when o_orderkey % 17 = 0 then null else o_orderstatus end as availability_type,
                     cast(case when o_orderkey % 3 = 0 then 0 else 1 end as int) as is_valid,
                     case when o_orderkey % 5 = 0 then 'OTHER' else 'MAIN' end as tenant_name
              from {orders}) l""",
    "city": """
        select cast(n_nationkey as bigint) as id,
               case n_nationkey when 1 then 'Chandigarh' when 2 then 'Bangalore' else n_name end as city_name
        from {nation}""",
    "agent_activity": """
        select event_id as id, user_id as personnel_id, ts as created_on,
               '{{' || case when event_type = 'error' then ''
                          else '"newAvailabilityValue":"' || case when event_type in ('view', 'click') then 'true' else 'false' end || '",' end
                    || '"perviousAvailabilityValue":"' || case when event_id % 2 = 0 then 'true' else 'false' end || '",'
                    || '"reason":' || case when event_type = 'signup' then '"Going for a meeting"'
                                           when event_id % 3 = 0 then 'null' else '"Shift"' end || '}}' as activity
        from {events}""",
    "attendance": """
        select event_id as id, user_id as personnel_id, ts as login_time, cast(ts as date) as attendance_date
        from {events} where event_type = 'signup'""",
    "location_ping": f"""
        select event_id as id, {_email('user_id')} as email, ts as created_on, cast(ts as date) as date
        from {{events}} where event_type <> 'signup'""",
    # ---- records --------------------------------------------------------------------
    "customer_audit": f"""
        select cast(event_id % 3 as string) as rev_type, cast(event_id as string) as rev,
               user_id as customer_id, 'Name ' || cast(user_id as string) as name,
               {_email('user_id')} as email, event_type as gender,
               cast(null as string) as date_of_birth, {_phone('user_id')} as number,
               cast(null as string) as secondary_number, '0' as secondary_on_chat,
               cast(null as string) as referral_code, cast(null as string) as app_token,
               'MAIN' as tenant_name, 'en' as language, event_type as lead_source,
               cast(null as string) as location, props as additional_details,
               ts as created_on, ts as updated_on, 'NEW' as customer_type
        from {{events}}""",
    "lead_comment": """
        select cast(l_orderkey as string) || '-' || cast(l_linenumber as string) as comment_id,
               l_orderkey as lead_id, l_returnflag as text,
               case when l_linestatus = 'O' then 'APPOINTMENT' else 'CASE' end as lead_type,
               cast(l_suppkey as string) as user, cast(l_shipdate as date) as created_on,
               case l_returnflag when 'A' then 'APPOINTMENT_DONE' when 'R' then 'APPOINTMENT_CANCELLED'
                                 else 'NOTE' end as comment_type
        from {lineitem}""",
    "appointment": f"""
        select o_orderkey as id, o_custkey as lead_id, {_email('o_custkey')} as user_email,
               cast(case o_orderstatus when 'F' then 3 when 'O' then 4 else 1 end as int) as status,
               case when o_orderpriority = '5-LOW' then 'DIAGNOSTICS' else 'OPD' end as consultation_type,
               case when o_orderkey % 3 = 0 then 'FOLLOWUP_APPOINTMENT' else 'NEW_APPOINTMENT' end as creation_type,
               cast(o_totalprice as decimal(18,2)) as consultation_fee,
               cast(o_orderdate as date) as appointment_date,
               case when o_orderkey % 4 = 0 then 'OTHER' else 'MAIN' end as tenant_name,
               case when o_orderkey % 2 = 0 then '{{{{"isDiagnosticsTestRecommended":"true"}}}}' else '{{{{}}}}' end as additional_details
        from {{orders}}""",
    "diagnostic_outcome": "select l_orderkey as appointment_id, l_partkey as test_id from {lineitem}",
    "diagnostic": "select p_partkey as id, case when p_size = 7 then null else p_brand end as name from {part}",
    "surgery_audit": """
        select l_orderkey as case_id, cast(l_shipdate as date) as created_on, l_returnflag as user,
               'MAIN' as tenant_name, l_linestatus as treatment_type,
               cast(l_shipdate as date) as admission_date, cast(null as date) as discharge_date,
               l_partkey as doctor_id, l_suppkey as hospital_id, l_partkey % 200 as owner_id,
               cast(null as string) as package_type, l_linestatus as surgery_status,
               cast(null as date) as follow_up_date, l_linenumber as surgery_id,
               l_returnflag as treatment_name, cast(l_extendedprice as decimal(18,2)) as promised_price,
               cast(l_discount as decimal(18,2)) as discount, cast(l_quantity as decimal(18,2)) as price,
               cast(null as string) as lead_uniqueness_status, cast(null as string) as additional_details
        from {lineitem}""",
    # ---- commission -----------------------------------------------------------------
    "insurance_case": """
        select o_orderkey as id, o_custkey as patient_id, o_orderkey % 120 as facility_id,
               o_orderkey % 30 as vendor_id, o_orderstatus as status, cast(null as string) as comments,
               o_custkey as personnel_id, o_orderpriority as treatment_type, o_orderkey % 500 as surgery_id,
               'Surgery ' || cast(o_orderkey % 40 as string) as surgery_name, 'General' as speciality_name,
               'Insurer ' || cast(o_orderkey % 6 as string) as insurance_name,
               '{{"tpaName":"TPA ' || cast(o_orderkey % 4 as string) || '"}}' as additional_details,
               o_orderdate as created_on, o_orderdate as updated_on, cast(null as string) as assigned_to,
               cast(null as string) as pending_phase_type
        from {orders}""",
    "insurance_phase": """
        select event_id as phase_id, user_id * 7 + event_id % 7 as insurance_case_id,
               case when event_type in ('view', 'purchase') then 'Insurance_Docs_Approval'
                    when event_type in ('click', 'error') then 'DISCHARGE_DOCS_APPROVAL'
                    else 'MARKING_SURGERY_DONE' end as phase_type,
               event_type as status, cast(null as string) as reason, user_id as assigned_to,
               '{{"surgeryDischargeApprovalInfo":{{"nme":"' || cast(event_id % 90 as string)
                 || '","totalBillAmount":"' || cast(event_id % 7 + 1 as string) || ',' || cast(event_id % 900 + 100 as string)
                 || '.50","finalApprovedAmount":"' || case when event_id % 19 = 0 then 'n/a' else cast(event_id % 800 + 100 as string) end
                 || '"}},"surgeryDischargeDoneRequest":{{"admissionDate":"' || case when event_id % 6 = 0 then '' else cast(cast(ts as date) as string) end
                 || '","dischargeDate":"2024-02-01"}}}}' as additional_details,
               ts as created_on, ts as updated_on
        from {events}""",
    "insurance_sub_phase": """
        select event_id as sub_phase_id, event_id - event_id % 2 as phase_id,
               case when event_type = 'signup' then 'OTHER_SUB_PHASE' else 'Finance_Eligibility_Approval' end as sub_phase_type,
               case when event_id % 23 = 0 then '{{}}'
                    else '{{"financeEligibilityInfo":{{"lenderId":"' || cast(event_id % 27 as string) || '"}}}}' end as additional_details
        from {events}""",
    "insurance_lender": """
        select cast(n_nationkey as bigint) as lender_id,
               case n_nationkey when 3 then 'Own PDC' when 4 then 'Hospital PDC' else 'Lender ' || n_name end as lender_name,
               cast(null as string) as additional_details
        from {nation}""",
    "insurance_vendor": """
        select cast(n_nationkey as bigint) as vendor_id, 'Vendor ' || n_name as vendor_name from {nation}""",
    "rate_agreement": """
        select s_name || 'Partner' || '24HR' as key, cast(s_suppkey % 20 + 5 as string) || '.50%' as share_pct,
               cast(s_suppkey % 20 + 7 as string) || '.00%' as net_share_pct,
               case when s_suppkey % 2 = 0 then 'On Approved amount' else 'On Total Bill Amount' end as remarks,
               '2024-01-05' as start_date, case when s_suppkey % 5 = 0 then '' else '2024-01-20' end as end_date
        from {supplier}
        union all
        select s_name || 'Partner' || '24HR' as key, '9%' as share_pct, '10.62%' as net_share_pct,
               'ON APPROVED AMOUNT' as remarks, '2024-01-21' as start_date, '2024-12-31' as end_date
        from {supplier} where s_acctbal > 6000
        union all
        select s_name || 'Partner' || 'PDC-Own' as key, '4%' as share_pct, '4.72%' as net_share_pct,
               'On Total Bill Amount' as remarks, '1990-01-01' as start_date, '2024-12-31' as end_date
        from {supplier}
        union all
        select s_name || 'Partner' || 'None' as key, '1%' as share_pct, '1.18%' as net_share_pct,
               'Other' as remarks, '1990-01-01' as start_date, '2000-12-31' as end_date
        from {supplier}""",
    "patient": """
        select c_custkey as id, c_custkey - c_custkey % 3 as customer_id,
               case when c_custkey % 5 = 0 then null else cast((c_nationkey + 1) % 30 as bigint) end as city_id
        from {customer}""",
    "customer_profile": f"""
        select c_custkey as customer_id, c_name as name, {_email('c_custkey')} as email,
               case when c_custkey % 30 = 0 then '' else {_phone('c_custkey % 60')} end as customer_number
        from {{customer}}""",
    "patient_case": """
        select c_custkey as case_id, c_custkey as patient_id,
               case when c_custkey % 2 = 0 then null else cast(c_nationkey as bigint) end as city_id,
               case when c_custkey % 4 = 0 then 'Customer App' else 'Web' end as lead_source
        from {customer}""",
    # ---- calls ----------------------------------------------------------------------
    "call": f"""
        select event_id as id, 'c' || cast(event_id as string) as sid, ts as call_created_on, event_type as status,
               case when event_type = 'view' then 'outbound' else 'inbound' end as direction,
               {_phone('event_id % 300')} as to_no, {_phone('user_id')} as from_no, '080-1234' as exotel_no,
               case when event_id % 10 = 0 then null else cast(event_id % 600 as bigint) end as duration,
               cast(value as decimal(18,2)) as price,
               case when event_id % 4 = 0 then 'completed' when event_id % 4 = 1 then 'busy'
                    when event_id % 4 = 2 then '' else null end as leg_1_status,
               case when event_id % 9 = 0 then null else cast(event_id % 60 as bigint) end as leg_1_duration,
               case when event_id % 5 = 0 then 'completed' when event_id % 5 = 1 then 'canceled'
                    when event_id % 5 = 2 then 'busy' when event_id % 5 = 3 then '' else null end as leg_2_status,
               cast(event_id % 45 as bigint) as leg_2_duration, cast(null as string) as recording_url
        from {{events}}""",
    "call_document": f"""
        select event_id * 3 as id, 'c' || cast(event_id as string) as call_sid, ts as created_on,
               'INBOUND_PATIENT_CALL_LIST' as insight_type,
               case when event_id % 7 = 0 then '{{{{"other":1}}}}'
                    when event_id % 7 = 1 then '{{{{"insightData":{{{{"agents":[]}}}}}}}}'
                    when event_id % 7 = 2 then '{{{{"insightData":{{{{"agents":["a","b"],"personnelType":"FIELD_STAFF"}}}}}}}}'
                    when event_id % 7 = 3 then '{{{{"insightData":{{{{"personnelType":"CUSTOMER_SUPPORT","agentInSystem":"yes"}}}}}}}}'
                    when event_id % 7 = 4 then '{{{{"insightData":{{{{"agents":["a"],"agentAvailable":"no"}}}}}}}}'
                    else '{{{{"insightData":{{{{}}}}}}}}' end as insight_data
        from {{events}} where event_type <> 'purchase'
        union all
        select event_id * 3 + 1 as id, 'c' || cast(event_id as string) as call_sid, ts as created_on,
               'INBOUND_PATIENT_CALL_LIST' as insight_type,
               case when event_id % 5 = 0 then '{{{{}}}}' else '{{{{"insightData":{{{{"agents":["z"],"personnelType":"CUSTOMER_SUPPORT"}}}}}}}}' end as insight_data
        from {{events}} where event_type = 'click'
        union all
        select event_id * 3 + 2 as id, 'c' || cast(event_id as string) as call_sid, ts as created_on,
               'INCOMING_EXOTEL_CALL_DETAILS' as insight_type,
               case when event_id % 5 = 0 then '{{{{"insightData":{{{{"leg1DetailedStatus":"failed_operator_error","leg1AgentNumber":"' || {_phone('event_id % 200')} || '"}}}}}}}}'
                    when event_id % 5 = 1 then '{{{{"insightData":{{{{"leg1DetailedStatus":"busy","leg2DetailedStatus":"Call_Completed","leg2AgentNumber":"' || {_phone('event_id % 250')} || '","leg2Status":"done"}}}}}}}}'
                    when event_id % 5 = 2 then '{{{{"insightData":{{{{"leg1DetailedStatus":"canceled","leg1AgentNumber":"' || {_phone('event_id % 300')} || '","leg3AgentNumber":"' || {_phone('user_id')} || '"}}}}}}}}'
                    when event_id % 5 = 3 then '{{{{"noPayload":true}}}}'
                    else '{{{{"insightData":{{{{"leg2AgentNumber":""}}}}}}}}' end as insight_data
        from {{events}} where event_type <> 'signup'""",
    "menu_answer": """
        select event_id as id, user_id as entity_id, ts as created_on,
               case when event_id % 3 = 0 then 3 else 4 end as ivr_question_id,
               event_id % 5 as option_value,
               cast(case when event_type = 'error' then 4 else 3 end as int) as template_id,
               case when event_type = 'view' then 'CUSTOMER' else 'PATIENT_CASE' end as entity_type
        from {events}""",
    # ---- cashback -------------------------------------------------------------------
    "cash_ledger": f"""
        select o_orderkey as id, o_custkey as customer_id,
               case when o_orderpriority = '1-URGENT' then 6 else o_orderkey % 5 + 1 end as cashback_type,
               cast(round(o_totalprice * 100) as bigint) as amount,
               case o_orderkey % 6 when 0 then 'APPOINTMENT' when 1 then 'DIAGNOSTICS_APPOINTMENT'
                    when 2 then 'PATIENT_SURGERY' when 3 then 'LOYALTY_CARD' when 4 then 'PROMOTION' else null end as issued_entity_type,
               case when o_orderkey % 6 = 3 then o_orderkey % 5000 else o_orderkey + o_orderkey % 2 end as issued_entity_id,
               case when o_orderstatus = 'P' then 'DEBITED' else 'CREDITED' end as transaction_type,
               {SPREAD} as created_on
        from {{orders}}""",
    "cashback_type": """
        select cast(r_regionkey + 1 as bigint) as cashback_id, r_name as cashback_type,
               cast(case when r_regionkey = 2 then 0 else 1 end as int) as is_active
        from {region}""",
    "payment_link": """
        select o_orderkey as entity_id, case when o_orderkey % 50 = 0 then 'CASE' else 'APPOINTMENT' end as entity_type,
               case when o_orderkey % 7 = 0 then 'FAILED' else 'PAID' end as status,
               cast(5000 as bigint) as amount
        from {orders}
        union all
        select o_orderkey as entity_id, 'APPOINTMENT' as entity_type, 'PAID' as status,
               cast(round(o_totalprice * 100) as bigint) - 5000 as amount
        from {orders} where o_orderpriority <> '5-LOW'""",
    "card": """
        select p_partkey as card_id, case when p_size % 3 = 0 then 'INACTIVE' else 'ACTIVE' end as status from {part}""",
    "card_payment": f"""
        select p_partkey as card_id, {_email('p_partkey % 400')} as collected_by from {{part}}""",
    "message_log": f"""
        select o_orderkey as id, o_orderkey as entity_tag_map_id, {SPREAD} as communication_date,
               cast(case when o_orderkey % 20 = 0 then 0 else 1 end as int) as communication_done,
               case when o_orderkey % 33 = 0 then 'CALL' else 'SMS' end as communication_type,
               case when o_orderpriority = '2-HIGH' then 100 + o_orderkey % 50
                    when o_orderpriority = '4-NOT SPECIFIED' then 251 + o_orderkey % 4 else 255 + o_orderkey % 2 end as asset_id
        from {{orders}} where o_orderstatus = 'O' and o_orderpriority in ('2-HIGH', '4-NOT SPECIFIED', '5-LOW')""",
    "message_tag": """
        select o_orderkey as id, cast(case when o_orderpriority = '2-HIGH' then 275 else 1 end as int) as tag_id,
               o_custkey as entity_id, case when o_orderkey % 41 = 0 then 'CASE' else 'PATIENT_PROFILE' end as entity_type,
               '{{"cashNudgingFlow":"' || case o_orderkey % 4 when 0 then 'APP_DONE' when 1 then 'APP_CANCEL'
                    when 2 then 'CASE_CLOSED' else 'CASE_CANCEL' end || '"}}' as additional_details
        from {orders}""",
    "asset": "select o_orderkey as id from {orders}",
    "one_time_message": f"""
        select o_orderkey as id, {SPREAD} as scheduled_on, {_phone('o_custkey % 60')} as patient_number,
               'SMS' as communication_type, case when o_orderkey % 12 = 0 then 'FAILED' else 'SUCCESS' end as status,
               '{{{{"promotionalCashAmount":"' || case o_orderkey % 5 when 0 then '100' when 1 then '300' when 2 then '500'
                    when 3 then '1000' else '700' end || '","cashPromoDone":"'
                    || case when o_orderkey % 14 = 0 then 'false' else 'true' end || '"}}}}' as additional_details
        from {{orders}} where o_orderstatus = 'O' and o_orderpriority = '3-MEDIUM'""",
    "chat_message": f"""
        select o_orderkey as id, {_phone('o_custkey % 60')} as from_id,
               case when o_orderkey % 10 = 0 then '0' else {_phone('o_custkey % 60')} end as to_message,
               {SPREAD} as created_on
        from {{orders}} where o_orderstatus = 'F' and o_orderpriority in ('1-URGENT', '2-HIGH', '3-MEDIUM')""",
    "ledger_call": f"""
        select o_orderkey as id, {_phone('o_custkey % 60')} as from_no, '1' as to_no,
               case when o_orderkey % 9 = 0 then 'outbound' else 'inbound' end as direction,
               {SPREAD} + interval '330' minute as call_created_on
        from {{orders}} where o_orderstatus = 'F' and o_orderpriority in ('4-NOT SPECIFIED', '5-LOW')""",
    "transaction": """
        select o_custkey as patient_id,
               case when o_custkey % 3 = 0 and o_orderpriority = '1-URGENT' then 'CASHBACK' else 'CARD' end as payment_mode,
               o_orderdate as created_on, cast(o_orderkey % 53 as string) as week
        from {orders}""",
}

