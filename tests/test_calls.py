import itertools

import pytest
from conftest import at, tuples
from pyspark.sql import functions as F

from fieldbook import vocabulary as v
from fieldbook.functions.calls import document_call_id, final_status, menu_outcome
from fieldbook.functions.text import counterparty, number_class
from fieldbook.operators import documents
from fieldbook.probes.deployment import ROLES
from fieldbook.plans import calls


def expected(d1, d2, d3, leg1, leg2, sent):
    """The truth table of FIXTURES.md §3, step by step."""
    d1, d2, d3 = ((d or "").upper() for d in (d1, d2, d3))
    if "CALL_COMPLETED" in (d1, d2, d3):
        base = "CALL_COMPLETED"
    elif d1 not in ("", "NO_CALL_INSIGHT"):
        base = d1
    elif leg2 == "completed":
        base = "CALL_COMPLETED"
    elif leg2:
        base = leg2.upper()
    elif leg1 == "completed":
        base = "LEG_1_COMPLETED"
    elif leg1:
        base = leg1.upper()
    else:
        base = "NO_CALL_INSIGHT"
    if base == "CANCELED" and sent is not None:
        return "CUSTOMER_CANCELLED" if sent else "NO_NUMBER_TO_DIALOUT_CANCELED"
    if base == "BUSY" and sent is False:
        return "NO_NUMBER_TO_DIALOUT_BUSY"
    return base


def test_final_status_truth_table(table):
    details = [None, "NO_CALL_INSIGHT", "busy", "Canceled", "call_completed", "failed_x"]
    legs = [None, "", "completed", "busy", "canceled"]
    rows = list(itertools.product(details, [None, "CALL_COMPLETED", "busy"], [None, "call_completed"], legs, legs, [None, True, False]))
    df = table("i:l d1:s d2:s d3:s l1:s l2:s sent:b", [(i, *r) for i, r in enumerate(rows)])
    got = df.select("i", final_status(*[F.col(c) for c in ("d1", "d2", "d3", "l1", "l2", "sent")]).alias("x"))
    wrong = [(rows[r.i], r.x) for r in got.collect() if r.x != expected(*rows[r.i])]
    assert not wrong and len(rows) == 2700


DOCS = "id:l sid:s insight_type:s insight_data:s created_on:t"


def docs(table, *texts, kind=v.LIST_DOCUMENT):
    t = at("2024-01-01 00:00:00")
    return table(DOCS, [(i, sid, kind, text, t) for i, (sid, text) in enumerate(texts)])


@pytest.mark.parametrize("text, row", [
    ('{"insightData":{"agents":[]}}', (False, True, None, "", "")),
    ('{"insightData":{"agents":[{"n":1},"x"],"personnelType":"P"}}', (True, True, "P", "", "")),
    ('{"insightData":{"agentInSystem":"yes","agentAvailable":"no"}}', (False, False, None, "yes", "no")),
    ('{"insightData":{}}', (False, False, None, "", "")),
    ('{"else":1}', (False, False, None, "", "")),
    ("not json", (False, False, None, "", "")),
    (None, (False, False, None, "", "")),
])
def test_list_documents(table, text, row):
    assert tuples(documents.dial_list(docs(table, ("a", text)), "sid", ["created_on", "id"])) == [("a", *row)]


def test_last_list_document_with_payload_wins_as_a_whole(table):
    df = docs(table, ("a", '{"insightData":{"agents":["x"],"personnelType":"P"}}'), ("a", '{"insightData":{}}'), ("a", "{}"))
    assert tuples(documents.dial_list(df, "sid", ["created_on", "id"]), "no_sent", "personnel_type") == [(False, None)]


def test_first_detail_document_with_payload_wins(table):
    df = docs(table, ("a", "{}"), ("a", '{"insightData":{"leg1Status":"one"}}'), ("a", '{"insightData":{"leg1Status":"two"}}'),
              ("b", "{}"), kind=v.DETAIL_DOCUMENT)
    assert tuples(documents.leg_details(df, "sid", ["created_on", "id"]), "sid", "leg1Status") == [("a", "one")]


def test_menu(table):
    answers = table("id:l entity_id:l ivr_question_id:l option_value:s", [
        (1, 1, 3, "1"), (2, 1, 3, "9"), (3, 2, 4, "2"), (4, 2, 4, "1"), (5, 3, 3, "2"), (6, 3, None, None)])
    assert tuples(documents.menu_levels(answers, "entity_id", ["id"])) == [
        (1, v.CHAT_FLOW, None), (2, None, v.TRANSFERRED), (3, v.CHOOSE_LANGUAGE, v.CHAT_FLOW)]
    kept = documents.case_answers(table("id:l template_id:i entity_type:s", [(1, 3, "PATIENT_CASE"), (2, 4, "PATIENT_CASE"), (3, 3, None)]))
    assert tuples(kept, "id") == [(1,)]
    flows = table("f:s d:i a:s b:s", [
        (v.SINGLE_LEVEL_FLOW, 1, None, None), (v.SINGLE_LEVEL_FLOW, 2, None, None), (v.MULTI_LEVEL_FLOW, 1, "A", None),
        (v.MULTI_LEVEL_FLOW, 1, "A", "B"), (v.MULTI_LEVEL_FLOW, 1, None, None), ("OTHER", 3, None, None), (None, None, None, None)])
    got = flows.select(menu_outcome(*[F.col(c) for c in "fdab"])).collect()
    assert [r[0] for r in got] == [v.TRANSFERRED, v.CHAT_FLOW, "A", "B", v.CHAT_FLOW, v.TRANSFERRED, v.CHAT_FLOW]


@pytest.mark.parametrize("reply, found", [
    ('{"callSid":"a"}', "a"), ('{"Call":{"Sid":"b"}}', "b"), ('{"callSid":null,"Call":{"Sid":"b"}}', None),
    ('{"callSid":""}', None), ("{}", None), (None, None),
])
def test_document_call_id(spark, reply, found):
    assert spark.range(1).select(document_call_id(F.lit(reply).cast("string"))).first()[0] == found


def test_numbers(table):
    df = table("d:s a:s b:s", [("inbound", "+91 9000000001", "080"), ("outbound", "080", "09000000002"), (None, "1", "")])
    got = df.select(counterparty(F.col("d"), F.col("a"), F.col("b")), number_class(F.col("b"), ["9000000002"])).collect()
    assert [tuple(r) for r in got] == [("9000000001", "Non-IVR"), ("9000000002", "IVR"), (None, "Non-IVR")]


CALLS = ("sid:s call_created_on:t status:s direction:s to_no:s from_no:s exotel_no:s duration:l price:m "
         "leg_1_status:s leg_1_duration:l leg_2_status:s leg_2_duration:l recording_url:s")


def call(sid, when, number, leg2=""):
    return (sid, at(when), "x", "inbound", "1", number, "0", None, None, "", None, leg2, 3, None)


def test_call_detail_and_failed_feed(table):
    rows = table(CALLS, [
        call("a", "2024-01-01 10:00:00", "+919000000001"), call("b", "2024-01-01 10:05:00", "9000000002", "canceled"),
        call("c", "2024-01-01 10:10:00", "", "failed_unknown_error"),
        ("d", at("2024-01-01 10:00:00"), "x", "outbound", "1", "2", "0", None, None, "", None, "", 3, None),
    ])
    t = at("2024-01-01 09:00:00")
    papers = table("id:l call_sid:s insight_type:s insight_data:s created_on:t", [
        (1, "a", v.LIST_DOCUMENT, '{"insightData":{"agents":["q"],"personnelType":"FIELD_STAFF"}}', t),
        (2, "a", v.DETAIL_DOCUMENT, '{"insightData":{"leg1DetailedStatus":"failed_operator_error","leg1AgentNumber":"98","leg3AgentNumber":"99"}}', t),
        (3, "zz", v.LIST_DOCUMENT, '{"insightData":{}}', t),
        (4, "b", v.DETAIL_DOCUMENT, '{"insightData":{"leg1AgentNumber":"98"}}', t),
    ])
    city = table("id:l city_name:s", [(1, "Chandigarh"), (2, "Pune")])
    cities = calls.caller_cities(
        table("case_id:l patient_id:l city_id:l", [(1, 1, 2), (2, 1, None), (3, 2, None)]),
        table("id:l customer_id:l city_id:l", [(1, 1, 1), (2, 2, None)]),
        table("customer_id:l customer_number:s", [(1, "9000000001"), (2, "9000000002")]), city, roles=ROLES,
    )
    assert tuples(cities) == [("9000000001", "CHD"), ("9000000002", v.NO_CITY)]
    people = "id:l email:s phone:s city_id:l"
    support = calls.agents_by_number(table(people, [(1, "s@x", "98", 2), (2, "t@x", "98", 1), (3, "u@x", "", 1)]), city, "CUSTOMER_SUPPORT", ROLES)
    field = calls.agents_by_number(table(people, [(4, "f@x", "98", None), (5, "g@x", "99", 1)]), city, "FIELD_STAFF", ROLES)
    detail = calls.call_detail(rows, papers, cities, support.unionByName(field), route=calls.staff_route())
    found = {r.sid: r for r in calls.published_calls(detail).collect()}
    assert set(found) == {"a", "b", "c"}
    assert (found["a"].leg1_agent_email, found["a"].leg3_agent_email, found["a"].leg3_agent_city) == ("f@x", "g@x", "CHD")
    assert (found["a"].final_status, found["a"].no_sent, found["a"].city) == ("FAILED_OPERATOR_ERROR", "true", "CHD")
    assert (found["b"].leg1_agent_email, found["b"].personnel_type, found["b"].no_sent) == ("s@x", "NA", None)
    assert found["b"].final_status == "CANCELED"      # never requested: no refinement
    assert (found["c"].final_status, found["c"].city, found["c"].duration) == ("FAILED_UNKNOWN_ERROR", v.NO_CITY, "0")

    merged = calls.agents_by_priority(support, field)
    assert tuples(merged) == [("98", "s@x", "Pune"), ("99", "g@x", "CHD")]
    feed = calls.failed_calls(calls.call_detail(rows, papers, cities, merged), at("2024-01-01 10:10:00"), 10)
    assert [tuple(r) for r in feed.select("sid", "notify").collect()] == [("c", "")]
