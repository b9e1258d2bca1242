"""Call-outcome expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fieldbook import vocabulary as v


def final_status(
    d1: Column, d2: Column, d3: Column, leg1: Column, leg2: Column, sent: Column
) -> Column:
    """One outcome per call.

    Documented legs speak first, then the second leg of the call record, then the
    first; ``sent`` (NULL: not requested) refines cancelled and busy calls.
    """
    first = F.coalesce(F.upper(d1), F.lit(v.NO_DOCUMENT))
    any_completed = F.lit(False)
    for leg in (first, F.upper(d2), F.upper(d3)):
        any_completed = any_completed | F.coalesce(leg == v.CALL_COMPLETED, F.lit(False))
    base = (
        F.when(any_completed, v.CALL_COMPLETED)
        .when(first != v.NO_DOCUMENT, first)
        .when(leg2 == v.COMPLETED, v.CALL_COMPLETED)
        .when(leg2 != "", F.upper(leg2))
        .when(leg1 == v.COMPLETED, v.LEG_1_COMPLETED)
        .when(leg1 != "", F.upper(leg1))
        .otherwise(v.NO_DOCUMENT)
    )
    return (
        F.when((base == v.CANCELED) & sent, v.CUSTOMER_CANCELLED)
        .when((base == v.CANCELED) & ~sent, v.NO_NUMBER_CANCELED)
        .when((base == v.BUSY) & ~sent, v.NO_NUMBER_BUSY)
        .otherwise(base)
    )


def menu_outcome(flow: Column, digit: Column, first: Column, second: Column) -> Column:
    """What the caller's key press led to; depends on the kind of menu."""
    return (
        F.when(
            flow == v.SINGLE_LEVEL_FLOW,
            F.when(digit == 1, v.TRANSFERRED).otherwise(v.CHAT_FLOW),
        )
        .when(flow == v.MULTI_LEVEL_FLOW, F.coalesce(second, first, F.lit(v.CHAT_FLOW)))
        .otherwise(F.when(digit.isin(1, 2, 3), v.TRANSFERRED).otherwise(v.CHAT_FLOW))
    )


def document_call_id(response: Column) -> Column:
    """Call id of an API reply: the flat key if it exists, else the nested one."""
    has_flat = F.array_contains(F.json_object_keys(response), "callSid")
    found = F.when(has_flat, F.get_json_object(response, "$.callSid")).otherwise(
        F.get_json_object(response, "$.Call.Sid")
    )
    return F.nullif(found, F.lit(""))
