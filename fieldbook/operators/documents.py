"""JSON documents kept per call: last valid, first valid, last answer per level."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldbook import vocabulary as v

LIST_FIELDS = ("agentInSystem", "agentAvailable")
DETAIL_FIELDS = tuple(
    f"leg{n}{part}" for part in ("DetailedStatus", "AgentNumber", "Status") for n in (1, 2, 3)
)
TYPE_FIELD = v.ROLES.staff_key


def payload(document: Column, type_field: str = TYPE_FIELD) -> Column:
    """``insightData`` of a document, NULL when absent or unreadable.

    One schema covers both kinds of document, so the text is parsed once.
    """
    texts = (*LIST_FIELDS, *DETAIL_FIELDS, type_field)
    schema = T.StructType([
        T.StructField("agents", T.ArrayType(T.StringType())),
        *[T.StructField(name, T.StringType()) for name in texts],
    ])
    return F.from_json(document, T.StructType([T.StructField("insightData", schema)]))["insightData"]


def _position(order: Sequence[str], present: Column) -> Column:
    return F.when(present, F.struct(*[F.col(c) for c in order]))


def last_present(values: Column, order: Sequence[str], present: Column) -> Column:
    """Aggregate: ``values`` of the last row that is present, NULL if there is none."""
    return F.max_by(values, _position(order, present))


def first_present(values: Column, order: Sequence[str], present: Column) -> Column:
    """Aggregate: ``values`` of the first row that is present, NULL if there is none."""
    return F.min_by(values, _position(order, present))


def array_filled(json: Column, path: str) -> Column:
    """TRUE / FALSE for a filled / empty JSON array, NULL when there is none."""
    return F.json_array_length(F.get_json_object(json, path)) > 0


def _dial_values(type_field: str) -> Column:
    return F.struct(
        F.coalesce(F.size("_p.agents") > 0, F.lit(False)).alias("no_sent"),
        F.col("_p.agents").isNotNull().alias("requested"),
        F.col(f"_p.{type_field}").alias("personnel_type"),
        F.coalesce("_p.agentInSystem", F.lit("")).alias("agent_in_system"),
        F.coalesce("_p.agentAvailable", F.lit("")).alias("agent_available"),
    )


def _dial_columns(found: str) -> list[Column]:
    """A call that has list documents, but none with a payload, was asked and not answered."""
    return [
        F.coalesce(f"{found}.no_sent", F.lit(False)).alias("no_sent"),
        F.coalesce(f"{found}.requested", F.lit(False)).alias("requested"),
        F.col(f"{found}.personnel_type"),
        F.coalesce(f"{found}.agent_in_system", F.lit("")).alias("agent_in_system"),
        F.coalesce(f"{found}.agent_available", F.lit("")).alias("agent_available"),
    ]


def dial_list(docs: DataFrame, key: str, order: Sequence[str], type_field: str = TYPE_FIELD) -> DataFrame:
    """Was a list of agents requested and sent for the call, and for which staff group?

    Decided by the last list document with a payload.
    """
    parsed = docs.withColumn("_p", payload(F.col("insight_data"), type_field))
    found = last_present(_dial_values(type_field), order, F.col("_p").isNotNull()).alias("_d")
    return parsed.groupBy(key).agg(found).select(key, *_dial_columns("_d"))


def leg_details(docs: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """Leg fields of the first detail document with a payload; other calls are left out."""
    parsed = docs.withColumn("_p", payload(F.col("insight_data")))
    present = F.col("_p").isNotNull()
    return (
        parsed.groupBy(key)
        .agg(
            first_present(F.struct(*[F.col(f"_p.{f}") for f in DETAIL_FIELDS]), order, present).alias("_l"),
            F.count_if(present).alias("_n"),
        )
        .where(F.col("_n") > 0)
        .select(key, "_l.*")
    )


def call_facts(docs: DataFrame, key: str, order: Sequence[str], type_field: str = TYPE_FIELD) -> DataFrame:
    """``dial_list`` and ``leg_details`` of a mixed document table in one aggregate.

    ``listed`` tells a call with list documents from one without; there the dial columns
    mean nothing.
    """
    kind, present = F.col("insight_type"), F.col("_p").isNotNull()
    parsed = docs.where(kind.isin(v.LIST_DOCUMENT, v.DETAIL_DOCUMENT)).withColumn(
        "_p", payload(F.col("insight_data"), type_field)
    )
    is_list, is_detail = kind == v.LIST_DOCUMENT, kind == v.DETAIL_DOCUMENT
    legs = F.struct(*[F.col(f"_p.{f}") for f in DETAIL_FIELDS])
    return (
        parsed.groupBy(key)
        .agg(
            F.bool_or(is_list).alias("listed"),
            last_present(_dial_values(type_field), order, is_list & present).alias("_d"),
            first_present(legs, order, is_detail & present).alias("_l"),
        )
        .select(key, "listed", *_dial_columns("_d"), "_l.*")
    )


def case_answers(answers: DataFrame) -> DataFrame:
    """Answers given in the case menu; other templates and entities do not count."""
    return answers.where(
        (F.col("template_id") == v.MENU_TEMPLATE) & (F.col("entity_type") == v.MENU_ENTITY)
    )


def menu_levels(answers: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """Last answer of each menu level per entity, as an outcome label."""
    position = F.struct(*[F.col(c) for c in order])
    language = F.col("ivr_question_id").cast("string") == v.LANGUAGE_QUESTION
    option = F.col("option_value").cast("string")
    first = F.when(option.isin("1", "2", "3"), v.CHOOSE_LANGUAGE).otherwise(v.CHAT_FLOW)
    second = F.when(option == "1", v.TRANSFERRED).otherwise(v.CHAT_FLOW)
    is_language = F.coalesce(language, F.lit(False))
    return answers.groupBy(key).agg(
        F.max_by(first, F.when(is_language, position)).alias("first_level"),
        F.max_by(second, F.when(~is_language, position)).alias("second_level"),
    )
