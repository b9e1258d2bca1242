"""Probes: the streaming feeds, drained over the driver's tables in unordered batches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldbook import vocabulary as v
from fieldbook.functions.clock import to_local
from fieldbook.functions.text import MONEY, major_units
from fieldbook.probes.registry import Tables, probe
from fieldbook.probes.tables import BUCKET_SQL
from fieldbook.session import work_folder
from fieldbook.streaming import feeds


POLLS = 3


def arrivals(rows: DataFrame) -> list[DataFrame]:
    """The rows in parts that are not in time order, as a feed may find them one after another."""
    lot = F.pmod(F.xxhash64(*rows.columns), F.lit(POLLS))
    return [rows.where(lot == i) for i in range(POLLS)]


def fed(t: Tables, parts: list[DataFrame], feed: feeds.Feed, bind) -> DataFrame:
    """What the feed has published after a poll for each part; as many tasks write and read a part as it needs."""
    folder, position = work_folder(t.spark, "inbox"), work_folder(t.spark, "feed-position")
    kept = feeds.store(t.spark, feed, work_folder(t.spark, "feed"), bind(parts[0]).schema)
    for rows in parts:
        rows.write.mode("append").parquet(folder)
        feeds.drain(bind(feeds.file_stream(t.spark, folder, rows.schema, "*.parquet")), kept, position)
        kept.publish()
        kept.compact(fanout=2)
    return kept.published()


CALLS_SQL = """
    (select event_id as sid, ts as call_created_on, case event_type when 'error' then 'FAILED_OPERATOR_ERROR'
            when 'purchase' then 'FAILED_UNKNOWN_ERROR' else 'CALL_COMPLETED' end as final_status from events)"""


def as_calls(events: DataFrame) -> DataFrame:
    status = (
        F.when(F.col("event_type") == "error", v.FAILED_STATUSES[1])
        .when(F.col("event_type") == "purchase", v.FAILED_STATUSES[2])
        .otherwise(v.CALL_COMPLETED)
    )
    return events.select(
        F.col("event_id").alias("sid"), F.col("ts").alias("call_created_on"), status.alias("final_status")
    )


@probe("T01_failed_call_counts", f"""
    select w as window_start, w + interval '10 minutes' as window_end, final_status, count(*) as calls
    from (select *, time_bucket(interval '10 minutes', call_created_on, timestamp '1970-01-01') as w from {CALLS_SQL})
    where final_status <> 'CALL_COMPLETED' group by all""")
def _(t: Tables):
    return fed(t, arrivals(t.events), feeds.failed_call_counts(), as_calls)


@probe("T01_failed_call_rows", f"""
    select sid, call_created_on, final_status from {CALLS_SQL} where final_status <> 'CALL_COMPLETED'""")
def _(t: Tables):
    return fed(t, arrivals(t.events), feeds.failed_calls(), as_calls)


@probe("T02_audit_rows", """
    select cast(event_id as varchar) as rev, user_id as customer_id, cast(1 as bigint) as rows from events""")
def _(t: Tables):
    def twice(events: DataFrame) -> DataFrame:
        """Each revision arrives twice in a batch; half of them once more in another."""
        return events.select(
            F.col("event_id").cast("string").alias("rev"), F.col("user_id").alias("customer_id"),
            F.col("ts").alias("created_on"), F.explode(F.array(F.lit(1), F.lit(2))).alias("copy"),
        ).drop("copy")

    again = t.events.where("event_id % 2 = 0")
    found = fed(t, [*arrivals(t.events), again], feeds.audit_rows(buckets=4), twice)
    return found.groupBy("rev", "customer_id").agg(F.count(F.lit(1)).alias("rows"))


LEDGER_SQL = f"""
    (select o_orderdate + interval '330 minutes' as created_on, transaction_type, {BUCKET_SQL} as bucket, amount from (
       select *, 'PROMO' as issued_entity_type, case when o_orderstatus = 'P' then 'DEBITED' else 'CREDITED' end as transaction_type,
              case when o_orderpriority = '1-URGENT' then 6 else 1 end as cashback_type, cast(o_totalprice as decimal(18,2)) as amount
       from orders where o_orderstatus <> 'P' or o_orderpriority <> '5-LOW'))"""


@probe("T03_ledger_days", f"""
    select cast(created_on as date) as day, transaction_type, bucket, cast(sum(amount) as double) as amount, count(*) as entries
    from {LEDGER_SQL} group by 1, 2, 3""")
def _(t: Tables):
    return fed(t, arrivals(t.orders), feeds.ledger_days(), as_ledger)


def as_ledger(orders: DataFrame) -> DataFrame:
    debit = F.col("o_orderstatus") == "P"
    return orders.select(
        to_local(F.col("o_orderdate")).alias("created_on"),
        F.when(debit, v.DEBITED).otherwise(v.CREDITED).alias("transaction_type"),
        F.lit("PROMO").alias("issued_entity_type"),
        F.when(F.col("o_orderpriority") == "1-URGENT", 6).otherwise(1).alias("cashback_type"),
        F.when(F.col("o_orderpriority") == "5-LOW", v.PARTIAL_PAYMENT).otherwise(v.FULL_PAYMENT).alias("payment_tag"),
        major_units(F.round(F.col("o_totalprice") * 100)).cast(MONEY).alias("amount"),
    )
