"""Queries over the driver's tables, each next to its SQL twin.

A probe is a function of ``Tables``; its SQL says the same thing independently. ``VIEWS``
(see ``views.py``) binds the library's logical inputs to the driver's tables; both sides
start from the same binding, which only renames and derives columns.
"""

from __future__ import annotations

from collections.abc import Callable
from string import Formatter

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldbook.probes.views import VIEWS
from fieldbook.session import split_skewed_joins
from fieldbook.sources.schemas import struct

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


SCHEMAS = {
    "region": struct("r_regionkey:i r_name:s"),
    "nation": struct("n_nationkey:i n_name:s n_regionkey:i"),
    "customer": struct("c_custkey:l c_name:s c_nationkey:i c_acctbal:f c_mktsegment:s"),
    "supplier": struct("s_suppkey:l s_name:s s_nationkey:i s_acctbal:f"),
    "part": struct("p_partkey:l p_name:s p_brand:s p_type:s p_size:i p_retailprice:f"),
    "orders": struct(
        "o_orderkey:l o_custkey:l o_orderstatus:s o_totalprice:f o_orderdate:t o_orderpriority:s"
    ),
    "lineitem": struct(
        "l_orderkey:l l_partkey:l l_suppkey:l l_linenumber:i l_quantity:f l_extendedprice:f "
        "l_discount:f l_tax:f l_returnflag:s l_linestatus:s l_shipdate:t"
    ),
    "events": struct("event_id:l ts:t user_id:l event_type:s value:f props:s"),
}


class Tables:
    """``t.orders`` reads a driver table, ``t.view("personnel")`` a bound logical input.

    Schemas are declared, so opening a table starts no job.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self._views: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.schema(SCHEMAS[name]).parquet(f"{self.folder}/{name}.parquet")

    def view(self, name: str) -> DataFrame:
        if name not in self._views:
            text = VIEWS[name]
            inputs = {n: getattr(self, n) for n in sources_of(text)}
            self._views[name] = self.spark.sql(text, **inputs)
        return self._views[name]

    def views(self, names: str) -> list[DataFrame]:
        return [self.view(n) for n in names.split()]


def sources_of(text: str) -> list[str]:
    return sorted({field for _, field, _, _ in Formatter().parse(text) if field})


def with_views(names: str, body: str) -> str:
    """DuckDB text: the named bindings as common table expressions, then the query."""
    parts = []
    for name in names.split():
        text = VIEWS[name]
        parts.append(f"{name} AS ({text.format(**{n: n for n in sources_of(text)})})")
    body = body.strip()
    if body.upper().startswith("WITH "):
        return f"WITH {', '.join(parts)}, {body[5:]}" if parts else body
    return f"WITH {', '.join(parts)} {body}" if parts else body


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles, so that both engines hash the same kind of number."""
    return df.select(*[
        F.col(f.name).cast("double").alias(f.name)
        if isinstance(f.dataType, T.DecimalType) else F.col(f.name)
        for f in df.schema
    ])


def probe(name: str, sql: str | None = None, views: str = ""):
    def register(build: Callable[[Tables], DataFrame]):
        QUERIES[name] = lambda spark, folder: plain(build(Tables(split_skewed_joins(spark), folder)))
        if sql is not None:
            ORACLES[name] = with_views(views, sql)
        return build

    return register
