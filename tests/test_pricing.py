"""Agreements in force by bins of days, against all pairs of a key."""

import datetime as dt
import random

import pytest
from conftest import at, tuples
from pyspark.sql import functions as F

from fieldbook.operators import pricing

CASES, RATES = "k:s id:l on:t", "k:s rate:l start_date:t end_date:t"


def pairs(cases, rates):
    out = []
    for key, id, on in cases:
        mine = [r for r in rates if key is not None and r[0] == key]
        if not mine:
            out.append((key, id, on, None, None, None))
        for _, rate, start, end in mine:
            if not (on and ((start and on < start) or (end and on > end))):
                out.append((key, id, on, rate, start, end))
    return sorted(out, key=repr)


def found(table, cases, rates):
    return tuples(pricing.in_force(table(CASES, cases), table(RATES, rates), key="k", on_date=F.col("on")))


@pytest.mark.parametrize("seed", range(4))
def test_against_all_pairs(table, seed):
    draw = random.Random(seed)
    origin = at("2020-01-01 00:00:00")
    when = lambda: draw.choice([None, *[origin + dt.timedelta(hours=draw.randrange(24 * 400)) for _ in range(4)]])
    cases = [(draw.choice(["a", "b", "c", None]), i, when()) for i in range(120)]
    rates = [(draw.choice(["a", "b", "d", None]), i, when(), when()) for i in range(40)]
    assert found(table, cases, rates) == pairs(cases, rates)


def test_edges_of_bins_periods_and_the_calendar(table):
    start, end = at("2020-01-31 12:00:00"), at("2020-03-03 12:00:00")
    second = dt.timedelta(seconds=1)
    dates = [None, start - second, start, start + second, end - second, end, end + second, at("1000-01-01 00:00:00"), at("1899-12-31 23:59:59"),
             at("2100-01-01 00:00:00"), at("2999-01-01 00:00:00")]
    cases = [("k", i, on) for i, on in enumerate(dates)] + [("nobody", 90, start), (None, 91, start), (None, 92, None)]
    rates = [("k", 1, start, end), ("k", 2, None, start), ("k", 3, end, None), ("k", 4, None, None), ("k", 5, end, start), (None, 6, None, None),
             ("k", 7, at("1000-01-01 00:00:00"), at("1000-01-01 00:00:00")), ("k", 8, at("2999-01-01 00:00:00"), None)]
    assert found(table, cases, rates) == pairs(cases, rates)
    only_early = [("k", 1, start, end)]
    assert found(table, [("k", 1, at("2021-01-01 00:00:00"))], only_early) == []
    assert found(table, [("k", 1, start)], []) == [("k", 1, start, None, None, None)]


def test_a_thousand_agreements_of_one_key_are_not_all_candidates(spark, table):
    origin, week = at("2000-01-01 00:00:00"), dt.timedelta(days=7)
    rates = table(RATES, [("k", i, origin + i * week, origin + (i + 1) * week - dt.timedelta(seconds=1)) for i in range(1_000)])
    cases = spark.range(2_000).select(F.lit("k").alias("k"), "id", (F.lit(origin) + F.make_dt_interval(F.col("id").cast("int") * 3)).cast("timestamp_ntz").alias("on"))
    met = pricing.binned(rates, "k", "start_date", "end_date")
    per_bin = met.where(F.col("_bin") != pricing.ANY_DAY).groupBy("_bin").count()
    assert per_bin.agg(F.max("count")).first()[0] <= 6 and met.count() < 3_500
    rows = pricing.in_force(cases, rates, key="k", on_date=F.col("on"))
    assert rows.count() == 2_000 and rows.where(F.expr("rate <> id * 3 div 7")).count() == 0


def test_a_long_agreement_has_few_bins(table):
    days = [1, 32, 255, 256, 2_047, 2_048, 16_383, 16_384, 40_000]
    start = at("1950-01-01 00:00:00")
    rates = table(RATES, [("k", n, start, start + dt.timedelta(days=n)) for n in days] + [("k", 0, None, None), ("k", -1, start, None), ("k", -2, None, start)])
    met = pricing.binned(rates, "k", "start_date", "end_date")
    assert met.groupBy("rate").count().agg(F.max("count")).first()[0] <= 10  # one of them is ANY_DAY


@pytest.mark.parametrize("seed", range(3))
def test_periods_of_all_lengths_against_all_pairs(table, seed):
    draw = random.Random(seed)
    origin = at("1990-01-01 00:00:00")
    day = lambda: origin + dt.timedelta(hours=draw.randrange(24 * 365 * 40))

    def rate(i):
        start = draw.choice([None, day()])
        length = dt.timedelta(hours=draw.randrange(24 * draw.choice([1, 32, 256, 2_048, 16_384, 40_000]) + 1))
        return draw.choice(["a", "b", "d", None]), i, start, draw.choice([None, (start or day()) + length])

    cases = [(draw.choice(["a", "b", "c", None]), i, draw.choice([None, *[day() for _ in range(5)]])) for i in range(100)]
    rates = [rate(i) for i in range(40)]
    edges = [("a", 100 + i, edge + shift) for i, (_, _, *period) in enumerate(rates) for edge in period if edge
             for shift in (-dt.timedelta(seconds=1), dt.timedelta(0), dt.timedelta(seconds=1))]
    assert found(table, cases + edges, rates) == pairs(cases + edges, rates)


def test_agreements_and_their_keys_stay_off_the_driver(spark):
    cases = spark.range(50).selectExpr("cast(id % 5 as string) as k", "id", "timestamp_ntz'2024-01-10' as on")
    rates = spark.range(4).selectExpr("cast(id as string) as k", "id as rate", "timestamp_ntz'2024-01-01' as start_date", "cast(null as timestamp_ntz) as end_date")
    rows = pricing.in_force(cases, rates, key="k", on_date=F.col("on"))
    assert rows.where("rate is not null").count() == 40 and len(rows.collect()) == 50
    assert "Broadcast" not in rows._jdf.queryExecution().executedPlan().toString()
