import datetime as dt

import pytest
from conftest import at, tuples
from pyspark.sql import functions as F

from fieldbook.functions import clock


def test_periods_on_the_first_of_a_month():
    p = clock.Periods(dt.date(2024, 3, 1))
    assert (p.yesterday, p.month_start, p.last_month_start, p.last_month_end) == (
        dt.date(2024, 2, 29), dt.date(2024, 2, 1), dt.date(2024, 1, 1), dt.date(2024, 1, 31),
    )


def test_previous_local_day_is_half_open(table):
    df = table("t:t", [(at(s),) for s in (
        "2024-01-13 18:29:59.999999", "2024-01-13 18:30:00", "2024-01-14 18:29:59.999999", "2024-01-14 18:30:00")])
    kept = df.where(clock.in_previous_local_day(F.col("t"), dt.date(2024, 1, 15)))
    assert [str(r.t) for r in kept.orderBy("t").collect()] == ["2024-01-13 18:30:00", "2024-01-14 18:29:59.999999"]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_clock_readings_do_not_depend_on_the_session_zone(spark, table, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        # 02:30 does not exist in New York on that day.
        df = table("t:t", [(at("2024-03-10 02:30:00.000001"),), (at("1969-12-31 23:59:59"),)])
        back = df.select(clock.micros(F.col("t")), clock.clock_time(clock.event_time(F.col("t"))) == F.col("t"))
        assert tuples(back) == [(-1_000_000, True), (1_710_037_800_000_001, True)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_elapsed_seconds_round_down(table):
    df = table("a:t b:t", [(at("2024-01-01 00:00:00.9"), at("2024-01-01 00:00:02.1")),
                           (at("2024-01-01 00:00:02.1"), at("2024-01-01 00:00:00.9"))])
    assert tuples(df.select(clock.elapsed_seconds(F.col("a"), F.col("b")))) == [(-2,), (1,)]


def test_labels(table):
    df = table("t:t", [(at("2024-04-05 20:59:59"),), (at("2024-11-30 21:00:00"),)])
    got = tuples(df.select(clock.year_month_label(F.col("t")), clock.short_time_text(F.col("t")), clock.office_hours(F.col("t"))))
    assert got == [("2024-11", "Nov 30, 21:00:00", "OFF_HOUR"), ("2024-4", "Apr 05, 20:59:59", "OFFICE_HOUR")]


def test_unreadable_time_is_null(table):
    df = table("x:s", [("2024-01-01",), ("soon",), ("",)])
    assert tuples(df.select(clock.parse_time(F.col("x")).isNull())) == [(False,), (True,), (True,)]
