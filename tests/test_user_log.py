"""Distinct users by merged bitmaps, against sets in memory."""

import datetime as dt
import random
from collections import defaultdict

import pytest
from conftest import at, tuples
from pyspark.sql import functions as F

from fieldbook.plans.user_log import UserLog, dense
from fieldbook.session import work_folder
from fieldbook.sources.files import Files

ROWS = "campaign:s split:s who:s ts:t id:l"
FIRST = dt.date(2024, 1, 1)
DAYS = [FIRST + dt.timedelta(days=d) for d in range(12)]
PERIODS = {"day": (DAYS[3], DAYS[3]), "week": (DAYS[2], DAYS[8]), "all": (DAYS[0], DAYS[11]), "none": (dt.date(2025, 1, 1), dt.date(2025, 1, 2))}


def random_rows(seed, n=400, people=60):
    draw = random.Random(seed)
    return [
        (draw.choice("ab"), draw.choice("xyz"), draw.choice([None, *[f"u{draw.randrange(people)}" for _ in range(9)]]),
         at("2024-01-01 00:00:00") + dt.timedelta(hours=draw.randrange(12 * 24)), i)
        for i in range(n)
    ]


def log_of(spark, **options):
    return UserLog(spark, work_folder(spark, "users"), ["campaign", "split"], "who", "ts", "id", **options)


def by_hand(rows, scope):
    users, rows_in, firsts = defaultdict(set), defaultdict(int), {}
    for campaign, split, who, ts, id in rows:
        for name, (a, b) in PERIODS.items():
            if who is not None and a <= ts.date() <= b:
                users[campaign, split, name].add(who)
                rows_in[campaign, split, name] += 1
                key = (name, who, campaign if scope else None)
                found = ((ts, id), (campaign, split))
                firsts[key] = min(firsts.get(key, found), found)
    touched = defaultdict(int)
    for (name, _, _), (_, group) in firsts.items():
        touched[(*group, name)] += 1
    counts = sorted(((*k, len(v), rows_in[k]) for k, v in users.items()), key=repr)
    return counts, sorted(((*k, n) for k, n in touched.items()), key=repr)


@pytest.mark.parametrize("scope", [(), ("campaign",)])
@pytest.mark.parametrize("cuts", [[11], [0, 5, 11], [3, 4, 9, 11]])
def test_counts_and_first_touch(spark, table, scope, cuts):
    rows = random_rows(len(cuts) + len(scope))
    log, frame, start = log_of(spark, scope=scope), table(ROWS, rows), 0
    for end in cuts:
        log.add(frame, DAYS[start], DAYS[end])
        start = end + 1
    counts, touched = by_hand(rows, scope)
    assert tuples(log.counts(PERIODS), "campaign", "split", "period", "users", "rows") == counts
    assert tuples(log.first_touch(PERIODS), "campaign", "split", "period", "users") == touched
    merged = {(r.campaign, r.period): r.users for r in log.counts(PERIODS, ["campaign"]).collect()}
    assert merged["a", "all"] == len({r[2] for r in rows if r[0] == "a"} - {None})


def test_a_later_day_reads_neither_earlier_rows_nor_their_sets(spark, table):
    rows = random_rows(5)
    log = log_of(spark)
    early, late = ([r for r in rows if (r[3].date() <= DAYS[8]) is early] for early in (True, False))
    log.add(table(ROWS, early), DAYS[0], DAYS[8])
    Files(spark, log.out).delete(f"{log.out}/sets/until={DAYS[8]}/day={DAYS[4]}")  # a set that is gone isn't missed by later days
    log.add(table(ROWS, late), DAYS[9], DAYS[11])
    want = {r[2] for r in late if r[0] == "b"} - {None}
    assert {r.users for r in log.counts({"late": (DAYS[9], DAYS[11])}, ["campaign"]).where("campaign = 'b'").collect()} == {len(want)}
    days = {f.rsplit("day=", 1)[1][:10] for f in log.sets(DAYS[10], DAYS[11]).select("users").inputFiles()}
    assert days


def test_a_stretch_run_again_and_one_that_died(spark, table, monkeypatch):
    rows = random_rows(6)
    log, frame = log_of(spark), table(ROWS, rows)
    log.add(frame, DAYS[0], DAYS[5])
    with monkeypatch.context() as patch:
        patch.setattr(Files, "write", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt))
        with pytest.raises(KeyboardInterrupt):
            log.add(frame, DAYS[6], DAYS[11])
    assert list(log.tops()) == [DAYS[5]]
    for _ in range(2):
        log.add(frame, DAYS[6], DAYS[11])
    assert tuples(log.counts(PERIODS), "campaign", "split", "period", "users", "rows") == by_hand(rows, ())[0]
    numbers = [r.number for r in log._numbers(log.tops()).collect()]
    assert sorted(numbers) == list(range(1, len(numbers) + 1)) and max(log.tops().values()) == len(numbers)


def test_numbers_over_many_tasks_and_buckets(spark):
    users = spark.range(0, 100_000, 1, 7).select(F.concat(F.lit("u"), "id").alias("user"))
    made = dense(users, 5)
    told = made.agg(F.min("number"), F.max("number"), F.count_distinct("number")).first()
    assert tuple(told) == (5, 100_004, 100_000)
    log = UserLog(spark, work_folder(spark, "many"), ["g"], "user", "ts", "id")
    rows = users.select("user", F.lit("g").alias("g"), F.lit(at("2024-01-01 10:00:00")).cast("timestamp_ntz").alias("ts"), F.lit(1).alias("id"))
    log.add(rows.unionByName(rows), FIRST, FIRST)
    assert tuples(log.counts({"d": (FIRST, FIRST)})) == [("g", "d", 100_000, 200_000)]
    assert log.sets(FIRST, FIRST).count() == 4


def test_no_rows(spark, table):
    log = log_of(spark)
    with pytest.raises(ValueError, match="no stretch"):
        log.counts(PERIODS)
    log.add(table(ROWS, []), DAYS[0], DAYS[1])
    log.add(table(ROWS, random_rows(1)), DAYS[2], DAYS[11])
    assert log.counts({"x": (DAYS[0], DAYS[1])}).count() == 0 and log.counts(PERIODS).count() > 0
