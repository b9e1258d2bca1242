import datetime as dt
import random

import pytest
from conftest import at, tuples
from pyspark.sql import functions as F

from fieldbook.operators import ranges
from fieldbook.operators.activity import with_next_row
from fieldbook.operators.attribution import attribute
from fieldbook.operators.ranges import later_minima
from fieldbook.plans.campaign_log import CampaignLog, MissingStretch
from fieldbook.session import work_folder
from fieldbook.sources.files import Files

MESSAGES = "k:s sent_on:t campaign:s id:l"
RESPONSES = "k:s sent_on:t id:l channel:s"
SPENDS = "k:s sent_on:t id:l used_on:s creation_type:s"
ABC = ["a", "b", "c"]


def by_hand(messages, responses, spends, rivals):
    """Per message: walk the events in time order, look for a rival in between."""
    def credit(message, events):
        later = sorted((e for e in events if e[0] == message[0] and e[1] > message[1]), key=lambda e: (e[1], e[2]))
        if message[0] is None or not later:
            return None
        first = later[0]
        for other in messages:
            if other[0] == message[0] and other[2] in rivals[message[2]]:
                if message[1] < other[1] <= first[1]:
                    return None
        return first

    out = {}
    for message in messages:
        reply, spend = credit(message, responses), credit(message, spends)
        out[message[3]] = (
            reply is not None, reply and reply[2], spend is not None, spend and spend[2],
        )
    return out


def random_input(seed, size=260, keys=6, instants=25):
    draw = random.Random(seed)
    start = at("2024-01-01 00:00:00")
    rows = []
    for i in range(size):
        key = draw.choice([f"k{n}" for n in range(keys)] + ["k0"] * keys + [None])
        when = start + dt.timedelta(seconds=draw.randrange(instants) * 40)
        rows.append((draw.choice("mmrs"), key, when, i))
    messages = [(k, t, draw.choice(ABC), i) for kind, k, t, i in rows if kind == "m"]
    responses = [(k, t, i, "chat") for kind, k, t, i in rows if kind == "r"]
    spends = [(k, t, i, "VISIT", "") for kind, k, t, i in rows if kind == "s"]
    return messages, responses, spends


@pytest.fixture
def cut(spark):
    """``cut(n)``: later sorts make n ranges, also of few rows."""
    names = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.execution.arrow.maxRecordsPerBatch")
    before = {name: spark.conf.get(name) for name in names}

    def make(n, batch=10_000):
        for name, value in zip(names, (n, "false", batch), strict=True):
            spark.conf.set(name, str(value))

    yield make
    for name, value in before.items():
        spark.conf.set(name, value)


@pytest.fixture
def walked(monkeypatch):
    """What was written of the walks: each plan's frame and the table read back."""
    seen, real = [], ranges.stored

    def stored(df, purpose):
        seen.append((df, real(df, purpose)))
        return seen[-1][1]

    monkeypatch.setattr(ranges, "stored", stored)
    return seen


@pytest.mark.parametrize("many, batch", [(1, 7), (5, 10_000), (40, 3)])
@pytest.mark.parametrize("rivals", ["all", "none", "one"])
def test_against_nested_loops(table, cut, many, batch, rivals):
    cut(many, batch)
    messages, responses, spends = random_input(seed=many * 31 + len(rivals))
    chosen = {
        "all": {c: [o for o in ABC if o != c] for c in ABC},
        "none": {c: [] for c in ABC},
        "one": {"a": ["b"], "b": ["a"], "c": []},
    }[rivals]
    got = attribute(
        table(MESSAGES, messages), table(RESPONSES, responses), table(SPENDS, spends),
        key="k", ts="sent_on", campaign="campaign", id="id", campaigns=ABC,
        rivals=None if rivals == "all" else chosen,
    ).collect()
    found = {r.id: (r.responded, r.response_id, r.used, r.spend_id) for r in got}
    assert found == by_hand(messages, responses, spends, chosen)
    assert len(got) == len(messages)


def run(table, messages, responses=(), spends=()):
    result = attribute(
        table(MESSAGES, messages), table(RESPONSES, list(responses)), table(SPENDS, list(spends)),
        key="k", ts="sent_on", campaign="campaign", id="id", campaigns=ABC,
    )
    return {r.id: r for r in result.collect()}


def test_event_at_message_time_does_not_count(table):
    t0 = at("2024-01-01 10:00:00")
    assert not run(table, [("x", t0, "a", 1)], [("x", t0, 9, "chat")])[1].responded


def test_rival_at_event_time_blocks_and_rival_after_does_not(table):
    t0, t1, t2 = (at(f"2024-01-01 1{h}:00:00") for h in range(3))
    blocked = run(table, [("x", t0, "a", 1), ("x", t1, "b", 2)], [("x", t1, 9, "chat")])
    assert not blocked[1].responded
    free = run(table, [("x", t0, "a", 1), ("x", t2, "b", 2)], [("x", t1, 9, "chat")])
    assert free[1].responded and free[1].channel == "chat"


def test_same_campaign_does_not_compete(table):
    t0, t1, t2 = (at(f"2024-01-01 1{h}:00:00") for h in range(3))
    found = run(table, [("x", t0, "a", 1), ("x", t1, "a", 2)], [], [("x", t2, 9, "VISIT", "NEW")])
    assert found[1].used and found[2].used and found[1].used_on == "VISIT"


def test_missing_number_never_matches_and_is_kept(table):
    t0, t1 = at("2024-01-01 10:00:00"), at("2024-01-01 11:00:00")
    found = run(table, [(None, t0, "a", 1)], [(None, t1, 9, "chat")])
    assert found[1].responded is False and found[1].channel is None


def test_one_key_with_many_rows(spark):
    rows = spark.range(20_000).select(
        F.lit("x").alias("k"),
        (F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(secs=F.col("id").cast("decimal(18,6)"))).alias("sent_on"),
        "id", (F.col("id") % 4).alias("kind"),
    )
    messages = rows.where("kind < 2").withColumn("campaign", F.when(F.col("kind") == 0, "a").otherwise("b"))
    responses = rows.where("kind = 2").withColumn("channel", F.lit("chat"))
    spends = rows.where("kind = 3").select("k", "sent_on", "id", F.lit("V").alias("used_on"), F.lit("").alias("creation_type"))
    got = attribute(
        messages.drop("kind"), responses.drop("kind"), spends, key="k", ts="sent_on",
        campaign="campaign", id="id", campaigns=["a", "b"],
    )
    # Order of kinds is a, b, reply, spend: only b reaches its reply and spend.
    assert tuples(got.groupBy("campaign", "responded", "used").count()) == [
        ("a", False, False, 5000), ("b", True, True, 5000),
    ]


def burst(spark):
    """200,000 rows of one key within 50 seconds, and 50,000 at one instant."""
    even = spark.range(200_000).select(F.lit("x").alias("k"), (F.col("id") * 250).alias("us"), "id")
    pile = spark.range(50_000).select(F.lit("x").alias("k"), F.lit(60_000_000).cast("long").alias("us"), (F.col("id") + 200_000).alias("id"))
    return even.unionByName(pile).withColumn("ts", F.timestamp_micros("us").cast("timestamp_ntz"))


def test_a_burst_and_a_pile_spread_over_ranges(spark, cut, walked):
    cut(16)
    found = later_minima(burst(spark), key="k", ts="ts", marks={"next": F.col("_us")}, keep=["us", "id"])
    assert found.count() == 250_000
    wrong = F.col("next") != F.when(F.col("us") < 49_999_750, F.col("us") + 250).otherwise(60_000_000)
    assert found.where("us < 60000000").where(wrong | F.col("next").isNull()).count() == 0
    assert found.where("us = 60000000 and next is not null").count() == 0
    sizes = [r["count"] for r in walked[0][1].groupBy("_range").count().collect()]
    assert len(sizes) >= 12 and max(sizes) < 40_000
    assert walked[0][1].where(F.col("_role") != ranges.ROW).count() == 3 * len(sizes)


def test_next_rows_over_ranges(spark, cut, walked):
    cut(16)
    found = with_next_row(burst(spark), key="k", ts="ts", id="id", values=["us", "id"])
    assert found.where("id = 249999").select("id_lead", "us_lead").first() == (None, None)
    assert found.where("id < 249999 and (id_lead is null or id_lead <> id + 1 or us_lead < us)").count() == 0
    assert max(r["count"] for r in walked[0][1].groupBy("_range").count().collect()) < 40_000


@pytest.mark.parametrize("many, batch", [(1, 4), (6, 10_000), (50, 2)])
def test_next_rows_against_a_sort(table, cut, many, batch):
    cut(many, batch)
    draw = random.Random(many)
    rows = [(draw.choice(["a", "b", "b", None]), at("2024-01-01 00:00:00") + dt.timedelta(seconds=draw.randrange(30)), i) for i in range(150)]
    want = {}
    for key in ("a", "b"):
        mine = sorted((r for r in rows if r[0] == key), key=lambda r: r[1:])
        want |= {a[2]: (b and b[1], b and b[2]) for a, b in zip(mine, [*mine[1:], None], strict=True)}
    got = with_next_row(table("k:s ts:t id:l", rows), key="k", ts="ts", id="id", values=["ts", "id"]).collect()
    assert {r.id: (r.ts_lead, r.id_lead) for r in got} == want | {r[2]: (None, None) for r in rows if r[0] is None}


def test_other_columns_may_have_any_name_and_type(spark):
    rows = spark.sql("""
        select id, 'x' as k, timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, 0, id) as ts, map('a', id) as _keep, array(id) as _m0,
               cast(id as decimal(9, 2)) as _role, timestamp'2024-01-01' as _range, named_struct('z', id) as _place from range(5)""")
    found = with_next_row(rows, key="k", ts="ts", id="id", values=["_m0", "_place"]).orderBy("id").collect()
    assert [r["_m0_lead"] for r in found] == [[1], [2], [3], [4], None]
    assert [r["_keep"] for r in found] == [{"a": i} for i in range(5)] and found[0]["_place_lead"].z == 1
    empty = later_minima(rows.limit(0), key="k", ts="ts", marks={"next": F.col("_us")}, keep=["id"])
    assert empty.columns == ["id", "next"] and empty.count() == 0


def in_order(spark, table, messages, responses, spends, ends, horizon=None):
    log = CampaignLog(spark, work_folder(spark, "log"), ABC, horizon, key="k")
    feeds = table(MESSAGES, messages), table(RESPONSES, responses), table(SPENDS, spends)
    for start, until in zip(ends, ends[1:], strict=False):
        log.advance(*feeds, start, until)
    return log, feeds


COLUMNS = ("id", "campaign", "k", "responded", "response_id", "channel", "used", "spend_id", "used_on", "creation_type")


@pytest.mark.parametrize("horizon", [None, dt.timedelta(seconds=80), dt.timedelta(seconds=400)])
@pytest.mark.parametrize("stretches", [2, 5])
def test_stretches_give_what_one_run_gives(spark, table, horizon, stretches):
    rows = random_input(seed=stretches, size=300)
    first = at("2024-01-01 00:00:00")
    ends = [first + dt.timedelta(seconds=40 * 25 * i // stretches) for i in range(stretches)] + [at("2024-01-02 00:00:00")]
    log, feeds = in_order(spark, table, *rows, ends, horizon)
    whole = attribute(*feeds, key="k", ts="sent_on", campaign="campaign", id="id", campaigns=ABC, horizon=horizon)
    assert tuples(log.answers(), *COLUMNS) == tuples(whole, *COLUMNS)
    log.advance(*feeds, *ends[-2:])  # run again
    assert tuples(log.answers(), *COLUMNS) == tuples(whole, *COLUMNS) and len(log.stretches()) == stretches


def test_a_horizon_by_hand(table):
    t = [at("2024-01-01 10:00:00") + dt.timedelta(seconds=s) for s in (0, 10, 11)]
    messages = table(MESSAGES, [("x", t[0], "a", 1)])
    for when, credited in ((t[1], True), (t[2], False)):
        found = attribute(
            messages, table(RESPONSES, [("x", when, 9, "chat")]), table(SPENDS, []), key="k", ts="sent_on", campaign="campaign", id="id",
            campaigns=ABC, horizon=dt.timedelta(seconds=10),
        ).first()
        assert found.responded is credited and found.response_id == (9 if credited else None)


def test_only_open_messages_are_carried(spark, table):
    """Of a hundred days, each with an answered message, one that a rival follows and one that stays open for a day."""
    day = dt.timedelta(days=1)
    first = at("2024-01-01 00:00:00")
    hours = lambda d, h: first + d * day + dt.timedelta(hours=h)
    messages, responses = [], []
    for d in range(6):
        messages += [(f"r{d}", hours(d, 1), "a", 10 * d), (f"s{d}", hours(d, 1), "a", 10 * d + 1), (f"s{d}", hours(d, 2), "b", 10 * d + 2)]
        responses.append((f"r{d}", hours(d, 30), 1000 + d, "chat"))
    log, feeds = in_order(spark, table, messages, responses, [], [first + d * day for d in range(7)], 2 * day)
    for end in log.stretches():
        carried = log._read("open", end).count()
        assert carried <= 4  # of r and s messages those of the last two days
    assert {r.id: r.response_id for r in log.answers().where("responded").collect()} == {10 * d: 1000 + d for d in range(5)}
    with pytest.raises(MissingStretch):
        log.advance(*feeds, first + 9 * day, first + 10 * day)
    with pytest.raises(MissingStretch):
        CampaignLog(spark, work_folder(spark, "none"), ABC, key="k").answers()


def test_a_stretch_that_died_is_not_valid(spark, table):
    first, day = at("2024-01-01 00:00:00"), dt.timedelta(days=1)
    messages = [("x", first, "a", 1), ("x", first + day, "a", 2)]
    log, feeds = in_order(spark, table, messages, [("x", first + 1.5 * day, 7, "chat")], [], [first, first + day, first + 2 * day])
    want = tuples(log.answers(), *COLUMNS)
    Files(spark, log.out).delete(f"{log._folder('open', first + 2 * day)}/_SUCCESS")
    assert log.stretches() == [first + day] and {r.id for r in log.answers().collect()} == {1}
    log.advance(*feeds, first + day, first + 2 * day)
    assert tuples(log.answers(), *COLUMNS) == want
