import datetime as dt
from decimal import Decimal

import pytest
from conftest import at, tuples
from pyspark.sql import functions as F

from fieldbook import vocabulary as v
from fieldbook.operators.ledger import running_totals
from fieldbook.session import work_folder
from fieldbook.sources.schemas import struct
from fieldbook.streaming import feeds

CALLS = "sid:s call_created_on:t final_status:s"
AUDIT = "customer_id:l rev:s created_on:t"
LEDGER = "transaction_type:s issued_entity_type:s cashback_type:l amount:m created_on:t payment_tag:s"
BAD = v.FAILED_STATUSES[0]

CALL_ROWS = [
    ("a", at("2024-01-01 18:01:00"), BAD), ("b", at("2024-01-01 10:02:00"), BAD), ("c", at("2024-01-01 10:03:00"), "CALL_COMPLETED"),
    ("d", at("2024-01-01 10:31:00"), BAD), ("e", at("2024-01-01 10:09:59"), BAD), ("f", at("2024-01-01 18:00:00"), BAD),
]
AUDIT_ROWS = [
    (1, "1", at("2024-01-05 18:30:00")), (1, "1", at("2024-01-05 18:30:00")), (2, "1", at("2024-01-01 18:29:59")),
    (1, "2", at("2024-01-01 19:00:00")), (2, "1", at("2024-01-01 18:29:59")), (1, "1", at("2024-01-05 18:30:00")),
]
LEDGER_ROWS = [
    (t, v.LOYALTY, 1, Decimal(a), at(f"2024-01-0{d} 1{d}:00:00"), p) for d, t, a, p in (
        (5, "CREDITED", 2, "NA"), (1, "CREDITED", 5, "NA"), (1, "DEBITED", 7, v.PARTIAL_PAYMENT), (2, "CREDITED", 1, "NA"),
        (1, "DEBITED", 9, v.FULL_PAYMENT), (5, "DEBITED", 1, v.FULL_PAYMENT))
]
FEEDS = {
    "counts": (feeds.failed_call_counts(), CALLS, CALL_ROWS), "calls": (feeds.failed_calls(), CALLS, CALL_ROWS),
    "audit": (feeds.audit_rows(), AUDIT, AUDIT_ROWS), "ledger": (feeds.ledger_days(), LEDGER, LEDGER_ROWS),
}


class Run:
    def __init__(self, spark, table, feed, spec, cap):
        self.spark, self.table, self.feed, self.spec, self.cap = spark, table, feed, spec, cap
        self.inbox, self.out, self.state = (work_folder(spark, n) for n in ("in", "out", "state"))
        self.store = feeds.store(spark, feed, self.out, struct(spec))

    def arrive(self, rows):
        self.table(self.spec, rows).coalesce(1).write.mode("append").parquet(self.inbox)

    def drain(self):
        feeds.drain(feeds.file_stream(self.spark, self.inbox, struct(self.spec), "*.parquet", self.cap), self.store, self.state)
        return self

    def published(self):
        """What is published, which is also the answer of all that is stored."""
        self.store.publish()
        told = tuples(self.store.published())
        assert told == tuples(self.store.answer())
        return told


@pytest.mark.parametrize("name", FEEDS)
@pytest.mark.parametrize("cap", [1, 1000])
def test_same_answer_however_files_are_batched(spark, table, name, cap):
    feed, spec, rows = FEEDS[name]
    run = Run(spark, table, feed, spec, cap)
    for row in rows:  # unordered in time, a file each
        run.arrive([row])
    assert run.drain().published() == tuples(feed.batch_twin(table(spec, rows)))


@pytest.mark.parametrize("name", FEEDS)
def test_late_rows_and_restarts_count(spark, table, name):
    feed, spec, rows = FEEDS[name]
    run = Run(spark, table, feed, spec, 1000)
    run.arrive(rows[:2])
    run.drain().drain()
    run.arrive(rows[2:])
    assert run.drain().published() == tuples(feed.batch_twin(table(spec, rows)))


@pytest.mark.parametrize("name", FEEDS)
def test_a_batch_tried_again_counts_once(spark, table, name):
    feed, spec, rows = FEEDS[name]
    run = Run(spark, table, feed, spec, 1000)
    for _ in range(2):
        run.store.save(table(spec, rows[:3]), 0)
    run.store.save(table(spec, rows[3:]), 1)
    assert run.published() == tuples(feed.batch_twin(table(spec, rows)))


def opened(df):
    """Files that a plan reads."""
    return len(df.inputFiles())


@pytest.mark.parametrize("name", FEEDS)
def test_a_poll_replaces_the_parts_it_changes_and_no_others(spark, table, name):
    feed, spec, rows = FEEDS[name]
    if spec == CALLS:
        rows = [*rows, ("z", at("2024-01-02 10:00:00"), BAD)]
    run = Run(spark, table, feed, spec, 1000)
    run.store.save(table(spec, rows), 0)
    all_parts = run.store.publish()
    before = {f: mtime for f, mtime in published_files(spark, run)}
    run.store.save(table(spec, rows[:1]), 1)
    touched = run.store.publish()
    assert len(touched) <= 1 < len(all_parts)
    after = {f for f, _ in published_files(spark, run)}
    folders = {"/".join(p) for p in touched}
    gone = {f for f in before if f not in after}
    assert all(any(folder in f for folder in folders) for f in gone)
    assert run.store.publish() == set() and {f for f, _ in published_files(spark, run)} == after
    assert tuples(run.store.published()) == tuples(feed.batch_twin(table(spec, [*rows, rows[0]])))


def published_files(spark, run):
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet")
    return [(r.path, r.modificationTime) for r in files.load(f"{run.out}/{feeds.PUBLISHED}").select("path", "modificationTime").collect()]


@pytest.mark.parametrize("name", ["counts", "audit"])
def test_ranges_grow_with_the_logarithm_of_the_batches(spark, table, name):
    feed, spec, rows = FEEDS[name]
    run = Run(spark, table, feed, spec, 1000)
    seen = []
    for batch in range(30):
        run.store.save(table(spec, [rows[batch % len(rows)]]), batch)
        if batch % 5 == 4:
            run.store.publish()
            run.store.compact(fanout=3)
            cover = run.store.cover()
            assert sum(r.until - r.since + 1 for r in cover) == batch + 1
            assert all(a.until + 1 == b.since for a, b in zip(cover, cover[1:]))
            assert run.store.complete() and set(run.store.complete()) == set(cover)
            seen.append(len(cover))
    assert max(seen) <= 2 * 4 and opened(run.store.read(run.store.cover())) <= 8 * 6
    assert run.published() == tuples(feed.batch_twin(table(spec, [rows[b % len(rows)] for b in range(30)])))


@pytest.mark.parametrize("name", FEEDS)
def test_a_merge_that_dies_or_is_repeated_counts_every_batch_once(spark, table, name, monkeypatch):
    feed, spec, rows = FEEDS[name]
    run = Run(spark, table, feed, spec, 1000)
    for batch in range(6):
        run.store.save(table(spec, rows[batch : batch + 1]), batch)
    want = run.published()
    with monkeypatch.context() as patch:  # merged, but what it covers stays
        patch.setattr(feeds.Store, "_forget", lambda self: None)
        made = run.store.compact(fanout=3)
    assert made and len(run.store.complete()) > len(run.store.cover()) and run.published() == want
    run.store.files.delete(f"{run.store._folder(made[0])}/{feeds.COMPLETE}")  # died before it was complete
    assert run.published() == want
    assert run.store.compact(fanout=3) and run.published() == want and set(run.store.complete()) == set(run.store.cover())
    # The last batch is tried again after a poll that published nothing of it.
    run.store.save(table(spec, rows[:1]), 6)
    run.store.compact(fanout=3)
    run.store.save(table(spec, rows[:1]), 6)
    assert run.published() == tuples(feed.batch_twin(table(spec, [*rows[:6], rows[0]])))


def test_a_poll_that_dies_while_publishing_is_made_up_for(spark, table, monkeypatch):
    feed, spec, rows = FEEDS["ledger"]
    run = Run(spark, table, feed, spec, 1000)
    run.store.save(table(spec, rows), 0)
    with monkeypatch.context() as patch:
        patch.setattr(feeds.Files, "write", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt))
        with pytest.raises(KeyboardInterrupt):
            run.store.publish()
    assert run.store.noted() == -1
    run.store.save(table(spec, rows[:2]), 1)
    assert run.published() == tuples(feed.batch_twin(table(spec, [*rows, *rows[:2]]))) and run.store.noted() == 1


def test_a_batch_is_compared_with_its_own_parts_of_a_long_history(spark, table, monkeypatch):
    """60 days of 40 customers each; a batch of two revisions opens the parts of two keys only."""
    feed = feeds.audit_rows(buckets=8)
    run = Run(spark, table, feed, AUDIT, 1000)
    history = [(c, str(d), at("2024-01-01 10:00:00") + dt.timedelta(days=d)) for d in range(60) for c in range(40)]
    for batch in range(3):
        run.store.save(table(AUDIT, history[batch::3]), batch)
    everything, seen, read = opened(run.store.read(run.store.cover())), [], feeds.Store.read

    def watched(self, *args):
        seen.append(read(self, *args))
        return seen[-1]

    monkeypatch.setattr(feeds.Store, "read", watched)
    run.store.save(table(AUDIT, [history[7], history[1000], (99, "1", at("2024-01-03 10:00:00"))]), 3)
    # At most a file for each of three ranges in each of three parts.
    assert everything > 500 and len(seen) == 1 and opened(seen[0]) <= 9
    monkeypatch.undo()
    assert len(run.published()) == len(history) + 1
    touched = run.store.parts([feeds.Range(3, 3)])
    assert len(touched) == 1


def test_rows_without_a_time_have_a_part_of_their_own(spark, table):
    for name in ("counts", "audit", "ledger", "calls"):
        feed, spec, rows = FEEDS[name]
        run = Run(spark, table, feed, spec, 1000)
        timeless = [tuple(None if hasattr(value, "hour") else value for value in row) for row in rows[:2]]
        for batch in range(2):
            run.store.save(table(spec, [*rows, *timeless]), batch)
        assert run.published() == tuples(feed.batch_twin(table(spec, [*rows, *timeless] * 2)))


def test_counts_by_hand_and_closed_windows(spark, table):
    rows = feeds.failed_call_counts().batch_twin(table(CALLS, CALL_ROWS))
    told = tuples(feeds.closed(rows, F.col("window_end"), dt.datetime(2024, 1, 1, 12)), "window_start", "calls", "closed")
    assert told == [(at("2024-01-01 10:00:00"), 2, True), (at("2024-01-01 10:30:00"), 1, True), (at("2024-01-01 18:00:00"), 2, False)]


def test_audit_by_hand(spark, table):
    got = tuples(feeds.audit_rows().batch_twin(table(AUDIT, AUDIT_ROWS)).selectExpr("customer_id", "rev", "string(local_day)"))
    assert got == [(1, "1", "2024-01-06"), (1, "2", "2024-01-02"), (2, "1", "2024-01-01")]


def test_ledger_days_equal_the_batch_totals(spark, table):
    ledger = table(LEDGER, LEDGER_ROWS)
    assert tuples(feeds.ledger_days().batch_twin(ledger)) == tuples(running_totals(ledger))


def test_nothing_arrived(spark, table):
    feed, spec, _ = FEEDS["counts"]
    assert Run(spark, table, feed, spec, 1).published() == []
