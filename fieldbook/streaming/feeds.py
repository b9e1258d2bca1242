"""Feeds that would otherwise be polled.

A feed turns each batch of arriving rows into rows that can be put together later in any order:
counts and sums of the batch, or its different rows. So the answer depends only on which rows have
arrived, not on how files were cut into batches or in which order they came: there is no watermark, no row
is ever too late, and no state grows in memory. Every window is published, also those that still fill;
``closed`` tells them apart by the reader's clock.

**Stored rows** lie in one folder per range of batches, ``since=a-until=b``, and below it in *parts*: by day, and where
rows are compared by key, by a hash bucket of the keys. A batch that is tried again replaces its own folder, so each row counts once.

**Publishing** looks at the ranges that came since the last time: the names of their parts say which parts of the answer change. Only
those are put together again, from all ranges, and replaced. What was published last is noted after that, so a poll that
died is made up for by the next.

**Compaction** merges ``FANOUT`` neighbouring ranges of one size into one, like the levels of a log-structured store, so the files
of a part grow with the logarithm of the batches. A merged folder counts once it is complete and then hides those it covers;
repeating a merge writes the same folder. Only published ranges are merged, never the batch that may be tried again.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Callable, Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldbook import vocabulary as v
from fieldbook.functions.clock import UTC_OFFSET, clock_time, instant, micros, to_local
from fieldbook.functions.text import MONEY
from fieldbook.operators.ledger import bucket, counted
from fieldbook.sources.files import COMPLETE, Files

CALLS_WIDTH = dt.timedelta(minutes=10)
FANOUT = 8
KEY_BUCKETS = 64
RANGE = re.compile(r"since=(\d+)-until=(\d+)").fullmatch
ROWS, PUBLISHED, NOTED = "rows", "published", "published-until"


def file_stream(
    spark: SparkSession, folder: str, schema: T.StructType, pattern: str = "*", files_per_batch: int = 1000
) -> DataFrame:
    """``files_per_batch`` bounds the work of a batch, not the answer."""
    return (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", pattern)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(folder)
    )


@dataclass(frozen=True)
class Feed:
    """``partial`` makes a batch's rows, ``combine`` puts the rows of several batches together; both have the same columns.

    ``parts`` names the columns that rows are laid out by; rows that ``combine`` brings together have the same. With ``keys``, of the
    rows of one part with the same keys only the first that arrives is stored. ``hidden`` columns aren't part of the answer.
    """

    partial: Callable[[DataFrame], DataFrame]
    combine: Callable[[DataFrame], DataFrame]
    parts: tuple[str, ...]
    keys: tuple[str, ...] = ()
    hidden: tuple[str, ...] = ()

    def batch_twin(self, rows: DataFrame) -> DataFrame:
        """The answer for rows that are all there already."""
        return self.combine(self.partial(rows)).drop(*self.hidden)


@dataclass(frozen=True)
class Range:
    """Batches ``since`` to ``until``, stored in one folder."""

    since: int
    until: int

    @property
    def folder(self) -> str:
        return f"since={self.since}-until={self.until}"


Part = tuple[str, ...]


class Store:
    """What a feed has stored and published below ``out``. ``schema`` is that of its stored rows."""

    def __init__(self, spark: SparkSession, feed: Feed, out: str, schema: T.StructType):
        self.spark, self.feed, self.out, self.schema = spark, feed, out, schema
        self.files = Files(spark, out)

    # ---- stored rows

    def complete(self) -> list[Range]:
        names = [m for m in map(RANGE, self.files.folders(f"{self.out}/{ROWS}")) if m]
        found = [Range(int(m[1]), int(m[2])) for m in names]
        return [r for r in found if self.files.exists(f"{self._folder(r)}/{COMPLETE}")]

    def cover(self) -> list[Range]:
        """The widest complete ranges: each batch once."""
        found: list[Range] = []
        for r in sorted(self.complete(), key=lambda r: (r.since, -r.until)):
            if not found or r.since > found[-1].until:
                found.append(r)
        return found

    def _folder(self, r: Range) -> str:
        return f"{self.out}/{ROWS}/{r.folder}"

    def parts(self, ranges: Iterable[Range]) -> set[Part]:
        """Names of the folders of the parts that these ranges have rows of; no data are read."""
        found: set[Part] = set()
        for r in ranges:
            level: list[Part] = [()]
            for column in self.feed.parts:
                level = [
                    (*at, name) for at in level
                    for name in self.files.folders("/".join([self._folder(r), *at])) if name.startswith(f"{column}=")
                ]
            found.update(level)
        return found

    def read(self, ranges: Iterable[Range], parts: set[Part] | None = None, spark: SparkSession | None = None) -> DataFrame:
        """The rows of these ranges; with ``parts`` only the files of those are opened."""
        spark, frames = spark or self.spark, []
        for r in ranges:
            folder = self._folder(r)
            paths = [folder] if parts is None else [f"{folder}/{'/'.join(p)}" for p in sorted(parts) if self.files.exists(f"{folder}/{'/'.join(p)}")]
            if paths and self.files.folders(folder):
                frames.append(spark.read.schema(self.schema).option("basePath", folder).parquet(*paths).select(*self.schema.names))
        return reduce(DataFrame.unionByName, frames) if frames else spark.createDataFrame([], self.schema)

    def _write(self, rows: DataFrame, r: Range) -> None:
        typed = rows.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in self.schema])
        typed.repartition(*self.feed.parts).write.mode("overwrite").partitionBy(*self.feed.parts).parquet(self._folder(r))

    def save(self, rows: DataFrame, batch: int) -> None:
        made, feed = self.feed.partial(rows), self.feed
        if feed.keys:
            earlier = [r for r in self.cover() if r.until < batch]
            if earlier:
                # Only the parts that this batch touches are opened, and of them only the keys.
                touched = {tuple(map(_named, feed.parts, row)) for row in made.select(*feed.parts).distinct().toLocalIterator()}
                made = _without(made, self.read(earlier, touched, rows.sparkSession), (*feed.parts, *feed.keys))
        self._write(made, Range(batch, batch))

    def compact(self, fanout: int = FANOUT) -> list[Range]:
        """Merge published ranges, level by level; returns the ranges made."""
        made, until, width = [], self.noted(), fanout
        while width <= until + 1:
            cover = self.cover()
            for first in range(0, until + 1 - width + 1, width):
                whole = Range(first, first + width - 1)
                inside = [r for r in cover if whole.since <= r.since and r.until <= whole.until]
                if len(inside) > 1:
                    self._write(self.feed.combine(self.read(inside)), whole)
                    made.append(whole)
            width *= fanout
        self._forget()
        return made

    def _forget(self) -> None:
        """Remove the ranges that a complete wider one covers."""
        cover = self.cover()
        for r in self.complete():
            if r not in cover:
                self.files.delete(self._folder(r))

    # ---- the answer

    def noted(self) -> int:
        """The last batch that is published; -1 at first."""
        return int(self.files.read(f"{self.out}/{NOTED}").strip() or -1)

    def publish(self) -> set[Part]:
        """Replace the parts of the answer that changed since the last time; returns them."""
        cover, done = self.cover(), self.noted()
        fresh = [r for r in cover if r.until > done]
        touched = self.parts(fresh)
        if touched:
            answer = self.feed.combine(self.read(cover, touched))
            answer.repartition(*self.feed.parts).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
                *self.feed.parts
            ).parquet(f"{self.out}/{PUBLISHED}")
        if fresh:
            self.files.write(f"{self.out}/{NOTED}", str(max(r.until for r in fresh)))
        return touched

    def published(self) -> DataFrame:
        """The answer as it was published last."""
        kinds = self.feed.combine(self.spark.createDataFrame([], self.schema)).schema
        if not self.files.folders(f"{self.out}/{PUBLISHED}"):
            return self.spark.createDataFrame([], kinds).drop(*self.feed.hidden)
        rows = self.spark.read.schema(kinds).parquet(f"{self.out}/{PUBLISHED}")
        return rows.select(*[c for c in kinds.names if c not in self.feed.hidden])

    def answer(self) -> DataFrame:
        """The answer for everything stored, put together anew."""
        return self.feed.combine(self.read(self.cover())).drop(*self.feed.hidden)


def _named(column: str, value) -> str:
    """The folder of a part as Spark names it; its columns are dates and whole numbers."""
    return f"{column}={'__HIVE_DEFAULT_PARTITION__' if value is None else value}"


def _without(rows: DataFrame, stored: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Rows whose keys, nulls included, are not stored yet."""
    known = stored.select(*[F.col(k).alias(f"_known_{k}") for k in keys])
    same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_known_{k}")) for k in keys])
    return rows.join(known, same, "left_anti")


def stored_schema(spark: SparkSession, feed: Feed, schema: T.StructType) -> T.StructType:
    """Of the rows a feed stores for input of this schema."""
    return feed.partial(spark.createDataFrame([], schema)).schema


def store(spark: SparkSession, feed: Feed, out: str, schema: T.StructType) -> Store:
    """``schema`` is that of the arriving rows."""
    return Store(spark, feed, out, stored_schema(spark, feed, schema))


def drain(stream: DataFrame, kept: Store, checkpoint: str) -> None:
    """Store everything that has arrived, then stop. A restart goes on where this run ended.

    ``checkpoint`` and the store belong together: batches are numbered by the checkpoint.
    """
    query = (
        stream.writeStream.foreachBatch(kept.save)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def _window(ts: str, width: dt.timedelta) -> tuple[Column, Column]:
    size = int(width.total_seconds() * 1_000_000)
    us = micros(F.col(ts))
    start = us - F.pmod(us, F.lit(size))
    return clock_time(F.timestamp_micros(start)), clock_time(F.timestamp_micros(start + size))


def failed_call_rows(calls: DataFrame) -> DataFrame:
    """Each dropped call as it arrives."""
    return calls.where(F.col("final_status").isin(*v.FAILED_STATUSES))


def failed_calls() -> Feed:
    """Dropped calls, each as often as it arrived."""
    def partial(calls: DataFrame) -> DataFrame:
        return failed_call_rows(calls).withColumn("call_day", F.col("call_created_on").cast("date"))

    return Feed(partial, lambda rows: rows, ("call_day",), hidden=("call_day",))


def failed_call_counts(width: dt.timedelta = CALLS_WIDTH) -> Feed:
    """Dropped calls per tumbling window and status."""
    groups = ("window_start", "window_end", "final_status")

    def partial(calls: DataFrame) -> DataFrame:
        start, end = _window("call_created_on", width)
        windows = failed_call_rows(calls).select(start.alias("window_start"), end.alias("window_end"), "final_status")
        return combine(windows.select("*", F.lit(1).cast("long").alias("calls"), F.col("window_start").cast("date").alias("window_day")))

    def combine(rows: DataFrame) -> DataFrame:
        return rows.groupBy(*groups, "window_day").agg(F.sum("calls").alias("calls"))

    return Feed(partial, combine, ("window_day",), hidden=("window_day",))


def audit_rows(offset: dt.timedelta = UTC_OFFSET, buckets: int = KEY_BUCKETS) -> Feed:
    """Every audit revision once, with the local day it belongs to.

    A repeated delivery carries the same ``created_on`` and so falls on the same day, and into the same bucket of keys.
    """
    keys = ("customer_id", "rev")

    def partial(audit: DataFrame) -> DataFrame:
        day = to_local(F.col("created_on"), offset).cast("date")
        key_bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")
        return audit.withColumns({"local_day": day, "key_bucket": key_bucket}).dropDuplicates(["local_day", *keys])

    return Feed(partial, lambda rows: rows.dropDuplicates(["local_day", *keys]), ("local_day", "key_bucket"), keys, ("key_bucket",))


def ledger_days() -> Feed:
    """Given / used totals per local day and bucket; ``created_on`` is local time."""
    groups = ("day", "transaction_type", "bucket")

    def partial(ledger: DataFrame) -> DataFrame:
        rows = counted(ledger).select(F.col("created_on").cast("date").alias("day"), "transaction_type", bucket().alias("bucket"), "amount")
        return rows.groupBy(*groups).agg(F.sum(F.col("amount").cast(MONEY)).alias("amount"), F.count(F.lit(1)).alias("entries"))

    def combine(rows: DataFrame) -> DataFrame:
        return rows.groupBy(*groups).agg(F.sum("amount").alias("amount"), F.sum("entries").alias("entries"))

    return Feed(partial, combine, ("day",))


def closed(rows: DataFrame, end: Column, clock: dt.datetime) -> DataFrame:
    """With ``closed``: whether the window that ends at ``end`` is over by the reader's clock."""
    return rows.withColumn("closed", end <= instant(clock))
