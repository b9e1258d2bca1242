"""Distinct users per day as bitmaps, so that overlapping periods are counted without their rows.

Users are numbered as they first appear; a day's users are bitmaps over these numbers, in buckets of 32,768. Merging the bitmaps
of a period's days counts its distinct users exactly, whatever other periods share the days, and a later day is added by
reading that day and the numbers only. Stored below one folder, per *stretch* of days:

- ``numbers/until=…``: the users seen first in it, with their numbers,
- ``sets/until=…/day=…``: per group, day and bucket the users, and those whose first row of the day is in that group,
- ``top/…``: the highest number so far, written last; it makes the stretch valid.

Stretches follow one another. One that is run again replaces what it wrote; those after it must then be run again, too. Rows
without a user or a time count as rows of nobody and are left out.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fieldbook.session import stored
from fieldbook.sources.files import Files

Period = tuple[dt.date, dt.date]


@dataclass(frozen=True)
class UserLog:
    """``groups`` split the counts; ``scope`` names the groups within which a user's first row is looked for (none: all of them)."""

    spark: SparkSession
    out: str
    groups: Sequence[str]
    user: str
    ts: str
    id: str
    scope: Sequence[str] = ()

    # ---- stretches

    def tops(self) -> dict[dt.date, int]:
        """The highest number at the end of each valid stretch."""
        files = Files(self.spark, self.out)
        names = [n.removeprefix("until=") for n in files.folders(f"{self.out}/top")]
        told = {n: files.read(f"{self.out}/top/until={n}/number").strip() for n in names}
        return {dt.date.fromisoformat(n): int(top) for n, top in told.items() if top}

    def add(self, rows: DataFrame, first: dt.date, last: dt.date) -> None:
        """Take in the rows of the days ``first`` to ``last``; every row of these days must be there."""
        earlier = {until: top for until, top in self.tops().items() if until < first}
        base = max(earlier.values(), default=0) + 1  # bitmaps count from one
        day = F.col(self.ts).cast("date")
        mine = rows.where(day.between(F.lit(first), F.lit(last)) & F.col(self.user).isNotNull()).select(
            *self.groups, F.col(self.user).alias("user"), day.alias("day"), F.struct(self.ts, self.id).alias("at")
        )
        # One row per user, group and day goes on from here.
        daily = stored(mine.groupBy(*self.groups, "user", "day").agg(F.min("at").alias("at"), F.count(F.lit(1)).alias("rows")), "daily")
        fresh = daily.select("user").distinct()
        if earlier:
            fresh = fresh.join(self._numbers(earlier), "user", "left_anti")
        made = stored(dense(fresh, base), "numbers")
        made.write.mode("overwrite").parquet(f"{self.out}/numbers/until={last}")
        known = made if not earlier else made.unionByName(self._numbers(earlier))
        own = Window.partitionBy(*self.scope, "user", "day")
        told = daily.withColumn("opens", F.col("at") == F.min("at").over(own)).join(known, "user")
        bit = F.bitmap_bit_position("number")
        sets = told.groupBy(*self.groups, "day", F.bitmap_bucket_number("number").alias("bucket")).agg(
            F.bitmap_construct_agg(bit).alias("users"), F.bitmap_construct_agg(F.when(F.col("opens"), bit)).alias("openers"), F.sum("rows").alias("rows")
        )
        sets.write.mode("overwrite").partitionBy("day").parquet(f"{self.out}/sets/until={last}")
        top = made.agg(F.max("number")).first()[0]
        Files(self.spark, self.out).make(f"{self.out}/top/until={last}")
        Files(self.spark, self.out).write(f"{self.out}/top/until={last}/number", str(base - 1 if top is None else top))

    def _numbers(self, stretches: Mapping[dt.date, int]) -> DataFrame:
        return self.spark.read.parquet(*[f"{self.out}/numbers/until={until}" for until in sorted(stretches)])

    # ---- counts

    def sets(self, first: dt.date, last: dt.date) -> DataFrame:
        """The stored sets of the days ``first`` to ``last``; other days' files are not opened."""
        frames = []
        for until in sorted(self.tops()):
            folder = f"{self.out}/sets/until={until}"
            if Files(self.spark, self.out).folders(folder):
                frames.append(self.spark.read.option("basePath", folder).parquet(folder))
        if not frames:
            raise ValueError("no stretch with rows is complete yet")
        return reduce(DataFrame.unionByName, frames).where(F.col("day").between(F.lit(first), F.lit(last)))

    def _in_periods(self, periods: Mapping[str, Period]) -> DataFrame:
        """The sets once for each period that their day is in."""
        whole = self.sets(min(a for a, _ in periods.values()), max(b for _, b in periods.values()))
        names = [F.when(F.col("day").between(F.lit(a), F.lit(b)), F.lit(name)) for name, (a, b) in periods.items()]
        return whole.withColumn("period", F.explode(F.array_compact(F.array(*names))))

    def counts(self, periods: Mapping[str, Period], groups: Sequence[str] | None = None) -> DataFrame:
        """groups, period, users, rows: distinct users. With fewer ``groups`` the sets of the others are merged as well."""
        by = [*(self.groups if groups is None else groups), "period"]
        merged = self._in_periods(periods).groupBy(*by, "bucket").agg(F.bitmap_or_agg("users").alias("users"), F.sum("rows").alias("rows"))
        return merged.groupBy(*by).agg(F.sum(F.bitmap_count("users")).alias("users"), F.sum("rows").alias("rows"))

    def first_touch(self, periods: Mapping[str, Period]) -> DataFrame:
        """groups, period, users: each user once per period, in the group of their first row of the period.

        A day adds to a group those of its openers whom no earlier day of the period has seen: the merged sets with
        them, less the merged sets without.
        """
        days = self._in_periods(periods)
        place = [*self.scope, "period", "bucket"]
        daily = days.groupBy(*place, "day").agg(F.bitmap_or_agg("users").alias("seen"))
        before = Window.partitionBy(*place).orderBy("day").rowsBetween(Window.unboundedPreceding, -1)
        daily = daily.select(*place, "day", F.bitmap_or_agg("seen").over(before).alias("earlier"))
        rest = [g for g in self.groups if g not in self.scope]
        opened = days.groupBy(*place, *rest, "day").agg(F.bitmap_or_agg("openers").alias("openers")).join(daily, [*place, "day"])
        both = opened.select(*place, *rest, "day", F.bitmap_count("earlier").alias("had"), F.explode(F.array("earlier", "openers")).alias("users"))
        merged = both.groupBy(*place, *rest, "day", "had").agg(F.bitmap_or_agg("users").alias("users"))
        new: Column = F.bitmap_count("users") - F.coalesce("had", F.lit(0))
        return merged.groupBy(*self.groups, "period").agg(F.sum(new).alias("users")).where("users > 0")


def dense(users: DataFrame, base: int) -> DataFrame:
    """user, number: from ``base`` on without a gap, numbered where they lie."""
    placed = stored(users.withColumn("place", F.monotonically_increasing_id()), "placed")
    part = F.shiftright("place", 33)
    sizes = placed.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n"))  # a row for each task
    start = F.coalesce(F.sum("n").over(Window.partitionBy(F.lit(0)).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = F.broadcast(sizes.select("part", start.alias("start")))
    inside = F.col("place") - F.shiftleft("part", 33)
    return placed.withColumn("part", part).join(starts, "part").select("user", (F.lit(base).cast("long") + F.col("start") + inside).alias("number"))
