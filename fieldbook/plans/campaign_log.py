"""Answers to campaign messages, kept up from one stretch of time to the next.

A stretch reads its own messages and events, and of all earlier messages only the *open* ones, whose answer may
still change. Open messages are those nobody has answered yet and that are no older than the horizon, so what a
stretch reads doesn't grow with history. Stored below one folder, per stretch:

- ``closed/until=…``: messages whose answer became final in it,
- ``open/until=…``: messages still open at its end, with the answer so far.

``open`` is written last and makes the stretch valid. A stretch that is run again replaces both; those after it must
then be run again as well, in order.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldbook.operators.attribution import OPEN, carry_on
from fieldbook.session import stored
from fieldbook.sources.files import COMPLETE, Files
from fieldbook.sources.readers import stack

CLOSED, STILL_OPEN = "closed", "open"
LABEL = "%Y%m%dT%H%M%S"


class MissingStretch(RuntimeError):
    pass


@dataclass(frozen=True)
class CampaignLog:
    """``key``, ``ts``, ``campaign`` and ``id`` name the columns of messages and events."""

    spark: SparkSession
    out: str
    campaigns: Sequence[str]
    horizon: dt.timedelta | None = None
    key: str = "phone"
    ts: str = "sent_on"
    campaign: str = "campaign"
    id: str = "id"

    def _folder(self, kind: str, until: dt.datetime) -> str:
        return f"{self.out}/{kind}/until={until.strftime(LABEL)}"

    def stretches(self) -> list[dt.datetime]:
        """The ends of the stretches that are complete, ascending."""
        files, top = Files(self.spark, self.out), f"{self.out}/{STILL_OPEN}"
        names = [n for n in files.folders(top) if files.exists(f"{top}/{n}/{COMPLETE}")]
        return sorted(dt.datetime.strptime(n.removeprefix("until="), LABEL) for n in names)

    def advance(self, messages: DataFrame, responses: DataFrame, spends: DataFrame, start: dt.datetime, until: dt.datetime) -> None:
        """Take in the rows of [start, until). ``start`` is the end of an earlier stretch, unless this is the first one."""
        done = self.stretches()
        if any(end < until for end in done) and start not in done:
            raise MissingStretch(f"no stretch ends at {start}; there are {done}")
        carried = self._read(STILL_OPEN, start) if start in done else None
        inside = (F.col(self.ts) >= F.lit(start).cast("timestamp_ntz")) & (F.col(self.ts) < F.lit(until).cast("timestamp_ntz"))
        rows = stored(carry_on(
            carried, *[df.where(inside) for df in (messages, responses, spends)], until=until, key=self.key, ts=self.ts,
            campaign=self.campaign, id=self.id, campaigns=self.campaigns, horizon=self.horizon,
        ), "stretch")
        still = F.col(OPEN[0]) | F.col(OPEN[1])
        rows.where(~still).drop(*OPEN).write.mode("overwrite").parquet(self._folder(CLOSED, until))
        rows.where(still).write.mode("overwrite").parquet(self._folder(STILL_OPEN, until))

    def _read(self, kind: str, until: dt.datetime) -> DataFrame:
        return self.spark.read.parquet(self._folder(kind, until))

    def answers(self) -> DataFrame:
        """Every message once, as far as its answer is known at the end of the last stretch."""
        done = self.stretches()
        if not done:
            raise MissingStretch("no stretch is complete yet")
        last = self._read(STILL_OPEN, done[-1]).drop(*OPEN)
        return stack(*[self._read(CLOSED, end) for end in done], last)
