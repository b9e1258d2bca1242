"""What a run read, published and rejected, counted in the passes that publish.

The counts are metrics of the plan (``DataFrame.observe``): they are taken while the rows go by, so no table is
scanned again for them. A count that several passes could take is that of the first one. A pass that the
optimizer drops because it has no rows to see counts none.
"""

from __future__ import annotations

import threading
from collections.abc import Callable, Mapping
from contextlib import suppress
from dataclasses import dataclass, field

from py4j.protocol import Py4JError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from fieldbook.sources.schemas import RUN_REPORT

READ, PUBLISHED, REJECTED = "read", "published", "rejected"
PATIENCE = 30  # seconds for metrics to arrive after their pass has ended

# (rows, table, conditions by reason) -> the same rows, counted: how many there are, and of how many each condition is true.
Watch = Callable[[DataFrame, str, Mapping[str, Column]], DataFrame]


def unwatched(rows: DataFrame, table: str, reasons: Mapping[str, Column]) -> DataFrame:
    return rows


@dataclass
class RunReport:
    _watched: list[tuple[Observation, str, str, list[str]]] = field(default_factory=list)

    def checked(self, rows: DataFrame, table: str, reasons: Mapping[str, Column]) -> DataFrame:
        """Rows on their way through checks: those read, and of these the rejected ones by reason."""
        return self._watch(rows, table, READ, reasons)

    def published(self, rows: DataFrame, table: str) -> DataFrame:
        return self._watch(rows, table, PUBLISHED, {})

    def _watch(self, rows: DataFrame, table: str, measure: str, reasons: Mapping[str, Column]) -> DataFrame:
        seen = Observation()
        self._watched.append((seen, table, measure, list(reasons)))
        counts = [F.count_if(condition).alias(f"reason{i}") for i, condition in enumerate(reasons.values())]
        return rows.observe(seen, F.count(F.lit(1)).alias("rows"), *counts)

    def rows(self) -> list[tuple[str, str, str | None, int]]:
        """(table, measure, reason, rows); call it when everything is published."""
        out = []
        for seen, table, measure, reasons in self._watched:
            told = _told(seen)
            out.append((table, measure, None, told.get("rows", 0)))
            out += [(table, REJECTED, reason, told.get(f"reason{i}", 0)) for i, reason in enumerate(reasons)]
        return out

    def frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.rows(), RUN_REPORT)


def _told(seen: Observation) -> dict[str, int]:
    found: dict[str, int] = {}

    def wait() -> None:
        with suppress(Py4JError):  # the session may end before a pass that never was
            found.update(seen.get)

    waiting = threading.Thread(target=wait, daemon=True)
    waiting.start()
    waiting.join(PATIENCE)
    return dict(found)
