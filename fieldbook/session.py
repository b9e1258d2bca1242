"""Session defaults and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# A hot key of a join is split over several tasks at run time, also where the split costs
# one more shuffle because the join feeds an aggregate on the same key.
SKEW_JOIN = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

DEFAULTS = {
    **SKEW_JOIN,
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.ui.enabled": "false",
}


# Paths by application, in the order they were written.
_WRITTEN: dict[str, list[str]] = {}


def build_session(app: str = "fieldbook", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def split_skewed_joins(spark: SparkSession) -> SparkSession:
    """Turn on, in a session made elsewhere, what the plans rely on for hot join keys."""
    for name, value in SKEW_JOIN.items():
        spark.conf.set(name, value)
    return spark


class NoSharedFolder(RuntimeError):
    pass


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below the shared ``spark.checkpoint.dir``, which the session must name.

    Only a local session, whose driver and executors are one process, gets a temporary folder
    if it names none. On a cluster executors would each write to a disk of their own and later reads
    would miss files, so there a missing setting ends the run.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise NoSharedFolder("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="fieldbook-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` to the shared folder once and go on from the written table.

    For a result that several later steps read: it is computed once, and a lost executor
    costs a re-read instead of the whole lineage. ``intermediates`` removes what a finished job wrote.
    """
    spark = df.sparkSession
    path = work_folder(spark, purpose)
    df.write.parquet(path)
    _WRITTEN.setdefault(spark.sparkContext.applicationId, []).append(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def intermediates(spark: SparkSession) -> Iterator[None]:
    """Removes, at its end, the tables that ``stored`` wrote inside; nothing may read them afterwards."""
    written = _WRITTEN.setdefault(spark.sparkContext.applicationId, [])
    before = len(written)
    try:
        yield
    finally:
        for path in written[before:]:
            where = spark._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
        del written[before:]
