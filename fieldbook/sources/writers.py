"""Outputs. Every writer can be run again without duplicating rows.

A table that is replaced as a whole has numbered folders, one for each time it was written, and a small file that names the
current one. The file is put in place last, by one atomic rename, so a run that dies between any two steps leaves the
table as it was, and a reader that has begun goes on reading its own folder. ``readers.current`` finds the folder.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldbook.sources.files import Files, numbered
from fieldbook.sources.schemas import conform

RUN_DATE = "run_date"
VERSION, CURRENT, BUCKETS = "v", "CURRENT", "_buckets"


def replace(path: str, df: DataFrame, write: Callable[[str], None]) -> str:
    """Write the next version of the table at ``path`` and make it the current one; returns its folder.

    Versions before the previous one, and folders that runs which died left behind, are removed afterwards, as
    readers may still be at work on the previous version.
    """
    files = Files(df.sparkSession, path)
    last = max([number for number, _ in numbered(files.folders(path), VERSION)], default=0)
    name = f"{VERSION}{last + 1:06}-{uuid.uuid4().hex[:8]}"
    write(f"{path}/{name}")
    before = files.read(f"{path}/{CURRENT}").strip()
    files.write(f"{path}/{CURRENT}", name)
    for _, old in numbered(files.folders(path), VERSION):
        if old not in (name, before) and old < name:
            files.delete(f"{path}/{old}")
    return f"{path}/{name}"


def publish(
    df: DataFrame,
    path: str,
    schema: T.StructType,
    *,
    run_date: dt.date | None = None,
    fmt: str = "parquet",
) -> None:
    """Write the declared layout.

    Without ``run_date`` the table is replaced. With it, only that run's partition is
    replaced: history accumulates, and a rerun of a day leaves one copy of the day.
    """
    out = conform(df, schema)
    if run_date is None:
        replace(path, out, lambda new: out.write.format(fmt).save(new))
        return
    (
        out.withColumn(RUN_DATE, F.lit(run_date))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(RUN_DATE)
        .format(fmt)
        .save(path)
    )


def publish_bucketed(df: DataFrame, path: str, schema: T.StructType, *, key: str, buckets: int | None = None) -> None:
    """Replace a table whose rows are dealt by ``key`` into ``buckets`` (by default as many as the session shuffles over), one file each.

    Tables dealt by their join keys into the same number of buckets are joined, and grouped by these keys, without a shuffle.
    ``readers.read_bucketed`` reads them; read as plain Parquet they are tables like any other.
    """
    spark = df.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    out = conform(df, schema)

    def write(folder: str) -> None:
        name = f"fieldbook_{uuid.uuid4().hex}"
        out.repartition(n, key).write.bucketBy(n, key).sortBy(key).format("parquet").option("path", folder).saveAsTable(name)
        spark.sql(f"drop table {name}")  # the files stay
        Files(spark, folder).write(f"{folder}/{BUCKETS}", json.dumps({"key": key, "buckets": n}))

    replace(path, df, write)


def write_csv(df: DataFrame, path: str, compressed: bool = True) -> None:
    writer = df.write.option("header", True).option("escape", '"')
    if compressed:
        writer = writer.option("compression", "gzip")
    replace(path, df, writer.csv)


def write_sheet(df: DataFrame, path: str) -> None:
    """Replace a sheet export: header plus rows, empty cells for NULL."""
    text = df.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in df.columns])
    replace(path, text, text.write.option("header", True).option("escape", '"').csv)
