"""Inputs: files, text sheets and JDBC tables."""

from __future__ import annotations

import datetime as dt
import hashlib
import json
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldbook.functions.clock import UTC_OFFSET, in_local_days
from fieldbook.sources.files import COMPLETE, Files, numbered
from fieldbook.sources.schemas import assert_stored
from fieldbook.sources.writers import BUCKETS, CURRENT, VERSION


def current(spark: SparkSession, path: str) -> str:
    """The folder to read: of a table that is replaced as a whole its current version, else the path itself.

    Should the file that names it be missing, as between the two steps of a rename that isn't atomic, it
    is the newest complete version.
    """
    files = Files(spark, path)
    if not files.is_folder(path):
        return path
    name = files.read(f"{path}/{CURRENT}").strip()
    if not name:
        complete = [v for _, v in numbered(files.folders(path), VERSION) if files.exists(f"{path}/{v}/{COMPLETE}")]
        name = complete[-1] if complete else ""
    return f"{path}/{name}" if name else path


def read_table(
    spark: SparkSession, path: str, schema: T.StructType | None = None, fmt: str = "parquet"
) -> DataFrame:
    """A stored table, in its current version; of a bucketed one with what its buckets save. With ``schema`` the stored columns and types must be exactly those
    declared, which is checked before anything is read."""
    folder = current(spark, path)
    if folder != path and Files(spark, folder).exists(f"{folder}/{BUCKETS}"):
        return read_bucketed(spark, path, schema)
    df = spark.read.format(fmt).load(folder)
    if schema is not None:
        assert_stored(df, schema)
    return df


def read_bucketed(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A table of ``writers.publish_bucketed`` in its current version, with what its buckets save.

    How rows were dealt is told to the session's catalog under a name of the version's own.
    """
    folder = current(spark, path)
    told = json.loads(Files(spark, folder).read(f"{folder}/{BUCKETS}") or "{}")
    if not told:
        raise ValueError(f"{path} is no bucketed table")
    df = spark.read.parquet(folder)
    if schema is not None:
        assert_stored(df, schema)
    name = f"fieldbook_{hashlib.md5(folder.encode()).hexdigest()}"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    where = folder.replace("'", "\\'")
    key = told["key"]
    spark.sql(
        f"create table if not exists {name} ({columns}) using parquet "
        f"clustered by (`{key}`) sorted by (`{key}`) into {told['buckets']} buckets location '{where}'"
    )
    return spark.table(name)


def read_window(
    spark: SparkSession,
    path: str,
    *,
    ts: str,
    first: dt.date,
    last: dt.date,
    offset: dt.timedelta = UTC_OFFSET,
    fmt: str = "parquet",
) -> DataFrame:
    """Rows of the local days first..last; the bounds are pushed into the scan."""
    return spark.read.format(fmt).load(current(spark, path)).where(in_local_days(F.col(ts), first, last, offset))


def read_jdbc(
    spark: SparkSession,
    options: Mapping[str, str],
    table: str,
    *,
    split_on: str,
    lower: int,
    upper: int,
    partitions: int,
) -> DataFrame:
    """A database table read in parallel ranges of a numeric column.

    Connection options (url, user, driver …) belong to the caller.
    """
    return (
        spark.read.format("jdbc")
        .options(**options)
        .option("dbtable", table)
        .option("partitionColumn", split_on)
        .option("lowerBound", lower)
        .option("upperBound", upper)
        .option("numPartitions", partitions)
        .load()
    )


def read_text_sheet(
    spark: SparkSession,
    path: str,
    columns: Mapping[str, str] | Sequence[str],
    multi_line: bool = False,
) -> DataFrame:
    """A sheet exported as CSV: first row is the header and every cell is text.

    ``columns`` lists what is wanted (optionally header → new name); wide sheets lose
    everything else at the scan. A wanted header that the sheet lacks fails. ``multi_line`` is for
    sheets whose cells or headers hold line breaks; such a file cannot be split and is read by one task.
    """
    reader = spark.read.option("header", True).option("multiLine", multi_line)
    sheet = reader.option("escape", '"').csv(current(spark, path))
    wanted = dict(columns) if isinstance(columns, Mapping) else {c: c for c in columns}
    absent = [c for c in wanted if c not in sheet.columns]
    if absent:
        raise ValueError(f"sheet {path} has no columns {absent}")
    return sheet.select(*[F.col(f"`{old}`").alias(new) for old, new in wanted.items()])


def stack(*frames: DataFrame) -> DataFrame:
    """Union by name; a column missing in one frame is NULL there."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out
