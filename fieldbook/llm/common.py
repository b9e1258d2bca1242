"""What the operators share: reading the text tables and words as columns."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldbook.session import stored

SCHEMAS = {
    "documents": "doc_id long, text string, lang string, source string, n_chars long",
    "labels": "doc_id long, quality int, toxic int",
    "benchmark": "item_id long, text string",
    "pages": "page_id long, url string, html string",
    "conversations": "conv_id long, turn long, role string, text string",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")


def id_and_text(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Only the two columns an operator works on, so that no other column can clash; a null text is empty."""
    return docs.select(
        F.col(id).cast("long").alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")
    )


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def once(df: DataFrame, purpose: str) -> DataFrame:
    """Written to the shared folder and read again; the shuffle files behind it go as soon as it is written."""
    conf = df.sparkSession.conf
    before = conf.get(CLEANUP, "false")
    conf.set(CLEANUP, "true")
    try:
        return stored(df, purpose)
    finally:
        conf.set(CLEANUP, before)


def free_names(df: DataFrame, *names: str) -> list[str]:
    """The names, changed where the frame has a column called so already."""
    taken, free = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        free.append(name)
    return free


def words(text: Column) -> Column:
    """Runs of anything but ASCII white space, as an array."""
    return F.filter(F.split(text, r"\s+"), lambda w: w != "")


def hashed_words(text: Column) -> Column:
    return F.transform(words(text), lambda w: F.xxhash64(w))


def slices(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Small pieces of the batches, so that a task holds few texts as Python objects at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def clear_of(spans: list[tuple], taken: list[tuple[int, int]]) -> list[tuple]:
    """Of spans (kind, start, end) by start those that overlap none of ``taken``, (start, end) in any order; one walk over both."""
    joined: list[list[int]] = []
    for start, end in sorted(taken):
        if joined and start <= joined[-1][1]:
            joined[-1][1] = max(joined[-1][1], end)
        else:
            joined.append([start, end])
    free, at = [], 0
    for span in spans:
        while at < len(joined) and joined[at][1] <= span[1]:
            at += 1
        if at == len(joined) or span[2] <= joined[at][0]:
            free.append(span)
    return free


def rank_file(path: str) -> dict[bytes, int]:
    """Token bytes and ranks of a file with one base64 token and one rank on each line."""
    import base64

    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}
