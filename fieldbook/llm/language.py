"""Language ID by compression with one zstandard raw-content dictionary per language.

A text gets the language whose dictionary lets zstandard write it shortest. It is
compressed in pieces of ``PIECE`` bytes, each on its own, so that the dictionary counts all
the way through a long text instead of only at its start; the sizes of all pieces are
added up, so the whole text decides. The score is how much
shorter the winner is than the runner-up, as a share of the runner-up; a narrow margin is a
rejection.

A dictionary is text of a bounded, documented sample of labelled rows: for each language the
``SAMPLE_ROWS`` rows that come first by a hash of their id, ``SAMPLE_CHARS`` characters each.
Dictionaries are cut to one size, that of the smallest among the languages with enough text: ``ENOUGH_BYTES``, or half of what
the best known language has if that is less. A language with less text, say a rare or mistyped label, keeps its smaller
dictionary and takes nothing away from the others. What is kept comes first by the hash, too.
Labels are noisy, so once the dictionaries are made, sampled rows which another language
explains better are taken out and the dictionaries made again.

A null or empty text, or one without a letter, is ``und`` with score 0, and rejected. A tie is settled
by the sizes of the text's different words, each on its own; if that ties too, the language with
the most labelled rows is taken, with score 0. With no labelled rows every text is ``und``.
Repeated rows each give a row, a null id stays null, other columns are left out.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldbook.llm.common import id_and_text, slices

SAMPLE_ROWS = 200
SAMPLE_CHARS = 1000
PIECE = 512
ENOUGH_BYTES = 8_192
# Lazy matching with matches from four bytes tells the languages apart with dictionaries of 10 to 300 KB alike.
PARAMETERS = {
    "strategy": zstandard.STRATEGY_LAZY, "window_log": 20, "hash_log": 17, "chain_log": 17, "search_log": 4, "min_match": 4,
    "write_content_size": False, "write_dict_id": False,
}
MARGIN = 0.004
UNKNOWN = "und"
BETWEEN = re.compile(r"[\W\d_]+").sub


def normal(text: str) -> str:
    """Letters in lower case, anything between them one space."""
    return BETWEEN(" ", text.lower())


def compressors(texts: dict[str, bytes]) -> list[zstandard.ZstdCompressor]:
    made, parameters = [], zstandard.ZstdCompressionParameters(**PARAMETERS)
    for language in texts:
        raw = zstandard.ZstdCompressionDict(texts[language], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        raw.precompute_compress(compression_params=parameters)
        made.append(zstandard.ZstdCompressor(compression_params=parameters, dict_data=raw))
    return made


def sizes(parts: list[bytes], by: list[zstandard.ZstdCompressor]) -> np.ndarray:
    """Compressed bytes of all parts with each dictionary."""
    pieces = [raw[i : i + PIECE] for raw in parts for i in range(0, len(raw), PIECE)]
    return np.array([sum(len(c.compress(piece)) for piece in pieces) for c in by], np.int64)


def judged(text: str, languages: list[str], by: list[zstandard.ZstdCompressor]) -> tuple[str, float]:
    if not languages or not any(map(str.isalpha, text)):
        return UNKNOWN, 0.0
    if len(languages) == 1:
        return languages[0], 1.0
    text = normal(text)
    bytes_by = sizes([text.encode()], by)
    if (bytes_by == bytes_by.min()).sum() > 1:
        bytes_by = sizes([f" {word} ".encode() for word in dict.fromkeys(text.split())], by)
    best, second = np.sort(bytes_by)[:2]
    return languages[int(bytes_by.argmin())], float(second - best) / float(second)


def fit(docs: DataFrame, id: str = "doc_id", text: str = "text", lang: str = "lang") -> dict[str, bytes]:
    """Language -> raw content of its dictionary, from rows with a text and a label; the most frequent language first.

    At most ``SAMPLE_ROWS`` rows of ``SAMPLE_CHARS`` characters per language reach the driver; the number
    of languages is that of the labels in use.
    """
    first = Window.partitionBy("lang").orderBy("order", "text")
    labelled = docs.where(F.col(text).isNotNull() & F.col(lang).isNotNull()).select(
        F.col(lang).cast("string").alias("lang"),
        F.xxhash64(F.col(id)).alias("order"),
        F.substring(F.col(text), 1, SAMPLE_CHARS).alias("text"),
    )
    sample = (
        labelled.withColumn("place", F.row_number().over(first))
        .where(F.col("place") <= SAMPLE_ROWS)
    )
    rows = [(r.lang, r.text) for r in sorted(sample.select("lang", "order", "text").toLocalIterator())]
    texts = gathered(rows)
    if len(texts) > 1:
        by, languages = compressors(texts), list(texts)
        # A row's own text is in its language's dictionary: leave it out by judging with the other half's dictionaries.
        halves = [rows[0::2], rows[1::2]]
        kept = [False] * len(rows)
        for half, other in enumerate(halves[::-1]):
            others = gathered(other)
            by, languages = compressors(others), list(others)
            kept[half::2] = [lang not in others or judged(text, languages, by)[0] in (lang, UNKNOWN) for lang, text in halves[half]]
        texts = {**texts, **gathered([row for row, stays in zip(rows, kept, strict=True) if stays])}
    rows_of = {r.lang: r["count"] for r in labelled.groupBy("lang").count().toLocalIterator()}
    return {lang: texts[lang] for lang in sorted(texts, key=lambda lang: (-rows_of[lang], lang))}


def gathered(rows: list[tuple[str, str]]) -> dict[str, bytes]:
    """Dictionaries of one size where there is enough text, as a longer one would have the better chances; none for a language without letters."""
    texts: dict[str, list[str]] = {}
    for lang, text in rows:
        if any(map(str.isalpha, text)):
            texts.setdefault(lang, []).append(normal(text))
    raw = {lang: "\n".join(parts).encode() for lang, parts in texts.items()}
    known = [len(content) for content in raw.values()]
    enough = min(ENOUGH_BYTES, max(known, default=0) // 2)
    size = min((n for n in known if n >= enough), default=0)
    return {lang: content[:size] for lang, content in raw.items()}


def predict(docs: DataFrame, texts: dict[str, bytes], id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, lang_pred, score, rejected; only the text is looked at."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by, languages = compressors(texts), list(texts)
        for batch in slices(batches):
            found = [judged(value, languages, by) for value in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
                ["doc_id", "lang_pred", "score"],
            )

    told = id_and_text(docs, id, text).mapInArrow(run, "doc_id long, lang_pred string, score double")
    return told.withColumn("rejected", (F.col("lang_pred") == UNKNOWN) | (F.col("score") < MARGIN))


def accepted(docs: DataFrame, texts: dict[str, bytes], text: str = "text") -> DataFrame:
    """The rows, with all their columns, whose language is not rejected."""
    by_name = docs.columns
    place = by_name.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by, languages = compressors(texts), list(texts)
        for batch in slices(batches):
            found = [judged(value or "", languages, by) for value in batch.column(place).to_pylist()]
            yield batch.filter(pa.array([lang != UNKNOWN and score >= MARGIN for lang, score in found], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def held_out(id: Column) -> Column:
    return F.crc32(id.cast("string").cast("binary")) % 4 == 2
