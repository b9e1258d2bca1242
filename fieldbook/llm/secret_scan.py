"""Secret scan: wide candidate patterns, then a random forest that takes out false positives.

1. ``corpus_statistics``: one pass over all texts counts the transitions between neighbouring
   bytes and the short words; the ``DICTIONARY`` most frequent words are the dictionary.
2. ``candidates``: known key formats (of a PEM key all of it, if its end is there), values assigned to names that
   contain a word like *password* with any number of blanks around the sign (in quotes up to the closing one), and any long
   token with a digit in it; keys without a fixed length may be of any. Each gets its features: length, transitions (how likely its bytes follow
   each other in the corpus, how often letters, capitals, digits and signs take turns), how much
   of it dictionary words cover, the document's path, and the neighbouring words.
3. ``train``: a random forest on labelled findings (candidates with a 0 or 1), at most
   ``LABELLED`` of them, first by a hash.
4. ``scan``: scores every candidate; a score of 0.5 or more is a secret.

Where no reviewed findings are at hand, ``reviewed`` labels those that need no review: a key of a known
format or an assigned random value is a secret; a mail address, a dotted or plain number, or a token made of dictionary
words isn't. What it can't tell gets no label, and the forest decides.

Null and empty texts have no candidates. Repeated documents have the same findings, given once per id and
text. A null id or path is allowed. Other columns are left out. With labels of a single class, and for kinds of
candidates without labels, there is nothing to learn: the pattern's verdict stands, by which a format or an assigned value is a
secret and any other token isn't. Positions are code points.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldbook.llm.common import clear_of, free_names, slices
from fieldbook.session import stored

DICTIONARY = 4_000
LABELLED = 20_000
TREES, DEPTH, SEED = 40, 8, 7
LEAST = 14

# Formats of keys.
FORMATS = {
    "aws": r"(?:AKIA|ASIA)[0-9A-Z]{16}",
    "github": r"gh[pousr]_[A-Za-z0-9]{36}",
    "slack": r"xox[abprs]-[A-Za-z0-9-]{10,}+",
    "google": r"AIza[0-9A-Za-z_-]{35}",
    "stripe": r"[sr]k_(?:live|test)_[0-9A-Za-z]{16,}+",
    "private_key": r"-----BEGIN (?:[A-Z]{2,10} )?PRIVATE KEY-----(?:(?:\s*+[A-Za-z-]++: [^\n]*+)*+[\sA-Za-z0-9+/=\\]*+-----END (?:[A-Z]{2,10} )?PRIVATE KEY-----)?",
}
NAMES = r"password|passwd|passphrase|pwd|secret|token|api[_-]?key|access[_-]?key|auth[_-]?key|client[_-]?secret|credential"
FORMAT = re.compile("(?<![A-Za-z0-9])(?:" + "|".join(f"(?P<{name}>{form})" for name, form in FORMATS.items()) + ")(?![A-Za-z0-9])").finditer
# Three parts of any length. Whether a run of the first part's characters is followed by two more is told once, at the run's start:
# told again at every eyJ within the run, the time would grow with the square of its length.
PART = "[A-Za-z0-9_-]"
JWT = re.compile(
    rf"(?<!{PART})(?={PART}{{11,}}+\.{PART}{{8,}}+\.{PART}{{8}}){PART}*?(?<![A-Za-z0-9])(?P<jwt>eyJ{PART}{{8,}}+\.{PART}{{8,}}+\.{PART}{{8,}}+)"
).finditer
# A name and a sign; the name is told once, at its start.
SETTING = re.compile(r"(?<![A-Za-z0-9_-])(?P<name>[A-Za-z0-9_-]++)[\"']?[ \t]*+(?:=>|:=|=|:)[ \t]*+").finditer
SENSITIVE = re.compile(NAMES, re.I).search
# A value in quotes goes on to the closing one; without quotes it ends at a comma, or if little stands before that, at a blank.
QUOTED = {q: re.compile(rf"{q}(?P<value>(?:[^{q}\\\n]|\\.){{6,}}+){q}").match for q in "\"'"}
PLAIN = re.compile(r"[\"']?(?P<value>[^\s\"',;<>(){}]{6,}|[^\s\"'<>(){}]{6,})").match
TOKEN = re.compile(r"[A-Za-z0-9+/=_.@-]{14,}").finditer
WORDS = re.compile(r"(?<![^\W\d_])[^\W\d_]{2,6}(?![^\W\d_])").findall
NEIGHBOUR = re.compile(r"[^\W_]+").findall
EXAMPLE = re.compile(r"test|example|sample|mock|fixture|demo|doc", re.I).search
CUE = re.compile(NAMES + "|key|login|credentials", re.I).search
BUCKETS = 8

FINDING = "doc_id long, text_hash long, kind string, start int, end int, value string, features array<double>"


def text_key(text: Column) -> Column:
    """Tells apart the texts of rows that share an id."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


class Statistics:
    """Transition costs between bytes and the dictionary, both of bounded size."""

    def __init__(self, transitions: np.ndarray, words: list[str]):
        counts = transitions.reshape(256, 256) + 0.1
        self.cost = -np.log2(counts / counts.sum(1, keepdims=True)).astype(np.float32)
        self.words = frozenset(w for w in words if len(w) > 2)

    def surprise(self, value: str) -> float:
        """Mean bits a transition costs."""
        raw = np.frombuffer(value.lower().encode(), np.uint8)
        return float(self.cost[raw[:-1], raw[1:]].mean()) if len(raw) > 1 else 0.0

    def coverage(self, value: str) -> float:
        """Share of the characters that dictionary words cover, the longest first from the left."""
        value, at, covered = value.lower(), 0, 0
        while at < len(value):
            size = next((n for n in range(6, 2, -1) if value[at : at + n] in self.words), 0)
            covered += size
            at += size or 1
        return covered / max(len(value), 1)


def corpus_statistics(docs: DataFrame, text: str = "text") -> Statistics:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: Counter[str] = Counter()
        pairs = np.zeros(65536, np.int64)
        for batch in slices(batches, 64):
            joined = "\n".join(filter(None, batch.column(0).to_pylist())).lower()
            raw = np.frombuffer(joined.encode(), np.uint8).astype(np.int64)
            pairs += np.bincount(raw[:-1] * 256 + raw[1:], minlength=65536) if len(raw) > 1 else 0
            words.update(WORDS(joined))
        used = np.flatnonzero(pairs)
        yield pa.RecordBatch.from_arrays(
            [pa.array([None] * len(words) + used.tolist(), pa.int32()), pa.array(list(words) + [""] * len(used), pa.string()),
             pa.array(list(words.values()) + pairs[used].tolist(), pa.int64())], ["pair", "word", "n"],
        )

    counts = stored(
        docs.select(F.col(text).cast("string")).mapInArrow(count, "pair int, word string, n long").groupBy("pair", "word").agg(F.sum("n").alias("n")),
        "secret-counts",
    )
    transitions = np.zeros(65536)
    for row in counts.where("pair is not null").toLocalIterator():  # at most one for each pair of bytes
        transitions[row.pair] = row.n
    words = counts.where("pair is null").orderBy(F.desc("n"), "word").limit(DICTIONARY)
    return Statistics(transitions, [row.word for row in words.toLocalIterator()])


def settings(text: str) -> Iterator[tuple[str, int, int]]:
    """Values assigned to sensitive names; a name inside such a value is part of it."""
    until = 0
    for match in SETTING(text):
        if match.start() < until or not SENSITIVE(match["name"]):
            continue
        quoted = QUOTED.get(text[match.end() : match.end() + 1])
        value = (quoted and quoted(text, match.end())) or PLAIN(text, match.end())
        if value:
            until = value.end()
            yield "assigned", *value.span("value")


def found(text: str) -> list[tuple[str, int, int]]:
    """Candidates of a text as (kind, start, end); of overlapping ones the first kind stays. The time grows with the text's length."""
    formats: list[tuple[str, int, int]] = [(m.lastgroup, *m.span()) for m in FORMAT(text)]
    if "eyJ" in text:
        formats += [("jwt", *m.span("jwt")) for m in JWT(text)]
    kept: list[tuple[str, int, int]] = []
    for span in sorted(formats, key=lambda c: c[1]):
        if not kept or span[1] >= kept[-1][2]:
            kept.append(span)
    if "=" in text or ":" in text:
        kept += clear_of(list(settings(text)), [s[1:] for s in kept])
    tokens = [("token", *m.span()) for m in TOKEN(text) if any(map(str.isdigit, m.group()))]
    kept += clear_of(tokens, [s[1:] for s in kept])
    return sorted(kept, key=lambda c: c[1:])


def turns(value: str) -> float:
    """How often letters, capitals, digits and signs take turns, per character."""
    kinds = [0 if c.islower() else 1 if c.isupper() else 2 if c.isdigit() else 3 for c in value]
    return sum(a != b for a, b in zip(kinds, kinds[1:], strict=False)) / max(len(kinds) - 1, 1)


def entropy(value: str) -> float:
    return -sum(n / len(value) * math.log2(n / len(value)) for n in Counter(value).values())


def lead(text: str, start: int) -> str:
    """The last 40 characters before a position, where a run of blanks counts as one, so that aligned settings look like others."""
    near = text[max(0, start - 40) : start]
    if "  " not in near and "\t" not in near:
        return near
    kept: list[str] = []
    while start > 0 and len(kept) < 40:
        start -= 1
        blank = text[start] in " \t"
        if not (blank and kept and kept[-1] == " "):
            kept.append(" " if blank else text[start])
    return "".join(reversed(kept))


def features(text: str, start: int, end: int, path: str | None, known: Statistics) -> list[float]:
    value, path = text[start:end], path or ""
    leading = lead(text, start)
    before, after = NEIGHBOUR(leading), NEIGHBOUR(text[end : end + 40])
    shape = value.strip("=")
    near = [0.0] * BUCKETS
    for word in before[-2:]:
        near[crc32(word.lower().encode()) % BUCKETS] = 1.0
    return [
        float(min(len(value), 200)),
        known.surprise(value),
        known.coverage(value),
        turns(value),
        entropy(value),
        sum(map(str.isdigit, shape)) / len(value),
        sum(map(str.isupper, shape)) / len(value),
        float(all(c in "0123456789abcdef" for c in shape)),
        float(len(set(value)) / len(value)),
        float("@" in value),
        float(bool(EXAMPLE(path))),
        float(path.count("/") + path.count("\\")),
        float(crc32(path.rpartition(".")[2].encode()) % BUCKETS) if "." in path else -1.0,
        float(bool(before and CUE(before[-1]))),
        float(any(map(CUE, before))),
        float(leading[-3:].strip(" \"'")[-1:] in ("=", ":")),
        np.mean([known.coverage(w) for w in before[-3:]]) if before else -1.0,
        np.mean([known.coverage(w) for w in after[:3]]) if after else -1.0,
        *near,
    ]


def candidates(docs: DataFrame, known: Statistics, id: str = "doc_id", text: str = "text", path: str = "source") -> DataFrame:
    """One row per candidate of each different id and text, with its features; written once, as training and scoring both read it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows: list[dict] = []
            for doc, key, value, where in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                rows += [
                    {"doc_id": doc, "text_hash": key, "kind": kind, "start": start, "end": end, "value": value[start:end],
                     "features": features(value, start, end, where, known)}
                    for kind, start, end in found(value)
                ]
            yield pa.RecordBatch.from_pylist(rows, SCHEMA)

    texts = docs.select(
        F.col(id).cast("long").alias("doc_id"), text_key(F.col(text)).alias("text_hash"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"), F.col(path).cast("string").alias("path"),
    )
    each = texts.mapInArrow(run, FINDING)
    return stored(each.dropDuplicates(["doc_id", "text_hash", "start", "end"]), "secret-candidates")


SCHEMA = pa.schema([
    ("doc_id", pa.int64()), ("text_hash", pa.int64()), ("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()),
    ("value", pa.string()), ("features", pa.list_(pa.float64())),
])


def reviewed(findings: DataFrame) -> DataFrame:
    """Findings with a label where the pattern leaves no doubt: a format, a random assigned value; mail, numbers, words."""
    value, feature = F.col("value"), F.col("features")
    random = value.rlike(r"^[0-9a-fA-F]{16,}$") | (value.rlike("[0-9]") & value.rlike("[a-z]") & value.rlike("[A-Z]") & (feature[4] > 3.5))
    secret = ~F.col("kind").isin("assigned", "token") | ((F.col("kind") == "assigned") & random)
    harmless = value.rlike(r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+\.?$") | value.rlike(r"^[0-9./_:+=-]+$") | (feature[2] > 0.8)
    label = F.when(secret, 1.0).when((F.col("kind") == "token") & harmless, 0.0)
    return findings.withColumn("label", label).where(F.col("label").isNotNull())


@dataclass(frozen=True)
class Forest:
    """A model, None where the labels were of a single class, and the kinds of candidates it has learned from."""

    model: RandomForestClassificationModel | None
    kinds: tuple[str, ...] = ()


def train(labelled: DataFrame) -> Forest:
    sample = (
        labelled.select("kind", "features", F.col("label").cast("double").alias("label"), F.xxhash64("doc_id", "start", "value").alias("order"))
        .orderBy("order").limit(LABELLED)
    )
    sample = stored(sample.select("kind", array_to_vector("features").alias("features"), "label"), "secret-labels")
    seen = sample.select("kind", "label").distinct().collect()  # two labels of a few kinds
    if len({row.label for row in seen}) < 2:
        return Forest(None)
    classifier = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED, featuresCol="features", labelCol="label")
    return Forest(classifier.fit(sample), tuple(sorted({row.kind for row in seen})))


def scored(findings: DataFrame, forest: Forest) -> DataFrame:
    """Findings with ``score`` and ``is_secret``. What the forest has learned nothing about keeps its pattern's verdict."""
    by_pattern = F.when(F.col("kind") == "token", 0.0).otherwise(1.0)
    if forest.model is None:
        told = findings.withColumn("score", by_pattern)
    else:
        told = forest.model.transform(findings.withColumn("features", array_to_vector("features")))
        told = told.withColumn("score", F.when(F.col("kind").isin(*forest.kinds), vector_to_array("probability")[1]).otherwise(by_pattern))
    return told.select("doc_id", "text_hash", "kind", "start", "end", "value", "score", (F.col("score") >= 0.5).alias("is_secret"))


def scan(docs: DataFrame, id: str = "doc_id", text: str = "text", path: str = "source") -> DataFrame:
    """All candidates with their verdict, the forest being trained on those that need no review."""
    findings = candidates(docs, corpus_statistics(docs, text), id, text, path)
    return scored(findings, train(reviewed(findings)))


def redacted(docs: DataFrame, secrets: DataFrame, mask: str = "[secret]") -> DataFrame:
    """Documents, all columns, with the secrets of their text replaced by ``mask`` and ``n_chars`` brought up to date."""
    key, id, hash, found = free_names(docs, "key", "id", "hash", "spans")
    spans = secrets.where("is_secret").groupBy("doc_id", "text_hash").agg(
        F.array_sort(F.collect_list(F.struct("start", "end"))).alias(found)
    ).select(F.col("doc_id").alias(id), F.col("text_hash").alias(hash), found)
    keyed = docs.withColumn(key, text_key(F.col("text")))
    joined = keyed.join(spans, keyed["doc_id"].eqNullSafe(spans[id]) & (keyed[key] == spans[hash]), "left")
    # What stands between the spans, put together with the mask; a span's start and end count code points.
    ends = F.concat(F.array(F.lit(0)), F.transform(found, lambda s: s["end"]))
    starts = F.concat(F.transform(found, lambda s: s["start"]), F.array(F.char_length("text")))
    pieces = F.transform(
        F.arrays_zip(ends.alias("a"), starts.alias("b")), lambda p: F.substring(F.col("text"), p["a"] + 1, F.greatest(p["b"] - p["a"], F.lit(0)))
    )
    cleaned = F.when(F.col(found).isNull(), F.col("text")).otherwise(F.array_join(pieces, mask))
    out = joined.withColumn("text", cleaned)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col(found).isNull(), F.col("n_chars")).otherwise(F.char_length("text").cast("long")))
    return out.select(*docs.columns)
