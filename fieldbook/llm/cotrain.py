"""Quality of documents by co-training a view of the text and a view of the page's metadata.

Both views are logistic models. In each round every view scores a pool of unlabelled documents, and
those it is surest of are added, with the class it gives them, to what the other view learns
from. A view passes on labels only above the confidence at which it is right on
labelled rows that it hasn't seen (``PRECISION``), and at most ``PASS_ON`` a round and class, so a weak
view passes on little or nothing.

At the end both views are calibrated on held-back labelled rows, and a small logistic model over the two
calibrated log-odds, fitted on those rows too, combines them. Every document is scored from
its whole text and its metadata.

Learning is bounded: ``LABELLED`` labelled and ``POOL`` unlabelled documents, those first by a hash of their
id. Of these only feature vectors reach the driver. Scoring is one pass over the texts; the
join with the pages moves no text.

Metadata are source, language, stated length and the page's address. A document without a page has that
as a feature. Null and empty texts, and null metadata, are features too. Without labels of
both classes every score is 0.5. A document is kept if its score is 0.5 or more. A label row without
quality counts as no label; several label rows of an id count with their mean. Repeated
documents each give a row; a null id stays null and has no page.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldbook.llm.common import slices

LABELLED = 20_000
POOL = 20_000
ROUNDS = 4
PASS_ON = 500
PRECISION = 0.97
HOST_BUCKETS = 64
SOURCE_BUCKETS = 64
LANG_BUCKETS = 16

UPPER = np.zeros(256, bool)
UPPER[65:91] = True
SYMBOL = np.zeros(256, bool)
SYMBOL[[*b"!#$%&*+/<=>?@[\\]^_`{|}~"]] = True
STOP = np.zeros(256, bool)
STOP[[*b".,;:"]] = True
DIGIT = np.zeros(256, bool)
DIGIT[48:58] = True
TEXT_FEATURES = 15


def text_view(text: str) -> np.ndarray:
    """Shares of characters and words that tell prose from shouting, symbols, tables and repetition."""
    raw = text.encode()
    count = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    size = max(len(raw), 1)
    tokens = text.split()
    n = max(len(tokens), 1)
    different = len(set(tokens))
    again = sum(map(str.__eq__, tokens, tokens[1:]))
    lines = text.split("\n")
    return np.array([
        1.0,
        np.log1p(len(raw)),
        count[UPPER].sum() / size * 5,
        count[SYMBOL].sum() / size * 10,
        count[ord("|")] / n * 5,
        count[ord("!")] / n * 5,
        count[STOP].sum() / n * 5,
        count[DIGIT].sum() / size * 10,
        len(raw) / n / 10,
        different / n,
        different / np.sqrt(n) / 10,
        again / n * 5,
        len(set(lines)) / len(lines),
        np.log1p(len(lines)) / 3,
        float(not tokens),
    ])


def bucket(value: str | None, buckets: int) -> int:
    return buckets if value is None else crc32(value.encode()) % buckets


def meta_view(source: str | None, lang: str | None, n_chars: int | None, pages: int | None, host: str | None, form: str | None) -> np.ndarray:
    x = np.zeros(8 + SOURCE_BUCKETS + LANG_BUCKETS + HOST_BUCKETS + 3 + 5)
    length = np.log1p(max(n_chars or 0, 0))
    x[:8] = 1.0, length / 5, (length / 5) ** 2, n_chars is None, pages is None, np.log1p(pages or 0), length < 4, length > 10
    at = 8
    for value, buckets in ((source, SOURCE_BUCKETS), (lang, LANG_BUCKETS), (host, HOST_BUCKETS)):
        x[at + bucket(value, buckets)] = 1.0
        at += buckets + 1
    x[at + ("https", "query", "fragment", "html", "folder").index(form) if form else -1] = float(form is not None)
    return x


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 30) -> np.ndarray:
    """Newton's method; the classes weigh as they come. The first column is the constant and not held back by the ridge."""
    w, hold = np.zeros(x.shape[1]), np.full(x.shape[1], ridge)
    hold[0] = 1e-6
    for _ in range(rounds):
        p = sigmoid(x @ w)
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(hold), x.T @ (p - y) + hold * w)
        w = np.clip(w - step, -50, 50)
        if np.abs(step).max() < 1e-6:
            break
    return w


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


@dataclass
class Model:
    text: np.ndarray | None = None
    meta: np.ndarray | None = None
    # Log-odds of a view -> calibrated log-odds, as (shift, slope); then the weights that combine both.
    calibrated: list[np.ndarray] = field(default_factory=list)
    combined: np.ndarray | None = None
    passed_on: list[tuple[int, int]] = field(default_factory=list)

    def odds(self, view: int, z: np.ndarray) -> np.ndarray:
        shift, slope = self.calibrated[view]
        return shift + slope * np.clip(z, -30, 30)

    def score(self, text_z: np.ndarray, meta_z: np.ndarray) -> np.ndarray:
        if self.combined is None:
            return np.full(len(text_z), 0.5)
        a, b = self.odds(0, text_z), self.odds(1, meta_z)
        return sigmoid(self.combined[0] + self.combined[1] * a + self.combined[2] * b)


def learn(views: list[np.ndarray], label: np.ndarray, held: np.ndarray) -> Model:
    """``views``: a matrix for each view over the same rows. ``label``: 0, 1 or -1 for none. ``held``: rows kept back."""
    model = Model()
    seen, kept_back = (label >= 0) & ~held, (label >= 0) & held
    if any(len(set(label[rows])) < 2 for rows in (seen, kept_back)):
        return model
    given = [np.where(seen, label, -1).astype(float) for _ in views]
    for _ in range(ROUNDS):
        weights = [logistic(x[g >= 0], g[g >= 0]) for x, g in zip(views, given, strict=True)]
        chances = [sigmoid(x @ w) for x, w in zip(views, weights, strict=True)]
        told = []
        for view, chance in enumerate(chances):
            other, n = 1 - view, 0
            free = np.flatnonzero((label < 0) & (given[other] < 0))
            for kind in (0, 1):
                sure = chance if kind else 1 - chance
                least = confident(sure[kept_back], label[kept_back] == kind)
                best = free[np.argsort(-sure[free], kind="stable")][:PASS_ON]
                best = best[sure[best] >= least]
                given[other][best] = kind
                n += len(best)
            told.append(n)
        model.passed_on.append(tuple(told))
        if not any(told):
            break
    weights = [logistic(x[g >= 0], g[g >= 0]) for x, g in zip(views, given, strict=True)]
    model.text, model.meta = weights
    truth = label[kept_back].astype(float)
    z = [x[kept_back] @ w for x, w in zip(views, weights, strict=True)]
    model.calibrated = [logistic(np.stack([np.ones(len(truth)), np.clip(v, -30, 30)], 1), truth) for v in z]
    model.combined = logistic(np.stack([np.ones(len(truth)), model.odds(0, z[0]), model.odds(1, z[1])], 1), truth)
    return model


def confident(sure: np.ndarray, right: np.ndarray) -> float:
    """The least confidence from which on at least PRECISION of the rows are right; more than 1 if there is none."""
    order = np.argsort(-sure, kind="stable")
    share = np.cumsum(right[order]) / np.arange(1, len(order) + 1)
    enough = np.flatnonzero((share >= PRECISION) & (np.arange(len(order)) >= 20))
    return float(sure[order][enough[-1]]) if len(enough) else 2.0


def page_facts(pages: DataFrame) -> DataFrame:
    """doc_id, pages, host, form of the address: from the number in a page's address; the first address counts."""
    url = F.col("url")
    form = (
        F.when(url.contains("?"), "query").when(url.contains("#"), "fragment").when(url.endswith(".html"), "html")
        .when(url.endswith("/"), "folder").when(url.startswith("https:"), "https")
    )
    found = pages.select(
        F.regexp_extract(url, r"/([0-9]{1,18})(?:[^0-9/]|/?$)", 1).try_cast("long").alias("page_of"),
        F.struct(url.alias("url"), F.regexp_extract(url, r"^[a-z]+://([^/:?#]+)", 1).alias("host"), form.alias("form")).alias("page"),
    )
    first = found.where(F.col("page_of").isNotNull()).groupBy("page_of").agg(F.min("page").alias("page"), F.count("*").alias("pages"))
    return first.select("page_of", "pages", "page.host", "page.form")


def plain(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"),
        F.col("source").cast("string").alias("source"), F.col("lang").cast("string").alias("lang"),
        F.col("n_chars").cast("long").alias("n_chars"),
    )


def fit(docs: DataFrame, labels: DataFrame, pages: DataFrame) -> Model:
    known = (
        labels.where("doc_id is not null and quality is not null")
        .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.round(F.avg("quality")).cast("int").alias("label"))
    )
    by_hash = F.xxhash64("doc_id")
    ids = docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
    labelled = known.join(ids, "doc_id", "left_semi").orderBy(by_hash, "doc_id").limit(LABELLED)
    pool = ids.join(known, "doc_id", "left_anti").orderBy(by_hash, "doc_id").limit(POOL).withColumn("label", F.lit(-1))
    # At most LABELLED + POOL ids, a few hundred KB.
    chosen = F.broadcast(labelled.unionByName(pool))

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            x = [text_view(text).tolist() for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(i) for i in (0, 2, 3, 4, 5)] + [pa.array(x, pa.list_(pa.float64()))],
                                             ["doc_id", "source", "lang", "n_chars", "label", "x"])

    sampled = plain(docs).join(chosen, "doc_id").mapInArrow(
        features, "doc_id long, source string, lang string, n_chars long, label int, x array<double>"
    )
    facts = page_facts(pages)
    rows = sampled.join(facts, sampled["doc_id"] == facts["page_of"], "left")
    got = sorted(rows.toLocalIterator(), key=lambda r: (r.doc_id, r.x))
    if not got:
        return Model()
    text = np.array([r.x for r in got])
    meta = np.array([meta_view(r.source, r.lang, r.n_chars, r.pages, r.host, r.form) for r in got])
    held = np.array([crc32(str(r.doc_id).encode()) % 4 == 0 for r in got])
    return learn([text, meta], np.array([r.label for r in got]), held)


def score(docs: DataFrame, pages: DataFrame, model: Model) -> DataFrame:
    """doc_id, text_score, meta_score, score, keep: one row per document."""

    def of_text(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = batch.column(1).to_pylist()
            z = np.array([text_view(t) for t in texts]) @ model.text if model.text is not None and texts else np.zeros(len(texts))
            yield pa.RecordBatch.from_arrays([batch.column(i) for i in (0, 2, 3, 4)] + [pa.array(z, pa.float64())],
                                             ["doc_id", "source", "lang", "n_chars", "z"])

    def of_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 8192):
            text_z = batch.column(4).to_numpy(zero_copy_only=False)
            if model.meta is None:
                scores = [np.full(batch.num_rows, 0.5)] * 3
            else:
                facts = zip(*[batch.column(i).to_pylist() for i in (1, 2, 3, 5, 6, 7)], strict=True)
                meta_z = np.array([meta_view(*f) for f in facts]).reshape(batch.num_rows, -1) @ model.meta
                scores = [sigmoid(model.odds(0, text_z)), sigmoid(model.odds(1, meta_z)), model.score(text_z, meta_z)]
            yield pa.RecordBatch.from_arrays([batch.column(0)] + [pa.array(s, pa.float64()) for s in scores],
                                             ["doc_id", "text_score", "meta_score", "score"])

    read = plain(docs).mapInArrow(of_text, "doc_id long, source string, lang string, n_chars long, z double")
    facts = page_facts(pages)
    rows = read.join(facts, read["doc_id"] == facts["page_of"], "left").drop("page_of")
    told = rows.mapInArrow(of_all, "doc_id long, text_score double, meta_score double, score double")
    return told.withColumn("keep", F.col("score") >= 0.5)
