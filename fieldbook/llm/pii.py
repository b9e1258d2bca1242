"""Personal data by weak supervision.

Four base kinds (``email``, ``ip``, ``card``, ``phone``) are found by fixed rules and always stay. Beyond them
the operator proposes candidates of further kinds (``PROPOSALS``) and decides about each:

1. Labelers vote 1 (personal data), 0 (no opinion) or -1 (not): the strict form, gazetteers, checksums,
   words in the context before, and whether the span stands free.
2. The votes of all candidates of the whole corpus, base spans included, are counted by pattern of
   votes. There are at most 3^labelers patterns a kind, so the counts are small whatever the
   input; expectation-maximisation over them estimates every labeler's reliability per
   class and each pattern's probability.
3. A logistic span classifier is trained on the patterns, weighted by their counts, with the
   probabilities as targets; its features are the votes, the kind and the length. It scores
   each candidate. A candidate of 0.5 or more that overlaps no base span becomes a span.

Finding is linear in the text's length: no pattern starts over and over in a long run, and candidates are held against
the base spans in one walk.

Null and empty texts have no spans. Repeated rows each give a row, a null id stays null, other columns are
left out. Positions are code points, ends exclusive.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldbook.llm.common import clear_of, id_and_text, slices

Span = tuple[str, int, int]

KINDS = ("email", "ip", "card", "phone")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+").match
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*").finditer
PART = re.compile(r"[0-9]+").finditer
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+").finditer
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]").finditer
DIGIT = re.compile(r"[0-9]").search

# Kinds beyond the base ones, with the form of a candidate.
PROPOSALS = {
    "account": re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"),
    "local_phone": re.compile(r"(?<![0-9A-Za-z.+])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9A-Za-z])"),
    "national_id": re.compile(r"(?<![0-9A-Za-z.-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])"),
    "short_card": re.compile(r"(?<![0-9.-])[3-6][0-9]{12,14}(?![0-9])"),
    "spelled_email": re.compile(
        r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{2,64} ?[\[(]at[\])] ?[A-Za-z0-9-]{1,63}(?: ?[\[(]dot[\])] ?[A-Za-z0-9-]{2,63}){1,4}"
    ),
}

# Gazetteers.
ENDINGS = frozenset("com org net edu gov info io dev app co uk de fr es it nl eu us ca au in example test".split())
COUNTRIES = frozenset("AD AE AT BE BG CH CY CZ DE DK EE ES FI FR GB GR HR HU IE IS IT LI LT LU LV MT NL NO PL PT RO SE SI SK".split())
CUES = frozenset(
    "phone tel telephone mobile cell call fax whatsapp mail email e-mail contact reach write ssn social security iban account bank card credit "
    "visa ip address host telefon anruf konto karte téléphone appelez courriel compte carte teléfono correo cuenta tarjeta".split()
)
DENIALS = frozenset("version order invoice isbn issn doi part serial model figure section page chapter build rev revision sku".split())
WORD = re.compile(r"[^\W\d_]+(?:-[^\W\d_]+)?").findall
NEAR = 40


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = ord(digit) - 48
        if place % 2:
            value = value * 2 - 9 * (value > 4)
        total += value
    return total % 10 == 0


def emails(text: str) -> Iterator[Span]:
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL:
            start -= 1
        domain = DOMAIN(text, at + 1) if start < at else None
        free = domain.end() if domain else at + 1
        if domain:
            yield "email", start, free
        at = text.find("@", free)


def addresses(text: str) -> Iterator[Span]:
    for chain in DOTTED(text):
        parts = list(PART(text, chain.start(), chain.end()))
        for four in zip(*[iter(parts)] * 4, strict=False):
            if all(len(value) < 4 and int(value) < 256 for value in (p.group().lstrip("0") or "0" for p in four)):
                yield "ip", four[0].start(), four[3].end()


def cards(text: str) -> Iterator[Span]:
    for match in CARD(text):
        digits = match.group().replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and luhn(digits):
            yield "card", match.start(), match.end()


def phones(text: str) -> Iterator[Span]:
    for match in PHONE(text):
        if 8 <= sum(map(str.isdigit, match.group())) <= 15:
            yield "phone", match.start(), match.end()


def base_spans(text: str) -> list[Span]:
    """By kind as listed, then start."""
    found: list[Span] = []
    if "@" in text:
        found += emails(text)
    if DIGIT(text):
        found += addresses(text)
        found += cards(text)
        if "+" in text:
            found += phones(text)
    return found


def proposals(text: str, taken: list[Span]) -> list[Span]:
    """Candidates of the further kinds that overlap no base span, by kind and start."""
    kinds = ("account", "local_phone", "national_id", "short_card") if DIGIT(text) else ()
    if "at)" in text or "at]" in text:
        kinds += ("spelled_email",)
    taken = [s[1:] for s in taken]
    return [s for kind in kinds for s in clear_of([(kind, *m.span()) for m in PROPOSALS[kind].finditer(text)], taken)]


# Labelers: (kind, the span's text, lower-case words before it, the characters around) -> 1, 0 or -1. What a candidate's
# pattern already demands is no vote for it.


def by_form(kind: str, span: str, before: list[str], around: str) -> int:
    if kind in ("email", "spelled_email"):
        return 1 if re.search(r"[A-Za-z]{2,}\Z", span) else -1
    if kind == "ip":
        return -1 if span.startswith("0.") or re.search(r"(?:\A|\.)0[0-9]", span) else 1
    if kind in ("phone", "local_phone"):
        return -1 if len(set(filter(str.isdigit, span))) < 3 else int(kind == "phone")
    if kind == "national_id":
        return -1 if span.startswith(("000", "666", "9")) or span[4:6] == "00" or span.endswith("0000") else 0
    return 0 if len(set(span)) > 4 else -1


def by_list(kind: str, span: str, before: list[str], around: str) -> int:
    if kind in ("email", "spelled_email"):
        return 1 if re.split(r"[^A-Za-z0-9-]+", span)[-1].lower() in ENDINGS else 0
    if kind == "account":
        return 1 if span[:2] in COUNTRIES else -1
    if kind in ("card", "short_card"):
        return 1 if span[0] in "3456" else -1
    return 0


def by_sum(kind: str, span: str, before: list[str], around: str) -> int:
    if kind in ("card", "short_card"):
        return 1 if luhn("".join(filter(str.isdigit, span))) else -1
    if kind == "account":
        plain = span.replace(" ", "")
        return 1 if int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1 else -1
    return 0


def by_context(kind: str, span: str, before: list[str], around: str) -> int:
    return -1 if DENIALS.intersection(before) else 1 if CUES.intersection(before) else 0


def by_edges(kind: str, span: str, before: list[str], around: str) -> int:
    return -1 if any(c.isalnum() or c in "_/=#" for c in around) else int(kind in KINDS)


LABELERS = (by_form, by_list, by_sum, by_context, by_edges)


def voted(text: str, span: Span) -> str:
    """kind, the votes and a class of length, as one text: what the models see of a candidate."""
    kind, start, end = span
    before = WORD(text[max(0, start - NEAR) : start].lower())
    around = text[max(0, start - 1) : start] + text[end : end + 1]
    votes = ",".join(str(labeler(kind, text[start:end], before, around)) for labeler in LABELERS)
    return f"{kind}|{votes}|{min((end - start) // 8, 4)}"


def features(pattern: str) -> np.ndarray:
    kind, votes, length = pattern.split("|")
    named = [*KINDS, *sorted(PROPOSALS)]
    votes = np.array(votes.split(","), float)
    return np.concatenate([[1.0], votes, np.abs(votes), [kind == k for k in named], [float(length) / 4]])


def reliabilities(counts: dict[str, int], rounds: int = 100) -> dict[str, float]:
    """Probability of each pattern to be personal data, by expectation-maximisation over its counts.

    An abstention says nothing. Base spans are personal data beyond doubt and hold the classes in place.
    """
    patterns = sorted(counts)
    weight = np.array([counts[p] for p in patterns], float)
    votes = np.array([p.split("|")[1].split(",") for p in patterns], int)
    sure = np.array([p.split("|")[0] in KINDS for p in patterns])
    cast = np.stack([votes == 1, votes == -1], 2).astype(float)  # pattern, labeler, for or against
    chance = np.where(sure, 1.0, 1 / (1 + np.exp(-votes.sum(1).astype(float))))  # to begin with, what most labelers say
    for _ in range(rounds):
        log = []
        # A labeler is taken to be right more often than not, until its votes say otherwise.
        for p, prior in ((chance, (4.0, 1.0)), (1 - chance, (1.0, 4.0))):
            share = np.einsum("p,plv->lv", weight * p, cast) + prior
            share /= share.sum(1, keepdims=True)
            log.append(np.einsum("plv,lv->p", cast, np.log(share)) + np.log((weight * p * ~sure).sum() + 1))
        new = np.where(sure, 1.0, 1 / (1 + np.exp(np.clip(log[1] - log[0], -500, 500))))
        moved, chance = np.abs(new - chance).max(initial=0), new
        if moved < 1e-6:
            break
    return dict(zip(patterns, chance.tolist(), strict=True))


def classifier(counts: dict[str, int], chances: dict[str, float], rounds: int = 300) -> np.ndarray:
    """Weights of the logistic span classifier; patterns count by the root of how often they occur."""
    patterns = sorted(counts)
    x = np.array([features(p) for p in patterns])
    y = np.array([chances[p] for p in patterns])
    weight = np.sqrt([counts[p] for p in patterns])
    weight /= weight.sum()
    w = np.zeros(x.shape[1])
    for _ in range(rounds):  # Newton steps, with a little regularisation
        p = 1 / (1 + np.exp(-x @ w))
        slope = x.T @ (weight * (p - y)) + 1e-3 * w
        bend = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(len(w))
        step = np.linalg.solve(bend, slope)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit(docs: DataFrame, id: str = "doc_id", text: str = "text") -> dict[str, float]:
    """Pattern of votes -> the classifier's probability; over all candidates of all texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[str] = Counter()
        for batch in slices(batches):
            for value in batch.column(1).to_pylist():
                base = base_spans(value)
                seen.update(voted(value, span) for span in base + proposals(value, base))
        yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], ["pattern", "n"])

    patterns = id_and_text(docs, id, text).mapInArrow(count, "pattern string, n long").groupBy("pattern").agg(F.sum("n").alias("n"))
    counts = {r.pattern: r.n for r in patterns.toLocalIterator()}
    if not counts:
        return {}
    w = classifier(counts, reliabilities(counts))
    # Where no labeler is in favour, the patterns of others say nothing about it.
    favoured = [p for p in counts if "1" in p.split("|")[1].replace("-1", "").split(",")]
    return {p: float(1 / (1 + np.exp(-features(p) @ w))) for p in favoured}


def find(docs: DataFrame, scores: dict[str, float], id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, base and extra: arrays of (kind, start, end, score), by kind and start. A base span's score is 1."""
    span = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("kind", "start", "end", "score")
        for batch in slices(batches):
            base, extra = [], []
            for value in batch.column(1).to_pylist():
                found = base_spans(value)
                base.append([dict(zip(names, (*s, 1.0), strict=True)) for s in found])
                scored = [(*s, scores.get(voted(value, s), 0.0)) for s in proposals(value, found)]
                extra.append([dict(zip(names, s, strict=True)) for s in scored if s[3] >= 0.5])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(base, pa.list_(span)), pa.array(extra, pa.list_(span))], ["doc_id", "base", "extra"]
            )

    kind = "array<struct<kind:string,start:int,end:int,score:double>>"
    return id_and_text(docs, id, text).mapInArrow(run, f"doc_id long, base {kind}, extra {kind}")


def listed(spans):
    """Spans as text: kind:start:end, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
