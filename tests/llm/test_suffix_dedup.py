import random
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pytest

from fieldbook.llm import suffix_dedup as sd
from tests.llm.conftest import ODD

L = sd.LENGTH


def brute(rows):
    raw = [(i, (t or "").encode()) for i, t in rows]
    first = {}
    for i, text in sorted((r for r in raw if r[0] is not None), key=lambda r: r[0]):
        for at in range(len(text) - L + 1):
            first.setdefault(text[at : at + L], i)
    out = []
    for i, text in raw:
        gone = np.zeros(len(text), bool)
        for at in range(len(text) - L + 1 if i is not None else 0):
            if first[text[at : at + L]] < i:
                gone[at : at + L] = True
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        left = bytes(np.frombuffer(text, np.uint8)[~gone])
        out.append((i, len(text), int(gone.sum()), spans, sha256(left).hexdigest()))
    return sorted(out, key=repr)


def deduped(frame):
    rows = sd.dedup(frame).collect()
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, sha256(bytes(r.kept)).hexdigest()) for r in rows), key=repr)


def random_rows(seed, n=120):
    pick = random.Random(seed)
    alphabet = pick.choice(("ab", "abcdefgh ", "aé日 "))
    passages = ["".join(pick.choices(alphabet, k=pick.choice((49, 50, 51, 60, 120, 300)))) for _ in range(8)]
    passages += ["a" * 70, "ab" * 40, "abc" * 60]
    rows = []
    for _ in range(n):
        parts = [pick.choice(passages) if pick.random() < 0.6 else "".join(pick.choices(alphabet, k=pick.randrange(90))) for _ in range(pick.randrange(6))]
        text = "".join(parts)
        if pick.random() < 0.3 and text:
            cut = pick.randrange(len(text))
            text = text[:cut] + "!" + text[cut + 1 :]
        rows.append((pick.randrange(n), text))
    return rows


@pytest.mark.parametrize("seed", range(3))
def test_against_all_strings(docs, seed):
    rows = random_rows(seed)
    assert deduped(docs(rows)) == brute(rows)


def test_large_buckets_and_frequent_samples_give_the_same(docs, monkeypatch):
    monkeypatch.setattr(sd, "LARGE", 2)
    monkeypatch.setattr(sd, "SAMPLED", 1)
    monkeypatch.setattr(sd, "FREQUENT", 10**9)
    rows = random_rows(9, 200)
    assert deduped(docs(rows)) == brute(rows)


def test_pieces_of_long_texts(spark):
    """Texts of several pieces, with repeats across the borders."""
    pick = random.Random(3)
    size = sd.BLOCK_BYTES
    long = "".join(pick.choices("abcdefgh ", k=2 * size + 500))
    rows = [(1, long), (2, "xyz" + long[size - 400 : size + 400]), (3, long[: size + 60] + "#" + long[size + 60 :]), (4, long[-70:] + "!" * 60)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in sd.dedup(frame).collect()}
    assert got[1] == (len(long), 0, 0, long.encode())
    assert got[2] == (803, 800, 1, b"xyz")
    assert got[3] == (len(long) + 1, len(long), 2, b"#")
    assert got[4] == (130, 70, 1, b"!" * 60)


def test_the_table(table):
    docs = table("documents")
    assert deduped(docs) == brute([(r.doc_id, r.text) for r in docs.collect()])


def test_odd_rows_and_empty_table(docs):
    rows = [*ODD, (9, "ab" * 60), (9, "ab" * 60), (10, "ab" * 60), (-1, "x" * 49), (-2, "x" * 50), (11, "x" * 51), (None, "x" * 51)]
    assert deduped(docs(rows)) == brute(rows)
    assert deduped(docs(rows).limit(0)) == []


def test_every_string_has_one_sample_in_it():
    raw = [t.encode() for _, t in random_rows(4)]
    block = sd.Block(raw)
    owner, first, count, sample, _ = block.contexts()
    assert count.sum() == sum(max(len(t) - L + 1, 0) for t in raw)
    assert (sample >= first + count - 1).all() and (sample + sd.GRAM <= first + L).all()
    text = block.raw.tobytes()
    by_string = {}
    for o, f, c, s in zip(owner, first, count, sample, strict=True):
        for at in range(f, f + c):
            assert by_string.setdefault(text[at : at + L], s - at) == s - at  # equal strings, equal distance


def batches(rows, schema, size):
    table = pa.Table.from_pylist(rows, schema)
    return table.combine_chunks().to_batches(max_chunksize=size)


def test_judging_does_not_depend_on_batches():
    pick = random.Random(5)
    rows = sorted((
        {"sample": pick.randrange(4), "context": pick.randrange(3), "doc_id": pick.randrange(6), "place": i << 32, "n": pick.choice((1, 2, 3)) }
        for i in range(120)
    ), key=lambda r: (r["sample"], r["context"], r["doc_id"]))
    rows += [{"sample": 9, "context": 1, "doc_id": d, "place": 0, "n": 1} for d in (1, 1, 2)]
    rows += [{"sample": 10, "context": 1, "doc_id": 1, "place": 0, "n": -1}]
    told = [
        sorted((r for b in sd.judged(iter(batches(rows, sd.CONTEXT, size))) for r in b.to_pylist()), key=repr) for size in (1, 2, 7, 1000)
    ]
    assert told[0] == told[1] == told[2] == told[3]
    asked = {(r["sample"], r["doc_id"]) for r in told[0] if r["sample"] is not None}
    assert (10, 1) in asked and not any(s == 9 for s, _ in asked)
    assert sum(r["sample"] is None and r["doc_id"] == 2 and r["place"] == 0 for r in told[0]) >= 1


def test_blocks_of_buckets_do_not_change_the_result(monkeypatch):
    pick = random.Random(6)
    schema = pa.schema([("bucket", pa.int64()), ("large", pa.bool_()), ("doc_id", pa.int64()), ("place", pa.int64()), ("n", pa.int32()), ("bytes", pa.binary())])
    rows = []
    for i in range(300):
        offset = pick.randrange(3)
        left = bytes(pick.choices(b"ab", k=offset)) + bytes(sd.REACH - offset)
        rows.append({"bucket": pick.randrange(20), "large": False, "doc_id": pick.randrange(30), "place": i << 32, "n": offset + 1,
                     "bytes": left + bytes(pick.choices(b"a", k=48)) + bytes(pick.choices(b"ab", k=2)) + bytes([offset])})
    rows.sort(key=lambda r: (r["bucket"], r["doc_id"]))
    told = []
    for size, most in ((300, 10**6), (3, 10**6), (5, 40), (5, 4)):  # at last, blocks smaller than a bucket
        monkeypatch.setattr(sd, "BLOCK_CONTEXTS", most)
        told.append(sorted((r for b in sd.sorted_buckets(iter(batches(rows, schema, size))) for r in b.to_pylist()), key=repr))
    assert told[0] and told[0] == told[1] == told[2] == told[3]


def test_strings_of_a_large_bucket_may_fill_many_blocks(monkeypatch):
    schema = pa.schema([("bucket", pa.int64()), ("large", pa.bool_()), ("doc_id", pa.int64()), ("place", pa.int64()), ("n", pa.int32()), ("bytes", pa.binary())])
    rows = [{"bucket": 5, "large": True, "doc_id": i // 3, "place": i << 32, "n": 1, "bytes": bytes(sd.REACH) + b"a" * L + bytes(1)} for i in range(100)]
    monkeypatch.setattr(sd, "BLOCK_CONTEXTS", 7)
    told = {(r["doc_id"], r["place"] >> 32) for b in sd.sorted_buckets(iter(batches(rows, schema, 4))) for r in b.to_pylist()}
    assert told == {(i // 3, i) for i in range(3, 100)}


@pytest.mark.parametrize("times", [1, 40, 400])
def test_repeated_rows_change_nothing(docs, times):
    """Two documents share a passage, three more only its sample piece; each row stands there many times."""
    pick = random.Random(11)
    noise = lambda n: "".join(pick.choices("bcdefgh", k=n))
    passage = noise(57)
    raw = np.frombuffer(passage.encode(), np.uint8)
    at = int(np.argmin(sd.gram_hashes(raw)[: len(raw) - sd.GRAM + 1] >> np.uint64(32)))
    piece = passage[at : at + sd.GRAM]
    once = [(1, noise(60) + passage), (2, noise(50) + piece + noise(50)), (3, piece + noise(70)), (4, noise(70) + piece), (5, passage + noise(40))]
    want = brute(once)
    assert want[4][2] >= 57
    assert sorted(set(deduped(docs(once * times)))) == want


def test_a_stretch_is_named_once(docs):
    once = [(1, "x" * 30 + "ab" * 60), (2, "ab" * 60 + "cd" * 40)]
    assert sd.removals(docs(once * 50)).distinct().count() <= 4
