import random

import public_tokenizers as vocabulary
import pytest
import tiktoken

from fieldbook.llm import bpe
from fieldbook.llm.common import rank_file
from tests.llm.conftest import ODD

RANKS = vocabulary.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def oracle():
    return tiktoken.Encoding("own", pat_str=vocabulary.PATTERN, mergeable_ranks=rank_file(RANKS), special_tokens={})


def random_texts(seed):
    pick = random.Random(seed)
    for _ in range(1500):
        kind = pick.random()
        if kind < 0.3:
            anything = (pick.randrange(1, 0xD800), pick.randrange(0xE000, 0x30000), pick.randrange(1, 300), 32, 10, 0x1C, 0x85)
            yield "".join(chr(pick.choice(anything)) for _ in range(pick.randrange(60)))
        elif kind < 0.6:
            yield "".join(pick.choice("aab  \n\t'stlre12!.") for _ in range(pick.randrange(200)))
        else:
            yield pick.choice("a e1!\n") * pick.randrange(1, 3000)


def test_ids_are_those_of_the_reference_library(oracle):
    codec = bpe.Codec(rank_file(RANKS), vocabulary.PATTERN)
    for text in random_texts(1):
        ids = list(codec.encode(text))
        assert ids == oracle.encode_ordinary(text)
        assert codec.decode(ids) == text.encode()


def test_queue_gives_ranks_in_order_and_positions_within():
    queue, pick = bpe.RankQueue(50_256), random.Random(2)
    entries = [(pick.choice((0, 1, 255, 256, 50_255, pick.randrange(50_256))), i) for i in range(500)]
    for entry in entries:
        queue.push(*entry)
    assert [queue.pop() for _ in entries] == sorted(entries) and not queue.top


def test_very_long_piece_and_a_memo_that_overflows(oracle, monkeypatch):
    monkeypatch.setattr(bpe, "MEMO", 3)
    codec = bpe.Codec(rank_file(RANKS), vocabulary.PATTERN)
    text = "abcdefghij" * 5_000 + " one two three four five six"
    assert list(codec.encode(text)) == oracle.encode_ordinary(text) and len(codec) <= 3


def test_rows_odd_texts_and_round_trip(spark, docs, oracle):
    frame = docs(ODD)
    coded = bpe.encode(frame, RANKS, vocabulary.PATTERN, decoded=True)
    assert coded.columns == ["doc_id", "ids", "decoded"]
    key = lambda row: (row[0] is None, row[0] or 0, row[1])
    got = sorted(((r.doc_id, bytes(r.decoded)) for r in coded.collect()), key=key)
    assert got == sorted(((i, (t or "").encode()) for i, t in ODD), key=key)
    by_text = {bytes(r.decoded): r.ids for r in coded.collect()}
    assert all(by_text[(t or "").encode()] == oracle.encode_ordinary(t or "") for _, t in ODD)
    back = bpe.decode(coded.select("doc_id", "ids"), RANKS, vocabulary.PATTERN)
    assert sorted(bytes(r.decoded) for r in back.collect()) == sorted((t or "").encode() for _, t in ODD)
    assert bpe.encode(frame.limit(0), RANKS, vocabulary.PATTERN).count() == 0
    nulls = spark.createDataFrame([(1, None)], "doc_id long, ids array<int>")
    assert bytes(bpe.decode(nulls, RANKS, vocabulary.PATTERN).first().decoded) == b""
