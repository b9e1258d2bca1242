"""Byte-level BPE with a rank queue over a hierarchical bitmap.

A text is cut by the tokenizer's pattern; each piece is merged on its own. The symbols of a
piece form a linked list. Every mergeable neighbour pair waits in the bucket of its merge
rank, as the position of its left symbol; a two-level bitmap of 256-way words marks the
buckets in use, so finding the lowest rank is two find-first-set steps however long the
piece is. An entry whose pair has changed since is stale and skipped when it comes up.

Memory of a task: the rank table, a memo of at most ``MEMO`` short pieces, and the piece at
hand. The memo changes only the speed.

Null and empty texts have no tokens and decode to no bytes. Repeated rows each give a row.
A null id stays null. Other columns are left out.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from functools import lru_cache
from heapq import heappop, heappush
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldbook.llm.common import id_and_text, rank_file, slices

MEMO = 1_000_000
MEMO_CHARS = 48
LEAF_BITS, LEAF_MASK = 8, 255


class RankQueue:
    """Buckets of positions by rank; the lowest rank first, and in it the lowest position."""

    def __init__(self, ranks: int):
        self.leaf = [0] * ((ranks >> LEAF_BITS) + 1)
        self.top = 0
        self.buckets: dict[int, list[int]] = {}

    def push(self, rank: int, position: int) -> None:
        bucket = self.buckets.get(rank)
        if bucket is None:
            self.buckets[rank] = [position]
            word = rank >> LEAF_BITS
            self.leaf[word] |= 1 << (rank & LEAF_MASK)
            self.top |= 1 << word
        else:
            heappush(bucket, position)

    def pop(self) -> tuple[int, int]:
        """Of a queue that isn't empty, that is while ``top`` isn't 0."""
        top = self.top
        word = (top & -top).bit_length() - 1
        bits = self.leaf[word]
        low = bits & -bits
        rank = (word << LEAF_BITS) + low.bit_length() - 1
        bucket = self.buckets[rank]
        if len(bucket) > 1:
            return rank, heappop(bucket)
        del self.buckets[rank]
        bits = self.leaf[word] = bits ^ low
        if not bits:
            self.top = top & (top - 1)
        return rank, bucket[0]


class Codec(dict):
    """Piece of text -> tuple of token ids; a dict so that known pieces cost one lookup."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        super().__init__()
        self.ranks = ranks
        self.token = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            self.token[rank] = token
        self.queue = RankQueue(len(self.token))
        # \s of the pattern means Unicode's White_Space, which leaves out the ASCII separators 1C-1F.
        self.pieces = regex.compile(
            pattern.replace(r"[^\s", r"[^\p{White_Space}").replace(r"\S", r"\P{White_Space}").replace(r"\s", r"\p{White_Space}")
        ).findall

    def __missing__(self, piece: str) -> tuple[int, ...]:
        ids = self.merge(piece.encode())
        if len(piece) <= MEMO_CHARS:
            if len(self) >= MEMO:
                self.clear()
            self[piece] = ids
        return ids

    def merge(self, piece: bytes) -> tuple[int, ...]:
        rank_of = self.ranks.get
        whole = rank_of(piece)
        if whole is not None:
            return (whole,)
        size = len(piece)
        # A symbol is known by its first byte's position; after[i] is the next symbol's, before[i] the one in front.
        after, before = list(range(1, size + 1)), list(range(-1, size - 1))
        waiting = [rank_of(piece[i : i + 2]) for i in range(size)]
        waiting[-1] = None
        queue, push, pop = self.queue, self.queue.push, self.queue.pop
        for i, rank in enumerate(waiting):
            if rank is not None:
                push(rank, i)
        while queue.top:
            rank, i = pop()
            if waiting[i] != rank:
                continue  # stale
            gone = after[i]
            waiting[gone] = None
            following = after[i] = after[gone]
            if following < size:
                before[following] = i
                rank = waiting[i] = rank_of(piece[i : after[following]])
                if rank is not None:
                    push(rank, i)
            else:
                waiting[i] = None
            front = before[i]
            if front >= 0:
                rank = rank_of(piece[front:following])
                if rank != waiting[front]:
                    waiting[front] = rank
                    if rank is not None:
                        push(rank, front)
        ids, i = [], 0
        while i < size:
            ids.append(self.ranks[piece[i : after[i]]])
            i = after[i]
        return tuple(ids)

    def encode(self, text: str) -> Iterator[int]:
        return chain.from_iterable(map(self.__getitem__, self.pieces(text)))

    def decode(self, ids) -> bytes:
        return b"".join(map(self.token.__getitem__, ids))


@lru_cache(maxsize=2)
def codec_of(ranks: str, pattern: str) -> Codec:
    """One for all tasks of a worker process."""
    return Codec(rank_file(ranks), pattern)


def encode(docs: DataFrame, ranks: str, pattern: str, decoded: bool = False, id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, ids array<int>; with ``decoded`` also the bytes that the ids stand for.

    ``ranks`` is the path of the rank file, which must exist on every worker.
    """
    schema = "doc_id long, ids array<int>" + ", decoded binary" * decoded

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(ranks, pattern)
        for batch in slices(batches):
            ids, ends = array("i"), [0]
            back = []
            for value in batch.column(1).to_pylist():
                ids.extend(codec.encode(value))
                if decoded:
                    back.append(codec.decode(ids[ends[-1] :]))
                ends.append(len(ids))
            values = pa.array(np.frombuffer(ids, np.int32) if ids else np.empty(0, np.int32))
            columns = [batch.column(0), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)]
            yield pa.RecordBatch.from_arrays(columns + [pa.array(back, pa.binary())] * decoded, ["doc_id", "ids", "decoded"][: 2 + decoded])

    return id_and_text(docs, id, text).mapInArrow(run, schema)


def decode(encoded: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """doc_id, decoded binary, of rows (doc_id, ids); null ids decode to no bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(ranks, pattern)
        for batch in slices(batches):
            back = [codec.decode(ids or ()) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(back, pa.binary())], ["doc_id", "decoded"])

    rows = encoded.select(F.col("doc_id").cast("long"), F.col("ids").cast("array<int>"))
    return rows.mapInArrow(run, "doc_id long, decoded binary")
