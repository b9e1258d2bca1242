"""Removal of bytes that an earlier document already has, by blockwise suffix sorting with a difference cover.

A byte goes if it lies in a string of ``LENGTH`` bytes that also starts in a document with a smaller id.

**The cover.** A difference cover is a set of sample positions such that two equal strings always have
a sample at the same distance from their starts. Here it is content-defined: in every string of
``LENGTH`` bytes the ``GRAM``-byte piece with the least hash (leftmost of equals) is its sample, so equal
strings agree on it. One position in 17 is a sample; a cover of fixed residues would need four times as
many to be shuffled. All suffixes whose strings have one sample piece in common form a *suffix bucket*.

**1. Contexts.** The strings that share one sample position lie side by side. The bytes they span are the
sample's context, 50 to 84 bytes. Equal contexts are settled at once: all but those of the least id are repeats. Within a
task that happens before the shuffle, so a passage in a third of all documents is sent once per block of texts.
A bucket with a single context is done.

**2. Buckets.** Only the contexts that remain are sent, one row each however many suffixes they hold, and sorted
one block of buckets at a time. The cover-sample ranks come first: contexts in the order of the bytes
from the sample on, and in the order of the bytes before it read backwards, each with the length of the common
prefix of neighbours. A suffix that starts ``o`` bytes before the sample ties with another exactly if the
``o`` bytes left of the samples agree and the samples' ranks tie for the remaining bytes; both are lookups in
the ranks, so no suffix is compared byte by byte. Of each class of equal strings all but those of the least id are repeats.

**3. Removal.** The repeats of a document are put together and its text cut.

Buckets of more than ``LARGE`` contexts are dealt out by string instead, one row for each, so that no bucket grows with the
input; very frequent samples are found in a sixty-fourth of the documents and spread already in step 1 (where a
sample is spread decides only which task sees it, not the result).

Equal contexts are told by 128 bits of hashes; the strings in buckets by their bytes.

A null text counts as empty. Rows without an id stay whole and remove nothing. Rows of one id count as one document:
they remove nothing from each other. Other columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldbook.llm.common import id_and_text, once, slices

LENGTH = 50
GRAM = 16
REACH = LENGTH - GRAM  # a sample lies at most so far behind its string's start
BLOCK_BYTES = 1_000_000
BLOCK_CONTEXTS = 100_000
LARGE = 100_000
SAMPLED = 64
FREQUENT = 5_000  # a sample with more than one in so many of all sample positions is spread

U = np.uint64
BASE, BASE_INVERSE = U(0x9E3779B97F4A7C15), U(pow(0x9E3779B97F4A7C15, -1, 2**64))
FACTOR, SECOND = U(0xBF58476D1CE4E5B9), U(0x94D049BB133111EB)
BYTES = np.random.default_rng(977).integers(1, 2**64 - 1, 256, dtype=U)


def gram_hashes(raw: np.ndarray) -> np.ndarray:
    """A hash of the GRAM bytes from each position on; at the end zeros follow."""
    padded = np.concatenate([raw, np.zeros(GRAM, np.uint8)])
    eights = np.ndarray((len(raw) + 8,), U, padded.tobytes(), 0, (1,))
    hashes = eights[: len(raw)] * BASE
    hashes ^= hashes >> U(29)
    hashes += eights[8:]
    hashes *= FACTOR
    return hashes ^ (hashes >> U(32))


class Block:
    """Some texts end to end."""

    def __init__(self, texts: list[bytes]):
        self.raw = np.frombuffer(b"".join(texts), np.uint8)
        self.sizes = np.array([len(t) for t in texts], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.owner = np.repeat(np.arange(len(texts)), self.sizes)
        self.hashes = gram_hashes(self.raw)

    def powers(self) -> tuple[np.ndarray, np.ndarray]:
        """Sums that give any stretch's hash: (sums[b] - sums[a]) * inverse[a]."""
        n = len(self.raw)
        power = np.cumprod(np.concatenate([[U(1)], np.full(n, BASE)]))
        sums = np.concatenate([[U(0)], np.cumsum(BYTES[self.raw] * power[:n])])
        return sums, np.cumprod(np.concatenate([[U(1)], np.full(n, BASE_INVERSE)]))

    def contexts(self) -> tuple[np.ndarray, ...]:
        """For each sample: its text, the first of its strings' starts, how many strings, its position, hash of its context."""
        n, wide = len(self.raw), REACH + 1
        starts = np.flatnonzero(self.owner[: max(n - LENGTH + 1, 0)] == self.owner[min(LENGTH - 1, n) :])
        if not len(starts):
            none = np.empty(0, np.int64)
            return none, none, none, none, none.view(U)
        least, width = (self.hashes & U(0xFFFFFFFF00000000)) | np.arange(n, dtype=U), 1
        while width * 2 <= wide:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        if width < wide:
            least = np.minimum(least[: width - wide], least[wide - width :])
        sample = (least[starts] & U(0xFFFFFFFF)).astype(np.int64)
        new = np.flatnonzero(np.concatenate([[True], (np.diff(sample) != 0) | (np.diff(starts) != 1)]))
        first, count, sample = starts[new], np.diff(np.append(new, len(starts))), sample[new]
        sums, inverse = self.powers()
        whole = (sums[first + count - 1 + LENGTH] - sums[first]) * inverse[first]
        whole = (whole ^ (whole >> U(31))) * SECOND + (sample - first).astype(U) * FACTOR + count.astype(U)
        return self.owner[first], first, count, sample, whole


def columns_of(column: pa.Array) -> list[list]:
    """A column's rows; for an array of structs one list of numpy arrays for each field."""
    if not pa.types.is_list(column.type):
        return [column.to_pylist()]
    ends, structs = column.offsets.to_numpy(), column.values
    fields = [structs.field(i).to_numpy(zero_copy_only=False) for i in range(structs.type.num_fields)]
    return [[field[a:b] for a, b in zip(ends, ends[1:], strict=False)] for field in fields]


def blocks(batches: Iterator[pa.RecordBatch], more: int) -> Iterator[tuple[list[tuple], np.ndarray, np.ndarray, list[bytes]]]:
    """Rows, where their piece of text begins, their text's checksum, and the piece's bytes; the text is the second column.

    A piece has BLOCK_BYTES bytes and ``more`` of the following ones, and a block one piece or small texts of as many
    bytes, so its arrays are bounded however long a text is. Which sample a string has depends on its own bytes
    alone, so cutting a text only cuts the context that lies across the border in two.
    """
    rows, offsets, versions, texts, size = [], [], [], [], 0
    for batch in slices(batches):
        for row in zip(*[values for c in batch.columns for values in columns_of(c)], strict=True):
            raw = row[1].encode()
            version = crc32(raw)
            for offset in range(0, max(len(raw), 1), BLOCK_BYTES):
                rows.append(row)
                offsets.append(offset)
                versions.append(version)
                texts.append(raw[offset : offset + BLOCK_BYTES + more])
                size += len(texts[-1])
                if size >= BLOCK_BYTES:
                    yield rows, np.array(offsets, np.int64), np.array(versions, np.int64), texts
                    rows, offsets, versions, texts, size = [], [], [], [], 0
    if rows:
        yield rows, np.array(offsets, np.int64), np.array(versions, np.int64), texts


def place(first: np.ndarray, version: np.ndarray) -> np.ndarray:
    """Start in the document and its text's checksum, which tells rows of one id apart, as one number."""
    return (first << 32) | version


CONTEXT = pa.schema([("sample", pa.int64()), ("context", pa.int64()), ("doc_id", pa.int64()), ("place", pa.int64()), ("n", pa.int32())])
CONTEXT_SQL = "sample long, context long, doc_id long, place long, n int"


def contexts(texts: DataFrame, frequent: np.ndarray | None = None) -> DataFrame:
    """One row per sample. Those which an equal context in the same block already makes repeats have no sample and may be
    several in one; ``n`` is negative for frequent samples."""
    frequent = np.empty(0, np.int64) if frequent is None else np.sort(frequent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, offsets, versions, raw in blocks(batches, LENGTH - 1):
            block = Block(raw)
            ids = np.array([r[0] for r in rows], np.int64)
            owner, first, count, sample, whole = block.contexts()
            key, doc = block.hashes[sample].view(np.int64), ids[owner]
            order = np.lexsort((doc, whole, key))
            new = np.concatenate([[True], (np.diff(key[order]) != 0) | (np.diff(whole[order]) != U(0))])[: len(order)]
            least = doc[order][np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))] if len(order) else doc
            repeat = np.zeros(len(order), bool)
            repeat[order] = doc[order] > least
            # Repeats next to each other in a text as one stretch.
            where = np.flatnonzero(repeat)
            apart = np.flatnonzero(np.concatenate([[True], (first[where][1:] != (first + count)[where][:-1]) | (np.diff(owner[where]) != 0)])[: len(where)])
            stretch = np.add.reduceat(count[where], apart) if len(where) else where
            told, open_ = where[apart], np.flatnonzero(~repeat)
            sign = np.where(np.isin(key[open_], frequent), -1, 1)
            row = np.concatenate([told, open_])
            missing = np.arange(len(row)) < len(told)
            yield pa.RecordBatch.from_arrays([
                pa.array(key[row], mask=missing), pa.array(whole[row].view(np.int64), mask=missing), pa.array(doc[row]),
                pa.array(place(first[row] - block.starts[owner[row]] + offsets[owner[row]], versions[owner[row]])),
                pa.array(np.concatenate([stretch, count[open_] * sign]).astype(np.int32)),
            ], schema=CONTEXT)

    return texts.mapInArrow(run, CONTEXT_SQL)


def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Contexts in order of sample, context and id -> repeats (without sample), and contexts whose bucket has others.

    Rows of one id with one text give every context as often as there are rows; one of each is looked at.
    A bucket may run over many batches: what is kept between them is the last sample, context, least id, id and place, and the rows
    of a bucket's only context so far.
    """
    last, many, held = None, False, []
    for batch in batches:
        if not batch.num_rows:
            continue
        known = batch.column(0).is_valid().to_numpy(zero_copy_only=False)
        if not known.all():
            yield batch.filter(pa.array(~known)).select(["sample", "doc_id", "place", "n"])
            batch = batch.filter(pa.array(known))
            if not batch.num_rows:
                continue
        sample, context, doc, start, n = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
        spread, n = n < 0, np.abs(n)
        size = len(sample)
        new_sample, new_context = np.ones(size, bool), np.ones(size, bool)
        new_sample[1:] = sample[1:] != sample[:-1]
        new_sample[0] = last is None or sample[0] != last[0]
        new_context[1:] = new_sample[1:] | (context[1:] != context[:-1])
        new_context[0] = new_sample[0] or context[0] != last[1]
        once_more = ~new_context
        once_more[1:] &= (doc[1:] == doc[:-1]) & (start[1:] == start[:-1])
        once_more[0] &= last is not None and (doc[0], start[0]) == last[3:]
        begun = np.maximum.accumulate(np.where(new_context, np.arange(size), -1))
        least = np.where(begun >= 0, doc[begun], last[2] if last else 0)
        repeat = doc > least
        bucket = np.cumsum(new_sample) - new_sample[0]
        with_others = np.bincount(bucket, weights=new_context) >= 2
        with_others |= np.bincount(bucket, weights=spread) > 0
        if not new_sample[0]:
            with_others[0] |= many or new_context[bucket == 0].any()
        if held and (new_sample[0] or with_others[0]):
            if not new_sample[0]:
                yield from held
            held = []
        asked = ~repeat & with_others[bucket]
        out = [("sample", pa.array(sample, mask=repeat)), ("doc_id", pa.array(doc)), ("place", pa.array(start)), ("n", pa.array(n))]
        rows = pa.RecordBatch.from_arrays([a for _, a in out], [name for name, _ in out])
        yield rows.filter(pa.array((repeat | asked) & ~once_more))
        many = bool(with_others[-1])
        if not many:
            held.append(rows.filter(pa.array(~repeat & ~once_more & (bucket == bucket[-1]))))
        last = (sample[-1], context[-1], least[-1], doc[-1], start[-1])


STRETCH = "doc_id long, place long, n int"


def strings(texts: DataFrame) -> DataFrame:
    """bucket, large, doc_id, place, n, bytes: the contexts asked for, or single strings of large buckets.

    ``texts`` has doc_id, text and ``asked``, an array of (first, n, sample, large). ``bytes`` are the REACH bytes before the sample
    backwards, then LENGTH from it on, with zeros for those outside the context, then how far the sample is behind
    the context's start. Strings of large buckets that are repeats already
    within the block have no bucket.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, offsets, versions, raw in blocks(batches, REACH + LENGTH):
            block = Block(raw)
            owner = np.repeat(np.arange(len(rows)), [len(r[2]) for r in rows])
            first, n, bucket, large = (np.concatenate([r[i] for r in rows]) for i in (2, 3, 4, 5))
            here = (first >= offsets[owner]) & (first < offsets[owner] + BLOCK_BYTES)
            owner, n, bucket, large = owner[here], n[here], bucket[here], large[here]
            first = first[here] - offsets[owner]
            if not len(owner):
                continue
            each = np.where(large, n, 1)
            at = np.repeat(np.arange(len(owner)), each)
            shift = np.arange(len(at)) - np.repeat(np.cumsum(each) - each, each)
            owner, first, bucket, large = owner[at], first[at] + shift, bucket[at], large[at]
            n = np.where(large, 1, n[at])
            start = first + block.starts[owner]
            sample = start + sliding_window_view(block.hashes >> U(32), REACH + 1)[start].argmin(1)
            padded = np.concatenate([np.zeros(REACH, np.uint8), block.raw, np.zeros(LENGTH, np.uint8)])
            around = sliding_window_view(padded, REACH + LENGTH)[sample]
            left = around[:, REACH - 1 :: -1] * (np.arange(REACH) < (sample - start)[:, None])
            right = around[:, REACH:] * (np.arange(LENGTH) < (start + n - 1 + LENGTH - sample)[:, None])
            ids = np.array([r[0] for r in rows], np.int64)
            doc, settled = ids[owner], np.zeros(len(owner), bool)
            if large.any():
                sums, inverse = block.powers()
                string = (sums[start + LENGTH] - sums[start]) * inverse[start] * SECOND
                bucket = np.where(large, string.view(np.int64), bucket)
                some = np.flatnonzero(large)
                some = some[np.lexsort((doc[some], bucket[some]))]
                new = np.concatenate([[True], np.diff(bucket[some]) != 0])
                settled[some] = doc[some] > doc[some][np.maximum.accumulate(np.where(new, np.arange(len(some)), 0))]
            found = np.concatenate([left, right, (sample - start)[:, None]], 1).astype(np.uint8)
            held = pa.FixedSizeBinaryArray.from_buffers(pa.binary(REACH + LENGTH + 1), len(found), [None, pa.py_buffer(found.tobytes())])
            yield pa.RecordBatch.from_arrays([
                pa.array(bucket, mask=settled), pa.array(large), pa.array(doc), pa.array(place(first + offsets[owner], versions[owner])),
                pa.array(n.astype(np.int32)), held.cast(pa.binary()),
            ], ["bucket", "large", "doc_id", "place", "n", "bytes"])

    return texts.mapInArrow(run, f"bucket long, large boolean, {STRETCH}, bytes binary")


def ranked(bucket: np.ndarray, strings: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rank of each row by bucket and bytes; at each rank how many first bytes it shares with the one before, -1 in another bucket."""
    n, wide = strings.shape
    words = np.zeros((n, -(-wide // 8) * 8), np.uint8)
    words[:, :wide] = strings
    words = words.view(">u8").astype(U)
    order = np.lexsort((*words.T[::-1], bucket))
    differs = np.concatenate([strings[order][1:] != strings[order][:-1], np.ones((n - 1, 1), bool)], 1)
    common = np.append(-1, np.where(np.diff(bucket[order]) != 0, -1, differs.argmax(1)))
    rank = np.empty(n, np.int64)
    rank[order] = np.arange(n)
    return rank, common


def repeats(bucket: np.ndarray, doc: np.ndarray, n: np.ndarray, both: np.ndarray, offset: np.ndarray) -> np.ndarray:
    """Which strings repeat one of a smaller id: booleans (context, string), for whole buckets.

    ``offset``: how far the context's first string starts before the sample.
    """
    left_rank, left_common = ranked(bucket, both[:, :REACH])
    right_rank, right_common = ranked(bucket, both[:, REACH:])
    out = np.zeros((len(bucket), REACH + 1), bool)
    for o in range(REACH + 1):
        rows = np.flatnonzero((offset >= o) & (offset - o < n))
        if not len(rows):
            continue
        left = np.cumsum(left_common < o)[left_rank[rows]]
        right = np.cumsum(right_common < LENGTH - o)[right_rank[rows]]
        order = np.lexsort((doc[rows], right, left))
        new = np.concatenate([[True], (np.diff(left[order]) != 0) | (np.diff(right[order]) != 0)])
        least = doc[rows][order][np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))]
        out[rows[order], (offset[rows] - o)[order]] = doc[rows][order] > least
    return out


def sorted_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of ``strings`` in order of bucket and id -> the repeats as stretches (doc_id, place, n); a block of buckets at a time."""

    def block(table: pa.Table) -> pa.RecordBatch:
        bucket, doc, start, n = (table.column(c).to_numpy() for c in ("bucket", "doc_id", "place", "n"))
        both = np.frombuffer(b"".join(table.column("bytes").to_pylist()), np.uint8).reshape(len(bucket), -1)
        found = repeats(bucket, doc, n, both[:, :-1], both[:, -1].astype(np.int64))
        edge = np.diff(np.pad(found, ((0, 0), (1, 1))).astype(np.int8), axis=1)
        row, first = np.nonzero(edge == 1)
        last = np.nonzero(edge == -1)[1]
        return pa.RecordBatch.from_arrays(
            [pa.array(doc[row]), pa.array(start[row] + (first << 32)), pa.array((last - first).astype(np.int32))], ["doc_id", "place", "n"]
        )

    kept: pa.Table | None = None
    for batch in batches:
        known = batch.column(0).is_valid().to_numpy(zero_copy_only=False)
        if not known.all():
            yield batch.filter(pa.array(~known)).select(["doc_id", "place", "n"])
            batch = batch.filter(pa.array(known))
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        kept = pa.concat_tables([kept, table]) if kept is not None else table
        if kept.num_rows < BLOCK_CONTEXTS:
            continue
        bucket = kept.column("bucket").to_numpy()
        whole = int(np.flatnonzero(bucket != bucket[-1])[-1]) + 1 if bucket[0] != bucket[-1] else 0
        if whole:
            yield block(kept.slice(0, whole))
            kept = kept.slice(whole).combine_chunks()
        elif kept.column("large")[0].as_py():
            # A string of a large bucket fills the block: its first row has the least id and stands for the rest.
            yield block(kept)
            kept = kept.slice(0, 1).combine_chunks()
        # Any other bucket has at most LARGE rows and is kept until it ends.
    if kept is not None and kept.num_rows:
        yield block(kept)


def removals(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, place, n: stretches of ``n`` starts of repeated strings; ``place`` is the first one's start and the text's checksum."""
    texts = id_and_text(docs, id, text).where("doc_id is not null")
    sampled = contexts(texts.where(F.pmod(F.xxhash64("doc_id"), F.lit(SAMPLED)) == 0)).where("sample is not null")
    counts = once(sampled.groupBy("sample").agg(F.count("*").alias("n")), "dedup-sample")
    least = max(50, (counts.agg(F.sum("n")).first()[0] or 0) // FREQUENT)
    # At most FREQUENT numbers.
    frequent = np.array([r.sample for r in counts.where(F.col("n") > least).toLocalIterator()], np.int64)
    task = (
        F.when(F.col("sample").isNull(), F.xxhash64("doc_id", "place")).when(F.col("n") < 0, F.xxhash64("sample", "context")).otherwise(F.xxhash64("sample"))
    )
    found = contexts(texts, frequent).repartition(task).sortWithinPartitions("sample", "context", "doc_id", "place")
    found = once(found.mapInArrow(judged, f"sample long, {STRETCH}"), "dedup-contexts")
    asked = found.where("sample is not null")
    large = asked.groupBy("sample").agg(F.count("*").alias("contexts")).where(F.col("contexts") > LARGE).select("sample", F.lit(True).alias("large"))
    version, first = F.expr("place & 4294967295L").alias("version"), F.shiftright("place", 32)
    mine = asked.join(large, "sample", "left").groupBy("doc_id", version).agg(
        F.collect_list(F.struct(first.alias("first"), "n", "sample", F.coalesce("large", F.lit(False)).alias("large"))).alias("asked")
    )
    # The rows of one id with one text are one here: the join leaves them together, so this takes no further shuffle.
    keyed = texts.withColumn("version", F.crc32("text")).join(mine, ["doc_id", "version"]).dropDuplicates(["doc_id", "version", "text"])
    bucketed = strings(keyed.select("doc_id", "text", "asked"))
    task = F.coalesce("bucket", F.xxhash64("doc_id", "place"))
    repeated = bucketed.repartition(task).sortWithinPartitions("bucket", "doc_id").mapInArrow(sorted_buckets, STRETCH)
    return found.where("sample is null").select("doc_id", "place", "n").unionByName(once(repeated, "dedup-strings"))


def kept(texts: DataFrame) -> DataFrame:
    """What is left of each text: from doc_id, text and ``gone``, an array of (first, n) or null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            out = []
            for text, first, n in zip(batch.column(1).to_pylist(), *columns_of(batch.column(2)), strict=True):
                raw = text.encode()
                if not len(first):
                    out.append((len(raw), 0, 0, raw))
                    continue
                order = np.argsort(first)
                start, end = first[order], np.maximum.accumulate((first.astype(np.int64) + n - 1 + LENGTH)[order])
                new = np.flatnonzero(np.concatenate([[True], start[1:] > end[:-1]]))
                start, end = start[new].tolist(), end[np.append(new[1:], len(end)) - 1].tolist()
                left = [raw[a:b] for a, b in zip([0, *end], [*start, len(raw)], strict=True)]
                out.append((len(raw), sum(end) - sum(start), len(start), b"".join(left)))
            columns = zip(*out, strict=True) if out else ((), (), (), ())
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0)] + [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"]
            )

    return texts.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")


def dedup(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans (maximal removed runs), kept (the bytes that stay, which may cut a character)."""
    gone = removals(docs, id, text).groupBy("doc_id", F.expr("place & 4294967295L").alias("version")).agg(
        F.collect_set(F.struct(F.shiftright("place", 32).alias("first"), "n")).alias("gone")
    )
    texts = id_and_text(docs, id, text).withColumn("version", F.crc32("text"))
    return kept(texts.join(gone, ["doc_id", "version"], "left").select("doc_id", "text", "gone"))
