"""What comes later for the same key: one ordered pass over ranges of (key, time).

All rows are sorted once, by key and from the latest time to the earliest, into as many ranges of about equal size as the
session has shuffle partitions (Spark samples the bounds). So a hot key, a burst and a pile of rows at one instant lie in many ranges, and no task holds a key.
Each range is then walked as a stream: per key it keeps, for every mark, the last value met, which is the
nearest later one. A range also says what it ends with: for its last key the values met so far, with and
without those of its last instant. These few rows (three a range) settle what the first key of a range takes from the ranges
before it; they are broadcast, and their number is that of the ranges.

The walk's result is written to the shared folder once and read for both, the rows and the ends, so both see the same
ranges. Rows are shuffled once and never joined with each other. Rows that are the same in every column can't be told
apart and share a range.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldbook.functions.clock import micros
from fieldbook.session import stored

MICROS = "_us"
# What a row of the walk's result is: an input row, or what a range ends or begins with.
ROW, END, BEFORE_LAST_INSTANT, BEGIN = range(4)
# Whether a row has the first key of its range, and whether it also lies at the range's first instant.
INNER, FIRST_KEY, FIRST_INSTANT = range(3)


def later_minima(
    rows: DataFrame,
    *,
    key: str,
    ts: str,
    marks: Mapping[str, Column],
    keep: Sequence[str],
    only: Column | None = None,
) -> DataFrame:
    """``keep`` plus, per mark, its minimum over the strictly later rows of the same key.

    A mark's value must be ``_us`` (microseconds) or a struct that begins with it; a row may have a value for one mark only. ``only``
    limits the rows returned, not the rows looked at. A row without a key is kept and finds nothing.
    """
    timed = rows.withColumn(MICROS, micros(F.col(ts)))
    wanted = F.lit(True) if only is None else F.coalesce(only, F.lit(False))
    return _walked(timed, key, marks, keep, wanted, strictly=True)


def next_rows(df: DataFrame, *, key: str, ts: str, id: str, name: str, values: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """``keep`` plus ``name``: the values of the following row of the key in (ts, id) order, as a struct."""
    timed = df.withColumn(MICROS, micros(F.col(ts)))
    mark = {name: F.struct(F.col(MICROS), F.col(id).alias("id"), F.struct(*values).alias("values"))}
    found = _walked(timed, key, mark, keep, F.lit(True), strictly=False)
    return found.withColumn(name, F.col(f"{name}.values"))


def _walked(rows: DataFrame, key: str, marks: Mapping[str, Column], keep: Sequence[str], wanted: Column, strictly: bool) -> DataFrame:
    # Texts of SQL below, as a plan of many short columns costs more to build than to run on small inputs.
    names = [f"_m{i}" for i in range(len(marks))]
    named = rows.select(
        F.col(key).alias("_key"), F.col(MICROS), wanted.alias("_wanted"), F.struct(*keep).alias("_keep"),
        *[value.alias(name) for name, value in zip(names, marks.values(), strict=True)],
    )
    kind = ", ".join(f"if({name} is null, null, {i})" for i, name in enumerate(names))
    narrow = named.selectExpr(
        "_key", MICROS, f"if(_key is null, null, coalesce({kind}, null)) as _kind", "_wanted", "_keep", *[f"if(_key is null, null, {n}) as {n}" for n in names]
    )
    kinds = {f.name: f.dataType for f in narrow.schema}
    # Of one instant the least value comes last, so that it is the last one met. What is kept only spreads rows that tie.
    plain = ", ".join(f"_keep.`{f.name}`" for f in kinds["_keep"] if not _has_map(f.dataType))
    # A mark that is a number is the instant itself.
    payloads = [n for n in names if isinstance(kinds[n], T.StructType)]
    order = [F.col("_key").asc_nulls_first(), F.col(MICROS).desc(), F.col("_kind"), *[F.col(n).desc_nulls_last() for n in payloads]]
    order += [F.expr(f"xxhash64({plain})")] if plain else []
    # The number is given, so that as many tasks walk as the session deals shuffles over, also where few bytes are walked.
    many = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = narrow.repartitionByRange(many, *order).sortWithinPartitions(*order)
    out = T.StructType([
        T.StructField("_role", T.IntegerType()), T.StructField("_range", T.IntegerType()), T.StructField("_place", T.IntegerType()),
        *[T.StructField(n, kinds[n]) for n in ("_key", MICROS, "_keep", *names)],
    ])
    done = stored(ordered.mapInArrow(_walk(names, strictly), out), "ranges")
    handed = F.broadcast(_handed(done.where(f"_role <> {ROW}"), names))
    found = done.where(f"_role = {ROW}").join(handed, "_range", "left")
    return found.selectExpr("_keep.*", *[
        f"coalesce({name}, case _place when {FIRST_KEY} then {name}_key when {FIRST_INSTANT} then {name}_instant end) as `{mark}`"
        for name, mark in zip(names, marks, strict=True)
    ])


def _has_map(kind: T.DataType) -> bool:
    return "map<" in kind.simpleString()


def _handed(ends: DataFrame, names: Sequence[str]) -> DataFrame:
    """Per range: for its first key what the ranges before it met, for rows after their instants and for those at the same one."""
    def met(name: str, role: int, window: str) -> str:
        return f"min(if(_role = {role}, {name}, null)) over {window}"

    columns = [f"{met(n, END, 'earlier')} as {n}_key" for n in names]
    columns += [f"least({met(n, BEFORE_LAST_INSTANT, 'earlier')}, {met(n, END, 'later')}) as {n}_instant" for n in names]
    return ends.sparkSession.sql(f"""
        select * except (_role) from (
          select _role, _range, {', '.join(columns)} from {{ends}}
          window earlier as (partition by _key order by _range range between unbounded preceding and 1 preceding),
                 later as (partition by _key order by {MICROS} desc range between unbounded preceding and 1 preceding))
        where _role = {BEGIN}""", ends=ends)


def _changes(column: pa.Array) -> np.ndarray:
    """Whether each value differs from the one before; nulls are equal to each other."""
    n = len(column)
    if n < 2:
        return np.ones(n, bool)
    a, b = column.slice(1), column.slice(0, n - 1)
    differs = pc.fill_null(pc.not_equal(a, b), False).to_numpy(zero_copy_only=False)
    missing = column.is_null().to_numpy(zero_copy_only=False)
    return np.concatenate([[True], differs | (missing[1:] != missing[:-1])])


def _picked(column: pa.Array, at: np.ndarray) -> pa.Array:
    """The values at these places, null where the place is negative."""
    return column.take(pa.array(np.maximum(at, 0), mask=at < 0))


def _walk(names: Sequence[str], strictly: bool):
    """The pass over one sorted range. Between batches it keeps the rows that later rows may still need: two a mark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        range_id, kept, first = TaskContext.get().partitionId(), None, None
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            more = 0 if kept is None else kept.num_rows
            if more:
                table = pa.Table.from_batches([kept, batch]).combine_chunks()
                batch = table.to_batches()[0]
            key, us, kind = (batch.column(c) for c in ("_key", MICROS, "_kind"))
            n, every = batch.num_rows, np.arange(batch.num_rows)
            new_key = _changes(key)
            new_group = new_key | _changes(us) if strictly else np.ones(n, bool)
            key_start = np.maximum.accumulate(np.where(new_key, every, 0))
            group_start = np.maximum.accumulate(np.where(new_group, every, 0))
            kinds = pc.fill_null(kind, -1).to_numpy(zero_copy_only=False)
            met, found = [], []
            for i in range(len(names)):
                seen = np.maximum.accumulate(np.where(kinds == i, every, -1))
                earlier = np.append(-1, seen)[group_start]
                met.append(np.where(seen >= key_start, seen, -1))
                found.append(np.where(earlier >= key_start, earlier, -1))
            if first is None:
                first = key[0], us[0]
                yield _end(batch, names, range_id, BEGIN, 0, np.full(len(names), -1))
            place = np.zeros(n, np.int32)
            if first is not False:
                # The rows of the first key come first; once it has ended, all rows are inner ones.
                until = n if not new_key[1:].any() else int(np.argmax(new_key[1:])) + 1
                place[:until] = FIRST_KEY
                if strictly:
                    at_first = pc.equal(us, first[1]).to_numpy(zero_copy_only=False)
                    place[:until][at_first[:until]] = FIRST_INSTANT
                if until < n:
                    first = False
            rows = every[more:][batch.column("_wanted").to_numpy(zero_copy_only=False)[more:]]
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(len(rows), ROW, np.int32)), pa.array(np.full(len(rows), range_id, np.int32)), pa.array(place[rows]),
                pa.nulls(len(rows), key.type), pa.nulls(len(rows), us.type), batch.column("_keep").take(pa.array(rows)),
                *[_picked(batch.column(name), at[rows]) for name, at in zip(names, found, strict=True)],
            ], ["_role", "_range", "_place", "_key", MICROS, "_keep", *names])
            ends, befores = np.array([m[-1] for m in met]), np.array([f[-1] for f in found])
            needed = sorted({n - 1, *ends.tolist(), *befores.tolist()} - {-1})
            last = batch, ends, befores
            kept = batch.take(pa.array(needed))
        if last is not None:
            batch, ends, befores = last
            yield _end(batch, names, range_id, END, batch.num_rows - 1, ends)
            yield _end(batch, names, range_id, BEFORE_LAST_INSTANT, batch.num_rows - 1, befores)

    return run


def _end(batch: pa.RecordBatch, names: Sequence[str], range_id: int, role: int, row: int, at: np.ndarray) -> pa.RecordBatch:
    own = pa.array([row])
    return pa.RecordBatch.from_arrays([
        pa.array([role], pa.int32()), pa.array([range_id], pa.int32()), pa.array([INNER], pa.int32()), batch.column("_key").take(own),
        batch.column(MICROS).take(own), pa.nulls(1, batch.column("_keep").type),
        *[_picked(batch.column(name), at[i : i + 1]) for i, name in enumerate(names)],
    ], ["_role", "_range", "_place", "_key", MICROS, "_keep", *names])
