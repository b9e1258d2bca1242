"""Repair of the structure of conversations, by the cheapest edits.

A conversation should read ``(s?(ua)+)?`` by the initials of its roles. Its rows, by turn (null first, then role and
text), are walked once. For each of four states (nothing, after the system row, after a user, after an
assistant) the walk keeps the cheapest edits so far, as a string of initials: Keep, Rerole, Delete, Insert. The
strings of a conversation share their beginnings: an edit is a node linked to the edit before. A node knows its ancestors at
1, 2, 4 ... steps and a rolling hash of its string, so of two strings of one cost the lesser is found by a search for their
longest common prefix; the nodes below it are then compared letter by letter up to the node that both share, so a hash that
collides changes nothing. Strings of one cost are never a prefix of one another: every further edit costs, or is the row's own.

A task sees of a row its turn, role initial and fault; texts are joined with the edits and hashed as
a stream. The rows of one conversation are walked by one task, as their order and their hash demand; it holds
the nodes (four a row at most) and no text.

Null roles and texts count as one space, a null conversation as a conversation of its own. Repeated rows are duplicates,
rows of one turn are ordered by role and text. Without rows there is no conversation. Only the four named columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldbook.llm.common import once

KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
COST = {KEEP: 0, REROLE: 2, DELETE: 3, INSERT: 2}
LEFT_TRUNCATED = 1
BLANK, DUPLICATE, TRUNCATED, FINE = "b", "d", "t", "-"
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
# Whose turn it is, by state, and the state after it.
NEXT = {NOTHING: ("user", USER), SYSTEM: ("user", USER), USER: ("assistant", ASSISTANT), ASSISTANT: ("user", USER)}
ENDS = (NOTHING, ASSISTANT)
LEGAL = {"su", "ua", "au"}
WHITE = " \t\n\x0b\f\r"
KEY = "conv"


class Trails:
    """Strings as linked nodes; node 0 is the empty one."""

    def __init__(self, modulus: int = 2**61 - 1):
        self.modulus = modulus
        self.up, self.letter, self.depth, self.hash = [[]], [""], [0], [0]

    def add(self, node: int, letter: str) -> int:
        ups, k = [node], 0
        while k < len(self.up[ups[k]]):
            ups.append(self.up[ups[k]][k])
            k += 1
        self.up.append(ups)
        self.letter.append(letter)
        self.depth.append(self.depth[node] + 1)
        self.hash.append((self.hash[node] * 131 + ord(letter)) % self.modulus)
        return len(self.up) - 1

    def text(self, node: int) -> str:
        letters = []
        while node:
            letters.append(self.letter[node])
            node = self.up[node][0]
        return "".join(reversed(letters))

    def ancestor(self, node: int, depth: int) -> int:
        steps, k = self.depth[node] - depth, 0
        while steps:
            if steps & 1:
                node = self.up[node][k]
            steps, k = steps >> 1, k + 1
        return node

    def less(self, a: int, b: int) -> bool:
        depth = min(self.depth[a], self.depth[b])
        x, y = self.ancestor(a, depth), self.ancestor(b, depth)
        if self.hash[x] == self.hash[y]:
            first = self._first_difference(x, y)
            return self.depth[a] < self.depth[b] if first is None else first
        for k in reversed(range(len(self.up[x]))):
            if k < len(self.up[x]) and self.hash[self.up[x][k]] != self.hash[self.up[y][k]]:
                x, y = self.up[x][k], self.up[y][k]
        first = self._first_difference(self.up[x][0], self.up[y][0])
        return self.letter[x] < self.letter[y] if first is None else first

    def _first_difference(self, x: int, y: int) -> bool | None:
        """Whether x's string is less, by the letters themselves; None if the two are equal."""
        found = None
        while x != y:
            if self.letter[x] != self.letter[y]:
                found = self.letter[x] < self.letter[y]
            x, y = self.up[x][0], self.up[y][0]
        return found


class Walk:
    """One conversation: its rows one by one, then the cheapest edits."""

    def __init__(self, modulus: int = 2**61 - 1):
        self.trails = Trails(modulus)
        self.best: list[tuple[int, int] | None] = [(0, 0), None, None, None]
        self.initials: list[str] = []
        self.faults = {BLANK: 0, DUPLICATE: 0, TRUNCATED: 0, FINE: 0}
        self.illegal = self.turns = 0
        self.first_turn = self.last_turn = None
        self._insert()

    def row(self, turn: int | None, initial: str, fault: str) -> None:
        if turn is not None and (self.last_turn is None or turn != self.last_turn):
            self.turns += 1
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.last_turn = turn
        if self.initials and self.initials[-1] + initial not in LEGAL:
            self.illegal += 1
        self.initials.append(initial)
        self.faults[fault] += 1
        before, self.best = self.best, [None] * 4
        for state, found in enumerate(before):
            if found is None:
                continue
            self._offer(state, found, DELETE)
            if fault in (BLANK, DUPLICATE):
                continue
            more = LEFT_TRUNCATED if fault == TRUNCATED else 0
            role, after = NEXT[state]
            if initial == role[0]:
                self._offer(after, found, KEEP, more)
            elif initial == "s" and state == NOTHING:
                self._offer(SYSTEM, found, KEEP, more)
            self._offer(after, found, REROLE, more)
        self._insert()

    def _offer(self, state: int, found: tuple[int, int], edit: str, more: int = 0) -> None:
        cost, now = found[0] + COST[edit] + more, self.best[state]
        if now is not None and now[0] < cost:
            return
        node = self.trails.add(found[1], edit)
        if now is None or cost < now[0] or self.trails.less(node, now[1]):
            self.best[state] = (cost, node)

    def _insert(self) -> None:
        """Any inserts after a row: two in a row lead from every state to every one they can lead to."""
        for _ in range(2):
            for state in (NOTHING, SYSTEM, USER, ASSISTANT):
                if self.best[state] is not None:
                    self._offer(NEXT[state][1], self.best[state], INSERT)

    def result(self) -> dict:
        ends = [self.best[s] for s in ENDS if self.best[s] is not None]
        cost, node = ends[0]
        for other in ends[1:]:
            if other[0] < cost or (other[0] == cost and self.trails.less(other[1], node)):
                cost, node = other
        audit = self.trails.text(node)
        state, roles, before, waiting = NOTHING, [], [], []
        for edit in audit:
            if edit == INSERT:
                role, state = NEXT[state]
                waiting.append(role)
                continue
            before.append(waiting)
            waiting = []
            if edit == DELETE:
                roles.append(None)
            elif edit == KEEP and self.initials[len(roles)] == "s":
                roles.append("")
                state = SYSTEM
            else:
                role, state = NEXT[state]
                roles.append(role if edit == REROLE else "")
        gaps = 0 if self.first_turn is None else self.last_turn - self.first_turn + 1 - self.turns
        return {
            "gaps": gaps, "blank": self.faults[BLANK], "duplicate": self.faults[DUPLICATE], "truncated": self.faults[TRUNCATED],
            "illegal": self.illegal, "cost": cost, "audit": audit, "roles": roles, "before": before, "after": waiting,
        }


# ``roles``: per row null if deleted, empty if kept, else the new role. ``before``: roles put before the row.
AUDIT = (
    f"{KEY} string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
    "roles array<string>, before array<array<string>>, after array<string>"
)
_ARROW = pa.schema([
    (KEY, pa.string()), *[(n, pa.int64()) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")], ("audit", pa.string()),
    ("roles", pa.list_(pa.string())), ("before", pa.list_(pa.list_(pa.string()))), ("after", pa.list_(pa.string())),
])
MANY = 50_000


def turns(rows: DataFrame) -> DataFrame:
    """``rows`` by conversation with their place, role initial and first fault; ``conv`` is text, a space for null."""
    space = F.lit(" ")
    clean = rows.select(
        F.coalesce(F.col("conv_id").cast("string"), space).alias(KEY), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), space).alias("role"), F.coalesce(F.col("text").cast("string"), space).alias("text"),
    )
    whole = Window.partitionBy(KEY)
    placed = clean.withColumn("place", F.row_number().over(whole.orderBy(F.col("turn").asc_nulls_first(), "role", "text")))
    placed = placed.withColumn("_times", F.row_number().over(Window.partitionBy(KEY, "role", "text").orderBy("place")))
    end = F.rtrim(F.col("text"), F.lit(WHITE))
    fault = (
        F.when(end == "", BLANK).when(F.col("_times") > 1, DUPLICATE)
        .when(~F.substring(end, -1, 1).isin(".", "!", "?"), TRUNCATED).otherwise(FINE)
    )
    last = F.max("place").over(whole) == F.col("place")
    return placed.select(
        KEY, "turn", "role", "text", "place", F.substring("role", 1, 1).alias("initial"), fault.alias("fault"), last.alias("last")
    )


def audits(placed: DataFrame) -> DataFrame:
    """One row per conversation: counts of faults, the cost, the edits' initials and what they do to each row."""
    narrow = placed.select(KEY, "turn", "place", "initial", "fault")
    return narrow.repartition(KEY).sortWithinPartitions(KEY, "place").mapInArrow(_walk, AUDIT)


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    key, walk, done, size = None, None, [], 0
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in (KEY, "turn", "initial", "fault")]
        for conv, turn, initial, fault in zip(*columns):
            if conv != key:
                if walk is not None:
                    done.append({KEY: key, **walk.result()})
                key, walk = conv, Walk()
            walk.row(turn, initial, fault)
            size += 1
        if size > MANY:
            yield pa.RecordBatch.from_pylist(done, schema=_ARROW)
            done, size = [], 0
    if walk is not None:
        yield pa.RecordBatch.from_pylist([*done, {KEY: key, **walk.result()}], schema=_ARROW)


def _edited(placed: DataFrame, found: DataFrame) -> DataFrame:
    """Per row the turns that it became, as (role, text): inserted ones before it, itself, and those after the last row."""
    def empty(roles: Column) -> Column:
        return F.transform(roles, lambda r: F.struct(r.alias("role"), F.lit("").alias("text")))

    role = F.col("roles")[F.col("place") - 1]
    own = F.when(role.isNotNull(), F.array(F.struct(F.when(role == "", F.col("role")).otherwise(role).alias("role"), F.col("text").alias("text"))))
    none = F.array().cast("array<struct<role:string,text:string>>")
    made = F.concat(
        empty(F.col("before")[F.col("place") - 1]), F.coalesce(own, none), F.when(F.col("last"), empty(F.col("after"))).otherwise(none)
    )
    return placed.join(found.select(KEY, "roles", "before", "after"), KEY).select(KEY, "place", made.alias("made"))


def repaired(placed: DataFrame, found: DataFrame) -> DataFrame:
    """conv, place, part, role, text: the repaired conversations; sort by place and part."""
    edited = _edited(placed, found)
    return edited.select(KEY, "place", F.posexplode("made").alias("part", "turn")).select(KEY, "place", "part", "turn.role", "turn.text")


def hashes(placed: DataFrame, found: DataFrame) -> DataFrame:
    """conv, sha256 of the repaired ``role:text`` lines, for conversations of which something is left."""
    line = F.array_join(F.transform("made", lambda t: F.concat(t["role"], F.lit(":"), t["text"])), "\n")
    lines = _edited(placed, found).where(F.size("made") > 0).select(KEY, "place", line.alias("lines"))
    return lines.repartition(KEY).sortWithinPartitions(KEY, "place").mapInArrow(_hashed, f"{KEY} string, sha256 string")


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    key, state = None, None
    for batch in batches:
        keys, found = [], []
        for conv, lines in zip(batch.column(KEY), batch.column("lines")):
            conv = conv.as_py()
            if conv != key:
                if state is not None:
                    keys.append(key)
                    found.append(state.hexdigest())
                key, state = conv, hashlib.sha256()
            else:
                state.update(b"\n")
            state.update(lines.as_buffer())
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(found, pa.string())], names=[KEY, "sha256"])
    if state is not None:
        yield pa.RecordBatch.from_arrays([pa.array([key]), pa.array([state.hexdigest()])], names=[KEY, "sha256"])


COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def repair(rows: DataFrame, all_ids: DataFrame) -> DataFrame:
    """One row per ``conv_id`` of ``all_ids``: the counts, the audit and the hash of the repaired conversation."""
    placed = once(turns(rows), "turns")
    found = once(audits(placed), "audits")
    ids = all_ids.select(F.col("conv_id"), F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")).alias(KEY)).distinct()
    report = ids.join(found.select(KEY, *COUNTS, "audit"), KEY, "left").join(hashes(placed, found), KEY, "left")
    return report.select(
        "conv_id", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in COUNTS], F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"),
    )


def damaged(rows: DataFrame) -> DataFrame:
    """Faults of a known kind, by a checksum of conversation and turn: rows lost, emptied, without stops, repeated or of another role."""
    def text(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    lot = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn")).cast("binary")) % 20
    words = F.when(lot == 1, "").when(lot == 2, F.regexp_replace(text("text"), "[.!?]", "")).otherwise(text("text"))
    return rows.where(lot != 0).select(
        "conv_id", "turn", F.when(lot == 4, "user").otherwise(text("role")).alias("role"), words.alias("text"),
        F.explode(F.when(lot == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_copy"),
    ).drop("_copy")
