import itertools
import random
import re
import time
from hashlib import sha256

import pytest

from fieldbook.llm import conversations as cv

ROLES = re.compile(r"(s?(ua)+)?")


def faults(rows):
    """b, d, t or - for each (role, text)."""
    seen, out = set(), []
    for role, text in rows:
        end = text.strip(cv.WHITE)
        out.append("b" if not end else "d" if (role, text) in seen else "t" if end[-1] not in ".!?" else "-")
        seen.add((role, text))
    return out


def brute(rows, most=2):
    """(cost, audit, lines) by trying every sequence of edits with up to ``most`` inserts in a row."""
    best = None
    told = faults(rows)
    gaps = [list(itertools.chain.from_iterable(itertools.product(("user", "assistant"), repeat=k) for k in range(most + 1)))] * (len(rows) + 1)
    options = []
    for (role, text), fault in zip(rows, told, strict=True):
        free = [("D", 3, None)]
        if fault not in "bd":
            more = int(fault == "t")
            free += [("K", more, (role, text)), ("R", 2 + more, ("user", text)), ("R", 2 + more, ("assistant", text))]
        options.append(free)
    for inserts in itertools.product(*gaps):
        for edits in itertools.product(*options):
            cost = sum(e[1] for e in edits) + 2 * sum(map(len, inserts))
            if best is not None and cost > best[0]:
                continue
            audit, lines = "I" * len(inserts[0]), [(r, "") for r in inserts[0]]
            for (letter, _, line), gap in zip(edits, inserts[1:], strict=True):
                audit += letter + "I" * len(gap)
                lines += ([line] if line else []) + [(r, "") for r in gap]
            if ROLES.fullmatch("".join(r[:1] or "-" for r, _ in lines)) and (best is None or (cost, audit) < best[:2]):
                best = (cost, audit, lines)
    return best


def walked(rows, modulus=2**61 - 1):
    walk = cv.Walk(modulus)
    for turn, ((role, _), fault) in enumerate(zip(rows, faults(rows), strict=True)):
        walk.row(turn, role[0], fault)
    return walk.result()


def lines_of(rows, result):
    out = []
    for (role, text), before, new in zip(rows, result["before"], result["roles"], strict=True):
        out += [(r, "") for r in before]
        if new is not None:
            out.append((new or role, text))
    return out + [(r, "") for r in result["after"]]


def conversation(pick, n):
    return [(pick.choice(("user", "user", "assistant", "assistant", "system", "tool")), pick.choice(("Yes.", "No!", "cut", " ", "So?"))) for _ in range(n)]


@pytest.mark.parametrize("modulus", [2**61 - 1, 2, 1])
def test_cheapest_and_least_audit_also_where_hashes_collide(modulus):
    pick = random.Random(modulus)
    for n, times in ((0, 1), (1, 12), (2, 30), (3, 30), (4, 6)):
        for _ in range(times):
            rows = conversation(pick, n)
            result = walked(rows, modulus)
            assert (result["cost"], result["audit"], lines_of(rows, result)) == brute(rows, 2 if n < 3 else 1)


def test_strings_are_compared_like_strings():
    pick = random.Random(4)
    for modulus in (2**61 - 1, 3):
        trails = cv.Trails(modulus)
        nodes, texts = [0], [""]
        for _ in range(400):
            at, letter = pick.randrange(len(nodes)), pick.choice("DIKR")
            nodes.append(trails.add(nodes[at], letter))
            texts.append(texts[at] + letter)
        assert [trails.text(n) for n in nodes] == texts
        for _ in range(4_000):
            a, b = pick.randrange(len(nodes)), pick.randrange(len(nodes))
            assert trails.less(nodes[a], nodes[b]) == (texts[a] < texts[b])


def test_time_and_nodes_grow_with_the_rows():
    took = {}
    for n in (5_000, 20_000):
        began = time.process_time()
        for roles in (("user",), ("assistant", "user"), ("system",)):
            walk = cv.Walk()
            for i in range(n):
                walk.row(i, roles[i % len(roles)][0], "-")
            assert len(walk.result()["audit"]) >= n and len(walk.trails.up) < 20 * n
        took[n] = time.process_time() - began
    assert took[20_000] < 10 * took[5_000] + 1


SCHEMA = "conv_id long, turn long, role string, text string, conv string, place int, fault int, made string, roles string, sha256 long"


def frame_of(spark, rows):
    return spark.createDataFrame([(*r, "c", 1, 2, "m", "r", 3) for r in rows], SCHEMA)


def expected(rows, ids):
    out = []
    for conv in ids:
        mine = sorted([r for r in rows if r[0] == conv], key=lambda r: (r[1] is not None, r[1] or 0, (r[2] or " "), (r[3] if r[3] is not None else " ")))
        plain = [(r[2] if r[2] is not None else " ", r[3] if r[3] is not None else " ") for r in mine]
        told, turns = faults(plain), [r[1] for r in mine if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        initials = [role[:1] for role, _ in plain]
        illegal = sum(a + b not in cv.LEGAL for a, b in zip(initials, initials[1:]))
        cost, audit, lines = brute(plain, 1) if plain else (0, "", [])
        whole = "\n".join(f"{r}:{t}" for r, t in lines)
        out.append((conv, gaps, told.count("b"), told.count("d"), told.count("t"), illegal, cost, audit, sha256(whole.encode()).hexdigest()))
    return sorted(out, key=repr)


def repaired(rows, ids):
    found = cv.repair(rows, ids)
    assert found.columns == ["conv_id", *cv.COUNTS, "audit", "repaired_sha256"]
    return sorted((tuple(r) for r in found.collect()), key=repr)


def test_odd_rows_and_empty_tables(spark):
    rows = [
        (1, 0, "user", "Hi."), (1, 1, "assistant", "Yes."), (2, 5, "assistant", "cut"), (2, None, "system", "S."), (2, 5, "assistant", "cut"), (2, 5, "a", "é😀!"),
        (3, 1, None, "No role."), (3, 2, "user", None), (3, 2, "user", ""), (None, 1, "user", "Q?"), (None, None, None, None), (4, None, "user", "\n\t "),
        (5, 9, "system", "S."), (6, -3, "user", "long " * 50_000 + "."), (6, 4, "user", "b."), (6, 4, "assistant", "a."), (7, 1, "", "x."),
    ]
    frame = frame_of(spark, rows)
    ids = {r[0] for r in rows}
    assert repaired(frame, frame) == expected(rows, ids)
    more = frame_of(spark, [(99, 1, "user", "gone")])
    assert repaired(frame, frame.unionByName(more)) == expected(rows, [*ids, 99])
    assert repaired(frame.limit(0), frame.limit(0)) == []


def test_random_conversations_in_any_order_of_rows(spark):
    pick = random.Random(7)
    rows = [(c, pick.choice((i, i + 1, 2 * i)), *row) for c in range(40) for i, row in enumerate(conversation(pick, pick.randrange(1, 4)))]
    pick.shuffle(rows)
    frame = frame_of(spark, rows).repartition(5)
    assert repaired(frame, frame) == expected(rows, {r[0] for r in rows})


def test_damage_by_hand(spark):
    from zlib import crc32

    rows = [(c, t, "assistant", "One. Two!") for c in range(30) for t in range(4)] + [(None, 1, None, None), (1, None, "system", "S.")]
    want = []
    for conv, turn, role, text in rows:
        lot = crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if lot == 1 else re.sub("[.!?]", "", text) if lot == 2 else text
        want += [(conv, turn, "user" if lot == 4 else role, text)] * (0 if lot == 0 else 2 if lot == 3 else 1)
    got = [tuple(r) for r in cv.damaged(frame_of(spark, rows)).select("conv_id", "turn", "role", "text").collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_repaired_turns_are_rows(spark):
    rows = frame_of(spark, [(1, 0, "assistant", "A."), (1, 1, "user", "B.")])
    placed = cv.turns(rows)
    found = cv.audits(placed)
    got = cv.repaired(placed, found).orderBy("place", "part").collect()
    assert [(r.role, r.text) for r in got] == brute([("assistant", "A."), ("user", "B.")])[2]
