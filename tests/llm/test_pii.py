import random
import re
import time

from fieldbook.llm import pii
from tests.llm.conftest import ODD


def brute(text):
    found = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(part) <= 255 for part in m.group().split(".")):
            found.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m.group())
        if 16 <= len(digits) <= 19 and sum(sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(digits[::-1])) % 10 == 0:
            found.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 8 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            found.append(("phone", *m.span()))
    return found


def test_base_spans_against_the_plain_patterns():
    pick = random.Random(3)
    for _ in range(30_000):
        text = "".join(pick.choice("ab@@..-0123456789 12.+()é%_") for _ in range(pick.randrange(60)))
        assert pii.base_spans(text) == brute(text)


def test_long_runs_take_linear_time():
    began = time.process_time()
    for text in ("a" * 10**6 + "@", "1" * 10**6, "+1" + " " * 10**6, "1.2." * 10**5, "a@" * 10**5, "AB12 " * 10**5, "1-" * 10**5, "x[at]" * 10**5):
        pii.proposals(text, pii.base_spans(text))
    assert time.process_time() - began < 20


CONTACTS = [
    (i, f"Please call our phone (30{i % 10}) 555-01{i % 90 + 10} or mail to jo{i}[at]mail[dot]org, card 378282246310005 on file, contact me{i}@mail.org")
    for i in range(60)
]
NOISE = [(100 + i, f"order version 30{i % 10}-555-01{i % 90 + 10} part x{i} serial 1234567890123{i % 10}") for i in range(60)]


def test_votes_tell_further_spans_from_noise(docs):
    frame = docs(CONTACTS + NOISE)
    scores = pii.fit(frame)
    rows = {r.doc_id: r for r in pii.find(frame, scores).collect()}
    kinds = lambda row: {s.kind for s in row.extra}
    assert all(kinds(rows[i]) >= {"spelled_email", "local_phone"} for i, _ in CONTACTS)
    assert not any(kinds(rows[i]) for i, _ in NOISE)
    assert all([(s.kind, s.start, s.end) for s in rows[i].base] == brute(t) for i, t in CONTACTS + NOISE)


def test_odd_rows_and_empty_tables(docs):
    frame = docs(ODD)
    scores = pii.fit(frame)
    found = pii.find(frame, scores)
    assert found.columns == ["doc_id", "base", "extra"] and found.count() == len(ODD)
    assert pii.fit(frame.limit(0)) == {} and pii.find(frame.limit(0), {}).count() == 0


def test_positions_are_code_points(docs):
    text = "😀é me@mail.org"
    row = pii.find(docs([(1, text)]), {}).first()
    assert [text[s.start : s.end] for s in row.base] == ["me@mail.org"]


def test_reliabilities_of_a_useless_labeler_change_nothing():
    counts = {"email|1,1,0,1,1|2": 50, "email|1,1,0,-1,1|2": 50, "account|-1,-1,-1,1,-1|2": 40, "account|-1,-1,-1,-1,-1|2": 40}
    chance = pii.reliabilities(counts)
    assert min(v for k, v in chance.items() if k.startswith("email")) > 0.9
    assert max(v for k, v in chance.items() if k.startswith("account")) < 0.1


def test_time_grows_with_the_spans():
    import time

    began = time.process_time()
    text = " ".join(f"+1 202 555 {i % 10000:04} and 123-45-{i % 9000 + 1000} or jo{i}@x.example.com" for i in range(40_000))
    base = pii.base_spans(text)
    assert len(base) >= 80_000 and len(pii.proposals(text, base)) >= 40_000
    assert time.process_time() - began < 15
