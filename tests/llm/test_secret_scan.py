import re
import time

import pytest

from fieldbook.llm import secret_scan as ss
from fieldbook.llm.common import SCHEMAS
from tests.llm.conftest import ODD

HEX = "0123456789abcdef" * 3


def secret(i):
    return (HEX[i % 16 :] + HEX)[:40][::-1]


ROWS = [(i, f'thonre was here, set token = "{secret(i)}" and go on with the reading of it') for i in range(40)]
ROWS += [(100 + i, f"write to jo{i}.somebody@mail{i}.example.com or card 40418949746087{i % 90 + 10} from 192.168.100.{i + 100}") for i in range(40)]


@pytest.fixture(scope="module")
def forest(spark):
    frame = spark.createDataFrame([(i, t, "src/app/main.py") for i, t in ROWS], "doc_id long, text string, source string")
    known = ss.corpus_statistics(frame)
    return known, ss.train(ss.reviewed(ss.candidates(frame, known)))


def test_secrets_stay_and_harmless_candidates_go(docs, forest):
    known, model = forest
    fresh = [(1, f"password={secret(3)}"), (2, "mail to someone.else@mail77.example.com please"), (3, "AKIA" + "Q7ZK" * 4 + " is here")]
    told = {(r.doc_id, r.value): r.is_secret for r in ss.scored(ss.candidates(docs(fresh), known), model).collect()}
    assert told[1, secret(3)] and told[3, "AKIA" + "Q7ZK" * 4]
    assert not told[2, "someone.else@mail77.example.com"]


def test_spans_are_code_points_and_redaction_keeps_the_rest(docs):
    text = f"é😀 token: '{secret(1)}' then password={secret(2)}, done"
    rows = [(1, text), (1, text), (2, "nothing"), (None, text), (3, None)]
    frame = docs(rows)
    secrets = ss.scan(frame)
    assert {text[r.start : r.end] for r in secrets.collect()} == {secret(1), secret(2)}
    clean = ss.redacted(frame, secrets)
    assert clean.columns == frame.columns
    want = text.replace(secret(1), "[secret]").replace(secret(2), "[secret]")
    got = sorted(((r.doc_id, r.text, r.n_chars) for r in clean.collect()), key=repr)
    assert got == sorted([(1, want, len(want)), (1, want, len(want)), (2, "nothing", None), (None, want, len(want)), (3, None, None)], key=repr)


def test_odd_rows_and_empty_tables(docs):
    frame = docs(ODD)
    assert {r.doc_id for r in ss.scan(frame).collect()} <= {i for i, _ in ODD}
    assert ss.scan(frame.limit(0)).count() == 0
    assert ss.redacted(frame, ss.scan(frame)).count() == len(ODD)


def test_findings_of_the_table(spark):
    docs = spark.read.schema(SCHEMAS["documents"]).parquet("/root/testdata/sf0.01/documents.parquet")
    planted = r"AKIA[0-9A-Z]{16}|(?<=password=)[0-9a-f]{18}|(?<=token = \")[0-9a-f]{40}"
    want = {(r.doc_id, *m.span()) for r in docs.collect() for m in re.finditer(planted, r.text)}
    got = {(r.doc_id, r.start, r.end) for r in ss.scan(docs).where("is_secret").collect()}
    assert want and want <= got and len(got - want) <= len(want)


def test_candidates_do_not_overlap():
    text = f'secret_key = "{secret(5)}" ghp_{"aB3" * 12} -----BEGIN RSA PRIVATE KEY----- api-key: eyJhbGciOiJI.eyJzdWIiOiIx.SflKxwRJSMeKKF'
    spans = [(a, b) for _, a, b in ss.found(text)]
    assert len(spans) == 4 and all(b <= c for (_, b), (c, _) in zip(spans, spans[1:], strict=False))


@pytest.mark.parametrize("gap", [" ", " " * 5, " " * 60, "\t" * 8, " \t" * 30])
def test_aligned_assignments_are_candidates_and_look_like_others(docs, forest, gap):
    known, model = forest
    for text, value in [(f"password{gap}={gap}hunter2xyz", "hunter2xyz"), (f'api_key:{gap}"abc123def9"', "abc123def9"), (f"token{gap}={gap}'{secret(4)}'", secret(4))]:
        ((kind, start, end),) = ss.found(text)
        assert (kind, text[start:end]) == ("assigned", value)
        plain = text.replace(gap, " ")
        assert ss.features(text, start, end, None, known) == ss.features(plain, plain.index(value), plain.index(value) + len(value), None, known)
    rows = [(1, f"here token{gap}={gap}{secret(6)} stays"), (2, f"here password{gap}={gap}{secret(7)} stays")]
    secrets = ss.scored(ss.candidates(docs(rows), known), model)
    clean = {r.doc_id: r.text for r in ss.redacted(docs(rows), secrets).collect()}
    assert clean == {1: f"here token{gap}={gap}[secret] stays", 2: f"here password{gap}={gap}[secret] stays"}


def test_keys_of_any_length_are_formats_and_whole():
    for kind, key in [
        ("jwt", f"eyJ{'aB3_' * 5}.{'x9-Y' * 1500}.{'Zk4' * 2000}"), ("jwt", f"eyJ{'aB3_' * 2000}.{'x9-Y' * 3}.{'Zk4' * 9}"),
        ("slack", f"xoxb-{'12aB-' * 60}9"), ("stripe", f"sk_live_{'4eC39' * 40}"),
    ]:
        for before, after in (("", ""), ("the key ", " is here"), ("x-", "\n")):
            assert ss.found(before + key + after) == [(kind, len(before), len(before) + len(key))]


def test_time_of_the_patterns_grows_with_the_text():
    began = time.process_time()
    for text in ("eyJ-" * 150_000, "eyJ-" * 150_000 + ".", "eyJaaaaaaaa." + "eyJ-" * 150_000, "eyJ-" * 75_000 + "." + "eyJ-" * 75_000 + ".eyJ", "xoxb-" * 100_000,
                 "password" + " " * 600_000, ("password" + " " * 50) * 10_000, "password=" + " " * 600_000, "sk_live_" * 75_000):
        ss.found(text)
    assert time.process_time() - began < 20


@pytest.mark.parametrize("text, secrets", [
    ('password: "correct horse battery staple 99"', ["correct horse battery staple 99"]), ("api_key => 'it is \\' so long'", ["it is \\' so long"]),
    ("password_prod = hunter2xyz", ["hunter2xyz"]), ('{"db_password": "hunter2xyz", "user": "bob"}', ["hunter2xyz"]),
    ("password=ab,cdefghij k", ["ab,cdefghij"]), ("password=hunter2xyz,user=bob", ["hunter2xyz"]), ('token: "unclosed value', ["unclosed"]),
    ("password=password=hunter2xyz", ["password=hunter2xyz"]), ("user = somebody_else", []),
])
def test_values_are_whole(text, secrets):
    assert [(kind, text[a:b]) for kind, a, b in ss.found(text)] == [("assigned", s) for s in secrets]


def test_a_pem_key_is_one_finding_with_its_body():
    body = "\n".join(["MIIEpAIBAAKCAQEA" + "xY9+/" * 9] * 12 + ["Zz0="])
    for head in ("", "Proc-Type: 4,ENCRYPTED\nDEK-Info: AES-128-CBC,0A1B\n\n"):
        key = f"-----BEGIN RSA PRIVATE KEY-----\n{head}{body}\n-----END RSA PRIVATE KEY-----"
        assert ss.found(f"a {key} b") == [("private_key", 2, 2 + len(key))]
    assert ("private_key", 0, 31) in ss.found("-----BEGIN RSA PRIVATE KEY-----\n" + "no end of it here")


def test_time_grows_with_the_candidates():
    pick = __import__("random").Random(2)
    began = time.process_time()
    for text in (" ".join(f"{pick.getrandbits(64):016x}" for _ in range(100_000)), 'password="' * 60_000, "password=" * 60_000, "password" * 60_000,
                 "-----BEGIN RSA PRIVATE KEY-----\n" * 20_000, "token: abcdef1 " * 40_000):
        ss.found(text)
    assert time.process_time() - began < 15


def test_clear_of_against_all_pairs():
    from fieldbook.llm.common import clear_of

    pick = __import__("random").Random(3)
    for _ in range(300):
        spans = sorted(("k", a, a + pick.randrange(1, 5)) for a in (pick.randrange(40) for _ in range(8)))
        taken = [(a, a + pick.randrange(1, 6)) for a in (pick.randrange(40) for _ in range(5))]
        assert clear_of(spans, taken) == [s for s in spans if all(s[2] <= a or b <= s[1] for a, b in taken)]
