import re

from fieldbook.llm import license_scan as ls
from tests.llm.conftest import ODD


def brute(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
    found = [
        (at, label) for phrase, label in ls.PHRASES.items() for at in range(len(words)) if words[at : at + phrase.count(" ") + 1] == phrase.split()
    ]
    starts = [at for at, _ in found]
    return len(words), len(found), min(starts, default=None), max(starts, default=None), ",".join(sorted({label for _, label in found}))


def check(scanned, rows):
    key = lambda row: repr(row)
    got = [(r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in scanned.collect()]
    assert sorted(got, key=key) == sorted(((i, *brute(t)) for i, t in rows), key=key)


def test_base_places_of_the_table(table):
    docs = table("documents")
    check(ls.scan(docs), [(r.doc_id, r.text) for r in docs.collect()])


def test_odd_texts_repeats_and_overlapping_phrases(docs):
    rows = [*ODD, (20, "CC-BY cc by;CC\nBY"), (20, "CC-BY cc by;CC\nBY"), (21, "Apache License apache éapache license"), (22, "mit"),
            (23, "the MIT License " * 500), (None, "mit license")]
    check(ls.scan(docs(rows)), rows)
    assert ls.scan(docs(rows).limit(0)).count() == 0


def labels(docs, text):
    row = ls.scan(docs([(1, text)])).first()
    return row.labels, row.n_notices, row.score


def test_notices_survive_small_changes_and_are_told_from_relatives(docs):
    notice = next(text for label, _, text in ls.NOTICES if label == "bsd")
    words = notice.split()
    assert labels(docs, "x " * 9 + notice.upper() + " y") == ("bsd", 1, 1.0)
    inserted = words[:8] + ["really"] + words[8:]
    assert labels(docs, " ".join(inserted))[:2] == ("bsd", 1)
    assert labels(docs, " ".join(words[: len(words) // 2])) == ("", 0, 0.0)
    agpl = next(text for label, _, text in ls.NOTICES if label == "agpl")
    assert labels(docs, agpl)[0] == "agpl"
    assert labels(docs, "This work is licensed under the GNU General Public License, version 3.")[0] == "gpl"
    assert labels(docs, "the of and " * 200) == ("", 0, 0.0)


def test_the_short_list_is_made_of_words():
    for t in ls.short_list():
        assert t.key in t.text and t.text.split() == re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t.text.lower())


def full_text(n=700):
    return " ".join(f"w{i * 7919 % 997}x{i % 13}" for i in range(n))


def test_full_license_texts_as_templates(docs):
    text = full_text()
    words = text.split()
    known = [ls.Template("long", " ".join(words[60:66]), text), ls.Template("saying", " ".join(words[:150]), " ".join(words[:150]), True), *ls.short_list()]
    lost = [w for i, w in enumerate(words) if i % 50]  # a word in fifty left out: 96 % of the pairs, on many diagonals
    rows = [
        (1, "x y " + text + " z"), (2, " ".join(lost)), (3, " ".join(words[:500])), (4, " ".join(words[:62] + words[66:])),
        (5, " ".join(words[:150])), (6, " ".join(words[:149])), (7, "released under the MIT License"), (8, ""), (9, text + " and " + text),
    ]
    told = {r.doc_id: (r.labels, r.base_labels, r.first_word, r.n_notices) for r in ls.scan(docs(rows), known=known).collect()}
    assert told[1] == ("long,saying", "saying", 2, 1)
    assert told[2][0] == "long"
    assert told[3] == ("saying", "saying", 0, 0) and told[4] == ("", "", None, 0)  # too little; the key words are missing
    assert told[5] == ("saying", "saying", 0, 0) and told[6] == ("", "", None, 0)
    assert told[7][0] == "mit" and told[8] == ("", "", None, 0) and told[9] == ("long,saying", "saying", 0, 2)


def test_templates_in_several_blocks_give_the_same(docs, monkeypatch):
    rows = [(i, f"{text} and more; {phrase}") for i, ((_, _, text), phrase) in enumerate(zip(ls.NOTICES, list(ls.PHRASES) * 5))] + ODD
    whole = sorted(map(repr, ls.scan(docs(rows)).collect()))
    monkeypatch.setattr(ls, "BROADCAST", 90)
    assert sorted(map(repr, ls.scan(docs(rows)).collect())) == whole


def test_a_template_without_its_key_is_refused(spark):
    import pytest

    for bad in (ls.Template("x", "not there", "some other words"), ls.Template("x", "one", "one")):
        with pytest.raises(ValueError, match="template 0"):
            ls.templates(spark, [bad])


def test_no_python_in_the_plan(docs):
    plan = ls.scan(docs(ODD))._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))
