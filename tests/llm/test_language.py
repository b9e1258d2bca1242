import zlib

from fieldbook.llm import language
from tests.llm.conftest import ODD


def test_held_out_accuracy(table):
    docs = table("documents")
    known = docs.where(~language.held_out(docs["doc_id"]))
    told = {r.doc_id: r for r in language.predict(docs, language.fit(known)).collect()}
    truth = {r.doc_id: (r.lang, r.text) for r in docs.collect()}
    held = [i for i in truth if zlib.crc32(str(i).encode()) % 4 == 2 and len(truth[i][1]) > 60]
    assert len(held) > 30
    assert sum(told[i].lang_pred == truth[i][0] for i in held) / len(held) > 0.95
    assert all(0 <= r.score <= 1 for r in told.values())


def test_held_out_rows_are_those_of_the_checksum(table):
    docs = table("documents")
    rows = docs.select("doc_id", language.held_out(docs["doc_id"]).alias("held")).collect()
    assert all(r.held == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)


def test_labels_are_no_input_of_a_prediction(table):
    from pyspark.sql import functions as F

    docs, texts = table("documents").limit(50), language.fit(table("documents"))
    other = docs.withColumn("lang", F.lit("xx")).withColumn("source", F.lit("s")).withColumn("doc_id", -F.col("doc_id"))
    pred = lambda d: sorted((abs(r.doc_id), r.lang_pred, r.score) for r in language.predict(d, texts).collect())
    assert pred(docs) == pred(other)


def test_odd_rows(docs, table):
    texts = language.fit(table("documents"))
    told = language.predict(docs(ODD), texts)
    assert told.columns == ["doc_id", "lang_pred", "score", "rejected"] and told.count() == len(ODD)
    by_id = {r.doc_id: r for r in told.where("doc_id in (1, 2, 4)").collect()}
    assert all(by_id[i].lang_pred == "und" and by_id[i].score == 0 and by_id[i].rejected for i in (1, 2, 4))
    frame = docs(ODD)
    kept = language.accepted(frame, texts)
    assert kept.columns == frame.columns
    assert kept.count() == told.where("not rejected").count()


def test_without_rows_labels_or_letters(docs):
    empty = docs(ODD).limit(0)
    assert language.fit(empty) == {}
    assert language.predict(empty, {}).count() == 0
    assert {r.lang_pred for r in language.predict(docs(ODD), {}).collect()} == {"und"}
    one = language.fit(docs([(1, "some words", "en"), (2, "12 34", "fr"), (3, None, "de"), (4, "text", None)]))
    assert list(one) == ["en"]
    assert {r.lang_pred for r in language.predict(docs([(9, "words")]), one).collect()} == {"en"}


def test_a_rare_label_takes_nothing_from_the_others(table, docs):
    from pyspark.sql import functions as F

    frame = table("documents")
    plain = language.fit(frame)
    odd = frame.where("lang = 'en' and length(text) > 200").orderBy("doc_id").limit(1).withColumns({"lang": F.lit("xx"), "doc_id": F.lit(-5).cast("long")})
    more = language.fit(frame.unionByName(odd))
    assert set(more) == {*plain, "xx"} and len(more["xx"]) <= 1_100
    assert all(len(more[k]) >= 0.95 * len(plain[k]) > 8_192 for k in plain)
    told = language.predict(frame, more).join(frame.select("doc_id", "lang"), "doc_id").where("lang is not null and lang_pred <> 'und'")
    assert told.where("lang_pred = 'xx'").count() <= 2 and told.where("lang_pred = lang").count() >= 0.95 * told.count()


def test_dictionaries_are_cut_to_the_least_of_those_with_enough():
    rows = [("a", "wort " * 20_000), ("b", "word " * 10_000), ("c", "parola " * 100), ("d", "1 2 3")]
    made = language.gathered(rows)
    assert set(made) == {"a", "b", "c"} and len(made["a"]) == len(made["b"]) == 50_000 and len(made["c"]) == 700
    assert len(language.gathered([("a", "wort " * 400), ("b", "word " * 300)])["a"]) == 1500
