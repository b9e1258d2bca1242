"""License texts and phrases in documents by diagonal voting.

Every rolling pair of words of every document is hashed and joined with the pairs of the
templates. A hit votes for a diagonal: the place in the document at which the template would
start, that is word position minus template position. Votes are counted per document,
template and diagonal; diagonals next to each other, as a word put in or left out
makes them, are merged into one span.

Verification needs no second look at the text: the join also compares the words of a pair, and
pairs overlap, so a diagonal with all pairs of a template is the template word for word. A
short phrase (``PHRASES``) must be there in full. A longer notice (``NOTICES``) must have
``COVER`` of its pairs within one merged span, and on one diagonal of it all pairs of the words
that tell it from its relatives.

The templates are the short list below unless others are passed in: of any length, full license texts too. Their pairs are
broadcast in blocks of at most ``BROADCAST``, one pass over the documents for each block; the short list makes a few hundred. Which
pairs voted is kept as bits, ``CHUNK`` pairs a number. Only hits are shuffled.

Null and empty texts give a row without words and labels. Repeated rows each give a row, also
those with the same id; a null id stays null. Other columns are left out.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fieldbook.llm.common import id_and_text

BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
COVER = 0.8
# Diagonals at most so far apart belong to one span.
REACH = 3
CHUNK = 63
BROADCAST = 200_000

# Fixed values.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Wording of common license notices, as label, words that have to be there in any case, and text.
NOTICES = (
    ("gpl", "gnu general",
     "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
     "public license as published by the free software foundation either version 3 of the license or at your option "
     "any later version"),
    ("gpl", "gnu general",
     "this work is licensed under the gnu general public license version 3"),
    ("lgpl", "gnu lesser",
     "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser "
     "general public license"),
    ("agpl", "gnu affero",
     "licensed under the gnu affero general public license version 3"),
    ("apache", "apache license",
     "licensed under the apache license version 2 0 the license you may not use this file except in compliance with "
     "the license"),
    ("apache", "apache license",
     "licensed under the apache license version 2 0"),
    ("mit", "free of charge",
     "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
     "documentation files"),
    ("mit", "mit license",
     "released under the mit license"),
    ("bsd", "source and binary",
     "redistribution and use in source and binary forms with or without modification are permitted provided that the"
     " following conditions are met"),
    ("isc", "with or without fee",
     "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
     "granted"),
    ("mpl", "mozilla public",
     "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("cc-by", "creative commons attribution",
     "licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-nc", "by nc",
     "licensed under cc by nc 4 0"),
    ("cc-by-sa", "by sa",
     "licensed under cc by sa 4 0"),
    ("cc0", "waived all copyright",
     "to the extent possible under law the author has waived all copyright and related or neighboring rights to this"
     " work"),
    ("unlicense", "unencumbered software",
     "this is free and unencumbered software released into the public domain"),
    ("proprietary", "all rights reserved",
     "all rights reserved no part of this publication may be reproduced distributed or transmitted in any form or by"
     " any means"),
)


class Template(NamedTuple):
    """``text`` and ``key``, the words of it that have to be there in any case, are words as ``scan_words`` makes them, with spaces between.

    A phrase has to be there in full.
    """

    label: str
    key: str
    text: str
    phrase: bool = False


def scan_words(text: Column) -> Column:
    """Words of a text whose A-Z are in lower case."""
    return F.filter(F.split(F.translate(text, UPPER, LOWER), BETWEEN), lambda w: w != "")


def pair(first: Column, second: Column) -> Column:
    return F.concat(first, F.lit(" "), second)


def short_list() -> list[Template]:
    return [Template(label, text, text, True) for text, label in PHRASES.items()] + [Template(*notice, False) for notice in NOTICES]


def templates(spark: SparkSession, known: Sequence[Template]) -> DataFrame:
    """template, label, phrase, pairs (how many it has), needed (how many have to vote), at (position of the pair), must, gram, hash."""
    rows = []
    for number, t in enumerate(known):
        split, key = t.text.split(), t.key.split()
        start = next((i for i in range(len(split)) if split[i : i + len(key)] == key), None)
        if start is None or len(split) < 2:
            raise ValueError(f"template {number}: {t.key!r} is not among its words, or it is a single word")
        for at, (first, second) in enumerate(zip(split, split[1:], strict=False)):
            rows.append((number, t.label, t.phrase, len(split) - 1, len(key) - 1, at, start <= at < start + len(key) - 1, f"{first} {second}"))
    schema = "template int, label string, phrase boolean, pairs int, needed int, at int, must boolean, gram string"
    table = spark.createDataFrame(rows, schema)
    return table.withColumn("hash", F.xxhash64("gram"))


def hits(docs: DataFrame, id: str = "doc_id", text: str = "text", known: Sequence[Template] | None = None) -> DataFrame:
    """One row (row, doc_id, n_words) for each document and one more for each of its pairs that a template has."""
    known = short_list() if known is None else known
    listed = id_and_text(docs, id, text).select(
        F.monotonically_increasing_id().alias("row"), "doc_id", scan_words(F.col("text")).alias("words")
    )
    # Pairs as (position, hash, words); the row at position -1 keeps documents without a hit.
    none = F.array(F.struct(F.lit(-1).alias("position"), F.lit(None).cast("long").alias("hash"), F.lit(None).cast("string").alias("gram")))
    grams = F.when(
        F.size("words") > 1,
        F.transform(
            F.arrays_zip(F.slice("words", 1, F.size("words") - 1).alias("a"), F.slice("words", 2, F.size("words") - 1).alias("b")),
            lambda ab, i: F.struct(i.alias("position"), F.xxhash64(pair(ab["a"], ab["b"])).alias("hash"), pair(ab["a"], ab["b"]).alias("gram")),
        ),
    )
    pairs = listed.select(
        "row", "doc_id", F.size("words").alias("n_words"), F.explode(F.concat(none, F.coalesce(grams, F.array()))).alias("pair")
    ).select("row", "doc_id", "n_words", "pair.*")
    table = templates(docs.sparkSession, known).withColumnsRenamed({"hash": "known_hash", "gram": "known_gram"})
    blocks = -(-sum(t.text.count(" ") for t in known) // BROADCAST) or 1
    found = None
    for block in range(blocks):
        some = table if blocks == 1 else table.where(F.pmod(F.xxhash64("template", "at"), F.lit(blocks)) == block)
        joined = pairs.join(F.broadcast(some), (pairs["hash"] == some["known_hash"]) & (pairs["gram"] == some["known_gram"]), "left")
        # The documents' own rows come with the first block.
        kept = joined.where(F.col("template").isNotNull() | ((F.col("position") == -1) & F.lit(block == 0))).select(
            "row", "doc_id", "n_words", "template", "label", "phrase", "pairs", "needed", "at", "must", (F.col("position") - F.col("at")).alias("diagonal")
        )
        found = kept if found is None else found.unionByName(kept)
    return found


def diagonals(found: DataFrame) -> DataFrame:
    """Votes per document, template, diagonal and chunk of the template; a row of a document without hits has a null template."""
    return found.withColumn("chunk", F.expr(f"at div {CHUNK}")).groupBy(
        "row", "doc_id", "n_words", "template", "label", "phrase", "pairs", "needed", "diagonal", "chunk"
    ).agg(
        F.min("at").alias("first_at"), F.count_if("must").alias("key_votes"),
        # Which pairs voted, as bits.
        F.bit_or(F.expr(f"shiftleft(1L, int(at % {CHUNK}))")).alias("bits"),
    )


def scan(docs: DataFrame, id: str = "doc_id", text: str = "text", known: Sequence[Template] | None = None) -> DataFrame:
    """Per document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, n_notices.

    The base is the phrases. ``score`` is the best coverage of any template, 1 where a phrase stands;
    ``n_notices`` counts the merged spans of longer notices.
    """
    votes = diagonals(hits(docs, id, text, known))
    along = Window.partitionBy("row", "template").orderBy("diagonal", "chunk")
    same = Window.partitionBy("row", "template", "diagonal")
    notice = ~F.col("phrase")
    # Both kinds in one pass over the votes: a merged span is what follows a gap of more than REACH.
    # The rows of one diagonal, a chunk each, belong together also for a phrase.
    step = F.col("diagonal") - F.lag("diagonal").over(along)
    merged = (
        votes.withColumn("new", F.when(notice, (step > REACH).cast("int")).otherwise(F.coalesce((step != 0).cast("int"), F.lit(1))))
        .withColumn("span", F.sum(F.coalesce("new", F.lit(0))).over(along))
        .withColumn("key_votes", F.sum("key_votes").over(same))
        .groupBy("row", "doc_id", "n_words", "template", "label", "phrase", "pairs", "needed", "span", "chunk")
        .agg(
            F.min(F.when(notice, F.col("diagonal") + F.col("first_at")).otherwise(F.col("diagonal"))).alias("start"),
            F.bit_count(F.bit_or("bits")).alias("bits"),
            F.max("key_votes").alias("key_votes"),
        )
        .groupBy("row", "doc_id", "n_words", "template", "label", "phrase", "pairs", "needed", "span")
        .agg(F.min("start").alias("start"), F.sum("bits").alias("bits"), F.max("key_votes").alias("key_votes"))
        .withColumn("covered", F.col("bits") / F.col("pairs"))
        .withColumn("is_base", F.coalesce(F.col("phrase") & (F.col("bits") == F.col("pairs")), F.lit(False)))
        .withColumn("is_notice", F.coalesce(~F.col("phrase") & (F.col("covered") >= COVER) & (F.col("key_votes") >= F.col("needed")), F.lit(False)))
    )
    base, found = F.col("is_base"), F.col("is_base") | F.col("is_notice")
    joined = lambda condition: F.array_join(F.array_sort(F.collect_set(F.when(condition, F.col("label")))), ",")
    return (
        merged.groupBy("row", "doc_id")
        .agg(
            F.max("n_words").cast("long").alias("n_words"),
            F.count_if(base).cast("long").alias("n_base"),
            F.min(F.when(base, F.col("start"))).cast("long").alias("first_word"),
            F.max(F.when(base, F.col("start"))).cast("long").alias("last_word"),
            joined(base).alias("base_labels"),
            joined(found).alias("labels"),
            F.coalesce(F.max(F.when(found, F.col("covered"))), F.lit(0.0)).alias("score"),
            F.count_if(F.col("is_notice")).cast("long").alias("n_notices"),
        )
        .drop("row")
    )
