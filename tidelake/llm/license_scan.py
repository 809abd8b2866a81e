"""License notices in texts, found by diagonal voting, in DataFrame functions only.

The rolling word k-grams of all texts are joined by their hashes to positions in templates. A hit at
word p of a text and word q of a template votes for the diagonal p - q. Votes are counted by
diagonal, neighbouring diagonals of a template (words put in or left out) are merged into spans, and
spans are verified: the words of every vote are compared, the span may not be much longer than the
template, and enough of the template's k-grams must be in it.

Templates of fewer than five words are phrases: they are looked for as they are, every place counts,
and their diagonals are not merged. NULL and empty texts have no words and no spans. Repeated rows
each keep their row; a doc_id with different texts is judged text by text. Empty tables give empty
results. Further columns of any name do not matter.
"""

from __future__ import annotations

import json
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidelake.llm.common import saved

PHRASE_WORDS = 5
PHRASE_WIDTH, NOTICE_WIDTH = 2, 3
LEAST_SHARE = 0.5
#: Diagonals so many words apart, and so many words of the text between them, belong to one span.
SHIFT = 8
#: A verified span has at most so many times the template's words.
STRETCH = 2
#: Templates are sent to all tasks; so many k-grams are their bound.
MOST_GRAMS = 200_000

#: Phrases and their labels.
PHRASES = (
    ("gpl", "gnu general public license"),
    ("apache", "apache license"),
    ("cc-by", "cc by"),
    ("mit", "mit license"),
)
#: Opening sentences of public licenses and usual ways to name them.
NOTICES = (
    ("gpl-3.0", "this work is licensed under the gnu general public license version 3"),
    (
        "gpl",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu "
        "general public license as published by the free software foundation",
    ),
    ("apache-2.0", "licensed under the apache license version 2 0"),
    ("mit", "released under the mit license"),
    (
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and "
        "associated documentation files the software to deal in the software without restriction",
    ),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0"),
    ("cc-by-4.0", "licensed under a creative commons attribution 4 0 international license"),
    (
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted provided "
        "that the following conditions are met",
    ),
    (
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or without fee is "
        "hereby granted",
    ),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0"),
)
TEMPLATES = PHRASES + NOTICES
#: No xxhash64 of words is looked up under this value but by a chance of 2^-64: the row that stands for a text itself.
ITSELF = 0

_NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """Runs of digits, letters and all characters beyond ASCII, A-Z lowered."""
    low = F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.filter(F.split(low, _NO_WORD), lambda w: w != "")


def rolling(words: Column, width: int) -> Column:
    """Hashes of all runs of ``width`` words."""
    at = F.sequence(F.lit(0), F.size(words) - width)
    runs = F.transform(at, lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(width)]))
    return F.when(F.size(words) >= width, runs).otherwise(F.array().cast("array<long>"))


def template_grams(spark: SparkSession, templates: Iterable[tuple[str, str]]) -> DataFrame:
    """(template, label, phrase, grams, place, width, gram, hash): every k-gram of every template."""
    rows = []
    for number, (label, text) in enumerate(templates):
        words = text.split()
        if len(words) < PHRASE_WIDTH:
            raise ValueError(f"template {text!r} has fewer than {PHRASE_WIDTH} words")
        phrase = len(words) < PHRASE_WORDS
        width = PHRASE_WIDTH if phrase else NOTICE_WIDTH
        grams = [words[i : i + width] for i in range(len(words) - width + 1)]
        known = {"template": number, "label": label, "phrase": phrase, "length": len(words), "grams": len(grams), "width": width}
        rows += [{**known, "place": i, "gram": gram} for i, gram in enumerate(grams)]
    if len(rows) > MOST_GRAMS:
        raise ValueError(f"templates have more than {MOST_GRAMS} k-grams")
    fields = "template int, label string, phrase boolean, length int, grams int, place int, width int, gram array<string>"
    kind = "array<struct<" + fields.replace(", ", ",").replace(" ", ":") + ">>"
    made = spark.range(1).select(F.inline(F.from_json(F.lit(json.dumps(rows)), kind)))

    def hashed(width: int) -> Column:
        return F.xxhash64(*[F.get("gram", F.lit(k)) for k in range(width)])

    short = F.col("width") == PHRASE_WIDTH
    return made.withColumn("hash", F.when(short, hashed(PHRASE_WIDTH)).otherwise(hashed(NOTICE_WIDTH)))


def votes(docs: DataFrame, templates: Iterable[tuple[str, str]] = TEMPLATES) -> DataFrame:
    """One row a text (``template`` NULL) and one a hit: (doc_id, id, key, n_words, template, place, at)."""
    grams = template_grams(docs.sparkSession, templates)
    hit = F.struct("template", "place", "width", "gram").alias("hit")
    looked_up = grams.select("hash", hit)
    no_hit = F.lit(None).cast(looked_up.schema["hit"].dataType).alias("hit")
    looked_up = looked_up.unionByName(docs.sparkSession.range(1).select(F.lit(ITSELF).cast("long").alias("hash"), no_hit))
    texts = docs.select("doc_id", F.xxhash64("text").alias("key"), words_of(F.col("text")).alias("words"))
    hashes = F.concat(
        F.array(F.lit(ITSELF).cast("long")),
        rolling(F.col("words"), PHRASE_WIDTH),
        rolling(F.col("words"), NOTICE_WIDTH),
    )
    rows = texts.select(
        "doc_id", "key", "words", F.size("words").alias("n"), F.posexplode(hashes).alias("slot", "hash")
    ).join(F.broadcast(looked_up), "hash")
    short = F.greatest(F.col("n") - PHRASE_WIDTH + 1, F.lit(0))
    at = F.col("slot") - 1 - F.when(F.col("hit.width") == PHRASE_WIDTH, 0).otherwise(short)
    rows = rows.withColumn("at", at)
    same_words = F.slice("words", F.col("at") + 1, F.col("hit.width")) == F.col("hit.gram")
    return rows.filter(((F.col("slot") == 0) & F.col("hit").isNull()) | ((F.col("slot") > 0) & same_words)).select(
        "doc_id",
        F.coalesce("doc_id", F.lit(0)).alias("id"),
        "key",
        F.col("n").cast("long").alias("n_words"),
        F.col("hit.template").alias("template"),
        F.col("hit.place").alias("place"),
        "at",
    )


def spans_of(hits: DataFrame, templates: Iterable[tuple[str, str]] = TEMPLATES) -> DataFrame:
    """(id, key, label, phrase, start, end, share): the verified spans, in words, ``end`` exclusive."""
    known = template_grams(hits.sparkSession, templates)
    known = F.broadcast(known.select("template", "label", "phrase", "length", "grams", "width").distinct())
    text = ["id", "key", "template"]
    # The places of a diagonal are no more than the template's; votes of repeated rows fall together here.
    diagonal = hits.groupBy(*text, (F.col("at") - F.col("place")).alias("diagonal")).agg(
        F.collect_set("place").alias("places"), F.min("at").alias("first"), F.max("at").alias("last")
    )
    diagonal = diagonal.join(known, "template")
    phrases = diagonal.filter("phrase and size(places) = grams").select(
        "id",
        "key",
        "label",
        "phrase",
        F.col("diagonal").alias("start"),
        (F.col("diagonal") + F.col("length")).alias("end"),
        F.lit(1.0).alias("share"),
    )
    order = Window.partitionBy(*text).orderBy("first", "diagonal")
    apart = (F.abs(F.col("diagonal") - F.lag("diagonal").over(order)) > SHIFT) | (
        F.col("first") - F.lag("last").over(order) > SHIFT
    )
    merged = (
        diagonal.filter("not phrase")
        .withColumn("new", F.coalesce(apart, F.lit(True)).cast("int"))
        .withColumn("run", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy(*text, "run", "label", "phrase", "length", "grams", "width")
        .agg(
            F.size(F.array_distinct(F.flatten(F.collect_list("places")))).alias("found"),
            F.min("first").alias("start"),
            (F.max("last") + F.col("width")).alias("end"),
        )
        .withColumn("share", F.col("found") / F.col("grams"))
    )
    notices = merged.filter(
        (F.col("share") >= LEAST_SHARE) & (F.col("end") - F.col("start") <= STRETCH * F.col("length"))
    )
    return phrases.unionByName(notices.select(*phrases.columns))


def scanned(docs: DataFrame, templates: Iterable[tuple[str, str]] = TEMPLATES) -> DataFrame:
    """(doc_id, n_words, spans) of every row; spans are sorted structs (start, end, label, phrase, share)."""
    templates = tuple(templates)
    rows = saved(votes(docs, templates), "license-votes")
    found = spans_of(rows.filter("template is not null"), templates)
    span = F.struct(*[F.col(c) for c in ("start", "end", "label", "phrase", "share")])
    # A text has no more spans than words times templates; they are its own and stay with it.
    found = found.groupBy("id", "key").agg(F.array_sort(F.collect_list(span)).alias("spans"))
    none = F.array().cast(found.schema["spans"].dataType)
    every = rows.filter("template is null").select("doc_id", "id", "key", "n_words")
    return every.join(found, ["id", "key"], "left").select(
        "doc_id", "n_words", F.coalesce("spans", none).alias("spans")
    )


def labels(spans: Column) -> Column:
    """The distinct labels of spans, sorted, with commas between."""
    return F.array_join(F.array_sort(F.array_distinct(F.transform(spans, lambda s: s["label"]))), ",")
