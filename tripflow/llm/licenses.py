"""License scan by diagonal voting over rolling word k-grams.

Every rolling hash of GRAM words is joined to the template positions that carry the same hash; text
position minus template position is the diagonal, and the matches of a template are votes for
diagonals. A diagonal that every k-gram of a short phrase votes for is a place where the phrase
stands; for long templates neighbouring diagonals, which an inserted or dropped word splits, are
merged to one span, verified by the share of the template's positions that it covers. The join
compares the words themselves after their hash, so a hash collision cannot vote.

Defined results: a null or empty text has no words and no labels; repeated rows give repeated rows;
a text shorter than GRAM words has no k-gram; columns other than doc_id and text are ignored.
Everything here is DataFrame expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F


GRAM = 3
#: Diagonals at most so many words apart belong to one span.
NEAR = 5
#: The share of a template's positions that a span must cover.
COVERED = 0.6

# The phrases whose places are counted, with their labels.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

# Opening sentences and notices of well-known licenses.
TEMPLATES = {
    "mit-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    "documentation files (the Software), to deal in the Software without restriction, including without limitation the "
    "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
    "apache-2-notice": "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in "
    "compliance with the License. You may obtain a copy of the License at",
    "apache-2-line": "Licensed under the Apache License, Version 2.0",
    "bsd-text": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
    "the following conditions are met",
    "gpl-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
    "Public License as published by the Free Software Foundation",
    "gpl-3-line": "This work is licensed under the GNU General Public License, version 3",
    "mit-line": "Released under the MIT License",
    "cc-by-nc-line": "Licensed under CC BY-NC 4.0",
    "cc-by-sa-line": "This work is licensed under a Creative Commons Attribution ShareAlike 4.0 International License",
    "cc0-line": "To the extent possible under law the author has waived all copyright and related or neighboring rights to this work",
    "mpl-2-notice": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
}

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """Lower-case words. Of the letters that lower() turns into ASCII only A-Z may match, so the Kelvin sign and the
    dotted capital I are replaced before by letters that stay outside ASCII; words of ASCII letters come out the same."""
    plain = F.replace(F.replace(F.coalesce(text, F.lit("")), F.lit("K"), F.lit("ĸ")), F.lit("İ"), F.lit("ı"))
    return F.array_remove(F.split(F.lower(plain), SEPARATORS), "")


def templates(spark: SparkSession) -> DataFrame:
    """(gram, hash, template, place, size, exact, label): the k-grams of all templates, a fixed small table."""
    rows = [(text, label, True) for text, label in PHRASES.items()] + [(text, label, False) for label, text in TEMPLATES.items()]
    texts = spark.createDataFrame([(i, *row) for i, row in enumerate(rows)], "template int, text string, label string, exact boolean")
    split = texts.select("template", "label", "exact", words_of(F.col("text")).alias("words"))
    split = split.withColumn("size", F.size("words") - GRAM + 1)
    each = split.select("*", F.explode(F.sequence(F.lit(0), F.col("size") - 1)).alias("place"))
    gram = [F.get("words", F.col("place") + k) for k in range(GRAM)]
    return each.select(F.xxhash64(*gram).alias("hash"), F.concat_ws(" ", *gram).alias("gram"), "template", "place", "size", "exact", "label")


def _votes(rows: DataFrame) -> DataFrame:
    """(row, template, size, exact, label, diagonal, place): k-grams of the texts that stand in a template."""
    known = F.broadcast(templates(rows.sparkSession))
    at = rows.select("row", "words", F.explode(F.sequence(F.lit(0), F.size("words") - GRAM)).alias("at"))
    gram = [F.get("words", F.col("at") + k) for k in range(GRAM)]
    hashed = at.select("row", "at", F.xxhash64(*gram).alias("hash"), F.concat_ws(" ", *gram).alias("found"))
    same = hashed.join(known, "hash").where("found = gram")
    return same.select("row", "template", "size", "exact", "label", (F.col("at") - F.col("place")).alias("diagonal"), "place")


def spans(rows: DataFrame) -> DataFrame:
    """(row, label, exact, first, last, covered): verified spans of templates in the texts of ``rows`` (row, words)."""
    by = ["row", "template", "size", "exact", "label"]
    diagonals = _votes(rows).groupBy(*by, "diagonal").agg(
        F.collect_set("place").alias("places"), F.min("place").alias("low"), F.max("place").alias("high")
    )
    whole = diagonals.where("exact AND size(places) = size").select(
        "row", "label", "exact", F.col("diagonal").cast("long").alias("first"), (F.col("diagonal") + F.col("size") + GRAM - 2).cast("long").alias("last"), F.lit(1.0).alias("covered")
    )
    along = W.partitionBy("row", "template").orderBy("diagonal")
    apart = F.col("diagonal") - F.lag("diagonal").over(along) > NEAR
    near = diagonals.where("NOT exact").withColumn("run", F.sum(F.coalesce(apart, F.lit(True)).cast("int")).over(along))
    merged = near.groupBy(*by, "run").agg(
        F.min(F.col("diagonal") + F.col("low")).alias("first"),
        F.max(F.col("diagonal") + F.col("high") + GRAM - 1).alias("last"),
        F.size(F.array_distinct(F.flatten(F.collect_list("places")))).alias("seen"),
    )
    covered = F.col("seen") / F.col("size")
    loose = merged.where(covered >= COVERED).select(
        "row", "label", "exact", F.col("first").cast("long"), F.col("last").cast("long"), covered.alias("covered")
    )
    return whole.union(loose)


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels and score for every row of ``docs``.

    Places and base labels are those of PHRASES. labels adds the templates' own; score is the
    largest covered share of any template or phrase, 0 without one.
    """
    words = words_of(F.col("text"))
    key = F.xxhash64("doc_id", "text")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    # Equal rows share a key and their votes fall together, so votes are taken from one of them.
    found = spans(texts.select(key.alias("row"), words.alias("words")).where(F.size("words") >= GRAM))
    base = F.when(F.col("exact"), F.col("first"))
    by_row = found.groupBy("row").agg(
        F.count_distinct(base, F.col("label")).alias("n_base"),
        F.min(base).alias("first_word"),
        F.max(base).alias("last_word"),
        F.concat_ws(",", F.sort_array(F.collect_set(F.when(F.col("exact"), F.col("label"))))).alias("base_labels"),
        F.concat_ws(",", F.sort_array(F.collect_set("label"))).alias("labels"),
        F.max("covered").alias("score"),
    )
    rows = texts.select("doc_id", key.alias("row"), F.size(words).cast("long").alias("n_words")).join(by_row, "row", "left")
    return rows.select(
        "doc_id",
        "n_words",
        F.coalesce("n_base", F.lit(0).cast("long")).alias("n_base"),
        "first_word",
        "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"),
        F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )
