"""License scans by diagonal voting: rolling word pairs of all texts are joined with their places in
license templates, matches vote for the diagonal (place in the text less place in the template),
neighbouring diagonals are merged into spans, and spans are verified by the share of the template found.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

#: Words are what stands between these: ASCII other than letters and digits.
BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Phrases that count wherever they stand, word by word.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
#: Opening or naming sentences of common licenses; found if ``LEAST_SHARE`` of their word pairs are there.
TEMPLATES = {
    "mit": (
        "released under the mit license",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and"
        " associated documentation files",
    ),
    "apache-2.0": (
        "licensed under the apache license version 2 0",
        "you may not use this file except in compliance with the license",
    ),
    "gpl": (
        "this work is licensed under the gnu general public license",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu"
        " general public license as published by the free software foundation",
    ),
    "cc-by-nc": ("licensed under cc by nc 4 0", "creative commons attribution noncommercial 4 0 international"),
    "bsd": (
        "redistribution and use in source and binary forms with or without modification are permitted provided"
        " that the following conditions are met",
    ),
    "mpl-2.0": ("this source code form is subject to the terms of the mozilla public license v 2 0",),
}
LEAST_SHARE = 0.6
#: Diagonals this close are one span: words were put in or left out between them.
SLACK = 3


def templates(spark: SparkSession) -> DataFrame:
    """``template, label, base, t_pos, t_size, first, second``: each word pair of each template. Its size
    is that of the tables above."""
    rows, number = [], 0
    for base, phrases in ((True, [(x, y) for x, y in BASE.items()]), (False, [(x, y) for y, z in TEMPLATES.items() for x in z])):
        for text, label in phrases:
            words = text.split()
            for at, pair in enumerate(zip(words, words[1:])):
                rows.append((number, label, base, at, len(words) - 1, *pair))
            number += 1
    schema = "template int, label string, base boolean, t_pos int, t_size int, first string, second string"
    return spark.createDataFrame(rows, schema)


def words_of(text: Column) -> Column:
    """Words of a text, A-Z lower-cased. ``lower`` does that unless the text has one of the two other
    characters that it turns into ASCII letters."""
    lowered = F.when(text.rlike("[\\u0130\\u212A]"), F.translate(text, UPPER, LOWER)).otherwise(F.lower(text))
    return F.filter(F.split(lowered, BREAK), lambda word: word != "")


def matches(documents: DataFrame, text: str = "text") -> DataFrame:
    """``row, doc_id, n_words, pos`` and the template's columns, for every word pair that a template has;
    and for every document a row of template -1. The key is a hash; on a match the words are compared.

    All rows of a document go to one partition, by ``row``, a number given to each: what follows groups by
    it and needs no other exchange.
    """
    value = F.coalesce(F.col(text), F.lit(""))
    words = documents.select(F.monotonically_increasing_id().alias("row"), "doc_id", words_of(value).alias("w"))
    hashed = words.select(
        "row",
        "doc_id",
        "w",
        F.expr(
            "concat(array(0L), CASE WHEN size(w) < 2 THEN CAST(array() AS array<bigint>)"
            " ELSE transform(sequence(0, size(w) - 2), i -> xxhash64(w[i], w[i + 1])) END)"
        ).alias("h"),
    )
    pairs = hashed.select("row", "doc_id", "w", F.posexplode("h").alias("at", "h")).withColumn("pos", F.col("at") - 1)
    known = templates(documents.sparkSession)
    every = known.sparkSession.createDataFrame([(-1, None, False, 0, 1, None, None, 0)], known.schema.add("h", "long"))
    # A fixed table of some hundred rows.
    known = F.broadcast(known.withColumn("h", F.xxhash64("first", "second")).union(every))
    same = (F.get("w", F.col("pos")) == F.col("first")) & (F.get("w", F.col("pos") + 1) == F.col("second"))
    wanted = ((F.col("template") == -1) & (F.col("pos") == -1)) | ((F.col("pos") >= 0) & same)
    return (
        pairs.join(known, "h")
        .where(wanted)
        .select("row", "doc_id", F.size("w").cast("long").alias("n_words"), "pos", "template", "label", "base", "t_pos", "t_size")
        .repartition("row")
    )


def spans(found: DataFrame) -> DataFrame:
    """``row, doc_id, n_words, label, base, start, stop, share``: the merged diagonals, words from 0, ``stop``
    excluded, with the share of the template's word pairs that were found."""
    document = ["row", "doc_id", "n_words"]
    diagonal = (
        found.withColumn("diagonal", F.col("pos") - F.col("t_pos"))
        .groupBy(*document, "template", "label", "base", "t_size", "diagonal")
        .agg(F.collect_set("t_pos").alias("places"), F.min("pos").alias("low"), F.max("pos").alias("high"))
    )
    # The rows of one document and template: at most as many as its text has matches.
    along = Window.partitionBy(*document, "template").orderBy("diagonal")
    new = F.col("base") | (F.col("diagonal") - F.lag("diagonal", 1, -(10**9)).over(along) > SLACK)
    merged = (
        diagonal.withColumn("span", F.sum(new.cast("int")).over(along))
        .groupBy(*document, "template", "label", "base", "t_size", "span")
        .agg(
            F.size(F.array_distinct(F.flatten(F.collect_list("places")))).alias("n"),
            F.min("low").alias("start"),
            (F.max("high") + 2).alias("stop"),
        )
    )
    return merged.select(*document, "label", "base", "start", "stop", (F.col("n") / F.col("t_size")).alias("share"))


def licenses(documents: DataFrame, text: str = "text") -> DataFrame:
    """One row for every document: ``doc_id``, ``n_words``, ``n_base`` (places of base phrases),
    ``first_word`` and ``last_word`` (their least and greatest start), ``base_labels`` and ``labels``
    (distinct, sorted, comma-joined), ``score`` (share of the best verified span, 1 with a base phrase) and
    ``found`` (the verified spans). Null and empty texts have no word and score 0; rows of one ``doc_id``
    are each returned."""
    whole = F.col("base") & (F.col("share") == 1)
    other = ~F.col("base") & F.col("label").isNotNull()
    good = whole | (other & (F.col("share") >= LEAST_SHARE))

    def joined(kind: Column) -> Column:
        return F.array_join(F.sort_array(F.collect_set(F.when(kind, F.col("label")))), ",")

    return (
        spans(matches(documents.select("doc_id", F.col(text).alias("text"))))
        .groupBy("row", "doc_id", "n_words")
        .agg(
            F.count_if(whole).alias("n_base"),
            F.min(F.when(whole, F.col("start"))).cast("long").alias("first_word"),
            F.max(F.when(whole, F.col("start"))).cast("long").alias("last_word"),
            joined(whole).alias("base_labels"),
            joined(good).alias("labels"),
            F.coalesce(F.max(F.when(good, F.col("share"))), F.lit(0.0)).alias("score"),
            F.sort_array(F.collect_list(F.when(good, F.struct("start", "stop", "label", "share")))).alias("found"),
        )
        .drop("row")
    )
