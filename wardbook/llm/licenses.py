"""License scan by diagonal voting. DataFrame functions only.

Every rolling word 3-gram of a text is joined by hash to the positions where
license templates hold it. A hit votes for the diagonal "text position less
template position". Neighbouring diagonals merge, so a word put in or left
out does not break a span, and the share of the template's words that a
merged diagonal covers decides.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

GRAM = 3

# The base phrases and their labels.
PHRASES = (
    ("mit", "under the mit license"),
    ("apache-2", "apache license version 2"),
    ("cc-by-nc", "cc by nc"),
)

# Opening words of public licenses.
TEMPLATES = (
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("apache-2", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("cc-by", "this work is licensed under the creative commons attribution 4 0 international license"),
    ("gpl-3", "licensed under the gnu general public license version 3"),
    ("gpl-3", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0"),
)


def _grams(spark: SparkSession, phrases, templates) -> DataFrame:
    """Template grams: hash, words, position and what they belong to. As many rows as the templates have words."""
    rows = []
    for number, (label, text) in enumerate((*phrases, *templates)):
        words = text.split()
        for at in range(len(words) - GRAM + 1):
            rows.append((number, label, number < len(phrases), len(words), at, words[at : at + GRAM]))
    grams = spark.createDataFrame(
        rows, "template int, label string, base boolean, length int, at int, gram array<string>"
    )
    return grams.withColumn("hash", F.xxhash64(*[F.col("gram")[i] for i in range(GRAM)]))


def _hits(docs: DataFrame, grams: DataFrame) -> DataFrame:
    """Verified hits of every text, and one row without a template for each document."""
    # Outside ASCII every character belongs to a word, whatever its case.
    parts = F.split(F.lower(F.coalesce(F.col("text"), F.lit(""))), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    words = docs.select(
        "doc_id", F.monotonically_increasing_id().alias("row"), F.array_remove(parts, "").alias("words")
    ).withColumn("n_words", F.size("words").cast("long"))
    starts = F.when(
        F.col("n_words") >= GRAM, F.sequence(F.lit(0), (F.col("n_words") - GRAM).cast("int"))
    ).otherwise(F.array().cast("array<int>"))
    hashes = F.transform(starts, lambda i: F.xxhash64(*[F.get("words", i + j) for j in range(GRAM)]))
    none = F.array(F.lit(None).cast("long"))
    exploded = words.withColumn("hashes", F.concat(hashes, none)).select(
        "row", "doc_id", "n_words", "words", F.posexplode("hashes").alias("pos", "hash")
    )
    same = F.lit(True)
    for j in range(GRAM):
        same = same & (F.get("words", F.col("pos") + j) == F.col("gram")[j])
    # The template grams number a few hundred, fixed by this module.
    return (
        exploded.join(F.broadcast(grams), "hash", "left")
        .filter(F.col("hash").isNull() | same)
        .select("row", "doc_id", "n_words", "template", "label", "base", "length", "at", (F.col("pos") - F.col("at")).alias("diagonal"))
    )


def scan_licenses(
    docs: DataFrame, phrases=PHRASES, templates=TEMPLATES, slip: int = 2, least: float = 0.7
) -> DataFrame:
    """One row per document with the places of the base phrases and the labels found.

    A base phrase counts where all its words stand in a row. A template gives
    its label where diagonals at most ``slip`` apart cover ``least`` of its
    words. Null text counts as empty: no words, empty labels, score 0.
    Repeated rows are scanned one by one, an empty table gives no rows. Only
    doc_id and text are read.
    """
    grams = _grams(docs.sparkSession, phrases, templates)
    # One shuffle by row serves every step below; it carries hits, never words.
    hits = _hits(docs, grams).repartition("row")
    diagonals = hits.groupBy("row", "doc_id", "n_words", "template", "label", "base", "length", "diagonal").agg(
        F.collect_set("at").alias("ats")
    )
    line = Window.partitionBy("row", "template").orderBy("diagonal")
    apart = F.col("diagonal") - F.lag("diagonal").over(line)
    clusters = diagonals.withColumn("_new", F.when(apart <= slip, 0).otherwise(1)).withColumn(
        "_cluster", F.sum("_new").over(line)
    )
    whole = F.col("base") & (F.size("ats") == F.col("length") - GRAM + 1)
    covered = F.size(
        F.array_distinct(
            F.flatten(F.transform(F.flatten(F.collect_list("ats")), lambda a: F.sequence(a, a + GRAM - 1)))
        )
    )
    spans = clusters.groupBy("row", "doc_id", "n_words", "template", "label", "base", "length", "_cluster").agg(
        F.count(F.when(whole, 1)).alias("places"),
        F.min(F.when(whole, F.col("diagonal"))).alias("first"),
        F.max(F.when(whole, F.col("diagonal"))).alias("last"),
        covered.alias("covered"),
    )
    share = F.col("covered") / F.col("length")
    found = F.when(F.col("base"), F.col("places") > 0).otherwise(share >= least)

    def joined(condition):
        return F.array_join(F.array_sort(F.collect_set(F.when(condition, F.col("label")))), ",")

    return spans.groupBy("row", "doc_id", "n_words").agg(
        F.sum("places").alias("n_base"),
        F.min("first").cast("long").alias("first_word"),
        F.max("last").cast("long").alias("last_word"),
        joined(F.col("base") & (F.col("places") > 0)).alias("base_labels"),
        joined(found).alias("labels"),
        F.coalesce(F.max(share), F.lit(0.0)).alias("score"),
    ).drop("row")
