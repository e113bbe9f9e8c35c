"""License notices in documents: votes of word windows along offset diagonals."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidecall.llm.common import Scratch, lower_ascii, row_key

#: A word is a run of letters and digits; everything ASCII that is neither separates.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: Distinct windows of notices up to which they are sent to every task.
MAX_HASHES = 20_000

# Phrases and the labels they give.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Opening words of well-known license notices, by label.
NOTICES = [
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction"),
    ("mit", "Released under the MIT License."),
    ("apache", "Licensed under the Apache License, Version 2.0."),
    ("apache", "You may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0."),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
]


def words_of(text: Column) -> Column:
    """Words in order; an empty array without any."""
    return F.filter(F.split(lower_ascii(F.coalesce(text, F.lit(""))), SEPARATORS), lambda w: w != "")


def notice_table(spark: SparkSession, notices: list[tuple[str, str]] = NOTICES) -> DataFrame:
    rows = [(i, label, text) for i, (label, text) in enumerate(notices)]
    return spark.createDataFrame(rows, "template int, label string, notice string")


def _windows(words: str, k: int) -> Column:
    """Start and hash of every window of ``k`` words."""
    last = F.size(words) - k
    starts = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
    window = lambda i: F.xxhash64(*[F.get(words, i + j) for j in range(k)])
    return F.transform(starts, lambda i: F.struct(i.alias("at"), window(i).alias("hash")))


def _windows_of(words: str, widths: Iterable[int]) -> Column:
    """Start, hash and width of every window of any of these widths."""
    told = lambda k: F.transform(
        _windows(words, k), lambda w: F.struct(w["at"].alias("at"), w["hash"].alias("hash"), F.lit(k).alias("width"))
    )
    return F.concat(*[told(k) for k in widths])


def _phrase_places(words: str, phrases: dict[str, str]) -> Column:
    """Start and label of every place of a phrase; only words that end a phrase are looked at."""
    return F.concat(*[_places_of(words, phrase.split(), label) for phrase, label in phrases.items()])


def _places_of(words: str, parts: list[str], label: str) -> Column:
    before = len(parts) - 1
    found = F.transform(words, lambda w, i: F.when(w == parts[-1], i - before))
    found = F.filter(found, lambda i: i >= 0)
    rest = lambda i: F.forall(
        F.transform(F.array(*map(F.lit, parts[:-1])), lambda w, j: F.get(words, i + j) == w), lambda same: same
    )
    if before:
        found = F.filter(found, rest)
    places = F.transform(found, lambda i: F.struct(i.alias("at"), F.lit(label).alias("label")))
    return F.when(F.array_contains(words, parts[-1]), places).otherwise(places_type())


def places_type() -> Column:
    return F.array().cast("array<struct<at:int,label:string>>")


def scan_licenses(
    docs: DataFrame,
    notices: DataFrame,
    phrases: dict[str, str] = PHRASES,
    k: int = 3,
    drift: int = 3,
    min_coverage: float = 0.6,
    min_similarity: float = 0.6,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """License labels per document.

    Every window of ``k`` words of every document is joined by hash and words with the
    windows of the notices (``template, label, notice``; shorter notices are one window of all
    their words, those without words are never found). A hit votes for the diagonal
    ``position - template position``: the words of one copy of a notice lie on one diagonal,
    or on neighbouring ones where a word was added or lost. Diagonals no further than
    ``drift`` apart are merged. A merged diagonal whose hits cover ``min_coverage`` of the
    notice's words is verified: the words that stand in the document where the strongest
    diagonal begins are compared with the notice by edit distance.

    Places of ``phrases`` are counted beside that and always give their labels. The score is
    1 with a phrase, else the best similarity of a verified notice, else 0.

    Up to ``MAX_HASHES`` distinct windows of notices, which is checked, the notices are
    broadcast and windows that none of them has never become rows; beyond, both sides are
    shuffled. Only hits, their votes aggregated before the shuffle, and one narrow row per
    document travel.

    Null texts count as empty: no words, no places, no labels (an empty string). Rows that
    repeat are judged one by one and alike, null ids are ids. An empty table gives no rows;
    other columns are not read.

    Returns ``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score``.
    """
    scratch = Scratch(docs.sparkSession, "licenses")
    marks = (
        notices.select("template", "label", words_of(F.col("notice")).alias("words"))
        .where(F.size("words") > 0)
        .withColumn("width", F.least(F.lit(k), F.size("words")))
        .select("template", "label", "words", "width", F.explode(_windows_of("words", range(1, k + 1))).alias("w"))
        .where("width = w.width")
        .select(
            "template",
            F.col("w.at").alias("place"),
            F.col("w.hash").alias("hash"),
            F.slice("words", F.col("w.at") + 1, F.col("width")).alias("gram"),
            F.size("words").alias("size"),
            F.array_join("words", " ").alias("notice"),
            F.col("label").alias("notice_label"),
        )
    )
    marks = scratch.write(marks, "marks")  # so that its size is known
    widths = [r["width"] for r in marks.select(F.size("gram").alias("width")).distinct().collect()]  # k at most
    hashes = [r["hash"] for r in marks.select("hash").distinct().limit(MAX_HASHES + 1).collect()]
    few = len(hashes) <= MAX_HASHES
    parts = docs.select(
        docs[id_col].alias("doc_id"),
        row_key(docs[id_col], docs[text_col]).alias("key"),
        words_of(docs[text_col]).alias("words"),
    )
    windows = _windows_of("words", sorted(widths) or [k])
    if few:
        # Windows that no notice has are left out before they become rows.
        windows = F.filter(windows, lambda w: w["hash"].isin(hashes))
    hits = (
        parts.select("key", "words", F.explode(windows).alias("w"))
        .join(F.broadcast(marks) if few else marks, F.col("w.hash") == F.col("hash"))
        .where(F.slice("words", F.col("w.at") + 1, F.size("gram")) == F.col("gram"))
        .select(
            "key",
            "template",
            "size",
            "notice",
            "notice_label",
            "place",
            (F.col("w.at") - F.col("place")).alias("diagonal"),
            "words",
        )
        .select(
            "key",
            "template",
            "size",
            "notice",
            "notice_label",
            "place",
            "diagonal",
            F.array_join(
                F.slice("words", F.greatest(F.col("diagonal"), F.lit(0)) + 1, F.col("size") + F.least("diagonal", F.lit(0))),
                " ",
            ).alias("passage"),
        )
    )
    votes = hits.groupBy("key", "template", "diagonal").agg(
        F.collect_set("place").alias("places"),  # at most the words of the notice
        *[F.first(c).alias(c) for c in ("size", "notice", "notice_label", "passage")],
    )
    by_template = Window.partitionBy("key", "template").orderBy("diagonal")
    before = F.lag("diagonal").over(by_template)
    merged = (
        votes.withColumn("new", F.when(F.col("diagonal") - before <= drift, 0).otherwise(1))
        .withColumn("run", F.sum("new").over(by_template))
        .groupBy("key", "template", "run")
        .agg(
            # A run on one notice has few diagonals that matter; the union is bounded by its size.
            F.array_distinct(F.flatten(F.collect_set("places"))).alias("places"),
            F.max_by("passage", F.struct(F.size("places"), -F.col("diagonal"))).alias("passage"),
            *[F.first(c).alias(c) for c in ("size", "notice", "notice_label")],
        )
    )
    covered = F.size(
        F.array_distinct(F.flatten(F.transform("places", lambda p: F.sequence(p, p + F.least(F.lit(k), F.col("size")) - 1))))
    )
    longest = F.greatest(F.length("passage"), F.length("notice"))
    verified = (
        merged.where(covered >= F.col("size") * min_coverage)
        .withColumn("similarity", 1 - F.levenshtein("passage", "notice") / longest)
        .where(F.col("similarity") >= min_similarity)
        .groupBy("key")
        .agg(
            F.collect_set("notice_label").alias("notice_labels"),  # at most the labels there are
            F.max("similarity").alias("similarity"),
        )
    )
    places = parts.withColumn("places", _phrase_places("words", phrases))
    at = F.transform("places", lambda p: p["at"])
    base = F.array_distinct(F.transform("places", lambda p: p["label"]))
    narrow = places.select(
        "doc_id",
        "key",
        F.size("words").cast("bigint").alias("n_words"),
        F.size("places").cast("bigint").alias("n_base"),
        F.array_min(at).cast("bigint").alias("first_word"),
        F.array_max(at).cast("bigint").alias("last_word"),
        F.array_sort(base).alias("base"),
    )
    none = F.array().cast("array<string>")
    labels = F.array_sort(F.array_union("base", F.coalesce("notice_labels", none)))
    return narrow.join(verified, "key", "left").select(
        "doc_id",
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.array_join("base", ",").alias("base_labels"),
        F.array_join(labels, ",").alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("similarity", F.lit(0.0))).alias("score"),
    )
