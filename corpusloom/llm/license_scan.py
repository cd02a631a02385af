"""Licence notices in texts: a trained paragraph classifier, confirmed against templates.

Paragraphs end at blank lines; comment marks go and wrapped lines are joined. Paragraphs are cut into overlapping
pieces, and lines that are not alone are pieces too, so that a notice inside
running text, or between other lines, is seen by itself. Every piece is classified. A multinomial logistic regression on hashed word n-grams names the
family of a piece. Its `unknown` class is learned from ordinary text of the corpus, from sentences
that merely use the words of licences, and the probability a family must reach is calibrated on
held-out rows. A named family counts only if one of its templates is confirmed by its word pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm.common import external_key, internal_key, quoted, written

# -- fixed values: short public notices by family, and sentences that only sound alike --
TEMPLATES = {
    "apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
        "This project is released under the Apache License 2.0.",
        "SPDX-License-Identifier: Apache-2.0",
    ),
    "mit": (
        "Released under the MIT License.",
        "This software is distributed under the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files.",
        "SPDX-License-Identifier: MIT",
    ),
    "gpl-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License.",
        "Licensed under the GNU GPL version 3 or later.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ),
    "lgpl": (
        "This library is licensed under the GNU Lesser General Public License.",
        "SPDX-License-Identifier: LGPL-2.1-or-later",
    ),
    "bsd": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted.",
        "Licensed under the BSD 3-Clause License.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ),
    "mpl-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ),
    "cc-by-nc": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "cc-by": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    "cc0": (
        "To the extent possible under law, the author has waived all copyright and related rights to this work.",
        "Released into the public domain under CC0 1.0.",
    ),
    "proprietary": (
        "All rights reserved. No part of this publication may be reproduced without permission.",
        "Copyright, all rights reserved.",
    ),
}
SOUND_ALIKE = (
    "The driver lost his license after the accident.",
    "A license plate was found at the scene.",
    "The city will license three new taxi firms under the rules.",
    "An apache helicopter was released to the public.",
    "Students of MIT released a paper on public transport.",
    "You need permission to enter this area, free of charge for any person over sixty.",
    "The general of the army spoke to the public.",
    "This version of the software is free.",
    "Creative people share common goals and attribution matters.",
    "Fishing is permitted with or without a boat.",
)
# ---------------------------------------------------------------------------------------
UNKNOWN = "unknown"
FAMILIES = (UNKNOWN, *sorted(TEMPLATES))
PIECE_WORDS, STEP_WORDS = 40, 20
FEATURES, COPIES, ORDINARY = 1 << 14, 60, 4_000
#: The probability a family must reach lets through at most this share of held-out unknown rows.
UNKNOWN_SHARE = 0.005
CONFIRMED = 0.7
#: Words that most notices have: pieces with one are reported, whatever the model calls them.
TELLING = r"(?i)licen[cs]e|permission|permitted|gpl|public license|free software|source code form|\bcc\b|creative commons|cc0|waived|rights reserved|spdx"
#: The same where white space or comment marks may stand between the words of a phrase.
WRAPPED = TELLING.replace(" ", r"\W+")
#: Every telling phrase has one of these, in any case, or the word "cc", or "source", "code" and "form": a quick look that spares most texts the search.
HINTS = ("licen", "permission", "permitted", "gpl", "software", "commons", "cc0", "waived", "reserved", "spdx")
_WORD_CC = r"[cC][cC]\b(?<=\b[cC][cC])"
#: Comment marks at the beginning and the end of a line.
OPENING, CLOSING = r"^[ \t\x0B\f\r]*(?:(?://+!?|/\*+!?|\*+/?|#+!?|;+|--+|%+|<!--+|>+|\"{3}|'{3}|\.\.|(?i:rem|dnl)(?=[ \t]|$))[ \t]*)+", r"[ \t]*(?:\*+/|--+>|\*+|#+|\"{3}|'{3})?[ \t\x0B\f\r]*$"

#: Only lines that begin or end with one of these characters can have such a mark, or white space beside it.
_BEGINS, _ENDS = " \t\x0b\x0c\r/*#;-%<>\"'.rRdD", " \t\x0b\x0c\r*/>#\"'\x85\u2028\u2029"


def words_of(text: Column) -> Column:
    """Lower-case runs of letters, digits, dots and hyphens, without the dots at their end."""
    # Plain texts are lowered whole and need no Unicode classes.
    plain = F.regexp_extract_all(F.lower(text), F.lit(r"[a-z0-9.\-]*[a-z0-9\-]"), F.lit(0))
    others = F.transform(F.regexp_extract_all(text, F.lit(r"[\p{L}\p{N}.\-]*[\p{L}\p{N}\-]"), F.lit(0)), F.lower)
    return F.when(F.octet_length(text) == F.length(text), plain).otherwise(others)


def pairs_of(words: Column) -> Column:
    return F.transform(F.sequence(F.lit(0), F.greatest(F.size(words) - 2, F.lit(0))), lambda i: F.concat_ws(" ", F.get(words, i), F.get(words, i + 1)))


def with_grams(rows: DataFrame, text_column: str = "piece") -> DataFrame:
    """Words, word pairs and both as hashed counts."""
    return _grams_of(rows.withColumn("words", words_of(F.col(text_column))))


def _grams_of(rows: DataFrame) -> DataFrame:
    rows = rows.withColumn("pairs", F.array_distinct(pairs_of(F.col("words"))))
    rows = rows.withColumn("grams", F.concat("words", "pairs"))
    return HashingTF(inputCol="grams", outputCol="features", numFeatures=FEATURES, binary=True).transform(rows)


def paragraphs(text: Column) -> Column:
    """Per paragraph line_at (of its first line) and its lines, in order, without comment marks."""
    opened = lambda line: F.when(F.contains(F.lit(_BEGINS), F.substring(line, 1, 1)), F.regexp_replace(line, OPENING, "")).otherwise(line)
    closed = lambda line: F.when(F.contains(F.lit(_ENDS), F.substring(line, -1, 1)), F.regexp_replace(line, CLOSING, "")).otherwise(line)
    bare = F.transform(F.transform(F.split(text, "\r\n|\r|\n"), opened), closed)
    # The mark cuts at each run of blank lines; a line's number goes with it.
    numbered = F.transform(bare, lambda line, i: F.when(F.trim(line) == "", F.lit("\n")).otherwise(F.concat(i.cast("string"), F.lit("\x02"), line, F.lit("\x01"))))
    each = F.filter(F.split(F.array_join(numbered, ""), "\n+"), lambda p: p != "")
    return F.transform(
        each,
        lambda p: F.struct(
            F.substring_index(p, "\x02", 1).cast("int").alias("line_at"),
            F.transform(F.filter(F.split(p, "\x01"), lambda line: line != ""), lambda line: F.regexp_replace(line, "^[0-9]+\x02", "")).alias("lines"),
        ),
    )


def may_tell(text: Column) -> Column:
    """Whether a text can match WRAPPED; true for all that do, and for some others."""
    low = F.lower(text)
    found = F.contains(low, F.lit("source")) & F.contains(low, F.lit("code")) & F.contains(low, F.lit("form"))
    for hint in HINTS:
        found = found | F.contains(low, F.lit(hint))
    return found | text.rlike(_WORD_CC)


def pieces(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", ordinary: bool = False) -> DataFrame:
    """key, line_at, piece_at, piece, telling: the pieces of every paragraph, and of each of its lines if it has several.

    `line_at` is the line a piece's paragraph, or the line that is a piece by itself, begins on; `telling` says that the piece has a
    telling word. `ordinary`: only paragraphs without such a word, and not their lines.
    """
    text = F.coalesce(F.col(quoted(text_column)), F.lit(""))
    # Few texts have these characters, and the replacement walks through a text one by one.
    text = F.when(F.contains(text, F.lit("\x01")) | F.contains(text, F.lit("\x02")), F.translate(text, "\x01\x02", "  ")).otherwise(text)
    texts = docs.select(internal_key(F.col(quoted(id_column))).alias("key"), text.alias("text"))
    # Pieces of texts that cannot have a telling phrase, not even a wrapped one, need not be searched for one.
    told = F.lit(True) if ordinary else may_tell(F.col("text"))
    found = texts.select("key", told.alias("told"), F.explode(paragraphs(F.col("text"))).alias("p")).select("key", "told", "p.line_at", "p.lines")
    whole = F.array(F.struct("line_at", F.array_join("lines", " ").alias("line")))
    alone = F.transform("lines", lambda line, i: F.struct((F.col("line_at") + i).alias("line_at"), line.alias("line")))
    parts = whole if ordinary else F.when(F.size("lines") > 1, F.concat(whole, alone)).otherwise(whole)
    lines = found.select("key", "told", F.explode(parts).alias("each")).select("key", "told", "each.line_at", "each.line")
    if ordinary:
        # The other lines of a notice are no ordinary text.
        lines = lines.filter(~F.col("line").rlike(TELLING))
    words = lines.filter("trim(line) <> ''").select("key", "told", "line_at", F.split(F.trim("line"), r"[ \t\x0B\f\r]+").alias("w"))
    starts = F.sequence(F.lit(0), F.greatest(F.size("w") - 1 - (PIECE_WORDS - STEP_WORDS), F.lit(0)), F.lit(STEP_WORDS))
    cut = words.select("key", "told", "line_at", F.posexplode(starts).alias("piece_at", "start"), "w")
    cut = cut.select("key", "line_at", "piece_at", F.array_join(F.slice("w", F.col("start") + 1, PIECE_WORDS), " ").alias("piece"), "told")
    return cut.select("key", "line_at", "piece_at", "piece", (F.col("told") & F.col("piece").rlike(TELLING)).alias("telling"))


def labelled_paragraphs(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """piece and family: altered copies of the templates, alone and in ordinary text, and unknown paragraphs.

    Ordinary text is a sample of the corpus, at most ORDINARY pieces, by a hash of their place.
    """
    spark = docs.sparkSession
    place = F.xxhash64("key", "line_at", "piece_at")
    few = docs.filter(F.col(quoted(text_column)).isNotNull()).orderBy(F.xxhash64(quoted(id_column))).limit(ORDINARY // 4)
    ordinary = pieces(few, id_column, text_column, ordinary=True).filter("NOT telling").orderBy(place).limit(ORDINARY).select("piece")
    ordinary = written(ordinary.withColumn("n", F.monotonically_increasing_id()), "ordinary-pieces")
    notices = [(family, text) for family, texts in TEMPLATES.items() for text in texts] + [(UNKNOWN, text) for text in SOUND_ALIKE]
    made = _copies(spark, notices)
    # A copy loses some words; every other one stands between words of ordinary text.
    kept = F.filter(F.split("text", " "), lambda w, i: (F.col("copy") == 0) | (F.pmod(F.xxhash64(w, i, F.col("copy")), F.lit(12)) != 0))
    made = made.select("family", F.array_join(kept, " ").alias("text"), F.pmod(F.xxhash64("text", "copy"), F.lit(997)).alias("slot"), "copy")
    around = ordinary.select(F.pmod(F.xxhash64("n"), F.lit(997)).alias("slot"), F.slice(F.split("piece", " "), 1, 12).alias("w")).groupBy("slot").agg(F.min("w").alias("w"))
    inside = made.join(around, "slot", "left").select(
        "family", F.when((F.col("copy") % 2 == 1) & F.col("w").isNotNull(), F.concat_ws(" ", F.array_join(F.slice("w", 1, 6), " "), "text", F.array_join(F.slice("w", 7, 6), " "))).otherwise(F.col("text")).alias("piece")
    )
    return inside.union(ordinary.select(F.lit(UNKNOWN), "piece"))


def _copies(spark: SparkSession, notices: list[tuple[str, str]]) -> DataFrame:
    base = spark.createDataFrame(notices, "family string, text string")
    return base.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(COPIES - 1))))


def fit_classifier(labelled: DataFrame) -> tuple[LogisticRegressionModel, float]:
    """The model and the calibrated probability that a family must reach."""
    index = F.array_position(F.array(*[F.lit(f) for f in FAMILIES]), F.col("family")).cast("double") - 1
    rows = written(with_grams(labelled).select("features", index.alias("label"), (F.pmod(F.xxhash64("piece", F.lit(3)), F.lit(5)) == 0).alias("held")), "licence-rows")
    model = LogisticRegression(family="multinomial", maxIter=40, regParam=1e-3, elasticNetParam=0.0).fit(rows.filter("NOT held"))
    judged = model.transform(rows.filter("held")).withColumn("p", F.array_max(F.slice(vector_to_array("probability"), 2, len(FAMILIES))))
    cut = judged.filter("label = 0").agg(F.expr(f"percentile_approx(p, {1 - UNKNOWN_SHARE}, 10000)")).first()[0]
    return model, max(0.5, cut or 0.0)


def _rotated(h: np.ndarray, bits: int) -> np.ndarray:
    return (h << np.uint32(bits)) | (h >> np.uint32(32 - bits))


def feature_index(grams: pa.Array) -> np.ndarray:
    """The place of each string in the vectors of `HashingTF` (32-bit Murmur3, seed 42)."""
    raw = np.frombuffer(grams.cast(pa.large_string()).buffers()[1], np.int64)[: len(grams) + 1]
    body = grams.cast(pa.large_string()).buffers()[2]
    data = np.frombuffer(body, np.uint8) if body is not None else np.zeros(0, np.uint8)
    size, out = np.diff(raw), np.zeros(len(grams), np.uint32)
    for n in np.unique(size).tolist():
        which = np.flatnonzero(size == n)
        padded = np.zeros((len(which), -(-n // 4) * 4), np.uint8)
        padded[:, :n] = data[raw[which][:, None] + np.arange(n)]
        blocks = padded.view("<u4")
        h = np.full(len(which), 42, np.uint32)
        for b in range(blocks.shape[1]):
            h ^= _rotated(blocks[:, b] * np.uint32(0xCC9E2D51), 15) * np.uint32(0x1B873593)
            if 4 * b + 4 <= n:
                h = _rotated(h, 13) * np.uint32(5) + np.uint32(0xE6546B64)
        h ^= np.uint32(n)
        h = (h ^ (h >> np.uint32(16))) * np.uint32(0x85EBCA6B)
        h = (h ^ (h >> np.uint32(13))) * np.uint32(0xC2B2AE35)
        out[which] = h ^ (h >> np.uint32(16))
    return (out % np.uint32(FEATURES)).astype(np.int64)


def advantages(words: pa.ListArray, weights: np.ndarray, intercepts: np.ndarray) -> np.ndarray:
    """Per list of words: by how much the model's margin of the best family exceeds that of `unknown`.

    `weights` has a row per feature and a column per family, `unknown` taken off. Each feature of a list counts once, as in `with_grams`.
    """
    flat = words.flatten().dictionary_encode()
    # The empty string is the pair of a list without words.
    vocabulary = pa.concat_arrays([flat.dictionary.cast(pa.string()), pa.array([""])])
    ids, size = flat.indices.to_numpy().astype(np.int64), pc.list_value_length(words).to_numpy()
    of = np.repeat(np.arange(len(size)), size)
    next_to = np.flatnonzero(of[1:] == of[:-1])
    pairs, pair_at = np.unique(ids[next_to] * len(vocabulary) + ids[next_to + 1], return_inverse=True)
    left, right = (vocabulary.take(pa.array(side)) for side in np.divmod(pairs, len(vocabulary)))
    of_word, of_pair = feature_index(vocabulary), feature_index(pc.binary_join_element_wise(left, right, " "))
    empty = np.flatnonzero(size == 0)
    rows = np.concatenate([of, of[next_to], empty])
    seen = rows * FEATURES + np.concatenate([of_word[ids], of_pair[pair_at], np.full(len(empty), of_word[-1])])
    seen = np.sort(seen.astype(np.int32) if len(size) * FEATURES < 1 << 31 else seen)
    rows, features = np.divmod(seen[np.append(True, seen[1:] != seen[:-1])], FEATURES)
    begins = np.flatnonzero(np.append(True, rows[1:] != rows[:-1]))
    return (np.add.reduceat(weights[features], begins, axis=0) + intercepts).max(axis=1)


def named_or_telling(found: DataFrame, model: LogisticRegressionModel, least: float) -> DataFrame:
    """The pieces, with their words, that have a telling word or for which a family may reach the probability `least`.

    Every piece is scored with the model's weights. A family's probability is at most 1 / (1 + exp(-its advantage over `unknown`)),
    so no family reaches `least` where the best advantage is below the logit of it.
    """
    coefficients, intercepts = model.coefficientMatrix.toArray(), model.interceptVector.toArray()
    weights, offsets = (coefficients[1:] - coefficients[0]).T.astype(np.float32), intercepts[1:] - intercepts[0]
    needed = float(np.log(least / (1 - least))) - 0.01 if least < 1 else -np.inf  # the slack is for short floats; the model itself judges what is left

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                kept = advantages(batch.column("words"), weights, offsets) >= needed
                yield batch.filter(pc.or_(pa.array(kept), batch.column("telling")))

    rows = found.withColumn("words", words_of(F.col("piece"))).select("key", "line_at", "piece_at", "telling", "words")
    return rows.mapInArrow(run, rows.schema)


def confirmation(pairs: Column, family: Column) -> Column:
    """The largest share of the word pairs of a template of the family that the piece has, 0 for `unknown`."""

    def share(text: str) -> Column:
        wanted = F.array_distinct(pairs_of(words_of(F.lit(text))))
        return F.size(F.array_intersect(pairs, wanted)) / F.size(wanted)

    best = {f: F.greatest(*s) if len(s := [share(t) for t in texts]) > 1 else s[0] for f, texts in TEMPLATES.items()}
    found = F.lit(0.0)
    for name in sorted(best):
        found = F.when(family == name, best[name]).otherwise(found)
    return found


def scan(docs: DataFrame, labelled: DataFrame | None = None, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per piece that names a family or has a telling word: doc_id, line_at, piece_at, family, probability, similarity, confirmed.

    Every piece of every text is classified; those without a row are `unknown` and have no telling word. `family` is `unknown` where no family reaches its probability; `confirmed` says that a template of the
    named family is there. `labelled` (piece, family) replaces the rows that the classifier learns from. Null and
    empty texts have no pieces; rows repeating an id are scanned one by one; a null id stays null;
    an empty table gives no rows; other columns are not read.
    """
    found = pieces(docs, id_column, text_column)
    model, least = fit_classifier(labelled if labelled is not None else labelled_paragraphs(docs, id_column, text_column))
    judged = model.transform(_grams_of(named_or_telling(found, model, least))).withColumn("p", F.slice(vector_to_array("probability"), 2, len(FAMILIES)))
    top = F.array_max("p")
    named = F.when(top >= least, F.get(F.array(*[F.lit(f) for f in FAMILIES[1:]]), (F.array_position("p", top) - 1).cast("int"))).otherwise(UNKNOWN)
    # The number keeps the filter above the projection; below it, Spark would make words and features anew for each use of the family.
    judged = judged.withColumn("family", named).withColumn("at", F.monotonically_increasing_id())
    judged = judged.filter((F.col("at") >= 0) & ((F.col("family") != UNKNOWN) | F.col("telling")))
    judged = judged.withColumn("similarity", confirmation(F.col("pairs"), F.col("family")))
    return judged.select(
        external_key("key").alias("doc_id"), "line_at", "piece_at", "family", F.round(top, 6).alias("probability"),
        F.round("similarity", 6).alias("similarity"), (F.col("similarity") >= CONFIRMED).alias("confirmed"),
    )
