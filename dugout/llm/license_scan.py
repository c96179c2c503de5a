"""License scan: word k-gram hashes joined to template positions, diagonal votes, span check.

Every rolling word k-gram (k = 2) of every document is hashed and joined to the template positions
that hold it. A hit votes for its diagonal (document position - template position); votes are
aggregated per (document, template, diagonal), so a span that is a verbatim copy is one diagonal with
a vote for each of the template's k-grams. An inserted or dropped word moves the diagonal, so each diagonal is merged with
those up to the template's reach above it: ``GAP`` words for each of the edits that the threshold can bear. A merged
span so lies within the template's length and reach, whatever stands before or after it, and is verified:
the share of the template's k-grams, by position, that it covers must reach the template's threshold (1 for the short base
phrases, ``SHARE`` for longer license statements). Of verified spans within reach of each other the best stays.

The template table is small and fixed by the caller (a parameter); its size is checked before it is
broadcast.

Words: A-Z is lower-cased, then maximal runs of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`` (ASCII digits, a-z
and everything beyond ASCII).

Cases: null text counts as empty; empty or one-word texts have no hit; repeated rows are scanned each
(rows are told apart by doc_id and text); very long texts are scanned whole, a gram at a time; empty
tables give empty results; extra columns are ignored; a template of fewer than k words is an error.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from dugout.llm.common import small, staged, text_or_empty

K = 2
GAP = 3
SHARE = 0.8
SPLIT = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# The base phrases and their labels.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
# The method's own templates, the usual notices of public licenses, and their labels.
STATEMENTS = {
    "licensed under the apache license version 2 0": "apache-2.0",
    "you may not use this file except in compliance with the license you may obtain a copy of the license at": "apache-2.0",
    "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis"
    " without warranties or conditions of any kind either express or implied": "apache-2.0",
    "released under the mit license": "mit",
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute"
    " sublicense and or sell copies of the software": "mit",
    "redistribution and use in source and binary forms with or without modification are permitted": "bsd",
    "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from"
    " this software without specific prior written permission": "bsd-3-clause",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted": "isc",
    "licensed under cc by nc 4 0": "cc-by-nc-4.0",
    "this work is licensed under a creative commons attribution 4 0 international license": "cc-by-4.0",
    "this work is licensed under a creative commons attribution sharealike 4 0 international license": "cc-by-sa-4.0",
    "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work": "cc0-1.0",
    "licensed under the gnu general public license version 3": "gpl-3.0",
    "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software"
    " foundation either version 2 of the license or at your option any later version": "gpl-2.0-or-later",
    "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software"
    " foundation either version 3 of the license or at your option any later version": "gpl-3.0-or-later",
    "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software"
    " foundation": "lgpl",
    "you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software"
    " foundation": "agpl",
    "this source code form is subject to the terms of the mozilla public license": "mpl-2.0",
    "this program and the accompanying materials are made available under the terms of the eclipse public license": "epl",
    "this is free and unencumbered software released into the public domain": "unlicense",
    "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and"
    " redistribute it freely": "zlib",
    "distributed under the boost software license version 1 0": "bsl-1.0",
    "everyone is permitted to copy and distribute verbatim or modified copies of this license document": "wtfpl",
    "this library is free software you may redistribute it and or modify it under the same terms as perl itself": "artistic",
}
# The one character beyond ASCII whose lower case is an ASCII letter; put aside, so that only A-Z become a-z.
KELVIN, ASIDE = "\u212a", "\u03c9"


def words_of(text: str | Column = "text") -> Column:
    """Lower-case words of the whole text; their bounds and ASCII letters follow the A-Z rule exactly."""
    lowered = F.lower(F.replace(text_or_empty(text), F.lit(KELVIN), F.lit(ASIDE)))
    return F.array_remove(F.split(lowered, SPLIT), "")


def templates(spark: SparkSession, base=BASE, statements=STATEMENTS, share: float = SHARE) -> DataFrame:
    """(template, label, is_base, share, words)."""
    rows = [(i, label, is_base, 1.0 if is_base else share, phrase.split())
            for i, (phrase, label, is_base) in enumerate(
                [(p, x, True) for p, x in base.items()] + [(p, x, False) for p, x in statements.items()])]
    if any(len(r[4]) < K for r in rows):
        raise ValueError(f"a template needs at least {K} words")
    return spark.createDataFrame(rows, "template int, label string, is_base boolean, share double, words array<string>")


def template_grams(table: DataFrame) -> DataFrame:
    gram = F.xxhash64(*[F.get("words", F.col("at") + i) for i in range(K)])
    return (table.select("*", F.explode(F.sequence(F.lit(0), F.size("words") - K)).alias("at"))
            .select("template", "at", gram.alias("gram"), *[F.get("words", F.col("at") + i).alias(f"t{i}") for i in range(K)]))


def reach(grams: int, share: float = SHARE, gap: int = GAP) -> int:
    """By how much the diagonals of one span may differ: ``gap`` words for each edit that leaves ``share`` of the k-grams."""
    return math.ceil(round((1 - share) * grams, 9)) * gap


def gram_hits(docs: DataFrame, table: DataFrame) -> DataFrame:
    """(doc_id, text_id, template, at, pos): every place where a document holds a template's k-gram.

    The join is on hashes; the words themselves are compared after it (not as join keys, which would be
    evaluated for every word)."""
    grams = small(staged(template_grams(table), "license-grams"))
    words = docs.select("doc_id", F.xxhash64(text_or_empty()).alias("text_id"), words_of().alias("words"))
    n = F.size("words")
    rolled = (words.withColumn("pos", F.explode(F.when(n >= K, F.sequence(F.lit(0), n - K))))
              .withColumn("gram", F.xxhash64(*[F.get("words", F.col("pos") + i) for i in range(K)])))
    same = F.lit(True)
    for i in range(K):
        same = same & F.coalesce(F.get("words", F.col("pos") + i) == F.col(f"t{i}"), F.lit(False))
    return rolled.join(grams, "gram").where(same).select("doc_id", "text_id", "template", "at", "pos")


def spans(docs: DataFrame, table: DataFrame, gap: int = GAP) -> DataFrame:
    """(doc_id, text_id, template, label, is_base, first_word, n_words, score): verified spans."""
    size = table.select("template", "label", "is_base", "share", (F.size("words") - K + 1).alias("grams"))
    size = size.withColumn("reach", (F.ceil(F.round((1 - F.col("share")) * F.col("grams"), 9)) * gap).cast("int"))
    farthest = size.agg(F.max("reach")).first()[0] or 0       # of the caller's templates
    votes = (gram_hits(docs, table)
             .withColumn("diagonal", F.col("pos") - F.col("at"))
             .groupBy("doc_id", "text_id", "template", "diagonal")
             .agg(F.count_distinct("pos").alias("votes"), F.min("pos").alias("lo"), F.max("pos").alias("hi"),
                  F.collect_set("at").alias("ats")))          # at most one place per template gram
    votes = staged(votes.join(F.broadcast(size), "template"), "license-votes")      # one row per template
    whole = votes.where(F.col("votes") == F.col("grams")).select(
        "doc_id", "text_id", "template", "label", "is_base", F.col("diagonal").alias("first_word"),
        (F.col("grams") + K - 1).alias("n_words"), F.lit(1.0).alias("score"))
    partial = votes.where(~F.col("is_base") & (F.col("votes") < F.col("grams")))
    along = W.partitionBy("doc_id", "text_id", "template").orderBy("diagonal")
    near = F.collect_list(F.struct("diagonal", "lo", "hi", "ats")).over(along.rangeBetween(0, farthest))
    near = F.filter(near, lambda x: x["diagonal"] <= F.col("diagonal") + F.col("reach"))
    merged = partial.withColumn("near", near).select(
        "doc_id", "text_id", "template", "label", "is_base", "share", "reach", "diagonal", F.array_min("near.lo").alias("lo"), F.array_max("near.hi").alias("hi"),
        (F.size(F.array_distinct(F.flatten("near.ats"))) / F.col("grams")).alias("score"))
    passed = (merged.where(F.col("score") >= F.col("share"))
              .withColumn("new", (F.coalesce(F.col("diagonal") - F.lag("diagonal").over(along), F.col("reach") + 1) > F.col("reach")).cast("int"))
              .withColumn("span", F.sum("new").over(along)))
    best = passed.groupBy("doc_id", "text_id", "template", "label", "is_base", "span").agg(
        F.max_by(F.struct("lo", "hi", "score"), F.struct("score", -F.col("diagonal"))).alias("b"))
    verified = best.select("doc_id", "text_id", "template", "label", "is_base", F.col("b.lo").alias("first_word"),
                           (F.col("b.hi") - F.col("b.lo") + K).alias("n_words"), F.col("b.score").alias("score"))
    return whole.unionByName(verified)


def scan(docs: DataFrame, table: DataFrame | None = None) -> DataFrame:
    """One row per document: n_words, n_base, first_word, last_word, base_labels, labels, score, spans.

    score is the best span's share (1 where a phrase stands verbatim), 0 without a span. Labels are
    empty strings where there are none."""
    table = templates(docs.sparkSession) if table is None else table
    found = spans(docs, table)
    per_doc = (found.groupBy("doc_id", "text_id")
               .agg(F.sum(F.col("is_base").cast("long")).alias("n_base"),
                    F.min(F.when(F.col("is_base"), F.col("first_word"))).cast("long").alias("first_word"),
                    F.max(F.when(F.col("is_base"), F.col("first_word"))).cast("long").alias("last_word"),
                    F.concat_ws(",", F.array_sort(F.collect_set(F.when(F.col("is_base"), F.col("label"))))).alias("base_labels"),
                    F.concat_ws(",", F.array_sort(F.collect_set("label"))).alias("labels"),
                    F.max("score").alias("score")))
    per_doc = small(staged(per_doc, "license-docs"))
    rows = docs.select(F.col("doc_id"), F.xxhash64(text_or_empty()).alias("text_id"),
                       F.size(words_of()).cast("long").alias("n_words")).alias("d")
    f = per_doc.alias("f")
    on = F.col("d.doc_id").eqNullSafe(F.col("f.doc_id")) & (F.col("d.text_id") == F.col("f.text_id"))
    return (rows.join(f, on, "left")
            .select("d.doc_id", "n_words", F.coalesce("n_base", F.lit(0).cast("long")).alias("n_base"), "first_word", "last_word",
                    F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"),
                    F.coalesce("score", F.lit(0.0)).alias("score")))
