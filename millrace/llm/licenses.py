"""License scan by diagonal voting.

A text and a template that share a passage share word k-grams at a constant offset.  All rolling k-gram hashes of all texts
are joined in Spark to the positions of the same k-grams in the templates; a match votes for the diagonal "word number in
the text less word number in the template"; votes are summed per diagonal, neighbouring diagonals of one template are merged
(words put in or left out shift the offset), and a merged span counts if its matches cover enough of the template.

Before the join each task drops k-grams that no template has, by the sorted hashes of the templates (a fixed list in this
module), so only matches travel.  The join compares the hash and the words themselves, so a verified span rests on equal
words.  A short phrase is a template whose k is its length: each place where it stands is a span of its own and is never
merged with another.

Defined results: a null or empty text has no words and no span; very long texts are scanned whole; a text that stands in several rows gets the
same result in each; rows with one id and different texts are kept apart; a span that covers exactly the least share counts; an empty
table gives an empty result; further columns are not read, so their names cannot clash.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.arrays import LOWER, Members, WORD_BYTES, ngrams_of, span_hashes, spans, text_hashes, text_slices
from millrace.session import durable

#: Words of a k-gram of a long template, the widest step between diagonals that are merged, the least covered share.
K = 4
STEP = 6
COVERED = 0.6


@dataclass(frozen=True)
class Template:
    name: str
    label: str
    text: str
    phrase: bool = False


# Phrases and licence notices as their publishers word them.
PHRASES = (
    Template("mit phrase", "mit", "mit license", True),
    Template("apache phrase", "apache", "apache license", True),
    Template("gpl phrase", "gpl", "general public license", True),
)
NOTICES = (
    Template("mit grant", "mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    Template("mit warranty", "mit", "The Software is provided \"as is\", without warranty of any kind, express or implied, including but not limited to the warranties of merchantability, fitness for a particular purpose and noninfringement."),
    Template("apache notice", "apache", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    Template("apache line", "apache", "Licensed under the Apache License, Version 2.0"),
    Template("gpl notice", "gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    Template("gpl line", "gpl", "licensed under the GNU General Public License, version 3"),
    Template("bsd notice", "bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    Template("isc notice", "isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    Template("mpl notice", "mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    Template("cc by-nc line", "cc-by-nc", "licensed under CC BY-NC 4.0"),
    Template("cc by line", "cc-by", "licensed under a Creative Commons Attribution 4.0 International License"),
)


def words_in(text: str) -> list[str]:
    """The words of a text as the scan counts them."""
    data = LOWER[np.frombuffer(text.encode(), np.uint8)]
    starts, ends, _ = spans(WORD_BYTES[data], np.array([0, len(data)]))
    raw = data.tobytes()
    return [raw[a:b].decode() for a, b in zip(starts, ends)]


def template_grams(templates: tuple[Template, ...]) -> list[tuple]:
    """(k, hash as signed 64 bits, words, name, label, phrase, position, words of the template) of every k-gram."""
    out = []
    for t in templates:
        words = words_in(t.text)
        k = len(words) if t.phrase else min(K, len(words))
        hashes = text_hashes(words)
        grams, _ = ngrams_of(hashes, np.array([0, len(words)]), k)
        for i, g in enumerate(grams):
            out.append((k, int(g.astype(np.int64)), " ".join(words[i : i + k]), t.name, t.label, t.phrase, i, len(words)))
    return out


def hits(docs: DataFrame, key: str, text_col: str, grams: list[tuple]) -> DataFrame:
    """Per row: the key, n_words and the k-grams that some template has, as (gram, words, pos)."""
    sets = {k: Members(np.array([g[1] for g in grams if g[0] == k], np.int64).astype(np.uint64)) for k in sorted({g[0] for g in grams})}
    hit = pa.struct([("gram", pa.int64()), ("words", pa.string()), ("pos", pa.int64())])

    def found(batches):
        for batch in batches:
            n_words, lists = np.zeros(batch.num_rows, np.int64), [None] * batch.num_rows
            for row, end, data, offsets in text_slices(batch.column(1)):
                data = LOWER[data]
                starts, ends, first = spans(WORD_BYTES[data], offsets)
                words = span_hashes(data, starts, ends)
                n_words[row:end] = np.diff(first)
                raw = data.tobytes()
                for k, members in sets.items():
                    rolled, at = ngrams_of(words, first, k)
                    for i in members.positions(rolled):
                        doc = int(np.searchsorted(at, i, "right")) - 1
                        pos = int(i - at[doc])
                        w = int(first[doc]) + pos
                        said = b" ".join(raw[starts[j] : ends[j]] for j in range(w, w + k)).decode(errors="replace")
                        lists[row + doc] = lists[row + doc] or []
                        lists[row + doc].append({"gram": int(rolled[i].astype(np.int64)), "words": said, "pos": pos})
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_words), pa.array(lists, pa.list_(hit))], names=["_key", "n_words", "hits"]
            )

    rows = docs.select(F.col(key).alias("_key"), F.col(text_col).alias("_text"))
    kind = dict(rows.dtypes)["_key"]
    return rows.mapInArrow(found, f"_key {kind}, n_words long, hits array<struct<gram: long, words: string, pos: long>>")


def license_spans(found: DataFrame, grams: list[tuple], covered: float = COVERED, step: int = STEP) -> DataFrame:
    """(_key, name, label, phrase, first_word, last_word, votes, covered) of the verified spans in the rows of ``hits``."""
    spark = found.sparkSession
    places = spark.createDataFrame(
        grams, "k int, gram long, words string, name string, label string, phrase boolean, tpos long, length int"
    )
    exploded = found.select("_key", F.explode("hits").alias("h")).select("_key", "h.gram", "h.words", "h.pos").distinct()
    # The template positions are a fixed list of this module, a few hundred rows.
    voted = exploded.join(F.broadcast(places), ["gram", "words"]).withColumn("diagonal", F.col("pos") - F.col("tpos"))
    by_diagonal = voted.groupBy("_key", "name", "label", "phrase", "k", "length", "diagonal").agg(
        F.count("*").alias("votes"), F.collect_set("tpos").alias("tpos"), F.min("pos").alias("first_word"), F.max("pos").alias("last_pos")
    )
    order = Window.partitionBy("_key", "name").orderBy("diagonal")
    notices = (
        by_diagonal.filter(~F.col("phrase"))
        .withColumn("_new", (F.col("diagonal") - F.lag("diagonal", 1, -(1 << 60)).over(order) > step).cast("int"))
        .withColumn("_span", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy("_key", "name", "label", "phrase", "k", "length", "_span")
        .agg(
            F.sum("votes").alias("votes"),
            # At most the words of one template, whatever the number of diagonals.
            F.array_distinct(F.flatten(F.collect_set("tpos"))).alias("tpos"),
            F.min("first_word").alias("first_word"), F.max("last_pos").alias("last_pos"),
        )
        .drop("_span")
    )
    phrases = by_diagonal.filter("phrase").select(*notices.columns)
    share = F.size(F.array_distinct(F.flatten(F.transform("tpos", lambda p: F.sequence(p, p + F.col("k") - 1))))) / F.col("length")
    return (
        notices.unionByName(phrases)
        .withColumn("covered", share)
        .filter(F.col("covered") >= covered)
        .select("_key", "name", "label", "phrase", "first_word", (F.col("last_pos") + F.col("k") - 1).alias("last_word"), "votes", "covered")
    )


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: tuple[Template, ...] = PHRASES + NOTICES) -> DataFrame:
    """Per row of ``docs``: id, n_words, spans (name, label, phrase, first and last word, covered share), the base figures of
    the phrases, labels and score (the largest covered share)."""
    grams = template_grams(templates)
    keyed = docs.select(F.struct(F.col(id_col).alias("id"), F.md5(F.coalesce(F.col(text_col), F.lit(""))).alias("text")).alias("_key"), F.col(text_col).alias("_text"))
    found = durable(hits(keyed, "_key", "_text", grams))
    per_row = license_spans(found, grams).groupBy("_key").agg(
        F.collect_list(F.struct("name", "label", "phrase", "first_word", "last_word", "covered")).alias("spans"),
        F.count(F.when(F.col("phrase"), 1)).alias("n_base"),
        F.min(F.when(F.col("phrase"), F.col("first_word"))).alias("first_word"),
        F.max(F.when(F.col("phrase"), F.col("first_word"))).alias("last_word"),
        F.array_join(F.array_sort(F.collect_set(F.when(F.col("phrase"), F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.collect_set("label")), ",").alias("labels"),
        F.max("covered").alias("score"),
    )
    out = found.select("_key", "n_words").join(per_row, "_key", "left")
    return out.select(
        F.col("_key.id").alias(id_col), "n_words", "spans",
        F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"), "first_word", "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).cast("double").alias("score"),
    )
