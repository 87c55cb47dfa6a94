"""License texts and notices by diagonal voting, in SQL functions and joins only.

Every run of K words of every text is hashed and joined with the positions of such runs in the
templates. A hit votes for its diagonal, the offset between text and template; words that were
put in or left out move a copy to a neighbouring diagonal, so neighbours are merged to spans.
A span is verified by its words: hits are compared as text, not by hash alone, and must cover most
of the template. The templates are a fixed list, so their table is broadcast; texts are never moved,
only hits are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidegauge.functions.rows import compute_once
from tidegauge.llm.common import stored

UPPER, LOWERED = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
APART = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
K = 5
# Diagonals this near to each other belong to one copy.
GAP = 6
# Share of a template's words that verified hits must cover.
SHARE = 0.7
# Score of a text with a license's name and no verified span.
NAMED = 0.5

# The phrases that count as names of licenses, and their labels.
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}

# Texts and notices of public licenses.
TEMPLATES = [
    ("apache-2.0-notice", "Licensed under the Apache License, Version 2.0."),
    ("apache-2.0-header", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."""),
    ("bsd-2-clause", """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."""),
    ("bsd-3-clause", """Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."""),
    ("bsd-disclaimer", """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED."""),
    ("cc-by-4.0-notice", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-nc-4.0-notice", "Licensed under CC BY-NC 4.0."),
    ("gpl-notice", """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."""),
    ("gpl-warranty", """This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."""),
    ("gpl-3.0-notice", "This work is licensed under the GNU General Public License, version 3."),
    ("isc", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."""),
    ("mit-notice", "Released under the MIT License."),
    ("mit-text", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."""),
    ("mpl-2.0-notice", """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at"""),
    ("unlicense", """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."""),
    ("zlib", """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software."""),
]


def words_of(text: Column) -> Column:
    """Words of a text, A-Z in small letters. Only texts of ASCII alone take the quick way, as other
    letters must stay as they are."""
    low = F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWERED))
    return F.filter(F.split(low, APART), lambda w: w != "")


def run_hashes(words: str, k: int = K) -> Column:
    """A hash for each run of ``k`` words, in order."""
    hashed = F.transform(words, lambda w: F.xxhash64(w))
    starts = F.sequence(F.lit(1), F.size(words) - (k - 1))
    runs = F.transform(F.arrays_zip(F.array(hashed.alias("h")).alias("h")), lambda one: F.transform(starts, lambda i: F.xxhash64(F.slice(one["h"], i, F.lit(k)))))
    return F.when(F.size(words) >= k, runs[0]).otherwise(F.array().cast("array<bigint>"))


def run_text(words: str, at: Column, k: int = K) -> Column:
    return F.array_join(F.slice(words, at, F.lit(k)), " ")


def template_runs(spark: SparkSession, templates: list[tuple[str, str]] = TEMPLATES, k: int = K) -> DataFrame:
    """``(gram, template, size, tpos, ttext)``: where each run of words stands in a template, from 1."""
    listed = F.explode(F.array(*(F.struct(F.lit(name).alias("template"), F.lit(text).alias("text")) for name, text in templates))).alias("t")
    rows = compute_once(spark.range(1).select(listed).select("t.*"), "words", words_of(F.col("text")))
    at = rows.select("template", F.size("words").alias("size"), "words", F.posexplode(run_hashes("words", k)).alias("tpos", "gram"))
    return at.select("gram", "template", "size", (F.col("tpos") + 1).alias("tpos"), run_text("words", F.col("tpos") + 1, k).alias("ttext"))


def _named(words: str, phrases: dict[str, str]) -> Column:
    """``(at, label)`` wherever the words of a phrase stand side by side."""
    def label(word, i):
        result = None
        for phrase, name in phrases.items():
            first, *rest = phrase.split(" ")
            met = word == first
            for j, other in enumerate(rest, 1):
                met = met & (F.get(F.col(words), i + j) == other)
            result = F.when(met, name) if result is None else result.when(met, name)
        return F.struct(i.alias("at"), result.alias("label"))

    return F.filter(F.transform(words, label), lambda s: s["label"].isNotNull())


def votes(docs: DataFrame, templates: list[tuple[str, str]] = TEMPLATES) -> DataFrame:
    """One line for each row of the table, whose ``pos`` is 0, and its hits ``(row, pos, template, size, tpos)``."""
    rows = docs.select(F.col("doc_id").cast("bigint"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), F.monotonically_increasing_id().alias("row"))
    # Every phrase ends in one of these.
    may_name = F.col("text").rlike("(?i)license|cc")
    rows = compute_once(rows, "words", words_of(F.col("text")))
    names = F.when(may_name, _named("words", PHRASES)).otherwise(F.array().cast("array<struct<at:int,label:string>>"))
    rows = compute_once(rows, "names", names)
    runs = F.posexplode(F.concat(F.array(F.lit(None).cast("bigint")), run_hashes("words"))).alias("pos", "gram")
    each = rows.select("row", "doc_id", "words", "names", runs)
    met = each.join(F.broadcast(template_runs(rows.sparkSession, templates)), "gram", "left")
    head = F.col("pos") == 0
    met = met.where(head | (F.col("ttext") == run_text("words", F.col("pos"))))

    def of_head(value):
        return F.when(head, value)

    return met.select(
        "row", of_head(F.col("doc_id")).alias("doc_id"), of_head(F.size("words")).cast("bigint").alias("n_words"), of_head(F.col("names")).alias("names"), "pos", "template", "size", "tpos"
    )


def verified_spans(hits: DataFrame) -> DataFrame:
    """``(row, template, start, end, votes, share)``: copies of templates, words counted from 0."""
    diagonal = (F.col("pos") - F.col("tpos")).alias("diagonal")
    by_diagonal = hits.groupBy("row", "template", "size", diagonal).agg(
        F.count("*").alias("votes"), F.collect_set("tpos").alias("places"), F.min("pos").alias("low"), F.max("pos").alias("high")
    )
    along = Window.partitionBy("row", "template").orderBy("diagonal")
    begins = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(along) > GAP, F.lit(False)).cast("int")
    copies = by_diagonal.withColumn("begins", begins).withColumn("copy", F.sum("begins").over(along))
    merged = copies.groupBy("row", "template", "size", "copy").agg(
        F.sum("votes").alias("votes"), F.array_distinct(F.flatten(F.collect_list("places"))).alias("places"), F.min("low").alias("low"), F.max("high").alias("high")
    )
    covered = F.size(F.array_distinct(F.flatten(F.transform("places", lambda p: F.sequence(p, p + (K - 1))))))
    spans = merged.select("row", "template", (F.col("low") - 1).alias("start"), (F.col("high") + K - 1).alias("end"), "votes", (covered / F.col("size")).alias("share"))
    return spans.where(F.col("share") >= SHARE)


def scan(docs: DataFrame, templates: list[tuple[str, str]] = TEMPLATES) -> DataFrame:
    """``(doc_id, n_words, names, spans)`` of every row.

    ``names`` are the places ``(at, label)`` where a license is named, ``spans`` the verified copies
    ``(start, end, template, share)`` by start. Null texts are empty and have neither; equal rows and
    rows without an id stay; an empty table gives no rows; other columns play no part. A very long
    text is one row of words, and where two copies touch, their diagonals are apart by a template's length.
    """
    found = stored(votes(docs, templates), "votes")
    spans = verified_spans(found.where("pos > 0").select("row", "pos", "template", "size", "tpos"))
    listed = spans.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("start", "end", "template", "share"))).alias("spans"))
    none = F.array().cast("array<struct<start:int,end:int,template:string,share:double>>")
    return found.where("pos = 0").select("row", "doc_id", "n_words", "names").join(listed, "row", "left").select("doc_id", "n_words", "names", F.coalesce("spans", none).alias("spans"))


def summary(scanned: DataFrame) -> DataFrame:
    """Digest columns of ``scan``; ``score`` is the largest share of a template that is covered, at least
    NAMED where a license is named, else 0."""
    at = F.transform("names", lambda s: s["at"])
    base = F.transform("names", lambda s: s["label"])

    def listed(labels):
        return F.array_join(F.array_sort(F.array_distinct(labels)), ",")

    share = F.coalesce(F.array_max(F.transform("spans", lambda s: s["share"])), F.lit(0.0))
    return scanned.select(
        "doc_id", "n_words", F.size("names").cast("bigint").alias("n_base"), F.array_min(at).cast("bigint").alias("first_word"), F.array_max(at).cast("bigint").alias("last_word"),
        listed(base).alias("base_labels"), listed(F.concat(base, F.transform("spans", lambda s: s["template"]))).alias("labels"),
        F.greatest(share, F.when(F.size("names") > 0, F.lit(NAMED)).otherwise(F.lit(0.0))).alias("score"),
    )


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def words_sql(text: str) -> str:
    return f"list_filter(string_split_regex(translate(coalesce({text}, ''), '{UPPER}', '{LOWERED}'), '{APART}'), lambda w: w <> '')"


# Runs of words are joined as lists; the places a copy covers are unnested and counted.
ORACLE = f"""
WITH docs AS (SELECT row_number() OVER () AS row, doc_id, {words_sql('text')} AS w FROM documents),
phrases(label, p) AS (VALUES {', '.join(f"({_quoted(label)}, {phrase.split(' ')})" for phrase, label in PHRASES.items())}),
named AS (
    SELECT row, label, i - 1 AS place FROM docs, phrases, unnest(range(1, len(w) - len(p) + 2)) AS r(i) WHERE w[i : i + len(p) - 1] = p),
base AS (
    SELECT row, count(*) AS n_base, min(place) AS first_word, max(place) AS last_word, list(DISTINCT label) AS labels FROM named GROUP BY row),
templates AS (SELECT template, {words_sql('t')} AS w FROM (VALUES {', '.join(f'({_quoted(n)}, {_quoted(t)})' for n, t in TEMPLATES)}) AS v(template, t)),
parts AS (SELECT template, len(w) AS size, i AS tpos, w[i : i + {K - 1}] AS g FROM templates, unnest(range(1, len(w) - {K - 2})) AS r(i)),
runs AS (SELECT row, i AS pos, w[i : i + {K - 1}] AS g FROM docs, unnest(range(1, len(w) - {K - 2})) AS r(i)),
hits AS (SELECT row, template, size, tpos, pos - tpos AS diagonal FROM runs JOIN parts USING (g)),
stepped AS (
    SELECT *, diagonal - lag(diagonal) OVER (PARTITION BY row, template ORDER BY diagonal) > {GAP} AS begins
    FROM (SELECT DISTINCT row, template, diagonal FROM hits)),
copies AS (
    SELECT row, template, diagonal, sum(CASE WHEN begins THEN 1 ELSE 0 END) OVER (PARTITION BY row, template ORDER BY diagonal) AS copy FROM stepped),
covered AS (
    SELECT row, template, size, copy, count(DISTINCT tpos + j) / size AS share
    FROM hits JOIN copies USING (row, template, diagonal), range({K}) AS r(j) GROUP BY row, template, size, copy),
spans AS (SELECT row, list(DISTINCT template) AS labels, max(share) AS share FROM covered WHERE share >= {SHARE} GROUP BY row)
SELECT doc_id, len(w) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(array_to_string(list_sort(base.labels), ','), '') AS base_labels,
       array_to_string(list_sort(list_concat(coalesce(base.labels, []), coalesce(spans.labels, []))), ',') AS labels,
       CAST(greatest(coalesce(share, 0), CASE WHEN n_base > 0 THEN {NAMED} ELSE 0 END) AS DOUBLE) AS score
FROM docs LEFT JOIN base USING (row) LEFT JOIN spans USING (row)
"""
