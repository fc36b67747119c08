"""Licence scan (operator 2): Dice coefficient over word bigrams.

A text is cut into units, its lines and its paragraphs of several lines. Units
and templates are normalised alike (lower case, runs of anything but letters and
digits become one blank) and compared as sets of word bigrams. A Dice coefficient
of ``t`` needs set sizes within the factor ``(2 - t) / t`` of each other: units
out of every template's bounds are dropped before their bigrams are listed, and a
unit meets only templates within bounds. A unit that reaches the threshold has
most of some template's bigrams, so it has a word of a small set that follows
from the templates (``gate_words``); other units are dropped first. Bigrams are looked up in the templates'
(broadcast; their number is fixed by ``TEMPLATES`` or checked), so only units that
share a bigram with a template are grouped.

``scan_passages`` finds what lines and paragraphs miss, with the same coefficient: the whole text
where it has a blank line, and runs of words. A run has as many words as a template, begins at a
bigram of it and ends with the text at the latest; line breaks, comment signs and blank lines
don't count. Of runs that overlap, one is reported if no better one overlaps it (higher coefficient,
then more common bigrams, earlier, name). A run counts for the template it was sized by only. All is
found within a row; rows without enough bigrams of some template are dropped first.

Only DataFrame functions are used. Defined cases: null and empty texts have no
units; a unit or template of one word has that word as its only "bigram"; equal
coefficients go to the template first by name; repeated rows give one set of
results; an empty table gives no rows; only the id and text columns are read.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from responsekit.llm.common import read, row_key
from responsekit.session import materialize

THRESHOLD = 0.8
#: Public licence statements and notices (name, text).
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0-notice", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
     "compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("BSD-2-Clause-terms", "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
     "that the following conditions are met:"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "This work is dedicated to the public domain under CC0 1.0."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0-notice", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
     "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
     "later version."),
    ("ISC-terms", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
     "granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("MIT", "Released under the MIT License."),
    ("MIT-terms", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
     "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the "
     "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
     "persons to whom the Software is furnished to do so, subject to the following conditions:"),
    ("MPL-2.0-notice", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
     "not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
]
#: Bigrams of this many templates are broadcast (at 10,000 bigrams each, 100 bytes: 1 GB at the very most; licences have few hundred).
MAX_BROADCAST_TEMPLATES = 1000
#: So many different bigrams at most are written into the plan to drop rows early (a saving only).
MAX_LISTED_BIGRAMS = 10_000


def normal_words(text: Column) -> Column:
    return F.split(F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " ")), " ")


def bigrams(df: DataFrame, keys: list[str]) -> DataFrame:
    """``keys``, the distinct bigrams ``g`` of the array ``words``, and their number ``n``."""
    n = F.greatest(F.size("words") - 1, F.lit(1))
    pairs = F.zip_with(F.slice("words", F.lit(1), n), F.slice("words", F.lit(2), n), lambda x, y: F.concat_ws(" ", x, y))
    listed = df.select(*keys, F.array_distinct(pairs).alias("all"))
    return listed.select(*keys, F.size("all").alias("n"), F.explode("all").alias("g"))


def units(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, k1, k2, unit, number, words): lines, and paragraphs (between blank lines) of two lines or more."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), *row_key(docs, id_col, text_col))
    lines = rows.select("doc_id", "k1", "k2", F.lit("line").alias("unit"), F.posexplode(F.split("text", "\n")).alias("number", "part"))
    blocks = rows.select("doc_id", "k1", "k2", F.lit("paragraph").alias("unit"),
                         F.posexplode(F.split("text", r"\n[\x20\x09-\x0D]*\n")).alias("number", "part"))
    return lines.unionByName(blocks.where(F.trim("part").contains("\n")))


def whole_texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, k1, k2, unit, number, words): texts with a blank line; others are a line or a paragraph."""
    rows = docs.where(F.col(text_col).rlike(r"\n[\x20\x09-\x0D]*\n"))
    return rows.select(F.col(id_col).alias("doc_id"), *row_key(docs, id_col, text_col), F.lit("text").alias("unit"), F.lit(0).alias("number"),
                       F.col(text_col).alias("part"))


def gate_words(sets: dict[str, set[str]], threshold: float) -> list[str]:
    """Words of which every unit that reaches the threshold with some template contains one.

    Of a template's m bigrams such a unit has at least ``threshold * m / (2 - threshold)``, so of any
    ``m - that + 1`` it has one; those with the longest (rarest) words are taken, and of each the longer word."""
    words = set()
    for grams in sets.values():
        m = len(grams)
        enough = m - math.ceil(threshold * m / (2 - threshold) - 1e-9) + 1
        longest = sorted((max(g.split(" "), key=lambda w: (len(w), w)) for g in grams), key=lambda w: (-len(w), w))
        words.update(longest[:enough])
    return sorted(w for w in words if not any(o != w and o in w for o in words))


def has_word(text: Column, words: list[str]) -> Column:
    low = F.lower(text)
    return reduce(lambda a, b: a | b, [F.contains(low, F.lit(w)) for w in words])


def scan(docs: DataFrame, templates: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text",
         units=units) -> DataFrame:
    """(doc_id, unit, number, license, dice): the best template of every unit that reaches the threshold.
    ``templates``: name, text."""
    known = bigrams(templates.select("name", normal_words(F.col("text")).alias("words")), ["name"])
    known = known.select("name", "g", F.col("n").alias("n_template"))
    widest = (2 - threshold) / threshold
    low, high = known.agg(F.min("n_template"), F.max("n_template")).first()
    if low is None:
        low, high = 1, 0
    keys = ["doc_id", "k1", "k2", "unit", "number"]
    small = templates.count() <= MAX_BROADCAST_TEMPLATES
    parts = None
    if small:
        sets: dict[str, set[str]] = {}
        for r in known.collect():
            sets.setdefault(r["name"], set()).add(r["g"])
        words = gate_words(sets, threshold)
        if words:  # documents and units without any of these words reach the threshold with no template
            parts = units(docs.where(has_word(F.col(text_col), words)), id_col, text_col).where(has_word(F.col("part"), words))
    cut = (units(docs, id_col, text_col) if parts is None else parts).select(*keys, normal_words(F.col("part")).alias("words"))
    # a unit has more words than different bigrams: too short ones go before their bigrams are listed
    cut = cut.where((F.size("words") >= low / widest) & (F.element_at("words", 1) != ""))
    have = bigrams(cut, keys).where(F.col("n").between(low / widest, high * widest))
    hint = F.broadcast if small else (lambda df: df)
    within = (F.col("n") <= widest * F.col("n_template")) & (F.col("n_template") <= widest * F.col("n"))
    hits = have.join(hint(known), "g").where(within).select(*keys, "n", "name", "n_template", "g").distinct()
    dice = 2 * F.col("common") / (F.col("n") + F.col("n_template"))
    scored = hits.groupBy(*keys, "n", "name", "n_template").agg(F.count("*").alias("common")).select(*keys, "name", dice.alias("dice"))
    best = scored.where(F.col("dice") >= threshold).groupBy(*keys).agg(F.min(F.struct(-F.col("dice"), "name")).alias("best"))
    return best.select("doc_id", "unit", "number", F.col("best.name").alias("license"), (-F.col("best")[best.schema["best"].dataType.names[0]]).alias("dice"))


def runs(docs: DataFrame, templates: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, unit, number, license, dice): runs of words that reach the threshold; ``number`` is the first word's, from 0."""
    named = templates.select("name", normal_words(F.col("text")).alias("words")).where(F.element_at("words", 1) != "")
    known = bigrams(named, ["name"]).groupBy("name").agg(F.collect_list("g").alias("known"))
    known = materialize(known.join(named.select("name", F.size("words").alias("width")), "name"))
    widest = known.agg(F.max("width")).first()[0] or 0
    small = known.count() <= MAX_BROADCAST_TEMPLATES
    narrow = known.where("width = 1").count() > 0
    rows = docs
    sets = {r["name"]: set(r["known"]) for r in known.collect()} if small else {}
    gate = gate_words(sets, threshold) if sets else []
    if gate:
        rows = rows.where(has_word(F.col(text_col), gate))
    rows = rows.select(F.col(id_col).alias("doc_id"), *row_key(docs, id_col, text_col), normal_words(F.col(text_col)).alias("words"))
    n = F.greatest(F.size("words") - 1, F.lit(1))
    pairs = F.zip_with(F.slice("words", F.lit(1), n), F.slice("words", F.lit(2), n), lambda x, y: F.concat_ws(" ", x, y))
    rows = rows.where(F.element_at("words", 1) != "").withColumn("pairs", pairs)
    found = F.concat("pairs", "words") if narrow else F.col("pairs")
    grams = sorted(set().union(*sets.values()))
    if 0 < len(grams) <= MAX_LISTED_BIGRAMS:
        found = F.array_intersect(found, F.lit(grams))
    rows = rows.withColumn("found", found)
    # a run that reaches the threshold has this many of the template's bigrams, so has the text
    enough = F.ceil(threshold * F.size("known") / (2 - threshold) - 1e-9).cast("int")
    hint = F.broadcast if small else (lambda df: df)
    met = rows.where(F.size("found") > 0).crossJoin(hint(known.withColumn("enough", F.greatest(enough, F.lit(1)))))
    met = met.where(F.size(F.array_intersect("found", "known")) >= F.col("enough")).drop("found")
    grams = F.when(F.col("width") == 1, F.col("words")).otherwise(F.col("pairs"))
    met = met.select("doc_id", "k1", "k2", "name", "known", "width", "enough", F.size("words").alias("size"), grams.alias("grams"))
    at = F.filter(F.transform("grams", lambda g, k: F.when(F.array_contains("known", g), k + 1)), lambda k: k.isNotNull())
    # begins at a bigram of the template and has enough of them within the width
    last = F.greatest(F.col("width") - 2, F.lit(0))
    starts = F.filter("at", lambda p, k: F.get("at", k + F.col("enough") - 1) - p <= last)
    met = met.withColumn("at", at).withColumn("start", F.explode(starts)).drop("at")
    met = met.withColumn("mine", F.array_distinct(F.slice("grams", F.col("start"), F.greatest(F.col("width") - 1, F.lit(1)))))
    common = F.size(F.array_intersect("mine", "known"))
    met = met.select("doc_id", "k1", "k2", "name", "start", F.least(F.col("start") + F.col("width"), F.col("size") + 1).alias("end"), common.alias("common"),
                     (2 * common / (F.size("mine") + F.size("known"))).alias("dice"))
    met = met.where(F.col("dice") >= threshold).distinct()
    rank = F.struct((-F.col("dice")).alias("a"), (-F.col("common")).alias("b"), F.col("start").alias("c"), F.col("name").alias("d"))
    near = Window.partitionBy("k1", "k2").orderBy("start").rangeBetween(-widest, widest)
    met = met.withColumn("rank", rank).withColumn("others", F.collect_list(F.struct("start", "end", "rank")).over(near))
    better = F.exists("others", lambda o: (o["start"] < F.col("end")) & (F.col("start") < o["end"]) & (o["rank"] < F.col("rank")))
    return met.where(~better).select("doc_id", F.lit("run").alias("unit"), (F.col("start") - 1).alias("number"), F.col("name").alias("license"), "dice")


def scan_passages(docs: DataFrame, templates: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """(doc_id, unit, number, license, dice) of whole texts and runs of words, for what ``scan`` can't see in lines and paragraphs."""
    whole = scan(docs, templates, threshold, id_col, text_col, whole_texts)
    return whole.unionByName(runs(docs, templates, threshold, id_col, text_col))


def op2_license_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    templates = spark.createDataFrame(TEMPLATES, "name string, text string")
    return scan_passages(read(spark, sf_dir, "documents"), templates)


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    templates = spark.createDataFrame(TEMPLATES, "name string, text string")
    return scan(read(spark, sf_dir, "documents"), templates)


def _sql_text(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


_TEMPLATES_SQL = ", ".join(f"({_sql_text(n)}, {_sql_text(t)})" for n, t in TEMPLATES)

SQL = rf"""
WITH unit AS (
  SELECT doc_id, 'line' AS unit, generate_subscripts(p, 1) - 1 AS number, unnest(p) AS part, '' AS name
  FROM (SELECT doc_id, string_split(text, chr(10)) AS p FROM documents)
  UNION ALL
  SELECT * FROM (SELECT doc_id, 'paragraph', generate_subscripts(p, 1) - 1, unnest(p) AS part, ''
    FROM (SELECT doc_id, regexp_split_to_array(text, '\n[\x20\x09-\x0D]*\n') AS p FROM documents)) WHERE contains(trim(part), chr(10))
  UNION ALL SELECT NULL, 'template', 0, column1, column0 FROM (VALUES {_TEMPLATES_SQL}) t(column0, column1)),
word AS (SELECT doc_id, unit, number, name, string_split(trim(regexp_replace(lower(part), '[^\p{{L}}\p{{N}}]+', ' ', 'g')), ' ') AS w FROM unit),
gram AS (SELECT doc_id, unit, number, name, CASE WHEN len(w) = 1 THEN w
           ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS g FROM word WHERE w[1] <> ''),
have AS (SELECT doc_id, unit, number, len(g) AS n, unnest(g) AS g FROM gram WHERE unit <> 'template'),
known AS (SELECT name, len(g) AS m, unnest(g) AS g FROM gram WHERE unit = 'template'),
dice AS (SELECT doc_id, unit, number, name, 2.0 * count(*) / (n + m) AS dice FROM have JOIN known USING (g)
         GROUP BY doc_id, unit, number, name, n, m HAVING 2.0 * count(*) / (n + m) >= {THRESHOLD}),
best AS (SELECT *, row_number() OVER (PARTITION BY doc_id, unit, number ORDER BY dice DESC, name) AS k FROM dice)
SELECT doc_id, unit, CAST(number AS INTEGER) AS number, name AS license, dice FROM best WHERE k = 1
"""
