"""Licence scan: TF-IDF cosine of text lines and whole files to templates, then inheritance from directories.

DataFrame functions only.

1. Lines become words; for every template word its document frequency over all lines is counted (one pass; the
   result has as many rows as the templates have words). It gives idf weights, and the templates' unit vectors.
2. Each line that holds a telling word (a template word that isn't a plain function word), and each text as a whole
   if it has such a line, is compared with every template: a join of its words with the templates' weights. Words
   that no template has weigh as much as the rarest one; they enter through the norm.
3. A file's own licence is its best line or whole text with a cosine of at least ``LEAST``. A file of which such
   lines are at least ``FILE_SHARE`` is a licence file: its licence holds for its directory.
4. Other files take the licence of their nearest ancestor directory that has one. Ancestors are joined by path,
   once per directory, not per file.

The templates and their weights are a fixed small table, so broadcasting them is safe; the joins by directory are
left to Spark, which splits a directory that holds a third of all files.

Edge cases: null and empty texts have no licence of their own but may inherit; a null path inherits nothing.
Repeated rows give equal rows. Ties between templates go to the first name, between licence files of one directory
to the higher cosine, then the first name. An empty table gives no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sectora.llm import common

LEAST, FILE_SHARE = 0.6, 0.5

# Public licence headers and statements, by SPDX id.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("MIT", "Released under the MIT License"),
    ("MIT", "Licensed under the MIT License"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version"),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License version 2 as published by the Free Software Foundation"),
    ("LGPL-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License, version 2.1"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies"),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0"),
    ("CC0-1.0", "To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights to this software to the public domain worldwide"),
    ("Zlib", "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely"),
    ("Unlicense", "This is free and unencumbered software released into the public domain"),
    ("proprietary", "All rights reserved"),
]
# Template words that tell nothing on their own ("mit" is a German preposition).
PLAIN = "a above all an and any anyone appear are as at author available by can code copies either extent fee file for form forms free general have if in including into is it later law made materials may met mit not notice obtain of on or person possible program provided public published purpose related s sa source subject terms that the this to under use v version which with without work www you 2 3 4.0 2.0 2.1".split()


def words_of(text: Column) -> Column:
    """Lower-case words of letters and digits; dots stay inside numbers."""
    return F.filter(F.split(F.lower(text), r"[^a-z0-9.]+|[.](?![0-9])"), lambda w: w != "")


def _template_words(spark) -> list[tuple[int, str, str, list[str]]]:
    rows = spark.createDataFrame([(k, n, t) for k, (n, t) in enumerate(TEMPLATES)], "template int, licence string, text string")
    return [(r.template, r.licence, r.text, r.words) for r in rows.withColumn("words", words_of(F.col("text"))).collect()]


def _idf(documents: int, holding: int) -> float:
    return math.log((1 + documents) / (1 + holding)) + 1


def _frequencies(texts: DataFrame, vocabulary: list[str]) -> tuple[int, dict[str, int]]:
    """Number of lines, and of lines that hold each template word: as many rows as there are words."""
    lines = texts.select(F.explode(F.split(F.coalesce("text", F.lit("")), "\n")).alias("line"))
    shared = F.array_intersect(words_of(F.col("line")), F.array(*[F.lit(w) for w in vocabulary]))
    counted = lines.select(F.explode(F.concat(shared, F.array(F.lit("\n")))).alias("word")).groupBy("word").agg(F.count("*").alias("n")).collect()
    holding = {r.word: r.n for r in counted}
    return holding.pop("\n", 0), holding


def _units(files: DataFrame, telling: list[str]) -> DataFrame:
    """Per file, written with a row number: its columns but the text, its telling lines' words, and then all its words."""
    tell = F.array(*[F.lit(w) for w in telling])
    lines = F.transform(F.split(F.coalesce("text", F.lit("")), "\n"), lambda x, i: F.struct(i.alias("line"), words_of(x).alias("words")))
    cut = files.select(F.monotonically_increasing_id().alias("row"), "*", F.filter(lines, lambda x: F.arrays_overlap(x["words"], tell)).alias("units"))
    whole = F.array(F.struct(F.lit(-1).alias("line"), words_of(F.col("text")).alias("words")))
    return common.written(cut.withColumn("units", F.when(F.size("units") > 0, F.concat("units", whole))).drop("text"), "licence-units")


def own_licences(units: DataFrame, templates, idf: dict[str, float]) -> DataFrame:
    """``row, licence, cosine, licence_words`` of the files with a licence of their own."""
    spark, weights, rarest = units.sparkSession, [], max(idf.values())
    for k, licence, _, template in templates:
        vector = {w: template.count(w) * idf[w] for w in template}
        norm = math.sqrt(sum(v * v for v in vector.values()))
        weights += [(k, licence, w, v / norm) for w, v in vector.items()]
    # at most the words of TEMPLATES: a fixed bound
    weights = F.broadcast(spark.createDataFrame(weights, "template int, licence string, word string, weight double"))
    idfs = F.create_map(*[x for w in idf for x in (F.lit(w), F.lit(idf[w]))])

    each = units.where("units is not null").select("row", F.explode("units").alias("u")).select("row", "u.line", "u.words")
    terms = each.select("row", "line", F.explode("words").alias("word")).groupBy("row", "line", "word").agg(F.count("*").alias("tf"))
    terms = terms.withColumn("w", F.col("tf") * F.coalesce(idfs[F.col("word")], F.lit(rarest)))
    norms = terms.groupBy("row", "line").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"), F.sum("tf").alias("n"))
    dots = terms.join(weights, "word").groupBy("row", "line", "template", "licence").agg(F.sum(F.col("w") * F.col("weight")).alias("dot"))
    scored = dots.join(norms, ["row", "line"]).select("row", "line", "licence", "n", F.least(F.lit(1.0), F.round(F.col("dot") / F.col("norm"), 6)).alias("cosine"))
    # the best template of each unit, then the best unit of each row
    best = scored.groupBy("row", "line").agg(F.min_by("licence", F.struct(-F.col("cosine"), F.col("licence"))).alias("licence"), F.max("cosine").alias("cosine"), F.first("n").alias("n")).where(F.col("cosine") >= LEAST)
    return best.groupBy("row").agg(
        F.min_by("licence", F.struct(-F.col("cosine"), F.col("licence"))).alias("licence"), F.max("cosine").alias("cosine"),
        # the whole text's words if it is close itself, else those of its close lines
        F.max(F.when(F.col("line") < 0, F.col("n"))).alias("whole_words"), F.sum(F.when(F.col("line") >= 0, F.col("n"))).alias("line_words"),
    ).select("row", "licence", "cosine", F.coalesce("whole_words", "line_words").alias("licence_words"))


def scan(files: DataFrame, text: str = "text", path: str = "path") -> DataFrame:
    """All columns of ``files`` but the text, with ``licence, cosine, origin, licence_directory``.

    ``origin`` is ``file`` (a licence file), ``header`` (a statement in the file), ``inherited`` or ``none``.
    """
    made = ("licence", "cosine", "origin", "licence_directory")
    rest = [c for c in files.columns if c != text and c.lower() not in made]
    # the input's columns travel as one, so that their names meet none of the names used here
    given = F.struct(*[F.col(f"`{c}`") for c in rest]) if rest else F.struct(F.lit(None).alias("nothing"))
    texts = files.select(F.col(f"`{text}`").alias("text"), F.col(f"`{path}`").alias("path"), given.alias("given"))
    path = "path"
    templates = _template_words(files.sparkSession)
    vocabulary = sorted({w for *_, cut in templates for w in cut})
    total, holding = _frequencies(texts, vocabulary)
    units = _units(texts, sorted(set(vocabulary) - set(PLAIN)))
    own = own_licences(units, templates, {w: _idf(total, holding.get(w, 0)) for w in vocabulary})
    n_words = F.size(F.element_at("units", -1)["words"])
    placed = units.select("row", "path", "given", F.when(F.col("units").isNotNull(), n_words).alias("n_words")).join(own, "row", "left")
    directory = F.when(F.contains(path, F.lit("/")), F.regexp_extract(path, r"^(.*)/[^/]*$", 1)).when(F.col(path).isNotNull(), F.lit(""))
    named = F.regexp_extract(path, r"([^/]*)$", 1).rlike(r"(?i)^(licen[cs]e|copying|notice)")
    is_file = F.col("licence").isNotNull() & (named | (F.col("licence_words") >= F.col("n_words") * FILE_SHARE))
    placed = common.written(placed.withColumn("directory", directory).withColumn("is_file", F.coalesce(is_file, F.lit(False))).drop("n_words", "licence_words"), "licence-files")

    declared = placed.where("is_file and directory is not null").groupBy("directory").agg(
        F.min_by("licence", F.struct(-F.col("cosine"), F.col("licence"))).alias("its"), F.max("cosine").alias("its_cosine")
    )
    # ancestors of each directory, itself first; the root is ''
    parts = F.split("directory", "/")
    up = F.transform(F.sequence(F.lit(0), F.size(parts)), lambda k: F.struct(k.alias("depth"), F.array_join(F.slice(parts, F.lit(1), k), "/").alias("ancestor")))
    chains = placed.select("directory").where("directory is not null").distinct().select("directory", F.explode(up).alias("u")).select("directory", "u.*")
    nearest = (
        chains.join(declared.withColumnRenamed("directory", "ancestor"), "ancestor")
        .groupBy("directory").agg(F.max_by(F.struct("ancestor", "its", "its_cosine"), "depth").alias("n")).select("directory", "n.*")
    )
    out = placed.join(nearest, "directory", "left")
    mine = F.col("licence").isNotNull()
    origin = F.when(F.col("is_file"), "file").when(mine, "header").when(F.col("its").isNotNull(), "inherited").otherwise("none")
    return out.select(
        *[F.col("given").getField(c).alias(c) for c in rest], F.coalesce("licence", "its").alias("licence"), F.when(mine, F.col("cosine")).otherwise(F.col("its_cosine")).alias("cosine"),
        origin.alias("origin"), F.when(~mine, F.col("ancestor")).alias("licence_directory"),
    )
